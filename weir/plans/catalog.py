"""Registered queries of the engine's own operators, over messages made from the events and orders tables.

Messages are made by native expressions alone, so that the same rules can be written in SQL: every event is a JSON
message of topic events, with faults by residues of its id; every order is a change record, as JSON or as framed Avro.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions.avro import decimal_value
from weir.functions.avro_write import encode, framed
from weir.functions.canonical import JsonError, dump, parse, parse_lossy
from weir.functions.columns import event_timestamp, framing_id, routed
from weir.operators import delivery
from weir.operators.rows import OUTCOMES, RowPath, encode_rows, outcome_counts, typed_rows, with_routes
from weir.operators.spread import spread
from weir.plans.oracle import ORACLE
from weir.plans.tables import ColumnSpec, TableSpec
from weir.plans.transforms import Transform
from weir.sources.capture import first_messages

FROZEN = "2026-01-01T00:00:00.123456"
CLUSTER = "main"
DAY = {"partition_type": "DAY", "partition_field": "__event_timestamp"}


def _columns(text: str) -> tuple[ColumnSpec, ...]:
    """Columns from "name TYPE[!]", comma-separated; ! is required."""
    parts = (c.split() for c in text.split(","))
    return tuple(ColumnSpec(n, k.rstrip("!"), k.endswith("!")) for n, k in parts)


_KAFKA = "__cluster STRING, __kafka_partition INTEGER, __kafka_offset INTEGER, __kafka_topic STRING, __schema JSON, __event_timestamp TIMESTAMP, __inserted_at TIMESTAMP"
_CE = "__ce_type STRING, __ce_id STRING, __ce_time STRING"
TABLES = {
    "json_events": _columns(f"user_id INTEGER!, payload JSON, __operation STRING, {_KAFKA}"),
    "cloudevents": _columns(f"user_id INTEGER!, payload JSON, {_CE}, {_KAFKA}"),
    "cloudevents_enriched": _columns(f"user_id INTEGER!, payload JSON, headers JSON, {_CE}, {_KAFKA}"),
    "json_cdc": _columns(f"o_orderkey INTEGER!, payload JSON, __before JSON, __ce_type STRING, __ce_id STRING, {_KAFKA}"),
    "debezium_unwrap": _columns(f"o_orderkey INTEGER!, payload JSON, __operation STRING, __deleted BOOLEAN, {_KAFKA}"),
    "avro_events": _columns(f"o_orderkey INTEGER!, payload JSON, __operation STRING, {_KAFKA}"),
}
EVENTS_TABLE, ORDERS_TABLE = "p.d.events", "p.d.orders"

_ORDER_FIELDS = [
    {"name": "o_orderkey", "type": "long"},
    {"name": "o_orderstatus", "type": "string"},
    {"name": "o_totalprice", "type": "double"},
    {"name": "o_orderdate", "type": {"type": "long", "logicalType": "timestamp-millis"}},
]
_ORDER = {"type": "record", "name": "Value", "fields": _ORDER_FIELDS}
CDC_SCHEMA = {
    "type": "record",
    "name": "Envelope",
    "fields": [
        {"name": "before", "type": ["null", _ORDER]},
        {"name": "after", "type": ["null", "Value"]},
        {"name": "source", "type": {"type": "record", "name": "Source", "fields": [{"name": "ts_ms", "type": "long"}]}},
        {"name": "op", "type": "string"},
    ],
}
EVENT_SCHEMA = {
    "type": "record",
    "name": "Envelope",
    "fields": [*_ORDER_FIELDS[:3], {"name": "who", "type": {"type": "record", "name": "Who", "fields": [{"name": "o_custkey", "type": "long"}]}}],
}
CDC_ID, EVENT_ID = 9001, 9002


def row_path(transform: str, **options) -> RowPath:
    topic = "events" if transform in ("json_events", "cloudevents", "cloudevents_enriched") else "orders"
    name = EVENTS_TABLE if topic == "events" else ORDERS_TABLE
    removed = options.pop("removed", {})
    table = TableSpec(name, TABLES[transform], **DAY)
    return RowPath(Transform(transform, CLUSTER, removed), {topic: name}, {name: table}, **options)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _ms(column: str) -> Column:
    """Epoch milliseconds of a time, which is in UTC if it has no zone."""
    return F.unix_millis(F.col(column).cast("timestamp"))


def event_messages(events: DataFrame) -> DataFrame:
    """Events as messages. Residues of the id make null values (17), bad keys (19), bad values (23), a topic without a
    route (29) and messages without headers (31)."""
    n = F.col("event_id")
    value = F.concat(
        F.lit('{"event_id": '), n.cast("string"), F.lit(', "event_type": "'), F.col("event_type"), F.lit('", "value": '), F.col("value").cast("string"),
        F.lit(', "props": '), F.col("props"), F.lit("}"),
    )
    header = lambda name, text: F.struct(F.lit(name).alias("key"), text.cast("binary").alias("value"))
    always = F.array(header("ce_type", F.col("event_type")), header("ce_id", n.cast("string")))
    timed = F.concat(always, F.array(header("ce_time", event_timestamp(_ms("ts")))))
    return events.select(
        F.when(n % 29 == 0, "unrouted").otherwise("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        n.alias("offset"),
        _ms("ts").alias("timestamp"),
        F.when(n % 19 == 0, "nope").otherwise(F.concat(F.lit('{"user_id": '), F.col("user_id").cast("string"), F.lit("}"))).cast("binary").alias("key"),
        F.when(n % 17 == 0, None).when(n % 23 == 0, "{bad").otherwise(value).cast("binary").alias("value"),
        F.when(n % 31 == 0, None).when(n % 3 == 0, timed).otherwise(always).alias("headers"),
    )


def _operation() -> Column:
    return F.when(F.col("o_orderstatus") == "O", "c").when(F.col("o_orderstatus") == "P", "u").otherwise("d")


def _order_message(orders: DataFrame, value) -> DataFrame:
    key = F.concat(F.lit('{"o_orderkey": '), F.col("o_orderkey").cast("string"), F.lit("}"))
    return orders.select(
        F.lit("orders").alias("topic"),
        (F.col("o_custkey") % 4).cast("int").alias("partition"),
        F.col("o_orderkey").alias("offset"),
        _ms("o_orderdate").alias("timestamp"),
        key.cast("binary").alias("key"),
        value.alias("value"),
        F.lit(None).cast("array<struct<key: string, value: binary>>").alias("headers"),
    )


def order_changes(orders: DataFrame) -> DataFrame:
    """Orders as JSON change records: O is new, P has a cheaper state before, F is gone (after is null)."""
    price = lambda p: F.concat(F.lit('{"k": '), F.col("o_orderkey").cast("string"), F.lit(', "p": '), p.cast("string"), F.lit("}"))
    old = F.when(_operation() == "u", price(F.lit(1.5))).when(_operation() == "d", price(F.col("o_totalprice"))).otherwise("null")
    new = F.when(_operation() == "d", "null").otherwise(price(F.col("o_totalprice")))
    value = F.concat(F.lit('{"before": '), old, F.lit(', "after": '), new, F.lit("}"))
    return _order_message(orders, value.cast("binary"))


def _avro_batches(batches: Iterator[pa.RecordBatch], changes: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = []
        for r in batch.to_pylist():
            if changes:
                row = {k: r[k] for k in ("o_orderkey", "o_orderstatus", "o_totalprice")} | {"o_orderdate": r["ms"]}
                gone = r["op"] == "d"
                change = {"before": row if gone else None, "after": None if gone else row, "source": {"ts_ms": r["ms"]}, "op": r["op"]}
                values.append(framed(CDC_ID, encode(CDC_SCHEMA["fields"][0]["type"], change["before"]) + _rest(change)))
            else:
                values.append(framed(EVENT_ID, encode(EVENT_SCHEMA, {**r, "who": {"o_custkey": r["o_custkey"]}})))
        names = [n for n in batch.schema.names if n not in ("ms", "op")]
        yield pa.record_batch([*(batch.column(batch.schema.names.index(n)) for n in names), pa.array(values, pa.binary())], [*names, "value"])


def _rest(change: dict) -> bytes:
    """after, source and op of a change; after names the record that before defines."""
    after = encode(["null", _ORDER], change["after"])
    return after + encode(CDC_SCHEMA["fields"][2]["type"], change["source"]) + encode("string", change["op"])


def order_avro(orders: DataFrame, changes: bool = True) -> DataFrame:
    """Orders as framed Avro: change records, or plain events."""
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    rows = orders.select(*names, _ms("o_orderdate").alias("ms"), _operation().alias("op"))
    fields = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, value binary"
    if dict(rows.dtypes)["o_orderdate"] == "timestamp":
        fields = fields.replace("timestamp_ntz", "timestamp")
    return _order_message(rows.mapInArrow(lambda b: _avro_batches(b, changes), fields), F.col("value"))


def _rows(messages: DataFrame, path: RowPath, *columns: str) -> DataFrame:
    table, path.wire = next(iter(path.tables.values())), False
    found = typed_rows(encode_rows(messages, path, FROZEN), table)
    own = columns or [c.name for c in table.columns if c.name != "__operation"]
    return found.select(*own)


_CDC_NAMES = ("o_orderkey", "payload", "__operation", "__deleted", "__kafka_offset", "__event_timestamp", "__schema")


@dataclass(frozen=True)
class RowQuery:
    """A query of the row path: the table that messages are made from, how, their path, and the columns returned."""

    source: str
    messages: Callable[[DataFrame], DataFrame]
    path: Callable[[], RowPath]
    columns: tuple[str, ...] = ()

    def rows(self, messages: DataFrame) -> DataFrame:
        return _rows(messages, self.path(), *self.columns)

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.rows(self.messages(_table(spark, sf_dir, self.source)))


def _cdc_path(**options) -> RowPath:
    return row_path("debezium_unwrap", encoding="avro", schemas={CDC_ID: CDC_SCHEMA}, **options)


#: The six transforms over whole tables; bench.py times them over messages made before.
ROW_QUERIES = {
    "json_events_rows": RowQuery("events", event_messages, lambda: row_path("json_events")),
    "cloudevents_rows": RowQuery("events", event_messages, lambda: row_path("cloudevents")),
    "cloudevents_enriched_rows": RowQuery("events", event_messages, lambda: row_path("cloudevents_enriched")),
    "json_cdc_rows": RowQuery(
        "orders", order_changes, lambda: row_path("json_cdc"),
        ("o_orderkey", "payload", "__before", "__kafka_partition", "__kafka_offset", "__event_timestamp", "__schema"),
    ),
    "debezium_rows": RowQuery("orders", order_avro, _cdc_path, _CDC_NAMES),
    "debezium_denylist": RowQuery("orders", order_avro, lambda: _cdc_path(removed={"orders": ("o_totalprice", "o_orderdate")}), _CDC_NAMES),
    "avro_events_rows": RowQuery(
        "orders", lambda orders: order_avro(orders, False), lambda: row_path("avro_events", encoding="avro", schemas={EVENT_ID: EVENT_SCHEMA}),
        ("o_orderkey", "payload", "__kafka_offset", "__event_timestamp", "__schema"),
    ),
}


def _outcomes(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return encode_rows(event_messages(_table(spark, sf_dir, "events")), row_path("cloudevents", **options), FROZEN)


def skip_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _outcomes(spark, sf_dir, skip_invalid_keys=True, skip_decode_errors=True)
    return found.select("offset", "outcome", "skip_reason", "stage")


def outcome_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_counts(_outcomes(spark, sf_dir))


def topic_routing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = with_routes(event_messages(_table(spark, sf_dir, "events")), row_path("json_events"))
    return routes.where("skip_reason is null").groupBy("topic", "destination_id").agg(F.count(F.lit(1)).alias("n"))


def unrouted_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(_table(spark, sf_dir, "events"))
    return messages.where(routed("topic", {"events": EVENTS_TABLE}).isNull()).select("topic").distinct()


def framing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids from framed values of every order: four-byte, eight-byte, and values that are not framed."""
    k = F.col("o_orderkey")
    short = F.lpad(F.hex(k + 1), 8, "0")
    wide = F.concat(F.lit("00000000"), F.lpad(F.hex(k), 8, "0"))
    text = F.when(k % 3 == 0, F.concat(F.lit("00"), short)).when(k % 3 == 1, F.concat(F.lit("00"), wide)).otherwise(F.concat(F.lit("01"), short))
    return _table(spark, sf_dir, "orders").select("o_orderkey", framing_id(F.unhex(text)).alias("schema_id"))


def event_timestamp_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", event_timestamp(_ms("ts")).alias("event_timestamp"))


_LOGICAL = {
    "type": "record",
    "name": "L",
    "fields": [
        {"name": n, "type": {"type": "int" if n in ("date", "time-millis") else "long", "logicalType": n}}
        for n in ("timestamp-millis", "timestamp-micros", "local-timestamp-micros", "date", "time-millis", "time-micros")
    ],
}


def _logical_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from weir.functions.avro import compile_schema

    decode = compile_schema(_LOGICAL)
    names = [f["name"] for f in _LOGICAL["fields"]]
    for batch in batches:
        found = []
        for us in batch.column(1).to_pylist():
            day, of_day = divmod(us, 86_400_000_000)
            values = (us // 1000, us, us, day, of_day // 1000, of_day)
            found.append(decode(encode(_LOGICAL, dict(zip(names, values, strict=True)))))
        columns = [pa.array([f[n] for f in found], pa.string()) for n in names]
        yield pa.record_batch([batch.column(0), *columns], ["event_id", *(n.replace("-", "_") for n in names)])


def avro_logical_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's time, encoded as Avro logical types and rendered by the decoder; dates before 1970 included."""
    us = F.unix_micros(F.col("ts").cast("timestamp")) - F.when(F.col("event_id") % 2 == 1, 2_000_000_000_000_000).otherwise(0)
    fields = ", ".join(f"{f['name'].replace('-', '_')} string" for f in _LOGICAL["fields"])
    return _table(spark, sf_dir, "events").select("event_id", us.alias("us")).mapInArrow(_logical_batches, f"event_id long, {fields}")


def _keyed(events: DataFrame, key, table: str) -> tuple[DataFrame, RowPath]:
    messages = events.select(
        F.lit("events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), _ms("ts").alias("timestamp"),
        key.cast("binary").alias("key"), F.lit("1").cast("binary").alias("value"), F.lit(None).cast("array<struct<key: string, value: binary>>").alias("headers"),
    )
    spec = TableSpec(EVENTS_TABLE, _columns(f"{table}, {_KAFKA}"))
    return messages, RowPath(Transform("json_events", CLUSTER), {"events": EVENTS_TABLE}, {EVENTS_TABLE: spec})


def _outcome_of(messages: DataFrame, path: RowPath, place: int, kind: str) -> DataFrame:
    found = encode_rows(messages, path, FROZEN)
    return found.select("offset", "outcome", "stage", F.col("cells")[place].cast(kind).alias("value"))


def json_name_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by column name, by JSON name, and by a name that is none; payload has no column, so nulls only pass."""
    n = F.col("event_id")
    name = F.when(n % 3 == 0, "user_id").when(n % 3 == 1, "userId").otherwise("other")
    key = F.concat(F.lit('{"'), name, F.lit('": '), F.col("user_id").cast("string"), F.lit("}"))
    messages, path = _keyed(_table(spark, sf_dir, "events"), key, "user_id INTEGER!, payload JSON")
    return _outcome_of(messages.withColumn("value", F.lit("null").cast("binary")), path, 0, "long")


def numeric_string_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers given as numbers, digits, exponents, fractions and words, in a table where text is read."""
    n = F.col("event_id")
    u = F.col("user_id").cast("string")
    given = (
        F.when(n % 5 == 0, u).when(n % 5 == 1, F.concat(F.lit('"'), u, F.lit('"'))).when(n % 5 == 2, F.concat(F.lit('"'), u, F.lit('e3"')))
        .when(n % 5 == 3, F.concat(F.lit('"'), u, F.lit('.5"'))).otherwise(F.concat(F.lit('"x'), u, F.lit('"')))
    )
    key = F.concat(F.lit('{"user_id": '), given, F.lit("}"))
    messages, path = _keyed(_table(spark, sf_dir, "events"), key, "user_id INTEGER!, payload JSON, __operation STRING")
    return _outcome_of(messages.withColumn("value", F.lit("{}").cast("binary")), path, 0, "long")


def required_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns that are there, null, or absent."""
    n = F.col("event_id")
    key = F.when(n % 4 == 0, '{"user_id": null}').when(n % 4 == 1, "{}").otherwise(F.concat(F.lit('{"user_id": '), F.col("user_id").cast("string"), F.lit("}")))
    messages, path = _keyed(_table(spark, sf_dir, "events"), key, "user_id INTEGER!, payload JSON, __operation STRING")
    found = _outcome_of(messages.withColumn("value", F.lit("{}").cast("binary")), path, 0, "long")
    return found.groupBy("outcome", "stage").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def _decimal_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for cents in batch.column(1).to_pylist():
            raw = cents.to_bytes(16, "big", signed=True)
            found.append((float(decimal_value(raw, 20, 2)), float(decimal_value(raw, 3, 2))))
        yield pa.record_batch([batch.column(0), pa.array([f[0] for f in found]), pa.array([f[1] for f in found])], ["o_orderkey", "exact", "rounded"])


def decimal_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals as two's complement decimals, read with all digits and rounded half-even to three."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return _table(spark, sf_dir, "orders").select("o_orderkey", cents.alias("cents")).mapInArrow(_decimal_batches, "o_orderkey long, exact double, rounded double")


def _canonical_batches(batches: Iterator[pa.RecordBatch], lossy: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[str | None] = []
        for raw in batch.column(1).to_pylist():
            try:
                found.append(dump(parse_lossy(raw) if lossy else parse(raw.decode())))
            except JsonError:
                found.append(None)
        yield pa.record_batch([batch.column(0), pa.array(found, pa.string())], ["event_id", "canonical"])


def json_canonical_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loosely written text of each event in canonical form: spaces, escapes, exponents, repeated members."""
    n = F.col("event_id").cast("string")
    text = F.concat(
        F.lit('{ "b" : [ '), n, F.lit(' , 1e20, 1.50 , 15e-8, true ,null], "a":"\\u00e9\\/\\t", "n": {"x": '), F.col("value").cast("string"), F.lit(', "x": "'), F.col("event_type"), F.lit('"} }')
    )
    rows = _table(spark, sf_dir, "events").select("event_id", text.cast("binary").alias("text"))
    return rows.mapInArrow(lambda b: _canonical_batches(b, False), "event_id long, canonical string")


def surrogate_control_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with half a surrogate pair, control characters, or both: one class is repaired, never two."""
    n = F.col("event_id") % 4
    bad = F.when(n == 0, F.lit("\\ud83d")).when(n == 1, F.lit("\x01")).when(n == 2, F.lit("\x02\\udc00")).otherwise(F.lit("\\ud83d\\ude00"))
    text = F.concat(F.lit('{"k": "'), F.col("event_id").cast("string"), bad, F.lit('"}'))
    rows = _table(spark, sf_dir, "events").select("event_id", text.cast("binary").alias("text"))
    return rows.mapInArrow(lambda b: _canonical_batches(b, True), "event_id long, canonical string")


def partition_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weir.operators.tables import partition_value

    path = row_path("json_events")
    rows = typed_rows(encode_rows(event_messages(_table(spark, sf_dir, "events")), path, FROZEN), path.tables[EVENTS_TABLE])
    return rows.groupBy(partition_value(path.tables[EVENTS_TABLE]).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def capture_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capture's cap: the first 50 messages of each topic, by partition and offset."""
    found = first_messages(event_messages(_table(spark, sf_dir, "events")), 50)
    return found.select("topic", "partition", "offset", "timestamp")


def commit_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as acknowledgements: offsets of ids that 97 divides, above 1000, are still open."""
    e = _table(spark, sf_dir, "events")
    open_ = (F.col("event_id") % 97 == 0) & (F.col("event_id") > 1000)
    acks = e.select(F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"), (~open_).alias("done"))
    return delivery.commit_prefix(acks)


def consumer_lag_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag by event type: each user a partition, lag its number of events; users that 7 divides are not owned."""
    e = _table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("topic"), F.col("user_id").alias("partition"))
    partitions = e.agg(F.count(F.lit(1)).alias("consumer_lag")).withColumn("desired", F.col("partition") % 7 != 0)
    return delivery.consumer_lag(partitions)


def ack_latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.latency_summary(_table(spark, sf_dir, "events").select((F.col("value") * 100).cast("long").alias("ms")))


def distinct_rows_ignoring_inserted_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events twice, with another time of insertion: rows, and rows that differ otherwise."""
    e = _table(spark, sf_dir, "events").select("user_id", "event_type", F.lit("a").alias("inserted_at"))
    return delivery.distinct_rows(e.union(e.withColumn("inserted_at", F.lit("b"))), "inserted_at")


def parity_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two results by key: the second lacks some orders, has others changed."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    other = o.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 13 == 0, "X").otherwise(F.col("o_orderstatus")))
    return delivery.compare(o, other, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


def stream_replay_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table replayed as a stream, in the row path, to Parquet; what arrived is read back."""
    from weir.sources.shared import scratch

    events = _table(spark, sf_dir, "events")
    root = scratch(spark, "replay")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]")  # a stream's path is a folder or a glob
    path = row_path("json_events")
    outcomes = encode_rows(event_messages(stream), path, FROZEN)
    query = outcomes.writeStream.format("parquet").option("path", f"{root}/rows").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    found = typed_rows(spark.read.schema(OUTCOMES).parquet(f"{root}/rows"), path.tables[EVENTS_TABLE])
    return found.select("user_id", "payload", "__kafka_offset")


_ALL = (
    skip_outcomes, outcome_by_stage, topic_routing_counts, unrouted_topics, framing_ids, event_timestamp_format, avro_logical_types,
    json_name_resolution, numeric_string_keys, required_violations, decimal_rounding, json_canonical_text, surrogate_control_sanitize,
    partition_day_counts, capture_first_n, commit_prefix, consumer_lag_by_topic, ack_latency_percentiles, distinct_rows_ignoring_inserted_at, parity_verdicts,
    stream_replay_equals_batch,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = ROW_QUERIES | {f.__name__: f for f in _ALL}
ORACLE_SQL = ORACLE
