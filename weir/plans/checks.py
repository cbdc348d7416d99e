"""Further registered queries, each through the operators that a running pipeline uses, with their DuckDB SQL.

Every query's SQL is beside it. Those that write tables or files do so below the shared folder.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions.avro import compile_schema
from weir.functions.avro_write import encode, framed
from weir.operators import tables
from weir.operators.delivery import OffsetTracker
from weir.operators.rows import LARGE, RowPath, encode_rows, typed_rows
from weir.plans import catalog
from weir.plans.catalog import CLUSTER, EVENTS_TABLE, FROZEN, _columns, _KAFKA, _keyed, _outcome_of, _table, event_messages, order_avro, row_path
from weir.plans.config import resolve_env
from weir.plans.oracle import _GOOD, _PAYLOAD
from weir.plans.tables import ColumnSpec, TableError, TableSpec, json_name
from weir.plans.transforms import Transform
from weir.sources.capture import first_messages, parse_since, stream_capture, write_capture
from weir.sources.shared import scratch
from weir.streaming.engine import RunOptions, Writer, forget, start
from weir.streaming.remote import FaultyService, Retry, deliver
from weir.streaming.service import HttpService, serve_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
_NO_HEADERS = "array<struct<key: string, value: binary>>"


def registered(sql: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__], ORACLE[query.__name__] = query, sql
        return query

    return add


def _database(spark: SparkSession) -> str:
    """A database of its own, with its files below the shared folder."""
    name = f"weir_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch(spark, 'database')}'")
    return name


# documents as rows, large ones among them


def _varint_size(n: str) -> str:
    return f"CASE WHEN {n} < 128 THEN 1 WHEN {n} < 16384 THEN 2 WHEN {n} < 2097152 THEN 3 WHEN {n} < 268435456 THEN 4 ELSE 5 END"


LARGE_BYTES = 4000


@registered(f"""
WITH b AS (
  SELECT doc_id, text, length(doc_id::VARCHAR) AS digits, CASE WHEN text IS NULL THEN 2 ELSE 6 + strlen(to_json(text)::VARCHAR) END AS payload FROM documents
), s AS (
  SELECT *, payload + 1 + {_varint_size("payload")} + 6 + 2 + 1 + {_varint_size("doc_id")} + 6 + 4 + 28 + 28 AS wire FROM b
)
SELECT doc_id, CASE WHEN wire > {LARGE_BYTES} THEN 'large' ELSE 'row' END AS outcome,
  (CASE WHEN wire > {LARGE_BYTES} THEN payload + digits + 202 ELSE wire END)::BIGINT AS n_bytes, md5(text) AS text_md5 FROM s""")
def large_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as messages, whose rows go the large way above a limit of bytes; the text is read back from the row."""
    docs = _table(spark, sf_dir, "documents")
    messages = docs.select(
        F.lit("docs").alias("topic"), F.lit(0).alias("partition"), F.col("doc_id").alias("offset"), F.lit(0).cast("long").alias("timestamp"),
        F.lit(None).cast("binary").alias("key"), F.to_json(F.struct(F.col("text").alias("t"))).cast("binary").alias("value"), F.lit(None).cast(_NO_HEADERS).alias("headers"),
    )
    table = TableSpec("p.d.docs", _columns("payload JSON, __operation STRING, " + _KAFKA))
    found = encode_rows(messages, RowPath(Transform("json_events", CLUSTER), {"docs": "p.d.docs"}, {"p.d.docs": table}, max_row_bytes=LARGE_BYTES), FROZEN)
    size = F.coalesce(F.octet_length("row_bytes"), F.octet_length("large_json"))
    text = F.when(F.col("outcome") == LARGE, F.get_json_object("large_json", "$.payload.t")).otherwise(F.get_json_object(F.col("cells")[0], "$.t"))
    return found.select(F.col("offset").alias("doc_id"), "outcome", size.cast("long").alias("n_bytes"), F.md5(text.cast("binary")).alias("text_md5"))


def _varint_sql(n: str) -> str:
    """The bytes of a non-negative number below 2**28, as a blob."""
    octet = lambda e: f"lpad(to_hex(({e})::BIGINT), 2, '0')"
    parts = [octet(n), *(" || ".join([*(octet(f"(({n}) >> {7 * i}) % 128 + 128") for i in range(k)), octet(f"({n}) >> {7 * k}")]) for k in (1, 2, 3))]
    return f"unhex(CASE WHEN {n} < 128 THEN {parts[0]} WHEN {n} < 16384 THEN {parts[1]} WHEN {n} < 2097152 THEN {parts[2]} ELSE {parts[3]} END)"


def _text_sql(tag: str, text: str) -> str:
    return f"unhex('{tag}') || {_varint_sql(f'strlen({text})')} || encode({text})"


_EVENT_TS = "strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%f')"
_WIRE = " || ".join(
    [f"unhex('08') || {_varint_sql('user_id')}", _text_sql("12", f"({_PAYLOAD})"), _text_sql("22", "'main'"), f"unhex('28') || {_varint_sql('user_id % 4')}",
     f"unhex('30') || {_varint_sql('event_id')}", _text_sql("3a", "'events'"), _text_sql("42", "'{}'"), _text_sql("4a", _EVENT_TS), _text_sql("52", f"'{FROZEN}'")]
)


@registered(f"SELECT event_id AS offset_, md5({_WIRE}) AS row_md5 FROM events WHERE {_GOOD}")
def wire_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proto2 bytes of every event's row, by their digest."""
    found = encode_rows(event_messages(_table(spark, sf_dir, "events")), row_path("json_events"), FROZEN)
    return found.where("outcome = 'row'").select(F.col("offset").alias("offset_"), F.md5("row_bytes").alias("row_md5"))


# keys, values and cells


@registered("""
SELECT event_id AS "offset", CASE WHEN event_id % 3 = 0 THEN 'error' WHEN event_id % 3 = 1 THEN 'skipped' ELSE 'row' END AS outcome,
  CASE WHEN event_id % 3 = 1 THEN 'invalid_key' END AS skip_reason, CASE WHEN event_id % 3 = 0 THEN 'source' END AS stage FROM events""")
def non_utf8_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are no UTF-8 are errors whatever is skipped, keys that are no JSON are skipped."""
    n = F.col("event_id")
    key = F.when(n % 3 == 0, F.unhex(F.lit("FF7B7D"))).when(n % 3 == 1, F.lit("{nope").cast("binary")).otherwise(F.lit('{"user_id": 1}').cast("binary"))
    messages, path = _keyed(_table(spark, sf_dir, "events"), key, "user_id INTEGER!, payload JSON, __operation STRING")
    path.skip_invalid_keys = path.skip_decode_errors = True
    return encode_rows(messages.withColumn("value", F.lit("{}").cast("binary")), path, FROZEN).select("offset", "outcome", "skip_reason", "stage")


@registered("""
SELECT event_id AS "offset", t AS transform, CASE WHEN t = 'json_events' THEN 'error' ELSE 'row' END AS outcome,
  CASE WHEN t = 'json_events' THEN 'transform' END AS stage, CASE WHEN t <> 'json_events' THEN user_id END AS value
FROM events, (VALUES ('json_events'), ('json_cdc')) AS x(t)""")
def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are JSON texts of JSON: one transform reads them once more, another cannot."""
    events = _table(spark, sf_dir, "events")
    key = F.concat(F.lit('"{\\"k\\": '), F.col("user_id").cast("string"), F.lit('}"'))
    found = []
    for name in ("json_events", "json_cdc"):
        messages, path = _keyed(events, key, "k INTEGER!, payload JSON, __operation STRING, __before JSON, __ce_type STRING, __ce_id STRING")
        path.transform = Transform(name, CLUSTER)
        messages = messages.withColumn("value", F.lit('{"after": {"a": 1}}').cast("binary"))
        found.append(_outcome_of(messages, path, 0, "long").withColumn("transform", F.lit(name)))
    return found[0].unionByName(found[1])


@registered("""
SELECT event_id AS "offset", CASE WHEN event_id % 6 IN (1, 2, 3) THEN 'error' ELSE 'row' END AS outcome, CASE WHEN event_id % 6 IN (1, 2, 3) THEN 'encode' END AS stage,
  CASE event_id % 6 WHEN 0 THEN event_type WHEN 5 THEN '[' || user_id || ',"x"]' END AS value FROM events""")
def scalar_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that are a text, an integer, a float, a bool, null, or a list, in a column of JSON."""
    n, u = F.col("event_id"), F.col("user_id").cast("string")
    value = (
        F.when(n % 6 == 0, F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))).when(n % 6 == 1, u).when(n % 6 == 2, F.concat(u, F.lit(".5")))
        .when(n % 6 == 3, "true").when(n % 6 == 4, "null").otherwise(F.concat(F.lit("[ "), u, F.lit(', "x" ]')))
    )
    events = _table(spark, sf_dir, "events")
    messages, path = _keyed(events, F.lit("{}"), "payload JSON, __operation STRING")
    messages = messages.drop("value").join(events.select(F.col("event_id").alias("offset"), value.cast("binary").alias("value")), "offset")
    return _outcome_of(messages, path, 0, "string")


def _cell(spark: SparkSession, sf_dir: str, given: Column, kind: str, read: Callable[[Column], Column]) -> DataFrame:
    """Each event's key with a member c of given text, read as a column of a type."""
    key = F.concat(F.lit('{"c": '), given, F.lit("}"))
    messages, path = _keyed(_table(spark, sf_dir, "events"), key, f"c {kind}, payload JSON, __operation STRING")
    found = encode_rows(messages.withColumn("value", F.lit("{}").cast("binary")), path, FROZEN)
    return found.select("offset", "outcome", "stage", read(F.col("cells")[0]).alias("value"))


@registered("""
SELECT event_id AS "offset", CASE WHEN event_id % 6 = 5 THEN 'error' ELSE 'row' END AS outcome, CASE WHEN event_id % 6 = 5 THEN 'encode' END AS stage,
  CASE event_id % 6 WHEN 0 THEN value WHEN 1 THEN user_id WHEN 2 THEN value WHEN 3 THEN user_id * 100.0 WHEN 4 THEN user_id + 0.5 END AS value FROM events""")
def float_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floats given as numbers, integers, digits, exponents, fractions and words."""
    n, u, v = F.col("event_id") % 6, F.col("user_id").cast("string"), F.col("value").cast("string")
    text = lambda c, end="": F.concat(F.lit('"'), c, F.lit(end + '"'))
    given = F.when(n == 0, v).when(n == 1, u).when(n == 2, text(v)).when(n == 3, text(u, "e2")).when(n == 4, text(u, ".5")).otherwise(text(u, "x"))
    return _cell(spark, sf_dir, given, "FLOAT", lambda c: c.cast("double"))


@registered("""
SELECT event_id AS "offset", CASE WHEN event_id % 4 = 3 THEN 'error' ELSE 'row' END AS outcome, CASE WHEN event_id % 4 = 3 THEN 'encode' END AS stage,
  CASE WHEN event_id % 4 < 3 THEN hex(encode(event_type || event_id)) END AS value FROM events""")
def base64_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes given in either alphabet of base64, with padding and without; one in four is no base64."""
    n, raw = F.col("event_id") % 4, F.base64(F.concat("event_type", F.col("event_id").cast("string")).cast("binary"))
    safe = F.translate(raw, "+/", "-_")
    given = F.when(n == 0, raw).when(n == 1, safe).when(n == 2, F.rtrim(raw, F.lit("="))).otherwise(F.lit("!"))
    return _cell(spark, sf_dir, F.concat(F.lit('"'), given, F.lit('"')), "BYTES", lambda c: F.hex(F.unbase64(c)))


@registered("""
SELECT event_id AS "offset", CASE WHEN event_id % 4 = 3 THEN 'error' ELSE 'row' END AS outcome, CASE WHEN event_id % 4 = 3 THEN 'encode' END AS stage,
  CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false END AS value FROM events""")
def bool_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bools, null, and a word that is none."""
    n = F.col("event_id") % 4
    given = F.when(n == 0, "true").when(n == 1, "false").when(n == 2, "null").otherwise('"yes"')
    return _cell(spark, sf_dir, given, "BOOLEAN", lambda c: c.cast("boolean"))


# Avro

_NESTED = {
    "type": "record", "name": "N", "fields": [
        {"name": "ids", "type": {"type": "array", "items": "long"}},
        {"name": "named", "type": {"type": "map", "values": "string"}},
        {"name": "kind", "type": {"type": "enum", "name": "K", "symbols": ["even", "odd"]}},
        {"name": "code", "type": {"type": "fixed", "name": "F", "size": 2}},
        {"name": "maybe", "type": ["null", {"type": "array", "items": {"type": "map", "values": "boolean"}}]},
    ],
}


def _nested_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = []
        for n, u, kind in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            row = {"ids": [n, -u] * (n % 3), "named": {"type": kind, "user": str(u)}, "kind": "odd" if n % 2 else "even", "code": b"ab", "maybe": None if n % 2 else [{"x": n % 4 == 0}, {}]}
            values.append(framed(7, encode(_NESTED, row)))
        yield pa.record_batch([batch.column(0), pa.array(values, pa.binary())], ["offset", "value"])


@registered("""
SELECT event_id AS "offset", '{"ids":[' || CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN event_id || ',' || -user_id ELSE event_id || ',' || -user_id || ',' || event_id || ',' || -user_id END
  || '],"named":{"type":"' || event_type || '","user":"' || user_id || '"},"kind":"' || CASE WHEN event_id % 2 = 1 THEN 'odd' ELSE 'even' END || '","code":"ab","maybe":'
  || CASE WHEN event_id % 2 = 1 THEN 'null' ELSE '[{"x":' || CASE WHEN event_id % 4 = 0 THEN 'true' ELSE 'false' END || '},{}]' END || '}' AS payload FROM events""")
def avro_nested_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays and maps in blocks, enums, fixed and unions of each event, decoded by the row path."""
    rows = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type").mapInArrow(_nested_batches, "offset long, value binary")
    messages = rows.select(
        F.lit("events").alias("topic"), F.lit(0).alias("partition"), "offset", F.lit(0).cast("long").alias("timestamp"), F.lit(None).cast("binary").alias("key"), "value",
        F.lit(None).cast(_NO_HEADERS).alias("headers"),
    )
    table = TableSpec(EVENTS_TABLE, _columns("payload JSON, __operation STRING, " + _KAFKA))
    path = RowPath(Transform("avro_events", CLUSTER), {"events": EVENTS_TABLE}, {EVENTS_TABLE: table}, "avro", schemas={7: _NESTED}, wire=False)
    return typed_rows(encode_rows(messages, path, FROZEN), table).select(F.col("__kafka_offset").alias("offset"), "payload")


_BYTES = {"type": "record", "name": "B", "fields": [{"name": "raw", "type": "bytes"}, {"name": "id", "type": {"type": "string", "logicalType": "uuid"}}]}


def _bytes_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from weir.functions.avro import AvroError

    decode = compile_schema(_BYTES)
    for batch in batches:
        raws, ids = [], []
        for raw, given in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            try:
                found = decode(encode(_BYTES, {"raw": raw, "id": given}))
            except AvroError:
                found = {"raw": None, "id": None}
            raws.append(found["raw"])
            ids.append(found["id"])
        yield pa.record_batch([batch.column(0), pa.array(raws, pa.string()), pa.array(ids, pa.string())], ["event_id", "raw", "uuid"])


@registered("""
SELECT event_id, CASE WHEN event_id % 7 > 0 THEN props END AS raw, CASE WHEN event_id % 7 > 0 THEN CASE WHEN event_id % 5 = 0 THEN 'x' || d
  ELSE d[1:8] || '-' || d[9:12] || '-' || d[13:16] || '-' || d[17:20] || '-' || d[21:32] END END AS uuid FROM (SELECT *, md5(event_id::VARCHAR) AS d FROM events)""")
def uuid_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UUIDs given with and without hyphens and in capitals, one in five none, decoded beside bytes; where those are no UTF-8 the record fails."""
    digits = F.md5(F.col("event_id").cast("string"))
    hyphened = F.regexp_replace(F.upper(digits), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    given = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("x"), digits)).when(F.col("event_id") % 2 == 0, hyphened).otherwise(F.upper(digits))
    raw = F.when(F.col("event_id") % 7 == 0, F.unhex(F.lit("C328"))).otherwise(F.col("props").cast("binary"))
    return _table(spark, sf_dir, "events").select("event_id", raw.alias("raw"), given.alias("given")).mapInArrow(_bytes_batches, "event_id long, raw string, uuid string")


@registered("""
SELECT o_orderkey AS "offset", CASE WHEN o_orderkey % 3 = 0 THEN 'skipped' WHEN o_orderkey % 3 = 1 THEN 'error' ELSE 'row' END AS outcome,
  CASE WHEN o_orderkey % 3 = 0 THEN 'decode_error' END AS skip_reason, CASE WHEN o_orderkey % 3 = 1 THEN 'source' END AS stage FROM orders""")
def missing_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of an id that no registry has are skipped as they cannot be decoded; bodies that end too early are errors."""
    k = F.col("offset") % 3
    unknown = F.concat(F.unhex(F.lit("0000000001")), F.expr("substring(value, 6)"))
    value = F.when(k == 0, unknown).when(k == 1, F.expr("substring(value, 1, 9)")).otherwise(F.col("value"))
    path = row_path("debezium_unwrap", encoding="avro", schemas={catalog.CDC_ID: catalog.CDC_SCHEMA}, skip_decode_errors=True)
    found = encode_rows(order_avro(_table(spark, sf_dir, "orders")).withColumn("value", value), path, FROZEN)
    return found.select("offset", "outcome", "skip_reason", "stage")


@registered("""
SELECT event_id AS "offset", '{"a":"' || (event_id + 3) || '","b":"' || (event_id + 2) || '","c":"' || event_type || '"}' AS headers FROM events""")
def header_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's message with a header given three times, another twice and one once: the row path keeps the last, at the first's place."""
    header = lambda name, value: F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value"))
    n = F.col("offset")
    types = _table(spark, sf_dir, "events").select(F.col("event_id").alias("offset"), "event_type")
    messages, _ = _keyed(_table(spark, sf_dir, "events"), F.lit("{}"), "payload JSON")
    headers = F.array(header("a", n), header("b", n), header("a", n + 1), header("c", F.col("event_type")), header("b", n + 2), header("a", n + 3))
    messages = messages.join(types, "offset").withColumn("headers", headers).withColumn("value", F.lit("{}").cast("binary"))
    table = TableSpec(EVENTS_TABLE, _columns(f"payload JSON, headers JSON, {catalog._CE}, {_KAFKA}"))
    path = RowPath(Transform("cloudevents_enriched", CLUSTER), {"events": EVENTS_TABLE}, {EVENTS_TABLE: table}, wire=False)
    return typed_rows(encode_rows(messages, path, FROZEN), table).select(F.col("__kafka_offset").alias("offset"), "headers")


@registered(f"""SELECT event_id AS "offset", true AS is_time FROM events WHERE {_GOOD}""")
def inserted_at_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time of insertion, where none is given, is one of a clock, in UTC."""
    path = row_path("json_events", wire=False)
    rows = typed_rows(encode_rows(event_messages(_table(spark, sf_dir, "events")), path), path.tables[EVENTS_TABLE])
    at = F.col("__inserted_at")
    recent = F.abs(F.unix_timestamp(F.to_timestamp(F.substring(at, 1, 19), "yyyy-MM-dd'T'HH:mm:ss")) - F.unix_timestamp(F.current_timestamp())) < 3600
    return rows.select(F.col("__kafka_offset").alias("offset"), (at.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{6})?$") & recent).alias("is_time"))


# captures, tables and the running pipeline


@registered("""
SELECT topic, partition, "offset", md5(value) AS value_md5, CASE WHEN n % 31 > 0 THEN event_type END AS ce_type FROM (
  SELECT event_id AS n, event_type, 'events' AS topic, (user_id % 4)::INTEGER AS partition, event_id AS "offset", '{"event_id": ' || event_id || ', "event_type": "' || event_type
    || '", "value": ' || value::VARCHAR || ', "props": ' || props || '}' AS value, row_number() OVER (ORDER BY user_id % 4, event_id) AS place
  FROM events WHERE event_id % 29 <> 0 AND event_id % 17 <> 0 AND event_id % 23 <> 0 AND epoch_us(ts) // 1000 >= 1704200000000) WHERE place <= 500""")
def capture_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capture of one topic from a time on, capped, written and replayed as a stream: keys, values and headers return."""
    messages = event_messages(_table(spark, sf_dir, "events")).where("value is not null and offset % 23 <> 0")
    folder, out = scratch(spark, "capture"), scratch(spark, "replayed")
    write_capture(first_messages(messages, 500, ["events"], 1_704_200_000_000), folder)
    query = stream_capture(spark, folder).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()
    ce_type = F.filter("headers", lambda h: h["key"] == "ce_type")
    kind = F.when(F.size(F.coalesce(ce_type, F.array())) > 0, ce_type[0]["value"].cast("string"))
    return spark.read.parquet(out).select("topic", "partition", "offset", F.md5("value").alias("value_md5"), kind.alias("ce_type"))


def _ran(spark: SparkSession, sf_dir: str, dry_first: bool = False) -> tuple[DataFrame, DataFrame, Writer]:
    """Events captured and run through the engine to a table of their own: its rows, the quarantined messages, and the writer."""
    database, folder = _database(spark), scratch(spark, "capture")
    write_capture(event_messages(_table(spark, sf_dir, "events")), folder)
    name = f"p.{database}.rows"
    table = TableSpec(name, catalog.TABLES["json_events"], ("user_id",), "DAY", "__event_timestamp")
    checkpoint = scratch(spark, "run")
    for dry in (True, False) if dry_first else (False,):
        path = RowPath(Transform("json_events", CLUSTER), {"events": name}, {name: table})
        options = RunOptions(checkpoint, once=True, quarantine=f"{checkpoint}-bad", inserted_at=FROZEN, dry_run=dry)
        writer = Writer(path, options)
        start(stream_capture(spark, folder), writer).awaitTermination()
        forget(spark, options)
    spark.catalog.refreshTable(f"{database}.rows")
    return spark.table(f"{database}.rows"), spark.read.parquet(f"{checkpoint}-bad"), writer


@registered(f"""
SELECT user_id, ({_PAYLOAD}) AS payload, event_id AS __kafka_offset, strftime(ts, '%Y-%m-%d') AS _partition FROM events WHERE {_GOOD}""")
def engine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run: capture, stream, row path, table created, one append a batch, partitions by day."""
    return _ran(spark, sf_dir)[0].select("user_id", "payload", "__kafka_offset", "_partition")


@registered("""
SELECT event_id AS "offset", CASE WHEN event_id % 29 = 0 THEN 'unrouted' ELSE 'events' END AS topic, 'source' AS stage FROM events
WHERE event_id % 17 <> 0 AND (event_id % 19 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0)""")
def engine_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that a run with a quarantine put aside instead of stopping."""
    return _ran(spark, sf_dir)[1].select("offset", "topic", "stage")


@registered(f"""
SELECT 'messages' AS name, count(*)::BIGINT AS n FROM events UNION ALL SELECT 'rows', count(*)::BIGINT FROM events WHERE {_GOOD}
UNION ALL SELECT 'table rows', count(*)::BIGINT FROM events WHERE {_GOOD} UNION ALL SELECT 'skipped_empty_value', count(*)::BIGINT FROM events WHERE event_id % 17 = 0
UNION ALL SELECT 'errors', count(*)::BIGINT FROM events WHERE event_id % 17 <> 0 AND (event_id % 19 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0)""")
def engine_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run counted."""
    metrics = _ran(spark, sf_dir)[2].metrics
    found = {n: metrics.totals[n] for n in ("messages", "rows", "skipped_empty_value", "errors")}
    found["table rows"] = sum(c["rows"] for c in metrics.by_table.values())
    return spark.createDataFrame(sorted(found.items()), "name string, n long")


@registered(f"""SELECT event_id AS __kafka_offset, 2::BIGINT AS n FROM events WHERE {_GOOD}""")
def dry_run_then_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run writes every row and keeps no offsets: the run after it writes every row again."""
    return _ran(spark, sf_dir, True)[0].groupBy("__kafka_offset").agg(F.count(F.lit(1)).alias("n"))


_NARROW = (ColumnSpec("o_orderkey", "INTEGER", True), ColumnSpec("o_orderstatus", "STRING"))
_WIDE = (*_NARROW, ColumnSpec("o_orderpriority", "STRING", description="added"))


@registered("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority FROM orders")
def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders appended to a table before and after a column was added to it: the old ones have null there."""
    orders, database = _table(spark, sf_dir, "orders"), _database(spark)
    for remainder, columns in ((0, _NARROW), (1, _WIDE)):
        table = TableSpec(f"p.{database}.orders", columns)
        tables.ensure_table(spark, table)
        tables.append(orders.where(F.col("o_orderkey") % 2 == remainder).select(*(c.name for c in columns)), table)
    return spark.table(f"{database}.orders")


@registered("""
SELECT * FROM (VALUES (1::BIGINT, 'created', ''), (2, 'unchanged', ''), (3, 'added', 'o_orderpriority'), (4, 'unchanged', ''), (5, 'unchanged', '')) AS t(step, result, added)""")
def table_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table ensured again and again: created, left alone, widened, and never narrowed."""
    database, found = _database(spark), []
    for step, columns in enumerate((_NARROW, _NARROW, _WIDE, _WIDE, _NARROW), 1):
        ensured = tables.ensure_table(spark, TableSpec(f"p.{database}.orders", columns))
        found.append((step, ensured.result, ",".join(ensured.columns)))
    return spark.createDataFrame(found, "step long, result string, added string")


@registered(f"""
SELECT 'taken' AS what, count(*)::BIGINT AS n FROM events WHERE {_GOOD} UNION ALL SELECT 'loaded', 0 UNION ALL SELECT 'violations', 0 UNION ALL SELECT 'retried', 1""")
def delivered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire rows of all events to a service over HTTP that fails every seventh request: each is there, by content."""
    service = FaultyService(every_n=7, close_after=5)
    server = serve_rows(service)
    try:
        url = f"http://{spark.sparkContext.getConf().get('spark.driver.host', '127.0.0.1')}:{server.server_address[1]}"
        path = row_path("json_events")
        outcomes = encode_rows(event_messages(_table(spark, sf_dir, "events")), path, FROZEN)
        sent = deliver(outcomes, path, functools.partial(HttpService, url), 50, functools.partial(Retry, first_wait=0.01, longest_wait=0.1))
        retries = sum(r["retries"] for r in sent.collect())
    finally:
        server.shutdown()
    found = [("taken", service.distinct(EVENTS_TABLE)), ("loaded", len(service.loaded)), ("violations", len(service.violations)), ("retried", int(retries > 0))]
    return spark.createDataFrame(found, "what string, n long")


def _refused(call: Callable[[], object]) -> str:
    try:
        return str(call())
    except (TableError, ValueError):
        return "refused"


def _tracked() -> str:
    """Offsets to commit while offsets are done out of order, and after a partition was given anew."""
    tracker = OffsetTracker()
    tracker.assign("t", 0)
    tickets = {o: tracker.track("t", 0, o, float(o)) for o in (5, 6, 9)}
    found = [tracker.committable()]
    for o in (6, 5):
        tracker.done(tickets[o])
        found.append(tracker.committable())
    age = tracker.oldest_age(19.0)
    tracker.assign("t", 0)
    tracker.done(tickets[9])
    return "; ".join([*(",".join(f"{t}/{p}@{o}" for t, p, o in f) for f in found), f"{age:g}", ",".join(map(str, tracker.committable()))])


@registered("""
SELECT * FROM (VALUES
  ('since', '90m', '994600000'), ('since', '2h', '992800000'), ('since', '1d', '913600000'), ('since', '123', '123'), ('since', 'soon', 'refused'),
  ('table', 'p.d.t', '(''p'', ''d'', ''t'')'), ('table', 'd.t', 'refused'), ('table', 'p..t', 'refused'),
  ('json name', '__event_timestamp', 'EventTimestamp'), ('json name', 'user_id', 'userId'), ('json name', 'a__b_1', 'aB1'),
  ('partition', 'DAY TIMESTAMP', 'None'), ('partition', 'HOUR DATE', 'refused'), ('partition', 'WEEK TIMESTAMP', 'refused'), ('partition', 'DAY STRING', 'refused'),
  ('environment', '12', '12 int'), ('environment', 'true', 'True bool'), ('environment', 'a: b', 'a: b str'), ('environment', '1.5', '1.5 float'),
  ('tracker', '', '; ; t/0@9; 10; ')) AS t(rule, given, found)""")
def scalar_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules about single values: times to begin at, table names, JSON names, partitioning, the environment, commits."""
    found = [("since", t, _refused(lambda t=t: parse_since(t, 1_000_000_000))) for t in ("90m", "2h", "1d", "123", "soon")]
    found += [("table", t, _refused(lambda t=t: tables.table_name(t))) for t in ("p.d.t", "d.t", "p..t")]
    found += [("json name", t, json_name(t)) for t in ("__event_timestamp", "user_id", "a__b_1")]
    for t in ("DAY TIMESTAMP", "HOUR DATE", "WEEK TIMESTAMP", "DAY STRING"):
        by, kind = t.split()
        table = TableSpec("p.d.t", (ColumnSpec("at", kind),), (), by, "at")
        found.append(("partition", t, _refused(lambda table=table: tables.check_partitioning(table))))
    for t in ("12", "true", "a: b", "1.5"):
        value = resolve_env({"k": "env://X"}, {"X": t})["k"]
        found.append(("environment", t, f"{value} {type(value).__name__}"))
    return spark.createDataFrame([*found, ("tracker", "", _tracked())], "rule string, given string, found string")
