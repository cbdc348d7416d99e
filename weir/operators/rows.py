"""Messages to rows: the operators of the row path, DataFrame to DataFrame, for batches and streams alike.

with_routes     native: destination by topic, the empty-value rule, framing id
schema_ids      native: the distinct framing ids, for the registry
encode_rows     one Arrow pass: parse, transform, coerce, encode; an outcome for every message
typed_rows      native: one destination's rows as typed columns
failures        native: what stopped, by stage

An outcome is row, large (a row above the streaming limit, as NDJSON), skipped (with a reason) or error (with the
stage that failed: source, transform or encode). A message's checks have a fixed order: empty value, key, value,
headers, topic. Nothing is shuffled and nothing is collected but schema ids.

Within a batch, what is equal for all rows or a column of the input is made for all rows at once; a row's own values are
read one row after the other, directly if they fit their columns as they are, and else by the rules in full.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions import avro
from weir.functions.avro import AvroError, parse_framing
from weir.functions.canonical import JsonError, dump, parse, parse_lossy
from weir.functions.coercion import EncodeError, cell_texts, coerce, could_exceed, proto_bytes
from weir.functions.columns import framing_id, is_empty, routed
from weir.operators.spread import spread
from weir.plans.config import Config
from weir.plans.tables import BOOL, INT64, STRING, TableSpec
from weir.plans.transforms import Message, Transform, TransformError, keys_of

MAX_STREAM_ROW_BYTES = 8 << 20
KEPT_KEYS = 20_000

ROW, LARGE, SKIPPED, ERROR = "row", "large", "skipped", "error"
EMPTY_VALUE, INVALID_KEY, DECODE_ERROR = "empty_value", "invalid_key", "decode_error"

MESSAGES = (
    "topic string, partition int, offset long, timestamp long, key binary, value binary, "
    "headers array<struct<key: string, value: binary>>"
)
MESSAGE_COLUMNS = ("topic", "partition", "offset", "timestamp", "key", "value", "headers")
OUTCOMES = (
    "topic string, partition int, offset long, destination_id string, outcome string, skip_reason string, stage string, "
    "error string, row_bytes binary, large_json string, cells array<string>"
)


class Skip(Exception):
    """A message left out on purpose."""


class SourceError(ValueError):
    """A message that cannot be decoded."""


@dataclass
class RowPath:
    """Everything an executor needs to turn a message into an outcome."""

    transform: Transform
    topics: Mapping[str, str]
    tables: Mapping[str, TableSpec]
    encoding: str = "utf-8"
    skip_empty_value: bool = True
    skip_invalid_keys: bool = False
    skip_decode_errors: bool = False
    schemas: Mapping[int, Any] = field(default_factory=dict)
    max_row_bytes: int = MAX_STREAM_ROW_BYTES
    #: Whether rows get their wire bytes; typed columns do without.
    wire: bool = True

    def __post_init__(self):
        self._decoders: dict[int, Any] = {}
        self._keys: dict[str, Any] = {}
        self._texts: dict[tuple[int, str], str] = {}
        self._direct: dict[str | None, Direct | None] = {None: None}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    @classmethod
    def of(cls, config: Config, schemas: Mapping[int, Any] | None = None) -> RowPath:
        s = config.source
        flags = s.skip_empty_value, s.skip_invalid_keys, s.skip_decode_errors
        return cls(config.transform, s.topics, config.destination.tables, s.encoding, *flags, dict(schemas or {}))

    def direct(self, destination: str | None) -> Direct | None:
        """How rows of a destination are made by columns; None if they are not."""
        if destination not in self._direct:
            table = self.tables.get(destination)
            self._direct[destination] = Direct(self, table) if table is not None and not self.wire and Direct.fits(table) else None
        return self._direct[destination]

    def outcome(self, raw: dict[str, Any], inserted_at: str) -> dict[str, Any]:
        """The outcome of one message, as the columns of OUTCOMES beyond its coordinates. Headers are pairs, or None."""
        stage = "source"
        try:
            message, schema_id = self._parse(raw)
            message.value = self._decoded(schema_id, message.value)
            stage = "transform"
            message.schema = self._schema_text(schema_id, message.topic)
            row = self.transform.row(message, inserted_at)
            stage = "encode"
            return self._encoded(self.topics[message.topic], row)
        except Skip as skip:
            return {"outcome": SKIPPED, "skip_reason": str(skip)}
        except (SourceError, AvroError, TransformError, EncodeError) as error:
            return {"outcome": ERROR, "stage": stage, "error": str(error)}

    def _parse(self, raw: dict[str, Any]) -> tuple[Message, int | None]:
        value, key = raw["value"] or b"", raw["key"]
        if self.skip_empty_value and not value:
            raise Skip(EMPTY_VALUE)
        keys: Any = {}
        if key:
            try:
                text = key.decode()
            except UnicodeDecodeError:
                raise SourceError("the key is not UTF-8") from None
            try:
                keys = self._key(text)
            except JsonError as error:
                if self.skip_invalid_keys:
                    raise Skip(INVALID_KEY) from None
                raise SourceError(f"key: {error}") from None
        try:
            schema_id, body = self._value(value)
            headers = dict(map(self._header, raw["headers"])) if raw["headers"] else {}
            if raw["topic"] not in self.topics:
                raise SourceError(f"topic {raw['topic']} is not routed")
        except (SourceError, AvroError, JsonError) as error:
            if self.skip_decode_errors:
                raise Skip(DECODE_ERROR) from None
            raise SourceError(str(error)) from None
        ms = -1 if raw["timestamp"] is None else raw["timestamp"]
        return Message(raw["topic"], raw["partition"], raw["offset"], ms, keys, headers, body), schema_id

    def _key(self, text: str) -> Any:
        """The value of a key, which is not changed later: keys repeat, so a bounded number of them is kept."""
        found = self._keys.get(text, self)
        if found is self:
            found = parse(text)
            if len(self._keys) >= KEPT_KEYS:
                self._keys.clear()
            self._keys[text] = found
        return found

    def _value(self, value: bytes) -> tuple[int | None, Any]:
        if self.encoding == "utf-8":
            return None, parse_lossy(value)
        schema_id, at = parse_framing(value)
        if schema_id not in self.schemas:
            raise SourceError(f"schema {schema_id} is missing")
        return schema_id, value[at:]

    @staticmethod
    def _header(header: tuple[str, bytes | None]) -> tuple[str, str]:
        name, value = header
        try:
            return name, value.decode()
        except (AttributeError, UnicodeDecodeError):
            raise SourceError(f"header {name} is null or not UTF-8") from None

    def _decoded(self, schema_id: int | None, body: Any) -> Any:
        """An Avro body's value. That it does not follow its schema is an error whatever the skip rules."""
        if schema_id is None:
            return body
        if schema_id not in self._decoders:
            self._decoders[schema_id] = avro.compile_schema(self.schemas[schema_id])
        return self._decoders[schema_id](body)

    def _schema_text(self, schema_id: int | None, topic: str) -> str:
        at = (-1 if schema_id is None else schema_id, topic)
        if at not in self._texts:
            self._texts[at] = self.transform.schema_text(topic, {} if schema_id is None else self.schemas[schema_id])
        return self._texts[at]

    def _encoded(self, destination: str, row: dict[str, Any]) -> dict[str, Any]:
        table = self.tables.get(destination)
        if table is None:
            raise EncodeError(f"no table {destination}")
        cells = {k: dump(v) if type(v) is dict or type(v) is list else v for k, v in row.items()}
        values = coerce(table, cells)
        wire = proto_bytes(table, values) if self.wire or could_exceed(values, self.max_row_bytes) else None
        if wire is not None and len(wire) > self.max_row_bytes:
            return {"outcome": LARGE, "large_json": large_json(table, row)}
        return {"outcome": ROW, "row_bytes": wire if self.wire else None, "cells": cell_texts(table, values)}


class Direct:
    """Cells of common rows: the table's columns only, all of them text, integers or bools of their own kind of column,
    no required one missing, and a message that is surely not too long. Any other row is left to RowPath.outcome.

    Columns that a batch gives for all of its rows are left out of a row's cells (see batch_columns).
    """

    #: Columns of a whole batch, and the wire types that they must have.
    BATCH = {"__cluster": STRING, "__kafka_partition": INT64, "__kafka_offset": INT64, "__kafka_topic": STRING, "__inserted_at": STRING}
    CAUGHT = (KeyError, AttributeError, UnicodeDecodeError, JsonError, SourceError, AvroError, TransformError)

    def __init__(self, path: RowPath, table: TableSpec):
        self.path, self.table = path, table
        self.own = [place for place, c in enumerate(table.columns) if c.name not in self.BATCH]
        self.places = {table.columns[place].name: at for at, place in enumerate(self.own)}
        self.wires = [table.wires[place] for place in self.own]
        self.required = [at for at, place in enumerate(self.own) if place in table.required]
        self.room = path.max_row_bytes - 16 * len(table.wires) - 4 * (len(path.transform.cluster) + 300)
        self.schema = self.places["__schema"]
        self.keys: dict[bytes | None, tuple[Any, list[str | None], int] | None] = {}

    @classmethod
    def fits(cls, table: TableSpec) -> bool:
        wires = {c.name: c.wire for c in table.columns}
        return all(wires.get(n) == w for n, w in (cls.BATCH | {"__schema": STRING}).items())

    def cells(self, topic: str, key: bytes | None, value: bytes, headers: dict[str, str] | None, time: str) -> list[str | None] | None:
        """A row's own cells as texts (see cell_texts); None if the row takes more."""
        path = self.path
        try:
            known = self.keys.get(key, self)
            if known is self:
                known = self._key(key)
            if known is None:
                return None
            keys, row, size = known
            if path.encoding == "utf-8":
                schema_id, body = None, parse_lossy(value)
            else:
                schema_id, at = parse_framing(value)
                body = path._decoded(schema_id, value[at:])
            schema = path._schema_text(schema_id, topic)
            found = path.transform.own(Message(topic, 0, 0, 0, keys, headers or {}, body, schema, time))
            row = row.copy()
            size += len(schema)
            row[self.schema] = schema
            texts = self._put(row, found)
        except self.CAUGHT:
            return None
        if texts is None or 4 * (size + texts) > self.room:
            return None
        for at in self.required:
            if row[at] is None:
                return None
        return row

    def _put(self, row: list[str | None], values: dict[str, Any]) -> int | None:
        """Puts values in their places of a row; the characters of texts, or None if a value takes reading."""
        places, wires, size = self.places, self.wires, 0
        for name, value in values.items():
            place = places[name]
            if value is None:
                row[place] = None
                continue
            kind = type(value)
            if kind is dict or kind is list:
                value, kind = dump(value), str
            wire = wires[place]
            if kind is str and wire == STRING:
                size += len(value)
                row[place] = value
            elif kind is int and wire == INT64 and value < 1 << 63:
                row[place] = str(value)
            elif kind is bool and wire == BOOL:
                row[place] = "true" if value else "false"
            else:
                return None
        return size

    def _key(self, key: bytes | None) -> tuple[Any, list[str | None], int] | None:
        """A key's value and its cells: keys repeat, so a bounded number of them is kept."""
        keys = parse(key.decode()) if key else {}
        row: list[str | None] = [None] * len(self.own)
        members = {n: v for n, v in keys_of(self.path.transform, keys).items() if n not in self.BATCH}
        size = self._put(row, members)
        found = None if size is None else (keys, row, size)
        if len(self.keys) >= KEPT_KEYS:
            self.keys.clear()
        self.keys[key] = found
        return found

    def batch_columns(self, batch: pa.RecordBatch, rows: pa.Array, texts: list[list[str | None]], at: str | None) -> pa.ListArray:
        """The cells of all of a table's columns, for some rows of a batch, from their own cells."""
        n, names = len(texts), batch.schema.names
        own = dict(zip(self.own, zip(*texts, strict=True), strict=True))
        taken = lambda name: batch.column(names.index(name)).take(rows).cast(pa.string())
        made = {
            "__cluster": lambda: pa.repeat(pa.scalar(self.path.transform.cluster, pa.string()), n),
            "__kafka_partition": lambda: taken("partition"),
            "__kafka_offset": lambda: taken("offset"),
            "__kafka_topic": lambda: taken("topic"),
            "__inserted_at": lambda: taken("inserted_at") if at is None else pa.repeat(pa.scalar(at, pa.string()), n),
        }
        columns = [pa.array(own[place], pa.string()) if place in own else made[c.name]() for place, c in enumerate(self.table.columns)]
        width = len(columns)
        order = (np.arange(n)[:, None] + n * np.arange(width)).ravel()  # by rows, from one column after the other
        offsets = pa.array(np.arange(0, (n + 1) * width, width), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.concat_arrays(columns).take(pa.array(order)))


def large_json(table: TableSpec, row: dict[str, Any]) -> str:
    """A row as one NDJSON object: nulls left out, JSON columns as documents."""
    found = {}
    for name, value in row.items():
        if value is None:
            continue
        if isinstance(value, str) and name in table.places and table.columns[table.places[name]].type == "JSON":
            try:
                value = parse(value)
            except JsonError as error:
                raise EncodeError(f"{name}: {error}") from None
        found[name] = value
    return dump(found)


def _objects(column: pa.Array) -> list:
    """The values of texts or bytes, None for null: what to_pylist gives, made at once."""
    return column.to_numpy(zero_copy_only=False).tolist()


class _Headers:
    """A batch's headers: all names and values from flat columns, made to lists only if a row asks."""

    def __init__(self, column: pa.ListArray):
        self.there = column.is_valid().to_numpy(zero_copy_only=False).tolist()
        self.ends = np.concatenate(([0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).tolist()
        self.names, self.values = column.flatten().flatten()
        self.raw: list[tuple[str, bytes | None]] | None = None
        try:
            self.texts = None if self.values.null_count else self.values.cast(pa.string())  # this checks that they are UTF-8
        except pa.ArrowInvalid:
            self.texts = None

    def of(self, row: int) -> list[tuple[str, bytes | None]] | None:
        """A row's headers as they came."""
        if self.raw is None:
            self.raw = list(zip(_objects(self.names), _objects(self.values), strict=True))
        return self.raw[self.ends[row] : self.ends[row + 1]] if self.there[row] else None

    def decoded(self) -> list[dict[str, str] | None]:
        """Each row's headers by name, of repeated names the last; only if all values are texts."""
        pairs = list(zip(_objects(self.names), _objects(self.texts), strict=True))
        return [dict(pairs[a:b]) if a < b else None for a, b in zip(self.ends[:-1], self.ends[1:], strict=True)]


#: Milliseconds of the times that Arrow renders as event_time does: from 1970 to 9999.
_LAST_MS = 253_402_300_800_000


def _time_texts(ms: pa.Array) -> list[str | None]:
    """event_time() of a column at once; None where it is not one of these."""
    usual = pc.and_(pc.greater_equal(ms, 0), pc.less(ms, _LAST_MS))
    micros = pc.multiply(pc.if_else(usual, ms, pa.scalar(None, pa.int64())), 1000)
    return _objects(pc.strftime(micros.cast(pa.timestamp("us")), "%Y-%m-%d %H:%M:%S"))


_FIELDS = [f.split(" ", 1)[0] for f in OUTCOMES.split(", ")]
_KINDS = [pa.string(), pa.int32(), pa.int64(), *[pa.string()] * 5, pa.binary(), pa.string(), pa.list_(pa.string())]


def _outcome_batches(batches: Iterator[pa.RecordBatch], path: RowPath, at: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gc.disable()  # a row's objects have no cycles, and are very many until the batch is done
        try:
            found = _outcomes(batch, path, at)
        finally:
            gc.enable()
        yield found


def _outcomes(batch: pa.RecordBatch, path: RowPath, at: str | None) -> pa.RecordBatch:
    column = dict(zip(batch.schema.names, batch.columns, strict=True))
    times, headers = _time_texts(column["timestamp"]), _Headers(column["headers"])
    # a header that is no text is an error whether it is read or not: of such a batch no row with headers goes directly
    odd = headers.texts is None
    named = headers.decoded() if not odd and path.transform.reads_headers else [None] * len(batch)
    direct: dict[Direct, tuple[list[int], list]] = {}
    others: list[int] = []
    found: list[dict[str, Any]] = []
    order = [_objects(column[n]) for n in ("topic", "key", "value", "destination_id")]
    for row, (topic, key, value, destination) in enumerate(zip(*order, strict=True)):
        cells = None
        if value and not (odd and headers.of(row)) and times[row] and (way := path.direct(destination)) is not None:
            cells = way.cells(topic, key, value, named[row], times[row])
        if cells is not None:
            rows, texts = direct.setdefault(way, ([], []))
            rows.append(row)
            texts.append(cells)
        else:
            raw = {n: column[n][row].as_py() for n in ("partition", "offset", "timestamp")}
            raw |= {"topic": topic, "key": key, "value": value, "headers": headers.of(row)}
            others.append(row)
            found.append(path.outcome(raw, at or column["inserted_at"][row].as_py()))
    parts = [(pa.array(others, pa.int64()), [pa.array([x.get(f) for x in found], k) for f, k in zip(_FIELDS[4:], _KINDS[4:], strict=True)])]
    for way, (rows, texts) in direct.items():
        place, n = pa.array(rows, pa.int64()), len(rows)
        made = [pa.repeat(pa.scalar(ROW), n), *(pa.nulls(n, k) for k in _KINDS[5:10]), way.batch_columns(batch, place, texts, at)]
        parts.append((place, made))
    back = pc.sort_indices(pa.concat_arrays([p[0] for p in parts]))
    own = [pa.concat_arrays([p[1][i] for p in parts]).take(back) for i in range(7)]
    return pa.record_batch([*(column[f] for f in _FIELDS[:4]), *own], _FIELDS)


def with_routes(messages: DataFrame, path: RowPath) -> DataFrame:
    """Adds destination_id, skip_reason (empty values) and schema_id, all by native expressions."""
    reason = F.when(is_empty("value"), F.lit(EMPTY_VALUE)) if path.skip_empty_value else F.lit(None).cast("string")
    found = messages.withColumn("destination_id", routed("topic", path.topics)).withColumn("skip_reason", reason)
    framed = framing_id("value") if path.encoding == "avro" else F.lit(None).cast("long")
    return found.withColumn("schema_id", framed)


def schema_ids(messages: DataFrame) -> list[int]:
    """The distinct framing ids of a bounded batch: what a registry is asked for."""
    ids = messages.select(framing_id("value").alias("schema_id")).where("schema_id is not null").distinct()
    return sorted(r["schema_id"] for r in ids.collect())


def encode_rows(messages: DataFrame, path: RowPath, inserted_at: str | Column | None = None) -> DataFrame:
    """An outcome for each message (columns MESSAGES). inserted_at: a text for all rows, or now, to the microsecond."""
    fixed = inserted_at if isinstance(inserted_at, str) else None
    stamp = F.lit("") if fixed else now_text()
    rows = spread(messages).select(*MESSAGE_COLUMNS, routed("topic", path.topics).alias("destination_id"), stamp.alias("inserted_at"))
    held = messages.sparkSession.sparkContext.broadcast(path)
    return rows.mapInArrow(lambda b: _outcome_batches(b, held.value, fixed), OUTCOMES)


def now_text() -> Column:
    """The batch's time as ISO text in UTC, its fraction only if there is one."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    whole = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(now, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat_ws(".", whole, fraction))


def typed_rows(outcomes: DataFrame, table: TableSpec) -> DataFrame:
    """The rows of one destination as its typed columns."""
    rows = outcomes.where((F.col("destination_id") == table.name) & (F.col("outcome") == ROW))
    schema = table.schema()
    columns = []
    for place, f in enumerate(schema):
        text = F.col("cells")[place]
        value = F.unbase64(text) if f.dataType.simpleString() == "binary" else text.cast(f.dataType)
        columns.append(value.alias(f.name, metadata=f.metadata))
    return rows.select(*columns)


def failures(outcomes: DataFrame) -> DataFrame:
    """The messages that stopped, with stage and error."""
    return outcomes.where(F.col("outcome") == ERROR).select("topic", "partition", "offset", "stage", "error")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Messages by outcome, skip reason and stage."""
    return outcomes.groupBy("outcome", "skip_reason", "stage").agg(F.count(F.lit(1)).alias("n"))
