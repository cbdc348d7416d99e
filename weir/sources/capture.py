"""Captured messages: reading them as a batch or a stream, and writing them.

A capture is a folder of NDJSON, one message a line: topic, partition, offset, timestamp_type, timestamp (epoch ms, -1
if unknown), key, value (base64 or null) and headers (a list of [name, base64 or null], or null).

read_capture uses Spark's JSON reader with a fixed schema and native base64 functions. stream_capture is the same over
a folder that grows. CaptureSource is a Python data source for one file on a path that executors share: tasks read ranges
of its bytes; as a stream, its offsets are bytes, so that each batch is a range that can be read again.
"""

from __future__ import annotations

import json
import os
import threading
import uuid
from base64 import b64decode
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, DataSourceStreamReader

from weir.operators.registry import Registry
from weir.operators.rows import MESSAGES

_LINES = (
    "topic string, partition int, offset long, timestamp_type string, timestamp long, key string, value string, "
    "headers array<array<string>>"
)


def _decoded(lines: DataFrame) -> DataFrame:
    header: Column = F.transform(
        "headers", lambda h: F.struct(h[0].alias("key"), F.unbase64(h[1]).alias("value"))
    )
    return lines.select(
        "topic", "partition", "offset", "timestamp", F.unbase64("key").alias("key"), F.unbase64("value").alias("value"), header.alias("headers")
    )


def read_capture(spark: SparkSession, path: str) -> DataFrame:
    """The messages of a capture (columns MESSAGES)."""
    return _decoded(spark.read.schema(_LINES).json(path))


def stream_capture(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The messages of a folder of capture files, as a stream of its files."""
    reader = spark.readStream.schema(_LINES)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _decoded(reader.json(folder))


def capture_lines(messages: DataFrame) -> DataFrame:
    """Messages as the columns of a capture line."""
    header = F.transform("headers", lambda h: F.array(h["key"], F.base64(h["value"])))
    kind = F.when(F.col("timestamp") < 0, "none").otherwise("create")
    return messages.select(
        "topic", "partition", "offset", kind.alias("timestamp_type"), "timestamp", F.base64("key").alias("key"), F.base64("value").alias("value"), header.alias("headers")
    )


def write_capture(messages: DataFrame, path: str) -> None:
    """Writes messages as a capture, nulls included."""
    capture_lines(messages).write.option("ignoreNullFields", "false").json(path)


def write_schemas(ids: Iterable[int], registry: Registry, folder: str) -> int:
    """Writes the text of each schema that the registry has to folder/<id>.json: a replay needs no registry then."""
    n = 0
    for schema_id in ids:
        if (text := registry.load(schema_id)) is not None:
            Path(folder).mkdir(parents=True, exist_ok=True)
            Path(folder, f"{schema_id}.json").write_text(text, encoding="utf-8")
            n += 1
    return n


def limited(spark: SparkSession, seconds: float, work: Callable[[], Any]) -> bool:
    """Whether work's Spark jobs end within so many seconds; those that do not are cancelled."""
    tag = f"limited-{uuid.uuid4().hex}"
    late = threading.Event()

    def stop() -> None:
        late.set()
        spark.sparkContext.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    spark.sparkContext.addJobTag(tag)
    timer.start()
    try:
        work()
    except Exception:
        if not late.is_set():
            raise
        return False
    finally:
        timer.cancel()
        spark.sparkContext.removeJobTag(tag)
    return True


def first_messages(messages: DataFrame, per_topic: int, topics: list[str] | None = None, since_ms: int | None = None) -> DataFrame:
    """At most per_topic messages a topic, by partition and offset, of the topics given and from a time on.

    A partition's first per_topic offsets are found before a topic's rows meet, so that no topic is one task's list.
    """
    if topics is not None:
        messages = messages.where(F.col("topic").isin(topics))
    if since_ms is not None:
        messages = messages.where(F.col("timestamp") >= since_ms)
    salt = F.pmod(F.xxhash64("offset"), F.lit(32))
    own = Window.partitionBy("topic", "salt").orderBy("partition", "offset")
    few = messages.withColumn("salt", salt).withColumn("place", F.row_number().over(own)).where(F.col("place") <= per_topic)
    every = Window.partitionBy("topic").orderBy("partition", "offset")
    return few.withColumn("place", F.row_number().over(every)).where(F.col("place") <= per_topic).drop("place", "salt")


def parse_since(text: str, now_ms: int) -> int:
    """Epoch milliseconds from a number, or from Nm, Nh or Nd before now."""
    units = {"m": 60_000, "h": 3_600_000, "d": 86_400_000}
    if text and text[-1] in units and text[:-1].isdigit():
        return now_ms - int(text[:-1]) * units[text[-1]]
    if text.isdigit():
        return int(text)
    raise ValueError(f"not a time: {text}")


def _message(line: str) -> tuple:
    m = json.loads(line)
    raw = lambda x: None if x is None else b64decode(x)
    headers = m.get("headers")
    headers = None if headers is None else [(name, raw(value)) for name, value in headers]
    return m["topic"], m["partition"], m["offset"], m["timestamp"], raw(m.get("key")), raw(m.get("value")), headers


#: Bytes of a file that a task reads, and that a micro-batch has at most but for its last line.
RANGE_BYTES = 32 << 20


class _Range(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


def _ranges(start: int, end: int, size: int) -> list[InputPartition]:
    return [_Range(at, min(end, at + size)) for at in range(start, end, size)]


def _lines(path: str, part: _Range) -> Iterator[tuple]:
    """The messages of the lines that begin in a range of bytes."""
    with open(path, "rb") as file:
        at = max(0, part.start - 1)
        file.seek(at)
        if part.start:
            at += len(file.readline())  # the line that holds the byte before the range is another range's
        while at < part.end and (line := file.readline()):
            at += len(line)
            if line.strip():
                yield _message(line)


class _CaptureReader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[InputPartition]:
        return _ranges(0, os.path.getsize(self.path), self.size)

    def read(self, partition: _Range) -> Iterator[tuple]:
        return _lines(self.path, partition)


class _CaptureStream(DataSourceStreamReader):
    """A micro-batch is a range of bytes, which ends with a whole line: a line without its end is left for later.

    Only offsets are the driver's: the lines are read by tasks.
    """

    def __init__(self, path: str, size: int):
        self.path, self.size = path, size
        self._at = 0

    def initialOffset(self) -> dict:
        return {"byte": 0}

    def latestOffset(self) -> dict:
        self._at = self._ended(self._at)
        return {"byte": self._at}

    def _ended(self, start: int) -> int:
        """The end of the last whole line up to the size of a batch from start, or of the first one if that is longer."""
        with open(self.path, "rb") as file:
            file.seek(start)
            raw = file.read(self.size)
            whole = raw.rfind(b"\n") + 1
            if whole or not raw:
                return start + whole
            line = raw + file.readline()
            return start + len(line) if line.endswith(b"\n") else start

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._at = max(self._at, end["byte"])
        return _ranges(start["byte"], end["byte"], max(1, self.size // 4))

    def read(self, partition: _Range) -> Iterator[tuple]:
        return _lines(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


class CaptureSource(DataSource):
    """format("weir_capture").option("path", file); option("bytes", of a task, and as a stream of a batch)."""

    @classmethod
    def name(cls) -> str:
        return "weir_capture"

    def schema(self) -> str:
        return MESSAGES

    def reader(self, schema) -> DataSourceReader:
        return _CaptureReader(self.options["path"], int(self.options.get("bytes", RANGE_BYTES)))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _CaptureStream(self.options["path"], int(self.options.get("bytes", RANGE_BYTES)))
