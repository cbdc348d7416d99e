"""Helpers shared by the training-data operators: shared storage, folds, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators.spread import as_bytes, estimated_bytes, spread
from weir.sources.shared import scratch

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df once to the shared folder and reads it back: cuts lineage, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Ids that are broadcast at most: about 100 MB of a task's memory.
MAX_BROADCAST_IDS = 2_000_000


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs but for the rows of the doc_ids given, of which repeated ones and null count for nothing.

    The ids are written and counted first: up to MAX_BROADCAST_IDS they go to the documents, and no text is moved.
    """
    own = materialise(ids.select(F.col("doc_id").alias("__weir_gone")).where("__weir_gone is not null").distinct(), "ids")
    gone = F.broadcast(own) if own.count() <= MAX_BROADCAST_IDS else own
    return docs.join(gone, docs["doc_id"] == gone["__weir_gone"], "left_anti")


def fold(modulus: int, remainder: int, column: str = "doc_id") -> Column:
    """True where crc32(column as text) mod modulus is the remainder; false for null."""
    crc = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema, ordered: bool = False
) -> DataFrame:
    """mapInArrow: one narrow pass, batch by batch. A small scan is dealt out to all cores, unless its order counts.

    Texts can be long: the session's bound on a batch is its rows and, from here on, BATCH_BYTES.
    """
    conf = df.sparkSession.conf
    if as_bytes(conf.get(BATCH_CONF, "64m")) > BATCH_BYTES:
        conf.set(BATCH_CONF, str(BATCH_BYTES))
    return (df if ordered else spread(df)).mapInArrow(function, schema)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each string, without decoding; null gives b''."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


#: Above this, Catalyst's estimate is its default for sources of unknown size.
_KNOWN_BYTES = 1 << 52


def input_bytes(docs: DataFrame) -> int:
    """How large an input with a text column is: its files' size where the plan knows it, else the texts' bytes."""
    estimate = estimated_bytes(docs)
    if estimate < _KNOWN_BYTES and "Join" not in docs._jdf.queryExecution().optimizedPlan().toString():
        return estimate
    return docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0


#: What a partition of an exchange is to hold at most, and how many there are at most.
PARTITION_BYTES = 256 << 20
MAX_PARTITIONS = 200_000


def by_size(spark: SparkSession, size: int) -> int | None:
    """How many partitions an exchange of so many bytes takes, if more than the session's setting; None if that will do."""
    wanted = min(MAX_PARTITIONS, -(-size // PARTITION_BYTES))
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """df dealt out by keys to as many partitions as its bytes ask for; as it is where the session's setting will do.

    A grouping by the same keys that follows takes these partitions and moves nothing.
    """
    n = by_size(df.sparkSession, size)
    return df.repartition(n, *keys) if n else df


def moved_bytes(df: DataFrame, copies: int = 1) -> int:
    """The bytes of a table whose rows are copied so often, from what the plan knows; 0 if it knows nothing."""
    estimate = estimated_bytes(df)
    return estimate * copies if estimate < _KNOWN_BYTES else 0
