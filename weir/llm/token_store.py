"""Token-id tables: Parquet files of id lists in ascending doc_id order, for selective reads.

The documents are dealt out by ranges of doc_id (and of a hash of the text, so that one repeated doc_id can be split)
and sorted within each range; ids are made after that, in the same stage, and written by Spark's own committer, so no
file of a lost attempt stays. Ids are a dictionary-encoded list column. shard, doc_id, n_tokens and first (the ids of
the shard before the document) are delta-encoded columns of their own, so that they can be read without the ids. Row
groups and pages are bounded, and the writer's page indexes let a reader with a filter on doc_id skip pages.

Defined cases: a null or empty text has only the end id; a null doc_id sorts first; rows that share a doc_id are
ordered by their texts' hash, then text; an empty table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weir.llm.common import input_bytes, map_batches, text_bytes
from weir.llm.tokens import default_tokenizer, encoder
from weir.sources.shared import scratch

END_ID = 1
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 5_000
#: Bytes of input files that go to one shard, as long as that makes at most MAX_SHARDS.
SHARD_BYTES = 16 << 20
MAX_SHARDS = 50_000
#: With fewer shards than cores, shards are smaller, down to this.
LEAST_SHARD_BYTES = 2 << 20

SCHEMA = "shard int, doc_id long, n_tokens int, first long, ids array<int>"


def _encode_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
    shard, first = TaskContext.get().partitionId(), 0
    for batch in batches:
        texts = text_bytes(batch.column(1))
        for at in range(0, len(texts), 512):
            blobs = [encode(t) + end for t in texts[at : at + 512]]
            ends = np.cumsum([0, *(len(b) // 4 for b in blobs)])
            ids = pa.array(np.frombuffer(b"".join(blobs), "<i4"))
            columns = [
                pa.array(np.full(len(blobs), shard, np.int32)),
                batch.column(0).slice(at, len(blobs)),
                pa.array(np.diff(ends).astype(np.int32)),
                pa.array(first + ends[:-1]),
                pa.ListArray.from_arrays(ends.astype(np.int32), ids),
            ]
            yield pa.record_batch(columns, ["shard", "doc_id", "n_tokens", "first", "ids"])
            first += int(ends[-1])


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    shards: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Writes the ids of every document below path: a file a shard, doc_id ascending within and across the shards."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if shards is None:
        size = input_bytes(docs)
        shards = max(1, min(MAX_SHARDS, -(-size // SHARD_BYTES)), min(docs.sparkSession.sparkContext.defaultParallelism, size // LEAST_SHARD_BYTES))
    dealt = rows.repartitionByRange(shards, F.col("doc_id"), F.xxhash64("text"))
    dealt = dealt.sortWithinPartitions(F.col("doc_id"), F.xxhash64("text"), F.col("text"))
    tokenizer = tokenizer or default_tokenizer()
    ids = map_batches(dealt, lambda b: _encode_batches(b, tokenizer, end_id), SCHEMA, ordered=True)
    (
        ids.write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written table; a reader that selects no ids reads none, and a filter on doc_id skips row groups and pages."""
    return spark.read.schema(SCHEMA).parquet(path)


def with_start(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Adds start, the number of ids of all documents before each, to rows that have shard and first.

    metadata is the table's shard, n_tokens and first. One total a shard meets in one task, nothing else does.
    """
    totals = metadata.groupBy(F.col("shard").alias("of")).agg(F.max(F.col("first") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("of", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(base, rows["shard"] == base["of"]).withColumn("start", F.col("base") + F.col("first"))


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(4)
        ids = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
        ends = (np.asarray(lists.offsets) * 4).tolist()
        crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        counts = pa.array(np.diff(np.asarray(lists.offsets)).astype(np.int64))
        columns = [batch.column(0), batch.column(1), counts, batch.column(3), pa.array(crc, pa.int64())]
        yield pa.record_batch(columns, ["shard", "doc_id", "n_tokens", "first", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    rows = map_batches(
        read_tokens(spark, path), _digest_batches, "shard int, doc_id long, n_tokens long, first long, ids_crc32 long"
    )
    totals = read_tokens(spark, path).select("shard", "n_tokens", "first")
    return with_start(rows, totals).select("doc_id", "start", "n_tokens", "ids_crc32")


def store_and_digest(docs: DataFrame, **options) -> DataFrame:
    """Writes the documents' ids to a new folder in the shared storage, and reads their digests back."""
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write_tokens(docs, path, **options)
    return token_digests(spark, path)
