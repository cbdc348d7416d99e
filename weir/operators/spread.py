"""Small inputs over all cores: a file that cannot be split is one task, however many cores wait."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

#: What a task should have at least, in bytes of input files, to be worth its own.
TASK_BYTES = 256 << 10
#: What is moved for this at most.
MOST_BYTES = 128 << 20


def as_bytes(text: str) -> int:
    """A size as Spark's settings give it."""
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    text = text.lower().removesuffix("b")
    return int(text[:-1]) << units[text[-1]] if text and text[-1] in units else int(text)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate: the size of the files for a scan, and a very large number for a source of unknown size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _dealt(df: DataFrame) -> bool:
    """Whether the plan deals its rows out already."""
    return "Repartition" in df._jdf.queryExecution().optimizedPlan().toString()


def spread(df: DataFrame, *order: Column, task_bytes: int = TASK_BYTES) -> DataFrame:
    """df dealt out to more tasks if its plan knows it to be small, and the scan gives less than half as many tasks as cores.

    With an order, rows are dealt out by its first column and sorted by all of it, so that a task that is run again
    meets the same rows in the same order.

    At most MOST_BYTES are moved; anything larger, of unknown size, or streaming stays as it is.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    size = estimated_bytes(df)
    wanted = min(spark.sparkContext.defaultParallelism, size // task_bytes)
    if size > MOST_BYTES or wanted < 2 or _dealt(df):
        return df
    scanned = max(len(df.inputFiles()), size // as_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    if 2 * scanned > wanted:
        return df
    return df.repartition(wanted, order[0]).sortWithinPartitions(*order) if order else df.repartition(wanted)
