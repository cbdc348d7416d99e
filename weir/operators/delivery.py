"""Delivery bookkeeping over data: commit prefixes, lag, latencies, distinct rows, and comparison of two results."""

from __future__ import annotations

from collections.abc import Container
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def commit_prefix(acks: DataFrame) -> DataFrame:
    """For each partition of acks (topic, partition, offset, done): the offset to commit.

    That is one more than the last offset of the contiguous done prefix of the offsets present, null if the first is
    not done. It takes two partial aggregations: the first offset that is not done, and the last offset before it.
    """
    gap = acks.where(~F.col("done")).groupBy("topic", "partition").agg(F.min("offset").alias("gap"))
    rows = acks.join(gap, ["topic", "partition"], "left")
    before = F.when(F.col("gap").isNull() | (F.col("offset") < F.col("gap")), F.col("offset"))
    return rows.groupBy("topic", "partition").agg((F.max(before) + 1).alias("commit"))


def consumer_lag(partitions: DataFrame) -> DataFrame:
    """Lag by topic, over partitions that are owned and whose lag is known (topic, partition, desired, consumer_lag)."""
    known = partitions.where((F.col("partition") >= 0) & F.col("desired") & (F.col("consumer_lag") >= 0))
    return known.groupBy("topic").agg(F.sum("consumer_lag").alias("lag"))


#: Buckets of values by their logarithm, so many for each doubling.
BUCKETS = 64


def latency_summary(latencies: DataFrame, column: str = "ms") -> DataFrame:
    """Count, p50, p99 and max of a column, each percentile the value at place floor(n * p) from the smallest.

    Equal values are counted first, then buckets of close values, of which there is a bounded number. Only the distinct
    values of the two buckets that hold the percentiles are put in order.
    """
    v, asked = F.col(column), {"p50": 0.5, "p99": 0.99}
    bucket = F.signum(v).cast("double") * F.floor(F.log2(F.abs(v).cast("double") + 1) * BUCKETS)
    counts = latencies.where(v.isNotNull()).groupBy(v.alias("v"), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("k"))
    buckets = counts.groupBy("bucket").agg(F.sum("k").alias("k"))
    upto, n = F.sum("k").over(Window.orderBy("bucket")), F.sum("k").over(Window.partitionBy())
    places = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), F.least(F.floor(F.col("n") * p), F.col("n") - 1).alias("place")) for name, p in asked.items())))
    ranked = buckets.select("bucket", (upto - F.col("k")).alias("before"), upto.alias("upto"), n.alias("n"))
    holding = ranked.select("bucket", "before", "upto", places.alias("of")).where("before <= of.place AND of.place < upto").select("bucket", "before", "of.*")
    inside = counts.join(F.broadcast(holding), "bucket")  # a row a percentile
    reached = F.col("before") + F.sum("k").over(Window.partitionBy("name").orderBy("v"))
    found = inside.select("name", "v", "place", reached.alias("reached")).where("reached > place").groupBy("name").agg(F.min("v").alias("v"))
    whole = counts.agg(F.sum("k").alias("n"), F.max("v").alias("max"))
    rows = found.select(F.lit(None).cast("long").alias("n"), "name", "v").union(whole.select("n", F.lit("max"), "max"))
    one = lambda name: F.max(F.when(F.col("name") == name, F.col("v"))).alias(name)
    return rows.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), one("p50"), one("p99"), one("max"))


def distinct_rows(rows: DataFrame, *ignored: str) -> DataFrame:
    """How many rows there are, and how many differ in other columns than the ignored."""
    names = [c for c in rows.columns if c not in ignored]
    key = F.xxhash64(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))
    return rows.select(key.alias("key")).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("key").alias("n_distinct"))


def compare(own: DataFrame, other: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows of two results by key: n by verdict, one of matched, differs, only_left and only_right."""
    a = own.select(*keys, F.struct(*values).alias("a"))
    b = other.select(*[F.col(k).alias(f"other_{k}") for k in keys], F.struct(*values).alias("b"))
    same = [F.col(k).eqNullSafe(F.col(f"other_{k}")) for k in keys]
    on = same[0]
    for more in same[1:]:
        on = on & more
    verdict = (
        F.when(F.col("b").isNull(), "only_left").when(F.col("a").isNull(), "only_right")
        .when(F.col("a").eqNullSafe(F.col("b")), "matched").otherwise("differs")
    )
    return a.join(b, on, "full_outer").groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@dataclass
class OffsetTracker:
    """The same prefix rule for one process: offsets in flight by partition, with generations.

    A ticket names the generation of its partition's assignment; what is done for an older one changes nothing.
    """

    _open: dict[tuple[str, int], dict[int, float]] = field(default_factory=dict)
    _seen: dict[tuple[str, int], int] = field(default_factory=dict)
    _first: dict[tuple[str, int], int] = field(default_factory=dict)
    _generation: dict[tuple[str, int], int] = field(default_factory=dict)

    def assign(self, topic: str, partition: int) -> None:
        at = topic, partition
        self._generation[at] = self._generation.get(at, 0) + 1
        self._open[at] = {}
        self._seen.pop(at, None)
        self._first.pop(at, None)

    def revoke(self, topic: str, partition: int) -> None:
        self.assign(topic, partition)
        del self._open[topic, partition]

    def track(self, topic: str, partition: int, offset: int, now: float = 0.0) -> tuple[str, int, int, int] | None:
        """A ticket, or None if the partition is not owned."""
        at = topic, partition
        if at not in self._open:
            return None
        self._open[at][offset] = now
        self._seen[at] = max(offset, self._seen.get(at, offset))
        self._first[at] = min(offset, self._first.get(at, offset))
        return topic, partition, offset, self._generation[at]

    def done(self, ticket: tuple[str, int, int, int]) -> None:
        topic, partition, offset, generation = ticket
        if self._generation.get((topic, partition)) == generation and (topic, partition) in self._open:
            self._open[topic, partition].pop(offset, None)

    def committable(self, only: Container[tuple[str, int]] | None = None) -> list[tuple[str, int, int]]:
        """(topic, partition, offset to commit) of the partitions with a done prefix, in order; of those given, or of all."""
        found = []
        for at, last in sorted(self._seen.items()):
            if at in self._open and (only is None or at in only):
                first = min(self._open[at], default=last + 1)
                if first > self._first[at]:
                    found.append((*at, first))
        return found

    def in_flight(self, only: Container[tuple[str, int]] | None = None) -> int:
        """How many offsets are not done; of the partitions given, or of all."""
        return sum(len(pending) for at, pending in self._open.items() if only is None or at in only)

    def oldest_age(self, now: float) -> float | None:
        times = [t for pending in self._open.values() for t in pending.values()]
        return now - min(times) if times else None
