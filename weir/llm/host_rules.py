"""Host-level quality rules: rule failures by host, shrunk by an empirical beta prior, and joined back to documents.

A document fails a rule of its own: the base rule (too few words, or repeated word windows) or a weak one (many symbols,
many repeated lines), which alone does not tell good documents from bad. Failures of any rule are counted by host; the
hosts' rates, taken together, give a beta prior by the method of moments, and each host's rate is shrunk towards it: a
host of few documents says little. That gives the host's verdict, whatever its number of documents:

  rejected  even the lower end of its shrunk rate (mean less two standard deviations) is above max_rate: all its documents go
  watched   its shrunk rate is at least watch_rate: documents that fail a weak rule go
  trusted   otherwise: a weak failure there is taken for a chance one, and the document stays

A host without evidence of its own has the prior's mean for its rate, so that at a corpus of many failures a host has to
show documents that pass before it is trusted. Documents that fail the base rule always go.

Documents are read once: their counts are written to shared storage without their texts, and hosts and documents are
both derived from that table. Counting by host is a partial aggregation, so a host with a third of the documents is a
few rows by the time it is dealt out. Only hosts of another verdict than that of a host without documents are joined
back, a set that Spark broadcasts if its measured size allows, and else joins with the skewed side split.

Defined cases: a null or empty text has no words and fails the base rule; a null host is a host without documents of its
own, whatever its documents; repeated rows count once each; an empty table has no hosts; without failures, or without
documents that pass, the prior is uniform; a rate of exactly watch_rate is watched, a lower end of exactly max_rate is
not rejected; a text of any length is counted whole, by one worker; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import map_batches, materialise, text_bytes

MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 50
MAX_HOST_RATE = 0.5
WATCH_RATE = 0.05

TRUSTED, WATCHED, REJECTED = "trusted", "watched", "rejected"

_SYMBOLS = b"#*$%&|<>"
_NOT_COUNTED = bytes([0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)])
_MIX = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """How many words lie in a window of words that the text has at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    rolled = np.zeros(n, np.uint64)
    for i in range(window):
        rolled = (rolled ^ (rolled >> np.uint64(29))) * _MIX + ids[i : i + n]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order][1:] == rolled[order][:-1]
    if not same.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _count(text: bytes) -> tuple[int, ...]:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text.translate(None, _NOT_COUNTED)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for batch in batches:
        counts = [_count(t) for t in text_bytes(batch.column(2))]
        columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(6)]
        yield pa.record_batch([batch.column(0), batch.column(1), *columns], names)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def weak_failed() -> Column:
    symbols = 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")
    lines = 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")
    return symbols | lines


def _prior(k: int, n: int | None, n2: int | None, f: int | None, q: float | None) -> tuple[float, float]:
    """alpha and beta from sums over hosts: how many, documents, their squares, failures, failures squared by documents.

    The rates' mean is m = f / n. Their spread about it, less what chance gives hosts of one rate, is the correlation
    rho of two documents of a host, and alpha + beta = 1 / rho - 1.
    """
    if not n or f in (0, n):
        return 1.0, 1.0
    m = f / n
    spread = (q - n * m * m) / (m * (1 - m))
    room = n - n2 / n - (k - 1)
    if room <= 0:
        return 1.0, 1.0
    rho = min(max((spread - (k - 1)) / room, 1e-4), 0.99)
    return m * (1 / rho - 1), (1 - m) * (1 / rho - 1)


@dataclass(frozen=True)
class HostPrior:
    """The beta prior of the hosts' rates, with the bounds of the verdicts."""

    alpha: float
    beta: float
    max_rate: float = MAX_HOST_RATE
    watch_rate: float = WATCH_RATE

    def verdict(self, failed: Column, docs: Column) -> tuple[Column, Column, Column]:
        """A host's shrunk rate, its lower end, and its verdict."""
        a, b = failed + F.lit(self.alpha), docs - failed + F.lit(self.beta)
        rate = a / (a + b)
        low = rate - 2 * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
        return rate, low, F.when(low > self.max_rate, REJECTED).when(rate >= self.watch_rate, WATCHED).otherwise(TRUSTED)

    @property
    def default(self) -> str:
        """The verdict of a host without documents, but that it is never rejected."""
        return WATCHED if self.alpha / (self.alpha + self.beta) >= self.watch_rate else TRUSTED


def host_verdicts(counts: DataFrame, max_rate: float = MAX_HOST_RATE, watch_rate: float = WATCH_RATE) -> tuple[DataFrame, HostPrior]:
    """host, n_docs, n_failed, rate (shrunk), low (its lower end) and verdict, for every host that is not null; and the prior."""
    hosts = counts.where("host is not null").groupBy("host")
    hosts = hosts.agg(F.count(F.lit(1)).alias("n_docs"), F.sum((base_failed() | weak_failed()).cast("long")).alias("n_failed"))
    n, f = F.col("n_docs"), F.col("n_failed")
    sums = hosts.agg(F.count(F.lit(1)).alias("k"), F.sum(n).alias("n"), F.sum(n * n).alias("n2"), F.sum(f).alias("f"), F.sum(f * f / n).alias("q"))
    prior = HostPrior(*_prior(*sums.first()), max_rate, watch_rate)  # one row: five sums over all hosts
    rate, low, verdict = prior.verdict(f, n)
    return hosts.withColumns({"rate": rate, "low": low, "verdict": verdict}), prior


def document_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.col(host).cast("string"), F.col("text").cast("string"))
    return map_batches(rows, _count_batches, SCHEMA)


def apply_host_rules(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE, watch_rate: float = WATCH_RATE) -> DataFrame:
    """Per document: its counts, base_failed, kept, host and its host's verdict."""
    counts = materialise(document_counts(docs, host), "rule-counts")
    hosts, prior = host_verdicts(counts, max_rate, watch_rate)
    other = hosts.where(F.col("verdict") != prior.default).select(F.col("host").alias("of_host"), "verdict")
    rows = counts.join(other, F.col("host") == F.col("of_host"), "left").withColumns(
        {"verdict": F.coalesce("verdict", F.lit(prior.default)), "base_failed": base_failed(), "weak_failed": weak_failed()}
    )
    gone = F.col("base_failed") | (F.col("verdict") == REJECTED) | (F.col("weak_failed") & (F.col("verdict") == WATCHED))
    return rows.withColumn("kept", ~gone).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host", "verdict"
    )
