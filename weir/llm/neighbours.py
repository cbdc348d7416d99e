"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text's terms are hashed byte n-grams of the text itself, hashed n-grams of its bytes' classes (lower, upper, digit,
space, mark) and counts of repetition. A truncated singular value decomposition of the learned texts' TF-IDF matrix
gives the latent space. The learned texts' latent vectors, with their labels, are broadcast; every document's exact
cosines with all of them are computed block by block, and its nearest neighbours vote, weighted by similarity and by
how common their label is among all labelled rows.

Learned are at most per_label texts a label and max_texts in all (parameters), chosen among the labels by a hash of the
id, so that no other text is moved; equal texts of a label are one. That bounds the decomposition, which the driver
does, and the broadcasts: max_texts ids, max_texts vectors of rank floats, and a projection of terms by rank. All
documents are scored, whole.

Defined cases: a null text is an empty one, whose vector is zero: it gets the share of label 1 among labelled rows, as
does every text if nothing is labelled (0.5 then); labels other than 0 and 1, and null ones, are not learned; a
document labelled twice counts with each label; of learned texts that are equally near at the last place among the
neighbours, those that numpy's partition puts first vote, the same ones whenever the model and the text are the same; a text
of any length is read whole, its n-grams in blocks of 1 MB; an empty table gives an empty result; other columns of either
input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import map_batches, text_bytes
from weir.llm.features import gram_counts, weighted

DIMS = 2048
CLASS_DIMS = 1024
SIZES = (2, 3)
CLASS_SIZES = (2, 3, 4)
RANK = 64
NEIGHBOURS = 15
SHARPNESS = 8
PER_LABEL = 2500
MAX_TEXTS = 5000
THRESHOLD = 0.7

_CLASSES = bytes(
    0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256)
)
#: Repetition: adjacent equal words, words met before, lines met before; each in eight columns, by its share.
_REPEATS = 24


def term_counts(texts: list[bytes]) -> np.ndarray:
    """A row a text: hashed byte n-grams, hashed class n-grams, and one column for each share of repetition."""
    counts = np.zeros((len(texts), DIMS + CLASS_DIMS + _REPEATS), np.float32)
    gram_counts(texts, DIMS, SIZES, counts[:, :DIMS])
    gram_counts([t.translate(_CLASSES) for t in texts], CLASS_DIMS, CLASS_SIZES, counts[:, DIMS : DIMS + CLASS_DIMS])
    for row, text in enumerate(texts):
        words, lines = text.lower().split(), text.split(b"\n")
        n = max(1, len(words))
        adjacent = sum(a == b for a, b in zip(words[1:], words, strict=False)) / n
        shares = adjacent, 1 - len(set(words)) / n, 1 - len(set(lines)) / len(lines)
        for i, share in enumerate(shares):
            # as common as a frequent n-gram of the text, so that the column counts
            counts[row, DIMS + CLASS_DIMS + 8 * i + min(7, int(8 * share))] = n
    return counts


def latent(rows: np.ndarray, rank: int, rounds: int = 4) -> np.ndarray:
    """The first right singular vectors of a matrix, by subspace iteration from a fixed start."""
    rank = min(rank, *rows.shape)
    space = np.random.default_rng(0).standard_normal((rows.shape[1], min(rank + 16, *rows.shape))).astype(np.float32)
    for _ in range(rounds):
        space, _ = np.linalg.qr(rows.T @ (rows @ space))
    _, _, turn = np.linalg.svd(rows @ space, full_matrices=False)
    return np.ascontiguousarray((space @ turn.T)[:, :rank], np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class NeighbourModel:
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray  # of each learned text: its label's share of all labelled rows by that of the sample
    prior: float

    def scores(self, texts: list[bytes], neighbours: int = NEIGHBOURS) -> np.ndarray:
        found = np.full(len(texts), self.prior)
        k = min(neighbours, len(self.labels))
        if not k:
            return found
        for at in range(0, len(texts), 128):
            block = weighted(term_counts(texts[at : at + 128]), self.idf) @ self.projection
            cosines = _unit(block) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosines, near, 1), 0) ** SHARPNESS * self.weights[near]
            total = votes.sum(1)
            share = (votes * self.labels[near]).sum(1) / np.maximum(total, 1e-30)
            found[at : at + 128] = np.where(total > 1e-12, share, self.prior)
        return np.clip(found, 0.0, 1.0)


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_bytes(batch.column(1))
        for at in range(0, len(texts), 256):
            rows = [r.astype("<u2").tobytes() for r in np.minimum(term_counts(texts[at : at + 256]), 65_535)]
            yield pa.record_batch([batch.column(0).slice(at, len(rows)), pa.array(rows, pa.binary())], ["label", "counts"])


def sampled_labels(labels: DataFrame, per_label: int, total: int) -> tuple[DataFrame, dict[int, int]]:
    """At most per_label rows (of, label) of each label and total of all, by a hash of the id; and all labels' counts."""
    totals = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bound = max(1, min(per_label, total // max(1, len(totals))))
    hashed = labels.withColumn("hash", F.xxhash64(F.lit("sample"), "of"))
    parts = [
        hashed.where((F.col("label") == k) & (F.pmod(F.col("hash"), F.lit(1_000_003)) < min(1.0, 1.2 * bound / n) * 1_000_003)).orderBy("hash", "of").limit(bound)
        for k, n in sorted(totals.items())
    ]
    chosen = labels.limit(0) if not parts else parts[0].drop("hash")
    for part in parts[1:]:
        chosen = chosen.union(part.drop("hash"))
    return chosen, totals


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    label: str = "quality",
    rank: int = RANK,
    per_label: int = PER_LABEL,
    max_texts: int = MAX_TEXTS,
) -> NeighbourModel:
    """A model of the labels (0 or 1) of the rows of labels for which learn, a condition on doc_id, holds."""
    own = labels.where(F.col(label).isin(0, 1) & (F.lit(True) if learn is None else learn))
    own = own.select(F.col("doc_id").cast("long").alias("of"), F.col(label).cast("int").alias("label")).distinct()
    chosen, totals = sampled_labels(own, per_label, max_texts)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # at most max_texts ids are broadcast to the scan, so that no other text is moved
    sample = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).select("label", "text").distinct()
    rows = map_batches(sample.select("label", "text"), _term_batches, "label int, counts binary").collect()
    dims = DIMS + CLASS_DIMS + _REPEATS
    if not rows:
        empty = np.zeros((0, 1), np.float32)
        return NeighbourModel(np.zeros(dims, np.float32), np.zeros((dims, 1), np.float32), empty, empty[:, 0], empty[:, 0], 0.5)
    rows.sort(key=lambda r: (r["label"], bytes(r["counts"])))
    known = np.array([r["label"] for r in rows], np.float32)
    counts = np.stack([np.frombuffer(r["counts"], "<u2") for r in rows]).astype(np.float32)
    idf = (np.log((len(rows) + 1) / ((counts > 0).sum(0) + 1)) + 0.1).astype(np.float32)
    matrix = weighted(counts, idf)
    projection = latent(matrix, rank)
    every = sum(totals.values())
    weights = np.array([totals.get(int(y), 0) / every / (known == y).mean() for y in known], np.float32)
    return NeighbourModel(idf, projection, _unit(matrix @ projection), known, weights, totals.get(1, 0) / every)


def _score_batches(batches: Iterator[pa.RecordBatch], model, neighbours: int, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = model.value.scores(text_bytes(batch.column(1)), neighbours)
        yield pa.record_batch([batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])


def score(docs: DataFrame, model: NeighbourModel, neighbours: int = NEIGHBOURS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (how likely label 1 is) and predicted (1 from the threshold on) of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, lambda b: _score_batches(b, held, neighbours, threshold), "doc_id long, score double, predicted int")
