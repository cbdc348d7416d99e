"""Hashed byte n-gram counts of whole texts, and bounded labelled samples: shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_MULTIPLIER = np.uint32(2_654_435_761)
#: Bytes of text whose n-grams are hashed at once.
_BLOCK = 1 << 20
#: Labels of a classifier at most: they come to the driver, and into one map of a plan.
MAX_LABELS = 3000


def gram_counts(texts: list[bytes], dims: int, sizes: tuple[int, ...], out: np.ndarray | None = None) -> np.ndarray:
    """Counts of each text's byte n-grams of the given sizes (at most 4), hashed to dims columns (a power of two)."""
    counts = np.zeros((len(texts), dims), np.float32) if out is None else out
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    for row, text in enumerate(texts):
        for at in range(0, len(text), _BLOCK):
            octets = np.frombuffer(text[at : at + _BLOCK + max(sizes) - 1], np.uint8).astype(np.uint32)
            for size in sizes:
                # a later block starts with the n-grams that begin in it, so none counts twice
                n = min(_BLOCK, len(octets) - size + 1)
                if n <= 0:
                    continue
                grams = octets[:n].copy()
                for i in range(1, size):
                    grams = (grams << np.uint32(8)) | octets[i : i + n]
                grams = (grams + np.uint32(size)) * _MULTIPLIER
                grams ^= grams >> np.uint32(15)
                counts[row] += np.bincount((grams * _MULTIPLIER) >> shift, minlength=dims)
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of (1 + log count) * idf, scaled to length one; a row without n-grams stays zero."""
    rows = np.where(counts > 0, np.log(np.maximum(counts, 1)) + 1, 0).astype(np.float32) * idf
    return rows / np.maximum(np.sqrt((rows * rows).sum(1, keepdims=True)), 1e-12)


def labelled_sample(rows: DataFrame, label: str, per_label: int, total: int) -> tuple[DataFrame, dict]:
    """Distinct labelled texts, at most per_label for each label and about total of all; and the labels' row counts.

    rows has text and the label, both not null. Each label's texts of the smallest hashes are in, as many as the bound or
    all it has: copies are one text, and the same rows give the same sample however they are dealt out. Whole texts are
    kept. More than MAX_LABELS labels raise ValueError. Only hashes are counted, and only texts below a hash that about bound distinct texts are below are moved.
    """
    hashed = rows.withColumn("hash", F.xxhash64(F.lit("sample"), "text"))
    of_hash = hashed.groupBy(label, "hash").agg(F.count(F.lit(1)).alias("n"))
    known = of_hash.groupBy(label).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).limit(MAX_LABELS + 1).collect()
    if len(known) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} values of {label}")
    totals = {r[label]: r["n"] for r in known}
    if not totals:
        return rows.select(label, "text", F.lit(0).cast("long").alias("hash")), totals
    bound = max(1, min(per_label, total // len(totals)))
    # eight deviations and more above the bound: that fewer than the bound are below it has a chance under 1e-12
    enough = bound + 8 * bound**0.5 + 32
    highest = {r[label]: min((1 << 63) - 1, int(2**64 * min(1.0, enough / r["texts"])) - (1 << 63)) for r in known}
    limit = F.create_map(*(x for k, h in highest.items() for x in (F.lit(k), F.lit(h).cast("long"))))[F.col(label)]
    some = hashed.where(F.col("hash") <= limit)
    some = some.groupBy(label, "hash").agg(F.first("text").alias("text"))
    first = Window.partitionBy(label).orderBy("hash")
    return some.withColumn("place", F.row_number().over(first)).where(F.col("place") <= bound).drop("place"), totals
