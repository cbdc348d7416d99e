"""Language identification by the nearest of several centroids per language.

A text's vector is the TF-IDF of its hashed byte n-grams (letters only, lower case, words between single spaces),
scaled to length one. The vectors of each language's learned texts are clustered by spherical k-means, so that a
language of several registers has several centroids. A text gets the language of the centroid of largest cosine; it is
rejected as too far from all of them if that cosine is below what nearly all held-out texts of its length have. Those
are measured while fitting: each half of a language's learned texts, and a shorter piece of each for every power of two
of bytes, against centroids of the other half. A text's length is its number of different n-grams, so that a repeated
word is a short text. A length met by few takes the nearest lengths too. The score is a softmax of the languages' best
cosines.

Learned are at most per_language texts a language and about max_texts in all (both parameters), chosen by a hash of
the text. Their clusters are fitted a language a task; only centroids come to the driver and are broadcast, at most
max_centroids of dims floats. All texts are scored whole.

Defined cases: a null text or one without a letter (str.isalpha: numerals such as ½ or ① are none) is "und", with score 0
and rejected; of languages with equal cosines the first in alphabetical order is taken; a text of any length is read
whole, its n-grams in blocks of 1 MB; rows with a null lang are not
learned from; repeated rows are scored each on its own; without any learned language every text is "und"; with too few
learned texts to measure a length no text with a letter is rejected; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import map_batches, materialise
from weir.llm.features import gram_counts, labelled_sample, weighted

DIMS = 4096
SIZES = (2, 3, 4)
CENTROIDS = 6
PER_LANGUAGE = 1200
MAX_TEXTS = 6000
MAX_CENTROIDS = 3000
#: This share of held-out cosines at the same length lies below the least cosine that is not too far.
REJECT_SHARE = 0.005
#: So many held-out cosines make a floor; of a length with fewer, those of the nearest lengths are taken too.
FLOOR_COSINES = 30
LENGTHS = 32
#: Texts whose counts or vectors are made at once.
BLOCK_ROWS = 256
#: Bytes up to which pieces of learned texts are measured; longer ones are measured whole.
MAX_PIECE = 2048
TEMPERATURE = 0.05
UNKNOWN = "und"

#: Of the bytes of a lower-case text, all but a-z and what is beyond ASCII become spaces.
_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


@dataclass
class LanguageModel:
    languages: list[str]
    centroids: np.ndarray  # a row a centroid
    of: np.ndarray  # the language of each centroid
    idf: np.ndarray
    floor: np.ndarray  # least cosine by length class

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, rejected) of each text."""
        found: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
        if not self.languages:
            return found
        for at in range(0, len(texts), BLOCK_ROWS):
            counts = gram_counts([normalise(t) for t in texts[at : at + BLOCK_ROWS]], len(self.idf), SIZES)
            cosines = weighted(counts, self.idf) @ self.centroids.T
            best = np.stack([cosines[:, self.of == i].max(1) for i in range(len(self.languages))], 1)
            top = best.argmax(1)
            nearest = best[np.arange(len(best)), top]
            score = 1 / np.exp((best - nearest[:, None]) / TEMPERATURE).sum(1)
            far = nearest < self.floor[_length_class(counts, len(self.floor))]
            for i, text in enumerate(texts[at : at + BLOCK_ROWS]):
                if text and any(map(str.isalpha, text)):
                    found[at + i] = (self.languages[top[i]], float(score[i]), bool(far[i]))
        return found


def normalise(text: str | None) -> bytes:
    words = (text or "").lower().encode().translate(_LETTERS).split()
    return b" %b " % b" ".join(words) if words else b""


def _length_class(counts: np.ndarray, classes: int) -> np.ndarray:
    """Half powers of two of the different n-grams."""
    return np.minimum((2 * np.log2((counts > 0).sum(1) + 1)).astype(int), classes - 1)


def pieces(text: bytes) -> list[bytes]:
    """Of a normal text, a run of whole words for each power of two of bytes below its length; words without end are cut."""
    words, found, size = text[1:-1], [], 2
    while size < min(len(words), MAX_PIECE + 1):
        at = zlib.crc32(words) % (len(words) - size)
        start = words.find(b" ", at, at + size + 32) + 1 or at
        end = words.find(b" ", start + size - 1, start + size + 32)
        if end < 0:
            end = start + size if start + size + 32 < len(words) else len(words)
        piece = words[start:end].decode(errors="ignore").strip().encode()
        if piece:
            found.append(b" %b " % piece)
        size *= 2
    return found


def floors(lengths: np.ndarray, cosines: np.ndarray) -> np.ndarray:
    """The least cosine of each length class that is not too far: all zero if fewer than FLOOR_COSINES are known."""
    floor = np.zeros(LENGTHS, np.float32)
    if len(cosines) >= FLOOR_COSINES:
        for length in range(LENGTHS):
            away = np.abs(lengths - length)
            near = away <= np.partition(away, FLOOR_COSINES - 1)[FLOOR_COSINES - 1]
            floor[length] = np.quantile(cosines[near], REJECT_SHARE)
    return floor


def _vector_batches(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # a batch of short texts has many, and each has dims counts
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            some = batch.slice(at, BLOCK_ROWS)
            texts = [normalise(t) for t in some.column(1).to_pylist()]
            rows = [row.astype("<u2").tobytes() for row in np.minimum(gram_counts(texts, dims, SIZES), 65_535)]
            short = pa.array([pieces(t) for t in texts], pa.list_(pa.binary()))
            yield pa.record_batch([some.column(0), pa.array(rows, pa.binary()), short], ["lang", "counts", "pieces"])


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    counts = np.empty((len(column), dims), np.float32)
    for row, x in zip(counts, column, strict=True):
        row[:] = np.frombuffer(x.as_buffer(), "<u2")
    return counts


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """weighted() of many rows, with the room of a block beside the result."""
    vectors = np.empty_like(counts)
    for at in range(0, len(counts), BLOCK_ROWS):
        vectors[at : at + BLOCK_ROWS] = weighted(counts[at : at + BLOCK_ROWS], idf)
    return vectors


def cluster(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means of rows of length one: up to k centroids of length one, without chance."""
    mean = rows.mean(0)
    chosen = [int((rows @ mean).argmax())]
    nearest = rows @ rows[chosen[0]]
    while len(chosen) < min(k, len(rows)):
        # next is a row that lies far from all so far, but not among the farthest few: those are odd ones
        order = np.argsort(nearest, kind="stable")
        chosen.append(int(order[len(order) // 20]))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
    centroids = rows[chosen]
    for _ in range(rounds):
        of = (rows @ centroids.T).argmax(1)
        sums = np.stack([rows[of == i].sum(0) if (of == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def held_out_cosines(
    counts: np.ndarray, vectors: np.ndarray, short: list[list[bytes]], idf: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Length classes and best cosines of a language's texts and their pieces, each half against centroids of the other."""
    lengths, cosines = [np.zeros(0, int)], [np.zeros(0, np.float32)]
    for half in range(2) if len(vectors) > 1 else ():
        centers = cluster(vectors[1 - half :: 2], k)
        lengths.append(_length_class(counts[half::2], LENGTHS))
        cosines.append((vectors[half::2] @ centers.T).max(1))
        texts = [p for own in short[half::2] for p in own]
        for at in range(0, len(texts), BLOCK_ROWS):
            some = gram_counts(texts[at : at + BLOCK_ROWS], len(idf), SIZES)
            lengths.append(_length_class(some, LENGTHS))
            cosines.append((weighted(some, idf) @ centers.T).max(1))
    return np.concatenate(lengths), np.concatenate(cosines)


def fit(
    docs: DataFrame,
    learn: Column | None = None,
    label: str = "lang",
    dims: int = DIMS,
    centroids: int = CENTROIDS,
    per_language: int = PER_LANGUAGE,
    max_texts: int = MAX_TEXTS,
    max_centroids: int = MAX_CENTROIDS,
) -> LanguageModel:
    """A model of the languages of docs' rows for which learn holds."""
    known = F.col(label).isNotNull() & F.col("text").isNotNull()
    rows = docs.where(known if learn is None else known & learn)
    rows = rows.select(F.col(label).cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sample, totals = labelled_sample(rows, "lang", per_language, max_texts)
    vectors = materialise(
        map_batches(sample.select("lang", "text"), lambda b: _vector_batches(b, dims), "lang string, counts binary, pieces array<binary>"), "lang-vectors"
    )
    per_lang = max(1, min(centroids, max_centroids // max(1, len(totals))))

    def frequencies(key: tuple, table: pa.Table) -> pa.Table:
        seen = (_matrix(table.column("counts"), dims) > 0).sum(0)
        return pa.table({"n": pa.array([table.num_rows], pa.int64()), "seen": pa.array([seen.astype("<i8").tobytes()], pa.binary())})

    found = vectors.select("lang", "counts").groupBy("lang").applyInArrow(frequencies, "n long, seen binary").collect()
    texts = sum(r["n"] for r in found)
    seen = sum((np.frombuffer(r["seen"], "<i8") for r in found), np.zeros(dims, np.int64))
    idf = np.log((texts + 1) / (seen + 1)).astype(np.float32) + np.float32(0.05)

    def clusters(key: tuple, table: pa.Table) -> pa.Table:
        counts = _matrix(table.column("counts"), dims)
        used = counts.any(1)
        if not used.any():
            return pa.table({"lang": pa.array([], pa.string()), "centroids": pa.array([], pa.binary()), "lengths": pa.array([], pa.binary()), "cosines": pa.array([], pa.binary())})
        counts = counts[used]
        vectors = _vectors(counts, idf)
        centers = cluster(vectors, per_lang)
        short = [p for p, u in zip(table.column("pieces").to_pylist(), used, strict=True) if u]
        lengths, cosines = held_out_cosines(counts, vectors, short, idf, per_lang)
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()]),
                "centroids": pa.array([centers.astype("<f4").tobytes()], pa.binary()),
                "lengths": pa.array([lengths.astype("<i4").tobytes()], pa.binary()),
                "cosines": pa.array([cosines.astype("<f4").tobytes()], pa.binary()),
            }
        )

    fitted = vectors.groupBy("lang").applyInArrow(clusters, "lang string, centroids binary, lengths binary, cosines binary")
    fitted = sorted(fitted.collect(), key=lambda r: r["lang"])
    if not fitted:
        return LanguageModel([], np.zeros((0, dims), np.float32), np.zeros(0, int), idf, np.zeros(LENGTHS, np.float32))
    parts = [np.frombuffer(r["centroids"], "<f4").reshape(-1, dims) for r in fitted]
    lengths = np.concatenate([np.frombuffer(r["lengths"], "<i4") for r in fitted])
    cosines = np.concatenate([np.frombuffer(r["cosines"], "<f4") for r in fitted])
    of = np.concatenate([np.full(len(p), i) for i, p in enumerate(parts)])
    return LanguageModel([r["lang"] for r in fitted], np.concatenate(parts), of, idf, floors(lengths, cosines))


def _predict_batches(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        found = model.value.predict(batch.column(names.index("text")).to_pylist())
        columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
        kept = [i for i, n in enumerate(names) if n != "text"]
        yield pa.record_batch([*(batch.column(i) for i in kept), *columns], [*(names[i] for i in kept), "lang_pred", "score", "rejected"])


def _keep_batches(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = model.value.predict(batch.column(batch.schema.names.index("text")).to_pylist())
        yield batch.filter(pa.array([not f[2] for f in found], pa.bool_()))


def predict(docs: DataFrame, model: LanguageModel, *kept: str) -> DataFrame:
    """The columns kept (not text), lang_pred, score and rejected of every row of docs, which needs text."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*kept, F.col("text").cast("string").alias("text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    return map_batches(rows, lambda b: _predict_batches(b, held), ", ".join([*fields, "lang_pred string", "score double", "rejected boolean"]))


def keep_known(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of docs, with all their columns, that the model does not reject."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return map_batches(docs, lambda b: _keep_batches(b, held), docs.schema)
