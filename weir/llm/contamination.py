"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

The normal form of a text is its words (a-z after lower-casing A-Z, digits and everything beyond ASCII), each between
single spaces. A window is ten consecutive words of a benchmark item, or all of an item of fewer. Any window holds one
of the item's blocks of five words, cut one after the other from its first word; the blocks of all items, and the items
that are windows of their own, are the patterns of one automaton, kept by each worker. Each document's normal form is
scanned once; a block that is found is extended to both sides as far as the document's words are the item's, and if that
makes a window, all its words are hit. The place in words gives the place in the original text.

The automaton's nodes are as many as the items' characters, and a worker holds those of max_pattern_chars at a time. For
a larger benchmark the documents are still read once, by one narrow pass: a bitmap of the patterns' hashes, of a bounded
size, lets through the documents that may have one, and these, held up to a bound of bytes, meet one automaton after the
other in memory. Broadcast is the benchmark's text, with its bitmap, up to max_benchmark_bytes; only beyond that is there
a pass for each so many bytes, with a written table of the documents' hits between passes.

Defined cases: a null or empty text has no words, no hits and no items; repeated documents are scanned each on its
own; of repeated item_ids each counts once; a null item_id is named "null"; of equal items at one place all count; an
empty benchmark hits nothing; a text of any length is scanned whole, by one worker, and an item longer than an automaton
may be is cut to parts that overlap by a window; other columns of either input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import map_batches, materialise, text_bytes

WINDOW = 10
#: Characters of items in one automaton: about 50 bytes of memory each.
MAX_PATTERN_CHARS = 2_000_000
#: Bytes of items that are broadcast at once.
MAX_BENCHMARK_BYTES = 64 << 20
#: Bits of the bitmap for each pattern, and in all at most.
PATTERN_BITS, MAX_BITMAP_BITS = 16, 1 << 28
#: Bytes of documents that are held to meet one automaton after the other.
HELD_BYTES = 32 << 20

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

SCHEMA = "doc_id long, text string, n_words long, hits binary, items array<string>"


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def block_words(window: int) -> int:
    """The longest block of which any window, wherever it begins, holds one of those cut one after the other."""
    return (window + 1) // 2


def _patterns(items: list[tuple[str, list[bytes]]], window: int) -> Iterator[tuple[int, int, int]]:
    """(item's place, first word, number of words) of the patterns of items."""
    block = block_words(window)
    for place, (_, words) in enumerate(items):
        if len(words) < window:
            yield place, 0, len(words)
        else:
            for at in range(0, len(words) - block + 1, block):
                yield place, at, block


class _Seeds:
    """The automaton of some items, and their words to extend what it finds."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.items, self.window = items, window
        owners: dict[str, tuple[int, list[tuple[int, int]]]] = {}
        for place, at, n in _patterns(items, window):
            pattern = f" {b' '.join(items[place][1][at : at + n]).decode('latin-1')} "
            owners.setdefault(pattern, (n, []))[1].append((place, at))
        self.automaton = ahocorasick.Automaton()
        for pattern, owned in owners.items():
            self.automaton.add_word(pattern, owned)
        if owners:
            self.automaton.make_automaton()

    def add(self, words: list[bytes], hit: np.ndarray | None, names: set[str]) -> np.ndarray | None:
        """hit with the words of windows found; names gets their items."""
        if not words or not len(self.automaton):
            return hit
        normal = f" {b' '.join(words).decode('latin-1')} "
        matches = [(end, n, owned) for end, (n, owned) in self.automaton.iter(normal)]
        if not matches:
            return hit
        spaces = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 0x20)
        lasts = np.searchsorted(spaces, [m[0] for m in matches]).tolist()  # a match's words: from last - n up to last
        done: dict[tuple[int, int], int] = {}  # up to which word an item, laid along the document, is compared
        for last, (_, n, owned) in zip(lasts, matches, strict=True):
            first = last - n
            for place, at in owned:
                along = place, first - at
                if first < done.get(along, 0):
                    continue
                name, item = self.items[place]
                low, high = first, last
                if len(item) >= self.window:
                    while low > 0 and low - along[1] > 0 and words[low - 1] == item[low - 1 - along[1]]:
                        low -= 1
                    while high < len(words) and high - along[1] < len(item) and words[high] == item[high - along[1]]:
                        high += 1
                    done[along] = high
                    if high - low < self.window:
                        continue
                if hit is None:
                    hit = np.zeros(len(words), bool)
                hit[low:high] = True
                names.add(name)
        return hit


def _cut(item_id: str, words: list[bytes], window: int, max_chars: int) -> Iterator[tuple[str, list[bytes]]]:
    """An item, or parts of at most about max_chars that overlap by a window, so that each window is in one of them."""
    start = 0
    while True:
        end, size = start, 0
        while end < len(words) and (size < max_chars or end - start < 2 * window):
            size += len(words[end]) + 1
            end += 1
        yield item_id, words[start:end]
        if end == len(words):
            return
        start = end - window + 1


def _gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n of the words' hashes."""
    rolled = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n if len(rolled) else 0):
        rolled = (rolled ^ (rolled >> np.uint64(29))) * _MIX + words[i : i + len(rolled)]
    return rolled ^ (rolled >> np.uint64(32))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


@dataclass
class _Benchmark:
    """Items in parts of an automaton each; with more than one part, a bitmap of the patterns of each number of words."""

    parts: list[list[tuple[str, list[bytes]]]]
    window: int
    bitmap: np.ndarray | None = None
    lengths: tuple[int, ...] = ()

    @classmethod
    def of(cls, rows: list[tuple[str, bytes]], window: int, max_chars: int) -> _Benchmark:
        parts: list[list[tuple[str, list[bytes]]]] = [[]]
        size = 0
        for item_id, text in rows:
            if words := normal_words(text):
                for piece in _cut(item_id, words, window, max_chars):
                    own = sum(map(len, piece[1])) + len(piece[1])
                    if parts[-1] and size + own > max_chars:
                        parts.append([])
                        size = 0
                    parts[-1].append(piece)
                    size += own
        made = cls(parts, window)
        if len(parts) > 1:
            made._fill()
        return made

    def _fill(self) -> None:
        hashes: dict[int, list[np.ndarray]] = {}
        block = block_words(self.window)
        for part in self.parts:
            for _, words in part:
                own = _word_hashes(words)
                if len(words) < self.window:
                    hashes.setdefault(len(words), []).append(_gram_hashes(own, len(words)))
                else:
                    hashes.setdefault(block, []).append(_gram_hashes(own, block)[::block])
        every = np.concatenate([h for own in hashes.values() for h in own])
        bits = min(MAX_BITMAP_BITS, 1 << max(10, int(len(every) * PATTERN_BITS).bit_length()))
        self.bitmap, self.lengths = np.zeros(bits >> 3, np.uint8), tuple(sorted(hashes))
        at = every & np.uint64(bits - 1)
        np.bitwise_or.at(self.bitmap, at >> np.uint64(3), np.left_shift(1, at & np.uint64(7)).astype(np.uint8))

    def may_hit(self, words: list[bytes]) -> bool:
        """False only for a text in which no pattern occurs."""
        own = _word_hashes(words)
        for n in self.lengths:
            at = _gram_hashes(own, n) & np.uint64(8 * len(self.bitmap) - 1)
            if (self.bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).any():
                return True
        return False


#: The worker's last automaton, with the broadcast items that it was built from.
_built: list = []


def _seeds(items: list, window: int) -> _Seeds:
    if not _built or _built[0] is not items or _built[1].window != window:
        _built.clear()  # before the next is built: one at a time
        _built[:] = [items, _Seeds(items, window)]
    return _built[1]


_Found = tuple[int, np.ndarray | None, set[str]]


def _found(batches: Iterator[pa.RecordBatch], broadcast) -> Iterator[tuple[pa.RecordBatch, list[_Found]]]:
    """Each batch (with a column text) and, of each of its texts, the number of words, the words hit, and the items."""
    benchmark: _Benchmark = broadcast.value
    held: list[tuple[pa.RecordBatch, list[_Found], list[tuple[int, list[bytes]]]]] = []
    size = 0

    def meet() -> Iterator[tuple[pa.RecordBatch, list[_Found]]]:
        nonlocal size
        for part in benchmark.parts:
            if any(some for _, _, some in held):
                seeds = _seeds(part, benchmark.window)
                for _, found, some in held:
                    for row, words in some:
                        n, hit, names = found[row]
                        found[row] = n, seeds.add(words, hit, names), names
        yield from ((batch, found) for batch, found, _ in held)
        held.clear()
        size = 0

    for batch in batches:
        found: list[_Found] = []
        some: list[tuple[int, list[bytes]]] = []
        for row, text in enumerate(text_bytes(batch.column(batch.schema.names.index("text")))):
            words = normal_words(text)
            found.append((len(words), None, set()))
            if words and (benchmark.bitmap is None or benchmark.may_hit(words)):
                some.append((row, words))
                size += len(text)
        held.append((batch, found, some))
        size += batch.nbytes
        if benchmark.bitmap is None or size >= HELD_BYTES:
            yield from meet()
    yield from meet()


def _scan_batches(batches: Iterator[pa.RecordBatch], broadcast) -> Iterator[pa.RecordBatch]:
    for batch, found in _found(batches, broadcast):
        before = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        all_hits, all_items = [], []
        for (n, hit, names), hits, items in zip(found, *before, strict=True):
            if hit is not None and hits is not None:
                hit |= np.unpackbits(np.frombuffer(hits, np.uint8), count=n).astype(bool)
            all_hits.append(hits if hit is None else np.packbits(hit).tobytes())
            all_items.append(sorted({*(items or ()), *names}) or None)
        yield pa.record_batch(
            [
                batch.column(0),
                batch.column(1),
                pa.array([f[0] for f in found], pa.int64()),
                pa.array(all_hits, pa.binary()),
                pa.array(all_items, pa.list_(pa.string())),
            ],
            ["doc_id", "text", "n_words", "hits", "items"],
        )


def _benchmarks(benchmark: DataFrame, window: int, max_chars: int, max_bytes: int) -> Iterator[_Benchmark]:
    """The items, as many at once as max_bytes allows, one long item apart: the driver never holds more."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // max_bytes))
    for part in range(n):
        rows = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == part)
        yield _Benchmark.of(sorted((r[0], r[1].encode()) for r in rows.collect()), window, max_chars)


def _state(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lit(None).cast("binary").alias("hits"),
        F.lit(None).cast("array<string>").alias("items"),
    )


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_pattern_chars: int = MAX_PATTERN_CHARS, max_benchmark_bytes: int = MAX_BENCHMARK_BYTES
) -> DataFrame:
    """doc_id, text, n_words, hits (bits of the words hit, null if none) and items (sorted, null if none)."""
    return _scanned(docs, benchmark, window, max_pattern_chars, max_benchmark_bytes, lambda batches: batches, SCHEMA)


def _scanned(docs: DataFrame, benchmark: DataFrame, window: int, max_chars: int, max_bytes: int, then, schema: str) -> DataFrame:
    """The scan's rows after then, a function of batches, in the same pass over the texts."""
    state, before = _state(docs), None
    for part in _benchmarks(benchmark, window, max_chars, max_bytes):
        if before is not None:
            state = materialise(map_batches(state, lambda b, held=before: _scan_batches(b, held), SCHEMA), "contamination").select("doc_id", "text", "hits", "items")
        before = docs.sparkSession.sparkContext.broadcast(part)
    return map_batches(state, lambda b: then(_scan_batches(b, before)), schema)


def hit_spans(text: str | None, hits: bytes | None) -> list[tuple[int, int]]:
    """Runs of hit words as code point offsets, end exclusive, in the original text."""
    if not hits:
        return []
    words = [m.span() for m in _WORD.finditer(text or "")]
    edge = np.diff(np.concatenate(([0], np.unpackbits(np.frombuffer(hits, np.uint8), count=len(words)), [0])).astype(int))
    return [(words[a][0], words[b - 1][1]) for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0), strict=True)]


def _report_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        n_hit, spans, digests, n_items = [], [], [], []
        for text, hits, items in zip(*(batch.column(i).to_pylist() for i in (1, 3, 4)), strict=True):
            n_hit.append(sum(map(int.bit_count, hits)) if hits else 0)
            spans.append([{"start": a, "end": b} for a, b in hit_spans(text, hits)])
            n_items.append(len(items or ()))
            digests.append(hashlib.sha256(",".join(items or ()).encode()).hexdigest())
        yield pa.record_batch(
            [
                batch.column(0),
                batch.column(2),
                pa.array(n_hit, pa.int64()),
                pa.array(n_items, pa.int64()),
                pa.array(digests),
                batch.column(4),
                pa.array(spans, pa.list_(span)),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "items", "spans"],
        )


_REPORT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, items array<string>, spans array<struct<start: int, end: int>>"
)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_pattern_chars: int = MAX_PATTERN_CHARS, max_benchmark_bytes: int = MAX_BENCHMARK_BYTES
) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, items and the hit spans of its text."""
    found = _scanned(docs, benchmark, window, max_pattern_chars, max_benchmark_bytes, _report_batches, _REPORT)
    return found.withColumn("contaminated", F.col("n_hit") > 0)


def _clean_batches(batches: Iterator[pa.RecordBatch], broadcast) -> Iterator[pa.RecordBatch]:
    for batch, found in _found(batches, broadcast):
        yield batch.filter(pa.array([hit is None for _, hit, _ in found], pa.bool_()))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_pattern_chars: int = MAX_PATTERN_CHARS, max_benchmark_bytes: int = MAX_BENCHMARK_BYTES
) -> DataFrame:
    """The documents in which no benchmark window occurs, with all their columns; what one pass keeps the next one reads."""
    for n, part in enumerate(_benchmarks(benchmark, window, max_pattern_chars, max_benchmark_bytes)):
        if n:
            docs = materialise(docs, "clean")
        held = docs.sparkSession.sparkContext.broadcast(part)
        docs = map_batches(docs, lambda b, held=held: _clean_batches(b, held), docs.schema)
    return docs
