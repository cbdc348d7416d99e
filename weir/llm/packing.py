"""Packing documents into token windows by multiway differencing (Karmarkar-Karp).

A document's ids are cut at multiples of the capacity; full pieces are windows of their own. What remains of each
document, all of it if it fits a window, joins a batch of bounded size whole: no document that fits is cut. Within a batch, partial partitions (one multiset of window sums each) are
merged in order of their spread, the largest sums of one with the smallest of the other, so that opposing imbalances
cancel. If a window then exceeds the capacity, the window count rises and the batch is differenced again.

Everything is one narrow pass over the documents, without a shuffle (but for files of a few MB, see spread()): a batch never spans two partitions of the scan,
and what it holds is bounded by its window count, whatever the size of a document or of the corpus. A task that is
run again meets the same rows in the same order and gives the same windows.

Defined cases: a null or empty text is one piece that holds only the end id; repeated rows are packed each on its
own; of partial partitions of equal spread the one made first is merged first, so that ties give the same windows again;
a text of any length is tokenized in parts, and its full pieces leave as they are cut; an empty table gives no windows;
other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import map_batches, text_bytes
from weir.llm.tokens import default_tokenizer, encoder
from weir.operators.spread import spread

CAPACITY = 4096
END_ID = 2
BATCH_WINDOWS = 192
#: Input file bytes that a task should have at least, for its last batch to be a small part of its windows.
SPREAD_BYTES = 4 << 20

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "padding long"
)


def difference(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """The window of each item, and the windows' sums, after differencing all items into so many windows.

    A partial partition is a descending array of its non-zero sums beside the nodes that stand for the items summed;
    sums of zero are not stored.
    """
    nodes = len(sizes)
    merged: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    heap = [(-int(s), i, np.array([s], np.int64), np.array([i], np.int64)) for i, s in enumerate(sizes)]
    if windows == 1:
        return np.zeros(len(sizes), np.int64), np.array([sizes.sum()], np.int64)
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, a, a_node = heapq.heappop(heap)
        _, _, b, b_node = heapq.heappop(heap)
        both = len(a) + len(b) - windows
        if both <= 0:
            sums, node = np.concatenate((a, b)), np.concatenate((a_node, b_node))
        else:
            # position i gets the i-th largest of a and the i-th smallest of b, of which windows - len(b) are zero
            free = windows - len(b)
            rising, rising_node = b[::-1], b_node[::-1]
            new = np.arange(nodes, nodes + both)
            nodes += both
            merged.append((new, a_node[free:], rising_node[:both]))
            sums = np.concatenate((a[:free], a[free:] + rising[:both], rising[both:]))
            node = np.concatenate((a_node[:free], new, rising_node[both:]))
        order = np.argsort(-sums, kind="stable")
        sums, node = sums[order], node[order]
        low = sums[-1] if len(sums) == windows else 0
        heapq.heappush(heap, (int(low - sums[0]), tie, sums, node))
        tie += 1
    _, _, sums, node = heap[0]
    of = np.zeros(nodes, np.int64)
    of[node] = np.arange(len(node))
    for new, left, right in reversed(merged):
        of[left] = of[new]
        of[right] = of[new]
    return of[: len(sizes)], sums


def pack(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """difference() into the fewest windows, from the least possible number on, that all hold at most the capacity."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        of, sums = difference(sizes, windows)
        if sums.max() <= capacity:
            return of, sums
        windows += 1


def _padding(length: int, capacity: int) -> int:
    return 0 if length & (length - 1) == 0 else capacity - length


def _pack_batches(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, batch_windows: int
) -> Iterator[pa.RecordBatch]:
    encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
    sequence = TaskContext.get().partitionId() << 33
    out: list[tuple] = []
    rest: list[tuple] = []
    rest_tokens = 0

    def close() -> None:
        nonlocal rest, rest_tokens, sequence
        of, sums = pack(np.array([r[2] for r in rest], np.int64), capacity)
        offsets = [0] * len(sums)
        pads = [_padding(int(s), capacity) for s in sums]
        for r, w in zip(rest, of.tolist(), strict=True):
            out.append((*r, sequence + w, offsets[w], pads[w]))
            offsets[w] += r[2]
        sequence += len(sums)
        rest, rest_tokens = [], 0

    def flush() -> pa.RecordBatch:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        rows = pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)
        out.clear()
        return rows

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            ids = memoryview(encode(text) + end)
            tokens, start = len(ids) // 4, 0
            while start < tokens:
                full = tokens - start >= capacity
                length = capacity if full else tokens - start
                piece = (doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), tokens)
                if full:
                    out.append((*piece, sequence, 0, 0))
                    sequence += 1
                else:
                    rest.append(piece)
                    rest_tokens += length
                    if rest_tokens >= batch_windows * capacity:
                        close()
                start += length
            if len(out) >= 10_000:
                yield flush()
    if rest:
        close()
    if out:
        yield flush()


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    batch_windows: int = BATCH_WINDOWS,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its window, and the window's padding.

    Window ids are unique and stable for a given scan, but not dense. docs needs doc_id (integer) and text.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = spread(rows, F.col("doc_id"), F.xxhash64("text"), F.col("text"), task_bytes=SPREAD_BYTES)
    return map_batches(rows, lambda b: _pack_batches(b, path, end_id, capacity, batch_windows), SCHEMA, ordered=True)
