"""SimHash near-duplicates with a Gray-order hierarchical index.

A fingerprint has a bit for each bit that is set in over half the hashes of a document's word shingles. Equal
fingerprints collapse first, so that a group of exact copies is one node from then on. Two distinct fingerprints that
differ in at most k bits agree on at least one of k + 1 blocks of bits; nodes that agree on a block are searched
together, and blocks that very many nodes share are split again, by sub-blocks of the bits left, which loses no link.

Within such a group the fingerprints are sorted by their rank in Gray order, which keeps those of few differences close.
Runs of neighbours are factored into upper nodes, each a mask of the bits that all its members share beyond what its
ancestors share, and the pattern of those bits. A query accumulates its differences from the root down and leaves a
whole group as soon as they exceed k; it also leaves groups that it is already linked to. What comes out is a spanning
forest of a group's links, not its pairs.

A fingerprint may have several words, of 64 bits each, from as many mixtures of the same shingle hashes. Texts that are
alike by chance come close in one word, seldom in the others, so that several words find more of what is alike within
few bits a word, and fewer false links: in each word, texts that agree in it are one class, of which that of the least
node stands for all; classes link if they differ in at most max_bits bits of the word, and those that stand for them in at
most check_bits of the next two words. One word alone, the default, has no others to check.

A node is a fingerprint (of several words: their hash), never a doc_id: ids may be null or repeated, fingerprints are
not. Components are found by alternating star contractions over those links, each round a written table: the links and
labels stay distributed. A contraction joins links with one minimum a node, so a node of very many links is a skewed
join side that Spark may split, never one task's list.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; repeated rows share a
fingerprint; rows are linked by their texts alone, so that two texts of one repeated doc_id are two documents; a null
doc_id links others like any other, but is never the smallest: a component of null ids alone has a null component_id;
differences of exactly max_bits link; a text of any length is read whole, by one worker, in pieces of 65,536 shingles;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import by_size, map_batches, materialise, moved_bytes, text_bytes

SHINGLE = 3
SEED = 42
MAX_BITS = 2
FANOUT = 16
#: Of the two words that follow, of 128 bits, so many may differ.
CHECK_BITS = 20
CHECK_WORDS = 2
#: Groups of more nodes than this are split by a further block.
GROUP_NODES = 20_000
MAX_ROUNDS = 60

_ALL = (1 << 64) - 1


def _shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    cuts = zip(starts, ends[shingle - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in cuts), np.uint64, len(words) - shingle + 1)


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """The hashes that a further word is made of; those of word 0 are the shingles' own."""
    if not word:
        return hashes
    with np.errstate(over="ignore"):
        z = hashes + np.uint64(0x9E3779B97F4A7C15 * word & _ALL)
        z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


def fingerprint_words(text: bytes, shingle: int = SHINGLE, words: int = 1) -> list[int]:
    """The fingerprint of a text in UTF-8, in words of 64 bits."""
    hashes = _shingle_hashes(text, shingle)
    ones = np.zeros((words, 64), np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        for word in range(words):
            octets = _mixed(part, word).astype("<u8", copy=False).view(np.uint8)
            ones[word] += np.unpackbits(octets, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), axis=1, bitorder="little").view("<u8").ravel().tolist()


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text in UTF-8."""
    return fingerprint_words(text, shingle)[0]


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_bytes(batch.column(1))
        found = np.array([fingerprint_words(t, shingle, len(names)) for t in texts], np.uint64).reshape(-1, len(names))
        yield pa.record_batch([batch.column(0), *(pa.array(w) for w in np.ascontiguousarray(found.T).view(np.int64))], ["doc_id", *names])


def _names(words: int) -> list[str]:
    return ["bits", *(f"bits{n}" for n in range(1, words))]


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, words: int = 1) -> DataFrame:
    """doc_id and bits, bits1, ...: the words of the fingerprint as signed longs."""
    rows, names = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), _names(words)
    return map_batches(rows, lambda b: _fingerprint_batches(b, shingle, names), ", ".join(f"{n} long" for n in ["doc_id", *names]))


def gray_rank(bits: np.ndarray) -> np.ndarray:
    """The place of each 64-bit code in the reflected Gray sequence."""
    rank = bits.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Levels of nodes over fingerprints in Gray order; the last level has the fingerprints themselves."""

    def __init__(self, bits: np.ndarray, fanout: int = FANOUT):
        self.order = np.argsort(gray_rank(bits), kind="stable")
        self.bits, self.fanout = bits[self.order], fanout
        shared = [(np.full(len(bits), _ALL, np.uint64), self.bits)]
        while len(shared[0][0]) > 1:
            mask, pattern = shared[0]
            starts = np.arange(0, len(mask), fanout)
            one = np.bitwise_and.reduceat(pattern, starts)
            differ = one ^ np.bitwise_or.reduceat(pattern, starts)
            shared.insert(0, (np.bitwise_and.reduceat(mask, starts) & ~differ, one))
        # an upper node keeps the pattern; its children keep only what they share beyond it
        self.levels = []
        for depth, (mask, pattern) in enumerate(shared):
            if depth:
                mask = mask & ~np.repeat(shared[depth - 1][0], fanout)[: len(mask)]
            self.levels.append((mask, pattern))

    def links(self, max_bits: int, chunk: int = 1024, checks: np.ndarray | None = None, check_bits: int = 0) -> Iterator[tuple[int, int]]:
        """Pairs of positions (in the order given) that differ in at most max_bits bits, and in at most check_bits of
        their rows of checks: a spanning forest of them all."""
        n = len(self.bits)
        checks = None if checks is None else checks[self.order]
        root = np.arange(n)
        for at in range(0, n, chunk):
            query = np.arange(at, min(n, at + chunk))
            uniform = self._uniform(root)
            q, node, far = query, np.zeros(len(query), np.int64), np.zeros(len(query), np.int64)
            for depth, (mask, pattern) in enumerate(self.levels):
                if depth:
                    width = self.fanout
                    node = (node[:, None] * width + np.arange(width)).ravel()
                    q, far = np.repeat(q, width), np.repeat(far, width)
                    real = node < len(mask)
                    q, node, far = q[real], node[real], far[real]
                far = far + np.bitwise_count((self.bits[q] ^ pattern[node]) & mask[node])
                near = (far <= max_bits) & (uniform[depth][node] != root[q])
                q, node, far = q[near], node[near], far[near]
            later = node > q
            q, node = q[later], node[later]
            if checks is not None:
                near = np.bitwise_count(checks[q] ^ checks[node]).sum(1) <= check_bits
                q, node = q[near], node[near]
            for a, b in zip(q.tolist(), node.tolist(), strict=True):
                x, y = _find(root, a), _find(root, b)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    yield int(self.order[a]), int(self.order[b])
            while (root[root] != root).any():
                root = root[root]

    def _uniform(self, root: np.ndarray) -> list[np.ndarray]:
        """For each level, the component that all members of a node are in; -1 if they are in several."""
        found = [root]
        for mask, _ in self.levels[-2::-1]:
            starts = np.arange(0, len(found[0]), self.fanout)
            low, high = np.minimum.reduceat(found[0], starts), np.maximum.reduceat(found[0], starts)
            found.insert(0, np.where(low == high, low, -1))
        return found


def _find(root: np.ndarray, x: int) -> int:
    while root[x] != x:
        x = root[x]
    return x


def _block_masks(free: int, blocks: int) -> list[int]:
    """Masks that cut the set bits of free into so many about equal blocks."""
    bits = [b for b in range(64) if free >> b & 1]
    return [sum(1 << b for b in part) for part in (bits[len(bits) * i // blocks : len(bits) * (i + 1) // blocks] for i in range(blocks))]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _link_batches(batches: Iterator[pa.RecordBatch], max_bits: int, check_bits: int, fanout: int) -> Iterator[pa.RecordBatch]:
    """Rows (word, mask, value, bits, node, checks) sorted by the first three: the links of each group. A group may span batches."""
    held: list[np.ndarray] = []

    def search(rows: np.ndarray) -> pa.RecordBatch | None:
        if len(rows) < 2:
            return None
        bits, checks = rows[:, 3].copy().view(np.uint64), rows[:, 5:].copy().view(np.uint64) if rows.shape[1] > 5 else None
        # what fits one upper node has nothing to prune by: most groups end here
        if len(rows) <= fanout and (np.bitwise_count(bits[:, None] ^ bits) <= max_bits).sum() == len(rows):
            return None
        pairs = list(GrayIndex(bits, fanout).links(max_bits, checks=checks, check_bits=check_bits))
        if not pairs:
            return None
        a, b = rows[[p[0] for p in pairs], 4], rows[[p[1] for p in pairs], 4]
        return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["u", "v"])

    for batch in batches:
        if not len(batch):
            continue
        rows = np.stack([c.to_numpy() for c in batch.columns], 1)
        cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(1)) + 1
        parts = np.split(rows, cuts)
        if held and (held[-1][-1, :3] != rows[0, :3]).any():
            if (found := search(np.concatenate(held))) is not None:
                yield found
            held = []
        for part in parts[:-1]:
            if held or len(part) > 1:
                if (found := search(np.concatenate([*held, part]))) is not None:
                    yield found
            held = []
        held.append(parts[-1])
    if held and (found := search(np.concatenate(held))) is not None:
        yield found


def _classes(nodes: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """(word, bits, node, check0, ...), a row for each value of each word, and the links (u, v) of nodes that agree in a word."""
    if len(names) == 1:
        return nodes.select(F.lit(0).cast("long").alias("word"), "bits", "node"), None
    checks = min(CHECK_WORDS, len(names) - 1)

    def of(word: int):
        others = (F.col(names[(word + 1 + n) % len(names)]).alias(f"check{n}") for n in range(checks))
        return F.struct(F.lit(word).cast("long").alias("word"), F.col(names[word]).alias("bits"), F.struct("node", *others).alias("one"))

    rows = nodes.select(F.explode(F.array(*(of(w) for w in range(len(names))))).alias("of")).select("of.*")
    found = materialise(rows.groupBy("word", "bits").agg(F.min("one").alias("one"), F.count(F.lit(1)).alias("n")), "classes")
    shared = found.where("n > 1").select("word", "bits", F.col("one.node").alias("u"))
    agree = rows.select("word", "bits", F.col("one.node").alias("v")).join(shared, ["word", "bits"]).where("u <> v").select("u", "v").distinct()
    return found.select("word", "bits", "one.*"), agree


def links(
    nodes: DataFrame, max_bits: int = MAX_BITS, words: int = 1, check_bits: int = CHECK_BITS, fanout: int = FANOUT, group_nodes: int = GROUP_NODES
) -> DataFrame:
    """(u, v), u < v: pairs of nodes (node, bits, bits1, ...) that connect whatever nodes the links of the fingerprints connect."""
    if group_nodes < 2 << max_bits:
        raise ValueError("a group has at least as many nodes as max_bits + 1 bits can tell apart")
    classes, agree = _classes(nodes, _names(words))
    held = [c for c in classes.columns if c not in ("word", "bits")]
    group = ["word", "mask", "value"]

    def blocked(rows: DataFrame, masks: list[int]) -> DataFrame:
        keys = F.explode(F.array(*(F.lit(_signed(m)).cast("long") for m in masks)))
        return rows.select("word", "bits", *held, keys.alias("mask")).withColumn("value", F.col("bits").bitwiseAND(F.col("mask")))

    rows, done = blocked(classes, _block_masks(_ALL, max_bits + 1)), []
    while True:  # each round fixes a part of the bits left: a group of few bits left has few values
        sizes = rows.groupBy(*group).count().where(F.col("count") > group_nodes)
        hot = materialise(sizes.select(*group), "hot-blocks")
        masks = [r["mask"] for r in hot.select("mask").distinct().collect()]  # no more than blocks, not nodes
        if not masks:
            break
        done.append(rows.join(hot, group, "left_anti"))
        own = rows.join(hot, group, "left_semi")
        split = []
        for m in masks:
            free = _ALL & ~(m & _ALL)
            split.append(blocked(own.where(F.col("mask") == m), [(m & _ALL) | s for s in _block_masks(free, max_bits + 1)]))
        rows = split[0]
        for more in split[1:]:
            rows = rows.union(more)
        rows = materialise(rows, "split-blocks")
    done.append(rows)
    every = done[0].select(*group, "bits", *held)
    for more in done[1:]:
        every = every.union(more.select(*group, "bits", *held))
    n = by_size(nodes.sparkSession, moved_bytes(nodes, words * (max_bits + 1)))
    grouped = (every.repartition(n, *group) if n else every.repartition(*group)).sortWithinPartitions(*group)
    found = map_batches(grouped, lambda b: _link_batches(b, max_bits, check_bits, fanout), "u long, v long", ordered=True).distinct()
    return found if agree is None else found.union(agree)


def _sums(edges: DataFrame) -> tuple:
    """One row that tells two sets of edges apart."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of an edge (u, v) can reach, by star contractions."""
    edges = materialise(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        # large star: larger neighbours of a node move to its smallest neighbour, itself included
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")).withColumnRenamed("u", "at")
        large = both.join(low, both["u"] == low["at"]).where("v > u").select(F.col("low").alias("u"), "v").where("u <> v").distinct()
        # small star: each node's smaller neighbours, and the node, move to the smallest of them
        least = large.groupBy(F.col("v").alias("at")).agg(F.min("u").alias("low"))
        moved = large.join(least, large["v"] == least["at"]).select(F.col("low").alias("a"), F.explode(F.array("u", "v")).alias("b"))
        small = materialise(moved.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges")
        if _sums(small) == _sums(edges):
            return small.select(F.col("v").alias("node"), F.col("u").alias("root"))
        edges = small
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE, words: int = 1, **options) -> DataFrame:
    """doc_id, bits, component_id: the smallest doc_id that is linked to a document, directly or over others."""
    names = _names(words)
    node = F.col("bits") if words == 1 else F.xxhash64(*names)
    prints = materialise(fingerprints(docs, shingle, words).withColumn("node", node), "fingerprints")
    nodes = materialise(prints.groupBy("node", *names).agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected(links(nodes.select("node", *names), max_bits, words, **options)).withColumnRenamed("node", "linked")
    rooted = nodes.join(roots, nodes["node"] == roots["linked"], "left").select("node", "least", F.coalesce("root", "node").alias("of_root"))
    least = rooted.groupBy(F.col("of_root").alias("least_root")).agg(F.min("least").alias("component_id"))
    of = rooted.join(least, rooted["of_root"] == least["least_root"]).select(F.col("node").alias("of_node"), "component_id")
    return prints.join(of, prints["node"] == of["of_node"]).select("doc_id", "bits", "component_id")


def fingerprint_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id."""
    rows = near_duplicates(docs, **options)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
