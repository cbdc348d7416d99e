"""Deleted interpolation: n-gram relative frequencies mixed by the frequency of their context.

The probability of a token w after v is  l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1),  where b is a class of
c(v) by its binary logarithm. The weights of each class are learned by expectation-maximisation on the counts of a
held-out fold of the training documents, against the counts of the training documents without that fold; the counts
used afterwards are those of all training documents. Tokens are words and one end a document; a document's first
token follows its end mark.

How the counts meet the documents: documents are written once, as compressed blocks of bounded size. A block's
distinct unigrams and bigrams, as sorted 64-bit hashes with their training counts, are cut into ranges and dealt to
shards; a shard adds up the counts of all blocks and answers each block with the totals, in the order of its own keys,
so that an answer needs no keys. A block and its answers then meet once, and every token finds its counts by its
place among the block's keys. What is moved grows with the distinct n-grams of a block, not with pairs of any kind,
and a very common word is one key a block. No table of counts is broadcast or collected: the driver gets N, V, and a
histogram of quantised frequencies, bounded by its grid, from which the weights are learned.

Hashes are 64 bits; two n-grams of the same hash would share their counts. Frequencies are quantised (to an eighth of a
power of two) only to learn the weights, never to score.

Defined cases: a null or empty text is one end token; repeated rows count once each; a null doc_id is a training
document outside the fold; without training documents all counts are zero and the model is uniform; without a fold the
weights are equal; ties do not occur, as no order decides anything; a text of any length is one row of a block, which is
then as large as the text; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import dealt, input_bytes, map_batches, materialise, text_bytes

#: Text of a block: the least, and the most where there are so many shards that a block would have few keys for each.
BLOCK_BYTES = 8 << 20
MAX_BLOCK_BYTES = 64 << 20
#: Bytes of text that give a shard so many keys of a block that its message is mostly keys: 64, of about nine bytes of text.
MESSAGE_BYTES = 64 * 9
#: Input file bytes whose keys go to one shard, as long as that makes at most MAX_SHARDS.
SHARD_BYTES = 8 << 20
MAX_SHARDS = 200_000
CLASSES = 24
#: Quantisation of frequencies, in parts of a power of two.
STEPS = 8
ROUNDS = 60

#: Fixed keys for the end of a document, as a token and as a context.
_END = np.uint64(0x5BD1E995_9E3779B9)
_MIX = np.uint64(0x9E3779B97F4A7C15)

SCORED, TRAINED, FOLD = 0, 1, 2


def _pack_ints(values: np.ndarray) -> bytes:
    """Unsigned integers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpack_ints(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack_ints(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpack_ints(blob), dtype=np.uint64)


def _block_batches(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Documents to blocks; the fold's documents have blocks of their own."""
    block = TaskContext.get().partitionId() << 32
    held: dict[bool, list[tuple]] = {False: [], True: []}
    size = {False: 0, True: 0}

    def close(own: bool) -> pa.RecordBatch:
        nonlocal block
        ids, kinds, texts = zip(*held[own], strict=True)
        table = pa.record_batch([pa.array(ids, pa.int64()), pa.array(kinds, pa.int8()), pa.array(texts, pa.large_binary())], ["doc_id", "kind", "text"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_batch(table)
        payload = zstandard.compress(sink.getvalue().to_pybytes(), 3)
        held[own], size[own], block = [], 0, block + 1
        return pa.record_batch([pa.array([block]), pa.array([own]), pa.array([payload], pa.binary())], ["block", "fold", "payload"])

    for batch in batches:
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), strict=True):
            own = row[1] == FOLD
            held[own].append(row)
            size[own] += len(row[2])
            if size[own] >= block_bytes:
                yield close(own)
    for own in (False, True):
        if held[own]:
            yield close(own)


@dataclass
class _Block:
    """A block's tokens as places among its sorted distinct keys."""

    ids: list
    kinds: np.ndarray  # of documents
    ends: np.ndarray  # tokens up to the end of each document
    unigrams: np.ndarray
    word: np.ndarray  # place of each token's unigram
    bigrams: np.ndarray
    pair: np.ndarray  # place of each token's bigram


def _read_block(payload: bytes) -> _Block:
    table = pa.ipc.open_stream(zstandard.decompress(payload)).read_all()
    hashes, lengths = [], []
    digest = xxhash.xxh64_intdigest
    for text in text_bytes(table.column("text").combine_chunks()):
        words = text.lower().split()
        hashes.append(np.fromiter(map(digest, words), np.uint64, len(words)))
        hashes.append(np.array([_END], np.uint64))
        lengths.append(len(words) + 1)
    tokens = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    before = np.concatenate((np.array([_END], np.uint64), tokens[:-1]))[: len(tokens)]  # a document's first follows an end
    pairs = ((before ^ (before >> np.uint64(31))) * _MIX) ^ tokens
    pairs = (pairs ^ (pairs >> np.uint64(29))) * _MIX
    unigrams, word = np.unique(tokens, return_inverse=True)
    bigrams, pair = np.unique(pairs, return_inverse=True)
    kinds = np.array(table.column("kind").to_pylist(), np.int8)
    return _Block(table.column("doc_id").to_pylist(), kinds, np.cumsum(lengths), unigrams, word, bigrams, pair)


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the sorted keys of each shard, an equal range of all hashes, begin and end."""
    edges = np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def _key_batches(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    names = ["shard", "gram", "block", "keys", "counts", "fold"]
    for batch in batches:
        for number, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            block = _read_block(payload)
            kind = np.repeat(block.kinds, np.diff(block.ends, prepend=0))
            rows: list[tuple] = []
            for gram, keys, place in ((1, block.unigrams, block.word), (2, block.bigrams, block.pair)):
                trained = np.bincount(place[kind != SCORED], minlength=len(keys))
                fold = np.bincount(place[kind == FOLD], minlength=len(keys))
                cuts = _cuts(keys, shards).tolist()
                for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if a < b:
                        rows.append((shard, gram, number, _pack_keys(keys[a:b]), _pack_ints(trained[a:b]), _pack_ints(fold[a:b]) if fold[a:b].any() else None))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _add_up(key: tuple, table: pa.Table) -> pa.Table:
    """The totals of a shard's keys: an answer to each block, and one row (block null) of N and V over all."""
    shard, gram = (k.as_py() for k in key)
    keys = [_unpack_keys(b) for b in table.column("keys").to_pylist()]
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    parts, size = np.cumsum([0, *map(len, keys)]), int(place.max()) + 1
    trained, fold = np.zeros(size, np.int64), np.zeros(size, np.int64)
    wheres = [place[a:b] for a, b in zip(parts[:-1], parts[1:], strict=True)]
    for where, counts, own in zip(wheres, table.column("counts").to_pylist(), table.column("fold").to_pylist(), strict=True):
        trained[where] += _unpack_ints(counts).astype(np.int64)  # keys are distinct within a block
        if own is not None:
            fold[where] += _unpack_ints(own).astype(np.int64)
    blocks = table.column("block").to_pylist()
    n = len(blocks)
    return pa.table(
        {
            "block": pa.array([*blocks, None], pa.int64()),
            "gram": pa.array([gram] * (n + 1), pa.int32()),
            "shard": pa.array([shard] * (n + 1), pa.int32()),
            "counts": pa.array([*(_pack_ints(trained[w]) for w in wheres), None], pa.binary()),
            "fold": pa.array([*(_pack_ints(fold[w]) for w in wheres), None], pa.binary()),
            "n": pa.array([None] * n + [int(trained.sum())], pa.int64()),
            "n_fold": pa.array([None] * n + [int(fold.sum())], pa.int64()),
            "types": pa.array([None] * n + [int((trained > 0).sum())], pa.int64()),
        }
    )


_ANSWER = "block long, gram int, shard int, counts binary, fold binary, n long, n_fold long, types long"


@dataclass
class _Totals:
    """For each token of a block, the counts of itself, of its bigram and of its context."""

    word: np.ndarray
    pair: np.ndarray
    context: np.ndarray


def _answered(block: _Block, answers: pa.Table, column: str) -> _Totals:
    order = answers.select(["gram", "shard", column]).sort_by([("gram", "ascending"), ("shard", "ascending")])
    grams, blobs = order.column("gram").to_pylist(), order.column(column).to_pylist()
    counts = {g: np.concatenate([_unpack_ints(b) for x, b in zip(grams, blobs, strict=True) if x == g]).astype(np.int64) for g in (1, 2)}
    word = counts[1][block.word]
    end = counts[1][np.searchsorted(block.unigrams, _END)]
    return _Totals(word, counts[2][block.pair], np.concatenate(([end], word[:-1])))


def _classes(context: np.ndarray) -> np.ndarray:
    """0 for a context that was not met, then one class for each power of two."""
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, CLASSES - 1), 0)


def _histogram(n_kept: int):
    def count(key: tuple, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        names = ("class", "f2", "f1", "n")
        if not blocks.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        block = _read_block(blocks.column("payload")[0].as_py())
        every, own = _answered(block, answers, "counts"), _answered(block, answers, "fold")
        word, pair, context = every.word - own.word, every.pair - own.pair, every.context - own.context
        absent = -10_000
        with np.errstate(divide="ignore", invalid="ignore"):
            f2 = np.where(pair > 0, np.rint(STEPS * np.log2(pair / np.maximum(context, 1))), absent).astype(np.int64)
            f1 = np.where(word > 0, np.rint(STEPS * np.log2(word / max(1, n_kept))), absent).astype(np.int64)
        rows, n = np.unique(np.stack([_classes(context), f2, f1], 1), axis=0, return_counts=True)
        return pa.table({"class": rows[:, 0], "f2": rows[:, 1], "f1": rows[:, 2], "n": n.astype(np.int64)})

    return count


def learn_weights(histogram: np.ndarray, types: int, rounds: int = ROUNDS) -> np.ndarray:
    """A row of (l2, l1, l0) for each class, from rows (class, f2, f1, n) of quantised logarithms of frequencies.

    A class adds the tokens of an even mixture, one of each part, so that no weight is ever zero; without a context
    there is no l2.
    """
    weights = np.full((CLASSES, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    for c in range(CLASSES):
        rows = histogram[histogram[:, 0] == c]
        if not len(rows):
            continue
        f = np.stack([np.where(rows[:, i] > -10_000, 2.0 ** (rows[:, i] / STEPS), 0) for i in (1, 2)] + [np.full(len(rows), 1 / (types + 1))], 1)
        for _ in range(rounds):
            mixed = f * weights[c]
            part = (mixed / mixed.sum(1, keepdims=True) * rows[:, 3:]).sum(0) + np.where(weights[c] > 0, 1.0, 0)
            weights[c] = part / part.sum()
    return weights


def _score_blocks(weights: np.ndarray, n: int, types: int):
    def score(key: tuple, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return pa.table({f.split()[0]: pa.array([], pa.int64()) for f in _SCORES.split(", ")}).cast(_SCORE_TYPES)
        block = _read_block(blocks.column("payload")[0].as_py())
        found = _answered(block, answers, "counts")
        base = np.log10((found.word + 1) / (n + types + 1))
        mix = weights[_classes(found.context)]
        p = mix[:, 0] * found.pair / np.maximum(found.context, 1) + mix[:, 1] * found.word / max(1, n) + mix[:, 2] / (types + 1)
        ends = block.ends
        starts = np.concatenate(([0], ends[:-1]))
        total = lambda x: np.add.reduceat(x, starts)  # noqa: E731  a document has a token at least
        return pa.table(
            {
                "doc_id": pa.array(block.ids, pa.int64()),
                "held_out": pa.array(block.kinds == SCORED),
                "n_tokens": pa.array(ends - starts, pa.int64()),
                "n_known": pa.array(total((found.word > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(len(ends), n, np.int64)),
                "base_score": pa.array(total(base)),
                "score": pa.array(total(np.log10(p))),
            }
        )

    return score


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_SCORE_TYPES = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
    + [("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def fold_kinds(modulus: int = 7, held_out: int = 2, folds: int = 8, fold: int = 5) -> Column:
    """SCORED where crc32(doc_id as text) mod modulus is held_out; of the rest, one of so many folds is FOLD."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    own = F.floor(crc / modulus) % folds == fold
    return F.when(F.coalesce(crc % modulus == held_out, F.lit(False)), SCORED).when(F.coalesce(own, F.lit(False)), FOLD).otherwise(TRAINED)


def block_size(shards: int) -> int:
    """Bytes of text to a block where its keys go to so many shards."""
    return min(MAX_BLOCK_BYTES, max(BLOCK_BYTES, MESSAGE_BYTES * shards))


def interpolated_scores(docs: DataFrame, kinds: Column | None = None, block_bytes: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score (add-one unigrams) and score.

    kinds tells for each row whether it is SCORED only, TRAINED, or TRAINED and in the FOLD for the weights. Blocks
    grow with the number of shards, that is with the input, if block_bytes does not say otherwise.
    """
    kinds = fold_kinds() if kinds is None else kinds
    size = input_bytes(docs)
    shards = max(1, min(MAX_SHARDS, -(-size // shard_bytes)))
    block_bytes = block_size(shards) if block_bytes is None else block_bytes
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), kinds.cast("int").alias("kind"), F.col("text").cast("string").alias("text"))
    blocks = materialise(map_batches(rows, lambda b: _block_batches(b, block_bytes), "block long, fold boolean, payload binary"), "blocks")
    schema = "shard int, gram int, block long, keys binary, counts binary, fold binary"
    keys = map_batches(blocks.select("block", "payload"), lambda b: _key_batches(b, shards), schema)
    answers = materialise(dealt(keys, 2 * size, "shard", "gram").groupBy("shard", "gram").applyInArrow(_add_up, _ANSWER), "answers")
    sums = answers.where("block is null and gram = 1").agg(F.sum("n"), F.sum("n_fold"), F.sum("types")).first()
    n, n_fold, types = (int(x or 0) for x in sums)
    answers = answers.where("block is not null").select("block", "gram", "shard", "counts", "fold")
    of_fold = answers.join(blocks.where("fold").select("block"), "block", "left_semi")
    by_block = lambda df: dealt(df, size, "block").groupBy("block")
    learned = by_block(blocks.where("fold")).cogroup(by_block(of_fold))
    learned = learned.applyInArrow(_histogram(n - n_fold), "class long, f2 long, f1 long, n long")
    histogram = learned.groupBy("class", "f2", "f1").agg(F.sum("n").alias("n")).collect()  # bounded by the grid
    weights = learn_weights(np.array(sorted(map(tuple, histogram)), np.int64).reshape(-1, 4), types)
    scored = by_block(blocks.select("block", "payload")).cogroup(by_block(answers.drop("fold")))
    return scored.applyInArrow(_score_blocks(weights, n, types), _SCORES)
