import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from weir.llm import common
from weir.llm import interpolation as lm

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(n=150, seed=0):
    rng = np.random.default_rng(seed)
    follow = {w: rng.choice(list("abcdefghij"), 3) for w in "abcdefghij"}
    rows = []
    for i in range(n):
        words = [rng.choice(list("abcdefghij"))]
        for _ in range(rng.integers(0, 60)):
            words.append(rng.choice(follow.get(words[-1], ["a"])) if rng.random() < 0.9 else str(rng.choice(["Q", "z\x1cz", "é"])).replace("Q", "a"))
        rows.append((i, " ".join(words).replace("b", "B")))
    return rows


def kind(doc_id):
    if doc_id is None:
        return lm.TRAINED
    crc = zlib.crc32(str(doc_id).encode())
    return lm.SCORED if crc % 7 == 2 else lm.FOLD if crc // 7 % 8 == 5 else lm.TRAINED


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), "\n"]


class Brute:
    """The model by plain counting, with exact frequencies in the weights' learning."""

    def __init__(self, rows):
        self.every, self.kept = self._count(rows, lm.TRAINED, lm.FOLD), self._count(rows, lm.TRAINED)
        events = defaultdict(list)
        for doc, text in rows:
            if kind(doc) == lm.FOLD:
                own = ["\n", *tokens(text)]
                for v, w in zip(own[:-1], own[1:], strict=True):
                    events[self._class(self.kept[0][v])].append(self._parts(self.kept, v, w))
        self.weights = np.full((lm.CLASSES, 3), 1 / 3)
        self.weights[0] = (0, 0.5, 0.5)
        for c, f in events.items():
            f = np.array(f)
            for _ in range(lm.ROUNDS):
                mixed = f * self.weights[c]
                part = (mixed / mixed.sum(1, keepdims=True)).sum(0) + (self.weights[c] > 0)
                self.weights[c] = part / part.sum()

    @staticmethod
    def _count(rows, *kinds):
        words, pairs = Counter(), Counter()
        for doc, text in rows:
            if kind(doc) in kinds:
                own = tokens(text)
                words.update(own)
                pairs.update(zip(["\n", *own[:-1]], own, strict=True))
        return words, pairs, sum(words.values())

    @staticmethod
    def _class(n):
        return min(int(math.log2(n)) + 1, lm.CLASSES - 1) if n else 0

    def _parts(self, counts, v, w):
        words, pairs, n = counts
        return pairs[v, w] / max(1, words[v]), words[w] / max(1, n), 1 / (len(self.every[0]) + 1)

    def row(self, doc, text):
        words, _, n = self.every
        own = tokens(text)
        base = sum(math.log10((words[w] + 1) / (n + len(words) + 1)) for w in own)
        score = sum(math.log10(self.weights[self._class(words[v])] @ self._parts(self.every, v, w)) for v, w in zip(["\n", *own[:-1]], own, strict=True))
        return kind(doc) == lm.SCORED, len(own), sum(words[w] > 0 for w in own), n, base, score


EDGES = [(900, None), (901, ""), (902, " \n\t"), (903, "unseen words only"), (None, "a b c"), (7, "a b"), (7, "a b"), (904, "a b " * 20_000)]


@pytest.mark.parametrize(("block", "shard", "partition"), [(None, lm.SHARD_BYTES, None), (500, 300, None), (500, 300, 10_000)])
def test_equals_brute_force(documents, widened, block, shard, partition, monkeypatch):
    if partition:  # more partitions than the session's setting
        monkeypatch.setattr(common, "PARTITION_BYTES", partition)
    rows = corpus() + EDGES
    brute = Brute(rows)
    found = lm.interpolated_scores(widened(documents(rows)), block_bytes=block, shard_bytes=shard).collect()
    wanted = sorted((brute.row(d, t) for d, t in rows), key=lambda r: (r[1], r[4]))
    got = sorted(((r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found), key=lambda r: (r[1], r[4]))
    assert len(got) == len(rows)
    for a, b in zip(got, wanted, strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9) and a[5] == pytest.approx(b[5], rel=0.01)
    assert {r["doc_id"] for r in found} == {d for d, _ in rows}


def test_held_out_text_is_likelier_than_by_unigrams(documents):
    found = [r for r in lm.interpolated_scores(documents(corpus(400))).collect() if r["held_out"]]
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found) * 0.8


def test_probabilities_add_up():
    rows = corpus(60)
    brute = Brute(rows)
    for v in ("a", "\n", "never"):
        mass = sum(brute.weights[brute._class(brute.every[0][v])] @ brute._parts(brute.every, v, w) for w in [*brute.every[0], "unknown"])
        assert mass == pytest.approx(1)


def test_without_training_documents(documents):
    scored = [d for d in range(200) if kind(d) == lm.SCORED][:3]
    found = lm.interpolated_scores(documents([(d, "a b") for d in scored])).collect()
    assert [(r["train_tokens"], r["n_known"], r["base_score"]) for r in found] == [(0, 0, 0.0)] * 3
    assert all(r["score"] <= 0 for r in found)
    no_fold = [d for d in range(200) if kind(d) == lm.TRAINED][:3]
    assert all(r["score"] < 0 for r in lm.interpolated_scores(documents([(d, "a b") for d in no_fold])).collect())
    assert lm.interpolated_scores(documents([(1, "x")]).limit(0)).count() == 0


def test_packed_integers():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        values = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
        assert (lm._unpack_keys(lm._pack_keys(values)) == values).all()
        assert (lm._unpack_ints(lm._pack_ints(values)) == values).all()
    keys = np.sort(rng.integers(0, 2**64 - 1, 500, dtype=np.uint64))
    cuts = lm._cuts(keys, 7)
    assert all((int(k) * 7) >> 64 == s for s in range(7) for k in keys[cuts[s] : cuts[s + 1]])


def test_blocks_grow_with_the_shards():
    assert lm.block_size(1) == lm.block_size(10_000) == lm.BLOCK_BYTES
    assert lm.BLOCK_BYTES < lm.block_size(50_000) == 50_000 * lm.MESSAGE_BYTES < lm.block_size(lm.MAX_SHARDS) == lm.MAX_BLOCK_BYTES
