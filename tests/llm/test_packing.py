import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weir.llm import packing
from weir.llm.tokens import default_tokenizer


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=60), st.integers(1, 12))
def test_differencing_is_a_partition(sizes, windows):
    of, sums = packing.difference(np.array(sizes, np.int64), windows)
    assert len(of) == len(sizes) and sums.sum() == sum(sizes) and len(sums) <= windows
    again = np.bincount(of, weights=sizes, minlength=len(sums))
    assert (again == sums).all()


def test_differencing_balances():
    sizes = np.random.default_rng(1).integers(1, 1000, 500)
    _, sums = packing.difference(sizes, 20)
    assert len(sums) == 20 and sums.max() - sums.min() <= 20


def plain_difference(sizes, windows):
    """The sums of Karmarkar-Karp, in full: lists of all sums, the two of the largest spread merged, opposites joined."""
    lists = [(0, n, sorted([s] + [0] * (windows - 1), reverse=True)) for n, s in enumerate(sizes)]
    tie = len(lists)
    while len(lists) > 1:
        lists.sort(key=lambda x: (x[2][-1] - x[2][0], x[1]))
        (_, _, a), (_, _, b) = lists[:2]
        lists[:2] = [(0, tie, sorted((x + y for x, y in zip(a, reversed(b), strict=True)), reverse=True))]
        tie += 1
    return lists[0][2]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=25), st.integers(1, 7))
def test_differencing_equals_a_plain_one(sizes, windows):
    _, sums = packing.difference(np.array(sizes, np.int64), windows)
    assert sorted(sums.tolist(), reverse=True) == [s for s in plain_difference(sizes, windows) if s]


def test_what_fits_a_window_is_not_cut(documents):
    rng = np.random.default_rng(4)
    rows = [(n, "word " * int(k)) for n, k in enumerate(rng.integers(1, 4000, 300))]
    found = packing.pack_documents(documents(rows)).collect()
    assert sum(r["doc_tokens"] <= packing.CAPACITY for r in found) == sum(len(d) <= packing.CAPACITY for d in expected(rows).values())
    assert all(r["length"] == min(r["doc_tokens"] - r["start"], packing.CAPACITY) for r in found)


def test_windows_rise_only_when_needed():
    of, sums = packing.pack(np.array([6, 6, 6]), 10)  # two windows cannot hold them
    assert len(sums) == 3 and sums.max() <= 10
    assert len(packing.pack(np.array([5, 5, 5, 5]), 10)[1]) == 2


def expected(rows, end_id=packing.END_ID):
    t = Tokenizer.from_file(default_tokenizer())
    return {d: np.array([*t.encode(x or "", add_special_tokens=False).ids, end_id], "<u4") for d, x in rows}


def check(found, docs, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(docs)
    for doc, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(docs[doc])
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(docs[doc][p["start"] : at].tobytes())
        assert at == len(docs[doc])
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        assert {p["padding"] for p in pieces} == {0 if at & (at - 1) == 0 else capacity - at}
    return sum(len(d) for d in docs.values()) / (len(by_sequence) * capacity)


@pytest.mark.parametrize(("capacity", "batch"), [(4096, 192), (64, 4), (16, 1)])
def test_pieces(documents, capacity, batch):
    rng = np.random.default_rng(2)
    words = ["alpha", "Beta,", "gamma42", "über", "日本", "don't", "<|endoftext|>", "x!?"]
    rows = [(n, " ".join(rng.choice(words, rng.integers(0, 120)))) for n in range(80)] + [(100, None), (101, ""), (102, "word " * 9000)]
    found = packing.pack_documents(documents(rows), capacity=capacity, batch_windows=batch).collect()
    check(found, expected(rows), capacity)


def test_little_padding(documents):
    rng = np.random.default_rng(3)
    rows = [(n, "word " * int(rng.integers(1, 1500))) for n in range(400)]
    df = documents(rows).coalesce(1)
    assert check(packing.pack_documents(df, capacity=1024).collect(), expected(rows), 1024) > 0.95


def test_repeated_rows_empty_tables_and_columns(documents, widened):
    rows = [(7, "one two three"), (7, "one two three"), (None, "x")]
    found = packing.pack_documents(widened(documents(rows))).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in found) == [(0, 2), (7, 4), (7, 4)]
    assert packing.pack_documents(documents(rows).limit(0)).count() == 0


def test_the_same_scan_gives_the_same_windows(documents):
    df = documents([f"text number {n} " * (n % 50) for n in range(200)])
    assert sorted(map(tuple, packing.pack_documents(df).collect())) == sorted(map(tuple, packing.pack_documents(df).collect()))
