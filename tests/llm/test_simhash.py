import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from weir.llm import simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(bits, max_bits=2):
    """Smallest index reachable, by all pairs."""
    root = list(range(len(bits)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(bits)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(bits))]


TEXTS = ["", "a", "A b", "a b c", "a b c d", "É é a b", "x\x1cy z w\x0bv u", "one two three " * 30_000]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprints(text):
    assert simhash.fingerprint(text.encode()) == brute_print(text)


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest(b"a b c", seed=42)


def test_gray_rank():
    codes = np.array([n ^ (n >> 1) for n in range(1000)] + [2**63, 2**64 - 1], np.uint64)
    assert simhash.gray_rank(codes)[:1000].tolist() == list(range(1000))
    assert simhash.gray_rank(codes)[1000] == 2**64 - 1


def spanned(bits, max_bits, fanout):
    root = list(range(len(bits)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in simhash.GrayIndex(np.array(bits, np.uint64), fanout).links(max_bits, chunk=7):
        assert (bits[a] ^ bits[b]).bit_count() <= max_bits
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(bits))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=8), st.lists(st.tuples(st.integers(0, 7), st.sets(st.integers(0, 63), max_size=5)), max_size=60), st.integers(0, 4), st.sampled_from([2, 3, 16]))
def test_index_connects_what_all_pairs_connect(centres, moved, max_bits, fanout):
    bits = list(dict.fromkeys([*centres, *(centres[c % len(centres)] ^ sum(1 << b for b in flips) for c, flips in moved)]))
    assert spanned(bits, max_bits, fanout) == components(bits, max_bits)


def cloud(rng, n):
    centres = [rng.getrandbits(64) for _ in range(5)]
    return list(dict.fromkeys(rng.choice(centres) ^ sum(1 << b for b in {rng.randrange(64) for _ in range(rng.randint(0, 4))}) for _ in range(n)))


@pytest.mark.parametrize("group_nodes", [20_000, 80])
def test_links_and_components(spark, group_nodes):
    rng = random.Random(3)
    bits = cloud(rng, 400) + [rng.getrandbits(64) for _ in range(200)]
    check_links(spark, bits, 2, group_nodes)


def check_links(spark, bits, max_bits, group_nodes):
    signed = [b - 2**64 if b >> 63 else b for b in bits]
    edges = simhash.links(spark.createDataFrame([(b, b) for b in signed], "node long, bits long"), max_bits, group_nodes=group_nodes)
    roots = {r["node"]: r["root"] for r in simhash.connected(edges).collect()}
    groups = components(bits, max_bits)
    least = {}
    for b, g in zip(signed, groups, strict=True):
        least[g] = min(b, least.get(g, b))
    assert [roots.get(b, b) for b in signed] == [least[g] for g in groups]


@pytest.mark.parametrize(("max_bits", "group_nodes"), [(0, 10), (1, 60), (3, 100)])
def test_other_numbers_of_bits(spark, max_bits, group_nodes):
    check_links(spark, cloud(random.Random(max_bits), 150), max_bits, group_nodes)


def test_a_group_has_a_least_size(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "bits long"), 4, group_nodes=20)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "u long, v long")
    roots = {r["node"]: r["root"] for r in simhash.connected(edges).collect()}
    assert roots == {**{i: 0 for i in range(1, 201)}, 501: 500}
    assert simhash.connected(edges.limit(0)).count() == 0


def test_documents(documents, widened):
    rng = random.Random(1)
    words = [f"w{n}" for n in range(50)]
    base = [rng.choice(words) for _ in range(400)]
    rows = [(10, " ".join(base)), (3, " ".join(base).upper()), (7, None), (5, ""), (9, " \n"), (20, " ".join([*base[:399], "other"])), (21, "quite different"), (21, "quite different")]
    rows += [(30 + n, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for n in range(40)] + [(None, "quite different"), (None, "alone here it is")]
    check_documents(simhash.fingerprint_report(widened(documents(rows))), rows)
    assert simhash.fingerprint_report(documents(rows).limit(0)).count() == 0


def check_documents(report, rows):
    """Every row's fingerprint, and the smallest doc_id of its component, by all pairs; null where all ids are null."""
    bits = [brute_print(t) for _, t in rows]
    groups = components(bits)
    smallest = {}
    for (d, _), g in zip(rows, groups, strict=True):
        smallest[g] = min((x for x in (d, smallest.get(g)) if x is not None), default=None)
    wanted = [(d, f"{b:016x}", smallest[g]) for (d, _), b, g in zip(rows, bits, groups, strict=True)]
    key = lambda t: tuple(str(x) for x in t)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in report.collect()), key=key) == sorted(wanted, key=key)


@pytest.mark.parametrize("bridge", [None, 8, 5, 7])
def test_a_bridge_links_whatever_its_id(documents, bridge, monkeypatch):
    """7 and 9 differ in four bits and are linked over a third row, of a null id, of an id of its own, or of 7's id."""
    rng = random.Random(5)
    words = [f"w{n}" for n in range(40)]
    base = [rng.choice(words) for _ in range(300)]
    near = []
    for n in range(300):  # a change of one word moves few bits: find a middle text with an end on either side
        for w in ("x", "y", "z"):
            near.append(" ".join([*base[:n], w, *base[n + 1 :]]))
    middle = " ".join(base)
    m = brute_print(middle)
    ones = [(brute_print(t), t) for t in near]
    ones = [(b, t) for b, t in ones if 1 <= (b ^ m).bit_count() <= 2]
    left, right = next((s, t) for a, s in ones for b, t in ones if 3 <= (a ^ b).bit_count())
    rows = [(7, left), (9, right), (bridge, middle), (None, "alone it is"), (7, "another text of a repeated id")]
    check_documents(simhash.fingerprint_report(documents(rows)), rows)
    found = {r["component_id"] for r in simhash.fingerprint_report(documents(rows[:3])).collect()}
    assert found == {min(x for x in (7, bridge) if x is not None)}


def brute_words(text, shingle, words):
    """Bit by bit, the further hashes by the published finaliser of SplitMix64."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return [0] * words
    hashes = [xxhash.xxh64_intdigest(b" ".join(parts[i : i + shingle]), seed=42) for i in range(max(1, len(parts) - shingle + 1))]

    def mixed(h, word):
        if not word:
            return h
        z = (h + word * 0x9E3779B97F4A7C15) % 2**64
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ z >> 27) * 0x94D049BB133111EB % 2**64
        return z ^ z >> 31

    return [sum(1 << b for b in range(64) if 2 * sum(mixed(h, w) >> b & 1 for h in hashes) > len(hashes)) for w in range(words)]


@pytest.mark.parametrize("text", TEXTS[:-1])
def test_fingerprints_of_several_words(text):
    assert simhash.fingerprint_words(text.encode(), 2, 5) == brute_words(text, 2, 5)
    assert simhash.fingerprint_words(text.encode(), 3, 1) == [brute_print(text)]


def edited(rng, n, longest=160):
    """Texts, many of them another with words changed, dropped or put in."""
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(30, longest))) for _ in range(n // 4)]
    while len(texts) < n:
        words = rng.choice(texts[: n // 4]).split()
        for _ in range(rng.choice([0, 1, 1, 2, 4, 12])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize(("words", "group_nodes"), [(2, 20_000), (5, 20_000), (5, 64)])
def test_components_of_several_words(spark, documents, words, group_nodes):
    rng, max_bits, check_bits = random.Random(words), 4, 20
    texts = [*edited(rng, 160), "", None, "one", "one"]
    prints = [tuple(brute_words(t, 2, words)) for t in texts]
    signed = [tuple(b - 2**64 if b >> 63 else b for b in p) for p in prints]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(signed)], ", ".join(["i long", *(f"b{w} long" for w in range(words))]))
    node = {r["i"]: r["node"] for r in rows.selectExpr("i", f"xxhash64({', '.join(f'b{w}' for w in range(words))}) AS node").collect()}
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def join(i, j):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)

    checks = min(2, words - 1)
    for w in range(words):
        classes = {}
        for i in range(len(texts)):
            classes.setdefault(prints[i][w], []).append(i)
        stand = [min(members, key=node.get) for members in classes.values()]
        for members in classes.values():
            for i in members:
                join(members[0], i)
        for i in stand:
            for j in stand:
                far = sum((prints[i][(w + 1 + n) % words] ^ prints[j][(w + 1 + n) % words]).bit_count() for n in range(checks))
                if (prints[i][w] ^ prints[j][w]).bit_count() <= max_bits and far <= check_bits:
                    join(i, j)
    got = simhash.near_duplicates(documents(list(enumerate(texts))), max_bits, 2, words, check_bits=check_bits, group_nodes=group_nodes).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: find(i) for i in range(len(texts))}
    assert len({find(i) for i in range(len(texts))}) < 0.6 * len(texts)


def test_partitions_follow_the_size(spark, documents, monkeypatch):
    from weir.llm import common

    table = spark.range(100_000)
    assert common.by_size(spark, 1) is None and common.dealt(table, 1, "id") is table
    monkeypatch.setattr(common, "PARTITION_BYTES", 1000)
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions")) + 5
    assert common.by_size(spark, 1000 * wanted) == wanted and common.dealt(table, 1000 * wanted, "id").rdd.getNumPartitions() == wanted
    assert common.by_size(spark, 1 << 60) == common.MAX_PARTITIONS
    rows = list(enumerate(edited(random.Random(4), 120)))
    check_documents(simhash.fingerprint_report(documents(rows)), rows)


def test_many_texts_that_agree_in_a_word_are_one_class(spark, documents):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [f"{base} x{i}" for i in range(300)] + ["other words altogether, that is to say none of those"]
    got = simhash.near_duplicates(documents(list(enumerate(texts))), 4, 2, 8, group_nodes=32).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict.fromkeys(range(300), 0) | {300: 300}


def test_recall_of_similar_texts(spark, documents):
    """Of pairs whose sets of five-word shingles have a similarity of 0.8 or more, at least 0.9 come into one component; others do not."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts, pairs = [], []
    for _ in range(150):
        words = rng.choices(vocabulary, k=rng.randint(60, 400))
        other = list(words)
        for _ in range(rng.randint(1, max(1, len(words) // 50))):
            other[rng.randrange(len(other))] = rng.choice(vocabulary)
        a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (words, other))
        if len(a & b) >= 0.8 * len(a | b):
            pairs.append((len(texts), len(texts) + 1))
        texts += [" ".join(words), " ".join(other)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(documents(list(enumerate(texts))), 4, 2, 8).collect()}
    assert len(pairs) > 100 and sum(got[a] == got[b] for a, b in pairs) >= 0.9 * len(pairs)
    assert all(c // 2 == d // 2 for d, c in got.items())
