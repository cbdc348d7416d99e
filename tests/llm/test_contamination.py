import hashlib
import random
import re

import pytest

from weir.llm import contamination
from weir.llm.contamination import scan

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    found = []
    for doc, text in docs:
        own, hit, names = words(text), set(), set()
        for item, item_text in items:
            w = words(item_text)
            n = min(window, len(w))
            grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
            for i in range(len(own) - n + 1 if n else 0):
                if tuple(own[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    names.add("null" if item is None else str(item))
        found.append((doc, len(own), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=lambda r: (r[0] is not None, r))


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def make(seed):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "GAMMA", "d3lta", "é", "日本", "x", "y", "z", "10"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--", "'"]) for _ in range(n))
    items = [(n, text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for n in range(12)] + [(3, text(12)), (None, text(14)), (50, None), (51, "?!")]
    docs = [(n, text(rng.randint(0, 60))) for n in range(60)]
    for n in range(30):
        item = rng.choice([t for _, t in items if t])
        cut = item.split(" ")
        docs.append((100 + n, text(5) + " ".join(cut[rng.randint(0, 3) :]) + " " + text(5)))
    return docs + [(200, None), (201, ""), (202, "--- !!"), (5, docs[5][1]), (None, items[4][1])], items


@pytest.mark.parametrize(("seed", "chars", "size"), [(1, 10**6, 10**6), (2, 10**6, 10**6), (3, 150, 10**6), (4, 150, 500), (5, 10**6, 400)])
def test_equals_brute_force(spark, documents, widened, seed, chars, size):
    docs, items = make(seed)
    report = contamination.contamination(widened(documents(docs)), widened(table(spark, items)), max_pattern_chars=chars, max_benchmark_bytes=size)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted((tuple(r[n] for n in names) for r in report.collect()), key=lambda r: (r[0] is not None, r)) == brute(docs, items)
    clean = sorted(str(r["doc_id"]) for r in contamination.drop_contaminated(documents(docs), table(spark, items), max_pattern_chars=chars, max_benchmark_bytes=size).collect())
    assert clean == sorted(str(r[0]) for r in brute(docs, items) if not r[5])


@pytest.mark.parametrize("window", [1, 2, 3, 5, 10, 13])
def test_other_windows(window):
    docs, items = make(window + 20)
    rows = [(str(i) if i is not None else "null", (t or "").encode()) for i, t in items]
    for chars in (10**6, 60):
        held = contamination._Benchmark.of(rows, window, chars)
        wanted = {d: (n, k) for d, n, k, *_ in brute([(i, t) for i, (_, t) in enumerate(docs)], items, window)}
        for i, (_, text) in enumerate(docs):
            own, hit, names = contamination.normal_words((text or "").encode()), None, set()
            if len(held.parts) == 1 or held.may_hit(own):
                for part in held.parts:
                    hit = contamination._Seeds(part, window).add(own, hit, names)
            assert (len(own), 0 if hit is None else int(hit.sum())) == wanted[i]


def test_many_parts_are_one_pass(spark, documents, monkeypatch):
    """A benchmark of very many automata: the texts are read once, and nothing is written."""
    monkeypatch.setattr(contamination, "materialise", lambda *a: pytest.fail("texts were written"))
    items = [(n, " ".join(f"w{(n * 37 + i * i) % 400}" for i in range(30))) for n in range(200)]
    assert len(contamination._Benchmark.of([(str(n), t.encode()) for n, t in items], 10, 400).parts) >= 50
    docs = [(n, f"before {items[n][1]} after" if n % 3 == 0 else f"clean {n} " * 20) for n in range(60)]
    report = contamination.contamination(documents(docs), table(spark, items), max_pattern_chars=400)
    assert "Exchange" not in report._jdf.queryExecution().executedPlan().toString()
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(tuple(r[n] for n in names) for r in report.collect()) == brute(docs, items)
    kept = contamination.drop_contaminated(documents(docs), table(spark, items), max_pattern_chars=400)
    assert sorted(r["doc_id"] for r in kept.collect()) == [n for n in range(60) if n % 3]


def test_spans_lie_in_the_original(spark, documents):
    text = "Intro—é: ONE, two;\nThree 4 five six seven eight NINE ten! outro"
    row = contamination.contamination(documents([text]), table(spark, [(1, "one two three 4 five six seven eight nine ten")])).first()
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == ["ONE, two;\nThree 4 five six seven eight NINE ten"]
    assert row["n_hit"] == 10 and row["items"] == ["1"]


def test_short_items_and_borders(spark, documents):
    items = table(spark, [(1, "cat"), (2, "a b")])
    found = {r["doc_id"]: r["n_hit"] for r in contamination.contamination(documents(["the cat sat", "concatenate", "cat cat", "xa b", "a b a b", "a, B"]), items).collect()}
    assert found == {0: 1, 1: 0, 2: 2, 3: 0, 4: 4, 5: 2}


def test_long_text_and_empty_tables(spark, documents):
    item = " ".join(f"w{n}" for n in range(12))
    long = documents([("x " * 200_000) + item + (" y" * 200_000)])
    assert contamination.contamination(long, table(spark, [(1, item)])).first()["n_hit"] == 12
    none = contamination.contamination(long, table(spark, [(1, item)]).limit(0)).first()
    assert (none["n_hit"], none["n_items"], none["contaminated"]) == (0, 0, False)
    assert contamination.contamination(long.limit(0), table(spark, [(1, item)])).count() == 0
    assert scan(long, table(spark, [(1, None)])).first()["hits"] is None


def test_narrow_plan(spark, documents):
    plan = contamination.contamination(documents(["a"]), table(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
