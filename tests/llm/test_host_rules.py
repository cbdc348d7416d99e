import random
from collections import Counter

import pytest

from weir.llm import host_rules


def brute(text):
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().strip()]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts_equal_brute_force(documents, widened):
    rng = random.Random(4)
    parts = ["a", "b", "é", "日本", "#", "a|b", "\n", "\n\n", " ", "  ", "\t", "\x1c", "\x0b", "same line\n"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(200)] + [None, "", "\n\n \n", "a b c d e a b c d e", "x " * 100_000]
    found = {r["doc_id"]: r for r in host_rules.apply_host_rules(widened(documents(texts).drop("host"))).collect()}
    for n, text in enumerate(texts):
        want = brute(text)
        assert tuple(found[n][c] for c in NAMES) == want, text
        assert found[n]["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def posterior(hosts, max_rate=0.5, watch_rate=0.05):
    """host -> verdict, from (n, failed) by host; of None, that of a host without documents."""
    docs, failed, k = sum(n for n, _ in hosts.values()), sum(f for _, f in hosts.values()), len(hosts)
    m = failed / docs
    spread = sum(n * (f / n - m) ** 2 for n, f in hosts.values()) / (m * (1 - m))
    rho = min(max((spread - (k - 1)) / (docs - sum(n * n for n, _ in hosts.values()) / docs - (k - 1)), 1e-4), 0.99)
    alpha, beta = m * (1 / rho - 1), (1 - m) * (1 / rho - 1)
    found = {}
    for h, (n, f) in hosts.items():
        a, b = f + alpha, n - f + beta
        low = a / (a + b) - 2 * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5
        found[h] = "rejected" if low > max_rate else "watched" if a / (a + b) >= watch_rate else "trusted"
    return found | {None: "watched" if m >= watch_rate else "trusted"}


def good(n):
    return " ".join(f"word{n}x{i}" for i in range(20))


def weak(n):
    return " ".join(f"w{n}x{i}$$" for i in range(20))


def planted(hosts, weak_ones=2):
    """Documents of hosts, (n, failed) each: of those that fail, the first few fail a weak rule only."""
    rows = []
    for h, (n, failed) in hosts.items():
        rows += [(len(rows) + i, (weak(i) if i < weak_ones else "too short") if i < failed else good(i), "en", h) for i in range(n)]
    return rows


@pytest.mark.parametrize(
    ("hosts", "wanted"),
    [
        # hosts that differ: even one of three documents is rejected, if all fail
        ({"bad3000": (3000, 2990), "bad30": (30, 30), "bad3": (3, 3), "good3000": (3000, 5), "good30": (30, 0), "good3": (3, 0), "fair": (400, 60)}, ["bad3", "bad30", "bad3000"]),
        # hosts that are much alike: a small one says little against that
        ({**{f"h{i}": (400, 50 + i) for i in range(12)}, "bad3": (3, 3), "good3": (3, 0), "bad300": (300, 299), "good3000": (3000, 30)}, ["bad300"]),
    ],
)
def test_verdicts(documents, hosts, wanted):
    rows = planted(hosts)
    rows += [(1_000_000 + i, "too short", "en", None) for i in range(50)] + [(2_000_000, good(1), "en", None), (2_000_001, weak(1), "en", None)]
    table, prior = host_rules.host_verdicts(host_rules.document_counts(documents(rows)))
    verdict = {r["host"]: r["verdict"] for r in table.collect()} | {None: prior.default}
    assert verdict == posterior(hosts)
    assert sorted(h for h, v in verdict.items() if v == "rejected") == wanted
    assert verdict["good3"] in ("watched", "trusted") and verdict["good3000"] == "trusted" and verdict[None] == "watched"
    found = {r["doc_id"]: r for r in host_rules.apply_host_rules(documents(rows)).collect()}
    for doc, text, _, host in rows:
        is_weak = "$$" in text
        assert found[doc]["verdict"] == verdict[host] and found[doc]["base_failed"] == (text == "too short")
        assert found[doc]["kept"] == (text != "too short" and verdict[host] != "rejected" and not (is_weak and verdict[host] == "watched"))
    # the verdict decides: the same weak text stays at one host and goes at another, a good one goes at a rejected host
    stays = {found[d]["kept"] for d, t, _, h in rows if "$$" in t and h is not None}
    assert stays == {True, False} and any(t.startswith("word") and not found[d]["kept"] for d, t, _, h in rows)


def test_a_verdict_decides_on_the_test_tables(spark):
    """On the given tables documents go by their host's verdict, and hardly one of those is labelled good."""
    from pathlib import Path

    data = Path("/root/testdata/sf0.01")
    if not data.exists():
        pytest.skip("no test tables")
    found = host_rules.apply_host_rules(spark.read.parquet(f"{data}/documents.parquet"))
    labels = spark.read.parquet(f"{data}/labels.parquet").select("doc_id", "quality")
    gone = found.where("not kept and not base_failed").join(labels, "doc_id", "left").collect()
    assert len(gone) > 20 and sum(r["quality"] == 1 for r in gone) <= 0.02 * len(gone)


@pytest.mark.parametrize("rows", [[(1, good(1), "en", "h")], [(1, None, "en", None)], [(1, good(1), "en", "h"), (1, good(1), "en", "h"), (None, good(2), "en", "i")]])
def test_edges(documents, rows):
    found = host_rules.apply_host_rules(documents(rows)).collect()
    assert len(found) == len(rows) and all(r["kept"] == (r["n_words"] >= 10) for r in found)


def test_ties_and_a_long_text(documents):
    # alpha / (alpha + beta) of a uniform prior is a half: without failures no rate counts, whatever the bounds
    found = host_rules.apply_host_rules(documents([(1, good(1), "en", "h"), (2, "x y z " * 300_000, "en", "h")]), watch_rate=0.0).collect()
    assert {r["doc_id"]: (r["kept"], r["n_words"]) for r in found} == {1: (True, 20), 2: (False, 900_000)}
    prior = host_rules.HostPrior(1.0, 19.0)
    assert prior.default == host_rules.WATCHED and host_rules.HostPrior(1.0, 19.1).default == host_rules.TRUSTED


def test_empty_table(documents):
    assert host_rules.apply_host_rules(documents([(1, "x")]).limit(0)).count() == 0
