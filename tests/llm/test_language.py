import numpy as np
import pytest
from pyspark.sql import functions as F

from weir.llm import language
from weir.llm.common import fold
from weir.llm.features import gram_counts, weighted

WORDS = {"en": "the and of to in is you that it he was for on are with as his they at be this from have or by one had not but what all".split(),
         "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass".split(),
         "fr": "le de un être et à il avoir ne je son que se qui ce dans en du elle au pour pas sur faire plus dire me on".split()}


def corpus(n=120, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        rows.append((i, " ".join(rng.choice(WORDS[lang], rng.integers(20, 80))), lang, "s"))
    return rows


@pytest.fixture(scope="module")
def model(documents):
    return language.fit(documents(corpus()), ~fold(3, 1))


def test_grams_equal_a_plain_count():
    texts = [b"", b"a", b"abc", b"abcabc" * 50]
    counts = gram_counts(texts, 64, (2, 3))
    for row, text in zip(counts, texts, strict=True):
        assert row.sum() == sum(max(0, len(text) - n + 1) for n in (2, 3))
    long = bytes(np.random.default_rng(0).integers(97, 123, (1 << 20) + 5000, dtype=np.uint8))
    assert gram_counts([long], 256, (3,)).sum() == len(long) - 2  # across blocks, each once
    assert np.allclose(np.linalg.norm(weighted(counts[2:], np.ones(64, np.float32)), axis=1), 1)


def test_held_out_accuracy(documents, model):
    df = documents(corpus())
    rows = df.withColumn("held_out", fold(3, 1))
    found = language.predict(rows, model, "doc_id", "held_out", "lang").collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == 120 and len(held) > 20
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_prediction_reads_only_the_text(documents, model):
    df = documents(corpus(30))
    other = df.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 1000)
    key = lambda d, off: {r["doc_id"] - off: (r["lang_pred"], r["score"]) for r in language.predict(d, model, "doc_id").collect()}
    assert key(df, 0) == key(other, 1000)


def plain_cosines(model, text):
    """The best cosine of each language, by a plain count of n-grams and a sum over the centroid's columns."""
    from collections import Counter

    counts = Counter()
    raw = language.normalise(text)
    for size in language.SIZES:
        for i in range(len(raw) - size + 1):
            gram = int.from_bytes(raw[i : i + size], "big")
            h = (gram + size) * 2_654_435_761 % 2**32
            counts[(h ^ (h >> 15)) * 2_654_435_761 % 2**32 >> 32 - 12] += 1
    weights = {c: (np.log(n) + 1) * float(model.idf[c]) for c, n in counts.items()}
    norm = sum(w * w for w in weights.values()) ** 0.5
    best = {}
    for row, of in zip(model.centroids, model.of, strict=True):
        cosine = sum(w * float(row[c]) for c, w in weights.items()) / norm
        best[model.languages[of]] = max(cosine, best.get(model.languages[of], -1))
    return best


def test_predictions_equal_brute_force(documents, model):
    """Every text's language and score by all cosines with all centroids, each computed on its own."""
    assert len(model.idf) == 4096 and np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-5)
    texts = [r[1] for r in corpus(40, 5)] + ["x", "the le der", "zzz qqq", "É" * 50]
    found = {r["doc_id"]: r for r in language.predict(documents(texts), model, "doc_id").collect()}
    for n, text in enumerate(texts):
        best = plain_cosines(model, text)
        top = max(best.values())
        score = 1 / sum(np.exp((b - top) / language.TEMPERATURE) for b in best.values())
        assert best[found[n]["lang_pred"]] > top - 1e-5 and abs(found[n]["score"] - score) < 1e-3


def test_labels_are_bounded(documents, monkeypatch):
    from weir.llm import features

    monkeypatch.setattr(features, "MAX_LABELS", 2)
    with pytest.raises(ValueError, match="more than 2"):
        language.fit(documents(corpus(12)))


def test_of_equal_cosines_the_first_language_is_taken():
    idf = np.ones(4096, np.float32)
    row = weighted(gram_counts([language.normalise("abc")], 4096, language.SIZES), idf)
    tied = language.LanguageModel(["aa", "bb"], np.concatenate([row, row]), np.array([0, 1]), idf, np.zeros(language.LENGTHS, np.float32))
    assert tied.predict(["abc"])[0][:2] == ("aa", 0.5)


@pytest.mark.parametrize("text", [None, "", "123 !?", " \n", "\x00", "½ ² ①", "Ⅳ_٣"])
def test_no_letter_is_und(model, text):
    assert model.predict([text]) == [("und", 0.0, True)]


def test_short_and_long_and_junk(model):
    for text in ("the", "é", "THE AND OF TO IN", "the and of " * 100_000):
        assert model.predict([text])[0][0] in WORDS
    assert not model.predict(["the and of to in is you that it he was"])[0][2]


def test_far_texts_are_rejected(documents):
    rows = [(n, " ".join(np.random.default_rng(n).choice(WORDS["en"], 60)), "en", "s") for n in range(200)]
    model = language.fit(documents(rows))
    assert model.predict(["zzqxj " * 60])[0][2]


def syllables(seed, n, words=None):
    """Texts of a made-up language: words of its own syllables, from one to n of them."""
    rng = np.random.default_rng(seed)
    own = ["".join(rng.choice(list("bcdfghklmnprstvz"), 1)) + "".join(rng.choice(list("aeiou"), rng.integers(1, 3))) for _ in range(25)]
    return [" ".join("".join(rng.choice(own, rng.integers(1, 4))) for _ in range(words or rng.integers(5, 200))) for _ in range(n)]


@pytest.fixture(scope="module")
def made_up(documents):
    rows = [(1000 * lang + i, text, f"l{lang}", "s") for lang in (1, 2, 3) for i, text in enumerate(syllables(lang, 150)[:100])]
    return language.fit(documents(rows))


@pytest.mark.parametrize("words", [8, 30, 120, 500, 2000])
def test_unseen_languages_and_random_letters_are_rejected_at_every_length(made_up, words):
    rng = np.random.default_rng(words)
    far = syllables(77, 40, words) + syllables(78, 40, words)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя"):
        far += [" ".join("".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(words)) for _ in range(20)]
    assert np.mean([r[2] for r in made_up.predict(far)]) >= 0.95


def test_held_out_texts_stay_at_every_length(made_up):
    for seed in (1, 2, 3):
        held = syllables(seed, 150)[100:]
        cut = [" ".join(t.split()[:n]) for t in held for n in (1, 2, 4, 8, 16, 32, 64)]
        repeated = [" ".join([w] * 40) for t in held for w in t.split()[:1]]
        for texts, most in ((held, 0.04), (cut, 0.04), (repeated, 0.2)):
            assert np.mean([r[2] for r in made_up.predict(texts)]) <= most


def test_every_length_has_a_floor(made_up):
    assert (made_up.floor > 0).all()
    assert (language.floors(np.arange(5), np.ones(5, np.float32)) == 0).all()  # too few to tell


def test_pieces_are_whole_words_or_characters():
    text = language.normalise("one two three four five six seven eight nine ten eleven twelve " * 20)
    assert len(language.pieces(text)) == 10 and all(set(p.split()) <= set(text.split()) for p in language.pieces(text))
    endless = language.pieces(language.normalise("語" * 1000))
    assert len(endless) > 8 and all(set(p.decode().strip()) == {"語"} for p in endless)
    assert language.pieces(b"") == [] == language.pieces(b" a ")


def test_several_centroids_serve_several_registers():
    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 0.05, (50, 8)) + np.eye(8)[0], rng.normal(0, 0.05, (50, 8)) + np.eye(8)[3]
    rows = np.concatenate((a, b))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centroids = language.cluster(rows.astype(np.float32), 2)
    assert sorted(centroids.argmax(1).tolist()) == [0, 3]
    assert len(language.cluster(rows[:1].astype(np.float32), 5)) == 1


def test_sample_is_bounded_and_copies_count_once(documents):
    from weir.llm.features import labelled_sample

    rows = [(n, "same text", "en", "s") for n in range(300)] + [(1000 + n, f"text {n}", "de", "s") for n in range(300)]
    df = documents(rows).select("lang", "text")
    sample, totals = labelled_sample(df, "lang", 40, 60)
    found = sample.collect()
    assert totals == {"en": 300, "de": 300}
    assert sum(r["lang"] == "de" for r in found) <= 30 and sum(r["lang"] == "en" for r in found) <= 1
    assert sorted(r["text"] for r in sample.collect()) == sorted(r["text"] for r in found)


def test_copies_do_not_thin_a_label(documents):
    from weir.llm.features import labelled_sample

    hot = [(n, f"hot {n % 50}", "en", "s") for n in range(8000)] + [(9000 + n, "only one", "fr", "s") for n in range(2000)]
    rows = hot + [(20_000 + n, f"text {n}", "de", "s") for n in range(2000)]
    sample, totals = labelled_sample(documents(rows).select("lang", "text"), "lang", 40, 6000)
    found = sample.collect()
    by = {k: [r["text"] for r in found if r["lang"] == k] for k in totals}
    assert totals == {"en": 8000, "fr": 2000, "de": 2000}
    assert {k: len(set(v)) for k, v in by.items()} == {k: len(v) for k, v in by.items()} == {"en": 40, "fr": 1, "de": 40}


def test_learning_takes_the_room_of_a_block_beside_its_result():
    import tracemalloc

    import pyarrow as pa

    texts = [f"word {n} of a short text" for n in range(3000)]
    batch = pa.record_batch([pa.array(["en"] * len(texts)), pa.array(texts)], ["lang", "text"])
    language.normalise("a"), gram_counts([b"a"], language.DIMS, language.SIZES)
    room = language.BLOCK_ROWS * language.DIMS * 4  # of a block's counts

    def peak(call):
        tracemalloc.start()
        try:
            return call(), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    made, most = peak(lambda: list(language._vector_batches(iter([batch]), language.DIMS)))
    assert most < 4 * room
    table = pa.Table.from_batches(made)
    assert table.num_rows == len(texts) and table.column("lang").to_pylist() == ["en"] * len(texts)
    assert table.column("pieces").to_pylist() == [language.pieces(language.normalise(t)) for t in texts]
    counts, most = peak(lambda: language._matrix(table.column("counts"), language.DIMS))
    assert most < counts.nbytes + room
    assert np.array_equal(counts, gram_counts([language.normalise(t) for t in texts], language.DIMS, language.SIZES))
    idf = np.linspace(0.05, 3, language.DIMS, dtype=np.float32)
    vectors, most = peak(lambda: language._vectors(counts, idf))
    assert most < counts.nbytes + 6 * room
    assert np.array_equal(vectors, weighted(counts, idf))


def test_every_label_is_sampled(documents):
    from weir.llm.features import labelled_sample

    rows = [(n, f"text {n % 7}", f"l{n % 90}", "s") for n in range(9000)]  # more labels than texts in all
    sample, totals = labelled_sample(documents(rows).select("lang", "text"), "lang", 40, 60)
    assert len(totals) == 90 and {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()} == dict.fromkeys(totals, 1)


def test_nothing_to_learn(documents, widened):
    empty = language.fit(documents([(1, None, "en", "s"), (2, "text", None, "s")]))
    assert empty.predict(["text"]) == [("und", 0.0, True)]
    df = widened(documents([(1, "the and of", None, None), (1, "the and of", None, None), (None, None, None, None)]))
    model = language.fit(documents(corpus(30)))
    assert sorted(r["lang_pred"] for r in language.predict(df, model, "doc_id").collect()) == ["en", "en", "und"]
    assert language.predict(df.limit(0), model, "doc_id").count() == 0
    assert [r["doc_id"] for r in language.keep_known(df, model).collect()] == [1, 1]
