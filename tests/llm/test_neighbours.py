import numpy as np
import pytest

from weir.llm import neighbours
from weir.llm.common import fold


def corpus(n=300, seed=0):
    rng = np.random.default_rng(seed)
    syllables = ["an", "er", "th", "in", "on", "re", "ti", "es"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(rng.integers(15, 60))]
        good = int(i % 4 > 0)
        rows.append((i, " ".join(words) + "." if good else " ".join(f"{w}{rng.choice(['***', '&&&', '###'])}" for w in words)))
        labels.append((i, good, 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def fitted(spark, documents):
    rows, labels = corpus()
    docs = documents(rows)
    return docs, labels, neighbours.fit(docs, spark.createDataFrame(labels, LABELS), ~fold(4, 2))


def test_held_out_accuracy(fitted):
    docs, labels, model = fitted
    known = dict((d, q) for d, q, _ in labels)
    found = neighbours.score(docs, model).withColumn("held_out", fold(4, 2)).collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == 300 and len(held) > 40
    assert np.mean([r["predicted"] == known[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)


def test_votes_equal_brute_force(fitted):
    docs, _, model = fitted
    texts = [r["text"].encode() for r in docs.limit(40).collect()]
    from weir.llm.features import weighted

    vectors = weighted(neighbours.term_counts(texts), model.idf) @ model.projection
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    for vector, score in zip(vectors, model.scores(texts), strict=True):
        cosines = np.array([vector @ v for v in model.vectors])
        near = np.argsort(-cosines, kind="stable")[: neighbours.NEIGHBOURS]
        votes = np.maximum(cosines[near], 0) ** neighbours.SHARPNESS * model.weights[near]
        assert score == pytest.approx((votes * model.labels[near]).sum() / votes.sum(), abs=1e-3)


def test_latent_space_keeps_the_leading_directions():
    rng = np.random.default_rng(0)
    rows = (rng.standard_normal((60, 3)) * [10, 5, 2]) @ rng.standard_normal((3, 40)) + rng.standard_normal((60, 40)) * 0.01
    space = neighbours.latent(rows.astype(np.float32), 3)
    _, _, exact = np.linalg.svd(rows, full_matrices=False)
    assert space.shape == (40, 3) and np.allclose(np.abs(exact[:3] @ space), np.eye(3), atol=0.02)


def test_sample_is_bounded(spark, documents):
    rows, labels = corpus()
    model = neighbours.fit(documents(rows), spark.createDataFrame(labels, LABELS), per_label=20, max_texts=30)
    assert len(model.labels) <= 30 and model.prior == 0.75


def test_edges(spark, documents, widened):
    rows, labels = corpus(40)
    odd = [*labels, (0, None, 0), (1, 7, 0), (None, 1, 0), (999, 1, 0), (2, 1, 1)]
    model = neighbours.fit(widened(documents([*rows, (None, "x"), (998, None)])), spark.createDataFrame(odd, LABELS))
    df = documents([(1, None), (1, None), (2, ""), (None, "an er"), (3, "th " * 50_000)])
    found = neighbours.score(widened(df), model).collect()
    assert len(found) == 5 and all(0 <= r["score"] <= 1 for r in found)
    assert neighbours.score(df.limit(0), model).count() == 0
    nothing = neighbours.fit(documents(rows), spark.createDataFrame([], LABELS))
    assert [r["score"] for r in neighbours.score(df, nothing).collect()] == [0.5] * 5
    one = neighbours.fit(documents(rows), spark.createDataFrame([(0, 1, 0)], LABELS))
    assert 0 <= neighbours.score(df, one).first()["score"] <= 1
