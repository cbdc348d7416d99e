from pathlib import Path

import pytest

import corpus_pipeline as pipeline
from weir.llm import contamination, language, line_dedup, simhash
from weir.llm.common import fold

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def documents_table(spark):
    if not DATA.exists():
        pytest.skip("no test tables")
    return spark.read.parquet(f"{DATA}/documents.parquet")


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_in_order(spark, documents_table):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "pack"]
    docs, before = documents_table, ids(documents_table)
    for n, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(DATA))
        assert tuple(out.columns) == pipeline.COLUMNS and out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType, name
        after = ids(out)
        assert after <= before and len(after) > 0.5 * len(before), name
        before, docs = after, spark.createDataFrame(out.collect(), out.schema)
    packed = pipeline.STAGES[-1][1](spark, docs, str(DATA)).collect()
    assert {r["doc_id"] for r in packed} == before
    ran = pipeline.run(spark, str(DATA)).collect()
    key = lambda rows: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    assert {r["doc_id"] for r in ran} == before and sum(r["length"] for r in ran) == sum(r["length"] for r in packed)
    assert len(key(ran)) == len(key(packed))


def test_each_stage_takes_its_operators_decision(spark, documents_table):
    docs = documents_table
    model = language.fit(docs, ~fold(3, 1))
    rejected = {r["doc_id"] for r in language.predict(docs, model, "doc_id").where("rejected").collect()}
    assert ids(pipeline.language_id(spark, docs, str(DATA))) == ids(docs) - rejected
    lines = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs.select(*pipeline.COLUMNS)).collect()}
    kept = {r["doc_id"]: r for r in pipeline.dedup_lines(spark, docs, str(DATA)).collect()}
    assert all(kept[d]["text"] == r["text"] for d, r in lines.items() if d in kept)
    assert all(not (lines[d]["text"].split()) for d in lines.keys() - kept.keys())
    assert all(r["n_chars"] == len(r["text"]) for r in kept.values())
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, **pipeline.NEAR).collect()}
    assert ids(pipeline.near_dedup(spark, docs, str(DATA))) == set(groups.values())
    bad = {r["doc_id"] for r in contamination.contamination(docs, spark.read.parquet(f"{DATA}/benchmark.parquet")).where("contaminated").collect()}
    assert bad and ids(pipeline.decontaminate(spark, docs, str(DATA))) == ids(docs) - bad


def test_edges(spark, documents, widened):
    df = widened(documents([(1, None), (1, None), (2, ""), (None, "some words here"), (None, None), (3, "some words here")]))
    for name, stage in pipeline.STAGES:
        stage(spark, df, str(DATA)).collect()
        assert stage(spark, df.limit(0), str(DATA)).count() == 0, name


def test_what_a_stage_wrote_for_itself_goes(spark, documents_table):
    from weir.sources.shared import shared_folder

    found = pipeline.run(spark, str(DATA))
    root = Path(shared_folder(spark).removeprefix("file:")) / f"weir-{spark.sparkContext.applicationId}"
    left = {p.name.rsplit("-", 1)[0] for p in root.iterdir() if p.name.startswith("stage-")}
    assert "stage-decontaminate" in left and found.count() > 0


def test_without(spark, documents, monkeypatch):
    from weir.llm import common

    docs = documents([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (3, "e")])
    gone = spark.createDataFrame([(2,), (2,), (None,), (9,)], "doc_id long")
    for bound in (10, 0):
        monkeypatch.setattr(common, "MAX_BROADCAST_IDS", bound)
        assert sorted(r["text"] for r in common.without(docs, gone).collect()) == ["a", "d", "e"]
    assert common.without(docs, gone.limit(0)).count() == 5
