from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from weir.llm.catalog import ORACLE_SQL, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")

SCHEMAS = {
    "op1_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op2_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op3_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op4_token_ids": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op5_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op7_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op9_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op10_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
}


def test_all_ten_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 11)) and set(SCHEMAS) == set(QUERIES)
    assert set(ORACLE_SQL) <= set(QUERIES) and {*QUERIES, "pipeline"} <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_contract(spark, name):
    frame = entry_module.queries()[name](spark, str(DATA))
    types = dict(frame.dtypes)
    for field in SCHEMAS[name].split(", "):
        column, kind = field.split()
        assert types[column] == kind
    rows = frame.collect()
    docs = {r["doc_id"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect()}
    assert {r["doc_id"] for r in rows} == docs
    assert name == "op2_packing" or len(rows) == len(docs)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    duck = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        duck.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame = QUERIES[name](spark, str(DATA))
    names = sorted(frame.columns)
    oracle = duck.sql(ORACLE_SQL[name])
    assert sorted(oracle.columns) == names
    assert sorted(map(tuple, frame.select(*names).collect())) == sorted(oracle.select(*names).fetchall())


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    languages = QUERIES["op5_language_id"](spark, str(DATA)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in languages) >= 0.95 * len(languages)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    quality = QUERIES["op7_quality"](spark, str(DATA)).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["quality"] == r["predicted"] for r in quality) >= 0.85 * len(quality)
