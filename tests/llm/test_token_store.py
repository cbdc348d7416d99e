import glob
import zlib

import numpy as np
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from weir.llm import token_store
from weir.llm.tokens import default_tokenizer


def expected(rows):
    t = Tokenizer.from_file(default_tokenizer())
    return [(d, np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")) for d, x in rows]


def rows_of(n=300, seed=0):
    rng = np.random.default_rng(seed)
    ids = rng.permutation(n * 3)[:n].tolist()
    return [(int(d), " ".join(rng.choice(["alpha", "beta,", "Gamma", "日本", "x1"], rng.integers(0, 40)))) for d in ids] + [(5000, None), (5001, ""), (-7, "first"), (6000, "long " * 30_000)]


def test_digests_equal_brute_force(spark, documents, widened, tmp_path):
    rows = rows_of()
    token_store.write_tokens(widened(documents(rows)), f"{tmp_path}/t", shards=5)
    found = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_store.token_digests(spark, f"{tmp_path}/t").collect()}
    at = 0
    for doc, ids in sorted(expected(rows), key=lambda r: r[0]):
        assert found[doc] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_files_are_in_order_with_their_encodings(spark, documents, tmp_path):
    token_store.write_tokens(documents(rows_of(4000)), f"{tmp_path}/t", shards=4, row_group_bytes=1 << 13, page_bytes=1 << 12, page_rows=20)
    files = sorted(glob.glob(f"{tmp_path}/t/*.parquet"))
    ids = [d for f in files for d in pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()]
    assert len(files) > 1 and ids == sorted(ids)
    meta = [pq.ParquetFile(f).metadata for f in files]
    assert any(m.num_row_groups > 1 for m in meta)
    for m in meta:
        columns = {m.row_group(0).column(c).path_in_schema: m.row_group(0).column(c) for c in range(m.num_columns)}
        assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
        assert columns["doc_id"].encodings == ("DELTA_BINARY_PACKED",) or "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert columns["doc_id"].has_offset_index and columns["doc_id"].has_column_index


def test_selective_reads(spark, documents, tmp_path):
    token_store.write_tokens(documents(rows_of()), f"{tmp_path}/t", shards=3)
    plan = token_store.read_tokens(spark, f"{tmp_path}/t").where("doc_id = 5").select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1] and "EqualTo(doc_id,5)" in plan


def test_repeated_and_null_ids(spark, documents):
    rows = [(2, "b b"), (2, "a"), (2, "a"), (None, "null first"), (1, "one")]
    found = token_store.store_and_digest(documents(rows), shards=3).collect()
    wanted = {(d, len(i), zlib.crc32(i.tobytes())) for d, i in expected(rows)}
    assert {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found} == wanted
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])] == [None, 1, 2, 2, 2]


def test_empty_table(documents):
    assert token_store.store_and_digest(documents([(1, "x")]).limit(0)).count() == 0
