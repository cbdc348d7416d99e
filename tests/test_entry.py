import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from weir import cli
from weir.plans import catalog, checks

QUERIES = catalog.QUERIES | checks.QUERIES
DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def text(value):
    if value is None or value != value:
        return "null"
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = entry_module.queries()[name](spark, str(DATA))
    names = sorted(frame.columns)
    found = sorted(tuple(map(text, r)) for r in frame.select(*names).collect())
    oracle = duck.sql(entry_module.oracle_sql()[name])
    assert sorted(oracle.columns) == names
    assert found == sorted(tuple(map(text, r)) for r in oracle.select(*[f'"{n}"' for n in names]).fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("kept", ["nothing", "corpus_pipeline.py"])
def test_other_queries_without_the_training_data_part(tmp_path, kept):
    """With the llm folders gone, and the pipeline with them or not, the rest imports and registers all its queries."""
    root = Path(__file__).parent.parent
    gone = {"llm", "tests", ".git", "__pycache__", "corpus_pipeline.py"} - {kept}
    shutil.copytree(root, tmp_path / "repo", ignore=lambda folder, names: gone & set(names))
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, check=True)
    queries, oracle = ran.stdout.splitlines()
    assert queries.split() == sorted(QUERIES) and set(oracle.split()) <= set(QUERIES)


def test_check_config(tmp_path, capsys):
    sys.path.insert(0, str(Path(__file__).parent))
    from test_config import BASE

    (tmp_path / "c.yml").write_text(BASE.replace("WEIR_ENV_SERVERS", "k").replace("WEIR_ENV_BATCH", "5").replace("env://USER_NAME", "me"))
    assert cli.main(["check-config", "--config", f"{tmp_path}/c.yml"]) == 0
    assert "1 topics to 1 tables by json_events" in capsys.readouterr().out


def test_load(spark):
    found = cli.load(spark, 2, 3, 5, 10)
    assert found.count() == 30 and found.first()["payload"] == '{"id":0,"filler":"xxxxxxxxxx"}'
