import json
import socket
import urllib.error
import urllib.request
from base64 import b64encode

import pytest

from weir.operators import tables
from weir.operators.rows import encode_rows, typed_rows
from weir.operators.tables import ADDED, CREATED, UNCHANGED, TableError, check_partitioning, ensure_table, table_name
from weir.plans.catalog import FROZEN, TABLES, row_path
from weir.plans.tables import ColumnSpec, TableSpec
from weir.sources.capture import read_capture, stream_capture
from weir.streaming import engine
from weir.streaming.engine import RunOptions, Stopper, Writer, forget, options_from_env, start
from weir.streaming.health import serve
from weir.streaming.remote import FaultyService
from weir.streaming.service import HttpService, serve_rows
from weir.streaming.metrics import Metrics, Progress, chunked, lag_by_topic, pipeline_tags, push, worker_tags


def write_lines(path, offsets, value=lambda o: {"a": o}):
    e = lambda x: b64encode(x).decode()
    with open(path, "w") as file:
        for o in offsets:
            v = value(o)
            own = {"topic": "events", "partition": o % 2, "offset": o, "timestamp_type": "create", "timestamp": 1_700_000_000_000, "headers": None}
            file.write(json.dumps(own | {"key": e(b'{"user_id":%d}' % o), "value": None if v is None else e(v if isinstance(v, bytes) else json.dumps(v).encode())}) + "\n")


def path_for(name, **options):
    path = row_path("json_events", **options)
    table = TableSpec(name, TABLES["json_events"], ("user_id",), "DAY", "__inserted_at")
    path.topics, path.tables = {"events": name}, {name: table}
    return path


def run(spark, tmp_path, path, **options):
    writer = Writer(path, RunOptions(f"{tmp_path}/cp", once=True, inserted_at=FROZEN, **options))
    query = start(stream_capture(spark, f"{tmp_path}/in", 1), writer)
    query.awaitTermination()
    return writer


def test_replay_equals_batch_and_restart_loses_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_lines(f"{tmp_path}/in/1.ndjson", range(10), lambda o: None if o == 3 else {"a": o})
    path = path_for("p.s1.rows", max_row_bytes=1000)
    writer = run(spark, tmp_path, path)
    write_lines(f"{tmp_path}/in/2.ndjson", range(10, 15), lambda o: {"a": "x" * 2000} if o == 12 else {"a": o})
    run(spark, tmp_path, path)
    live = spark.table("s1.rows")
    batch = encode_rows(read_capture(spark, f"{tmp_path}/in"), path, FROZEN)
    rows = typed_rows(batch, path.tables["p.s1.rows"]).select("user_id", "payload").collect()
    found = {(r["user_id"], r["payload"]) for r in live.collect()}
    assert len(found) == live.count() == 14 and found - {(r["user_id"], r["payload"]) for r in rows} == {(12, json.dumps({"a": "x" * 2000}).replace(" ", ""))}
    assert {r["_partition"] for r in live.select("_partition").collect()} == {"2026-01-01"}
    assert writer.metrics.totals["messages"] == 10 and writer.metrics.totals["skipped_empty_value"] == 1


def test_a_bad_message_stops_the_query_and_a_restart_resumes(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    write_lines(f"{tmp_path}/in/1.ndjson", range(3), lambda o: b"{bad" if o == 1 else {"a": o})
    path = path_for("p.s2.rows")
    with pytest.raises(Exception, match="source"):
        run(spark, tmp_path, path)
    assert not spark.catalog.tableExists("s2.rows")
    run(spark, tmp_path, path, quarantine=f"{tmp_path}/bad")
    assert sorted(r["user_id"] for r in spark.table("s2.rows").collect()) == [0, 2]
    assert [r["offset"] for r in spark.read.parquet(f"{tmp_path}/bad").collect()] == [1]


def users(spark, name):
    spark.catalog.refreshTable(name)  # a stream's session is its own
    return sorted(r["user_id"] for r in spark.table(name).collect())


def test_a_dry_run_takes_nothing_from_the_real_one(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_lines(f"{tmp_path}/in/1.ndjson", range(3))
    path = path_for("p.s7.rows")
    writer = run(spark, tmp_path, path, dry_run=True)
    assert users(spark, "s7.rows") == [0, 1, 2] and (tmp_path / "cp" / f"dry-{writer.options.run_id}").exists()
    forget(spark, writer.options)
    assert not list((tmp_path / "cp").iterdir())
    write_lines(f"{tmp_path}/in/1.ndjson", range(6))  # all of it is the real run's first batch
    real = run(spark, tmp_path, path)
    forget(spark, real.options)
    assert users(spark, "s7.rows") == [0, 0, 1, 1, 2, 2, 3, 4, 5] and (tmp_path / "cp/query").exists()


def test_a_reset_of_the_offsets_takes_the_records_along(spark, tmp_path):
    import shutil

    (tmp_path / "in").mkdir()
    write_lines(f"{tmp_path}/in/1.ndjson", range(2))
    path = path_for("p.s8.rows")
    run(spark, tmp_path, path)
    shutil.rmtree(tmp_path / "cp/query")
    write_lines(f"{tmp_path}/in/2.ndjson", range(2, 4))
    run(spark, tmp_path, path)
    assert set(users(spark, "s8.rows")) == {0, 1, 2, 3}


def test_a_loss_between_append_and_record_loses_no_row(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    write_lines(f"{tmp_path}/in/1.ndjson", range(3))
    path = path_for("p.s9.rows")
    with monkeypatch.context() as m:
        m.setattr(engine.Writer, "_record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            run(spark, tmp_path, path)
    run(spark, tmp_path, path)
    assert users(spark, "s9.rows") == [0, 0, 1, 1, 2, 2]  # at least once: what was not recorded is appended again


def test_records_go_with_their_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(4):
        write_lines(f"{tmp_path}/in/{n}.ndjson", range(n, n + 1))
    path = path_for("p.s10.rows")
    run(spark, tmp_path, path)
    run(spark, tmp_path, path)
    (query,) = (tmp_path / "cp/query/appended").iterdir()
    assert query.name in (tmp_path / "cp/query/metadata").read_text()
    assert [p.name for p in query.iterdir()] == ["3"] and users(spark, "s10.rows") == [0, 1, 2, 3]


def test_a_run_against_a_service_that_fails_delivers_all(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_lines(f"{tmp_path}/in/1.ndjson", range(30), lambda o: {"a": "x" * 2000} if o == 12 else {"a": o})
    write_lines(f"{tmp_path}/in/2.ndjson", range(30, 40))
    path = path_for("p.s11.rows", max_row_bytes=1000)
    service = FaultyService(every_n=3, close_after=2)
    server = serve_rows(service)
    url = f"http://127.0.0.1:{server.server_address[1]}"
    try:
        writer = Writer(path, RunOptions(f"{tmp_path}/cp", once=True, inserted_at=FROZEN, max_rows_per_request=4, request_budget_s=60), connect=lambda: HttpService(url, sleep=lambda s: None))
        query = start(stream_capture(spark, f"{tmp_path}/in", 1), writer)
        query.awaitTermination()
    finally:
        server.shutdown()
    batch = encode_rows(read_capture(spark, f"{tmp_path}/in"), path, FROZEN)
    assert set(service.taken["p.s11.rows"]) == {bytes(r["row_bytes"]) for r in batch.where("outcome = 'row'").collect()}
    assert len(set(service.taken["p.s11.rows"])) == 39 and len(service.loaded["p.s11.rows"]) == 1 and not service.violations
    totals = writer.metrics.by_table["p.s11.rows"]
    assert totals["rows"] == 39 and totals["large_rows"] == totals["loads"] == 1 and totals["retries"] > 0 and totals["acks"] == 2
    assert "weir_append_ms_max" in writer.metrics.prometheus()


def test_columns_that_were_added_begin_the_grace_time(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_lines(f"{tmp_path}/in/1.ndjson", range(2))
    path = path_for("p.s12.rows")
    assert run(spark, tmp_path, path).columns_added_at is None
    wider = TableSpec("p.s12.rows", (*TABLES["json_events"], ColumnSpec("more", "STRING")), ("user_id",), "DAY", "__inserted_at")
    path.tables = {"p.s12.rows": wider}
    write_lines(f"{tmp_path}/in/2.ndjson", range(2, 4))
    assert run(spark, tmp_path, path).columns_added_at is not None
    assert spark.table("s12.rows").where("more is null").count() == 4


def test_a_failure_between_tables_does_not_append_twice(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    write_lines(f"{tmp_path}/in/1.ndjson", range(3))
    path = path_for("p.s3.a")
    write = tables.append
    monkeypatch.setattr(engine.Writer, "_failed", lambda *a: None)
    calls = []

    def append(rows, table, *more):
        calls.append(table.name)
        write(rows, table, *more)
        if len(calls) == 1:
            raise_after.append(True)

    raise_after: list = []
    monkeypatch.setattr(tables, "append", append)
    counts = engine.Writer._record

    def record(self, spark_, epoch, name):
        counts(self, spark_, epoch, name)
        if raise_after:
            raise_after.clear()
            raise RuntimeError("lost after the append was recorded")

    monkeypatch.setattr(engine.Writer, "_record", record)
    with pytest.raises(Exception, match="lost after"):
        run(spark, tmp_path, path)
    run(spark, tmp_path, path)
    assert spark.table("s3.a").count() == 3 and calls == ["p.s3.a"]


def test_tables(spark):
    one = TableSpec("p.dd.t", (ColumnSpec("a", "INTEGER", True, "it's"), ColumnSpec("at", "TIMESTAMP")), (), "DAY", "at")
    assert ensure_table(spark, one).result == CREATED
    assert ensure_table(spark, one).result == UNCHANGED
    two = TableSpec("p.dd.t", (*one.columns, ColumnSpec("b", "FLOAT", True)), (), "DAY", "at")
    added = ensure_table(spark, two)
    assert added.result == ADDED and added.columns == ("b",)
    rows = spark.createDataFrame([(1, "2026-01-02T03:04:05.1", 2.5, "gone"), (2, "2026-01-03 00:00:00.000000", None, "x"), (3, "no time", 1.0, "x")], "a long, at string, b double, extra string")
    tables.append(rows, two, 1)
    assert {r["a"]: r["_partition"] for r in spark.table("dd.t").collect()} == {1: "2026-01-02", 2: "2026-01-03", 3: "__null__"}
    assert spark.table("dd.t").columns == ["a", "at", "b", "_partition"] or set(spark.table("dd.t").columns) == {"a", "at", "b", "_partition"}
    assert table_name("a.b.c") == ("a", "b", "c")
    for bad in ("a.b", "a.b.c.d", "a..c"):
        with pytest.raises(TableError):
            table_name(bad)


@pytest.mark.parametrize(("kind", "column", "type_"), [("WEEK", "at", "TIMESTAMP"), ("DAY", "no", "TIMESTAMP"), ("DAY", "at", "STRING"), ("HOUR", "at", "DATE")])
def test_bad_partitioning(kind, column, type_):
    with pytest.raises(TableError):
        check_partitioning(TableSpec("p.d.t", (ColumnSpec("at", type_),), (), kind, column))


def test_metrics_and_health():
    metrics = Metrics(tags={"p": 'a"b'})
    metrics.add({"rows": 5, "errors": 0})
    metrics.add({"rows": 2}, "p.d.t")
    metrics.batch(12)
    text = metrics.prometheus()
    assert 'weir_rows_total{p="a\\"b"} 5' in text and 'weir_table_rows_total{p="a\\"b",table="p.d.t"} 2' in text and "weir_batch_ms_max 12" in text
    first = b"\n".join(metrics.datagrams()).decode()
    assert 'weir.rows:5|c|#p:a"b' in first and "batch_ms_max:12|g" in first
    metrics.add({"rows": 1})
    second = b"\n".join(metrics.datagrams()).decode()
    assert "weir.rows:1|c" in second and "table_rows" not in second and "batch_ms_max:0|g" in second
    assert chunked(["a" * 5, "b" * 5, "c" * 20], 11) == [b"aaaaa\nbbbbb", b"c" * 20]
    state = {"healthy": True}
    server = serve(0, metrics, lambda: state["healthy"], lambda: False)
    try:
        url = f"http://127.0.0.1:{server.server_address[1]}"
        assert urllib.request.urlopen(f"{url}/healthz").status == 200
        assert b"weir_rows_total" in urllib.request.urlopen(f"{url}/metrics").read()
        state["healthy"] = False
        for path, status in (("/healthz", 503), ("/readyz", 503), ("/other", 404)):
            with pytest.raises(urllib.error.HTTPError) as error:
                urllib.request.urlopen(url + path)
            assert error.value.code == status
    finally:
        server.shutdown()


def test_statsd_push():
    with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as server:
        server.bind(("127.0.0.1", 0))
        server.settimeout(5)
        metrics = Metrics()
        metrics.add({"rows": 3})
        push(metrics, *server.getsockname(), every_s=0.05).set()
        assert b"weir.rows:3|c" in server.recv(9000)


def test_options_from_env():
    env = {"WEIR_RUN_LINGER_MS": "250", "WEIR_RUN_ENSURE_TABLES": "false", "WEIR_RUN_HEALTH_PORT": "9", "ENVIRONMENT": "staging", "OTHER": "x"}
    options = options_from_env("cp", env)
    assert (options.linger_s, options.ensure_tables, options.health_port, options.dry_run) == (0.25, False, 9, True)
    assert options_from_env("cp", {}) == RunOptions("cp")


class Query:
    """A query that is busy for some polls and then idle."""

    def __init__(self, busy, error=None, polls=10**9):
        self.busy, self.error, self.polls, self.stopped = busy, error, polls, False

    @property
    def isActive(self):
        self.polls -= 1
        return not self.stopped and self.polls > 0

    @property
    def status(self):
        self.busy -= 1
        return {"isTriggerActive": self.busy > 0}

    def stop(self):
        self.stopped = True

    def exception(self):
        return self.error


def test_stopper():
    asked = Stopper(Query(3), sleep=lambda s: None)
    asked.asked = True
    assert asked.wait() == 0 and asked.query.stopped and asked.query.busy <= 0
    stuck = Stopper(Query(10**9), drain_s=1, sleep=lambda s: None)
    stuck.asked = True
    assert stuck.wait() == 0 and stuck.query.stopped
    assert Stopper(Query(0, "failed", polls=3), sleep=lambda s: None).wait() == 1


def test_progress():
    progress = Progress(Metrics())
    assert not progress.stalled(60) and progress.stalled(0)
    progress.onQueryTerminated(type("E", (), {"exception": "why"}))
    assert progress.failed == "why"


def test_lag_gauges_and_tags():
    assert lag_by_topic('{"t":{"0":5,"1":7}}', '{"t":{"0":9,"1":7,"2":4},"u":{"0":1}}') == {"t": 4}
    assert lag_by_topic("3", "5") == lag_by_topic(None, None) == lag_by_topic("x", "{}") == {}
    source = type("S", (), {"endOffset": '{"t":{"0":5}}', "latestOffset": '{"t":{"0":9}}'})
    event = type("E", (), {"progress": type("P", (), {"batchDuration": 7, "sources": [source]})})
    progress = Progress(Metrics(tags={"pipeline": "x"}))
    progress.onQueryProgress(event)
    assert 'weir_consumer_lag{topic="t"} 4' in progress.metrics.prometheus()
    assert b"weir.consumer_lag:4|g|#pipeline:x,topic:t" in b"\n".join(progress.metrics.datagrams())
    from test_config import BASE, ENV

    from weir.plans.config import load_config

    config = load_config(BASE.replace("  sync_mode", "  stream: s1\n  sync_mode"), ENV)
    assert worker_tags(config, "h") == {"pipeline": "demo", "kafka_cluster": "c", "pod_name": "h"}
    assert pipeline_tags(config) == {"pipeline_name": "demo", "pipeline_stream": "s1", "pipeline_source": "kafka", "kafka_cluster": "c"}
