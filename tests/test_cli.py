import json
import signal
from base64 import b64encode

import pytest

from weir import cli
from weir.sources.capture import read_capture

CONFIG = """
name: demo
source:
  name: kafka
  sync_mode: stream
  topics: [{name: events, destination_id: p.cli.rows}]
  bootstrap_servers: k
  message_encoding: utf-8
  authentication: {type: basic, params: {username: me}}
destination:
  name: bigquery_streaming_v2
  config:
    project_id: p
    dataset_id: cli
    unnest: true
    time_partitioning: {type: DAY, field: __event_timestamp}
    record_schemas:
    - destination_id: p.cli.rows
      clustering_keys: [user_id]
      record_schema:
      - {name: user_id, type: INTEGER, mode: REQUIRED}
      - {name: payload, type: JSON}
      - {name: __operation, type: STRING}
      - {name: __cluster, type: STRING}
      - {name: __kafka_partition, type: INTEGER}
      - {name: __kafka_offset, type: INTEGER}
      - {name: __kafka_topic, type: STRING}
      - {name: __schema, type: JSON}
      - {name: __event_timestamp, type: TIMESTAMP}
      - {name: __inserted_at, type: TIMESTAMP, default_value_expression: CURRENT_TIMESTAMP()}
transforms:
- label: any
  builtin: {name: json_events, cluster: c}
engine: {runner: {type: stream}}
"""


@pytest.fixture
def files(tmp_path):
    (tmp_path / "c.yml").write_text(CONFIG)
    (tmp_path / "in").mkdir()
    e = lambda x: b64encode(x).decode()
    with open(tmp_path / "in/1.ndjson", "w") as file:
        for o in range(6):
            own = {"topic": "events", "partition": 0, "offset": o, "timestamp_type": "create", "timestamp": 1_700_000_000_000 + o, "headers": None}
            file.write(json.dumps(own | {"key": e(b'{"user_id":%d}' % o), "value": e(b'{"a":%d}' % o)}) + "\n")
    handlers = [signal.getsignal(s) for s in (signal.SIGTERM, signal.SIGINT)]
    yield tmp_path
    for s, h in zip((signal.SIGTERM, signal.SIGINT), handlers, strict=True):
        signal.signal(s, h)


def test_run(spark, files, monkeypatch):
    monkeypatch.setenv("WEIR_RUN_HEALTH_PORT", "0")
    args = ["run", "--config", f"{files}/c.yml", "--checkpoint", f"{files}/cp", "--capture", f"{files}/in", "--once"]
    assert cli.main(args) == 0
    rows = spark.table("cli.rows").collect()
    assert sorted(r["user_id"] for r in rows) == list(range(6)) and {r["_partition"] for r in rows} == {"2023-11-14"}
    assert cli.main(args) == 0 and spark.table("cli.rows").count() == 6
    (files / "in/2.ndjson").write_text('{"topic": "events", "partition": 0, "offset": 9, "timestamp": 1, "key": null, "value": "e30="}\n')
    assert cli.main(args) == 1  # a required column is missing


def test_capture(spark, files, capsys):
    args = ["capture", "--config", f"{files}/c.yml", "--capture", f"{files}/in", "--out", f"{files}/out", "--per-topic", "4", "--since", "1700000000001"]
    assert cli.main(args) == 0 and "events: 4" in capsys.readouterr().out
    assert sorted(r["offset"] for r in read_capture(spark, f"{files}/out").collect()) == [1, 2, 3, 4]


def test_smoke(spark, tmp_path, capsys):
    assert cli.main(["smoke", "--writers", "2", "--batches", "3", "--rows", "5", "--filler", "10", "--out", f"{tmp_path}/s"]) == 0
    assert spark.read.parquet(f"{tmp_path}/s").count() == 30 and "rows 30" in capsys.readouterr().out


def test_smoke_and_run_against_a_service(spark, files, tmp_path, capsys, monkeypatch):
    from weir.streaming.remote import FaultyService
    from weir.streaming.service import serve_rows

    monkeypatch.setenv("WEIR_RUN_HEALTH_PORT", "0")
    service = FaultyService(close_after=5)
    server = serve_rows(service)
    url = f"http://127.0.0.1:{server.server_address[1]}"
    try:
        assert cli.main(["smoke", "--writers", "2", "--batches", "2", "--rows", "5", "--filler", "10", "--service", url]) == 0
        assert "rows 20" in capsys.readouterr().out and service.distinct("p.d.smoke") == 10
        assert cli.main(["run", "--config", f"{files}/c.yml", "--checkpoint", f"{files}/cp2", "--capture", f"{files}/in", "--once", "--service", url]) == 0
        assert service.distinct("p.cli.rows") == 6 and not service.violations
    finally:
        server.shutdown()
    with pytest.raises(SystemExit):
        cli.main(["smoke"])
