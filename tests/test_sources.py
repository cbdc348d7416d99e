import json
from base64 import b64encode

import pytest

from weir.operators.registry import from_dict, from_folder
from weir.sources import capture
from weir.sources.capture import CaptureSource, first_messages, limited, parse_since, read_capture, stream_capture, write_capture, write_schemas

SCHEMA = "topic string, partition int, offset long, timestamp long, key binary, value binary, headers array<struct<key: string, value: binary>>"
ROWS = [
    ("a", 0, 0, 5, b"k", b"\xff\x00", [("h", b"v"), ("n", None)]),
    ("a", 0, 1, -1, None, None, None),
    ("a", 1, 0, 7, b"", b"", []),
    ("b", 0, 0, 8, b"k", b"v", None),
]


def plain(rows):
    own = lambda x: None if x is None else bytes(x)
    return sorted(
        (r["topic"], r["partition"], r["offset"], r["timestamp"], own(r["key"]), own(r["value"]), None if r["headers"] is None else [(h["key"], own(h["value"])) for h in r["headers"]]) for r in rows
    )


def test_round_trip(spark, tmp_path):
    write_capture(spark.createDataFrame(ROWS, SCHEMA), f"{tmp_path}/c")
    assert plain(read_capture(spark, f"{tmp_path}/c").collect()) == sorted(ROWS)


def lines(path):
    e = lambda x: None if x is None else b64encode(x).decode()
    with open(path, "w") as file:
        for t, p, o, ts, k, v, h in ROWS:
            headers = None if h is None else [[n, e(x)] for n, x in h]
            file.write(json.dumps({"topic": t, "partition": p, "offset": o, "timestamp_type": "create", "timestamp": ts, "key": e(k), "value": e(v), "headers": headers}) + "\n")


def test_data_source(spark, tmp_path):
    lines(f"{tmp_path}/m.ndjson")
    spark.dataSource.register(CaptureSource)
    assert plain(spark.read.format("weir_capture").option("path", f"{tmp_path}/m.ndjson").load().collect()) == sorted(ROWS)
    stream = spark.readStream.format("weir_capture").option("path", f"{tmp_path}/m.ndjson").option("bytes", 150).load()
    query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert plain(spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(ROWS)


@pytest.mark.parametrize("size", [1, 7, 100, 10_000])
def test_ranges_meet_each_line_once(tmp_path, size):
    lines(f"{tmp_path}/m.ndjson")
    end = (tmp_path / "m.ndjson").stat().st_size
    found = [m for part in capture._ranges(0, end, size) for m in capture._lines(f"{tmp_path}/m.ndjson", part)]
    assert [m[:4] for m in found] == [r[:4] for r in ROWS]


def test_a_line_without_its_end_waits(tmp_path):
    lines(f"{tmp_path}/m.ndjson")
    whole = (tmp_path / "m.ndjson").read_bytes()
    stream = capture._CaptureStream(f"{tmp_path}/m.ndjson", 1 << 20)
    (tmp_path / "m.ndjson").write_bytes(whole[:-20])
    first = stream.latestOffset()["byte"]
    assert whole[:first].count(b"\n") == 3 and whole[first - 1 : first] == b"\n"
    (tmp_path / "m.ndjson").write_bytes(whole)
    assert stream.latestOffset()["byte"] == len(whole) == stream.latestOffset()["byte"]


def test_schemas_beside_a_capture(spark, tmp_path):
    write_capture(spark.createDataFrame(ROWS, SCHEMA), f"{tmp_path}/c")
    assert write_schemas([3, 4], from_dict({3: {"type": "record", "name": "X", "fields": []}}), f"{tmp_path}/c/schemas") == 1
    assert list(from_folder(f"{tmp_path}/c/schemas").resolve([3, 4])) == [3]
    assert plain(read_capture(spark, f"{tmp_path}/c").collect()) == sorted(ROWS)


def test_a_limit_of_time(spark):
    slow = spark.range(0, 10**11, 1, 2).selectExpr("sum(id % 7 * (id % 11))")
    assert not limited(spark, 0.5, slow.collect)
    assert limited(spark, 60, lambda: spark.range(3).collect())
    with pytest.raises(ValueError):
        limited(spark, 60, lambda: int("x"))


def test_folder_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines(f"{tmp_path}/in/m.ndjson")
    query = stream_capture(spark, f"{tmp_path}/in", 1).writeStream.format("memory").queryName("folder").trigger(availableNow=True).start()
    query.awaitTermination()
    assert plain(spark.table("folder").collect()) == sorted(ROWS)


def test_first_messages(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    at = lambda d: sorted((r["topic"], r["partition"], r["offset"]) for r in d.collect())
    assert at(first_messages(df, 2)) == [("a", 0, 0), ("a", 0, 1), ("b", 0, 0)]
    assert at(first_messages(df, 5, ["b"])) == [("b", 0, 0)]
    assert at(first_messages(df, 5, since_ms=7)) == [("a", 1, 0), ("b", 0, 0)]
    assert first_messages(df.limit(0), 5).count() == 0


def test_since():
    assert parse_since("5", 0) == 5 and parse_since("2h", 10**9) == 10**9 - 7_200_000 and parse_since("1d", 10**9) == 10**9 - 86_400_000
    with pytest.raises(ValueError):
        parse_since("soon", 0)
