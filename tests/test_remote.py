import pytest

from weir.operators.rows import ROW, encode_rows
from weir.plans.catalog import FROZEN, row_path
from weir.sources.wire import WireRows
from weir.plans.tables import ColumnSpec, TableSpec
from weir.streaming.remote import FaultyService, Retry, Sender, ServiceError, deliver, rest_retry, without_field
from weir.streaming.service import HttpService, packed, serve_rows, unpacked

SCHEMA = "topic string, partition int, offset long, timestamp long, key binary, value binary, headers array<struct<key: string, value: binary>>"


class Clock:
    def __init__(self):
        self.t, self.waits = 0.0, []

    def now(self):
        return self.t

    def sleep(self, s):
        self.waits.append(s)
        self.t += s

    def policy(self, **more):
        return Retry(now=self.now, sleep=self.sleep, **more)


def failing(times, error):
    left = [times]

    def request():
        if left[0]:
            left[0] -= 1
            raise error
        return "done"

    return request


def test_passing_failures_are_tried_again_with_growing_waits():
    clock = Clock()
    assert clock.policy().call(failing(8, ServiceError("UNAVAILABLE"))) == "done"
    assert clock.waits == [1, 2, 4, 8, 16, 32, 60, 60]


def test_a_request_has_a_time():
    clock = Clock()
    with pytest.raises(ServiceError):
        clock.policy().call(failing(99, ServiceError("ABORTED")))
    assert 300 <= clock.t < 420


@pytest.mark.parametrize("error", [ServiceError("PERMISSION_DENIED"), ServiceError("INVALID_ARGUMENT", "schema"), ServiceError("UNAVAILABLE", "", (3,))])
def test_other_failures_are_final(error):
    clock = Clock()
    with pytest.raises(ServiceError):
        clock.policy().call(failing(1, error))
    assert not clock.waits


def test_a_rejected_schema_passes_for_some_time_after_columns_were_added():
    clock = Clock()
    policy = clock.policy(columns_added_at=0.0)
    assert policy.call(failing(2, ServiceError("INVALID_ARGUMENT", "unknown field in Schema"))) == "done"
    with pytest.raises(ServiceError):
        policy.call(failing(1, ServiceError("INVALID_ARGUMENT", "bad value")))
    clock.t = 601
    with pytest.raises(ServiceError):
        policy.call(failing(1, ServiceError("INVALID_ARGUMENT", "schema")))


def test_rest():
    clock = Clock()
    call = rest_retry(now=clock.now, sleep=clock.sleep)
    answers = [(503, ""), (429, ""), (403, "rateLimitExceeded"), OSError("reset"), (200, "ok")]

    def request():
        answer = answers.pop(0)
        if isinstance(answer, OSError):
            raise answer
        return answer

    assert call(request) == "ok" and clock.waits == [1, 2, 4, 8]
    for bad in ((404, "no"), (403, "denied")):
        with pytest.raises(ServiceError):
            call(lambda bad=bad: bad)
    tries = []
    with pytest.raises(ServiceError):
        call(lambda: tries.append(1) or (500, ""))
    assert len(tries) == 8


class Kept(FaultyService):
    def append(self, table, schema, rows):
        super().append(table, schema, rows)
        self.calls = [*getattr(self, "calls", []), rows]


def sent(rows, **limits):
    service = Kept()
    sender = Sender(service, Retry(), TableSpec("p.d.t", (ColumnSpec("a", "STRING"),)), **limits)
    for row in rows:
        sender.add(row)
    sender.flush()
    assert sender.counts["rows"] == len(rows) and sender.counts["requests"] == len(getattr(service, "calls", []))
    return getattr(service, "calls", [])


def test_requests():
    rows = [b"x" * n for n in (10, 10, 10, 95, 1)]
    size = len(TableSpec("p.d.t", (ColumnSpec("a", "STRING"),)).descriptor())
    assert sent(rows, max_rows=2) == [rows[:2], rows[2:4], rows[4:]]
    assert sent(rows, max_rows=100, max_bytes=size + 36) == [rows[:2], rows[2:3], rows[3:4], rows[4:]]
    assert sent([]) == []


def messages(spark, n):
    rows = [("events", 0, i, 1000, b'{"user_id":%d}' % i, b'{"a":%d}' % i, None) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)




def test_delivery_survives_faults(spark):
    path = row_path("json_events")
    outcomes = encode_rows(messages(spark, 50), path, FROZEN)

    # each worker has a service of its own: what comes back are the counts of what was taken
    found = deliver(outcomes, path, lambda: FaultyService(every_n=3, close_after=4), 5, lambda: Retry(sleep=lambda s: None)).collect()
    assert sum(r["rows"] for r in found) == 50 and sum(r["retries"] for r in found) > 0
    with pytest.raises(Exception, match="a bad row"):
        deliver(outcomes, path, lambda: FaultyService(row_error_every_n=2), 5).collect()


def test_service_counts_distinct_rows(spark):
    path = row_path("json_events")
    table = path.tables["p.d.events"]
    one = [bytes(r["row_bytes"]) for r in encode_rows(messages(spark, 5), path, FROZEN).collect()]
    two = [bytes(r["row_bytes"]) for r in encode_rows(messages(spark, 5), path, "2027-01-01T00:00:00").collect()]
    service = FaultyService()
    sender = Sender(service, Retry(), table, 4)
    for row in one + two + two:
        sender.add(row)
    sender.flush()
    number = table.columns[table.places["__inserted_at"]].number
    assert service.distinct(table.name) == 10 and service.distinct(table.name, number) == 5 and not service.violations
    assert without_field(one[0], number) == without_field(two[0], number) != one[0]


def test_parts_of_a_body():
    assert unpacked(packed([b"", b"a" * 300, b"b"])) == [b"", b"a" * 300, b"b"] and unpacked(b"") == []


def test_delivery_over_http_survives_faults(spark):
    """Tasks in worker processes, one server: what it took is every row at least once, large rows as loads."""
    path = row_path("json_events", max_row_bytes=160)
    long = [("events", 0, 100 + i, 1000, b'{"user_id":%d}' % (100 + i), b'{"a":"%s"}' % (b"x" * 500), None) for i in range(3)]
    outcomes = encode_rows(messages(spark, 50).union(spark.createDataFrame(long, SCHEMA)), row_path("json_events", max_row_bytes=400), FROZEN).repartition(3)
    service = FaultyService(every_n=4, close_after=3)
    server = serve_rows(service)
    try:
        url = f"http://127.0.0.1:{server.server_address[1]}"
        found = deliver(outcomes, path, lambda: HttpService(url, sleep=lambda s: None), 5, lambda: Retry(sleep=lambda s: None)).collect()
    finally:
        server.shutdown()
    wanted = {bytes(r["row_bytes"]) for r in outcomes.where("outcome = 'row'").collect()}
    assert set(service.taken["p.d.events"]) == wanted and len(wanted) == 50 and not service.violations
    assert {r["large_json"] for r in outcomes.where("outcome = 'large'").collect()} == set(service.loaded["p.d.events"]) and len(service.loaded["p.d.events"]) == 3
    assert sum(r["rows"] for r in found) == 50 and sum(r["loads"] for r in found) == 3 and sum(r["retries"] for r in found) > 0
    assert all(r["ack_ms_max"] <= r["ack_ms"] for r in found)


def test_errors_over_http():
    server = serve_rows(FaultyService(row_error_every_n=1))
    client = HttpService(f"http://127.0.0.1:{server.server_address[1]}", sleep=lambda s: None)
    with pytest.raises(ServiceError) as error:
        client.append("p.d.t", b"", [b"a"])
    assert (error.value.code, error.value.rows) == ("INVALID_ARGUMENT", (0,))
    server.shutdown()
    server.server_close()
    with pytest.raises(ServiceError) as error:
        HttpService("http://127.0.0.1:9").append("p.d.t", b"", [b"a"])
    assert error.value.code == "UNAVAILABLE"


def test_wire_files(spark, tmp_path):
    spark.dataSource.register(WireRows)
    path = row_path("json_events")
    rows = encode_rows(messages(spark, 20), path, FROZEN).where(f"outcome = '{ROW}'").select("destination_id", "row_bytes")
    rows.write.format("weir_rows").mode("append").option("path", f"{tmp_path}/w").save()
    read = lambda: sorted((r["destination_id"], bytes(r["row_bytes"])) for r in spark.read.format("weir_rows").option("path", f"{tmp_path}/w").load().collect())
    wanted = sorted((r["destination_id"], bytes(r["row_bytes"])) for r in rows.collect())
    assert read() == wanted
    rows.limit(0).write.format("weir_rows").mode("append").option("path", f"{tmp_path}/w").save()
    assert read() == wanted
    with pytest.raises(Exception):
        bad = rows.selectExpr("if(length(row_bytes) > 0, cast(raise_error('stop') as string), destination_id) AS destination_id", "row_bytes")
        bad.write.format("weir_rows").mode("append").option("path", f"{tmp_path}/w").save()
    assert read() == wanted


def test_wire_stream(spark, tmp_path):
    spark.dataSource.register(WireRows)
    path = row_path("json_events")
    messages(spark, 12).write.parquet(f"{tmp_path}/in")
    stream = encode_rows(spark.readStream.schema(messages(spark, 1).schema).parquet(f"{tmp_path}/in"), path, FROZEN).select("destination_id", "row_bytes")
    query = stream.writeStream.format("weir_rows").option("path", f"{tmp_path}/w").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.format("weir_rows").option("path", f"{tmp_path}/w").load().count() == 12
