import io
import random
import urllib.error

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weir.operators import delivery
from weir.operators.delivery import OffsetTracker
from weir.operators.registry import RegistryError, from_dict, from_folder, from_http


def test_commit_prefix(spark):
    rows = [("t", 0, o, o not in (3, 5)) for o in range(8)] + [("t", 1, o, True) for o in (2, 4)] + [("u", 0, 0, False)]
    found = {(r["topic"], r["partition"]): r["commit"] for r in delivery.commit_prefix(spark.createDataFrame(rows, "topic string, partition int, offset long, done boolean")).collect()}
    assert found == {("t", 0): 3, ("t", 1): 5, ("u", 0): None}


def test_lag(spark):
    rows = [("t", 0, True, 5), ("t", 1, True, -1), ("t", -1, True, 9), ("t", 2, False, 9), ("u", 0, True, 0)]
    found = delivery.consumer_lag(spark.createDataFrame(rows, "topic string, partition int, desired boolean, consumer_lag long"))
    assert {r["topic"]: r["lag"] for r in found.collect()} == {"t": 5, "u": 0}


@pytest.mark.parametrize("n", [0, 1, 2, 100, 101])
def test_latencies(spark, n):
    values = [random.Random(n).randint(0, 50) for _ in range(n)]
    row = delivery.latency_summary(spark.createDataFrame([(v,) for v in values], "ms long")).first()
    values.sort()
    at = lambda p: values[min(int(n * p), n - 1)] if n else None
    assert tuple(row) == (n, at(0.5), at(0.99), values[-1] if n else None)


def test_distinct_and_compare(spark):
    a = spark.createDataFrame([(1, "x", "t1"), (1, "x", "t2"), (2, None, "t1")], "k int, v string, at string")
    assert tuple(delivery.distinct_rows(a, "at").first()) == (3, 2)
    one = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    two = spark.createDataFrame([(1, "x"), (2, None), (4, "z")], "k int, v string").union(spark.createDataFrame([(5, "a")], "k int, v string"))
    found = {r["verdict"]: r["n"] for r in delivery.compare(one, two, ["k"], ["v"]).collect()}
    assert found == {"matched": 2, "only_left": 1, "only_right": 2}


def test_tracker():
    t = OffsetTracker()
    assert t.track("t", 0, 1) is None
    t.assign("t", 0)
    a, b, c = (t.track("t", 0, o, now=o) for o in (5, 6, 9))
    assert t.committable() == [] and t.oldest_age(10) == 5
    t.done(b)
    assert t.committable() == []
    t.done(a)
    assert t.committable() == [("t", 0, 9)]
    t.done(c)
    assert t.committable() == [("t", 0, 10)] and t.oldest_age(10) is None
    late = t.track("t", 0, 10)
    t.revoke("t", 0)
    t.assign("t", 0)
    t.track("t", 0, 10)
    t.done(late)  # an older generation
    assert t.committable() == []


@settings(deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=30))
def test_tracker_prefix(done):
    t = OffsetTracker()
    t.assign("t", 0)
    tickets = [t.track("t", 0, o) for o in range(len(done))]
    for ticket, d in zip(tickets, done, strict=True):
        if d:
            t.done(ticket)
    prefix = next((i for i, d in enumerate(done) if not d), len(done))
    assert t.committable() == ([("t", 0, prefix)] if prefix else [])


def test_registries(tmp_path):
    (tmp_path / "7.json").write_text('{"type": "record", "name": "Other", "fields": []}')
    registry = from_folder(str(tmp_path))
    assert registry.resolve([7, 8]) == {7: {"type": "record", "name": "Envelope", "fields": []}}
    assert from_dict({1: "long"}).resolve([1]) == {1: "long"}


def test_http_registry():
    answers, waits, asked = [OSError("down"), 503, 429, b'{"type":"long"}'], [], []

    def opened(request, timeout):
        asked.append((request.full_url, request.get_header("Authorization")))
        answer = answers.pop(0)
        if isinstance(answer, int):
            raise urllib.error.HTTPError(request.full_url, answer, "", {}, None)
        if isinstance(answer, Exception):
            raise answer
        return io.BytesIO(answer)

    registry = from_http("http://r/", "u", "p", waits.append, opened)
    assert registry.resolve([5]) == {5: {"type": "long", "name": "Envelope"}} and registry.resolve([5])
    assert waits == [0.5, 1.0, 2.0] and asked[0] == ("http://r/apis/registry/v2/ids/globalIds/5", "Basic dTpw")
    answers[:] = [404]
    assert 6 not in registry.resolve([6])
    answers[:] = [401]
    with pytest.raises(RegistryError):
        registry.resolve([8])
    answers[:] = [OSError("down")] * 10
    with pytest.raises(RegistryError):
        registry.resolve([9])


def test_commits_and_offsets_in_flight_of_some_partitions():
    tracker = OffsetTracker()
    tickets = []
    for partition in (0, 1):
        tracker.assign("t", partition)
        tickets += [tracker.track("t", partition, o) for o in (3, 4)]
    tracker.done(tickets[0])
    tracker.done(tickets[2])
    assert tracker.committable() == [("t", 0, 4), ("t", 1, 4)] and tracker.committable({("t", 1)}) == [("t", 1, 4)] and tracker.committable([]) == []
    assert tracker.in_flight() == 2 and tracker.in_flight({("t", 0)}) == 1 and tracker.in_flight({("u", 0)}) == 0
