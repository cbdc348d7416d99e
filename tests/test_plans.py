"""What Catalyst makes of the registered queries: pruned scans, native expressions, partial aggregation."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from weir.operators.spread import estimated_bytes, spread

DATA = Path("/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def plan(spark, name):
    return entry_module.queries()[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()


def columns(text):
    return {c.split(":")[0] for c in re.findall(r"ReadSchema: struct<(.*?)>\n", text + "\n")[0].split(",")}


NATIVE = {
    "framing_ids": {"o_orderkey"}, "topic_routing_counts": {"event_id", "event_type", "value", "props"}, "unrouted_topics": {"event_id"},
    "event_timestamp_format": {"event_id", "ts"}, "commit_prefix": {"event_id", "user_id"}, "consumer_lag_by_topic": {"event_type", "user_id"},
    "ack_latency_percentiles": {"value"},
}


@pytest.mark.parametrize("name", sorted(NATIVE))
def test_native_and_pruned(spark, name):
    text = plan(spark, name)
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert columns(text) <= NATIVE[name]


@pytest.mark.parametrize("name", ["json_events_rows", "cloudevents_rows", "json_cdc_rows", "debezium_rows", "avro_events_rows"])
def test_the_row_path_is_narrow(spark, name):
    text = plan(spark, name)
    assert text.count("Exchange") <= 1 and "REPARTITION_BY_NUM" in text or "Exchange" not in text
    assert "Aggregate" not in text and "Join" not in text


def test_conditions_reach_the_scan(spark):
    from weir.plans.catalog import event_messages

    events = spark.read.parquet(f"{DATA}/events.parquet")
    text = event_messages(events).where("offset = 7")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_id), EqualTo(event_id,7)]" in text


def test_counts_are_partial_before_they_are_dealt_out(spark):
    text = plan(spark, "consumer_lag_by_topic")
    assert text.count("partial_") >= 2


def test_spread_moves_small_scans_only(spark, tmp_path):
    small = spark.read.parquet(f"{DATA}/lineitem.parquet")
    dealt = spread(small)
    assert dealt.rdd.getNumPartitions() == min(spark.sparkContext.defaultParallelism, estimated_bytes(small) // (256 << 10)) > 1
    assert spread(dealt) is dealt and dealt.count() == small.count()
    ordered = spread(small, small["l_orderkey"], small["l_linenumber"])
    assert "Sort [l_orderkey" in ordered._jdf.queryExecution().executedPlan().toString()
    tiny = spark.read.parquet(f"{DATA}/region.parquet")
    assert spread(tiny) is tiny
    unknown = spark.createDataFrame([(1,)], "a int")
    assert spread(unknown) is unknown
    stream = spark.readStream.schema(small.schema).parquet(str(tmp_path))
    assert spread(stream) is stream
