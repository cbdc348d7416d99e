"""python -m weir.cli run | check-config | capture | smoke | fake-service

run reads its knobs from WEIR_RUN_* variables: see weir.streaming.engine.options_from_env.
"""

from __future__ import annotations

import argparse
import functools
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import delivery
from weir.operators.registry import Registry, from_folder, from_http
from weir.operators.rows import MAX_STREAM_ROW_BYTES, ROW, RowPath, schema_ids
from weir.plans.config import ENV_PREFIX, Config, load_config
from weir.session import prepare
from weir.plans.tables import ColumnSpec, TableSpec
from weir.sources.capture import first_messages, limited, parse_since, read_capture, stream_capture, write_capture, write_schemas
from weir.sources.kafka import read_kafka, stream_kafka
from weir.streaming.engine import Stopper, Writer, forget, options_from_env, start
from weir.streaming.health import serve
from weir.streaming.metrics import Metrics, Progress, pipeline_tags, push, worker_tags
from weir.streaming.remote import FaultyService, deliver
from weir.streaming.service import HttpService, serve_rows


def _session(name: str) -> SparkSession:
    return prepare(SparkSession.builder.appName(name).getOrCreate())


def _config(args: argparse.Namespace) -> Config:
    with open(args.config, encoding="utf-8") as file:
        return load_config(file.read(), prefix=args.env_prefix)


def _registry(config: Config, folder: str | None) -> Registry:
    s = config.source
    return from_folder(folder) if folder else from_http(s.registry_url, s.registry_username, s.registry_password)


def check_config(args: argparse.Namespace) -> int:
    config = _config(args)
    print(f"{config.name}: {len(config.source.topics)} topics to {len(config.destination.tables)} tables by {config.transform.name}")
    for topic, table in config.source.topics.items():
        print(f"  {topic} -> {table}: {len(config.destination.tables[table].columns)} columns")
    return 0


def run(args: argparse.Namespace) -> int:
    config = _config(args)
    spark = _session(config.name)
    options = options_from_env(args.checkpoint, os.environ)
    options.linger_s = min(options.linger_s, config.source.consumer_timeout)
    options.quarantine, options.once = args.quarantine, args.once
    metrics = Metrics(tags=worker_tags(config, os.environ.get("HOSTNAME")), table_tags=pipeline_tags(config))
    options.max_rows_per_request = min(options.max_rows_per_request, config.destination.max_rows)
    connect = functools.partial(HttpService, args.service) if args.service else None
    writer = Writer(RowPath.of(config), options, _registry(config, args.schemas), metrics, connect)
    if args.capture:
        messages = stream_capture(spark, args.capture)
    else:
        messages = stream_kafka(spark, config.source, max_messages=options.max_messages_per_trigger, linger_s=options.linger_s)
    progress = Progress(metrics)
    spark.streams.addListener(progress)
    query = start(messages, writer)
    ended = push(metrics, args.statsd.rsplit(":", 1)[0], int(args.statsd.rsplit(":", 1)[1])) if args.statsd else None
    server = serve(options.health_port, metrics, lambda: query.isActive and not progress.stalled(options.stall_s), lambda: query.isActive)
    try:
        return Stopper(query, options.drain_s).install().wait()
    finally:
        server.shutdown()
        forget(spark, options)
        if ended is not None:
            ended.set()


def capture(args: argparse.Namespace) -> int:
    config = _config(args)
    spark = _session(config.name)
    since = parse_since(args.since, int(time.time() * 1000)) if args.since else None
    messages = read_capture(spark, args.capture) if args.capture else read_kafka(spark, config.source, since)
    topics = args.topic or list(config.source.topics)
    few = first_messages(messages, args.per_topic, topics, since)
    if args.max_wait and not limited(spark, args.max_wait, lambda: write_capture(few, args.out)):
        print(f"no capture within {args.max_wait} s", file=sys.stderr)
        return 1
    if not args.max_wait:
        write_capture(few, args.out)
    if config.source.encoding == "avro":
        n = write_schemas(schema_ids(read_capture(spark, args.out)), _registry(config, args.schemas), f"{args.out}/schemas")
        print(f"schemas: {n}")
    for r in read_capture(spark, args.out).groupBy("topic").count().orderBy("topic").collect():
        print(f"{r['topic']}: {r['count']}")
    return 0


SMOKE_TABLE = TableSpec("p.d.smoke", (ColumnSpec("id", "INTEGER", True), ColumnSpec("payload", "JSON"), ColumnSpec("__inserted_at", "TIMESTAMP")))


def load(spark: SparkSession, writers: int, batches: int, rows: int, filler: int) -> DataFrame:
    """Generated rows for a sink: id, a payload document of a given size, and a time."""
    n = spark.range(writers * batches * rows, numPartitions=writers)
    document = F.to_json(F.struct("id", F.repeat(F.lit("x"), filler).alias("filler")))
    return n.select("id", document.alias("payload"), F.lit("2026-01-01T00:00:00").alias("__inserted_at"))


def wire_rows(rows: DataFrame) -> DataFrame:
    """Generated rows as outcomes with wire bytes."""
    import pyarrow as pa

    from weir.functions.coercion import proto_bytes

    def encode(batches):
        for batch in batches:
            found = [proto_bytes(SMOKE_TABLE, list(r)) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.record_batch([pa.array(found, pa.binary())], ["row_bytes"])

    named = F.lit(SMOKE_TABLE.name).alias("destination_id")
    return rows.mapInArrow(encode, "row_bytes binary").select(named, F.lit(ROW).alias("outcome"), "row_bytes", F.lit(None).cast("string").alias("large_json"))


def smoke(args: argparse.Namespace) -> int:
    """Sends generated rows batch after batch to a service, or to Parquet; prints throughput and latencies."""
    if not args.service and not args.out:
        raise SystemExit("smoke takes --service or --out")
    spark = _session("smoke")
    path = RowPath(None, {}, {SMOKE_TABLE.name: SMOKE_TABLE}, max_row_bytes=MAX_STREAM_ROW_BYTES)
    times, began, size = [], time.monotonic(), 0
    total = args.writers * args.batches * args.rows
    for _ in range(args.batches):
        at = time.monotonic()
        rows = load(spark, args.writers, 1, args.rows, args.filler)
        if args.service:
            sent = deliver(wire_rows(rows), path, functools.partial(HttpService, args.service), args.rows)
            size += sent.agg(F.sum("bytes")).first()[0]
        else:
            rows.write.mode("append").parquet(args.out)
            size += args.writers * args.rows * (args.filler + 60)
        times.append((int((time.monotonic() - at) * 1000),))
    spent = time.monotonic() - began
    found = delivery.latency_summary(spark.createDataFrame(times, "ms long")).first()
    print(f"rows {total}, {size / 2**20 / spent:.1f} MiB/s, batches {found['n']}, p50 {found['p50']} ms, p99 {found['p99']} ms, max {found['max']} ms")
    return 0


def fake_service(args: argparse.Namespace) -> int:
    """Serves a service that keeps rows in memory and fails as asked, until it is interrupted; prints what it took."""
    service = FaultyService(args.every_n, args.code, "", args.row_error_every_n, args.close_after, args.latency_ms / 1000)
    server = serve_rows(service, args.port)
    print(f"port {server.server_address[1]}", flush=True)
    try:
        while True:
            time.sleep(3600)
    except KeyboardInterrupt:
        server.shutdown()
        for table, rows in sorted(service.taken.items()):
            print(f"{table}: {len(rows)} rows, {service.distinct(table)} distinct, {len(service.loaded.get(table, ()))} loaded")
        for text in service.violations:
            print(text)
    return 1 if service.violations else 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="weir")
    commands = top.add_subparsers(required=True)

    def command(name: str, function, *configured: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        p.set_defaults(function=function)
        if configured:
            p.add_argument("--config", required=True)
            p.add_argument("--env-prefix", default=ENV_PREFIX)
        return p

    command("check-config", check_config, "config")
    p = command("run", run, "config")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--capture", help="a folder of capture files instead of the live source")
    p.add_argument("--schemas", help="a folder of writer schemas instead of the registry")
    p.add_argument("--quarantine", help="where failed messages go, instead of stopping")
    p.add_argument("--service", help="URL of a table service to which rows go, instead of catalog tables")
    p.add_argument("--statsd", help="host:port to which counters are pushed")
    p.add_argument("--once", action="store_true", help="end when what is there is written")
    p = command("capture", capture, "config")
    p.add_argument("--out", required=True)
    p.add_argument("--capture", help="a capture to cut from, instead of the live source")
    p.add_argument("--topic", action="append")
    p.add_argument("--per-topic", type=int, default=1000)
    p.add_argument("--since")
    p.add_argument("--schemas", help="a folder of writer schemas instead of the registry")
    p.add_argument("--max-wait", type=float, help="seconds after which a capture that is not done is given up")
    p = command("smoke", smoke)
    for name, default in (("writers", 4), ("batches", 10), ("rows", 5000), ("filler", 1000)):
        p.add_argument(f"--{name}", type=int, default=default)
    p.add_argument("--out", help="a folder for Parquet files")
    p.add_argument("--service", help="URL of a table service")
    p = command("fake-service", fake_service)
    for name in ("port", "every-n", "row-error-every-n", "close-after", "latency-ms"):
        p.add_argument(f"--{name}", type=int, default=0)
    p.add_argument("--code", default="UNAVAILABLE")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.function(args)


if __name__ == "__main__":
    sys.exit(main())
