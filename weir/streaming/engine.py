"""The running pipeline: a message stream to destination tables, at least once.

Each micro-batch is read once and kept while it is written: schemas of new ids are resolved, outcomes are computed,
the first error stops the query (or goes to a quarantine table), and each destination that occurs gets one append, or
one pass of requests if a service is given. Appends are recorded by query, batch and destination, so that a batch that
is run again after a failure does not append twice what was recorded. Offsets are in the query's checkpoint, which the
driver advances only when the whole batch is written; the records lie in the same folder, under the query's id, so that
whatever resets the offsets takes the records along. Records of earlier batches go when a batch begins.
"""

from __future__ import annotations

import signal
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weir.operators import tables
from weir.operators.registry import Registry
from weir.operators.rows import ERROR, LARGE, ROW, RowPath, encode_rows, schema_ids, typed_rows
from weir.plans.tables import TableSpec
from weir.streaming import remote
from weir.streaming.metrics import Metrics, grouped


class RowFailed(RuntimeError):
    """A message that stopped the pipeline."""


@dataclass
class RunOptions:
    """Knobs of a run. A dry run writes rows and keeps neither offsets nor records: its folder is its own, and goes."""

    checkpoint: str
    linger_s: float = 1.0
    ensure_tables: bool = True
    quarantine: str | None = None
    stall_s: float = 600
    drain_s: float = 20
    max_rows_per_file: int = 0
    inserted_at: str | None = None
    max_messages_per_trigger: int = 1_000_000
    health_port: int = 8080
    once: bool = False
    dry_run: bool = False
    max_rows_per_request: int = remote.MAX_ROWS
    schema_grace_s: float = 600
    request_budget_s: float = 300
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex, compare=False)

    @property
    def folder(self) -> str:
        """Where the offsets and records of this run are."""
        return f"{self.checkpoint}/" + (f"dry-{self.run_id}" if self.dry_run else "query")


#: Run options by the end of their environment variable's name, with the factor to the option's unit.
_KNOBS = {
    "LINGER_MS": ("linger_s", 0.001), "ENSURE_TABLES": ("ensure_tables", None), "STALL_S": ("stall_s", 1), "DRAIN_S": ("drain_s", 1),
    "MAX_ROWS_PER_FILE": ("max_rows_per_file", 1), "MAX_MESSAGES_PER_TRIGGER": ("max_messages_per_trigger", 1), "HEALTH_PORT": ("health_port", 1),
    "MAX_ROWS_PER_REQUEST": ("max_rows_per_request", 1), "SCHEMA_GRACE_S": ("schema_grace_s", 1), "REQUEST_BUDGET_S": ("request_budget_s", 1),
}
_WHOLE = ("max_rows_per_file", "max_messages_per_trigger", "health_port", "max_rows_per_request")


def options_from_env(checkpoint: str, env: Mapping[str, str], prefix: str = "WEIR_RUN_") -> RunOptions:
    """Run options from the environment; offsets are kept only if ENVIRONMENT is production or not set."""
    found: dict[str, Any] = {"dry_run": env.get("ENVIRONMENT", "production") != "production"}
    for name, (option, factor) in _KNOBS.items():
        if (text := env.get(prefix + name)) is not None:
            value = text.strip().lower() in ("1", "true", "yes") if factor is None else float(text) * factor
            found[option] = int(value) if option in _WHOLE else value
    return RunOptions(checkpoint, **found)


class Writer:
    """foreachBatch of a pipeline. connect gives a service that takes the rows; without it catalog tables take them."""

    def __init__(
        self, path: RowPath, options: RunOptions, registry: Registry | None = None, metrics: Metrics | None = None, connect: Callable[[], remote.Service] | None = None
    ):
        self.path, self.options, self.registry, self.connect = path, options, registry, connect
        self.metrics = metrics or Metrics()
        path.wire = connect is not None  # typed columns do without wire bytes
        self.columns_added_at: float | None = None
        self._ensured: set[str] = set()

    def __call__(self, messages: DataFrame, epoch: int) -> None:
        spark = messages.sparkSession
        self._forget_before(spark, epoch)
        messages = messages.persist()
        try:
            if self.path.encoding == "avro" and self.registry is not None:
                self.path.schemas = self.registry.resolve(schema_ids(messages))
            outcomes = encode_rows(messages, self.path, self.options.inserted_at).persist()
            try:
                self._write(spark, outcomes, epoch)
            finally:
                outcomes.unpersist()
        finally:
            messages.unpersist()

    def _write(self, spark: SparkSession, outcomes: DataFrame, epoch: int) -> None:
        counts = grouped(outcomes)  # the batch's one aggregation: what is present, what failed, and all counters
        if any(r["outcome"] == ERROR for r in counts):
            self._failed(outcomes)
        present = {r["destination_id"] for r in counts if r["outcome"] in (ROW, LARGE)}
        for name in sorted(present):
            table = self.path.tables[name]
            if not self._recorded(spark, epoch, name):
                began = time.monotonic()
                self._append(spark, outcomes, table)
                self._record(spark, epoch, name)
                self.metrics.acknowledged(int((time.monotonic() - began) * 1000), name)
        self.metrics.add_groups(counts)

    def _failed(self, outcomes: DataFrame) -> None:
        bad = outcomes.where(F.col("outcome") == ERROR)
        if self.options.quarantine is None:
            first = bad.orderBy("topic", "partition", "offset").select("topic", "partition", "offset", "stage", "error").first()
            raise RowFailed("{}[{}]@{}: {}: {}".format(*first))
        bad.select("topic", "partition", "offset", "stage", "error").write.mode("append").parquet(self.options.quarantine)

    def _append(self, spark: SparkSession, outcomes: DataFrame, table: TableSpec) -> None:
        if self.options.ensure_tables and table.name not in self._ensured:
            if tables.ensure_table(spark, table).result == tables.ADDED:
                self.metrics.add({"schema_changes": 1})
                self.columns_added_at = time.time()
            self._ensured.add(table.name)
        if self.connect is not None:
            self._deliver(outcomes, table)
            return
        rows = typed_rows(outcomes, table).unionByName(tables.large_rows(outcomes, table))
        tables.append(rows, table, self.options.max_rows_per_file)

    def _deliver(self, outcomes: DataFrame, table: TableSpec) -> None:
        o, added = self.options, self.columns_added_at
        policy = lambda: remote.Retry(now=time.time, budget_s=o.request_budget_s, schema_grace_s=o.schema_grace_s, columns_added_at=added)
        sent = remote.deliver(outcomes.where(F.col("destination_id") == table.name), self.path, self.connect, o.max_rows_per_request, policy)
        names = ("requests", "retries", "bytes", "loads", "ack_ms")
        totals = sent.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names), F.coalesce(F.max("ack_ms_max"), F.lit(0)).alias("m")).first()
        self.metrics.add({f"request_{n}" if n == "bytes" else n: totals[n] for n in names}, table.name)
        self.metrics.highest("ack_ms_max", totals["m"])

    def _records(self, spark: SparkSession, *below: str):
        """The file system and the path of the query's records, or of one below it."""
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        path = spark._jvm.org.apache.hadoop.fs.Path("/".join((f"{self.options.folder}/appended/{query}", *below)))
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def _recorded(self, spark: SparkSession, epoch: int, name: str) -> bool:
        fs, path = self._records(spark, str(epoch), name)
        return fs.exists(path)

    def _record(self, spark: SparkSession, epoch: int, name: str) -> None:
        fs, path = self._records(spark, str(epoch), name)
        fs.create(path, True).close()

    def _forget_before(self, spark: SparkSession, epoch: int) -> None:
        """A batch begins only when those before it are committed: their records serve no more."""
        fs, path = self._records(spark)
        if fs.exists(path):
            for status in fs.listStatus(path):
                if int(status.getPath().getName()) < epoch:
                    fs.delete(status.getPath(), True)


def start(messages: DataFrame, writer: Writer) -> StreamingQuery:
    """Starts the query of a message stream; with options.once it ends when what is there is written."""
    o = writer.options
    stream = messages.writeStream.foreachBatch(writer).option("checkpointLocation", o.folder)
    stream = stream.trigger(availableNow=True) if o.once else stream.trigger(processingTime=f"{o.linger_s} seconds")
    return stream.start()


def forget(spark: SparkSession, options: RunOptions) -> None:
    """Removes what an ended dry run kept of its offsets and records; of another run nothing goes."""
    if options.dry_run:
        path = spark._jvm.org.apache.hadoop.fs.Path(options.folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@dataclass
class Stopper:
    """Stops a query on SIGTERM or SIGINT, after the batch that runs, within drain_s."""

    query: StreamingQuery
    drain_s: float = 20
    asked: bool = False
    sleep: Callable[[float], None] = field(default=time.sleep)

    def install(self) -> Stopper:
        for number in (signal.SIGTERM, signal.SIGINT):
            signal.signal(number, lambda *_: setattr(self, "asked", True))
        return self

    def wait(self) -> int:
        """Until the query ends or is asked to; 0 if it ended well, 1 if it failed."""
        while self.query.isActive and not self.asked:
            self.sleep(0.2)
        waited = 0.0
        while self.query.isActive and self.query.status["isTriggerActive"] and waited < self.drain_s:
            self.sleep(0.2)
            waited += 0.2
        if self.query.isActive:
            self.query.stop()
        return 1 if self.query.exception() else 0
