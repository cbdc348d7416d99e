"""Counters of a running query: observed on its batches, rendered for scraping or pushed as deltas."""

from __future__ import annotations

import json
import socket
import threading
import time
from collections import Counter, defaultdict
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from weir.operators.rows import DECODE_ERROR, EMPTY_VALUE, ERROR, INVALID_KEY, LARGE, ROW
from weir.plans.config import Config

DATAGRAM_BYTES = 8000


#: Names of the reasons to skip a message, as counters.
_SKIPPED = {r: f"skipped_{r}" for r in (EMPTY_VALUE, INVALID_KEY, DECODE_ERROR)}
#: Names of the stages at which a message fails, as counters.
_FAILED = {s: f"failed_{s}" for s in ("source", "transform", "encode")}


def grouped(outcomes: DataFrame) -> list[Row]:
    """n, bytes (of wire rows, or of the texts of cells) and the largest row by destination, outcome, skip reason and stage: one aggregation that tells all counters of a batch."""
    by = outcomes.groupBy("destination_id", "outcome", "skip_reason", "stage")
    size = F.coalesce(F.octet_length("row_bytes"), F.octet_length("large_json"), F.octet_length(F.array_join("cells", "")), F.lit(0))
    return by.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes"), F.max(size).alias("largest")).collect()


def worker_tags(config: Config, host: str | None = None) -> dict[str, str]:
    """Tags that tell the writers of one pipeline apart."""
    tags = {"pipeline": config.name, "kafka_cluster": config.transform.cluster}
    return tags | ({"pod_name": host} if host else {})


def pipeline_tags(config: Config) -> dict[str, str]:
    """Tags of a pipeline's rows by table: counts of several writers add up under them."""
    stream = {"pipeline_stream": config.source.stream} if config.source.stream else {}
    return {"pipeline_name": config.name} | stream | {"pipeline_source": "kafka", "kafka_cluster": config.transform.cluster}


def lag_by_topic(end: str | None, latest: str | None) -> dict[str, int]:
    """Lag of each topic from a source's read and newest offsets, as its progress has them."""
    try:
        own, newest = json.loads(end or "null"), json.loads(latest or "null")
    except ValueError:
        return {}
    if not isinstance(own, dict) or not isinstance(newest, dict):
        return {}
    found = {}
    for topic, offsets in newest.items():
        if isinstance(offsets, dict) and isinstance(own.get(topic), dict):
            found[topic] = sum(max(0, o - own[topic].get(p, o)) for p, o in offsets.items())
    return found


class Metrics:
    """Totals, gauges and rows by destination; safe to use from several threads."""

    def __init__(self, prefix: str = "weir", tags: dict[str, str] | None = None, table_tags: dict[str, str] | None = None):
        self.prefix, self.tags, self.table_tags = prefix, tags or {}, tags or {} if table_tags is None else table_tags
        self.gauges: dict[tuple[str, str, str], int] = {}
        self.totals: Counter[str] = Counter()
        self.by_table: dict[str, Counter[str]] = defaultdict(Counter)
        self.maxima: Counter[str] = Counter(batch_ms_max=0)
        self._pushed: Counter[str] = Counter()
        self._lock = threading.Lock()

    def add(self, counts: dict[str, int], table: str | None = None) -> None:
        with self._lock:
            (self.totals if table is None else self.by_table[table]).update({k: v for k, v in counts.items() if v})

    def gauge(self, name: str, value: int, tag: str = "", of: str = "") -> None:
        with self._lock:
            self.gauges[name, tag, of] = value

    def add_groups(self, groups: list[Row]) -> None:
        """Counters of a batch from grouped(): messages, rows, large rows, skips and failures, bytes; and rows by table."""
        counts: Counter[str] = Counter()
        for g in groups:
            counts["messages"] += g["n"]
            if g["outcome"] in (ROW, LARGE):
                name, size = ("rows", "row_bytes") if g["outcome"] == ROW else ("large_rows", "large_bytes")
                counts.update({name: g["n"], size: g["bytes"]})
                self.add({name: g["n"], size: g["bytes"]}, g["destination_id"])
                self.highest("row_bytes_max", g["largest"])
            elif g["outcome"] == ERROR:
                counts.update({"errors": g["n"], _FAILED.get(g["stage"], "failed"): g["n"]})
            else:
                counts.update({"skipped": g["n"], _SKIPPED.get(g["skip_reason"], "skipped_other"): g["n"]})
        self.add(counts)

    def highest(self, name: str, value: int) -> None:
        """A gauge that keeps its largest value until it is pushed."""
        with self._lock:
            self.maxima[name] = max(value, self.maxima[name])

    def acknowledged(self, ms: int, table: str) -> None:
        """A destination's rows of a batch were taken, so long after they were first sent."""
        self.add({"acks": 1, "append_ms": ms}, table)
        self.add({"acks": 1, "append_ms": ms})
        self.highest("append_ms_max", ms)

    def batch(self, ms: int) -> None:
        with self._lock:
            self.totals.update({"batches": 1, "batch_ms": ms})
        self.highest("batch_ms_max", ms)

    def _samples(self) -> list[tuple[str, dict[str, str], int]]:
        found = [(k, self.tags, v) for k, v in sorted(self.totals.items())]
        return found + [(f"table_{k}", {**self.table_tags, "table": t}, v) for t, c in sorted(self.by_table.items()) for k, v in sorted(c.items())]

    def prometheus(self) -> str:
        """All totals as exposition text."""
        with self._lock:
            lines, seen = [], set()
            for name, tags, value in self._samples():
                if name not in seen:
                    seen.add(name)
                    lines.append(f"# TYPE {self.prefix}_{name}_total counter")
                labels = ",".join(f'{k}="{_escaped(v)}"' for k, v in tags.items())
                lines.append(f"{self.prefix}_{name}_total{{{labels}}} {value}" if labels else f"{self.prefix}_{name}_total {value}")
            for name, value in sorted(self.maxima.items()):
                lines += [f"# TYPE {self.prefix}_{name} gauge", f"{self.prefix}_{name} {value}"]
            for (name, tag, of), value in sorted(self.gauges.items()):
                if name not in seen:
                    seen.add(name)
                    lines.append(f"# TYPE {self.prefix}_{name} gauge")
                lines.append(f'{self.prefix}_{name}{{{tag}="{_escaped(of)}"}} {value}' if tag else f"{self.prefix}_{name} {value}")
        return "\n".join(lines) + "\n"

    def datagrams(self) -> list[bytes]:
        """What has grown since the last call, as statsd lines in datagrams cut at line ends; maxima start anew."""
        with self._lock:
            lines = []
            for name, tags, value in self._samples():
                key = f"{name}|{sorted(tags.items())}"
                if grown := value - self._pushed[key]:
                    self._pushed[key] = value
                    lines.append(_statsd(f"{self.prefix}.{name}", grown, "c", tags))
            for name, value in sorted(self.maxima.items()):
                lines.append(_statsd(f"{self.prefix}.{name}", value, "g", self.tags))
                self.maxima[name] = 0
            for (name, tag, of), value in sorted(self.gauges.items()):
                lines.append(_statsd(f"{self.prefix}.{name}", value, "g", self.tags | ({tag: of} if tag else {})))
        return chunked(lines)


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")


def _statsd(name: str, value: int, kind: str, tags: dict[str, str]) -> str:
    own = ",".join(f"{k}:{v}" for k, v in tags.items())
    return f"{name}:{value}|{kind}" + (f"|#{own}" if own else "")


def chunked(lines: list[str], size: int = DATAGRAM_BYTES) -> list[bytes]:
    """Lines joined to datagrams of at most size bytes; a longer line stands alone."""
    found: list[bytes] = []
    for line in lines:
        raw = line.encode()
        if found and len(found[-1]) + 1 + len(raw) <= size:
            found[-1] += b"\n" + raw
        else:
            found.append(raw)
    return found


def push(metrics: Metrics, host: str, port: int, every_s: float = 10) -> threading.Event:
    """Sends datagrams of what has grown, again and again, from a thread; set the event to end it after a last one."""
    ended = threading.Event()

    def run() -> None:
        with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as out:
            while True:
                last = ended.wait(every_s)
                for datagram in metrics.datagrams():
                    out.sendto(datagram, (host, port))
                if last:
                    return

    threading.Thread(target=run, daemon=True).start()
    return ended


class Progress(StreamingQueryListener):
    """Feeds observed counters to metrics, and remembers when the last batch ended."""

    def __init__(self, metrics: Metrics, observation: str = "outcomes"):
        self.metrics, self.observation = metrics, observation
        self.last_progress = time.monotonic()
        self.failed: str | None = None

    def onQueryStarted(self, event: Any) -> None:
        self.last_progress = time.monotonic()

    def onQueryProgress(self, event: Any) -> None:
        self.last_progress = time.monotonic()
        self.metrics.batch(int(event.progress.batchDuration))
        for source in event.progress.sources or ():
            for topic, lag in lag_by_topic(source.endOffset, source.latestOffset).items():
                self.metrics.gauge("consumer_lag", lag, "topic", topic)

    def onQueryIdle(self, event: Any) -> None:
        self.last_progress = time.monotonic()

    def onQueryTerminated(self, event: Any) -> None:
        self.failed = event.exception

    def stalled(self, after_s: float) -> bool:
        return time.monotonic() - self.last_progress >= after_s
