"""Delivery of wire rows to a remote table service: requests, retries, and a service of our own to test against.

A service is anything with append(table, schema, rows): it takes one request or raises ServiceError. Requests of one
table go out in order; one that fails for a passing reason is sent again, with growing waits, until its time is up.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.sql import DataFrame

from weir.operators.rows import LARGE, ROW, RowPath
from weir.plans.tables import TableSpec

#: What a request may hold, and what a row takes beyond its bytes.
MAX_REQUEST_BYTES = 9 * (1 << 20) + (1 << 19)
ROW_OVERHEAD = 8
MAX_ROWS = 5000
#: Codes of failures that pass.
PASSING = frozenset({"UNAVAILABLE", "INTERNAL", "ABORTED", "DEADLINE_EXCEEDED", "RESOURCE_EXHAUSTED", "UNKNOWN", "CANCELLED"})


class ServiceError(RuntimeError):
    """A request that was not taken; rows tells which rows were at fault."""

    def __init__(self, code: str, message: str = "", rows: tuple[int, ...] = ()):
        super().__init__(f"{code}: {message}")
        self.code, self.message, self.rows = code, message, rows


class Service(Protocol):
    """Takes rows of a table: wire messages by requests, and rows too large for them as lines of JSON by loads."""

    def append(self, table: str, schema: bytes, rows: list[bytes]) -> None: ...

    def load(self, table: str, lines: list[str]) -> None: ...


@dataclass
class Retry:
    """When a failed request is sent again, and how long after."""

    first_wait: float = 1.0
    longest_wait: float = 60.0
    budget_s: float = 300.0
    schema_grace_s: float = 600.0
    now: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    columns_added_at: float | None = None

    def passes(self, error: ServiceError) -> bool:
        """Whether a failure passes. A rejected schema does for some time after columns were added."""
        if error.rows:
            return False
        added = self.columns_added_at is not None and self.now() - self.columns_added_at < self.schema_grace_s
        return error.code in PASSING or error.code == "INVALID_ARGUMENT" and added and "schema" in error.message.lower()

    def call(self, request: Callable[[], Any], on_retry: Callable[[], None] = lambda: None) -> Any:
        began, wait = self.now(), self.first_wait
        while True:
            try:
                return request()
            except ServiceError as error:
                if not self.passes(error) or self.now() - began >= self.budget_s:
                    raise
            on_retry()
            self.sleep(wait)
            wait = min(2 * wait, self.longest_wait)


def rest_retry(**clock: Any) -> Callable[[Callable[[], tuple[int, str]]], str]:
    """A caller of REST requests that give (status, body): 5xx, 429 and exceeded rates are tried again, 8 times in all."""
    waits = Retry(**clock)

    def call(request: Callable[[], tuple[int, str]], attempts: int = 8) -> str:
        wait = waits.first_wait
        for attempt in range(1, attempts + 1):
            try:
                status, body = request()
            except OSError as error:
                status, body, passing = 0, str(error), True
            else:
                passing = status >= 500 or status == 429 or status == 403 and "rateLimitExceeded" in body
                if 200 <= status < 300:
                    return body
            if not passing or attempt == attempts:
                raise ServiceError(f"HTTP {status}", body[:500])
            waits.sleep(wait)
            wait = min(2 * wait, waits.longest_wait)
        raise AssertionError("unreachable")

    return call


_SENT = ("requests", "rows", "retries", "bytes", "loads", "ack_ms", "ack_ms_max")


class Sender:
    """One task's writer of one table: holds rows until a request is full, whatever the batches they come in."""

    def __init__(self, service: Service, policy: Retry, table: TableSpec, max_rows: int = MAX_ROWS, max_bytes: int = MAX_REQUEST_BYTES):
        self.service, self.policy, self.max_rows, self.max_bytes = service, policy, max_rows, max_bytes
        self.name, self.schema = table.name, table.descriptor()
        self.held: list[bytes] = []
        self.size = len(self.schema)
        self.counts = dict.fromkeys(_SENT, 0)

    def add(self, row: bytes) -> None:
        own = len(row) + ROW_OVERHEAD
        if self.held and (len(self.held) >= self.max_rows or self.size + own > self.max_bytes):
            self.flush()
        self.held.append(row)
        self.size += own

    def flush(self) -> None:
        if self.held:
            rows = self.held
            self._call(lambda: self.service.append(self.name, self.schema, rows))
            self.counts["requests"] += 1
            self.counts["rows"] += len(rows)
            self.counts["bytes"] += sum(map(len, rows))
            self.held, self.size = [], len(self.schema)

    def load(self, line: str) -> None:
        """A large row is a load of its own, so that no more than one is held."""
        self._call(lambda: self.service.load(self.name, [line]))
        self.counts["loads"] += 1

    def _call(self, request: Callable[[], None]) -> None:
        began = time.monotonic()

        def again() -> None:
            self.counts["retries"] += 1

        self.policy.call(request, again)
        ms = int((time.monotonic() - began) * 1000)
        self.counts["ack_ms"] += ms
        self.counts["ack_ms_max"] = max(ms, self.counts["ack_ms_max"])


def deliver(outcomes: DataFrame, path: RowPath, connect: Callable[[], Service], max_rows: int = MAX_ROWS, retry: Callable[[], Retry] = Retry) -> DataFrame:
    """Sends the rows of outcomes from where they are; a row a partition and table: requests, rows, retries, bytes,
    loads of large rows, and the time until requests were taken, in all and the longest.

    Each partition is a writer of its own. A lost task sends its rows again: delivery is at least once.
    """
    tables: dict[str, TableSpec] = dict(path.tables)

    def send(batches):
        import pyarrow as pa

        service, policy = connect(), retry()
        senders: dict[str, Sender] = {}
        for batch in batches:
            for name, row, large in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name not in senders:
                    senders[name] = Sender(service, policy, tables[name], max_rows)
                if large is None:
                    senders[name].add(row)
                else:
                    senders[name].load(large)
        for sender in senders.values():
            sender.flush()
        columns = [pa.array(list(senders), pa.string()), *(pa.array([s.counts[n] for s in senders.values()], pa.int64()) for n in _SENT)]
        yield pa.record_batch(columns, ["destination_id", *_SENT])

    rows = outcomes.where(outcomes["outcome"].isin(ROW, LARGE)).select("destination_id", "row_bytes", "large_json")
    return rows.mapInArrow(send, ", ".join(["destination_id string", *(f"{n} long" for n in _SENT)]))


@dataclass
class FaultyService:
    """A service in memory that fails on purpose and keeps what it took.

    every_n: each n-th request fails with code; row_error_every_n: or names a bad row; close_after: so many requests,
    then the connection is closed until it is opened again; latency_s: before each answer.
    """

    every_n: int = 0
    code: str = "UNAVAILABLE"
    message: str = ""
    row_error_every_n: int = 0
    close_after: int = 0
    latency_s: float = 0
    sleep: Callable[[float], None] = time.sleep
    taken: dict[str, list[bytes]] = field(default_factory=dict)
    loaded: dict[str, list[str]] = field(default_factory=dict)
    schemas: dict[str, bytes] = field(default_factory=dict)
    violations: list[str] = field(default_factory=list)
    n: int = 0
    open_for: int = 0

    def append(self, table: str, schema: bytes, rows: list[bytes]) -> None:
        self.n += 1
        if self.latency_s:
            self.sleep(self.latency_s)
        if not rows:
            self.violations.append("a request without rows")
        if len(schema) + sum(len(r) + ROW_OVERHEAD for r in rows) > MAX_REQUEST_BYTES and len(rows) > 1:
            self.violations.append("a request that is too large")
        if self.close_after and self.open_for >= self.close_after:
            self.open_for = 0
            raise ServiceError("UNAVAILABLE", "the connection is closed")
        if self.every_n and self.n % self.every_n == 0:
            raise ServiceError(self.code, self.message)
        if self.row_error_every_n and self.n % self.row_error_every_n == 0:
            raise ServiceError("INVALID_ARGUMENT", "a bad row", (0,))
        self.open_for += 1
        self.schemas[table] = schema
        self.taken.setdefault(table, []).extend(rows)

    def load(self, table: str, lines: list[str]) -> None:
        self.n += 1
        if self.every_n and self.n % self.every_n == 0:
            raise ServiceError(self.code, self.message)
        self.loaded.setdefault(table, []).extend(lines)

    def distinct(self, table: str, ignored_field: int | None = None) -> int:
        """How many rows of a table differ, one field left out."""
        rows = (r if ignored_field is None else without_field(r, ignored_field) for r in self.taken.get(table, ()))
        return len({hashlib.blake2b(r, digest_size=8).digest() for r in rows})


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (raw[at] & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if raw[at - 1] < 0x80:
            return value, at


def without_field(message: bytes, number: int) -> bytes:
    """A wire message without one of its fields."""
    out, at = bytearray(), 0
    while at < len(message):
        start = at
        tag, at = _varint(message, at)
        kind = tag & 7
        if kind == 0:
            _, at = _varint(message, at)
        elif kind == 2:
            size, at = _varint(message, at)
            at += size
        else:
            at += 8 if kind == 1 else 4
        if tag >> 3 != number:
            out += message[start:at]
    return bytes(out)
