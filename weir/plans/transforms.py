"""The six transforms, as declarations: where the payload, the event time and each further column come from.

A transform gives a row of named values: the message key's members first, then its own columns, of which a later one
of the same name counts. Its columns that read only message coordinates or literals are also Spark expressions (see
weir.functions.columns); what needs the parsed value is read here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from weir.functions.avro import timestamp_text
from weir.functions.canonical import JsonError, dump, parse


class TransformError(ValueError):
    """A message that a transform cannot project."""


@dataclass
class Message:
    """A parsed message: keys, headers and value are JSON values; schema is the text for the schema column."""

    topic: str
    partition: int
    offset: int
    timestamp_ms: int
    keys: Any
    headers: dict[str, str]
    value: Any
    schema: str = "{}"
    #: The text of timestamp_ms, where it is known.
    time: str | None = None


@dataclass(frozen=True)
class Transform:
    name: str
    cluster: str
    removed: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def row(self, message: Message, inserted_at: str) -> dict[str, Any]:
        return {**keys_of(self, message.keys), **self.own(message), **self._common(message, inserted_at)}

    @property
    def reads_headers(self) -> bool:
        return self.name in ("cloudevents", "cloudevents_enriched", "json_cdc")

    def own(self, message: Message) -> dict[str, Any]:
        """The columns that the transform makes of a message, beside the key's members and common ones."""
        return _READERS[self.name](self, message)

    def _common(self, message: Message, inserted_at: str) -> dict[str, Any]:
        return {
            "__cluster": self.cluster,
            "__kafka_partition": message.partition,
            "__kafka_offset": message.offset,
            "__kafka_topic": message.topic,
            "__schema": message.schema,
            "__inserted_at": inserted_at,
        }

    def schema_text(self, topic: str, schema: Any) -> str:
        """The schema column of messages of a topic with a writer schema ({} for JSON messages)."""
        if self.name == "debezium_unwrap":
            gone = set(self.removed.get(topic, ()))
            return dump([f for f in _before_fields(schema) if not (isinstance(f, dict) and f.get("name") in gone)])
        if self.name == "avro_events":
            return dump(_flattened(schema))
        return dump(schema)


def _mapping(value: Any, what: str) -> dict:
    if not isinstance(value, dict):
        raise TransformError(f"{what} is not a mapping")
    return value


def _member(value: Any, name: str, what: str) -> Any:
    if not isinstance(value, dict) or name not in value:
        raise TransformError(f"{what} is missing")
    return value[name]


#: Transforms that read a text key as JSON once more.
_REPARSED = ("cloudevents", "json_cdc")


def keys_of(transform: Transform, keys: Any) -> dict[str, Any]:
    """The members of a message's key."""
    if transform.name in _REPARSED and isinstance(keys, str):
        try:
            keys = parse(keys)
        except JsonError as error:
            raise TransformError(f"keys: {error}") from None
    return _mapping(keys, "keys")


#: Texts of whole seconds, which neighbouring messages share.
_seconds: dict[int, str] = {}


def event_time(ms: Any, what: str = "timestamp") -> str:
    """Epoch milliseconds as text in UTC with six digits of the second."""
    if ms is None:
        raise TransformError(f"{what} is missing")
    if type(ms) not in (int, float):
        raise TransformError(f"{what} is not a number")
    if type(ms) is float or ms >= 1 << 63:
        ms = max(-(1 << 63), min((1 << 63) - 1, int(ms)))
    seconds, ms = divmod(ms, 1000)
    if seconds not in _seconds:
        if len(_seconds) > 10_000:
            _seconds.clear()
        _seconds[seconds] = timestamp_text(seconds * 1_000_000, " ")
    return f"{_seconds[seconds]}.{ms:03d}000"


def _debezium(transform: Transform, message: Message) -> dict[str, Any]:
    value = _mapping(message.value, "value")
    operation = _member(value, "op", "value.op")
    ms = _member(_member(value, "source", "value.source"), "ts_ms", "value.source.ts_ms")
    at = event_time(ms, "value.source.ts_ms")
    deleted = operation == "d"
    payload = _member(value, "before" if deleted else "after", "value.before/after")
    if gone := transform.removed.get(message.topic):
        payload = {k: v for k, v in _mapping(payload, "payload").items() if k not in gone}
    return {"payload": dump(payload), "__operation": operation, "__deleted": deleted, "__event_timestamp": at}


def _event(message: Message, **own: Any) -> dict[str, Any]:
    return {**own, "__event_timestamp": message.time or event_time(message.timestamp_ms)}


def _cloudevents(transform: Transform, message: Message) -> dict[str, Any]:
    found = _event(message, payload=message.value)
    for name in ("type", "id"):
        found[f"__ce_{name}"] = _member(message.headers, f"ce_{name}", f"headers.ce_{name}")
    return {**found, "__ce_time": message.headers.get("ce_time")}


def _enriched(transform: Transform, message: Message) -> dict[str, Any]:
    optional = {f"__ce_{name}": message.headers.get(f"ce_{name}") for name in ("type", "id", "time")}
    return {**_event(message, payload=message.value, headers=message.headers), **optional}


def _json_cdc(transform: Transform, message: Message) -> dict[str, Any]:
    value = _mapping(message.value, "value")
    found = {"payload": _member(value, "after", "value.after"), "__before": value.get("before")}
    optional = {f"__ce_{name}": message.headers.get(f"ce_{name}") for name in ("type", "id")}
    return {**_event(message, **found), **optional}


def _events(transform: Transform, message: Message) -> dict[str, Any]:
    return _event(message, payload=message.value, __operation=None)


_READERS: dict[str, Callable[[Transform, Message], dict[str, Any]]] = {
    "debezium_unwrap": _debezium,
    "cloudevents": _cloudevents,
    "cloudevents_enriched": _enriched,
    "json_events": _events,
    "json_cdc": _json_cdc,
    "avro_events": _events,
}
NAMES = tuple(_READERS)


def _before_fields(schema: Any) -> list:
    """Fields of the first record among the branches of the field "before"; of several such fields the last counts."""
    found: list = []
    for f in schema.get("fields") or () if isinstance(schema, dict) else ():
        if isinstance(f, dict) and f.get("name") == "before" and isinstance(f.get("type"), list):
            records = (b["fields"] for b in f["type"] if isinstance(b, dict) and isinstance(b.get("fields"), list))
            found = next(records, found)
    if not found:
        raise TransformError("the schema has no fields of before")
    return found


def _flattened(schema: Any) -> list:
    """The schema's fields; one of a record type is replaced by the list of that type's fields."""
    fields = schema.get("fields") if isinstance(schema, dict) else None
    if not isinstance(fields, list):
        raise TransformError("the schema has no fields")
    found = []
    for f in fields:
        kind = _member(_mapping(f, "schema field"), "type", "schema field type")
        if not isinstance(kind, (dict, list, str)):
            raise TransformError("schema field type")
        if "fields" not in kind:
            found.append(f)
        elif isinstance(kind, dict):
            found.append(kind["fields"])
        else:
            raise TransformError("schema field type")
    return found
