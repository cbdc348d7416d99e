"""Avro bodies from JSON values: what tests and demonstrations feed to the decoder."""

from __future__ import annotations

import struct
from typing import Any


def _long(value: int) -> bytes:
    value = (value << 1) ^ (value >> 63)
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def encode(schema: Any, value: Any) -> bytes:
    """The body of a value; a union takes its first branch for None and the last otherwise."""
    if isinstance(schema, list):
        at = schema.index("null") if value is None else len(schema) - 1
        return _long(at) + encode(schema[at], value)
    kind = schema if isinstance(schema, str) else schema["type"]
    if isinstance(kind, (dict, list)):
        return encode(kind, value)
    if kind == "null":
        return b""
    if kind == "boolean":
        return b"\1" if value else b"\0"
    if kind in ("int", "long"):
        return _long(value)
    if kind in ("float", "double"):
        return struct.pack("<f" if kind == "float" else "<d", value)
    if kind in ("bytes", "string"):
        raw = value if isinstance(value, bytes) else value.encode()
        return _long(len(raw)) + raw
    if kind == "fixed":
        return value
    if kind == "enum":
        return _long(schema["symbols"].index(value))
    if kind == "array":
        items = b"".join(encode(schema["items"], v) for v in value)
        return (_long(len(value)) + items if value else b"") + b"\0"
    if kind == "map":
        items = b"".join(encode("string", k) + encode(schema["values"], v) for k, v in value.items())
        return (_long(len(value)) + items if value else b"") + b"\0"
    if kind == "record":
        return b"".join(encode(f["type"], value[f["name"]]) for f in schema["fields"])
    raise ValueError(f"cannot write {kind}")


def framed(schema_id: int, body: bytes) -> bytes:
    return b"\0" + schema_id.to_bytes(4, "big") + body
