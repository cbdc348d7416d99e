"""Destination tables: declared columns, their wire types, descriptor bytes and Spark schema."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import types as T

INT64, DOUBLE, BOOL, BYTES, STRING = "int64", "double", "bool", "bytes", "string"

#: Wire types by declared type; every other type but RECORD travels as text.
WIRE_TYPES = {"INTEGER": INT64, "FLOAT": DOUBLE, "BOOLEAN": BOOL, "BYTES": BYTES}
_SPARK = {INT64: T.LongType(), DOUBLE: T.DoubleType(), BOOL: T.BooleanType(), BYTES: T.BinaryType(), STRING: T.StringType()}
#: Fixed values of the descriptor format: field types, wire classes, labels.
_PROTO_TYPES = {DOUBLE: 1, INT64: 3, BOOL: 8, STRING: 9, BYTES: 12}
_WIRE_CLASSES = {INT64: 0, BOOL: 0, DOUBLE: 1, STRING: 2, BYTES: 2}
_OPTIONAL, _REQUIRED = 1, 2
MESSAGE_NAME = "TableRow"


class TableError(ValueError):
    """A table that cannot be declared."""


def json_name(name: str) -> str:
    """The JSON name of a column: underscores go, and the character after each is a capital."""
    head, *rest = name.split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in rest)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    required: bool = False
    description: str | None = None
    default: str | None = None
    number: int = 0

    @cached_property
    def wire(self) -> str:
        return WIRE_TYPES.get(self.type, STRING)

    @cached_property
    def tag(self) -> bytes:
        key, out = self.number << 3 | _WIRE_CLASSES[self.wire], bytearray()
        while key > 0x7F:
            out.append(key & 0x7F | 0x80)
            key >>= 7
        return bytes([*out, key])


@dataclass(frozen=True)
class TableSpec:
    """A destination table. Column numbers count from one, in declared order."""

    name: str
    columns: tuple[ColumnSpec, ...]
    clustering: tuple[str, ...] = ()
    partition_type: str | None = None
    partition_field: str | None = None
    places: dict[str, int] = field(init=False, repr=False, compare=False)
    json_places: dict[str, int] = field(init=False, repr=False, compare=False)
    wires: tuple[str, ...] = field(init=False, repr=False, compare=False)
    required: tuple[int, ...] = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        for c in self.columns:
            if c.type == "RECORD":
                raise TableError(f"{self.name}.{c.name}: RECORD is not supported")
        numbered = tuple(
            ColumnSpec(c.name, c.type, c.required, c.description, c.default, i + 1) for i, c in enumerate(self.columns)
        )
        object.__setattr__(self, "columns", numbered)
        object.__setattr__(self, "places", {c.name: i for i, c in enumerate(numbered)})
        object.__setattr__(self, "json_places", {json_name(c.name): i for i, c in enumerate(numbered)})
        object.__setattr__(self, "wires", tuple(c.wire for c in numbered))
        object.__setattr__(self, "required", tuple(i for i, c in enumerate(numbered) if c.required))

    def schema(self) -> T.StructType:
        """The typed schema: required columns are not null, and the declaration is in each field's metadata."""
        return T.StructType(
            [
                T.StructField(
                    c.name,
                    _SPARK[c.wire],
                    not c.required,
                    {"type": c.type, "number": c.number}
                    | ({"description": c.description} if c.description else {})
                    | ({"default": c.default} if c.default else {}),
                )
                for c in self.columns
            ]
        )

    def descriptor(self) -> bytes:
        """The table's message descriptor, wrapped as the writer's schema."""
        message = _field(1, MESSAGE_NAME.encode())
        for c in self.columns:
            label = _REQUIRED if c.required else _OPTIONAL
            own = _field(1, c.name.encode()) + _number(3, c.number) + _number(4, label) + _number(5, _PROTO_TYPES[c.wire])
            message += _field(2, own)
        return _field(1, message)


def _count(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, body: bytes) -> bytes:
    return _count(number << 3 | 2) + _count(len(body)) + body


def _number(number: int, value: int) -> bytes:
    return _count(number << 3) + _count(value)
