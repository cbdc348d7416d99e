"""Native column expressions of the row path: no Python runs for these."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def is_empty(value: Column | str) -> Column:
    """A missing value or one of no bytes."""
    return F.coalesce(F.octet_length(_c(value)), F.lit(0)) == 0


def routed(topic: Column | str, topics: Mapping[str, str]) -> Column:
    """The destination of a topic, null if it has none."""
    if not topics:
        return F.lit(None).cast("string")
    pairs = F.create_map(*(F.lit(x) for pair in topics.items() for x in pair))
    return F.try_element_at(pairs, _c(topic))


def _big_endian(raw: Column) -> Column:
    """Up to eight bytes as a signed number."""
    high, low = F.conv(F.hex(F.substring(raw, 1, 4)), 16, 10).cast("long"), F.conv(F.hex(F.substring(raw, 5, 4)), 16, 10).cast("long")
    return F.when(F.octet_length(raw) <= 4, high).otherwise(F.shiftleft(high, 32).bitwiseOR(low))


def framing_id(value: Column | str) -> Column:
    """The schema id of a framed value, null if it is not framed."""
    v = _c(value)
    short = _big_endian(F.substring(v, 2, 4))
    framed = (F.octet_length(v) >= 5) & (F.hex(F.substring(v, 1, 1)) == "00")
    wide = F.when(F.octet_length(v) >= 9, _big_endian(F.substring(v, 2, 8)))
    return F.when(framed, F.when(short != 0, short).otherwise(wide))


def event_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds as text with six digits of the second (session time zone: UTC)."""
    return F.date_format(F.timestamp_millis(_c(ms).cast("long")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
