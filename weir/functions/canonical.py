"""JSON text in one canonical form: parsing as strictly as the wire contract asks, and printing.

A document is a Python value: None, bool, int (-2**63 to 2**64 - 1), float, str, list or dict in member order. A
repeated member keeps its first place and its last value. Integers beyond 64 bits are floats, and so is -0.

Printing is compact; member order and non-ASCII text stay; control characters are escaped with lower-case digits;
floats have the fewest digits that read back, a point or an exponent without plus sign or leading zeros.

The common case runs in C (json.loads and json.dumps); only texts that hold floats, long integers or surrogate escapes
take the slower, exact path.
"""

from __future__ import annotations

import json
import re
from typing import Any

DEEPEST = 127
#: Classes of a parse error, by which a lenient reader decides whether to repair the text.
SYNTAX, SURROGATE, CONTROL = "syntax", "surrogate", "control"

#: What the C decoder would read otherwise: long integers, -0, floats that may overflow, escapes of half a pair.
_SPECIAL = re.compile(r"\d{19}|-0(?![.\d])|[eE]\+?\d{3}|\\u[dD][89a-fA-F]").search
#: Floats that json.dumps prints otherwise; in a text member this only costs time.
_REWRITTEN = re.compile(r"\de[+-]\d|NaN|Infinity").search
_SURROGATE_ESCAPE = re.compile(r"\\u[dD][89abAB][0-9a-fA-F]{2}|\\u[dD][c-fC-F][0-9a-fA-F]{2}").search
_ESCAPES = re.compile(r"\\(?:u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|u[dD][89a-fA-F][0-9a-fA-F]{2}|.)", re.S)
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")
_EXPONENT = re.compile(r"e([+-]?)0*(\d)")


class JsonError(ValueError):
    """A text that is not JSON; kind is SYNTAX, SURROGATE or CONTROL, by the first offence in the text."""

    def __init__(self, message: str, kind: str = SYNTAX):
        super().__init__(message)
        self.kind = kind


def _refuse(name: str) -> Any:
    raise JsonError(f"{name} is not JSON")


def _integer(digits: str) -> int | float:
    if digits == "-0":
        return -0.0
    if len(digits) > 21:
        return _float(digits)
    value = int(digits)
    return value if -(1 << 63) <= value < 1 << 64 else float(digits)


def _float(digits: str) -> float:
    value = float(digits)
    if value in (float("inf"), float("-inf")):
        raise JsonError("number out of range")
    return value


_FAST = json.JSONDecoder(parse_constant=_refuse)
_scan = _FAST.scan_once
_EXACT = json.JSONDecoder(parse_constant=_refuse, parse_float=_float, parse_int=_integer)


def _lone_surrogate(text: str) -> int:
    """Where the first escape of half a surrogate pair is; -1 if there is none."""
    if not _SURROGATE_ESCAPE(text):
        return -1
    return next((m.start() for m in _ESCAPES.finditer(text) if len(m[0]) == 6 and m[0][1] == "u" and m[0][2] in "dD"), -1)


def _depth(text: str) -> int:
    """The deepest nesting, strings left out."""
    deepest = depth = 0
    for c in re.sub(r'"(?:[^"\\]|\\.)*"?', "", text, flags=re.S):
        if c in "[{":
            depth += 1
            deepest = max(deepest, depth)
        elif c in "]}":
            depth -= 1
    return deepest


def parse(text: str) -> Any:
    """The value of a JSON text; raises JsonError."""
    if text.count("[") + text.count("{") > DEEPEST and _depth(text) > DEEPEST:
        raise JsonError("nested too deeply")
    special = _SPECIAL(text) is not None
    if not special:
        try:
            value, end = _scan(text, 0)
            if end == len(text):
                return value
        except (StopIteration, json.JSONDecodeError, RecursionError):
            pass  # said below; or white space around the value
    lone = _lone_surrogate(text) if special else -1
    try:
        value = (_EXACT if special else _FAST).decode(text)
    except json.JSONDecodeError as error:
        if 0 <= lone < error.pos:
            raise JsonError("lone surrogate", SURROGATE) from None
        raise JsonError(error.msg, CONTROL if error.msg.startswith("Invalid control character") else SYNTAX) from None
    except RecursionError:
        raise JsonError("nested too deeply") from None
    if lone >= 0:
        raise JsonError("lone surrogate", SURROGATE)
    return value


def mend_surrogates(text: str) -> str:
    """Escapes of half a surrogate pair become the escape of U+FFFD."""
    return _ESCAPES.sub(lambda m: "\\ufffd" if len(m[0]) == 6 and m[0][2] in "dD" else m[0], text)


def mend_controls(text: str) -> str:
    """Control characters go, but for tab, line feed and carriage return."""
    return _CONTROL.sub("", text)


def parse_lossy(raw: bytes) -> Any:
    """The value of JSON bytes, read as UTF-8 with replacement; one repair, of the first offence's kind alone."""
    text = raw.decode("utf-8", "replace")
    try:
        return parse(text)
    except JsonError as error:
        if error.kind == SYNTAX:
            raise
        return parse(mend_surrogates(text) if error.kind == SURROGATE else mend_controls(text))


def float_text(value: float) -> str:
    """A float's canonical text; null where JSON has none."""
    if value != value or value in (float("inf"), float("-inf")):
        return "null"
    text = repr(value)
    if "e" not in text:
        return text
    if 1e-5 <= abs(value) < 1e-4:
        sign, digits = ("-", text[1:]) if text[0] == "-" else ("", text)
        return f"{sign}0.0000{digits[: digits.index('e')].replace('.', '')}"
    return _EXPONENT.sub(lambda m: f"e{'-' if m[1] == '-' else ''}{m[2]}", text)


_string = json.encoder.encode_basestring


_encoder = json.JSONEncoder(ensure_ascii=False, separators=(",", ":"), check_circular=False)
#: One C encoder for all values: JSONEncoder.encode() makes one for each.
_make = json.encoder.c_make_encoder
_chunks = _make and _make(None, _encoder.default, _string, None, ":", ",", False, False, True)


def _plain(value: Any) -> str:
    return "".join(_chunks(value, 0)) if _chunks else _encoder.encode(value)


def _write(value: Any) -> str:
    kind = type(value)
    if kind is float:
        return float_text(value)
    if kind is dict:
        return "{" + ",".join([f"{_string(k)}:{_write(v)}" for k, v in value.items()]) + "}"
    if kind is list:
        return "[" + ",".join(map(_write, value)) + "]"
    return _plain(value)


def dump(value: Any) -> str:
    """The canonical text of a value."""
    text = _plain(value)
    return _write(value) if _REWRITTEN(text) else text
