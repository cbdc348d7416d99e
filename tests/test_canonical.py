import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weir.functions.canonical import CONTROL, SURROGATE, SYNTAX, JsonError, dump, float_text, mend_surrogates, parse, parse_lossy


@pytest.mark.parametrize(
    ("value", "text"),
    [
        (1.0, "1.0"), (-0.0, "-0.0"), (1e20, "1e20"), (1e16, "1e16"), (1e15, "1000000000000000.0"), (1.5e-7, "1.5e-7"), (1e-5, "0.00001"),
        (1.234e-5, "0.00001234"), (-9.9e-5, "-0.000099"), (1e-4, "0.0001"), (1.2345678901234568e29, "1.2345678901234568e29"),
        (float("nan"), "null"), (float("inf"), "null"), (5e-324, "5e-324"), (1.7976931348623157e308, "1.7976931348623157e308"),
    ],
)
def test_floats(value, text):
    assert float_text(value) == text


@pytest.mark.parametrize(
    ("text", "canonical"),
    [
        ('{ "b" : 1, "a": [ ] }', '{"b":1,"a":[]}'),
        ('{"k":"v","k":"w"}', '{"k":"w"}'),
        ('{"a":1,"b":2,"a":3}', '{"a":3,"b":2}'),
        ('"\\u00e9\\/\\u2028\x7f"', '"é/\u2028\x7f"'),
        ('"\\u0001\\b\\f\\n\\r\\t\\"\\\\"', '"\\u0001\\b\\f\\n\\r\\t\\"\\\\"'),
        ("18446744073709551615", "18446744073709551615"),
        ("18446744073709551616", "1.8446744073709552e19"),
        ("-9223372036854775809", "-9.223372036854776e18"),
        ("123456789012345678901234567890", "1.2345678901234568e29"),
        ("-0", "-0.0"), ("[-0,0,-0.0]", "[-0.0,0,-0.0]"), ("1E2", "100.0"), ('"\\ud83d\\ude00"', '"😀"'),
    ],
)
def test_canonical(text, canonical):
    assert dump(parse(text)) == canonical


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("", SYNTAX), ("nope", SYNTAX), ("NaN", SYNTAX), ("[1,]", SYNTAX), ("1e999", SYNTAX), ("\ufeff1", SYNTAX), ("[01]", SYNTAX), ("1 2", SYNTAX),
        ('"\\ud83d"', SURROGATE), ('"\\udc00 \\ud83d\\ude00"', SURROGATE), ('"a\x01"', CONTROL), ('"\x01\\ud83d"', CONTROL), ('"\\ud83d\x01"', SURROGATE),
        ("[" * 128 + "]" * 128, SYNTAX), ("[" * 5000, SYNTAX),
    ],
)
def test_errors(text, kind):
    with pytest.raises(JsonError) as error:
        parse(text)
    assert error.value.kind == kind


def test_depth_counts_nesting_only():
    assert parse("[" * 127 + "]" * 127)
    assert parse(json.dumps(["[" * 300, '"\\[']))


def test_lossy_repairs_one_class_only():
    assert parse_lossy(b'{"x":"bad \xff"}') == {"x": "bad \ufffd"}
    assert parse_lossy(b'"\\ud83d!"') == "\ufffd!"
    assert parse_lossy(b'"a\x01b"') == "ab"
    with pytest.raises(JsonError):
        parse_lossy(b'"\x01\\ud83d"')
    assert mend_surrogates('\\\\ud83d \\ud83d \\ud83d\\ude00 \\u0041') == "\\\\ud83d \\ufffd \\ud83d\\ude00 \\u0041"


_JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**63), 2**64 - 1) | st.floats(allow_nan=False, allow_infinity=False) | st.text(st.characters(exclude_categories=["Cs"])),
    lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(st.characters(exclude_categories=["Cs"]), max_size=5), x, max_size=4),
    max_leaves=20,
)


@settings(max_examples=300, deadline=None)
@given(_JSON)
def test_round_trip(value):
    text = dump(value)
    again = parse(text)
    assert again == value and dump(again) == text


@settings(max_examples=300, deadline=None)
@given(st.floats(allow_nan=False, allow_infinity=False))
def test_float_text_reads_back(value):
    back = float(float_text(value))
    assert back == value and math.copysign(1, back) == math.copysign(1, value)
