import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from scoreflow.layouts import KEYED7, MRI11, PAIR, PEOPLE9, FieldLayout
from scoreflow.operators import (
    cast_columns,
    drop_blank,
    keep_int_field,
    parse_delimited,
    parse_with_rejects,
    project_pair,
    split_fields,
)

GOOD = "54,1,9,12,33,2,2,7,1,4,18"
SHORT = "54,1,9,12,33"
BAD_LAST = "54,1,9,12,33,2,2,7,1,4,N/A"
BAD_FIRST = "x,1,9,12,33,2,2,7,1,4,18"
LONG = GOOD + ",more,99"
NUMBERS = [int(v) for v in GOOD.split(",")]


def values(df):
    return [tuple(r) for r in df.collect()]


def test_drop_blank(lines):
    assert values(drop_blank(lines("a", "", " ", None))) == [("a",), (" ",)]


def test_split_keeps_empty_fields(lines):
    assert split_fields(lines("a,,b,")).first().fields == ["a", "", "b", ""]


def test_keep_int_field(lines):
    df = lines(GOOD, SHORT, BAD_LAST, BAD_FIRST, LONG, "", None)
    assert values(keep_int_field(df)) == [(GOOD,), (BAD_FIRST,), (LONG,)]


def test_keep_int_field_can_fail_on_short_rows(lines):
    assert values(keep_int_field(lines(GOOD, BAD_LAST), short_rows="fail")) == [(GOOD,)]
    with pytest.raises(Exception, match="line has no field 10: 54,1,9,12,33"):
        keep_int_field(lines(GOOD, SHORT), short_rows="fail").collect()


def test_policies(lines):
    df = lines(GOOD, SHORT, BAD_LAST, LONG)
    assert values(parse_delimited(df, MRI11, "drop")) == [tuple(NUMBERS)] * 2
    nulls = values(parse_delimited(df, MRI11, "null"))
    assert nulls[0] == nulls[3] == tuple(NUMBERS)
    assert nulls[1] == tuple(NUMBERS[:5]) + (None,) * 6
    assert nulls[2] == tuple(NUMBERS[:10]) + (None,)
    with pytest.raises(Exception, match="does not fit layout mri11: 54,1,9,12,33"):
        parse_delimited(lines(SHORT), MRI11).collect()


def test_checked_field_drops_and_the_rest_is_strict(lines):
    df = lines(GOOD, SHORT, BAD_LAST)
    assert values(parse_delimited(df, MRI11, "strict", checked=10)) == [tuple(NUMBERS)]
    with pytest.raises(Exception, match="does not fit layout mri11: x,1"):
        parse_delimited(lines(BAD_FIRST), MRI11, "strict", checked=10).collect()
    with pytest.raises(Exception, match="line has no field 10"):
        parse_delimited(lines(SHORT), MRI11, "strict", checked=10, short_rows="fail").collect()


def test_checked_field_with_the_other_policies(lines):
    df = lines(GOOD, SHORT, BAD_LAST, BAD_FIRST)
    assert values(parse_delimited(df, MRI11, "null", checked=10)) == [tuple(NUMBERS), (None, *NUMBERS[1:])]
    assert values(parse_delimited(df, MRI11, "drop", checked=10)) == [tuple(NUMBERS)]
    # A checked field beyond the layout.
    pair = FieldLayout.of("first_two", ["a", "b"], "bigint")
    assert values(parse_delimited(lines(GOOD, SHORT), pair, checked=10)) == [(54, 1)]


def test_strict_fails_even_if_the_bad_column_is_not_used(lines):
    with pytest.raises(Exception, match="does not fit"):
        parse_delimited(lines(BAD_FIRST), MRI11).select("TURN").collect()


def test_kept_columns_and_mixed_types(spark):
    df = spark.createDataFrame([("k", "P17,12,33,7,1,54,4,2,1260")], "key string, value string")
    row = parse_delimited(df, PEOPLE9, keep=["key"]).first()
    assert row.asDict() == {
        "key": "k", "PNO": "P17", "Item": 12, "ORDERDR": 33, "DEPT": 7, "SEX": 1, "AGE": 54, "POS": 4,
        "IO": 2, "SECOND": 1260}


def test_decimals(lines):
    row = parse_delimited(lines("12.9,33,7,1,54,4,-2.5"), KEYED7).first()
    assert tuple(row) == (12.9, 33.0, 7.0, 1.0, 54.0, 4.0, -2.5)
    assert parse_delimited(lines("12d,33,7,1,54,4,2"), KEYED7, "drop").count() == 0


def test_truncated_decimals_must_be_finite(lines):
    layout = KEYED7.truncated()
    good, bad = "12.9,33,7,1,54,4,-2.5", "1,inf,7,1,54,4,2"
    assert parse_delimited(lines(good), layout).dtypes == [(c, "bigint") for c in KEYED7.columns]
    assert values(parse_delimited(lines(good, bad), layout, "drop")) == [(12, 33, 7, 1, 54, 4, -2)]
    assert values(parse_delimited(lines(bad), layout, "null")) == [(1, None, 7, 1, 54, 4, 2)]
    with pytest.raises(Exception, match="does not fit"):
        parse_delimited(lines("nan,1,7,1,54,4,2"), layout).collect()


def test_pair_takes_what_is_there(lines):
    assert values(project_pair(lines("P17,21,x", "only"), PAIR)) == [("P17", "21"), ("only", None)]


def test_cast_columns(spark):
    df = spark.createDataFrame([("1", "x", "keep")], "a string, b string, c string")
    assert values(cast_columns(df, ["a", "b"])) == [(1, None, "keep")]


def test_other_separators(lines):
    layout = FieldLayout.of("bars", ["a", "b"], "bigint", separator="|")
    assert values(parse_delimited(lines("1|2"), layout)) == [(1, 2)]


def test_bad_arguments(lines):
    with pytest.raises(ValueError, match="policy"):
        parse_delimited(lines(GOOD), MRI11, "loose")
    with pytest.raises(ValueError, match="field types"):
        FieldLayout("x", (("a", "date"),))
    with pytest.raises(ValueError, match="repeat"):
        FieldLayout.of("x", ["a", "a"], "bigint")
    assert KEYED7.rename(*"abcdefg").columns == list("abcdefg")


def test_each_line_is_split_once(lines):
    plan = parse_delimited(lines(GOOD), MRI11, "drop")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1
    kept = keep_int_field(lines(GOOD))._jdf.queryExecution().executedPlan().toString()
    assert kept.count("split(") == 1


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=11, max_size=11), min_size=1, max_size=20))
def test_parse_returns_what_was_rendered(lines, rows):
    df = lines(*[",".join(map(str, row)) for row in rows])
    assert sorted(values(parse_delimited(df, MRI11))) == sorted(map(tuple, rows))


def test_rejects_and_parsed_lines_are_all_lines(lines):
    layout = FieldLayout.of("pair", ["a", "b"], "bigint")
    values = ["1,2", "1", "x,2", "1,y", "", None, "3,4,5", "1,"]
    rows = parse_with_rejects(lines(*values), layout).collect()
    assert [(r.line, r.reason, r.a, r.b) for r in rows] == [
        ("1,2", None, 1, 2), ("1", "short", 1, None), ("x,2", "field a", None, 2), ("1,y", "field b", 1, None),
        ("", "short", None, None), (None, "short", None, None), ("3,4,5", None, 3, 4), ("1,", "field b", 1, None)]
