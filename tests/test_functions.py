import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from scoreflow.functions import (
    clean_utf8,
    encode_utf8,
    float_text,
    int_text,
    int_vector,
    key_minutes_line,
    minutes_message,
    seconds_line,
    seconds_message,
    truncate,
    truncate_vector,
    whole_minutes,
    zip_rows,
)


def outcomes(spark, values, column, source="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, value {source}")
    got = rows.select("i", column.alias("out")).orderBy("i").collect()
    return [r.out for r in got]


def python_number(kind, text):
    try:
        return kind(text)
    except ValueError:
        return None


INTS = ["5", " 5 ", "+5", "-7", "007", "\t8\n", "1_000", "-1_0_0", "", " ", "x", "3.7", "1e3", "5d", "5L",
        "NaN", "inf", "0x1F", "1__0", "_1", "1_", "--1", "+ 1", "N/A", "9223372036854775807"]


def test_int_text_reads_what_python_reads(spark):
    assert outcomes(spark, INTS, int_text("value")) == [python_number(int, v) for v in INTS]


def test_int_text_gives_null_beyond_64_bits_and_for_null(spark):
    assert outcomes(spark, ["9223372036854775808", None], int_text("value")) == [None, None]


FLOATS = ["5", " 5.25 ", "+.5", "-5.", "1e3", "1E-2", "1_000.5", "inf", "-Infinity", "", "x", "5d", "5f",
          "0x1p3", "1e", ".", "1__0", "3.7.1", "N/A"]


def test_float_text_reads_what_python_reads(spark):
    assert outcomes(spark, FLOATS, float_text("value")) == [python_number(float, v) for v in FLOATS]


def test_float_text_nan(spark):
    assert math.isnan(outcomes(spark, ["NaN"], float_text("value"))[0])


def test_truncate_toward_zero(spark):
    values = [1.9, -1.9, 0.0, -0.5, float("nan"), float("inf"), 1e300, None]
    assert outcomes(spark, values, truncate(F.col("value")), "double") == [1, -1, 0, 0, None, None, None, None]


def test_minutes_truncate_then_floor(spark):
    values = [-61.5, -59.5, -0.5, 59.9, 60.0, 119.99, None]
    assert outcomes(spark, values, whole_minutes(F.col("value")), "double") == [-2, -1, 0, 0, 1, 1, None]


def test_messages(spark):
    row = spark.createDataFrame([("P1", 3, 200.25), (None, -1, -60.0)], "PNO string, minutes bigint, seconds double")
    pno, minutes, seconds = F.col("PNO"), F.col("minutes"), F.col("seconds")
    got = row.select(
        minutes_message(pno, minutes), seconds_message(seconds), seconds_line(seconds), key_minutes_line(pno, minutes)
    ).collect()
    assert list(got[0]) == [
        "The Patient NO. is P1, need 3 minutes to detect by MRI",
        "The AI predict that 200.25 seconds to detect from  MRI",
        "This patient need 200.25 seconds to detect from MRI",
        "P1,3",
    ]
    assert got[1][0] == "The Patient NO. is None, need -1 minutes to detect by MRI"
    assert got[1][3] == "None,-1"


def test_vectors(spark):
    row = spark.createDataFrame([(1.9, -1.9, [2.7, -2.7])], "a double, b double, v array<double>")
    got = row.select(int_vector(["a", "b"]), truncate_vector(F.col("v"))).first()
    assert list(got) == [[1, -1], [2, -2]]


def test_zip_stops_at_the_shorter_array(spark):
    row = spark.createDataFrame([([7, 8, 9], [0.5, 1.5])], "i array<bigint>, p array<double>")
    got = row.select(zip_rows(F.col("i"), F.col("p"), "row_id", "prediction"))
    assert [tuple(r) for r in got.collect()] == [(7, 0.5), (8, 1.5)]


BYTES = [b"a\xffb", b"\xe2\x82", b"\xe2\x28\xa1", b"\xf0\x80\x80\x41", b"\xed\xa0\x80z", b"", b"plain",
         "é漢😀".encode(), "real � stays".encode(), "ab�".encode(), b"\xc0\xaf\xf5\xe0\x80"]


def test_clean_utf8_leaves_out_what_python_ignores(spark):
    got = outcomes(spark, [bytearray(b) for b in BYTES], clean_utf8(F.col("value")), "binary")
    assert got == [b.decode("utf-8", "ignore") for b in BYTES]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.binary(max_size=24), st.text(max_size=8).map(lambda t: t.encode("utf-8", "ignore"))),
                min_size=1, max_size=60))
def test_clean_utf8_on_any_bytes(spark, payloads):
    got = outcomes(spark, [bytearray(b) for b in payloads], clean_utf8(F.col("value")), "binary")
    assert got == [b.decode("utf-8", "ignore") for b in payloads]


def test_encode_utf8(spark):
    got = outcomes(spark, ["aé😀", None], encode_utf8(F.col("value")))
    assert [None if b is None else bytes(b) for b in got] == ["aé😀".encode(), None]


@pytest.mark.parametrize("text", ["a'b", "back\\slash", "`tick`"])
def test_odd_names_and_separators_survive_as_sql_text(spark, text):
    from scoreflow.functions.sqltext import literal, name

    row = spark.range(1).selectExpr(f"{literal(text)} AS {name(text)}")
    assert row.columns == [text] and row.first()[0] == text
