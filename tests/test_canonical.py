"""Canonical value text equals what Python prints."""

import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from tillflow.functions.canonical import card_text, double_text, string_text, timestamp_text

EDGE = [0.0, -0.0, 1.0, 3.0, 2.3, 2.30, 10.0, 1013.7, 112946.26, 499978.59, 9999999.0, 1e7, 12345678.9,
        5494173772652516.0, 1e16, 1.5e16, 1e22, 1e-4, 1.5e-4, 1e-5, 0.001, 123456.789, -2.5e20, -0.00012,
        float("inf"), float("-inf"), float("nan"), 1.7976931348623157e308, 2.2250738585072014e-308]


def _texts(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    return [r.t for r in df.select("i", double_text("v").alias("t")).orderBy("i").collect()]


def _py(v):
    return "nan" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(v)


def test_double_text_edges(spark):
    assert _texts(spark, EDGE) == [_py(v) for v in EDGE]


def test_double_text_null_is_nan(spark):
    assert _texts(spark, [None]) == ["nan"]


_FIFTEEN_DIGITS = st.builds(lambda m, k: float(f"{m}e{k}"), st.integers(-(10**15) + 1, 10**15 - 1), st.integers(-320, 300))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e12, max_value=1e12).map(lambda x: round(x, 2)),
                          _FIFTEEN_DIGITS), min_size=1, max_size=40))
def test_double_text_is_python_repr(spark, values):
    """Exact for money values and every double whose shortest text has at most
    15 significant digits, at any magnitude. (Some 16-17 digit values differ in
    the last digit on JDK 17, whose own digits are not exact there.)"""
    assert _texts(spark, values) == [repr(v) for v in values]


def test_double_text_hard_cases(spark):
    hard = [5e-324, 1e23, 2.0**55, 3.60287970189641e16, 2.881210879009443e16, 0.1 + 0.2, 0.7999999999999999, 2.0**-44]
    assert _texts(spark, hard) == [repr(v) for v in hard]


def test_timestamp_text(spark):
    rows = [(0, dt.datetime(2021, 8, 25, 0, 0)), (1, dt.datetime(2021, 8, 25, 9, 0, 0, 500000)),
            (2, dt.datetime(2021, 3, 14, 2, 30)), (3, None)]
    df = spark.createDataFrame(rows, "i int, ts timestamp_ntz")
    got = [r.t for r in df.select("i", timestamp_text("ts").alias("t")).orderBy("i").collect()]
    # All-midnight values keep their time part (T5); the DST-gap wall time is kept.
    assert got == ["2021-08-25 00:00:00", "2021-08-25 09:00:00.500000", "2021-03-14 02:30:00", "NaT"]


def test_string_and_card_text(spark):
    df = spark.createDataFrame([(0, "5494000000000001"), (1, None), (2, "x")], "i int, c string")
    plain = [r.t for r in df.select("i", card_text("c").alias("t")).orderBy("i").collect()]
    as_float = [r.t for r in df.select("i", card_text("c", "float").alias("t")).orderBy("i").collect()]
    assert plain == ["5494000000000001", "nan", "x"]
    assert as_float == ["5494000000000001.0", "nan", "x"]
    assert [r.t for r in df.select(string_text("c").alias("t")).collect()][1] == "nan"
