"""Zone-free parsing and epoch conversion."""

import datetime as dt

from pyspark.sql import functions as F

from tillflow.functions.timeparse import (DAY_FIRST_FORMATS, ISO_FORMATS, MONTH_FIRST_FORMATS, epoch_seconds,
                                          from_epoch_seconds, parse_ntz)


def _parse(spark, texts, formats):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r.t for r in df.select("i", parse_ntz(F.col("s"), formats).alias("t")).orderBy("i").collect()]


def test_dst_gap_wall_time_is_kept(spark):
    # The session zone of the tests is America/New_York, where 02:30 on this day does not exist.
    assert _parse(spark, ["2021-03-14 02:30:00"], ISO_FORMATS) == [dt.datetime(2021, 3, 14, 2, 30)]


def test_formats(spark):
    texts = ["2021-08-25 09:00:00", "2021-08-25 09:00:00.5", "2021-08-25T09:00:00", "2021-08-25", "bad", None, "2021-02-30 10:00:00"]
    assert _parse(spark, texts, ISO_FORMATS) == [
        dt.datetime(2021, 8, 25, 9), dt.datetime(2021, 8, 25, 9, 0, 0, 500000), dt.datetime(2021, 8, 25, 9),
        dt.datetime(2021, 8, 25), None, None, None,
    ]
    assert _parse(spark, ["01/08/2021 09:00"], DAY_FIRST_FORMATS) == [dt.datetime(2021, 8, 1, 9)]
    assert _parse(spark, ["01/08/2021 09:00"], MONTH_FIRST_FORMATS) == [dt.datetime(2021, 1, 8, 9)]


def test_epoch_round_trip(spark):
    vals = [dt.datetime(1970, 1, 1), dt.datetime(2021, 3, 14, 2, 30), dt.datetime(2024, 1, 1, 0, 0, 7, 179575),
            dt.datetime(1969, 12, 31, 23, 59, 59, 500000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, ts timestamp_ntz")
    out = df.select("i", epoch_seconds(F.col("ts")).alias("e")).withColumn("back", from_epoch_seconds(F.col("e"))).orderBy("i").collect()
    utc = dt.timezone.utc
    expect = [int((v.replace(tzinfo=utc).timestamp()) // 1) for v in vals]
    assert [r.e for r in out] == expect
    assert out[1].back == dt.datetime(2021, 3, 14, 2, 30)
