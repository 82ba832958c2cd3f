"""Run metrics by time bucket and over look-back horizons.

Invocations, errors and duration (average, sum, min, max), per function. Sums go
through DECIMAL(30,8), so they do not depend on the order rows are added in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Look-back horizons of the monitoring board, in hours (24 h, 2 and 7 days).
HORIZONS = (("24h", 24), ("2d", 48), ("7d", 168))


def _measures(ts_col: str, kind_col: str, dur_col: str, error_kind: str) -> list[Column]:
    total = F.sum(F.col(dur_col).cast("decimal(30,8)")).cast("double")
    n = F.count(F.lit(1))
    return [
        n.cast("bigint").alias("invocations"),
        F.count_if(F.col(kind_col) == error_kind).cast("bigint").alias("errors"),
        (total / n).alias("dur_avg"),
        total.alias("dur_sum"),
        F.min(dur_col).alias("dur_min"),
        F.max(dur_col).alias("dur_max"),
    ]


def metrics_by_window(events: DataFrame, every: str = "1 hour", ts_col: str = "ts", kind_col: str = "event_type",
                      dur_col: str = "value", error_kind: str = "error") -> DataFrame:
    return (
        events.groupBy(F.window(ts_col, every).alias("w"), F.col(kind_col).alias("function_name"))
        .agg(*_measures(ts_col, kind_col, dur_col, error_kind))
        .select(F.col("w.start").alias("window_start"), "function_name", "invocations", "errors", "dur_avg", "dur_sum", "dur_min", "dur_max")
    )


def metrics_lookback(events: DataFrame, horizons=HORIZONS, ts_col: str = "ts", kind_col: str = "event_type",
                     dur_col: str = "value", error_kind: str = "error") -> DataFrame:
    """Per horizon and kind, over (latest - horizon, latest] of the data itself.

    One scan: each row is tagged with the horizons it falls in (at most three),
    then one grouped aggregate. ``latest`` is a scalar subquery.
    """
    latest = events.select(F.max(ts_col)).scalar()
    tags = F.array_compact(
        F.array(
            *[
                F.when(F.col(ts_col) > F.timestamp_add("HOUR", F.lit(-h), latest), F.struct(F.lit(lbl).alias("horizon")))
                for lbl, h in horizons
            ]
        )
    )
    return (
        events.select(ts_col, kind_col, dur_col, F.explode(tags).alias("t"))
        .groupBy(F.col("t.horizon").alias("horizon"), F.col(kind_col).alias("function_name"))
        .agg(*_measures(ts_col, kind_col, dur_col, error_kind))
    )
