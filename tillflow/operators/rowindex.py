"""Dense 0..n-1 row index over a total order (K3).

A window ``row_number()`` without ``partitionBy`` pulls every row into one
task. Instead: sort (range partitioned, so partition order is global order),
checkpoint to the shared folder so the layout is fixed, count rows per
partition, turn the counts into offsets (one row per partition, a bounded
broadcast) and add the position inside the partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.session import ensure_checkpoint_dir


def with_row_index(df: DataFrame, order_cols: list[str], name: str = "row_index") -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    ordered = (
        df.orderBy(*order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
        .checkpoint(eager=True)
    )
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
    )
    return ordered.join(F.broadcast(offsets), "_pid").select(
        (F.col("_off") + F.col("_local")).alias(name), *[F.col(c) for c in df.columns]
    )
