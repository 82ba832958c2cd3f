"""Checks of the declared constraints, which Spark does not enforce (Q1-Q5).

Each check is one aggregation per table (one scan, partial aggregation before
the shuffle) and returns a small report DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.hashing import SHA256, IdScheme, packed
from tillflow.schemas import FOREIGN_KEYS, KEYS, TABLES


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _packed(df: DataFrame, columns: list[str], *rest: str, names: list[str] | None = None) -> DataFrame:
    """Key columns as their shuffles move them."""
    return df.select(*[packed(F.col(c)).alias(a) for c, a in zip(columns, names or columns)], *rest)


def dq_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, and key values held by more than one row (Q1)."""
    out = []
    for name, df in tables.items():
        per_key = _packed(df, KEYS[name]).groupBy(*KEYS[name]).agg(F.count(F.lit(1)).alias("n"))
        out.append(
            per_key.agg(
                F.sum("n").cast("bigint").alias("n_rows"),
                F.count_if(F.col("n") > 1).cast("bigint").alias("n_dup_keys"),
            ).select(F.lit(name).alias("table_name"), "n_rows", "n_dup_keys")
        )
    return _union(out)


def dq_foreign(tables: dict[str, DataFrame]) -> DataFrame:
    """Per foreign key: child rows without a parent (Q2)."""
    out = []
    for child, ccols, parent, pcols in FOREIGN_KEYS:
        c = _packed(tables[child], ccols, names=pcols)
        orphans = c.join(_packed(tables[parent], pcols), pcols, "left_anti")
        out.append(
            orphans.agg(F.count(F.lit(1)).cast("bigint").alias("n_orphans")).select(
                F.lit(child).alias("child_table"), F.lit(parent).alias("parent_table"), "n_orphans"
            )
        )
    return _union(out)


def _per_column(tables, measure) -> DataFrame:
    out = []
    for name, df in tables.items():
        cols = [f.name for f in TABLES[name].fields]
        row = df.agg(*[measure(F.col(c), TABLES[name][c]).cast("bigint").alias(c) for c in cols])
        stacked = ", ".join(f"'{c}', `{c}`" for c in cols)
        out.append(
            row.selectExpr(f"stack({len(cols)}, {stacked}) as (column_name, n)").select(
                F.lit(name).alias("table_name"), "column_name", F.col("n").cast("bigint").alias("n")
            )
        )
    return _union(out)


def dq_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """Per column: null count (Q3). Every declared column is NOT NULL."""
    return _per_column(tables, lambda c, f: F.count_if(c.isNull())).withColumnRenamed("n", "n_nulls")


def dq_length(tables: dict[str, DataFrame], ids: IdScheme = SHA256) -> DataFrame:
    """Per text column: values longer than the declared length, for ids that of their scheme (Q4)."""

    def measure(c, field):
        limit = field.metadata.get("max_length")
        if limit is None:
            return F.lit(0)
        if field.name.endswith("_id"):
            limit = ids.id_length(field.name)
        return F.count_if(F.length(c) > limit)

    return _per_column(tables, measure).withColumnRenamed("n", "n_too_long")


def dq_quantity(valid_items: DataFrame, link: DataFrame) -> DataFrame:
    """Recount items per (order, product) and compare with the link table (Q5)."""
    keys = ["order_id", "product_id"]
    recount = _packed(valid_items, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_items"))
    joined = _packed(link, keys, "quantity").join(recount, ["order_id", "product_id"], "full_outer")
    return joined.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_keys"),
        F.count_if(~F.col("quantity").eqNullSafe(F.col("n_items").cast("int"))).cast("bigint").alias("n_mismatch"),
    )
