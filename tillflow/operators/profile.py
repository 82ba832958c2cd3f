"""Inspection reports of the scripts, made distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.basket import split_basket


def qty_profile(link: DataFrame) -> DataFrame:
    """Link rows with quantity > 0, > 1, > 2 in one pass; null rows left out."""
    q = F.col("quantity")
    return link.filter(q.isNotNull()).agg(
        F.count_if(q > 0).cast("bigint").alias("n_gt0"),
        F.count_if(q > 1).cast("bigint").alias("n_gt1"),
        F.count_if(q > 2).cast("bigint").alias("n_gt2"),
    )


def row_counts(receipts: DataFrame) -> DataFrame:
    """Rows before and after the explode, in one scan.

    ``posexplode_outer`` yields position 0 (or null for a null basket) exactly
    once per receipt, so both counts come from the exploded rows.
    """
    exploded = receipts.select(F.posexplode_outer(split_basket(F.col("basket_items"))).alias("pos", "item"))
    return exploded.agg(
        F.count_if(F.col("pos").isNull() | (F.col("pos") == 0)).cast("bigint").alias("n_receipts"),
        F.count(F.lit(1)).cast("bigint").alias("n_items"),
    )


def preview(df: DataFrame, order_cols: list[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in a fixed order (L1): a top-k per partition, then a merge."""
    return df.orderBy(*order_cols).limit(n)


def lookup_by_key(link: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """The first link row and its order and product rows (L2, F2), over stored tables.

    The key of one row is fetched (a top-1 over the key columns), then every
    table is read with that key as a filter that reaches its scan.
    """
    first = link.select("order_id", "product_id").orderBy("order_id", "product_id").limit(1).collect()
    order, product = (first[0]["order_id"], first[0]["product_id"]) if first else (None, None)
    return (
        link.where((F.col("order_id") == F.lit(order)) & (F.col("product_id") == F.lit(product)))
        .join(orders.where(F.col("order_id") == F.lit(order)).select("order_id", "timestamp", "total_price", "payment_type"), "order_id")
        .join(products.where(F.col("product_id") == F.lit(product)).select("product_id", "item_name", "item_size", "item_price"), "product_id")
        .select("order_id", "product_id", "quantity", "timestamp", "total_price", "payment_type", "item_name", "item_size", "item_price")
    )
