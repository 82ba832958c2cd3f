"""Basket text to item rows.

Grammar of a basket cell: ``<size> <name> - <price>`` items joined by ``", "``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEM_SEP = ", "
PRICE_SEP = " - "


def split_basket(c: Column) -> Column:
    """Array of item texts; the separator has no regex metacharacters."""
    return F.split(c, ITEM_SEP)


def explode_basket(df: DataFrame, col: str = "basket_items", out: str = "basket_item") -> DataFrame:
    """One row per item; a null basket keeps its row with a null item."""
    return df.select("*", F.explode_outer(split_basket(F.col(col))).alias(out))


def split_item_price(c: Column) -> tuple[Column, Column]:
    """Split once on the *last* ``" - "``; no separator gives (text, null)."""
    has_price = F.instr(c, PRICE_SEP) > 0
    price = F.when(has_price, F.substring_index(c, PRICE_SEP, -1))
    item = F.when(has_price, c.substr(F.lit(1), F.length(c) - F.length(price) - len(PRICE_SEP))).otherwise(c)
    return item, price


def split_size_name(c: Column) -> tuple[Column, Column]:
    """Split once on the *first* blank; one word gives (word, null)."""
    parts = F.split(c, " ", 2)
    return F.get(parts, 0), F.get(parts, 1)


def item_columns(df: DataFrame, col: str = "basket_item") -> DataFrame:
    """Adds item, item_price, item_size, item_name in one projection."""
    item, price = split_item_price(F.col(col))
    size, name = split_size_name(item)
    return df.select("*", item.alias("item"), price.alias("item_price"), size.alias("item_size"), name.alias("item_name"))
