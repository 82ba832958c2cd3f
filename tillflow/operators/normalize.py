"""Receipts to 1NF item rows and the four 3NF tables.

Plan shape: the raw rows are scanned once; ``order_id`` is hashed before the
personal columns are dropped; the basket is exploded (narrow). The only
shuffles are the dedups of stores / orders / products and the quantity count,
each with a map-side partial aggregate, so a key that holds a third of all rows
is collapsed before it is shuffled. ``store_id`` and ``product_id`` are pure
functions of the joined columns, so by default they are hashed in place and the
two lookup joins of the original design disappear (``*_by_join`` keep them).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.basket import explode_basket, item_columns, split_basket
from tillflow.functions.clean import counted_rejects
from tillflow.functions.hashing import SHA256, IdScheme, packed, unpacked
from tillflow.schemas import DEAL, PARTITION_COLUMN, PII_COLUMNS, RECORD, Staged

PRODUCT_COLS = ["item_name", "item_size", "item_price"]
#: Products up to this many are broadcast to the items that look their ids up.
BROADCAST_PRODUCTS = 500_000


def with_order_id(receipts: DataFrame, ids: IdScheme = SHA256) -> DataFrame:
    """Adds ``order_id`` from all seven raw columns, PII included."""
    return receipts.select("*", ids.order_id().alias("order_id"))


def drop_pii(df: DataFrame) -> DataFrame:
    return df.drop(*PII_COLUMNS)


def hash_pii(df: DataFrame, ids: IdScheme = SHA256) -> DataFrame:
    """Pseudonymise instead of drop (P6): each personal value by its hash."""
    for c in PII_COLUMNS:
        df = df.withColumn(c, ids.pseudonym(c))
    return df


def clean(receipts: DataFrame, ids: IdScheme = SHA256) -> DataFrame:
    """Typed receipts -> receipts with ``order_id`` and without PII."""
    return drop_pii(with_order_id(receipts, ids))


def to_1nf(cleaned: DataFrame) -> DataFrame:
    """One row per basket item, with item / price / size / name."""
    return item_columns(explode_basket(cleaned))


def item_reject() -> F.Column:
    """Why an item forms no product; null when it does."""
    return (
        F.when(F.col("basket_item").isNull(), F.lit("no basket"))
        .when(F.col("item_price").isNull(), F.lit("no price"))
        .when(F.col("item_name").isNull() | F.col("item_size").isNull(), F.lit("no size and name"))
        .when(F.col("item_price").try_cast("double").isNull(), F.lit("price not a number"))
    )


def valid_items(items: DataFrame) -> DataFrame:
    """Items with a name, a size and a price that is a number.

    ``order_id`` is never null (a hash of coalesced text), so it is not tested:
    the test would be pushed below the joins and hash every receipt twice.
    """
    return items.filter(
        F.col("item_name").isNotNull() & F.col("item_size").isNotNull() & F.col("item_price").try_cast("double").isNotNull()
    )


def rejected_items(items: DataFrame) -> DataFrame:
    """Item rows that form no product, with the ``reason``."""
    return items.withColumn("reason", item_reject()).where("reason IS NOT NULL")


def item_rejects(items: DataFrame) -> DataFrame:
    """The rejected items of each order and file, equal ones counted; an order without a basket is no reject."""
    file = F.col("file_path") if "file_path" in items.columns else F.lit(None).cast("string")
    bad = rejected_items(items).where("reason <> 'no basket'").select("reason", "order_id", "basket_item", file.alias("file_path"))
    return counted_rejects(bad)


def stores(cleaned: DataFrame, ids: IdScheme = SHA256) -> DataFrame:
    """Distinct store names (a null name is one store, id from ``nan``)."""
    return cleaned.select("store_name").distinct().select(ids.store_id().alias("store_id"), "store_name")


def orders(cleaned: DataFrame, ids: IdScheme = SHA256) -> DataFrame:
    """Distinct order rows, store id hashed in place of the store join.

    The whole row is compared: the text that ``order_id`` hashes has no
    separator, so two receipts can share an id. Both stay, and the key check
    (Q1) reports them.
    """
    return (
        cleaned.select("order_id", "timestamp", "store_name", "total_price", "payment_type")
        .distinct()
        .select("order_id", "timestamp", ids.store_id().alias("store_id"), "total_price", "payment_type")
    )


def products(items: DataFrame, ids: IdScheme = SHA256) -> DataFrame:
    """Distinct (name, size, price text), id hashed from that text.

    ``item_price`` stays text here; ``sinks.tables.conform`` types it (T14).
    """
    return (
        valid_items(items)
        .select(*PRODUCT_COLS)
        .distinct()
        .select(ids.product_id().alias("product_id"), *PRODUCT_COLS)
    )


def order_month() -> F.Column:
    return F.trunc(F.col("timestamp").cast("date"), "month").alias("order_month")


def _link_rows(items: DataFrame, ids: IdScheme, dated: bool = False) -> DataFrame:
    v = valid_items(items)
    extra = [c for c in ("file_time", "file_path", DEAL) if c in v.columns]
    extra += ["order_month" if "order_month" in v.columns else order_month()] if dated else []
    if ids.jvm_only:
        return v.select("order_id", ids.product_id().alias("product_id"), *extra)
    # Python-side hash: hash each distinct product once, then look it up.
    return v.join(products(items, ids), PRODUCT_COLS, "left").select("order_id", "product_id", *extra)


def by_order(cleaned: DataFrame) -> DataFrame:
    """Receipts dealt to tasks by their order, so that its items are made and counted where they lie.

    A receipt moves once and whole, which is less than each of its items with two ids.
    """
    moved = cleaned.select(packed(F.col("order_id")).alias(DEAL), *[c for c in cleaned.columns if c != "order_id"])
    return moved.repartition(DEAL).select(unpacked(F.col(DEAL)).alias("order_id"), "*")


def _link_keys(items: DataFrame, dated: bool) -> list[str]:
    """What a link row is grouped by; where orders have been dealt to tasks, that too, so that the groups stay where they are."""
    return [*([DEAL] if DEAL in items.columns else []), "order_id", "product_id", *(["order_month"] if dated else [])]


def orders_products(items: DataFrame, ids: IdScheme = SHA256, dated: bool = False) -> DataFrame:
    """Quantity per (order, product): items of one file add up.

    ``dated`` also keeps ``order_month`` (a function of the order, so grouping
    by it changes nothing) for the month-partitioned target.
    """
    keys = _link_keys(items, dated)
    return _link_rows(items, ids, dated).groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("quantity"))


def orders_products_by_file(items: DataFrame, ids: IdScheme = SHA256, dated: bool = False) -> DataFrame:
    """Quantities when rows come from several files: within a file they add,
    across files the earliest file wins (T12, T13, W1).

    A file may arrive as several parts; its time is that of its first part. Two
    aggregations, both with map-side partial aggregation: a count per (order,
    product, file), then ``min_by`` on the file order per (order, product). No
    window sorts a hot key's rows in one task.
    """
    keys = _link_keys(items, dated)
    per_file = (
        _link_rows(items, ids, dated)
        .groupBy(*keys, "file_path")
        .agg(F.count(F.lit(1)).cast("int").alias("quantity"), F.min("file_time").alias("file_time"))
    )
    first = F.min_by(F.struct("quantity", "file_time", "file_path"), F.struct("file_time", "file_path"))
    return (
        per_file.groupBy(*keys)
        .agg(first.alias("w"))
        .select(*keys, "w.quantity", "w.file_time", "w.file_path")
    )


def orders_by_join(cleaned: DataFrame, store_table: DataFrame) -> DataFrame:
    """J1 as written originally: look ``store_id`` up by name, null-safe.

    The stores side is small (one row per store); AQE turns the sort-merge join
    into a broadcast when its measured size is under the broadcast threshold.
    """
    o = cleaned.select("order_id", "timestamp", "store_name", "total_price", "payment_type").distinct()
    s = store_table.withColumnRenamed("store_name", "s_name")
    return o.join(s, o.store_name.eqNullSafe(s.s_name), "left").select(
        "order_id", "timestamp", "store_id", "total_price", "payment_type"
    )


def orders_products_by_join(items: DataFrame, product_table: DataFrame) -> DataFrame:
    """J2 as written originally: look ``product_id`` up by (price, size, name).

    Items are counted per order first, so the join moves one row for each
    product of an order, and a popular product no more than that. Up to
    ``BROADCAST_PRODUCTS`` products go to the items: where orders have been dealt to
    tasks, no item and no link row moves then. Of more products (count them from a
    stored table), the rows of an id that is in the table once are final after the
    join; only rows of an id that several products share, or of none, meet again.
    """
    valid = valid_items(items).where(F.col("item_price").isNotNull())
    if DEAL not in items.columns:
        valid = valid.withColumn(DEAL, packed(F.col("order_id")))
    counted = valid.groupBy(DEAL, *PRODUCT_COLS).agg(F.count(F.lit(1)).cast("int").alias("quantity"))
    table = product_table.select(packed(F.col("product_id")).alias("product_id"), *PRODUCT_COLS)
    if product_table.count() <= BROADCAST_PRODUCTS:
        linked = _summed(counted.join(F.broadcast(table), PRODUCT_COLS, "left"))
    else:
        n = F.count("product_id").over(Window.partitionBy("product_id"))
        joined = counted.join(table.withColumn("once", n == 1), PRODUCT_COLS, "left")
        again = _summed(joined.where(~F.coalesce("once", F.lit(False))))
        linked = joined.where("once").select(DEAL, "product_id", "quantity").unionByName(again)
    return linked.select(unpacked(F.col(DEAL)).alias("order_id"), unpacked(F.col("product_id")).alias("product_id"), "quantity")


def _summed(linked: DataFrame) -> DataFrame:
    return linked.groupBy(DEAL, "product_id").agg(F.sum("quantity").cast("int").alias("quantity"))


class Normalized:
    """The four tables of one set of receipts, each planned only when asked for."""

    def __init__(self, receipts: DataFrame, ids: IdScheme = SHA256, by_file: bool = False):
        if "_reject" in receipts.columns:
            receipts = receipts.filter(F.col("_reject").isNull()).drop("_reject", RECORD)
        self.receipts = receipts
        self.ids = ids
        self.by_file = by_file

    @cached_property
    def cleaned(self) -> DataFrame:
        if "order_id" in self.receipts.columns:  # cleaned before
            return self.receipts
        return clean(self.receipts, self.ids)

    @cached_property
    def items(self) -> DataFrame:
        return to_1nf(self.cleaned)

    @cached_property
    def stores(self) -> DataFrame:
        return stores(self.cleaned, self.ids)

    @cached_property
    def orders(self) -> DataFrame:
        return orders(self.cleaned, self.ids)

    @cached_property
    def products(self) -> DataFrame:
        return products(self.items, self.ids)

    @cached_property
    def orders_products(self) -> DataFrame:
        return self._link(dated=False)

    def _link(self, dated: bool) -> DataFrame:
        items = self.items
        if self.ids.jvm_only:
            needed = ["order_id", "basket_items", *(["timestamp"] if dated else []), *(["file_path", "file_time"] if self.by_file else [])]
            items = to_1nf(by_order(self.cleaned.select(*needed)))
        if self.by_file:
            return orders_products_by_file(items, self.ids, dated=dated).drop("file_time", "file_path", DEAL)
        return orders_products(items, self.ids, dated=dated).drop(DEAL)

    def dated(self, name: str) -> DataFrame:
        """The table plus ``order_month`` where the target is month-partitioned."""
        if name == "orders":
            return self.orders.select("*", order_month())
        if name == "orders_products":
            return self._link(dated=True)
        return self.table(name)

    def staged(self, name: str) -> DataFrame | Staged:
        """The table for a load: the dated ones are dealt to tasks as receipts and made there."""
        if name not in PARTITION_COLUMN or not self.ids.jvm_only:
            return self.dated(name)
        needed = {
            "orders": ["store_name", "total_price", "payment_type"],
            "orders_products": ["basket_items", *(c for c in ("file_path", "file_time") if self.by_file)],
        }
        rows = self.cleaned.select("order_id", "timestamp", order_month(), *needed[name])
        if name == "orders":
            return Staged(rows, lambda dealt: dealt.withColumn("store_id", self.ids.store_id()).drop("store_name"), F.lit(1))
        link = orders_products_by_file if self.by_file else orders_products
        items = F.coalesce(F.size(split_basket(F.col("basket_items"))), F.lit(0))
        return Staged(rows.drop("timestamp"), lambda dealt: link(to_1nf(dealt), self.ids, dated=True), items, unique=True)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


def normalize(receipts: DataFrame, ids: IdScheme = SHA256, by_file: bool = False) -> Normalized:
    """Typed receipts (optionally with ``file_path``/``file_time``) -> 4 tables."""
    return Normalized(receipts, ids, by_file)
