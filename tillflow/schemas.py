"""Schemas of the raw receipt and of the four processed tables (K6).

Keys are STRING, never CHAR(n): a blank-padded CHAR key never equals the
unpadded staging key, so an anti join against it would insert duplicates.
Declared NOT NULL / PK / FK constraints are checked by ``operators.quality``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

# Positional column names of the raw, headerless receipt file.
RAW_COLUMNS = [
    "timestamp",
    "store_name",
    "customer_name",
    "basket_items",
    "total_price",
    "payment_type",
    "card_number",
]

PII_COLUMNS = ["customer_name", "card_number"]

# Every raw field is read as text; typing happens in ``functions.clean`` so that
# the NA spellings, the timestamp formats and bad numbers are handled in one place.
RAW_TEXT = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Text of a row that does not have exactly these fields (null for all others).
RECORD = "_record"
RAW_READ = T.StructType([*RAW_TEXT.fields, T.StructField(RECORD, T.StringType(), True)])

# Raw receipt after typing (what the fixture view and the cleaner produce).
RAW_TYPED = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), True),
        T.StructField("store_name", T.StringType(), True),
        T.StructField("customer_name", T.StringType(), True),
        T.StructField("basket_items", T.StringType(), True),
        T.StructField("total_price", T.DoubleType(), True),
        T.StructField("payment_type", T.StringType(), True),
        T.StructField("card_number", T.StringType(), True),
    ]
)


def _f(name, dtype, comment=None, max_len=None):
    meta = {}
    if comment:
        meta["comment"] = comment
    if max_len:
        meta["max_length"] = max_len
    return T.StructField(name, dtype, False, metadata=meta)


STORES = T.StructType(
    [
        _f("store_id", T.StringType(), "content hash of the store name", 16),
        _f("store_name", T.StringType(), None, 255),
    ]
)

ORDERS = T.StructType(
    [
        _f("order_id", T.StringType(), "content hash of the whole raw receipt row", 16),
        _f("timestamp", T.TimestampNTZType(), "receipt time, no zone"),
        _f("store_id", T.StringType(), None, 16),
        _f("total_price", T.DoubleType()),
        _f("payment_type", T.StringType(), None, 4),
    ]
)

PRODUCTS = T.StructType(
    [
        _f("product_id", T.StringType(), "content hash of name, size and price text", 16),
        _f("item_name", T.StringType(), None, 255),
        _f("item_size", T.StringType(), None, 255),
        _f("item_price", T.DoubleType()),
    ]
)

ORDERS_PRODUCTS = T.StructType(
    [
        _f("order_id", T.StringType(), None, 16),
        _f("product_id", T.StringType(), None, 16),
        _f("quantity", T.IntegerType(), "number of items per order and product"),
    ]
)

# What a load turns away: receipts and items, with the reason and how often it occurs in a file.
RECEIPT_REJECTS = T.StructType(
    [
        T.StructField("reject_id", T.StringType(), False),
        T.StructField("reason", T.StringType(), False),
        T.StructField("record", T.StringType(), True),
        T.StructField("file_path", T.StringType(), True),
        T.StructField("n", T.LongType(), False),
    ]
)
ITEM_REJECTS = T.StructType(
    [
        T.StructField("reject_id", T.StringType(), False),
        T.StructField("reason", T.StringType(), False),
        T.StructField("order_id", T.StringType(), False),
        T.StructField("basket_item", T.StringType(), True),
        T.StructField("file_path", T.StringType(), True),
        T.StructField("n", T.LongType(), False),
    ]
)
REJECTS = {"receipt_rejects": RECEIPT_REJECTS, "item_rejects": ITEM_REJECTS}

TABLES = {
    "stores": STORES,
    "orders": ORDERS,
    "products": PRODUCTS,
    "orders_products": ORDERS_PRODUCTS,
}

KEYS = {
    "stores": ["store_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "orders_products": ["order_id", "product_id"],
}

# (child table, child columns, parent table, parent columns)
FOREIGN_KEYS = [
    ("orders", ["store_id"], "stores", ["store_id"]),
    ("orders_products", ["order_id"], "orders", ["order_id"]),
    ("orders_products", ["product_id"], "products", ["product_id"]),
]

# Fact tables are stored partitioned by the receipt month (first day of the
# month). An id hashes the receipt's timestamp, so a key can only exist under
# its own month: a load reads only the target partitions of the months in its
# batch (see sinks.tables). Months, not days: a backfill over years writes tens
# of folders per task, not thousands, and a daily batch still reads ~1/60 of
# five years.
PARTITION_COLUMN = {"orders": "order_month", "orders_products": "order_month"}

# Column that says which task of a large load a row of a dated table goes to: a month, or a part of its orders.
DEAL = "_deal"


@dataclass(frozen=True)
class Staged:
    """Staging of a dated table that is made where it will be written.

    ``rows`` have ``order_id`` and ``order_month``. ``finish`` makes the table's
    rows (and keeps ``DEAL``) once all rows of an order are in one task; ``size`` is at
    least the rows of the table that one of ``rows`` gives. ``unique``: they come
    one per key. ``sizes``: the rows of each month, about, where counting them
    would make ``rows`` once more; all months of ``rows`` are in it.
    """

    rows: DataFrame
    finish: Callable[[DataFrame], DataFrame]
    size: Column
    unique: bool = False
    sizes: dict | None = None


# Load order that keeps every foreign key satisfied at each commit.
LOAD_ORDER = ["stores", "products", "orders", "orders_products"]

# File-name suffix of each processed output, by table.
TABLE_SUFFIX = {
    "stores": "_stores",
    "orders": "_orders",
    "products": "_products",
    "orders_products": "_ordersproducts",
}
