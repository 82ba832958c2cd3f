"""Receipt-shaped input derived by Spark from the driver tables.

The driver ships TPC-H-like parquet, not receipt files. This view gives every
order one receipt row with the seven raw columns:

=============  ==================================================================
timestamp      ``o_orderdate``
store_name     ``n_name`` of the customer's nation
customer_name  ``c_name``
basket_items   the order's items ``<p_brand> <p_name> - <p_retailprice>``, sorted,
               joined by ``", "``
total_price    ``o_totalprice``
payment_type   ``CARD`` for priorities 1-URGENT and 2-HIGH, else ``CASH``
card_number    ``5494`` + ``o_custkey`` padded to 12 digits, for cards only
=============  ==================================================================

An order without line items is a receipt with a null basket.
The basket of one order is built in one task: a receipt is one row, so a basket
is bounded by what one till prints (TPC-H: at most seven lines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The cut dates of the two overlapping "files" (file A: before
# 1999-01-01; file B: from 1997-01-01, where 1997-1998 appears twice in B).
FILE_A_BEFORE = "1999-01-01 00:00:00"
FILE_B_FROM = "1997-01-01 00:00:00"
FILE_B_TWICE_BEFORE = "1999-01-01 00:00:00"


# Types of the driver-table columns used here (TESTDATA.md,
# FIXTURES.md section 6). Declared, so reads need no footer inference and scan
# only these columns.
DRIVER_COLUMNS = {
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_shipdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_brand string, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "pages": "page_id long, url string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_COLUMNS:
        reader = reader.schema(DRIVER_COLUMNS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def receipts_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts plus ``o_orderkey`` (kept only for fixture bookkeeping)."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_retailprice")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    item = F.concat(
        F.col("p_brand"), F.lit(" "), F.col("p_name"), F.lit(" - "), F.col("p_retailprice").cast("string")
    )
    # Partition the item texts by order straight after the part lookup: the basket
    # aggregation then needs no other shuffle and gathers nothing on the scan's side.
    # Without a count, so adaptive execution sizes the partitions.
    baskets = (
        lineitem.join(part, lineitem.l_partkey == part.p_partkey)
        .select("l_orderkey", item.alias("item"))
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(F.array_join(F.sort_array(F.collect_list("item")), ", ").alias("basket_items"))
    )
    # The customer is looked up first, so that no basket is shuffled for it.
    # nation has 25 rows by definition of the schema: a bounded broadcast.
    buyers = customer.join(F.broadcast(nation), F.col("c_nationkey") == nation.n_nationkey).select("c_custkey", "c_name", "n_name")
    bought = orders.join(buyers, orders.o_custkey == buyers.c_custkey)
    card = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (
        bought.join(baskets, bought.o_orderkey == baskets.l_orderkey, "left")
        .select(
            "o_orderkey",
            F.col("o_orderdate").alias("timestamp"),
            F.col("n_name").alias("store_name"),
            F.col("c_name").alias("customer_name"),
            "basket_items",
            F.col("o_totalprice").alias("total_price"),
            F.when(card, F.lit("CARD")).otherwise(F.lit("CASH")).alias("payment_type"),
            F.when(card, F.concat(F.lit("5494"), F.lpad(F.col("o_custkey").cast("string"), 12, "0"))).alias(
                "card_number"
            ),
        )
    )


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven raw receipt columns, typed (``schemas.RAW_TYPED``)."""
    return receipts_keyed(spark, sf_dir).drop("o_orderkey")


def receipts_doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every receipt twice in one file: dedup and within-file quantities."""
    r = receipts(spark, sf_dir)
    return r.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")


def two_files(spark: SparkSession, sf_dir: str, written: DataFrame | None = None) -> DataFrame:
    """Receipts cut into two overlapping files, with ``file_path``/``file_time``.

    File A holds receipts before 1999; file B holds receipts from 1997, and its
    1997-1998 receipts appear twice in it. Those keys exist from file A already,
    so A's quantity must win (T13), while B's doubled rows would add (T12).
    ``written``: the receipts, where they have been made before.
    """
    r = receipts(spark, sf_dir) if written is None else written
    ts = F.col("timestamp")
    in_a = ts < F.lit(FILE_A_BEFORE).cast("timestamp_ntz")
    in_b = ts >= F.lit(FILE_B_FROM).cast("timestamp_ntz")
    twice_in_b = in_b & (ts < F.lit(FILE_B_TWICE_BEFORE).cast("timestamp_ntz"))
    a = F.struct(F.lit("receipts/file_a.csv").alias("file_path"), F.lit("2022-02-16 09:00:00").cast("timestamp_ntz").alias("file_time"))
    b = F.struct(F.lit("receipts/file_b.csv").alias("file_path"), F.lit("2022-02-17 09:00:00").cast("timestamp_ntz").alias("file_time"))
    # One pass over the receipts: each row is tagged with the file copies it
    # belongs to (at most three), then exploded.
    copies = F.array_compact(F.array(F.when(in_a, a), F.when(in_b, b), F.when(twice_in_b, b)))
    return r.select("*", F.explode(copies).alias("f")).select(*r.columns, "f.file_path", "f.file_time")


#: Kind of seeded receipt by order key modulo seven; the others are sound.
BAD_TOTAL, NO_TIME, DAY_FIRST, EXTRA_FIELD, BAD_ITEMS, KINDS = 0, 1, 2, 3, 4, 7
#: Items that form no product.
BAD_BASKET = "Large Tea - abc, Small Tea, Mocha - 2.3"


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The receipts as lines of a file (column value), five in seven with a fault a load must turn away and report."""
    kind = F.col("o_orderkey") % KINDS
    iso = F.col("timestamp").cast("string")
    day_first = F.concat(iso.substr(9, 2), F.lit("/"), iso.substr(6, 2), F.lit("/"), iso.substr(1, 4), F.lit(" 09:00"))
    basket = F.when(kind == BAD_ITEMS, F.concat_ws(", ", "basket_items", F.lit(BAD_BASKET))).otherwise(F.coalesce("basket_items", F.lit("")))
    fields = [
        F.when(kind == NO_TIME, "").when(kind == DAY_FIRST, day_first).otherwise(iso),
        F.col("store_name"),
        F.col("customer_name"),
        F.concat(F.lit('"'), basket, F.lit('"')),
        F.when(kind == BAD_TOTAL, "abc").otherwise(F.col("total_price").cast("string")),
        F.col("payment_type"),
        F.concat(F.coalesce("card_number", F.lit("")), F.when(kind == EXTRA_FIELD, ",more").otherwise("")),
    ]
    return receipts_keyed(spark, sf_dir).select(F.concat_ws(",", *fields).alias("value"))


def file_of(df: DataFrame, path: str) -> DataFrame:
    return df.filter(F.col("file_path") == path).drop("file_path", "file_time")
