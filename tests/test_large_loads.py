"""Large loads move each receipt once; keys are shuffled as bytes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillflow.functions.hashing import packed, unpacked
from tillflow.operators import normalize as normalize_module, quality
from tillflow.operators.load import load_receipts
from tillflow.operators.normalize import by_order, clean, normalize, orders_products, orders_products_by_join, products, to_1nf
from tillflow.operators.processed import load_processed
from tillflow.schemas import DEAL, KEYS
from tillflow.sinks import tables as tables_module
from tillflow.sinks.csv import write_csv
from tillflow.sinks.tables import read_target

SCHEMA = (
    "timestamp timestamp_ntz, store_name string, customer_name string, basket_items string, total_price double, "
    "payment_type string, card_number string, file_path string, file_time timestamp"
)
TEA, MOCHA = "Large Tea - 1.5", "Large Mocha - 2.3"


def _row(day, basket, file="a", month=3, who="Jo"):
    at = None if day is None else dt.datetime(2021, month, day, 9)
    return (at, "Ayr", who, basket, 3.0, "CASH", None, file, dt.datetime(2022, 1, 1 if file == "a" else 2))


def _receipts(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [
    _row(1, f"{TEA}, {TEA}, {MOCHA}"), _row(1, f"{TEA}, {TEA}, {MOCHA}", "b"), _row(1, f"{TEA}, {TEA}, {MOCHA}", "b"),
    _row(2, MOCHA), _row(2, MOCHA), _row(3, None), _row(4, "Mocha - 2.3"), _row(None, TEA), _row(5, TEA, month=4),
    *[_row(1 + k % 28, f"{TEA}, {MOCHA}", month=6, who=f"Jo {k}") for k in range(40)],
]


def _stored(spark, base, table):
    return sorted(map(str, read_target(spark, base, table).collect()))


def test_packed_keys_are_told_apart(spark):
    texts = ["", "00", "0", "ab", "AB", "abc", "\x00", "\x01ab", "é", "ab" * 32, None, "zz"]
    t = spark.createDataFrame([(x,) for x in texts], "t string").select("t", packed(F.col("t")).alias("p"))
    rows = t.select("t", "p", unpacked(F.col("p")).alias("back")).collect()
    assert all(r.t == r.back for r in rows) and len({None if r.p is None else bytes(r.p) for r in rows}) == len(texts)
    assert {len(r.p) for r in rows if r.t == "ab" * 32} == {33}


@pytest.mark.parametrize("rows_per_file", [1_000_000, 7])
def test_large_and_small_loads_agree(spark, scratch, monkeypatch, rows_per_file):
    """Receipts of two files, without a time or a basket, loaded at once and again: both ways give the same tables."""
    small, large = scratch("targets"), scratch("targets")
    r = _receipts(spark, ROWS)
    load_receipts(r, small, spark)
    monkeypatch.setattr(tables_module, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(tables_module, "ROWS_PER_FILE", rows_per_file)
    added = load_receipts(r, large, spark)
    assert all(_stored(spark, small, t) == _stored(spark, large, t) for t in KEYS)
    assert added["orders_products"] == len(_stored(spark, large, "orders_products"))
    again = load_receipts(r.unionByName(_receipts(spark, [_row(9, TEA, "b")])), large, spark)
    assert again["orders_products"] == 1 and again["orders"] == 1 and again["products"] == 0
    quantities = read_target(spark, large, "orders_products").groupBy("quantity").count().collect()
    assert {q.quantity: q["count"] for q in quantities}[2] == 2  # two teas of the first file, the mocha of two equal receipts


def test_a_large_load_moves_no_link_row(spark, scratch, monkeypatch):
    """What is written is made in the task that receives the receipt: one exchange, of the receipts."""
    monkeypatch.setattr(tables_module, "BROADCAST_KEYS", 0)
    written = []
    append = tables_module._append
    monkeypatch.setattr(tables_module, "_append", lambda rows, base, table: written.append((table, rows)) or append(rows, base, table))
    base = scratch("targets")
    for _ in range(2):
        load_receipts(_receipts(spark, ROWS), base, spark)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a large target
    try:
        with tables_module._kept_in_place(spark):
            plans = [(t, rows._jdf.queryExecution().executedPlan().toString()) for t, rows in written]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    dated = [(t, plan.split("Initial Plan")[-1]) for t, plan in plans if t in ("orders", "orders_products")]
    assert [t for t, _ in dated] == ["orders", "orders_products"] * 2
    assert [plan.count("Exchange hashpartitioning") for _, plan in dated[:2]] == [1, 1]
    # the second load compares with the target: its keys move too, and nothing else
    assert [plan.count("Exchange hashpartitioning") for _, plan in dated[2:]] == [2, 2]


def test_links_of_dealt_receipts(spark):
    cleaned = clean(_receipts(spark, ROWS).drop("file_path", "file_time"))
    direct = orders_products(to_1nf(cleaned))
    dealt = to_1nf(by_order(cleaned))
    found = orders_products(dealt).drop(DEAL)
    assert sorted(map(str, found.collect())) == sorted(map(str, direct.collect()))
    joined = orders_products_by_join(dealt, products(to_1nf(cleaned)))
    assert sorted(map(str, joined.collect())) == sorted(map(str, direct.collect()))
    n = normalize(_receipts(spark, ROWS).drop("file_path", "file_time"))
    assert n.orders_products._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") == 1


def test_checks_of_texts_that_are_no_hex(spark):
    link = spark.createDataFrame([("AB", "p", 1), ("ab", "p", 1), ("ab", "p", 2), (None, "p", 1)], "order_id string, product_id string, quantity int")
    assert quality.dq_unique({"orders_products": link}).first()[1:] == (4, 1)
    items = spark.createDataFrame([("AB", "p"), (None, "p")], "order_id string, product_id string")
    assert tuple(quality.dq_quantity(items, link).first()) == (5, 4)


def test_no_rejects_leave_no_table(spark, scratch):
    base = scratch("targets")
    assert load_receipts(_receipts(spark, [_row(1, TEA)]), base, spark)["item_rejects"] == 0
    assert not tables_module._exists(spark, f"{base}/item_rejects")
    bad = _receipts(spark, [_row(1, "Tea"), _row(1, "Tea")])
    assert load_receipts(bad, base, spark)["item_rejects"] == 1 and load_receipts(bad, base, spark)["item_rejects"] == 0
    assert read_target(spark, base, "item_rejects").first().n == 2


def test_kept_tables_have_no_more_parts_than_they_need(spark):
    """What a load persists is not left in one part per shuffle partition."""
    few = spark.range(1000).select((F.col("id") % 7).alias("k")).distinct()
    kept = tables_module._kept(few)
    assert kept.count() == 7 and kept.rdd.getNumPartitions() == 1
    kept.unpersist()


def test_a_large_load_sorts_by_columns(spark, scratch, monkeypatch):
    """The join with the target sorts by packed keys that were worked out once, not by expressions over them."""
    monkeypatch.setattr(tables_module, "BROADCAST_KEYS", 0)
    written = []
    append = tables_module._append
    monkeypatch.setattr(tables_module, "_append", lambda rows, base, table: written.append((table, rows)) or append(rows, base, table))
    base = scratch("targets")
    for _ in range(2):
        load_receipts(_receipts(spark, ROWS), base, spark)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a large target
    try:
        with tables_module._kept_in_place(spark):
            plans = [rows._jdf.queryExecution().executedPlan().toString() for t, rows in written[-2:] if t in ("orders", "orders_products")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    sorts = [line for plan in plans for line in plan.splitlines() if "Sort [" in line]
    assert sorts and not any("unhex" in line for line in sorts)


def test_ids_are_looked_up_without_moving_links(spark, scratch, monkeypatch):
    """A small product table goes to the items; with a large one only rows of shared or missing ids are summed again."""
    cleaned = clean(_receipts(spark, ROWS).drop("file_path", "file_time"))
    items, direct = to_1nf(by_order(cleaned.select("order_id", "basket_items"))), orders_products(to_1nf(cleaned))
    products(to_1nf(cleaned)).write.parquet(path := scratch("products"))
    table = spark.read.parquet(path)
    small = orders_products_by_join(items, table)
    assert small._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
    one_id = table.select(F.lit("p").alias("product_id"), "item_name", "item_size", "item_price")
    some = table.where("item_name = 'Tea'")
    of = lambda t: sorted(map(str, orders_products_by_join(items, t).collect()))
    by_broadcast = [of(t) for t in (table, one_id, some)]
    monkeypatch.setattr(normalize_module, "BROADCAST_PRODUCTS", 0)
    assert [of(t) for t in (table, one_id, some)] == by_broadcast
    assert by_broadcast[0] == sorted(map(str, direct.collect()))
    assert len(by_broadcast[1]) == direct.select("order_id").distinct().count()  # all items of an order under one id


def test_a_large_processed_load_keeps_no_links(spark, scratch, monkeypatch):
    """Orders and links of processed files are made where they are written, not persisted; the tables are those of a small load."""
    out, small, large = scratch("processed"), scratch("targets"), scratch("targets")
    at = "order_id string, timestamp timestamp_ntz, store_id string, total_price double, payment_type string"
    day = lambda month: dt.datetime(2021, month, 3, 9)
    orders = [("a1", day(3), "s", 1.0, "CASH"), ("a1", day(4), "s", 1.0, "CASH"), ("a1", day(3), "r", 1.0, "CASH"), ("b2", day(4), "s", 2.0, "CARD"), ("XY", day(4), "s", 2.0, "CARD")]
    links = [("a1", "p", 2), ("a1", "p", 1), ("a1", "q", 1), ("b2", "p", 1), ("XY", "p", 1), ("none", "p", 1), ("none", "p", 1)]
    write_csv(spark.createDataFrame(orders, at), f"{out}/day.csv_orders.csv")
    write_csv(spark.createDataFrame(links, "order_id string, product_id string, quantity int"), f"{out}/day.csv_ordersproducts.csv")
    first = load_processed(spark, out, small)[0]
    monkeypatch.setattr(tables_module, "BROADCAST_KEYS", 0)
    written = []
    append = tables_module._append
    monkeypatch.setattr(tables_module, "_append", lambda rows, base, table: written.append((table, rows)) or append(rows, base, table))
    assert load_processed(spark, out, large)[0] == first == {"orders": 3, "orders_products": 5}
    assert all(_stored(spark, small, t) == _stored(spark, large, t) for t in first)
    for table, rows in written:
        assert "InMemoryTableScan" not in rows._jdf.queryExecution().executedPlan().toString(), table
    known = read_target(spark, large, "orders_products").where("order_month IS NOT NULL").count()
    assert known == 4 and load_processed(spark, out, large)[0] == load_processed(spark, out, small)[0]
    assert read_target(spark, large, "orders_products").where("order_month IS NOT NULL").count() == known
