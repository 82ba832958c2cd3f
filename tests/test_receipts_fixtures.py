"""Hand-made receipt files (FIXTURES.md section 1) through the CSV reader and
the normaliser: one test per trap T2-T14, T21."""

import datetime as dt
import hashlib
import os

from pyspark.sql import functions as F

from tillflow.functions.timeparse import DAY_FIRST_FORMATS, ISO_FORMATS
from tillflow.operators.normalize import normalize
from tillflow.sources.csv import read_receipts

PLAIN = '2021-08-25 09:00:00,Ayr,Jo X,"Large Tea - 1.5, Large Tea - 1.5",3.0,CASH,'
DASH = '2021-08-25 09:05:00,Ayr,Jo X,"Regular Iced latte - Hazelnut - 2.75",2.75,CARD,5494000000000001'
NO_PRICE = '2021-08-25 09:10:00,Ayr,Jo X,"Large Tea",1.5,CASH,'
ONE_WORD = '2021-08-25 09:15:00,Ayr,Jo X,"Mocha - 2.3",2.3,CASH,'
NULL_BASKET = "2021-08-25 09:20:00,Ayr,Jo X,,0.0,CASH,"
PRICES = '2021-08-25 09:25:00,Ayr,Jo X,"Large Tea - 2.3, Large Tea - 2.30",4.6,CASH,'
QUOTED = '2021-08-25 09:30:00,Ayr,"Jo ""X"" Y","Large Tea - 1.5",1.5,CASH,'
NULL_STORE = '2021-08-25 09:35:00,,Jo X,"Large Tea - 1.5",1.5,CASH,'


def _write(base, name, lines):
    path = base.replace("file:", "")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + ("\n" if lines else ""))
    return base


def _norm(spark, base, formats=ISO_FORMATS):
    typed = read_receipts(spark, base, formats)
    return typed, normalize(typed, by_file=True)


def test_file_semantics(spark, scratch):
    base = _write(scratch("fx"), "f1.csv", [PLAIN, PLAIN, DASH, NO_PRICE, ONE_WORD, NULL_BASKET, PRICES])
    typed, n = _norm(spark, base)
    assert typed.filter(F.col("_reject").isNotNull()).count() == 0
    orders = n.orders.collect()
    assert len(orders) == 6  # the identical row is one order (T12)
    link = {(r.order_id, r.product_id): r.quantity for r in n.orders_products.collect()}
    prods = {r.product_id: r for r in n.products.collect()}
    # Two items per row, the row twice in one file -> quantity 4
    by_name = {(p.item_size, p.item_name, p.item_price): pid for pid, p in prods.items()}
    tea15 = by_name[("Large", "Tea", "1.5")]
    assert sorted(q for (o, p), q in link.items() if p == tea15) == [4]
    # Last " - " splits the price; the name keeps its own dash
    assert ("Regular", "Iced latte - Hazelnut", "2.75") in by_name
    # No price, one word and null basket form no product and no link row
    assert all(p.item_name is not None and p.item_price is not None for p in prods.values())
    assert len(link) == 4  # tea 1.5 (x4), iced latte, tea 2.3, tea 2.30
    # Equal price, other text -> two products
    assert ("Large", "Tea", "2.3") in by_name and ("Large", "Tea", "2.30") in by_name
    # Null basket keeps its order
    assert any(r.total_price == 0.0 for r in orders)


def test_order_id_is_text_of_row(spark, scratch):
    """The id depends on the row only, card digits as written, midnight kept."""
    midnight = "2021-08-25 00:00:00,Ayr,Jo X,\"Large Tea - 1.5\",10.0,CARD,5494000000000001"
    base_mixed = _write(scratch("fx"), "mixed.csv", [midnight, NULL_BASKET])
    base_alone = _write(scratch("fx"), "alone.csv", [midnight])
    a = read_receipts(spark, base_mixed)
    b = read_receipts(spark, base_alone)
    from tillflow.operators.normalize import with_order_id

    ida = {r.order_id for r in with_order_id(a.drop("_reject", "_record", "file_path", "file_time")).collect()}
    idb = {r.order_id for r in with_order_id(b.drop("_reject", "_record", "file_path", "file_time")).collect()}
    text = "2021-08-25 00:00:00AyrJo XLarge Tea - 1.510.0CARD5494000000000001"
    expected = hashlib.sha256(text.encode()).hexdigest()
    assert expected in ida and idb == {expected}


def test_day_first_is_a_parameter(spark, scratch):
    line = '01/08/2021 09:00,Ayr,Jo X,"Large Tea - 1.5",1.5,CASH,'
    base = _write(scratch("fx"), "d.csv", [line])
    rejected = read_receipts(spark, base)
    assert rejected.first()._reject == "timestamp unparsed"
    parsed = read_receipts(spark, base, ISO_FORMATS + DAY_FIRST_FORMATS).first()
    assert parsed._reject is None and parsed.timestamp == dt.datetime(2021, 8, 1, 9, 0)


def test_doubled_quote_and_null_store(spark, scratch):
    base = _write(scratch("fx"), "q.csv", [QUOTED, NULL_STORE])
    typed, n = _norm(spark, base)
    names = {r.customer_name for r in typed.collect()}
    assert 'Jo "X" Y' in names  # T21
    stores = {r.store_name: r.store_id for r in n.stores.collect()}
    assert stores[None] == hashlib.sha256(b"nan").hexdigest()  # T2
    # The order of the null store carries that store id
    ids = {r.store_id for r in n.orders.collect()}
    assert stores[None] in ids and stores["Ayr"] in ids


def test_quoted_newline_with_multiline(spark, scratch):
    line = '2021-08-25 09:40:00,Ayr,"Jo\nX","Large Tea - 1.5",1.5,CASH,'
    base = _write(scratch("fx"), "m.csv", [line])
    rows = read_receipts(spark, base, multi_line=True).collect()
    assert len(rows) == 1 and rows[0].customer_name == "Jo\nX"


def test_empty_file(spark, scratch):
    base = _write(scratch("fx"), "empty.csv", [])
    typed, n = _norm(spark, base)
    assert typed.count() == 0 and n.orders_products.count() == 0 and n.stores.count() == 0


def test_second_file_adds_nothing(spark, scratch):
    """The same receipt in a later file does not add to its quantity."""
    base = scratch("fx")
    _write(base, "a.csv", [PLAIN])
    _write(base, "b.csv", [PLAIN, PLAIN])
    typed = read_receipts(spark, base)
    # file order by path here (equal modification seconds are possible)
    typed = typed.withColumn("file_time", F.lit(None).cast("timestamp"))
    n = normalize(typed, by_file=True)
    assert [r.quantity for r in n.orders_products.collect()] == [2]


def test_rejects_are_counted_not_loaded(spark, scratch):
    """Unusable rows get a reason and stay out of the tables; bad items are listed."""
    from tillflow.operators.normalize import rejected_items

    bad_total = '2021-08-25 09:45:00,Ayr,Jo X,"Large Tea - 1.5",abc,CASH,'
    no_time = ',Ayr,Jo X,"Large Tea - 1.5",1.5,CASH,'
    base = _write(scratch("fx"), "r.csv", [bad_total, no_time, PLAIN, NO_PRICE, ONE_WORD])
    typed, n = _norm(spark, base)
    reasons = sorted(r._reject for r in typed.filter(F.col("_reject").isNotNull()).collect())
    assert reasons == ["timestamp missing", "total not a number"]
    assert n.orders.count() == 3
    bad = sorted((r.item_size, r.item_name, r.item_price) for r in rejected_items(n.items).collect())
    assert bad == [("Large", "Tea", None), ("Mocha", None, "2.3")]
