"""Ids: SHA-256 and SHAKE-256 against hashlib."""

import hashlib

from pyspark.sql import functions as F

from tillflow.functions.hashing import SHA256, SHAKE256, sha256_hex, shake256_hex


def test_shake_and_sha_match_hashlib(spark):
    texts = ["", "Ayr", "2021-08-25 09:00:00AyrJo X", "ünïcødé", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", shake256_hex(F.col("t"), 8).alias("s8"), shake256_hex(F.col("t"), 5).alias("s5"),
                     sha256_hex(F.col("t")).alias("h")).orderBy("i").collect()
    for r, t in zip(rows, texts):
        if t is None:
            assert r.s8 is None and r.h is None
            continue
        assert r.s8 == hashlib.shake_256(t.encode()).hexdigest(8)
        assert r.s5 == hashlib.shake_256(t.encode()).hexdigest(5)
        assert r.h == hashlib.sha256(t.encode()).hexdigest()


def test_id_lengths(spark):
    df = spark.createDataFrame([("Ayr",)], "s string")
    r = df.select(SHAKE256.store_id("s").alias("a"), SHA256.store_id("s").alias("b")).first()
    assert len(r.a) == 10 and len(r.b) == 64


def test_order_text_has_no_separator(spark):
    """("1", "23") and ("12", "3") give the same text, so the same id."""
    import datetime as dt

    rows = [(dt.datetime(2021, 1, 1), "1", "23", None, 1.0, "CASH", None),
            (dt.datetime(2021, 1, 1), "12", "3", None, 1.0, "CASH", None)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, store_name string, customer_name string, basket_items string, total_price double, payment_type string, card_number string")
    ids = df.select(SHA256.order_id().alias("id")).collect()
    assert ids[0].id == ids[1].id
    expected = "2021-01-01 00:00:00" + "123" + "nan" + "1.0" + "CASH" + "nan"
    assert ids[0].id == hashlib.sha256(expected.encode()).hexdigest()
