"""File-name routing, output names and JSON fields."""

from pyspark.sql import functions as F

from tillflow.functions.jsonfields import arrival_event, event_fields, parse_object
from tillflow.functions.naming import flatten_key, logical_name, output_name, suffix_table, table_of_file


def test_route_name_to_table(spark):
    cases = [
        ("kiosk7.csv_stores.csv", "_stores", "stores"),
        ("north.pier.csv_ordersproducts.csv", "_ordersproducts", "orders_products"),
        ("kiosk7.csv_refunds.csv", "_refunds", None),
        ("kiosk7.csv", "", None),
        ("kiosk7", None, None),
    ]
    df = spark.createDataFrame(cases, "n string, suffix string, tbl string")
    got = df.select("suffix", "tbl", table_of_file(F.col("n")).alias("s"), suffix_table(table_of_file(F.col("n"))).alias("t")).collect()
    assert [(r.s, r.t) for r in got] == [(r.suffix, r.tbl) for r in got]


def test_output_name_flattens_path(spark):
    cases = [("till/kiosk7.csv", "tillkiosk7.csv"), ("a/b.c/d", "ab.cd"), ("plain.csv", "plain.csv"), ("", "")]
    df = spark.createDataFrame(cases, "k string, flat string")
    for r in df.select("flat", flatten_key(F.col("k")).alias("f"), output_name(F.col("k"), "orders_products").alias("o")).collect():
        assert r.f == r.flat and r.o == r.flat + "_ordersproducts.csv"


def test_logical_name(spark):
    cases = [("file:/x/a.csv_stores.csv/part-00003-9f-c000.csv", "a.csv_stores.csv"), ("file:/x/a.csv_stores.csv", "a.csv_stores.csv")]
    df = spark.createDataFrame(cases, "p string, n string")
    assert all(r.l == r.n for r in df.select("n", logical_name(F.col("p")).alias("l")).collect())


def test_arrival_event_round_trip(spark):
    df = spark.createDataFrame([("raw-bucket", "2022/2/16/x.csv")], "b string, k string")
    ev = df.select(arrival_event(F.col("b"), F.col("k")).alias("e"))
    b, k = event_fields(F.col("e"))
    r = ev.select(b.alias("b"), k.alias("k")).first()
    assert (r.b, r.k) == ("raw-bucket", "2022/2/16/x.csv")
    empty = spark.createDataFrame([('{"Records": []}',), ("not json",)], "e string")
    b, k = event_fields(F.col("e"))
    assert [tuple(x) for x in empty.select(b, k).collect()] == [(None, None), (None, None)]


def test_config_object_with_newlines(spark):
    text = '{\n  "host": "db.example",\n  "port": 5439,\n  "password": "test-only",\n  "user": "tester"\n}'
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(parse_object(F.col("t")).alias("c")).first().c
    assert (r.host, r.port, r.user) == ("db.example", 5439, "tester")
