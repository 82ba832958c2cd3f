"""Basket splitting equals Python's split / rsplit semantics."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillflow.functions.basket import explode_basket, split_item_price, split_size_name


def _py_item(text):
    parts = text.rsplit(" - ", 1)
    item, price = (parts[0], parts[1]) if len(parts) == 2 else (parts[0], None)
    sp = item.split(" ", 1)
    size, name = (sp[0], sp[1]) if len(sp) == 2 else (sp[0], None)
    return item, price, size, name


def _spark_items(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, b string")
    item, price = split_item_price(F.col("b"))
    df = df.select("i", item.alias("item"), price.alias("price"))
    size, name = split_size_name(F.col("item"))
    out = df.select("i", "item", "price", size.alias("size"), name.alias("name")).orderBy("i").collect()
    return [(r.item, r.price, r.size, r.name) for r in out]


CASES = ["Large Tea - 1.5", "Regular Iced latte - Hazelnut - 2.75", "Large Tea", "Mocha - 2.3", " Tea - 1",
         "a - - b", "x - ", " - 3", "", "Large  Tea - 2.30", "Large Tea -2.3"]


def test_split_edge_cases(spark):
    assert _spark_items(spark, CASES) == [_py_item(t) for t in CASES]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab -.1")), max_size=12), min_size=1, max_size=20))
def test_split_matches_python(spark, texts):
    assert _spark_items(spark, texts) == [_py_item(t) for t in texts]


def test_explode_keeps_null_basket(spark):
    df = spark.createDataFrame([(1, "A x - 1, B y - 2"), (2, None), (3, "A x - 1, A x - 1")], "k int, basket_items string")
    got = sorted((r.k, r.basket_item) for r in explode_basket(df).collect())
    assert got == [(1, "A x - 1"), (1, "B y - 2"), (2, None), (3, "A x - 1"), (3, "A x - 1")]
