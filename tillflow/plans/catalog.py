"""Every registered query: ``(spark, sf_dir) -> DataFrame``.

All read the driver tables (through ``fixtures``) in full, so their work grows
with the tables. Queries that exercise writers write under the shared
checkpoint folder (``session.scratch_path``) and read the result back.
"""

from __future__ import annotations

import functools
import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import fixtures
from tillflow.functions import basket as B
from tillflow.functions.hashing import SHA256, SHAKE256
from tillflow.functions.jsonfields import arrival_event, event_fields, parse_object
from tillflow.functions.naming import flatten_key, logical_name, output_name as output_name_of, suffix_table, table_of_file
from tillflow.functions.timeparse import DAY_FIRST_FORMATS, ISO_FORMATS, epoch_seconds, from_epoch_seconds, parse_ntz
from tillflow.operators import load, metrics, normalize as N, processed, profile, quality, upsert
from tillflow.operators.load import load_receipts
from tillflow.operators.rowindex import with_row_index
from tillflow.schemas import DEAL, KEYS, RAW_COLUMNS, TABLE_SUFFIX
from tillflow.session import file_system, scratch_path
from tillflow.sinks import csv as csv_sink
from tillflow.sinks.tables import append_rows, conform, land_raw, load_if_absent, read_target
from tillflow.sources import csv as csv_source
from tillflow.streaming import events as arrivals, ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return wrap


def _tables(n: N.Normalized) -> dict[str, DataFrame]:
    return {
        "stores": n.stores,
        "orders": n.orders,
        "products": conform(n.products, "products"),
        "orders_products": n.orders_products,
    }


def _written_receipts(spark, sf_dir) -> DataFrame:
    """The receipts, made once and written, for queries that go over them several times."""
    path = scratch_path(spark, "receipts")
    fixtures.receipts(spark, sf_dir).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _norm(spark, sf_dir, ids=SHA256) -> N.Normalized:
    return N.normalize(fixtures.receipts(spark, sf_dir), ids)


# --- composite outputs (N0-N4) -------------------------------------------------

@register("norm_1nf")
def norm_1nf(spark, sf_dir):
    return _norm(spark, sf_dir).items.select(
        "order_id", "timestamp", "store_name", "total_price", "payment_type",
        "basket_item", "item", "item_price", "item_size", "item_name",
    )


@register("norm_stores")
def norm_stores(spark, sf_dir):
    return _norm(spark, sf_dir).stores


@register("norm_orders")
def norm_orders(spark, sf_dir):
    return _norm(spark, sf_dir).orders


@register("norm_products")
def norm_products(spark, sf_dir):
    return conform(_norm(spark, sf_dir).products, "products")


@register("norm_orders_products")
def norm_orders_products(spark, sf_dir):
    return _norm(spark, sf_dir).orders_products


# --- ids, PII, projections, casts ---------------------------------------------

@register("row_hash_id")
def row_hash_id(spark, sf_dir):
    return N.with_order_id(fixtures.receipts(spark, sf_dir), SHA256)


@register("row_hash_shake")
def row_hash_shake(spark, sf_dir):
    return N.with_order_id(fixtures.receipts(spark, sf_dir), SHAKE256)


@register("pii_drop")
def pii_drop(spark, sf_dir):
    return N.clean(fixtures.receipts(spark, sf_dir))


@register("pii_hash")
def pii_hash(spark, sf_dir):
    hashed = N.hash_pii(N.with_order_id(fixtures.receipts(spark, sf_dir)))
    return hashed.select("order_id", "customer_name", "card_number")


@register("project_rename_all")
def project_rename_all(spark, sf_dir):
    positional = fixtures.receipts(spark, sf_dir).toDF(*[f"_c{i}" for i in range(len(RAW_COLUMNS))])
    return positional.toDF(*RAW_COLUMNS)


@register("project_drop")
def project_drop(spark, sf_dir):
    items = _norm(spark, sf_dir).items
    return items.drop("timestamp", "store_name", "basket_items", "total_price", "payment_type", "item", "basket_item")


def _order_date_texts(spark, sf_dir) -> DataFrame:
    o = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    iso = F.col("o_orderdate").cast("string")
    day_first = F.concat(
        iso.substr(9, 2), F.lit("/"), iso.substr(6, 2), F.lit("/"), iso.substr(1, 4), F.lit(" "), iso.substr(12, 5)
    )
    text = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), iso).otherwise(day_first)
    return o.select("o_orderkey", text.alias("ts_text"))


@register("parse_timestamp")
def parse_timestamp(spark, sf_dir):
    t = _order_date_texts(spark, sf_dir)
    return t.select("o_orderkey", "ts_text", parse_ntz(F.col("ts_text"), ISO_FORMATS + DAY_FIRST_FORMATS).alias("timestamp"))


@register("epoch_convert")
def epoch_convert(spark, sf_dir):
    e = fixtures.table(spark, sf_dir, "events").select("event_id", "ts")
    secs = epoch_seconds(F.col("ts"))
    return e.select("event_id", secs.alias("epoch_s"), from_epoch_seconds(secs).alias("ts_second"))


# --- basket functions (C1-C4) -------------------------------------------------

def _cleaned(spark, sf_dir):
    return N.clean(fixtures.receipts(spark, sf_dir))


@register("split_basket")
def split_basket(spark, sf_dir):
    arr = B.split_basket(F.col("basket_items"))
    return _cleaned(spark, sf_dir).select(
        "order_id", F.coalesce(F.size(arr), F.lit(0)).cast("bigint").alias("n_items"), F.get(arr, 0).alias("first_item"),
        F.get(arr, F.size(arr) - 1).alias("last_item"),
    )


@register("explode_basket")
def explode_basket(spark, sf_dir):
    return B.explode_basket(_cleaned(spark, sf_dir)).select("order_id", "basket_item")


@register("split_item_price")
def split_item_price(spark, sf_dir):
    ex = B.explode_basket(_cleaned(spark, sf_dir))
    item, price = B.split_item_price(F.col("basket_item"))
    return ex.select("order_id", item.alias("item"), price.alias("item_price"))


@register("split_size_name")
def split_size_name(spark, sf_dir):
    ex = B.explode_basket(_cleaned(spark, sf_dir))
    item, _ = B.split_item_price(F.col("basket_item"))
    size, name = B.split_size_name(item)
    return ex.select("order_id", size.alias("item_size"), name.alias("item_name"))


# --- joins (J1-J4) ------------------------------------------------------------

@register("join_store_id")
def join_store_id(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir)
    return N.orders_by_join(cleaned, N.stores(cleaned))


@register("join_product_id")
def join_product_id(spark, sf_dir):
    cleaned = N.clean(_written_receipts(spark, sf_dir))
    items = N.to_1nf(N.by_order(cleaned.select("order_id", "basket_items")))
    path = scratch_path(spark, "products")
    N.products(N.to_1nf(cleaned)).write.option("compression", "zstd").parquet(path)
    return N.orders_products_by_join(items, spark.read.parquet(path))


# The two overlapping lineitem "loads" of the anti-join checks.
TARGET_SHIPPED_BEFORE = "1997-01-01 00:00:00"
STAGING_SHIPPED_FROM = "1996-01-01 00:00:00"


def _shipped(li, before=None, since=None):
    d = F.col("l_shipdate")
    if before:
        li = li.filter(d < F.lit(before).cast("timestamp_ntz"))
    if since:
        li = li.filter(d >= F.lit(since).cast("timestamp_ntz"))
    return li


@register("anti_join_single")
def anti_join_single(spark, sf_dir):
    o = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    li = _shipped(fixtures.table(spark, sf_dir, "lineitem"), before=TARGET_SHIPPED_BEFORE)
    target = li.select(F.col("l_orderkey").alias("o_orderkey"))
    return upsert.anti_join(o, target, ["o_orderkey"])


@register("anti_join_composite")
def anti_join_composite(spark, sf_dir):
    li = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    staging = _shipped(li, since=STAGING_SHIPPED_FROM).select("l_orderkey", "l_partkey", "l_linenumber")
    target = _shipped(li, before=TARGET_SHIPPED_BEFORE).select("l_orderkey", "l_partkey")
    return upsert.anti_join(staging, target, ["l_orderkey", "l_partkey"])


@register("distinct_keys")
def distinct_keys(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").distinct()


@register("distinct_values")
def distinct_values(spark, sf_dir):
    return fixtures.receipts(spark, sf_dir).select("store_name").distinct()


# --- dedup and aggregation on a file with every receipt twice (A1-A3, T12) ------

def _doubled(spark, sf_dir) -> N.Normalized:
    return N.normalize(fixtures.receipts_doubled(spark, sf_dir))


@register("dedup_stores")
def dedup_stores(spark, sf_dir):
    return _doubled(spark, sf_dir).stores


@register("dedup_orders")
def dedup_orders(spark, sf_dir):
    return _doubled(spark, sf_dir).orders


@register("dedup_products")
def dedup_products(spark, sf_dir):
    return conform(_doubled(spark, sf_dir).products, "products")


@register("agg_quantity")
def agg_quantity(spark, sf_dir):
    return _doubled(spark, sf_dir).orders_products


@register("qty_profile")
def qty_profile(spark, sf_dir):
    return profile.qty_profile(_norm(spark, sf_dir).orders_products)


@register("row_counts")
def row_counts(spark, sf_dir):
    return profile.row_counts(fixtures.receipts(spark, sf_dir))


# --- loads over two overlapping files (K2, K4, K5, W1, T13) -------------------

FILES = ("receipts/file_a.csv", "receipts/file_b.csv")


def _file(spark, sf_dir, path, written=None) -> N.Normalized:
    return N.normalize(fixtures.file_of(fixtures.two_files(spark, sf_dir, written), path))


def _upsert(spark, sf_dir, table):
    """The table after file A and then file B have been loaded into a target."""
    base, written = scratch_path(spark, "targets"), _written_receipts(spark, sf_dir)
    for path in FILES:
        load_if_absent({table: _file(spark, sf_dir, path, written).staged(table)}, base, spark)
    return ingest.target(spark, base, table)


@register("upsert_stores")
def upsert_stores(spark, sf_dir):
    return _upsert(spark, sf_dir, "stores")


@register("upsert_products")
def upsert_products(spark, sf_dir):
    return _upsert(spark, sf_dir, "products")


@register("upsert_orders")
def upsert_orders(spark, sf_dir):
    return _upsert(spark, sf_dir, "orders")


@register("upsert_orders_products")
def upsert_orders_products(spark, sf_dir):
    return _upsert(spark, sf_dir, "orders_products")


@register("sink_append")
def sink_append(spark, sf_dir):
    base = scratch_path(spark, "targets")
    for path in FILES:
        append_rows(_file(spark, sf_dir, path).dated("orders"), base, "orders")
    return ingest.target(spark, base, "orders")


@register("first_arrival_wins")
def first_arrival_wins(spark, sf_dir):
    files = fixtures.two_files(spark, sf_dir)
    cleaned = N.clean(files).select("order_id", "basket_items", "file_path", "file_time")
    return N.orders_products_by_file(N.to_1nf(N.by_order(cleaned))).drop("file_time", DEAL)


# --- CSV in and out, landing, row index, conformance (S1, S5, K1, K3, K6, K9) --

def _receipts_csv(spark, sf_dir, name="receipts") -> str:
    path = scratch_path(spark, name)
    csv_sink.write_csv(fixtures.receipts(spark, sf_dir), path)
    return path


@register("scan_receipts_csv")
def scan_receipts_csv(spark, sf_dir):
    path = _receipts_csv(spark, sf_dir)
    typed = csv_source.read_receipts(spark, path, lineage=False)
    return typed.filter(F.col("_reject").isNull()).select(*RAW_COLUMNS)


@register("staging_read_typed")
def staging_read_typed(spark, sf_dir):
    base = scratch_path(spark, "processed")
    paths = csv_sink.write_processed({"products": _norm(spark, sf_dir).products}, base, "receipts/all.csv")
    return csv_source.read_staging(spark, paths["products"], "products")


@register("sink_csv_roundtrip")
def sink_csv_roundtrip(spark, sf_dir):
    base = scratch_path(spark, "processed")
    paths = csv_sink.write_processed(_tables(N.normalize(_written_receipts(spark, sf_dir))), base, "receipts/all.csv")
    return csv_source.read_staging(spark, paths["orders"], "orders")


@register("load_processed")
def load_processed(spark, sf_dir):
    """Write the processed outputs, route and load them by name, and load them again."""
    base, targets = scratch_path(spark, "processed"), scratch_path(spark, "targets")
    csv_sink.write_processed(_tables(N.normalize(_written_receipts(spark, sf_dir))), base, "receipts/all.csv")
    for _ in range(2):
        processed.load_processed(spark, base, targets)
    return ingest.target(spark, targets, "orders_products")


@register("route_processed")
def route_processed(spark, sf_dir):
    """Rows of each processed output, by the name and table that its part files tell."""
    base = scratch_path(spark, "processed")
    csv_sink.write_processed(_tables(N.normalize(_written_receipts(spark, sf_dir))), base, "receipts/all.csv")
    name = logical_name(F.col("_metadata.file_path"))
    lines = spark.read.text(f"{base}/*").select(name.alias("file_name"))
    return lines.groupBy("file_name", suffix_table(table_of_file(F.col("file_name"))).alias("table_name")).agg(F.count("*").alias("n_rows"))


@register("raw_landing")
def raw_landing(spark, sf_dir):
    """Every line as it came; landing the same files again adds nothing."""
    src = _receipts_csv(spark, sf_dir)
    landing = scratch_path(spark, "landing")
    for _ in range(2):
        land_raw(spark, src, landing)
    return spark.read.parquet(landing).select("value")


def _faulty_load(spark, sf_dir) -> str:
    src, targets = scratch_path(spark, "faulty"), scratch_path(spark, "targets")
    fixtures.faulty_lines(spark, sf_dir).write.text(src)
    load_receipts(csv_source.read_receipts(spark, src), targets, spark)
    return targets


@register("reject_report")
def reject_report(spark, sf_dir):
    return load.reject_report(spark, _faulty_load(spark, sf_dir))


@register("item_rejects")
def item_rejects(spark, sf_dir):
    rejects = read_target(spark, _faulty_load(spark, sf_dir), "item_rejects")
    return rejects.groupBy("reason", "basket_item").agg(F.count_distinct("order_id").alias("n_orders"), F.sum("n").alias("n_items"))


@register("sink_row_index")
def sink_row_index(spark, sf_dir):
    o = _norm(spark, sf_dir).orders.select("order_id", "timestamp")
    return with_row_index(o, ["timestamp", "order_id"])


@register("conform_schema")
def conform_schema(spark, sf_dir):
    """Columns of the four conformed tables in order: type, comment and values that are not null."""
    out = []
    for name, df in _tables(_norm(spark, sf_dir)).items():
        fields = conform(df, name).schema.fields
        row = conform(df, name).agg(*[F.count(f.name).alias(f.name) for f in fields])
        entries = F.array(*[
            F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.lit(f.metadata.get("comment", "")).alias("comment"), F.col(f.name).alias("n_values"))
            for i, f in enumerate(fields)
        ])
        out.append(row.select(F.lit(name).alias("table_name"), F.explode(entries).alias("f")).select("table_name", "f.*"))
    return functools.reduce(DataFrame.unionByName, out)


# --- names, JSON (C8, K7, K8, S3, S4) -------------------------------------------

def _url_parts(spark, sf_dir):
    p = fixtures.table(spark, sf_dir, "pages").select("page_id", "url")
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1)
    key = F.regexp_extract("url", r"^[a-z]+://[^/?#]+/?([^?#]*)", 1)
    return p.select("page_id", "url", host.alias("bucket"), key.alias("object_key"))


@register("output_name")
def output_name(spark, sf_dir):
    names = F.array(*[F.struct(F.lit(t).alias("table_name"), output_name_of(F.col("object_key"), t).alias("output_name")) for t in TABLE_SUFFIX])
    return _url_parts(spark, sf_dir).select("page_id", F.inline(names))


@register("route_by_filename")
def route_by_filename(spark, sf_dir):
    p = _url_parts(spark, sf_dir)
    suffixes = F.array(*[F.lit(s + ".csv") for s in TABLE_SUFFIX.values()])
    exploded = p.select("page_id", "object_key", F.explode(suffixes).alias("suffix"))
    processed = exploded.select("page_id", F.concat(flatten_key(F.col("object_key")), F.lit(".csv"), F.col("suffix")).alias("file_name"))
    raw = p.select("page_id", F.col("url").alias("file_name"))
    names = processed.unionByName(raw)
    return names.select("page_id", "file_name", table_of_file(F.col("file_name")).alias("table_name"))


@register("json_event_fields")
def json_event_fields(spark, sf_dir):
    p = _url_parts(spark, sf_dir)
    events = p.select("page_id", arrival_event(F.col("bucket"), F.col("object_key")).alias("event"))
    bucket, key = event_fields(F.col("event"))
    return events.select("page_id", bucket.alias("bucket_name"), key.alias("object_key"), flatten_key(key).alias("file_name"))


@register("json_parse_struct")
def json_parse_struct(spark, sf_dir):
    from pyspark.sql import types as T

    e = fixtures.table(spark, sf_dir, "events").select("event_id", "props")
    parsed = parse_object(F.col("props"), T.StructType([T.StructField("k", T.IntegerType())]))
    return e.select("event_id", parsed["k"].alias("k"))


# --- run metrics (A8) -----------------------------------------------------------

@register("metrics_by_window")
def metrics_by_window(spark, sf_dir):
    return metrics.metrics_by_window(fixtures.table(spark, sf_dir, "events"))


@register("metrics_lookback")
def metrics_lookback(spark, sf_dir):
    return metrics.metrics_lookback(fixtures.table(spark, sf_dir, "events"))


# --- data quality, lookups, previews (Q1-Q5, F2, L1, L2) ------------------------
# The checks run on stored tables with seeded violations, each by the first
# characters of an id, so that every check has something to find.

def _starts(column, prefix):
    return F.col(column).startswith(prefix)


def _seeded(spark, n: N.Normalized, *names) -> dict[str, DataFrame]:
    faulty = {
        "stores": lambda: n.stores.where("store_name <> 'KENYA'"),
        "orders": lambda: n.orders.withColumn("copy", F.explode(F.when(_starts("order_id", "00"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .drop("copy")
        .withColumn("payment_type", F.when(_starts("order_id", "2b"), "VOUCHER").when(~_starts("order_id", "1a"), F.col("payment_type"))),
        "products": lambda: conform(n.products, "products")
        .where(~_starts("product_id", "0"))
        .withColumn("item_name", F.when(_starts("product_id", "2"), F.repeat("item_name", F.lit(50))).when(~_starts("product_id", "1"), F.col("item_name"))),
        "orders_products": lambda: n.orders_products.where(~_starts("order_id", "4d")).withColumn(
            "quantity", F.col("quantity") + F.when(_starts("order_id", "3c"), 1).otherwise(0)
        ),
    }
    base = scratch_path(spark, "stored")
    out = {}
    for name in names:
        faulty[name]().write.option("compression", "zstd").parquet(f"{base}/{name}")
        out[name] = spark.read.parquet(f"{base}/{name}")
    return out


@register("dq_unique")
def dq_unique(spark, sf_dir):
    return quality.dq_unique(_seeded(spark, N.normalize(_written_receipts(spark, sf_dir)), *KEYS))


@register("dq_foreign")
def dq_foreign(spark, sf_dir):
    return quality.dq_foreign(_seeded(spark, N.normalize(_written_receipts(spark, sf_dir)), *KEYS))


@register("dq_not_null")
def dq_not_null(spark, sf_dir):
    return quality.dq_not_null(_seeded(spark, N.normalize(_written_receipts(spark, sf_dir)), *KEYS))


@register("dq_length")
def dq_length(spark, sf_dir):
    return quality.dq_length(_seeded(spark, N.normalize(_written_receipts(spark, sf_dir)), *KEYS), SHA256)


@register("dq_quantity")
def dq_quantity(spark, sf_dir):
    """The stored link table against a recount of the receipts' item rows."""
    n = N.normalize(_written_receipts(spark, sf_dir))
    valid = N.valid_items(n.items).withColumn("product_id", SHA256.product_id())
    return quality.dq_quantity(valid, _seeded(spark, n, "orders_products")["orders_products"])


@register("lookup_by_key")
def lookup_by_key(spark, sf_dir):
    base = scratch_path(spark, "targets")
    load_receipts(fixtures.receipts(spark, sf_dir), base, spark)
    t = load.targets(spark, base)
    return profile.lookup_by_key(t["orders_products"], t["orders"], t["products"])


@register("preview_limit")
def preview_limit(spark, sf_dir):
    items = _norm(spark, sf_dir).items.select("order_id", "basket_item", "item_size", "item_name", "item_price")
    return profile.preview(items, ["order_id", "basket_item"], 10)


# --- streaming (S2, R1-R3) -------------------------------------------------------

def _stream_dirs(spark):
    return scratch_path(spark, "inbox"), scratch_path(spark, "targets"), scratch_path(spark, "stream-ckpt")


#: Receipts before this come in a file that was last written a month before the others.
LATE_BEFORE = "1993-01-01 00:00:00"
MONTH_MS = 30 * 24 * 3600 * 1000


def _age(spark, folder, by_ms):
    """Set the files of a folder back in time."""
    fs, p = file_system(spark, folder)
    for s in fs.listStatus(p):
        fs.setTimes(s.getPath(), s.getModificationTime() - by_ms, -1)


@register("stream_ingest")
def stream_ingest(spark, sf_dir):
    """Two arrivals; the files of the second are a month older than those of the first."""
    inbox, targets, ckpt = _stream_dirs(spark)
    late = F.col("timestamp") < F.lit(LATE_BEFORE).cast("timestamp_ntz")
    receipts = _written_receipts(spark, sf_dir)
    csv_sink.write_csv(receipts.where(~late), f"{inbox}/new")
    ingest.run_available(spark, f"{inbox}/*", targets, ckpt)
    csv_sink.write_csv(receipts.where(late), f"{inbox}/late")
    _age(spark, f"{inbox}/late", MONTH_MS)
    ingest.run_available(spark, f"{inbox}/*", targets, ckpt)
    return ingest.target(spark, targets, "orders_products")


@register("event_ingest")
def event_ingest(spark, sf_dir):
    """Loads that events start: one event for one file, then one event for two, the first file again among them."""
    store, events, targets, ckpt = (scratch_path(spark, n) for n in ("store", "events", "targets", "events-ckpt"))
    early = F.col("timestamp") < F.lit(LATE_BEFORE).cast("timestamp_ntz")
    receipts = _written_receipts(spark, sf_dir)
    for key, part in (("day 1.csv", ~early), ("day+2.csv", early)):
        csv_sink.write_csv(receipts.where(part), f"{store}/till/{key}")
    said = [["day+1.csv"], ["day%2B2.csv", "day+1.csv"]]  # keys as events spell them
    for k, keys in enumerate(said):
        records = [{"s3": {"bucket": {"name": "till"}, "object": {"key": key}}} for key in keys]
        spark.createDataFrame([(json.dumps({"Records": records}),)], "value string").write.text(f"{events}/{k}")
        arrivals.run_available(spark, f"{events}/*", store, targets, ckpt)
    return ingest.target(spark, targets, "orders_products")


def _write_file(spark, sf_dir, written, path, dest):
    files = fixtures.two_files(spark, sf_dir, written)
    csv_sink.write_csv(fixtures.file_of(files, path), dest)


@register("stream_upsert")
def stream_upsert(spark, sf_dir):
    inbox, targets, ckpt = _stream_dirs(spark)
    written = _written_receipts(spark, sf_dir)
    _write_file(spark, sf_dir, written, "receipts/file_a.csv", f"{inbox}/a")
    ingest.run_available(spark, f"{inbox}/*", targets, ckpt)
    _write_file(spark, sf_dir, written, "receipts/file_b.csv", f"{inbox}/b")
    ingest.run_available(spark, f"{inbox}/*", targets, ckpt)
    return ingest.target(spark, targets, "orders_products")


@register("stream_replay")
def stream_replay(spark, sf_dir):
    """Both files, then both again: the link rows, with the rows of each table beside them."""
    inbox, targets, ckpt = _stream_dirs(spark)
    written = _written_receipts(spark, sf_dir)
    for again in ("", "-again"):
        for path, name in zip(FILES, ("a", "b"), strict=True):
            _write_file(spark, sf_dir, written, path, f"{inbox}/{name}{again}")
            ingest.run_available(spark, f"{inbox}/*", targets, ckpt)
    counts = [ingest.target(spark, targets, t).agg(F.count("*")).scalar().alias(f"n_{t}") for t in KEYS]
    return ingest.target(spark, targets, "orders_products").select("order_id", "product_id", "quantity", *counts)
