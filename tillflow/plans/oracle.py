"""DuckDB SQL oracles, one per registered query that SQL can express.

They rebuild the receipts from the base tables independently of the Spark
code: item name, size and price come straight from ``part`` (not from parsing
basket text), and quantities are counted from ``lineitem`` rows. Only
``row_hash_shake`` has no oracle (DuckDB has no SHAKE-256); it is checked
against ``hashlib`` in the tests.
"""

from __future__ import annotations

_BASE = """
li_items AS (
  SELECT l.l_orderkey,
         p.p_brand AS item_size,
         p.p_name AS item_name,
         CAST(p.p_retailprice AS VARCHAR) AS item_price,
         p.p_brand || ' ' || p.p_name AS item,
         p.p_brand || ' ' || p.p_name || ' - ' || CAST(p.p_retailprice AS VARCHAR) AS basket_item
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
baskets AS (
  SELECT l_orderkey,
         string_agg(basket_item, ', ' ORDER BY basket_item) AS basket_items,
         count(*) AS n_items,
         min(basket_item) AS first_item,
         max(basket_item) AS last_item
  FROM li_items GROUP BY l_orderkey
),
receipts AS (
  SELECT o.o_orderkey,
         o.o_orderdate AS "timestamp",
         n.n_name AS store_name,
         c.c_name AS customer_name,
         b.basket_items,
         o.o_totalprice AS total_price,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'CARD' ELSE 'CASH' END AS payment_type,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH')
              THEN '5494' || lpad(CAST(o.o_custkey AS VARCHAR), 12, '0') END AS card_number
  FROM orders o
  LEFT JOIN baskets b ON o.o_orderkey = b.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
clean AS (
  SELECT *,
         sha256(CAST("timestamp" AS VARCHAR) || coalesce(store_name, 'nan') || coalesce(customer_name, 'nan')
                || coalesce(basket_items, 'nan') || CAST(total_price AS VARCHAR) || coalesce(payment_type, 'nan')
                || coalesce(card_number, 'nan')) AS order_id
  FROM receipts
),
items AS (
  SELECT c.order_id, c.o_orderkey, c."timestamp", c.store_name, c.total_price, c.payment_type,
         i.basket_item, i.item, i.item_price, i.item_size, i.item_name,
         sha256(i.item_name || i.item_size || i.item_price) AS product_id
  FROM clean c LEFT JOIN li_items i ON i.l_orderkey = c.o_orderkey
),
t_stores AS (SELECT DISTINCT sha256(store_name) AS store_id, store_name FROM clean),
t_orders AS (
  SELECT DISTINCT order_id, "timestamp", sha256(store_name) AS store_id, total_price, payment_type FROM clean
),
t_products AS (
  SELECT DISTINCT product_id, item_name, item_size, CAST(item_price AS DOUBLE) AS item_price FROM items
  WHERE item_name IS NOT NULL
),
t_orders_products AS (
  SELECT order_id, product_id, CAST(count(*) AS INTEGER) AS quantity FROM items
  WHERE item_name IS NOT NULL GROUP BY order_id, product_id
)
"""


# The stored tables that the checks run on: rows and values broken by the first characters of an id.
_SEEDED = """
s_stores AS (SELECT * FROM t_stores WHERE store_name <> 'KENYA'),
s_orders AS (
  SELECT order_id, "timestamp", store_id, total_price,
         CASE WHEN order_id LIKE '2b%' THEN 'VOUCHER' WHEN order_id NOT LIKE '1a%' THEN payment_type END AS payment_type
  FROM (SELECT * FROM t_orders UNION ALL SELECT * FROM t_orders WHERE order_id LIKE '00%')
),
s_products AS (
  SELECT product_id, CASE WHEN product_id LIKE '2%' THEN repeat(item_name, 50) WHEN product_id NOT LIKE '1%' THEN item_name END AS item_name,
         item_size, item_price
  FROM t_products WHERE product_id NOT LIKE '0%'
),
s_orders_products AS (
  SELECT order_id, product_id, CAST(quantity + CASE WHEN order_id LIKE '3c%' THEN 1 ELSE 0 END AS INTEGER) AS quantity
  FROM t_orders_products WHERE order_id NOT LIKE '4d%'
)
"""


def _q(select: str, extra: str = "") -> str:
    ctes = _BASE + "," + _SEEDED + (("," + extra) if extra else "")
    return "WITH " + ctes.strip() + "\n" + select.strip()


FILE_A = "\"timestamp\" < TIMESTAMP '1999-01-01 00:00:00'"
FILE_B = "\"timestamp\" >= TIMESTAMP '1997-01-01 00:00:00'"

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["norm_1nf"] = _q(
    "SELECT order_id, \"timestamp\", store_name, total_price, payment_type, basket_item, item, item_price, item_size, item_name FROM items"
)
ORACLE_SQL["norm_stores"] = _q("SELECT * FROM t_stores")
ORACLE_SQL["norm_orders"] = _q("SELECT * FROM t_orders")
ORACLE_SQL["norm_products"] = _q("SELECT * FROM t_products")
ORACLE_SQL["norm_orders_products"] = _q("SELECT * FROM t_orders_products")

ORACLE_SQL["row_hash_id"] = _q(
    "SELECT \"timestamp\", store_name, customer_name, basket_items, total_price, payment_type, card_number, order_id FROM clean"
)
ORACLE_SQL["pii_drop"] = _q("SELECT \"timestamp\", store_name, basket_items, total_price, payment_type, order_id FROM clean")
ORACLE_SQL["pii_hash"] = _q(
    "SELECT order_id, sha256(coalesce(customer_name, 'nan')) AS customer_name, sha256(coalesce(card_number, 'nan')) AS card_number FROM clean"
)
ORACLE_SQL["project_rename_all"] = _q(
    "SELECT \"timestamp\", store_name, customer_name, basket_items, total_price, payment_type, card_number FROM receipts"
)
ORACLE_SQL["project_drop"] = _q("SELECT order_id, item_price, item_size, item_name FROM items")

ORACLE_SQL["parse_timestamp"] = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(o_orderdate, '%d/%m/%Y %H:%M') END AS ts_text,
       o_orderdate AS "timestamp"
FROM orders
"""
ORACLE_SQL["epoch_convert"] = """
SELECT event_id,
       CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch_s,
       date_trunc('second', ts) AS ts_second
FROM events
"""

ORACLE_SQL["split_basket"] = _q(
    "SELECT c.order_id, coalesce(b.n_items, 0) AS n_items, b.first_item, b.last_item FROM clean c LEFT JOIN baskets b ON b.l_orderkey = c.o_orderkey"
)
ORACLE_SQL["explode_basket"] = _q("SELECT order_id, basket_item FROM items")
ORACLE_SQL["split_item_price"] = _q("SELECT order_id, item, item_price FROM items")
ORACLE_SQL["split_size_name"] = _q("SELECT order_id, item_size, item_name FROM items")

ORACLE_SQL["join_store_id"] = ORACLE_SQL["norm_orders"]
ORACLE_SQL["join_product_id"] = ORACLE_SQL["norm_orders_products"]

ORACLE_SQL["anti_join_single"] = """
SELECT o.o_orderkey, o.o_orderdate FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l
                  WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate < TIMESTAMP '1997-01-01 00:00:00')
"""
ORACLE_SQL["anti_join_composite"] = """
SELECT s.l_orderkey, s.l_partkey, s.l_linenumber FROM lineitem s
WHERE s.l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'
  AND NOT EXISTS (SELECT 1 FROM lineitem t
                  WHERE t.l_orderkey = s.l_orderkey AND t.l_partkey = s.l_partkey
                    AND t.l_shipdate < TIMESTAMP '1997-01-01 00:00:00')
"""
ORACLE_SQL["distinct_keys"] = "SELECT DISTINCT l_orderkey, l_partkey FROM lineitem"
ORACLE_SQL["distinct_values"] = _q("SELECT DISTINCT store_name FROM receipts")

ORACLE_SQL["dedup_stores"] = ORACLE_SQL["norm_stores"]
ORACLE_SQL["dedup_orders"] = ORACLE_SQL["norm_orders"]
ORACLE_SQL["dedup_products"] = ORACLE_SQL["norm_products"]
ORACLE_SQL["agg_quantity"] = _q("SELECT order_id, product_id, CAST(2 * quantity AS INTEGER) AS quantity FROM t_orders_products")
ORACLE_SQL["qty_profile"] = _q(
    "SELECT count(*) FILTER (WHERE quantity > 0) AS n_gt0, count(*) FILTER (WHERE quantity > 1) AS n_gt1, "
    "count(*) FILTER (WHERE quantity > 2) AS n_gt2 FROM t_orders_products"
)
ORACLE_SQL["row_counts"] = _q("SELECT (SELECT count(*) FROM receipts) AS n_receipts, (SELECT count(*) FROM items) AS n_items")

# Loads over the two overlapping files: A's keys stay, B adds only new keys, so
# every receipt's rows appear once with its own (file-internal) quantity.
ORACLE_SQL["upsert_stores"] = ORACLE_SQL["norm_stores"]
ORACLE_SQL["upsert_products"] = ORACLE_SQL["norm_products"]
ORACLE_SQL["upsert_orders"] = ORACLE_SQL["norm_orders"]
ORACLE_SQL["upsert_orders_products"] = ORACLE_SQL["norm_orders_products"]
ORACLE_SQL["sink_append"] = _q(
    f"SELECT * FROM t_orders WHERE {FILE_A} UNION ALL SELECT * FROM t_orders WHERE {FILE_B}"
)
ORACLE_SQL["first_arrival_wins"] = _q(
    "SELECT op.order_id, op.product_id, op.quantity, "
    f"CASE WHEN o.{FILE_A} THEN 'receipts/file_a.csv' ELSE 'receipts/file_b.csv' END AS file_path "
    "FROM t_orders_products op JOIN t_orders o ON o.order_id = op.order_id"
)

ORACLE_SQL["scan_receipts_csv"] = ORACLE_SQL["project_rename_all"]
ORACLE_SQL["staging_read_typed"] = ORACLE_SQL["norm_products"]
ORACLE_SQL["sink_csv_roundtrip"] = ORACLE_SQL["norm_orders"]
ORACLE_SQL["load_processed"] = ORACLE_SQL["norm_orders_products"]
ORACLE_SQL["route_processed"] = _q(
    "\nUNION ALL ".join(
        f"SELECT 'receiptsall.csv{s}.csv' AS file_name, '{t}' AS table_name, count(*) AS n_rows FROM t_{t}"
        for t, s in (("stores", "_stores"), ("orders", "_orders"), ("products", "_products"), ("orders_products", "_ordersproducts"))
    )
)
ORACLE_SQL["raw_landing"] = _q(
    """
SELECT concat_ws(',', CAST("timestamp" AS VARCHAR), store_name, customer_name,
       CASE WHEN basket_items LIKE '%,%' THEN '"' || basket_items || '"' ELSE coalesce(basket_items, '') END,
       CAST(total_price AS VARCHAR), payment_type, coalesce(card_number, '')) AS value
FROM receipts
"""
)
ORACLE_SQL["reject_report"] = _q(
    """
SELECT 'receipt_rejects' AS kind,
       CASE o_orderkey % 7 WHEN 0 THEN 'total not a number' WHEN 1 THEN 'timestamp missing'
            WHEN 2 THEN 'timestamp unparsed' ELSE 'wrong number of fields' END AS reason, count(*) AS n
FROM receipts WHERE o_orderkey % 7 < 4 GROUP BY ALL
UNION ALL
SELECT 'item_rejects', unnest(['price not a number', 'no price', 'no size and name']), count(*)
FROM receipts WHERE o_orderkey % 7 = 4 HAVING count(*) > 0
"""
)
ORACLE_SQL["item_rejects"] = _q(
    """
SELECT r.reason, r.basket_item, count(*) AS n_orders, count(*) AS n_items
FROM receipts, (VALUES ('price not a number', 'Large Tea - abc'), ('no price', 'Small Tea'), ('no size and name', 'Mocha - 2.3')) r(reason, basket_item)
WHERE o_orderkey % 7 = 4 GROUP BY ALL
"""
)
ORACLE_SQL["sink_row_index"] = _q(
    "SELECT row_number() OVER (ORDER BY \"timestamp\", order_id) - 1 AS row_index, order_id, \"timestamp\" FROM t_orders"
)
_COLUMNS = [
    ("stores", "store_id", "string", "content hash of the store name"),
    ("stores", "store_name", "string", ""),
    ("orders", "order_id", "string", "content hash of the whole raw receipt row"),
    ("orders", "timestamp", "timestamp_ntz", "receipt time, no zone"),
    ("orders", "store_id", "string", ""),
    ("orders", "total_price", "double", ""),
    ("orders", "payment_type", "string", ""),
    ("products", "product_id", "string", "content hash of name, size and price text"),
    ("products", "item_name", "string", ""),
    ("products", "item_size", "string", ""),
    ("products", "item_price", "double", ""),
    ("orders_products", "order_id", "string", ""),
    ("orders_products", "product_id", "string", ""),
    ("orders_products", "quantity", "int", "number of items per order and product"),
]
ORACLE_SQL["conform_schema"] = _q(
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, {[c for u, c, _, _ in _COLUMNS if u == t].index(c)} AS position, '{c}' AS column_name, "
        f"'{d}' AS data_type, '{m}' AS comment, count(\"{c}\") AS n_values FROM t_{t}"
        for t, c, d, m in _COLUMNS
    )
)

_URL_PARTS = """
WITH parts AS (
  SELECT page_id, url,
         regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS bucket,
         regexp_extract(url, '^[a-z]+://[^/?#]+/?([^?#]*)', 1) AS object_key
  FROM pages
),
suffixes(table_name, suffix) AS (
  VALUES ('stores', '_stores'), ('orders', '_orders'), ('products', '_products'), ('orders_products', '_ordersproducts')
)
"""
ORACLE_SQL["output_name"] = _URL_PARTS + """
SELECT p.page_id, s.table_name, replace(p.object_key, '/', '') || s.suffix || '.csv' AS output_name
FROM parts p, suffixes s
"""
ORACLE_SQL["route_by_filename"] = _URL_PARTS + """
, names AS (
  SELECT p.page_id, replace(p.object_key, '/', '') || '.csv' || s.suffix || '.csv' AS file_name FROM parts p, suffixes s
  UNION ALL
  SELECT page_id, url AS file_name FROM parts
)
SELECT page_id, file_name, string_split(replace(file_name, '.csv', ','), ',')[2] AS table_name FROM names
"""
ORACLE_SQL["json_event_fields"] = _URL_PARTS + """
SELECT page_id, bucket AS bucket_name, object_key, replace(object_key, '/', '') AS file_name FROM parts
"""
ORACLE_SQL["json_parse_struct"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"

ORACLE_SQL["metrics_by_window"] = """
SELECT date_trunc('hour', ts) AS window_start, event_type AS function_name,
       count(*) AS invocations,
       count(*) FILTER (WHERE event_type = 'error') AS errors,
       CAST(sum(CAST(value AS DECIMAL(30, 8))) AS DOUBLE) / count(*) AS dur_avg,
       CAST(sum(CAST(value AS DECIMAL(30, 8))) AS DOUBLE) AS dur_sum,
       min(value) AS dur_min,
       max(value) AS dur_max
FROM events GROUP BY 1, 2
"""
ORACLE_SQL["metrics_lookback"] = """
WITH h(horizon, hours) AS (VALUES ('24h', 24), ('2d', 48), ('7d', 168)),
latest AS (SELECT max(ts) AS m FROM events)
SELECT h.horizon, e.event_type AS function_name,
       count(*) AS invocations,
       count(*) FILTER (WHERE e.event_type = 'error') AS errors,
       CAST(sum(CAST(e.value AS DECIMAL(30, 8))) AS DOUBLE) / count(*) AS dur_avg,
       CAST(sum(CAST(e.value AS DECIMAL(30, 8))) AS DOUBLE) AS dur_sum,
       min(e.value) AS dur_min,
       max(e.value) AS dur_max
FROM events e, h, latest
WHERE e.ts > latest.m - h.hours * INTERVAL 1 HOUR
GROUP BY 1, 2
"""

ORACLE_SQL["dq_unique"] = _q(
    """
SELECT 'stores' AS table_name, (SELECT count(*) FROM s_stores) AS n_rows,
       (SELECT count(*) FROM (SELECT store_id FROM s_stores GROUP BY 1 HAVING count(*) > 1)) AS n_dup_keys
UNION ALL SELECT 'orders', (SELECT count(*) FROM s_orders),
       (SELECT count(*) FROM (SELECT order_id FROM s_orders GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'products', (SELECT count(*) FROM s_products),
       (SELECT count(*) FROM (SELECT product_id FROM s_products GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'orders_products', (SELECT count(*) FROM s_orders_products),
       (SELECT count(*) FROM (SELECT order_id, product_id FROM s_orders_products GROUP BY 1, 2 HAVING count(*) > 1))
"""
)
ORACLE_SQL["dq_foreign"] = _q(
    """
SELECT 'orders' AS child_table, 'stores' AS parent_table,
       (SELECT count(*) FROM s_orders o WHERE NOT EXISTS (SELECT 1 FROM s_stores s WHERE s.store_id = o.store_id)) AS n_orphans
UNION ALL SELECT 'orders_products', 'orders',
       (SELECT count(*) FROM s_orders_products x WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = x.order_id))
UNION ALL SELECT 'orders_products', 'products',
       (SELECT count(*) FROM s_orders_products x WHERE NOT EXISTS (SELECT 1 FROM s_products p WHERE p.product_id = x.product_id))
"""
)
_NN = [
    ("stores", ["store_id", "store_name"]),
    ("orders", ["order_id", "timestamp", "store_id", "total_price", "payment_type"]),
    ("products", ["product_id", "item_name", "item_size", "item_price"]),
    ("orders_products", ["order_id", "product_id", "quantity"]),
]
ORACLE_SQL["dq_not_null"] = _q(
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS n_nulls FROM s_{t}"
        for t, cols in _NN
        for c in cols
    )
)
_LEN = {"store_id": 64, "store_name": 255, "order_id": 64, "payment_type": 4, "product_id": 64, "item_name": 255, "item_size": 255}
ORACLE_SQL["dq_length"] = _q(
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
        + (f"count(*) FILTER (WHERE length(\"{c}\") > {_LEN[c]})" if c in _LEN else "count(*) FILTER (WHERE false)")
        + f" AS n_too_long FROM s_{t}"
        for t, cols in _NN
        for c in cols
    )
)
ORACLE_SQL["dq_quantity"] = _q(
    """
SELECT count(*) AS n_keys, count(*) FILTER (WHERE s.quantity IS DISTINCT FROM t.quantity) AS n_mismatch
FROM t_orders_products t FULL JOIN s_orders_products s ON s.order_id = t.order_id AND s.product_id = t.product_id
"""
)
ORACLE_SQL["lookup_by_key"] = _q(
    """
SELECT op.order_id, op.product_id, op.quantity, o."timestamp", o.total_price, o.payment_type,
       p.item_name, p.item_size, p.item_price
FROM (SELECT * FROM t_orders_products ORDER BY order_id, product_id LIMIT 1) op
JOIN t_orders o ON o.order_id = op.order_id
JOIN t_products p ON p.product_id = op.product_id
"""
)
ORACLE_SQL["preview_limit"] = _q(
    "SELECT order_id, basket_item, item_size, item_name, item_price FROM items ORDER BY order_id, basket_item LIMIT 10"
)

ORACLE_SQL["stream_ingest"] = ORACLE_SQL["norm_orders_products"]
ORACLE_SQL["event_ingest"] = ORACLE_SQL["norm_orders_products"]
ORACLE_SQL["stream_upsert"] = ORACLE_SQL["norm_orders_products"]
ORACLE_SQL["stream_replay"] = _q(
    "SELECT order_id, product_id, quantity, (SELECT count(*) FROM t_stores) AS n_stores, (SELECT count(*) FROM t_orders) AS n_orders, "
    "(SELECT count(*) FROM t_products) AS n_products, (SELECT count(*) FROM t_orders_products) AS n_orders_products FROM t_orders_products"
)
