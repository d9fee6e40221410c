"""Oracle SQL registry, keyed like ``shelfline.plans.queries.REGISTRY``."""

from __future__ import annotations

from shelfline import config
from shelfline.plans import oracle_sql as S
from shelfline.sources import driver_tables as dt

ORACLE: dict[str, str] = {}
RUN, D1, D2 = dt.RUN_DATE, dt.DAY_DATES[1], dt.DAY_DATES[2]
PAGE = 500


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


def _scd1(keys, sk, values, src1, src2) -> str:
    k = ", ".join(keys)
    on = " AND ".join(f"d1.{x} = s2.{x}" for x in keys)
    vals = ", ".join(values)
    s2_vals = ", ".join(f"s2.{v}" for v in values)
    at1, at2 = (f"CAST(TIMESTAMP '{d}' AS VARCHAR)" for d in (D1, D2))
    changed = " OR ".join(f"d1.{v} IS DISTINCT FROM s2.{v}" for v in values)
    return f"""
WITH s1 AS ({src1}), s2 AS ({src2}),
d1 AS (SELECT row_number() OVER (ORDER BY {k}) AS {sk}, {k}, {vals}, {at1} AS updated_at FROM s1),
mx AS (SELECT coalesce(max({sk}), 0) AS m FROM d1)
SELECT d1.* FROM d1 WHERE NOT EXISTS (SELECT 1 FROM s2 WHERE {on})
UNION ALL
SELECT d1.{sk}, {", ".join(f"s2.{x}" for x in keys)}, {s2_vals}, CASE WHEN {changed} THEN {at2} ELSE {at1} END
FROM d1 JOIN s2 ON {on}
UNION ALL
SELECT (SELECT m FROM mx) + row_number() OVER (ORDER BY {k}) AS {sk}, {k}, {vals}, {at2}
FROM s2 WHERE NOT EXISTS (SELECT 1 FROM d1 WHERE {on})"""


def _fact_two_days() -> str:
    return f"""
WITH c1 AS ({S.consolidated(1)}), c2 AS ({S.consolidated(2)})
SELECT * FROM c1 WHERE NOT EXISTS (
  SELECT 1 FROM c2 WHERE c2.cart_id = c1.cart_id AND c2.product_id = c1.product_id)
UNION ALL SELECT * FROM c2"""


def _calendar(dates_sql: str) -> str:
    months = "[" + ", ".join(f"'{m}'" for m in config.MONTH_NAMES) + "]"
    days = "[" + ", ".join(f"'{w}'" for w in config.WEEKDAY_NAMES) + "]"
    return f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS date,
       CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
       CAST(month(d) AS SMALLINT) AS month, {months}[month(d)] AS month_name,
       CAST(day(d) AS SMALLINT) AS day, CAST(isodow(d) AS SMALLINT) AS weekday,
       {days}[isodow(d)] AS weekday_name, isodow(d) IN (6, 7) AS is_weekend
FROM ({dates_sql}) t"""


def _date_range(lo_sql: str, ds: str) -> str:
    return f"""
SELECT CAST(unnest(generate_series(
    CAST(least(coalesce(({lo_sql}), DATE '{ds}'), DATE '{ds}') AS TIMESTAMP),
    CAST(DATE '{ds}' AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d"""


# ── 1.x sources ──────────────────────────────────────────────────────────────
oracle("envelope_records", f"""
SELECT p_partkey // {PAGE} AS page,
       CAST(row_number() OVER (PARTITION BY p_partkey // {PAGE} ORDER BY p_partkey) - 1 AS INTEGER) AS ord,
       p_partkey AS product_id, p_name AS title, p_retailprice AS price,
       nullif(p_brand, 'Brand#1') AS brand
FROM part""")

oracle("envelope_check", f"""
SELECT p_partkey // {PAGE} AS page, TRUE AS is_list, CAST(count(*) AS INTEGER) AS n_items,
       0 AS n_non_objects, TRUE AS ok
FROM part GROUP BY 1
UNION ALL
SELECT page + k * 1000000, is_list, n_items, n_non_objects, FALSE
FROM (SELECT DISTINCT p_partkey // {PAGE} AS page FROM part) p,
     (VALUES (1, FALSE, 0, 0), (2, TRUE, 0, 0), (3, TRUE, 3, 2), (4, FALSE, 0, 0)) b(k, is_list, n_items, n_non_objects)""")

oracle("privacy_projection", """
SELECT c_custkey AS customer_id,
       8 - CAST(c_acctbal < 0 AS INTEGER) - CAST(c_custkey % 70 = 69 AS INTEGER) AS n_fields,
       FALSE AS has_password,
       CASE WHEN c_custkey % 40 = 0 THEN replace(c_name, '#', '.') || '.shop.example.com'
            ELSE replace(c_name, '#', '.') || '@Shop.Example.COM' END AS email
FROM customer""")

oracle("raw_json_scan", """
SELECT p_partkey AS product_id, p_name AS title, p_retailprice AS price,
       nullif(p_brand, 'Brand#1') AS brand
FROM part""")

oracle("parquet_scan", """
SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
       sum(CAST(l_quantity AS DECIMAL(18,2))) AS sum_qty
FROM lineitem GROUP BY 1, 2""")

oracle("lake_listing", f"""
SELECT layer, true AS has_files, true AS has_bytes, count(DISTINCT load_date) AS n_days
FROM (SELECT load_date FROM ({S.HISTORY["products"](1)}) a
      UNION ALL SELECT load_date FROM ({S.HISTORY["products"](2)}) b) d, (VALUES ('raw'), ('silver')) l(layer)
GROUP BY layer""")
oracle("day_partition_scan", f"SELECT * EXCLUDE (load_date) FROM ({S.sales_history(2)}) x")
oracle("history_day_scan", S.sales_history(1))

# ── 2.x sinks ────────────────────────────────────────────────────────────────
oracle("raw_landing_roundtrip", """
SELECT doc_id, lang, length(text) AS n_chars, sha256(text) AS text_sha256 FROM documents""")
oracle("parquet_roundtrip", S.products_history())
oracle("day_overwrite", f"""
SELECT load_date AS dt, count(*) AS n_rows, sum(net_amount) AS total_net
FROM (SELECT * FROM ({S.sales_history(1)}) a UNION ALL SELECT * FROM ({S.sales_history(2)}) b) x
GROUP BY 1""")
oracle("bronze_catalogue", """
SELECT 'products' AS entity, (SELECT count(*) FROM part) AS n_rows, 20 AS n_columns
UNION ALL SELECT 'customers', (SELECT count(*) FROM customer), 17
UNION ALL SELECT 'carts', (SELECT count(DISTINCT o_orderkey) FROM orders
                           JOIN lineitem ON l_orderkey = o_orderkey), 11""")

# ── 3.x conforming and scalar functions ──────────────────────────────────────
oracle("flatten_one_level", """
SELECT c_custkey AS customer_id, n_name AS address_city,
       'N' || CAST(c_nationkey AS VARCHAR) AS address_state_code,
       '{"lat":-7.5,"lng":12.25}' AS address_coordinates
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")

oracle("stringify_columns", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_retailprice AS VARCHAR) AS price,
       CAST(p_size AS VARCHAR) AS stock, nullif(p_brand, 'Brand#1') AS brand,
       '["' || lower(p_type) || '"]' AS tags,
       '{"width":' || CAST(CAST(p_size AS DOUBLE) AS VARCHAR) || ',"height":2.0,"depth":3.0}' AS dimensions
FROM part""")

oracle("lineage_columns", """
SELECT p_partkey AS product_id, TRUE AS from_day, '2001-12-31T00:00:00+00:00' AS ingested_at
FROM part""")

oracle("rename_allowlist", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
       p_name || ' - ' || p_type AS description, p_type AS category,
       nullif(p_brand, 'Brand#1') AS brand, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
       CAST(p_retailprice AS VARCHAR) AS price,
       CAST(CAST(nullif(p_size % 21, 0) AS DOUBLE) AS VARCHAR) AS discount_pct,
       CAST(CAST(p_size % 5 + 1 AS DOUBLE) AS VARCHAR) AS rating, CAST(p_size AS VARCHAR) AS stock,
       CASE WHEN p_size <= 5 THEN 'Low Stock' ELSE 'In Stock' END AS availability
FROM part""")

oracle("trim_blank_null", """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 2 THEN NULL ELSE c_name END AS name FROM customer""")

oracle("lenient_numeric", """
SELECT c_custkey,
       CASE WHEN c_custkey % 8 IN (0, 4) THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE)
            WHEN c_custkey % 8 = 5 THEN CAST(c_custkey AS DOUBLE) * 1000 END AS value
FROM customer""")

oracle("lenient_integer", """
SELECT c_custkey,
       CASE WHEN c_custkey % 6 IN (0, 1, 3) THEN c_custkey
            WHEN c_custkey % 6 = 5 THEN c_custkey * 100 END AS value
FROM customer""")

oracle("lenient_date", """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 5 THEN CAST(o_orderdate AS DATE) END AS order_date
FROM orders""")

oracle("discounted_price", f"""
SELECT product_id, price, discount_pct, discounted_price FROM ({S.products_silver()}) p""")

oracle("full_name", """
SELECT c_custkey, trim(concat_ws(' ', CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END,
                                      CASE WHEN c_acctbal >= 0 THEN c_name END)) AS full_name
FROM customer""")

oracle("email_normalise", f"SELECT customer_id, email FROM ({S.customers_silver()}) c")
oracle("age_band", f"SELECT customer_id, age, age_band FROM ({S.customers_silver()}) c")
oracle("discount_amount", f"""
SELECT cart_id, product_id, gross_amount, net_amount, discount_amount FROM ({S.sales_silver()}) s""")
oracle("stamp_load_date", f"""
SELECT cart_id, product_id,
       CASE WHEN customer_id % 2 = 0 THEN sale_date ELSE DATE '{RUN}' END AS sale_date,
       DATE '{RUN}' AS load_date
FROM ({S.sales_lines()}) s""")
oracle("stock_snapshot", S.stock_silver())
oracle("warehouse_types", f"""
SELECT h.product_id, h.price, h.discount_pct, h.discounted_price, h.rating, h.stock,
       CAST(round(p.price / 100 + 0.5) AS INTEGER) AS price_hundreds
FROM ({S.products_history()}) h JOIN ({S.products_silver()}) p ON h.product_id = p.product_id""")

# ── 4.x arrays, JSON, de-duplication ────────────────────────────────────────
oracle("explode_cart_lines", f"""
SELECT cart_id, customer_id,
       CAST(row_number() OVER (PARTITION BY cart_id ORDER BY {S.LINE_ORDER_ASC}) - 1 AS INTEGER) AS line_pos,
       product_id, CAST(quantity AS INTEGER) AS quantity, price, net_amount
FROM ({S.sales_lines()}) s""")
oracle("json_field_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(NULL AS VARCHAR) AS missing
FROM events""")
oracle("dedup_keep_last", S.sales_silver())
oracle("duplicate_count", f"""
WITH l AS ({S.sales_lines()})
SELECT (SELECT count(*) FROM l) AS n_rows,
       (SELECT count(*) FROM l) - (SELECT count(*) FROM (SELECT DISTINCT cart_id, product_id FROM l) d)
         AS n_duplicates""")
oracle("key_uniqueness", f"""
SELECT cart_id, product_id, count(*) AS n FROM ({S.sales_lines()}) s
GROUP BY 1, 2 HAVING count(*) > 1 OR cart_id IS NULL OR product_id IS NULL""")

# ── 5.x rules and the gate ───────────────────────────────────────────────────
oracle("rule_required", f"""
SELECT customer_id, (customer_id IS NULL OR last_name IS NULL OR email IS NULL) AS invalid
FROM ({S.customers_silver()}) c""")
oracle("rule_sales", f"""
SELECT cart_id, product_id, NOT ({S.VALID['sales']}) AS invalid
FROM (SELECT * REPLACE (CASE WHEN cart_id % 11 = 0 THEN 0 ELSE quantity END AS quantity,
                        CASE WHEN product_id % 13 = 0 THEN -price ELSE price END AS price)
      FROM ({S.sales_silver()}) x) s""")
oracle("rule_products", f"""
SELECT product_id, NOT ({S.VALID['products']}) AS invalid
FROM (SELECT * REPLACE (CASE WHEN product_id % 17 = 0 THEN NULL WHEN product_id % 13 = 0 THEN -price
                             ELSE price END AS price) FROM ({S.products_silver()}) x) p""")
oracle("rule_stock", f"""
SELECT product_id, NOT ({S.VALID['stock']}) AS invalid
FROM (SELECT * REPLACE (CASE WHEN product_id % 13 = 0 THEN -quantity WHEN product_id % 17 = 0 THEN 0
                             ELSE quantity END AS quantity) FROM ({S.stock_silver()}) x) s""")
oracle("rule_customers", f"""
SELECT customer_id, email, NOT ({S.VALID['customers']}) AS invalid FROM ({S.customers_silver()}) c""")
oracle("quality_split_valid", S.valid("customers"))
oracle("quality_split_rejects", S.rejects("customers"))
oracle("quality_gate", "\nUNION ALL\n".join(f"""
SELECT '{e}' AS entity, count(*) AS n_total, count(*) FILTER (WHERE NOT ({S.VALID[e]})) AS n_rejected,
       CAST(count(*) FILTER (WHERE NOT ({S.VALID[e]})) AS DOUBLE) / greatest(count(*), 1) AS reject_rate,
       CAST(count(*) FILTER (WHERE NOT ({S.VALID[e]})) AS DOUBLE) / greatest(count(*), 1)
         <= {config.DEFAULT_REJECT_LIMIT} AS passed
FROM ({S.SILVER[e]()}) x""" for e in config.ENTITIES))

# ── 6.x loads, upserts, dimensions ───────────────────────────────────────────
oracle("history_day_load", f"""
SELECT * FROM ({S.products_history(1)}) a UNION ALL SELECT * FROM ({S.products_history(2)}) b""")
oracle("align_columns", f"""
SELECT CAST(product_id AS BIGINT) AS product_id, product_name, description, category, brand, sku,
       CAST(price AS DECIMAL(14,2)) AS price, CAST(discount_pct AS DECIMAL(6,2)) AS discount_pct,
       CAST(discounted_price AS DECIMAL(14,2)) AS discounted_price,
       CAST(NULL AS DECIMAL(4,2)) AS rating, CAST(round(stock) AS INTEGER) AS stock,
       availability, 'silver/validated/products/dt={RUN}' AS source_key,
       CAST(CAST(load_date AS TIMESTAMP) AS VARCHAR) AS loaded_at, load_date
FROM ({S.products_silver()}) p""")


def _dim_src(name, day):
    h = S.products_history(day)
    if name == "product":
        return (f"SELECT product_id, product_name, category, brand, sku, price AS current_price "
                f"FROM ({h}) h")
    if name == "customer":
        return (f"SELECT customer_id, full_name, email, gender, age_band, city, state, state_code, "
                f"country FROM ({S.customers_history(day)}) h")
    if name == "category":
        return (f"SELECT category, CAST(count(*) AS INTEGER) AS product_count FROM ({h}) h "
                f"WHERE category IS NOT NULL GROUP BY category")
    return (f"SELECT coalesce(brand, '{config.DEFAULT_BRAND_LABEL}') AS brand, "
            f"CAST(count(*) AS INTEGER) AS product_count FROM ({h}) h GROUP BY 1")


_DIMS = {
    "product": (["product_id"], "product_sk",
                ["product_name", "category", "brand", "sku", "current_price"]),
    "customer": (["customer_id"], "customer_sk",
                 ["full_name", "email", "gender", "age_band", "city", "state", "state_code", "country"]),
    "category": (["category"], "category_sk", ["product_count"]),
    "brand": (["brand"], "brand_sk", ["product_count"]),
}
for _name, (_keys, _sk, _vals) in _DIMS.items():
    oracle(f"dim_{_name}_upsert", _scd1(_keys, _sk, _vals, _dim_src(_name, 1), _dim_src(_name, 2)))

oracle("fact_upsert", _fact_two_days())
oracle("calendar_range", f"""
SELECT d AS date FROM ({_date_range(f"SELECT min(sale_date) FROM ({S.sales_history()}) s", RUN)}) r""")
oracle("calendar_attributes", _calendar(
    _date_range(f"SELECT min(sale_date) FROM ({S.sales_history()}) s", RUN)))
oracle("calendar_insert_missing", _calendar(f"""
SELECT DISTINCT d FROM (
  {_date_range(f"SELECT min(sale_date) FROM ({S.sales_history(1)}) s", D1)}
  UNION ALL
  {_date_range(f"SELECT min(sale_date) FROM ({S.sales_history(2)}) s", D2)}) u"""))

# ── 7.x joins ────────────────────────────────────────────────────────────────
oracle("sales_consolidated", S.consolidated())
def _both_days(history, columns):
    return " UNION ALL ".join(f"SELECT {columns} FROM ({history(day)}) d" for day in (1, 2))


_SALES = _both_days(S.sales_history, "cart_id, product_id, customer_id, load_date")
oracle("sales_join_products", f"""
SELECT v.cart_id, v.product_id, v.load_date, p.category, p.brand
FROM ({_SALES}) v
LEFT JOIN ({_both_days(S.products_history, "product_id, load_date, category, brand")}) p
  ON p.product_id = v.product_id AND p.load_date = v.load_date""")
oracle("sales_join_customers", f"""
SELECT v.cart_id, v.product_id, v.load_date, v.customer_id, c.full_name AS customer_name, c.city
FROM ({_SALES}) v
LEFT JOIN ({_both_days(S.customers_history, "customer_id, load_date, full_name, city")}) c
  ON c.customer_id = v.customer_id AND c.load_date = v.load_date""")
oracle("join_completeness", "\nUNION ALL\n".join(f"""
SELECT DATE '{dt.day_date(day)}' AS load_date, count(*) AS n_rows, count(category) AS n_with_product,
       count(customer_name) AS n_with_customer
FROM ({S.consolidated(day)}) f""" for day in (None, 2)))

# ── 8.x aggregations ─────────────────────────────────────────────────────────
oracle("category_counts", f"""
SELECT category, CAST(count(*) AS INTEGER) AS product_count FROM ({S.products_history()}) p
WHERE category IS NOT NULL GROUP BY 1""")
oracle("brand_counts", f"""
SELECT coalesce(brand, '{config.DEFAULT_BRAND_LABEL}') AS brand, CAST(count(*) AS INTEGER) AS product_count
FROM ({S.products_history()}) p GROUP BY 1""")
oracle("cart_totals", f"""
SELECT cart_id, sum(CAST(gross_amount AS DECIMAL(14,2))) AS total,
       sum(CAST(net_amount AS DECIMAL(14,2))) AS discounted_total,
       count(*) AS total_products, sum(CAST(quantity AS BIGINT)) AS total_quantity
FROM ({S.sales_lines()}) s GROUP BY cart_id""")
oracle("audit_layer_counts", "\nUNION ALL\n".join(
    [f"SELECT 'history_{e}' AS layer, CAST(count(*) AS VARCHAR) AS value FROM ({S.HISTORY[e](2)}) x"
     for e in config.ENTITIES] + ["SELECT 'missing_table', 'error: AnalysisException'"]))
oracle("audit_record", "SELECT 'retail_daily' AS pipeline, 'run-1' AS run_id, "
       f"DATE '{RUN}' AS ds, 'success' AS status, '{{' || " + " || ', ' || ".join(
           f"'\"history_{e}\": ' || CAST((SELECT count(*) FROM ({S.HISTORY[e]()}) x) AS VARCHAR)"
           for e in sorted(config.ENTITIES)) + " || '}' AS steps")

# ── 9.x composition ──────────────────────────────────────────────────────────
oracle("pipeline_end_to_end", _fact_two_days())
oracle("rerun_idempotent", _fact_two_days())
