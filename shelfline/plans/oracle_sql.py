"""Independent SQL (DuckDB dialect) for every registered query.

Each string runs against views named after the benchmark tables.  The entity
derivations mirror ``shelfline.sources.driver_tables`` expression by
expression; two-decimal rounding is ``round_even(x * 100, 0) / 100``.
"""

from __future__ import annotations

from shelfline import config
from shelfline.sources import driver_tables as dt


def _r2(x: str) -> str:
    return f"(round_even(({x}) * 100, 0) / 100)"


def _day(day):
    return dt.day_date(day)


def _months():
    return "[" + ", ".join(f"'{m}'" for m in config.MONTH_NAMES) + "]"


def _weekdays():
    return "[" + ", ".join(f"'{w}'" for w in config.WEEKDAY_NAMES) + "]"


def _age_band(x: str) -> str:
    parts = " ".join(f"WHEN {x} < {u} THEN '{lab}'" for u, lab in config.AGE_BANDS)
    return f"(CASE {parts} WHEN {x} IS NOT NULL THEN '{config.AGE_BAND_TOP}' END)"


# ── silver entities ──────────────────────────────────────────────────────────
def products_silver(day=None) -> str:
    where = {None: "TRUE", 1: "p_size <= 45", 2: "p_size >= 3"}[day]
    price = ("CASE WHEN p_size % 10 = 0 THEN p_retailprice + 1.5 ELSE p_retailprice END"
             if day == 2 else "p_retailprice")
    disc = "CAST(nullif(p_size % 21, 0) AS DOUBLE)"
    return f"""
SELECT p_partkey AS product_id, p_name AS product_name,
       p_name || ' - ' || p_type AS description, p_type AS category,
       nullif(p_brand, 'Brand#1') AS brand, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
       {price} AS price, {disc} AS discount_pct,
       CAST(p_size % 5 + 1 AS DOUBLE) AS rating, CAST(p_size AS DOUBLE) AS stock,
       CASE WHEN p_size <= 5 THEN 'Low Stock' ELSE 'In Stock' END AS availability,
       {_r2(f"({price}) * (1 - coalesce({disc}, CAST(0.0 AS DOUBLE)) / 100)")} AS discounted_price,
       DATE '{_day(day)}' AS load_date
FROM part WHERE {where}"""


def customers_silver(day=None) -> str:
    where = {None: "TRUE", 1: "c.c_nationkey <> 24", 2: "c.c_nationkey <> 0"}[day]
    domain = ("CASE WHEN c_mktsegment = 'MACHINERY' THEN '@New.Example.COM' "
              "ELSE '@Shop.Example.COM' END") if day == 2 else "'@Shop.Example.COM'"
    handle = "replace(c_name, '#', '.')"
    first = "upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2))"
    last = "CASE WHEN c_acctbal >= 0 THEN substr(c_name, 10) END"
    age = "CASE WHEN c_custkey % 70 <> 69 THEN 10 + c_custkey % 70 END"
    bdate = ("CAST(CAST(1940 + c_custkey % 60 AS VARCHAR) || '-' || CAST(c_custkey % 12 + 1 AS VARCHAR)"
             " || '-' || CAST(c_custkey % 28 + 1 AS VARCHAR) AS DATE)")
    return f"""
SELECT c.c_custkey AS customer_id, {first} AS first_name, {last} AS last_name,
       trim(concat_ws(' ', {first}, {last})) AS full_name,
       lower(CASE WHEN c_custkey % 40 = 0 THEN {handle} || '.shop.example.com'
                  ELSE {handle} || {domain} END) AS email,
       CAST({age} AS DOUBLE) AS age, {_age_band(age)} AS age_band,
       CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
       {bdate} AS birth_date, g.n_name AS city, g.r_name AS state,
       'N' || CAST(c.c_nationkey AS VARCHAR) AS state_code, 'Earth' AS country,
       DATE '{_day(day)}' AS load_date
FROM customer c
LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) g
  ON c.c_nationkey = g.n_nationkey
WHERE {where}"""


LINE_ORDER_DESC = ", ".join(f"{c} DESC" for c in dt.LINE_ORDER)
LINE_ORDER_ASC = ", ".join(dt.LINE_ORDER)


def sales_lines(day=None) -> str:
    where = {None: "TRUE", 1: f"o_orderdate < TIMESTAMP '{dt.CART_DAY1_BEFORE}'",
             2: f"o_orderdate >= TIMESTAMP '{dt.CART_DAY2_FROM}'"}[day]
    return f"""
SELECT o_orderkey AS cart_id, o_custkey AS customer_id, l_partkey AS product_id,
       'part ' || CAST(l_partkey AS VARCHAR) AS product_name,
       {_r2("l_extendedprice / l_quantity")} AS price, l_quantity AS quantity,
       l_extendedprice AS gross_amount, {_r2("l_discount * 100")} AS discount_pct,
       {_r2("l_extendedprice * (1 - l_discount)")} AS net_amount,
       CAST(o_orderdate AS DATE) AS sale_date, {LINE_ORDER_ASC}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE {where}"""


def sales_silver(day=None) -> str:
    return f"""
SELECT cart_id, customer_id, product_id, product_name, price, quantity, gross_amount,
       discount_pct, net_amount, sale_date,
       {_r2("gross_amount - net_amount")} AS discount_amount,
       DATE '{_day(day)}' AS load_date
FROM ({sales_lines(day)}) s
QUALIFY row_number() OVER (PARTITION BY cart_id, product_id ORDER BY {LINE_ORDER_DESC}) = 1"""


def stock_silver(day=None) -> str:
    return f"""
SELECT product_id, stock AS quantity, price, availability,
       DATE '{_day(day)}' AS reference_date, DATE '{_day(day)}' AS load_date
FROM ({products_silver(day)}) p"""


def _src(entity, day):
    return f"'silver/validated/{entity}/dt={_day(day)}'"


# ── history-typed frames (cast as the warehouse tables declare) ─────────────
def products_history(day=None) -> str:
    return f"""
SELECT CAST(product_id AS BIGINT) AS product_id, product_name, description, category, brand, sku,
       CAST(price AS DECIMAL(14,2)) AS price, CAST(discount_pct AS DECIMAL(6,2)) AS discount_pct,
       CAST(discounted_price AS DECIMAL(14,2)) AS discounted_price,
       CAST(rating AS DECIMAL(4,2)) AS rating, CAST(round(stock) AS INTEGER) AS stock,
       availability, {_src('products', day)} AS source_key, CAST(CAST(load_date AS TIMESTAMP) AS VARCHAR) AS loaded_at, load_date
FROM ({valid('products', day)}) p"""


def customers_history(day=None) -> str:
    return f"""
SELECT CAST(customer_id AS BIGINT) AS customer_id, first_name, last_name, full_name, email,
       CAST(round(age) AS INTEGER) AS age, age_band, gender, birth_date, city, state,
       state_code, country, {_src('customers', day)} AS source_key, CAST(CAST(load_date AS TIMESTAMP) AS VARCHAR) AS loaded_at, load_date
FROM ({valid('customers', day)}) c"""


def sales_history(day=None) -> str:
    return f"""
SELECT CAST(cart_id AS BIGINT) AS cart_id, CAST(customer_id AS BIGINT) AS customer_id,
       CAST(product_id AS BIGINT) AS product_id, product_name,
       CAST(price AS DECIMAL(14,2)) AS price, CAST(round(quantity) AS INTEGER) AS quantity,
       CAST(gross_amount AS DECIMAL(14,2)) AS gross_amount,
       CAST(discount_pct AS DECIMAL(6,2)) AS discount_pct,
       CAST(discount_amount AS DECIMAL(14,2)) AS discount_amount,
       CAST(net_amount AS DECIMAL(14,2)) AS net_amount, sale_date,
       {_src('sales', day)} AS source_key, CAST(CAST(load_date AS TIMESTAMP) AS VARCHAR) AS loaded_at, load_date
FROM ({valid('sales', day)}) s"""


def stock_history(day=None) -> str:
    return f"""
SELECT CAST(product_id AS BIGINT) AS product_id, reference_date,
       CAST(round(quantity) AS INTEGER) AS quantity, CAST(price AS DECIMAL(14,2)) AS price,
       availability, {_src('stock', day)} AS source_key, CAST(CAST(load_date AS TIMESTAMP) AS VARCHAR) AS loaded_at, load_date
FROM ({valid('stock', day)}) s"""


HISTORY = {"products": products_history, "customers": customers_history,
           "sales": sales_history, "stock": stock_history}


def consolidated(day=None, sales=None, products=None, customers=None) -> str:
    sales = sales or sales_history(day)
    products = products or products_history(day)
    customers = customers or customers_history(day)
    return f"""
SELECT v.cart_id, v.product_id, v.sale_date, coalesce(p.product_name, v.product_name) AS product_name,
       p.category, p.brand, v.customer_id, c.full_name AS customer_name, c.city, c.state_code,
       c.age_band, v.quantity, v.price, v.gross_amount, v.discount_amount, v.net_amount,
       v.load_date
FROM ({sales}) v
LEFT JOIN ({products}) p ON p.product_id = v.product_id AND p.load_date = v.load_date
LEFT JOIN ({customers}) c ON c.customer_id = v.customer_id AND c.load_date = v.load_date"""


# ── validity (the rules of shelfline.operators.quality) ─────────────────────
VALID = {
    "products": "product_id IS NOT NULL AND product_name IS NOT NULL AND category IS NOT NULL "
                "AND price IS NOT NULL AND NOT coalesce(price < 0, FALSE)",
    "customers": "customer_id IS NOT NULL AND first_name IS NOT NULL AND email IS NOT NULL "
                 "AND contains(coalesce(email, ''), '@')",
    "sales": "cart_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL "
             "AND quantity IS NOT NULL AND price IS NOT NULL "
             "AND NOT coalesce(quantity <= 0 OR price < 0, FALSE)",
    "stock": "product_id IS NOT NULL AND reference_date IS NOT NULL AND quantity IS NOT NULL "
             "AND NOT coalesce(quantity < 0, FALSE)",
}
SILVER = {"products": products_silver, "customers": customers_silver,
          "sales": sales_silver, "stock": stock_silver}


def valid(entity, day=None) -> str:
    return f"SELECT * FROM ({SILVER[entity](day)}) x WHERE {VALID[entity]}"


def rejects(entity, day=None) -> str:
    return f"SELECT * FROM ({SILVER[entity](day)}) x WHERE NOT ({VALID[entity]})"
