"""Declared schemas of the silver entities and warehouse tables (2.5).

Each history table is partitioned by ``load_date`` (the day index of the
source design becomes the partition column).  Money is ``decimal(14,2)``.
Ids are ``bigint`` (not the 32-bit integer of the source design) so keys beyond
2^31 fit at scale.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)
PCT = T.DecimalType(6, 2)
RATING = T.DecimalType(4, 2)


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Silver (typed, before the warehouse coercion).
SILVER = {
    "products": _s(
        ("product_id", T.LongType(), True), ("product_name", T.StringType(), True),
        ("description", T.StringType(), True), ("category", T.StringType(), True),
        ("brand", T.StringType(), True), ("sku", T.StringType(), True),
        ("price", T.DoubleType(), True), ("discount_pct", T.DoubleType(), True),
        ("rating", T.DoubleType(), True), ("stock", T.DoubleType(), True),
        ("availability", T.StringType(), True)),
    "customers": _s(
        ("customer_id", T.LongType(), True), ("first_name", T.StringType(), True),
        ("last_name", T.StringType(), True), ("email", T.StringType(), True),
        ("age", T.DoubleType(), True), ("gender", T.StringType(), True),
        ("birth_date", T.DateType(), True), ("city", T.StringType(), True),
        ("state", T.StringType(), True), ("state_code", T.StringType(), True),
        ("country", T.StringType(), True)),
    "sales": _s(
        ("cart_id", T.LongType(), True), ("customer_id", T.LongType(), True),
        ("product_id", T.LongType(), True), ("product_name", T.StringType(), True),
        ("price", T.DoubleType(), True), ("quantity", T.DoubleType(), True),
        ("gross_amount", T.DoubleType(), True), ("discount_pct", T.DoubleType(), True),
        ("net_amount", T.DoubleType(), True)),
}

# History tables: one snapshot per load_date (the partition column comes last); loaded_at is
# when the row was loaded.
HISTORY = {
    "products": _s(
        ("product_id", T.LongType(), False), ("product_name", T.StringType(), True),
        ("description", T.StringType(), True), ("category", T.StringType(), True),
        ("brand", T.StringType(), True), ("sku", T.StringType(), True),
        ("price", MONEY, True), ("discount_pct", PCT, True),
        ("discounted_price", MONEY, True), ("rating", RATING, True),
        ("stock", T.IntegerType(), True), ("availability", T.StringType(), True),
        ("source_key", T.StringType(), True), ("loaded_at", T.TimestampType(), False),
        ("load_date", T.DateType(), False)),
    "customers": _s(
        ("customer_id", T.LongType(), False), ("first_name", T.StringType(), True),
        ("last_name", T.StringType(), True), ("full_name", T.StringType(), True),
        ("email", T.StringType(), True), ("age", T.IntegerType(), True),
        ("age_band", T.StringType(), True), ("gender", T.StringType(), True),
        ("birth_date", T.DateType(), True), ("city", T.StringType(), True),
        ("state", T.StringType(), True), ("state_code", T.StringType(), True),
        ("country", T.StringType(), True),
        ("source_key", T.StringType(), True), ("loaded_at", T.TimestampType(), False),
        ("load_date", T.DateType(), False)),
    "sales": _s(
        ("cart_id", T.LongType(), False), ("customer_id", T.LongType(), True),
        ("product_id", T.LongType(), False), ("product_name", T.StringType(), True),
        ("price", MONEY, True), ("quantity", T.IntegerType(), True),
        ("gross_amount", MONEY, True), ("discount_pct", PCT, True),
        ("discount_amount", MONEY, True), ("net_amount", MONEY, True),
        ("sale_date", T.DateType(), True),
        ("source_key", T.StringType(), True), ("loaded_at", T.TimestampType(), False),
        ("load_date", T.DateType(), False)),
    "stock": _s(
        ("product_id", T.LongType(), False), ("reference_date", T.DateType(), False),
        ("quantity", T.IntegerType(), True), ("price", MONEY, True),
        ("availability", T.StringType(), True),
        ("source_key", T.StringType(), True), ("loaded_at", T.TimestampType(), False),
        ("load_date", T.DateType(), False)),
}

# Consolidated sales fact (7.3), keyed by (cart_id, product_id) without the date.
FACT_SALES = _s(
    ("cart_id", T.LongType(), False), ("product_id", T.LongType(), False),
    ("sale_date", T.DateType(), False), ("product_name", T.StringType(), True),
    ("category", T.StringType(), True), ("brand", T.StringType(), True),
    ("customer_id", T.LongType(), True), ("customer_name", T.StringType(), True),
    ("city", T.StringType(), True), ("state_code", T.StringType(), True),
    ("age_band", T.StringType(), True), ("quantity", T.IntegerType(), True),
    ("price", MONEY, True), ("gross_amount", MONEY, True),
    ("discount_amount", MONEY, True), ("net_amount", MONEY, True),
    ("load_date", T.DateType(), False))
FACT_KEYS = ["cart_id", "product_id"]

DIM_PRODUCT = _s(
    ("product_sk", T.LongType(), False), ("product_id", T.LongType(), False),
    ("product_name", T.StringType(), True), ("category", T.StringType(), True),
    ("brand", T.StringType(), True), ("sku", T.StringType(), True),
    ("current_price", MONEY, True), ("updated_at", T.TimestampType(), False))
DIM_CUSTOMER = _s(
    ("customer_sk", T.LongType(), False), ("customer_id", T.LongType(), False),
    ("full_name", T.StringType(), True), ("email", T.StringType(), True),
    ("gender", T.StringType(), True), ("age_band", T.StringType(), True),
    ("city", T.StringType(), True), ("state", T.StringType(), True),
    ("state_code", T.StringType(), True), ("country", T.StringType(), True),
    ("updated_at", T.TimestampType(), False))
DIM_CATEGORY = _s(
    ("category_sk", T.LongType(), False), ("category", T.StringType(), False),
    ("product_count", T.IntegerType(), True), ("updated_at", T.TimestampType(), False))
DIM_BRAND = _s(
    ("brand_sk", T.LongType(), False), ("brand", T.StringType(), False),
    ("product_count", T.IntegerType(), True), ("updated_at", T.TimestampType(), False))
DIM_DATE = _s(
    ("date_sk", T.IntegerType(), False), ("date", T.DateType(), False),
    ("year", T.ShortType(), True), ("quarter", T.ShortType(), True),
    ("month", T.ShortType(), True), ("month_name", T.StringType(), True),
    ("day", T.ShortType(), True), ("weekday", T.ShortType(), True),
    ("weekday_name", T.StringType(), True), ("is_weekend", T.BooleanType(), True))

AUDIT_RUNS = _s(
    ("pipeline", T.StringType(), False), ("run_id", T.StringType(), False),
    ("ds", T.DateType(), False), ("status", T.StringType(), False),
    ("steps", T.StringType(), True), ("lineage", T.StringType(), True),
    ("recorded_at", T.TimestampType(), False))
