"""Registered queries: one per inventory operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the benchmark tables (or data Spark derives from them) in
full.  Queries that exercise sinks, loads or upserts write into a fresh
directory under the shared checkpoint folder and return what they read back.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import config, schemas
from shelfline.functions import (age_band, email_normalise, full_name, lenient_date,
                                 lenient_double, lenient_long, to_int_rounded,
                                 trim_blank_null)
from shelfline.operators import (audit, calendar, carts, conform, dedup, history, marts,
                                 quality, upsert)
from shelfline.plans import scenario
from shelfline.session import scratch_path
from shelfline.sinks import lake as L
from shelfline.sources import driver_tables as dt
from shelfline.sources import envelope as env
from shelfline.sources import lake_scan

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

PAGE_SIZE = 500   # records per source envelope page


def query(name: str):
    """Registers a query; moments of loads and updates are given as text, which every engine
    writes alike."""
    def wrap(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            out = fn(spark, sf_dir)
            moments = [c for c in ("loaded_at", "updated_at") if c in out.columns]
            return out.withColumns({c: F.col(c).cast("string") for c in moments}) if moments else out
        REGISTRY[name] = run
        return fn
    return wrap


def _hist(spark, sf_dir, entity, day=None, landed=None):
    return scenario.history_frame(spark, sf_dir, entity, day, landed)


def _landed(spark, sf_dir):
    return dt.landed_days(spark, sf_dir, scratch_path(spark, "lines"))


def _silver(spark, sf_dir, entity, day=None):
    return scenario.silver(spark, sf_dir, entity, day)


def _product_pages(spark, sf_dir) -> DataFrame:
    """Source envelopes: products in pages of ``PAGE_SIZE`` records, as JSON documents.

    Each page is a bounded group (at most ``PAGE_SIZE`` records), so building it
    never collects an unbounded group into one task.
    """
    recs = dt.product_records(spark, sf_dir)
    page = F.expr(f"id div {PAGE_SIZE}")
    grouped = recs.groupBy(page.alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(*recs.columns))).alias("items"))
    doc = F.to_json(F.struct(F.col("items").alias(config.ENVELOPE_KEYS["products"]),
                             F.size("items").alias("total"),
                             (F.col("page") * PAGE_SIZE).alias("skip"),
                             F.lit(PAGE_SIZE).alias("limit")))
    return grouped.select("page", doc.alias("value"))


# ── 1.x sources ──────────────────────────────────────────────────────────────
@query("envelope_records")
def q_envelope_records(spark, sf_dir):
    """Record list of each envelope, one row per record with its ordinal."""
    recs = env.envelope_records(_product_pages(spark, sf_dir), "products", doc_cols=("page",))
    return recs.select(
        "page", "ord",
        carts.json_field("record", "$.id").cast("long").alias("product_id"),
        carts.json_field("record", "$.title").alias("title"),
        carts.json_field("record", "$.price").cast("double").alias("price"),
        carts.json_field("record", "$.brand").alias("brand"))


@query("envelope_check")
def q_envelope_check(spark, sf_dir):
    """Shape check of every envelope (list present, items, non-object items), each page with four
    broken ones beside it: an object for the list, an empty list, items that are no objects, no key."""
    pages = _product_pages(spark, sf_dir)
    number = F.col("page").cast("string")
    broken = [F.concat(F.lit('{"products": {"id": '), number, F.lit("}}")), F.lit('{"products": [], "total": 0}'),
              F.concat(F.lit('{"products": [{"id": 1}, '), number, F.lit(', "x"]}')), F.lit('{"items": [{"id": 1}]}')]
    for k, value in enumerate(broken, 1):
        pages = pages.unionByName(_product_pages(spark, sf_dir).select((F.col("page") + k * 1_000_000).alias("page"),
                                                                       value.alias("value")))
    return env.envelope_check(pages, "products", doc_cols=("page",))


@query("privacy_projection")
def q_privacy_projection(spark, sf_dir):
    """Customer records with extra secret fields; only allowed fields survive."""
    recs = dt.customer_records(spark, sf_dir)
    with_secrets = recs.select("id", F.to_json(F.struct(
        *recs.columns, F.lit("hunter2").alias("password"),
        F.concat(F.lit("4111-"), F.col("id").cast("string")).alias("card"))).alias("record"))
    kept = env.privacy_projection(with_secrets, config.CUSTOMER_SOURCE_FIELDS)
    m = F.from_json(F.col("record"), "map<string,string>")
    return kept.select(F.col("id").alias("customer_id"),
                       F.size(F.map_keys(m)).alias("n_fields"),
                       m["password"].isNotNull().alias("has_password"),
                       m["email"].alias("email"))


@query("raw_json_scan")
def q_raw_json_scan(spark, sf_dir):
    """Land products as JSON Lines, scan them back as text records."""
    root = scratch_path(spark, "raw-scan")
    path = L.land_json(dt.product_records(spark, sf_dir), root, dt.RUN_DATE)
    recs = env.read_raw_json(spark, path)
    m = F.from_json(F.col("record"), "map<string,string>")
    return recs.select(m["id"].cast("long").alias("product_id"), m["title"].alias("title"),
                       m["price"].cast("double").alias("price"), m["brand"].alias("brand"))


@query("parquet_scan")
def q_parquet_scan(spark, sf_dir):
    """Whole-table Parquet scan; only the three used columns are read."""
    li = lake_scan.parquet_scan(spark, f"{sf_dir}/lineitem.parquet")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("sum_qty"))


def _two_day_history(spark, sf_dir, entity) -> str:
    root = scratch_path(spark, f"history-{entity}")
    for day in (1, 2):
        history.load_day(spark, _hist(spark, sf_dir, entity, day), root, entity,
                         dt.day_date(day), scenario.source_key(entity, day), scenario.loaded_at(day))
    return root


@query("day_partition_scan")
def q_day_partition_scan(spark, sf_dir):
    """Stage layout with ``dt=`` partitions; read one day back (partition pruning)."""
    root = scratch_path(spark, "stage")
    for day in (1, 2):
        L.write_day(_hist(spark, sf_dir, "sales", day).drop("load_date"), root, dt.day_date(day))
    return lake_scan.day_scan(spark, root, dt.day_date(2)).drop("dt")


@query("history_day_scan")
def q_history_day_scan(spark, sf_dir):
    """History table ``WHERE load_date = ds`` over a two-day table."""
    root = _two_day_history(spark, sf_dir, "sales")
    return history.read_day(spark, root, "sales", dt.day_date(1))


@query("lake_listing")
def q_lake_listing(spark, sf_dir):
    """Files, bytes and days per lake layer, without reading file contents: two landed days."""
    lk = L.Lake(scratch_path(spark, "listing"))
    for day in (1, 2):
        L.land_json(dt.product_records(spark, sf_dir, day), lk.raw("products"), dt.day_date(day))
        L.write_day(_hist(spark, sf_dir, "products", day), lk.silver("validated", "products"), dt.day_date(day))
    listing = env.lake_listing(spark, lk.root)
    # the number of files and bytes is Spark's to choose, their presence and the days are not
    return listing.select("layer", (F.col("n_files") >= F.col("n_days")).alias("has_files"),
                          (F.col("n_bytes") > 0).alias("has_bytes"), "n_days")


# ── 2.x sinks ────────────────────────────────────────────────────────────────
@query("raw_landing_roundtrip")
def q_raw_landing_roundtrip(spark, sf_dir):
    """Documents (non-ASCII prose) landed as UTF-8 JSON Lines and read back intact."""
    root = scratch_path(spark, "landing")
    docs = dt.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = L.land_json(docs, root, dt.RUN_DATE)
    back = spark.read.schema("doc_id long, text string, lang string").json(path)
    return back.select("doc_id", "lang", F.length("text").alias("n_chars"),
                       F.sha2(F.col("text"), 256).alias("text_sha256"))


@query("parquet_roundtrip")
def q_parquet_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "parquet")
    _hist(spark, sf_dir, "products").write.parquet(root)
    return lake_scan.parquet_scan(spark, root)


@query("day_overwrite")
def q_day_overwrite(spark, sf_dir):
    """Write day 1, day 2, then day 1 again: each day holds exactly its last write."""
    root, lines = scratch_path(spark, "overwrite"), _landed(spark, sf_dir)
    for day in (1, 2, 1):
        L.write_day(_hist(spark, sf_dir, "sales", day, lines).drop("load_date"), root, dt.day_date(day))
    back = spark.read.parquet(root)
    return back.groupBy(F.col("dt").cast("date").alias("dt")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("net_amount").alias("total_net"))


@query("bronze_catalogue")
def q_bronze_catalogue(spark, sf_dir):
    """Per entity: rows and columns of the bronze frame (keys discovered from the data)."""
    from shelfline.plans import pipeline as P
    lk = L.Lake(scratch_path(spark, "bronze"))
    raw = P.land(lk, {"products": dt.product_records(spark, sf_dir),
                      "customers": dt.customer_records(spark, sf_dir),
                      "carts": dt.cart_records(spark, sf_dir)}, dt.RUN_DATE)
    P.to_bronze(spark, lk, raw, dt.RUN_DATE, "2001-12-31T00:00:00+00:00")
    cat = spark.read.json(L.partition_dir(lk.catalogue(), dt.RUN_DATE))
    return cat.select("entity", F.col("n_rows").cast("long").alias("n_rows"),
                      F.size("columns").alias("n_columns"))


# ── 3.x conforming and scalar functions ──────────────────────────────────────
def _customer_json(spark, sf_dir):
    recs = dt.customer_records(spark, sf_dir)
    return recs.select(F.col("id").alias("_id"), F.to_json(F.struct(*recs.columns)).alias("record"))


@query("flatten_one_level")
def q_flatten_one_level(spark, sf_dir):
    """Nested address flattened one level; deeper objects stay JSON text."""
    flat = conform.flatten_one_level(_customer_json(spark, sf_dir))
    return flat.select(F.col("id").cast("long").alias("customer_id"),
                       F.col("`address.city`").alias("address_city"),
                       F.col("`address.stateCode`").alias("address_state_code"),
                       F.col("`address.coordinates`").alias("address_coordinates"))


@query("stringify_columns")
def q_stringify_columns(spark, sf_dir):
    """Every column to text: nested values as JSON, scalars cast."""
    s = conform.stringify_columns(dt.product_records(spark, sf_dir))
    return s.select(F.col("id").alias("product_id"), "price", "stock", "brand", "tags",
                    "dimensions")


@query("lineage_columns")
def q_lineage_columns(spark, sf_dir):
    root = scratch_path(spark, "lineage")
    path = L.land_json(dt.product_records(spark, sf_dir), root, dt.RUN_DATE)
    recs = env.read_raw_json(spark, path)
    tagged = conform.add_lineage(recs, F.col("source_file"), "2001-12-31T00:00:00+00:00")
    m = F.from_json(F.col("record"), "map<string,string>")
    return tagged.select(m["id"].cast("long").alias("product_id"),
                         F.col("_source_file").contains(f"dt={dt.RUN_DATE}").alias("from_day"),
                         F.col("_ingested_at").alias("ingested_at"))


@query("rename_allowlist")
def q_rename_allowlist(spark, sf_dir):
    """Source fields mapped to silver names; unmapped fields (tags, meta…) dropped."""
    text = conform.stringify_columns(dt.product_records(spark, sf_dir))
    return conform.rename_allowlist(text, config.RENAME["products"])


def _padded_names(spark, sf_dir):
    c = dt.table(spark, sf_dir, "customer")
    pad = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("\t "), F.col("c_name"), F.lit("\n")))
    pad = pad.when(F.col("c_custkey") % 4 == 1, F.concat(F.lit(" "), F.col("c_name"), F.lit("  ")))
    pad = pad.when(F.col("c_custkey") % 4 == 2, F.lit(" \t\n  ")).otherwise(F.col("c_name"))
    return c.select("c_custkey", pad.alias("raw"))


@query("trim_blank_null")
def q_trim_blank_null(spark, sf_dir):
    """Unicode-aware trim (tab, newline, no-break space); blank-only text becomes null."""
    return _padded_names(spark, sf_dir).select("c_custkey", trim_blank_null("raw").alias("name"))


@query("lenient_numeric")
def q_lenient_numeric(spark, sf_dir):
    """Account balances written in eight text forms, parsed leniently to double."""
    c = dt.table(spark, sf_dir, "customer")
    base = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    k = F.col("c_custkey") % 8
    text = (F.when(k == 0, base).when(k == 1, F.concat(base, F.lit("d")))
            .when(k == 2, F.lit("nan")).when(k == 3, F.regexp_replace(base, r"\.", ","))
            .when(k == 4, F.concat(F.lit(" "), base, F.lit("\t")))
            .when(k == 5, F.concat(F.col("c_custkey").cast("string"), F.lit("e3")))
            .when(k == 6, F.lit("0x1F")).otherwise(F.lit("")))
    return c.select("c_custkey", lenient_double(text).alias("value"))


@query("lenient_integer")
def q_lenient_integer(spark, sf_dir):
    """Keys written as ``17``, ``17.0``, ``17.5``, `` 17 ``, ``x17``, ``1e2``: parsed to bigint."""
    c = dt.table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    k = F.col("c_custkey") % 6
    text = (F.when(k == 0, key).when(k == 1, F.concat(key, F.lit(".0")))
            .when(k == 2, F.concat(key, F.lit(".5"))).when(k == 3, F.concat(F.lit(" "), key, F.lit(" ")))
            .when(k == 4, F.concat(F.lit("x"), key)).otherwise(F.concat(key, F.lit("e2"))))
    return c.select("c_custkey", lenient_long(text).alias("value"))


@query("lenient_date")
def q_lenient_date(spark, sf_dir):
    """Order dates in eleven layouts: ISO, unpadded, US slash, month names, timestamps with zones
    (the date is the local one), day first where no month fits, and junk."""
    o = dt.table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    k = F.col("o_orderkey") % 11
    iso = F.date_format(d, "yyyy-MM-dd")
    late = F.dayofmonth(d) > 12
    text = (F.when(k == 0, iso)
            .when(k == 1, F.date_format(d, "yyyy-M-d"))
            .when(k == 2, F.date_format(d, "M/d/yyyy"))
            .when(k == 3, F.date_format(d, "MMM d, yyyy"))
            .when(k == 4, F.concat(iso, F.lit("T10:30:00.000Z")))
            .when(k == 6, F.when(late, F.date_format(d, "d/M/yyyy")).otherwise(iso))
            .when(k == 7, F.when(late, F.date_format(d, "dd-MM-yyyy")).otherwise(iso))
            .when(k == 8, F.concat(iso, F.lit("T23:30:00-05:00")))
            .when(k == 9, F.concat(iso, F.lit(" 00:00:00+09:00")))
            .when(k == 10, F.when(F.month(d) == 9, F.concat(F.lit("Sept "), F.date_format(d, "d, yyyy"))).otherwise(iso))
            .otherwise(F.lit("not a date")))
    return o.select("o_orderkey", lenient_date(text).alias("order_date"))


@query("discounted_price")
def q_discounted_price(spark, sf_dir):
    p = _silver(spark, sf_dir, "products")
    return p.select("product_id", "price", "discount_pct", "discounted_price")


@query("full_name")
def q_full_name(spark, sf_dir):
    """Blank-safe full name, including rows where one or both parts are missing."""
    c = dt.table(spark, sf_dir, "customer")
    first = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    last = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))
    return c.select("c_custkey", full_name(first, last).alias("full_name"))


@query("email_normalise")
def q_email_normalise(spark, sf_dir):
    c = _silver(spark, sf_dir, "customers")
    return c.select("customer_id", email_normalise("email").alias("email"))


@query("age_band")
def q_age_band(spark, sf_dir):
    c = _silver(spark, sf_dir, "customers")
    return c.select("customer_id", "age", age_band("age").alias("age_band"))


@query("discount_amount")
def q_discount_amount(spark, sf_dir):
    v = _silver(spark, sf_dir, "sales")
    return v.select("cart_id", "product_id", "gross_amount", "net_amount", "discount_amount")


@query("stamp_load_date")
def q_stamp_load_date(spark, sf_dir):
    """Carts land with a source date on some days only: missing -> the run date."""
    v = dt.sales_lines(spark, sf_dir)
    v = v.withColumn("_src", F.when(F.col("customer_id") % 2 == 0,
                                    F.col("sale_date").cast("string"))).drop("sale_date")
    stamped = carts.enrich_sales(v, dt.RUN_DATE, lenient_date(F.col("_src")))
    return stamped.select("cart_id", "product_id", "sale_date",
                          F.lit(dt.RUN_DATE).cast("date").alias("load_date"))


@query("stock_snapshot")
def q_stock_snapshot(spark, sf_dir):
    return _silver(spark, sf_dir, "stock")


@query("warehouse_types")
def q_warehouse_types(spark, sf_dir):
    """Coercion into table types: decimals, and integers rounded half away from zero."""
    h = _hist(spark, sf_dir, "products")
    p = _silver(spark, sf_dir, "products")
    half = p.select("product_id", to_int_rounded(F.col("price") / 100 + 0.5).alias("price_hundreds"))
    return h.select("product_id", "price", "discount_pct", "discounted_price", "rating",
                    "stock").join(half, "product_id")


# ── 4.x arrays, JSON, de-duplication ────────────────────────────────────────
@query("explode_cart_lines")
def q_explode_cart_lines(spark, sf_dir):
    """Nested carts (JSON text) exploded to one row per line, with its position."""
    c = dt.cart_records(spark, sf_dir).select("id", "userId", F.to_json("products").alias("products"))
    lines = carts.explode_cart_lines(c)
    return lines.select("cart_id", "customer_id", "line_pos",
                        F.col("product_id").cast("long").alias("product_id"),
                        F.col("quantity").cast("int").alias("quantity"),
                        F.col("price").cast("double").alias("price"),
                        F.col("net_amount").cast("double").alias("net_amount"))


@query("json_field_extract")
def q_json_field_extract(spark, sf_dir):
    """Nested field by path; an absent field is null."""
    e = dt.table(spark, sf_dir, "events")
    return e.select("event_id", carts.json_field("props", "$.k").cast("long").alias("k"),
                    carts.json_field("props", "$.missing").alias("missing"))


@query("dedup_keep_last")
def q_dedup_keep_last(spark, sf_dir):
    """Sales lines de-duplicated on (cart, product), keeping the last line of the cart."""
    return _silver(spark, sf_dir, "sales")


@query("duplicate_count")
def q_duplicate_count(spark, sf_dir):
    return dedup.duplicate_count(dt.sales_lines(spark, sf_dir), config.KEYS["sales"])


@query("key_uniqueness")
def q_key_uniqueness(spark, sf_dir):
    """Keys an upsert source would hit twice."""
    return dedup.key_violations(dt.sales_lines(spark, sf_dir), config.KEYS["sales"])


# ── 5.x rules and the gate ───────────────────────────────────────────────────
@query("rule_required")
def q_rule_required(spark, sf_dir):
    c = _silver(spark, sf_dir, "customers")
    return c.select("customer_id", quality.rule_required(
        ["customer_id", "last_name", "email"]).alias("invalid"))


@query("rule_sales")
def q_rule_sales(spark, sf_dir):
    """Sales rule; every 11th cart has a quantity of zero and every 13th product a negative price."""
    v = (_silver(spark, sf_dir, "sales")
         .withColumn("quantity", F.when(F.col("cart_id") % 11 == 0, F.lit(0)).otherwise(F.col("quantity")))
         .withColumn("price", F.when(F.col("product_id") % 13 == 0, -F.col("price")).otherwise(F.col("price"))))
    return v.select("cart_id", "product_id", quality.invalid_flag("sales").alias("invalid"))


@query("rule_products")
def q_rule_products(spark, sf_dir):
    """Product rule; every 13th product has a negative price, every 17th none."""
    p = _silver(spark, sf_dir, "products")
    p = p.withColumn("price", F.when(F.col("product_id") % 17 == 0, None)
                     .when(F.col("product_id") % 13 == 0, -F.col("price")).otherwise(F.col("price")))
    return p.select("product_id", quality.invalid_flag("products").alias("invalid"))


@query("rule_stock")
def q_rule_stock(spark, sf_dir):
    """Stock rule; every 13th product has a negative quantity, every 17th a quantity of zero (allowed)."""
    s = _silver(spark, sf_dir, "stock")
    s = s.withColumn("quantity", F.when(F.col("product_id") % 13 == 0, -F.col("quantity"))
                     .when(F.col("product_id") % 17 == 0, F.lit(0)).otherwise(F.col("quantity")))
    return s.select("product_id", quality.invalid_flag("stock").alias("invalid"))


@query("rule_customers")
def q_rule_customers(spark, sf_dir):
    c = _silver(spark, sf_dir, "customers")
    return c.select("customer_id", "email", quality.invalid_flag("customers").alias("invalid"))


@query("quality_split_valid")
def q_quality_split_valid(spark, sf_dir):
    valid, _ = quality.split(quality.tag(_silver(spark, sf_dir, "customers"), "customers"))
    return valid


@query("quality_split_rejects")
def q_quality_split_rejects(spark, sf_dir):
    _, rejects = quality.split(quality.tag(_silver(spark, sf_dir, "customers"), "customers"))
    return rejects


@query("quality_gate")
def q_quality_gate(spark, sf_dir):
    """Reject rate per entity and whether the gate passes (rate not above the limit)."""
    limit = config.DEFAULT_REJECT_LIMIT
    parts = []
    for entity in config.ENTITIES:
        stats = quality.gate_stats(quality.tag(_silver(spark, sf_dir, entity), entity))
        parts.append(stats.select(F.lit(entity).alias("entity"), "n_total", "n_rejected",
                                  "reject_rate", (F.col("reject_rate") <= limit).alias("passed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ── 6.x loads, upserts, dimensions ───────────────────────────────────────────
@query("history_day_load")
def q_history_day_load(spark, sf_dir):
    """Load day 1, day 2, then day 1 again: no duplicates, day 2 untouched."""
    root = scratch_path(spark, "history")
    for day in (1, 2, 1):
        history.load_day(spark, _silver(spark, sf_dir, "products", day).where(
            ~quality.invalid_flag("products")), root, "products", dt.day_date(day),
            scenario.source_key("products", day), scenario.loaded_at(day))
    return history.read_history(spark, root, "products")


@query("align_columns")
def q_align_columns(spark, sf_dir):
    """Extra source columns dropped, a missing target column added as null, types cast."""
    p = _silver(spark, sf_dir, "products").drop("rating").withColumn("tags", F.array(F.lit("x")))
    return history.align_for_history(p, "products", dt.RUN_DATE,
                                     scenario.source_key("products", None), scenario.loaded_at(None))


def _dim_source(spark, sf_dir, name, day):
    h = _hist(spark, sf_dir, "products", day)
    if name == "product":
        return h.select("product_id", "product_name", "category", "brand", "sku",
                        F.col("price").alias("current_price"))
    if name == "customer":
        c = _hist(spark, sf_dir, "customers", day)
        return c.select("customer_id", "full_name", "email", "gender", "age_band", "city",
                        "state", "state_code", "country")
    if name == "category":
        return marts.category_counts(h)
    return marts.brand_counts(h)


def _dim_two_days(spark, sf_dir, name) -> DataFrame:
    from shelfline.plans.pipeline import DIM_SPECS
    schema, keys, sk = DIM_SPECS[name]
    values = [f.name for f in schema.fields if f.name not in (*keys, sk, "updated_at")]
    root = scratch_path(spark, f"dim-{name}")
    for day in (1, 2):
        current = L.read_snapshot(spark, root, schema)
        new_state = conform.align_to_schema(
            upsert.scd1_upsert(current, _dim_source(spark, sf_dir, name, day), keys, sk, values,
                               stamp=scenario.loaded_at(day)), schema)
        L.write_snapshot(spark, new_state, root)
    return L.read_snapshot(spark, root, schema)


@query("dim_product_upsert")
def q_dim_product_upsert(spark, sf_dir):
    return _dim_two_days(spark, sf_dir, "product")


@query("dim_customer_upsert")
def q_dim_customer_upsert(spark, sf_dir):
    return _dim_two_days(spark, sf_dir, "customer")


@query("dim_category_upsert")
def q_dim_category_upsert(spark, sf_dir):
    return _dim_two_days(spark, sf_dir, "category")


@query("dim_brand_upsert")
def q_dim_brand_upsert(spark, sf_dir):
    return _dim_two_days(spark, sf_dir, "brand")


def _consolidated(spark, sf_dir, day, landed=None):
    return conform.align_to_schema(marts.consolidate_sales(
        _hist(spark, sf_dir, "sales", day, landed), _hist(spark, sf_dir, "products", day),
        _hist(spark, sf_dir, "customers", day), dt.day_date(day)), schemas.FACT_SALES)


FACT_WIDTH = 4096   # small cart ranges so the benchmark tables span many fact partitions


def _fact_upsert_day(spark, root, batch):
    from shelfline.plans.pipeline import FACT_BUCKET
    return upsert.upsert_key_ranges(spark, root, batch, schemas.FACT_KEYS, schemas.FACT_SALES,
                                    FACT_BUCKET, upsert.key_range("cart_id", FACT_WIDTH),
                                    staging=f"{root}_staging")


@query("fact_upsert")
def q_fact_upsert(spark, sf_dir):
    """Fact after the day 1 and day 2 batches: re-landed carts take day 2's row."""
    from shelfline.plans.pipeline import read_fact_table
    root, lines = scratch_path(spark, "fact"), _landed(spark, sf_dir)
    for day in (1, 2):
        _fact_upsert_day(spark, root, _consolidated(spark, sf_dir, day, lines))
    return read_fact_table(spark, root)


@query("calendar_range")
def q_calendar_range(spark, sf_dir):
    fact = _hist(spark, sf_dir, "sales")
    return calendar.calendar_range(spark, fact, dt.RUN_DATE)


@query("calendar_attributes")
def q_calendar_attributes(spark, sf_dir):
    fact = _hist(spark, sf_dir, "sales")
    return calendar.calendar_dimension(calendar.calendar_range(spark, fact, dt.RUN_DATE))


@query("calendar_insert_missing")
def q_calendar_insert_missing(spark, sf_dir):
    """Calendar after day 1 and day 2: day 2 inserts only the dates it lacks."""
    root = scratch_path(spark, "dim-date")
    for day in (1, 2):
        current = L.read_snapshot(spark, root, schemas.DIM_DATE)
        dates = calendar.calendar_range(spark, _hist(spark, sf_dir, "sales", day), dt.day_date(day))
        missing = upsert.insert_missing(current, calendar.calendar_dimension(dates), ["date_sk"])
        L.write_snapshot(spark, current.unionByName(
            conform.align_to_schema(missing, schemas.DIM_DATE)), root)
    return L.read_snapshot(spark, root, schemas.DIM_DATE)


# ── 7.x joins ────────────────────────────────────────────────────────────────
@query("sales_consolidated")
def q_sales_consolidated(spark, sf_dir):
    """Flagship: a day's sales with that day's product and customer attributes."""
    sales = _hist(spark, sf_dir, "sales")
    products = _hist(spark, sf_dir, "products")
    customers = _hist(spark, sf_dir, "customers")
    return marts.consolidate_sales(sales, products, customers, dt.RUN_DATE)


def _both_days(spark, sf_dir, entity):
    return _hist(spark, sf_dir, entity, 1).unionByName(_hist(spark, sf_dir, entity, 2))


@query("sales_join_products")
def q_sales_join_products(spark, sf_dir):
    """Sales of both days left-joined to their day's products (some vanished on day 2)."""
    v = _both_days(spark, sf_dir, "sales")
    p = _both_days(spark, sf_dir, "products").select("product_id", "load_date", "category", "brand")
    return v.join(p, ["product_id", "load_date"], "left").select(
        "cart_id", "product_id", "load_date", "category", "brand")


@query("sales_join_customers")
def q_sales_join_customers(spark, sf_dir):
    """Sales of both days left-joined to their day's customers."""
    v = _both_days(spark, sf_dir, "sales")
    c = _both_days(spark, sf_dir, "customers").select(
        "customer_id", "load_date", F.col("full_name").alias("customer_name"), "city")
    return v.join(c, ["customer_id", "load_date"], "left").select(
        "cart_id", "product_id", "load_date", "customer_id", "customer_name", "city")


@query("join_completeness")
def q_join_completeness(spark, sf_dir):
    out = []
    for day in (None, 2):
        s = marts.join_completeness(_consolidated(spark, sf_dir, day) if day else
                                    q_sales_consolidated(spark, sf_dir))
        out.append(s.select(F.lit(dt.day_date(day)).cast("date").alias("load_date"), "*"))
    return out[0].unionByName(out[1])


# ── 8.x aggregations ─────────────────────────────────────────────────────────
@query("category_counts")
def q_category_counts(spark, sf_dir):
    return marts.category_counts(_hist(spark, sf_dir, "products"), dt.RUN_DATE)


@query("brand_counts")
def q_brand_counts(spark, sf_dir):
    return marts.brand_counts(_hist(spark, sf_dir, "products"), dt.RUN_DATE)


@query("cart_totals")
def q_cart_totals(spark, sf_dir):
    return carts.cart_totals(dt.sales_lines(spark, sf_dir))


@query("audit_layer_counts")
def q_audit_layer_counts(spark, sf_dir):
    """Counts per layer for day 2 after loading two days; a missing table is reported."""
    lk = L.Lake(scratch_path(spark, "audit"))
    for entity in config.ENTITIES:
        for day in (1, 2):
            history.load_day(spark, _hist(spark, sf_dir, entity, day), lk.history(entity),
                             entity, dt.day_date(day), scenario.source_key(entity, day))
    ds = dt.day_date(2)
    loaders = {f"history_{e}": (lambda e=e: history.read_day(spark, lk.history(e), e, ds))
               for e in config.ENTITIES}
    loaders["missing_table"] = lambda: spark.read.parquet(lk.table("never_written"))
    counts = audit.layer_counts(spark, loaders)
    return spark.createDataFrame([(k, str(v)) for k, v in counts.items()], "layer string, value string")


@query("audit_record")
def q_audit_record(spark, sf_dir):
    """Run record with step results (row counts of the day's loads)."""
    results = {f"history_{e}": _hist(spark, sf_dir, e).count() for e in config.ENTITIES}
    rec = audit.run_record(spark, "retail_daily", "run-1", dt.RUN_DATE, results, {})
    return rec.select("pipeline", "run_id", "ds", "status", "steps")


# ── 9.x composition ──────────────────────────────────────────────────────────
def _pipeline_two_days(spark, sf_dir, days=(1, 2)):
    from shelfline.plans import pipeline as P
    root = scratch_path(spark, "pipeline")
    for day in days:
        records = {"products": dt.product_records(spark, sf_dir, day),
                   "customers": dt.customer_records(spark, sf_dir, day),
                   "carts": dt.cart_records(spark, sf_dir, day)}
        P.run_day(spark, root, dt.day_date(day), records=records, run_id=f"day-{day}",
                  fact_bucket_width=FACT_WIDTH, database=None)  # several lakes share the session's catalog
    return P, L.Lake(root)


@query("pipeline_end_to_end")
def q_pipeline_end_to_end(spark, sf_dir):
    """Two daily runs from landed JSON to the fact table."""
    P, lk = _pipeline_two_days(spark, sf_dir)
    # only the fact is returned: drop the day's intermediate layers from scratch
    for layer in ("raw", "bronze", "silver", "_staging"):
        L.delete(spark, f"{lk.root}/{layer}")
    return P.read_fact(spark, lk)


@query("rerun_idempotent")
def q_rerun_idempotent(spark, sf_dir):
    """Loads and fact upsert for day 1, day 2, day 2 again: same state as one run."""
    from shelfline.plans.pipeline import read_fact_table
    root = scratch_path(spark, "rerun")
    lk, lines = L.Lake(root), _landed(spark, sf_dir)
    for day in (1, 2, 2):
        ds = dt.day_date(day)
        for e in ("sales", "products", "customers"):
            history.load_day(spark, _hist(spark, sf_dir, e, day, lines), lk.history(e), e, ds,
                             scenario.source_key(e, day))
        batch = conform.align_to_schema(marts.consolidate_sales(
            history.read_day(spark, lk.history("sales"), "sales", ds),
            history.read_day(spark, lk.history("products"), "products", ds),
            history.read_day(spark, lk.history("customers"), "customers", ds), ds),
            schemas.FACT_SALES)
        _fact_upsert_day(spark, lk.table("fact_sales"), batch)
    return read_fact_table(spark, lk.table("fact_sales"))
