"""The daily run (9.5, 9.6): landed JSON -> bronze -> silver -> history -> fact -> dims -> audit.

Every stage is written to the lake and the next stage reads it back, so a lost
executor recomputes from the last written layer, never from the source, and
each step's plan is small.  Rerunning a day replaces that day everywhere and
upserts by key, so it never duplicates rows.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import config, schemas
from shelfline.functions import (age_band, discounted_price, email_normalise, full_name,
                                 lenient_date)
from shelfline.operators import audit, calendar, carts, conform, history, marts, quality, upsert
from shelfline.operators.dedup import keep_last
from shelfline.sinks import lake as L
from shelfline.sources.envelope import read_raw_json

log = logging.getLogger(__name__)

PIPELINE = "retail_daily"
PARALLEL_JOBS = 4   # independent per-entity jobs submitted together from driver threads


def _parallel(fn, items, workers: int = PARALLEL_JOBS, done=None) -> list:
    """Run ``fn`` over independent items from driver threads; Spark schedules the
    jobs side by side.  Results keep the items' order; the first error is raised
    after every item has finished.  ``done(item, result)`` is called for each item
    that succeeds, whatever becomes of the others."""
    items = list(items)
    if done is not None:
        run = fn

        def fn(x):
            result = run(x)
            done(x, result)
            return result
    if workers <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(workers, len(items))) as pool:
        futures = [pool.submit(fn, x) for x in items]
        errors = [f.exception() for f in futures]
    for e in errors:
        if e is not None:
            raise e
    return [f.result() for f in futures]
RAW_ENTITIES = {"products": "products", "customers": "customers", "carts": "sales"}
DIMENSIONS = ["product", "customer", "date", "category", "brand"]


# ── 01 landing ───────────────────────────────────────────────────────────────
def land(lk: L.Lake, records: dict[str, DataFrame], ds: str) -> dict[str, str]:
    """Write each entity's records as JSON Lines under ``raw/<entity>/dt=<ds>``.

    Customers keep only the allowed source fields, whichever way they come in.  An entity without
    records is refused, as an envelope with an empty list is; its rows are counted by the job that
    writes them, and take the day's place only then, so the day keeps what it had.
    """
    if "customers" in records:
        people = records["customers"]
        allowed = [c for c in people.columns if c in config.CUSTOMER_SOURCE_FIELDS]
        records = {**records, "customers": people.select(*allowed)}
    spark = next(iter(records.values())).sparkSession if records else None
    out = {}
    for entity, df in records.items():
        observed, obs = L.counted(df)
        staged = L.land_json(observed, lk.raw(f"_incoming/{entity}"), ds)
        if not int(obs.get["n_rows"]):
            L.delete(spark, staged)
            raise ValueError(f"{entity}: source returned an empty list")
        out[entity] = L.partition_dir(lk.raw(entity), ds)
        L.move_into(spark, staged, out[entity])
    return out


# ── 02 bronze ────────────────────────────────────────────────────────────────
def to_bronze(spark: SparkSession, lk: L.Lake, raw_paths: dict[str, str], ds: str,
              ingested_at: str) -> dict[str, str]:
    """Flatten one level, everything as text, lineage columns; write + catalogue."""
    def one(item):
        entity, path = item
        recs = read_raw_json(spark, path)
        flat = conform.flatten_one_level(
            recs.withColumnRenamed("source_file", "_source_file").withColumnRenamed("ord", "_ord"))
        flat = conform.add_lineage(flat, F.col("_source_file"), ingested_at)
        dest, n = L.write_day_counted(flat, lk.bronze(entity), ds)
        return entity, (entity, path, dest, n, list(flat.columns), ds)

    done = _parallel(one, raw_paths.items())
    out = {entity: row[2] for entity, row in done}
    catalogue = [row for _, row in done]
    cat = spark.createDataFrame(
        catalogue, "entity string, source string, destination string, n_rows long, "
                   "columns array<string>, dt string")
    L.write_day(cat.coalesce(1), lk.catalogue(), ds, fmt="json")
    return out


# ── 03 silver: clean, enrich, validate ───────────────────────────────────────
def _order(*cols):
    return F.struct(*[F.col(c) for c in cols])


_SOURCE_KEYS = {"products": ["id"], "customers": ["id"], "sales": ["id", "userId", "products"]}


def _ensure_source_columns(b: DataFrame, entity: str) -> DataFrame:
    """Key source fields must exist; on an empty day (no keys to discover) they are
    added as nulls so the day yields empty typed tables instead of failing."""
    missing = [c for c in _SOURCE_KEYS[entity] if c not in b.columns]
    if not missing:
        return b
    if not b.isEmpty():
        raise ValueError(f"{entity}: mandatory source fields missing {missing}")
    for c in missing:
        b = b.withColumn(c, F.lit(None).cast("string"))
    return b


def _stage(spark: SparkSession, df: DataFrame, path_root: str, ds: str, keep: bool) -> DataFrame:
    """Optionally write a silver stage for lineage and continue from the written copy."""
    if not keep:
        return df
    return spark.read.parquet(L.write_day(df, path_root, ds))


def _placed(b: DataFrame) -> DataFrame:
    """``_ord`` with one number for all but the row's position in its split: the place of the split in
    source order.  The order travels with every line, and would carry the name of its file through each
    sort and shuffle.  There is a row per split of the landed files, so they are numbered and broadcast.
    """
    parts = ["batch", "part", "file", "block"]
    t = b.schema["_ord"].dataType if "_ord" in b.columns else None
    if not isinstance(t, T.StructType) or t.fieldNames() != [*parts, "pos"]:
        return b
    # batch and part are read from the file's name
    splits = (b.select("_ord.*").groupBy("file", "block").agg(F.min("batch").alias("batch"), F.min("part").alias("part"))
              .withColumn("_place", F.row_number().over(Window.orderBy(*parts))))
    splits = splits.select(F.col("file").alias("_file"), F.col("block").alias("_block"), "_place")
    same = (F.col("_ord.file") == F.col("_file")) & (F.col("_ord.block") == F.col("_block"))
    return (b.join(F.broadcast(splits), same, "left")
            .withColumn("_ord", F.struct("_place", "_ord.pos")).drop("_file", "_block", "_place"))


def clean(spark: SparkSession, lk: L.Lake, bronze: dict[str, str], ds: str,
          keep_stages: bool = False) -> dict[str, DataFrame]:
    """Rename/explode, conform types, de-duplicate keep-last; one frame per entity."""
    out = {}
    for raw_entity, path in bronze.items():
        entity = RAW_ENTITIES[raw_entity]
        b = _placed(_ensure_source_columns(spark.read.parquet(path), entity))
        if entity == "sales":
            keep = tuple(c for c in ("date", "_source_file", "_ord") if c in b.columns)
            df = carts.explode_cart_lines(b, keep=keep)
            df = df.withColumn("_order", _order("_ord", "line_pos"))
            df = df.drop("_source_file", "_ord", "line_pos")
        else:
            df = conform.rename_allowlist(b, {**config.RENAME[entity],
                                              "_source_file": "_source_file", "_ord": "_ord"})
            df = df.withColumn("_order", _order("_ord")).drop("_source_file", "_ord")
        df = conform.conform_types(df)
        absent = [f for f in schemas.SILVER[entity].fields if f.name not in df.columns]
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}) if absent else df
        df = keep_last(df, config.KEYS[entity], "_order").drop("_order")
        out[entity] = _stage(spark, df, lk.silver("cleaned", entity), ds, keep_stages)
    return out


def enrich(spark: SparkSession, lk: L.Lake, cleaned: dict[str, DataFrame], ds: str,
           keep_stages: bool = False) -> dict[str, DataFrame]:
    """Derived columns, the stock snapshot and the load date.

    The products frame feeds both products and stock, so its stage is always written and both
    read that copy: products are de-duplicated once, and a lost executor repeats no part of it.
    """
    day = F.lit(ds).cast("date")
    p = cleaned["products"]
    if "discount_pct" not in p.columns:
        p = p.withColumn("discount_pct", F.lit(None).cast("double"))
    p = p.withColumn("discounted_price", discounted_price("price", "discount_pct"))
    p = _stage(spark, p.withColumn("load_date", day), lk.silver("enriched", "products"), ds, True)
    c = cleaned["customers"]
    for col in ("first_name", "last_name", "email"):
        if col not in c.columns:
            c = c.withColumn(col, F.lit(None).cast("string"))
    c = (c.withColumn("full_name", full_name("first_name", "last_name"))
          .withColumn("email", email_normalise("email"))
          .withColumn("age_band", age_band("age") if "age" in c.columns else F.lit(None).cast("string")))
    v = cleaned["sales"]
    src_date = lenient_date(F.col("date")) if "date" in v.columns else None
    v = carts.enrich_sales(v, ds, src_date)
    if "date" in v.columns:
        v = v.drop("date")
    s = p.select("product_id", F.col("stock").alias("quantity"), "price", "availability",
                 day.alias("reference_date"))
    rest = {e: _stage(spark, df.withColumn("load_date", day), lk.silver("enriched", e), ds, keep_stages)
            for e, df in {"customers": c, "sales": v, "stock": s}.items()}
    return {"products": p, **rest}


def validate(spark: SparkSession, lk: L.Lake, enriched: dict[str, DataFrame], ds: str,
             limit: float | None = None) -> dict[str, str]:
    """Rules per entity, one job each; rejects always replace the day's, valid rows after the gate."""
    def one(entity):
        dest = lk.silver("validated", entity)
        quality.validate_day(enriched[entity], entity, lk.silver("rejects", entity), dest,
                             lk.silver("split", entity), ds, limit)
        return entity, L.partition_dir(dest, ds)

    return dict(_parallel(one, ("products", "customers", "sales", "stock")))


# ── 04 history loads ─────────────────────────────────────────────────────────
def load_history(spark: SparkSession, lk: L.Lake, validated: dict[str, str], ds: str,
                 done=None) -> dict[str, int]:
    """Rows loaded per entity; ``done(entity, rows)`` is called as each load succeeds."""
    def one(item):
        e, p = item
        return e, history.load_day(spark, spark.read.parquet(p), lk.history(e), e, ds, p)

    return dict(_parallel(one, validated.items(), done=done and (lambda _, loaded: done(*loaded))))


# ── 05 fact ──────────────────────────────────────────────────────────────────
FACT_BUCKET = "cart_range"
FACT_BUCKET_WIDTH = 1 << 21   # carts per fact partition (~2M carts, about 1 GB)


def build_fact(spark: SparkSession, lk: L.Lake, ds: str, width: int = FACT_BUCKET_WIDTH) -> int:
    """Consolidate the day from history and upsert it by (cart, product).

    Only the cart-key ranges present in the day's batch are rewritten.
    Returns the rows of the day's batch (observed while checkpointing it).
    """
    sales = history.read_day(spark, lk.history("sales"), "sales", ds)
    products = history.read_day(spark, lk.history("products"), "products", ds)
    customers = history.read_day(spark, lk.history("customers"), "customers", ds)
    batch = conform.enforce_not_null(
        conform.align_to_schema(marts.consolidate_sales(sales, products, customers, ds), schemas.FACT_SALES),
        schemas.FACT_SALES, "fact_sales")
    batch, obs = L.counted(batch)
    upsert.upsert_key_ranges(spark, lk.table("fact_sales"), batch, schemas.FACT_KEYS,
                             schemas.FACT_SALES, FACT_BUCKET, upsert.key_range("cart_id", width),
                             staging=f"{lk.root}/_staging/fact_sales")
    return int(obs.get["n_rows"])


def read_fact(spark: SparkSession, lk: L.Lake) -> DataFrame:
    return read_fact_table(spark, lk.table("fact_sales"))


def read_fact_table(spark: SparkSession, root: str) -> DataFrame:
    return upsert.read_bucketed(spark, root, schemas.FACT_SALES, FACT_BUCKET).drop(FACT_BUCKET)


# ── 06 dimensions ────────────────────────────────────────────────────────────
DIM_SPECS = {
    "product": (schemas.DIM_PRODUCT, ["product_id"], "product_sk"),
    "customer": (schemas.DIM_CUSTOMER, ["customer_id"], "customer_sk"),
    "category": (schemas.DIM_CATEGORY, ["category"], "category_sk"),
    "brand": (schemas.DIM_BRAND, ["brand"], "brand_sk"),
}


def dimension_source(spark: SparkSession, lk: L.Lake, name: str, ds: str) -> DataFrame:
    products = history.read_day(spark, lk.history("products"), "products", ds)
    if name == "product":
        return products.select("product_id", "product_name", "category", "brand", "sku",
                               F.col("price").alias("current_price"))
    if name == "customer":
        c = history.read_day(spark, lk.history("customers"), "customers", ds)
        return c.select("customer_id", "full_name", "email", "gender", "age_band", "city",
                        "state", "state_code", "country")
    if name == "category":
        return marts.category_counts(products)
    if name == "brand":
        return marts.brand_counts(products)
    raise KeyError(name)


def read_dimension(spark: SparkSession, lk: L.Lake, name: str) -> DataFrame:
    schema = schemas.DIM_DATE if name == "date" else DIM_SPECS[name][0]
    return L.read_snapshot(spark, lk.table(f"dim_{name}"), schema)


def build_dimension(spark: SparkSession, lk: L.Lake, name: str, ds: str) -> int:
    root = lk.table(f"dim_{name}")
    current = read_dimension(spark, lk, name)
    if name == "date":
        # the fact's first date is kept with its placement: no row of it is read
        placed = upsert.read_placement(spark, lk.table("fact_sales"), FACT_BUCKET)
        dates = calendar.calendar_range(spark, placed, ds, date_col="first_date")
        missing = upsert.insert_missing(current, calendar.calendar_dimension(dates), ["date_sk"])
        new_state = current.unionByName(conform.align_to_schema(missing, schemas.DIM_DATE))
    else:
        schema, keys, sk = DIM_SPECS[name]
        values = [f.name for f in schema.fields if f.name not in (*keys, sk, "updated_at")]
        src = dimension_source(spark, lk, name, ds)
        # category and brand sources are group-by outputs: unique by construction
        new_state = conform.align_to_schema(
            upsert.scd1_upsert(current, src, keys, sk, values,
                               check_unique=name in ("product", "customer")), schema)
    checked = conform.enforce_not_null(new_state, schemas.DIM_DATE if name == "date" else schema, f"dim_{name}")
    return L.write_snapshot(spark, checked, root)


# ── 07 audit ─────────────────────────────────────────────────────────────────
def audit_counts(spark: SparkSession, lk: L.Lake, ds: str) -> dict:
    """Rows per layer for the day (history partitions, fact rows of the day, dimensions).

    The fact's count is that of its rows (after a rerun it can hold rows of the day that
    the last batch no longer has), kept per load day with its placement.
    """
    loaders = {f"history_{e}": (lambda e=e: history.read_day(spark, lk.history(e), e, ds)
                                if L.exists(spark, lk.history(e)) else _missing(lk.history(e)))
               for e in config.ENTITIES}
    placed = lambda: upsert.read_placement(spark, lk.table("fact_sales"), FACT_BUCKET)
    loaders["fact_sales"] = lambda: (placed().where(F.col("load_date") == F.lit(ds).cast("date")),
                                     F.coalesce(F.sum("n_rows"), F.lit(0)))
    loaders["dim_product"] = lambda: read_dimension(spark, lk, "product")
    loaders["dim_customer"] = lambda: read_dimension(spark, lk, "customer")
    return audit.layer_counts(spark, loaders)


def _missing(path):
    raise FileNotFoundError(path)


def record_run(spark: SparkSession, lk: L.Lake, ds: str, run_id: str, results: dict) -> str:
    lineage = audit_counts(spark, lk, ds)
    status, failed = audit.run_status(results)
    L.append(audit.run_record(spark, PIPELINE, run_id, ds, results, lineage), lk.audit())
    log.info("run %s of %s recorded as %s, rows per layer %s", run_id, ds, status, lineage)
    if failed:
        raise RuntimeError(f"run {run_id}: no result from {', '.join(failed)}")
    return status


# ── the run ──────────────────────────────────────────────────────────────────
def run_day(spark: SparkSession, lake_root: str, ds: str, records: dict[str, DataFrame] | None = None,
            raw_paths: dict[str, str] | None = None, run_id: str | None = None,
            limit: float | None = None, fact_bucket_width: int = FACT_BUCKET_WIDTH,
            keep_stages: bool = False, database: str | None = "retail") -> dict:
    """Run one day end to end; the audit record is appended whatever happens.

    ``database``: where the run registers its tables in the session catalog and points them at
    the new state afterwards (None: not at all).  Raw, bronze, enriched products, rejects, validated
    silver and the warehouse tables are always written; ``keep_stages`` also writes the other cleaned
    and enriched silver stages (lineage only: the run chains them lazily otherwise).
    """
    from shelfline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    lk = L.Lake(lake_root)
    run_id = run_id or f"run-{uuid.uuid4().hex[:8]}"
    ingested_at = _dt.datetime.now(_dt.timezone.utc).isoformat()
    steps = ["landing", "bronze", "clean", "enrich", "validate"] + \
            [f"history_{e}" for e in config.ENTITIES] + ["fact"] + [f"dim_{d}" for d in DIMENSIONS]
    results: dict[str, object] = {s: None for s in steps}
    error: BaseException | None = None
    try:
        raw = raw_paths or land(lk, records or {}, ds)
        results["landing"] = raw
        bronze = to_bronze(spark, lk, raw, ds, ingested_at)
        results["bronze"] = bronze
        cleaned = clean(spark, lk, bronze, ds, keep_stages)
        results["clean"] = sorted(cleaned)
        enriched = enrich(spark, lk, cleaned, ds, keep_stages)
        results["enrich"] = sorted(enriched)
        validated = validate(spark, lk, enriched, ds, limit)
        results["validate"] = validated
        load_history(spark, lk, validated, ds, lambda e, n: results.update({f"history_{e}": n}))
        results["fact"] = build_fact(spark, lk, ds, fact_bucket_width)
        # the four keyed dimensions are independent; the calendar reads the fact
        keyed = [d for d in DIMENSIONS if d != "date"]
        _parallel(lambda d: build_dimension(spark, lk, d, ds), keyed,
                  done=lambda d, n: results.update({f"dim_{d}": n}))
        results["dim_date"] = build_dimension(spark, lk, "date", ds)
    except BaseException as exc:  # noqa: BLE001 - audit runs whatever failed
        error = exc
    try:
        record_run(spark, lk, ds, run_id, results)
        if database is not None and error is None:
            from shelfline.sinks import catalog
            catalog.register_tables(spark, lake_root, database)
    except Exception:  # noqa: BLE001 - the failure of the run itself comes first
        if error is None:
            raise
        log.exception("audit of the failed run %s", run_id)
    if error is not None:
        raise error
    return results


# ── landing from source envelopes (transport is out of scope) ────────────────
def land_envelopes(spark: SparkSession, lake_root: str, documents: dict[str, str], ds: str,
                   whole_file: bool = True) -> dict[str, str]:
    """Envelope documents per entity -> checked records -> raw JSON Lines for the day.

    ``documents`` maps an entity (``products``, ``customers``, ``carts``) to a
    file or directory of envelope documents.  Customers keep only the allowed
    source fields before anything is written.
    """
    from shelfline.sources import envelope as env
    lk = L.Lake(lake_root)
    out = {}
    for entity, path in documents.items():
        key = config.ENVELOPE_KEYS[entity]
        docs = env.read_envelope_files(spark, path, whole_file)
        env.assert_envelopes(env.envelope_check(docs, key), entity)
        recs = env.envelope_records(docs, key)
        if entity == "customers":
            recs = env.privacy_projection(recs, config.CUSTOMER_SOURCE_FIELDS)
        dest = L.partition_dir(lk.raw(entity), ds)
        env.in_source_order(recs).select("record").write.mode("overwrite").text(dest)
        out[entity] = dest
    return out
