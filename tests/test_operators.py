"""Operator edge cases the reference leaves untested (see FIXTURES.md)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import config, schemas
from shelfline.functions import (age_band, full_name, lenient_date, lenient_double,
                                 lenient_long, trim_blank_null)
from shelfline.operators import (audit, calendar, carts, conform, dedup, history, quality,
                                 upsert)
from shelfline.plans import pipeline
from shelfline.sinks import lake as L
from shelfline.sources import envelope as env


# ── conforming ───────────────────────────────────────────────────────────────
def test_trim_blank_null(spark):
    rows = [("\tabc\n",), (" x y ",), ("   ",), ("\t\n",), ("",), (None,), ("a",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(trim_blank_null("s")).collect()]
    assert got == ["abc", "x y", None, None, None, None, "a"]


def test_lenient_numbers(spark):
    rows = [("1d",), ("nan",), ("1e3",), ("1,5",), ("1.0",), ("1.5",), (" -2 ",), ("0x1F",),
            ("inf",), (".5",), ("",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [(r[0], r[1]) for r in df.select(lenient_double("s"), lenient_long("s")).collect()]
    assert got == [(None, None), (None, None), (1000.0, 1000), (None, None), (1.0, 1),
                   (1.5, None), (-2.0, -2), (None, None), (float("inf"), None), (0.5, None),
                   (None, None), (None, None)]


def test_lenient_dates(spark):
    rows = [("10/05/1990",), ("Oct 5, 1990",), ("1990-1-5",), ("2025-10-09T14:47:01.588Z",),
            ("junk",), ("",), ("October 5, 1990",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(lenient_date("s")).collect()]
    assert got == [dt.date(1990, 10, 5), dt.date(1990, 10, 5), dt.date(1990, 1, 5),
                   dt.date(2025, 10, 9), None, None, dt.date(1990, 10, 5), None]


def test_full_name_and_age_band(spark):
    rows = [("Ann", "Lee", None), (None, "Lee", 17), ("Ann", None, 24), (None, None, 25),
            ("Bo", "X", 59), ("Cy", "Y", 60)]
    df = spark.createDataFrame(rows, "f string, l string, age int")
    got = [tuple(r) for r in df.select(full_name("f", "l"), age_band("age")).collect()]
    assert got == [("Ann Lee", None), ("Lee", "18-24"), ("Ann", "18-24"), ("", "25-34"),
                   ("Bo X", "45-59"), ("Cy Y", "60+")]


def test_flatten_one_level_and_privacy(spark):
    recs = [json.dumps({"id": 1, "a": {"b": 1.50, "c": {"d": 2}}, "s": "{not an object}",
                        "arr": [1, 2], "password": "x"}),
            json.dumps({"id": 2, "a": {"b": 3}, "n": None})]
    df = spark.createDataFrame([(r,) for r in recs], "record string")
    kept = env.privacy_projection(df, ["id", "a", "s", "arr", "n"])
    flat = conform.flatten_one_level(kept)
    assert "password" not in flat.columns
    assert set(flat.columns) == {"id", "a.b", "a.c", "s", "arr", "n"}
    r = {row["id"]: row for row in flat.collect()}
    assert r["1"]["a.b"] == "1.5" and r["1"]["a.c"] == '{"d":2}'
    assert r["1"]["s"] == "{not an object}" and r["1"]["arr"] == "[1,2]"
    assert r["2"]["a.c"] is None and r["2"]["n"] is None


def test_keys_beyond_the_bounds_stay_json(spark):
    """100,000 keys that are data: as children of one key, and as keys of the records."""
    n = F.col("id").cast("string")
    nested = spark.range(100_000).select(F.concat(
        F.lit('{"id": '), n, F.lit(', "dims": {"h": 1, "w": '), n, F.lit('}, "prices": {"p'), n,
        F.lit('": 3}}')).alias("record"))
    keys = conform.discover_keys(nested)
    assert keys == [("id", None), ("dims", "h"), ("dims", "w"), ("prices", conform.WHOLE)]
    row = conform.flatten_one_level(nested, keys).where(F.col("id") == "77777").first()
    assert row.asDict() == {"id": "77777", "dims.h": "1", "dims.w": "77777", "prices": '{"p77777":3}'}

    loose = spark.range(100_000).select(F.concat(
        F.lit('{"id": '), n, F.lit(', "k'), n, F.lit('": {"x": '), n, F.lit("}}")).alias("record"))
    keys = conform.discover_keys(loose)
    assert len(keys) == conform.MAX_COLUMNS and keys[0] == ("id", None) and keys[-1] == conform.OTHERS
    flat = conform.flatten_one_level(loose, keys)
    named = {k for k, _ in keys if k}
    lost = next(i for i in range(99_999, 0, -1) if f"k{i}" not in named)
    assert flat.where(F.col("id") == str(lost)).first()[conform.REST] == f'{{"k{lost}":{{"x":{lost}}}}}'
    assert flat.where(F.col(conform.REST).isNotNull()).count() == 100_000 - (len(named) - 1)


def test_bounds_take_the_most_held_keys_first(spark):
    recs = [json.dumps({"a": 1, "o": {"x": 1, "y": 2}, "b": 2, f"r{i}": i}) for i in range(4)]
    df = spark.createDataFrame([(r,) for r in recs], "record string")
    assert len(conform.discover_keys(df, max_columns=8)) == 8           # everything fits
    assert conform.discover_keys(df, max_columns=5) == [("a", None), ("o", "x"), ("o", "y"), ("b", None),
                                                        conform.OTHERS]
    assert conform.discover_keys(df, max_columns=5, max_children=1) == [
        ("a", None), ("o", conform.WHOLE), ("b", None), ("r0", None), conform.OTHERS]
    rest = conform.flatten_one_level(df, conform.discover_keys(df, max_columns=4))
    assert rest.columns == ["a", "o", "b", "_rest"] or rest.columns == ["a", "o.x", "o.y", "_rest"]
    assert all(r["_rest"] for r in rest.collect())
    assert conform.discover_keys(df.limit(0)) == []


def test_schema_drift(spark):
    df = spark.createDataFrame([(1, "x", "extra")], "product_id long, product_name string, junk string")
    out = conform.align_to_schema(df, schemas.HISTORY["products"],
                                  defaults={"load_date": F.lit("2026-01-01").cast("date")})
    assert out.columns == [f.name for f in schemas.HISTORY["products"].fields]
    row = out.first()
    assert row["price"] is None and row["product_name"] == "x"
    with pytest.raises(ValueError, match="mandatory columns missing"):
        quality.require_columns(df, "products")


def test_int_coercion_rounds_half_away(spark):
    df = spark.createDataFrame([(30.5,), (30.4,), (-2.5,)], "quantity double")
    out = conform.align_to_schema(df, T.StructType([T.StructField("quantity", T.IntegerType())]))
    assert [r[0] for r in out.collect()] == [31, 30, -3]


# ── envelopes and carts ──────────────────────────────────────────────────────
def _docs(spark, texts):
    return spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)],
                                 "source_file string, value string")


def test_envelope_checks(spark):
    ok = _docs(spark, [json.dumps({"products": [{"id": 1}, {"id": 2}]})])
    env.assert_envelopes(env.envelope_check(ok, "products"), "products")
    recs = env.envelope_records(ok, "products").collect()
    assert [r["ord"] for r in recs] == [0, 1]
    for text, msg in [(json.dumps({"other": []}), "without the expected list"),
                      (json.dumps({"products": []}), "empty list"),
                      (json.dumps({"products": [{"id": 1}, 5]}), "not JSON objects")]:
        with pytest.raises(ValueError, match=msg):
            env.assert_envelopes(env.envelope_check(_docs(spark, [text]), "products"), "products")


def test_landing_refuses_an_entity_without_records(spark, tmp_lake):
    lk, df = L.Lake(tmp_lake), spark.createDataFrame([(1, "a"), (2, "b")], "id long, title string")
    path = pipeline.land(lk, {"products": df}, "2026-01-01")["products"]
    assert path == L.partition_dir(lk.raw("products"), "2026-01-01")
    with pytest.raises(ValueError, match="products: source returned an empty list"):
        pipeline.land(lk, {"products": df.limit(0)}, "2026-01-01")
    assert spark.read.json(path).count() == 2           # the earlier landing stays
    pipeline.land(lk, {"products": df.limit(1)}, "2026-01-01")
    assert spark.read.json(path).count() == 1


def test_explode_cart_lines_null_and_empty(spark):
    rows = [(1, 10, json.dumps([{"id": 5, "quantity": 2, "price": 1.5, "total": 3.0,
                                  "discountPercentage": 0, "discountedTotal": 3.0}])),
            (2, 10, None), (3, 11, "[]"),
            (4, 12, json.dumps([{"id": 6}, {"id": 7, "title": "t"}]))]
    df = spark.createDataFrame(rows, "id long, userId long, products string")
    lines = carts.explode_cart_lines(df).orderBy("cart_id", "line_pos").collect()
    assert [(r["cart_id"], r["product_id"], r["line_pos"]) for r in lines] == \
        [(1, "5", 0), (4, "6", 0), (4, "7", 1)]
    assert lines[1]["product_name"] is None and lines[2]["product_name"] == "t"


# ── de-duplication and keys ──────────────────────────────────────────────────
def test_keep_last_with_null_keys(spark):
    rows = [(1, "a", 0), (1, "b", 1), (None, "c", 2), (None, "d", 3), (2, "e", 4)]
    df = spark.createDataFrame(rows, "k long, v string, ord long")
    got = sorted((r["k"] if r["k"] is not None else -1, r["v"])
                 for r in dedup.keep_last(df, ["k"], "ord").collect())
    assert got == [(-1, "d"), (1, "b"), (2, "e")]
    counts = dedup.duplicate_count(df, ["k"]).first()
    assert (counts["n_rows"], counts["n_duplicates"]) == (5, 2)


def test_upsert_source_with_repeated_key_fails(spark):
    target = spark.createDataFrame([(1, "x")], "k long, v string")
    source = spark.createDataFrame([(2, "y"), (2, "z")], "k long, v string")
    with pytest.raises(ValueError, match="not unique"):
        upsert.replace_by_key(target, source, ["k"])


# ── quality gate ─────────────────────────────────────────────────────────────
def _customers(spark, n, bad):
    rows = [(i, f"N{i}", "a@b" if i >= bad else "no-at") for i in range(n)]
    return spark.createDataFrame(rows, "customer_id long, first_name string, email string")


def test_gate_edges(spark, tmp_lake):
    written = {}

    def sink(name):
        return lambda df: written.__setitem__(name, df.count())

    _, res = quality.validate(_customers(spark, 100, 5), "customers", 0.05,
                              write_rejects=sink("rej"), write_valid=sink("ok"))
    assert res.passed and written == {"rej": 5, "ok": 95}
    written.clear()
    with pytest.raises(ValueError, match="reject rate"):
        quality.validate(_customers(spark, 100, 6), "customers", 0.05,
                         write_rejects=sink("rej"), write_valid=sink("ok"))
    assert written == {"rej": 6}        # rejects saved, valid rows not


def test_rerun_without_rejects_replaces_stale_rejects(spark, tmp_lake):
    lk = L.Lake(tmp_lake)
    for bad in (3, 0):
        quality.validate(_customers(spark, 100, bad), "customers", 0.05,
                         write_rejects=lambda r: L.write_day(r, lk.silver("rejects", "c"), "d"),
                         write_valid=lambda v: L.write_day(v, lk.silver("validated", "c"), "d"))
    assert spark.read.parquet(L.partition_dir(lk.silver("rejects", "c"), "d")).count() == 0


def test_one_job_gate_publishes_both_sides(spark, tmp_lake):
    lk, jobs = L.Lake(tmp_lake), spark.sparkContext.statusTracker()
    paths = [lk.silver(s, "c") for s in ("rejects", "validated", "split")]

    def run(n, bad):
        return quality.validate_day(_customers(spark, n, bad), "customers", *paths, "d", 0.05)

    def rows(k):
        return spark.read.parquet(L.partition_dir(paths[k], "d")).count()

    spark.sparkContext.setJobGroup("gate", "gate")
    try:
        res = run(100, 5)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert res.passed and (rows(0), rows(1)) == (5, 95)
    assert len(jobs.getJobIdsForGroup("gate")) == 1
    with pytest.raises(ValueError, match="reject rate"):
        run(100, 6)
    assert (rows(0), rows(1)) == (6, 95)       # new rejects, the earlier valid rows stay
    assert run(80, 0).passed and (rows(0), rows(1)) == (0, 80)
    assert run(0, 0).passed and (rows(0), rows(1)) == (0, 0)
    with pytest.raises(ValueError, match="reject rate"):
        run(3, 3)
    assert (rows(0), rows(1)) == (3, 0) and not L.list_dirs(spark, paths[2])
    assert "_invalid" not in spark.read.parquet(L.partition_dir(paths[0], "d")).columns


# ── loads and upserts ────────────────────────────────────────────────────────
def _products(spark, rows):
    return spark.createDataFrame(rows, "product_id long, product_name string, price double")


def test_history_day_load_empty_day_and_backfill(spark, tmp_lake):
    root = os.path.join(tmp_lake, "h")
    history.load_day(spark, _products(spark, [(1, "a", 1.0), (2, "b", 2.0)]), root, "products",
                     "2026-01-01", "s1")
    history.load_day(spark, _products(spark, [(1, "a2", 1.5), (3, "c", 3.0)]), root, "products",
                     "2026-01-02", "s2")
    # backfill of day 1 after day 2, then day 2 reloaded empty
    n = history.load_day(spark, _products(spark, [(1, "a", 1.0)]), root, "products",
                         "2026-01-01", "s1")
    assert n == 1
    assert history.load_day(spark, _products(spark, []), root, "products", "2026-01-02", "s2") == 0
    all_rows = history.read_history(spark, root, "products").collect()
    assert [(r["product_id"], str(r["load_date"])) for r in all_rows] == [(1, "2026-01-01")]


def test_scd1_across_days(spark):
    schema = schemas.DIM_PRODUCT
    values = ["product_name", "category", "brand", "sku", "current_price"]
    empty = spark.createDataFrame([], schema)

    day = lambda d: F.lit(f"2026-01-0{d}").cast("timestamp")

    def src(rows):
        return spark.createDataFrame(
            rows, "product_id long, product_name string, category string, brand string, "
                  "sku string, current_price decimal(14,2)")
    d1 = upsert.scd1_upsert(empty, src([(3, "c", "x", None, "s3", None), (1, "a", "x", "b", "s1", None)]),
                            ["product_id"], "product_sk", values, stamp=day(1))
    d1 = spark.createDataFrame(d1.collect(), d1.schema)
    assert sorted((r["product_id"], r["product_sk"]) for r in d1.collect()) == [(1, 1), (3, 2)]
    # day 2: key 1 changes, key 3 absent (kept), key 2 new
    d2 = upsert.scd1_upsert(d1, src([(1, "a2", "x", "b", "s1", None), (2, "n", "y", None, "s2", None)]),
                            ["product_id"], "product_sk", values, stamp=day(2))
    got = sorted((r["product_id"], r["product_sk"], r["product_name"], str(r["updated_at"])[:10]) for r in d2.collect())
    assert got == [(1, 1, "a2", "2026-01-02"), (2, 3, "n", "2026-01-02"), (3, 2, "c", "2026-01-01")]
    # day 3: equal values keep their moment, nulls included; one join serves all rows
    d2 = spark.createDataFrame(d2.collect(), d2.schema)
    d3 = upsert.scd1_upsert(d2, src([(2, "n", "y", None, "s2", None), (3, "c", "x", None, None, None)]),
                            ["product_id"], "product_sk", values, stamp=day(3))
    assert sorted((r["product_id"], str(r["updated_at"])[:10]) for r in d3.collect()) == \
        [(1, "2026-01-02"), (2, "2026-01-02"), (3, "2026-01-03")]


def test_dates_with_zones_day_first_and_sept(spark):
    cases = {"13/05/1990": "1990-05-13", "13-05-1990": "1990-05-13", "05-06-1990": "1990-05-06", "5/6/1990": "1990-05-06",
             "2024-01-01T23:30:00-05:00": "2024-01-01", "1990-05-13T00:00:00+09:00": "1990-05-13",
             "2024-01-01 23:30:00": "2024-01-01", "Sept 5, 2001": "2001-09-05", "5 Sept 2001": "2001-09-05",
             "September 5, 2001": "2001-09-05", "Sep 5, 2001": "2001-09-05", "32/01/1990": None, "13/13/1990": None,
             "2024-01-01Tjunk": None, "2024-02-30T10:00:00Z": None, "Sept 31, 2001": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: r["d"] and str(r["d"]) for r in df.select("s", lenient_date("s").alias("d")).collect()}
    assert got == cases


def test_a_cart_with_most_lines_is_split_and_gives_the_same_rows(spark, tmp_lake):
    from shelfline.operators.dedup import keep_last
    from shelfline.plans import scenario
    from shelfline.sources import driver_tables
    hot = F.when(F.col("id") % 3 < 2, F.lit(7)).otherwise(F.col("id") % 5000)
    lines = spark.range(0, 60_000, 1, 8).select(
        hot.alias("l_orderkey"), (F.col("id") % 9001).alias("l_partkey"), (F.col("id") % 5).alias("l_suppkey"),
        (F.col("id") % 11).cast("int").alias("l_linenumber"), F.lit(2.0).alias("l_quantity"),
        (F.col("id") % 97 + 1.0).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit("1998-01-02").cast("timestamp_ntz").alias("l_shipdate"))
    orders = spark.range(0, 5000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"),
                                         F.lit("1998-01-01").cast("timestamp_ntz").alias("o_orderdate"))
    lines.write.parquet(f"{tmp_lake}/lineitem.parquet")
    orders.write.parquet(f"{tmp_lake}/orders.parquet")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = scenario.silver_sales(spark, tmp_lake)
        rows = sorted(map(str, got.collect()))
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    plain = keep_last(driver_tables.sales_lines(spark, tmp_lake), ["cart_id", "product_id"], "line_ord").drop("line_ord")
    plain = carts.enrich_sales(plain, driver_tables.day_date(None), F.col("sale_date")).withColumn(
        "load_date", F.lit(driver_tables.day_date(None)).cast("date"))
    assert rows == sorted(map(str, plain.select(*got.columns).collect()))


def test_old_snapshots_go_and_the_latest_stay(spark, tmp_lake):
    root = os.path.join(tmp_lake, "snap")
    for n in range(1, 6):
        assert L.write_snapshot(spark, spark.range(n), root) == n
    assert L.committed_versions(spark, root) == [3, 4, 5]
    assert L.read_snapshot(spark, root, T.StructType([T.StructField("id", T.LongType())])).count() == 5


def test_null_in_a_required_column_fails_the_load_and_keeps_the_day(spark, tmp_lake):
    root = os.path.join(tmp_lake, "history_stock")
    rows = lambda ids: spark.createDataFrame([(i, 5) for i in ids], "product_id long, quantity int").withColumn(
        "reference_date", F.lit("2026-01-01").cast("date"))
    history.load_day(spark, rows([1, 2]), root, "stock", "2026-01-01", "k")
    with pytest.raises(Exception, match="history_stock.product_id must not be null"):
        history.load_day(spark, rows([1, None, 3]), root, "stock", "2026-01-01", "k")
    kept = history.read_day(spark, root, "stock", "2026-01-01")
    assert sorted(r["product_id"] for r in kept.collect()) == [1, 2] and kept.where("loaded_at is null").count() == 0
    plan = conform.enforce_not_null(spark.range(3).withColumnRenamed("id", "product_id"),
                                    T.StructType([T.StructField("product_id", T.LongType(), False)]))
    assert "raise_error" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_surrogate_keys_are_dense_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7 % 5000).alias("k"))
    out = upsert.assign_surrogate_keys(df, ["k"], "sk", base=100)
    rows = out.orderBy("k").collect()
    assert [r["sk"] for r in rows] == list(range(101, 5101))


def test_key_range_upsert_backfill_wins(spark, tmp_lake):
    root = os.path.join(tmp_lake, "fact")
    schema = T.StructType([T.StructField("cart_id", T.LongType()),
                           T.StructField("product_id", T.LongType()),
                           T.StructField("v", T.StringType())])

    def up(rows):
        src = spark.createDataFrame(rows, schema)
        upsert.upsert_key_ranges(spark, root, src, ["cart_id", "product_id"], schema, "b",
                                 upsert.key_range("cart_id", 10), staging=root + "_stg")

    up([(1, 1, "d1"), (25, 1, "d1"), (40, 2, "d1")])
    up([(25, 1, "d2"), (26, 3, "d2")])          # touches bucket 2 only
    up([(1, 1, "d1b")])                          # backfill of an old key wins
    got = sorted(tuple(r) for r in upsert.read_bucketed(spark, root, schema, "b")
                 .drop("b").collect())
    assert got == [(1, 1, "d1b"), (25, 1, "d2"), (26, 3, "d2"), (40, 2, "d1")]


def test_key_range_upsert_lost_before_the_switch_keeps_every_row(spark, tmp_lake):
    root = os.path.join(tmp_lake, "fact")
    schema = T.StructType([T.StructField("cart_id", T.LongType()), T.StructField("product_id", T.LongType()),
                           T.StructField("sale_date", T.DateType()), T.StructField("load_date", T.DateType())])
    day = lambda d: dt.date(2026, 1, d)

    def up(rows, **more):
        return upsert.upsert_key_ranges(spark, root, spark.createDataFrame(rows, schema), ["cart_id", "product_id"], schema,
                                        "b", upsert.key_range("cart_id", 10), staging=root + "_stg", **more)

    def state():
        return sorted(tuple(r) for r in upsert.read_bucketed(spark, root, schema, "b").drop("b").collect())

    assert up([(1, 1, day(1), day(5)), (2, 1, day(2), day(5)), (25, 1, day(3), day(5))]) == 3
    before = state()

    def lost():
        raise RuntimeError("driver lost")

    # the merged ranges are written, the switch never comes: all rows of all days are there
    with pytest.raises(RuntimeError, match="driver lost"):
        up([(1, 1, day(4), day(6)), (99, 9, day(4), day(6))], before_switch=lost)
    assert state() == before
    assert up([(1, 1, day(4), day(6)), (99, 9, day(4), day(6))]) == 3
    after = [(1, 1, day(4), day(6)), (2, 1, day(2), day(5)), (25, 1, day(3), day(5)), (99, 9, day(4), day(6))]
    assert state() == after
    # counts and first dates are kept per load day, without the rows
    placed = {}
    for r in upsert.read_placement(spark, root, "b").collect():
        placed.setdefault(r["load_date"], []).append((r["n_rows"], r["first_date"]))
    assert {d: (sum(n for n, _ in v), min(f for _, f in v)) for d, v in placed.items()} == \
        {day(5): (2, day(2)), day(6): (2, day(4))}
    # folders that no kept placement lists go, and the rows stay
    for d in (7, 8, 9):
        up([(1, 1, day(d), day(d))])
    folders = [f for _, dirs, _ in os.walk(os.path.join(root, "rows")) for f in dirs if f == "b=0"]
    assert len(folders) <= 4 and state() == [(1, 1, day(9), day(9)), *after[1:]]
    with pytest.raises(ValueError, match="not unique"):
        up([(3, 1, day(1), day(1)), (3, 1, day(1), day(1))])


def test_key_range_upsert_reads_only_touched_folders(spark, tmp_lake):
    root = os.path.join(tmp_lake, "fact")
    schema = T.StructType([T.StructField("cart_id", T.LongType()), T.StructField("product_id", T.LongType())])
    src = spark.range(0, 100).selectExpr("id as cart_id", "id as product_id")
    upsert.upsert_key_ranges(spark, root, src, ["cart_id"], schema, "b", upsert.key_range("cart_id", 10), staging=root + "_stg")
    placement = upsert.read_placement(spark, root, "b").where("b in (2, 3)")
    rows = upsert._placed_rows(spark, root, schema, "b", placement)
    assert sorted(r[0] for r in rows.collect()) == list(range(20, 40))
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString().lower()


# ── calendar and audit ───────────────────────────────────────────────────────
def test_calendar_over_year_end(spark):
    fact = spark.createDataFrame([(dt.date(2025, 12, 25),)], "sale_date date")
    cal = calendar.calendar_dimension(calendar.calendar_range(spark, fact, "2026-01-07")).collect()
    assert len(cal) == 14
    assert {r["weekday_name"] for r in cal} == set(config.WEEKDAY_NAMES)
    first = cal[0]
    assert (first["date_sk"], first["month_name"], first["weekday"], first["is_weekend"]) == \
        (20251225, "dezembro", 4, False)
    jan3 = [r for r in cal if r["date_sk"] == 20260103][0]
    assert jan3["weekday_name"] == "sábado" and jan3["is_weekend"] and jan3["quarter"] == 1
    months = spark.createDataFrame([(dt.date(2026, m, 1),) for m in range(1, 13)], "date date")
    names = [r["month_name"] for r in calendar.calendar_dimension(months).collect()]
    assert names == config.MONTH_NAMES


def test_empty_fact_calendar_is_one_day(spark):
    fact = spark.createDataFrame([], "sale_date date")
    assert calendar.calendar_range(spark, fact, "2026-01-07").count() == 1


def test_audit_tolerates_missing_table(spark, tmp_lake):
    counts = audit.layer_counts(spark, {
        "ok": lambda: spark.range(3),
        "missing": lambda: spark.read.parquet(os.path.join(tmp_lake, "nope"))})
    assert counts["ok"] == 3 and counts["missing"].startswith("error: ")
    assert audit.run_status({"a": 0, "b": None}) == ("failed", ["b"])


def test_table_columns(spark, tmp_lake):
    from shelfline.sources import lake_scan
    p = os.path.join(tmp_lake, "t")
    spark.range(3).write.parquet(p)
    assert lake_scan.table_columns(spark, p) == ["id"]
    with pytest.raises(RuntimeError, match="does not exist"):
        lake_scan.table_columns(spark, os.path.join(tmp_lake, "missing"))


def test_keep_last_with_a_hot_key(spark):
    """One key holds a third of the rows: still one row per key, the last one."""
    n = 30000
    df = spark.range(0, n, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ord"), (F.col("id") * 2).alias("v"))
    out = dedup.keep_last(df, ["k"], "ord")
    assert out.count() == 1 + (n - n // 3)
    hot = out.where("k = -1").first()
    assert hot["ord"] == n - 3 and hot["v"] == 2 * (n - 3)


def test_lenient_long_keeps_large_ids_exact(spark):
    texts = ["9007199254740993", "1234567890123456789", "1234567890123456790.0", " 12 ", "1.5", "1e3",
             "9223372036854775808", "1e-30", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(lenient_long("s")).collect()]
    assert got == [9007199254740993, 1234567890123456789, 1234567890123456790, 12, None, 1000, None, None, None, None]


def test_flatten_dotted_and_mixed_keys(spark):
    recs = [json.dumps({"id": 1, "a.b": 5, "x.y": {"z": 3}, "m": {"k": "v"}}),
            json.dumps({"id": 2, "m": "plain", "q": {"it's.x": True}})]
    flat = conform.flatten_one_level(spark.createDataFrame([(r,) for r in recs], "record string"))
    assert set(flat.columns) == {"id", "a.b", "x.y.z", "m", "m.k", "q.it's.x"}
    r = {row["id"]: row for row in flat.collect()}
    assert r["1"]["a.b"] == "5" and r["1"]["x.y.z"] == "3"
    assert r["1"]["m"] is None and r["1"]["m.k"] == "v"
    assert r["2"]["m"] == "plain" and r["2"]["m.k"] is None and r["2"]["q.it's.x"] == "true"


def test_source_order_follows_batches_and_parts_as_numbers(spark, tmp_lake):
    for name, price in (("batch=9/part-100000-a.txt", 3), ("batch=9/part-99999-a.txt", 2),
                        ("batch=10/part-00000-a.txt", 4), ("part-00000-a.txt", 1)):
        path = os.path.join(tmp_lake, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(json.dumps({"id": 7, "price": price}) + "\n")
    recs = env.read_raw_json(spark, tmp_lake).orderBy("ord").collect()
    assert [json.loads(r["record"])["price"] for r in recs] == [1, 2, 3, 4]
    kept = dedup.keep_last(env.read_raw_json(spark, tmp_lake).withColumn("k", F.lit(1)), ["k"], "ord")
    assert json.loads(kept.first()["record"])["price"] == 4


def test_landing_keeps_page_order(spark, tmp_lake):
    pages = os.path.join(tmp_lake, "pages")
    os.makedirs(pages)
    for page, price, filler in (("page1", 1, 1), ("page2", 2, 400), ("page10", 3, 1)):
        body = {"products": [{"id": 7, "price": price, "title": "t" * filler}]}
        with open(os.path.join(pages, f"{page}.json"), "w") as f:
            json.dump(body, f)
    landed = pipeline.land_envelopes(spark, os.path.join(tmp_lake, "lake"), {"products": pages}, "2026-01-01")
    recs = env.read_raw_json(spark, landed["products"]).orderBy("ord").collect()
    assert [json.loads(r["record"])["price"] for r in recs] == [1, 2, 3]


def test_listing_names_layers_below_the_root(spark, tmp_lake):
    root = os.path.join(tmp_lake, "warehouse", "lake1")
    os.makedirs(os.path.join(root, "raw"))
    with open(os.path.join(root, "raw", "x.json"), "w") as f:
        f.write("{}")
    assert [(r["layer"], r["n_files"]) for r in env.lake_listing(spark, root).collect()] == [("raw", 1)]


def test_parallel_reports_the_items_that_succeed():
    def work(x):
        if x == 2:
            raise RuntimeError("no")
        return x * 10

    seen = {}
    with pytest.raises(RuntimeError, match="no"):
        pipeline._parallel(work, [1, 2, 3], done=lambda x, r: seen.update({x: r}))
    assert seen == {1: 10, 3: 30}
