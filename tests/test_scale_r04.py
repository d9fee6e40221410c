"""Steps that took more time than they need to (findings of round 4)."""

import datetime as dt_
import glob
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import lenient_date, lenient_double, lenient_long, text, trim_blank_null
from shelfline.operators import marts, upsert
from shelfline.plans import pipeline
from shelfline.sinks import lake as L


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plain_values_are_parsed_without_trimming_and_odd_ones_as_before(spark):
    values = ["12", "-7", "+7", " 12 ", "12\n", "12 ", " 12", "123456789012345678", "1234567890123456789", "-0", "007",
              "9223372036854775808", "1.50", "-3.0", "1.", ".5", "1e3", "inf", "nan", "1d", "١٢", "", "-", None,
              "2026-01-05", "2026-1-5", "2026-02-30", "2026-01-05\n", "2026-01-05 ", "2026/01/05", "0000-00-00", "junk"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string").repartition(1)
    s = trim_blank_null("s")
    double = F.when(s.rlike(text._NUMBER), s.try_cast(T.DoubleType()))
    exact = s.try_cast(T.DecimalType(38, 18))
    long = F.when((double == F.floor(double)) & (exact == F.floor(exact)), exact.try_cast(T.LongType()))
    day = F.when(s.rlike(r"^\d{4}[/-]\d{1,2}[/-]\d{1,2}$"), F.translate(s, "/", "-").try_cast(T.DateType()))
    want = df.select("i", double, long, day).orderBy("i").collect()
    got = df.select("i", lenient_double("s"), lenient_long("s"), lenient_date("s")).orderBy("i").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    assert f", {text._PLAIN_INTEGER})" in _plan(df.select(lenient_long("s")))


def test_folders_of_earlier_states_are_not_listed(spark, tmp_path):
    root = f"{tmp_path}/fact"
    schema = T.StructType([T.StructField("cart_id", T.LongType()), T.StructField("v", T.StringType())])
    for v in ("a", "b"):
        upsert.upsert_key_ranges(spark, root, spark.createDataFrame([(i, v) for i in range(40)], schema), ["cart_id"], schema, "b",
                                 upsert.key_range("cart_id", 10), staging=f"{root}_stg")
    os.makedirs(f"{root}/rows/written=lost/b=0")
    rows = upsert.read_bucketed(spark, root, schema, "b")
    assert len(glob.glob(f"{root}/rows/written=*")) == 3
    assert len({f.split("written=")[1].split("/")[0] for f in rows.inputFiles() if "written=" in f}) == 1
    assert sorted(tuple(r) for r in rows.collect()) == [(i, "b", i // 10) for i in range(40)]
    assert not glob.glob(f"{root}/rows/written=*/_temporary")


def test_days_join_small_partitions_by_hash_and_keep_one_name(spark):
    day = dt_.date(2026, 1, 5)
    sales = spark.range(500).select(
        F.col("id").alias("cart_id"), (F.col("id") % 40).alias("product_id"), F.lit(day).alias("sale_date"),
        F.when(F.col("id") % 3 > 0, F.lit("line")).alias("product_name"), (F.col("id") % 30).alias("customer_id"),
        *[F.lit(1.0).alias(c) for c in ("quantity", "price", "gross_amount", "discount_amount", "net_amount")], F.lit(day).alias("load_date"))
    products = spark.range(30).select(F.col("id").alias("product_id"), F.lit(day).alias("load_date"),
                                      F.when(F.col("id") % 2 > 0, F.lit("dim")).alias("product_name"),
                                      F.lit("c").alias("category"), F.lit("b").alias("brand"))
    customers = spark.range(20).select(F.col("id").alias("customer_id"), F.lit(day).alias("load_date"),
                                       *[F.lit(c).alias(c) for c in ("full_name", "city", "state_code", "age_band")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = marts.consolidate_sales(sales, products, customers, "2026-01-05")
        got = {r["cart_id"]: (r["product_name"], r["category"], r["city"]) for r in out.collect()}
        plan = _plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]
    assert got == {i: ("dim" if i % 40 < 30 and i % 40 % 2 else "line" if i % 3 else None,
                       "c" if i % 40 < 30 else None, "city" if i % 30 < 20 else None) for i in range(500)}


def test_the_order_of_lines_carries_no_file_name(spark, tmp_path):
    lk, ds = L.Lake(str(tmp_path)), "2026-01-05"
    raw = L.partition_dir(lk.raw("carts"), ds)
    for batch, part, price in ((2, 0, 1), (10, 0, 3), (10, 1, 4), (9, 7, 2)):
        os.makedirs(f"{raw}/batch={batch}", exist_ok=True)
        with open(f"{raw}/batch={batch}/part-{part:05d}.txt", "w") as f:
            for k in range(3):
                f.write(json.dumps({"id": k, "userId": 1, "products": [{"id": 5, "price": price, "quantity": k + n} for n in (1, 2)]}) + "\n")
    bronze = pipeline.to_bronze(spark, lk, {"carts": raw}, ds, "now")
    cleaned = pipeline.clean(spark, lk, bronze, ds)["sales"]
    assert sorted((r["cart_id"], r["price"], r["quantity"]) for r in cleaned.collect()) == [(k, 4.0, k + 2.0) for k in range(3)]
    shuffled = [line for line in _plan(cleaned).splitlines() if "SortAggregate" in line and "partial_max" in line]
    assert shuffled and all("file" not in line for line in shuffled)
