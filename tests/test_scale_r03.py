"""Steps whose memory or shuffled bytes grew faster than they need to (findings of round 3)."""

import datetime as dt_

from pyspark.sql import functions as F

from shelfline.operators import conform, dedup, upsert
from shelfline.sources import driver_tables as dt


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_discovery_holds_distinct_pairs_only(spark):
    rows = [('{"b": {"y": 1, "x": 2}, "a": 1}',), ('{"a": 2, "b": {"x": 1, "z": {}}, "c": null}',)]
    df = spark.createDataFrame(rows, "record string")
    pairs = df.select(F.posexplode(F.from_json("record", "map<string,variant>")).alias("pos", "k", "v"))
    found = conform._distinct_pairs(pairs)
    assert "SortAggregate" not in _plan(found) and "HashAggregate" in _plan(found)
    got = {(r["k"], r["child"]): tuple(r["first"]) for r in found.collect()}
    flat = {}
    for r in pairs.select("pos", "k", F.expr("map_keys(try_variant_get(v, '$', 'map<string,variant>'))").alias("c")).collect():
        for sub, child in enumerate([None] if r["c"] is None else r["c"]):
            flat[(r["k"], child)] = min(flat.get((r["k"], child), (9, 9)), (r["pos"], sub))
    assert got == flat


def test_keep_last_carries_its_order_once(spark):
    df = spark.range(200).select((F.col("id") % 7).alias("k"), F.struct(F.col("id"), F.lit("a")).alias("o"),
                                 F.concat(F.lit("v"), F.col("id")).alias("v"))
    out = dedup.keep_last(df, ["k"], "o")
    assert "max_by" not in _plan(out) and out.columns == ["k", "o", "v"]
    assert {(r["k"], r["o"]["id"], r["v"]) for r in out.collect()} == {
        (k, n, f"v{n}") for k in range(7) for n in [max(i for i in range(200) if i % 7 == k)]}
    mapped = dedup.keep_last(df.withColumn("m", F.create_map("v", "k")), ["k"], "o")
    assert {r["v"] for r in mapped.collect()} == {r["v"] for r in out.collect()}


def test_ranges_merge_with_one_shuffle_of_the_rows(spark):
    cols = "k long, p long, v string, r long"
    cur = spark.createDataFrame([(k, p, "old", k // 10) for k in range(40) for p in range(3)] + [(None, 1, "old", 0)], cols)
    src = spark.createDataFrame([(k, p, "new", k // 10) for k in range(35, 45) for p in range(1, 5)], cols)
    sizes = cur.groupBy("r").agg(F.count(F.lit(1)).alias("n_rows")).unionByName(
        src.groupBy("r").agg(F.count(F.lit(1)).alias("n_rows")))
    want = sorted(map(str, upsert.replace_by_key(cur, src, ["k", "p"]).collect()))
    for piece in (1_000_000, 10):
        merged = upsert._merge_ranges(cur, src, ["k", "p"], "r", sizes, piece)
        assert _plan(merged).count("REPARTITION_BY_COL") == 1 and "LeftAnti" not in _plan(merged)
        assert sorted(map(str, merged.collect())) == want


def test_landed_days_hold_the_rows_of_each_day(spark, tmp_path):
    days = [dt_.datetime(1997, 12, 31, 23), dt_.datetime(1998, 1, 1), dt_.datetime(1998, 6, 30, 23, 59), dt_.datetime(1998, 7, 1), None]
    spark.createDataFrame([(i, i % 3, days[i % 5]) for i in range(50)] + [(3, 7, days[1])],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(300).select(
        (F.col("id") % 60).alias("l_orderkey"), (F.col("id") % 4).alias("l_partkey"), (F.col("id") % 5).alias("l_suppkey"),
        (F.col("id") % 9).cast("int").alias("l_linenumber"), (F.col("id") + 1.0).alias("l_quantity"),
        (F.col("id") * 1.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit("1998-01-01").cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    landed = dt.landed_days(spark, str(tmp_path), f"{tmp_path}/landed")
    for day in (None, 1, 2):
        want = dt.last_sales_lines(spark, str(tmp_path), day)
        got = dt.last_sales_lines(spark, str(tmp_path), day, landed)
        assert got.columns == want.columns and want.count() > 0
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert "Exchange" not in _plan(got)
