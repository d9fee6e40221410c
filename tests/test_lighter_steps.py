"""Steps that cost more time or bytes than their rows need (findings of round 3, second part)."""

import datetime as dt_
import os

from pyspark.sql import functions as F

from shelfline.operators import conform, upsert
from shelfline.sinks import lake as L
from shelfline.sources import driver_tables as dt
from shelfline.sources import envelope as env


def _files(root) -> list[str]:
    return [f for _, _, names in os.walk(root) for f in names if f.startswith("part-")]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lists_of_objects_become_text_by_one_writer(spark):
    values = ["null", "1", "1.50", "1e5", "-0.0", "true", '"a\\"b\\u00e9\\n"', "[]", "{}", "[null]", "[{}]",
              '[[1,2],{"a":null}]', '[{"b":1,"a":[1,{"z":"q\\"","c":null}]},null,{"\\u00e9\\"k":"x","A":1.10}]',
              '["x","y"]', "[1,2.50]", '[{"a":1},2]', '"[1]"', '[{"a":null}]', '[{"d":1e400,"":2}]',
              '{"b":{"y":1,"x":"\\t"},"a":null}', '[{"n":123456789012345678901234567890123456789012345}]']
    v = spark.createDataFrame([(x,) for x in values], "j string").select("j", F.try_parse_json("j").alias("v"))
    out = v.select("j", F.try_variant_get("v", "$", "string").alias("cast"), conform._text(F.col("v")).alias("text"))
    rows = out.collect()
    assert len(rows) == len(values) and [r["text"] for r in rows] == [r["cast"] for r in rows]
    records = spark.createDataFrame([('{"a": [{"y": 1, "x": "q"}]}',)], "record string")
    flat = conform.flatten_one_level(records)
    assert flat.first()["a"] == '[{"x":"q","y":1}]' and "StructsToJson" in _plan(flat)


def test_carts_hold_plain_lines_and_derive_their_items_once(spark, tmp_path):
    at = dt_.datetime(1998, 1, 1)
    spark.createDataFrame([(1, 5, at), (2, 6, at), (2, 6, at), (3, None, None), (4, 5, at)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    line = [(k, p, n, s, q, x, 0.1, 0.0, "N", "O", at) for k, p, n, s, q, x in [
        (1, 11, 2, 7, 2.0, 30.0), (1, 12, 1, 7, 3.0, 10.0), (1, 12, 1, 7, 3.0, 10.0), (1, 10, 1, 7, 3.0, 10.0),
        (2, 13, 1, 7, 1.0, 5.0), (3, 14, None, 7, 4.0, 8.0), (3, 14, 1, 7, None, 8.0)]]
    spark.createDataFrame(line, "l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long, l_quantity double, "
                                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                                "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    carts = dt.cart_records(spark, str(tmp_path))
    grouped = next(s for s in _plan(carts).split("\n") if "collect_list" in s)
    assert "thumbnail" not in grouped and "l_extendedprice" in grouped
    got = {r["id"]: r for r in carts.collect()}
    assert sorted(got) == [1, 2, 3]
    assert [(i["id"], i["title"], i["price"], i["total"], i["discountedTotal"]) for i in got[1]["products"]] == [
        (10, "part 10", 3.33, 10.0, 9.0), (12, "part 12", 3.33, 10.0, 9.0), (12, "part 12", 3.33, 10.0, 9.0),
        (11, "part 11", 15.0, 30.0, 27.0)]
    assert (got[1]["total"], got[1]["discountedTotal"], got[1]["totalProducts"], got[1]["totalQuantity"]) == (60.0, 54.0, 4, 11)
    assert [i["id"] for i in got[2]["products"]] == [13, 13] and got[2]["userId"] == 6
    assert [i["quantity"] for i in got[3]["products"]] == [4, None] and got[3]["totalQuantity"] is None
    assert got[3]["userId"] is None and got[3]["date"] is None and got[1]["date"] == "1998-01-01"


def test_raw_records_are_compressed_in_bounded_files_and_keep_their_order(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(L.RAW_JSON, "maxRecordsPerFile", 300)
    path = L.land_json(spark.range(0, 2000, 1, 3).select("id", F.lit("é \n").alias("t")), f"{tmp_path}/raw", "2026-01-01")
    files = _files(path)
    assert len(files) >= 7 and all(f.endswith(".json.snappy") for f in files)
    back = env.read_raw_json(spark, path).orderBy("ord").select(F.get_json_object("record", "$.id").cast("long"),
                                                                F.get_json_object("record", "$.t")).collect()
    assert [tuple(r) for r in back] == [(i, "é \n") for i in range(2000)]


def test_lake_tables_are_written_with_the_smaller_codec(spark, tmp_path):
    df = spark.range(20).select("id", F.lit("2026-01-01").cast("date").alias("load_date"))
    L.write_day(df, f"{tmp_path}/day", "2026-01-01")
    L.overwrite_partition(spark, df, f"{tmp_path}/history", "2026-01-01")
    L.write_snapshot(spark, df, f"{tmp_path}/dim")
    L.append(df, f"{tmp_path}/log")
    upsert.upsert_key_ranges(spark, f"{tmp_path}/fact", df, ["id"], df.schema, "b", upsert.key_range("id", 10),
                             staging=f"{tmp_path}/stg")
    files = _files(tmp_path)
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert upsert.read_bucketed(spark, f"{tmp_path}/fact", df.schema, "b").count() == 20
