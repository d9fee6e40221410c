"""The daily run end to end on landed envelope documents."""

import pytest
from pyspark.sql import functions as F

from shelfline.operators import history
from shelfline.plans import pipeline as P
from shelfline.sinks import lake as L
from tests import fixtures as fx

DS = fx.RUN_DATE


def _run(spark, root, data=None, limit=None):
    docs = fx.write_envelopes(root, data)
    raw = P.land_envelopes(spark, root, docs, DS)
    return P.run_day(spark, root, DS, raw_paths=raw, run_id="test", limit=limit)


def test_stages_to_silver(spark, tmp_lake):
    res = _run(spark, tmp_lake)
    lk = L.Lake(tmp_lake)
    sales = spark.read.parquet(L.partition_dir(lk.silver("validated", "sales"), DS))
    assert sales.count() == 45
    assert sales.where(F.col("discount_amount") < 0).count() == 0
    cust = spark.read.parquet(L.partition_dir(lk.silver("validated", "customers"), DS))
    first = cust.where("customer_id = 71").first()
    assert first["email"] == fx.records("customers")[0]["email"].lower()
    assert first["city"] == fx.records("customers")[0]["address"]["city"] and first["state_code"]
    assert "password" not in spark.read.parquet(L.partition_dir(lk.bronze("customers"), DS)).columns
    stock = spark.read.parquet(L.partition_dir(lk.silver("validated", "stock"), DS))
    assert stock.count() == 30 and "quantity" in stock.columns
    assert {k: res[f"history_{k}"] for k in ("products", "customers", "sales", "stock")} == \
        {"products": 30, "customers": 20, "sales": 45, "stock": 30}


def test_high_reject_rate_fails(spark, tmp_lake):
    bad = fx.records("customers")
    for u in bad[:5]:
        u["email"] = "no-at-sign"
    data = {"customers": bad}
    with pytest.raises(ValueError, match="customers: reject rate"):
        _run(spark, tmp_lake, data)
    # the audit row was still appended, with a failed status
    runs = spark.read.parquet(L.Lake(tmp_lake).audit())
    assert runs.where("status = 'failed'").count() == 1


def test_full_pipeline_twice_is_idempotent(spark, tmp_lake):
    for _ in range(2):
        res = _run(spark, tmp_lake)
    lk = L.Lake(tmp_lake)
    assert history.read_day(spark, lk.history("sales"), "sales", DS).count() == 45
    fact = P.read_fact(spark, lk).where(F.col("load_date") == DS)
    row = fact.agg(F.count(F.lit(1)), F.count("category"), F.count("customer_name")).first()
    assert tuple(row) == (45, 45, 45)
    assert P.read_dimension(spark, lk, "category").count() == 5
    brands = P.read_dimension(spark, lk, "brand")
    assert brands.where("brand = 'Sem marca'").count() == 1
    assert res["history_sales"] == 45
    runs = spark.read.parquet(lk.audit())
    assert runs.count() == 2 and runs.where("status = 'success'").count() == 2
    # surrogate keys stay stable across the rerun
    dp = P.read_dimension(spark, lk, "product")
    assert dp.count() == 30 and dp.select("product_sk").distinct().count() == 30


def test_day_without_carts(spark, tmp_lake):
    """A day whose cart landing is empty loads products and customers and no sales."""
    docs = fx.write_envelopes(tmp_lake)
    raw = P.land_envelopes(spark, tmp_lake, {k: v for k, v in docs.items() if k != "carts"}, DS)
    empty = L.partition_dir(L.Lake(tmp_lake).raw("carts"), DS)
    spark.createDataFrame([], "record string").write.mode("overwrite").text(empty)
    raw["carts"] = empty
    res = P.run_day(spark, tmp_lake, DS, raw_paths=raw, run_id="empty-carts")
    assert res["history_sales"] == 0 and res["history_products"] == 30
    assert res["fact"] == 0


def test_keep_stages_writes_lineage_layers(spark, tmp_lake):
    docs = fx.write_envelopes(tmp_lake)
    raw = P.land_envelopes(spark, tmp_lake, docs, DS)
    res = P.run_day(spark, tmp_lake, DS, raw_paths=raw, run_id="stages", keep_stages=True)
    lk = L.Lake(tmp_lake)
    for stage in ("cleaned", "enriched", "validated", "rejects"):
        assert L.exists(spark, L.partition_dir(lk.silver(stage, "sales"), DS))
    cat = spark.read.json(L.partition_dir(lk.catalogue(), DS))
    assert {r["entity"]: r["n_rows"] for r in cat.collect()} == \
        {"products": 30, "customers": 20, "carts": 15}
    assert res["history_sales"] == 45


def test_catalog_tables_over_the_lake(spark, tmp_lake):
    from shelfline.sinks import catalog
    _run(spark, tmp_lake)
    tables = catalog.register_tables(spark, tmp_lake, "retail_test")
    assert "retail_test.history_sales" in tables and "retail_test.dim_brand" in tables
    n = spark.sql(f"SELECT count(*) FROM retail_test.history_sales WHERE load_date = '{DS}'").first()[0]
    assert n == 45
    assert spark.table("retail_test.dim_category").count() == 5
    assert spark.table("retail_test.fact_sales").count() == 45
    assert "product_sk" in catalog.table_columns(spark, "retail_test.dim_product")
    with pytest.raises(RuntimeError, match="does not exist"):
        catalog.table_columns(spark, "retail_test.nope")


def test_a_run_points_its_eleven_tables_at_the_new_state(spark, tmp_lake):
    _run(spark, tmp_lake)
    tables = [t.name for t in spark.catalog.listTables("retail")]
    assert len(tables) == 11 and {"audit_runs", "fact_sales", "dim_date"} <= set(tables)
    assert spark.table("retail.audit_runs").count() == 1
    first = spark.table("retail.dim_product").count()
    more = fx.records("products") + [{**fx.records("products")[0], "id": 999}]
    carts = [{**fx.records("carts")[0], "id": 777}]
    _run(spark, tmp_lake, {"products": more, "carts": carts})
    assert spark.table("retail.dim_product").count() == first + 1 == 31
    assert spark.table("retail.history_products").count() == 31 and spark.table("retail.history_stock").count() == 31
    assert spark.table("retail.history_sales").count() == 3
    assert spark.table("retail.fact_sales").count() == 48 and spark.table("retail.audit_runs").count() == 2
    assert spark.table("retail.audit_runs").where("recorded_at is null").count() == 0
    changed = spark.table("retail.dim_product").groupBy("updated_at").count().collect()
    assert sorted(r["count"] for r in changed) == [1, 30]
    for name in ("history_customers", "dim_customer", "dim_category", "dim_brand", "dim_date"):
        assert spark.table(f"retail.{name}").count() > 0, name


def test_calendar_and_audit_read_no_rows_of_the_fact(spark, tmp_lake):
    _run(spark, tmp_lake)
    lk = L.Lake(tmp_lake)
    from shelfline.operators import audit, calendar, upsert
    placed = upsert.read_placement(spark, lk.table("fact_sales"), P.FACT_BUCKET)
    dates = calendar.calendar_range(spark, placed, DS, date_col="first_date")
    plan = dates._jdf.queryExecution().executedPlan().toString()
    assert "fact_sales/placement" in plan and "fact_sales/rows" not in plan
    least = P.read_fact(spark, lk).agg({"sale_date": "min"}).first()[0]
    assert dates.agg({"date": "min"}).first()[0] == min(least, dates.agg({"date": "max"}).first()[0])
    assert P.audit_counts(spark, lk, DS)["fact_sales"] == P.read_fact(spark, lk).where(f"load_date = '{DS}'").count()


def test_audit_counts_the_fact_after_a_smaller_rerun(spark, tmp_lake):
    """A rerun with one cart less leaves that cart's rows in the fact; the audit says so."""
    _run(spark, tmp_lake)
    _run(spark, tmp_lake, {"carts": fx.records("carts")[:-1]})
    assert P.audit_counts(spark, L.Lake(tmp_lake), DS)["fact_sales"] == 45


def test_direct_records_missing_column_and_large_ids(spark, tmp_lake):
    """Records handed over directly lose their private fields too; an absent optional field is
    null; neighbouring ids near 2^63 stay apart."""
    import json
    products = fx.records("products")
    for p in products:
        del p["availabilityStatus"]
    products[0]["id"], products[1]["id"] = 9007199254740993, 9007199254740992
    used = {i["id"] for c in fx.records("carts") for i in c["products"]}
    data = {"products": products, "customers": fx.records("customers"), "carts": fx.records("carts")}
    frames = {e: spark.read.json(spark.sparkContext.parallelize([json.dumps(r) for r in recs])) for e, recs in data.items()}
    P.run_day(spark, tmp_lake, DS, records=frames, run_id="direct")
    lk = L.Lake(tmp_lake)
    bronze = spark.read.parquet(L.partition_dir(lk.bronze("customers"), DS))
    assert not {"password", "ip"} & set(bronze.columns)
    h = history.read_day(spark, lk.history("products"), "products", DS)
    assert h.count() == 30 and h.where("availability is null").count() == 30
    assert {r[0] for r in h.where("product_id > 9000000000000000").select("product_id").collect()} == \
        {9007199254740993, 9007199254740992}
    assert used
