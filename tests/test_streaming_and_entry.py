"""Incremental landing stream, and the driver entry points."""

import json
import os
import re
import tempfile

from pyspark.sql import functions as F

from shelfline.plans import pipeline as P
from shelfline.sinks import lake as L
from shelfline.streaming.landing import land_stream
from tests import fixtures as fx


def _drop(path, key, recs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump({key: recs}, f, indent=2)


def test_available_now_landing_is_incremental(spark, tmp_lake):
    landing = os.path.join(tmp_lake, "landing", "products")
    ckpt = os.path.join(tmp_lake, "_ckpt")
    prods = fx.records("products")
    _drop(os.path.join(landing, "dt=2026-09-29", "page1.json"), "products", prods[:10])
    _drop(os.path.join(landing, "dt=2026-09-29", "page2.json"), "products", prods[10:20])
    land_stream(spark, landing, tmp_lake, "products", ckpt, "2026-09-29")
    raw = L.Lake(tmp_lake).raw("products")
    assert spark.read.text(raw).count() == 20
    # a later file: only it is processed on the next run
    _drop(os.path.join(landing, "dt=2026-09-30", "page1.json"), "products", prods[20:])
    land_stream(spark, landing, tmp_lake, "products", ckpt, "2026-09-29")
    back = spark.read.text(raw)
    assert back.count() == 30
    assert back.where(F.col("dt") == "2026-09-30").count() == 10
    # the landed day runs through the pipeline's bronze step
    day = L.partition_dir(raw, "2026-09-30")
    lk = L.Lake(tmp_lake)
    b = P.to_bronze(spark, lk, {"products": day}, "2026-09-30", "t")
    assert spark.read.parquet(b["products"]).count() == 10


def test_entry_points():
    import __spark_entry__ as E
    from shelfline.session import get_session
    spark = get_session("local[4]", 4, checkpoint_dir=tempfile.mkdtemp(prefix="entry-"))
    df = E.entry(spark)
    assert "cart_id" in df.columns and df.count() > 0
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    own = {q for q in qs if not re.match(r"op\d+_|pipeline$", q)}
    assert own <= set(orc)
