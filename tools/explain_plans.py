"""Write the formatted physical plans of the headline operators to docs/plans/.

    python tools/explain_plans.py [sf_dir]

Plans are taken before execution (AQE may still switch a sort-merge join to a
broadcast join at runtime when a side measures small).
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shelfline import config, schemas  # noqa: E402
from shelfline.operators import carts, dedup, marts, quality, upsert  # noqa: E402
from shelfline.plans import queries as Q  # noqa: E402
from shelfline.plans import scenario  # noqa: E402
from shelfline.session import get_session  # noqa: E402
from shelfline.sources import driver_tables as dt  # noqa: E402

OUT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 16, checkpoint_dir=tempfile.mkdtemp(prefix="plans-"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 20))
    fact_src = Q._consolidated(spark, sf_dir, 2).withColumn(
        "cart_range", upsert.key_range("cart_id", 4096))
    dim_src = scenario.history_frame(spark, sf_dir, "products", 2).select(
        "product_id", "product_name", "category", "brand", "sku",
        F.col("price").alias("current_price"))
    dim_target = spark.createDataFrame([], schemas.DIM_PRODUCT)
    plans = {
        "sales_consolidated": Q.q_sales_consolidated(spark, sf_dir),
        "dedup_keep_last": Q.q_dedup_keep_last(spark, sf_dir),
        "explode_cart_lines": Q.q_explode_cart_lines(spark, sf_dir),
        "quality_gate": Q.q_quality_gate(spark, sf_dir),
        "cart_totals": carts.cart_totals(dt.sales_lines(spark, sf_dir)),
        "category_counts": marts.category_counts(scenario.history_frame(spark, sf_dir, "products")),
        "fact_merge_source": fact_src,
        "dim_product_full_outer_join": dim_target.select(
            "product_id", "product_sk").join(dim_src, "product_id", "full_outer"),
        "key_violations": dedup.key_violations(dt.sales_lines(spark, sf_dir), config.KEYS["sales"]),
        "customers_rejects": quality.split(quality.tag(
            scenario.silver(spark, sf_dir, "customers"), "customers"))[1],
    }
    os.makedirs(OUT, exist_ok=True)
    for name, df in plans.items():
        with open(os.path.join(OUT, f"{name}.txt"), "w", encoding="utf-8") as f:
            f.write(plan_text(df))
        print(name, flush=True)


if __name__ == "__main__":
    main()
