"""Day frames of the four entities built from the benchmark tables (typed path).

These are the silver/enriched entities a landed day would produce, aligned to
the history-table schemas, without a round trip through files.  The pipeline
query (``pipeline_end_to_end``) reaches the same frames through JSON landing,
text bronze and conforming; the oracle SQL is shared, which proves both paths
agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators import quality
from shelfline.operators.carts import enrich_sales
from shelfline.operators.conform import align_to_schema
from shelfline.sources import driver_tables as dt


def source_key(entity: str, day: int | None) -> str:
    return f"silver/validated/{entity}/dt={dt.day_date(day)}"


def loaded_at(day: int | None):
    """The moment that the queries take for a day's load: the day's beginning."""
    return F.lit(dt.day_date(day)).cast("timestamp")


def silver_sales(spark: SparkSession, sf_dir: str, day: int | None = None,
                 landed: DataFrame | None = None) -> DataFrame:
    """Cart lines, de-duplicated on (cart, product) keeping the last line of the cart."""
    last = dt.last_sales_lines(spark, sf_dir, day, landed)
    return (enrich_sales(last, dt.day_date(day), F.col("sale_date"))
            .withColumn("load_date", F.lit(dt.day_date(day)).cast("date")))


def silver_stock(products: DataFrame, ds: str) -> DataFrame:
    """Daily stock snapshot derived from the products of the day (3.16)."""
    return products.select(
        "product_id", F.col("stock").alias("quantity"), "price", "availability",
        F.lit(ds).cast("date").alias("reference_date"),
        F.lit(ds).cast("date").alias("load_date"))


def silver(spark: SparkSession, sf_dir: str, entity: str, day: int | None = None,
           landed: DataFrame | None = None) -> DataFrame:
    """``landed``: sales lines that ``landed_days`` wrote, for queries that load several days."""
    if entity == "products":
        return dt.silver_products(spark, sf_dir, day)
    if entity == "customers":
        return dt.silver_customers(spark, sf_dir, day)
    if entity == "sales":
        return silver_sales(spark, sf_dir, day, landed)
    if entity == "stock":
        return silver_stock(dt.silver_products(spark, sf_dir, day), dt.day_date(day))
    raise KeyError(entity)


def valid(spark: SparkSession, sf_dir: str, entity: str, day: int | None = None,
          landed: DataFrame | None = None) -> DataFrame:
    """Rows of the entity that pass its rules (the validated silver stage)."""
    return silver(spark, sf_dir, entity, day, landed).where(~quality.invalid_flag(entity))


def history_frame(spark: SparkSession, sf_dir: str, entity: str,
                  day: int | None = None, landed: DataFrame | None = None) -> DataFrame:
    """The rows a day load would put into the entity's history table."""
    df = valid(spark, sf_dir, entity, day, landed)
    return align_to_schema(df, schemas.HISTORY[entity],
                           defaults={"source_key": source_key(entity, day), "loaded_at": loaded_at(day)},
                           what=f"history.{entity}")
