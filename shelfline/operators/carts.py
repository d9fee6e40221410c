"""Cart expansion, nested field extraction and cart totals (4.1, 4.2, 8.6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import config
from shelfline.functions import round2

_ITEMS = "array<map<string,string>>"


def explode_cart_lines(carts: DataFrame, products_col: str = "products",
                       cart_col: str = "id", customer_col: str = "userId",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON array of items -> one row per item with the parent ids (4.1).

    Items are parsed as text maps, so a missing field is null and numbers keep
    their text form for the lenient parse that follows.  A null or empty array
    yields no rows (inner explode); ``line_pos`` is the item's position.
    """
    items = F.from_json(F.col(products_col), _ITEMS)
    exploded = carts.select(
        F.col(cart_col).alias("cart_id"), F.col(customer_col).alias("customer_id"),
        *keep, F.posexplode(items).alias("line_pos", "_item"))
    fields = [F.col("_item")[src].alias(dst) for src, dst in config.CART_LINE_FIELDS.items()]
    return exploded.select("cart_id", "customer_id", *fields, *keep, "line_pos")


def json_field(c, path: str) -> Column:
    """Nested field by JSON path; missing -> null (4.2)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.get_json_object(col, path)


def cart_totals(lines: DataFrame) -> DataFrame:
    """Per cart: gross and net totals, line count and quantity (8.6)."""
    return lines.groupBy("cart_id").agg(
        F.sum(F.col("gross_amount").cast("decimal(14,2)")).alias("total"),
        F.sum(F.col("net_amount").cast("decimal(14,2)")).alias("discounted_total"),
        F.count(F.lit(1)).alias("total_products"),
        F.sum(F.col("quantity").cast("long")).alias("total_quantity"))


def enrich_sales(lines: DataFrame, ds: str, sale_date: Column | None = None) -> DataFrame:
    """Sale date (source date when present, else the run date) and discount amount."""
    day = F.lit(ds).cast("date")
    return (lines
            .withColumn("sale_date", F.coalesce(sale_date, day) if sale_date is not None else day)
            .withColumn("discount_amount", round2(F.col("gross_amount") - F.col("net_amount"))))
