"""Retail entities derived from the benchmark tables (TPC-H-like star schema).

The given tables carry no nested carts, e-mails or missing brands, so the
entities are derived with deterministic expressions (and mirrored in
``shelfline.plans.oracle`` for the SQL check):

* products  <- part
* customers <- customer ⋈ nation ⋈ region (small dimension tables)
* carts     <- orders ⋈ lineitem, one cart per order, lines in a total order

Two landing days are simulated for the history/upsert scenarios: day 1 and
day 2 overlap, day 2 changes some values, drops some keys and adds others.
Nothing here limits the rows read: every selection is part of the scenario.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import (age_band, email_normalise, full_name,
                                 round2)
from shelfline.operators.dedup import keep_last
from shelfline.sinks.lake import PARQUET

# ── Fixed scenario parameters ────────────────────────────────────────────────
RUN_DATE = "2001-12-31"           # the single landing of the whole tables
DAY_DATES = {1: "2001-12-30", 2: "2001-12-31"}
CART_DAY1_BEFORE = "1998-07-01"   # day 1 carts: orders before this date
CART_DAY2_FROM = "1998-01-01"     # day 2 carts: orders from this date (overlap re-lands)
# Line order inside a cart: a total order over every lineitem column but the cart key.
LINE_ORDER = ["l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def day_date(day: int | None) -> str:
    return RUN_DATE if day is None else DAY_DATES[day]


# ── products ─────────────────────────────────────────────────────────────────
def _part_for_day(spark, sf_dir, day):
    p = table(spark, sf_dir, "part")
    if day == 1:
        p = p.where(F.col("p_size") <= 45)
    elif day == 2:
        p = p.where(F.col("p_size") >= 3)
    price = F.col("p_retailprice")
    if day == 2:
        price = F.when(F.col("p_size") % 10 == 0, price + 1.5).otherwise(price)
    return p.withColumn("_price", price)


def product_records(spark: SparkSession, sf_dir: str, day: int | None = None) -> DataFrame:
    """Products in the source (API) shape, nested fields included."""
    p = _part_for_day(spark, sf_dir, day)
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.concat(F.col("p_name"), F.lit(" - "), F.col("p_type")).alias("description"),
        F.col("p_type").alias("category"),
        F.col("_price").alias("price"),
        F.nullif(F.col("p_size") % 21, F.lit(0)).cast("double").alias("discountPercentage"),
        (F.col("p_size") % 5 + 1).cast("double").alias("rating"),
        F.col("p_size").alias("stock"),
        F.array(F.lower(F.col("p_type"))).alias("tags"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("brand"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.struct(F.col("p_size").cast("double").alias("width"),
                 F.lit(2.0).alias("height"), F.lit(3.0).alias("depth")).alias("dimensions"),
        F.when(F.col("p_size") <= 5, F.lit("Low Stock")).otherwise(F.lit("In Stock"))
         .alias("availabilityStatus"),
        F.array(F.struct((F.col("p_size") % 5 + 1).alias("rating"),
                         F.lit("ok").alias("comment"))).alias("reviews"),
        F.struct(F.lit("2025-10-09T14:47:01.588Z").alias("createdAt")).alias("meta"),
    )


def silver_products(spark: SparkSession, sf_dir: str, day: int | None = None) -> DataFrame:
    """Products after conforming and enrichment (typed path, same values as via text)."""
    from shelfline.functions import discounted_price
    p = _part_for_day(spark, sf_dir, day)
    disc = F.nullif(F.col("p_size") % 21, F.lit(0)).cast("double")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.col("p_name"), F.lit(" - "), F.col("p_type")).alias("description"),
        F.col("p_type").alias("category"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("brand"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("_price").alias("price"),
        disc.alias("discount_pct"),
        (F.col("p_size") % 5 + 1).cast("double").alias("rating"),
        F.col("p_size").cast("double").alias("stock"),
        F.when(F.col("p_size") <= 5, F.lit("Low Stock")).otherwise(F.lit("In Stock"))
         .alias("availability"),
        discounted_price(F.col("_price"), disc).alias("discounted_price"),
        F.lit(day_date(day)).cast("date").alias("load_date"),
    )


# ── customers ────────────────────────────────────────────────────────────────
def _customer_base(spark, sf_dir, day):
    c = table(spark, sf_dir, "customer")
    if day == 1:
        c = c.where(F.col("c_nationkey") != 24)
    elif day == 2:
        c = c.where(F.col("c_nationkey") != 0)
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation (25 rows) and region (5 rows) are fixed-size reference tables.
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")
    c = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey, "left")
    handle = F.regexp_replace(F.col("c_name"), "#", ".")
    domain = F.lit("@Shop.Example.COM")
    if day == 2:
        domain = F.when(F.col("c_mktsegment") == "MACHINERY",
                        F.lit("@New.Example.COM")).otherwise(domain)
    email = F.when(F.col("c_custkey") % 40 == 0,
                   F.concat(handle, F.lit(".shop.example.com"))).otherwise(F.concat(handle, domain))
    seg = F.col("c_mktsegment")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.concat(F.upper(F.substring(seg, 1, 1)), F.lower(F.expr("substring(c_mktsegment, 2)"))).alias("firstName"),
        F.when(F.col("c_acctbal") >= 0, F.expr("substring(c_name, 10)")).alias("lastName"),
        email.alias("email"),
        F.when(F.col("c_custkey") % 70 != 69, 10 + F.col("c_custkey") % 70).alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("female")).otherwise(F.lit("male")).alias("gender"),
        F.concat_ws("-", (1940 + F.col("c_custkey") % 60).cast("string"),
                    (F.col("c_custkey") % 12 + 1).cast("string"),
                    (F.col("c_custkey") % 28 + 1).cast("string")).alias("birthDate"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("stateCode"),
        F.lit("Earth").alias("country"),
    )


def customer_records(spark: SparkSession, sf_dir: str, day: int | None = None) -> DataFrame:
    """Customers in the source shape: the address is a nested object."""
    b = _customer_base(spark, sf_dir, day)
    return b.select(
        "id", "firstName", "lastName", "email", "age", "gender", "birthDate",
        F.struct(F.lit("Main St 1").alias("address"), F.col("city"), F.col("state"),
                 F.col("stateCode"), F.lit("00000").alias("postalCode"),
                 F.struct(F.lit(-7.5).alias("lat"), F.lit(12.25).alias("lng")).alias("coordinates"),
                 F.col("country")).alias("address"),
    )


def silver_customers(spark: SparkSession, sf_dir: str, day: int | None = None) -> DataFrame:
    b = _customer_base(spark, sf_dir, day)
    return b.select(
        F.col("id").alias("customer_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        full_name("firstName", "lastName").alias("full_name"),
        email_normalise("email").alias("email"),
        F.col("age").cast("double").alias("age"),
        age_band("age").alias("age_band"),
        F.col("gender"),
        F.col("birthDate").cast("date").alias("birth_date"),
        F.col("city"), F.col("state"), F.col("stateCode").alias("state_code"),
        F.col("country"),
        F.lit(day_date(day)).cast("date").alias("load_date"),
    )


# ── carts / sales lines ──────────────────────────────────────────────────────
def _orders(spark, sf_dir, day):
    return _of_day(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), day, "o_orderdate")


def _of_day(df, day, ordered):
    if day == 1:
        return df.where(F.col(ordered) < F.lit(CART_DAY1_BEFORE).cast("timestamp_ntz"))
    if day == 2:
        return df.where(F.col(ordered) >= F.lit(CART_DAY2_FROM).cast("timestamp_ntz"))
    return df


def _order_lines(spark, sf_dir, day):
    o = _orders(spark, sf_dir, day)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", *LINE_ORDER)
    return li.join(o, li.l_orderkey == o.o_orderkey)


def landed_days(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """``last_sales_lines`` of the whole tables, written to ``path`` for a query that loads several days:
    the lines are shuffled once, and each day is a scan of the written copy."""
    last_sales_lines(spark, sf_dir).write.options(**PARQUET).parquet(path)
    return spark.read.parquet(path)


def last_sales_lines(spark: SparkSession, sf_dir: str, day: int | None = None,
                     landed: DataFrame | None = None) -> DataFrame:
    """Flat cart lines de-duplicated on (cart, product), keeping the last line of the cart.

    ``landed``: the lines of the whole tables (``landed_days``), of which the day's are taken.

    The lines are reduced before they meet their carts: the aggregate is spread by (cart,
    product), and nothing above the join asks for its partitioning, so a cart that holds most
    lines is a skewed join partition that AQE splits, not one task's group.
    """
    if landed is not None:
        return _of_day(landed, day, "sale_date")   # the limits are midnights: the date decides as the moment does
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.struct(*LINE_ORDER).alias("line_ord"))
    last = keep_last(li, ["l_orderkey", "l_partkey"], "line_ord").select("l_orderkey", "l_partkey", "line_ord.*")
    o = _orders(spark, sf_dir, day)
    v = _line_values()
    return last.join(o, last.l_orderkey == o.o_orderkey).select(
        F.col("o_orderkey").alias("cart_id"),
        F.col("o_custkey").alias("customer_id"),
        *[c.alias(n) for n, c in v.items()],
        F.col("o_orderdate").cast("date").alias("sale_date"))


def _line_values(col=F.col) -> dict[str, Column]:
    """Values of a line; ``col(name)`` gives its columns (those of the row, or fields of a nested line)."""
    gross = col("l_extendedprice")
    net = round2(gross * (1 - col("l_discount")))
    return {
        "product_id": col("l_partkey"),
        "product_name": F.concat(F.lit("part "), col("l_partkey").cast("string")),
        "price": round2(gross / col("l_quantity")),
        "quantity": col("l_quantity"),
        "gross_amount": gross,
        "discount_pct": round2(col("l_discount") * 100),
        "net_amount": net,
    }


def sales_lines(spark: SparkSession, sf_dir: str, day: int | None = None) -> DataFrame:
    """Flat cart lines with their in-cart order (``line_ord``), before de-duplication."""
    v = _line_values()
    j = _order_lines(spark, sf_dir, day)
    return j.select(
        F.col("o_orderkey").alias("cart_id"),
        F.col("o_custkey").alias("customer_id"),
        *[c.alias(n) for n, c in v.items()],
        F.struct(*LINE_ORDER).alias("line_ord"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
    )


def cart_records(spark: SparkSession, sf_dir: str, day: int | None = None) -> DataFrame:
    """Carts in the source shape: one row per order, lines nested in ``products``.

    Building the nested form is a shuffle on the order key; the line array is
    sorted by ``LINE_ORDER`` so that "position in the cart" is deterministic.
    """
    j = _order_lines(spark, sf_dir, day)
    # One cart document per order: the source nests all lines of a cart in one document.  The group
    # holds the lines as they are (what is derived from a line adds nothing to their order), and the
    # document's items are built from them once, in a projection of their own.
    carts = j.groupBy(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("userId"),
                      F.col("o_orderdate").alias("_od")).agg(
        F.array_sort(F.collect_list(F.struct(*LINE_ORDER, "l_partkey"))).alias("_lines"))

    def item(line):
        v = _line_values(lambda c: line[c])
        return F.struct(v["product_id"].alias("id"), v["product_name"].alias("title"),
                        v["price"].alias("price"), v["quantity"].cast("int").alias("quantity"),
                        v["gross_amount"].alias("total"),
                        v["discount_pct"].alias("discountPercentage"),
                        v["net_amount"].alias("discountedTotal"),
                        F.lit("x").alias("thumbnail"))

    return carts.withColumn("products", F.transform("_lines", item)).select(
        "id", "products", "userId",
        F.aggregate("products", F.lit(0.0), lambda acc, x: acc + x["total"]).alias("total"),
        F.aggregate("products", F.lit(0.0), lambda acc, x: acc + x["discountedTotal"]).alias("discountedTotal"),
        F.size("products").alias("totalProducts"),
        F.aggregate("products", F.lit(0), lambda acc, x: acc + x["quantity"]).alias("totalQuantity"),
        F.col("_od").cast("date").cast("string").alias("date"),
    )
