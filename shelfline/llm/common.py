"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import scratch_path

#: Separators of words: space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: A broadcast side is forced only up to this many rows of a few machine words.
BROADCAST_ROWS = 2_000_000
#: Rows per Arrow batch: texts reach 100 KB, so a batch stays near 100 MB at worst.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (lineage ends there)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (as ``--py-files`` would), once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "shelfline.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def python_tasks(spark: SparkSession) -> None:
    """Prepare the session for Python code in tasks."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def bounded_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the counted ``rows`` are within ``limit``; else a shuffle join."""
    return F.broadcast(df) if rows <= limit else df


def one_of_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One whole row of each key: the first by its columns as JSON, so that reruns agree.  Partial
    aggregates keep one row a task, so a key may hold any share of the rows."""
    as_text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    first = rows.select(*keys, F.struct("*").alias("__row"), as_text.alias("__text"))
    return first.groupBy(*keys).agg(F.min_by("__row", "__text").alias("__row")).select("__row.*")


def fraction(key: Column) -> Column:
    """Uniform draw in (0, 1) from 52 bits of MD5: any SQL engine can repeat it."""
    return (hash52(key) + F.lit(0.5)) / F.lit(float(1 << 52))


def hash52(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("bigint")


def text_or_empty(batch, column: str = "text") -> list[str]:
    return ["" if t is None else t for t in batch[column].tolist()]


def per_text(docs: DataFrame, fn, schema: str, id_column: str = "doc_id",
             text_column: str = "text") -> DataFrame:
    """Apply ``fn(list of ids, list of texts) -> pandas frame`` to every row, map-side only."""
    python_tasks(docs.sparkSession)

    def run(batches: Iterator):
        for batch in batches:
            yield fn(batch["__id"].tolist(), text_or_empty(batch, "__text"))

    # ids travel as text, so that a null id stays null instead of turning numbers into floats
    narrow = docs.select(F.col(id_column).cast("string").alias("__id"),
                         F.col(text_column).alias("__text"))
    return narrow.mapInPandas(run, schema)
