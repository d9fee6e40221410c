"""Parquet and partitioned-day scans, table column lookup (1.5-1.8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.sinks import lake


def parquet_scan(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (1.5); projections and filters on the result reach the reader."""
    return spark.read.parquet(path)


def day_scan(spark: SparkSession, root: str, ds: str, col: str = "dt") -> DataFrame:
    """One day of a ``<col>=<ds>`` partitioned layer (1.6).

    Reading the root and filtering on the partition column lets the file index
    prune to one directory; the partition column stays in the frame.
    """
    return spark.read.parquet(root).where(F.col(col) == F.lit(ds).cast("date"))


def table_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns of a stored table, error when it does not exist (1.8)."""
    if not lake.exists(spark, path):
        raise RuntimeError(f"table {path} does not exist; was the schema created?")
    return spark.read.parquet(path).columns
