"""Gapless numbering of rows inside groups of any size, without one task per group.

A group is cut into runs by two keys (a coarse band, a fine cell).  The counts of
the runs give each run's offset by prefix sums over cells, then over bands; rows
are numbered inside their run only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def run_offsets(runs: DataFrame, group: str, band: str, cell: str, count: str = "n") -> DataFrame:
    """(group, band, cell, offset): rows of the group that come before each run."""
    before = Window.partitionBy(group, band).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = runs.select(group, band, cell, F.coalesce(F.sum(count).over(before), F.lit(0)).alias("in_band"))
    over = Window.partitionBy(group).orderBy(band).rowsBetween(Window.unboundedPreceding, -1)
    bands = (runs.groupBy(group, band).agg(F.sum(count).alias("rows"))
             .select(group, band, F.coalesce(F.sum("rows").over(over), F.lit(0)).alias("bands_before")))
    return cells.join(bands, [group, band]).select(
        group, band, cell, (F.col("in_band") + F.col("bands_before")).alias("offset"))


def numbered(rows: DataFrame, offsets: DataFrame, group: str, band: str, cell: str,
             order: list[Column], out: str) -> DataFrame:
    """``rows`` with ``out``: 0-based gapless rank inside the group, by band, cell, then ``order``."""
    inside = Window.partitionBy(group, band, cell).orderBy(*order)
    return (rows.withColumn("__inside", F.row_number().over(inside))
            .join(offsets, [group, band, cell])
            .withColumn(out, (F.col("__inside") - 1 + F.col("offset")).cast("bigint"))
            .drop("__inside", "offset"))


def cells_for(rows: int, floor: int, per_cell: int) -> int:
    """A power of two of cells so that a run holds about ``per_cell`` rows at most."""
    cells = floor
    while cells * per_cell < rows:
        cells *= 2
    return cells
