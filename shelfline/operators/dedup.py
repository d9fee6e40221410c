"""De-duplication and key checks (4.3, 4.4, 5.7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_last(df: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """One row per key: the one that comes last in source order.

    ``order`` must be a total order (e.g. ``struct(file, ordinal)``).  Null keys
    compare equal, so all null-key rows collapse to one, like a pandas
    ``drop_duplicates(keep="last")``.  Expressed as an aggregate so that it is
    partial: each map task keeps only its own last row per key before the shuffle,
    and a hot key costs one row per task, not one group in one task.

    An order that is a column of ``df`` is carried once: the largest struct that begins with it
    is the last row.  Without that (or where a column has no order) ``max_by`` carries both.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    if isinstance(order, str) and order in rest and all(_orderable(df.schema[c].dataType) for c in rest):
        first = F.when(F.col(order).isNotNull(), F.struct(order, *[c for c in rest if c != order]))
        packed = F.max(first).alias("_last")
    else:
        packed = F.max_by(F.struct(*rest), F.col(order) if isinstance(order, str) else order).alias("_last")
    return df.groupBy(*keys).agg(packed).select(*keys, "_last.*").select(*df.columns)


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return _orderable(t.elementType) if isinstance(t, T.ArrayType) else not isinstance(t, (T.MapType, T.VariantType))


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that de-duplication would remove: ``count(*) - count(distinct key)``.

    The key is wrapped in a struct so null keys are counted as one distinct key.
    """
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("n_duplicates"))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (or are null), with their multiplicity."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) | any_null))


def assert_unique_keys(df: DataFrame, keys: list[str], what: str = "source") -> None:
    """Raise when an upsert source hits one key twice (a conflict target would)."""
    bad = key_violations(df, keys).limit(5).collect()
    if bad:
        shown = ", ".join(str(tuple(r[k] for k in keys)) for r in bad)
        raise ValueError(f"{what}: key {keys} not unique or null, e.g. {shown}")
