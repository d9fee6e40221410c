"""Bronze and silver conforming: flatten, stringify, lineage, rename, typing (3.1-3.8)."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.schemas import SILVER
from shelfline.functions import (as_text, lenient_date, lenient_double, lenient_long,
                                 trim_blank_null)

log = logging.getLogger(__name__)

_VARIANT_MAP = "map<string,variant>"


def _as_object(v: Column) -> Column:
    """The variant as a map when it holds a JSON object, else null (a type check, no rendering)."""
    return F.try_variant_get(v, "$", _VARIANT_MAP)


def _text(v: Column) -> Column:
    """Text of a variant, as its cast to text gives it.

    The cast escapes each key and string of a nested value by a JSON writer made for it, which takes
    most of a record's time.  A list of objects is taken as maps and written by one writer: the same
    text (maps keep the variant's order of keys), at about half the time.
    """
    text = F.to_json(F.try_variant_get(v, "$", "array<map<string,variant>>"))
    # an element that is no object would be null: lists with nulls at all are left to the cast
    whole = ~(text.startswith("[null") | text.contains(",null"))
    return F.when(whole, text).otherwise(F.try_variant_get(v, "$", "string"))


def _child_text(v: Column, key: str) -> Column:
    """Text of a child of a variant; paths know no escapes, so quoted keys go through a map."""
    if "'" in key or "\\" in key:
        return F.try_variant_get(_as_object(v)[F.lit(key)], "$", "string")
    return F.try_variant_get(v, f"$['{key}']", "string")


#: Columns that a flattening may give, and children that one object key may give as columns.
MAX_COLUMNS, MAX_CHILDREN = 2_000, 500
#: Column of the keys beyond ``MAX_COLUMNS``: one JSON object per record.
REST = "_rest"
#: Child of a key that is taken as one JSON column; and the entry that stands for ``REST``.
WHOLE, OTHERS = Ellipsis, (None, Ellipsis)


def discover_keys(records: DataFrame, record_col: str = "record", max_columns: int = MAX_COLUMNS,
                  max_children: int = MAX_CHILDREN) -> list[tuple]:
    """(key, child) of the one-level flattening, in first-appearance order.

    Objects contribute one pair per child, everything else (key, None); a key may
    itself hold dots, so the two parts stay apart.  The scan is an aggregate with
    partial combining, so only distinct pairs reach the driver, at most ``max_columns`` of them.
    The two positions are kept as one number, whose minimum a hash aggregate takes: a task holds
    its distinct pairs, not (sorted) a row per pair of every record.

    Objects keyed by data would give a column for each of their keys.  Where there are more pairs
    than that, keys are taken in the order of the records that hold them (ties: first position, then
    name): an object of more than ``max_children`` children, or one whose children no longer fit, stays
    one JSON column (key, WHOLE), and keys that find no room share the column ``REST``
    (last entry OTHERS).  No value is lost, and the counting stays on the executors.
    """
    top = F.from_json(F.col(record_col), _VARIANT_MAP)
    pairs = records.select(F.posexplode(top).alias("pos", "k", "v"))
    found = _distinct_pairs(pairs)
    rows = found.limit(max_columns + 1).collect()
    if len(rows) > max_columns:
        rows = _within_bounds(pairs, found, max_columns, max_children)
    rows.sort(key=lambda r: (r["first"]["pos"], r["first"]["sub_pos"], r["k"],
                             "" if r["child"] in (None, WHOLE) else r["child"]))
    keys = [(r["k"], r["child"]) for r in rows if r["k"] is not None]
    return keys + [OTHERS] if len(keys) < len(rows) else keys


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    """Each (key, child) once, with its first position."""
    children = F.coalesce(F.map_keys(_as_object(F.col("v"))), F.array(F.lit(None).cast("string")))
    flat = pairs.select("pos", "k", F.posexplode(children).alias("sub_pos", "child"))
    place = F.shiftleft(F.col("pos").cast("long"), 32) + F.col("sub_pos")
    first = F.struct(F.shiftright("_place", 32).cast("int").alias("pos"),
                     F.col("_place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("sub_pos"))
    return flat.groupBy("k", "child").agg(F.min(place).alias("_place")).select("k", "child", first.alias("first"))


def _within_bounds(pairs: DataFrame, found: DataFrame, max_columns: int, max_children: int) -> list[dict]:
    """The entries of ``discover_keys`` for records with more pairs than columns may be."""
    held = pairs.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("pos"))
    width = found.groupBy("k").agg(F.count(F.lit(1)).alias("width"))
    per_key = (held.join(width, "k").orderBy(F.desc("n"), "pos", "k")
               .limit(max_columns + 1).collect())
    room, split, out = max_columns - 1, [], []          # one column is left for the rest
    for r in per_key:
        if r["width"] <= min(max_children, room):
            split.append(r["k"])
            room -= r["width"]
        elif room:
            out.append({"k": r["k"], "child": WHOLE, "first": {"pos": r["pos"], "sub_pos": 0}})
            room -= 1
        else:
            out.append({"k": None, "child": WHOLE, "first": {"pos": 1 << 31, "sub_pos": 0}})
            break
    # at most max_columns rows reach the driver, as the widths were counted above
    names = pairs.sparkSession.createDataFrame([(k,) for k in split], "k string")
    return out + [{"k": r["k"], "child": r["child"], "first": r["first"]}
                  for r in found.join(F.broadcast(names), "k", "left_semi").collect()]


def flatten_one_level(records: DataFrame, keys: list[tuple] | None = None,
                      record_col: str = "record") -> DataFrame:
    """JSON record text -> one text column per key; objects one level deep (3.1, 3.2).

    Records are parsed once into a map of variants.  Scalars become their text
    form, objects nested deeper than one level and arrays stay JSON text, JSON
    null becomes null.  A child path on a value that is not an object (a string
    that merely looks like one, an array) is null.  A key that is an object in some
    records and a scalar in others has a column of its own, null for the objects,
    beside those of its children.  Keys with dots are taken whole; should one share
    its name with a child column, the first value found is kept.  Other columns are kept.
    Keys beyond the bounds of ``discover_keys`` stay JSON: an object as one column, rare keys
    together in ``_rest`` (null where a record has none of them).
    """
    if keys is None:
        keys = discover_keys(records, record_col)
    top = F.from_json(F.col(record_col), _VARIANT_MAP)
    keep = [c for c in records.columns if c != record_col]
    staged = records.select(*keep, top.alias("_m"))
    parents = {k for k, child in keys if child not in (None, WHOLE)}
    values: dict[str, list[Column]] = {}
    for k, child in keys:
        if (k, child) == OTHERS:
            named = sorted({k for k, _ in keys if k is not None})
            others = F.map_filter(F.col("_m"), lambda key, _: ~key.isin(named))
            values.setdefault(REST, []).append(F.when(F.size(others) > 0, F.to_json(others)))
            continue
        v = F.col("_m")[F.lit(k)]
        if child not in (None, WHOLE):
            values.setdefault(f"{k}.{child}", []).append(_child_text(v, child))
        else:
            text = _text(v)
            values.setdefault(k, []).append(F.when(_as_object(v).isNull(), text) if k in parents else text)
    return staged.select(*keep, *[F.coalesce(*found).alias(n) for n, found in values.items()])


def stringify_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Every column to nullable text: nested as JSON, NaN/null as null (3.2)."""
    return df.select(*[
        F.col(f"`{f.name}`") if f.name in exclude
        else as_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
        for f in df.schema.fields])


def add_lineage(df: DataFrame, source: Column | str, ingested_at: str) -> DataFrame:
    """Source file and one run-wide ingest timestamp, fixed on the driver (3.3)."""
    src = F.lit(source) if isinstance(source, str) else source
    return df.withColumn("_source_file", src).withColumn("_ingested_at", F.lit(ingested_at))


def rename_allowlist(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep only mapped columns that exist, in map order, renamed (3.4)."""
    present = [(s, t) for s, t in mapping.items() if s in df.columns]
    return df.select(*[F.col(f"`{s}`").alias(t) for s, t in present])


#: Declared type of every silver column.
_SILVER_TYPES = {f.name: f.dataType for schema in SILVER.values() for f in schema.fields}


def conform_types(df: DataFrame) -> DataFrame:
    """Trim text, blanks to null; lenient id, numeric and date parsing by the declared
    silver types (3.5-3.8)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        is_text = isinstance(f.dataType, T.StringType)
        declared = _SILVER_TYPES.get(f.name)
        if isinstance(declared, T.LongType):
            c = lenient_long(c)
        elif isinstance(declared, T.DoubleType):
            c = lenient_double(c) if is_text else c.cast("double")
        elif isinstance(declared, T.DateType):
            c = lenient_date(c) if is_text else c.cast("date")
        elif is_text:
            c = trim_blank_null(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def align_to_schema(df: DataFrame, schema: T.StructType, defaults: dict | None = None,
                    what: str = "target") -> DataFrame:
    """Project onto a declared schema (6.2, 3.19).

    Columns unknown to the target are dropped with a warning; target columns the
    frame lacks come from ``defaults`` or as nulls; values are cast to the target
    types (decimal overflow raises under ANSI).  Integers from floats round half
    away from zero, as a typed database insert does.
    """
    defaults = defaults or {}
    extra = sorted(set(df.columns) - {f.name for f in schema.fields})
    if extra:
        log.warning("%s: columns without a destination (dropped): %s", what, extra)
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f"`{f.name}`")
            src_type = df.schema[f.name].dataType
            if (isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType))
                    and isinstance(src_type, (T.DoubleType, T.FloatType, T.DecimalType))):
                c = F.round(c, 0)
            c = c.cast(f.dataType)
        elif f.name in defaults:
            d = defaults[f.name]
            c = (d if isinstance(d, Column) else F.lit(d)).cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def enforce_not_null(df: DataFrame, schema: T.StructType, what: str = "target") -> DataFrame:
    """``df`` with the NOT NULL columns of a declared schema enforced (2.5).

    A null in such a column raises in the task that meets it, so the writing job fails before its
    commit and the table keeps its state.  The test is part of the projection: no pass of its own,
    and none at all on columns that cannot be null.
    """
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if not f.nullable and f.name in df.columns and df.schema[f.name].nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"{what}.{f.name} must not be null")).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)
