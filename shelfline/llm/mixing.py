"""Mixing sources to target weights by systematic sampling.

Within a source every document has the same expected number of copies (target
over size, 2 at most).  Documents stand in order of size; the prefix sum of the
expected copies, shifted by one random offset per source, is cut at the integers,
and a document is emitted once per integer its step crosses.  Because neighbours
in the order have nearly the same size, the words taken follow the target
closely.  All of it is DataFrame expressions; the prefix sums run over run counts
(``ranks``), so a source that holds most rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, bounded_broadcast, fraction, hash52, one_of_each, staged
from .ranks import cells_for, numbered, run_offsets

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2.0
CELLS, ROWS_PER_RUN = 64, 2_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def size_band(size: str) -> Column:
    """Steps of an eighth of an octave: bit length, then the three bits after the first."""
    return F.expr(f"cast(length(bin({size})) * 8 + (shiftright({size}, greatest(length(bin({size})) - 4, 0)) & 7) as int)")


def water_fill(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
               cap: float = CAP) -> DataFrame:
    """Target of each source: ``share`` of all sizes by weight, none above ``cap`` times its size.

    ``sources``: source, source_size.  Sources in code point order, null last, take the
    weights in turn.  A target that would exceed its cap stops there and the excess goes
    to the others by weight: in order of cap per weight, the first source whose share at
    the level reached so far fits sets the final level.  One row per source, so the
    unpartitioned windows see only as many rows as there are sources.
    """
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(at, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(cap))
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("left", F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("weights_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("level", F.col("left") / F.col("weights_left")))
    fits = F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))
    s = s.withColumn("final", F.min(fits).over(whole)["level"])
    return s.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * F.col("final")).alias("target"))


def mix(docs: DataFrame, count: int, size: Column | None = None, tie: Sequence[Column] = (),
        seed: str = "mix") -> DataFrame:
    """``docs`` (doc_id, source, anything else) with ``size``, ``source_size``, ``target`` and
    ``copies``; columns of these names are replaced.

    ``size``: the size of a row (None: the words of ``text``).  Rows of one size and id stand in
    order of ``tie``.  Null or empty texts have size 0 and are sampled like the others; a null
    source is a source; repeated rows are interchangeable.  ``count``: number of rows, which sets
    how finely sources are cut.
    """
    cells = cells_for(count, CELLS, ROWS_PER_RUN)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    sized = docs.withColumn("__size", word_count(F.col("text")) if size is None else size)
    sized = sized.drop("size", "source_size", "target", "copies").withColumnRenamed("__size", "size")
    keyed = (sized.withColumn("__source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")))
             .withColumn("__band", size_band("size"))
             .withColumn("__cell", F.pmod(hash52(F.concat(F.lit(seed + "|"), key)), F.lit(cells)).cast("int")))
    runs = staged(keyed.groupBy("__source", "__band", "__cell")
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "runs")
    sources = (runs.groupBy("__source").agg(F.sum("words").alias("source_size"))
               .withColumn("source", F.when(F.col("__source") != "null", F.substring(F.col("__source"), 2, 1 << 30))))
    targets = (water_fill(sources)
               .withColumn("__source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")))
               .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
               .withColumn("start", fraction(F.concat(F.lit(seed + "|offset|"), F.col("__source"))))
               .select("__source", "source_size", "target", "rate", "start"))
    offsets = staged(run_offsets(runs, "__source", "__band", "__cell").join(targets, "__source"), "offsets")
    order = [F.col("size"), F.col("doc_id").asc_nulls_last(), *tie]
    ranked = numbered(keyed, offsets, "__source", "__band", "__cell", order, "__rank")
    crossed = lambda k: F.floor(F.col("start") + F.col("rate") * k)
    copies = (crossed(F.col("__rank") + 1) - crossed(F.col("__rank"))).cast("int")
    return (ranked.withColumn("copies", copies)
            .drop("__source", "__band", "__cell", "__rank", "rate", "start"))


def repeat_mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with every row as often as the mix takes it (0 to 2 times).

    Only ids, sizes and a checksum of each row go through the mix; the copies come back to the
    rows in one join, broadcast as far as their count allows.  Equal rows share their copies.
    Nulls and empty texts as in ``mix``; an empty table stays empty.
    """
    check = F.xxhash64(*docs.columns)
    narrow = staged(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                                word_count(F.col("text")).alias("size"), check.alias("__check")), "narrow")
    mixed = mix(narrow, narrow.count(), F.col("size"), [F.col("__check")])
    taken = staged(mixed.groupBy(F.col("doc_id").alias("__id"), "__check")
                   .agg(F.sum("copies").cast("int").alias("__copies"), F.count(F.lit(1)).alias("__rows")).where("__copies > 0"), "copies")
    keyed = docs.withColumn("__check", check)
    found = bounded_broadcast(taken.withColumnRenamed("__check", "__same"), taken.count())
    rows = keyed.join(found, keyed["doc_id"].eqNullSafe(found["__id"]) & (F.col("__check") == F.col("__same")))
    if not taken.where("__rows > 1").isEmpty():
        rows = rows.where("__rows = 1").unionByName(one_of_each(rows.where("__rows > 1"), ["__id", "__check"]))
    copies = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    return rows.select(*docs.columns, copies.alias("__copy")).drop("__copy")


def mix_documents(docs: DataFrame) -> DataFrame:
    """One row per document with the words the mix takes from it.

    Empty table: no rows.  Other columns are not read.
    """
    sized = staged(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                               word_count(F.col("text")).alias("size"),
                               F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("tie")), "sizes")
    out = mix(sized, sized.count(), F.col("size"), [F.col("tie")])
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))
