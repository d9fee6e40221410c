"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over ten tokens that reads five of them and ignores the
others, so a substituted token spoils only the seeds that read it.  Documents and
items are indexed under every mask at every place.  The masks are chosen so that
whatever tokens an accepted window has substituted, one seed inside it reads none of
them: no overlap that the rule below accepts goes without a hit.
Around every hit of the join the document and the item are laid side by side and an overlap is confirmed where
a window of ``WINDOW`` tokens (the whole item if shorter) agrees in at least
``AGREE`` of its places.  DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, staged

#: Token places that each mask reads, out of SPAN.
MASKS = ((0, 2, 5, 8, 9), (1, 2, 3, 7, 9), (0, 4, 6, 7, 9), (0, 1, 3, 4, 5),
         (1, 5, 6, 8, 9), (2, 4, 6, 7, 8), (0, 1, 2, 3, 8))
SPAN = 10
WINDOW, AGREE = 16, 0.75
#: Benchmark tokens up to which its seeds are broadcast (a seed of 32 bytes for each mask).
BROADCAST_TOKENS = 2_000_000


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased tokens between blanks and ASCII punctuation."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s\p{Punct}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, key: str, tokens: str, at: str) -> DataFrame:
    """(key, place, seed) of every window of ``rows`` (key, tokens) under every mask.  The outer
    forms keep Spark from computing the tokens once more in an inferred filter; rows are
    exploded and hashed in generated code, so the token array is not copied per window."""
    windows = F.when(F.size(tokens) >= SPAN, F.sequence(F.lit(0), F.size(tokens) - SPAN))
    placed = rows.select(key, tokens, F.explode_outer(windows).alias(at)).where(F.col(at).isNotNull())
    read = placed.select(key, at, *[F.get(F.col(tokens), F.col(at) + k).alias(f"__{k}") for k in range(SPAN)])
    seeds = F.array(*[F.xxhash64(F.lit(m), *[F.col(f"__{k}") for k in mask]) for m, mask in enumerate(MASKS)])
    return read.select(key, at, F.explode_outer(seeds).alias("seed"))


def agreement(doc: Column, item: Column, shift: Column, q: Column) -> Column:
    """Most agreeing tokens in a window of the item that covers the hit at ``q``; -1 if the
    two overlap in less than a window.  Item place k lies on document place k + shift."""
    w = F.least(F.lit(WINDOW), F.size(item))
    lo = F.greatest(F.lit(0), -shift, q + SPAN - w)
    hi = F.least(q, F.size(item) - w, F.size(doc) - shift - w)
    same = lambda s: F.size(F.filter(F.sequence(s, s + w - 1), lambda k: F.get(doc, k + shift) == F.get(item, k)))
    return F.when(lo <= hi, F.array_max(F.transform(F.sequence(lo, hi), same))).otherwise(F.lit(-1))


def contaminated(docs: DataFrame, benchmark: DataFrame, broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """(doc_id, item_id, n_hits, agree, span, doc_token): every document and benchmark item
    that share an overlap; ``agree`` of ``span`` tokens in the best window, near token
    ``doc_token`` of the document.

    Null and empty texts, and texts or items of fewer than ten tokens, match nothing; a
    null id is returned as null; repeated rows count their hits together; equal items are
    all returned; other columns are not read.
    """
    items = staged(benchmark.where(F.col("text").isNotNull())
                   .select("item_id", token_hashes(F.col("text")).alias("item"))
                   .where(F.size("item") >= SPAN).withColumn("item_key", F.monotonically_increasing_id()), "items")
    tokens = items.agg(F.coalesce(F.sum(F.size("item")), F.lit(0))).first()[0]
    seeds = _seeds(items, "item_key", "item", "q")
    docs = docs.select("doc_id", "text")
    places = _seeds(docs.select("doc_id", token_hashes(F.col("text")).alias("doc")), "doc_id", "doc", "p")
    hits = staged(places.join(bounded_broadcast(seeds, tokens, broadcast_tokens), "seed")
                  .select(F.col("doc_id").alias("hit_id"), "item_key", "p", "q").distinct(), "hits")
    ids = hits.select("hit_id").distinct()
    ids = bounded_broadcast(ids, ids.count(), broadcast_tokens)
    hit_docs = (docs.join(ids, docs["doc_id"].eqNullSafe(ids["hit_id"]), "left_semi")
                .select("doc_id", token_hashes(F.col("text")).alias("doc")))
    scored = (hit_docs.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")))
              .join(bounded_broadcast(items, tokens, broadcast_tokens), "item_key")
              .select("doc_id", "item_id", "p", F.least(F.lit(WINDOW), F.size("item")).alias("span"),
                      agreement(F.col("doc"), F.col("item"), F.col("p") - F.col("q"), F.col("q")).alias("agree")))
    return (scored.where(F.col("agree") >= F.ceil(F.col("span") * F.lit(AGREE)))
            .groupBy("doc_id", "item_id")
            .agg(F.count(F.lit(1)).alias("n_hits"), F.max("agree").cast("int").alias("agree"),
                 F.max("span").alias("span"), F.min("p").alias("doc_token")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item."""
    found = staged(contaminated(docs, benchmark).select(F.col("doc_id").alias("__found")).distinct(), "contaminated")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["__found"]), "left_anti")
