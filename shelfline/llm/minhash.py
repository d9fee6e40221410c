"""MinHash near-duplicates with b-bit signatures.

1. One pass over the texts makes, per document, its distinct word shingles and
   from them a set fingerprint, ``HASHES`` minima kept to ``BITS`` low bits each
   (packed in longs), and ``BANDS`` band keys of ``ROWS`` minima.
2. Documents of one fingerprint are one class; only its representative (the
   smallest id) goes on, so exact copies cost one aggregate.
3. Representatives that share a band key form a bucket.  Buckets are not
   expanded into pairs: in each of a few rounds every member is paired with one
   pivot of its bucket, in later rounds only across components found so far.
   What is then still divided is paired exactly, the members outside the
   bucket's largest component against all others, each pair in its first shared
   bucket only (in large buckets in blocks of those members, for the load alone).
   The first pivot of a bucket is its most central member, the one with the most
   companions over all its buckets.
4. A pair's similarity is estimated from the packed signatures by bit counts,
   corrected for the chance agreement of ``BITS`` bits, and dropped when far
   below the threshold; what is left is confirmed on the full shingle sets.
   Members of divided buckets also carry a parity sketch of their sets: the bits
   in which two sketches differ never outnumber the shingles in which the sets
   differ, so a pair that differs in too many bits is ruled out without error.
5. Components are found by joins (``components``).

At similarity 0.8 a pair shares no band with probability (1 - 0.8^6)^32 = 6e-5,
and the estimate errs low by the margin with probability 2e-5.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, one_of_each, per_text, staged
from .components import connected_components

HASHES, BITS, ROWS = 192, 2, 6
BANDS = HASHES // ROWS
PERCENT = 80
#: The estimate must reach the threshold less this margin (over four standard errors).
MARGIN = 0.14
#: Members outside the largest component of a divided bucket that one block pairs with all of it.
LARGE_BUCKET = 512
PIVOT_ROUNDS = 2

_rng = np.random.default_rng(20250101)
_MULTIPLY = (_rng.integers(1, 1 << 31, HASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_BAND_MULTIPLY = _rng.integers(1, 1 << 62, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PER_LONG = 64 // BITS
LONGS = HASHES // PER_LONG
#: Bits of a parity sketch, a power of two; sets of many more shingles are left to the estimate.
SKETCH_BITS = 1024


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; one shingle if there are fewer words."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter([digest(w) for w in tokens], np.uint64, len(tokens))
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mixed(out * np.uint64(0xC2B2AE3D27D4EB4F) + h[i:len(h) - k + 1 + i])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The HASHES minima (32 bits) of a non-empty set."""
    x = (_mixed(shingles) >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, np.uint32(0xFFFFFFFF))
    for i in range(0, len(x), 512):
        np.minimum(low, (x[i:i + 512, None] * _MULTIPLY + _ADD).min(axis=0), out=low)
    return low


def packed(minima: np.ndarray) -> np.ndarray:
    """Rows of minima to rows of LONGS signed longs holding BITS mixed low bits of each."""
    m = minima.astype(np.uint64)
    low = ((m ^ (m >> np.uint64(7)) ^ (m >> np.uint64(16))) & np.uint64((1 << BITS) - 1)).reshape(-1, LONGS, PER_LONG)
    return np.bitwise_or.reduce(low << (np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)), axis=2).view(np.int64)


def band_keys(minima: np.ndarray) -> np.ndarray:
    m = minima.astype(np.uint64).reshape(-1, BANDS, ROWS)
    return _mixed((m * _BAND_MULTIPLY).sum(axis=2, dtype=np.uint64)).view(np.int64)


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """Signed longs whose bit k is the parity of the number of shingles that hash to k."""
    slots = _mixed(shingles ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)
    odd = (np.bincount(slots.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, sig, bands); sig and bands null for an empty set."""
    def run(ids, texts):
        sets = [shingle_hashes(t, words) for t in texts]
        full = [i for i, s in enumerate(sets) if len(s)]
        sig, bands = [None] * len(sets), [None] * len(sets)
        if full:
            minima = np.stack([signature(sets[i]) for i in full])
            for i, p, b in zip(full, packed(minima), band_keys(minima)):
                sig[i], bands[i] = p, b
        return pd.DataFrame({
            "doc_id": pd.array([None if i is None else int(i) for i in ids], "Int64"),
            "n_shingles": [len(s) for s in sets],
            "f1": [int(np.add.reduce(s).view(np.int64)) if len(s) else 0 for s in sets],
            "f2": [int(np.bitwise_xor.reduce(_mixed(s)).view(np.int64)) if len(s) else 0 for s in sets],
            "sig": sig, "bands": bands})

    return per_text(docs, run, "doc_id long, n_shingles long, f1 long, f2 long, sig array<long>, bands array<long>")


def estimated_similarity(a: Column, b: Column) -> Column:
    """Share of agreeing b-bit values, less the agreement expected of unequal minima."""
    ones = sum(1 << i for i in range(0, 64, BITS))
    ones = ones - (1 << 64) if ones >= 1 << 63 else ones

    def unequal(i: int) -> Column:
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        any_bit = x
        for s in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, s))
        return F.bit_count(any_bit.bitwiseAND(F.lit(ones)))

    differ = unequal(0)
    for i in range(1, LONGS):
        differ = differ + unequal(i)
    chance = 1.0 / (1 << BITS)
    return ((F.lit(1.0) - differ / F.lit(float(HASHES))) - F.lit(chance)) / F.lit(1.0 - chance)


def _differ(a: Column, b: Column, i: int) -> Column:
    return F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))


def _sketches_allow(percent: int) -> Column:
    """Whether sketches (ka, kb) leave room for the threshold: two sets of na and nb shingles that
    reach it differ in at most (na + nb) (100 - percent) / (100 + percent) of them."""
    a, b = F.col("ka"), F.col("kb")
    differ = _differ(a, b, 0)
    for i in range(1, SKETCH_BITS // 64):
        differ = differ + _differ(a, b, i)
    return differ * F.lit(100 + percent) <= (F.col("na") + F.col("nb")) * F.lit(100 - percent)


def _possible(percent: int) -> Column:
    """Whether sizes (na, nb) and signatures (sa, sb) of a pair (a, b) allow the threshold."""
    sizes = F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb")
    near = estimated_similarity(F.col("sa"), F.col("sb")) >= F.lit(percent / 100 - MARGIN)
    return (F.col("a") != F.col("b")) & sizes & near


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _likely(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, na, sa, b, nb, sb) whose sizes and estimate allow the threshold, as (a, b)."""
    return _ordered(pairs.where(_possible(percent)))


def _of_documents(docs: DataFrame, ids: DataFrame, words: int, made, column: str) -> DataFrame:
    """(id, ``column``): ``made`` of the shingle set of each document listed in ``ids`` (__id)."""
    wanted = docs.join(bounded_broadcast(ids, ids.count()), docs["doc_id"] == ids["__id"], "left_semi")

    def run(ids, texts):
        return pd.DataFrame({"id": [int(i) for i in ids], column: [made(shingle_hashes(t, words)) for t in texts]})

    return staged(per_text(wanted, run, f"id long, {column} array<long>").dropDuplicates(["id"]), column)


def confirmed(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose full shingle sets reach the threshold."""
    pairs = staged(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("__id")).distinct()
    sets = _of_documents(docs, ids, words, lambda s: s.view(np.int64), "shingles")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(left, "a").join(right, "b")
            .where(F.lit(100) * both >= F.lit(percent) * (F.size("x") + F.size("y") - both))
            .select("a", "b"))


def _divided(members: DataFrame) -> DataFrame:
    """Buckets whose members are in more than one component, with the largest component and
    the number of members outside it."""
    per = members.groupBy("band", "key", "comp").agg(F.count(F.lit(1)).alias("c"))
    return (per.groupBy("band", "key").agg(F.count(F.lit(1)).alias("comps"), (F.sum("c") - F.max("c")).alias("outside"),
                                           F.max_by("comp", "c").alias("largest")).where("comps > 1"))


def _across(inside: DataFrame, percent: int, large_bucket: int) -> DataFrame:
    """Likely pairs across components: members outside their bucket's largest component against
    all.  A pair is made once, in the bucket of the first band that it shares; the members
    outside are dealt into blocks of about ``large_bucket``, each of which meets the whole bucket."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("outside") / F.lit(max(1, large_bucket)))).cast("int")
    probes = inside.where("comp <> largest").select(
        "band", "key", F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block"),
        F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"), F.col("comp").alias("ca"),
        F.col("bands").alias("xa"), F.col("sketch").alias("ka"))
    others = inside.select(
        "band", "key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
        F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"),
        F.col("comp").alias("cb"), F.col("bands").alias("xb"), F.col("sketch").alias("kb"), "largest")
    p, o = probes.alias("p"), others.alias("o")
    before = F.size(F.filter(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                             lambda k: (k < F.col("p.band")) & (F.get(F.col("xa"), k) == F.get(F.col("xb"), k))))
    on = F.col("p.band") == F.col("o.band")
    for condition in (F.col("p.key") == F.col("o.key"), F.col("p.block") == F.col("o.block"),
                      F.expr("ca <> cb and (cb = largest or a < b)"), _possible(percent), _sketches_allow(percent), before == 0):
        on = on & condition
    return _ordered(p.join(o, on).select("a", "b"))


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = PERCENT,
                    large_bucket: int = LARGE_BUCKET, pivot_rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Words are lower-cased (A-Z) runs without blanks.  Null and empty texts have no shingles
    and link with nothing; a null id links with nothing and has a null component; repeated
    rows share a component and an outcome; other columns are not read; an empty table gives
    no rows.  ``kept`` holds for the smallest id of a component, for unlinked rows and for
    null ids.
    """
    docs = docs.select("doc_id", "text")
    every = staged(signatures(docs, words), "signatures")
    linkable = every.where("n_shingles > 0 and doc_id is not null")
    reps = staged(linkable.groupBy("f1", "f2", "n_shingles")
                  .agg(F.min(F.struct("doc_id", "sig", "bands")).alias("r"))
                  .select("f1", "f2", F.col("n_shingles").alias("n"), F.col("r.doc_id").alias("rep"),
                          F.col("r.sig").alias("sig"), F.col("r.bands").alias("bands")), "reps")
    # only ids travel with the band keys: most of them are alone in their bucket
    keyed = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    buckets = staged(keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "buckets")
    shared = staged(keyed.join(buckets, ["band", "key"]), "shared")
    central = shared.groupBy("rep").agg(F.sum("m").alias("w")).join(reps.select("rep", "n", "sig"), "rep")
    members = staged(shared.select("rep", "band", "key").join(central, "rep"), "members")

    labels = None
    links = None
    for at in range(pivot_rounds):
        now = _labelled(members, labels)
        order = -F.col("w") if at == 0 else F.xxhash64(F.lit(at), "band", "rep")
        pivots = now.groupBy("band", "key").agg(F.min(F.struct(order.alias("h"), "rep", "n", "sig")).alias("p"),
                                                F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        pivots = staged(pivots.where("lo <> hi").select("band", "key", "p.rep", "p.n", "p.sig")
                        .toDF("band", "key", "b", "nb", "sb"), "pivots")
        pairs = now.select("band", "key", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"), "comp")
        pairs = pairs.join(pivots, ["band", "key"])
        if labels is not None:
            of_pivot = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
            pairs = pairs.join(of_pivot, "b", "left").where(F.col("comp") != F.coalesce("cb", "b"))
        links, labels = _joined(docs, links, _likely(pairs, percent), words, percent)

    now = _labelled(members, labels)
    divided = staged(_divided(now).select("band", "key", "largest", "outside"), "divided")
    inside = staged(now.join(divided, ["band", "key"]), "inside")
    sketches = _of_documents(docs, inside.select(F.col("rep").alias("__id")).distinct(), words, parity_sketch, "sketch")
    inside = inside.join(sketches.withColumnRenamed("id", "rep"), "rep").join(reps.select("rep", "bands"), "rep")
    pairs = _across(inside, percent, large_bucket)
    links, labels = _joined(docs, links, pairs, words, percent)

    classes = (reps.select("f1", "f2", F.col("n").alias("n_shingles"), "rep")
               .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
               .select("f1", "f2", "n_shingles", F.coalesce("component", "rep").alias("class_id")))
    classes = staged(classes, "classes")
    linked = (every.drop("sig", "bands").join(classes, ["f1", "f2", "n_shingles"], "left")
              .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.coalesce("class_id", "doc_id")).otherwise(F.col("doc_id"))))
    linked = linked.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return linked.select("doc_id", "n_shingles", "component_id",
                         F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("comp", F.col("rep"))
    return (members.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
            .withColumn("comp", F.coalesce("component", "rep")).drop("component"))


def _joined(docs: DataFrame, links: DataFrame | None, pairs: DataFrame, words: int, percent: int):
    """All links so far with the confirmed ``pairs``, and the components they make."""
    new = confirmed(docs, pairs, words, percent)
    links = staged(new if links is None else links.unionByName(new), "confirmed")
    return links, staged(connected_components(links), "labels")


def keep_one(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` (all columns) with one row of each component; rows that repeat an id stay once, the
    first by their columns.  Rows without an id, words or text stay; an empty table stays empty.

    The texts are not shuffled: ids of dropped and of repeated documents are broadcast as far as
    their count allows, else they meet the texts in one join.
    """
    found = staged(near_duplicates(docs, words, percent).where("doc_id is not null")
                   .select(F.col("doc_id").alias("__id"), "kept"), "linked")
    dropped = staged(found.where("not kept").select("__id").distinct(), "dropped")
    kept = docs.join(bounded_broadcast(dropped, dropped.count()), docs["doc_id"] == dropped["__id"], "left_anti")
    repeated = staged(found.where("kept").groupBy("__id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__id"),
                      "repeated")
    n = repeated.count()
    if not n:
        return kept
    again = bounded_broadcast(repeated, n)
    return (kept.join(again, kept["doc_id"] == again["__id"], "left_anti")
            .unionByName(one_of_each(kept.join(again, kept["doc_id"] == again["__id"], "left_semi"), ["doc_id"])))
