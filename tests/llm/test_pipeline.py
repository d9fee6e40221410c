"""Every stage of the corpus pipeline against a plain version of it."""

import importlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from shelfline.llm import decontam, mixing, quality
from shelfline.llm.common import table
from shelfline.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, tie string, copies int"


@pytest.fixture(scope="module")
def docs(spark):
    found = [tuple(r) for r in table(spark, SF, "documents").collect()]
    found += [(10_000, None, "en", "s1", 0), (10_001, "", None, None, None), (10_002, " \n", "en", "s1", 2)]
    bench = table(spark, SF, "benchmark").first().text
    found += [(10_003, "Here it stands: " + bench + " and no more.", "en", "s2", 1), (10_004, found[3][1], "de", "s9", 1)]
    return spark.createDataFrame([(*r, 7, "t", 5) for r in found], DOCS).persist()


@pytest.fixture(scope="module")
def stages():
    return dict(importlib.import_module("corpus_pipeline").STAGES)


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_quality_keeps_what_the_scorer_keeps(spark, docs, stages):
    scorer = quality.fitted(docs, table(spark, SF, "labels"))
    rows = docs.collect()
    plain = scorer.scores([r.text or "" for r in rows]) >= quality.CUT
    got = stages["quality"](spark, docs, SF)
    assert got.columns == docs.columns and ids(got) == Counter(r.doc_id for r, keep in zip(rows, plain) if keep)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    k = min(5, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def test_one_of_each_group_stays(spark, docs, stages):
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    order = sorted(i for i in sets if sets[i])
    for at, a in enumerate(order):
        for b in order[at + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = stages["near_duplicates"](spark, docs, SF)
    assert got.columns == docs.columns and ids(got) == Counter(i for i in sets if root(i) == i)
    # repeats of a kept id stay once, the same one on every run
    again = docs.unionByName(docs.where("doc_id in (0, 10000)").replace("t", "a", "tie"))
    kept = [stages["near_duplicates"](spark, d, SF) for d in (again, again.repartition(5))]
    assert ids(kept[0]) == ids(got)
    assert all(sorted(r.tie for r in k.where("doc_id in (0, 10000)").collect()) == ["a", "a"] for k in kept)


def test_contaminated_documents_go(spark, docs, stages):
    def tokens(text):
        return [t for t in re.split(r"[\x09-\x0D\x20!-/:-@\[-`{-~]+", (text or "").lower()) if t]

    items = [tokens(r.text) for r in table(spark, SF, "benchmark").collect()]

    def overlaps(d):
        for i in items:
            w = min(16, len(i))
            if w < 10 or len(d) < w:
                continue
            a, b = np.array(d, object), np.array(i, object)
            for shift in range(w - len(i), len(d) - w + 1):
                lo, hi = max(0, -shift), min(len(i), len(d) - shift)
                same = (a[lo + shift:hi + shift] == b[lo:hi]).astype(int)
                if len(same) >= w and np.convolve(same, np.ones(w, int), "valid").max() >= np.ceil(0.75 * w):
                    return True
        return False

    small = docs.where("length(text) < 4000 or text is null").persist()
    got = stages["decontamination"](spark, small, SF)
    expected = Counter(r.doc_id for r in small.collect() if not overlaps(tokens(r.text)))
    assert got.columns == docs.columns and ids(got) == expected and 10_003 not in expected
    assert decontam.decontaminate(small.limit(0), table(spark, SF, "benchmark")).count() == 0


def test_mixing_takes_what_the_sql_takes(spark, docs, stages):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    taken = con.sql("SELECT doc_id, taken // greatest(size, 1) AS n, size FROM (" + ORACLE["op5_systematic_mix"] + ")").fetchall()
    got = stages["mixing"](spark, docs, SF)
    counted = ids(got)
    assert got.columns == docs.columns and max(counted.values()) <= 2
    assert {i: n for i, n, size in taken if size and n} == {i: counted[i] for i, _, size in taken if size and counted[i]}
    # equal rows share their copies, rows of one id that differ have their own
    twice = docs.unionByName(docs.where("doc_id < 40")).unionByName(docs.where("doc_id < 20").replace("t", "a", "tie"))
    first, second = (Counter(tuple(r) for r in stages["mixing"](spark, d, SF).collect()) for d in (twice, twice.repartition(7)))
    assert first == second and max(first.values()) <= 4
    assert mixing.repeat_mixed(docs.limit(0)).count() == 0


def test_sharding_places_where_the_sql_places(spark, docs, stages):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    placed = con.sql(f"SELECT doc_id, source, shard, slot FROM ({ORACLE['op4_hash_tree_shards']}) JOIN documents USING (doc_id)").fetchall()
    got = stages["sharding"](spark, docs, SF)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(placed, key=str)


def test_run_applies_the_stages_in_order(spark, stages):
    pipeline = importlib.import_module("corpus_pipeline")
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = table(spark, SF, "documents")
    for stage in list(stages.values())[:-1]:
        docs = stage(spark, docs, SF).persist()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert ids(pipeline.run(spark, SF)) == ids(docs) and pipeline.ORACLE_SQL is None
