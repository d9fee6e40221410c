"""Operators on tables, against brute force on small fixtures with nulls, ties and repeats."""

import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import covertree, decontam, minhash, mixing, pii, quality, secrets, sharding, toxicity
from shelfline.llm import license as lic
from shelfline.llm.components import connected_components
from shelfline.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, component_id string"
RNG = np.random.default_rng(11)
VOCABULARY = [f"w{k}" for k in range(300)]
BENCH = [" ".join(RNG.choice(VOCABULARY, 24)) for _ in range(3)]


def texts():
    base = RNG.choice(VOCABULARY, 90).tolist()
    out = [None, "", "  \n", "one", "One two\tthree", " ".join(base)]
    for k in range(12):  # near copies of falling similarity
        changed = list(base)
        for at in RNG.choice(90, k, replace=False):
            changed[at] = f"z{k}{at}"
        out.append(" ".join(changed))
    out += [" ".join(RNG.choice(VOCABULARY, 40)) for _ in range(25)]
    out += [" ".join(RNG.choice(VOCABULARY, 30)) + " " + BENCH[0] + " tail", out[5], out[5].upper(), out[-1]]
    words = BENCH[1].split()
    words[5] = words[14] = "other"
    return out + ["head " + " ".join(words), " ".join(RNG.choice(VOCABULARY, 4000))]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i % 7 == 6 else f"s{i % 3 if i % 2 else 0}", 1, 7, "x") for i, t in enumerate(texts())]
    rows += [rows[5], rows[20], (None, rows[5][1], "en", "s0", 1, 7, "x")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (3, 30), (5, 5)] + [(100, k) for k in range(101, 160)] + [(k, k + 1) for k in range(200, 240)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for p in links for n in p if p[0] != p[1]}
    assert got == union_find(nodes, [p for p in links if p[0] != p[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("words, large, rounds", [(4, 512, 2), (5, 0, 1)])
def test_minhash_equals_brute_force(spark, docs, words, large, rounds):
    got = minhash.near_duplicates(docs, words, large_bucket=large, pivot_rounds=rounds).collect()
    sets = {r.doc_id: shingles(r.text, words) for r in docs.collect() if r.doc_id is not None}
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = union_find(sets, links)
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), comp[r.doc_id], comp[r.doc_id] == r.doc_id)


@pytest.mark.parametrize("large", [0, 1, 512])
def test_a_pair_that_shares_one_band_only_is_linked_in_any_bucket(spark, large):
    rows, links = [], {}
    for t, n, kept in ((2796, 76, 62), (4277, 43, 35)):
        words = [f"a{t}x{k}" for k in range(n)]
        pair = [" ".join(words), " ".join(words[:kept])]
        a, b = (minhash.signature(minhash.shingle_hashes(x, 4)).reshape(minhash.BANDS, minhash.ROWS) for x in pair)
        assert (a == b).all(axis=1).sum() == 1
        links |= {len(rows): len(rows), len(rows) + 1: len(rows)}
        rows += [(len(rows) + k, x) for k, x in enumerate(pair)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), large_bucket=large, pivot_rounds=0)
    assert {r.doc_id: r.component_id for r in got.collect()} == links


def test_keep_one_keeps_columns_and_rows(docs, empty):
    kept = minhash.keep_one(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and len(ids) == len(set(ids)) and None in ids and {0, 1, 2, 3} <= set(ids)
    assert minhash.keep_one(empty).count() == 0 and minhash.near_duplicates(empty).count() == 0


def test_decontamination(spark, docs, empty):
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(BENCH)] + [(7, None), (8, "few words")], "item_id long, text string")
    rows = {r.doc_id: (r.text or "").lower().split() for r in docs.collect() if r.doc_id is not None}
    expected = set()
    for d, words in rows.items():
        for i, item in enumerate(b.split() for b in BENCH):
            w = min(decontam.WINDOW, len(item))
            for shift in range(-len(item), len(words)):
                for s in range(max(0, -shift), min(len(item), len(words) - shift) - w + 1):
                    if sum(item[k] == words[k + shift] for k in range(s, s + w)) >= math.ceil(0.75 * w):
                        expected.add((d, i))
    for limit in (decontam.BROADCAST_TOKENS, 0):
        found = decontam.contaminated(docs, bench, limit)
        assert {(r.doc_id, r.item_id) for r in found.collect()} == expected and expected
    clean = decontam.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == set(rows) - {d for d, _ in expected} | {None}
    assert decontam.contaminated(empty, bench).count() == 0 and decontam.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_decontamination_masks_meet_every_accepted_substitution():
    for w in range(decontam.SPAN, decontam.WINDOW + 1):
        for spoilt in itertools.combinations(range(w), w - math.ceil(decontam.AGREE * w)):
            assert any(not {at + k for k in mask} & set(spoilt)
                       for mask in decontam.MASKS for at in range(w - decontam.SPAN + 1)), (w, spoilt)


def test_decontamination_finds_every_random_substitution(spark):
    rng = np.random.default_rng(5)
    items, rows = [], []
    for n, spoilt in ((10, 1), (10, 2), (12, 2), (12, 3), (16, 2), (16, 3), (16, 4), (20, 4)):
        for _ in range(40):
            item = [f"i{len(items)}t{k}" for k in range(n)]
            edited = list(item)
            for at in rng.choice(min(n, 16), spoilt, replace=False):
                edited[at] = "edited"
            filler = [f"f{k}" for k in range(rng.integers(0, 9))]
            rows.append((len(items), " ".join(filler + edited + ["end"])))
            items.append((len(items), " ".join(item)))
    found = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"),
                                  spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(k, k) for k in range(len(items))}


def test_mixing(docs, empty):
    got = mixing.mix_documents(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_documents(docs).collect()), key=str)
    sizes = {}
    for r in docs.collect():
        sizes.setdefault(r.source, []).append(len((r.text or "").split()))
    total = {s: sum(v) for s, v in sizes.items()}
    order = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free = {}, set(order)
    while True:
        left = 1.5 * sum(total.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * total[s]]
        if not over:
            target |= share
            break
        target |= {s: 2.0 * total[s] for s in over}
        free -= set(over)
    assert len(got) == docs.count() and all(0 <= r.taken <= 2 * r.size for r in got)
    by = {round(t, 6) for t in target.values()}
    assert {round(r.target, 6) for r in got} == by
    for s in order:
        mine = [r for r in got if r.source_size == total[s]]
        assert abs(sum(r.taken for r in mine) - target[s]) <= 2 * max(max(v) for v in sizes.values())
    assert mixing.mix_documents(empty).count() == 0


def test_sharding(docs, empty):
    got = sharding.shard_documents(docs).collect()
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    slots = {}
    for r in got:
        assert r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.size == len(text[r.doc_id].encode()) + 8
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(got) == docs.count()
    assert sharding.shard_documents(empty).count() == 0


def test_tree_growth_moves_rows_only_into_the_new_shard(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    for n in (24, 25, 31):
        moved = (sharding.shard_rows(ids, sharding.fleet(n), grown=sharding.fleet(n + 1))
                 .where("shard <> grown_shard").groupBy("grown_shard").count().collect())
        assert [r.grown_shard for r in moved] == [n] and 0.5 < moved[0]["count"] * (n + 1) / 20_000 < 1.5
    counts = sharding.shard_rows(ids, sharding.fleet(24)).groupBy("shard").count().collect()
    assert len(counts) == 24 and max(r["count"] for r in counts) < 1.2 * 20_000 / 24


def test_cover_tree_equals_brute_force(spark):
    x = RNG.normal(size=(260, 8))
    x[60:160] = x[0] + RNG.normal(size=(100, 8)) * 0.12
    x[200:220] = x[5] * 3.0
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [1.0, None] + [0.0] * 6), (1004, []),
             (1005, [1.0, 2.0]), (1006, [2.0, 4.0]), (None, rows[0][1]), rows[3]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n_links", F.lit("x"))
    got = covertree.near_duplicates(frame).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    comp = union_find(range(260), list(zip(*np.nonzero(linked))))
    assert len(got) == len(rows) - 1
    for r in got:
        if r.vec_id is None or 1000 <= r.vec_id <= 1004:
            assert r.n_links == 0 and r.component_id == r.vec_id and r.kept
        elif r.vec_id > 1004:
            assert (r.n_links, r.component_id) == (1, 1005)
        else:
            assert (r.n_links, r.component_id, r.kept) == (linked[r.vec_id].sum(), comp[r.vec_id], comp[r.vec_id] == r.vec_id)
    assert covertree.near_duplicates(frame.limit(0)).count() == 0


def test_traversal_of_dense_and_scattered_vectors_equals_the_product():
    rng = np.random.default_rng(0)
    spread = rng.choice([0.0, 0.05, 0.2, 0.4, 3.0], (1500, 1))
    x = np.repeat(rng.normal(size=(5, 16)), 300, axis=0) + rng.normal(size=(1500, 16)) * spread
    a = covertree.Block(covertree.pack_block(np.arange(1500), x))
    b = covertree.Block(covertree.pack_block(np.arange(1500, 2250), x[::2] + 0.01))
    for other in (a, b):
        near = a.x @ other.x.T >= covertree.COSINE
        if other is a:
            np.fill_diagonal(near, False)
        wanted = near.sum(axis=1) if other is a else np.r_[near.sum(axis=1), near.sum(axis=0)]
        assert (covertree.traverse(a, other).counts == wanted).all()


def test_a_block_is_shuffled_once_for_each_bundle_near_it(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 32))
    x[100:200] = x[0] + rng.normal(size=(100, 32)) * 0.1
    monkeypatch.setattr(covertree, "LEAST_BLOCK", 16)
    monkeypatch.setattr(covertree, "MOST_BLOCK", 16)
    bundled, seen = covertree._bundle_pairs, {}

    def spy(blocks, *rest):
        out = bundled(blocks, *rest)
        seen.update(blocks=blocks.count(), sent=out.count(), most=out.groupBy("dim", "i", "j").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(covertree, "_bundle_pairs", spy)
    other = rng.normal(size=(20, 5))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(1000 + i, [float(v) for v in r]) for i, r in enumerate(other)]
    got = covertree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert seen["blocks"] >= 38 and seen["sent"] < seen["blocks"] ** 2 / 1.5 and seen["most"] > 2
    for ids, vectors in ((0, x), (1000, other)):
        u = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        linked = u @ u.T >= 0.95
        np.fill_diagonal(linked, False)
        comp = union_find(range(len(u)), list(zip(*np.nonzero(linked))))
        for r in got:
            if ids <= r.vec_id < ids + len(u):
                k = r.vec_id - ids
                assert (r.n_links, r.component_id) == (linked[k].sum(), comp[k] + ids)


def test_leading_axes_drop_no_link(monkeypatch):
    rng = np.random.default_rng(2)
    spread = rng.choice([0.05, 0.1, 0.3, 2.0], (900, 1))
    x = np.repeat(rng.normal(size=(9, 64)), 100, axis=0) + rng.normal(size=(900, 64)) * spread
    empty = x.copy()
    empty[:, :covertree.HEAD + 4] = 0  # axes that tell nothing
    levels = []
    tiles = covertree.Traversal.tiles
    monkeypatch.setattr(covertree.Traversal, "tiles", lambda self, level, *rest: (levels.append(level), tiles(self, level, *rest))[1])
    for vectors in (x, empty, rng.normal(size=(300, 64))):
        u = covertree.unit(vectors)
        axes = np.linalg.eigh(u.T @ u)[1][:, ::-1]
        half = len(vectors) // 2
        for basis in (None, axes):
            a = covertree.Block(covertree.pack_block(np.arange(half), vectors[:half]), basis)
            b = covertree.Block(covertree.pack_block(np.arange(half, 2 * half), vectors[half:2 * half]), basis)
            for other in (a, b):
                near = a.x @ other.x.T >= covertree.COSINE
                if other is a:
                    np.fill_diagonal(near, False)
                wanted = near.sum(axis=1) if other is a else np.r_[near.sum(axis=1), near.sum(axis=0)]
                assert (covertree.traverse(a, other).counts == wanted).all()
    assert levels[-1] > 0  # scattered vectors begin where the nodes are small


def test_scans_keep_every_row(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(40)] + [(None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    runs = [lambda d: pii.scan_documents(d, pii.fitted(docs)), secrets.scan_documents,
            lambda d: toxicity.score_toxicity(d, toxicity.fitted(docs, labels)),
            lambda d: quality.score_quality(d, quality.fitted(docs, labels))]
    for run in runs:
        ids = [r.doc_id for r in run(docs).select("doc_id").collect()]
        assert sorted(ids, key=str) == sorted((r.doc_id for r in docs.collect()), key=str)
        assert run(empty).count() == 0
    assert lic.scan_documents(docs, lic.fitted(docs)).count() == 0
    scored = quality.score_quality(docs, quality.fitted(docs, labels)).where("doc_id is not null").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in scored)
    for fit, table in ((quality.fitted, quality.score_quality), (toxicity.fitted, toxicity.score_toxicity)):
        assert table(docs, fit(docs, labels.limit(0))).count() == docs.count()


def test_every_query_runs_on_the_smallest_tables(spark):
    rows = {name: query(spark, "/root/testdata/sf0.001").count() for name, query in QUERIES.items()}
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    for name in ("op2_pii_skip_chain", "op3_secret_layers", "op4_hash_tree_shards", "op5_systematic_mix",
                 "op7_toxicity_automata", "op8_b_bit_minhash", "op10_compression_quality", "op13_periodic_runs"):
        assert rows[name] == documents, name
    for name, table in (("op1_embedding_near_dedup", "embeddings"), ("op12_wrapper_text", "pages")):
        assert rows[name] == spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").count(), name
    assert rows["pipeline"] > 0 and len(rows) == 14
