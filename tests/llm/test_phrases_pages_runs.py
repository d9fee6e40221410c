"""Collocations, page text and periodic runs, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfline.llm import collocations, periodic, wrappers

DOCS = "doc_id long, text string, lang string, source string, n_words long, runs string, node string"


# periodic runs

def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        agree = 0
        for i in range(len(words) - q + 1):
            if i < len(words) - q and words[i] == words[i + q]:
                agree += 1
                continue
            if agree >= q and agree + q >= 12:
                found.setdefault((i - agree, agree + q), q)
            agree = 0
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 70), st.integers(1, 30), st.integers(0, 10 ** 6)), min_size=1, max_size=5))
def test_runs_equal_brute_force(kinds):
    texts = []
    for letters, n, period, seed in kinds:
        rng = random.Random(seed)
        words = [rng.randrange(letters) for _ in range(n)]
        texts.append(np.array([words[i] if i < n // 3 else words[n // 3 + (i - n // 3) % period % max(1, n - n // 3)] for i in range(n)],
                              np.int64))
    assert [[tuple(r) for r in found.tolist()] for found in periodic.maximal_runs(texts)] == [brute_runs(t.tolist()) for t in texts]


def test_grammar_extensions_equal_plain_comparison():
    rng = np.random.default_rng(5)
    word = rng.integers(0, 2, 40)
    s = np.concatenate([[9], word, word, [1, 1, 1, 1, 1, 0], word, np.ones(50, int), word, [10]]).astype(np.int64)
    grammar = periodic.Grammar(s, s >= 9)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(1, len(s) - 1), np.arange(1, len(s) - 1)))
    i, j = i[i < j], j[i < j]
    ahead, behind = grammar.ahead_of(i, j), grammar.behind_of(i, j)
    for a, b, f, g in zip(i.tolist(), j.tolist(), ahead.tolist(), behind.tolist()):
        n = next(k for k in range(len(s)) if b + k >= len(s) or s[a + k] != s[b + k])
        m = next(k for k in range(len(s)) if a - k < 0 or s[a - k] != s[b - k])
        assert (f, g) == (n, m)
    # few levels: each leaves a constant share of the symbols
    assert len(grammar.symbols) < 60 and len(grammar.symbols[-1]) < len(s) / 4


def test_run_report(spark):
    rng = random.Random(8)
    loop = [f"w{k}" for k in range(7)]
    texts = [None, "", " \t\n", "one", " ".join(["so"] * 12), " ".join(["so"] * 11), " ".join(loop * 5 + ["end"]),
             " ".join(loop * 3 + ["x"] + ["a", "b"] * 9), "Été " * 30, " ".join(rng.choice(loop) for _ in range(3000)),
             " x " * 20]
    rows = [(i, t, "en", "s", 1, "x", "y") for i, t in enumerate(texts * 6)]
    rows += [rows[6], (None, texts[6], "en", "s", 1, "x", "y"), (-30, texts[7], "en", "s", 1, "x", "y")]
    got = Counter(tuple(r) for r in periodic.run_report(spark.createDataFrame(rows, DOCS)).collect())
    want = Counter()
    planted = 0
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and words:
            planted += 1
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want[doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
             hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
             hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()] += 1
    assert planted and got == want
    assert periodic.run_report(spark.createDataFrame([], DOCS)).count() == 0


def test_words_of_several_batches(monkeypatch):
    texts = [[b"a", b"b"] * 8, [b"c"], [], [b"d"] * 30, [b"e"] * 13]
    whole = periodic.runs_of_texts(texts)
    monkeypatch.setattr(periodic, "BATCH_WORDS", 14)
    assert [r.tolist() for r in periodic.runs_of_texts(texts)] == [r.tolist() for r in whole]
    assert [r.tolist() for r in whole] == [[[0, 16, 2]], [], [], [[0, 30, 1]], [[0, 13, 1]]]


# collocations

def phrase_counts(rows, upto):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, upto + 1):
                counts.update((lang or "und", *words[i:i + k]) for i in range(len(words) - k + 1))
    return counts, totals


def brute_collocations(rows, least, top):
    f, totals = phrase_counts(rows, 3)
    out = []
    candidates = {p: n for p, n in f.items() if len(p) > 2 and n >= least}
    covered = {}
    for p, n in candidates.items():
        if len(p) == 4:
            for part in (p[:3], (p[0], *p[2:])):
                covered[part] = max(covered.get(part, 0), n)
    for p, a in candidates.items():
        if len(p) == 3 and 100 * covered.get(p, 0) >= 50 * a and p in covered:
            continue
        lang, *words = p
        cuts = []
        for k in range(1, len(words)):
            left, right = f[(lang, *words[:k])], f[(lang, *words[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(words), a, left, right, totals[lang], score))
    ranked = []
    for lang in totals:
        of = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(r[0], at + 1, *r[1:]) for at, r in enumerate(of)]
    return sorted(ranked)


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(4)
    common = ["The", "of", "new", "york", "city", "été", "a b", "x"]
    rows = [(None, "en"), ("", "en"), (" . ,", None)]
    passage = "a longer passage that stands in many texts without any change of words"
    for k in range(60):
        words = [rng.choice(common) + rng.choice(["", "", "", ",", ".", "\n", "\t", "\x0b"]) for _ in range(rng.randint(1, 60))]
        rows.append((" ".join(words) + (f" {passage} " if k % 3 == 0 else ""), rng.choice(["en", "de", None])))
    return rows + [rows[5]] * 4


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "x", "y") for i, (t, lang) in enumerate(rows)], DOCS)


@pytest.mark.parametrize("least, top", [(3, 2000), (10, 7)])
def test_collocations_equal_brute_force(spark, phrase_rows, least, top):
    got = collocations.collocations(frame(spark, phrase_rows).repartition(3), least, top).collect()
    assert sorted(tuple(r) for r in got) == brute_collocations(phrase_rows, least, top)


def test_graph_parts_are_flushed_without_loss():
    part = collocations.GraphPart()
    part.add("en", ["a b c, a b", "b c a"])
    rows = [tuple(r.values()) for b in part.rows() for r in b.to_pylist()]
    assert Counter({(n, x): c for _, n, x, c in rows}) == Counter({
        ("a", None): 3, ("b", None): 3, ("c", None): 2, ("a b", "c"): 1, ("a b", None): 1,
        ("b c", "a"): 1, ("b c", None): 1, ("c a", None): 1})


def test_paths_spell_passages_and_keep_every_frequent_triple(spark, phrase_rows):
    got = collocations.phrase_paths(frame(spark, phrase_rows), 3).collect()
    f, _ = phrase_counts(phrase_rows, 3)
    spelled = Counter()
    for r in got:
        words = r.phrase.split(" ")
        assert len(words) == r.n_words
        for i in range(len(words) - 2):
            spelled[r.lang, *words[i:i + 3]] += 1
            assert f[r.lang, *words[i:i + 3]] == r.n
    assert spelled == Counter({p: 1 for p, n in f.items() if len(p) == 4 and n >= 3})
    assert any("longer passage that stands in many texts without any change of" in r.phrase for r in got)


def test_no_collocations_without_words(spark):
    assert collocations.collocations(frame(spark, [(None, "en"), (" ,. ", None)])).count() == 0
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0


def test_score_is_exact(spark):
    a, left, right = 999_999_999_937, 999_999_999_989, 1_000_000_000_039
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(
        collocations.score(*map(__import__("pyspark").sql.functions.col, "alr"))).first()
    assert row[0] == 1_000_000 * a * a // (left * right)


# page text

PAGES = "page_id long, url string, html string, host string, text string, wrapper string"


def text_of(spark, pages, **options):
    rows = [(i, url, source, "h", "t", "w") for i, (url, source) in enumerate(pages)]
    got = {r.page_id: r.text for r in wrappers.extract_text(spark.createDataFrame(rows, PAGES), **options).collect()}
    return [got[i] for i in range(len(rows))]


def test_articles_without_what_surrounds_them(spark):
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body>"
            "<header class=top><h1>Site</h1></header><nav><ul><li><a href=/>Home {0}</a><li><a href=/x>X</a></ul></nav>"
            "<div class='cookie-notice'>We use cookies {0}</div><article><header><h1>Title&nbsp;{0}</h1></header>"
            "<p>First <b>bold {0}</b>word &amp; more<br>line<p>Second\n\n {0} &lt;tag&gt; <a href=#>link</a>"
            "<table><tr><td>cell {0}<td>two</table><form><input value=1><label>Name {0}</label></form>"
            "<ul><li>one {0}<li>two</ul><div class=ad>Buy {0}</div><section id=comments><p>Nice {0}</p></section></article>"
            "<aside>Side {0}</aside><footer>&copy; {0}</footer><p hidden>not {0}</p></body></html>")
    want = "Title {0} First bold {0}word & more line Second {0} <tag> link cell {0} two one {0} two"
    got = text_of(spark, [(f"http://A.example/{k}", page.format(k)) for k in range(4)])
    assert got == [want.format(k) for k in range(4)]


def test_constant_blocks_are_template_and_varying_ones_content(spark):
    page = ("<body><div><p>The weekly of the town</p></div><div><a href=1>alpha {0}</a> <a href=2>beta {0}</a></div>"
            "<div><h2>Heading {0}</h2><p>{1}</p><p>{1} again</p><p>{2}</p></div><div><p>All rights reserved</p></div></body>")
    long = "words of the text number {0} " * 12
    pages = [("https://x.example/a", page.format(k, long.format(k), "end " * k)) for k in range(5)]
    clean = lambda s: " ".join(s.split())
    got = text_of(spark, pages)
    assert got == [clean(f"Heading {k} {long.format(k)} {long.format(k)} again " + "end " * k) for k in range(5)]
    # an only page has no constant blocks to compare
    assert text_of(spark, [("https://y.example/", "<p>only page</p>"), ("https://y.example/", "<p>only page</p>")]) == ["only page"] * 2


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    pages = [(None, None), ("http://o.example", ""), (None, "plain text, a < b & c"), ("x", "<p>cut <b>off"), ("x2", "<p>a</p><p"),
             ("http://d.example/", deep), ("http://e.example/", "<!-- never closed <p>x"), ("http://f.example/", "<script>x"),
             ("http://g.example/", "<p>" + "long " * 50_000 + "</p>"), ("http://h.example/", "<a \"<p>q</p>" * 50)]
    got = text_of(spark, pages)
    assert got[:2] == ["", ""] and got[5] == "deep text" and got[6:8] == ["", ""] and got[8] == ("long " * 50_000).strip()
    assert wrappers.extract_text(spark.createDataFrame([], PAGES)).count() == 0


def test_rounds_of_small_groups_give_the_same_text(spark):
    rng = random.Random(1)
    kinds = ["<h2>{0}</h2>", "<div class=box><p>box {0}</p></div>", "<ul><li>{0}</ul>", "<section><h3>s {0}</h3></section>"]
    pages = []
    for k in range(30):
        parts = "".join(rng.choice(kinds).format(f"{k} part") for _ in range(rng.randint(0, 6)))
        pages.append(("http://r.example/", f"<body><div class=menu>go {k}</div><main><p>text {k}</p>{parts}</main><p>same</p></body>"))
    whole = text_of(spark, pages)
    assert whole == text_of(spark, pages, group=3)
    assert all(t.startswith(f"text {k}") and "go" not in t and "same" not in t for k, t in enumerate(whole))


def brute_matching(a, b):
    """Simple tree matching by trying every order-keeping set of child pairs."""
    if a[0] != b[0]:
        return 0

    def best(x, y):
        if not x or not y:
            return 0
        return max(best(x[1:], y), best(x, y[1:]), brute_matching(x[0], y[0]) + best(x[1:], y[1:]))
    return 1 + best(a[1], b[1])


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6))
def test_tree_matching_equals_brute_force(seed):
    rng = random.Random(seed)

    def tree(depth):
        return (rng.choice("abc"), [tree(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)])

    def node(t):
        n = wrappers.Node(t[0], "")
        n.children = [node(c) for c in t[1]]
        return n

    def size(n):
        return 1 + sum(map(size, n.children))

    a, b = ("r", tree(2)[1]), ("r", tree(2)[1])
    x, y = node(a), node(b)
    both = size(x) + size(y)
    assert wrappers._weight(x, y) == brute_matching(a, b)
    wrappers.absorb(x, y)
    assert size(x) <= both - 1
