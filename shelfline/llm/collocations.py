"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are split into pieces, pieces into words.  Nodes of the graph are pairs of
words, edges are triples: the edge (a, b, c) leads from (a, b) to (b, c) and
weighs its occurrences.

1. One pass over the texts: each task numbers the words of a few million tokens,
   counts the triples that start at every word (cut short at a piece's end, the
   piece-end correction) and sends every distinct one once, with the words'
   flows through its part of the graph.
2. One shuffle brings together what leaves a node: a node's flow, the sum of its
   edges and of the pieces that end in it, is the count of its pair; a word's flow
   is the count of the word.  Only nodes and edges of ``min_count`` go on: a phrase
   that reaches it has parts that do.
3. Unary paths are compacted: where all that enters a node comes by one edge and
   all that leaves it goes by one, both weigh what the node does, the edges are one
   path.  A pair inside a path lies in a triple as frequent as itself, so it is
   dropped without a look at its edges; only the others meet theirs.
4. Candidates are scored at their cuts in exact decimal arithmetic.

``phrase_paths`` gives the compacted paths, the longest phrases that the graph
spells without a branch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import python_tasks, staged

MIN_COUNT, TOP = 10, 2000
#: A longer candidate with this share of a phrase's count makes it superfluous, in percent.
COVERED_PERCENT = 50
SCALE = 1_000_000
#: Bounds of a task's part of the graph: tokens counted together, and their distinct words.
CHUNK_TOKENS, CHUNK_WORDS = 4_000_000, 1 << 20
OUT_ROWS = 50_000

#: Ends of pieces become commas, which no word holds, tabs become blanks, letters A-Z small.
_TABLE = bytearray(bytes(range(256)).lower())
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = ord(",")
_TABLE[ord("\t")] = ord(" ")
_TABLE = bytes(_TABLE)


def tokens(text: str) -> list[bytes]:
    """Words, and a comma for every end of a piece."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).replace(b",", b" , ").split()


class GraphPart:
    """The triples of some texts, by language, as numbers of a common vocabulary."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = {b",": -1}
        self.words: list[bytes] = []
        self.ids: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, texts: list[str]) -> None:
        found = [t for text in texts for t in (*tokens(text), b",")]
        flat = np.empty(len(found), object)
        flat[:] = found
        local, distinct = pd.factorize(flat)
        number = np.empty(len(distinct), np.int64)
        for k, word in enumerate(distinct):
            at = self.vocabulary.get(word)
            if at is None:
                at = self.vocabulary[word] = len(self.words)
                self.words.append(word)
            number[k] = at
        self.ids.setdefault(lang, []).append(number[local].astype(np.int32))
        self.size += len(found)

    def full(self) -> bool:
        return self.size >= CHUNK_TOKENS or len(self.words) >= CHUNK_WORDS

    def rows(self) -> Iterator[pa.RecordBatch]:
        """lang, node, next, n: a pair and the word after it (null at a piece's end), or a word
        alone with its flow."""
        words = pa.array([w.decode("utf-8", "surrogatepass") for w in self.words], pa.string())
        base = len(self.words) + 1
        for lang, parts in self.ids.items():
            ids = np.concatenate([*parts, np.array([-1, -1], np.int32)]).astype(np.int64)
            a, b, c = ids[:-2], ids[1:-1], ids[2:]
            c = np.where(b < 0, -1, c)
            start = a >= 0
            pair, pairs = pd.factorize((a * base + b + 1)[start])
            key, n = np.unique(pair * base + c[start] + 1, return_counts=True)
            pair, third = np.divmod(key, base)
            first, second = np.divmod(pairs[pair], base)
            yield from self._batches(lang, words, np.arange(len(self.words)), None, None,
                                     np.bincount(first, weights=n, minlength=len(self.words)).astype(np.int64))
            whole = second > 0
            yield from self._batches(lang, words, first[whole], second[whole] - 1, third[whole] - 1, n[whole])

    @staticmethod
    def _batches(lang, words, first, second, third, n):
        kept = np.flatnonzero(n)
        for lo in range(0, len(kept), OUT_ROWS):
            at = kept[lo:lo + OUT_ROWS]
            node = words.take(pa.array(first[at]))
            follow = pa.nulls(len(at), pa.string())
            if second is not None:
                node = pc.binary_join_element_wise(node, words.take(pa.array(second[at])), " ")
                follow = words.take(pa.array(third[at], pa.int64(), mask=third[at] < 0))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), node, follow,
                                              pa.array(n[at], pa.int64())], ["lang", "node", "next", "n"])


def graph_parts(docs: DataFrame) -> DataFrame:
    """(lang, node, next, n) of every task's part of the graph."""
    python_tasks(docs.sparkSession)

    def run(batches):
        part = GraphPart()
        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                part.add(lang, texts)
            if part.full():
                yield from part.rows()
                part = GraphPart()
        yield from part.rows()

    narrow = docs.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return narrow.mapInArrow(run, "lang string, node string, next string, n long")


def flows(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, node, next, n, ends): nodes (``next`` null) with their flow and the pieces that end in
    them, and edges to the word ``next``.  Pairs and edges of ``min_count`` and more, all words.

    Both sums read the same shuffle, which has put a node and its edges into one partition.
    """
    parts = graph_parts(docs).repartition("lang", "node")
    ends = F.sum(F.when(F.col("next").isNull(), F.col("n")).otherwise(F.lit(0))).alias("ends")
    # conditions on sums only: one on a column would go below the shuffle and make it two
    nodes = (parts.groupBy("lang", "node").agg(F.sum("n").alias("n"), ends)
             .where((F.col("n") >= min_count) | ~F.col("node").contains(" ")))
    edges = (parts.groupBy("lang", "node", "next").agg(F.sum("n").alias("n"), ends)
             .where((F.col("n") >= min_count) & (F.col("ends") < F.col("n"))))
    return nodes.select("lang", "node", F.lit(None).cast("string").alias("next"), "n", "ends").unionByName(
        edges.select("lang", "node", "next", "n", "ends"))


class Graph:
    """The frequent part of the graph of ``docs`` (lang, text).

    words: lang, a, f.  pairs: lang, a, b, f.  totals: lang, words.  inner: lang, a, b of the nodes
    inside unary paths.  edges: lang, a, b, c, n, with ``tail`` and ``head``, the counts of the
    pairs (a, b) and (b, c), and ``entered`` and ``goes_on``, whether these are inner.
    """

    def __init__(self, docs: DataFrame, min_count: int = MIN_COUNT):
        found = staged(flows(docs, min_count), "flows")
        node = F.split("node", " ")
        alone = found.where(~F.col("node").contains(" "))
        self.totals = alone.groupBy("lang").agg(F.sum("n").alias("words"))
        self.words = alone.where(F.col("n") >= min_count).select("lang", F.col("node").alias("a"), F.col("n").alias("f"))
        double = found.where(F.col("node").contains(" ")).select("lang", node[0].alias("a"), node[1].alias("b"), "next", "n")
        self.pairs = double.where("next is null").select("lang", "a", "b", F.col("n").alias("f"))
        edges = double.where("next is not null").withColumnRenamed("next", "c")
        edges = edges.join(self.pairs.withColumnRenamed("f", "tail"), ["lang", "a", "b"])
        edges = staged(edges.join(self.pairs.select("lang", F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("head")),
                                  ["lang", "b", "c"]), "edges")
        # all that enters an inner node comes by one edge, all that leaves it goes by one
        enter = edges.where("n = head").select("lang", F.col("b").alias("a"), F.col("c").alias("b"))
        leave = edges.where("n = tail").select("lang", "a", "b")
        self.inner = staged(enter.join(leave, ["lang", "a", "b"]), "inner")
        first = self.inner.withColumn("entered", F.lit(True))
        last = self.inner.select("lang", F.col("a").alias("b"), F.col("b").alias("c"), F.lit(True).alias("goes_on"))
        marked = edges.join(first, ["lang", "a", "b"], "left").join(last, ["lang", "b", "c"], "left")
        self.edges = staged(marked.select("lang", "a", "b", "c", "n", "tail", "head",
                                          F.coalesce("entered", F.lit(False)).alias("entered"),
                                          F.coalesce("goes_on", F.lit(False)).alias("goes_on")), "marked")


def phrase_paths(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, n, n_words): the edges of ``min_count`` and more, unary paths compacted to one
    phrase each.

    Every edge points at the edge before it on its path; pointers double, so a path of k edges
    takes log2(k) rounds of one join.  No path is a ring: a text begins somewhere, so a ring has
    a node that something else enters.
    """
    edges = Graph(docs, min_count).edges.withColumn("edge", F.concat_ws(" ", "a", "b", "c"))
    before = edges.where("goes_on").select("lang", F.col("b").alias("a"), F.col("c").alias("b"), F.col("edge").alias("back"))
    at = edges.join(before, ["lang", "a", "b"], "left").select(
        "lang", "edge", "c", "n", F.when(F.col("entered"), F.col("back")).otherwise(F.col("edge")).alias("back"),
        F.col("entered").cast("long").alias("steps"))
    while True:
        at = staged(at, "paths")
        back = at.where("steps > 0").select("lang", F.col("edge").alias("back"), F.col("back").alias("further"),
                                            F.col("steps").alias("more"))
        joined = at.join(back, ["lang", "back"], "left")
        if joined.where("further is not null").isEmpty():
            break
        at = joined.select("lang", "edge", "c", "n", F.coalesce("further", "back").alias("back"),
                           (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
    tail = (at.where("steps > 0").groupBy("lang", "back")
            .agg(F.array_sort(F.collect_list(F.struct("steps", "c"))).alias("on")))
    heads = at.where("steps = 0").select("lang", F.col("edge").alias("back"), "n")
    return heads.join(tail, ["lang", "back"], "left").select(
        "lang", F.concat_ws(" ", F.col("back"), F.col("on.c")).alias("phrase"), "n",
        (F.coalesce(F.size(F.col("on")), F.lit(0)) + 3).cast("long").alias("n_words"))


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE a a / (left right)), exact for counts of up to 15 digits."""
    d = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", d(a) * d(a) * F.lit(SCALE).cast("decimal(7,0)"), d(left) * d(right))


def scored_phrases(g: Graph) -> DataFrame:
    """(lang, phrase, a, l, r, score) of all candidates that no longer one makes superfluous."""
    of = lambda name, f: g.words.select("lang", F.col("a").alias(name), F.col("f").alias(f))
    covers = lambda whole: F.lit(100) * F.col("n") >= F.lit(COVERED_PERCENT) * F.col(whole)
    # an inner node's edges weigh what it does; the other nodes are held against their edges
    branches = g.edges.where(~F.col("entered") & covers("tail")).select("lang", "a", "b").unionByName(
        g.edges.where(~F.col("goes_on") & covers("head")).select("lang", F.col("b").alias("a"), F.col("c").alias("b")))
    pairs = (g.pairs.join(g.inner, ["lang", "a", "b"], "left_anti").join(branches, ["lang", "a", "b"], "left_anti")
             .join(of("a", "l"), ["lang", "a"]).join(of("b", "r"), ["lang", "b"])
             .select("lang", F.concat_ws(" ", "a", "b").alias("phrase"), F.col("f").alias("a"), "l", "r",
                     score(F.col("f"), F.col("l"), F.col("r")).alias("score")))
    triples = g.edges.join(of("a", "first"), ["lang", "a"]).join(of("c", "last"), ["lang", "c"])
    cut = lambda k, l, r: F.struct(score(F.col("n"), F.col(l), F.col(r)).alias("score"), F.lit(k).alias("k"),
                                   F.col(l).alias("l"), F.col(r).alias("r"))
    triples = triples.withColumn("cut", F.least(cut(1, "first", "head"), cut(2, "tail", "last")))
    triples = triples.select("lang", F.concat_ws(" ", "a", "b", "c").alias("phrase"), F.col("n").alias("a"),
                             "cut.l", "cut.r", "cut.score")
    return pairs.unionByName(triples)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of two or three words of
    each language (null: ``und``), by score, count and phrase.

    Null, empty and blank texts have no words; repeated rows count as often as they stand; an
    empty table gives no rows; other columns are not read.
    """
    g = Graph(docs.select("lang", "text"), min_count)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = scored_phrases(g).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(g.totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
