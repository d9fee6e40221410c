"""Periodic runs of words by recompression.

A run is a stretch of words with smallest period q, at least ``MIN_LENGTH`` and
``POWER * q`` words long, that no neighbour extends.  Per batch of texts:

1. Words become numbers; the texts stand in one array, between separators that
   occur once each, so nothing ever matches across texts.
2. Recompression makes a run-length grammar level by level: blocks of equal
   symbols become one symbol, then the symbols are split in two classes by hash
   and every pair (first class, second class) becomes one symbol.  Equal
   stretches of text get equal symbols but near their ends.
3. A run with period p covers two neighbouring points of the grid of multiples
   of p, and its words agree at distance p around the first.  For every p the
   grid points whose words agree at distance p are found by one comparison of
   strided arrays (n / p of them: n log n over all p), and a point with fewer than
   three agreeing neighbours on either side lies in no run and is left out.
4. The exact extension to the right and left of a grid point and its partner is
   a longest common extension query on the grammar: up while both positions
   begin equal parents, along equal symbols (whole blocks at once), down at the
   first difference.  All queries of a batch go through the levels together.
5. One stretch is found with every multiple of its period; the smallest counts.

Nothing is cut or sampled: all periods up to half a text's words are tried.
Texts never meet, so the operator is one map-side pass.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text

MIN_LENGTH, POWER = 12, 2
#: Words that are worked on at a time, whole texts only (a longer text is worked on alone).
BATCH_WORDS = 1_000_000


def _numbers(keys: np.ndarray) -> np.ndarray:
    return pd.factorize(keys)[0]


def _classes(symbols: np.ndarray, level: int) -> np.ndarray:
    """A bit of each symbol, drawn anew on every level."""
    x = (symbols.astype(np.uint64) + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x >> np.uint64(40)) & np.uint64(1)).astype(bool)


class Grammar:
    """A run-length grammar of one array of symbols, by alternating block and pair compression.

    The array must begin and end with separators, each of which occurs once.  ``symbols[l]`` is
    the string on level l, ``first[l]`` where the children of its symbols begin on level l - 1
    (with one entry more, the end), ``up[l]`` the parent of every symbol, and ``ahead[l]`` and
    ``behind[l]`` how many equal symbols follow from each and lead up to each (None: one always).
    """

    def __init__(self, symbols: np.ndarray, separator: np.ndarray):
        self.symbols, self.first, self.up, self.ahead, self.behind = [], [np.empty(0, np.int32)], [], [], []
        now, apart, fresh = symbols.astype(np.int64), separator, int(symbols.max(initial=0)) + 1
        texts = int(separator.sum())
        while True:
            now, apart, fresh, blocks = self._blocks(now, apart, fresh)
            if len(now) <= 2 * texts + 1:
                break
            now, apart, fresh, pairs = self._pairs(now, apart, fresh)
            if not blocks and not pairs and self._stuck(now, apart):
                break
        self._level(now, None, None)

    def _level(self, symbols: np.ndarray, ahead, behind) -> None:
        self.symbols.append(symbols.astype(np.int32))
        self.ahead.append(ahead)
        self.behind.append(behind)

    def _raise(self, begins: np.ndarray) -> np.ndarray:
        """Records the parents of a level whose groups of children begin at ``begins``."""
        at = np.flatnonzero(begins).astype(np.int32)
        self.up.append((np.cumsum(begins) - 1).astype(np.int32))
        self.first.append(np.append(at, np.int32(len(begins))))
        return at

    @staticmethod
    def _stuck(now: np.ndarray, apart: np.ndarray) -> bool:
        """No two symbols of one text stand side by side."""
        return not (~apart[:-1] & ~apart[1:]).any()

    def _blocks(self, now, apart, fresh):
        begins = np.ones(len(now), bool)
        np.not_equal(now[1:], now[:-1], out=begins[1:])
        if begins.all():
            return now, apart, fresh, False
        at = np.flatnonzero(begins)
        length = np.diff(np.append(at, len(now)))
        own = np.repeat(np.arange(len(at)), length)
        inside = np.arange(len(now)) - at[own]
        self._level(now, (length[own] - inside).astype(np.int32), (inside + 1).astype(np.int32))
        self._raise(begins)
        out, many = now[at], length > 1
        out[many] = fresh + _numbers((out[many] << 32) | length[many])
        return out, apart[at], int(out.max()) + 1, True

    def _pairs(self, now, apart, fresh):
        right = _classes(now, len(self.symbols))
        free = ~apart[:-1] & ~apart[1:]
        one, other = ~right[:-1] & right[1:] & free, right[:-1] & ~right[1:] & free
        pair = one if np.count_nonzero(one) >= np.count_nonzero(other) else other
        if not pair.any():
            # every class the same side by side: the next level draws anew
            self._level(now, None, None)
            self._raise(np.ones(len(now), bool))
            return now, apart, fresh, False
        begins = np.ones(len(now), bool)
        begins[1:] = ~pair
        self._level(now, None, None)
        at = self._raise(begins)
        out, made = now[at], np.append(pair, False)[at]
        left = at[made]
        out[made] = fresh + _numbers((now[left] << 32) | now[left + 1])
        return out, apart[at], int(out.max()) + 1, True

    def _extend(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        """How many symbols of level 0 agree from i and j on; ``way`` 1 ahead, -1 behind."""
        runs = self.ahead if way > 0 else self.behind
        x, y = i.astype(np.int64), j.astype(np.int64)
        waiting: list[list[tuple]] = [[] for _ in self.symbols]
        here = np.arange(len(x))
        top = len(self.symbols) - 1
        for level in range(top + 1):
            s = self.symbols[level]
            higher = []
            while len(here):
                a, b = x[here], y[here]
                same = s[a] == s[b]
                waiting[level].append(here[~same])
                here, a, b = here[same], a[same], b[same]
                if level < top:
                    up, first = self.up[level], self.first[level + 1]
                    p, q = up[a], up[b]
                    edge = (first[p] == a) & (first[q] == b) if way > 0 else (first[p + 1] == a + 1) & (first[q + 1] == b + 1)
                    rise = edge & (self.symbols[level + 1][p] == self.symbols[level + 1][q])
                    x[here[rise]], y[here[rise]] = p[rise], q[rise]
                    higher.append(here[rise])
                    here, a, b = here[~rise], a[~rise], b[~rise]
                step = way if runs[level] is None else way * np.minimum(runs[level][a], runs[level][b])
                x[here], y[here] = a + step, b + step
            here = np.concatenate(higher) if higher else np.empty(0, np.int64)
        below = np.empty(0, np.int64)
        for level in range(top, 0, -1):
            below = np.concatenate([below, *waiting[level]])
            first, s = self.first[level], self.symbols[level - 1]
            if way > 0:
                x[below], y[below] = first[x[below]], first[y[below]]
            else:
                x[below], y[below] = first[x[below] + 1] - 1, first[y[below] + 1] - 1
            here = below
            while len(here):
                a, b = x[here], y[here]
                same = s[a] == s[b]
                here, a, b = here[same], a[same], b[same]
                step = way if runs[level - 1] is None else way * np.minimum(runs[level - 1][a], runs[level - 1][b])
                x[here], y[here] = a + step, b + step
        return way * (x - i)

    def ahead_of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of the positions i and j to the right."""
        return self._extend(i, j, 1)

    def behind_of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The same to the left, the positions themselves included."""
        return self._extend(i, j, -1)


def _grid_points(s: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, p) by p, then i: i a multiple of p, words agreeing at distance p there and at three
    neighbours in a row.  ``ends``, ``lengths``: of the texts, longest first."""
    at, of = [], []
    longest = int(lengths[0]) if len(lengths) else 0
    periods = np.arange(1, longest // POWER + 1)
    # the texts long enough for p stand before ends[count - 1]
    count = np.searchsorted(-lengths, -np.maximum(POWER * periods, MIN_LENGTH), side="right")
    for p, c in zip(periods.tolist(), count.tolist()):
        if not c:
            break
        grid = s[:ends[c - 1]:p]
        found = np.flatnonzero(grid[1:] == grid[:-1])
        if len(found):
            at.append(found * p)
            of.append(np.full(len(found), p))
    if not at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i, p = np.concatenate(at), np.concatenate(of)
    padded = np.concatenate([s, -np.arange(1, 4)])

    def agree(k: int, of: np.ndarray) -> np.ndarray:
        """A place before the array is one after its end, where nothing agrees."""
        return padded[i[of] + k] == padded[np.minimum(i[of] + k + p[of], len(padded) - 1)]

    near = np.zeros(len(i), bool)
    for way in (1, -1):
        left = np.arange(len(i))
        for k in (1, 2, 3):
            left = left[agree(way * k, left)]
        near[left] = True
    return i[near], p[near]


def maximal_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each array of word numbers its runs, rows (start, length, period) by start, period."""
    out = [np.empty((0, 3), np.int64) for _ in texts]
    order = sorted((k for k in range(len(texts)) if len(texts[k]) >= MIN_LENGTH), key=lambda k: -len(texts[k]))
    if not order:
        return out
    lengths = np.array([len(texts[k]) for k in order])
    words = 1 + max(int(texts[k].max()) for k in order)
    parts = []
    for n, k in enumerate(order):
        parts += [np.array([words + n], np.int64), texts[k].astype(np.int64)]
    s = np.concatenate([*parts, np.array([words + len(order)], np.int64)])
    starts = np.cumsum(lengths + 1) - lengths
    i, p = _grid_points(s, starts + lengths, lengths)
    if not len(i):
        return out
    grammar = Grammar(s, s >= words)
    # one query a row of neighbouring grid points, and one more wherever its stretch ends in the row
    begins = np.ones(len(i), bool)
    begins[1:] = (p[1:] != p[:-1]) | (i[1:] != i[:-1] + p[1:])
    row_end = np.append(np.flatnonzero(begins)[1:], len(i))[np.cumsum(begins) - 1]
    at, found = np.flatnonzero(begins), []
    while len(at):
        a, q = i[at], p[at]
        ahead, behind = grammar.ahead_of(a, a + q), grammar.behind_of(a - 1, a + q - 1)
        length = ahead + behind + q
        good = (ahead + behind >= (POWER - 1) * q) & (length >= MIN_LENGTH)
        found.append(np.column_stack([a - behind, length, q])[good])
        end = row_end[at]
        at = at + (ahead - 1) // q + 1
        at = at[at < end]
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    own = np.searchsorted(starts, runs[:, 0], side="right") - 1
    runs[:, 0] -= starts[own]
    cut = np.flatnonzero(np.diff(own)) + 1
    for rows, k in zip(np.split(runs, cut), own[np.append(0, cut)] if len(own) else ()):
        out[order[k]] = rows
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words less those that any run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def _in_batches(texts: list[list[bytes]]):
    """Neighbouring texts of up to BATCH_WORDS words together, as (from, to)."""
    lo = total = 0
    for k, words in enumerate(texts):
        if total and total + len(words) > BATCH_WORDS:
            yield lo, k
            lo, total = k, 0
        total += len(words)
    if lo < len(texts):
        yield lo, len(texts)


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for lo, hi in _in_batches(texts):
        lengths = [len(w) for w in texts[lo:hi]]
        flat = np.empty(sum(lengths), object)
        flat[:] = [w for words in texts[lo:hi] for w in words]
        out += maximal_runs(np.split(_numbers(flat), np.cumsum(lengths)[:-1]))
    return out


def scan_documents(docs: DataFrame, prepared=None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs`` (doc_id, text).

    ``runs``: array of (start, length, period) by start, then period, in words; ``collapsed``: the
    words left when every run is cut to its first period, joined by one space.  ``prepared(id,
    words)`` may replace the words of a text first (the id as text, or None).  Null, empty and
    blank texts have no words, no runs and an empty ``collapsed``; a null id stays null; repeated
    rows give equal rows; an empty table gives no rows; other columns are not read.
    """
    def run(ids, texts):
        words = [words_of(t) for t in texts]
        if prepared is not None:
            words = [prepared(i, w) for i, w in zip(ids, words)]
        found = runs_of_texts(words)
        return pd.DataFrame({
            "doc_id": pd.array([None if i is None else int(i) for i in ids], "Int64"),
            "n_words": [len(w) for w in words],
            "runs": [[{"start": a, "length": b, "period": c} for a, b, c in r.tolist()] for r in found],
            "collapsed": [b" ".join(collapsed(w, r)).decode("utf-8", "surrogatepass") for w, r in zip(words, found)]})

    return per_text(docs, run, "doc_id long, n_words long, "
                               "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted(doc_id: str | None, words: list[bytes]) -> list[bytes]:
    """Every tenth text, by crc32 of its id, becomes periodic from a word of its own on."""
    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document: the number of its runs, the longest, and digests of all of them and of
    the collapsed text, after ``planted``.  A null id is planted nothing; else as ``scan_documents``."""
    scanned = scan_documents(docs, planted)
    # the longest first, then the earliest, then the shortest period
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"),
                                                              r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length = -F.col("best.less")
    return scanned.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
        F.col("best.period").alias("period"), F.floor(length * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
