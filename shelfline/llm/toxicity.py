"""Toxicity by a lexicon with misspellings.

The lexicon is learned from labelled texts: whole words, and stems that take any
ending, that mark toxic ones.  Its trie is intersected with the Levenshtein
automata of the terms: a state is the set of
(trie node, edits used) pairs that the letters read so far can reach, states are
made on demand and remembered, so a word costs one table step per letter and a
word that can match nothing stops early.  A hit's window tells quotation
(quotation marks, words of speech around it) from abuse (address, other hits),
and logistic regression on labelled texts turns the hits into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text
from .labelled import class_weights, fold, logistic, sigmoid, training_rows

#: Bound of the training sample: documents per class.
TRAIN_ROWS = 4000
FOLDS, HELD_OUT, CUT = 4, 2, 0.3
#: A term: letters, and toxic documents it must be in.
MIN_LETTERS, MIN_DOCUMENTS = 4, 3
#: Its share of the toxic documents must be this many times its share of the clean ones, at the
#: lower end of an interval of SURE standard errors.  Neither depends on how many documents of
#: either class were sampled.
MIN_LIFT, SURE = 4.0, 1.645
#: A stem is lengthened, and a word taken whole, if that keeps this share of its documents.
SAME = 0.9
#: Terms of up to this many letters must be met exactly, words of up to twice as many within
#: one edit, longer ones within two; stems within one from twice as many on.
EXACT_LETTERS = 4
#: Share of a term's uses that are expected to be misspelt.
MISSPELT = 0.05
WINDOW = 48
#: A word: letters and digits, with signs that stand for letters or part them inside it.
WORDS = re.compile(r"[^\W_](?:[@$!+\-\u00ad\u200b]{0,2}[^\W_])*", re.UNICODE)
#: Words of reported speech and of address in the corpus's four languages.
SPEECH = frozenset("said says say wrote writes quote quoted quotes called calls word term phrase "
                   "sagte sagt schrieb zitat wort dit écrit cite mot dijo dice escribió cita palabra".split())
ADDRESS = frozenset("you your youre u du dich dein ihr tu te toi ton vous votre tú eres usted".split())
OPEN_QUOTES, CLOSE_QUOTES = "\"“„«‘", "\"”“»’"
#: Letters that stand for others in disguised words.
LOOKALIKE = str.maketrans("013457@$!+", "oieastasit", "-\u00ad\u200b")


def _folded(word: str) -> str:
    return word if word.isalpha() else word.translate(LOOKALIKE)


def allowed_edits(term: str) -> int:
    """A term that ends in ``*`` is a stem."""
    if term.endswith("*"):
        return int(len(term) - 1 >= 2 * EXACT_LETTERS)
    return 0 if len(term) <= EXACT_LETTERS else 1 if len(term) <= 2 * EXACT_LETTERS else 2


class FuzzyLexicon:
    """The product of the terms' Levenshtein automata with their trie, determinised on demand."""

    def __init__(self, terms: dict[str, int]):
        """``terms``: edits allowed for each; a stem is written with a final ``*``."""
        self.terms = dict(sorted(terms.items()))
        self.children: list[dict[str, int]] = [{}]
        self.room = [0]
        self.end: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        for term, edits in self.terms.items():
            node = 0
            self.room[0] = max(self.room[0], edits)
            for letter in term.removesuffix("*"):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.room.append(0)
                    self.end.append(None)
                    self.stem.append(None)
                node = self.children[node][letter]
                self.room[node] = max(self.room[node], edits)
            (self.stem if term.endswith("*") else self.end)[node] = term
        self.states: list[tuple[tuple[int, int], ...]] = []
        self.number: dict[tuple, int] = {}
        self.steps: list[dict[str, int]] = []
        self.ended: list[tuple[int, str] | None] = []
        self.passed: list[tuple[int, str] | None] = []
        self.start = self._state(self._closed({0: 0}))

    def __reduce__(self):
        return FuzzyLexicon, (self.terms,)

    def _closed(self, at: dict[int, int]) -> dict[int, int]:
        """Adds what letters missing from the word reach."""
        todo = list(at.items())
        while todo:
            node, used = todo.pop()
            if used > at[node]:
                continue
            for child in self.children[node].values():
                if used + 1 <= self.room[child] and used + 1 < at.get(child, 99):
                    at[child] = used + 1
                    todo.append((child, used + 1))
        return at

    def _state(self, at: dict[int, int]) -> int:
        """The number of a state; -1 if nothing can match from it."""
        key = tuple(sorted(at.items()))
        if not key:
            return -1
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            best = lambda terms: min(((used, terms[node]) for node, used in key
                                      if terms[node] and used <= self.terms[terms[node]]), default=None)
            self.ended.append(best(self.end))
            self.passed.append(best(self.stem))
        return self.number[key]

    def _step(self, state: int, letter: str) -> int:
        at: dict[int, int] = {}

        def reach(node: int, used: int) -> None:
            if used <= self.room[node] and used < at.get(node, 99):
                at[node] = used

        for node, used in self.states[state]:
            reach(node, used + 1)
            for edge, child in self.children[node].items():
                reach(child, used + (edge != letter))
        to = self._state(self._closed(at))
        self.steps[state][letter] = to
        return to

    def match(self, word: str) -> tuple[int, str] | None:
        """(edits, term) of the nearest word, or else of the nearest stem; None without one."""
        state, steps, passed, stem = self.start, self.steps, self.passed, None
        for letter in word:
            to = steps[state].get(letter)
            if to is None:
                to = self._step(state, letter)
            if to < 0:
                return stem
            state = to
            if passed[state] is not None and (stem is None or passed[state] < stem):
                stem = passed[state]
        return self.ended[state] or stem


class Sample:
    """Labelled texts as numbers of a common vocabulary: per text its distinct words and their counts."""

    def __init__(self, texts: list[str], labels: list[int]):
        self.labels = np.array(labels, int)
        number: dict[str, int] = {}
        self.words_in, self.counts = [], []
        for text in texts:
            found = Counter(WORDS.findall(text.lower()))
            self.words_in.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found)))
            self.counts.append(np.fromiter(found.values(), np.int32, len(found)))
        self.words = list(number)

    def documents(self, of: np.ndarray, groups: int, rows: np.ndarray) -> np.ndarray:
        """In how many of ``rows`` each group of words occurs; ``of``: group of every word, -1 for none."""
        out = np.zeros(groups, np.int64)
        for row in rows.tolist():
            found = of[self.words_in[row]]
            out[np.unique(found[found >= 0])] += 1
        return out


def learned_terms(sample: Sample) -> dict[str, int]:
    """Words, and the shortest stems (with ``*``), that toxic documents hold far more often than
    clean ones, with the edits that their length allows.

    Stems are lengthened letter by letter, as long as enough toxic documents hold them.
    """
    toxic_rows, clean_rows = np.flatnonzero(sample.labels == 1), np.flatnonzero(sample.labels == 0)
    n_toxic, n_clean = len(toxic_rows), len(clean_rows)
    plain = np.array([len(w) >= MIN_LETTERS and w.isalpha() for w in sample.words], bool)
    toxic: dict[str, int] = {}
    clean: dict[str, int] = {}
    alive, letters = np.flatnonzero(plain), MIN_LETTERS
    while len(alive):
        stems: dict[str, int] = {}
        of = np.full(len(sample.words), -1, np.int64)
        of[alive] = [stems.setdefault(sample.words[k][:letters], len(stems)) for k in alive.tolist()]
        held = sample.documents(of, len(stems), toxic_rows)
        also = sample.documents(of, len(stems), clean_rows) if held.max(initial=0) >= MIN_DOCUMENTS else held
        for stem, k in stems.items():
            if held[k] >= MIN_DOCUMENTS:
                toxic[stem], clean[stem] = int(held[k]), int(also[k])
        letters += 1
        alive = np.array([k for k in alive.tolist() if held[of[k]] >= MIN_DOCUMENTS and len(sample.words[k]) >= letters], int)
    whole = dict(zip(sample.words, sample.documents(np.where(plain, np.arange(len(sample.words)), -1), len(sample.words),
                                                    toxic_rows).tolist()))

    def least_lift(z: str) -> float:
        """The lower bound of the ratio of a term's shares (Katz interval, half a document added)."""
        t, c = toxic[z] + 0.5, clean[z] + 0.5
        error = math.sqrt(max(0.0, 1 / t - 1 / (n_toxic + 1) + 1 / c - 1 / (n_clean + 1)))
        return t / (n_toxic + 1) / (c / (n_clean + 1)) * math.exp(-SURE * error)

    longer: dict[str, list[str]] = {}
    for z in toxic:
        longer.setdefault(z[:-1], []).append(z)

    def lengthened(z: str) -> str:
        while True:
            on = max(longer.get(z, []), key=lambda y: (toxic[y], y), default=None)
            if on is None or toxic[on] < SAME * toxic[z]:
                return z
            z = on

    terms: set[str] = set()
    stems: set[str] = set()
    lifts = {z: lift for z in toxic if (lift := least_lift(z)) >= MIN_LIFT}
    # the surest first; what it begins with would only blur it
    for z in sorted(lifts, key=lambda z: (-lifts[z], len(z), z)):
        z = lengthened(z)
        if any(z[:k] in terms or z[:k] + "*" in terms for k in range(MIN_LETTERS, len(z) + 1)) or z in stems:
            continue
        terms.add(z if whole.get(z, 0) >= SAME * toxic[z] else z + "*")
        stems.update(z[:k] for k in range(MIN_LETTERS, len(z) + 1))
    return {t: allowed_edits(t) for t in sorted(terms)}


def spared(sample: Sample, rows: np.ndarray, hits: dict[int, tuple[int, str]]) -> frozenset[str]:
    """The words of clean texts among ``rows`` that only look like terms."""
    near = np.zeros(len(sample.words), bool)
    near[[k for k, hit in hits.items() if hit[0]]] = True
    return frozenset(sample.words[k] for row in rows.tolist() if not sample.labels[row]
                     for k in sample.words_in[row][near[sample.words_in[row]]].tolist())


def evidence_rates(sample: Sample, rows: np.ndarray, hits: dict[int, tuple[int, str]], terms: dict[str, int],
                   innocent: frozenset[str]) -> dict[str, tuple[float, ...]]:
    """For each term the share of toxic texts that hold it, how often a word of a clean text is it by
    chance, exactly and nearly (words of ``innocent`` aside), and the share of clean texts that may
    hold it unseen, among ``rows``.  All are shares: a larger sample makes them surer, not stricter."""
    met = np.zeros(len(sample.words), bool)
    met[list(hits)] = True
    holds, exact, near = Counter(), Counter(), Counter()
    words = toxic = clean = 0
    for row in rows.tolist():
        of, n = sample.words_in[row], sample.counts[row]
        found = [(int(k), int(c)) for k, c in zip(of[met[of]], n[met[of]])]
        if sample.labels[row]:
            toxic += 1
            holds.update({hits[k][1] for k, _ in found if not hits[k][0]})
            continue
        clean += 1
        words += int(n.sum())
        for k, c in found:
            edits, term = hits[k]
            if not edits:
                exact[term] += c
            elif sample.words[k] not in innocent:
                near[term] += c
    return {t: (max(holds[t] - 1, 0.5) / (toxic + 1), exact[t] / (words + 1), near[t] / (words + 1), CHANCE / (clean + 1))
            for t in terms}


#: Clean texts of the sample that are held to have a term beside those seen.
CHANCE = 0.25
#: Evidence of one term, and of all others together, counts up to this many nats.
ONE, OTHERS = 6.0, 12.0
FEATURES = ("most", "others", "quoted")


class ToxicityScorer:
    """Evidence is the logarithm of how much likelier a toxic text holds a term than a clean text of
    the same length by chance, so a term that clean texts never use counts at any length."""

    def __init__(self, terms: dict[str, int], innocent: frozenset[str], weights: np.ndarray,
                 rates: dict[str, tuple[float, ...]]):
        self.lexicon, self.innocent, self.weights, self.rates = FuzzyLexicon(terms), innocent, weights, rates
        self._known: dict[str, tuple[int, str] | None] = {}

    def __reduce__(self):
        return ToxicityScorer, (self.lexicon.terms, self.innocent, self.weights, self.rates)

    def hits(self, text: str) -> list[tuple[int, int, str, int]]:
        """(start, end, edits, term) of every word near a term."""
        lowered = text.lower()
        if len(lowered) != len(text):
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        known, match = self._known, self.lexicon.match
        if len(known) > 500_000:
            known.clear()
        words = WORDS.findall(lowered)
        near = []
        for word in set(words):
            if word not in known:
                known[word] = None if word in self.innocent else match(_folded(word))
            if known[word] is not None:
                near.append(word)
        if not near:
            return []
        one = re.compile(r"(?<![^\W_])(?:" + "|".join(map(re.escape, sorted(near))) + r")(?![^\W_])")
        return [(m.start(), m.end(), *known[m.group()]) for m in one.finditer(lowered)]

    def context(self, text: str, start: int, end: int, others: int) -> float:
        """Score of the window around a hit: above 0 abuse, below 0 quotation."""
        before, after = text[max(0, start - WINDOW):start], text[end:end + WINDOW]
        line_before, line_after = before.rsplit("\n", 1)[-1], after.split("\n", 1)[0]
        score = 0.0
        opened = max((line_before.rfind(q) for q in OPEN_QUOTES), default=-1)
        if opened >= 0 and any(q in line_after for q in CLOSE_QUOTES):
            score -= 1.0
        around = {w.lower() for w in WORDS.findall(line_before + " " + line_after)}
        score -= 0.5 * bool(around & SPEECH)
        score += 0.5 * bool(around & ADDRESS)
        return score + 0.25 * min(others, 2)

    def evidence(self, term: str, edits: int, words: float) -> float:
        held, exact, near, unseen = self.rates[term]
        share, rate = (held * MISSPELT, near) if edits else (held, exact)
        return math.log(share / (unseen - math.expm1(-rate * words)))

    def features(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(FEATURES)))
        for row, text in enumerate(texts):
            found = self.hits(text) if text else []
            if not found:
                continue
            words = len(text) / 6 + 1
            speaks: dict[str, float] = {}
            quoted = 0
            for start, end, edits, term in found:
                context = self.context(text, start, end, len(found) - 1)
                if context <= -1.0:
                    quoted += 1
                else:
                    speaks[term] = max(self.evidence(term, edits, words) + context, speaks.get(term, 0.0))
            most = max(speaks.values(), default=0.0)
            out[row] = min(most, ONE) / ONE, min(sum(speaks.values()) - most, OTHERS) / OTHERS, min(quoted, 3) / 3
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        x = self.features(texts)
        return sigmoid(np.column_stack([x, np.ones(len(x))]) @ self.weights)


def train(sample: pd.DataFrame, odds: float | None = None) -> ToxicityScorer:
    """Lexicon and weights from rows (text, label); ``odds``: logarithm of the odds of label 1 among
    all labels (None: as in the sample).

    Weights start from a prior in which evidence counts as it stands and a quotation little.
    Neither the lexicon nor the weights depend on what share of either class was sampled.
    """
    y = sample["label"].to_numpy(float)
    base = np.log((y.sum() + 1) / (len(y) - y.sum() + 1)) if odds is None else odds
    texts = sample["text"].tolist()
    counted = Sample(texts, y.astype(int).tolist())
    terms = learned_terms(counted)
    lexicon = FuzzyLexicon(terms)
    hits = {k: hit for k, w in enumerate(counted.words) if (hit := lexicon.match(_folded(w)))}
    halves = [np.arange(k, len(texts), 2) for k in range(2)]
    innocent = [spared(counted, rows, hits) for rows in halves]
    prior = np.array([ONE, OTHERS / 2, 0.3, base])
    # each half as if only the other half's clean words were known, as for unseen texts
    rates = [evidence_rates(counted, rows, hits, terms, innocent[1 - k]) for k, rows in enumerate(halves)]
    mean = {t: tuple(np.mean([r[t] for r in rates], axis=0).tolist()) for t in terms}
    scorer = ToxicityScorer(terms, innocent[0] | innocent[1], prior, mean)
    if len(np.unique(y)) == 2:
        x = np.zeros((len(texts), len(FEATURES)))
        for k in range(2):
            x[k::2] = ToxicityScorer(terms, innocent[1 - k], prior, rates[1 - k]).features(texts[k::2])
        scorer.weights = logistic(x, y, prior, np.array([3.0, 3.0, 1.5, 2.0]), rows=class_weights(y, base))
    return scorer


def fitted(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityScorer:
    return train(*training_rows(docs, labels, "toxic", FOLDS, HELD_OUT, train_rows))


def score_toxicity(docs: DataFrame, scorer: ToxicityScorer) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; null and empty texts have no hit
    and the base score; repeated rows and other columns have no effect."""
    def run(ids, texts):
        return pd.DataFrame({"doc_id": ids, "score": scorer.scores(texts)})

    scored = per_text(docs, run, "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))
