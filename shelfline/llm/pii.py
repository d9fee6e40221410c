"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans.  Every document is then read as
the tokens that could be personal data (those with digits or an at sign), each
with its surroundings, in a chain; tokens whose digits or letters repeat or
resemble an earlier token's are joined by a skip edge.  Labels are the kinds
and none.  Sum-product message passing (loopy, damped, to convergence) over
chain and skip edges lets an unmistakable mention carry its label to the other
mentions in the document: a phone number repeated without its plus, an address
with blanks around the sign, a card number with other separators; two mentions that no
pattern takes may carry each other.  Tokens of a repeat whose
belief in a kind is high, and whose digits or address could be of that kind, add spans to the base ones.

The unary weights are trained (softmax regression) on a bounded sample, with the
base patterns as distant labels; chain and skip potentials come from the counts of
label pairs on the sample's edges (piecewise training).
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns and bounds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")  # starts within digits fail alike
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

#: Where a digit pattern can match: every match but a phone's plus lies in such a run.
DIGIT_RUN = re.compile(r"[0-9][0-9 ().-]*")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Tokens of the field: numbers with their separators; addresses, also with blanks or words for the sign.
NUMBER = re.compile(r"\+?[0-9(][0-9().,:/-]*(?:[ -][0-9(][0-9().-]*)*")
ADDRESS = re.compile(r"(?<![^\s@])[^\s@]+\s?(?:@|\(at\)|\[at\])\s?[^\s@]+")
AT = re.compile(r"\s?(?:@|\(at\)|\[at\])\s?")

#: Documents of the training sample; belief that adds a span; rounds and damping of messages.
TRAIN_ROWS = 2000
BELIEF, ROUNDS, DAMPING, SETTLED = 0.75, 50, 0.3, 1e-4
#: Digits that two numbers must share at their ends to be joined.
SHARED = 7


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int, str]]:
    """For each at sign the match that starts where the characters before it do; if that one
    fails, so does every later start, so no text costs more than its length."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in LOCAL:
            lo -= 1
        m = EMAIL.match(text, lo) if lo < at else None
        if m:
            out.append((m.start(), m.end(), "email"))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = _emails(text) if "@" in text else []
    for run in DIGIT_RUN.finditer(text):
        lo, hi = run.span()
        if hi - lo < 7:
            continue
        part = run.group()
        if part.count(".") >= 3:
            found += [(m.start(), m.end(), "ip") for m in IP.finditer(text, lo, hi)
                      if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
        if hi - lo >= CARD_DIGITS[0]:
            for m in CARD.finditer(text, lo, hi):
                digits = m.group().replace(" ", "").replace("-", "")
                if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                    found.append((m.start(), m.end(), "card"))
        if lo and text[lo - 1] == "+":
            m = PHONE.match(text, lo - 1, hi)
            if m and PHONE_DIGITS[0] <= sum(c.isdigit() for c in m.group()) <= PHONE_DIGITS[1]:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass(frozen=True)
class Token:
    start: int
    end: int
    text: str
    label: int  # 0 none, else 1 + kind of the base span that covers it


FEATURES = ("bias", "plus", "address", "at", "octets", "luhn",
            "digits_small", "digits_short", "digits_phone", "digits_card", "digits_more", "grouped", "letters")


def _numbers(text: str):
    """(start, end) of the number tokens.  A run of groups longer than any kind is cut where a card
    number is complete, else before the group that passes its length: no token holds two numbers."""
    for m in NUMBER.finditer(text):
        start, end = m.span()
        if sum(c.isdigit() for c in m.group()) <= CARD_DIGITS[1]:
            yield start, end
            continue
        digits, last = "", start
        for group in re.finditer(r"[^ ]+", m.group()):
            more = "".join(c for c in group.group() if c.isdigit())
            full = CARD_DIGITS[0] <= len(digits) and luhn(digits)
            if digits and (full or len(digits) + len(more) > CARD_DIGITS[1]):
                yield start, last
                start, digits = m.start() + group.start(), ""
            digits += more
            last = m.start() + group.end()
        yield start, last


def tokens_of(text: str, base: list[tuple[int, int, str]]) -> list[Token]:
    """Candidate tokens in order; a base span is a token, other candidates lie outside them."""
    out, last = [], 0
    for s, e, k in base:
        if s >= last:
            out.append(Token(s, e, text[s:e], 1 + KINDS.index(k)))
            last = e
    found = list(_numbers(text))
    if "@" in text or "(at)" in text or "[at]" in text:
        found += [m.span() for m in ADDRESS.finditer(text)]
    taken, at, last = [(t.start, t.end) for t in out], 0, 0
    # an address goes before the numbers inside it
    for s, e in sorted(found, key=lambda f: (f[0], -f[1])):
        while e > s and text[e - 1] in " .,:;-/(":
            e -= 1
        if e <= s or s < last:
            continue
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if at < len(taken) and taken[at][0] < e:
            continue
        out.append(Token(s, e, text[s:e], 0))
        last = e
    return sorted(out, key=lambda t: t.start)


def address_of(token: str) -> str:
    """The token with a plain at sign."""
    return AT.sub("@", token, count=1)


def digits_of(token: str) -> str:
    return "".join(c for c in token if "0" <= c <= "9")


def octets(token: str) -> bool:
    parts = re.split(r"[^0-9]+", token.strip("()[]"))
    return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)


def key_of(token: str) -> str:
    """What repeats of a mention share: the letters and digits of an address, else the digits."""
    address = address_of(token).lower()
    if "@" in address:
        return "".join(c for c in address if c.isalnum() or c == "@")
    return digits_of(token)


def possible(kind: str, token: str) -> bool:
    """Could the token be of the kind, separators aside?"""
    digits, address = digits_of(token), address_of(token)
    if kind == "email":
        return EMAIL.fullmatch(address) is not None
    if "@" in address:
        return False
    if kind == "ip":
        return octets(token)
    if kind == "card":
        return CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits)
    # a phone number has few groups, and no single digits after its first: lists of numbers do
    groups = re.findall(r"[0-9]+", token)
    return PHONE_DIGITS[0] <= len(digits) <= PHONE_DIGITS[1] and len(groups) <= 5 and all(len(g) > 1 for g in groups[1:])


def features(token: Token, hide: bool = False) -> np.ndarray:
    """Unary features, of the token's shape alone; ``hide`` drops the plus that the phone pattern needs."""
    digits = digits_of(token.text)
    n = len(digits)
    x = np.ones(len(FEATURES))
    x[1:] = (token.text.startswith("+") and not hide, possible("email", token.text), "@" in address_of(token.text),
             octets(token.text), CARD_DIGITS[0] <= n <= CARD_DIGITS[1] and luhn(digits),
             n < SHARED, SHARED <= n < PHONE_DIGITS[0], PHONE_DIGITS[0] <= n <= PHONE_DIGITS[1],
             CARD_DIGITS[0] <= n <= CARD_DIGITS[1], n > CARD_DIGITS[1],
             any(c in " -().," for c in token.text.strip("()")), any(c.isalpha() for c in token.text))
    return x


def skip_edges(tokens: list[Token]) -> list[tuple[int, int]]:
    """Each token with the nearest earlier one of the same key, or of a key with the same ending
    (so edges grow with the tokens, not with pairs)."""
    edges, exact, ending = [], {}, {}
    for i, t in enumerate(tokens):
        key = key_of(t.text)
        if "@" not in key and len(key) < SHARED:
            continue
        tail = key[-SHARED:] if "@" not in key else key
        before = exact.get(key, ending.get(tail))
        if before is not None:
            edges.append((before, i))
        exact[key] = i
        ending[tail] = i
    return edges


class SkipChainField:
    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    def unaries(self, tokens: list[Token]) -> np.ndarray:
        """Unary potentials; the label of a base span is observed, so it is fixed."""
        scores = np.clip(np.array([features(t) for t in tokens]) @ self.unary, -30, 30)
        for i, t in enumerate(tokens):
            if t.label:
                scores[i] = -30
                scores[i, t.label] = 0
        return np.exp(scores)

    def beliefs(self, tokens: list[Token]) -> np.ndarray:
        """Marginals by damped sum-product messages over chain and skip edges."""
        n = len(tokens)
        phi = self.unaries(tokens)
        edges = [(i, i + 1, self.chain) for i in range(n - 1)] + [(i, j, self.skip) for i, j in skip_edges(tokens)]
        if not edges:
            return phi / phi.sum(axis=1, keepdims=True)
        source = np.array([i for i, _, _ in edges] + [j for _, j, _ in edges])
        target = np.array([j for _, j, _ in edges] + [i for i, _, _ in edges])
        pair = np.array([p for _, _, p in edges] + [p.T for _, _, p in edges])
        half = len(edges)
        back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
        logs = np.zeros((2 * half, phi.shape[1]))
        for _ in range(ROUNDS):
            total = np.log(phi)
            np.add.at(total, target, logs)
            out = total[source] - logs[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.einsum("ea,eab->eb", out, pair) + 1e-300)
            new -= new.max(axis=1, keepdims=True)
            moved = np.abs(new - logs).max()
            logs = DAMPING * logs + (1 - DAMPING) * new
            if moved < SETTLED:
                break
        total = np.log(phi)
        np.add.at(total, target, logs)
        total = np.exp(total - total.max(axis=1, keepdims=True))
        return total / total.sum(axis=1, keepdims=True)

    def added(self, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Spans of tokens outside the base ones, linked to another token, whose belief in a
        kind that is possible for them reaches BELIEF."""
        tokens = tokens_of(text, base)
        if len(tokens) < 2:
            return []
        linked = {k for edge in skip_edges(tokens) for k in edge}
        open_ = [i for i in sorted(linked) if not tokens[i].label and any(possible(k, tokens[i].text) for k in KINDS)]
        if not open_:  # no token that could be added: messages would change nothing
            return []
        belief = self.beliefs(tokens)
        out = []
        for i in open_:
            t, kind = tokens[i], int(belief[i, 1:].argmax())
            if belief[i, 1 + kind] >= BELIEF and possible(KINDS[kind], t.text):
                out.append((t.start, t.end, KINDS[kind]))
        return out


def train(texts: list[str]) -> SkipChainField:
    """Piecewise training with the base spans as labels.  A labelled token counts half as it stands
    and half without its plus, so that the rest of its shape also carries weight."""
    labels = len(KINDS) + 1
    rows, ys, counts = [], [], []
    chain, skip = np.full((labels, labels), 0.5), np.full((labels, labels), 0.02)
    skip += np.eye(labels)
    for text in texts:
        tokens = tokens_of(text, base_spans(text))
        for t in tokens:
            for hide in (False, True) if t.label else (False,):
                rows.append(features(t, hide))
                ys.append(t.label)
                counts.append(0.5 if t.label else 1.0)
        for a, b in zip(tokens, tokens[1:]):
            chain[a.label, b.label] += 1
        for i, j in skip_edges(tokens):
            # a pattern that fails on a repeat says nothing on its label
            if tokens[i].label and tokens[j].label:
                skip[tokens[i].label, tokens[j].label] += 1
                skip[tokens[j].label, tokens[i].label] += 1
    weights = np.zeros((len(FEATURES), labels))
    if rows:
        x, y, share = np.array(rows), np.eye(labels)[ys], np.array(counts)[:, None] / sum(counts)
        for _ in range(300):
            p = np.exp(x @ weights - (x @ weights).max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            weights -= 1.0 * (x.T @ (share * (p - y)) + 0.002 * weights)
    share = chain / chain.sum()
    chain = share / np.outer(share.sum(axis=1), share.sum(axis=0))  # lift over independence
    skip = skip / skip.sum(axis=1, keepdims=True)
    return SkipChainField(weights, np.sqrt(chain), skip)


def fitted(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> SkipChainField:
    """Trains on the first ``train_rows`` documents, by hashed id, that hold a digit run or an at sign."""
    first = [F.xxhash64("doc_id"), F.col("doc_id")]
    texts = docs.select("doc_id", "text").where(F.col("text").rlike(r"[0-9]{3}|@"))
    # ids are chosen before texts are read, so that no task sends texts that are not among the first
    ids = texts.select("doc_id").orderBy(*first).limit(train_rows).select(F.col("doc_id").alias("__id")).distinct()
    rows = (texts.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
            .orderBy(*first, F.md5("text")).limit(train_rows).collect())
    return train(sorted({r["text"] for r in rows}))


def digest(spans) -> str:
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in spans)


def scan_documents(docs: DataFrame, field: SkipChainField) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, added spans.

    Null and empty texts have no spans; ids may be null or repeat; other columns are not
    read; an empty table gives no rows.
    """
    def run(ids, texts):
        rows = []
        for i, text in zip(ids, texts):
            base = base_spans(text)
            added = field.added(text, base)
            every = sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))
            rows.append((i, *(sum(s[2] == k for s in base) for k in KINDS),
                         hashlib.sha256(digest(base).encode()).hexdigest(), digest(every), len(added)))
        return pd.DataFrame(rows, columns=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    out = per_text(docs, run, "doc_id string, n_email long, n_ip long, n_card long, n_phone long, "
                              "base_sha256 string, spans string, n_added long")
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint"))
