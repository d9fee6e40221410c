"""Quality by compression: a text that the dictionary of good texts shortens more is good.

Two zstandard dictionaries are trained, one from good and one from bad labelled
texts.  Every text is cut into blocks that are compressed with both (so that the
dictionary counts along the whole text); the difference of the compressed sizes
over the text's size, and the share left after compression, are calibrated to a
probability by logistic regression on labelled texts that made no dictionary.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text, python_tasks
from .labelled import class_weights, fold, logistic, sigmoid, training_rows

#: Bounds of the training sample: documents per class and bytes of each taken for a dictionary.
TRAIN_ROWS, TRAIN_BYTES = 4000, 4096
#: Pieces that a longer text's bytes are taken in, one from each equal part of it.
PIECES = 8
DICTIONARY_BYTES, BLOCK, LEVEL = 112_640, 2048, 3
FOLDS, HELD_OUT, CUT = 5, 0, 0.3


class CompressionScorer:
    """Holds the dictionaries' bytes and the calibration; compressors are made once per worker."""

    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray):
        self.good, self.bad, self.weights = good, bad, weights
        self._made = None

    def __getstate__(self):
        return self.good, self.bad, self.weights

    def __setstate__(self, state):
        self.__init__(*state)

    def _compressors(self):
        if self._made is None:
            made = []
            for content in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(content)
                d.precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False,
                                                     write_dict_id=False))
            self._made = made
        return self._made

    def features(self, texts: list[str]) -> np.ndarray:
        good, bad = self._compressors()
        out = np.zeros((len(texts), 2))
        for row, text in enumerate(texts):
            raw = text.encode("utf-8", "surrogatepass")
            if not raw:
                continue
            g = b = 0
            for at in range(0, len(raw), BLOCK):
                block = raw[at:at + BLOCK]
                g += len(good.compress(block))
                b += len(bad.compress(block))
            out[row] = (b - g) / len(raw), min(g, b) / len(raw)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        x = self.features(texts)
        return sigmoid(np.column_stack([x, np.ones(len(x))]) @ self.weights)


def _pieces(text: str) -> list[bytes]:
    """The blocks of a text of up to ``TRAIN_BYTES``; of a longer one as many bytes, spread over
    the whole of it at places drawn by hash."""
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw) <= TRAIN_BYTES:
        return [raw[at:at + BLOCK] for at in range(0, len(raw), BLOCK)]
    draw, width = zlib.crc32(raw), TRAIN_BYTES // PIECES
    ends = [len(raw) * k // PIECES for k in range(PIECES + 1)]
    starts = [lo + zlib.crc32(b"%d" % k, draw) % (hi - lo - width + 1) for k, (lo, hi) in enumerate(zip(ends, ends[1:]))]
    return [raw[at:at + width] for at in starts]


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; a raw one where zstandard finds too little to train on."""
    samples = [piece for t in texts for piece in _pieces(t)]
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, total // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:] or b" " * 8


def train(sample: pd.DataFrame, odds: float | None = None) -> CompressionScorer:
    """From rows (text, label): two of three make the dictionaries, the third the calibration.

    Both dictionaries take the same number of bytes, so that neither class is the longer
    memory.  With a class missing, scores are the (smoothed) share of good rows.  ``odds``: the
    logarithm of the odds of label 1 among all labels (None: as in the sample), so that the score
    is a probability whatever share of either class was sampled.
    """
    y = sample["label"].to_numpy(float)
    prior = np.log((y.sum() + 1) / (len(y) - y.sum() + 1)) if odds is None else odds
    if len(np.unique(y)) < 2:
        return CompressionScorer(b" " * 8, b" " * 8, np.array([0.0, 0.0, prior]))
    at = np.zeros(len(y), int)
    for label in (0, 1):
        of = np.flatnonzero(y == label)
        at[of] = np.arange(len(of)) % 3
    fit, rest = sample[at != 2], sample[at == 2]
    by = {label: fit.loc[fit["label"] == label, "text"].tolist() for label in (0, 1)}
    size = {k: [min(len(t.encode("utf-8", "surrogatepass")), TRAIN_BYTES) for t in v] for k, v in by.items()}
    room = min(sum(size[0]), sum(size[1]))
    equal = {k: [t for t, upto in zip(v, np.cumsum(size[k])) if upto <= room] or v[:1] for k, v in by.items()}
    scorer = CompressionScorer(_dictionary(equal[1]), _dictionary(equal[0]), np.zeros(3))
    x = scorer.features(rest["text"].tolist())
    spread = np.array([60.0, 10.0, 10.0])
    of = rest["label"].to_numpy(float)
    scorer.weights = logistic(x, of, np.array([5.0, 0.0, prior]), spread, rows=class_weights(of, prior))
    return scorer


def fitted(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> CompressionScorer:
    return train(*training_rows(docs, labels, "quality", FOLDS, HELD_OUT, train_rows))


def score_quality(docs: DataFrame, scorer: CompressionScorer) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; null and empty texts get the score of
    no evidence; nulls, repeated rows and other columns pass through without effect."""
    def run(ids, texts):
        return pd.DataFrame({"doc_id": ids, "score": scorer.scores(texts)})

    scored = per_text(docs, run, "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, scorer: CompressionScorer) -> DataFrame:
    """``docs`` (all columns) without the rows whose score is below the cut."""
    python_tasks(docs.sparkSession)

    def arrow(batches):
        for batch in batches:
            keep = scorer.scores(["" if t is None else t for t in batch.column("text").to_pylist()]) >= CUT
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(arrow, docs.schema)
