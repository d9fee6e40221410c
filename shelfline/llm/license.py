"""Licence scans by a trained paragraph classifier.

A paragraph is a line, or consecutive lines over which a notice is wrapped: lines that consist
mostly of word pairs of the notices and follow each other without a line empty of words (comment
marks alone are no words).  Multinomial logistic regression on sparse word n-grams
(one to three words of the notices' vocabulary) gives each licence family a
probability, with an unknown class trained on paragraphs of the corpus.  The
probabilities are calibrated by a temperature on held-out paragraphs.  A family is
reported only where the template comparison agrees: enough of the paragraph's
word pairs stand in one of the family's notices, or the reverse.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text

#: Short notices of the licence families, as they are commonly written.
NOTICES = {
    "MIT": ["Released under the MIT License.",
            "This project is licensed under the terms of the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": ["This program is licensed under the GNU General Public License, version 2.",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "AGPL-3.0": ["This program is licensed under the GNU Affero General Public License, version 3.",
                 "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "EPL-2.0": ["Licensed under the Eclipse Public License 2.0.",
                "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"],
    "BSD": ["Released under the BSD License.", "Licensed under the 3-Clause BSD License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, version 2.0."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY": ["Licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC0": ["Released under CC0 1.0 Universal.",
            "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "ISC": ["Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part of this publication may be reproduced without permission."],
}
FAMILIES = ("unknown", *NOTICES)

#: Bound of the training sample: documents that give unknown paragraphs.
TRAIN_ROWS, TRAIN_PARAGRAPHS = 400, 4000
NGRAM, COPIES, STEPS = 3, 24, 200
#: Calibrated probability and template agreement that a report needs.
CUT, AGREE = 0.5, 0.6
#: Share of a line's word pairs that stand in notices, from which it may be a part of a wrapped one.
LIKE = 0.5
WORD = re.compile(r"[a-z0-9]+")


def words_of(paragraph: str) -> list[str]:
    return WORD.findall(paragraph.lower())


def grams(words: list[str], n: int) -> list[tuple[str, ...]]:
    return list(zip(*(words[i:] for i in range(n))))


def ends_sentence(line: str) -> bool:
    return line.rstrip().endswith((".", "!", "?", ":"))


TEMPLATES = {family: [frozenset(grams(words_of(t), 2)) for t in notices] for family, notices in NOTICES.items()}


#: Every word pair of the notices, and the pairs that open one.
PAIRS = frozenset(p for notices in TEMPLATES.values() for t in notices for p in t)
OPENINGS = frozenset(tuple(words_of(t)[:2]) for notices in NOTICES.values() for t in notices)


def coverage(words: list[str], family: str) -> float:
    """The largest share of one notice's word pairs that the paragraph holds."""
    pairs = frozenset(grams(words, 2))
    return max(len(pairs & t) / len(t) for t in TEMPLATES[family])


def agreement(words: list[str], family: str) -> float:
    """The best share of word pairs: of the paragraph in a notice, or of a notice in the paragraph."""
    pairs = frozenset(grams(words, 2))
    if not pairs:
        return 0.0
    return max(len(pairs & t) / min(len(pairs), len(t)) for t in TEMPLATES[family])


class LicenceModel:
    def __init__(self, vocabulary: dict[tuple[str, ...], int], weights: np.ndarray, temperature: float):
        self.vocabulary, self.weights, self.temperature = vocabulary, weights, temperature
        self.first = frozenset(g[0] for g in vocabulary)

    def columns(self, words: list[str]) -> list[int]:
        """Known n-grams of a paragraph; an n-gram can only start where its first word is known."""
        known, first = self.vocabulary, self.first
        found = set()
        for i, w in enumerate(words):
            if w in first:
                for n in range(1, NGRAM + 1):
                    k = known.get(tuple(words[i:i + n]))
                    if k is not None:
                        found.add(k)
        return sorted(found)

    def probabilities(self, columns: list[int]) -> np.ndarray:
        z = (self.weights[columns].sum(axis=0) / np.sqrt(max(1, len(columns))) + self.weights[-1]) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    def family(self, words: list[str]) -> tuple[str, float, float] | None:
        """(family, probability, agreement) of a paragraph, or None for unknown."""
        columns = self.columns(words) if words else []
        if columns:  # without a known n-gram only the intercept speaks, for unknown
            p = self.probabilities(columns)
            k = int(p.argmax())
            if k and p[k] >= CUT:
                agree = agreement(words, FAMILIES[k])
                if agree >= AGREE:
                    return FAMILIES[k], float(p[k]), agree
        return None

    def paragraphs(self, lines: list[str]) -> list[list[tuple[int, list[str]]]]:
        """Lines (number, words) in paragraphs: lines that may be parts of one notice stand together."""
        out, last = [], None        # last word of the paragraph that the next line may join
        for number, line in enumerate(lines):
            words = words_of(line)
            if not words:
                last = None
                continue
            like = False
            if words[0] in self.first or words[-1] in self.first:  # else no pair at the line's ends is known
                pairs = grams([last, *words] if last else words, 2)
                like = bool(pairs) and sum(p in PAIRS for p in pairs) >= LIKE * len(pairs)
            if like and last and not self._opens(words, out[-1][-1], lines):
                out[-1].append((number, words))
            else:
                out.append([(number, words)])
            last = words[-1] if like else None
        return out

    def _opens(self, words: list[str], before: tuple[int, list[str]], lines: list[str]) -> bool:
        """Does the line open a notice of its own, after a sentence or a notice that is complete?"""
        if tuple(words[:2]) not in OPENINGS:
            return False
        found = self.family(before[1])
        return ends_sentence(lines[before[0]]) or bool(found and coverage(before[1], found[0]) >= AGREE)

    def find(self, text: str) -> list[tuple[int, int, int, str, float, float]]:
        """(number of the first line, start, end, family, probability, agreement) of every reported paragraph.

        A wrapped paragraph is one report, unless its lines hold notices of several families, or it
        is of none as a whole: then each line stands for itself.
        """
        lines, out = text.split("\n"), []
        starts = [0]
        for line in lines:
            starts.append(starts[-1] + len(line) + 1)
        for paragraph in self.paragraphs(lines):
            parts = [paragraph]
            if len(paragraph) > 1:
                alone = [(words, self.family(words)) for _, words in paragraph]
                complete = {f[0] for words, f in alone if f and coverage(words, f[0]) >= AGREE}
                if len(complete) > 1 or not self.family([w for _, words in paragraph for w in words]):
                    parts = [[line] for line in paragraph]
            for part in parts:
                found = self.family([w for _, words in part for w in words])
                if found:
                    first, end = part[0][0], part[-1][0]
                    out.append((first, starts[first], starts[end + 1] - 1, *found))
        return out


def _variants(rng: np.random.Generator, notice: str, filler: list[str]) -> list[list[str]]:
    """The notice, and copies that lose some words, are cut, or stand in other words."""
    words = words_of(notice)
    out = [words]
    for k in range(COPIES):
        kept = [w for w in words if rng.random() > 0.06] or words
        if len(kept) > 24:
            lo = int(rng.integers(0, len(kept) - 16))
            kept = kept[lo:lo + int(rng.integers(16, len(kept) + 1))]
        if k % 3 == 0 and filler:
            around = rng.choice(filler, 6).tolist()
            kept = around[:3] + kept + around[3:]
        out.append(kept)
    return out


def train(paragraphs: list[str], seed: int = 7) -> LicenceModel:
    """``paragraphs`` of the corpus train the unknown class, but for those that match a notice."""
    rng = np.random.default_rng(seed)
    corpus = [w for p in paragraphs[:TRAIN_PARAGRAPHS] if (w := words_of(p))]
    corpus = [w for w in corpus if all(agreement(w, f) < AGREE for f in NOTICES)]
    filler = [w for p in corpus[:200] for w in p[:5]]
    data = [(v, k) for k, f in enumerate(FAMILIES) if k for notice in NOTICES[f] for v in _variants(rng, notice, filler)]
    data += [(w, 0) for w in corpus]
    # words and cuts of notices alone say little: unknown
    data += [(rng.permutation(words_of(n))[:4].tolist(), 0) for f in NOTICES.values() for n in f for _ in range(4)]
    vocabulary = {g: k for k, g in enumerate(sorted({g for notices in NOTICES.values() for t in notices
                                                     for n in range(1, NGRAM + 1) for g in grams(words_of(t), n)}))}
    model = LicenceModel(vocabulary, np.zeros((len(vocabulary) + 1, len(FAMILIES))), 1.0)
    x = np.zeros((len(data), len(vocabulary) + 1), np.float32)
    for row, (words, _) in enumerate(data):
        columns = model.columns(words)
        x[row, columns] = 1 / np.sqrt(max(1, len(columns)))
    x[:, -1] = 1
    y = np.eye(len(FAMILIES), dtype=np.float32)[[k for _, k in data]]
    held = np.arange(len(data)) % 4 == 3

    def softmax(z):
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    for _ in range(STEPS):
        p = softmax(x[~held] @ w)
        w -= 8.0 * (x[~held].T @ (p - y[~held]) / (~held).sum() + 1e-5 * w)
    z = x[held] @ w
    loss = lambda t: -np.log(np.maximum(1e-12, (softmax(z / t) * y[held]).sum(axis=1))).mean()
    model.temperature = float(min((0.25, 0.4, 0.6, 0.8, 1.0, 1.25, 1.6, 2.0, 3.0), key=loss))
    model.weights = w.astype(float)
    return model


def fitted(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> LicenceModel:
    """Unknown paragraphs come from the first ``train_rows`` documents by hashed id."""
    first = [F.xxhash64("doc_id"), F.col("doc_id")]
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    # ids are chosen before texts are read, so that no task sends texts that are not among the first
    ids = texts.select("doc_id").orderBy(*first).limit(train_rows).select(F.col("doc_id").alias("__id")).distinct()
    rows = (texts.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
            .orderBy(*first).limit(train_rows).collect())
    lines = sorted({line for r in rows for line in r["text"].split("\n")})
    rng = np.random.default_rng(3)
    return train([lines[i] for i in rng.permutation(len(lines))])


def scan_documents(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """One row per reported paragraph: doc_id, paragraph, start, end (code points), family,
    probability, agreement.

    ``paragraph`` is the number of its first line; families are those of ``NOTICES``.  Null, empty
    and licence-free texts give no rows; ids may be null or repeat; a notice that
    repeats in a document is reported each time; other columns are not read.
    """
    def run(ids, texts):
        rows = [(i, *found) for i, t in zip(ids, texts) for found in model.find(t)]
        return pd.DataFrame(rows, columns=["doc_id", "paragraph", "start", "end", "family", "probability", "agreement"])

    out = per_text(docs, run, "doc_id string, paragraph int, start long, end long, family string, "
                              "probability double, agreement double")
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint"))
