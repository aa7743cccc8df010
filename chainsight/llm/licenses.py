"""License scans with a trained paragraph classifier.

A paragraph is a line of text, or a run of lines that holds more of one template
than any run inside it (a notice that was wrapped); such runs go before the lines
inside them.  Its features are the words and word pairs of the licence templates
that it holds, plus the share of words that no template has.  A multinomial
logistic regression over the families and the class ``unknown`` is trained on
variants of the templates (words dropped, replaced, added, cut) and on a bounded
sample of the corpus' own lines, and calibrated by a temperature on held-out
variants.  A predicted family is confirmed by comparison with its templates: the
weighted share of word pairs, of the shorter side, that both have.

Scanning is one pass without a shuffle.  Paragraphs without any word pair of a
template can't be confirmed and are not classified.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

LINES = 4_000           # corpus lines of the training sample at most
VARIANTS = 60           # of each template
PROBABILITY = 0.5
SIMILARITY = 0.6
FOREIGN = 0.5           # of a common pair, what a foreign pair takes from a run's worth
AROUND = 11             # words that a run may have besides the longest template's
UNKNOWN = "unknown"

#: Short notices of well-known public licences (fixed values).
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License. See LICENSE in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License version 2 as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 3 of the "
        "License.",
        "SPDX-License-Identifier: LGPL-3.0",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC0-1.0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has dedicated all copyright to the public domain under CC0.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "proprietary": [
        "All rights reserved.",
        "All rights reserved. Confidential and proprietary. Unauthorized copying of this file is prohibited.",
        "No part of this work may be reproduced without the written permission of the copyright holder.",
    ],
}
FAMILIES = (*TEMPLATES, UNKNOWN)
WORD = re.compile(r"[^\W_]+")


def words_of(line: str) -> list[str]:
    return WORD.findall(line.lower())


def variants(words: list[str], others: list[str], many: int, rng: random.Random) -> list[list[str]]:
    """A template's words, and changed versions: cut (a quarter at most), a word
    dropped or replaced, foreign words put around it."""
    out = [words]
    for _ in range(many - 1):
        own = list(words)
        if len(own) > 8 and rng.random() < 0.5:
            cut = rng.randrange(len(own) // 4 + 1)
            own = own[cut:] if rng.random() < 0.5 else own[:len(own) - cut]
        for _ in range(rng.randrange(1 + len(own) // 10)):
            at = rng.randrange(len(own))
            own[at:at + 1] = [] if rng.random() < 0.5 else [rng.choice(others)]
        if rng.random() < 0.4:
            own = [rng.choice(others) for _ in range(rng.randrange(4))] + own
        if rng.random() < 0.4:
            own = own + [rng.choice(others) for _ in range(rng.randrange(8))]
        out.append(own)
    return out


class Scanner:
    """Features, classifier and templates."""

    def __init__(self, negatives: list[list[str]], seed: int = 7):
        templates = [(n, words_of(t)) for n, texts in enumerate(TEMPLATES.values()) for t in texts]
        self.numbers: dict = {}
        for _, words in templates:
            for f in (*words, *zip(words, words[1:])):
                self.numbers.setdefault(f, len(self.numbers))
        spread: dict[tuple, set[int]] = {}
        for n, words in templates:
            for p in zip(words, words[1:]):
                spread.setdefault(p, set()).add(n)
        # a pair that many families share says little
        self.worth = {p: 1.0 / len(f) for p, f in spread.items()}
        self.templates = [(n, set(zip(words, words[1:]))) for n, words in templates]
        self.holders: dict[tuple, list[int]] = {}
        for at, (_, pairs) in enumerate(self.templates):
            for p in pairs:
                self.holders.setdefault(p, []).append(at)
        self.longest = max(len(words) for _, words in templates) + AROUND
        rng = random.Random(seed)
        others = sorted({w for words in negatives for w in words}) or ["text"]
        clean = [w for w in negatives if self.similarity(w)[0] < 0.3]
        rows, target = [], []
        for n, words in templates:
            made = variants(words, others, VARIANTS, rng)
            rows += made
            target += [n] * len(made)
        rows += clean + [[], ["the"], ["of", "the"]]
        target += [len(FAMILIES) - 1] * (len(rows) - len(target))
        x = np.array([self.vector(w) for w in rows])
        y = np.array(target)
        held = np.arange(len(y)) % 5 == 0
        self.weights = self.fit(x[~held], y[~held])
        self.temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 3.0),
                               key=lambda t: self.loss(x[held] @ self.weights / t, y[held]))

    def vector(self, words: list[str]) -> np.ndarray:
        x = np.zeros(len(self.numbers) + 2)
        for f in (*words, *zip(words, words[1:])):
            at = self.numbers.get(f)
            if at is not None:
                x[at] = 1.0
        x[-2] = 4 * sum(w not in self.numbers for w in words) / max(1, len(words))
        x[-1] = 1.0
        return x

    @staticmethod
    def loss(logits: np.ndarray, y: np.ndarray) -> float:
        z = logits - logits.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]).mean())

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, rounds: int = 300, decay: float = 1e-3) -> np.ndarray:
        """Softmax regression; each class counts the same in total."""
        weights = np.zeros((x.shape[1], len(FAMILIES)))
        share = 1.0 / np.bincount(y, minlength=len(FAMILIES)).clip(1)[y] / len(FAMILIES)
        goal = np.eye(len(FAMILIES))[y]
        step = 1.0 / (0.5 * float((x * x).sum(axis=1).mean()) + decay)
        v = weights
        for t in range(rounds):
            z = x @ v
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            new = v - step * (x.T @ ((p - goal) * share[:, None]) + decay * v)
            v = new + t / (t + 3) * (new - weights)
            weights = new
        return weights

    def similarity(self, words: list[str], family: int | None = None) -> tuple[float, int]:
        """Best weighted share of common pairs with a template, of the shorter side; its family."""
        own = set(zip(words, words[1:]))
        mine = sum(self.worth.get(p, 1.0) for p in own)
        best = (0.0, -1)
        for n, pairs in self.templates:
            if family is None or n == family:
                common = sum(self.worth[p] for p in own & pairs)
                size = min(mine, sum(self.worth[p] for p in pairs))
                if common:
                    best = max(best, (common / size, n))
        return best

    def line(self, words: list[str]) -> tuple[str, float, float] | None:
        """Family, probability and similarity of a confirmed line."""
        if not any(p in self.worth for p in zip(words, words[1:])):
            return None
        z = self.vector(words) @ self.weights / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        n = int(p.argmax())
        if n == len(FAMILIES) - 1 or p[n] < PROBABILITY:
            return None
        like = self.similarity(words, n)[0]
        return (FAMILIES[n], float(p[n]), like) if like >= SIMILARITY else None

    def runs(self, lines: list[list[str]]) -> list[tuple[int, int]]:
        """First and last line of each run that is worth more than the runs inside it (as
        much, where its last line only repeats pairs of the run), the best and longest ones
        first.  A run's worth: the pairs in common with one template, less ``FOREIGN`` of
        its other pairs."""
        worth: dict[tuple[int, int], float] = {}
        for first, words in enumerate(lines):
            if not words or len(words) > self.longest:
                continue
            pairs: set[tuple] = set()
            common: dict[int, int] = {}
            size, end = 0, []
            for last in range(first, len(lines)):
                size += len(lines[last])
                if size > self.longest:
                    break
                new = set(zip(end + lines[last], (end + lines[last])[1:])) - pairs
                end = lines[last][-1:] or end
                pairs |= new
                for p in new:
                    for at in self.holders.get(p, ()):
                        common[at] = common.get(at, 0) + 1
                own = (1 + FOREIGN) * max(common.values(), default=0) - FOREIGN * len(pairs)
                if own < 0:
                    break
                worth[first, last] = own
        best = [(own, first, last) for (first, last), own in worth.items()
                if lines[last] and own > max(0, worth.get((first + 1, last), 0)) and own >= worth.get((first, last - 1), 0)]
        return [(first, last) for _, first, last in sorted(best, key=lambda x: (-x[0], x[1] - x[2], x[1]))]

    def scan(self, text: str | None) -> list[dict]:
        lines = (text or "").split("\n")
        words = [words_of(line) for line in lines]
        starts = [0]
        for line in lines:
            starts.append(starts[-1] + len(line) + 1)
        free = [True] * len(lines)
        found = []

        def confirm(first: int, last: int) -> None:
            got = self.line([w for line in words[first:last + 1] for w in line])
            if got:
                free[first:last + 1] = [False] * (last + 1 - first)
                found.append({"paragraph": first, "start": starts[first], "end": starts[last + 1] - 1,
                              "family": got[0], "probability": got[1], "similarity": got[2]})

        for first, last in self.runs(words):
            if all(free[first:last + 1]):
                confirm(first, last)
        for n in range(len(lines)):
            if free[n]:
                confirm(n, n)
        return sorted(found, key=lambda x: x["paragraph"])


FOUND = T.ArrayType(T.StructType([
    T.StructField("paragraph", T.IntegerType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("family", T.StringType()),
    T.StructField("probability", T.DoubleType()), T.StructField("similarity", T.DoubleType())]))


def train(docs: DataFrame, text_col: str = "text", lines: int = LINES) -> Scanner:
    """Fit on the templates and on a bounded sample of ``docs``: at most ``lines`` distinct
    lines (up to 400 characters) of at most ``lines // 8`` distinct texts, the first in
    hash order."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL") \
        .select(F.xxhash64("text").alias("h"), "text")
    first = texts.select("h").distinct().orderBy("h").limit(lines // 8)
    some = texts.join(F.broadcast(first), "h").select(F.explode(F.split("text", "\n")).alias("line")) \
        .where(F.length("line").between(1, 400)).distinct().orderBy(F.xxhash64("line"), "line").limit(lines)
    return Scanner([words_of(r["line"]) for r in some.collect()])


def licence_column(text: Column, scanner: Scanner) -> Column:
    """array<struct(paragraph, start, end, family, probability, similarity)> of a text."""
    kind = to_arrow_type(FOUND)

    @F.arrow_udf(FOUND)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([scanner.scan(t.as_py()) for t in texts], kind)
    return run(text)


def scan_licences(docs: DataFrame, scanner: Scanner, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``licences`` (array of paragraph, start, end, family, probability,
    similarity; code points, end exclusive) of every row.

    A null or empty text has none; null ids and repeated rows are kept; an empty
    table gives no rows.  Equal probabilities go to the family listed first.  Other
    columns are not read."""
    return docs.select(F.col(f"`{id_col}`"), licence_column(F.col(f"`{text_col}`"), scanner).alias("licences"))
