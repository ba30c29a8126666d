"""Licence notices: a paragraph classifier confirmed by comparison with templates.

A paragraph is a line of a text. Its features are word 1- to 3-grams that occur in the training
notices; a multinomial logistic regression over them, fitted on the driver, tells licence families,
``unknown`` licences and ordinary text apart. Its probabilities are calibrated by a temperature
fitted on notices that it hasn't seen; a family below ``CONFIDENT`` becomes ``unknown``. A family is
confirmed if enough of one of its templates' word pairs occur in the paragraph.

A notice wrapped over several lines is found by its word pairs in the joined lines around a feature
(as far as the longest notice reaches, up to blank lines; comment words dropped), judged as
one text and, if confirmed, reported once, with the number of its first line, in place of what its
lines give alone. Lines that are confirmed alone stay.

Of what remains, lines with a feature are joined to a paragraph if no sentence ends at a break
between them, no line among them is blank or part of a confirmed notice, and no more than ``GAP``
lines in a row lack a feature (such lines add nothing to a score). A paragraph of several lines is judged as one text and
reported once, with the number of its first line, in place of its lines; so wrapped notices of
families without a template, or of none, are one finding. If it is ordinary text as a whole, its
lines keep what they give alone.

It is trained on the templates, variations of them (words left out, words around them), invented
notices of no family, and at most ``SAMPLE`` lines of the corpus (those of smallest hash) without a
cue word. Only n-grams that these lines lack are features, so a line without any of them has the
same score as an empty one, ordinary text; lines are found by their first feature words and then
scored by all their features. No line is cut or left out.

Defined results: null and empty texts have no paragraphs; blank lines are not counted; repeated
rows are scanned one by one; equal probabilities go to the family first listed; an empty table
gives no rows; clashing columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import need, python_on_executors, text_or_empty

SAMPLE, CONFIDENT, CONFIRMED, GAP = 4000, 0.6, 0.75, 1
NONE, UNKNOWN = "none", "unknown"
#: Short notices, opening sentences and whole paragraphs of public licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "This project is released under the Apache 2.0 license.",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "Licensed under the GPLv3.",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "Licensed under the GPLv2.",
    ),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software under the terms of the GNU Lesser General Public License."),
    "agpl-3.0": ("Licensed under the GNU Affero General Public License, version 3.", "You may use this work under the terms of the AGPLv3."),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."),
    "isc": ("Licensed under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'),
    "cc0-1.0": ("Dedicated to the public domain under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nd": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "Released under the Unlicense."),
    "proprietary": ("All rights reserved.", "Copyright. All rights reserved.", "All rights reserved. No part of this work may be reproduced without written permission."),
}
#: Invented notices of no listed family.
OTHERS = (
    "Licensed under the terms of the agreement between the parties.", "Released under the Foo Public Licence, version 1.", "Use is subject to the vendor licence terms.",
    "This work is licensed under a custom license.", "Licensed under the Open Widget License 5.1.", "Distributed under the terms set out in the licence file.",
    "You may copy this text under the house licence.", "Released under the Example Community License.", "Licensed to the customer under separate terms.",
    "This software is licensed, not sold, under these terms.", "See the license for the terms of use.", "The licensor grants a licence under these conditions.",
)
#: Sentences of such notices, with an invented name and a version.
FRAMES = (
    "Licensed under the {0} License.", "Licensed under the {0} License {1}.", "Licensed under the {0} License, version {1}.", "This work is licensed under the {0} License, version {1}.0.",
    "Released under the {0} License.", "This project is licensed under the {0} license.", "Licensed under {0} {1}.0.", "Distributed under the {0} Public License, version {1}.",
    "This file is subject to the terms of the {0} License.", "This program is free software under the terms of the {0} License.", "Licensed under the {0} Source License {1}.",
)
CUE = r"(?i)licen[sc]|copyright|permission|rights reserved|public domain|unencumbered|redistribut|\bgnu\b|\bgpl|creative commons|\bcc0?[ -]|governed"
_WORD = re.compile(r"[a-z0-9]+")
_COMMENT = {"dnl", "rem"}  # marks of comment lines that are words


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(text: str) -> set[str]:
    w = words(text)
    return {" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}


def _variations(notice: str, filler: list[str], rng: np.random.Generator, n: int) -> list[str]:
    out = [notice]
    for _ in range(n):
        w = [x for x in notice.split() if rng.random() > 0.06]
        cut = [list(rng.choice(filler, rng.integers(0, 7))) if filler else [] for _ in range(2)]
        out.append(" ".join([*cut[0], *w, *cut[1]]))
    return out


@dataclass
class Model:
    classes: list[str]  # none, unknown, then the families
    features: dict[str, int]
    weights: np.ndarray  # a row a feature, a column a class
    intercept: np.ndarray
    temperature: float
    finder: re.Pattern[str]
    across: re.Pattern[str]  # the same, also over line breaks
    templates: list[tuple[int, frozenset[tuple[str, str]]]]  # class, word pairs

    def probabilities(self, text: str) -> np.ndarray:
        hits = [self.features[g] for g in grams(text) if g in self.features]
        z = (self.intercept + self.weights[hits].sum(0)) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def judge(self, text: str) -> tuple[str, float, float, bool] | None:
        """Family, its probability, the share of its best template found, and whether that confirms
        it; None for ordinary text."""
        p = self.probabilities(text)
        if p.argmax() == 0:
            return None
        best = 1 + int(p[1:].argmax())
        w = words(text)
        pairs = set(zip(w, w[1:]))
        share = max((len(t & pairs) / len(t) for c, t in self.templates if c == best), default=0.0)
        if best == 1 or p[best] < CONFIDENT:
            return UNKNOWN, round(float(p[best]), 4), round(share, 4), False
        return self.classes[best], round(float(p[best]), 4), round(share, 4), share >= CONFIRMED

    def paragraphs(self, text: str) -> Iterator[tuple[int, str]]:
        """Number and text of the lines that have a feature (others score as ordinary text)."""
        yield from self._paragraphs(text, _lowered(text))

    def _paragraphs(self, text: str, lowered: str) -> Iterator[tuple[int, str]]:
        number, at, done = 0, 0, -1
        for m in self.finder.finditer(lowered):
            if m.start() < done:
                continue
            start = text.rfind("\n", 0, m.start()) + 1
            done = text.find("\n", m.end())
            done = len(text) if done < 0 else done
            number += sum(1 for x in text[at:start].split("\n") if x.strip())
            yield number, text[start:done]
            number, at = number + 1, done

    def findings(self, text: str) -> list[tuple[int, str, float, float, bool]]:
        """What the lines and the notices and paragraphs of several lines give, by line."""
        lowered = _lowered(text)
        found = [m.span() for m in self.across.finditer(lowered)]
        if not found:  # then no line has a feature of its own either
            return []
        alone = {n: j for n, p in self._paragraphs(text, lowered) if (j := self.judge(p))}
        if "\n" not in text.strip("\n"):
            return [(n, *j) for n, j in alone.items()]
        lines = text.split("\n")
        ends = np.cumsum([len(x) + 1 for x in lines])
        hits = np.searchsorted(ends, [(a, b - 1) for a, b in found], "right").tolist()  # lines of first and last character
        out, settled = [], {n for n, j in alone.items() if j[3]}
        for first, last, judged in self._wrapped(lines, sorted({a for a, _ in hits})):
            inside = [n for n in range(first, last + 1) if n in alone]
            if not any(alone[n][3] and alone[n][0] == judged[0] for n in inside):
                out.append((first, *judged))
                alone = {n: j for n, j in alone.items() if n not in inside or j[3]}
            settled.update(range(first, last + 1))
        for first, last, judged in self._continued(lines, sorted({i for a, b in hits for i in range(a, b + 1)}), settled):
            out.append((first, *judged))
            alone = {n: j for n, j in alone.items() if not first <= n <= last}
        return sorted([*out, *((n, *j) for n, j in alone.items())], key=lambda f: f[0])

    def _continued(self, lines: list[str], hits: list[int], settled: set[int]) -> Iterator[tuple[int, int, tuple[str, float, float, bool]]]:
        """First and last line, and verdict, of the paragraphs of several lines that aren't ordinary text."""
        number, counted = 0, 0
        group: list[int] = []  # first and last line, first line's number
        for i in [*hits, len(lines) + GAP + 1]:
            joined = bool(group) and i - group[1] <= GAP + 1 and i < len(lines) and not any(_finished(lines[k]) or not lines[k + 1].strip() for k in range(group[1], i))
            if joined and not any(group[2] + k - group[0] in settled for k in range(group[1], i + 1)):
                group[1] = i
                continue
            if group and group[0] < group[1]:
                parts = [words(x) for x in lines[group[0] : group[1] + 1]]
                judged = self.judge(" ".join(x for w in parts for x in (w[1:] if w and w[0] in _COMMENT else w)))
                if judged:
                    yield group[2], group[2] + group[1] - group[0], judged
            if i < len(lines):
                number += sum(1 for x in lines[counted:i] if x.strip())
                counted = i
                group = [] if number in settled else [i, i, number]

    def _wrapped(self, lines: list[str], starts: list[int]) -> list[tuple[int, int, tuple[str, float, float, bool]]]:
        """First and last line of each confirmed notice that takes several lines, and its verdict."""
        reach = 3 + max(_span(pairs) for _, pairs in self.templates)
        parts: dict[int, list[str]] = {}

        def line_words(i: int) -> list[str]:
            if i not in parts:
                w = words(lines[i])
                parts[i] = w[1:] if w and w[0] in _COMMENT else w
            return parts[i]

        def end_of_join(i: int, step: int) -> int:
            n = 0
            while n < reach and 0 <= i + step < len(lines) and lines[i + step].strip():
                i += step
                n += len(line_words(i))
            return i

        areas: list[list[int]] = []
        for i in starts:
            a, b = end_of_join(i, -1), end_of_join(i + 1 if i + 1 < len(lines) and lines[i + 1].strip() else i, 1)
            if areas and a <= areas[-1][1]:
                areas[-1][1] = max(b, areas[-1][1])
            elif a < b:
                areas.append([a, b])
        out = []
        number, counted = 0, 0
        for a, b in areas:
            number += sum(1 for x in lines[counted:a] if x.strip())
            counted = a
            out += [(number + i, number + j, judged) for i, j, judged in self._joined([line_words(i) for i in range(a, b + 1)])]
        return out

    def _joined(self, lines: list[list[str]]) -> list[tuple[int, int, tuple[str, float, float, bool]]]:
        w = [x for line in lines for x in line]
        line = [i for i, x in enumerate(lines) for _ in x]
        by_pair: dict[tuple[str, str], list[int]] = {}
        for k, pair in enumerate(zip(w, w[1:])):
            by_pair.setdefault(pair, []).append(k)
        found = []
        for c, pairs in self.templates:
            if sum(x in by_pair for x in pairs) < CONFIRMED * len(pairs):
                continue
            places = sorted((k, x) for x in pairs for k in by_pair.get(x, ()))
            for a, b in _windows(places, len(pairs)):
                if line[a] < line[b]:
                    judged = self.judge(" ".join(w[a : b + 1]))
                    if judged and judged[3] and judged[0] == self.classes[c]:
                        found.append((line[a], line[b], judged))
        out: list[tuple[int, int, tuple[str, float, float, bool]]] = []
        for a, b, judged in sorted(found, key=lambda x: (-x[2][2], x[0], x[1])):
            if not any(judged[0] == j[0] and a <= d and e <= b for e, d, j in out):
                out.append((a, b, judged))
        return sorted(out, key=lambda x: x[:2])


def _finished(line: str) -> bool:
    """Whether a sentence ends with the line (whatever marks follow)."""
    for c in reversed(line):
        if c.isalnum():
            return False
        if c in ".!?":
            return True
    return False


def _lowered(text: str) -> str:
    """In lower case, each character in its place."""
    lowered = text.lower()
    return lowered if len(lowered) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _span(pairs: frozenset[tuple[str, str]]) -> int:
    """Words that a notice may take: twice its own, and ten."""
    return 2 * len(pairs) + 10


def _windows(places: list[tuple[int, tuple[str, str]]], size: int) -> Iterator[tuple[int, int]]:
    """First and last word of the stretches that hold enough of a template's pairs, where most are
    together; stretches don't overlap."""
    inside: Counter[tuple[str, str]] = Counter()
    left, best = 0, None
    for k, pair in places:
        inside[pair] += 1
        while k + 1 - places[left][0] >= 2 * size + 10 or inside[places[left][1]] > 1:
            inside[places[left][1]] -= 1
            left += 1
        held = sum(1 for n in inside.values() if n)
        if held >= CONFIRMED * size:
            if best and places[left][0] > best[2]:
                yield best[1], best[2]
                best = None
            if not best or held > best[0]:
                best = (held, places[left][0], k + 1)
    if best:
        yield best[1], best[2]


def fit(docs: DataFrame, sample: int = SAMPLE, seed: int = 0) -> Model:
    """Train on the templates and at most ``sample`` lines of ``docs``."""
    need(docs, "text")
    lines = docs.select(F.explode(F.split(text_or_empty(), "\n")).alias("line")).filter(F.length("line").between(1, 2000) & ~F.col("line").rlike(CUE))
    hashed = lines.select(F.xxhash64("line").alias("h"), "line")
    chosen = hashed.select("h").distinct().orderBy("h").limit(sample).collect()  # at most `sample` numbers
    if not chosen:
        return train([], seed)
    found = hashed.filter(F.col("h") <= chosen[-1].h).groupBy("h").agg(F.min("line").alias("line"))
    return train([r.line for r in sorted(found.collect(), key=lambda r: r.h)], seed)


def train(ordinary: list[str], seed: int = 0) -> Model:
    rng = np.random.default_rng(seed)
    classes = [NONE, UNKNOWN, *TEMPLATES]
    filler = sorted({w for line in ordinary[:200] for w in line.split()})[:2000]
    texts, labels = [], []
    invented = [f.format(" ".join("".join(rng.choice(list("abdegiklmnoprstu"), 5)) for _ in range(rng.integers(1, 4))), rng.integers(1, 10)) for f in FRAMES for _ in range(6)]
    for c, notices in [(1, (*OTHERS, *invented)), *((classes.index(k), v) for k, v in TEMPLATES.items())]:
        for notice in notices:
            some = _variations(notice, filler, rng, 30 if c > 1 else 4)
            texts += some
            labels += [c] * len(some)
    cues = [g for t in (*OTHERS, *(x for v in TEMPLATES.values() for x in v)) for g in grams(t)]
    common = Counter(g for line in ordinary for g in grams(line))
    names = sorted({g for g in cues if not common[g]})
    features = {g: i for i, g in enumerate(names)}
    texts += [""] * 20 + ["the software", "a public work", "version 2", "version 3.0", "copy of the work", "use of this", "in the file", "a general term", "free and open"] * 4
    labels += [0] * (len(texts) - len(labels))
    x = np.zeros((len(texts), len(features)), np.float32)
    for i, t in enumerate(texts):
        x[i, [features[g] for g in grams(t) if g in features]] = 1
    y = np.array(labels)
    held = rng.random(len(y)) < 0.2
    weights, intercept = _regress(x[~held], y[~held], len(classes))
    z, yh = x[held] @ weights + intercept, y[held]
    losses = {t: -np.mean(_log_softmax(z / t)[np.arange(len(yh)), yh]) for t in np.geomspace(0.2, 5, 40)}
    least = [g for g in names if _least(g, features)]
    # a match of `finder` stays in its line
    finder, across = (re.compile(rf"(?<![a-z0-9])(?:{_any_of(least, gap)})(?![a-z0-9])") for gap in (r"[^a-z0-9\n]+", "[^a-z0-9]+"))
    templates = [(classes.index(k), frozenset(zip(words(t), words(t)[1:]))) for k, v in TEMPLATES.items() for t in v]
    return Model(classes, features, weights, intercept, float(min(losses, key=losses.get)), finder, across, templates)


def _least(gram: str, features: dict[str, int]) -> bool:
    """Whether no shorter feature lies within the n-gram; lines are found by these alone."""
    w = gram.split(" ")
    return not any(" ".join(w[i : i + n]) in features for n in range(1, len(w)) for i in range(len(w) - n + 1))


def _any_of(grams: list[str], gap: str) -> str:
    """A pattern of the n-grams, longer ones first, in which those with equal beginnings share them,
    so that a word is compared with few of them; ``gap`` stands for the blanks."""
    if not grams:
        return "(?!)"
    branches = []
    for first, some in groupby(sorted(grams), key=lambda g: g[:1]):
        if first:
            branches.append((gap if first == " " else re.escape(first)) + _rest([g[1:] for g in some], gap))
    return "|".join(branches)


def _rest(grams: list[str], gap: str) -> str:
    if len(grams) == 1:
        return re.escape(grams[0]).replace(r"\ ", gap)
    return f"(?:{_any_of([g for g in grams if g], gap)}){'?' if '' in grams else ''}"


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def _regress(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 150, rate: float = 0.5, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by accelerated gradient steps."""
    target = np.eye(classes, dtype=np.float32)[y]
    share = target.sum(0)
    target_weight = ((1 / np.maximum(share, 1))[y][:, None] * len(y) / classes).astype(np.float32)  # families count alike
    w, b = np.zeros((x.shape[1], classes), np.float32), np.zeros(classes, np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        error = (np.exp(_log_softmax(x @ w + b)) - target) * target_weight / len(y)
        vw, vb = 0.9 * vw - rate * (x.T @ error + ridge * w), 0.9 * vb - rate * error.sum(0)
        w, b = w + vw, b + vb
    return w, b


SCHEMA = "doc_id long, n_paragraphs long, findings array<struct<paragraph:long,family:string,probability:double,similarity:double,confirmed:boolean>>"


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_paragraphs and findings (by paragraph) of every row."""
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    python_on_executors(spark)
    shared = spark.sparkContext.broadcast(model)
    finding = pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            counts, found = [], []
            for t in batch.column(1):
                text = t.as_py()
                counts.append(sum(1 for x in text.split("\n") if x.strip()))
                found.append([dict(zip(("paragraph", "family", "probability", "similarity", "confirmed"), f, strict=True)) for f in own.findings(text)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.list_(finding))], names=["doc_id", "n_paragraphs", "findings"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, SCHEMA)
