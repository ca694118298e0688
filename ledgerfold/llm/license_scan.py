"""Licence scans: a classifier of paragraphs, confirmed by templates.

A paragraph is what stands between two line ends, or the neighbouring lines of a block without a blank line over which
a statement is wrapped: where a template is found over a line end, its words are a paragraph of their own, which is
given if it is confirmed, in place of the unconfirmed lines it covers. A paragraph's word unigrams and bigrams are looked up in a sparse multinomial
logistic regression over licence families and `unknown`. The model is fitted on variants of the templates
below and on a bounded sample of the corpus's own paragraphs as `unknown` (SAMPLE texts, those of smallest hash).
Probabilities are calibrated by a temperature that is fitted on examples kept apart. A family with a
probability of at least SURE is a prediction; it is confirmed if a template of the family has COVERED of its words, in
order and number, in the paragraph, within a stretch of 3 n - 6 words for a template of n: long ones are written with
clauses in between, those of three words are not.

N-grams that are frequent in the sample carry no weight. A paragraph without any n-gram of the
model has the bias alone, which fitting makes `unknown`, so only paragraphs with one are scored; whole texts are read.

Defined results: a null or empty text has no paragraphs with a licence and gives no rows; repeated rows are answered each; a null
identifier stays null; between equal probabilities the family first in order wins; no rows give no rows; columns but identifier
and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
SAMPLE = 500
PARAGRAPHS = 4000  # of the sample, at most
SURE = 0.5
COVERED = 0.8
FREQUENT = 0.01
ROUNDS = 300
STEP = 2.0
DECAY = 1e-4

# How licences are named in texts, by family.
TEMPLATES = {
    "apache": (
        "licensed under the apache license version 2.0",
        "this file is licensed to you under the apache license version 2.0",
        "you may not use this file except in compliance with the license",
        "spdx-license-identifier apache-2.0",
    ),
    "bsd": (
        "released under the bsd 3-clause license",
        "use of this source code is governed by a bsd-style license",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "spdx-license-identifier bsd-3-clause",
    ),
    "cc-by": (
        "licensed under cc by 4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
        "spdx-license-identifier cc-by-4.0",
    ),
    "cc-by-nc": (
        "licensed under cc by-nc 4.0",
        "this work is licensed under a creative commons attribution-noncommercial 4.0 international license",
        "spdx-license-identifier cc-by-nc-4.0",
    ),
    "cc-by-sa": (
        "licensed under cc by-sa 4.0",
        "this work is licensed under a creative commons attribution-sharealike 4.0 international license",
        "spdx-license-identifier cc-by-sa-4.0",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it under the terms of the gnu general public license",
        "spdx-license-identifier gpl-3.0-or-later",
    ),
    "lgpl": (
        "this library is licensed under the gnu lesser general public license version 3",
        "this library is free software you can redistribute it under the terms of the gnu lesser general public license",
        "spdx-license-identifier lgpl-3.0-or-later",
    ),
    "mit": (
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "spdx-license-identifier mit",
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license version 2.0",
        "spdx-license-identifier mpl-2.0",
    ),
    "reserved": ("all rights reserved", "copyright all rights reserved no part may be reproduced without permission"),
}
# Words that stand around such names without deciding the family.
FRAMES = ("", "this document is", "the contents of this page are", "copyright the authors", "see the file for details")
VERSIONS = ("1.0", "2.0", "2.1", "3.0", "4.0", "2", "3")

# Letters, digits and the marks inside names stay; line ends end paragraphs; the rest separates words.
_KEPT = bytes(
    c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() and c < 128 or c > 127 or c in b"\n.-" else 32 for c in range(256)
)


def words_of(paragraph: bytes) -> list[str]:
    """Of a paragraph that has been through _KEPT."""
    return [w for w in (word.strip(b".-").decode("utf-8", "replace") for word in paragraph.split()) if w]


def grams_of(words: list[str]) -> set[str]:
    return {*words, *map(" ".join, zip(words, words[1:]))}


def _variants(template: str) -> list[list[str]]:
    """A template as it may be written: framed, with another version, or with a word left out."""
    words = template.split()
    made = [[*frame.split(), *words] for frame in FRAMES] + [[*words, *frame.split()] for frame in FRAMES[1:]]
    made += [[v if re.fullmatch(r"\d+(\.\d+)?", w) else w for w in words] for v in VERSIONS]
    if len(words) > 5:
        made += [words[:i] + words[i + 1 :] for i in range(len(words))]
    return made


class Template:
    def __init__(self, text: str) -> None:
        words = text.split()
        self.size, self.full = len(words), (1 << len(words)) - 1
        self.span = max(self.size, 3 * self.size - 6)
        self.masks: dict[str, int] = {}
        for at, word in enumerate(words):
            self.masks[word] = self.masks.get(word, 0) | 1 << at

    def stretches(self, at: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
        """(words in order, first position, end) for the stretch from each of the positions (position, mask)."""
        for k, (first, _) in enumerate(at):
            # The longest common subsequence, a bit of `rest` for each word of the template that isn't in it.
            rest, most, end = self.full, 0, first
            for j in range(k, len(at)):
                position, mask = at[j]
                if position - first >= self.span:
                    break
                both = rest & mask
                rest = ((rest + both) | (rest - both)) & self.full
                if self.size - rest.bit_count() > most:
                    most, end = self.size - rest.bit_count(), position + 1
            yield most, first, end

    def best(self, words: list[str]) -> tuple[float, int, int]:
        """(share of the words, first position, end) of the best and then the shortest stretch."""
        at = [(i, self.masks[w]) for i, w in enumerate(words) if w in self.masks]
        most, first, end = max(self.stretches(at), key=lambda x: (x[0], x[1] - x[2]), default=(0, 0, 0))
        return most / self.size, first, end

    def matches(self, at: list[tuple[int, int]]) -> Iterator[tuple[float, int, int]]:
        """Stretches with COVERED of the words that don't overlap, each the best of those that begin within it."""
        found: tuple[int, int, int] | None = None
        for most, first, end in self.stretches(at):
            if found and first >= found[2]:
                yield found[0] / self.size, found[1], found[2]
                found = None
            if most >= COVERED * self.size and (not found or (most, first - end) > (found[0], found[1] - found[2])):
                found = most, first, end
        if found:
            yield found[0] / self.size, found[1], found[2]


KNOWN = {family: [Template(text) for text in texts] for family, texts in TEMPLATES.items()}
_ALL = [template for known in KNOWN.values() for template in known]
_HOLDING: dict[str, list[tuple[int, int]]] = {}
for _number, _template in enumerate(_ALL):
    for _word, _mask in _template.masks.items():
        _HOLDING.setdefault(_word, []).append((_number, _mask))
REACH = max(template.span for template in _ALL)


def wrapped(words: list[str], line_of: list[int]) -> list[tuple[float, int, int]]:
    """(share, first position, end) where a template is found over a line end; the best first."""
    at: dict[int, list[tuple[int, int]]] = {}
    for i, word in enumerate(words):
        for number, mask in _HOLDING.get(word, ()):
            at.setdefault(number, []).append((i, mask))
    found = []
    for number, positions in at.items():
        if len(positions) >= COVERED * _ALL[number].size:
            found += [m for m in _ALL[number].matches(positions) if line_of[m[1]] != line_of[m[2] - 1]]
    return sorted(found, key=lambda m: (-m[0], m[1] - m[2], m[1]))


class Classifier:
    def __init__(self) -> None:
        self.families = [*TEMPLATES, UNKNOWN]
        self.column: dict[str, int] = {}
        self.single: set[bytes] = set()
        self.pairs: set[tuple[bytes, ...]] = set()
        self.weights = np.zeros((0, len(self.families)))
        self.bias = np.zeros(len(self.families))
        self.temperature = 1.0

    def logits(self, words: list[str]) -> np.ndarray:
        at = sorted(self.column[g] for g in grams_of(words) if g in self.column)
        return self.bias + self.weights[at].sum(axis=0) / np.sqrt(max(1, len(at)))

    def probabilities(self, words: list[str]) -> np.ndarray:
        return _softmax(self.logits(words)[None, :] / self.temperature)[0]

    def predict(self, words: list[str]) -> tuple[str, float, float, int, int] | None:
        """(family, probability, share of the best template's words, where they begin and end), or None if unknown."""
        p = self.probabilities(words)
        best = int(np.argmax(p))
        if self.families[best] == UNKNOWN or p[best] < SURE:
            return None
        covered = max((t.best(words) for t in KNOWN[self.families[best]]), key=lambda x: (x[0], x[1] - x[2]))
        return self.families[best], float(p[best]), *covered

    def scan(self, text: bytes) -> list[tuple[int, str, float, float]]:
        """(number of the first line, family, probability, covered) of a text that has been through _KEPT."""
        rows: list[tuple[int, str, float, float]] = []
        block: list[list[bytes]] = []
        for number, line in enumerate([*text.split(b"\n"), b""]):
            words = [w for w in (word.strip(b".-") for word in line.split()) if w]
            if words:
                block.append(words)
            elif block:
                rows += [(number - len(block) + row[0], *row[1:]) for row in self._scan_block(block)]
                block = []
        return rows

    def _scan_block(self, block: list[list[bytes]]) -> list[tuple[int, str, float, float]]:
        # A bigram of the model has its words next to each other; single words find most, pairs the rest.
        hits = [not self.single.isdisjoint(w) or not self.pairs.isdisjoint(zip(w, w[1:])) for w in block]
        over = [(a[-1], b[0]) in self.pairs for a, b in zip(block, block[1:])]
        core = [hit or after or before for hit, after, before in zip(hits, [*over, False], [False, *over])]
        if not any(core):
            return []
        near = core[:]
        # Only what a template can reach from there is looked at.
        for way in (range(len(block)), range(len(block) - 1, -1, -1)):
            left = 0
            for i in way:
                near[i] |= left > 0
                left = REACH if core[i] else left - len(block[i])
        rows: dict[int, tuple[str, float, float]] = {}
        joined: list[tuple[int, str, float, float]] = []
        at = 0
        while at < len(block):
            words: list[str] = []
            line_of: list[int] = []
            taken: list[tuple[int, int]] = []
            while at < len(block) and near[at]:
                line = [w.decode("utf-8", "replace") for w in block[at]]
                if hits[at] and (found := self.predict(line)):
                    rows[at] = found[:3]
                    if found[2] >= COVERED:
                        taken.append((len(words) + found[3], len(words) + found[4]))
                words += line
                line_of += [at] * len(line)
                at += 1
            at += 1
            candidates = wrapped(words, line_of)
            for _, first, end in candidates:
                # What overlaps it tells families apart whose templates are alike.
                alike = [c for c in candidates if c[1] < end and first < c[2]]
                for low, high in ((min(c[1] for c in alike), max(c[2] for c in alike)), (first, end)):
                    found = self.predict(words[low:high])
                    if not found or found[2] < COVERED:
                        continue
                    low, high = low + found[3], low + found[4]
                    if line_of[low] == line_of[high - 1] or any(low < t[1] and t[0] < high for t in taken):
                        continue
                    taken.append((low, high))
                    joined.append((line_of[low], *found[:3]))
                    for i in range(line_of[low], line_of[high - 1] + 1):
                        if i in rows and rows[i][2] < COVERED:
                            del rows[i]
                    break
        return sorted([*((i, *row) for i, row in rows.items()), *joined])


def _softmax(rows: np.ndarray) -> np.ndarray:
    shifted = np.exp(rows - rows.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def fit(unknown: list[list[str]]) -> Classifier:
    """From the templates' variants and paragraphs of the corpus; those that hold a template are not unknown."""
    model = Classifier()
    known = [(f, v) for f, templates in TEMPLATES.items() for t in templates for v in _variants(t)]
    unknown = [w for w in unknown if not any(t.best(w)[0] >= COVERED for t in _ALL)]
    seen = Counter(g for words in unknown for g in grams_of(words))
    often = max(1.0, FREQUENT * len(unknown))
    vocabulary = sorted({g for _, words in known for g in grams_of(words) if seen[g] <= often})
    model.column = {g: i for i, g in enumerate(vocabulary)}
    model.single = {g.encode() for g in vocabulary if " " not in g}
    model.pairs = {tuple(g.encode().split()) for g in vocabulary if " " in g}
    examples = known + [(UNKNOWN, words) for words in unknown] + [(UNKNOWN, [])]
    x = np.zeros((len(examples), len(vocabulary)))
    for row, (_, words) in enumerate(examples):
        at = [model.column[g] for g in grams_of(words) if g in model.column]
        x[row, at] = 1 / np.sqrt(max(1, len(at)))
    y = np.array([model.families.index(f) for f, _ in examples])
    # Families weigh alike, whatever their number of examples.
    weight = 1 / np.bincount(y, minlength=len(model.families))[y]
    weight /= weight.sum()
    apart = np.arange(len(y)) % 5 == 4
    target = np.eye(len(model.families))[y]
    model.weights = np.zeros((len(vocabulary), len(model.families)))
    fitted = weight * ~apart
    for _ in range(ROUNDS):
        slope = (_softmax(x @ model.weights + model.bias) - target) * fitted[:, None]
        model.weights -= STEP * len(model.families) * (x.T @ slope + DECAY * model.weights)
        model.bias -= STEP * slope.sum(axis=0)
    logits = x[apart] @ model.weights + model.bias

    def loss(temperature: float) -> float:
        p = _softmax(logits / temperature)[np.arange(apart.sum()), y[apart]]
        return float(-(weight[apart] * np.log(np.maximum(p, 1e-12))).sum())

    model.temperature = min(np.geomspace(0.05, 4, 40), key=loss)
    return model


def unknown_lines(text: bytes) -> set[str]:
    """The lines of a text that has been through _KEPT, but those a statement is wrapped over."""
    found: set[str] = set()
    for block in re.split(rb"\n[\x20.-]*\n", text):
        lines = [words_of(line) for line in block.split(b"\n")]
        line_of = [i for i, line in enumerate(lines) for _ in line]
        statements = wrapped([w for line in lines for w in line], line_of)
        gone = {i for _, first, end in statements for i in range(line_of[first], line_of[end - 1] + 1)}
        found.update(" ".join(line) for i, line in enumerate(lines) if i not in gone)
    return found


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = sorted({line for text in batch.column(0) for line in unknown_lines(text.as_py().encode().translate(_KEPT))})
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["words"])


def learn(docs: DataFrame, text_col: str = "text") -> Classifier:
    """Fits a bounded sample of the corpus's paragraphs as unknown."""
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))
    marks = texts.select(F.xxhash64("text").alias("mark")).orderBy("mark").limit(SAMPLE)
    last = marks.agg(F.max("mark")).first()[0]
    if last is None:
        return fit([])
    sample = texts.where(F.xxhash64("text") <= last).dropDuplicates(["text"]).mapInArrow(_paragraphs, "words string")
    lines = sample.where("words <> ''").distinct().orderBy(F.xxhash64("words"), "words").limit(PARAGRAPHS).collect()
    return fit([row.words.split() for row in lines])


def scan_licenses(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, paragraph, family, probability, covered, confirmed): a row for each paragraph with a prediction.

    paragraph is the number of its first line, from 0; covered is the share of the best template's words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = shared.value
        for batch in batches:
            rows: list[tuple[int, int, str, float, float]] = []
            for at, text in enumerate(batch.column(1)):
                rows += [(at, *row) for row in classifier.scan((text.as_py() or "").encode().translate(_KEPT))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.string()),
                    pa.array([r[3] for r in rows], pa.float64()),
                    pa.array([r[4] for r in rows], pa.float64()),
                    pa.array([r[4] >= COVERED for r in rows], pa.bool_()),
                ],
                names=["id", "paragraph", "family", "probability", "covered", "confirmed"],
            )

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return given.mapInArrow(
        scan, f"id {kind}, paragraph long, family string, probability double, covered double, confirmed boolean"
    )
