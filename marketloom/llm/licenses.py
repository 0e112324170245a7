"""Licence statements in paragraphs, by a trained classifier that templates confirm.

A multinomial logistic regression over word one- and two-grams tells licence
families, an unknown licence and ordinary text apart. It learns from the
templates below, varied and put among words of ordinary paragraphs, and from a
bounded sample of paragraphs without licence words. Temperature and threshold
are set on examples held out. A family is reported only where enough of one of
its templates stands in the text; else the licence is unknown. Lines are judged
each by itself, and together with their neighbours up to a blank line.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import whole_row, with_results
from marketloom.llm.shipping import ship_code

# How the licences themselves, and notices that name them, commonly read.
TEMPLATES = {
    "agpl": [
        "licensed under the gnu affero general public license version 3",
        "you can redistribute it and/or modify it under the terms of the gnu affero general public license",
    ],
    "apache-2.0": [
        "licensed under the apache license version 2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ],
    "bsd": [
        "released under the bsd license",
        "redistribution and use in source and binary forms with or without modification are permitted provided that",
        "use of this source code is governed by a bsd-style license",
    ],
    "cc-by": [
        "licensed under cc by 4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
    ],
    "cc-by-nc": [
        "licensed under cc by-nc 4.0",
        "this work is licensed under a creative commons attribution-noncommercial 4.0 international license",
    ],
    "cc-by-sa": [
        "licensed under cc by-sa 4.0",
        "this work is licensed under a creative commons attribution-sharealike 4.0 international license",
    ],
    "cc0": [
        "released under cc0 1.0 universal",
        "dedicated to the public domain under the creative commons cc0 public domain dedication",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 2",
        "you can redistribute it and/or modify it under the terms of the gnu general public license",
    ],
    "isc": [
        "released under the isc license",
        "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "lgpl": [
        "licensed under the gnu lesser general public license version 3",
        "under the terms of the gnu lesser general public license",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
    ],
    "mpl-2.0": [
        "subject to the terms of the mozilla public license version 2.0",
        "licensed under the mozilla public license version 2.0",
    ],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}
# Licence statements of no listed family, and words that mark either.
UNLISTED = [
    "licensed under the terms of a commercial license agreement",
    "all rights reserved no part of this work may be reproduced without permission of the publisher",
    "use of this document is subject to the license terms of the vendor",
    "released under a custom license see the license file for details",
    "copyright by the authors licensed for personal use only",
    "this text is distributed under its own public license",
]
LICENCE_WORDS = r"(?i)licen[cs]e|copyright|permission|redistribut|copyleft|all rights reserved|public domain|creative commons"
SUBJECTS = ["this work is", "this software is", "this file is", "the text is", "the data are", "this project is", ""]

UNKNOWN, TEXT = "unknown", "text"
WINDOW, STRIDE = 80, 56
TOKEN = re.compile(r"[^\W_]+(?:[.+/-][^\W_]+)*")


@dataclass(frozen=True)
class Classifier:
    """Weights of each word gram for each class, and how sure a prediction must be."""

    classes: list[str]
    grams: dict[str | tuple[str, str], int]
    weight: np.ndarray
    intercept: np.ndarray
    threshold: float
    templates: dict[str, list[frozenset]]
    confirm: float

    def logits(self, parts: list[set]) -> np.ndarray:
        """A row of class logits for each set of grams."""
        known = [[self.grams[g] for g in part if g in self.grams] for part in parts]
        ends = np.cumsum([len(k) for k in known])
        summed = np.vstack([np.zeros(len(self.classes)), self.weight[[i for k in known for i in k]].cumsum(0)])
        return self.intercept + summed[ends] - summed[np.append(0, ends[:-1])]

    def judge(self, tokens: list[list[str]]) -> list[tuple[int, str, float, float]]:
        """Those parts that hold a licence statement: place, family or unknown, probability, template's share found."""
        parts = [grams_of(part) for part in tokens]
        logits = self.logits(parts)
        chances = np.exp(logits - logits.max(1, keepdims=True))
        chances /= chances.sum(1, keepdims=True)
        return [(int(at), *self._named(parts[at], chances[at])) for at in np.flatnonzero(chances[:, -1] < 0.5)]

    def statements(self, tokens: list[str], family: str, chance: float, share: float) -> list[tuple[int, int, str, float, float]]:
        """Every family confirmed in a part that holds a statement and was judged so: first and last token, then the verdict.

        Besides the part's own verdict, the place of each template that is there
        is judged by itself, so that several families do not hide each other. One
        stretch is one statement: the part's verdict has it, or the nearest template.
        """
        found = grams_of(tokens)
        best = {f: max(ts, key=lambda t: len(t & found) / len(t)) for f, ts in self.templates.items()}
        spans = {f: _span(tokens, t) for f, t in best.items() if len(t & found) / len(t) >= self.confirm}
        own = [(*spans[family], family, chance, share)] if family in spans else []
        others = [f for f in spans if f != family]
        alone = self.judge([tokens[spans[f][0] : spans[f][1] + 1] for f in others]) if others else []
        for at, *verdict in sorted(alone, key=lambda v: (-v[3], -v[2])):
            first, last = spans[others[at]]
            shared = [min(last, b) - max(first, a) + 1 for a, b, *_ in own]
            if verdict[0] == others[at] and not any(2 * n > last - first for n in shared):
                own.append((first, last, *verdict))
        return own

    def most_licence(self, parts: list[list[str]]) -> int:
        """The part that is least like ordinary text."""
        logits = self.logits([grams_of(part) for part in parts])
        return int((logits[:, :-1].max(1) - logits[:, -1]).argmax())

    def _named(self, found: set, chances: np.ndarray) -> tuple[str, float, float]:
        best = int(chances[:-1].argmax())
        family, chance = self.classes[best], float(chances[best])
        shares = {f: max(len(t & found) / len(t) for t in ts) for f, ts in self.templates.items()}
        share = shares.get(family, 0.0)
        if family == UNKNOWN or chance < self.threshold or share < self.confirm:
            return UNKNOWN, float(1 - chances[-1]), max(shares.values())
        return family, chance, share


def tokens_of(paragraph: str) -> list[str]:
    return TOKEN.findall(paragraph.lower())


def grams_of(tokens: list[str]) -> set[str | tuple[str, str]]:
    return {*tokens, *zip(tokens, tokens[1:], strict=False)}


def _span(tokens: list[str], template: frozenset) -> tuple[int, int]:
    """First and last token of the stretch that holds most word pairs of the template."""
    marks = [pair in template for pair in zip(tokens, tokens[1:], strict=False)]
    if not any(marks):
        return 0, len(tokens) - 1
    width = sum(isinstance(gram, tuple) for gram in template)
    width += max(2, width // 4)
    sums = [0, *accumulate(marks)]
    start = max(range(len(marks)), key=lambda i: (sums[min(i + width, len(marks))] - sums[i], -i))
    held = [i for i in range(start, min(start + width, len(marks))) if marks[i]]
    return held[0], held[-1] + 1


def windows(tokens: list[str]) -> Iterator[list[str]]:
    """A long paragraph in overlapping parts, so that a statement within it counts like one alone."""
    yield tokens[:WINDOW]
    for start in range(STRIDE, len(tokens) - WINDOW + STRIDE, STRIDE):
        yield tokens[start : start + WINDOW]


def license_paragraphs(
    df: DataFrame, classifier: Classifier, text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """Every row of ``df`` with ``n_paragraphs`` and ``licenses``.

    Paragraphs are the lines with a word, numbered from 0. ``licenses`` has a
    struct ``(paragraph, family, probability, similarity)`` for each family that a
    paragraph holds a statement of, or ``unknown`` if it holds one of none. A
    statement that goes over several lines, with no blank one between, is given at
    the first of them. NULL and blank texts have none. ``carry`` names
    the input columns to return (all by default); a result replaces an input
    column of its name. Repeated rows are judged alike; an empty table gives no rows.
    """
    names = df.columns if carry is None else carry
    ship_code(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(classifier)  # bounded by templates and sample
    found = "array<struct<paragraph:int,family:string,probability:double,similarity:double>>"
    rows = df.select(whole_row(df, names).alias("row"), F.col(text).alias("text"))
    schema = rows.select("row", F.lit(0).alias("n"), F.array().cast(found).alias("found")).schema
    kind = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [_document(value.as_py() or "", model.value) for value in batch.column("text")]
            arrays = [batch.column("row"), pa.array([n for n, _ in judged], pa.int32()), pa.array([f for _, f in judged], kind)]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    results = {"n_paragraphs": F.col("n"), "licenses": F.col("found")}
    return with_results(rows.mapInArrow(judge, schema), names, results)


def _document(text: str, model: Classifier) -> tuple[int, list[dict]]:
    lines: list[list[str]] = []
    blocks: list[list[int]] = [[]]
    for line in text.split("\n"):
        if line.strip():
            blocks[-1].append(len(lines))
            lines.append(tokens_of(line))
        elif blocks[-1]:
            blocks.append([])
    parts = [(at, part) for at, tokens in enumerate(lines) for part in windows(tokens)]
    if not parts:
        return 0, []
    seen: dict[int, dict[str, tuple]] = {}
    for place, *verdict in model.judge([part for _, part in parts]):
        at, part = parts[place]
        stated = [found[2:] for found in model.statements(part, *verdict)]
        _add(seen, at, stated or [tuple(verdict)])
    for block in blocks:
        if len(block) > 1:
            _over_lines(seen, block, lines, model)
    return len(lines), [
        {"paragraph": at, "family": family, "probability": chance, "similarity": share}
        for at, verdicts in sorted(seen.items())
        for family, chance, share in verdicts.values()
    ]


def _add(seen: dict[int, dict[str, tuple]], at: int, verdicts: list[tuple]) -> None:
    """Each family once a paragraph, and unknown only where there is no family."""
    known = seen.setdefault(at, {})
    for verdict in verdicts:
        known.setdefault(verdict[0], verdict)
    if len(known) > 1:
        known.pop(UNKNOWN, None)


def _over_lines(seen: dict[int, dict[str, tuple]], block: list[int], lines: list[list[str]], model: Classifier) -> None:
    """Add the statements that stand on several lines of the block."""
    starts = list(accumulate((len(lines[at]) for at in block), initial=0))[:-1]
    parts = list(windows([token for at in block for token in lines[at]]))
    unnamed = []
    for place, *verdict in model.judge(parts):
        line = [bisect_right(starts, place * STRIDE + i) - 1 for i in range(len(parts[place]))]
        for first, last, *found in model.statements(parts[place], *verdict):
            covered = block[line[first] : line[last] + 1]
            if len(covered) > 1 and not any(found[0] in seen.get(at, {}) for at in covered):
                for at in covered:
                    if UNKNOWN in seen.get(at, {}):  # a fragment of this statement
                        del seen[at]
                _add(seen, covered[0], [tuple(found)])
        if verdict[0] == UNKNOWN:
            unnamed.append((block[line[0] : line[-1] + 1], verdict))
    for covered, verdict in unnamed:
        if not any(seen.get(at) for at in covered):
            at = covered[model.most_licence([lines[at] for at in covered])]
            _add(seen, at, [tuple(verdict)])


def sample_paragraphs(df: DataFrame, text: str = "text", size: int = 1500, chars: int = 600) -> list[str]:
    """Different paragraphs without licence words, ``size`` at most, by the order of their hashes.

    What they teach is how ordinary text begins, so ``chars`` characters of each are
    enough. Their number is estimated first, and only hashes in the share of all
    hashes that holds twice ``size`` of them are sorted.
    """
    lines = df.select(F.explode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("line"))
    plain = lines.where(F.col("line").rlike(r"\w") & ~F.col("line").rlike(LICENCE_WORDS))
    hashed = plain.select(F.xxhash64("line").alias("hash"), F.substring("line", 1, chars).alias("line"))
    different = hashed.agg(F.approx_count_distinct("hash").alias("n")).first()["n"]
    if different > 2 * size:
        hashed = hashed.where(F.col("hash") < int(-(1 << 63) + 2 * size / different * (1 << 64)))
    once = hashed.groupBy("hash").agg(F.min("line").alias("line"))
    return [row["line"] for row in once.orderBy("hash").limit(size).collect()]


def train(ordinary: list[str], variants: int = 40, seed: int = 7, confirm: float = 0.6, precision: float = 0.98) -> Classifier:
    """Fit on varied templates and ordinary paragraphs; four fifths train, the rest calibrates."""
    rng = random.Random(seed)
    classes = [*TEMPLATES, UNKNOWN, TEXT]
    sources = {**TEMPLATES, UNKNOWN: UNLISTED}
    plain = [tokens_of(p)[:WINDOW] for p in ordinary]
    words = [t for tokens in plain for t in tokens] or ["text"]
    rows = [(_varied(rng, t, words), classes.index(name)) for name, texts in sources.items() for t in texts for _ in range(variants)]
    rows += [(tokens, len(classes) - 1) for tokens in plain]
    rows += [([], len(classes) - 1)]
    rng.shuffle(rows)
    cut = len(rows) * 4 // 5
    counts = Counter(g for tokens, _ in rows[:cut] for g in grams_of(tokens))
    kept = {g: i for i, g in enumerate(sorted((g for g, n in counts.items() if n >= 3), key=str))}
    weight, intercept = _fit(rows[:cut], kept, len(classes))
    held = [(_logits(tokens, kept, weight, intercept), y) for tokens, y in rows[cut:]]
    heat = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=lambda t: sum(_loss(z / t, y) for z, y in held))
    chances = sorted(((p := _softmax(z / heat))[:-2].max(), p[:-2].argmax() == y) for z, y in held if _softmax(z)[-1] < 0.5)
    threshold = next((c for i, (c, _) in enumerate(chances) if np.mean([ok for _, ok in chances[i:]]) >= precision), 0.9)
    return Classifier(
        classes,
        kept,
        weight / heat,
        intercept / heat,
        min(max(float(threshold), 0.5), 0.95),
        {name: [frozenset(grams_of(tokens_of(t))) for t in texts] for name, texts in TEMPLATES.items()},
        confirm,
    )


def _varied(rng: random.Random, template: str, words: list[str]) -> list[str]:
    tokens = [t for t in tokens_of(template) if rng.random() > 0.05]
    if len(tokens) > 12 and rng.random() < 0.3:
        tokens = tokens[: rng.randint(10, len(tokens))]
    around = [[rng.choice(words) for _ in range(rng.choice((0, 0, 3, 12)))] for _ in range(2)]
    return [*around[0], *tokens_of(rng.choice(SUBJECTS)), *tokens, *around[1]]


def _fit(rows: list, kept: dict[str, int], classes: int, steps: int = 150, rate: float = 0.5, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression on sparse binary grams, by adaptive gradient steps over the whole sample."""
    pairs = [(r, kept[g]) for r, (tokens, _) in enumerate(rows) for g in grams_of(tokens) if g in kept]
    row, col = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
    truth = np.zeros((len(rows), classes))
    truth[np.arange(len(rows)), [y for _, y in rows]] = 1
    balance = 1 / np.maximum(truth.sum(0), 1)
    importance = (truth @ balance)[:, None] / classes
    order = np.argsort(col, kind="stable")
    weight, square = np.zeros((len(kept) + 1, classes)), np.full((len(kept) + 1, classes), 1e-8)
    starts = np.searchsorted(row, np.arange(len(rows)))
    by_col, col_starts = row[order], np.searchsorted(col[order], np.arange(len(kept)))
    for _ in range(steps):
        logits = weight[-1] + _sums(weight[col], starts, len(rows))
        logits -= logits.max(1, keepdims=True)
        chance = np.exp(logits)
        chance /= chance.sum(1, keepdims=True)
        miss = (chance - truth) * importance
        slope = np.vstack([_sums(miss[by_col], col_starts, len(kept)), miss.sum(0)]) + ridge * weight
        square += slope**2
        weight -= rate * slope / np.sqrt(square)
    return weight[:-1], weight[-1]


def _sums(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Sums of consecutive groups that begin at ``starts``; an empty group gives 0."""
    total = np.vstack([np.zeros(values.shape[1:])[None], np.cumsum(values, 0)])
    ends = np.append(starts[1:], len(values))
    return total[ends] - total[starts[:n]]


def _logits(tokens: list[str], kept: dict[str, int], weight: np.ndarray, intercept: np.ndarray) -> np.ndarray:
    at = [kept[g] for g in grams_of(tokens) if g in kept]
    return intercept + weight[at].sum(0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def _loss(z: np.ndarray, y: int) -> float:
    return -float(np.log(_softmax(z)[y] + 1e-12))
