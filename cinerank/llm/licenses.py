"""Operator 3: licence statements by a trained paragraph classifier.

A paragraph (a line of a text, or neighbouring lines that a statement is
wrapped over) becomes sparse 1- and 2-grams of its words; an SPDX id counts as
its family, whatever its version.
Multinomial logistic regression tells the licence families and the class
`unknown` apart. It is trained here: families on variants of the templates
below (words dropped, prose added, versions changed), unknown on at most
SAMPLE distinct paragraphs of documents in the order of a hash of their text, short
ones of template words included. The probability that a prediction must reach
is calibrated on held-out variants and paragraphs, so that at most FALSE of
the unknown paragraphs pass. A prediction counts once a template of its
family confirms it: the paragraph must hold CONFIRM of the template's words
in order.

Lines without a blank one between them are joined from each line on, as far
as a stretch that confirms may reach; a joined statement counts where it holds
more of a template than its first line alone and than the lines after it.

Words that speak for no family can't make a prediction, so a paragraph
without any other is unknown at once, and so is one that holds too few words
of each template; that skips work, not cases.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import columns, distinct_sample, prepare, small

SAMPLE = 4000
VARIANTS = 60
FALSE = 0.001
CONFIRM = 0.6
UNKNOWN = "unknown"

# Usual statements of each licence family.
TEMPLATES = {
    "agpl": ["licensed under the gnu affero general public license version 3", "spdx-license-identifier agpl-3.0",
             "you can redistribute it and or modify it under the terms of the gnu affero general public license"],
    "apache": ["licensed under the apache license version 2.0", "spdx-license-identifier apache-2.0",
               "you may not use this file except in compliance with the license"],
    "bsd": ["licensed under the bsd 3-clause license", "redistribution and use in source and binary forms with or without modification are permitted",
            "spdx-license-identifier bsd-3-clause"],
    "cc-by": ["licensed under cc by 4.0", "spdx-license-identifier cc-by-4.0", "this work is licensed under a creative commons attribution 4.0 international license"],
    "cc-by-nc": ["licensed under cc by-nc 4.0", "spdx-license-identifier cc-by-nc-4.0", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"],
    "cc-by-sa": ["licensed under cc by-sa 4.0", "spdx-license-identifier cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4.0 international license"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related rights", "released under cc0 1.0 universal public domain dedication",
            "spdx-license-identifier cc0-1.0"],
    "gpl": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu gpl v2 or later",
            "you can redistribute it and or modify it under the terms of the gnu general public license", "spdx-license-identifier gpl-3.0-or-later"],
    "lgpl": ["licensed under the gnu lesser general public license version 2.1", "spdx-license-identifier lgpl-2.1",
             "you can redistribute it and or modify it under the terms of the gnu lesser general public license"],
    "mit": ["released under the mit license", "licensed under the mit license", "spdx-license-identifier mit",
            "permission is hereby granted free of charge to any person obtaining a copy of this software"],
    "mpl": ["subject to the terms of the mozilla public license version 2.0", "spdx-license-identifier mpl-2.0"],
    "proprietary": ["all rights reserved", "this content is proprietary and confidential and may not be copied without permission"],
}
_WORD = re.compile(r"[^\W_]+(?:[-.][^\W_]+)*")
_ID = re.compile(r"(agpl|apache|bsd|cc-by-nc|cc-by-sa|cc-by|cc0|gpl|lgpl|mpl)(?:(?<=-nc)-(?:sa|nd))?-[0-9][^ ]*")
_OTHER_IDS = {"0bsd": "bsd-id", "mit-0": "mit"}


def words(paragraph: str) -> list[str]:
    found = _WORD.findall(paragraph.lower())
    return [m[1] + "-id" if (m := _ID.fullmatch(w)) else _OTHER_IDS.get(w, w) for w in found]


def _grams(w: list[str]) -> set:
    return {*w, *zip(w, w[1:], strict=False)}


class Classifier:
    def __init__(self, negatives: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.classes = [*sorted(TEMPLATES), UNKNOWN]
        filler = [w for p in negatives[:500] for w in words(p)] or ["text"]
        known = sorted({g for t in TEMPLATES.values() for s in t for g in _grams(words(s))}, key=str)
        self.at = {g: i for i, g in enumerate(known)}
        rows, y = [], []
        for c, name in enumerate(self.classes[:-1]):
            for t in TEMPLATES[name]:
                w = words(t)
                for k in range(VARIANTS):
                    v = [x for x in w if k % 3 == 0 or rng.random() > 0.1]
                    v = [re.sub(r"\d", lambda _: str(rng.integers(1, 5)), x) if rng.random() < 0.3 and name not in ("cc0",) else x for x in v]
                    add = [filler[i] for i in rng.integers(0, len(filler), 2 * int(rng.integers(0, 8)))]
                    rows.append(self._known(add[::2] + v + add[1::2]))
                    y.append(c)
        own = sorted({x for ts in TEMPLATES.values() for t in ts for x in words(t)})
        last = len(self.classes) - 1
        for p in negatives:
            rows.append(self._known(words(p)))
            y.append(last)
        for _ in range(1500):  # template words out of their order
            mixed = [own[i] if rng.random() < 0.5 else filler[int(rng.integers(len(filler)))] for i in rng.integers(0, len(own), int(rng.integers(1, 12)))]
            rows.append(self._known(mixed))
            y.append(last)
        y = np.array(y)
        held = rng.random(len(y)) < 0.25
        x = np.zeros((len(rows), len(known)), dtype=np.float32)
        for r, at in enumerate(rows):
            x[r, at] = 1
        self._train(x[~held], y[~held])
        p = self._probabilities(x[held])
        false = np.sort(p[y[held] == last][:, :-1].max(1))[::-1]
        self.least = float(max(0.5, false[min(len(false) - 1, int(FALSE * len(false)))] + 1e-6)) if len(false) else 0.5
        telling = (self.w[:, :-1] - self.w[:, -1:]).max(1) > 0
        self.telling = {v for g, i in self.at.items() if telling[i] for v in ((g,) if isinstance(g, str) else g)}
        self.templates = {f: [words(t) for t in ts] for f, ts in TEMPLATES.items()}
        every = [t for ts in self.templates.values() for t in ts]
        self.needed = [CONFIRM * len(t) - 1e-9 for t in every]
        self.reach = 4 * max(map(len, every))     # the longest stretch that confirms
        self.places: dict[str, list] = {}         # of a word: the templates that hold it, and how often
        for i, t in enumerate(every):
            for x in set(t):
                self.places.setdefault(x, []).append((i, t.count(x)))

    def _known(self, w: list[str]) -> list[int]:
        return [self.at[g] for g in _grams(w) if g in self.at]

    def _train(self, x: np.ndarray, y: np.ndarray) -> None:
        k = len(self.classes)
        self.w, self.b = np.zeros((x.shape[1], k)), np.zeros(k)
        self.b[-1] = 2.0
        want = np.eye(k)[y]
        m, v = np.zeros_like(self.w), np.zeros_like(self.w)
        for step in range(1, 201):  # Adam; the bias stays, so no known words mean unknown
            g = x.T @ (self._softmax(x @ self.w + self.b) - want) / len(y) + 1e-4 * self.w
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            self.w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def _probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._softmax(x @ self.w + self.b)

    def predict(self, paragraph: str | list[str]) -> tuple[str, float, float] | None:
        """Family, its probability and the best template's share; None if unknown."""
        w = words(paragraph) if isinstance(paragraph, str) else paragraph
        if self.telling.isdisjoint(w):
            return None
        at = self._known(w)
        p = self._softmax((self.w[at].sum(0) + self.b)[None])[0]
        c = int(p[:-1].argmax())
        if p[c] < self.least:
            return None
        family = self.classes[c]
        share = self._held(w, family)
        return (family, float(p[c]), share) if share >= CONFIRM else None

    def statements(self, text: str) -> Iterator[tuple[int, str, float, float]]:
        """The line where each statement begins, and its prediction."""
        lines = [words(x) for x in text.split("\n")]
        own = [self.places.keys() & w for w in lines]
        i = 0
        while i < len(lines):
            hit, end = self._statement(lines, own, i) if own[i] else (None, i)
            if hit:
                yield i, *hit
            i = end + 1

    def _statement(self, lines: list, own: list, i: int) -> tuple[tuple[str, float, float] | None, int]:
        """The prediction that holds most of a template, of the lines from `i` on, and its last line."""
        best, end, joined, have = None, i, [], set()
        held = [0] * len(self.needed)
        possible = False
        for j in range(i, len(lines)):
            if not lines[j] or len(joined) >= self.reach or best and best[2] == 1:
                break
            joined = joined + lines[j]
            for x in own[j] - have:
                for t, k in self.places[x]:
                    held[t] += k
                    possible = possible or held[t] >= self.needed[t]
            have |= own[j]
            if possible and own[j] and (hit := self.predict(joined)) and (not best or hit[2] > best[2]) and (
                    j == i or self._held(joined[len(lines[i]):], hit[0]) < hit[2]):
                best, end = hit, j
        return best, end

    def _held(self, w: list[str], family: str) -> float:
        return max(self._share(w, t) for t in self.templates[family])

    @staticmethod
    def _share(w: list[str], template: list[str]) -> float:
        """The largest share of the template's words that a stretch of the
        paragraph holds in order. Stretches of four times the template's
        length overlap by half, over the whole paragraph."""
        wanted = set(template)
        step, best = 2 * len(template), 0
        for a in range(0, max(1, len(w) - step), step):
            part = [x for x in w[a:a + 2 * step] if x in wanted]
            if len(part) > best:
                best = max(best, sum(b.size for b in SequenceMatcher(None, part, template, autojunk=False).get_matching_blocks()))
        return best / len(template)


def fit(docs: DataFrame, *, sample: int = SAMPLE) -> Classifier:
    """A classifier whose unknown class knows paragraphs of `docs`."""
    lines = columns(docs, "text").select(F.explode(F.split(F.col("text").cast("string"), "\n")).alias("p")).where("trim(p) <> ''")
    some = [r["p"] for r in distinct_sample(lines, "p", 2 * sample).orderBy("h").select("p").collect()]
    own = re.compile(r"licen[cs]|copyright|all rights reserved|spdx", re.I)   # may be statements themselves: not for unknown
    return Classifier([p for p in some if not own.search(p)][:sample])


def scan(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """`doc_id, paragraph, family, probability, template_share`: one row per
    paragraph of `docs` (`doc_id`, `text`) that states a licence, by the line
    where it begins; lines count from 0. Null and empty texts state none; doc_id may be null or
    repeated; other columns are ignored; no rows give no rows."""
    spark = docs.sparkSession
    prepare(spark)
    held = spark.sparkContext.broadcast(fit(docs) if model is None else model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in small(batches):
            out = [(i, *hit) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if t
                   for hit in m.statements(t)]
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (b.schema.field(0).type, pa.int32(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             ["doc_id", "paragraph", "family", "probability", "template_share"])

    rows = columns(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, paragraph int, family string, probability double, template_share double")
