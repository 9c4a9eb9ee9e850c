"""Licence scans: a trained paragraph classifier, with an unknown class, confirmed by comparison with templates.

Paragraphs are lines; a line that ends in a word or a comma goes on in the next one, if that is not blank, so
a notice that is wrapped, also behind comment marks, is one paragraph.  A paragraph of more than ``2 * HALF`` words is read
in windows of that size that overlap by half.  A paragraph's features are its word 1-, 2- and 3-grams, hashed.  A multinomial logistic regression over them has one
class for each licence family and one for everything else; it learns from the families' notices with words left out,
put in and set between other text, against paragraphs of the corpus and sentences that only sound alike.  A temperature
fitted on examples kept aside calibrates the probabilities, so that the unknown class is a statement and not a rest.

A paragraph is compared with the templates of every family that is likelier than the unknown class: the share of common
word 2-grams, in the shorter of the two.  ``SIMILAR`` of it confirms the prediction, if at least ``PAIRS`` 2-grams are common
(or all, of a template with fewer), so that two or three usual words confirm nothing; both figures are returned.  The
likeliest family is compared first, and a template's 2-grams count for the first family that is confirmed by them, so
that a line with two notices has both and a notice isn't taken for the kindred family with almost the same words.

Learning takes the notices below and the paragraphs of at most ``SAMPLE_DOCS`` documents in one task (texts of at most
``FIT_TEXT_BYTES``, ``FIT_BYTES`` of them in all; of several texts of an id the least); scanning is one pass, without a
shuffle, over whole texts of any length.

Defined results: null and empty texts have no paragraph and no row; repeated rows are reported each; of overlapping
windows of one family the likeliest of the confirmed is reported, or the likeliest where none is; a document with several
licences has a row for each place, and of the families of one window the likeliest and all that are confirmed.  Of the
input only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import pickle
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FIT_BYTES, FIT_TEXT_BYTES, buffer_of, claim, class_tokens, mix64, ship, slices, texts_of

#: Notices as the licences word them.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has dedicated all copyright and related rights to this work to the public domain worldwide.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "All-rights-reserved": (
        "All rights reserved.",
        "Copyright 2020 the authors. All rights reserved.",
        "No part of this publication may be reproduced or distributed in any form without the prior written permission of the publisher.",
    ),
}
#: Sentences that share words with notices and are none.
ALIKE = (
    "You need a driving license to rent the car.", "The license plate was found near the public library.",
    "She is licensed to practise medicine in two states.", "The album was released under pressure from the label.",
    "Version 3 of the game was released in April.", "The Apache helicopter landed at the base.", "He studied at MIT and worked on software.",
    "The general public was free to use the foundation.", "All seats are reserved.", "The rights of all people are protected.",
    "The commons is open to the creative public.", "Mozilla published a new version of the browser.", "This work is hard and the terms are strict.",
    "You may obtain a copy of the book at the shop.", "The conditions are met when the source and the form are sent.",
    "Permission is granted to enter the building.", "The file is distributed on Monday.", "A public domain name was registered.",
)

FAMILIES = tuple(TEMPLATES)
UNKNOWN = len(FAMILIES)
SAMPLE_DOCS = 1000
BITS, HALF = 15, 24
SIMILAR, PAIRS = 0.6, 3
EXAMPLES = 40  # for each notice


#: White space and what comments begin with; and what a line ends in that goes on.
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32, *b"#*/"]] = True
_GOES_ON = np.zeros(256, bool)
_GOES_ON[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz,-(\"'", *range(128, 256)]] = True


def paragraph_ends(raw: np.ndarray) -> np.ndarray:
    """Which bytes are line ends that end a paragraph: behind anything but a word or a comma, or with a blank line there."""
    end = raw == 10
    at, solid = np.flatnonzero(end), np.flatnonzero(~_BLANK[raw])
    if len(at) and len(solid):
        i = np.searchsorted(solid, at)
        before, after = solid[np.maximum(i - 1, 0)], solid[np.minimum(i, len(solid) - 1)]
        seen = np.cumsum(end)
        soft = (i > 0) & (i < len(solid)) & (seen[after] - seen[before] == 1) & _GOES_ON[raw[before]]
        end[at[soft]] = False
    return end


def words_and_lines(raw: np.ndarray, off: np.ndarray):
    """(hash, start, end, text number, line number) of every word; lines are numbered through all texts."""
    h, start, end, doc, kind = class_tokens(raw, off)
    word = kind < 3
    h, start, end, doc = h[word], start[word], end[word], doc[word]
    ends = np.cumsum(paragraph_ends(raw))
    line = (ends[start] if len(start) else np.zeros(0, np.int64)) + doc  # a new text is a new line too
    return h, start, end, doc, line


def features(h: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Column of the 1-, 2- and 3-gram that begins at each word (n, 3); -1 where the line ends before."""
    out = np.full((len(h), 3), -1, np.int64)
    g = np.zeros(len(h), np.uint64)
    for k in range(3):
        n = len(h) - k
        if n <= 0:
            break
        g = mix64(g[:n] * np.uint64(0x9FB21C651E98DF25) + h[k:] + np.uint64(k + 1))
        inside = line[:n] == line[k:]
        out[:n, k] = np.where(inside, (g >> np.uint64(64 - BITS)).astype(np.int64), -1)
    return out


def word_pairs(text: str) -> Counter:
    """The word 2-grams of a text, each as often as it stands there; a single word is one by itself."""
    b = text.encode()
    h = class_tokens(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
    w = h[0][h[4] < 3].tolist()
    return Counter(zip(w, w[1:])) or Counter((x, 0) for x in w)


@lru_cache
def template_pairs(family: str) -> list[Counter]:
    return [word_pairs(t) for t in TEMPLATES[family]]


def closest(pairs: Counter, free: Counter, family: str) -> tuple[float, Counter]:
    """The largest share of common word 2-grams with a template of the family, in the shorter of the two, and that
    template; ``free`` are those of the text's ``pairs`` that may count."""
    best, which = 0.0, Counter()
    for q in template_pairs(family):
        if pairs and q:
            common = len(free.keys() & q.keys())
            share = common / min(len(pairs), len(q)) if common >= min(PAIRS, len(q)) else 0.0
            if share > best:
                best, which = share, q
    return best, which


def similarity(text: str, family: str) -> float:
    """The largest share of common word 2-grams with a template of the family, in the shorter of the two."""
    p = word_pairs(text)
    return closest(p, p, family)[0]


def compare(text: str, families: list[tuple[int, float]]) -> list[tuple[int, float, float]]:
    """(family, probability, similarity) of the first of ``families`` (family, probability; the likeliest first) and of
    every other that 2-grams of the text confirm which confirmed none before."""
    p = word_pairs(text)
    free, out = p, []
    for k, (c, probability) in enumerate(families):
        s, template = closest(p, free, FAMILIES[c])
        if s >= SIMILAR:
            free = free - Counter(template.keys())
        if s >= SIMILAR or k == 0:
            out.append((c, probability, s))
    return out


class Model:
    """Weights by feature and class, bias, temperature."""

    def __init__(self, paragraphs: list[str]):
        rng = np.random.default_rng(11)
        plain = [p for p in paragraphs if p.strip() and max(similarity(p, f) for f in FAMILIES) < SIMILAR]
        filler = [w for p in plain[:500] for w in p.split()[:30]] or ["the", "of", "and"]
        texts, labels = [], []
        for c, family in enumerate(FAMILIES):
            for notice in TEMPLATES[family]:
                for k in range(EXAMPLES):
                    texts.append(self._varied(notice, filler, rng) if k else notice)
                    labels.append(c)
        for s in ALIKE:
            for k in range(EXAMPLES // 2):
                texts.append(self._varied(s, filler, rng) if k else s)
                labels.append(UNKNOWN)
        for p in plain[:4000]:
            texts.append(" ".join(p.split()[:2 * HALF]))
            labels.append(UNKNOWN)
        self._learn(texts, np.array(labels), rng)

    @staticmethod
    def _varied(notice: str, filler: list[str], rng) -> str:
        words = [w for w in notice.split() if rng.random() > 0.06] or notice.split()
        if len(words) > 24 and rng.random() < 0.5:  # a part of a long notice
            a = int(rng.integers(0, len(words) - 16))
            words = words[a:a + 32]
        some = lambda n: [filler[i] for i in rng.integers(0, len(filler), int(rng.integers(0, n + 1)))]
        return " ".join(some(5) + words + some(5)) if rng.random() < 0.6 else " ".join(words)

    def _learn(self, texts: list[str], y: np.ndarray, rng) -> None:
        """Adagrad on the multinomial logistic loss of sparse rows, with weight decay by early end."""
        t = pa.array([x.replace("\n", " ") for x in texts], pa.large_string())
        raw, off = buffer_of(t)
        h, _, _, doc, line = words_and_lines(raw, off)
        f = features(h, line)
        rows = [np.zeros(0, np.int64)] * len(texts)
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
            x = f[a:b].ravel()
            rows[i] = x[x >= 0]
        classes = UNKNOWN + 1
        self.w = np.zeros((1 << BITS, classes), np.float32)
        self.b = np.zeros(classes, np.float32)
        gw, gb = np.full((1 << BITS, classes), 1e-2, np.float32), np.full(classes, 1e-2, np.float32)
        order = rng.permutation(len(y))
        aside, rest = order[:len(y) // 6], order[len(y) // 6:]
        for _ in range(4):
            for i in rng.permutation(rest).tolist():
                x = rows[i]
                if not len(x):
                    continue
                scale = np.float32(1 / np.sqrt(len(x)))
                z = self.w[x].sum(axis=0) * scale + self.b
                p = np.exp(z - z.max())
                p /= p.sum()
                p[y[i]] -= 1
                gw[x] += (p * scale) ** 2
                self.w[x] -= 0.3 * p * scale / np.sqrt(gw[x])
                gb += p ** 2
                self.b -= 0.3 * p / np.sqrt(gb)
        z = np.stack([self.w[rows[i]].sum(axis=0) / np.sqrt(max(1, len(rows[i]))) + self.b for i in aside])
        grid = np.exp(np.linspace(np.log(0.2), np.log(10), 60))
        loss = []
        for temperature in grid:
            q = z / temperature
            q = q - q.max(axis=1, keepdims=True)
            loss.append(-np.mean(q[np.arange(len(aside)), y[aside]] - np.log(np.exp(q).sum(axis=1))))
        self.temperature = float(grid[int(np.argmin(loss))])

    def scan(self, texts: pa.Array) -> list[tuple[int, int, int, list[tuple[int, float]]]]:
        """(text, first and last byte, families) of the windows whose best class is a family; ``families`` are all that are
        likelier than the unknown class, as (family, probability), the likeliest first."""
        raw, off = buffer_of(texts)
        h, start, end, doc, line = words_and_lines(raw, off)
        if not len(h):
            return []
        f = features(h, line)
        first_of_line = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
        place = np.arange(len(h)) - np.repeat(first_of_line, np.diff(np.r_[first_of_line, len(h)]))
        block = np.flatnonzero(place % HALF == 0)  # a block begins at every HALF words of a line
        per_word = np.zeros((len(block), self.w.shape[1]), np.float32)
        for a in range(0, len(block), 4096):  # bounded rows of weights at once
            lo = block[a]
            hi = block[a + 4096] if a + 4096 < len(block) else len(h)
            x = f[lo:hi]
            s = self.w[np.maximum(x[:, 0], 0)] * (x[:, :1] >= 0)
            for k in (1, 2):
                s += self.w[np.maximum(x[:, k], 0)] * (x[:, k:k + 1] >= 0)
            per_word[a:a + 4096] = np.add.reduceat(s, block[a:a + 4096] - lo, axis=0)
        many = np.add.reduceat((f >= 0).sum(axis=1), block)
        stop = np.r_[block[1:], len(h)]
        more = np.r_[line[block[1:]] == line[block[:-1]], False]  # the next block is in the same line
        alone = ~more & ~np.r_[False, more[:-1]]
        window = np.flatnonzero(more | alone)  # two blocks, or a line's only one
        after = np.minimum(window + 1, len(block) - 1)
        pair = more[window]
        z = per_word[window] + np.where(pair[:, None], per_word[after], 0)
        n = many[window] + np.where(pair, many[after], 0)
        z = (z / np.sqrt(np.maximum(n, 1))[:, None] + self.b) / self.temperature
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        out = []
        for i in np.flatnonzero(best != UNKNOWN).tolist():
            w = window[i]
            last = stop[w + 1] - 1 if pair[i] else stop[w] - 1
            likely = [(int(c), float(p[i, c])) for c in np.argsort(-p[i], kind="stable") if p[i, c] > p[i, UNKNOWN]]
            out.append((int(doc[block[w]]), int(start[block[w]]), int(end[last]), likely or [(int(best[i]), float(p[i, best[i]]))]))
        return out


def fit_licences(docs: DataFrame, n: int = SAMPLE_DOCS) -> Model:
    """Learn, with the paragraphs of at most ``n`` documents (chosen by a hash of their ids) as unknown examples."""
    spark = docs.sparkSession
    ship(spark)
    chosen = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    rows = (docs.select("doc_id", "text").where(F.octet_length("text") <= FIT_TEXT_BYTES).join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text")).repartition(1).sortWithinPartitions("doc_id").select("text"))
    limit = FIT_BYTES

    def run(batches):
        claim("fit_licences")
        paragraphs: list[str] = []
        left = limit
        for b in slices(batches, "text"):
            for t in texts_of(b, "text").to_pylist():
                left -= len(t)
                if left < 0:
                    break
                paragraphs += [" ".join(x.split()[:2 * HALF]) for x in t.split("\n")[:8]]  # examples, not what is scanned
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Model(paragraphs))], pa.binary())], names=["model"])

    got = rows.mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0][0]) if got else Model([])  # without documents: the notices and like sentences alone


def scan_licences(docs: DataFrame, model: Model) -> DataFrame:
    """Per licence paragraph: doc_id, start, end (characters), family, probability, similarity, confirmed."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in slices(batches, "text"):
            t = texts_of(b, "text")
            found: dict[tuple[int, int], list] = {}
            raw, off = buffer_of(t)
            for d, start, end, families in m.scan(t):
                text = raw[start:end].tobytes().decode("utf-8", "replace")
                for c, p, s in compare(text, families):
                    found.setdefault((d, c), []).append((s >= SIMILAR, p, s, start, end, text))
            if not found:
                continue
            ids, cols = b.column(0).to_pylist(), [[] for _ in range(7)]
            for (d, c), places in sorted(found.items()):
                kept: list[tuple[int, int]] = []
                for confirmed, p, s, start, end, text in sorted(places, key=lambda x: (not x[0], -x[1], x[3])):
                    if any(start < b2 and end > a2 for a2, b2 in kept):
                        continue
                    kept.append((start, end))
                    before = len(raw[off[d]:start].tobytes().decode("utf-8", "replace"))
                    for col, v in zip(cols, (ids[d], before, before + len(text), FAMILIES[c], p, s, confirmed)):
                        col.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "start", "end", "family", "probability", "similarity", "confirmed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, start long, end long, family string, probability double, similarity double, confirmed boolean")
