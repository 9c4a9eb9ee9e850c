"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network in numpy.

Tokens are runs of letters, digits or other marks.  Every token has a sparse ternary index vector by its hash; a word's
vector is the sum of the index vectors around its occurrences in the training texts, at unit length.  A token that the
training texts do not hold (or hold once) stands for its shape: class, length, the first byte of a mark.  A document is
the mean of its tokens' vectors, with its length and its shares of distinct tokens and of tokens like the one before.  A network of one hidden layer gives a
logit, and a temperature fitted on training texts kept aside makes it a probability.

Learning takes at most ``FIT_DOCS`` labelled texts (and bytes, see ``fit_on_sample``) in one task, so the table of word
vectors has a bound; scoring is one pass, without a shuffle, over whole texts of any length.

Defined results: null and empty texts, and texts without tokens, have the zero vector and whatever score the network
gives it; without any training text all scores are 0.5.  Repeated rows are scored each, and alike.  Words of the same count
are kept in the order of their hashes.  All columns of the input stay; one with the name of the new column is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Lookup, add_columns, buffer_of, class_tokens, fit_on_sample, mix64, text_slices

FIT_DOCS = 6000
DIM, NONZERO, REACH = 64, 4, 2
HIDDEN, EPOCHS = 32, 60
WORDS = 60_000


def index_vectors(h: np.ndarray) -> np.ndarray:
    """Sparse ternary vectors by hash: NONZERO places, signs by further bits."""
    out = np.zeros((len(h), DIM), np.float32)
    rows = np.arange(len(h))
    for j in range(NONZERO):
        x = mix64(h + np.uint64(j + 1))
        out[rows, (x % np.uint64(DIM)).astype(np.int64)] += np.where(x >> np.uint64(63), 1, -1).astype(np.float32)
    return out


def shape_of(raw: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """What stands for a token of unknown vector: its class, its length up to 15, and the first byte of a mark."""
    first = np.where(kind == 3, raw[start], 0) if len(start) else np.zeros(0, np.int64)
    return mix64(kind.astype(np.uint64) * np.uint64(1 << 20) + np.minimum(end - start, 15).astype(np.uint64) * np.uint64(256)
                 + first.astype(np.uint64))


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-6)


class Model:
    """Word vectors, network and temperature."""

    def __init__(self, texts: pa.Array, labels: np.ndarray):
        self._learn_words(texts)
        x = self.features(texts)
        y = labels.astype(np.float64)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        rng = np.random.default_rng(7)
        order = rng.permutation(len(y))
        aside = order[:len(y) // 6]
        rest = order[len(y) // 6:]
        self._learn_network((x - self.mean) / self.scale, y, rest, rng)
        self.temperature = 1.0
        if len(aside) > 20:
            z = self.logits(x[aside])
            grid = np.exp(np.linspace(np.log(0.3), np.log(10), 60))
            loss = [np.mean(np.logaddexp(0, np.where(y[aside] > 0.5, -z, z) / t)) for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _learn_words(self, texts: pa.Array) -> None:
        counts = [np.unique(class_tokens(*buffer_of(part))[0], return_counts=True) for _, part in text_slices(texts)]
        keys, back = np.unique(np.concatenate([k for k, _ in counts]), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate([c for _, c in counts]), minlength=len(keys))
        usual = np.flatnonzero(n > 1)
        usual = usual[np.argsort(-n[usual], kind="stable")][:WORDS]
        at = Lookup(keys[usual])
        v = np.zeros((len(usual), DIM), np.float32)
        step = 1 << 16
        for _, part in text_slices(texts):
            h, _, _, doc, _ = class_tokens(*buffer_of(part))
            word = at.find(h)
            for d in range(1, REACH + 1):
                for a in range(0, max(0, len(h) - d), step):
                    i = np.arange(a, min(a + step, len(h) - d))
                    i = i[doc[i] == doc[i + d]]
                    for here, there in ((i, i + d), (i + d, i)):
                        known = word[here] >= 0
                        np.add.at(v, word[here[known]], index_vectors(h[there[known]]) / d)
        self.keys, self.vectors = keys[usual], _unit(v)
        self.at = Lookup(self.keys)

    def features(self, texts: pa.Array) -> np.ndarray:
        return np.concatenate([self._features(part) for _, part in text_slices(texts)] or [np.zeros((0, DIM + 3))])

    def _features(self, texts: pa.Array) -> np.ndarray:
        raw, off = buffer_of(texts)
        h, start, end, doc, kind = class_tokens(raw, off)
        n = len(texts)
        i = self.at.find(h)
        out = np.zeros((n, DIM + 3))
        step = 1 << 17
        for a in range(0, len(h), step):  # bounded rows of vectors at once
            s = slice(a, a + step)
            known = i[s] >= 0
            v = np.empty((len(known), DIM), np.float32)
            v[known] = self.vectors[i[s][known]]
            if not known.all():
                odd = ~known
                v[odd] = index_vectors(shape_of(raw, start[s][odd], end[s][odd], kind[s][odd])) / 2
            where = np.flatnonzero(np.r_[True, doc[s][1:] != doc[s][:-1]])
            out[doc[s][where], :DIM] += np.add.reduceat(v, where, axis=0)
        per_doc = np.bincount(doc, minlength=n)
        out[:, :DIM] /= np.maximum(per_doc, 1)[:, None]
        out[:, DIM] = np.log1p(per_doc)
        again = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        out[:, DIM + 2] = np.sqrt(np.bincount(doc[1:], weights=again, minlength=n) / np.maximum(per_doc, 1))
        first = np.searchsorted(doc, np.arange(n + 1))
        out[:, DIM + 1] = [len(np.unique(h[a:b])) / (b - a) if b > a else 0.0 for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        return out

    def _learn_network(self, x: np.ndarray, y: np.ndarray, rows: np.ndarray, rng) -> None:
        """Adam on the logistic loss, the two labels weighted alike where one is rare, with weight decay."""
        self.w1 = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN))
        self.b1 = np.zeros(HIDDEN)
        self.w2 = rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN)
        self.b2 = np.zeros(1)
        params = [self.w1, self.b1, self.w2, self.b2]
        m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(EPOCHS):
            order = rng.permutation(rows)
            for a in range(0, len(order), 64):
                i = order[a:a + 64]
                z1 = x[i] @ self.w1 + self.b1
                a1 = np.maximum(z1, 0)
                p = 1 / (1 + np.exp(-np.clip(a1 @ self.w2 + self.b2[0], -50, 50)))
                d = (p - y[i]) / len(i)
                da = np.outer(d, self.w2) * (z1 > 0)
                grads = [x[i].T @ da + 1e-4 * self.w1, da.sum(axis=0), a1.T @ d + 1e-4 * self.w2, np.array([d.sum()])]
                t += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    params[k] -= 0.003 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.scale
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2[0]

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(self.features(texts)) / self.temperature, -50, 50)))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", n: int = FIT_DOCS) -> Model | None:
    """Learn from the labelled documents among ``docs`` (columns doc_id, text; doc_id, label)."""
    return fit_on_sample(docs, labels, label, n, Model)


def score_quality(docs: DataFrame, model: Model | None, text: str = "text", name: str = "quality") -> DataFrame:
    """All columns plus ``quality`` (0 to 1, higher: better)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def fn(texts, _):
        return [np.full(len(texts), 0.5) if shared.value is None else shared.value.score(texts)]

    return add_columns(docs, text, [T.StructField(name, T.DoubleType(), False)], fn)
