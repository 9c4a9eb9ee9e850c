"""Toxic passages by maximum-scoring segments.

Each token has a log-odds score: the toxic against the clean training texts that use it, with a Dirichlet prior in
proportion to its use in all of them, counted only where it is ``Z_MIN`` standard errors from none, less a drift that
makes the mean over clean text negative.  One pass over a text finds all its maximal segments (the disjoint runs of tokens that no
neighbour can better), in time linear in the tokens that score above zero.

How a segment of score S stands out in a text of m tokens follows from the extreme-value law of such scores: the
expected number of as good segments in clean text is E = K m exp(-lambda S), where lambda solves the mean of
exp(lambda s) = 1 over clean tokens and K is fitted to the clean texts' best segments.  Segments with E under ``E_MAX``
are passages.  A text's passages are added up as -log E, and a logistic curve fitted on the training texts turns the
sum into a probability.

Learning takes at most ``FIT_DOCS`` labelled texts (and bytes, see ``fit_on_sample``); scoring is one pass, without a
shuffle, over whole texts of any length.

Defined results: null and empty texts, and texts without tokens, have no passage and the score of a text without one;
without any training text all scores are 0.  Repeated rows are scored each.  All columns of the input stay; one with the
name of a new column is replaced (both names are parameters).  Of two segments that are equally good to join, the nearer counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Lookup, add_columns, buffer_of, class_tokens, fit_on_sample, text_slices

FIT_DOCS = 6000
PRIOR = 0.05  # the prior's weight, as a share of all counts
Z_MIN = 3.0
DRIFT = 0.05
E_MAX = 0.01


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of a row of scores, in order.

    Only tokens above zero can begin a segment; what lies between two of them is one sum.  Each segment keeps the sum
    before it (``left``) and up to its end (``right``); a new one is joined with the last one whose left is lower,
    if its right is lower too.  Each segment also keeps which one that was: all between have a left that is no lower
    than its own, so a search that passes the segment goes on there, and none is passed twice.
    """
    run = np.cumsum(scores)
    out: list[tuple] = []  # start, end, left, right, the last one before with a lower left
    at = np.flatnonzero(scores > 0)
    for i, right, own in zip(at.tolist(), run[at].tolist(), scores[at].tolist()):
        start, left = i, right - own
        j = len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= left:
                j = out[j][4]
            if j < 0 or out[j][3] >= right:
                out.append((start, i + 1, left, right, j))
                break
            start, _, left, _, before = out[j]
            del out[j:]
            j = before
    return [(a, b, r - left) for a, b, left, r, _ in out]


class Model:
    """Token scores and the laws fitted to them."""

    def __init__(self, texts: pa.Array, toxic: np.ndarray):
        bad = toxic.astype(bool)
        found = []  # per slice of the texts: keys, texts with the key (toxic, clean), uses in clean texts
        for first, part in text_slices(texts):
            raw, off = buffer_of(part)
            h, _, _, doc, _ = class_tokens(raw, off)
            keys, back = np.unique(h, return_inverse=True)
            # each text counts a token once, so that no single text makes a score
            once = np.unique(doc * len(keys) + back)
            by, which = first + once // max(1, len(keys)), once % max(1, len(keys))
            y1 = np.bincount(which, weights=bad[by], minlength=len(keys))
            use = np.bincount(back, weights=~bad[first + doc], minlength=len(keys))  # of clean text, token by token
            found.append((keys, y1, np.bincount(which, minlength=len(keys)) - y1, use))
        keys, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        y1, y0, use = (np.bincount(back, weights=np.concatenate([f[i] for f in found]), minlength=len(keys)) for i in (1, 2, 3))
        n1, n0 = max(1.0, y1.sum()), max(1.0, y0.sum())
        prior = PRIOR * (n0 + n1)
        a = prior * (y0 + y1) / (n0 + n1)
        odds = np.log((y1 + a) / (n1 + prior - y1 - a)) - np.log((y0 + a) / (n0 + prior - y0 - a))
        z = odds / np.sqrt(1 / (y1 + a) + 1 / (y0 + a))
        score = np.where(np.abs(z) >= Z_MIN, odds, 0.0)
        uses = max(1.0, use.sum())
        mean = (score * use).sum() / uses
        self.drift = DRIFT + max(0.0, mean)
        told = score != 0
        self.keys, self.scores = keys[told], score[told] - self.drift
        self.at = Lookup(self.keys)
        # lambda: the positive root of the mean of exp(lambda s) over clean tokens = 1
        s0 = score - self.drift
        low, high = 1e-6, 1.0
        law = lambda x: (np.exp(np.minimum(x * s0, 700.0)) * use).sum() / uses - 1
        if (s0[use > 0] > 0).any():
            while law(high) < 0 and high < 64:
                high *= 2
            for _ in range(60):
                mid = (low + high) / 2
                low, high = (mid, high) if law(mid) < 0 else (low, mid)
        self.lam = high
        self.k = 1.0
        texts_found = [f for _, part in text_slices(texts) for f in self._found(part)]
        best = np.array([max((s for _, _, s in f), default=0.0) for _, f in texts_found])
        size = np.array([tokens for tokens, _ in texts_found])
        fit = ~bad & (best > 0) & (size > 0)
        if fit.any():  # the mean of an extreme-value law with this lambda
            self.k = float(np.exp(np.mean(self.lam * best[fit] - np.log(size[fit])) - np.euler_gamma))
        x = np.array([self._sum(n, f) for n, f in texts_found])
        self.curve = logistic(np.log1p(x), bad.astype(float))

    def _found(self, texts: pa.Array):
        """(number of tokens, segments) of each text."""
        raw, off = buffer_of(texts)
        h, _, _, doc, _ = class_tokens(raw, off)
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        s = self.token_scores(h)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield b - a, segments(s[a:b])

    def token_scores(self, h: np.ndarray) -> np.ndarray:
        i = self.at.find(h)
        return np.where(i >= 0, self.scores[np.maximum(i, 0)], -self.drift) if len(self.keys) else np.full(len(h), -self.drift)

    def expected(self, tokens: int, score: float) -> float:
        """How many segments as good a clean text of so many tokens has."""
        return self.k * tokens * float(np.exp(-self.lam * score))

    def _sum(self, tokens: int, found: list) -> float:
        return sum(-np.log(max(e, 1e-300)) for _, _, s in found if (e := self.expected(tokens, s)) < E_MAX)

    def score(self, total: np.ndarray) -> np.ndarray:
        w, b = self.curve
        return 1 / (1 + np.exp(-np.clip(w * np.log1p(total) + b, -50, 50)))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Weight and bias of a one-feature logistic curve, lightly regularised (Newton's method)."""
    w = np.zeros(2)
    f = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -50, 50)))
        g = f.T @ (p - y) + 1e-2 * w
        hess = (f * (p * (1 - p))[:, None]).T @ f + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", n: int = FIT_DOCS) -> Model | None:
    """Learn from the labelled documents among ``docs`` (columns doc_id, text; doc_id, label)."""
    return fit_on_sample(docs, labels, label, n, Model)


def score_toxicity(docs: DataFrame, model: Model | None, text: str = "text", name: str = "toxicity",
                   passages_name: str = "passages") -> DataFrame:
    """All columns plus ``toxicity`` (0 to 1) and ``passages``: array of (start, end in characters, score, expected)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                            T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType())])
    fields = [T.StructField(name, T.DoubleType(), False), T.StructField(passages_name, T.ArrayType(passage), False)]

    def fn(texts, _):
        m = shared.value
        if m is None:
            return [np.zeros(len(texts)), [[] for _ in range(len(texts))]]
        raw, off = buffer_of(texts)
        h, start, end, doc, _ = class_tokens(raw, off)
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        s = m.token_scores(h)
        total, passages = [], []
        for d, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            found = [(x, y, v, e) for x, y, v in segments(s[a:b]) if (e := m.expected(b - a, v)) < E_MAX]
            total.append(sum(-np.log(max(e, 1e-300)) for *_, e in found))
            if found:  # bytes to characters: count the bytes that begin one
                begins = np.r_[0, np.cumsum((raw[off[d]:off[d + 1]] & 0xC0) != 0x80)]
                found = [{"start": int(begins[start[a + x] - off[d]]), "end": int(begins[end[a + y - 1] - off[d]]),
                          "score": v, "expected": e} for x, y, v, e in found]
            passages.append(found)
        return [m.score(np.array(total)), passages]

    return add_columns(docs, text, fields, fn)
