import random
import re

import numpy as np
import pytest

from provena.llm import jaccard
from provena.llm.components import components
from provena.llm.jaccard import bitmap, folded, jaccard_components, within_bound
from provena.llm.queries import op8_ngram_jaccard

from ..conftest import SF_SMALL
from .cases import no_docs, odd_docs

LOW = {c: c + 32 for c in range(65, 91)}


def plain_components(docs, k, num, den):
    """{id: (set size, smallest id reachable)} by comparing all pairs."""
    sets, root = {}, {}
    for i, t in docs:
        w = [x for x in re.split("[\x20\x09-\x0d]+", (t or "").translate(LOW)) if x]
        sets[i] = set(zip(*(w[j:] for j in range(k)))) if len(w) >= k else {tuple(w)} if w else set()
        root[i] = i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def copies(rng, n):
    """Texts with exact, near and farther copies, groups that share a passage, and short texts."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    passage = [word() for _ in range(30)]
    base = [[word() for _ in range(rng.choice([1, 2, 3, 8, 12, 40, 90]))] for _ in range(25)]
    out = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 9])):
            p = rng.randrange(len(w))
            w[p:p + rng.choice([0, 1, 1])] = [word()]
        if rng.random() < 0.2:
            w = w + passage
        out.append((i, " ".join(w).upper() if rng.random() < 0.1 else " ".join(w)))
    return out


@pytest.mark.parametrize("k,num,den,block,frequent", [(3, 90, 100, 256, 1 << 17), (5, 80, 100, 3, 4)])
def test_against_all_pairs(spark, monkeypatch, k, num, den, block, frequent):
    monkeypatch.setattr(jaccard, "BLOCK", block)  # small blocks: the blockwise comparison of open tiles
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)  # the order changes, the result doesn't
    docs = copies(random.Random(k), 300)
    got = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), k, num, den).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(docs, k, num, den)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = op8_ngram_jaccard(spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(docs, 3, 90, 100)


def test_bound_loses_no_link():
    rng = np.random.default_rng(6)
    for _ in range(300):
        n = int(rng.integers(9, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.r_[rng.permutation(a)[:int(len(a) * rng.uniform(0.85, 1))], rng.integers(0, 1 << 63, rng.integers(0, 6)).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        linked = 100 * both >= 90 * (len(a) + len(b) - both)
        ok = len(within_bound(0, np.array([1]), np.array([len(a), len(b)]), folded([bitmap(a), bitmap(b)]), 90, 100)) == 1
        assert ok or not linked


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(400, x) for x in range(401, 440)]
    name = lambda x: (x * 2654435761 % 2**32).to_bytes(4, "big")
    got = components(spark.createDataFrame([(name(a), name(b)) for a, b in edges], "a binary, b binary")).collect()
    root = {bytes(r.node): bytes(r.root) for r in got}
    want = {x: x for e in edges for x in e}
    for _ in range(500):
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    for a in root:
        assert root[root[a]] == root[a]
    linked = {(a, b) for a in want for b in want if want[a] == want[b] and a != b}
    assert {(a, b) for a in want for b in want if a != b and name(a) in root and root.get(name(a)) == root.get(name(b))} == linked


def test_odd_rows(spark):
    got = jaccard_components(odd_docs(spark), 5, 80, 100).collect()
    by = [(r.doc_id, r.n_shingles, r.component_id) for r in got]
    assert len(by) == 13 and {c for i, n, c in by if n == 0 and i is not None} == {0, 1, 2}
    assert [c for i, _, c in by if i in (6, 7)] == [6, 6, 6] and (None, 0, None) in by
    assert [c for i, n, c in by if i is None and n] == [6]  # a row without id is in the group of its copies
    assert jaccard_components(no_docs(spark)).count() == 0
