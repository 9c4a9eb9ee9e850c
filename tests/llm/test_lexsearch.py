import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from provena.llm import lexsearch
from provena.llm.lexsearch import Items, Scorer, Vocabulary, pack, search, term_spans, unpack
from provena.llm.queries import op13_lexical_search

from ..conftest import SF_SMALL
from .cases import PASSAGE, no_docs, odd_docs

LOW = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def plain(docs, items, k=10):
    """The contract by scoring every document for every item."""
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    bags = [b for b in bags if b[2]]
    n, length = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in set(items):
        scores = []
        for doc, bag, size in bags:
            m = 100 - 75 + (75 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
                    for t in terms(text) if t in bag)
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item, r + 1, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def made(rng, n):
    word = lambda: rng.choice(["Alpha", "beta", "GAMMA", "d", "éa", "x1", "漢字", "zeta", "eta", "theta", "iota", "K9"])
    base = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(25)]
    return [(i, rng.choice(base) + rng.choice(["", "", " beta", "-d.d_d "])) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize("limit,dense,cells", [(1 << 20, 512, 1 << 21), (60, 2, 40)])
def test_against_every_document(spark, monkeypatch, limit, dense, cells):
    monkeypatch.setattr(lexsearch, "DENSE_TERMS", dense)
    monkeypatch.setattr(lexsearch, "CELLS", cells)
    rng = random.Random(limit)
    docs, items = made(rng, 400), made(rng, 9)
    got = search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), limit=limit)
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def test_query(spark):
    docs, items = ([(r[0], r.text) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").collect()] for t in ("documents", "benchmark"))
    assert sorted(map(tuple, op13_lexical_search(spark, SF_SMALL).collect()), key=str) == plain(docs, items)


def test_equal_bags_are_one_class(spark):
    """A third of all documents with one bag: a window with a limit stands for them, the smallest ids are found."""
    docs = [(i, "alpha beta" if i % 3 else "beta ALPHA") for i in range(3000, 0, -1)] + [(9000, "gamma delta alpha")]
    items = [(1, "alpha beta"), (2, "gamma")]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = search(df.repartition(7), it)
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def test_vectors_and_vocabulary():
    rng = np.random.default_rng(1)
    for size in (10, 70_000):
        ids = np.unique(rng.integers(0, size, 50))
        times = rng.integers(1, 400, len(ids))
        a, b = unpack(pack(ids, times, size), len(ids), size)
        assert (a == ids).all() and (b == times).all()
    vocab = Vocabulary([b"alpha", b"al", b"alphabet", b"\xc3\xa9a"])
    raw = np.frombuffer("alpha al alph alphabet alphabets éa".encode(), np.uint8)
    start, end, _ = term_spans(raw, np.array([0, len(raw)]))
    assert vocab.find(raw, start, end).tolist() == [0, 1, -1, 2, -1, 3]


def test_whole_numbers_beyond_doubles():
    """Where sums pass 2^53 the scorer works in 64-bit integers."""
    items = Items([(1, "a " * 400_000 + "b"), (2, "b")])
    weight = np.array([30_000, 7])
    s = Scorer(items, weight)
    assert s.kind is np.int64
    got = s.scores([(2, pack(np.array([0, 1]), np.array([3, 1]), 2))], np.array([91]))
    each = [int(weight[i]) * ((1_000_000_000 * t) // (1000 * t + 8 * 91)) for i, t in ((0, 3), (1, 1))]
    assert got.tolist() == [[400_000 * each[0] + each[1], each[1]]]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, PASSAGE), (1, PASSAGE), (1, "word"), (2, None), (3, ""), (4, "nowhere"), (None, "é 漢字 x"), (5, "word fox " * 500)]
    it = spark.createDataFrame([(*i, 0, "t") for i in items], "item_id long, text string, score int, doc_id string")
    assert sorted(map(tuple, search(docs, it).collect()), key=str) == plain(rows, items)
    assert search(no_docs(spark), it).count() == 0 and search(docs, it.limit(0)).count() == 0
    long_doc = spark.createDataFrame([(1, "alpha " * 1_000_000), (2, "alpha beta"), (3, "beta " + "q" * 2_000_000)], "doc_id long, text string")
    one = spark.createDataFrame([(1, "alpha"), (2, "beta")], "item_id long, text string")
    assert sorted(map(tuple, search(long_doc, one).collect()), key=str) == plain([tuple(r) for r in long_doc.collect()], [(1, "alpha"), (2, "beta")])
