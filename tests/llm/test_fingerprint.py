import hashlib

import numpy as np

from provena.llm.fingerprint import K, WINDOW, edited, fingerprint, fingerprint_neighbours, likeness, winnow
from provena.llm.queries import op2_fingerprints

from ..conftest import SF_SMALL
from .cases import no_docs, odd_docs, odd_rows


def plain_winnow(text):
    if len(text) < K:
        return None
    g = [int(winnow([text[i:i + K]])[0][0][0]) for i in range(len(text) - K + 1)]
    out = []
    for w in [range(i, i + WINDOW) for i in range(len(g) - WINDOW + 1)] or [range(len(g))]:
        low = min(g[i] for i in w)
        pick = (low, max(i for i in w if g[i] == low))
        if not out or out[-1] != pick:
            out.append(pick)
    return out


def test_windows():
    for t in ["ab" * 60, "a" * 200, "😀" * 70, "xyz" * 30 + "hello world" * 9, "k" * K, "k" * (K + WINDOW)]:
        h, p = winnow(["before", t, "after " * 40])[1]
        assert list(zip(h.tolist(), p.tolist())) == plain_winnow(t)
    assert [len(h) for h, _ in winnow(["", "xyz", "a" * K])] == [0, 1, 1]


def test_shared_passage_is_seen():
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    for _ in range(30):
        passage = word(K + WINDOW - 1)
        a, b = winnow([word(90) + passage + word(50), word(33) + passage + word(120)])
        assert len(np.intersect1d(a[0], b[0]))


def test_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = {r.doc_id: r for r in op2_fingerprints(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        r, e = got[i], edited(t, after)
        prints = [h for h, _ in winnow([t, e, after])]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert r.fingerprint == prints[0].astype(">u4").tobytes().hex()
        sets = [np.unique(p) for p in prints]
        assert r.near_edited == likeness(sets[0], sets[1]) and r.near_next == likeness(sets[0], sets[2])


def test_odd_rows(spark):
    got = fingerprint_neighbours(odd_docs(spark), groups=3).collect()
    assert sorted(r.n_chars for r in got) == sorted(len(r[1] or "") for r in odd_rows())
    assert fingerprint_neighbours(no_docs(spark)).count() == 0
    one = fingerprint_neighbours(odd_docs(spark).where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0  # the next document of the only one is itself
    assert fingerprint(odd_docs(spark)).count() == 13


def test_rows_without_ids_follow_each_other_by_hash(spark):
    """They are spread over ranges of their own, before all ids; equal ids stand together."""
    from pyspark.sql import functions as F
    rows = [(None, f"without an id {i} " * (1 + i % 7)) for i in range(40)] + [(i // 3, f"with the id {i} " * 9) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.tie))
    for groups in (1, 5, 16):
        got = {(r.doc_id, r.n_chars, r.edited) for r in fingerprint_neighbours(docs, groups=groups).collect()}
        assert got == {(r.doc_id, len(r.text), edited(r.text, after.text)) for r, after in zip(order, order[1:] + order[:1])}
