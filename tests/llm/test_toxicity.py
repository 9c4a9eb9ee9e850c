import random

import numpy as np
from pyspark.sql import functions as F

from provena.llm.common import training_rows
from provena.llm.toxicity import fit_toxicity, score_toxicity, segments

from ..conftest import SF_MID
from .cases import no_docs, odd_docs


def plain_segments(scores):
    """All maximal segments by their definition: the best run of the whole, then of what is left on either side."""
    def best(a, b):
        top = None
        for i in range(a, b):
            s = 0.0
            for j in range(i, b):
                s += scores[j]
                if s > 1e-12 and (top is None or s > top[2] + 1e-12):
                    top = (i, j + 1, s)
        return top

    def split(a, b):
        t = best(a, b)
        return [] if t is None else [*split(a, t[0]), t, *split(t[1], b)]
    return split(0, len(scores))


def test_segments():
    rng = random.Random(4)
    for _ in range(300):
        s = np.array([round(rng.uniform(-3, 2), 3) for _ in range(rng.randint(0, 25))])
        got, want = segments(s), plain_segments(s)
        assert np.isclose(sum(x[2] for x in got), sum(x[2] for x in want)) and len(got) == len(want)
        for (a, b, v), (c, d, w) in zip(got, want):
            assert np.isclose(v, w) and np.isclose(s[a:b].sum(), v) and (a, b) == (c, d)


def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_toxicity(docs, training_rows(labels))
    rows = (score_toxicity(docs, model).join(labels.select("doc_id", "toxic"), "doc_id")
            .where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect())
    assert len(rows) > 50
    assert np.mean([(r.toxicity >= 0.5) == (r.toxic == 1) for r in rows]) > 0.93
    for r in rows:
        assert all(0 <= p.start < p.end <= len(r.text) for p in r.passages)
        assert r.passages or r.toxicity < 0.5


def test_odd_rows(spark):
    labels = spark.createDataFrame([(3, 0, 1), (6, 1, 0), (7, 1, 1), (8, 1, 0), (None, 1, 1), (5, 1, None), (99, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = fit_toxicity(odd_docs(spark), labels)
    out = score_toxicity(odd_docs(spark), model)
    assert out.columns.count("toxicity") == 1 and "Score" in out.columns
    rows = out.collect()
    assert len(rows) == 13 and all(0 <= r.toxicity <= 1 for r in rows)
    empty = {r.toxicity for r in rows if not (r.text or "").strip()}
    assert len(empty) == 1
    none = fit_toxicity(no_docs(spark), labels)
    assert none is None and {r.toxicity for r in score_toxicity(odd_docs(spark), none).collect()} == {0.0}
    assert score_toxicity(no_docs(spark), model).count() == 0


def test_segments_are_found_in_linear_time():
    import time
    for n in (100_000, 200_000):
        begin = time.process_time()
        got = segments(np.tile([1.0, -2.0], n))
        assert len(got) == n and time.process_time() - begin < 2
    rng = random.Random(9)
    for _ in range(40):
        s = np.array([rng.uniform(-3, 2) for _ in range(200)])
        got, want = segments(s), plain_segments(s)
        assert np.isclose(sum(x[2] for x in got), sum(x[2] for x in want))
        assert all(np.isclose(s[a:b].sum(), v) for a, b, v in got)


def test_a_text_of_a_million_words(spark):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    words = ["vile filth" if i % 2 else "calm river" for i in range(20)]
    docs = spark.createDataFrame([(i, f"{w} stone " * 30) for i, w in enumerate(words)], "doc_id long, text string")
    model = fit_toxicity(docs, labels)
    long = spark.createDataFrame([(1, "calm river vile stone " * 250_000), (2, "calm")], "doc_id long, text string")
    got = {r.doc_id: r for r in score_toxicity(long, model).select("doc_id", "toxicity", F.size("passages").alias("n")).collect()}
    assert set(got) == {1, 2} and 0 <= got[1].toxicity <= 1
