import numpy as np
from pyspark.sql import functions as F

from provena.llm.common import training_rows
from provena.llm.quality import fit_quality, index_vectors, score_quality

from ..conftest import SF_MID
from .cases import no_docs, odd_docs


def test_index_vectors_are_sparse_and_nearly_orthogonal():
    v = index_vectors(np.arange(500, dtype=np.uint64))
    assert (np.abs(v).sum(axis=1) <= 4).all() and abs((v[:250] * v[250:]).sum(axis=1).mean()) < 0.3


def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality(docs, training_rows(labels))
    rows = (score_quality(docs.select("doc_id", "text"), model).join(labels.withColumnRenamed("quality", "label"), "doc_id")
            .where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect())
    assert np.mean([(r.quality >= 0.3) == (r.label == 1) for r in rows]) > 0.9
    # calibrated: the mean probability is near the share of the label
    assert abs(np.mean([r.quality for r in rows]) - np.mean([r.label for r in rows])) < 0.1


def test_odd_rows(spark):
    labels = spark.createDataFrame([(3, 0), (6, 1), (7, 1), (8, 1), (None, 1), (5, None)], "doc_id long, quality int")
    model = fit_quality(odd_docs(spark), labels)
    rows = score_quality(odd_docs(spark), model).collect()
    assert len(rows) == 13 and all(0 <= r.quality <= 1 for r in rows)
    assert fit_quality(no_docs(spark), labels) is None
    assert {r.quality for r in score_quality(odd_docs(spark), None).collect()} == {0.5}
    assert score_quality(no_docs(spark), model).count() == 0


def test_against_a_plain_version():
    """Word vectors, pooling, network and temperature, worked out token by token and unit by unit."""
    import math
    import re
    from collections import Counter, defaultdict

    import pyarrow as pa

    from provena.llm import common, quality
    from provena.llm.quality import DIM, HIDDEN, REACH, Model, shape_of

    rng = np.random.default_rng(4)
    good = [" ".join(rng.choice(["river", "plain", "the", "and", "Silt", "spring", "42"], 12)) + "." for _ in range(40)]
    bad = [" ".join(rng.choice(["buy", "now", "the", "!!", "cheap", "99"], 12)) for _ in range(40)]
    texts, labels = good + bad, np.r_[np.ones(40), np.zeros(40)]
    m = Model(pa.array(texts, pa.large_string()), labels)

    def tokens(t):
        return re.findall(r"[A-Za-z\x80-\U0010ffff]+|[0-9]+|[^A-Za-z0-9\s\x80-\U0010ffff]+", t)

    def hashed(w):
        raw = np.frombuffer(w.encode(), np.uint8)
        h, start, end, _, kind = common.class_tokens(raw, np.array([0, len(raw)]))
        assert len(h) == 1
        return h[0], shape_of(raw, start, end, kind)[0]

    low = lambda w: w.translate({c: c + 32 for c in range(65, 91)})
    count = Counter(low(w) for t in texts for w in tokens(t))
    vector = defaultdict(lambda: np.zeros(DIM))
    for t in texts:
        ws = [low(w) for w in tokens(t)]
        for i, w in enumerate(ws):
            for j in range(max(0, i - REACH), min(len(ws), i + REACH + 1)):
                if i != j:
                    vector[w] += quality.index_vectors(np.array([hashed(ws[j])[0]]))[0] / abs(i - j)
    for t in [*texts[::9], "river new words ?? 7", "", " \n"]:
        ws = [low(w) for w in tokens(t)]
        x = np.zeros(DIM + 3)
        for w in ws:
            h, shape = hashed(w)
            x[:DIM] += (vector[w] / np.linalg.norm(vector[w]) if count[w] > 1 else quality.index_vectors(np.array([shape]))[0] / 2) / len(ws)
        if ws:
            x[DIM] = math.log(1 + len(ws))
            x[DIM + 1] = len(set(ws)) / len(ws)
            x[DIM + 2] = math.sqrt(sum(a == b for a, b in zip(ws, ws[1:])) / len(ws))
        one = pa.array([t], pa.large_string())
        assert np.allclose(m.features(one)[0], x, atol=1e-4)
        x = (x - m.mean) / m.scale
        hidden = [max(0.0, sum(x[i] * m.w1[i, j] for i in range(DIM + 3)) + m.b1[j]) for j in range(HIDDEN)]
        z = sum(hidden[j] * m.w2[j] for j in range(HIDDEN)) + m.b2[0]
        assert abs(m.score(one)[0] - 1 / (1 + math.exp(min(700, -z / m.temperature)))) < 1e-3
    assert np.mean((m.score(pa.array(texts, pa.large_string())) > 0.5) == labels) > 0.95
