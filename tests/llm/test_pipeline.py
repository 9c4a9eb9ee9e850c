import corpus_pipeline as P
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from provena.llm.common import stored
from provena.llm.queries import tokenizer_path

from ..conftest import SF_MID
from .cases import DOCS, odd_docs
from .test_jaccard import plain_components


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    bench = [r.text for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    assert [name for name, _ in P.STAGES] == ["toxicity", "quality classifier", "n-gram Jaccard join", "benchmark decontamination",
                                              "BPE encoding and decoding"]
    for k, (_, stage) in enumerate(P.STAGES[:-1]):
        out = stored(stage(spark, docs, SF_MID), "stage-test")
        assert out.columns == docs.columns
        before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        assert all(before[i] == r for i, r in after.items())
        gone = set(before) - set(after)
        if k == 0:
            clean = [i for i in before if i in labels and not labels[i].toxic]
            assert gone and np.mean([i in after for i in clean]) > 0.95
        if k == 1:
            good = [i for i in before if i in labels and labels[i].quality]
            assert gone and np.mean([i in after for i in good]) > 0.95
        if k == 2:
            comp = plain_components([(i, r.text) for i, r in before.items()], 5, 80, 100)
            assert set(after) == {i for i, (_, c) in comp.items() if i == c}
        if k == 3:
            assert {i for i, r in before.items() if any(b in r.text for b in bench)} <= gone
            assert len(gone) < 0.1 * len(before)
        docs = out
    t = Tokenizer.from_file(tokenizer_path())
    text = {r.doc_id: r.text for r in docs.collect()}
    out = P.STAGES[-1][1](spark, docs, SF_MID).collect()
    assert len(out) == len(text)
    for r in out:
        assert np.frombuffer(r.token_ids, "<u4").tolist() == t.encode(text[r.doc_id], add_special_tokens=False).ids


def test_odd_rows(spark):
    """Nulls, clashing names and empty tables go through every stage; no column is lost or replaced."""
    docs = odd_docs(spark)
    for _, stage in P.STAGES[:-1]:
        kept = stored(stage(spark, docs, SF_MID), "stage-test")
        assert kept.schema.names == DOCS.names
        assert kept.where("toxicity <> 'old'").count() == 0
        assert stage(spark, docs.limit(0), SF_MID).count() == 0
    ids = [r.doc_id for r in P.drop_near_copies(spark, docs, SF_MID).where(F.col("doc_id").isNotNull()).collect()]
    assert 7 not in ids and ids.count(6) == 1  # one row of a group stays, also where several share its id
    out = P.tokenise(spark, docs, SF_MID)
    assert out.columns == [*(f"{c}_" if c == "token_ids" else c for c in DOCS.names if c != "text"), "token_ids", "n_tokens", "decoded_sha256"]
    assert out.count() == docs.count() and out.where("token_ids_ <> 'old'").count() == 0
    clash = docs.selectExpr("doc_id", "text", "lang AS decoded", "n AS n_tokens", "Score AS decoded_sha256", "quality AS n_tokens_", "block AS benchmark_items_0")
    for name, stage in P.STAGES[:-1]:
        assert stored(stage(spark, clash, SF_MID), "stage-test").columns == clash.columns, name
    assert P.tokenise(spark, clash, SF_MID).columns == ["doc_id", "decoded", "n_tokens__", "decoded_sha256_", "n_tokens_", "benchmark_items_0", "token_ids",
                                                        "n_tokens", "decoded_sha256"]
    assert P.tokenise(spark, docs.limit(0), SF_MID).count() == 0


def test_near_copies_are_decided_by_row(spark):
    """Of two texts that share an id, only the copy goes; of equal rows without an id, one stays."""
    words = lambda w: " ".join(f"{w}{i}" for i in range(60))
    a, b, c, d = map(words, "abcd")
    rows = [(1, a), (2, b), (2, a + " end"), (3, c), (None, c), (None, a), (None, d), (None, d), (None, d + " end"),
            (None, ""), (None, ""), (None, " \n"), (None, None), (5, b + " end"), (5, "")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, extra int")
    got = P.drop_near_copies(spark, docs, SF_MID)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    without = [x for x in kept if x[0] is None and (x[1] or "").startswith("d")]
    assert len(without) == 1
    assert [x for x in kept if x not in without] == sorted(
        [(1, a), (2, b), (3, c), (None, ""), (None, ""), (None, " \n"), (None, None), (5, "")], key=str)
    again = P.drop_near_copies(spark, docs.unionByName(docs).unionByName(docs), SF_MID)  # rows that are equal in all columns
    assert sorted(((r.doc_id, r.text) for r in again.where(F.col("text").rlike("[a-z]")).collect()), key=str) == [x for x in kept if (x[1] or "").strip()]
