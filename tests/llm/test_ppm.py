import collections
import math
import zlib

import pytest
from pyspark.sql import functions as F

from provena.llm import ppm
from provena.llm.ppm import ESCAPE, ORDER, ppm_score
from provena.llm.queries import op7_ppm

from ..conftest import SF_SMALL
from .cases import no_docs, odd_docs

FOLD = bytes([c + 32 if 65 <= c <= 90 else c for c in range(256)])


def words(text):
    return (text or "").encode().translate(FOLD).split()


class Plain:
    """The model by its definition, one byte at a time."""

    def __init__(self, texts):
        self.c = collections.Counter(w for t in texts for w in words(t))
        self.c["end"] = len(texts)
        self.c = +self.c
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.ctx = collections.defaultdict(collections.Counter)
        for t in texts:
            s = b"\n" * ORDER + b" ".join(words(t)) + b"\n"
            for p in range(ORDER, len(s)):
                for j in range(ORDER + 1):
                    self.ctx[s[p - j:p]][s[p]] += 1

    def base(self, text):
        return sum(math.log10((self.c[w] + 1) / (self.n + self.v + 1)) for w in [*words(text), "end"])

    def score(self, text):
        s, total = b"\n" * ORDER + b" ".join(words(text)) + b"\n", 0.0
        for p in range(ORDER, len(s)):
            out = set()
            for j in range(ORDER, -1, -1):
                new = {x: n for x, n in self.ctx.get(s[p - j:p], {}).items() if x not in out}
                if not new:
                    continue
                t = sum(new.values())
                if s[p] in new:
                    total += math.log10((new[s[p]] - ESCAPE) / t)
                    break
                total += math.log10(ESCAPE * len(new) / t)
                out |= set(new)
            else:
                total += math.log10(1 / max(1, 256 - len(self.ctx.get(b"", {}))))
        return total


def close(rows, texts, held):
    model = Plain([t for t, h in zip(texts, held) if not h])
    for r, t, h in zip(rows, texts, held):
        assert r.held_out == h and r.train_tokens == model.n and r.n_tokens == len(words(t)) + 1
        assert r.n_known == sum(model.c[w] > 0 for w in [*words(t), "end"])
        assert r.base_score == pytest.approx(model.base(t), rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(model.score(t), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("part_runs", [1 << 20, 0, 30])
def test_query(spark, monkeypatch, part_runs):
    monkeypatch.setattr(ppm, "BLOCK_ROWS", 64)  # several blocks
    monkeypatch.setattr(ppm, "PART_RUNS", part_runs)  # whole parts, all of them cut, the larger ones cut
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").limit(60).collect()
    short = [(r.doc_id, r.text[:600]) for r in docs]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in short]
    rows = ppm_score(spark.createDataFrame([(i, t, h) for (i, t), h in zip(short, held)], "doc_id long, text string, held boolean"))
    close(rows.orderBy("doc_id").collect(), [t for _, t in short], held)
    got = op7_ppm(spark, SF_SMALL).collect()
    assert len(got) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumn("held", F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False)))
    rows = docs.select("doc_id", "text", "held").collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    pairs = sorted(zip([(r.doc_id, r.text, r.held) for r in rows], rows), key=lambda x: (key(x[0]), len(words(x[0][1]))))
    got = sorted(ppm_score(docs).collect(), key=lambda r: ((r.doc_id is None, r.doc_id or 0), r.n_tokens))
    close(got, [p[0][1] for p in pairs], [p[0][2] for p in pairs])
    assert ppm_score(no_docs(spark).withColumn("held", F.lit(False))).count() == 0
    alone = ppm_score(docs.where("doc_id = 3").withColumn("held", F.lit(True))).first()  # nothing to learn from
    assert alone.train_tokens == 0 and alone.base_score == 0.0 and alone.score == pytest.approx(2 * math.log10(1 / 256))


def test_blocks_that_several_tasks_read(spark, tmp_path):
    """A file whose row groups are read by different tasks: a word of a block is still one word of the vocabulary."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    texts = [f"river {w} plain {w}{i % 3} silt" for i, w in enumerate("stone mud reed fish boat stone mud reed fish boat".split() * 4)]
    held = [i % 7 == 2 for i in range(len(texts))]
    pq.write_table(pa.table({"doc_id": list(range(len(texts))), "text": texts, "held": held}), tmp_path / "docs.parquet", row_group_size=5)
    keys = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        docs = spark.read.parquet(str(tmp_path))
        assert docs.rdd.getNumPartitions() > 4
        close(ppm_score(docs).orderBy("doc_id").collect(), texts, held)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
