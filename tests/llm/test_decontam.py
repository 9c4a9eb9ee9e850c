import random

from provena.llm import decontam
from provena.llm.decontam import Items, budget, contamination, find_items, plain

from ..conftest import SF_SMALL
from .cases import PASSAGE, no_docs, odd_docs


def distance(p, t, anywhere=True):
    row = [0 if anywhere else j for j in range(len(t) + 1)]
    for i, c in enumerate(p, 1):
        new = [i]
        for j, e in enumerate(t, 1):
            new.append(min(row[j - 1] + (c != e), row[j] + 1, new[-1] + 1))
        row = new
    return min(row) if anywhere else row[-1]


def changed(rng, s, n):
    s = list(s)
    for _ in range(n):
        p = rng.randrange(len(s))
        s[p:p + rng.choice([0, 1, 1])] = rng.choice([[], ["x"], [" "], ["e", "q"]])
    return "".join(s)


def test_against_full_alignment():
    rng = random.Random(5)
    items = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 160))) for _ in range(8)]
    index = Items(list(range(8)), items)
    low = lambda z: "".join(map(chr, plain([z])[0]))
    for _ in range(60):
        i = rng.randrange(8)
        t = "".join(rng.choice("abcdefgh ") for _ in range(250))
        p = rng.randrange(250)
        t = t[:p] + changed(rng, items[i], rng.randint(0, budget(len(items[i])) + 3)).upper() + t[p:]
        d = distance(low(items[i]), low(t))
        hits = [h for h in find_items(index, ["other", t]) if h[1] == i]
        assert bool(hits) == (d <= index.k[i])
        if hits:
            best = min(hits, key=lambda h: h[4])
            assert best[4] == d and distance(low(items[i]), low(t[best[2]:best[3]]), anywhere=False) == d


def test_table(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = {(d.doc_id, b.item_id) for d in docs.collect() for b in bench.collect() if b.text in d.text}
    one = contamination(docs, bench).collect()
    assert want <= {(r.doc_id, r.item_id) for r in one}
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 2000)  # several blocks of items
    assert sorted(contamination(docs, bench).collect()) == sorted(one)


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, PASSAGE), (2, None), (3, ""), (4, "short"), (1, PASSAGE), (None, PASSAGE)], "item_id long, text string")
    got = contamination(odd_docs(spark), bench).collect()
    # 3 + 3 places in documents 6 and 7, again 3 of the repeated row, one in 8, 3 without id; by three equal items
    assert len(got) == 3 * (3 + 3 + 3 + 1 + 3) and {r.distance for r in got} == {0}
    assert contamination(no_docs(spark), bench).count() == 0
    assert contamination(odd_docs(spark), bench.limit(0)).count() == 0
