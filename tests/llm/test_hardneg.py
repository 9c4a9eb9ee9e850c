import numpy as np
import pytest
from pyspark.sql import functions as F

from provena.llm import hardneg
from provena.llm.hardneg import bounds, hard_negatives, hilbert, products
from provena.llm.queries import op12_hard_negatives

from ..conftest import SF_MID


def plain(rows, every=100, positives=5, negatives=10, low=30, high=90):
    """The contract by comparing each anchor with every row: rows of (id, label, list of integers)."""
    out = []
    for a, (i, la, va) in enumerate(rows):
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(va, v)), j, lab, b) for b, (j, lab, v) in enumerate(rows) if b != a and len(v) == len(va)]
        for s, j, lab, _ in sorted(x for x in scored if x[2] == la)[:positives]:
            fit = sorted((t, n) for t, n, m, _ in scored if m != la and low * -s <= 100 * -t <= high * -s)[:negatives]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n) in enumerate(fit)]
    return sorted(out)


def small(rng, n, dims):
    """Rows with copies, ties, few labels and small vectors."""
    v = rng.integers(-9, 10, (n, dims)) / 16
    v[rng.integers(0, n, n // 3)] = v[0]
    return [(int(i), int(x), [float(y) for y in w]) for i, x, w in zip(rng.permutation(n), rng.integers(0, 3, n), v)]


def whole(rows):
    return [(i, lab, [int(np.floor(256 * x)) for x in v]) for i, lab, v in rows]


@pytest.mark.parametrize("dims,block,tile", [(1, 8, 5), (3, 16, 7), (20, 2048, 1024)])
def test_against_all_pairs(spark, monkeypatch, dims, block, tile):
    monkeypatch.setattr(hardneg, "CHUNK_PARTS", 2)
    monkeypatch.setattr(hardneg.zone_blocks, "__defaults__", (block,))
    for f in (hardneg.anchor_tiles, hardneg.negative_tiles):
        monkeypatch.setattr(f, "__defaults__", (tile,))
    rows = small(np.random.default_rng(dims), 300, dims)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = hard_negatives(df, F.col("label"), every=10).collect()
    assert sorted(map(tuple, got)) == plain(whole(rows), every=10)


def test_query(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    got = op12_hard_negatives(spark, SF_MID)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain(whole(rows))


def test_hilbert_is_a_walk_over_all_places():
    """Neighbours on the curve differ by one in one dimension, and every place comes once."""
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        every = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        keys = hilbert(every, bits)
        assert len(set(keys)) == len(every)
        walk = every[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_and_products():
    rng = np.random.default_rng(2)
    for size in (10, 1 << 20, 1 << 28):
        v, a = rng.integers(-size, size, (40, 9)), rng.integers(-size, size, (7, 9))
        exact = a.astype(object) @ v.T.astype(object)
        assert (products(a, v) == exact).all()
        low, high = bounds(a, v.min(axis=0, keepdims=True), v.max(axis=0, keepdims=True))
        assert (low <= exact.min(axis=1, keepdims=True)).all() and (high >= exact.max(axis=1, keepdims=True)).all()
    with pytest.raises(ArithmeticError):
        products(np.full((1, 9), 1 << 40), np.full((1, 9), 1 << 40))


def test_blocks_are_skipped(spark):
    """Two far groups: the zone maps keep the windows of one from the blocks of the other."""
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, [float(x) for x in rng.normal(0, 0.01, 4) + (1 if i < 200 else -1)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    blocks = hardneg.zone_blocks(hardneg.rows_taking_part(df, F.col("label")), 40)
    tiles = hardneg.anchor_tiles(blocks, 10, 5, tile=8)
    read = hardneg.reads(tiles, blocks).agg(F.sum("m")).first()[0]
    assert read < 0.7 * 40 * blocks.count()  # windows and the blocks they read
    assert sorted(map(tuple, hard_negatives(df, F.col("label"), every=10).collect())) == plain(whole(rows), every=10)


def test_odd_rows(spark):
    schema = "vec_id long, label int, embedding array<float>, rank string, score int, dim int"
    nan, inf = float("nan"), float("inf")
    v = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.5, 0.5]), (3, 2, [0.5, 0.5]), (2, 2, [0.5, 0.5]),
         (4, None, [1.0, 1.0]), (5, 2, None), (6, 2, [None, 1.0]), (7, 2, [nan, 1.0]), (8, 2, [inf, 1.0]), (None, 2, [0.5, 0.5]),
         (9, 2, [0.5]), (10, 2, [0.5, 0.5, 0.5]), (11, 2, []), (100, 2, []), (200, 3, [-1.0, 0.0]), (300, 3, [-0.9, 0.0]), (12, 2, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in v], schema)
    good = [r for r in v if r[0] is not None and r[1] is not None and r[2] is not None
            and all(x is not None and np.isfinite(x) for x in r[2])]
    good = [(i, lab, [float(np.float32(x)) for x in w]) for i, lab, w in good]
    got = hard_negatives(df, F.col("label")).collect()
    assert sorted(map(tuple, got)) == plain(whole(good)) and len(got) == 12
    assert hard_negatives(df.limit(0), F.col("label")).count() == 0
    assert hard_negatives(df.where("vec_id = 1"), F.col("label")).count() == 0
