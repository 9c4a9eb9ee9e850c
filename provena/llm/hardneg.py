"""Hard negatives from zone-mapped blocks of vectors in Hilbert order.

1. Every row that takes part gets the place of its vector on a Hilbert curve through the ``HILBERT_DIMS`` dimensions that
   spread most (bits per dimension: ``HILBERT_BITS``; the spread is counted over all rows).  Rows are dealt by ranges of
   (place, id) and stored as Parquet blocks of ``BLOCK_ROWS`` rows with a zone map: the least and the largest value of
   each dimension.  Equal vectors share a place; the id in the range key spreads them over tasks.
2. A window is an anchor, a range of scores, and how many rows it wants: ``POSITIVES`` of its own label, or
   ``NEGATIVES`` of the other labels for each positive.  The window's home is the block that its anchor is in, and what it
   finds there gives a score that the last row wanted has at least.
3. Interval arithmetic over a zone map bounds the score of every row of a block from both sides.  A window reads those
   blocks only of which the bounds meet its range and reach that score.  Windows travel in tiles of ``TILE``, and
   zone maps in chunks; each tile meets each chunk, which makes one row for each block and tile that has something to read.
4. The blocks that are to be read are scored exactly, in integers; the best of each window are kept per tile and block
   and then for all.

A stated set of anchors meets all rows, in blocks: nothing is sampled or capped, and the result is exact.  Where the
vectors are spread evenly over many dimensions the bounds of a block reach far, and nearly every block is read.

Defined results: rows with a null label, vector or component, a component that is not finite, or without an id take no
part.  Rows that share an id are rows of their own: each is an anchor, and each can be another's positive or negative.
Vectors of different lengths have no product, and never meet.  An anchor without another row of its label has no
positives, and a window that no row falls into no negatives; both give no rows.  A negative score of a positive gives
an empty window.  Equal scores come by smaller id, then by place of storage.  Other columns of the input aren't read.  A
score beyond 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

BLOCK_ROWS = 2048
TILE = 1024
CHUNK_PARTS = 64
HILBERT_DIMS, HILBERT_BITS = 16, 8
POSITIVES, NEGATIVES = 5, 10
SCALE = 256
EXACT = float(1 << 53)
LONG = (1 << 63) - 1

_ZONE = "block_id long, chunk int, dim int, low binary, high binary"
_BLOCK = f"{_ZONE}, n int, ids binary, labels binary, vectors binary"
#: what a window is made of: the anchor's row, id and label, the positive it is for, its range and the score it has in reach
_PARTS = ("anchor_row", "anchor_id", "anchor_label", "key_row", "key_id", "key_score", "least", "most", "reach")
_TILE = "dim int, m int, points binary, " + ", ".join(f"{p} binary" for p in _PARTS)
_FOUND = ("anchor_row", "anchor_id", "key_row", "key_id", "key_score", "row", "id", "score")


def hilbert(points: np.ndarray, bits: int) -> list[bytes]:
    """The place on the Hilbert curve of each row of small non-negative integers (``bits`` bits each), as bytes that
    compare as the places do."""
    n, d = points.shape
    if not d:
        return [b""] * n
    x = points.astype(np.uint32).copy()
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of the smaller cubes
        low = np.uint32(q - 1)
        for i in range(d):
            on = (x[:, i] & q) > 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low).astype(np.uint32)
            x[:, 0] ^= np.where(on, low, swap).astype(np.uint32)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(n, np.uint32)
    q = top
    while q > 1:
        turn ^= np.where((x[:, d - 1] & q) > 0, q - 1, 0).astype(np.uint32)
        q >>= 1
    x ^= turn[:, None]
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of two tables of int64, as int64: in doubles where these are exact."""
    d = a.shape[1]
    most = d * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if most < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < LONG:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    if exact.size and max(abs(int(exact.max())), abs(int(exact.min()))) > LONG:
        raise ArithmeticError("an inner product does not fit into 64 bits")
    return exact.astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product that a row of ``a`` can have with a vector inside each zone (rows of ``low`` and
    ``high``); infinite where doubles are not exact."""
    most = a.shape[1] * float(np.abs(a).max(initial=0)) * float(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)))
    if most >= EXACT:
        wide = np.full((len(a), len(low)), np.inf)
        return -wide, wide
    up, down = np.maximum(a, 0).astype(np.float64), np.minimum(a, 0).astype(np.float64)
    low, high = low.T.astype(np.float64), high.T.astype(np.float64)
    return up @ low + down @ high, up @ high + down @ low


def _pack(a: np.ndarray) -> bytes:
    """Integers as 32 bits where all fit, else as 64; the length tells which."""
    small = not a.size or max(abs(int(a.max())), abs(int(a.min()))) < 1 << 31
    return np.ascontiguousarray(a, np.int32 if small else np.int64).tobytes()


def _unpack(b: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(b, np.int32 if len(b) == 4 * dim * n else np.int64).astype(np.int64).reshape(n, dim)


def _long(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.int64)


def rows_taking_part(embeddings: DataFrame, label: Column, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, label, v array<long>) of the rows that take part."""
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (embeddings.select(embeddings[ident].cast("long").alias("vec_id"), label.cast("long").alias("label"),
                              embeddings[vector].cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(~odd)
            .withColumn("v", F.transform("v", lambda x: F.floor(F.lit(float(SCALE)) * x))))


def _matrices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors) of a batch, a table for each length of vector."""
    lists = batch.column(column)
    off = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()
    size = np.diff(off)
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        yield at, flat[(off[at][:, None] + np.arange(d)).ravel()].reshape(len(at), d)


def _spread(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length of vector the dimensions that spread most, with their least and largest values, over all rows."""

    def sums(batches):
        for b in batches:
            for _, v in _matrices(b, 0):
                d = v.shape[1]
                x = v.astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)),
                                                  pa.array(np.full(d, len(v), np.int64)), *(pa.array(f(x, axis=0)) for f in (np.sum, np.min, np.max)),
                                                  pa.array((x * x).sum(axis=0))], names=["dim", "i", "n", "s", "low", "high", "ss"])

    got = (rows.select("v").mapInArrow(sums, "dim int, i int, n long, s double, low double, high double, ss double").groupBy("dim", "i")
           .agg(*(F.sum(c).alias(c) for c in ("n", "s", "ss")), F.min("low").alias("low"), F.max("high").alias("high")).toPandas())
    out = {}
    for d, g in got.groupby("dim"):
        g = g.assign(spread=g.ss / g.n - (g.s / g.n) ** 2).sort_values(["spread", "i"], ascending=[False, True]).head(HILBERT_DIMS)
        out[int(d)] = (g.i.to_numpy(np.int64), g.low.to_numpy(), g.high.to_numpy())
    return out


def zone_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows as stored blocks with zone maps, along the Hilbert curve.  A row's number is its block's id times 2^20
    plus its place in the block."""
    spark = rows.sparkSession
    ship(spark)
    rows = stored(rows, "vectors")
    spread = spark.sparkContext.broadcast(_spread(rows))
    parts = max(1, -(-rows.count() // (4 * block_rows)))

    def place(batches):
        for b in batches:
            out: list = [None] * b.num_rows
            for at, v in _matrices(b, 2):
                dims, low, high = spread.value.get(v.shape[1], (np.zeros(0, np.int64), np.zeros(0), np.zeros(0)))
                wide = np.where(high > low, high - low, 1.0)
                x = np.clip((v[:, dims] - low) / wide * ((1 << HILBERT_BITS) - 1), 0, (1 << HILBERT_BITS) - 1).astype(np.int64)
                for i, h in zip(at.tolist(), hilbert(x, HILBERT_BITS)):
                    out[i] = h
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.diff(b.column(2).offsets.to_numpy()).astype(np.int32)), pa.array(out, pa.binary())],
                                             names=["vec_id", "label", "v", "dim", "place"])

    placed = (rows.mapInArrow(place, "vec_id long, label long, v array<long>, dim int, place binary")
              .repartitionByRange(parts, "dim", "place", "vec_id").sortWithinPartitions("dim", "place", "vec_id", "label"))

    def cut(batches):
        part, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []  # (ids, labels, vectors), of one length

        def blocks(keep: int):
            nonlocal made, held
            if not held:
                return
            ids, labels, v = (np.concatenate(x) for x in zip(*held))
            whole = len(ids) if not keep else len(ids) - len(ids) % block_rows
            for a in range(0, whole, block_rows):
                b = min(whole, a + block_rows)
                yield ((part << 20) + made, part // CHUNK_PARTS, v.shape[1], _pack(v[a:b].min(axis=0)), _pack(v[a:b].max(axis=0)), b - a,
                       ids[a:b].tobytes(), labels[a:b].tobytes(), _pack(v[a:b]))
                made += 1
            held = [(ids[whole:], labels[whole:], v[whole:])] if whole < len(ids) else []

        for b in batches:
            ids, labels = (b.column(i).to_numpy().astype(np.int64) for i in (0, 1))
            rows = []
            for at, v in _matrices(b, 2):
                if held and held[0][2].shape[1] != v.shape[1]:
                    rows += blocks(0)
                held.append((ids[at], labels[at], v))
                rows += blocks(1)
            yield from _batches(rows, _BLOCK)
        yield from _batches(list(blocks(0)), _BLOCK)

    return stored(placed.select("vec_id", "label", "v").mapInArrow(cut, _BLOCK), "blocks")


def _batches(rows: list[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of one row each, as a row holds a whole block or tile."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    for r in rows:
        yield pa.RecordBatch.from_arrays([pa.array([x], kinds[k]) for x, (_, k) in zip(r, fields)], names=[f for f, _ in fields])


class Block:
    """A block of rows as it is read."""

    def __init__(self, r: dict):
        self.n, self.dim = r["n"], r["dim"]
        self.ids, self.labels = _long(r["ids"]), _long(r["labels"])
        self.vectors = _unpack(r["vectors"], self.n, self.dim)
        self.rows = (r["block_id"] << 20) + np.arange(self.n)


def hits(points: np.ndarray, w: dict[str, np.ndarray], block: Block, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, row of the block, score) of the best ``k`` rows of a block for each window, in order."""
    score = products(points, block.vectors)
    alike = w["anchor_label"][:, None] == block.labels
    fits = (score >= np.maximum(w["least"], w["reach"])[:, None]) & (score <= w["most"][:, None]) & (alike if same else ~alike)
    fits &= w["anchor_row"][:, None] != block.rows
    i, j = np.nonzero(fits)
    s = score[i, j]
    order = np.lexsort((block.rows[j], block.ids[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    first = np.searchsorted(i, i)
    top = np.arange(len(i)) - first < k
    return i[top], j[top], s[top]


def _reach(points: np.ndarray, w: dict[str, np.ndarray], home: Block, k: int, same: bool) -> np.ndarray:
    """The score that a window's ``k``-th row has at least, as its own block has so many."""
    i, _, s = hits(points, w, home, k, same)
    have = np.bincount(i, minlength=len(points))
    last = np.cumsum(have) - 1
    return np.where(have >= k, s[np.maximum(last, 0)] if len(s) else -LONG, -LONG)


def _tiles(found: Iterable[tuple[int, np.ndarray, dict[str, np.ndarray]]], tile: int) -> Iterator[pa.RecordBatch]:
    """Windows (dim, points, parts) in rows of at most ``tile`` windows."""
    held: list[tuple] = []
    dim = -1

    def rows(keep: bool):
        nonlocal held
        points, w = np.concatenate([p for p, _ in held]), {p: np.concatenate([x[p] for _, x in held]) for p in _PARTS}
        whole = len(points) - len(points) % tile if keep else len(points)
        for a in range(0, whole, tile):
            b = min(whole, a + tile)
            yield (dim, b - a, _pack(points[a:b]), *(w[p][a:b].astype(np.int64).tobytes() for p in _PARTS))
        held = [(points[whole:], {p: w[p][whole:] for p in _PARTS})] if whole < len(points) else []

    for d, points, w in found:
        if held and d != dim:
            yield from _batches(list(rows(False)), _TILE)
        dim = d
        if len(points):
            held.append((points, w))
            yield from _batches(list(rows(True)), _TILE)
    if held:
        yield from _batches(list(rows(False)), _TILE)


def anchor_tiles(blocks: DataFrame, every: int, k: int, tile: int = TILE) -> DataFrame:
    """Tiles of one window for each anchor (id divisible by ``every``) that wants the best ``k`` rows of its label."""

    def run(batches):
        def found():
            for b in batches:
                for r in b.to_pylist():
                    home = Block(r)
                    at = np.flatnonzero(home.ids % every == 0)
                    m = len(at)
                    w = {"anchor_row": home.rows[at], "anchor_id": home.ids[at], "anchor_label": home.labels[at],
                         **{p: np.full(m, -1) for p in ("key_row", "key_id", "key_score")},
                         "least": np.full(m, -LONG), "most": np.full(m, LONG), "reach": np.full(m, -LONG)}
                    if m:
                        w["reach"] = _reach(home.vectors[at], w, home, k, True)
                    yield home.dim, home.vectors[at], w
        yield from _tiles(found(), tile)

    return stored(blocks.mapInArrow(run, _TILE), "tiles")


def negative_tiles(blocks: DataFrame, positives: DataFrame, low: int, high: int, k: int, tile: int = TILE) -> DataFrame:
    """Tiles of one window for each anchor and positive: ``low``/100 to ``high``/100 of the positive's score."""
    parts = ("anchor_row", "key_row", "key_id", "key_score")
    per = (positives.select("anchor_row", F.col("row").alias("key_row"), F.col("id").alias("key_id"), F.col("score").alias("key_score"))
           .groupBy(F.shiftright("anchor_row", 20).alias("block_id")).agg(F.collect_list(F.struct(*parts)).alias("wanted")))

    def run(batches):
        def found():
            for b in batches:
                for r in b.to_pylist():
                    home = Block(r)
                    w = {p: np.array([x[p] for x in r["wanted"]], np.int64) for p in parts}
                    order = np.lexsort((w["key_row"], w["anchor_row"]))
                    w = {p: x[order] for p, x in w.items()}
                    at = w["anchor_row"] & ((1 << 20) - 1)
                    w |= {"anchor_id": home.ids[at], "anchor_label": home.labels[at], "reach": np.full(len(at), -LONG),
                          "least": np.array([-(-low * s // 100) for s in w["key_score"].tolist()], np.int64),
                          "most": np.array([high * s // 100 for s in w["key_score"].tolist()], np.int64)}
                    w["reach"] = _reach(home.vectors[at], w, home, k, False)
                    yield home.dim, home.vectors[at], w
        yield from _tiles(found(), tile)

    return stored(blocks.join(per, "block_id").mapInArrow(run, _TILE), "tiles")


def _windows(r: dict) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    return _unpack(r["points"], r["m"], r["dim"]), {p: _long(r[p]) for p in _PARTS}


def reads(tiles: DataFrame, blocks: DataFrame) -> DataFrame:
    """block_id and the windows of a tile that must read it, by the bounds of its zone map."""
    zone = [f.split()[0] for f in _ZONE.split(", ")]
    zones = blocks.select(*zone).groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("block_id", "dim", "low", "high"))).alias("zones"))
    chunks = blocks.agg(F.coalesce(F.max("chunk"), F.lit(0)).alias("c")).first().c
    schema = f"block_id long, {_TILE}"

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                points, w = _windows(r)
                zones = [z for z in r["zones"] if z["dim"] == r["dim"]]
                if not zones:
                    continue
                low, high = (np.concatenate([_unpack(z[c], 1, r["dim"]) for z in zones]) for c in ("low", "high"))
                least, most = bounds(points, low, high)
                need = (most >= np.maximum(w["least"], w["reach"])[:, None]) & (least <= w["most"][:, None])
                for j in np.flatnonzero(need.any(axis=0)).tolist():
                    at = np.flatnonzero(need[:, j])
                    yield from _batches([(zones[j]["block_id"], r["dim"], len(at), _pack(points[at]), *(w[p][at].tobytes() for p in _PARTS))], schema)

    met = tiles.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks)))).join(zones, "chunk")
    return met.mapInArrow(run, schema)


def best(tiles: DataFrame, blocks: DataFrame, k: int, same: bool) -> DataFrame:
    """The best ``k`` rows of each window over all blocks, with their rank."""
    names = [f.split()[0] for f in _TILE.split(", ")]
    read = reads(tiles, blocks).select("block_id", *(F.col(c).alias(f"t_{c}") for c in names))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block = Block(r)
                points, w = _windows({c: r[f"t_{c}"] for c in names})
                i, j, s = hits(points, w, block, k, same)
                if len(i):
                    cols = [*(w[c][i] for c in _FOUND[:5]), block.rows[j], block.ids[j], s]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(_FOUND))

    found = read.join(blocks, "block_id").mapInArrow(run, ", ".join(f"{c} long" for c in _FOUND))
    order = Window.partitionBy("anchor_row", "key_row").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, label: Column, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = 30, high: int = 90, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (id divisible by
    ``every``) and each of its best ``positives`` rows of the same label, the best ``negatives`` rows of other labels with
    a score of ``low`` to ``high`` hundredths of the positive's."""
    blocks = zone_blocks(rows_taking_part(embeddings, label, ident, vector))
    near = stored(best(anchor_tiles(blocks, every, positives), blocks, positives, True), "positives")
    far = best(negative_tiles(blocks, near, low, high, negatives), blocks, negatives, False)
    return far.select("anchor_id", F.col("key_id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
                      F.col("key_score").alias("positive_score"), F.col("score").alias("negative_score"))
