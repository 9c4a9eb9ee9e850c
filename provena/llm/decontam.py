"""Benchmark decontamination: which documents hold a benchmark item, give or take a few edits.

An item of m characters counts as found where a stretch of a document is within k = RATE * m edits of it.  By the
q-gram lemma such a stretch shares at least ``m - q + 1 - k * q`` q-grams with the item, and since k edits move the
diagonal (place in the text less place in the item) by k at most, they all lie in k + 1 neighbouring diagonals.  So:

1. the q-grams of every text are looked up in the items' q-grams;
2. the shared ones are counted by (document, item, band), a band being a range of at least 2k + 2 diagonals; two rows of
   bands overlap by half, so any k + 1 diagonals lie in one band as a whole;
3. regions that reach the item's bound are verified by alignment within the band, which also gives distance and place.

Letters are compared in lower case and any white space as a space, one character for one, so places are those of the
text itself.  The items are the query set: they go to the tasks in blocks of at most about ``BLOCK_CHARS`` characters,
one pass over the documents for each, and a block is all that the driver holds.

Defined results: null and empty texts hold nothing; an item under ``Q`` characters is never found; where RATE * m edits
would leave no q-gram, k is the largest that leaves one; several places of one item in a document are a row each, but of
overlapping ones the nearest (then the first) only; repeated rows and items are reported each; texts of any length are
taken whole; all columns of the input stay, but for one with the name of the new column.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Lookup, add_columns, mix64, stored

Q = 8
RATE = 0.1
BLOCK_CHARS = 4 << 20
_FILTER_BITS = 20
_STEP = 0x9E3779B97F4A7C15


def _plain_table() -> np.ndarray:
    out = np.arange(65536, dtype=np.uint32)
    for c in range(65536):
        if 0xD800 <= c < 0xE000:
            continue
        x = chr(c)
        low = x.lower()
        out[c] = 32 if x.isspace() else ord(low) if len(low) == 1 and ord(low) < 65536 else c
    return out


_PLAIN = _plain_table()
_VALUE = mix64(np.arange(1, 65537, dtype=np.uint64))


def plain(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, folded, and the offsets of the texts."""
    off = np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _PLAIN[np.minimum(code, 65535)]
    return np.where(code > 65535, code, low) if len(code) and code.max() > 65535 else low, off


def grams(code: np.ndarray) -> np.ndarray:
    """Hash of the Q code points that begin at each place (Q = 8: three doublings)."""
    if len(code) < Q:
        return np.zeros(0, np.uint64)
    h = _VALUE[np.minimum(code, 65535)] + (code >> np.uint32(16)).astype(np.uint64)
    size, base = 1, _STEP
    while size < Q:
        h = h[:-size] * np.uint64(base) + h[size:]
        base = base * base % (1 << 64)
        size *= 2
    return h ^ (h >> np.uint64(32))


def budget(m: int) -> int:
    """Edits allowed in an item of m >= Q characters; always leaves one q-gram at least."""
    return max(0, min(int(RATE * m), (m - Q) // Q))


class Items:
    """The q-grams of a block of items, with their places."""

    def __init__(self, ids: list, texts: list[str]):
        keep = [i for i, t in enumerate(texts) if len(t) >= Q]
        self.ids = [ids[i] for i in keep]
        self.code = [plain([texts[i]])[0] for i in keep]
        size = np.array([len(c) for c in self.code], np.int64)
        self.k = np.array([budget(int(m)) for m in size], np.int64)
        self.need = size - Q + 1 - self.k * Q
        self.shift = np.array([max(1, int(2 * k + 1).bit_length()) for k in self.k], np.int64)  # band of 2^shift >= 2k + 2
        self.size = size
        h = np.concatenate([grams(c) for c in self.code]) if keep else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(keep)), np.maximum(size - Q + 1, 0))
        place = np.concatenate([np.arange(m - Q + 1) for m in size]) if keep else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.item, self.place = item[order], place[order]
        unique, self.first = np.unique(h[order], return_index=True)
        self.count = np.diff(np.r_[self.first, len(h)])
        self.at = Lookup(unique)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(unique >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def regions(self, code: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, first and last diagonal) of the bands that reach the bound; diagonals within the text."""
        h = grams(code)
        pos = np.flatnonzero(self.maybe[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        g = self.at.find(h[pos])
        pos, g = pos[g >= 0], g[g >= 0]
        doc = np.searchsorted(off, pos, side="right") - 1
        inside = pos + Q <= off[doc + 1]
        pos, g, doc = pos[inside], g[inside], doc[inside]
        many = self.count[g]
        flat = np.repeat(self.first[g] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        item, place = self.item[flat], self.place[flat]
        doc, pos = np.repeat(doc, many), np.repeat(pos, many)
        diagonal = pos - off[doc] - place + self.size[item]  # from 1: never negative
        out = []
        for half in (0, 1):
            move = half << (self.shift[item] - 1)
            band = (diagonal + move) >> self.shift[item]
            # one number per (text, item, band)
            width = int(band.max()) + 1 if len(band) else 1
            key = (doc * len(self.ids) + item) * width + band
            unique, n = np.unique(key, return_counts=True)
            which = (unique // width) % max(1, len(self.ids))
            good = n >= self.need[which]
            for u, i in zip(unique[good].tolist(), which[good].tolist()):
                b, s = u % width, int(self.shift[i])
                low = (b << s) - (half << (s - 1)) - int(self.size[i])
                out.append((u // width // len(self.ids), i, low, low + (1 << s) - 1))
        return out


#: cells that are aligned at once, and rows after which finished regions are left out
_CELLS, _ROWS = 1 << 18, 16
_ONE = 1 << 40  # an edit; below it stands how far from the text's end the stretch begins, so that of equals it begins late
_FAR = 1 << 60


def align(regions: list[tuple[np.ndarray, np.ndarray, int, int, int]]) -> list[tuple[int, int, int] | None]:
    """For each region (item, text, low, high, k) the nearest stretch of the text to the whole item, by alignment on the
    diagonals from low - k to high + k: (distance, start, end), nothing where it is over k.  Of equals the first end, then
    the last start.  Many regions are aligned at once, one row of all their items at a time."""
    out: list = [None] * len(regions)
    order = sorted(range(len(regions)), key=lambda r: len(regions[r][0]))
    a = 0
    while a < len(order):
        b = a
        width = 0
        while b < len(order):
            _, _, low, high, k = regions[order[b]]
            width = max(width, high - low + 2 * k + 1)
            # the texts of the batch are laid out too, one place for each row and cell
            if b > a and (b + 1 - a) * (width + len(regions[order[b]][0])) > _CELLS:
                break
            b += 1
        _align(regions, order[a:b], out)
        a = b
    return out


def _align(regions: list, which: list[int], out: list) -> None:
    m = np.array([len(regions[r][0]) for r in which])
    n = np.array([len(regions[r][1]) for r in which])
    k = np.array([regions[r][4] for r in which])
    base = np.array([regions[r][2] for r in which]) - k  # row i, cell c: text place base + i + c
    own = np.array([regions[r][3] - regions[r][2] for r in which]) + 2 * k + 1
    width, rows = int(own.max()), int(m.max())
    letters = np.zeros((len(which), rows), np.uint32)
    text = np.full((len(which), rows + width), 0xFFFFFFFF, np.uint32)  # text[c] is the character at base + c
    for x, r in enumerate(which):
        item, t, *_ = regions[r]
        letters[x, :len(item)] = item
        low, high = max(0, int(base[x])), min(len(t), int(base[x]) + rows + width)
        if low < high:
            text[x, low - base[x]:high - base[x]] = t[low:high]
    cells = np.arange(width)
    place = base[:, None] + np.arange(rows + width + 1)
    inside = (place >= 0) & (place <= n[:, None])
    start = place[:, :width]
    row = np.where(inside[:, :width] & (cells < own[:, None]), n[:, None] - start, _FAR)  # an occurrence may begin anywhere
    steps = cells * _ONE
    live = np.arange(len(which))
    for i in range(1, rows + 1):
        new = row + (text[:, i - 1:i - 1 + width] != letters[:, i - 1:i]) * _ONE
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + _ONE)  # a character of the item without one in the text
        new[~inside[:, i:i + width] | (cells >= own[:, None])] = _FAR
        row = np.minimum(np.minimum.accumulate(new - steps, axis=1) + steps, _FAR)  # a character of the text left over
        row[~inside[:, i:i + width] | (cells >= own[:, None])] = _FAR
        done = m[live] == i
        if done.any() or i % _ROWS == 0:
            least = (row >> 40).min(axis=1)
            for x in np.flatnonzero(done & (least <= k[live])).tolist():
                cell = int(np.argmax((row[x] >> 40) == least[x]))
                r = live[x]
                out[which[r]] = (int(least[x]), int(n[r] - (row[x, cell] & (_ONE - 1))), int(base[r] + i + cell))
            stay = ~done & (least <= k[live])
            if not stay.all():
                live, row, text, letters, inside, own = live[stay], row[stay], text[stay], letters[stay], inside[stay], own[stay]
            if not len(live):
                return


def find_items(items: Items, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, distance) of every item found."""
    code, off = plain(texts)
    regions = items.regions(code, off)
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    hits = align([(items.code[i], code[off[d]:off[d + 1]], low, high, int(items.k[i])) for d, i, low, high in regions])
    for (d, i, _, _), hit in zip(regions, hits):
        if hit is not None:
            found.setdefault((d, i), []).append(hit)
    out = []
    for (d, i), places in found.items():
        kept: list[tuple[int, int, int]] = []
        for distance, start, end in sorted(set(places)):
            if all(end <= s or start >= e for _, s, e in kept):
                kept.append((distance, start, end))
        out += [(d, i, start, end, distance) for distance, start, end in sorted(kept, key=lambda x: x[1])]
    return out


def item_blocks(benchmark: DataFrame):
    """The items in blocks of about ``BLOCK_CHARS`` characters, one at a time: (ids, texts)."""
    sized = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    chars = sized.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // BLOCK_CHARS))
    for b in range(blocks):
        rows = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield [r[0] for r in rows], [r[1] for r in rows]


def mark_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "benchmark_items") -> DataFrame:
    """All columns plus ``name``: array of (item_id, start, end in characters, distance in edits).  Each block of items but
    the last is a pass of its own over the documents, whose result is stored before the next block is read, so no task
    and not the driver holds two blocks."""
    spark = docs.sparkSession
    kind = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()),
                                     T.StructField("end", T.LongType()), T.StructField("distance", T.IntegerType())]))
    out = docs.select(*(docs[f"`{c}`"] for c in docs.columns if c.lower() != name.lower()))
    taken = {c.lower() for c in out.columns}
    so_far = next(x for k in range(len(taken) + 1) if (x := f"found_before_{k}") not in taken)
    earlier = None
    for items in item_blocks(benchmark):
        if earlier is not None:
            out = stored(out.withColumnRenamed(name, so_far) if earlier == 1 else
                         out.withColumn(so_far, F.concat(so_far, name)).drop(name), "benchmark-items")
        shared = spark.sparkContext.broadcast(items)

        def fn(index, texts, _):
            found: list[list] = [[] for _ in range(len(texts))]
            for d, i, start, end, distance in find_items(index, texts.to_pylist()) if index.ids else []:
                found[d].append({"item_id": index.ids[i], "start": start, "end": end, "distance": distance})
            return [found]

        out = add_columns(out, text, [T.StructField(name, kind, False)], fn, limit=1 << 20, setup=lambda shared=shared: Items(*shared.value))
        earlier = 1 if earlier is None else 2
    return out if earlier == 1 else out.withColumn(name, F.concat(so_far, name)).drop(so_far)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per item found in a document: doc_id, item_id, start, end (characters), distance (edits)."""
    marked = mark_items(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)
    return marked.select("doc_id", F.explode("benchmark_items").alias("i")).select("doc_id", "i.item_id", "i.start", "i.end", "i.distance")
