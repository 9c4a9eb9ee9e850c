"""Ranked lexical search that scores each distinct bag of words once.

1. Items go block by block (``ITEM_CHARS`` characters at a time; a block is all that the driver holds).  The terms of a
   block's items are its vocabulary, and each document is restricted to it: the terms it holds, with how often.
2. Documents with the same restricted vector and the same length norm ``m`` score alike for every item: they are a class.
   Vectors are told apart by a hash first and by their bytes then.  Of a class, the ``k`` documents with the smallest ids
   stand for all, as no other can be among the first ``k`` of an item; they are found by a window with a limit, which
   cuts each task's share before the shuffle, so that a class of a third of all documents is no burden.
3. A class is scored against all items of the block at once, in integers: terms of many items as a product of matrices,
   the others through the list of their items.  Each task keeps the best ``k`` classes of each item; the best of all tasks
   are expanded to their members, in ascending id.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z are lower-cased, nothing else is.
Counts (documents with a term, terms, documents that hold a term) cover the whole table.

Defined results: null text has no terms; a document without terms counts nowhere.  Rows that share an id are documents of
their own; a document without an id counts, and comes after all ids where scores are equal.  Rows of the item table with the same
id and text are one item; different texts of one id are ranked each by itself.  An item without terms, or whose terms no
document holds, has no rows.  Other columns of either table aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Lookup, buffer_of, same_bytes, ship, slices, span_hash, stored, texts_of

ITEM_CHARS = 1 << 20
DENSE_TERMS = 512
CELLS = 1 << 21  # of a score matrix
EXACT = float(1 << 53)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = True
_TERM[128:] = True


def term_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every term, and the number of its text."""
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = _TERM[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[off] = True
    before = cut[:-1].copy()
    before[1:] |= ~inside[:-1]
    after = cut[1:].copy()
    after[:-1] |= ~inside[1:]
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


class Vocabulary:
    """The terms of a block of items, found in text by hash and told apart by their bytes."""

    def __init__(self, terms: list[bytes]):
        self.size = len(terms)
        self.length = np.array([len(t) for t in terms], np.int64)
        self.start = np.r_[0, np.cumsum(self.length)]
        self.raw = np.frombuffer(b"".join(terms), np.uint8)
        self.at = Lookup(span_hash(_value(self.raw), self.start[:-1], self.start[1:]) if terms else np.zeros(0, np.uint64))

    def find(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each term of a (folded) text, or -1."""
        out = self.at.find(span_hash(_value(raw), start, end)) if len(start) else np.zeros(0, np.int64)
        live = np.flatnonzero(out >= 0)
        out[live[end[live] - start[live] != self.length[out[live]]]] = -1
        live = live[out[live] >= 0]
        same = same_bytes(raw, start[live], self.raw, self.start[out[live]], end[live] - start[live])
        out[live[~same]] = -1
        return out


def _value(raw: np.ndarray) -> np.ndarray:
    return raw.astype(np.uint64) + np.uint64(1)


class Items:
    """A block of items: (item_id, text) and, by term, the items that hold it and how often."""

    def __init__(self, rows: list[tuple]):
        self.ids = [i for i, _ in rows]
        raw, off = buffer_of(pa.array([t or "" for _, t in rows], pa.large_string()))
        raw = _FOLD[raw]
        start, end, item = term_spans(raw, off)
        body = raw.tobytes()
        numbers: dict[bytes, int] = {}
        term = np.array([numbers.setdefault(body[a:b], len(numbers)) for a, b in zip(start.tolist(), end.tolist())], np.int64)
        self.terms = list(numbers)
        pair, times = np.unique(term * max(1, len(rows)) + item, return_counts=True)
        self.term, self.item, self.times = pair // max(1, len(rows)), pair % max(1, len(rows)), times
        self.first = np.searchsorted(self.term, np.arange(len(numbers) + 1))


def item_blocks(items: DataFrame, limit: int = ITEM_CHARS) -> Iterator[list[tuple]]:
    """Distinct (item_id, text) in blocks of at most ``limit`` characters, or one item."""
    rows, size = [], 0
    for r in items.select("item_id", "text").distinct().toLocalIterator():
        n = len(r.text or "")
        if rows and size + n > limit:
            yield rows
            rows, size = [], 0
        rows.append((r.item_id, r.text))
        size += n + 1
    if rows:
        yield rows


def pack(ids: np.ndarray, times: np.ndarray, size: int) -> bytes:
    """A vector as bytes, the same for equal vectors: numbers in ascending order, counts of one byte, larger counts."""
    large = times[times >= 255].astype(np.uint32)
    return ids.astype(np.uint16 if size <= 1 << 16 else np.uint32).tobytes() + np.minimum(times, 255).astype(np.uint8).tobytes() + large.tobytes()


def unpack(body: bytes, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    kind = np.dtype(np.uint16 if size <= 1 << 16 else np.uint32)
    ids = np.frombuffer(body, kind, n).astype(np.int64)
    times = np.frombuffer(body, np.uint8, n, n * kind.itemsize).astype(np.int64)
    large = times == 255
    if large.any():
        times[large] = np.frombuffer(body, np.uint32, offset=n * (kind.itemsize + 1))
    return ids, times


def bags(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n (terms of the document, repeats counted), held (terms of the vocabulary that it holds), bag (binary), bag_hash."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        vocab = shared.value
        for b in slices(batches, "text"):
            raw, off = buffer_of(texts_of(b, "text"))
            raw = _FOLD[raw]
            start, end, doc = term_spans(raw, off)
            n = np.bincount(doc, minlength=b.num_rows)
            term = vocab.find(raw, start, end)
            on = term >= 0
            pair, times = np.unique(doc[on] * max(1, vocab.size) + term[on], return_counts=True)
            doc, term = pair // max(1, vocab.size), pair % max(1, vocab.size)
            first = np.searchsorted(doc, np.arange(b.num_rows + 1))
            body = [pack(term[x:y], times[x:y], vocab.size) for x, y in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(np.diff(first), pa.int64()), pa.array(body, pa.binary())],
                                             names=["doc_id", "n", "held", "bag"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, held long, bag binary")
            .withColumn("bag_hash", F.xxhash64("bag")))


def document_counts(held: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""

    def run(batches):
        df = np.zeros(size, np.int64)
        for b in batches:
            for n, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                df[unpack(body, n, size)[0]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["term", "df"])

    got = held.select("held", "bag").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[got["term"].to_numpy()] = got["df"].to_numpy()
    return out


class Scorer:
    """Scores of bags against a block of items, in whole numbers."""

    def __init__(self, items: Items, weight: np.ndarray):
        self.n, self.size, self.weight = len(items.ids), len(items.terms), weight
        most = np.bincount(items.item, weights=items.times * weight[items.term], minlength=self.n).max(initial=0) * 1e6
        self.kind = np.float64 if most < EXACT else np.int64
        per = np.diff(items.first)
        dense = np.sort(np.argsort(-per, kind="stable")[:DENSE_TERMS])
        self.column = np.full(self.size, -1)
        self.column[dense] = np.arange(len(dense))
        self.table = np.zeros((len(dense), self.n), self.kind)
        on = self.column[items.term] >= 0
        self.table[self.column[items.term[on]], items.item[on]] = items.times[on]
        self.first, self.per, self.item, self.times = items.first, per, items.item, items.times

    def scores(self, bodies: list[tuple[int, bytes]], m: np.ndarray) -> np.ndarray:
        """(bags x items)"""
        parts = [unpack(body, n, self.size) for n, body in bodies]
        row = np.repeat(np.arange(len(parts)), [len(i) for i, _ in parts])
        term, tf = (np.concatenate(x) for x in zip(*parts))
        value = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        dense = self.column[term] >= 0
        left = np.zeros((len(parts), len(self.table)), self.kind)
        left[row[dense], self.column[term[dense]]] = value[dense]
        out = left @ self.table
        row, term, value = row[~dense], term[~dense], value[~dense]
        many = self.per[term]
        at = np.repeat(self.first[term] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum()) if len(term) else np.zeros(0, np.int64)
        np.add.at(out, (np.repeat(row, many), self.item[at]), (np.repeat(value, many) * self.times[at]).astype(self.kind))
        return out.astype(np.int64)


def best_classes(classes: DataFrame, scorer: Scorer, k: int) -> DataFrame:
    """(item, score, members): the best ``k`` classes of each item, by score and smallest id, of each task."""
    shared = classes.sparkSession.sparkContext.broadcast(scorer)

    def run(batches):
        s = shared.value
        step = max(1, CELLS // max(1, s.n))
        best = [np.zeros(0, np.int64)] * 3  # item, score, place in members
        members: list = []
        floor = np.ones(s.n, np.int64)
        for b in batches:
            for a in range(0, b.num_rows, step):
                part = b.slice(a, step)
                got = s.scores(list(zip(part.column(1).to_pylist(), part.column(2).to_pylist())), part.column(0).to_numpy())
                if len(got) > k:
                    floor = np.maximum(floor, np.partition(got, len(got) - k, axis=0)[len(got) - k])
                c, i = np.nonzero(got >= floor)
                item, score, place = (np.concatenate(x) for x in zip(best, (i, got[c, i], len(members) + c)))
                members += part.column(3).to_pylist()
                low = np.array([(m[0] is None, m[0] or 0) for m in (members[p] for p in place.tolist())], np.int64).reshape(-1, 2)
                order = np.lexsort((low[:, 1], low[:, 0], -score, item))
                item, score, place = item[order], score[order], place[order]
                top = np.arange(len(item)) - np.searchsorted(item, item) < k
                used, place = np.unique(place[top], return_inverse=True)
                members = [members[p] for p in used.tolist()]
                best = [item[top], score[top], place]
                last = np.bincount(best[0], minlength=s.n) == k
                floor[last] = np.maximum(floor[last], best[1][np.searchsorted(best[0], np.flatnonzero(last), side="right") - 1])
        yield pa.RecordBatch.from_arrays([pa.array(best[0], pa.int64()), pa.array(best[1], pa.int64()),
                                          pa.array([members[p] for p in best[2].tolist()], pa.list_(pa.int64()))], names=["item", "score", "members"])

    return classes.select("m", "held", "bag", "members").mapInArrow(run, "item long, score long, members array<long>")


def _first(df: DataFrame, by: str, ident: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.col(ident).asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, limit: int = ITEM_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents (doc_id, text) of the highest score above 0 of each item
    (item_id, text), equal scores by ascending doc_id."""
    spark = docs.sparkSession
    ship(spark)
    out = spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    for rows in item_blocks(items, limit):
        block = Items(rows)
        found = stored(bags(docs, Vocabulary(block.terms)), "bags")
        total = found.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if not total.docs or not block.terms:
            continue
        held = found.where("held > 0")
        df = document_counts(held, len(block.terms))
        weight = np.floor(1000 * np.log((2 * total.docs + 2) / (2 * df + 1))).astype(np.int64)
        norm = F.expr(f"25 + CAST(CAST(75 * n AS DECIMAL(19,0)) * CAST({total.docs} AS DECIMAL(19,0)) div CAST({total.terms} AS DECIMAL(19,0)) AS BIGINT)")
        key = ("bag_hash", "m", "held", "bag")
        members = (held.withColumn("m", norm).withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(F.col("doc_id").asc_nulls_last())))
                   .where(F.col("place") <= k))
        # an array leaves nulls out: a document without an id is put back as a null member
        classes = members.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "doc_id"))), lambda x: x["doc_id"]).alias("members"))
        top = _first(best_classes(classes, Scorer(block, weight), k).withColumn("low", F.col("members")[0]), "item", "low", k)
        ranked = _first(top.select("item", "score", F.explode("members").alias("doc_id")), "item", "doc_id", k)
        names = spark.createDataFrame([(n, i) for n, i in enumerate(block.ids)], f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        out = out.unionByName(stored(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
    return out
