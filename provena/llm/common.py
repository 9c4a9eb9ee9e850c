"""Helpers shared by the text operators: shipping the package, Arrow batches cut by size, vectorised words.

A batch function never sees more than about ``SLICE_BYTES`` of text at once unless one text alone is larger, so a
Python worker's memory is bounded by the longest text and not by the number of rows that Spark puts in a batch.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

SLICE_BYTES = 2 << 20
HASH_PIECE = 2 << 20

#: Bounds of a sample that a classifier learns from, next to its number of documents: bytes in all, bytes of a text.
FIT_BYTES, FIT_TEXT_BYTES = 16 << 20, 1 << 20

GATHER = 8

_SHIPPED: set[str] = set()
#: what tasks of one operator keep in a Python worker for its next tasks
CACHES: list[dict] = []
_OWNER = [""]


def claim(owner: str) -> None:
    """Called where a task begins: empties the caches that another operator's tasks have left in this worker, and gives
    the freed memory back to the system (workers are used again, stage after stage)."""
    if _OWNER[0] == owner:
        return
    _OWNER[0] = owner
    for c in CACHES:
        c.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application (a zip of the source, no data)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="provena-src-"), "provena_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "provena")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def stored(df: DataFrame, name: str, scope: list[str] | None = None, small: bool = False) -> DataFrame:
    """Write an intermediate once under the shared checkpoint folder and read it back (survives lost executors).  Its
    path goes into ``scope``, for ``discard`` when nothing reads it any more; without one it stays.  What is ``small``
    next to the input is gathered into ``1 / GATHER`` as many files as the session has shuffle partitions."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    if small:
        df = df.repartition(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // GATHER))
    df.write.parquet(path)
    if scope is not None:
        scope.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, scope: list[str]) -> None:
    """Delete the stored intermediates of a scope."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in scope:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    scope.clear()


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The text column without nulls (null: empty), as string with 64-bit offsets."""
    a = batch.column(batch.schema.get_field_index(column))
    a = a if pa.types.is_large_string(a.type) else a.cast(pa.large_string())
    return pc.fill_null(a, "")


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds at most ``limit`` bytes of text, or one row."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(column))), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        row, n = 0, b.num_rows
        while row < n:
            done = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield b.slice(row, stop - row)
            row = stop


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Cut an array of texts as ``slices`` cuts batches: (place of the first text, texts)."""
    for b in slices([pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), texts], names=["at", "text"])], "text", limit):
        yield b.column(0)[0].as_py(), b.column(1)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a large_string array and the offsets of its texts in them, counted from 0."""
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off - off[0]


def add_columns(df: DataFrame, text: str, fields: list[T.StructField],
                fn: Callable[[pa.Array, pa.RecordBatch], list], limit: int = SLICE_BYTES,
                setup: Callable[[], object] | None = None) -> DataFrame:
    """All columns of ``df`` plus ``fields``; an input column with the name of a new one is replaced.

    ``fn(texts, batch)`` returns one Arrow array (or list) per field; with ``setup`` it gets that result first.
    """
    ship(df.sparkSession)
    new = {f.name.lower() for f in fields}
    keep = [c for c in df.columns if c.lower() not in new or c == text]
    src = df.select(*[df[f"`{c}`"] for c in keep])
    schema = T.StructType([*src.schema.fields, *fields])
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(f.dataType) for f in fields]
    names = schema.names

    owner = f"{fn.__module__}.{fn.__qualname__}"

    def run(batches):
        claim(owner)
        state = setup() if setup else None
        for b in slices(batches, text, limit):
            t = texts_of(b, text)
            cols = fn(state, t, b) if setup else fn(t, b)
            cols = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=names)

    return src.mapInArrow(run, schema)


# ---- 64-bit hashing and words -------------------------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (xor-shift and multiply)."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse modulo 2^64
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLDED = _BYTE[_FOLD]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}
CACHES.append(_POWERS)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^0..B^(n-1) and their inverses modulo 2^64; kept for the next call."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[key] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for every pair, from one running sum; equal spans have equal hashes.  Long rows are
    worked through in pieces of about ``HASH_PIECE`` values (spans in ascending order), which gives the same hashes."""
    if len(values) > HASH_PIECE and len(start) > 1:
        out = np.empty(len(start), np.uint64)
        a = 0
        while a < len(start):
            b = max(a + 1, int(np.searchsorted(start, start[a] + HASH_PIECE)))
            low, high = int(start[a]), int(end[b - 1])
            out[a:b] = _span_hash(values[low:high], start[a:b] - low, end[a:b] - low)
            a = b
        return out
    return _span_hash(values, start, end)


def _span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(len(values) + 1)
    run = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=run[1:])
    h = (run[end] - run[start]) * down[start]
    return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word ``[^\\x20\\x09-\\x0D]+`` and the number of its text."""
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    gap = _SPACE[raw]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    before = cut[:-1].copy()
    before[1:] |= gap[:-1]
    after = cut[1:].copy()
    after[:-1] |= gap[1:]
    start = np.flatnonzero(~gap & before)
    end = np.flatnonzero(~gap & after) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, A-Z folded to a-z, and the number of its text."""
    start, end, doc = word_spans(raw, off)
    return (span_hash(_FOLDED[raw], start, end) if len(raw) else np.zeros(0, np.uint64)), doc


def shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, k: int, rank: np.ndarray | None = None) -> list:
    """Per text the sorted distinct hashes of its k-word shingles; with fewer words, the whole sequence as one.  With a
    ``rank`` for every word, pairs of the hashes and the sum of the ranks of their words."""
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    low = None
    if len(words) >= k:
        n = len(words) - k + 1
        grams = np.zeros(n, np.uint64)
        for j in range(k):
            grams = mix64(grams * np.uint64(0x9FB21C651E98DF25) + words[j:n + j])
        if rank is not None:
            low = rank[:n].copy()
            for j in range(1, k):
                low += rank[j:n + j]
    none = np.zeros(0, np.uint64)
    out = []
    for i in range(n_docs):
        a, b = first[i], first[i + 1]
        if b - a >= k:
            if rank is None:
                out.append(np.unique(grams[a:b - k + 1]))
            else:
                h, at = np.unique(grams[a:b - k + 1], return_index=True)
                out.append((h, low[a:b - k + 1][at]))
        elif b > a:
            h = np.zeros(1, np.uint64)
            for w in words[a:b]:
                h = mix64(h * np.uint64(0x9FB21C651E98DF25) + w)
            h = mix64(h + np.uint64(b - a))
            out.append(h if rank is None else (h, rank[a:b].sum(keepdims=True)))
        else:
            out.append(none if rank is None else (none, none))
    return out


class Lookup:
    """Exact map from uint64 keys to positions in a sorted table: a bucket start per leading bits, then a short probe."""

    def __init__(self, keys: np.ndarray):
        mixed = mix64(keys)
        self.order = np.argsort(mixed, kind="stable")
        self.keys = mixed[self.order]
        self.bits = max(4, int(np.ceil(np.log2(max(2, len(keys))))) + 1)
        self.shift = np.uint64(64 - self.bits)
        self.start = np.searchsorted(self.keys >> self.shift, np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key in the array given at first, or -1."""
        q = mix64(keys)
        out = np.full(len(q), -1, np.int64)
        if not len(self.keys) or not len(q):
            return out
        b = (q >> self.shift).astype(np.int64)
        at, stop = self.start[b], self.start[b + 1]
        live = np.flatnonzero(at < stop)
        at, stop, q = at[live], stop[live], q[live]
        while len(live):
            hit = self.keys[at] == q
            out[live[hit]] = self.order[at[hit]]
            at = at + 1
            go = ~hit & (at < stop)
            live, at, stop, q = live[go], at[go], stop[go], q[go]
        return out




def byte_hashes(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """64-bit hash of each text, byte by byte."""
    return span_hash(_BYTE[raw], off[:-1], off[1:]) if len(off) > 1 else np.zeros(0, np.uint64)


def same_bytes(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether a[a_at:a_at + size] and b[b_at:b_at + size] are equal, for every triple."""
    ok = np.ones(len(size), bool)
    live = np.flatnonzero(size > 0)
    x, y, left = a_at[live], b_at[live], size[live]
    while len(live):
        same = a[x] == b[y]
        ok[live[~same]] = False
        same &= left > 1
        live, x, y, left = live[same], x[same] + 1, y[same] + 1, left[same] - 1
    return ok


#: byte classes: 0 white space and control, 1 letters (and all of UTF-8's multi-byte characters), 2 digits, 3 other marks
_CLASS = np.full(256, 1, np.uint8)
_CLASS[:33] = 0
_CLASS[127] = 0
_CLASS[33:48] = _CLASS[58:65] = _CLASS[91:97] = _CLASS[123:127] = 3
_CLASS[48:58] = 2


def class_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text number and class of every run of bytes of one class (white space left out)."""
    kind = _CLASS[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[off] = True
    cut[1:-1] |= kind[1:] != kind[:-1]
    edge = np.flatnonzero(cut)
    start, end = edge[:-1], edge[1:]
    k = kind[start] if len(start) else kind[:0]
    solid = k > 0
    start, end = start[solid], end[solid]
    return start, end, np.searchsorted(off, start, side="right") - 1, k[solid]


def class_tokens(raw: np.ndarray, off: np.ndarray):
    """(hash, start, end, text number, class) of every run, A-Z folded."""
    start, end, doc, kind = class_spans(raw, off)
    h = span_hash(_FOLDED[raw], start, end) if len(start) else np.zeros(0, np.uint64)
    return h, start, end, doc, kind


def training_rows(labels: DataFrame, fold: int = 5) -> DataFrame:
    """The label rows that models may learn from: crc32 of the id as text does not divide by ``fold``."""
    return labels.where(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % fold != 0)


def fit_on_sample(docs: DataFrame, labels: DataFrame, label: str, n: int, fit: Callable[[pa.Array, np.ndarray], object]):
    """``fit(texts, labels)`` on at most ``n`` labelled documents and ``FIT_BYTES`` of text, in the order of a hash of
    their ids, in one task; returns what it returns.  Texts above ``FIT_TEXT_BYTES`` are not learnt from.  Of several texts of
    an id the least is taken, of several labels the greatest.  The bounds hold for the task, the model and what comes to
    the driver."""
    import pickle
    spark = docs.sparkSession
    ship(spark)
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
             .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    text = F.coalesce("text", F.lit(""))
    rows = (docs.select("doc_id", text.alias("text")).where(F.octet_length("text") <= FIT_TEXT_BYTES).join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")).withColumn("place", F.xxhash64("doc_id"))
            .repartition(1).sortWithinPartitions("place", "doc_id").select("text", "label"))
    limit, owner = FIT_BYTES, f"{fit.__module__}.{fit.__qualname__}"

    def run(batches):
        claim(owner)
        texts, known, left = [], [], limit
        for b in batches:
            t = texts_of(b, "text")
            size = np.cumsum(pc.binary_length(t).to_numpy(zero_copy_only=False).astype(np.int64))
            fits = int(np.searchsorted(size, left, side="right"))
            left = left - int(size[-1]) if fits == len(size) else -1
            texts.append(t.slice(0, fits))
            known.append(b.column(1).to_numpy()[:fits])
        if any(map(len, texts)):
            model = fit(pa.chunked_array(texts, pa.large_string()).combine_chunks(), np.concatenate(known))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    got = rows.mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0][0]) if got else None
