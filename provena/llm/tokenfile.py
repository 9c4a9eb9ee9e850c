"""Token-id output: patched frame-of-reference blocks in binary files.

One file per range of documents.  A file holds the ids of its documents in order, cut into blocks of ``BLOCK`` values:

    magic "PFORIDS1"
    block*   : minimum u32, width u8, zero u8, exceptions u16, packed values, exception places u16*, exception values u32*
    trailer  : block starts u64*, document ids i64* (and a byte each: id present), document sizes u64*
    end      : number of blocks u64, of documents u64, of ids u64, start of the trailer u64, magic

A block stores its values less their minimum, at the width that the ``PERCENTILE`` of them needs; values that need
more bits are exceptions, whose whole offsets stand in the lists behind the block.  Values are packed in columns: lane
j of ``LANES`` has the values j, j + LANES, ..., bit after bit into 32-bit words, so packing works on whole arrays.  The
block starts let a reader go to any id without reading what comes before.

Files are written under a name of the attempt and then moved, so a task that runs twice leaves one whole file.

Defined results: null text counts as empty and gives the end id alone; repeated rows are written each; rows of one
``doc_id`` stand in an order given by their texts; a null ``doc_id`` comes first and is read back as null; an empty
table gives no file with documents and no rows.
"""

from __future__ import annotations

import os
import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import ChunkEncoder, encoder_of, load_tokenizer
from .common import ship, slices, texts_of

MAGIC = b"PFORIDS1"
BLOCK, LANES = 1024, 32
PERCENTILE = 0.98
_HEAD = struct.Struct("<IBBH")
_END = struct.Struct("<QQQQ8s")


# ---- blocks -------------------------------------------------------------------------------------------------

def _pack(v: np.ndarray, width: int) -> np.ndarray:
    """(n, BLOCK) values under 2^width as (n, width * LANES) 32-bit words."""
    n, per = len(v), BLOCK // LANES
    rows = v.reshape(n, per, LANES)
    out = np.zeros((n, width, LANES), np.uint32)
    for i in range(per):
        w, shift = divmod(i * width, 32)
        out[:, w] |= rows[:, i] << np.uint32(shift)
        if shift + width > 32:
            out[:, w + 1] |= rows[:, i] >> np.uint32(32 - shift)
    return out.reshape(n, -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    n, per = len(words), BLOCK // LANES
    rows = words.reshape(n, width, LANES)
    out = np.zeros((n, per, LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(per):
        w, shift = divmod(i * width, 32)
        x = rows[:, w] >> np.uint32(shift)
        if shift + width > 32:
            x = x | (rows[:, w + 1] << np.uint32(32 - shift))
        out[:, i] = x & mask
    return out.reshape(n, BLOCK)


def encode_blocks(values: np.ndarray) -> list[bytes]:
    """Whole blocks (a multiple of BLOCK values, uint32), each as bytes."""
    v = values.reshape(-1, BLOCK)
    low = v.min(axis=1)
    rest = v - low[:, None]
    at = np.partition(rest, int(BLOCK * PERCENTILE) - 1, axis=1)[:, int(BLOCK * PERCENTILE) - 1]
    width = np.ceil(np.log2(at.astype(np.float64) + 1)).astype(np.int64)
    out: list[bytes] = [b""] * len(v)
    for w in np.unique(width).tolist():
        which = np.flatnonzero(width == w)
        part = rest[which]
        over = part >> np.uint32(w) != 0 if w < 32 else np.zeros(part.shape, bool)
        words = _pack(np.where(over, np.uint32(0), part), w) if w else np.zeros((len(part), 0), np.uint32)
        for k, i in enumerate(which.tolist()):
            places = np.flatnonzero(over[k])
            out[i] = (_HEAD.pack(int(low[i]), w, 0, len(places)) + words[k].astype("<u4").tobytes()
                      + places.astype("<u2").tobytes() + part[k, places].astype("<u4").tobytes())
    return out


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The values of the blocks that begin at ``starts`` in ``data``."""
    out = np.zeros((len(starts), BLOCK), np.uint32)
    heads = [_HEAD.unpack_from(data, s) for s in starts.tolist()]
    width = np.array([h[1] for h in heads])
    for w in np.unique(width).tolist():
        which = np.flatnonzero(width == w)
        if w:
            words = np.stack([np.frombuffer(data, "<u4", w * LANES, int(starts[i]) + _HEAD.size) for i in which.tolist()])
            out[which] = _unpack(words, w)
    for i, (low, w, _, n) in enumerate(heads):
        if n:
            p = int(starts[i]) + _HEAD.size + 4 * w * LANES
            out[i, np.frombuffer(data, "<u2", n, p)] = np.frombuffer(data, "<u4", n, p + 2 * n)
        out[i] += np.uint32(low)
    return out.reshape(-1)


# ---- files --------------------------------------------------------------------------------------------------

def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's URI (local, HDFS, S3, GCS) and the path in it."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


class FileWriter:
    """Writes one file; ids come document by document."""

    def __init__(self, folder: str, name: str):
        self.fs, base = store_of(folder)
        self.fs.create_dir(base, recursive=True)
        self.path, self.part = f"{base}/{name}", f"{base}/_{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.part, compression=None)
        self.out.write(MAGIC)
        self.at, self.starts, self.doc, self.there, self.count, self.n = len(MAGIC), [], [], [], [], 0
        self.wait: list[np.ndarray] = []
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc.append(doc_id or 0)
        self.there.append(doc_id is not None)
        self.count.append(len(ids))
        self.n += len(ids)
        self.wait.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 256 * BLOCK:
            self._flush()

    def _flush(self, last: bool = False) -> None:
        v = np.concatenate(self.wait) if self.wait else np.zeros(0, np.uint32)
        if last and len(v) % BLOCK:
            v = np.concatenate([v, np.full(-len(v) % BLOCK, v[-1], np.uint32)])
        whole = len(v) // BLOCK * BLOCK
        for k in range(0, whole, 1024 * BLOCK):
            for b in encode_blocks(v[k:min(whole, k + 1024 * BLOCK)]):
                self.starts.append(self.at)
                self.out.write(b)
                self.at += len(b)
        self.wait, self.waiting = [v[whole:]], len(v) - whole

    def close(self) -> tuple[int, int]:
        self._flush(last=True)
        for values, kind in ((self.starts, "<u8"), (self.doc, "<i8"), (self.there, "u1"), (self.count, "<u8")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(_END.pack(len(self.starts), len(self.doc), self.n, self.at, MAGIC))
        self.out.close()
        self.fs.move(self.part, self.path)
        return len(self.doc), self.n


class FileReader:
    """Random access to the documents of one file."""

    def __init__(self, folder: str, name: str):
        fs, base = store_of(folder)
        self.file = fs.open_input_file(f"{base}/{name}")
        size = self.file.size()
        blocks, docs, self.n, trailer, magic = _END.unpack(self.file.read_at(_END.size, size - _END.size))
        if magic != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{name}: not a token file")
        t = self.file.read_at(size - _END.size - trailer, trailer)
        if len(t) != 8 * blocks + 17 * docs:
            raise ValueError(f"{name}: trailer of {len(t)} bytes for {blocks} blocks and {docs} documents")
        self.starts = np.r_[np.frombuffer(t, "<u8", blocks).astype(np.int64), trailer]
        self.doc = np.frombuffer(t, "<i8", docs, 8 * blocks)
        self.there = np.frombuffer(t, "u1", docs, 8 * blocks + 8 * docs).astype(bool)
        self.count = np.frombuffer(t, "<u8", docs, 8 * blocks + 9 * docs).astype(np.int64)
        self.first = np.cumsum(self.count) - self.count

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids from ``begin`` to ``end``, read from their blocks only."""
        if begin >= end:
            return np.zeros(0, np.uint32)
        a, b = begin // BLOCK, -(-end // BLOCK)
        data = self.file.read_at(int(self.starts[b] - self.starts[a]), int(self.starts[a]))
        return decode_blocks(data, self.starts[a:b] - self.starts[a])[begin - a * BLOCK:end - a * BLOCK]


class LibraryEncoder(ChunkEncoder):
    """Ids by the tokenizers library, each distinct piece between white space once."""

    def __init__(self, spec: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        super().__init__({t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()})
        (self.mark,) = self._ids("\x01")

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many pieces in one call.  The byte 1 as a word of its own stands between two; its token comes from no other
        text, so it marks where the ids of a piece end.  Pieces that hold the byte go alone."""
        out = {c: np.array(self._ids(c), np.uint32) for c in chunks if "\x01" in c}
        rest = [c for c in chunks if c not in out] if out else chunks
        for k in range(0, len(rest), 4096):
            part = rest[k:k + 4096]
            ids = np.array(self._ids(" \x01 ".join(part)), np.uint32)
            cut = np.flatnonzero(ids == self.mark)
            if len(cut) != len(part) - 1:
                raise ValueError("the tokenizer does not keep the pieces apart")
            for c, a, b in zip(part, [0, *(cut + 1).tolist()], [*cut.tolist(), len(ids)]):
                out[c] = ids[a:b]
        found = [out[c] for c in chunks]
        return np.concatenate(found), np.array([len(x) for x in found], np.int64)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


_READY: dict[str, LibraryEncoder] = {}


def _encoder(kind: str, key: str, spec) -> ChunkEncoder:
    if kind == "own":
        return encoder_of(key, spec)
    if key not in _READY:
        _READY[key] = LibraryEncoder(spec.value)
    return _READY[key]


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, files: int | None = None,
                      encoder: str = "own") -> DataFrame:
    """Write the ids of all texts in ascending ``doc_id`` order and return the manifest, a stored table:
    file, base (ids in the files before), n_docs, n_tokens.

    ``files`` defaults to the session's shuffle partitions.  Ranges are cut by (doc_id, hash of the text), so many rows
    of one id still spread over several files.  ``encoder``: "own" is the exact encoder of ``bpe``, whose ids are the
    library's; "library" calls the tokenizers library itself, at 1.7 times the time.
    """
    if encoder not in ("own", "library"):
        raise ValueError(f"encoder {encoder!r}")
    spark = docs.sparkSession
    ship(spark)
    key, spec = load_tokenizer(spark, tokenizer)
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
           .withColumn("tie", F.xxhash64("text"))
           .repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie"))

    def write(batches):
        enc, out = _encoder(encoder, key, spec), None
        name = f"part-{TaskContext.get().partitionId():06d}.pfor"
        end = np.array([end_id], np.uint32)
        for b in slices(batches, "text"):
            out = out or FileWriter(folder, name)
            ids, count = enc.encode_array(texts_of(b, "text"))
            ends = np.cumsum(count)
            for doc, x, y in zip(b.column(0).to_pylist(), (ends - count).tolist(), ends.tolist()):
                out.add(doc, np.concatenate([ids[x:y], end]))
        if out:
            n_docs, n_ids = out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())],
                                             names=["file", "n_docs", "n_tokens"])

    made = src.mapInArrow(write, "file string, n_docs long, n_tokens long")
    path = f"{folder}/_manifest"
    made = made.repartition(1)  # one short row per file
    made.write.mode("overwrite").parquet(path)
    made = spark.read.schema(made.schema).parquet(path)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one short row per file
    return made.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str, batch_ids: int = 1 << 19) -> DataFrame:
    """The documents of the files: doc_id, start (ids of all documents before), n_tokens, token_ids (binary, u32)."""
    spark = manifest.sparkSession
    ship(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches):
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = FileReader(folder, name)
                ends, row = f.first + f.count, 0
                while row < len(f.doc):
                    begin = int(f.first[row])
                    stop = max(row + 1, int(np.searchsorted(ends, begin + batch_ids, side="right")))
                    v = f.ids(begin, int(ends[stop - 1])).astype("<u4")
                    data, off = v.tobytes(), (np.r_[f.first[row:stop], ends[stop - 1]] - begin) * 4
                    ids = [data[x:y] for x, y in zip(off[:-1].tolist(), off[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f.doc[row:stop], pa.int64(), mask=~f.there[row:stop]), pa.array(f.first[row:stop] + base, pa.int64()),
                         pa.array(f.count[row:stop], pa.int64()), pa.array(ids, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "token_ids"])
                    row = stop

    return (manifest.select("file", "base").repartition(n)
            .mapInArrow(read, "doc_id long, start long, n_tokens long, token_ids binary"))


def token_folder(spark: SparkSession) -> str:
    """A fresh shared folder for token files."""
    return scratch_path(spark, "token-files")
