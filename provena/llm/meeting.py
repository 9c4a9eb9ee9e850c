"""Which keys of a table occur in more than one row, told to the rows that have them, without moving the keys themselves.

Most keys of a large table of hashes occur once, and only the others are of use.  Rows are dealt into blocks (a file's name
and a stretch of ``BLOCK_ROWS`` rows of it).  Each block lists the leading bits of its keys, once each, cut by their first
bits into buckets, as short byte strings (differences of sorted numbers, packed).  A bucket's lists meet in one task, which
sends every block back the ones that another block has too, or that the block itself has in several rows.  So a key
costs some three bytes on its way and no more than one entry a block, however many rows hold it.

Two keys with the same leading bits count as one: what passes is all keys that occur twice, and a few that do not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import claim, ship
from .tokenfile import store_of

BLOCK_ROWS = 16_384
#: keys that meet in a bucket, about
BUCKET_KEYS = 1 << 22


def pack(v: np.ndarray) -> bytes:
    """Sorted uint32 as bytes."""
    step = np.diff(v, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(step.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(body: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body, max_output_size=4 * n or 1), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel(), dtype=np.uint32)


def _blocks(batches, columns: int):
    """(block, parts) of batches whose last column is the block; parts are slices of batches."""
    block, parts = None, []
    for b in batches:
        blocks = b.column(columns).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1], True])
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if y <= x:
                continue
            if blocks[x] != block:
                if parts:
                    yield block, parts
                block, parts = int(blocks[x]), []
            parts.append(b.slice(x, y - x))
    if parts:
        yield block, parts


def _keys(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(owner, key) of every key of a slice (columns owner, keys, block)."""
    lists = part.column(1)
    size = np.diff(lists.offsets.to_numpy())
    return np.repeat(part.column(0).to_numpy(zero_copy_only=False), size), lists.flatten().to_numpy().view(np.uint64)


def meeting_keys(rows: DataFrame, owner: str, keys: str, scope: list[str] | None = None) -> DataFrame:
    """(owner, key): the keys (array of long) of rows read from files, of those keys that more than one owner (long) has."""
    spark = rows.sparkSession
    ship(spark)
    block = F.xxhash64(F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / BLOCK_ROWS))
    src = rows.select(F.col(owner).alias("owner"), F.col(keys).alias("keys"), block.alias("block")).where("owner IS NOT NULL AND keys IS NOT NULL")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = src.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    bits = max(n, total // BUCKET_KEYS, 2).bit_length()

    def list_blocks(batches):
        claim("meeting")
        for at, parts in _blocks(batches, 2):
            who, key = (np.concatenate(x) for x in zip(*map(_keys, parts)))
            key = key >> np.uint64(32 - bits)
            order = np.lexsort((who, key))
            who, key = who[order], key[order]
            new = np.r_[True, key[1:] != key[:-1]]
            several = np.zeros(int(new.sum()), bool)  # another owner has the key right behind
            other = ~new & np.r_[False, who[1:] != who[:-1]]
            several[np.cumsum(new)[other] - 1] = True
            key = key[new]
            bucket = (key >> np.uint64(32)).astype(np.int64)
            edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            v = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            cut = list(zip(edge[:-1].tolist(), edge[1:].tolist())) if len(key) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(bucket[a]) for a, _ in cut], pa.int32()), pa.array([at] * len(cut), pa.int64()), pa.array([b - a for a, b in cut], pa.int32()),
                 pa.array([pack(v[a:b]) for a, b in cut], pa.binary()), pa.array([np.packbits(several[a:b]).tobytes() for a, b in cut], pa.binary())],
                names=["bucket", "block", "n", "body", "several"])

    def meet(batches):
        claim("meeting")
        held: list[tuple] = []

        def close():
            v = np.concatenate([x[1] for x in held])
            row = np.repeat(np.arange(len(held)), [len(x[1]) for x in held])
            keep = np.concatenate([x[2] for x in held])
            order = np.argsort(v, kind="stable")
            same = v[order][1:] == v[order][:-1]
            keep[order[1:][same]] = True
            keep[order[:-1][same]] = True
            v, row = v[keep], row[keep]
            ends = np.searchsorted(row, np.arange(len(held) + 1))
            out = [(x[0], x[3], v[a:b]) for x, a, b in zip(held, ends[:-1].tolist(), ends[1:].tolist()) if b > a]
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                                               pa.array([len(o[2]) for o in out], pa.int32()), pa.array([pack(o[2]) for o in out], pa.binary())],
                                              names=["block", "bucket", "n", "body"])

        bucket = None
        for b in batches:
            for k, at, m, body, several in zip(*(b.column(i).to_pylist() for i in range(5))):
                if k != bucket and held:
                    yield close()
                    held = []
                bucket = k
                held.append((at, unpack(body, m), np.unpackbits(np.frombuffer(several, np.uint8), count=m).astype(bool), k))
        if held:
            yield close()

    folder = scratch_path(spark, "llm-meeting")
    if scope is not None:
        scope.append(folder)
    lists = src.mapInArrow(list_blocks, "bucket int, block long, n int, body binary, several binary")
    met = lists.repartition(n, "bucket").sortWithinPartitions("bucket", "block").mapInArrow(meet, "block long, bucket int, n int, body binary")
    met.repartition(n, "block").write.partitionBy("block").parquet(folder)

    def keep(batches):
        claim("meeting")
        for at, parts in _blocks(batches, 2):
            told = _told(folder, at)
            for part in parts:
                who, key = _keys(part)
                short = key >> np.uint64(32 - bits)
                i = np.searchsorted(told, short)
                ok = told[np.minimum(i, len(told) - 1)] == short if len(told) else np.zeros(len(short), bool)
                yield pa.RecordBatch.from_arrays([pa.array(who[ok], pa.int64()), pa.array(key[ok].view(np.int64), pa.int64())], names=["owner", "key"])

    return src.mapInArrow(keep, "owner long, key long")


def _told(folder: str, block: int) -> np.ndarray:
    """The leading bits of a block's keys that occur elsewhere too, in order."""
    fs, base = store_of(folder)
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(f"{base}/block={block}", allow_not_found=True)) if f.path.endswith(".parquet")]
    out = [np.zeros(0, np.uint64)]
    for f in files:
        t = pq.read_table(f, filesystem=fs, columns=["bucket", "n", "body"], partitioning=None)
        for k, n, body in zip(*(t[c].to_pylist() for c in ("bucket", "n", "body"))):
            out.append((np.uint64(k) << np.uint64(32)) | unpack(body, n).astype(np.uint64))
    return np.sort(np.concatenate(out))
