"""Language-model scoring by prediction by partial matching over bytes.

A text is read as its words (A-Z folded), a space between two and a line end behind the last; no word holds either byte,
so this stream and the sequence of words say the same.  The model is the trie of all contexts of up to ``ORDER`` bytes
that the training texts hold.  A byte's probability comes from the longest context seen: with T the count of the
context and D its distinct next bytes, a byte seen C times there has (C - ESCAPE) / T and the escape has ESCAPE * D / T; after an
escape the next shorter context is asked, without the bytes that the longer one already had (symbol exclusion, in T and
in D), down to single bytes and then to an even share.  A text starts behind ``ORDER`` line ends.

With the trie fixed, the code length of a byte depends on its ``ORDER`` + 1 bytes alone.  So:

1. One pass counts, per block of rows, the distinct words and byte runs of the block, from all training texts; runs and
   words of other texts are listed with count 0.
2. Words are summed over the blocks; runs are summed, and the trie is worked out in parts, one for each two bytes next
   to the predicted one: all contexts of two bytes or more that such a run meets end in these, so a part holds its whole
   subtrie.  The shorter contexts are one table of at most 65,536 counts.
3. Each block gets the numbers of its own words and runs, as one file per block in the shared folder, and a second pass
   over the rows scores them.  No task or broadcast holds the vocabulary or the trie; what is counted grows with the
   corpus.

A block is ``BLOCK_ROWS`` rows of an input file, known by the file's name and the row's place; a DataFrame that is not
read from files is stored first.  Words are known by a 64-bit hash.

Defined results: null and empty texts are the end token alone; a null ``doc_id`` counts as the text ''; repeated rows
count and are scored each; without training texts every token has base probability 1 and bytes have even shares.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import _FOLD, Lookup, buffer_of, ship, slices, span_hash, stored, texts_of, word_spans, _FOLDED
from .tokenfile import store_of

ORDER = 5
#: what the escape takes from each distinct next byte; on held-out texts 0.3 codes shorter than 0.1, 0.2, 0.4 and 0.5
ESCAPE = 0.3
BLOCK_ROWS = 16_384
#: distinct runs of a part that are worked out in one task; a larger part is cut by a third context byte
PART_RUNS = 1 << 18
#: bytes of text that are scored or counted at once; their runs take many times the room
SLICE = 1 << 19
#: the end token's key among the word hashes
END = np.uint64(0x656E642D746F6B65)
WORD, RUN = 0, 1


def streams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(runs, first run of each text, word hashes with the end token, first word of each text).

    A run is a byte of the stream with the ``order`` bytes before it, as one number, the byte itself lowest.
    """
    raw, off = buffer_of(texts)
    n = len(texts)
    start, end, doc = word_spans(raw, off)
    per_doc = np.bincount(doc, minlength=n)
    # words and end tokens in one row
    first_word = np.r_[0, np.cumsum(per_doc + 1)]
    words = np.full(int(first_word[-1]), END, np.uint64)
    words[np.arange(len(start)) + doc] = span_hash(_FOLDED[raw], start, end) if len(start) else np.zeros(0, np.uint64)
    # the stream: every text behind `order` line ends
    size = end - start
    text_len = np.maximum(np.bincount(doc, weights=size, minlength=n).astype(np.int64) + per_doc, 1)
    first = np.r_[0, np.cumsum(text_len + order)]
    out = np.full(int(first[-1]), 10, np.uint8)
    if len(start):
        done = np.cumsum(size) - size
        of_doc = np.r_[0, np.cumsum(np.bincount(doc, weights=size, minlength=n).astype(np.int64))][doc]
        rank = np.arange(len(start)) - np.r_[0, np.cumsum(per_doc)][doc]
        at = first[doc] + order + (done - of_doc) + rank
        flat = np.repeat(at - start, size) + np.flatnonzero(_inside(len(raw), start, end))
        out[flat] = _FOLD[raw[np.flatnonzero(_inside(len(raw), start, end))]]
        inner = doc[:-1] == doc[1:]
        out[(at + size)[:-1][inner]] = 32
    runs = out[order:].astype(np.uint64)
    for k in range(1, order + 1):
        runs |= out[order - k:len(out) - k].astype(np.uint64) << np.uint64(8 * k)
    first_run = first - order * np.arange(n + 1)
    keep = np.ones(len(runs), bool)
    pads = (first[1:-1, None] - order + np.arange(order)[None, :]).ravel()
    keep[pads] = False
    return runs[keep], first_run, words, first_word


def _inside(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    step = np.zeros(n + 1, np.int8)
    step[start] += 1
    np.subtract.at(step, end, 1)
    return np.cumsum(step[:-1], dtype=np.int8).astype(bool)


def trie_logs(key: np.ndarray, count: np.ndarray, order: int, pairs: np.ndarray, after: np.ndarray | None = None) -> np.ndarray:
    """log10 probability of the last byte of every run.  ``key``: distinct runs that hold all runs with their last two
    context bytes; ``count``: their training counts; ``pairs``: training counts of all (byte, next byte), 256 x 256.
    With ``after``, the training counts of the bytes behind these two, the runs need only be all those with their last
    three context bytes."""
    out = np.zeros(len(key))
    open_ = np.ones(len(key), bool)
    upper = None  # of the context one byte longer: (seen, sum of lower counts of its symbols, distinct), per run
    for j in range(order, -1, -1):
        mask = np.uint64((1 << (8 * (j + 1))) - 1)
        if j == 2 and after is not None:
            low, mid = (key & np.uint64(255)).astype(np.int64), ((key >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
            c, t, d = after[low], np.full(len(key), after.sum()), np.full(len(key), (after > 0).sum())
        elif j >= 2:
            sym, back = np.unique(key & mask, return_inverse=True)
            c_sym = np.bincount(back, weights=count, minlength=len(sym))
            ctx, c_back = np.unique(sym >> np.uint64(8), return_inverse=True)
            t = np.bincount(c_back, weights=c_sym)[c_back][back]
            d = np.bincount(c_back, weights=c_sym > 0)[c_back][back]
            c = c_sym[back]
        else:
            table = pairs if j else pairs.sum(axis=0, keepdims=True)
            low = (key & np.uint64(255)).astype(np.int64)
            mid = ((key >> np.uint64(8)) & np.uint64(255)).astype(np.int64) if j else np.zeros(len(key), np.int64)
            c, t, d = table[mid, low], table.sum(axis=1)[mid], (table > 0).sum(axis=1)[mid]
        te, de = t.astype(float), d.astype(float)
        if upper is not None:
            above, above_d = upper(c)
            te, de = te - above, de - above_d
        live = open_ & (de > 0)
        hit, miss = live & (c > 0), live & (c == 0)
        out[hit] += np.log10((c[hit] - ESCAPE) / te[hit])
        out[miss] += np.log10(ESCAPE * de[miss] / te[miss])
        open_ &= ~hit

        if j == 2 and after is not None:
            def upper(lower, mid=mid, d=d):
                return ((after > 0)[None, :] * pairs).sum(axis=1)[mid], d
        elif j >= 2:
            def upper(lower, sym=sym, back=back, c_sym=c_sym, c_back=c_back, d=d):
                """For the context of this level: the shorter context's counts of its symbols, and how many they are."""
                one = np.zeros(len(sym))
                one[back] = lower  # the shorter context's count of the same byte
                x = np.bincount(c_back, weights=np.where(c_sym > 0, one, 0))
                return x[c_back][back], d
        elif j == 1:
            def upper(lower, mid=mid, d=d):
                single = pairs.sum(axis=0)
                return ((pairs > 0) * single[None, :]).sum(axis=1)[mid], d
    seen = int((pairs.sum(axis=0) > 0).sum())
    out[open_] += np.log10(1 / max(1, 256 - seen))
    return out


def with_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, text, held, block of every row."""
    src = docs.select("doc_id", "text", "held")
    place = (F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / BLOCK_ROWS))
    try:
        return src.select("doc_id", "text", "held", F.xxhash64(*place).alias("block"))
    except AnalysisException:  # not read from files
        return stored(src, "ppm-input").select("doc_id", "text", "held", F.xxhash64(*place).alias("block"))


def _merge(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key = np.concatenate([p[0] for p in parts])
    unique, back = np.unique(key, return_inverse=True)
    count = np.bincount(back, weights=np.concatenate([p[1] for p in parts]), minlength=len(unique)).astype(np.int64)
    held = np.zeros(len(unique), bool)
    held[back[np.concatenate([p[2] for p in parts])]] = True
    return unique, count, held


def count_blocks(docs: DataFrame, order: int) -> DataFrame:
    """(kind, key, block, cnt, held): the distinct words and runs of each block, their training counts, and whether a
    text that is not for training has them."""

    def tally(keys: np.ndarray, is_held: bool):
        unique, n = np.unique(keys, return_counts=True)
        return unique, np.zeros(len(unique), np.int64) if is_held else n, np.full(len(unique), is_held)

    def count(batches):
        block, parts, waiting = None, {WORD: [], RUN: []}, 0

        def close():
            for kind, p in parts.items():
                if p:
                    key, n, held = _merge(p)
                    for k in range(0, len(key), 1 << 18):
                        s = slice(k, k + (1 << 18))
                        m = len(key[s])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(m, kind, np.int8)), pa.array(key[s].view(np.int64)), pa.array(np.full(m, block, np.int64)),
                             pa.array(n[s]), pa.array(held[s])], names=["kind", "key", "block", "cnt", "held"])

        for b in slices(batches, "text", SLICE):
            blocks = b.column(3).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1], True])
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if blocks[x] != block:
                    yield from close()
                    block, parts, waiting = blocks[x], {WORD: [], RUN: []}, 0
                part = b.slice(x, y - x)
                runs, first_run, words, first_word = streams(texts_of(part, "text"), order)
                is_held = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                for kind, keys, first in ((WORD, words, first_word), (RUN, runs, first_run)):
                    mark = np.repeat(is_held, np.diff(first))
                    for flag in (False, True):
                        if (mark == flag).any():
                            parts[kind].append(tally(keys[mark == flag], flag))
                waiting += len(runs)
                if waiting > 1 << 22:
                    parts, waiting = {k: [_merge(p)] if p else [] for k, p in parts.items()}, 0
        yield from close()

    return docs.mapInArrow(count, "kind byte, key long, block long, cnt long, held boolean")


def ppm_score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Score the rows of ``docs`` (doc_id, text, held: not for training).

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    spark = docs.sparkSession
    ship(spark)
    src = with_blocks(docs)
    seen = stored(count_blocks(src, order), "ppm-seen")

    # words: a key has a row per block, or several where a block's rows are read by several tasks; one of them all leads
    per_key = Window.partitionBy("key").orderBy("block")
    whole = per_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words = stored(seen.where(F.col("kind") == WORD).withColumn("c", F.sum("cnt").over(whole))
                   .withColumn("lead", F.row_number().over(per_key) == 1).drop("kind"), "ppm-words")
    n_train, v_train = words.agg(F.coalesce(F.sum("cnt"), F.lit(0)), F.count(F.when(F.col("lead") & (F.col("c") > 0), 1))).first()
    # a word seen once, in a training text of this very block, needs no answer; nor does one never seen in training
    told = words.where("c > 0 AND (c > 1 OR held)").select("block", F.lit(WORD).cast("byte").alias("kind"), "key",
                                                           F.col("c").cast("double").alias("value"))

    # runs: summed, then the trie part by part
    runs = seen.where(F.col("kind") == RUN)
    total = stored(runs.groupBy("key").agg(F.sum("cnt").alias("cnt")), "ppm-runs")
    low = total.where("cnt > 0").groupBy(F.col("key").bitwiseAND(0xFFFF).alias("pair")).agg(F.sum("cnt").alias("n")).collect()
    pairs = np.zeros(65536)
    for r in low:  # at most 65,536 rows
        pairs[r["pair"]] = r["n"]
    pairs = spark.sparkContext.broadcast(pairs.reshape(256, 256))

    # parts with very many runs are cut by one more context byte; what they need in common is 256 counts each
    cut = total.withColumn("part", F.shiftright("key", 8).bitwiseAND(0xFFFF))
    large = stored(cut.groupBy("part").agg(F.count(F.lit(1)).alias("runs")).where(F.col("runs") > PART_RUNS).select("part"), "ppm-large")
    behind = (cut.join(large, "part").groupBy("part", F.col("key").bitwiseAND(0xFF).alias("byte")).agg(F.sum("cnt").alias("n")).collect())
    after = {r["part"]: np.zeros(256) for r in behind}
    for r in behind:  # at most 65,536 parts of 256 counts
        after[r["part"]][r["byte"]] = r["n"]
    after = spark.sparkContext.broadcast(after)

    def logs(by, pdf):
        import pandas as pd
        key = pdf["key"].to_numpy(np.int64)
        return pd.DataFrame({"key": key, "value": trie_logs(key.view(np.uint64), pdf["cnt"].to_numpy(np.float64), order, pairs.value,
                                                            after.value.get(int(by[0])))})

    third = F.when(F.col("large"), F.shiftright("key", 24).bitwiseAND(0xFF)).otherwise(F.lit(-1).cast("long"))
    value = (cut.join(large.withColumn("large", F.lit(True)), "part", "left").withColumn("third", third).groupBy("part", "third")
             .applyInPandas(logs, "key long, value double"))
    answers = told.unionByName(runs.select("block", "kind", "key").join(value, "key").select("block", "kind", "key", "value"))
    folder = scratch_path(spark, "ppm-answers")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    answers.repartition(n, "block").write.partitionBy("block").parquet(folder)

    n_base = float(n_train + v_train + 1)

    def score(batches):
        block, word_at, word_c, run_at, run_v = None, None, None, None, None
        for b in slices(batches, "text", SLICE):
            blocks = b.column(3).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1], True])
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if blocks[x] != block:
                    block = blocks[x]
                    kind, key, v = _answers(folder, int(block))
                    word_at, word_c = Lookup(key[kind == WORD].view(np.uint64)), v[kind == WORD]
                    run_at, run_v = Lookup(key[kind == RUN].view(np.uint64)), v[kind == RUN]
                part = b.slice(x, y - x)
                r, first_run, w, first_word = streams(texts_of(part, "text"), order)
                held = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                i = word_at.find(w)
                c = np.where(i >= 0, word_c[np.maximum(i, 0)] if len(word_c) else 0.0, np.repeat(~held, np.diff(first_word)).astype(float))
                logs = run_v[run_at.find(r)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(held), pa.array(np.diff(first_word)),
                     pa.array(np.add.reduceat((c > 0).astype(np.int64), first_word[:-1])), pa.array(np.full(y - x, n_train, np.int64)),
                     pa.array(np.add.reduceat(np.log10((c + 1) / n_base), first_word[:-1])), pa.array(np.add.reduceat(logs, first_run[:-1]))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return src.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held", "block").mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _answers(folder: str, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    fs, base = store_of(folder)
    import pyarrow.fs as pafs
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(f"{base}/block={block}", allow_not_found=True)) if f.path.endswith(".parquet")]
    t = [pq.read_table(f, filesystem=fs, columns=["kind", "key", "value"], partitioning=None) for f in files]
    if not t:
        return np.zeros(0, np.int8), np.zeros(0, np.int64), np.zeros(0)
    t = pa.concat_tables(t)
    return t["kind"].to_numpy(), t["key"].to_numpy(), t["value"].to_numpy()
