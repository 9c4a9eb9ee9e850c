"""Document fingerprints by winnowing, and comparison of each document with its edited self and its successor.

Every run of ``k`` code points has a rolling hash (one running sum over the text, see ``span_hash``); of every ``window``
neighbouring hashes the smallest is chosen, the rightmost of equals, and its position is kept.  So two texts that share
a passage of at least ``window + k - 1`` code points share a chosen hash, and no shared run under ``k`` counts.

Defined results: null counts as the empty text, whose fingerprint is empty; a text under ``k`` code points has the hash
of its whole self; one with fewer than ``window`` hashes has the smallest of them.  Two empty fingerprints have likeness
1, an empty and another 0.  Documents of one id follow each other in the order of their texts' hashes; a null id comes
before all others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, mix64, powers, ship, slices, texts_of

K, WINDOW = 20, 45

_CHAR = mix64(np.arange(1, 65537, dtype=np.uint64))


def winnow(texts: list[str], k: int = K, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the chosen hashes (uint32) and their positions (code points), by position."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    off = np.r_[0, np.cumsum(size)]
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(code)
    value = _CHAR[np.minimum(code, 65535)]
    if n and code.max() > 65534:
        far = code > 65534
        value[far] = mix64(code[far].astype(np.uint64) + np.uint64(1))
    up, down = powers(n + 1)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(value * up[:n], out=run[1:])
    empty = (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    grams = max(0, n - k + 1)
    h = mix64((run[k:] - run[:grams]) * down[:grams]) >> np.uint64(32) if grams else np.zeros(0, np.uint64)
    # hash above, place counted from the right below: the smallest is the rightmost of the smallest hashes
    place = np.uint64(0xFFFFFFFF) - np.arange(grams, dtype=np.uint64)
    low = (h << np.uint64(32)) | place
    packed, span = low, 1
    while span * 2 <= window:
        low = np.minimum(low[:-span], low[span:]) if len(low) > span else low[:0]
        span *= 2
    if span < window:
        low = np.minimum(low[:len(low) - (window - span)], low[window - span:]) if len(low) > window - span else low[:0]
    out = []
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        if a == b:
            out.append(empty)
            continue
        if b - a < k:
            whole = mix64((run[b:b + 1] - run[a:a + 1]) * down[a:a + 1] + np.uint64(b - a)) >> np.uint64(32)
            out.append((whole.astype(np.uint32), np.zeros(1, np.int64)))
            continue
        g = b - a - k + 1
        chosen = low[a:a + g - window + 1] if g >= window else packed[a:a + g].min(keepdims=True)
        chosen = chosen[np.r_[True, chosen[1:] != chosen[:-1]]]
        out.append(((chosen >> np.uint64(32)).astype(np.uint32), 0xFFFFFFFF - (chosen & np.uint64(0xFFFFFFFF)).astype(np.int64) - a))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes (sorted, distinct)."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, after: str) -> str:
    """The last quarter of the code points replaced by the first as many of the text after."""
    q = len(text) // 4
    return text[:len(text) - q] + after[:q]


def fingerprint(docs: DataFrame, text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """All columns plus ``hashes`` (array of long) and ``positions`` (array of long, code points)."""
    fields = [T.StructField("hashes", T.ArrayType(T.LongType()), False), T.StructField("positions", T.ArrayType(T.LongType()), False)]

    def fn(texts, _):
        prints = winnow(texts.to_pylist(), k, window)
        return [[h.astype(np.int64) for h, _ in prints], [p for _, p in prints]]

    return add_columns(docs, text, fields, fn)


def fingerprint_neighbours(docs: DataFrame, groups: int | None = None, k: int = K, window: int = WINDOW) -> DataFrame:
    """Per document, in ascending ``doc_id``: doc_id, n_chars, edited (its text with the last quarter taken from the
    next document, after the last the first), fingerprint and edited_fingerprint (binary, the chosen hashes in order,
    32 bits each), positions, and the likeness to the edited text's and the next document's fingerprint.

    Documents go to ``groups`` ranges of ids (the session's shuffle partitions by default).  The first text of the next
    range travels along as the last row of each range, so the texts are shuffled once and no range sees another.
    """
    spark = docs.sparkSession
    ship(spark)
    n = groups or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select(F.col("doc_id").cast("double").alias("at"))
    cuts = sorted(set(ids.approxQuantile("at", [i / n for i in range(1, n)], 1 / (8 * n)))) if n > 1 else []
    cuts = cuts or [0.0]  # a table without ids, or one range asked for: any cut will do
    ranges = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="at", outputCol="range", handleInvalid="keep")

    def placed(df: DataFrame) -> DataFrame:
        df = ranges.transform(df.withColumn("at", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))))
        # rows without an id stand in the order of their texts' hashes: as many ranges of these, before all others
        by_hash = F.least(F.floor((F.col("tie") / 2.0 ** 64 + 0.5) * n), F.lit(n - 1)).cast("int") - n
        return df.withColumn("range", F.when(F.col("doc_id").isNull(), by_hash).otherwise(F.col("range").cast("int"))).drop("at")

    src = placed(src.withColumn("tie", F.xxhash64("text")))
    # one row per range: its first document's text, sent to the range before (the last range gets the first text);
    # the broadcast has one short row per range
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")
    first = src.groupBy("range").agg(F.min(order).alias("o"))
    before = F.coalesce(F.lag("range").over(Window.orderBy("range")), F.max("range").over(Window.partitionBy()))
    first = first.select(F.col("range").alias("of"), F.col("o.doc_id").alias("first_id"), F.col("o.tie").alias("first_tie"),
                         before.alias("to"))
    ends = (src.join(F.broadcast(first), (F.col("range") == F.col("of")) & (F.col("tie") == F.col("first_tie"))
                     & F.col("doc_id").eqNullSafe(F.col("first_id")))
            .dropDuplicates(["of"])
            .select("doc_id", "text", F.col("to").alias("range"), "tie", F.lit(True).alias("end")))
    rows = (src.withColumn("end", F.lit(False)).select("doc_id", "text", "range", "tie", "end").unionByName(ends)
            .repartitionById(n, F.pmod("range", F.lit(n))).sortWithinPartitions("range", "end", "doc_id", "tie").select("doc_id", "text", "end"))
    schema = ("doc_id long, n_chars long, edited string, fingerprint binary, edited_fingerprint binary, "
              "positions array<long>, near_edited double, near_next double")

    def run(batches):
        held: list[tuple] = []
        for b in slices(batches, "text", 1 << 20):
            rows = [*held, *zip(b.column(0).to_pylist(), texts_of(b, "text").to_pylist(), b.column(2).to_pylist())]
            held = rows[-1:]
            if len(rows) < 2:
                continue
            prints = winnow([t for _, t, _ in rows], k, window)
            sets = [np.unique(h) for h, _ in prints]
            live = [i for i in range(len(rows) - 1) if not rows[i][2]]
            changed = [edited(rows[i][1], rows[i + 1][1]) for i in live]
            after = winnow(changed, k, window)
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[i][0] for i in live], pa.int64()), pa.array([len(rows[i][1]) for i in live], pa.int64()),
                pa.array(changed, pa.string()),
                pa.array([prints[i][0].astype(">u4").tobytes() for i in live], pa.binary()),
                pa.array([h.astype(">u4").tobytes() for h, _ in after], pa.binary()),
                pa.array([prints[i][1] for i in live], pa.list_(pa.int64())),
                pa.array([likeness(sets[i], np.unique(h)) for i, (h, _) in zip(live, after)], pa.float64()),
                pa.array([likeness(sets[i], sets[i + 1]) for i in live], pa.float64()),
            ], names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "positions", "near_edited", "near_next"])

    return rows.mapInArrow(run, schema)
