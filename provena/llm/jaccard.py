"""N-gram Jaccard join: which documents are linked by a word-shingle similarity of at least ``num / den``.

1. Equal shingle sets form a class (a 128-bit digest of the sorted set); only classes go on.
2. Two linked sets share a shingle among the first ``n - ceil(n * num / den) + 1`` of either, in any one order of all
   shingles.  The order goes by the logarithms of the counts of a shingle's words, summed; behind all of them come the
   shingles that are themselves frequent, by their own counts.  A word or shingle counts 0 if it is not one of the most
   frequent (lists whose length affects the order and never the result).  So the first shingles are those with several
   rare words, a passage that many texts share comes last, and unrelated texts seldom meet.  Shingles that a single class has are dropped
   by a pre-aggregated count.
3. What is left is dealt into tiles: a shingle and a band of sizes, with each class in its own band and the one below,
   since linked sets differ in size by ``num / den`` at most.  Tiles of the same members (as many, with the same two
   64-bit hashes over them) are one tile.
4. In a tile a hashed bitmap of each set bounds the overlap from above: every differing bit is a shingle that only one
   has.  Only pairs that pass go through the exact intersection of the sorted sets.
5. First every member is compared with one member only, the smallest of all its tiles' smallest; then with the smallest
   ones of its other tiles that are not joined with it yet; the links give components.  Tiles that still hold members of
   different components are compared in full (those with many candidates together with the tiles that they overlap), in blocks of at most ``BLOCK`` members and about ``BLOCK_SHINGLES`` shingles
   that are spread over the tasks, and give the links that join components.  A large group of near copies is settled by
   the first step; nothing is capped.

Result: the exact components of the link graph.  Defined results: a null or empty text, or one of white space only, has
no shingles and is linked with nothing; a text with fewer than k words has its whole sequence as its one shingle; rows
of one ``doc_id`` are documents of their own that share the id; a null ``doc_id`` never names a component unless all
its ids are null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Lookup, add_columns, buffer_of, claim, discard, ship, shingles, slices, stored, texts_of, word_hashes
from .components import components
from .meeting import meeting_keys

#: How many of the most frequent words, and of the most frequent shingles, the order knows; 2 MB of broadcast each.
FREQUENT = 1 << 17
BLOCK = 256
#: shingles of a block's sets, 32 MB; a larger set is in a block by itself or with few
BLOCK_SHINGLES = 1 << 22
#: up to so many candidate pairs for each member are told apart from the others of their tiles and checked once
PAIRS = 4


def sets_of(texts: pa.Array, k: int) -> list[np.ndarray]:
    raw, off = buffer_of(texts)
    words, doc = word_hashes(raw, off)
    return shingles(words, doc, len(texts), k)


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _frequent(docs: DataFrame, keys) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent of the hashes that ``keys(texts)`` gives, as far as a slice of the input holds them twice, and
    their counts."""

    def count(batches):
        for b in slices(batches, "text"):
            h, c = np.unique(keys(texts_of(b, "text")), return_counts=True)
            h, c = h[c > 1], c[c > 1]
            if len(h):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])

    top = (docs.select("text").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
           .orderBy(F.desc("c"), "h").limit(FREQUENT).toArrow())
    return top["h"].to_numpy().astype(np.int64).view(np.uint64), top["c"].to_numpy()


def frequent_words(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return _frequent(docs, lambda texts: word_hashes(*buffer_of(texts))[0])


def frequent_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of shingles, the counts of texts that hold them."""
    return _frequent(docs, lambda texts: np.concatenate([np.zeros(0, np.uint64), *sets_of(texts, k)]))


def signatures(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n (set size), dig (binary digest), node (its first 64 bits), prefix (array of long), bits (bitmap)."""
    spark = docs.sparkSession
    heavy = spark.sparkContext.broadcast((frequent_words(docs), frequent_shingles(docs, k)))
    fields = [T.StructField("n", T.LongType(), False), T.StructField("dig", T.BinaryType(), True),
              T.StructField("node", T.LongType(), True), T.StructField("prefix", T.ArrayType(T.LongType()), True),
              T.StructField("bits", T.BinaryType(), True)]

    def setup():
        return [(Lookup(h), np.r_[np.round(16 * np.log2(1 + c)).astype(np.int64), 0]) for h, c in heavy.value]

    def fn(state, texts, _):
        (word_at, word_often), (shingle_at, shingle_often) = state
        words, doc = word_hashes(*buffer_of(texts))
        rank = word_often[word_at.find(words)]  # in whole steps, so that sums are exact; 0 for a word not in the list
        sets = shingles(words, doc, len(texts), k, rank)
        size = np.array([len(s) for s, _ in sets], np.int64)
        own = shingle_often[shingle_at.find(np.concatenate([np.zeros(0, np.uint64), *(s for s, _ in sets)]))]
        ends = np.cumsum(size)
        digs, nodes, prefixes, maps = [], [], [], []
        for (s, low), end in zip(sets, ends.tolist()):
            n = len(s)
            if not n:
                for column in (digs, nodes, prefixes, maps):
                    column.append(None)
                continue
            need = n - -(-num * n // den) + 1
            p = s[np.lexsort((s, low, own[end - n:end]))[:need]]
            d = digest(s)
            digs.append(d)
            nodes.append(int.from_bytes(d[:8], "little", signed=True))
            prefixes.append(p.view(np.int64))
            maps.append(bitmap(s))
        return [pa.array(size, pa.int64()), pa.array(digs, pa.binary()), pa.array(nodes, pa.int64()), prefixes, pa.array(maps, pa.binary())]

    return add_columns(docs, "text", fields, fn, setup=setup).drop("text")


def bitmap(s: np.ndarray) -> bytes:
    """A hashed bitmap of a set: a power of two of bits, at least two for each shingle."""
    bits = 1 << max(6, int(2 * len(s) - 1).bit_length())
    out = np.zeros(bits, np.uint8)
    out[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps of several widths at the smallest one: the upper half is laid over the lower."""
    width = min(map(len, maps)) // 8
    return np.stack([np.bitwise_or.reduce(np.frombuffer(m, np.uint64).reshape(-1, width), axis=0) for m in maps])


def within_bound(i: int, js: np.ndarray, size: np.ndarray, maps: np.ndarray, num: int, den: int) -> np.ndarray:
    """Those of ``js`` that may be linked with i: a bit that differs is a shingle that only one of the two has, so the
    differing bits bound the overlap from above."""
    both = size[i] + size[js]
    need = -(-num * both // (num + den))
    fits = np.minimum(size[i], size[js]) >= need
    js, both, need = js[fits], both[fits], need[fits]
    differ = np.bitwise_count(maps[js] ^ maps[i]).sum(axis=1, dtype=np.int64)
    return js[(both - differ) // 2 >= need]


def partners(left: int, total: int, i: int) -> np.ndarray:
    """Whom member i of the left is compared with: the right, or the left behind it where there is no right."""
    return np.arange(left, total) if total > left else np.arange(i + 1, left)


def candidates(left: list, right: list, num: int, den: int) -> tuple[list[tuple], list[tuple[int, tuple]]]:
    """Pairs of members of a block with other labels and within the bound, as (digest, digest); where they would be
    over ``PAIRS`` for each member, the members (side, member) that have such a partner instead.
    A member: (digest, label, size, bitmap)."""
    every = left + right
    size = np.array([m[2] for m in every])
    label = np.unique([m[1] for m in every], return_inverse=True)[1]
    maps = folded([m[3] for m in every])
    pairs: list[tuple] | None = []
    live = np.zeros(len(every), bool)
    for i in range(len(left)):
        js = partners(len(left), len(every), i)
        js = within_bound(i, js[label[js] != label[i]], size, maps, num, den)
        live[js] = True
        live[i] |= len(js) > 0
        if pairs is not None:
            pairs += [(every[i][0], every[j][0]) for j in js.tolist()]
            if len(pairs) > PAIRS * len(every):
                pairs = None
    if pairs is not None:
        return pairs, []
    return [], [(int(k >= len(left)), every[k]) for k in np.flatnonzero(live).tolist()]


def links_between(left: list, right: list, num: int, den: int) -> list[tuple[bytes, bytes]]:
    """Links of a block by exact intersection, but for pairs of one label or already joined in this block.
    A member: (digest, label, set)."""
    every = left + right
    size = np.array([len(m[2]) for m in every])
    maps = folded([bitmap(m[2]) for m in every])
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    out = []
    for i in range(len(left)):
        for j in within_bound(i, partners(len(left), len(every), i), size, maps, num, den).tolist():
            a, b = find(every[i][1]), find(every[j][1])
            if a == b:
                continue
            same = len(np.intersect1d(every[i][2], every[j][2], assume_unique=True))
            if den * same >= num * (size[i] + size[j] - same):
                root[max(a, b)] = min(a, b)
                out.append((every[i][0], every[j][0]))
    return out


def _groups(batches, columns: int):
    """(gid, left members, right members) of rows sorted by gid and side."""
    gid, group = None, ([], [])
    for b in batches:
        for g, side, *member in zip(*(b.column(i).to_pylist() for i in range(columns))):
            if g != gid:
                if gid is not None:
                    yield gid, *group
                gid, group = g, ([], [])
            group[side].append(member)
    if gid is not None:
        yield gid, *group


def links(members: DataFrame, classes: DataFrame, docs: DataFrame, k: int, num: int, den: int, whole: bool = False) -> DataFrame:
    """Links (a, b), stored, of the groups in ``members``: gid, side (a group of side 0 only is compared with itself),
    dig, label.  The bitmaps go to the groups first; then sets go where there are candidates.  A pair that is a
    candidate in many groups is checked once.  With ``whole``, groups with many candidates that overlap are put together
    before, so that a set doesn't go to each of them."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def sieve(batches):
        for gid, left, right in _groups(batches, 6):
            if left and len(left) + len(right) > 1:
                pairs, live = candidates(left, right, num, den)
                rows = [(None, 0, a, None, b) for a, b in pairs] + [(gid, side, m[0], m[1], None) for side, m in live]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["gid", "side", "dig", "label", "other"])

    def settle(batches):
        for _, left, right in _groups(batches, 5):
            for side in (left, right):
                for m in side:
                    m[2] = np.frombuffer(m[2], np.uint64)
            found = links_between(left, right, num, den) if left and len(left) + len(right) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())],
                                                 names=["a", "b"])

    scope: list[str] = []
    live = stored(members.join(classes.select("dig", "n", "bits"), "dig").select("gid", "side", "dig", "label", "n", "bits")
                  .repartition(n, "gid").sortWithinPartitions("gid", "side", "dig")
                  .mapInArrow(sieve, "gid string, side int, dig binary, label binary, other binary"), "candidates", scope, True)
    pairs = live.where("other IS NOT NULL").select(F.least("dig", "other").alias("lead"), F.greatest("dig", "other").alias("dig")).distinct()
    pairs = pairs.join(classes.select("dig", "n"), "dig")
    left = live.where("other IS NULL").drop("other")
    left = _together(left, classes, scope) if whole else left
    rows = stored(left.unionByName(_stars(pairs)), "members", scope, True)
    sets = _sets(docs, classes.join(rows.select("dig").distinct(), "dig", "left_semi"), k, scope)
    out = stored(rows.join(sets, "dig").select("gid", "side", "dig", "label", "set")
                 .repartition(n, "gid").sortWithinPartitions("gid", "side", "dig")
                 .mapInArrow(settle, "a binary, b binary"), "links", small=True)
    discard(members.sparkSession, scope)
    return out


def _together(groups: DataFrame, classes: DataFrame, scope: list[str]) -> DataFrame:
    """The members of overlapping groups as one group, cut into blocks (gid, side, dig, label)."""
    lead = groups.groupBy("gid").agg(F.min("dig").alias("lead"))
    root = components(groups.join(lead, "gid").where("dig <> lead").select(F.col("lead").alias("a"), F.col("dig").alias("b")))
    rows = groups.select("dig", "label").distinct().join(classes.select("dig", "n"), "dig").join(root.withColumnRenamed("node", "dig"), "dig")
    return _blocked(stored(rows.withColumn("group", F.hex("root")), "together", scope, True), "group")


def _blocked(rows: DataFrame, by: str) -> DataFrame:
    """Groups (``by``) of rows (dig, label, n) as pairs of blocks that are compared: gid, side, dig, label."""
    blocks = rows.groupBy(by).agg(F.min("label").alias("x"), F.max("label").alias("y"), _blocks().alias("blocks")).where("x <> y").select(by, "blocks")
    left = rows.join(blocks, by).withColumn("i", F.pmod(F.hash("dig"), "blocks"))
    left = left.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return left.select(F.concat_ws(":", by, F.least("i", "j"), F.greatest("i", "j")).alias("gid"),
                       F.when(F.col("i") <= F.col("j"), 0).otherwise(1).alias("side"), "dig", "label")


def _blocks():
    """In how many blocks a group goes, from its number of members and of their shingles."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")


def _stars(pairs: DataFrame) -> DataFrame:
    """Groups (gid, side, dig, label) that compare each ``lead`` with its ``dig``s (of ``n`` shingles), a block of them at
    a time."""
    share = pairs.groupBy("lead").agg(_blocks().alias("blocks"))
    block = F.pmod(F.hash("dig"), "blocks")
    one = pairs.join(share, "lead").select(F.concat_ws(":", F.hex("lead"), block).alias("gid"), "lead", "dig")
    member = one.select("gid", F.lit(1).alias("side"), "dig", F.col("dig").alias("label"))
    first = one.select("gid", F.lit(0).alias("side"), F.col("lead").alias("dig"), F.col("lead").alias("label")).distinct()
    return first.unionByName(member)


def tiles(sig: DataFrame, classes: DataFrame, num: int, den: int, scope: list[str]) -> DataFrame:
    """(tile, dig, n): classes that share a prefix shingle with another class of a size in reach; tiles with the same
    members are kept once."""
    # shingles that occur once never move
    keys = stored(meeting_keys(sig, "node", "prefix", scope).withColumnRenamed("owner", "node"), "prefixes", scope)
    shared = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    # classes by their 64-bit names until few are left, then by the whole digest
    names = classes.select("node", "dig", "n")
    met = keys.join(shared, "key").distinct().join(names.select("node", "n"), "node")
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(den / num)) + 1e-9).cast("int")
    met = met.withColumn("band", F.explode(F.array(band, band - 1))).select("key", "band", "node", "n")
    met = stored(met, "tiles", scope)
    what = met.groupBy("key", "band").agg(F.count(F.lit(1)).alias("size"), *_hashes("node")).where("size > 1")
    once = what.groupBy("size", "s0", "s1").agg(F.min(F.struct("key", "band")).alias("t")).select("t.key", "t.band")
    return (met.join(once, ["key", "band"]).select(F.concat_ws(":", F.hex("key"), "band").alias("tile"), "node", "n")
            .join(names, ["node", "n"]).select("tile", "dig", "n"))


def _hashes(*of: str) -> list:
    """Two 64-bit hashes of a set of rows, whatever their order."""
    return [F.bit_xor(F.xxhash64(*of, F.lit(i))).alias(f"s{i}") for i in (0, 1)]


def jaccard_components(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id that links lead to)."""
    ship(docs.sparkSession)
    src = docs.select("doc_id", "text")
    spark, scope, wide = docs.sparkSession, [], []
    sig = stored(signatures(src, k, num, den), "signatures", wide)
    named = stored(sig.select("doc_id", "n", "dig"), "documents")  # what the result needs of them
    every = stored(sig.where("n > 0").groupBy("dig").agg(F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in ("node", "n", "bits"))),
                   "classes", wide)
    tile = stored(tiles(sig, every, num, den, scope), "tile-members", wide, True)
    discard(spark, scope)
    classes = stored(every.join(tile.select("dig").distinct(), "dig", "left_semi"), "met-classes", scope, True)

    # every member with the smallest of the smallest members of its tiles
    lead = tile.groupBy("tile").agg(F.min("dig").alias("lead"))
    body = stored(tile.join(lead, "tile").where("dig <> lead"), "tile-bodies", scope, True)
    star = stored(body.select("lead", "dig", "n").distinct(), "stars", scope, True)
    first = star.groupBy("dig", "n").agg(F.min("lead").alias("lead"))
    found = links(_stars(first), classes, src, k, num, den)
    root = components(found)

    # with the smallest members of its other tiles, where they are not joined with it yet
    other = _named(_named(star, root, "dig", "x"), root, "lead", "y").where("x <> y").select("lead", "dig", "n")
    other = other.join(first.select("lead", "dig"), ["lead", "dig"], "left_anti")
    found = found.unionByName(links(_stars(other), classes, src, k, num, den))
    root = components(found)

    # tiles whose members are not all joined yet, in full: the smallest member has been compared with all others, so the
    # rest of the tile is what is left.  It is stored, so that Spark can split the joins of a tile with many members.
    body = stored(_named(body, root, "dig", "label").drop("lead"), "open-tiles", scope, True)
    more = links(_blocked(body, "tile"), classes, src, k, num, den, whole=True)
    root = components(found.unionByName(more))

    comp = every.select("dig", "rep").join(root, F.col("dig") == F.col("node"), "left").select("dig", "rep", F.coalesce("root", "dig").alias("root"))
    least = comp.groupBy("root").agg(F.min("rep").alias("component_id"))
    comp = stored(comp.join(least, "root").select("dig", "component_id"), "components", small=True)
    discard(spark, scope + wide)
    return (named.join(comp, "dig", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def _named(rows: DataFrame, root: DataFrame, column: str, name: str) -> DataFrame:
    """All columns plus the component that a column's class is in so far: its root, or the class itself."""
    of = root.select(F.col("node").alias(column), F.col("root").alias(name))
    return rows.join(of, column, "left").withColumn(name, F.coalesce(name, column))


def _sets(docs: DataFrame, wanted: DataFrame, k: int, scope: list[str]) -> DataFrame:
    """(dig, set) of the wanted classes, from the text of one document each.  The list of those documents is stored, so
    that the planner knows its size and sends it to the texts where it is small."""
    # by a hash of the id, whatever the id is: a few more texts do no harm
    ids = stored(wanted.where("rep IS NOT NULL").select(F.xxhash64("rep").alias("rep_hash")).distinct(), "wanted", scope, True)
    rows = docs.join(ids, F.xxhash64("doc_id") == F.col("rep_hash"), "left_semi").where("doc_id IS NOT NULL")
    rows = rows.unionByName(docs.where("doc_id IS NULL")).select("text")  # classes of documents without ids

    def run(batches):
        for b in slices(batches, "text"):
            s = [x for x in sets_of(texts_of(b, "text"), k) if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([digest(x) for x in s], pa.binary()),
                                              pa.array([x.tobytes() for x in s], pa.binary())], names=["dig", "set"])

    return rows.mapInArrow(run, "dig binary, set binary")
