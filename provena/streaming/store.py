"""Keyed tables that a stream keeps up to date: the latest row of each key, written by micro-batches.

Both kinds take a batch under its batch id and are safe to replay: the batch reads what batches before it left and writes
a folder of its own, whose ``_SUCCESS`` file is the commit mark.  A folder without the mark is never read.

* ``LogTable``: each batch adds a delta with the latest rows of its own keys; a reader merges the newest base with the
  deltas after it.  The deltas are folded into a new base when they outweigh it, so what a trigger writes follows the
  batch, and what compaction writes follows the sum of the batches (each row is written again only after as many bytes
  have come in as the base has).
* ``BucketTable``: keys are dealt into hash buckets, and a batch rewrites only those that it touches.  A reader finds
  each key in one place without merging.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this engine wrote."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, path: str, prefix: str = "v=") -> list[int]:
    """Numbers of the committed folders ``<prefix>N`` under a path, in order (metadata only)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith(prefix) and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            found.append(int(name[len(prefix):]))
    return sorted(found)


def size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the greatest ``order`` (then the greatest of its other columns), combined before the
    shuffle.  A null key is a key."""
    rest = [c for c in rows.columns if c not in keys]
    by = [*order, *(c for c in rest if c not in order and not _unordered(rows.schema[c].dataType))]
    # where every column takes part in the order, one struct is both the row and its rank, and moves once
    top = (F.max(F.struct(*by)) if set(by) == set(rest) else F.max_by(F.struct(*rest), F.struct(*by))).alias("_top")
    return rows.groupBy(*keys).agg(top).select(*keys, "_top.*").select(*rows.columns)


def _unordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


class LogTable:
    """Log-structured: ``<path>/d=N`` the delta of batch N, ``<path>/b=N`` everything up to batch N."""

    def __init__(self, path: str, schema: T.StructType, keys: list[str], order: list[str], outweigh: float = 1.0):
        self.path, self.schema, self.keys, self.order, self.outweigh = path, schema, keys, order, outweigh

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """The batch's latest rows; then a new base, if the deltas since the last one are larger than it."""
        spark = rows.sparkSession
        names = [f.name for f in self.schema.fields]
        latest(rows.select(*names), self.keys, self.order).write.mode("overwrite").parquet(f"{self.path}/d={batch_id}")
        base, deltas = self._parts(spark, batch_id)
        since = sum(size(spark, f"{self.path}/d={d}") for d in deltas)
        if base is None and len(deltas) > 1 or base is not None and since > self.outweigh * size(spark, f"{self.path}/b={base}"):
            self.read(spark, batch_id).write.mode("overwrite").parquet(f"{self.path}/b={batch_id}")
            if base is not None:  # the last base and its deltas stay for a replay of this batch
                for kind, last in (("b", base - 1), ("d", base)):
                    for v in versions(spark, self.path, f"{kind}="):
                        if v <= last:
                            remove(spark, f"{self.path}/{kind}={v}")

    def _parts(self, spark: SparkSession, upto: int) -> tuple[int | None, list[int]]:
        base = max((b for b in versions(spark, self.path, "b=") if b <= upto), default=None)
        return base, [d for d in versions(spark, self.path, "d=") if d <= upto and (base is None or d > base)]

    def read(self, spark: SparkSession, upto: int = 1 << 62) -> DataFrame:
        """The latest row of each key after batch ``upto``."""
        base, deltas = self._parts(spark, upto)
        paths = ([f"{self.path}/b={base}"] if base is not None else []) + [f"{self.path}/d={d}" for d in deltas]
        if not paths:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).parquet(*paths)
        return rows if len(paths) == 1 else latest(rows, self.keys, self.order)


class BucketTable:
    """Hash buckets: ``<path>/v=N/bucket=b`` holds bucket b as batch N left it."""

    def __init__(self, path: str, schema: T.StructType, keys: list[str], order: list[str], buckets: int = 64):
        self.path, self.schema, self.keys, self.order, self.buckets = path, schema, keys, order, buckets

    def write(self, rows: DataFrame, batch_id: int, unique: bool = False) -> list[int]:
        """Merge a batch into the buckets of its keys; returns the buckets written anew (a list of their numbers is all
        that comes to the driver).  ``unique``: the rows are the latest of their keys already, one of each."""
        spark = rows.sparkSession
        names = [f.name for f in self.schema.fields]
        new = rows.select(*names) if unique else latest(rows.select(*names), self.keys, self.order)
        staged = f"{self.path}/_new-{batch_id}"
        new.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")).write.mode("overwrite").option("compression", "zstd").parquet(staged)
        new = spark.read.parquet(staged)
        touched = sorted(r[0] for r in new.select("bucket").distinct().collect())
        places = self._places(spark, batch_id - 1)
        old = self._read(spark, {b: v for b, v in places.items() if b in touched})
        both = new.select(*names, "bucket").unionByName(old)
        # a bucket is dealt to several tasks by its keys, and merged where it is written
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        deals = -(-2 * tasks // len(touched)) if 0 < len(touched) < tasks else 1
        dealt = both.withColumn("_deal", F.pmod(F.xxhash64(*self.keys, F.lit("deal")), F.lit(deals)).cast("int"))
        dealt = dealt.repartition(max(1, min(len(touched) * deals, tasks)), "bucket", "_deal")
        merged = latest(dealt, ["bucket", "_deal", *self.keys], self.order).drop("_deal")
        merged.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{self.path}/v={batch_id}")
        remove(spark, staged)
        for b in touched:  # what this batch read stays for a replay; what was older goes
            for v in self._versions_of(spark, b):
                if v < places.get(b, -1):
                    remove(spark, f"{self.path}/v={v}/bucket={b}")
        return touched

    def _versions_of(self, spark: SparkSession, bucket: int) -> list[int]:
        return [v for v, held in self._held(spark).items() if bucket in held]

    def _held(self, spark: SparkSession) -> dict[int, set[int]]:
        out = {}
        for v in versions(spark, self.path):
            fs, p = _fs(spark, f"{self.path}/v={v}")
            names = [st.getPath().getName() for st in fs.listStatus(p)]
            out[v] = {int(n.split("=")[1]) for n in names if n.startswith("bucket=")}
        return out

    def _places(self, spark: SparkSession, upto: int) -> dict[int, int]:
        """Which version holds each bucket after batch ``upto``."""
        out: dict[int, int] = {}
        for v, held in sorted(self._held(spark).items()):
            if v <= upto:
                out.update({b: v for b in held})
        return out

    def _read(self, spark: SparkSession, places: dict[int, int]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        if not places:
            return spark.createDataFrame([], schema)
        out = None
        by_version: dict[int, list[int]] = {}
        for b, v in places.items():
            by_version.setdefault(v, []).append(b)
        for v, held in by_version.items():
            root = f"{self.path}/v={v}"
            part = spark.read.schema(schema).option("basePath", root).parquet(*(f"{root}/bucket={b}" for b in held))
            out = part if out is None else out.unionByName(part)
        return out

    def read(self, spark: SparkSession, upto: int = 1 << 62) -> DataFrame:
        """The latest row of each key after batch ``upto``."""
        return self._read(spark, self._places(spark, upto)).drop("bucket")
