"""Connected components of an edge table by contraction: every node joins its smallest neighbour, the edges are renamed
and shrink, and the renamings are composed.  Each round is stored, nothing comes to the driver but a row count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b); nodes of one component share the root.

    A node's partner is a minimum, combined in each task before the shuffle, so a hub does not gather its neighbours.
    The nodes should be hashes: in random order the number of edges falls by a constant factor a round.
    """
    spark = edges.sparkSession
    scope: list[str] = []  # what the next round still reads
    e = edges.select("a", "b").where("a <> b").distinct()
    e = stored(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", scope, True)
    names = None
    while not e.isEmpty():
        before, scope = scope, []
        p = stored(e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")), "parents", scope, True)
        names = (p.select(F.col("a").alias("node"), F.col("p").alias("root")) if names is None else
                 stored(names.join(p, F.col("root") == F.col("a"), "left")
                        .select("node", F.coalesce("p", "root").alias("root")), "roots", scope, True))
        pa, pb = p.select("a", F.col("p").alias("x")), p.select(F.col("a").alias("b"), F.col("p").alias("y"))
        e = stored(e.join(pa, "a").join(pb, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
                   "edges", scope, True)
        discard(spark, before)
    return names if names is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root")).where("false")
