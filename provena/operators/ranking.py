"""Exact positions within groups that may be huge.

``row_number() OVER (PARTITION BY g ORDER BY k)`` sorts each group in one
task: with few groups (or one hot group) that is one straggler holding a
large share of the data.  ``ordinal`` gives the same numbers while splitting
every group over many tasks:

1. range-partition on (g, k): a hot group spans several range partitions;
2. number rows inside each (range partition, group) - bounded by the
   partition size;
3. count rows per (range partition, group) - a table of at most
   (#partitions + #groups) rows - and turn the counts into offsets with a
   running sum over the partitions of each group;
4. position = offset + local number.

The order keys must be unique within a group (as for a deterministic
``row_number``).

Steps 2 and 3 both read the partition id of every row, so they must see one
and the same range partitioning.  Range bounds come from a random sample
seeded per RDD, and column pruning gives each branch its own exchange, so
two branches computed separately get different bounds on large input.  The
range-partitioned rows are therefore checkpointed once to the shared folder
named by ``spark.checkpoint.dir`` and both branches read that copy; it also
survives the loss of the executors that computed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordinal(df: DataFrame, by: list[str], order: list[str], name: str = "pos",
            num_partitions: int | None = None) -> DataFrame:
    from ..session import checkpoint_dir
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = (df.repartitionByRange(n, *by, *order).withColumn("_pid", F.spark_partition_id())
         .checkpoint(eager=True))
    local = r.withColumn("_local", F.row_number().over(Window.partitionBy("_pid", *by).orderBy(*order)))
    counts = r.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_pid")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    o = offsets.select(F.col("_pid").alias("_opid"), *[F.col(c).alias(f"_o_{c}") for c in by], "_off")
    cond = F.col("_pid") == F.col("_opid")
    for c in by:  # null-safe: a null group is a group too
        cond = cond & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    j = local.join(o, cond)
    return (j.withColumn(name, (F.col("_off") + F.col("_local")).cast("int"))
            .drop("_pid", "_local", "_off", "_opid", *[f"_o_{c}" for c in by]))
