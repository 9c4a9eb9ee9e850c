"""Attach the SQL text in force to each execution (backward as-of join).

Each execution takes the latest SQL text parsed in the same session at or
before its timestamp (a parse precedes the execution it belongs to, so a
text at the same instant counts).  Text is never cleared, so a DataFrame-API
write inherits the last text of its session; ``max_age_seconds`` optionally
cuts texts that are too old.  Texts sharing the latest instant are a tie the
log cannot order: the greatest text wins, so the answer is deterministic and a
task recomputed after a lost executor gives the same rows.

Scale: a session may hold a third of all rows, in any stretch of time, so
the split is by row count, not by clock.  Texts and executions are range
partitioned on (session, time): every range partition ("bucket") is a
contiguous run of about rows / n rows, and a hot session spans many of them.
Inside a (session, bucket) a running ``last(.., ignorenulls)`` window fills
the text; the last text of each earlier bucket is carried forward by a
window over the small (session, bucket) table (at most sessions + buckets
rows); the two are combined per row.  No task sorts more than one bucket,
and the result is exact.

Both steps read the bucket of every row, so they must see one range
partitioning.  Range bounds come from a sample seeded per RDD, so the
bucketed rows are checkpointed once to ``spark.checkpoint.dir`` and both
steps read that copy (which also survives lost executors).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def micros(ts: str | Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP (its instant) or a TIMESTAMP_NTZ (its clock face)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    clock = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c.cast("timestamp_ntz"))
    return F.when(F.typeof(c) == "timestamp", F.unix_micros(c.cast("timestamp"))).otherwise(clock)


def attach_sql(execs: DataFrame, texts: DataFrame, by: str = "session_id", ts: str = "ts",
               text_col: str = "sql_text", max_age_seconds: float | None = None,
               num_buckets: int | None = None) -> DataFrame:
    """Return ``execs`` plus ``sql_text`` (null when no text) and ``sql_ts``.

    ``num_buckets`` (default ``spark.sql.shuffle.partitions``) is the number of
    range buckets the (session, time) order is cut into."""
    from ..session import checkpoint_dir
    spark = execs.sparkSession
    checkpoint_dir(spark)
    n = int(num_buckets or spark.conf.get("spark.sql.shuffle.partitions"))
    ex_cols = execs.columns
    ex = execs.select(*[F.col(c) for c in ex_cols],
                      micros(ts).alias("_us"), F.lit(1).alias("_is_exec"),
                      F.lit(None).cast("string").alias("_txt"))
    # a text without a time precedes nothing; the text keeps its own time, whatever its type
    tx = texts.where(F.col(ts).isNotNull()).select(F.col(by), micros(ts).alias("_us"), F.col(text_col).cast("string").alias("_txt"),
                                                   F.col(ts).alias("_tts"))
    ex = ex.withColumn("_tts", F.lit(None).cast(texts.schema[ts].dataType))
    for c in ex_cols:
        if c != by:
            tx = tx.withColumn(c, F.lit(None).cast(execs.schema[c].dataType))
    tx = tx.withColumn("_is_exec", F.lit(0)).select(*ex.columns)
    # a text sorts before an execution at the same instant (the parse precedes it)
    u = (ex.unionByName(tx).repartitionByRange(n, by, "_us", "_is_exec")
         .withColumn("_b", F.spark_partition_id()).checkpoint(eager=True))

    # 1. inside (session, bucket): latest text at or before each row
    w_in = (Window.partitionBy(by, "_b").orderBy("_us", "_is_exec", "_txt")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # a null session matches nothing (SQL equality), inside a bucket as across buckets
    text_here = F.when((F.col("_is_exec") == 0) & F.col(by).isNotNull(),
                       F.struct(F.col("_us").alias("t"), F.col("_txt").alias("s"), F.col("_tts").alias("at")))
    filled = u.withColumn("_in", F.last(text_here, ignorenulls=True).over(w_in)).where(F.col("_is_exec") == 1)

    # 2. last text of every (session, bucket), carried forward to later buckets of the session
    last_per_bucket = (u.where(F.col("_is_exec") == 0)
                       .groupBy(by, "_b")
                       .agg(F.max(F.struct(F.col("_us").alias("t"), F.col("_txt").alias("s"), F.col("_tts").alias("at"))).alias("_last"))
                       .withColumn("_k", F.lit(1)))
    exec_buckets = (u.where(F.col("_is_exec") == 1).select(by, "_b").distinct()
                    .withColumn("_last", F.lit(None).cast(last_per_bucket.schema["_last"].dataType))
                    .withColumn("_k", F.lit(0)))
    w_carry = (Window.partitionBy(by).orderBy("_b", "_k")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = (exec_buckets.unionByName(last_per_bucket)
             .withColumn("_prev", F.last("_last", ignorenulls=True).over(w_carry))
             .where(F.col("_k") == 0).select(by, "_b", "_prev"))

    # 3. combine: a text inside the bucket wins over the carried one
    j = filled.join(carry, [by, "_b"], "left")
    found = F.when(F.col("_in").isNotNull(), F.col("_in")).otherwise(F.col("_prev"))
    j = j.withColumn("_found", found)
    keep = F.col("_found").isNotNull() & F.col("_us").isNotNull()  # an execution without a time follows nothing
    if max_age_seconds is not None:
        keep = keep & (F.col("_us") - F.col("_found.t") <= F.lit(int(max_age_seconds * 1_000_000)))
    return j.select(*[F.col(c) for c in ex_cols],
                    F.when(keep, F.col("_found.s")).alias("sql_text"),
                    F.when(keep, F.col("_found.at")).alias("sql_ts"))
