"""T5 at the reader: messages that carry their number within their key come out in that order, whatever order they came in.

The messages of a key are numbered from 1 without a gap (``keyed_for_sink``).  A batch's messages join those that wait;
of each key the run of numbers that follows what is out already is let go, and the rest waits for the missing ones.  So a
key's messages leave in order, batch after batch, and within a batch their numbers tell the order.

A hot key is no burden to one task: its numbers are cut into stretches of ``SPAN``, each is counted by itself, and only
one short row per (key, stretch) is compared along the key.  What is kept between batches is the waiting messages and, per
key, the last number let go (a ``LogTable``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import LogTable, remove, versions

SPAN = 1000
_DONE = T.StructType([T.StructField("key", T.StringType()), T.StructField("done", T.LongType())])


class Resequencer:
    """State under ``state``; messages that are let go under ``<out>/batch_id=N``.  ``schema`` has key, seq and the rest."""

    def __init__(self, state: str, out: str, schema: T.StructType, span: int = SPAN):
        self.state, self.out, self.schema, self.span = state, out, schema, span
        self.done = LogTable(f"{state}/done", _DONE, ["key"], ["done"])

    def batch(self, rows: DataFrame, batch_id: int) -> None:
        """One micro-batch (``foreachBatch``)."""
        spark = rows.sparkSession
        names = self.schema.names
        before = [v for v in versions(spark, f"{self.state}/waiting") if v < batch_id]
        waiting = spark.read.schema(self.schema).parquet(f"{self.state}/waiting/v={before[-1]}") if before else spark.createDataFrame([], self.schema)
        done = self.done.read(spark, batch_id - 1).select(F.col("key").alias("of"), "done")
        rows = rows.select(*names).unionByName(waiting).dropDuplicates(["key", "seq"])  # a message may come twice
        rows = rows.join(done, F.col("key").eqNullSafe(F.col("of")), "left").drop("of").withColumn("done", F.coalesce("done", F.lit(0)))
        staged = f"{self.state}/new-{batch_id}"
        rows.where(F.col("seq") > F.col("done")).write.mode("overwrite").parquet(staged)
        rows = spark.read.parquet(staged).withColumn("stretch", F.floor((F.col("seq") - 1) / self.span))

        # how far each stretch goes on without a gap from where it begins (or from what is out already)
        begin = F.greatest(F.col("stretch") * self.span, F.col("done"))
        place = F.row_number().over(Window.partitionBy("key", "stretch").orderBy("seq"))
        run = rows.select("key", "stretch", "done", "seq", begin.alias("begin"), place.alias("n"))
        parts = run.groupBy("key", "stretch", "done", "begin").agg(
            F.count(F.when(F.col("seq") == F.col("begin") + F.col("n"), 1)).alias("run"))
        # along the key: a stretch counts if all before it are whole, and the first one begins where the key stands
        order = Window.partitionBy("key").orderBy("stretch")
        end = F.col("begin") + F.col("run")
        joined = F.coalesce(F.lag(end).over(order), F.col("done")) == F.col("begin")
        linked = parts.withColumn("end", end).withColumn("broken", F.sum(F.when(joined, 0).otherwise(1)).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        reach = linked.where("broken = 0 AND run > 0").groupBy("key").agg(F.max("end").alias("reach"))
        reach_path = f"{self.state}/reach-{batch_id}"
        reach.write.mode("overwrite").parquet(reach_path)
        reach = spark.read.parquet(reach_path)

        named = rows.join(reach.select(F.col("key").alias("of"), "reach"), F.col("key").eqNullSafe(F.col("of")), "left")
        free = F.col("seq") <= F.coalesce("reach", F.lit(0))
        named.where(free).select(*names).write.mode("overwrite").parquet(f"{self.out}/batch_id={batch_id}")
        self.done.write(reach.select("key", F.col("reach").alias("done")), batch_id)
        named.where(~free).select(*names).write.mode("overwrite").parquet(f"{self.state}/waiting/v={batch_id}")
        remove(spark, staged)
        remove(spark, reach_path)
        for v in before[:-1]:
            remove(spark, f"{self.state}/waiting/v={v}")

    def start(self, rows: DataFrame, checkpoint: str):
        return (rows.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

    def gaps(self, spark: SparkSession) -> DataFrame:
        """Keys whose messages wait: (key, missing, waiting): the first number that is missing and how many wait."""
        last = versions(spark, f"{self.state}/waiting")
        waiting = spark.read.schema(self.schema).parquet(f"{self.state}/waiting/v={last[-1]}") if last else spark.createDataFrame([], self.schema)
        held = waiting.groupBy("key").agg(F.count(F.lit(1)).alias("waiting"))
        done = self.done.read(spark).select(F.col("key").alias("of"), "done")
        return (held.join(done, F.col("key").eqNullSafe(F.col("of")), "left")
                .select("key", (F.coalesce("done", F.lit(0)) + 1).alias("missing"), "waiting"))
