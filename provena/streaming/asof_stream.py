"""J1 in a stream: executions get the SQL text that was in force, as the rows come in, in any order.

Texts and executions are one stream of rows told apart by ``kind``.  A row waits until the stream has passed its time by
``delay`` seconds; then no text that precedes it should be missing any more.  What a batch closes is answered by the batch
operator (``attach_sql``) over the closed texts and the carried ones.

A row that comes when its time is already closed is late, and still counts: the executions of its session are answered
once more, over the session's whole history, and the new answers replace the old ones.  So the order of arrival decides
what a batch costs, and never the result; ``delay`` should cover the usual disorder.

What is kept, each part under a batch's id, so that a replayed batch finds what it found before:

* the rows that wait (their number follows the delay, not the age of the stream);
* the carried texts: of each session the last one closed, in a ``LogTable`` (one row per session);
* the time up to which rows are closed;
* the texts and answers themselves, appended per batch, of which only late rows read anything again.

When the stream has ended, ``finish`` closes what still waits.  ``event_id`` names an execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.asof import attach_sql, micros
from .store import LogTable, latest, remove, versions

TEXT, EXECUTION = 0, 1
ROW = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("event_id", T.LongType()), T.StructField("session_id", T.LongType()),
                    T.StructField("ts", T.TimestampNTZType()), T.StructField("sql_text", T.StringType())])
_CARRIED = T.StructType([T.StructField("session_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("sql_text", T.StringType())])
_ANSWER = T.StructType([*ROW.fields[1:4], T.StructField("sql_text", T.StringType()), T.StructField("sql_ts", T.TimestampNTZType()),
                        T.StructField("revision", T.LongType())])
_BEFORE_ALL = -(1 << 62)


class AsofStream:
    """State under ``state``; texts and answers under ``<out>/texts/v=N`` and ``<out>/answers/v=N``."""

    def __init__(self, state: str, out: str, delay: float):
        self.state, self.out, self.delay = state, out, int(delay * 1_000_000)
        self.carried = LogTable(f"{state}/carried", _CARRIED, ["session_id"], ["ts"])

    def batch(self, rows: DataFrame, batch_id: int) -> None:
        """One micro-batch (``foreachBatch``)."""
        self._close(rows, batch_id, None)

    def finish(self, spark: SparkSession) -> None:
        """Answer what still waits."""
        last = versions(spark, f"{self.state}/waiting")
        if last:
            self._close(spark.createDataFrame([], ROW), last[-1] + 1, 1 << 62)

    def start(self, rows: DataFrame, checkpoint: str):
        return (rows.select(*ROW.names).writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())

    def _close(self, rows: DataFrame, batch_id: int, until: int | None) -> None:
        spark = rows.sparkSession
        before = [v for v in versions(spark, f"{self.state}/waiting") if v < batch_id]
        closed, waiting = _BEFORE_ALL, spark.createDataFrame([], ROW)
        if before:
            closed = spark.read.parquet(f"{self.state}/closed/v={before[-1]}").first().us
            waiting = spark.read.schema(ROW).parquet(f"{self.state}/waiting/v={before[-1]}")
        rows = rows.select(*ROW.names).where(F.col("ts").isNotNull() | (F.col("kind") == EXECUTION))
        new = f"{self.state}/new-{batch_id}"  # the batch is read several times
        rows.withColumn("us", F.coalesce(micros("ts"), F.lit(1 << 61))).write.mode("overwrite").parquet(new)
        rows = spark.read.parquet(new)
        if until is None:
            until = max(closed, (rows.where(F.col("ts").isNotNull()).agg(F.max("us")).first()[0] or _BEFORE_ALL) - self.delay)
        late = rows.where(F.col("us") <= closed)
        every = rows.where(F.col("us") > closed).unionByName(waiting.withColumn("us", F.coalesce(micros("ts"), F.lit(1 << 61))))
        done = every.where(F.col("us") <= until)
        texts, late_texts = (d.where(F.col("kind") == TEXT).select(*_CARRIED.names) for d in (done, late))
        asks, late_asks = (d.where(F.col("kind") == EXECUTION).select("event_id", "session_id", "ts") for d in (done, late))
        carried = self.carried.read(spark, batch_id - 1).join(asks.select("session_id").distinct(), "session_id", "left_semi")
        answers = attach_sql(asks, texts.unionByName(late_texts).unionByName(carried))
        if not late.isEmpty():
            sessions = late.select("session_id").distinct()
            history = self._parts(spark, "texts", batch_id, _CARRIED).join(sessions, "session_id", "left_semi").unionByName(late_texts)
            again = self._latest(self._parts(spark, "answers", batch_id, _ANSWER)).join(sessions, "session_id", "left_semi")
            answers = answers.unionByName(attach_sql(again.select("event_id", "session_id", "ts").unionByName(late_asks), history))
        answers.select(*_ANSWER.names[:-1], F.lit(batch_id).cast("bigint").alias("revision")).write.mode("overwrite").parquet(f"{self.out}/answers/v={batch_id}")
        texts = texts.unionByName(late_texts)
        texts.write.mode("overwrite").parquet(f"{self.out}/texts/v={batch_id}")
        self.carried.write(texts.where(F.col("session_id").isNotNull()), batch_id)
        spark.range(1).select(F.lit(until).cast("bigint").alias("us")).write.mode("overwrite").parquet(f"{self.state}/closed/v={batch_id}")
        # the waiting rows come last: their mark commits the batch
        every.where(F.col("us") > until).select(*ROW.names).write.mode("overwrite").parquet(f"{self.state}/waiting/v={batch_id}")
        remove(spark, new)
        for v in before[:-1]:
            for part in ("waiting", "closed"):
                remove(spark, f"{self.state}/{part}/v={v}")

    def _parts(self, spark: SparkSession, what: str, below: int, schema: T.StructType) -> DataFrame:
        paths = [f"{self.out}/{what}/v={v}" for v in versions(spark, f"{self.out}/{what}") if v < below]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    @staticmethod
    def _latest(answers: DataFrame) -> DataFrame:
        return latest(answers, ["event_id"], ["revision"])

    def answers(self, spark: SparkSession) -> DataFrame:
        """event_id, session_id, ts, sql_text, sql_ts: the last answer of each execution."""
        return self._latest(self._parts(spark, "answers", 1 << 62, _ANSWER)).drop("revision")
