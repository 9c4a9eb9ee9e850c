"""Structured Streaming forms of the engine.

* ``stream_lineage`` (T1, T4, K12-K14, A5): a stream of plan-log rows (one row = one execution, self-contained) ->
  ``foreachBatch`` that harvests each row in place and writes every product under ``<out>/<product>/batch_id=N``.  A
  replayed batch overwrites its own folder, so output is idempotent.  Entities are kept up to date in a table of hash
  buckets, and messages are sent with a ledger of what each attempt delivered.
* ``redrive`` (T4, X-H): executions in quarantine go through again under rules that came later.
* ``stream_catalog`` (T2): catalog events -> the last change of each object, a log-structured table to which a batch
  adds its own changes.
* ``dedupe_stream`` (T6): drop redelivered rows, however late they come.
* ``read_notifications`` (S10, T3): Kafka (or file) source with bounded intake.

See ``store`` for the tables, ``asof_stream`` for J1 and ``resequence`` for the reader of numbered messages (T5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.names import split_list
from ..operators.catalog import catalog_changes, catalog_state
from ..operators.deliver import send_with_retry, to_messages
from ..operators.route import DEFAULT_POLICY, Policy
from ..plans.capture import PLAN_LOG_SCHEMA
from ..plans.in_row import PlanLineage
from .store import BucketTable, LogTable, remove, versions

# ---------------------------------------------------------------------------
# sources


def read_plan_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                         schema=PLAN_LOG_SCHEMA) -> DataFrame:
    """Plan-log files as a stream; ``max_files_per_trigger`` bounds intake."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def trimmed_topics(spec: str) -> str:
    """F10 on a topic list: ``" a , ,b "`` -> ``"a,b"`` (evaluated once, on the driver, for an option value)."""
    return ",".join(t.strip() for t in spec.split(",") if t.strip())


def read_notifications(spark: SparkSession, topics: str, fmt: str = "kafka", options: dict | None = None,
                       max_per_trigger: int | None = None, path: str | None = None, schema=None) -> DataFrame:
    """Notification source.  Kafka: subscribe to the cleaned topic list
    from the earliest offset, ``maxOffsetsPerTrigger`` bounds intake; nothing
    is dropped (the original bounded queue dropped events after 10 s).  Any
    other format reads ``(topic, key, value)`` files from ``path`` and keeps
    the listed topics."""
    opts = dict(options or {})
    if fmt == "kafka":
        r = (spark.readStream.format("kafka").option("subscribe", trimmed_topics(topics))
             .option("startingOffsets", "earliest").options(**opts))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", int(max_per_trigger))
        return r.load().select(F.col("topic"), F.col("key").cast("string"), F.col("value").cast("string"))
    r = spark.readStream.format(fmt).options(**opts)
    if schema is not None:
        r = r.schema(schema)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_per_trigger))
    df = r.load(path)
    return df.where(F.array_contains(split_list(F.lit(topics)), F.col("topic")))


#: Rows of a segment of the notification log.
SEGMENT_ROWS = 10_000


def append_notifications(messages: DataFrame, path: str, segment_rows: int = SEGMENT_ROWS) -> None:
    """Append ``(topic, key, value)`` rows to a notification log: a folder per topic, in segments of at most
    ``segment_rows`` rows."""
    (messages.select("topic", "key", "value").write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", segment_rows)
     .partitionBy("topic").parquet(path))


def read_notification_log(spark: SparkSession, path: str, topics: str, rows_per_trigger: int | None = None,
                          segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """S10 + T3 over a notification log: the listed topics from their beginning, as one stream.

    Every topic is a source of its own, so the checkpoint keeps one offset per topic: a topic that is quiet, or comes to
    the list later under a new checkpoint, moves none of the others.  ``rows_per_trigger`` bounds what a trigger takes
    from each topic, in whole segments."""
    names = trimmed_topics(topics).split(",") if trimmed_topics(topics) else []
    if not names:
        raise ValueError("no topic")
    out = None
    for name in dict.fromkeys(names):
        r = spark.readStream.schema("key string, value string")
        if rows_per_trigger:
            r = r.option("maxFilesPerTrigger", max(1, int(rows_per_trigger) // segment_rows))
        one = r.parquet(f"{path}/topic={name}").select(F.lit(name).alias("topic"), "key", "value")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------------------
# Continuous lineage


def _write_batch(df: DataFrame, out: str, product: str, batch_id: int) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/{product}/batch_id={batch_id}")


ENTITY_KEYS = ["type_name", "qualified_name"]


def entity_table(spark: SparkSession, path: str, buckets: int = 64) -> BucketTable:
    """A5: the entities as the stream keeps them, the latest event per (type_name, qualified_name)."""
    empty = PlanLineage(spark.createDataFrame([], PLAN_LOG_SCHEMA)).entities
    return BucketTable(path, empty.schema, ENTITY_KEYS, ["ts", "event_id"], buckets)


def lineage_batch_writer(out: str, policy: Policy = DEFAULT_POLICY, ns: str = K.NAMESPACE,
                         send=None, dead_letter_path: str | None = None, entities: BucketTable | None = None, rules: DataFrame | None = None,
                         retry_interval_ms: int = K.RETRY_INTERVAL_MS):
    """``foreachBatch`` function: plan-log batch -> lineage products.

    Products: ``table_lineage``, ``column_lineage``, ``quarantine`` and
    ``messages`` (topic, key, value).  If ``send`` is given, messages are
    also sent with retry, and ``<out>/ledger`` tells what each attempt delivered;
    what fails to the end lands in ``dead_letter_path``, or stops the query if
    there is none.  ``entities`` is a table to be kept up to date (A5).
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = f"{out}/_rows/batch_id={batch_id}"
        lin = PlanLineage(batch, rules, policy, ns).stage(rows)  # each plan is parsed once, then products read the rows
        good = lin.good.select("event_id", "ts", "target_qn", "process_qn", "op_type", "inputs", "n_inputs",
                               "query_text")
        _write_batch(good, out, "table_lineage", batch_id)
        _write_batch(lin.column_lineage, out, "column_lineage", batch_id)
        _write_batch(lin.quarantine, out, "quarantine", batch_id)
        _write_batch(to_messages(lin), out, "messages", batch_id)
        if entities is not None:
            entities.write(lin.latest_entities(), batch_id, unique=True)
        remove(spark, rows)  # all products are stored
        if send is not None:
            msgs = spark.read.parquet(f"{out}/messages/batch_id={batch_id}")
            send_with_retry(msgs.select("event_id", "topic", "key", "value"), send, dead_letter_path, batch_id=batch_id,
                            retry_interval_ms=retry_interval_ms, ledger=f"{out}/ledger")
    return run


def redrive(log: DataFrame, out: str, rules: DataFrame, number: int, reasons=(K.REASON_UNSUPPORTED, K.REASON_NO_SQL_TEXT),
            policy: Policy = DEFAULT_POLICY, **kw) -> None:
    """T4 + X-H: executions of ``log`` that the stream under ``out`` put into quarantine go through again, now that a rule
    (or, in ``log``, a text) has come.  Only what was not delivered goes: neither by the stream nor by an earlier
    redrive.  Products are written next to the stream's own, under ``redrive=<number>``; the number is the version of
    the rules, and the same number written twice replaces its own rows.
    """
    spark = log.sparkSession
    held = spark.read.parquet(f"{out}/quarantine").where(F.col("reason").isin(*reasons)).select("event_id").distinct()
    again = log.join(held, "event_id", "left_semi").join(
        spark.read.parquet(f"{out}/table_lineage").select("event_id"), "event_id", "left_anti")
    for v in versions(spark, f"{out}/redriven", "redrive="):
        if v < number:
            again = again.join(spark.read.parquet(f"{out}/redriven/redrive={v}/table_lineage").select("event_id"), "event_id", "left_anti")
    root = f"{out}/redriven/redrive={number}"
    lineage_batch_writer(root, policy, rules=rules, **kw)(again, 0)
    _mark(spark, root)


def _mark(spark: SparkSession, folder: str) -> None:
    """Mark a folder of several products as complete."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


def delivered_lineage(spark: SparkSession, out: str) -> DataFrame:
    """The table lineage that a stream and its redrives have delivered."""
    rows = spark.read.parquet(f"{out}/table_lineage").drop("batch_id")
    for v in versions(spark, f"{out}/redriven", "redrive="):
        rows = rows.unionByName(spark.read.parquet(f"{out}/redriven/redrive={v}/table_lineage").drop("batch_id"))
    return rows


def stream_lineage(plan_stream: DataFrame, out: str, checkpoint: str, policy: Policy = DEFAULT_POLICY,
                   available_now: bool = True, **kw):
    """Start the continuous lineage query; returns the StreamingQuery."""
    w = (plan_stream.writeStream.foreachBatch(lineage_batch_writer(out, policy, **kw))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


# ---------------------------------------------------------------------------
# Continuous catalog state


CHANGE = "scope string, db string, tbl string, event_id bigint, ts timestamp_ntz, seq int, change string"


def catalog_table(state: str) -> LogTable:
    """The last change of each object, and the last drop of each database (which stays known when the database is made
    anew: its older tables are gone)."""
    from pyspark.sql.types import _parse_datatype_string
    return LogTable(state, _parse_datatype_string(CHANGE), ["scope", "db", "tbl"], ["ts", "event_id", "seq"])


def catalog_batch_writer(state: str, databases: DataFrame | None = None):
    """``foreachBatch`` function: add a batch's changes to the state; what it writes follows the batch, not the state."""
    table = catalog_table(state)

    def run(batch: DataFrame, batch_id: int) -> None:
        ch = catalog_changes(batch, databases).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "seq", "change", "db", "tbl")
        drops = ch.where(F.col("change") == "DROP_DATABASE").withColumn("tbl", F.lit(None).cast("string"))
        table.write(ch.withColumn("scope", F.lit("object")).unionByName(drops.withColumn("scope", F.lit("drop"))), batch_id)
    return run


def stream_catalog(events_stream: DataFrame, state: str, checkpoint: str, databases: DataFrame | None = None,
                   available_now: bool = True):
    w = (events_stream.writeStream.foreachBatch(catalog_batch_writer(state, databases))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_catalog_state(spark: SparkSession, state: str) -> DataFrame:
    """Current catalog from the stored changes (C10 columns)."""
    if not versions(spark, state, "d="):
        raise FileNotFoundError(state)
    return catalog_state(catalog_table(state).read(spark).drop("scope").distinct())


# ---------------------------------------------------------------------------
# De-dup of redelivered rows


def dedupe_stream(df: DataFrame, keys=("event_id", "type_name", "qualified_name")) -> DataFrame:
    """Keep the first row of each ``keys``, whenever it or its repeats arrive.

    No event time takes part, so nothing counts as late and no first delivery
    is dropped.  The state holds every key seen (keyed, spread over the
    shuffle partitions, in the checkpoint)."""
    return df.dropDuplicates(list(keys))
