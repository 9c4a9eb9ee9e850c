"""Streaming twins of the batch queries (T1, T2, T6, K12 via the stream).

Each query writes its input (derived from the driver tables) as several
files in the shared scratch folder, runs the stream to completion with the
``availableNow`` trigger and small ``maxFilesPerTrigger`` (so state and
batching are exercised) and returns what the sink holds.  The oracle is the
batch twin's SQL: stream = batch.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import constants as K
from .oracle import with_views
from .queries import ORACLE, lineage, plan_log_path, query
from .session import Tables, scratch_path
from .sources import fixtures as fx
from .streaming import stream as S
from .streaming.store import remove

TRIGGERS = 3  # about how many micro-batches each run takes


def _files(spark) -> int:
    """Input files: one per shuffle partition."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _per_trigger(files: int) -> int:
    return max(1, -(-files // TRIGGERS))


_STREAM_OUT: dict = {}


def refusing_sink(tries: str):
    """A sink that refuses a message as often as a hash of it says (0 to 4 times), and counts what it was offered."""
    def send(messages):
        spark = messages.sparkSession
        messages.select("event_id").write.mode("append").parquet(tries)
        times = spark.read.parquet(tries).groupBy("event_id").agg(F.count(F.lit(1)).alias("times"))
        refusals = F.pmod(F.col("event_id") * 7919 + F.length("key"), F.lit(5))
        return messages.join(times, "event_id").where(F.col("times") <= refusals).drop("times")
    return send


def _lineage_stream(spark, sf_dir) -> str:
    """Run the lineage stream over the plan log once per session and folder;
    the stream queries read its products."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STREAM_OUT:
        src = plan_log_path(spark, sf_dir)
        out, ck, tries = (scratch_path(spark, f"lineage_{x}") for x in ("out", "ck", "tries"))
        S.stream_lineage(S.read_plan_log_stream(spark, src, max_files_per_trigger=_per_trigger(_files(spark))), out, ck, send=refusing_sink(tries),
                         dead_letter_path=f"{out}/dead", entities=S.entity_table(spark, f"{out}/entities", 16), retry_interval_ms=0).awaitTermination()
        _STREAM_OUT[key] = out
    return _STREAM_OUT[key]


@query("stream_table_lineage", ORACLE["table_lineage"])
def stream_table_lineage(spark, sf_dir):
    out = _lineage_stream(spark, sf_dir)
    r = spark.read.parquet(f"{out}/table_lineage")
    return r.select("event_id", "target_qn", F.array_join("inputs", "|").alias("inputs"),
                    F.col("n_inputs").cast("bigint").alias("n_inputs"))


@query("stream_column_lineage", ORACLE["column_lineage"])
def stream_column_lineage(spark, sf_dir):
    out = _lineage_stream(spark, sf_dir)
    c = spark.read.parquet(f"{out}/column_lineage")
    return c.select("event_id", "branch", "lineage_id", F.array_join("inputs", "|").alias("inputs"), "dep_type",
                    "expression")


@query("stream_envelope_sizes", ORACLE["envelope_sizes"])
def stream_envelope_sizes(spark, sf_dir):
    out = _lineage_stream(spark, sf_dir)
    m = spark.read.parquet(f"{out}/messages")
    return m.select("topic", "key", F.col("n_entities").cast("bigint").alias("n_entities"), "first_type")


REFUSALS = "(event_id * 7919 + length(target_qn)) % 5"


@query("delivery_status", with_views(f"""
SELECT event_id AS msg_id, CAST(least({REFUSALS} + 1, {K.MAX_RETRIES}) AS INT) AS attempts_used, {REFUSALS} < {K.MAX_RETRIES} AS delivered
FROM ox_good""", "ox_good"))
def delivery_status_q(spark, sf_dir):
    """What the stream's ledger says of every message, sent to a sink that refuses some of them some times."""
    from .operators.deliver import delivery_status, read_ledger
    return delivery_status(read_ledger(spark, f"{_lineage_stream(spark, sf_dir)}/ledger"))


@query("stream_delivery", with_views(f"""
SELECT CAST(a.attempt AS INT) AS attempt, count(*) AS tried, CAST(sum(CASE WHEN {REFUSALS} < a.attempt THEN 1 ELSE 0 END) AS BIGINT) AS delivered
FROM ox_good, (SELECT unnest(range(1, {K.MAX_RETRIES + 1})) AS attempt) a WHERE {REFUSALS} >= a.attempt - 1 GROUP BY a.attempt""", "ox_good"))
def stream_delivery(spark, sf_dir):
    """Per attempt how many messages the stream tried and delivered; only what failed was tried again."""
    from .operators.deliver import read_ledger
    led = read_ledger(spark, f"{_lineage_stream(spark, sf_dir)}/ledger")
    return led.groupBy("attempt").agg(F.count(F.lit(1)).alias("tried"), F.sum(F.col("delivered").cast("int")).alias("delivered"))


@query("dead_letters", with_views(f"""
SELECT event_id AS msg_id, {K.MAX_RETRIES} AS last_attempt FROM ox_good WHERE {REFUSALS} >= {K.MAX_RETRIES}""", "ox_good"))
def dead_letters_q(spark, sf_dir):
    """The messages that the last attempt left."""
    d = spark.read.parquet(f"{_lineage_stream(spark, sf_dir)}/dead")
    return d.select(F.col("event_id").alias("msg_id"), "last_attempt")


@query("stream_dead_letters", with_views(f"""
SELECT '{K.HOOK_TOPIC}' AS topic, target_qn AS key, count(*) AS n FROM ox_good WHERE {REFUSALS} >= {K.MAX_RETRIES} GROUP BY target_qn""", "ox_good"))
def stream_dead_letters(spark, sf_dir):
    """Dead letters by topic and key, their text complete."""
    d = spark.read.parquet(f"{_lineage_stream(spark, sf_dir)}/dead")
    whole = F.from_json("value", "struct<type:string>")["type"] == K.MESSAGE_TYPE
    return d.where(whole).groupBy("topic", "key").agg(F.count(F.lit(1)).alias("n"))


@query("stream_entities", ORACLE["dedupe_entities"])
def stream_entities(spark, sf_dir):
    """A5 in the stream: the entity table that the batches left, the latest event of each entity."""
    out = _lineage_stream(spark, sf_dir)
    return S.entity_table(spark, f"{out}/entities", 16).read(spark).select("type_name", "qualified_name", "event_id")


@query("redrive_unsupported", with_views("""
SELECT e.event_id, e.target_qn, 'QUERY:' || e.inputs_colon || '->:INSERT_OVERWRITE:' || e.target_qn AS process_qn
FROM ox_events e WHERE e.route = 'UNSUPPORTED' AND e.n_inputs > 0 AND e.event_id % 2 = 0
UNION ALL SELECT event_id, target_qn, process_qn FROM ox_good""", "ox_events", "ox_good"))
def redrive_unsupported(spark, sf_dir):
    """T4 + X-H: a rule for the unsupported command comes later, first for a log of half its executions; the same
    redrive is run twice, and then once more under the next version.  Every execution is delivered once."""
    from .operators.route import register_route, route_rules
    out = scratch_path(spark, "redrive_out")
    log = spark.read.parquet(plan_log_path(spark, sf_dir))
    S.lineage_batch_writer(out)(log, 0)
    rules = register_route(route_rules(spark), "OTHER")
    half = log.where(F.col("event_id") % 2 == 0)
    for number in (1, 1, 2):
        S.redrive(half, out, rules, number)
    return S.delivered_lineage(spark, out).select("event_id", "target_qn", "process_qn")


@query("stream_sql_text_asof", ORACLE["sql_text_asof"])
def stream_sql_text_asof(spark, sf_dir):
    """J1 in a stream: texts and executions in files of ranges of time that come in any order, and are shuffled themselves;
    the answer is the batch's."""
    from .operators.asof import micros
    from .streaming.asof_stream import EXECUTION, ROW, TEXT, AsofStream
    t = Tables(spark, sf_dir)
    texts = fx.sql_text(t).select(F.lit(TEXT).alias("kind"), F.lit(None).cast("bigint").alias("event_id"), "session_id", "ts", "sql_text")
    asks = fx.exec_event(t).select(F.lit(EXECUTION).alias("kind"), "event_id", "session_id", "ts", F.lit(None).cast("string").alias("sql_text"))
    rows = texts.unionByName(asks)
    # a row comes up to two hours after its time, and the stream takes the files as they happen to be written
    delay = 2 * 3600
    arrival = micros("ts") + F.pmod(F.xxhash64("session_id", "ts"), F.lit(delay * 1_000_000))
    src = scratch_path(spark, "asof_rows")
    files = _files(spark)
    placed = rows.withColumn("arrival", arrival).repartitionByRange(files, "arrival")
    ordered = placed.sortWithinPartitions(F.xxhash64("arrival")).drop("arrival")
    ordered.select(*(F.col(f.name).cast(f.dataType) for f in ROW.fields)).write.parquet(src)
    out, ck = scratch_path(spark, "asof_out"), scratch_path(spark, "asof_ck")
    run = AsofStream(scratch_path(spark, "asof_state"), out, delay)
    run.start(spark.readStream.schema(ROW).option("maxFilesPerTrigger", _per_trigger(files)).parquet(src), ck).awaitTermination()
    run.finish(spark)
    return run.answers(spark).select("event_id", "sql_text", micros("sql_ts").alias("sql_us"))


@query("ordered_messages", with_views("""
SELECT target_qn AS key, row_number() OVER (PARTITION BY target_qn ORDER BY event_id) AS seq, event_id, true AS in_order FROM ox_good""", "ox_good"))
def ordered_messages(spark, sf_dir):
    """T5 at the reader: numbered messages from files in no order come out per key in the order of events, batch after batch."""
    from .operators.deliver import keyed_for_sink, to_messages
    from .streaming.resequence import Resequencer
    src = scratch_path(spark, "numbered")
    files = _files(spark)
    numbered = keyed_for_sink(to_messages(lineage(spark, sf_dir))).select("key", F.col("seq").cast("bigint").alias("seq"), "event_id")
    numbered.repartition(files, F.xxhash64("key", "seq")).write.parquet(src)
    schema = spark.read.parquet(src).schema
    out, ck = scratch_path(spark, "ordered_out"), scratch_path(spark, "ordered_ck")
    run = Resequencer(scratch_path(spark, "ordered_state"), out, schema, span=16)
    run.start(spark.readStream.schema(schema).option("maxFilesPerTrigger", _per_trigger(files)).parquet(src), ck).awaitTermination()
    got = spark.read.parquet(out)
    # a batch's messages of a key come right after those of the batches before it
    per = got.groupBy("key", "batch_id").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("key").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.withColumn("in_order", (F.col("lo") == before + 1) & (F.col("hi") == before + F.col("n"))).select("key", "batch_id", "in_order")
    return got.join(per, ["key", "batch_id"]).select("key", "seq", "event_id", "in_order")


@query("stream_catalog_state", ORACLE["catalog_state"])
def stream_catalog_state(spark, sf_dir):
    src = scratch_path(spark, "catalog_log")
    fx.catalog_event(Tables(spark, sf_dir)).repartition(_files(spark), "event_id").write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", _per_trigger(_files(spark))).parquet(src)
    state, ck = scratch_path(spark, "catalog_state"), scratch_path(spark, "catalog_ck")
    S.stream_catalog(stream, state, ck).awaitTermination()
    return S.read_catalog_state(spark, state)


ENTITY_KEYS_SQL = with_views("""
SELECT DISTINCT event_id, type_name, qualified_name FROM (
  SELECT event_id, 'hive_process' AS type_name, process_qn AS qualified_name FROM ox_good
  UNION ALL SELECT event_id, 'hive_column_lineage', lineage_id FROM ox_colineage) e""", "ox_good", "ox_colineage")


@query("stream_dedupe", ENTITY_KEYS_SQL)
def stream_dedupe(spark, sf_dir):
    ents = lineage(spark, sf_dir).entities.select("event_id", "ts", "type_name", "qualified_name")
    src = scratch_path(spark, "entity_feed")
    # every row twice, the two deliveries in files of their own and the files in no order of time, so that first
    # deliveries and repeats of all times meet in every trigger
    twice = ents.withColumn("delivery", F.explode(F.array(F.lit(0), F.lit(1))))
    twice.repartition(_files(spark), F.xxhash64("event_id", "qualified_name", "delivery")).drop("delivery").write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", _per_trigger(_files(spark))).parquet(src)
    out, ck = scratch_path(spark, "dedupe_out"), scratch_path(spark, "dedupe_ck")
    q = (S.dedupe_stream(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select("event_id", "type_name", "qualified_name")


@query("notification_feed", with_views("""
SELECT t.topic, target_qn AS key, count(*) AS n_messages FROM ox_good, (VALUES ('ATLAS_HOOK'), ('OTHER_TOPIC')) t(topic)
WHERE t.topic = 'ATLAS_HOOK' OR event_id % 3 = 0 GROUP BY t.topic, target_qn""", "ox_good"))
def notification_feed(spark, sf_dir):
    """S10 + T3: a log of three topics, two of them subscribed by a list that needs trimming, each with an offset of its
    own and bounded intake per trigger.  The stream stops when the log is half written and starts again from its
    checkpoint when the rest is there: every message of the subscribed topics arrives once."""
    from .operators.deliver import to_messages
    msgs = to_messages(lineage(spark, sf_dir)).select("event_id", "topic", "key", "value")
    log = scratch_path(spark, "notification_log")
    staged = scratch_path(spark, "notifications")
    msgs.write.option("compression", "zstd").parquet(staged)  # each message once; the topics' copies are made as the log is written
    hook = spark.read.parquet(staged)
    second = hook.where(F.col("event_id") % 3 == 0).withColumn("topic", F.lit("OTHER_TOPIC"))
    rows = hook.unionByName(second).unionByName(hook.withColumn("topic", F.lit("NOT_ASKED_FOR")))
    # as many triggers for a long log as for a short one: Spark keeps files for every trigger and every segment
    intake = max(2000, -(-hook.count() // (2 * TRIGGERS)))
    segment = max(500, min(S.SEGMENT_ROWS, intake // 4))
    out, ck = scratch_path(spark, "notifications_out"), scratch_path(spark, "notifications_ck")
    for half in (0, 1):
        S.append_notifications(rows.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half), log, segment_rows=segment)
        if half == 1:
            remove(spark, staged)  # the log holds it all
        feed = S.read_notification_log(spark, log, f" {K.HOOK_TOPIC} , ,OTHER_TOPIC,", rows_per_trigger=intake, segment_rows=segment)
        (feed.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).option("compression", "zstd")
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return (spark.read.parquet(out).groupBy("topic", "key")
            .agg(F.count(F.lit(1)).alias("n_messages")))
