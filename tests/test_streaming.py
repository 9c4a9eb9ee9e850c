"""Streaming helpers: notification source (file form), keyed sink, live send
with retry and dead letter inside the lineage stream, catalog tag, DDL helpers."""

import os

from pyspark.sql import functions as F

from provena.operators import catalog as C
from provena.operators import deliver as D
from provena.operators import warehouse as W
from provena.session import Tables, scratch_path
from provena.sources.plan_log import plan_log
from provena.streaming import stream as S

from .conftest import SF_SMALL


def test_read_notifications_file_source(spark, tmp_path):
    src = str(tmp_path / "notes")
    spark.createDataFrame([("ATLAS_HOOK", "k1", "{}"), ("OTHER", "k2", "{}"), ("b", "k3", "{}")],
                          "topic string, key string, value string").write.json(src)
    schema = "topic string, key string, value string"
    df = S.read_notifications(spark, " ATLAS_HOOK , ,b ", fmt="json", path=src, schema=schema,
                              max_per_trigger=1)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
     .trigger(availableNow=True).start().awaitTermination())
    assert sorted(r.key for r in spark.read.parquet(out).collect()) == ["k1", "k3"]
    assert S.trimmed_topics(" a , ,b ") == "a,b"


def test_keyed_for_sink_numbers_each_key(spark):
    """The numbers of a key run through in event order, over all the ranges that it was cut into."""
    rows = [(i * 7 % 3001, "k" if i % 3 else "j", "v") for i in range(3000)]
    m = spark.createDataFrame(rows, "event_id int, key string, value string")
    got = D.keyed_for_sink(m).collect()
    for k in ("k", "j"):
        mine = sorted((r.seq, r.event_id) for r in got if r.key == k)
        assert [s for s, _ in mine] == list(range(1, len(mine) + 1)) and [e for _, e in mine] == sorted(e for _, e in mine)


def test_with_app_tag(spark):
    df = C.with_app(spark.range(1))
    r = df.first()
    assert r.app_name == spark.sparkContext.appName and r.master == spark.sparkContext.master


def test_stream_lineage_live_send_and_dead_letter(spark):
    src = scratch_path(spark, "plan_log_t")
    plan_log(Tables(spark, SF_SMALL)).repartition(2).write.parquet(src)
    sent, dead = scratch_path(spark, "sent"), scratch_path(spark, "dead")
    state = {"n": 0}

    def send(batch):
        state["n"] += 1
        if state["n"] == 1:
            raise RuntimeError("broker down")      # first attempt of the first batch fails
        batch.write.mode("append").parquet(sent)

    out, ck = scratch_path(spark, "out"), scratch_path(spark, "ck")
    q = S.stream_lineage(S.read_plan_log_stream(spark, src, max_files_per_trigger=1), out, ck, send=send,
                         dead_letter_path=dead)
    q.awaitTermination()
    msgs = spark.read.parquet(f"{out}/messages")
    assert spark.read.parquet(sent).count() == msgs.count() > 0
    assert not os.path.exists(dead)


def test_stream_lineage_replay_is_idempotent(spark):
    src = scratch_path(spark, "plan_log_r")
    plan_log(Tables(spark, SF_SMALL)).write.parquet(src)
    out = scratch_path(spark, "out_r")
    for _ in range(2):  # same batch id written twice (a replay after failure)
        S.lineage_batch_writer(out)(spark.read.parquet(src), 0)
    batch = spark.read.parquet(f"{out}/table_lineage")
    assert batch.count() == batch.select("event_id").distinct().count()


def test_ddl_helpers(spark):
    db = W.fresh_database(spark)
    W.ctas(spark.range(3).withColumnRenamed("id", "x"), f"{db}.a")
    W.create_like(spark, f"{db}.b", f"{db}.a")
    assert spark.table(f"{db}.b").count() == 0
    W.drop_table(spark, f"{db}.b")
    W.drop_table(spark, f"{db}.missing")          # IF EXISTS
    current = spark.catalog.currentDatabase()
    W.use_database(spark, db)
    assert spark.catalog.currentDatabase() == db
    W.use_database(spark, current)
    W.drop_database(spark, db)
    assert not spark.catalog.databaseExists(db)


def test_dedupe_stream_drops_redelivery(spark, tmp_path):
    # deliveries years apart and in no order of time, one file a trigger: every first one stays
    rows = [(i, f"{2000 + i * 7 % 20}-01-01 00:00:{i:02d}", "hive_process", f"p{i % 5}") for i in range(20)]
    df = (spark.createDataFrame(rows, "event_id bigint, ts string, type_name string, qualified_name string")
          .withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    src = str(tmp_path / "feed")
    for part in ("event_id < 9", "event_id BETWEEN 4 AND 15", "event_id > 7", "true"):
        df.where(part).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    (S.dedupe_stream(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
     .trigger(availableNow=True).start().awaitTermination())
    assert spark.read.parquet(out).count() == 20


def test_empty_batch_and_bad_plans(spark):
    """A batch without rows writes empty products; a plan that cannot be read is quarantined, the others go on."""
    src, out = scratch_path(spark, "plan_log_b"), scratch_path(spark, "out_b")
    plan_log(Tables(spark, SF_SMALL)).write.parquet(src)
    log = spark.read.parquet(src)
    S.lineage_batch_writer(out)(log.limit(0), 0)
    assert spark.read.parquet(f"{out}/table_lineage/batch_id=0").count() == 0
    good = {r.event_id for r in spark.read.parquet(src).select("event_id").collect()}
    some = sorted(good)[:40]
    bad = F.when(F.col("event_id") == some[0], "{not json").when(F.col("event_id") == some[1], "[{\"x\":")
    S.lineage_batch_writer(out)(log.where(F.col("event_id").isin(some)).withColumn(
        "plan_json", F.coalesce(bad, F.col("plan_json"))).withColumn("status", F.lit("SUCCESS")).withColumn(
        "command", F.lit("CreateHiveTableAsSelectCommand")), 1)
    reasons = {r.event_id: r.reason for r in spark.read.parquet(f"{out}/quarantine/batch_id=1").collect()}
    assert {i for i, r in reasons.items() if r == "BAD_PLAN"} == set(some[:2])
    assert spark.read.parquet(f"{out}/table_lineage/batch_id=1").count() == 38
