"""Tables that a stream keeps, the as-of stream, the re-sequencer, redrive and the notification log."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provena.operators.route import register_route, route_rules
from provena.session import Tables, scratch_path
from provena.sources.plan_log import plan_log
from provena.streaming import stream as S
from provena.streaming.asof_stream import EXECUTION, ROW, TEXT, AsofStream
from provena.streaming.resequence import Resequencer
from provena.streaming.store import BucketTable, LogTable, size, versions

from .conftest import SF_SMALL

KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("at", T.IntegerType()), T.StructField("v", T.StringType())])


def batches(rng, n, keys, rows):
    at = 0
    for _ in range(n):
        out = []
        for _ in range(rows):
            at += 1
            out.append((rng.choice([None, *map(str, range(keys))]), rng.choice([at, at, rng.randrange(at + 1)]), f"v{at}"))
        yield out


def newest(rows):
    top = {}
    for k, at, v in rows:
        top[k] = max(top.get(k, (-1, "")), (at, v))
    return {k: v for k, v in top.items()}


@pytest.mark.parametrize("kind", ["log", "bucket"])
def test_latest_rows_whatever_is_replayed(spark, tmp_path, kind):
    make = lambda p: LogTable(p, KV, ["k"], ["at"]) if kind == "log" else BucketTable(p, KV, ["k"], ["at"], 8)
    table, seen = make(str(tmp_path / kind)), []
    assert table.read(spark).count() == 0
    for n, rows in enumerate(batches(random.Random(5), 7, 40, 30)):
        df = spark.createDataFrame(rows, KV)
        for _ in range(1 + n % 3):  # a batch that is written again changes nothing
            table.write(df, n)
        seen += rows
        assert {r.k: (r.at, r.v) for r in table.read(spark).collect()} == newest(seen)
    table.write(spark.createDataFrame([], KV), 7)
    assert {r.k: (r.at, r.v) for r in table.read(spark).collect()} == newest(seen)


def test_a_batch_without_its_mark_is_not_read(spark, tmp_path):
    for kind in (LogTable, BucketTable):
        path = str(tmp_path / kind.__name__)
        table = kind(path, KV, ["k"], ["at"])
        table.write(spark.createDataFrame([("a", 1, "x")], KV), 0)
        table.write(spark.createDataFrame([("a", 2, "y"), ("b", 1, "z")], KV), 1)
        (tmp_path / kind.__name__ / ("d=1" if kind is LogTable else "v=1") / "_SUCCESS").unlink()
        if kind is LogTable:  # the batch died before it was folded into a base
            for b in versions(spark, path, "b="):
                (tmp_path / kind.__name__ / f"b={b}" / "_SUCCESS").unlink()
        assert [tuple(r) for r in table.read(spark).collect()] == [("a", 1, "x")]


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    table = BucketTable(str(tmp_path / "b"), KV, ["k"], ["at"], 32)
    assert len(table.write(spark.range(3000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("at"), F.lit("v").alias("v")), 0)) == 32
    for n in range(1, 4):
        assert len(table.write(spark.createDataFrame([("7", 1 + n, "w"), ("8", 1 + n, "w")], KV), n)) <= 2
        held = [p.name for p in (tmp_path / "b" / f"v={n}").iterdir() if p.name.startswith("bucket=")]
        assert len(held) <= 2
    assert table.read(spark).count() == 3000 and table.read(spark).where("v = 'w'").count() == 2


def test_what_a_trigger_writes_follows_the_batch(spark, tmp_path):
    """Small batches on a large table write deltas of their own size; the table is written anew when they outweigh it."""
    path = str(tmp_path / "log")
    table = LogTable(path, KV, ["k"], ["at"])
    one = lambda n, at: spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit(at).alias("at"), F.lit("v").alias("v"))
    table.write(one(40_000, 0), 0)
    table.write(one(10, 1), 1)  # the first base
    base = versions(spark, path, "b=")
    for n in range(2, 8):
        table.write(one(10, n), n)
        assert size(spark, f"{path}/d={n}") < size(spark, f"{path}/b={base[0]}") / 100
    assert versions(spark, path, "b=") == base
    assert table.read(spark).count() == 40_000 and table.read(spark).where("at = 7").count() == 10
    table.write(one(50_000, 8), 8)
    assert versions(spark, path, "b=") == [*base, 8]


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def plain_asof(rows):
    out = {}
    for kind, event, session, ts, _ in rows:
        if kind == EXECUTION:
            texts = [(t, x) for k, _, s, t, x in rows if k == TEXT and s == session and session is not None and ts is not None and t is not None and t <= ts]
            out[event] = max(texts)[1] if texts else None
    return out


@pytest.mark.parametrize("delay,shuffled", [(0, True), (40 * 60, True), (600 * 60, True), (30 * 60, False)])
def test_asof_stream_in_any_order(spark, tmp_path, delay, shuffled):
    rng = random.Random(delay + shuffled)
    rows = [(TEXT, None, rng.choice([1, 2, 3, None]), at(rng.randrange(500)), f"t{i}") for i in range(60)]
    rows += [(EXECUTION, i, rng.choice([1, 1, 2, 4, None]), at(rng.randrange(500)) if i % 9 else None, None) for i in range(90)]
    rng.shuffle(rows)
    if not shuffled:
        rows.sort(key=lambda r: (r[3] or at(0)) + dt.timedelta(minutes=rng.randrange(30)))
    run = AsofStream(str(tmp_path / "state"), str(tmp_path / "out"), delay)
    for n in range(5):
        df = spark.createDataFrame(rows[n * 30:n * 30 + 30], ROW)
        for _ in range(1 + (n == 2)):  # a replayed batch
            run.batch(df, n)
    run.finish(spark)
    got = {r.event_id: r.sql_text for r in run.answers(spark).collect()}
    assert got == plain_asof(rows)


MSG = T.StructType([T.StructField("key", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("value", T.StringType())])


def test_resequencer_order_gaps_and_replays(spark, tmp_path):
    rng = random.Random(8)
    rows = [(k, s, f"{k}{s}") for k, n in (("hot", 95), ("b", 12), ("c", 1), (None, 7)) for s in range(1, n + 1)]
    missing = {("hot", 41), ("b", 1)}
    sent = [r for r in rows if r[:2] not in missing]
    rng.shuffle(sent)
    sent += sent[:15]  # some come twice
    run = Resequencer(str(tmp_path / "state"), str(tmp_path / "out"), MSG, span=10)
    parts = [sent[i::6] for i in range(6)]
    for n, part in enumerate(parts):
        for _ in range(1 + (n == 3)):
            run.batch(spark.createDataFrame(part, MSG), n)
    released = spark.read.parquet(str(tmp_path / "out")).collect()
    for k, upto in (("hot", 40), ("b", 0), ("c", 1), (None, 7)):
        mine = sorted((r.batch_id, r.seq) for r in released if r.key == k)
        assert [s for _, s in mine] == list(range(1, upto + 1)), k
    assert {r.key: (r.missing, r.waiting) for r in run.gaps(spark).collect()} == {"hot": (41, 54), "b": (1, 11)}
    run.batch(spark.createDataFrame([("b", 1, "b1"), ("hot", 41, "hot41")], MSG), 6)
    released = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.key or "", r.seq, r.value) for r in released) == sorted((k or "", s, v) for k, s, v in rows)
    assert run.gaps(spark).count() == 0
    run.batch(spark.createDataFrame([], MSG), 7)


def test_redrive_delivers_once(spark):
    log = scratch_path(spark, "redrive_log")
    plan_log(Tables(spark, SF_SMALL)).write.parquet(log)
    log = spark.read.parquet(log)
    out = scratch_path(spark, "redrive")
    S.lineage_batch_writer(out)(log, 0)
    before = {r.event_id for r in S.delivered_lineage(spark, out).collect()}
    S.redrive(log, out, route_rules(spark), 1)  # nothing has come that would help
    assert S.delivered_lineage(spark, out).count() == len(before)
    rules = register_route(route_rules(spark), "OTHER")
    for number in (2, 2, 3):
        S.redrive(log, out, rules, number)
        got = [r.event_id for r in S.delivered_lineage(spark, out).collect()]
        assert len(got) == len(set(got)) > len(before)
    unsupported = {r.event_id for r in spark.read.parquet(f"{out}/quarantine").where("reason = 'UNSUPPORTED_COMMAND'").collect()}
    empty = {r.event_id for r in spark.read.parquet(f"{out}/redriven/redrive=2/quarantine").collect()}
    assert set(got) == before | (unsupported - empty)


def test_notification_log_topics_and_restart(spark, tmp_path):
    log, out, ck = (str(tmp_path / x) for x in ("log", "out", "ck"))

    def put(topic, a, b):
        S.append_notifications(spark.range(a, b).select(F.lit(topic).alias("topic"), F.col("id").cast("string").alias("key"), F.lit("v").alias("value")), log, 10)

    def run():
        feed = S.read_notification_log(spark, log, " a , ,b", rows_per_trigger=10, segment_rows=10)
        q = feed.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted((r.topic, int(r.key)) for r in spark.read.parquet(out).collect())

    put("a", 0, 35)
    put("b", 0, 5)
    put("c", 0, 9)
    assert run() == [("a", i) for i in range(35)] + [("b", i) for i in range(5)]
    put("b", 5, 25)
    assert run() == [("a", i) for i in range(35)] + [("b", i) for i in range(25)]
    assert run() == [("a", i) for i in range(35)] + [("b", i) for i in range(25)]
    with pytest.raises(ValueError):
        S.read_notification_log(spark, log, " , ")
