"""Tests of the findings of round 3; the two on equal rows (joins in an event, plan log and tables) guard the results."""

import os
import re

from pyspark.sql import functions as F


def _write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(os.path.join(folder, f"{name}.parquet"))


def test_external_csv_holds_names_and_a_folder_per_nation(spark, tmp_path):
    """every column of the customers is in the external table, which is partitioned by nation."""
    from provena.queries import QUERIES
    rows = [(i, f"Customer#{i}", i % 7, i / 2, "BUILDING") for i in range(40)]
    _write(spark, str(tmp_path), "customer", rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    got = QUERIES["external_csv_partitioned"](spark, str(tmp_path))
    assert got.columns == ["id", "name", "segment", "balance", "nation_no"]
    assert sorted(map(tuple, got.collect())) == [(i, n, s, b, k) for i, n, k, b, s in rows]
    folders = {re.search(r"nation_no=(\d+)", f).group(1) for f in got.inputFiles()}
    assert folders == {str(k) for k in range(7)}


def _tables(spark, folder, orders=60):
    """Own orders, line items and parts, with orders and parts that come twice and numbers that are null."""
    o = [(i, i % 9, ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")[i % 5]) for i in [*range(orders), 4, 6]]
    items = [(i, (i * 7 + j * 3) % 20, (i + j) % 6 if i % 4 else 5, j % 4 + 1 if j != 3 or i % 8 else None, "NAR"[(i + j) % 3]) for i in range(orders) for j in range(i % 6)]
    _write(spark, folder, "orders", o, "o_orderkey long, o_custkey long, o_orderpriority string")
    orders_df = spark.read.parquet(f"{folder}/orders.parquet").withColumn("o_orderdate", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"))
    orders_df.write.parquet(f"{folder}/dated/orders.parquet")
    _write(spark, f"{folder}/dated", "lineitem", items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string")
    _write(spark, f"{folder}/dated", "part", [(k % 20, ("PROMO", "LARGE")[k % 3 == 0]) for k in range(25)], "p_partkey long, p_type string")
    return f"{folder}/dated"


def _exchanges(spark, df):
    """Keys of the plan's exchanges when no side is small."""
    key, aqe = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"
    before = {k: spark.conf.get(k) for k in (key, aqe)}
    spark.conf.set(key, "-1")
    spark.conf.set(aqe, "false")
    try:
        text = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return [re.sub(r"#\d+L?", "", x).split(", ") for x in re.findall(r"(?<!Reused)Exchange hashpartitioning\(([^)]*?), \d+\)", text)]


def test_no_plan_is_moved_once_it_is_made(spark, tmp_path):
    """the log's rows are dealt by event before JSON is made of them."""
    from provena.session import Tables
    from provena.sources.plan_log import plan_log
    keys = _exchanges(spark, plan_log(Tables(spark, _tables(spark, str(tmp_path)))))
    assert keys and all(k in (["event_id"], ["l_orderkey"], ["o_orderkey"], ["pk"]) for k in keys)


def test_columns_are_resolved_where_their_event_lies(spark, tmp_path):
    """No exchange by attribute, place or branch."""
    from provena.queries import lineage
    keys = _exchanges(spark, lineage(spark, _tables(spark, str(tmp_path))).column_lineage)
    assert keys and not any(k for k in keys if any(x in " ".join(k) for x in ("attr", "pos", "branch", "root_kind")))


def test_joins_in_an_event_are_those_of_its_keys(spark):
    """Rows that repeat, null numbers and events of one side only come out as with an equality of both columns."""
    from provena.operators.lineage import join_in_event
    a = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, None, "c"), (1, 2, "d"), (None, 1, "e"), (2, 7, "f")], "event_id long, k long, x string")
    b = spark.createDataFrame([(1, 1, "p"), (1, 1, "q"), (1, None, "r"), (None, 1, "s"), (3, 7, "t")], "event_id long, k long, y string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got, want = join_in_event(a, b, ["k"], how), a.join(b, ["event_id", "k"], how)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_plan_log_gives_the_lineage_of_its_tables(spark, tmp_path):
    """The log of tables with repeats and nulls holds the same lineage as the tables."""
    from provena.plans.in_row import PlanLineage
    from provena.queries import lineage
    from provena.session import Tables
    from provena.sources.plan_log import plan_log
    d = _tables(spark, str(tmp_path))
    cols = ("event_id", "target_qn", "inputs")
    tables = lineage(spark, d).good.select(*cols).collect()
    assert tables and sorted(map(str, PlanLineage(plan_log(Tables(spark, d))).good.select(*cols).collect())) == sorted(map(str, tables))


def test_a_bucket_is_written_by_several_tasks(spark, tmp_path):
    """few buckets, many rows: more tasks than buckets share the merge, and each key stays in one place."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from provena.streaming.store import BucketTable
    schema = StructType([StructField("k", StringType()), StructField("at", LongType()), StructField("v", StringType())])
    table = BucketTable(str(tmp_path / "b"), schema, ["k"], ["at"], 2)
    for n in range(2):
        table.write(spark.range(2000).select(F.col("id").cast("string").alias("k"), F.lit(n).cast("long").alias("at"), F.lit("v").alias("v")), n)
    parts = {f for b in (tmp_path / "b" / "v=1").iterdir() if b.is_dir() for f in (p.name.split("-")[1] for p in b.glob("part-*"))}
    assert len(parts) > 2
    got = table.read(spark)
    assert got.count() == 2000 and got.where("at = 1").select("k").distinct().count() == 2000


def test_branches_are_numbered_before_their_nodes_are_made(spark, tmp_path):
    """what is moved and sorted is the line items, not the nodes made of them."""
    from provena.session import Tables
    from provena.sources import fixtures as fx
    text = fx.plan_branch(Tables(spark, _tables(spark, str(tmp_path))))._jdf.queryExecution().optimizedPlan().toString()
    assert "named_struct" not in text[text.index("Window"):] and "DataWritingCommandExec" not in text[text.index("Window"):]


def test_feed_stages_each_message_once(spark, tmp_path, monkeypatch):
    """the topics' copies are made as the log is written; the staged messages go when the log has them, and no text is
    dealt anew."""
    from provena import streaming_queries as Q
    from provena.queries import QUERIES, lineage
    d, staged = _tables(spark, str(tmp_path)), []
    real = Q.remove
    monkeypatch.setattr(Q, "remove", lambda s, path: (staged.append(s.read.parquet(path).count()), real(s, path)))
    got = {tuple(r) for r in QUERIES["notification_feed"](spark, d).collect()}
    good = [(r.event_id, r.target_qn) for r in lineage(spark, d).good.select("event_id", "target_qn").collect()]
    want = {}
    for event, key in good:
        for topic in ("ATLAS_HOOK", *(("OTHER_TOPIC",) if event % 3 == 0 else ())):
            want[topic, key] = want.get((topic, key), 0) + 1
    assert staged == [len(good)] and got == {(t, k, n) for (t, k), n in want.items()}
