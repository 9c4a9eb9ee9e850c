"""Tests of the findings of round 4 (F1 stream_entities, F2 dead_letters: the stream that both read); those on equal rows guard the results."""

import os

from pyspark.sql import functions as F


def _write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(os.path.join(folder, f"{name}.parquet"))


def _tables(spark, folder):
    """Own orders, line items and parts: rows that come twice, parts of two kinds or none, and nulls in every column."""
    priorities = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None)
    orders = [(i, i % 9 if i % 11 else None, priorities[i % 6]) for i in [*range(90), 4, 6]] + [(None, 1, "2-HIGH")]
    items = [(i if i % 13 else None, (i * 7 + j * 3) % 24 if (i + j) % 9 else None, (i + j) % 25 if i % 4 else 5, j % 3 + 1 if j != 3 or i % 8 else None,
              "NAR"[(i * j) % 3] if (i + 2 * j) % 10 else None) for i in range(90) for j in range(i % 6)]
    items += [(i, p, None if j % 5 == 0 else s, n, f) for j, (i, p, s, n, f) in enumerate(items[::4])] + items[::7]
    _write(spark, folder, "dated", orders, "o_orderkey long, o_custkey long, o_orderpriority string")
    spark.read.parquet(f"{folder}/dated.parquet").withColumn("o_orderdate", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")).write.parquet(f"{folder}/orders.parquet")
    _write(spark, folder, "lineitem", items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string")
    parts = [(k % 20, ("PROMO", "LARGE", None)[k % 3]) for k in range(35)] + [(None, "PROMO")]
    _write(spark, folder, "part", parts, "p_partkey long, p_type string")
    return folder


def _log(spark, folder):
    from provena.session import Tables
    from provena.sources.plan_log import plan_log
    return plan_log(Tables(spark, _tables(spark, folder)))


def _plan(df, kind):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_plan_log_holds_the_rows_of_the_event_tables(spark, tmp_path):
    """written in the event's row, the log is the one of the event tables, text by text."""
    from provena.session import Tables
    from provena.sources import fixtures as fx
    from provena.sources.plan_log import plan_log_from
    log, t = _log(spark, str(tmp_path)), Tables(spark, str(tmp_path))
    want = plan_log_from(fx.write_event(t), fx.scan_relation(t), fx.scan_column(t), fx.output_expr(t), fx.output_leaf(t))
    assert log.columns == want.columns
    got = sorted(map(str, log.collect()))
    assert len(got) > 90 and got == sorted(map(str, want.collect()))
    for word in ("LogicalRDD", '"projectList":[]', '"output":[]', "Coalesce", "expressions.Add", "Literal", '"partitionColumnNames":["'):
        assert any(word in x for x in got), word


def test_plan_log_puts_an_event_together_once(spark, tmp_path):
    """one list of line items per event, and no row made for each node of a plan."""
    plan = _plan(_log(spark, str(tmp_path)), "optimizedPlan")
    assert plan.count("collect_list(") == 1 and "StructsToJson" not in plan and "to_json" not in plan


def test_harvest_copies_no_parsed_plan(spark, tmp_path):
    """no step keeps the parsed plan as a column of its own; few steps follow one another."""
    from provena.plans.in_row import harvest
    rows = harvest(_log(spark, str(tmp_path)).limit(10))
    text = _plan(rows, "optimizedPlan")
    assert text.count("from_json") == 1
    above = text[:text.index("from_json")]
    assert above.count("Project [") <= 2


def test_messages_are_made_in_one_step(spark, tmp_path):
    """the entities of a message are no column before its text is made."""
    from provena.operators.deliver import to_messages
    from provena.plans.in_row import PlanLineage
    path = str(tmp_path / "rows")
    (tmp_path / "t").mkdir()
    lin = PlanLineage(_log(spark, str(tmp_path / "t"))).stage(path)
    msgs = to_messages(lin)
    text = _plan(msgs, "optimizedPlan")
    first, *below = text.split("Project [")[1:]
    assert "StructsToJson" in first and below and not any("hive_process" in x for x in below)
    sizes = [(r.n, r.n_entities, r.first_type, r.first) for r in msgs.select(
        F.size(F.from_json("value", "struct<entities:struct<entities:array<struct<typeName:string>>>>")["entities"]["entities"]).alias("n"),
        "n_entities", "first_type", F.get_json_object("value", "$.entities.entities[0].typeName").alias("first")).collect()]
    assert sizes and all(n == m and a == b for n, m, a, b in sizes)


def test_latest_entities_are_those_of_all_entities(spark, tmp_path):
    """an entity is built of the row that is kept; ties go as they do among whole entities."""
    from provena.plans.in_row import PlanLineage
    from provena.streaming.store import latest
    from provena.streaming.stream import ENTITY_KEYS, entity_table
    (tmp_path / "t").mkdir()
    log = _log(spark, str(tmp_path / "t"))
    # several executions of one number, at one time, with other texts and commands: only the later fields tell them apart
    again = log.where("event_id % 3 = 0").withColumn("sql_text", F.concat(F.coalesce("sql_text", F.lit("a")), F.lit("z")))
    other = log.where("event_id % 4 = 1").withColumn("command", F.lit("InsertIntoHiveTable"))
    twice = log.unionByName(again).unionByName(other).withColumn("event_id", F.expr("event_id - event_id % 5"))
    lin = PlanLineage(twice).stage(str(tmp_path / "rows"))
    got, want = lin.latest_entities(), latest(lin.entities, ENTITY_KEYS, ["ts", "event_id"])
    moved = [x for x in _plan(got, "optimizedPlan").split("\n") if "Aggregate" in x]
    assert moved and "attributes" not in moved[0]
    want_rows = sorted(map(str, want.select(*got.columns).collect()))
    assert len(want_rows) > 30 and sorted(map(str, got.collect())) == want_rows
    one, two = entity_table(spark, str(tmp_path / "one"), 4), entity_table(spark, str(tmp_path / "two"), 4)
    for n in range(2):
        one.write(lin.entities, n)
        two.write(lin.latest_entities(), n, unique=True)
    assert sorted(map(str, one.read(spark).collect())) == sorted(map(str, two.read(spark).collect()))
