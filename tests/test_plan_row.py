"""Plans in their own row: trees, expression texts and lineage, against plain versions and against the joins."""

import json
import random

from pyspark.sql import functions as F

from provena.operators.deliver import to_messages
from provena.operators.lineage import Lineage
from provena.operators.route import STRICT_POLICY, register_route, route_rules
from provena.plans.capture import capture, plan_log
from provena.plans.in_row import PlanLineage, harvest
from provena.plans.shred import event_tables_from_plans, output_texts
from provena.plans.tree import classify_plans, plan_nodes, plan_trees
from provena.functions.names import strip_expr_ids
from provena.session import Tables, scratch_path
from provena.sources.plan_log import plan_log as derived_log

from .conftest import SF_SMALL

KINDS = ["UnionExec", "DataWritingCommandExec", "FileSourceScanExec", "ExecutedCommandExec", "WriteToDataSourceV2Exec"]


def random_tree(rng, depth=0):
    kids = [random_tree(rng, depth + 1) for _ in range(rng.choice([0, 0, 1, 1, 2, 4]) if depth < 7 else 0)]
    return rng.choice(KINDS), kids


def flat(tree, at=0, parent=None):
    """(node_pos, parent_pos, last_pos, cls, children) in pre-order, by walking the tree."""
    cls, kids = tree
    out, here = [], at
    at += 1
    for k in kids:
        part = flat(k, at, here)
        out += part
        at += len(part)
    return [(here, parent, at - 1, cls, len(kids)), *out]


def as_json(nodes):
    return json.dumps([{"class": f"org.apache.spark.sql.execution.{c}", "num-children": n} for _, _, _, c, n in nodes])


def test_trees_of_random_plans(spark):
    rng = random.Random(3)
    plans = {i: flat(random_tree(rng)) for i in range(150)}
    plans[900] = flat(("UnionExec", [("DataWritingCommandExec", [("FileSourceScanExec", [])])] * 300))  # wide
    chain = ("FileSourceScanExec", [])
    for _ in range(300):
        chain = ("DataWritingCommandExec", [chain])
    plans[901] = flat(chain)  # deep
    log = spark.createDataFrame([(i, as_json(p)) for i, p in plans.items()], "event_id long, plan_json string")
    got = {}
    for r in plan_nodes(log).collect():
        got.setdefault(r.event_id, []).append((r.node_pos, r.parent_pos, r.last_pos, r.cls))
    assert {i: sorted(p) for i, p in got.items()} == {i: [x[:4] for x in p] for i, p in plans.items()}
    for r in classify_plans(log).collect():
        p = plans[r.event_id]
        cls = {x[0]: x[3] for x in p}
        writes = sum(1 + (cls.get(x[1]) == "UnionExec") for x in p if x[3] == "DataWritingCommandExec")
        assert (r.n_write_cmds, r.has_write) == (writes, writes > 0)
        assert r.has_ddl == ("ExecutedCommandExec" in cls.values()) and r.has_v2 == ("WriteToDataSourceV2Exec" in cls.values())


def test_plans_that_are_no_tree(spark):
    node = lambda c, n: {"class": c, "num-children": n}
    texts = {1: None, 2: "", 3: "{no json", 4: "[]", 5: json.dumps([node("A", 2), node("B", 0)]), 6: json.dumps([node("A", 0), node("B", 0)]),
             7: json.dumps([node("A", 1), node("B", 0)])}
    log = spark.createDataFrame(list(texts.items()), "event_id long, plan_json string")
    trees = {r.event_id: r.tree for r in plan_trees(log).collect()}
    assert {i for i, t in trees.items() if t} == {7} and trees[4] == [] and trees[5] is None and trees[6] is None
    assert {r.event_id for r in plan_nodes(log).collect()} == {7}
    assert classify_plans(log.limit(0)).count() == 0


def test_no_exchange_from_plan_to_messages(spark):
    log = spark.read.parquet(_stored_log(spark))
    lin = PlanLineage(log)
    for df in (lin.column_lineage, lin.good, lin.quarantine, lin.column_entities, to_messages(lin)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan, plan


_LOG: dict = {}


def _stored_log(spark):
    if "path" not in _LOG:
        _LOG["path"] = scratch_path(spark, "plan_row_log")
        derived_log(Tables(spark, SF_SMALL)).write.parquet(_LOG["path"])
    return _LOG["path"]


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_in_row_is_what_the_joins_say(spark):
    log = spark.read.parquet(_stored_log(spark))
    rules = register_route(route_rules(spark), "OTHER")
    for kw in ({}, {"policy": STRICT_POLICY}, {"rules": rules}):
        a, b = PlanLineage(log, **kw), Lineage(event_tables_from_plans(log), **kw)
        cols = [c for c in a.column_lineage.columns]
        assert rows(a.column_lineage) == rows(b.column_lineage.select(*cols)) and a.column_lineage.count() > 0
        assert rows(a.quarantine) == rows(b.quarantine)
        good = ["event_id", "process_qn", "target_qn", "op_type", "inputs", "n_inputs", "query_text", "root_kind"]
        assert rows(a.good.select(*good)) == rows(b.good.select(*good))
        assert rows(to_messages(a)) == rows(to_messages(b))
        assert rows(a.entities) == rows(b.entities)
    staged = PlanLineage(log).stage(scratch_path(spark, "plan_row_stage"))
    assert rows(staged.column_lineage) == rows(PlanLineage(log).column_lineage)


def test_expression_texts_are_spark_s_own(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS expr_source (n INT, big BIGINT, w DOUBLE, s STRING, day DATE, p STRUCT<a: INT, b: STRUCT<c: STRING>>, "
              "list ARRAY<INT>, price DECIMAL(8,2)) USING parquet")
    items = ["n + big * 2", "-w / (n - 1)", "n % 3 = 0 OR NOT (w > 1 AND s IS NULL)", "p.b.c", "p.a + 1", "list[2]", "concat(s, '-', s)",
             "CASE n WHEN 1 THEN 'a' WHEN 2 THEN 'b' END", "CASE WHEN w < 0 THEN w ELSE abs(w) END", "if(n <=> 3, s, upper(s))", "n IN (1, 2, 3)",
             "coalesce(s, 'none')", "cast(price AS INT)", "cast(n AS STRING) || s", "date_add(day, 7)", "year(day) div 10", "trim(s)", "ltrim(s)",
             "substring(s, 2, 3)", "regexp_replace(s, 'a+', 'b')", "round(price, 1)", "concat_ws('/', s, s)", "s LIKE '%a_b%'", "named_struct('k', n)",
             "day > DATE '2024-02-29'", "price * 2", "null", "length(s) & 3", "transform(list, x -> x + n)"]
    sql = "SELECT " + ", ".join(f"{x} AS c{i}" for i, x in enumerate(items)) + " FROM expr_source"
    row = capture(spark.sql(sql), 1, "InsertIntoHiveTable", "t")
    log = plan_log(spark, [row])
    got = {r.out_pos: r.expression for r in output_texts(log).select("out_pos", strip_expr_ids("expression").alias("expression")).collect()}
    want = spark.createDataFrame(list(enumerate(row.expr_texts)), "out_pos int, t string").select("out_pos", strip_expr_ids("t").alias("t")).collect()
    assert got == {r.out_pos: r.t for r in want if r.t}
    # without the session's own texts, lineage takes the ones of the plan
    plain = lambda df: rows(df.select("lineage_id", "inputs", "dep_type", strip_expr_ids("expression")))
    assert plain(PlanLineage(log.withColumn("expr_texts", F.lit(None).cast("array<string>"))).column_lineage) == plain(PlanLineage(log).column_lineage)
    assert plain(PlanLineage(log.drop("expr_texts")).column_lineage) == plain(PlanLineage(log).column_lineage)


def test_unread_null_and_empty_plans(spark):
    log = spark.read.parquet(_stored_log(spark)).where("status = 'SUCCESS' AND command = 'CreateHiveTableAsSelectCommand'").limit(4)
    ids = sorted(r.event_id for r in log.collect())
    bad = F.when(F.col("event_id") == ids[0], "{no").when(F.col("event_id") == ids[1], F.lit(None)).when(F.col("event_id") == ids[2], "[]")
    kept = log.withColumn("plan_json", F.when(F.col("event_id") == ids[3], F.col("plan_json")).otherwise(bad))
    got = {r.event_id: (r.root_kind, r.reason, len(r.columns), r.n_inputs) for r in harvest(kept).collect()}
    assert got[ids[0]] == ("BAD_PLAN", "BAD_PLAN", 0, 0) or got[ids[0]][1] == "BAD_PLAN"
    assert got[ids[1]][:3] == ("OTHER", None, 0) and got[ids[2]][:3] == ("OTHER", None, 0)
    assert harvest(log.limit(0)).count() == 0
