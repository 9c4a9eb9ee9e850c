"""Golden lineage of statements over a small measuring network, captured live from Spark's optimized plans and shredded
by the engine.  The statements are chosen for the cells of the emission matrix; the expected rows are worked out by hand."""

import pytest
from pyspark.sql import functions as F

from provena.functions.names import strip_expr_ids
from provena.operators.lineage import Lineage
from provena.operators.route import DEFAULT_POLICY, STRICT_POLICY
from provena.plans.capture import capture, plan_log
from provena.plans.shred import event_tables_from_plans

CTAS = "CreateHiveTableAsSelectCommand"
INSERT = "InsertIntoHiveTable"
DS_CTAS = "CreateDataSourceTableAsSelectCommand"


@pytest.fixture(scope="module")
def wh(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lab")
    spark.sql("CREATE TABLE IF NOT EXISTS lab.reading (Level DOUBLE, probe BIGINT, at STRUCT<x: INT, y: INT>, marks ARRAY<STRING>, "
              "taken DATE) USING parquet PARTITIONED BY (taken)")
    spark.sql("CREATE TABLE IF NOT EXISTS lab.probe (probe BIGINT, model STRING, fitted DATE, `limit` DOUBLE) USING parquet")
    spark.createDataFrame([(1.5, "a")], "Level DOUBLE, note STRING").createOrReplaceTempView("jotted")
    return spark


def _run(spark, stmts, policy=DEFAULT_POLICY):
    rows = [capture(spark.sql(sql), i, cmd, tbl, "lab", sql_text=sql) for i, (sql, cmd, tbl) in enumerate(stmts)]
    return Lineage(event_tables_from_plans(plan_log(spark, rows)), policy=policy)


def _cols(lin):
    """{event: {output column: (inputs, type, expression)}}; the inputs without the namespace that all of them have."""
    c = lin.column_lineage.select("event_id", "lineage_id", "inputs", "dep_type", strip_expr_ids("expression").alias("expression"))
    out = {}
    for r in c.collect():
        assert all(i.endswith("@5k") for i in r.inputs)
        out.setdefault(r.event_id, {})[r.lineage_id.split(":")[1]] = (",".join(i[:-3] for i in r.inputs), r.dep_type, r.expression)
    return out


#: (statement, expected rows): one column of each kind
DERIVED = [
    # renamed twice on the way: still the source column itself
    ("select b as c from (select Level as b from lab.reading)", {"c": ("lab.reading.level", "SIMPLE", None)}),
    ("select cast(probe as string) p from lab.reading", {"p": ("lab.reading.probe", "EXPRESSION", "cast(probe as string)")}),
    # one input and a text without parentheses counts as a rename
    ("select at.y from lab.reading", {"y": ("lab.reading.at", "SIMPLE", None)}),
    ("select case when probe > 7 then Level else `limit` end v from lab.reading natural join lab.probe",
     {"v": ("lab.reading.probe,lab.reading.level,lab.probe.limit", "EXPRESSION", "CASE WHEN (probe > 7) THEN Level ELSE limit END")}),
    # a column that is used twice is listed twice
    ("select Level * Level sq from lab.reading", {"sq": ("lab.reading.level,lab.reading.level", "EXPRESSION", "(Level * Level)")}),
    # a window's output is no source column: an expression over it has no inputs
    ("select n + probe m from (select probe, rank() over (partition by probe order by Level) n from lab.reading)",
     {"m": ("lab.reading.probe", "EXPRESSION", "(cast(n as bigint) + probe)")}),
    ("select 'x' k, taken from lab.reading", {"k": ("", "EXPRESSION", "x"), "taken": ("lab.reading.taken", "SIMPLE", None)}),
]


def test_derived_columns(wh):
    got = _cols(_run(wh, [(sql, CTAS, "out") for sql, _ in DERIVED]))
    assert got == dict(enumerate(want for _, want in DERIVED))


JOINED = "select r.probe, upper(p.model) Model from lab.probe p full join lab.reading r on p.probe = r.probe and p.fitted < r.taken"


def test_process_identity(wh):
    lin = _run(wh, [(JOINED, CTAS, "Seen"), (JOINED, INSERT, "Seen"), (JOINED, DS_CTAS, "Seen")])
    rows = {r.event_id: r for r in lin.good.collect()}
    assert rows[0].process_qn == "lab.Seen@5k" and rows[0].op_type == "CREATETABLE_AS_SELECT"
    for i in (1, 2):
        assert rows[i].process_qn == "QUERY:lab.probe@5k:lab.reading@5k->:INSERT_OVERWRITE:lab.Seen@5k" and rows[i].op_type == "QUERY"
    assert all(r.inputs == ["lab.probe@5k", "lab.reading@5k"] for r in rows.values())
    assert _cols(lin)[0] == {"probe": ("lab.reading.probe", "SIMPLE", None), "model": ("lab.probe.model", "EXPRESSION", "upper(model)")}


def test_bare_relation_maps_each_column(wh):
    cols = _cols(_run(wh, [("table lab.reading", INSERT, "copy")]))[0]
    assert cols == {c: (f"lab.reading.{c}", "EXPRESSION", "DirectMapping") for c in ("level", "probe", "at", "marks", "taken")}


@pytest.mark.parametrize("sql,inputs", [
    ("select * from lab.reading where Level > 0.5", 1),
    ("select distinct model from lab.probe", 1),
    ("select probe, max(Level) top from lab.reading group by probe", 1),
    ("select probe, taken d from lab.reading union all select probe, fitted from lab.probe", 2),
    ("select probe from lab.reading order by probe", 1),
    ("select probe, rank() over (partition by probe order by Level) n from lab.reading", 1),
    ("select probe, mark from lab.reading lateral view explode(marks) m as mark", 1),
])
def test_other_roots_give_table_lineage_only(wh, sql, inputs):
    lin = _run(wh, [(sql, CTAS, "other")])
    roots = lin.good.select("root_kind", F.size("inputs")).collect()
    assert len(roots) == 1 and roots[0][1] == inputs
    if roots[0][0] == "OTHER":
        assert lin.column_lineage.count() == 0
    else:  # Spark ends the plan of some of them with a projection
        assert "marks" in sql or "rank" in sql


def test_table_read_twice_is_listed_twice(wh):
    lin = _run(wh, [("select a.Level - b.Level gap from lab.reading a join lab.reading b using (probe)", CTAS, "gaps")])
    assert _cols(lin)[0] == {"gap": ("lab.reading.level,lab.reading.level", "EXPRESSION", "(Level - Level)")}
    assert lin.good.first().inputs == ["lab.reading@5k"] * 2


def test_literals_are_skipped_or_quarantine(wh):
    stmt = [("select `limit` * 2 twice, fitted from lab.probe", CTAS, "twice")]
    assert _cols(_run(wh, stmt))[0] == {"twice": ("lab.probe.limit", "EXPRESSION", "(limit * 2.0)"), "fitted": ("lab.probe.fitted", "SIMPLE", None)}
    assert [r.reason for r in _run(wh, stmt, STRICT_POLICY).quarantine.collect()] == ["LITERAL_LEAF"]


def test_rows_of_the_session_are_no_catalog_input(wh):
    ins = _run(wh, [("select note, Level + 1 l from jotted", DS_CTAS, "jots")])
    assert [r.reason for r in ins.quarantine.collect()] == ["NO_INPUT_TABLE"] and ins.column_lineage.count() == 0
    made = _run(wh, [("select note, Level from jotted", CTAS, "jots")])
    assert [(r.process_qn, r.inputs) for r in made.good.collect()] == [("lab.jots@5k", [])]


def test_shred_missing_empty_and_short_plans(spark):
    """A null or empty plan still yields its event (root kind OTHER) and no
    other rows; an output without a rendered text gets a null text."""
    import datetime as dt

    from provena.plans.capture import PLAN_LOG_SCHEMA
    from provena.plans.shred import ATTRIBUTE, PROJECT
    proj = ('[{"class":"%s","num-children":0,"projectList":[[{"class":"%s","num-children":0,"name":"a",'
            '"exprId":{"id":7}}],[{"class":"%s","num-children":0,"name":"b","exprId":{"id":8}}]]}]'
            % (PROJECT, ATTRIBUTE, ATTRIBUTE))
    ts = dt.datetime(2024, 1, 1)
    rows = [(1, ts, 1, "SUCCESS", CTAS, "d", "t", "d", "q", None, None),
            (2, ts, 1, "SUCCESS", CTAS, "d", "t", "d", "q", "[]", []),
            (3, ts, 1, "SUCCESS", CTAS, "d", "t", "d", "q", proj, ["only_first"])]
    t = event_tables_from_plans(spark.createDataFrame(rows, PLAN_LOG_SCHEMA))
    kinds = {r.event_id: r.root_kind for r in t.write_event.collect()}
    assert kinds == {1: "OTHER", 2: "OTHER", 3: "PROJECT"}
    assert t.scan_relation.count() == 0 and t.scan_column.count() == 0
    outs = {r.out_pos: (r.out_name, r.out_attr_id, r.n_children, r.expr_text) for r in t.output_expr.collect()}
    assert outs == {0: ("a", 7, 0, "only_first"), 1: ("b", 8, 0, None)}
    leaves = sorted((r.out_pos, r.leaf_pos, r.attr_id, r.is_named) for r in t.output_leaf.collect())
    assert leaves == [(0, 1, 7, True), (1, 1, 8, True)]


def test_scalar_subquery_is_no_name(wh):
    """A subquery leaf has an id but no name: skipped by default, quarantined by the strict policy."""
    stmt = [("select Level / (select max(`limit`) from lab.probe) part from lab.reading", CTAS, "parts")]
    assert _cols(_run(wh, stmt))[0]["part"][0] == "lab.reading.level"
    assert [r.reason for r in _run(wh, stmt, STRICT_POLICY).quarantine.collect()] == ["LITERAL_LEAF"]
