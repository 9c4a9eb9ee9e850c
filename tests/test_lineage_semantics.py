"""Emission matrix (every cell) and the quirks that decide answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from provena.operators.lineage import EventTables, Lineage
from provena.operators.route import STRICT_POLICY

TS = dt.datetime(2024, 1, 1)
EV = ("event_id bigint, ts timestamp_ntz, session_id bigint, status string, command string, target_db string, "
      "target_table string, current_db string, sql_text string, root_kind string")
REL = "event_id bigint, rel_pos bigint, db string, tbl string, is_catalog boolean"
COL = "event_id bigint, rel_pos bigint, attr_id bigint, col string, is_partition_col boolean"
OUT = "event_id bigint, out_pos int, out_name string, out_attr_id bigint, n_children int, expr_text string"
LEAF = "event_id bigint, out_pos int, leaf_pos int, attr_id bigint, is_named boolean"

CTAS, INS, DS = "CreateHiveTableAsSelectCommand", "InsertIntoHiveTable", "CreateDataSourceTableAsSelectCommand"


def ev(i, command=CTAS, root="PROJECT", db="Tgt", tbl="Tab", sql="q", status="SUCCESS", cur="cur"):
    return (i, TS, 1, status, command, db, tbl, cur, sql, root)


@pytest.fixture(scope="module")
def tables(spark):
    events = [ev(1), ev(2, root="RELATION", db="d", tbl="t2"), ev(3, root="OTHER", db="d", tbl="t3"),
              ev(4, command=INS, db="d", tbl="t4"), ev(5, command=CTAS, db="d", tbl="t5"),
              ev(6, command=DS, db=None, tbl="t6", cur="curdb"), ev(7, command=CTAS, db=None, tbl="t7"),
              ev(8, status="FAILED"), ev(9, command="InsertIntoHadoopFsRelationCommand"), ev(10, command="OTHER"),
              ev(11, sql=None, db="d", tbl="t11"), ev(12, sql="", command=INS, db="d", tbl="t12"),
              ev(13, sql=" ", db="d", tbl="t13")]
    rels = [(1, 1, "Db1", "T_X", True), (1, 2, None, "other", True), (1, 3, "tmp", "rdd", False),
            (2, 1, "src", "emp", True), (3, 1, "src", "emp", True)] + \
           [(i, 1, "src", "emp", True) for i in (6, 7, 9, 10, 11, 12, 13)]
    cols = [(1, 1, 101, "ColA", False), (1, 1, 102, "ColB", False), (1, 2, 201, "c", False),
            (1, 3, 301, "r", False),
            (2, 1, 11, "Id", False), (2, 1, 12, "name", False), (2, 1, 13, "deptno", True)]
    outs = [(1, 0, "OutA", 101, 0, None),          # pass-through
            (1, 1, "nothing", 999, 0, None),       # no children, not in dictionary: no row
            (1, 2, "lit", 998, 1, "k"),            # children, zero hits
            (1, 3, "renamed", 997, 1, "ColB"),     # one hit, no parens: SIMPLE
            (1, 4, "f1", 996, 1, "abs(ColB)"),     # one hit, parens: EXPRESSION
            (1, 5, "f2", 995, 1, "x + y"),         # two hits
            (1, 6, "dup", 994, 1, "concat(a, a)"),  # duplicate leaf (Q8)
            (1, 7, "rdd_only", 993, 1, "r"),       # leaf on a non-catalog relation only
            (3, 0, "x", 1, 0, None),
            (11, 0, "a", 1, 1, "lower(a)"), (11, 1, "b", 2, 1, "'k'")]
    leaves = [(1, 0, 1, 101, True), (1, 1, 1, 999, True), (1, 2, 1, None, False),
              (1, 3, 1, 102, True), (1, 4, 1, 102, True), (1, 5, 1, 101, True), (1, 5, 2, 201, True),
              (1, 6, 1, 102, True), (1, 6, 2, 102, True), (1, 7, 1, 301, True),
              (11, 1, 1, None, False)]
    return EventTables(spark.createDataFrame(events, EV), spark.createDataFrame(rels, REL),
                       spark.createDataFrame(cols, COL), spark.createDataFrame(outs, OUT),
                       spark.createDataFrame(leaves, LEAF))


def rows(lin, event_id):
    c = lin.column_lineage.where(F.col("event_id") == event_id).select(
        "lineage_id", "output_qn", F.array_join("inputs", ",").alias("inputs"), "dep_type", "expression",
        "branch")
    return {r.lineage_id: r for r in c.collect()}


def test_emission_matrix_project_cells(tables):
    r = rows(Lineage(tables), 1)
    assert set(r) == {"Tgt.Tab@5k:" + n for n in ("outa", "lit", "renamed", "f1", "f2", "dup", "rdd_only")}
    assert (r["Tgt.Tab@5k:outa"].inputs, r["Tgt.Tab@5k:outa"].dep_type) == ("db1.t_x.cola@5k", "SIMPLE")
    assert r["Tgt.Tab@5k:outa"].branch == "PASSTHROUGH"
    assert (r["Tgt.Tab@5k:lit"].inputs, r["Tgt.Tab@5k:lit"].dep_type, r["Tgt.Tab@5k:lit"].expression) == \
        ("", "EXPRESSION", "k")
    assert (r["Tgt.Tab@5k:renamed"].dep_type, r["Tgt.Tab@5k:renamed"].expression) == ("SIMPLE", None)
    assert (r["Tgt.Tab@5k:f1"].dep_type, r["Tgt.Tab@5k:f1"].expression) == ("EXPRESSION", "abs(ColB)")
    assert r["Tgt.Tab@5k:f2"].inputs == "db1.t_x.cola@5k,default.other.c@5k"
    assert r["Tgt.Tab@5k:f2"].dep_type == "EXPRESSION"
    # Q8: duplicates kept, in leaf order
    assert r["Tgt.Tab@5k:dup"].inputs == "db1.t_x.colb@5k,db1.t_x.colb@5k"
    # non-catalog relations are not in the dictionary: zero hits, expression kept
    assert (r["Tgt.Tab@5k:rdd_only"].inputs, r["Tgt.Tab@5k:rdd_only"].dep_type) == ("", "EXPRESSION")


def test_case_rules_q7(tables):
    r = rows(Lineage(tables), 1)["Tgt.Tab@5k:outa"]
    assert r.output_qn == "Tgt.Tab.outa@5k"          # only the column part is lower-cased
    assert r.inputs == "db1.t_x.cola@5k"             # input: the whole name is lower-cased


def test_relation_root_direct_mapping(tables):
    r = rows(Lineage(tables), 2)
    assert set(r) == {"d.t2@5k:id", "d.t2@5k:name", "d.t2@5k:deptno"}
    assert all(v.dep_type == "EXPRESSION" and v.expression == "DirectMapping" for v in r.values())
    assert r["d.t2@5k:id"].inputs == "src.emp.id@5k"


def test_other_root_has_no_columns(tables):
    assert rows(Lineage(tables), 3) == {}


def test_table_lineage_order_and_non_catalog(tables):
    g = {r.event_id: r for r in Lineage(tables).good.select(
        "event_id", F.array_join("inputs", ",").alias("i"), "process_qn", "op_type", "query_text").collect()}
    assert g[1].i == "Db1.T_X@5k,default.other@5k"   # table names keep their case
    assert g[1].process_qn == "Tgt.Tab@5k" and g[1].op_type == "CREATETABLE_AS_SELECT"
    assert g[5].i == "" and g[5].process_qn == "d.t5@5k"   # Q3: CTAS with no inputs is emitted
    assert 8 not in g                                        # failed executions are dropped


def test_target_db_rules_n1(tables):
    g = {r.event_id: r.target_qn for r in Lineage(tables).good.select("event_id", "target_qn").collect()}
    assert g[6] == "curdb.t6@5k"      # datasource CTAS: session's current database
    assert g[7] == "default.t7@5k"    # Hive CTAS: "default"


def test_sql_text_q1_default_and_strict(tables):
    g = {r.event_id: r.query_text for r in Lineage(tables).good.select("event_id", "query_text").collect()}
    assert g[11] == "CREATE_TABLE_AS_SELECT"
    assert g[13] == " "                      # no trim: a blank text is kept
    assert g[12] == "FROM_TABLE_INSERT_SELECT"  # "" takes the insert fallback
    strict = {r.event_id: r.reason for r in Lineage(tables, policy=STRICT_POLICY).quarantine.collect()}
    assert strict[11] == "NO_SQL_TEXT"
    assert 13 not in strict


def test_quarantine_default(tables):
    q = {r.event_id: r.reason for r in Lineage(tables).quarantine.collect()}
    assert q[4] == "NO_INPUT_TABLE" and 12 not in q
    assert q[9] == "FS_WRITE" and q[10] == "UNSUPPORTED_COMMAND"
    assert 5 not in q and 8 not in q


def test_literal_strict_q2(tables):
    q = {r.event_id: r.reason for r in Lineage(tables, policy=STRICT_POLICY).quarantine.collect()}
    assert q[1] == "LITERAL_LEAF"            # output "lit" holds a literal leaf


@pytest.mark.parametrize("n", [1, 4, 32])
def test_partition_count_does_not_change_output(spark, tables, n):
    base = sorted(map(tuple, Lineage(tables).column_lineage.select(
        "event_id", "lineage_id", F.array_join("inputs", ","), "dep_type").collect()))
    t2 = EventTables(*[getattr(tables, f).repartition(n) for f in
                       ("write_event", "scan_relation", "scan_column", "output_expr", "output_leaf")])
    got = sorted(map(tuple, Lineage(t2).column_lineage.select(
        "event_id", "lineage_id", F.array_join("inputs", ","), "dep_type").collect()))
    assert got == base


def test_dedupe_same_events_twice(tables):
    from provena.operators.entities import dedupe_entities
    lin = Lineage(tables)
    e = lin.entities.select("type_name", "qualified_name", "ts", "event_id")
    once = sorted(map(tuple, dedupe_entities(e).collect()))
    twice = sorted(map(tuple, dedupe_entities(e.unionByName(e)).collect()))
    assert once == twice


def test_messages_envelope(tables):
    from provena.operators.deliver import to_messages
    m = {r.event_id: r for r in to_messages(Lineage(tables)).collect()}
    assert m[1].key == "Tgt.Tab@5k" and m[1].topic == "ATLAS_HOOK"
    assert m[1].n_entities == 8 and m[1].first_type == "hive_process"
    assert '"user":"sparkhook"' in m[1].value and '"depenendencyType":"SIMPLE"' in m[1].value


def test_staged_products_equal_lazy_ones(spark):
    """``Lineage.stage`` stores the harvested events and column lineage once;
    messages, edges and de-dup built from the stored copies are unchanged."""
    from .conftest import SF_SMALL

    from provena.operators.deliver import to_messages
    from provena.operators.entities import dedupe_entities, edges
    from provena.session import Tables, scratch_path

    def products(lin):
        msgs = to_messages(lin).select("event_id", "key", "value")
        ed = edges(lin)
        dd = dedupe_entities(lin.entities).select("type_name", "qualified_name", "event_id")
        return [sorted(map(tuple, df.collect())) for df in (msgs, ed, dd)]

    et = EventTables.from_tables(Tables(spark, SF_SMALL))
    lazy = products(Lineage(et))
    staged_lin = Lineage(et)
    _ = staged_lin.column_lineage  # built before staging: must be rebuilt from the stored events
    staged = products(staged_lin.stage(scratch_path(spark, "stage_test")))
    assert all(len(x) > 0 for x in lazy)
    assert staged == lazy
