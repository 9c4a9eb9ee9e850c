"""Query catalogue: one Spark query per operator of the blueprint, each with
its DuckDB oracle twin.  Every query reads the driver tables of ``sf_dir``
(through the event views in ``sources.fixtures``) and runs over them whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import constants as K
from .oracle import with_views
from .operators.lineage import EventTables, Lineage, input_tables
from .operators.route import DEFAULT_POLICY, STRICT_POLICY, Policy, successful
from .session import Tables
from .sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_LINEAGE: dict = {}


def lineage(spark: SparkSession, sf_dir: str, policy: Policy = DEFAULT_POLICY, rules=None) -> Lineage:
    """The lineage plans of one scale-factor folder.  Plans (not data) are
    shared by all queries of one session: DataFrames are immutable, so a
    plan built once is reused, and only its execution is repeated."""
    if rules is not None:
        return Lineage(EventTables.from_tables(Tables(spark, sf_dir)), rules=rules, policy=policy)
    key = (spark._jsparkSession.hashCode(), sf_dir, policy)
    if key not in _LINEAGE:
        _LINEAGE[key] = Lineage(EventTables.from_tables(Tables(spark, sf_dir)), policy=policy)
    return _LINEAGE[key]


def _join(c) -> F.Column:
    return F.array_join(c, "|")


# ---------------------------------------------------------------------------
# S1, P1, A3, N1-N4


@query("execution_events", with_views("""
SELECT event_id, command, session_id FROM fx_write_event WHERE status = 'SUCCESS'""", "fx_write_event"))
def execution_events(spark, sf_dir):
    return successful(fx.write_event(Tables(spark, sf_dir))).select("event_id", "command", "session_id")


@query("route_writes", with_views("""
SELECT route, command, count(*) AS n FROM ox_events GROUP BY route, command""", "ox_events"))
def route_writes_q(spark, sf_dir):
    return lineage(spark, sf_dir).routed.groupBy("route", "command").agg(F.count(F.lit(1)).alias("n"))


@query("resolve_target", with_views("""
SELECT event_id, database, target_qn AS table_qn FROM ox_events WHERE route = 'LINEAGE'""", "ox_events"))
def resolve_target_q(spark, sf_dir):
    r = lineage(spark, sf_dir).routed
    return r.where(F.col("route") == K.ROUTE_LINEAGE).select("event_id", "database", F.col("target_qn").alias("table_qn"))


@query("scanned_tables", with_views("""
SELECT event_id, rel_pos, coalesce(db, 'default') || '.' || tbl || '@5k' AS table_qn
FROM fx_scan_relation WHERE is_catalog""", "fx_scan_relation"))
def scanned_tables(spark, sf_dir):
    return input_tables(fx.scan_relation(Tables(spark, sf_dir)))


@query("source_columns", with_views("""
SELECT event_id, attr_id, input_qn AS column_qn, is_partition_col FROM ox_catcols""", "ox_catcols"))
def source_columns(spark, sf_dir):
    return lineage(spark, sf_dir).catalog_cols.select("event_id", "attr_id", F.col("input_qn").alias("column_qn"),
                                                      "is_partition_col")


@query("output_columns", with_views("""
SELECT o.event_id, o.out_pos,
  g.database || '.' || g.target_table || '.' || lower(o.out_name) || '@5k' AS column_qn,
  g.database || '.' || g.target_table || '@5k:' || lower(o.out_name) AS lineage_id
FROM fx_output_expr o JOIN ox_good g ON o.event_id = g.event_id WHERE g.root_kind = 'PROJECT'""", "fx_output_expr",
                                    "ox_good"))
def output_columns(spark, sf_dir):
    from .functions import names as N
    lin = lineage(spark, sf_dir)
    g = lin.good.where(F.col("root_kind") == K.ROOT_PROJECT).select("event_id", "database", "target_table")
    return lin.t.output_expr.join(g, "event_id").select(
        "event_id", "out_pos",
        N.output_col_qn("database", "target_table", "out_name").alias("column_qn"),
        N.lineage_id("database", "target_table", "out_name").alias("lineage_id"))


# ---------------------------------------------------------------------------
# L1, L2


@query("table_lineage", with_views("""
SELECT event_id, target_qn, inputs_txt AS inputs, CAST(n_inputs AS BIGINT) AS n_inputs FROM ox_good""", "ox_good"))
def table_lineage(spark, sf_dir):
    g = lineage(spark, sf_dir).good
    return g.select("event_id", "target_qn", _join("inputs").alias("inputs"),
                    F.col("n_inputs").cast("bigint").alias("n_inputs"))


@query("process_identity", with_views("""
SELECT event_id, op_type AS operation_type, process_qn AS qualified_name FROM ox_good""", "ox_good"))
def process_identity(spark, sf_dir):
    g = lineage(spark, sf_dir).good
    return g.select("event_id", F.col("op_type").alias("operation_type"), F.col("process_qn").alias("qualified_name"))


# ---------------------------------------------------------------------------
# L3-L6, P4


@query("passthrough_columns", with_views("""
SELECT event_id, lineage_id, inputs_txt AS input FROM ox_colineage WHERE branch = 'PASSTHROUGH'""", "ox_colineage"))
def passthrough_columns(spark, sf_dir):
    c = lineage(spark, sf_dir).column_lineage
    return c.where(F.col("branch") == K.BRANCH_PASSTHROUGH).select(
        "event_id", "lineage_id", F.col("inputs")[0].alias("input"))


@query("derived_columns", with_views("""
SELECT event_id, lineage_id, inputs_txt AS inputs, dep_type, expression
FROM ox_colineage WHERE branch = 'DERIVED'""", "ox_colineage"))
def derived_columns(spark, sf_dir):
    c = lineage(spark, sf_dir).column_lineage
    return c.where(F.col("branch") == K.BRANCH_DERIVED).select(
        "event_id", "lineage_id", _join("inputs").alias("inputs"), "dep_type", "expression")


@query("direct_mapping", with_views("""
SELECT event_id, lineage_id, inputs_txt AS input, dep_type, expression
FROM ox_colineage WHERE branch = 'DIRECT'""", "ox_colineage"))
def direct_mapping(spark, sf_dir):
    c = lineage(spark, sf_dir).column_lineage
    return c.where(F.col("branch") == K.BRANCH_DIRECT).select(
        "event_id", "lineage_id", F.col("inputs")[0].alias("input"), "dep_type", "expression")


@query("column_lineage", with_views("""
SELECT event_id, branch, lineage_id, inputs_txt AS inputs, dep_type, expression FROM ox_colineage""",
                                    "ox_colineage"))
def column_lineage(spark, sf_dir):
    c = lineage(spark, sf_dir).column_lineage
    return c.select("event_id", "branch", "lineage_id", _join("inputs").alias("inputs"), "dep_type", "expression")


@query("emission_matrix", with_views("""
SELECT root_kind, branch, dep_type, count(*) AS n FROM ox_colineage GROUP BY root_kind, branch, dep_type""",
                                     "ox_colineage"))
def emission_matrix(spark, sf_dir):
    c = lineage(spark, sf_dir).column_lineage
    return c.groupBy("root_kind", "branch", "dep_type").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# L7-L10, K12, A5


@query("process_entities", with_views("""
SELECT process_qn AS qualified_name, op_type AS operation_type, query_text, '5k' AS cluster_name,
  'Spark' AS user_name, query_text AS recent_queries FROM ox_good""", "ox_good"))
def process_entities(spark, sf_dir):
    p = lineage(spark, sf_dir).process_entities
    a = F.col("attributes")
    return p.select(F.col("qualified_name"), a["operationType"].alias("operation_type"),
                    a["queryText"].alias("query_text"), a["clusterName"].alias("cluster_name"),
                    a["userName"].alias("user_name"), _join(a["recentQueries"]).alias("recent_queries"))


@query("column_entities", with_views("""
SELECT lineage_id AS qualified_name, dep_type, expression, CAST(n_inputs AS BIGINT) AS n_inputs,
  output_qn, process_qn FROM ox_colineage""", "ox_colineage"))
def column_entities(spark, sf_dir):
    c = lineage(spark, sf_dir).column_entities
    a, r = F.col("attributes"), F.col("relationships")
    return c.select("qualified_name", a[K.DEP_TYPE_ATTR].alias("dep_type"), a["expression"].alias("expression"),
                    F.size(r["inputs"]).cast("bigint").alias("n_inputs"),
                    r["outputs"][0]["qualified_name"].alias("output_qn"),
                    r["query"]["qualified_name"].alias("process_qn"))


@query("envelope_sizes", with_views("""
SELECT 'ATLAS_HOOK' AS topic, g.target_qn AS key, CAST(1 + coalesce(c.n, 0) AS BIGINT) AS n_entities,
  'hive_process' AS first_type
FROM ox_good g LEFT JOIN (SELECT event_id, count(*) AS n FROM ox_colineage GROUP BY event_id) c
  ON g.event_id = c.event_id""", "ox_good", "ox_colineage"))
def envelope_sizes(spark, sf_dir):
    from .operators.deliver import to_messages
    m = to_messages(lineage(spark, sf_dir))
    return m.select("topic", "key", F.col("n_entities").cast("bigint").alias("n_entities"), "first_type")


@query("message_entities", with_views("""
SELECT event_id, 0 AS place, 'hive_process' AS type_name, process_qn AS qualified_name, process_qn AS name, 'Spark' AS user_name,
  op_type AS operation_type, query_text AS query_id, query_text, query_text AS recent_queries, 'Not Supported' AS query_plan, '5k' AS cluster_name,
  CAST(NULL AS VARCHAR) AS dep_type, CAST(NULL AS VARCHAR) AS expression, strftime(ts, '%Y-%m-%dT%H:%M:%S.000') AS start_time,
  coalesce(string_agg_inputs, '') AS inputs, 'hive_table:' || target_qn AS outputs, CAST(NULL AS VARCHAR) AS query
FROM (SELECT g.*, list_aggregate(list_transform(string_split(nullif(inputs_txt, ''), '|'), lambda x: 'hive_table:' || x), 'string_agg', '|') AS string_agg_inputs
      FROM ox_good g) g
UNION ALL
SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY coalesce(pos, 0), out_name) AS INT), 'hive_column_lineage', lineage_id, lineage_id,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, dep_type, expression, strftime(ts, '%Y-%m-%dT%H:%M:%S.000'),
  coalesce(list_aggregate(list_transform(string_split(nullif(inputs_txt, ''), '|'), lambda x: 'hive_column:' || x), 'string_agg', '|'), ''),
  'hive_column:' || output_qn, 'hive_process:' || process_qn
FROM (SELECT c.*, CASE WHEN c.branch <> 'DIRECT' THEN CAST(substr(c.out_name, 5) AS INT) END AS pos FROM ox_colineage c) c""", "ox_good", "ox_colineage"))
def message_entities(spark, sf_dir):
    """K12 + F11: the JSON of every message read back, entity by entity and attribute by attribute."""
    from .operators.deliver import to_messages
    ref = "struct<typeName:string,uniqueAttributes:struct<qualifiedName:string>>"
    schema = ("struct<entities:struct<entities:array<struct<typeName:string,attributes:map<string,string>,"
              f"relationshipAttributes:struct<inputs:array<{ref}>,outputs:array<{ref}>,query:{ref}>>>>>")
    m = to_messages(lineage(spark, sf_dir)).select("event_id", F.from_json("value", schema)["entities"]["entities"].alias("e"))
    e = m.select("event_id", F.posexplode("e").alias("place", "x"))
    a, r = F.col("x.attributes"), F.col("x.relationshipAttributes")
    name = lambda q: F.concat(q["typeName"], F.lit(":"), q["uniqueAttributes"]["qualifiedName"])
    one = {"qualifiedName": "qualified_name", "name": "name", "userName": "user_name", "operationType": "operation_type", "queryId": "query_id",
           "queryText": "query_text", "queryPlan": "query_plan", "clusterName": "cluster_name", K.DEP_TYPE_ATTR: "dep_type",
           "expression": "expression", "startTime": "start_time"}
    return e.select("event_id", "place", F.col("x.typeName").alias("type_name"), *(a[k].alias(v) for k, v in one.items()),
                    F.from_json(a["recentQueries"], "array<string>")[0].alias("recent_queries"),
                    F.array_join(F.transform(r["inputs"], name), "|").alias("inputs"), F.array_join(F.transform(r["outputs"], name), "|").alias("outputs"),
                    name(r["query"]).alias("query"))


@query("edges", with_views("""
SELECT DISTINCT kind, src, dst FROM (
  SELECT 'dataset_process_inputs' AS kind, coalesce(r.db, 'default') || '.' || r.tbl || '@5k' AS src, g.process_qn AS dst
  FROM ox_good g JOIN fx_scan_relation r ON g.event_id = r.event_id WHERE r.is_catalog
  UNION ALL SELECT 'process_dataset_outputs', process_qn, target_qn FROM ox_good
  UNION ALL SELECT 'dataset_process_inputs', unnest(string_split(inputs_txt, '|')), lineage_id
  FROM ox_colineage WHERE inputs_txt <> ''
  UNION ALL SELECT 'process_dataset_outputs', lineage_id, output_qn FROM ox_colineage
  UNION ALL SELECT 'hive_process_column_lineage', lineage_id, process_qn FROM ox_colineage
) e""", "ox_good", "fx_scan_relation", "ox_colineage"))
def edges_q(spark, sf_dir):
    from .operators.entities import edges
    return edges(lineage(spark, sf_dir))


@query("dedupe_entities", with_views("""
SELECT type_name, qualified_name, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY type_name, qualified_name ORDER BY ts DESC, event_id DESC) AS rn
  FROM (SELECT 'hive_process' AS type_name, process_qn AS qualified_name, ts, event_id FROM ox_good
        UNION ALL SELECT 'hive_column_lineage', lineage_id, ts, event_id FROM ox_colineage) e
) x WHERE rn = 1""", "ox_good", "ox_colineage"))
def dedupe_entities_q(spark, sf_dir):
    from .operators.entities import dedupe_entities
    ents = lineage(spark, sf_dir).entities.select("type_name", "qualified_name", "ts", "event_id")
    return dedupe_entities(ents).select("type_name", "qualified_name", "event_id")


# ---------------------------------------------------------------------------
# Q1-Q3, T4, A4, X-H, P2

_STRICT_REASON = """
SELECT e.event_id, e.ts,
  CASE WHEN e.sql_text IS NULL THEN 'NO_SQL_TEXT'
       WHEN e.route = 'FS_WRITE' THEN 'FS_WRITE'
       WHEN e.route = 'UNSUPPORTED' THEN 'UNSUPPORTED_COMMAND'
       WHEN e.empty_inputs = 'QUARANTINE' AND e.n_inputs = 0 THEN 'NO_INPUT_TABLE'
       WHEN e.root_kind = 'PROJECT' AND l.event_id IS NOT NULL THEN 'LITERAL_LEAF' END AS reason
FROM ox_events e LEFT JOIN (
  SELECT DISTINCT o.event_id FROM ox_outputs o
  WHERE o.pass_qn IS NULL AND o.n_children >= 1
    AND EXISTS (SELECT 1 FROM fx_output_leaf f WHERE f.event_id = o.event_id AND f.out_pos = o.out_pos AND NOT f.is_named)
) l ON e.event_id = l.event_id"""


@query("quarantine_default", with_views("""
SELECT event_id, reason FROM ox_events_q WHERE reason IS NOT NULL""", "ox_events_q"))
def quarantine_default(spark, sf_dir):
    return lineage(spark, sf_dir).quarantine.select("event_id", "reason")


@query("quarantine_strict", with_views(f"""
SELECT event_id, reason FROM ({_STRICT_REASON}) q WHERE reason IS NOT NULL""", "ox_events", "ox_outputs",
                                       "fx_output_leaf"))
def quarantine_strict(spark, sf_dir):
    return lineage(spark, sf_dir, STRICT_POLICY).quarantine.select("event_id", "reason")


@query("quarantine_summary", with_views(f"""
SELECT 'default' AS policy, reason, count(*) AS n FROM ox_events_q WHERE reason IS NOT NULL GROUP BY reason
UNION ALL
SELECT 'strict', reason, count(*) FROM ({_STRICT_REASON}) q WHERE reason IS NOT NULL GROUP BY reason""",
                                       "ox_events_q", "ox_events", "ox_outputs", "fx_output_leaf"))
def quarantine_summary(spark, sf_dir):
    out = None
    for name, pol in (("default", DEFAULT_POLICY), ("strict", STRICT_POLICY)):
        q = (lineage(spark, sf_dir, pol).quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(name).alias("policy"), "reason", "n"))
        out = q if out is None else out.unionByName(q)
    return out


@query("route_rules", with_views("""
SELECT CASE WHEN e.command = 'OTHER' THEN 'LINEAGE' ELSE coalesce(r.route, 'UNSUPPORTED') END AS route,
  e.command, count(*) AS n
FROM fx_write_event e LEFT JOIN ox_rules r ON e.command = r.command
WHERE e.status = 'SUCCESS' GROUP BY 1, 2""", "fx_write_event", "ox_rules"))
def route_rules_q(spark, sf_dir):
    from .operators.route import register_route, route_rules
    rules = register_route(route_rules(spark), "OTHER")
    lin = lineage(spark, sf_dir, rules=rules)
    return lin.routed.groupBy("route", "command").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# J1

MAX_AGE_SECONDS = 6 * 3600


@query("sql_text_asof", with_views("""
SELECT e.event_id, t.sql_text, epoch_us(t.ts) AS sql_us FROM fx_exec e
ASOF LEFT JOIN fx_sql_text t ON e.session_id = t.session_id AND e.ts >= t.ts""", "fx_exec", "fx_sql_text"))
def sql_text_asof(spark, sf_dir):
    from .operators.asof import attach_sql, micros
    t = Tables(spark, sf_dir)
    return attach_sql(fx.exec_event(t), fx.sql_text(t)).select("event_id", "sql_text", micros("sql_ts").alias("sql_us"))


@query("sql_text_asof_max_age", with_views(f"""
SELECT e.event_id,
  CASE WHEN e.ts - t.ts <= INTERVAL {MAX_AGE_SECONDS} SECOND THEN t.sql_text END AS sql_text
FROM fx_exec e ASOF LEFT JOIN fx_sql_text t ON e.session_id = t.session_id AND e.ts >= t.ts""",
                                           "fx_exec", "fx_sql_text"))
def sql_text_asof_max_age(spark, sf_dir):
    from .operators.asof import attach_sql
    t = Tables(spark, sf_dir)
    return attach_sql(fx.exec_event(t), fx.sql_text(t), max_age_seconds=MAX_AGE_SECONDS).select(
        "event_id", "sql_text")


# ---------------------------------------------------------------------------
# S2, C1-C10, J4, J5

_KINDS = ", ".join(f"'{k}'" for k in K.CATALOG_KINDS)
_CHANGES = f"""
SELECT event_id, ts, kind, 0 AS seq,
  CASE kind WHEN 'CreateDatabaseEvent' THEN 'CREATE_DATABASE' WHEN 'DropDatabaseEvent' THEN 'DROP_DATABASE'
            WHEN 'AlterDatabaseEvent' THEN 'ALTER_DATABASE' WHEN 'CreateTableEvent' THEN 'CREATE_TABLE'
            WHEN 'DropTableEvent' THEN 'DROP_TABLE' WHEN 'AlterTableEvent' THEN 'ALTER_TABLE' ELSE 'RENAME_TABLE' END AS change,
  db, tbl,
  CASE kind WHEN 'AlterTableEvent' THEN change_kind WHEN 'RenameTableEvent' THEN new_name END AS detail
FROM fx_catalog_event
WHERE kind IN ({_KINDS})
UNION ALL
SELECT event_id, ts, kind, 1, 'CREATE_TABLE', db, new_name, NULL FROM fx_catalog_event WHERE kind = 'RenameTableEvent'"""


def _changes(spark, sf_dir, with_db=True):
    from .operators.catalog import catalog_changes
    t = Tables(spark, sf_dir)
    return catalog_changes(fx.catalog_event(t), fx.database(t) if with_db else None)


@query("catalog_feed", with_views(f"""
SELECT kind, count(*) AS n FROM fx_catalog_event
WHERE kind IN ({_KINDS})
GROUP BY kind""", "fx_catalog_event"))
def catalog_feed(spark, sf_dir):
    from .operators.catalog import read_catalog_events
    return read_catalog_events(fx.catalog_event(Tables(spark, sf_dir))).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"))


@query("catalog_changes", with_views(f"""
SELECT c.event_id, c.change, c.db, c.tbl,
  CASE WHEN c.change = 'CREATE_DATABASE' THEN d.description || '|' || d.location_uri ELSE c.detail END AS detail
FROM ({_CHANGES}) c LEFT JOIN fx_database d ON c.db = d.name""", "fx_catalog_event", "fx_database"))
def catalog_changes_q(spark, sf_dir):
    return _changes(spark, sf_dir).select("event_id", "change", "db", "tbl", "detail")


def _table_columns_sql(kind: str) -> str:
    return with_views(f"""
SELECT c.event_id, c.change, c.db, c.tbl, c2.pos, c2.name, c2.data_type,
  CASE WHEN c2.name IS NOT NULL THEN coalesce(c2.comment, '') END AS comment
FROM ({_CHANGES}) c LEFT JOIN fx_catalog_column c2 ON c.db = c2.db AND c.tbl = c2.tbl
WHERE c.change = 'CREATE_TABLE' AND c.kind = '{kind}'""", "fx_catalog_event", "fx_catalog_column")


def _table_columns(spark, sf_dir, kind):
    from .operators.catalog import table_columns
    ch = _changes(spark, sf_dir, with_db=False).where(F.col("kind") == kind)
    tc = table_columns(ch, fx.catalog_column(Tables(spark, sf_dir)))
    return tc.select("event_id", "change", "db", "tbl", "pos", "name", "data_type", "comment")


@query("create_table_columns", _table_columns_sql("CreateTableEvent"))
def create_table_columns(spark, sf_dir):
    return _table_columns(spark, sf_dir, "CreateTableEvent")


@query("rename_table_columns", _table_columns_sql("RenameTableEvent"))
def rename_table_columns(spark, sf_dir):
    return _table_columns(spark, sf_dir, "RenameTableEvent")


@query("table_columns_at_event", with_views(f"""
SELECT c.event_id, c.seq, c.db, c.tbl, h.pos, h.name, h.data_type, CASE WHEN h.name IS NOT NULL THEN coalesce(h.comment, '') END AS comment
FROM (SELECT * FROM ({_CHANGES}) c WHERE change = 'CREATE_TABLE') c
ASOF LEFT JOIN (SELECT DISTINCT db, tbl, v, valid_from FROM fx_catalog_history) w ON c.db = w.db AND c.tbl = w.tbl AND c.ts >= w.valid_from
LEFT JOIN fx_catalog_history h ON h.db = w.db AND h.tbl = w.tbl AND h.v = w.v
  AND NOT (h.v = 2 AND h.grp % 4 = 0) AND (h.pos = 1 OR (h.pos + h.v) % 3 <> 0)""", "fx_catalog_event", "fx_catalog_history"))
def table_columns_at_event(spark, sf_dir):
    """C4 + C7 + J4: the columns of the definition that was in force when a table was created or renamed."""
    from .operators.catalog import table_columns_at
    t = Tables(spark, sf_dir)
    out = table_columns_at(_changes(spark, sf_dir, with_db=False), fx.catalog_column_history(t))
    return out.select("event_id", "seq", "db", "tbl", "pos", "name", "data_type", "comment")


@query("catalog_state", with_views(f"""
SELECT db, tbl, change AS last_kind, event_id AS last_event_id,
  change IN ('CREATE_DATABASE', 'ALTER_DATABASE', 'CREATE_TABLE', 'ALTER_TABLE')
  AND NOT EXISTS (SELECT 1 FROM ({_CHANGES}) d WHERE d.change = 'DROP_DATABASE' AND d.db = x.db
                  AND (d.ts > x.ts OR (d.ts = x.ts AND (d.event_id > x.event_id OR (d.event_id = x.event_id AND d.seq > x.seq)))))
  AS alive
FROM (SELECT *, row_number() OVER (PARTITION BY db, tbl ORDER BY ts DESC, event_id DESC, seq DESC) AS rn
      FROM ({_CHANGES}) c) x WHERE rn = 1""", "fx_catalog_event"))
def catalog_state_q(spark, sf_dir):
    from .operators.catalog import catalog_state
    return catalog_state(_changes(spark, sf_dir, with_db=False))


@query("catalog_tally", with_views(f"""
SELECT CASE WHEN kind IN ({_KINDS}) THEN kind ELSE 'UNSUPPORTED' END AS kind, count(*) AS n
FROM fx_catalog_event GROUP BY 1""", "fx_catalog_event"))
def catalog_tally_q(spark, sf_dir):
    from .operators.catalog import catalog_tally
    return catalog_tally(fx.catalog_event(Tables(spark, sf_dir)))


@query("ddl_changes", with_views("""
SELECT command,
  CASE command WHEN 'DropTableCommand' THEN CASE WHEN coalesce(is_view, false) THEN 'drop_view' ELSE 'drop_table' END
               WHEN 'CreateTableCommand' THEN 'create_table' WHEN 'CreateTableLikeCommand' THEN 'create_table_like'
               WHEN 'AlterTableRenameCommand' THEN 'rename_table' WHEN 'CreateViewCommand' THEN 'create_view'
               ELSE 'unsupported' END AS change,
  count(*) AS n
FROM fx_ddl_event GROUP BY 1, 2""", "fx_ddl_event"))
def ddl_changes_q(spark, sf_dir):
    from .operators.catalog import ddl_changes
    return ddl_changes(fx.ddl_event(Tables(spark, sf_dir))).groupBy("command", "change").agg(
        F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# F10, F12 over customer rows


@query("trim_and_purge", """
SELECT c_custkey, array_to_string(list_filter(list_transform(string_split(raw, ','), lambda x: trim(x)),
                                              lambda x: x <> ''), '|') AS items,
  CAST(len(list_filter(list_transform(string_split(raw, ','), lambda x: trim(x)), lambda x: x <> '')) AS INT)
    AS n_items
FROM (SELECT c_custkey, ' ' || c_mktsegment || ' , ,' || c_name || ' ,  ' AS raw FROM customer) c""")
def trim_and_purge_q(spark, sf_dir):
    from .functions.names import split_list
    c = Tables(spark, sf_dir).customer
    raw = F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" , ,"), F.col("c_name"), F.lit(" ,  "))
    items = split_list(raw, ",")
    return c.select("c_custkey", F.array_join(items, "|").alias("items"), F.size(items).alias("n_items"))


@query("user_preference", """
SELECT c_custkey, coalesce(nullif(given, ''), nullif(grp, ''), 'system') AS user_name
FROM (SELECT c_custkey,
        CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN '' END AS given,
        CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS grp FROM customer) c""")
def user_preference_q(spark, sf_dir):
    from .functions.names import user_preference
    c = Tables(spark, sf_dir).customer
    k = F.col("c_custkey")
    given = F.when(k % 3 == 0, F.col("c_name")).when(k % 3 == 1, F.lit(""))
    grp = F.when(k % 2 == 0, F.col("c_mktsegment")).otherwise(F.lit(""))
    return c.select("c_custkey", user_preference(given, grp, F.lit("system")).alias("user_name"))




# ---------------------------------------------------------------------------
# S3-S5 over a plan log that grows with the tables


_PLAN_LOG: dict = {}


def plan_log_path(spark: SparkSession, sf_dir: str) -> str:
    """The plan log derived from the tables of ``sf_dir``, written once per
    session to the shared scratch folder (it is the input log, like a
    captured one would be) and read by the plan and stream queries."""
    from .session import scratch_path
    from .sources.plan_log import plan_log
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PLAN_LOG:
        path = scratch_path(spark, "plan_log")
        plan_log(Tables(spark, sf_dir)).write.option("compression", "zstd").parquet(path)
        _PLAN_LOG[key] = path
    return _PLAN_LOG[key]


def _plan_tables(spark, sf_dir):
    """Plan log -> parsed once into the shared scratch folder -> event tables."""
    from .plans.shred import event_tables_from_plans
    from .session import scratch_path
    log = spark.read.parquet(plan_log_path(spark, sf_dir))
    return event_tables_from_plans(log, stage_path=scratch_path(spark, "plan_nodes"))


_PHYSICAL_LOG: dict = {}


def physical_log_path(spark: SparkSession, sf_dir: str) -> str:
    """The executions' physical plans, written once per session like the plan log."""
    from .session import scratch_path
    from .sources.plan_log import physical_log
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PHYSICAL_LOG:
        path = scratch_path(spark, "physical_log")
        physical_log(Tables(spark, sf_dir)).write.option("compression", "zstd").parquet(path)
        _PHYSICAL_LOG[key] = path
    return _PHYSICAL_LOG[key]


@query("plan_nodes", with_views("""
SELECT event_id, node_pos, parent_pos, last_pos, cls FROM ox_plan_node""", "ox_plan_node"))
def plan_nodes_q(spark, sf_dir):
    from .plans.tree import plan_nodes
    return plan_nodes(spark.read.parquet(physical_log_path(spark, sf_dir)))


@query("classify_plan", with_views("""
SELECT n.event_id, bool_or(n.cls = 'ExecutedCommandExec') AS has_ddl, bool_or(n.cls = 'DataWritingCommandExec') AS has_write,
  bool_or(n.cls = 'WriteToDataSourceV2Exec') AS has_v2,
  CAST(sum(CASE WHEN n.cls = 'DataWritingCommandExec' THEN CASE WHEN p.cls = 'UnionExec' THEN 2 ELSE 1 END ELSE 0 END) AS BIGINT) AS n_write_cmds
FROM ox_plan_node n LEFT JOIN ox_plan_node p ON n.event_id = p.event_id AND n.parent_pos = p.node_pos
GROUP BY n.event_id""", "ox_plan_node"))
def classify_plan_q(spark, sf_dir):
    from .plans.tree import classify_plans
    return classify_plans(spark.read.parquet(physical_log_path(spark, sf_dir)))


@query("plan_expression_text", with_views("""
SELECT o.event_id, CAST(o.pos AS INT) AS out_pos,
  CASE WHEN o.expr_text LIKE '%(%' THEN 'coalesce(' || string_agg(l.t, ', ' ORDER BY l.leaf_pos) || ')'
       ELSE repeat('(', CAST(count(*) - 1 AS INT)) || string_agg(CASE WHEN l.leaf_pos = 1 THEN l.t ELSE ' + ' || l.t || ')' END, '' ORDER BY l.leaf_pos)
  END AS expression
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY out_pos) - 1 AS pos FROM fx_output_expr) o
JOIN fx_write_event w ON o.event_id = w.event_id AND w.root_kind = 'PROJECT'
JOIN (SELECT *, CASE WHEN attr_id IS NULL THEN CAST(leaf_pos AS VARCHAR) ELSE 'Col_' || CAST(attr_id // 1000 AS VARCHAR) END AS t
      FROM fx_output_leaf) l ON o.event_id = l.event_id AND o.out_pos = l.out_pos
WHERE o.n_children > 0
GROUP BY o.event_id, o.pos, o.expr_text""", "fx_output_expr", "fx_write_event", "fx_output_leaf"))
def plan_expression_text(spark, sf_dir):
    """The texts of all derived outputs, folded out of the plan's own expression nodes (the ids of a run left out)."""
    from .functions.names import strip_expr_ids
    from .plans.shred import output_texts
    log = spark.read.parquet(plan_log_path(spark, sf_dir))
    return output_texts(log).select("event_id", "out_pos", strip_expr_ids("expression").alias("expression"))


def _plan_lineage(spark, sf_dir, policy: Policy = DEFAULT_POLICY):
    """The lineage of the plan log, each execution's in its own row."""
    from .plans.in_row import PlanLineage
    return PlanLineage(spark.read.parquet(plan_log_path(spark, sf_dir)), policy=policy)


@query("plan_scans", with_views("""
SELECT pr.event_id, CAST(pr.node_pos AS BIGINT) AS rel_pos,
  CASE WHEN pr.is_catalog THEN pr.db END AS db, CASE WHEN pr.is_catalog THEN pr.tbl END AS tbl, pr.is_catalog,
  c.attr_id, c.col, pr.is_catalog AND c.is_partition_col AS is_partition_col
FROM (SELECT r.*, CASE WHEN w.root_kind = 'RELATION' THEN 0
                       ELSE 1 + row_number() OVER (PARTITION BY r.event_id ORDER BY r.rel_pos) END AS node_pos
      FROM fx_scan_relation r JOIN fx_write_event w ON r.event_id = w.event_id) pr
JOIN fx_scan_column c ON pr.event_id = c.event_id AND pr.rel_pos = c.rel_pos""",
                                "fx_scan_relation", "fx_write_event", "fx_scan_column"))
def plan_scans(spark, sf_dir):
    t = _plan_tables(spark, sf_dir)
    return t.scan_relation.join(t.scan_column, ["event_id", "rel_pos"]).select(
        "event_id", "rel_pos", "db", "tbl", "is_catalog", "attr_id", "col", "is_partition_col")


@query("plan_outputs", with_views("""
SELECT o.event_id, CAST(o.pos AS INT) AS out_pos, o.out_name, o.out_attr_id, o.n_children, o.expr_text,
  CASE WHEN o.n_children = 0 THEN CAST(o.out_attr_id AS VARCHAR) ELSE l.leaves END AS leaves
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY out_pos) - 1 AS pos FROM fx_output_expr) o
JOIN fx_write_event w ON o.event_id = w.event_id AND w.root_kind = 'PROJECT'
LEFT JOIN (SELECT event_id, out_pos,
             string_agg(coalesce(CAST(attr_id AS VARCHAR), 'lit'), '|' ORDER BY leaf_pos) AS leaves
           FROM fx_output_leaf GROUP BY event_id, out_pos) l
  ON o.event_id = l.event_id AND o.out_pos = l.out_pos""", "fx_output_expr", "fx_write_event", "fx_output_leaf"))
def plan_outputs(spark, sf_dir):
    t = _plan_tables(spark, sf_dir)
    lv = (t.output_leaf.groupBy("event_id", "out_pos")
          .agg(F.sort_array(F.collect_list(F.struct("leaf_pos", "attr_id"))).alias("l"))
          .select("event_id", "out_pos", F.array_join(
              F.transform("l", lambda x: F.coalesce(x["attr_id"].cast("string"), F.lit("lit"))), "|").alias("leaves")))
    return t.output_expr.join(lv, ["event_id", "out_pos"], "left").select(
        "event_id", "out_pos", "out_name", "out_attr_id", "n_children", "expr_text", "leaves")


@query("plan_table_lineage", ORACLE["table_lineage"])
def plan_table_lineage(spark, sf_dir):
    g = _plan_lineage(spark, sf_dir).good
    return g.select("event_id", "target_qn", _join("inputs").alias("inputs"),
                    F.col("n_inputs").cast("bigint").alias("n_inputs"))


@query("plan_column_lineage", ORACLE["column_lineage"])
def plan_column_lineage(spark, sf_dir):
    c = _plan_lineage(spark, sf_dir).column_lineage
    return c.select("event_id", "branch", "lineage_id", _join("inputs").alias("inputs"), "dep_type", "expression")


@query("catalog_app_tag", with_views(f"""
SELECT change, count(*) AS n, true AS tagged FROM ({_CHANGES}) c GROUP BY change""", "fx_catalog_event"))
def catalog_app_tag(spark, sf_dir):
    """Every catalog change carries the application name and master of the session that saw it."""
    from .operators.catalog import with_app
    tagged = with_app(_changes(spark, sf_dir))
    return tagged.groupBy("change").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.col("app_name").isNotNull() & F.col("master").isNotNull()).alias("tagged"))


@query("keyed_messages", with_views("""
SELECT target_qn AS key, CAST(row_number() OVER (PARTITION BY target_qn ORDER BY event_id) AS INT) AS seq, event_id
FROM ox_good""", "ox_good"))
def keyed_messages(spark, sf_dir):
    """T5: messages keyed by target table, numbered within their key in event order."""
    from .operators.deliver import keyed_for_sink, to_messages
    return keyed_for_sink(to_messages(lineage(spark, sf_dir))).select("key", "seq", "event_id")


# warehouse and streaming queries register themselves on import
from . import warehouse_queries as _warehouse_queries  # noqa: E402,F401
from . import streaming_queries as _streaming_queries  # noqa: E402,F401
