"""DuckDB oracle SQL for every registered query.

The oracle only sees the base tables, so each query repeats the event views
it needs as CTEs (``with_views``).  The views are the SQL twins of
``provena.sources.fixtures``; lists are flattened with ``string_agg(.., '|'
ORDER BY pos)`` and compared against ``array_join(.., '|')`` on the Spark side.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, deps: tuple[str, ...], body: str) -> None:
    VIEWS[name] = (deps, body.strip())


_view("fx_write_event", (), """
SELECT o_orderkey AS event_id, o_orderdate AS ts, o_custkey AS session_id,
  CASE WHEN o_orderkey % 17 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CreateHiveTableAsSelectCommand' WHEN '2-HIGH' THEN 'InsertIntoHiveTable'
       WHEN '3-MEDIUM' THEN 'CreateDataSourceTableAsSelectCommand' WHEN '4-NOT SPECIFIED' THEN 'InsertIntoHadoopFsRelationCommand' ELSE 'OTHER' END AS command,
  CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE 'db' || CAST(o_custkey % 5 AS VARCHAR) END AS target_db,
  'T_' || CAST(o_custkey % 50 AS VARCHAR) AS target_table,
  'cur' || CAST(o_custkey % 3 AS VARCHAR) AS current_db,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '' ELSE 'q' || CAST(o_orderkey AS VARCHAR) END AS sql_text,
  CASE WHEN lo = hi THEN 'RELATION' WHEN o_orderkey % 10 = 1 THEN 'OTHER' ELSE 'PROJECT' END AS root_kind
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS lo, max(l_suppkey) AS hi FROM lineitem GROUP BY l_orderkey) s
  ON o_orderkey = l_orderkey""")

_view("fx_scan_relation", (), """
SELECT DISTINCT l_orderkey AS event_id, l_suppkey AS rel_pos,
  CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE 'src' || CAST(l_suppkey % 4 AS VARCHAR) END AS db,
  'S_' || CAST(l_suppkey % 40 AS VARCHAR) AS tbl,
  l_suppkey % 8 <> 0 AS is_catalog
FROM lineitem""")

_view("fx_scan_column", ("fx_scan_relation",), """
SELECT DISTINCT l.l_orderkey AS event_id, l.l_suppkey AS rel_pos,
  l.l_partkey * 1000 + l.l_suppkey AS attr_id,
  'Col_' || CAST(l.l_partkey AS VARCHAR) AS col, p.p_type = 'PROMO' AS is_partition_col
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
JOIN fx_scan_relation r ON r.event_id = l.l_orderkey AND r.rel_pos = l.l_suppkey""")

_view("fx_output_leaf", (), """
SELECT l_orderkey AS event_id, l_linenumber AS out_pos,
  CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS INT) AS leaf_pos,
  CASE WHEN l_suppkey % 20 = 3 THEN NULL ELSE l_partkey * 1000 + l_suppkey END AS attr_id,
  l_suppkey % 20 <> 3 AS is_named
FROM lineitem""")

_view("fx_output_expr", (), """
SELECT l_orderkey AS event_id, l_linenumber AS out_pos, 'Out_' || CAST(l_linenumber AS VARCHAR) AS out_name,
  CASE WHEN count(*) = 1 AND min(l_returnflag) = 'N' THEN min(l_partkey * 1000 + l_suppkey) ELSE -l_linenumber END AS out_attr_id,
  CASE WHEN count(*) = 1 AND min(l_returnflag) = 'N' THEN 0 ELSE 1 END AS n_children,
  CASE WHEN count(*) = 1 AND min(l_returnflag) = 'N' THEN NULL
       WHEN min(l_returnflag) = 'A' THEN 'f(' || CAST(l_linenumber AS VARCHAR) || ')'
       ELSE 'x' || CAST(l_linenumber AS VARCHAR) END AS expr_text
FROM lineitem GROUP BY l_orderkey, l_linenumber""")

_view("fx_catalog_event", (), """
SELECT event_id, ts, user_id AS session_id,
  CASE WHEN k < 5 THEN CASE event_type WHEN 'signup' THEN 'CreateDatabaseEvent' WHEN 'error' THEN 'DropDatabaseEvent' WHEN 'purchase' THEN 'AlterDatabaseEvent' ELSE 'Ignored' END
       ELSE CASE event_type WHEN 'signup' THEN 'CreateTableEvent' WHEN 'error' THEN 'DropTableEvent' WHEN 'purchase' THEN 'AlterTableEvent' WHEN 'click' THEN 'RenameTableEvent' ELSE 'CreateTablePre' END END AS kind,
  CASE WHEN k % 5 = 4 THEN 'lake' ELSE 'db' || CAST(k % 5 AS VARCHAR) END AS db,
  CASE WHEN k < 5 THEN NULL WHEN k % 10 = 7 THEN 'gone_' || CAST(k AS VARCHAR)
       ELSE 't_' || CAST(k + 100 * (event_id // 2000) AS VARCHAR) END AS tbl,
  CASE WHEN k >= 5 AND event_type = 'click'
       THEN 't_' || CAST(5 + (k + event_id) % 95 + 100 * (event_id // 2000) AS VARCHAR) END AS new_name,
  CASE WHEN k >= 5 AND event_type = 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'dataSchema' ELSE 'stats' END END AS change_kind
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e""")

_view("fx_catalog_column", (), """
SELECT CASE WHEN p_partkey % 5 = 4 THEN 'lake' ELSE 'db' || CAST(p_partkey % 5 AS VARCHAR) END AS db,
  't_' || CAST(p_partkey % 100 + 100 * (p_partkey // 400) AS VARCHAR) AS tbl,
  CAST(row_number() OVER (PARTITION BY p_partkey % 100 + 100 * (p_partkey // 400) ORDER BY p_partkey) AS INT) AS pos,
  'Col_' || CAST(p_partkey AS VARCHAR) AS name, lower(p_type) AS data_type,
  CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END AS comment
FROM part""")

_view("fx_catalog_history", ("fx_catalog_column",), """
SELECT db, tbl, grp, v, TIMESTAMP '2024-01-01 12:00:00' + to_days(CAST(v * (1 + grp % 9) AS INT)) AS valid_from, pos, name,
  data_type || '_' || CAST(v AS VARCHAR) AS data_type, comment
FROM (SELECT *, CAST(substr(tbl, 3) AS BIGINT) AS grp FROM fx_catalog_column) c, (SELECT unnest(range(3)) AS v) n""")

_view("fx_database", (), """
SELECT 'db' || CAST(n_nationkey AS VARCHAR) AS name, n_name AS description, '/wh/' || lower(n_name) AS location_uri
FROM nation""")

_view("fx_sql_text", (), """
SELECT user_id AS session_id, ts, 'sql_' || CAST(event_id AS VARCHAR) AS sql_text FROM events WHERE event_type = 'view'""")

_view("fx_exec", (), """
SELECT event_id, user_id AS session_id, ts FROM events WHERE event_type = 'purchase'""")

_view("fx_ddl_event", ("fx_catalog_event",), """
SELECT event_id, ts,
  CASE kind WHEN 'CreateTableEvent' THEN CASE WHEN event_id % 5 = 0 THEN 'CreateViewCommand'
                                          WHEN event_id % 2 = 0 THEN 'CreateTableCommand'
                                          ELSE 'CreateTableLikeCommand' END
            WHEN 'DropTableEvent' THEN 'DropTableCommand'
            WHEN 'RenameTableEvent' THEN 'AlterTableRenameCommand'
            ELSE 'AlterTableSetPropertiesCommand' END AS command,
  db, tbl, new_name,
  CASE WHEN kind = 'DropTableEvent' THEN event_id % 3 = 0 END AS is_view,
  CASE WHEN kind = 'CreateTableEvent' AND event_id % 2 = 1 THEN 't_' || CAST(event_id % 90 + 10 AS VARCHAR) END AS source_tbl
FROM fx_catalog_event WHERE kind IN ('CreateTableEvent', 'DropTableEvent', 'RenameTableEvent', 'AlterTableEvent')""")

# The nodes of an execution's physical plan: each branch by its own offsets (class, parent, last), under a union where
# there is more than one.
_view("ox_plan_node", ("ox_branch",), """
SELECT event_id, 0 AS node_pos, CAST(NULL AS INT) AS parent_pos, CAST(sum(len(b)) AS INT) AS last_pos, 'UnionExec' AS cls
FROM ox_branch GROUP BY event_id HAVING count(*) > 1
UNION ALL
SELECT event_id, CAST(base + n.i AS INT), CAST(CASE WHEN n.p >= 0 THEN base + n.p WHEN many THEN 0 END AS INT), CAST(base + n.l AS INT), n.c
FROM (SELECT event_id, many, CAST(many AS INT) + coalesce(sum(len(b)) OVER (
        PARTITION BY event_id ORDER BY branch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base, unnest(b) AS n
      FROM (SELECT *, count(*) OVER (PARTITION BY event_id) > 1 AS many FROM ox_branch) m) x""")

_view("ox_branch", (), """
SELECT l_orderkey AS event_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS branch,
  CASE WHEN l_partkey % 7 = 0 THEN [{'i': 0, 'c': 'ExecutedCommandExec', 'p': -1, 'l': 0}]
       WHEN l_partkey % 7 <= 3 AND l_returnflag = 'N' THEN [{'i': 0, 'c': 'DataWritingCommandExec', 'p': -1, 'l': 2},
         {'i': 1, 'c': 'ProjectExec', 'p': 0, 'l': 2}, {'i': 2, 'c': 'FileSourceScanExec', 'p': 1, 'l': 2}]
       WHEN l_partkey % 7 <= 3 THEN [{'i': 0, 'c': 'DataWritingCommandExec', 'p': -1, 'l': 1}, {'i': 1, 'c': 'FileSourceScanExec', 'p': 0, 'l': 1}]
       WHEN l_partkey % 7 = 4 THEN [{'i': 0, 'c': 'WriteToDataSourceV2Exec', 'p': -1, 'l': 1}, {'i': 1, 'c': 'FileSourceScanExec', 'p': 0, 'l': 1}]
       WHEN l_partkey % 7 = 5 THEN [{'i': 0, 'c': 'UnionExec', 'p': -1, 'l': 4}, {'i': 1, 'c': 'DataWritingCommandExec', 'p': 0, 'l': 2},
         {'i': 2, 'c': 'FileSourceScanExec', 'p': 1, 'l': 2}, {'i': 3, 'c': 'DataWritingCommandExec', 'p': 0, 'l': 4},
         {'i': 4, 'c': 'FileSourceScanExec', 'p': 3, 'l': 4}]
       ELSE [{'i': 0, 'c': 'ProjectExec', 'p': -1, 'l': 2}, {'i': 1, 'c': 'FilterExec', 'p': 0, 'l': 2}, {'i': 2, 'c': 'FileSourceScanExec', 'p': 1, 'l': 2}]
  END AS b
FROM lineitem""")

# --- derived views shared by the lineage queries (default policy) -----------

_view("ox_rules", (), """
SELECT * FROM (VALUES
  ('CreateHiveTableAsSelectCommand', 'LINEAGE', 'CREATETABLE_AS_SELECT', 'CREATE_TABLE_AS_SELECT', 'TARGET', 'DEFAULT', 'EMIT'),
  ('InsertIntoHiveTable', 'LINEAGE', 'QUERY', 'FROM_TABLE_INSERT_SELECT', 'QUERY', 'DEFAULT', 'QUARANTINE'),
  ('CreateDataSourceTableAsSelectCommand', 'LINEAGE', 'QUERY', 'FROM_TABLE_INSERT_SELECT', 'QUERY', 'CURRENT', 'QUARANTINE'),
  ('InsertIntoHadoopFsRelationCommand', 'FS_WRITE', NULL, NULL, NULL, NULL, NULL)
) AS r(command, route, op_type, fallback_sql, id_rule, db_rule, empty_inputs)""")

_view("ox_inputs", ("fx_scan_relation",), """
SELECT event_id,
  string_agg(coalesce(db, 'default') || '.' || tbl || '@5k', '|' ORDER BY rel_pos) AS inputs_txt,
  string_agg(coalesce(db, 'default') || '.' || tbl || '@5k', ':' ORDER BY rel_pos) AS inputs_colon,
  count(*) AS n_inputs
FROM fx_scan_relation WHERE is_catalog GROUP BY event_id""")

_view("ox_events", ("fx_write_event", "ox_rules", "ox_inputs"), """
SELECT e.*, coalesce(r.route, 'UNSUPPORTED') AS route, r.op_type, r.fallback_sql, r.id_rule, r.db_rule, r.empty_inputs,
  coalesce(e.target_db, CASE WHEN r.db_rule = 'CURRENT' THEN e.current_db ELSE 'default' END) AS database,
  coalesce(e.target_db, CASE WHEN r.db_rule = 'CURRENT' THEN e.current_db ELSE 'default' END)
    || '.' || e.target_table || '@5k' AS target_qn,
  coalesce(i.inputs_txt, '') AS inputs_txt, i.inputs_colon, coalesce(i.n_inputs, 0) AS n_inputs
FROM fx_write_event e LEFT JOIN ox_rules r ON e.command = r.command
LEFT JOIN ox_inputs i ON e.event_id = i.event_id
WHERE e.status = 'SUCCESS'""")

_view("ox_events_q", ("ox_events",), """
SELECT *,
  CASE WHEN route = 'FS_WRITE' THEN 'FS_WRITE'
       WHEN route = 'UNSUPPORTED' THEN 'UNSUPPORTED_COMMAND'
       WHEN empty_inputs = 'QUARANTINE' AND n_inputs = 0 THEN 'NO_INPUT_TABLE' END AS reason,
  CASE WHEN id_rule = 'TARGET' THEN target_qn
       ELSE 'QUERY:' || coalesce(inputs_colon, '') || '->:INSERT_OVERWRITE:' || target_qn END AS process_qn,
  coalesce(nullif(sql_text, ''), fallback_sql) AS query_text
FROM ox_events""")

_view("ox_good", ("ox_events_q",), """
SELECT * FROM ox_events_q WHERE reason IS NULL AND route = 'LINEAGE'""")

_view("ox_catcols", ("fx_scan_relation", "fx_scan_column"), """
SELECT c.event_id, c.rel_pos, c.attr_id, c.col, c.is_partition_col,
  lower(coalesce(r.db, 'default') || '.' || r.tbl || '.' || c.col || '@5k') AS input_qn
FROM fx_scan_column c JOIN fx_scan_relation r ON c.event_id = r.event_id AND c.rel_pos = r.rel_pos
WHERE r.is_catalog""")

_view("ox_dict", ("ox_catcols",), """
SELECT event_id, attr_id, input_qn FROM ox_catcols""")

_view("ox_outputs", ("fx_output_expr", "ox_dict"), """
SELECT o.*, d.input_qn AS pass_qn
FROM fx_output_expr o LEFT JOIN ox_dict d ON o.event_id = d.event_id AND o.out_attr_id = d.attr_id""")

_view("ox_hits", ("fx_output_leaf", "ox_dict"), """
SELECT l.event_id, l.out_pos, string_agg(d.input_qn, '|' ORDER BY l.leaf_pos) AS inputs_txt, count(*) AS n_hits
FROM fx_output_leaf l JOIN ox_dict d ON l.event_id = d.event_id AND l.attr_id = d.attr_id
GROUP BY l.event_id, l.out_pos""")

_view("ox_colrows", ("ox_outputs", "ox_hits", "ox_catcols", "ox_good"), """
SELECT event_id, 'PASSTHROUGH' AS branch, out_name, pass_qn AS inputs_txt, 1 AS n_inputs,
       CAST(NULL AS VARCHAR) AS expression
FROM ox_outputs WHERE pass_qn IS NOT NULL
UNION ALL
SELECT o.event_id, 'DERIVED', o.out_name, coalesce(h.inputs_txt, ''), coalesce(h.n_hits, 0),
  CASE WHEN coalesce(h.n_hits, 0) = 1 AND NOT (o.expr_text LIKE '%(%' AND o.expr_text LIKE '%)%') THEN NULL
       ELSE o.expr_text END
FROM ox_outputs o LEFT JOIN ox_hits h ON o.event_id = h.event_id AND o.out_pos = h.out_pos
WHERE o.pass_qn IS NULL AND o.n_children >= 1
UNION ALL
SELECT c.event_id, 'DIRECT', c.col, arg_max(c.input_qn, c.rel_pos), 1, 'DirectMapping'
FROM ox_catcols c JOIN ox_good g ON c.event_id = g.event_id AND g.root_kind = 'RELATION'
GROUP BY c.event_id, c.col""")

_view("ox_colineage", ("ox_colrows", "ox_good"), """
SELECT r.event_id, g.ts, g.root_kind, r.branch, r.out_name, g.process_qn,
  g.database || '.' || g.target_table || '@5k:' || lower(r.out_name) AS lineage_id,
  g.database || '.' || g.target_table || '.' || lower(r.out_name) || '@5k' AS output_qn,
  r.inputs_txt, r.n_inputs, r.expression,
  CASE WHEN r.expression IS NULL THEN 'SIMPLE' ELSE 'EXPRESSION' END AS dep_type
FROM ox_colrows r JOIN ox_good g ON r.event_id = g.event_id
WHERE (r.branch = 'DIRECT' AND g.root_kind = 'RELATION')
   OR (r.branch <> 'DIRECT' AND g.root_kind = 'PROJECT')""")


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs for ``names`` and everything they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body.strip()}"
