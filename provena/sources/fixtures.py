"""Normalised event tables derived from the driver tables.

Each function turns base tables into one of the L1 event tables the engine
consumes (write events, scanned relations and columns, output expressions
and leaves, catalog events, SQL-text log).  They are the
scalable stand-in for a captured query log: the row count grows with the
scale factor, and every view is one declarative plan (no Python per row).

Reading key: an order is a write event, its line items are leaf references
of output columns, suppliers are scanned tables, (part, supplier) is a source
attribute and ``events`` doubles as catalog log and SQL/execution log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Tables


def _items(t: Tables, *cols: str) -> DataFrame:
    """These columns of the line items, each order's in one task.  What is worked out for a single execution then stays
    there: keys that begin with ``l_orderkey`` need no other exchange, and the texts made of the columns move nowhere."""
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return t.lineitem.select("l_orderkey", *cols).repartition(n, "l_orderkey")


def write_event(t: Tables) -> DataFrame:
    """One write event per order.  Its query is a bare relation where all line items come from one supplier, i.e. where
    one table is scanned; else a projection, or in one case of ten something else."""
    scanned = t.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("lo"), F.max("l_suppkey").alias("hi"))
    return t.orders.join(scanned, F.col("o_orderkey") == F.col("l_orderkey"), "left").selectExpr(
        "o_orderkey AS event_id", "o_orderdate AS ts", "o_custkey AS session_id",
        "CASE WHEN o_orderkey % 17 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'CreateHiveTableAsSelectCommand'
                                WHEN '2-HIGH' THEN 'InsertIntoHiveTable'
                                WHEN '3-MEDIUM' THEN 'CreateDataSourceTableAsSelectCommand'
                                WHEN '4-NOT SPECIFIED' THEN 'InsertIntoHadoopFsRelationCommand' ELSE 'OTHER' END AS command""",
        "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE concat('db', CAST(o_custkey % 5 AS STRING)) END AS target_db",
        "concat('T_', CAST(o_custkey % 50 AS STRING)) AS target_table",
        "concat('cur', CAST(o_custkey % 3 AS STRING)) AS current_db",
        """CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN ''
                ELSE concat('q', CAST(o_orderkey AS STRING)) END AS sql_text""",
        "CASE WHEN lo = hi THEN 'RELATION' WHEN o_orderkey % 10 = 1 THEN 'OTHER' ELSE 'PROJECT' END AS root_kind",
    )


def scan_relation(t: Tables) -> DataFrame:
    """One row per (event, scanned relation): the suppliers of an order."""
    return _items(t, "l_suppkey").selectExpr("l_orderkey AS event_id", "l_suppkey AS rel_pos").distinct().selectExpr(
        "event_id", "rel_pos",
        "CASE WHEN rel_pos % 9 = 0 THEN NULL ELSE concat('src', CAST(rel_pos % 4 AS STRING)) END AS db",
        "concat('S_', CAST(rel_pos % 40 AS STRING)) AS tbl",
        "rel_pos % 8 <> 0 AS is_catalog",
    )


def scan_column(t: Tables) -> DataFrame:
    """Data and partition columns of every scanned relation; attr ids are unique per event."""
    li = t.lineitem.selectExpr("l_orderkey AS event_id", "l_suppkey AS rel_pos", "l_partkey AS pk")
    part = t.part.selectExpr("p_partkey AS pk", "p_type = 'PROMO' AS is_partition_col")
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return (li.join(part, "pk").repartition(n, "event_id")
            .selectExpr("event_id", "rel_pos", "pk * 1000 + rel_pos AS attr_id",
                        "concat('Col_', CAST(pk AS STRING)) AS col", "is_partition_col")
            .distinct())


def output_leaf(t: Tables) -> DataFrame:
    """Leaves of every output column in leaf order; a null attr id is a literal."""
    return _items(t, "l_linenumber", "l_partkey", "l_suppkey").selectExpr(
        "l_orderkey AS event_id", "l_linenumber AS out_pos",
        "CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS INT)"
        " AS leaf_pos",
        "CASE WHEN l_suppkey % 20 = 3 THEN NULL ELSE l_partkey * 1000 + l_suppkey END AS attr_id",
        "l_suppkey % 20 <> 3 AS is_named",
    )


def output_expr(t: Tables) -> DataFrame:
    """Root project list: per output column its name, attr id, child count and text."""
    g = (_items(t, "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").groupBy("l_orderkey", "l_linenumber")
         .agg(F.expr("count(1) AS n"), F.expr("min(l_returnflag) AS flag"),
              F.expr("min(l_partkey * 1000 + l_suppkey) AS attr")))
    single = "(n = 1 AND flag = 'N')"
    return g.selectExpr(
        "l_orderkey AS event_id", "l_linenumber AS out_pos",
        "concat('Out_', CAST(l_linenumber AS STRING)) AS out_name",
        f"CASE WHEN {single} THEN attr ELSE -l_linenumber END AS out_attr_id",
        f"CASE WHEN {single} THEN 0 ELSE 1 END AS n_children",
        f"""CASE WHEN {single} THEN NULL
                 WHEN flag = 'A' THEN concat('f(', CAST(l_linenumber AS STRING), ')')
                 ELSE concat('x', CAST(l_linenumber AS STRING)) END AS expr_text""",
    )


def catalog_event(t: Tables) -> DataFrame:
    e = t.events.selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
    return e.selectExpr(
        "event_id", "ts", "user_id AS session_id",
        """CASE WHEN k < 5 THEN CASE event_type WHEN 'signup' THEN 'CreateDatabaseEvent' WHEN 'error' THEN 'DropDatabaseEvent'
                                                WHEN 'purchase' THEN 'AlterDatabaseEvent' ELSE 'Ignored' END
                ELSE CASE event_type WHEN 'signup' THEN 'CreateTableEvent' WHEN 'error' THEN 'DropTableEvent'
                                     WHEN 'purchase' THEN 'AlterTableEvent' WHEN 'click' THEN 'RenameTableEvent'
                                     ELSE 'CreateTablePre' END END AS kind""",
        "CASE WHEN k % 5 = 4 THEN 'lake' ELSE concat('db', CAST(k % 5 AS STRING)) END AS db",
        """CASE WHEN k < 5 THEN NULL WHEN k % 10 = 7 THEN concat('gone_', CAST(k AS STRING))
                ELSE concat('t_', CAST(k + 100 * (event_id DIV 2000) AS STRING)) END AS tbl""",
        """CASE WHEN k >= 5 AND event_type = 'click'
                THEN concat('t_', CAST(5 + (k + event_id) % 95 + 100 * (event_id DIV 2000) AS STRING)) END AS new_name""",
        """CASE WHEN k >= 5 AND event_type = 'purchase'
                THEN CASE WHEN event_id % 2 = 0 THEN 'dataSchema' ELSE 'stats' END END AS change_kind""",
    )


def catalog_column(t: Tables) -> DataFrame:
    """Current table definitions: one row per column.  The number of tables grows with ``part``, and a table has at
    most a few columns.  The ``gone_`` tables of the events have none on purpose."""
    base = t.part.selectExpr("p_partkey % 100 + 100 * (p_partkey DIV 400) AS grp", "p_partkey", "p_type", "p_size", "p_name")
    pos = F.row_number().over(Window.partitionBy("grp").orderBy("p_partkey"))
    return base.withColumn("pos", pos).selectExpr(
        "CASE WHEN grp % 5 = 4 THEN 'lake' ELSE concat('db', CAST(grp % 5 AS STRING)) END AS db",
        "concat('t_', CAST(grp AS STRING)) AS tbl",
        "pos",
        "concat('Col_', CAST(p_partkey AS STRING)) AS name",
        "lower(p_type) AS data_type",
        "CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END AS comment",
    )


def catalog_column_history(t: Tables) -> DataFrame:
    """Versions of the table definitions: each table gets three, some days apart.  A version leaves out a third of the
    columns, another third each time; the last version of every fourth table has none, as the table is gone."""
    base = catalog_column(t).selectExpr("*", "CAST(substr(tbl, 3) AS BIGINT) AS grp").withColumn("v", F.explode(F.array(*map(F.lit, range(3)))))
    rows = base.selectExpr(
        "db", "tbl", "grp", "v", "TIMESTAMP_NTZ '2024-01-01 12:00:00' + make_dt_interval(CAST(v * (1 + grp % 9) AS INT)) AS valid_from",
        "pos", "name", "concat(data_type, '_', v) AS data_type", "comment")
    gone = rows.selectExpr("db", "tbl", "grp", "v", "valid_from").where("v = 2 AND grp % 4 = 0").distinct().selectExpr(
        "db", "tbl", "valid_from", "CAST(NULL AS INT) AS pos", "CAST(NULL AS STRING) AS name", "CAST(NULL AS STRING) AS data_type",
        "CAST(NULL AS STRING) AS comment")
    # the first column is in every version, so that none comes to nothing
    held = rows.where("NOT (v = 2 AND grp % 4 = 0) AND (pos = 1 OR (pos + v) % 3 <> 0)").drop("grp", "v")
    return held.unionByName(gone)


def database(t: Tables) -> DataFrame:
    """Database definitions; the events' ``lake`` has none on purpose."""
    return t.nation.selectExpr(
        "concat('db', CAST(n_nationkey AS STRING)) AS name", "n_name AS description",
        "concat('/wh/', lower(n_name)) AS location_uri")


def sql_text(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'view'").selectExpr(
        "user_id AS session_id", "ts", "concat('sql_', CAST(event_id AS STRING)) AS sql_text")


def exec_event(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'purchase'").selectExpr("event_id", "user_id AS session_id", "ts")


def ddl_event(t: Tables) -> DataFrame:
    """DDL command log derived from the catalog log (table events only)."""
    c = catalog_event(t).where("kind IN ('CreateTableEvent', 'DropTableEvent', 'RenameTableEvent', 'AlterTableEvent')")
    return c.selectExpr(
        "event_id", "ts",
        """CASE kind WHEN 'CreateTableEvent' THEN CASE WHEN event_id % 5 = 0 THEN 'CreateViewCommand'
                                                   WHEN event_id % 2 = 0 THEN 'CreateTableCommand'
                                                   ELSE 'CreateTableLikeCommand' END
                     WHEN 'DropTableEvent' THEN 'DropTableCommand'
                     WHEN 'RenameTableEvent' THEN 'AlterTableRenameCommand'
                     ELSE 'AlterTableSetPropertiesCommand' END AS command""",
        "db", "tbl", "new_name",
        "CASE WHEN kind = 'DropTableEvent' THEN event_id % 3 = 0 END AS is_view",
        """CASE WHEN kind = 'CreateTableEvent' AND event_id % 2 = 1
                THEN concat('t_', CAST(event_id % 90 + 10 AS STRING)) END AS source_tbl""",
    )


def plan_branch(t: Tables) -> DataFrame:
    """What an execution ran, one branch per line item, as a pre-order array of (class, number of children): commands,
    writes with or without a projection, a union of two writes, or a read."""
    node = lambda cls, n: f"named_struct('class', '{cls}', 'num-children', {n})"
    scan, write = node("FileSourceScanExec", 0), node("DataWritingCommandExec", 1)
    # the branches are numbered first: in one select with the numbers, Spark makes the nodes before the rows are moved
    numbered = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").withColumn(
        "branch", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")))
    return numbered.selectExpr(
        "l_orderkey AS event_id", "branch",
        f"""CASE WHEN l_partkey % 7 = 0 THEN array({node("ExecutedCommandExec", 0)})
                 WHEN l_partkey % 7 <= 3 AND l_returnflag = 'N' THEN array({write}, {node("ProjectExec", 1)}, {scan})
                 WHEN l_partkey % 7 <= 3 THEN array({write}, {scan})
                 WHEN l_partkey % 7 = 4 THEN array({node("WriteToDataSourceV2Exec", 1)}, {scan})
                 WHEN l_partkey % 7 = 5 THEN array({node("UnionExec", 2)}, {write}, {scan}, {write}, {scan})
                 ELSE array({node("ProjectExec", 1)}, {node("FilterExec", 1)}, {scan}) END AS nodes""")


ALL = {
    "write_event": write_event,
    "scan_relation": scan_relation,
    "scan_column": scan_column,
    "output_leaf": output_leaf,
    "output_expr": output_expr,
    "catalog_event": catalog_event,
    "catalog_column": catalog_column,
    "catalog_column_history": catalog_column_history,
    "database": database,
    "sql_text": sql_text,
    "exec_event": exec_event,
    "ddl_event": ddl_event,
    "plan_branch": plan_branch,
}
