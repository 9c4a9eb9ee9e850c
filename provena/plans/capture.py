"""Live capture of one write on the current session (optional).

For a DataFrame about to be written, record the optimized logical plan of
its query (Catalyst's JSON), the rendered child text of each root output and
the write command.  This touches one plan on the driver, the same place
Spark keeps it anyway; everything after capture (shredding, lineage) runs on
the cluster over the captured log.

Capture the *optimized* plan: nested derived tables are already collapsed
into one Project over the scans, which is what lineage resolution needs.
Classic (py4j) sessions only.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

PLAN_LOG_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("session_id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("command", T.StringType()),
    T.StructField("target_db", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("current_db", T.StringType()),
    T.StructField("sql_text", T.StringType()),
    T.StructField("plan_json", T.StringType()),
    T.StructField("expr_texts", T.ArrayType(T.StringType())),
])


def _seq(s):
    return [s.apply(i) for i in range(s.size())]


def capture(df: DataFrame, event_id: int, command: str, target_table: str, target_db: str | None = None,
            sql_text: str | None = None, session_id: int = 0, status: str = "SUCCESS",
            ts: _dt.datetime | None = None) -> Row:
    """One plan-log row for writing ``df`` with ``command`` into ``target_db.target_table``."""
    plan = df._jdf.queryExecution().optimizedPlan()
    texts: list[str] = []
    if plan.nodeName() == "Project":
        for e in _seq(plan.projectList()):
            texts.append(",".join(c.toString() for c in _seq(e.children())))
    spark = df.sparkSession
    return Row(event_id=int(event_id), ts=ts or _dt.datetime(2024, 1, 1), session_id=int(session_id),
               status=status, command=command, target_db=target_db, target_table=target_table,
               current_db=spark.catalog.currentDatabase(), sql_text=sql_text,
               plan_json=plan.toJSON(), expr_texts=texts)


def plan_log(spark: SparkSession, rows: list[Row]) -> DataFrame:
    return spark.createDataFrame(rows, PLAN_LOG_SCHEMA)
