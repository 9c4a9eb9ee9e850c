"""Routing of write events (P1, X-H), execution-event
source filter (S1) and the quarantine split (T4, Q1-Q3).

Routing is data, not code: ``route_rules`` is a small table (one row per
write command) that events join to, so a new command needs one
``register_route`` call and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import names as N

RULE_SCHEMA = T.StructType([
    T.StructField("command", T.StringType(), False),
    T.StructField("route", T.StringType(), False),
    T.StructField("op_type", T.StringType(), True),
    T.StructField("fallback_sql", T.StringType(), True),
    T.StructField("id_rule", T.StringType(), True),       # TARGET | QUERY
    T.StructField("db_rule", T.StringType(), True),       # DEFAULT | CURRENT
    T.StructField("empty_inputs", T.StringType(), True),  # EMIT | QUARANTINE
])

# Rule rows (fixed behaviour of the three harvesters plus the reported-only FS insert).
DEFAULT_RULES = [
    (K.CMD_HIVE_CTAS, K.ROUTE_LINEAGE, K.OP_CTAS, K.FALLBACK_SQL_CTAS, "TARGET", "DEFAULT", "EMIT"),
    (K.CMD_HIVE_INSERT, K.ROUTE_LINEAGE, K.OP_QUERY, K.FALLBACK_SQL_INSERT, "QUERY", "DEFAULT", "QUARANTINE"),
    (K.CMD_DATASOURCE_CTAS, K.ROUTE_LINEAGE, K.OP_QUERY, K.FALLBACK_SQL_INSERT, "QUERY", "CURRENT", "QUARANTINE"),
    (K.CMD_HADOOP_FS_INSERT, K.ROUTE_FS_WRITE, None, None, None, None, None),
]



@dataclass(frozen=True)
class Policy:
    """Behaviour where the original hook throws and loses the event.

    ``sql="fallback"``: null and "" SQL text both take the command's fallback text;
    ``sql="strict"``: null text quarantines the event (NO_SQL_TEXT).
    ``literal="skip"``: literal leaves are ignored; ``"strict"``: quarantine (LITERAL_LEAF).
    """
    sql: str = "fallback"
    literal: str = "skip"


DEFAULT_POLICY = Policy()
STRICT_POLICY = Policy(sql="strict", literal="strict")


def _literal_rows(spark: SparkSession, rows) -> DataFrame:
    """Rows as a JVM-side literal relation (no Python workers at run time)."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, RULE_SCHEMA.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def route_rules(spark: SparkSession, rows=None) -> DataFrame:
    rows = list(DEFAULT_RULES if rows is None else rows)
    commands = [r[0] for r in rows]
    if len(set(commands)) < len(commands):
        raise ValueError(f"more than one rule for a command: {sorted(c for c in set(commands) if commands.count(c) > 1)}")
    return _literal_rows(spark, rows)


def register_route(rules: DataFrame, command: str, route: str = K.ROUTE_LINEAGE,
                   op_type: str | None = K.OP_QUERY, fallback_sql: str | None = K.FALLBACK_SQL_INSERT,
                   id_rule: str | None = "QUERY", db_rule: str | None = "DEFAULT",
                   empty_inputs: str | None = "QUARANTINE") -> DataFrame:
    """X-H: add (or replace) the rule of one command."""
    row = _literal_rows(rules.sparkSession, [(command, route, op_type, fallback_sql, id_rule, db_rule, empty_inputs)])
    return rules.where(F.col("command") != command).unionByName(row)


def successful(events: DataFrame) -> DataFrame:
    """Only successful executions are harvested; failures are dropped."""
    return events.where(F.col("status") == "SUCCESS")


def read_write_events(spark: SparkSession, path: str, schema=None, streaming: bool = False) -> DataFrame:
    """S1 over a parquet event log (batch or stream)."""
    if streaming:
        reader = spark.readStream.schema(schema) if schema is not None else spark.readStream
        return successful(reader.parquet(path))
    df = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    return successful(df)


def route_writes(events: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Attach the rule of each event's command; unknown commands route UNSUPPORTED.

    One rule per command: of several in a table handed in, the least by its
    columns holds, so an event is never multiplied.  How the join is done is
    left to Spark, which knows the size of the table.
    """
    if rules is None:
        rules = route_rules(events.sparkSession)
    names = [f.name for f in RULE_SCHEMA.fields if f.name != "command"]
    one = rules.groupBy("command").agg(F.min(F.struct(*names)).alias("r")).select("command", "r.*")
    routed = events.join(one, "command", "left")
    return routed.withColumn("route", F.coalesce(F.col("route"), F.lit(K.ROUTE_UNSUPPORTED)))


def resolve_target(routed: DataFrame, ns: str = K.NAMESPACE) -> DataFrame:
    """N1 + N2: target database (missing -> "default", or the session's current
    database for rules with db_rule CURRENT) and target table qualified name."""
    dbc = F.coalesce(F.col("target_db"),
                     F.when(F.col("db_rule") == "CURRENT", F.col("current_db")).otherwise(F.lit(K.DEFAULT_DB)))
    return (routed.withColumn("database", dbc)
            .withColumn("target_qn", F.concat(F.col("database"), F.lit("."), F.col("target_table"),
                                              F.lit("@" + ns))))


def quarantine_reason(policy: Policy, has_literal) -> "F.Column":
    """Q1-Q3, T4: why an event with its rule, ``n_inputs`` and ``root_kind`` cannot be harvested; null where it can.
    ``has_literal`` tells whether a derived output holds a leaf without a name."""
    reason = F.when(F.lit(policy.sql == "strict") & F.col("sql_text").isNull(), F.lit(K.REASON_NO_SQL_TEXT))
    reason = (reason.when(F.col("route") == K.ROUTE_FS_WRITE, F.lit(K.REASON_FS_WRITE))
              .when(F.col("route") == K.ROUTE_UNSUPPORTED, F.lit(K.REASON_UNSUPPORTED))
              .when(F.col("root_kind") == K.ROOT_BAD, F.lit(K.REASON_BAD_PLAN))
              .when((F.col("empty_inputs") == "QUARANTINE") & (F.col("n_inputs") == 0), F.lit(K.REASON_NO_INPUT_TABLE)))
    if policy.literal == "strict":
        reason = reason.when((F.col("root_kind") == K.ROOT_PROJECT) & has_literal, F.lit(K.REASON_LITERAL_LEAF))
    return reason


def process_identity(events: DataFrame) -> DataFrame:
    """L2 + F7: ``process_qn`` from the rule's id rule, the inputs and the target, and ``query_text`` with its fallback."""
    query_id = F.concat(F.lit(K.PROCESS_ID_PREFIX), F.array_join("inputs", K.PROCESS_ID_SEP), F.lit(K.PROCESS_ID_INFIX), F.col("target_qn"))
    return (events.withColumn("process_qn", F.when(F.col("id_rule") == "TARGET", F.col("target_qn")).otherwise(query_id))
            .withColumn("query_text", N.empty_to_default("sql_text", F.col("fallback_sql"))))
