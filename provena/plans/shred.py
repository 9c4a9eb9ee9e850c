"""Plan shredding (S3-S5): a log of optimized logical plans, one JSON array
of nodes per execution (Catalyst's ``toJSON`` format, pre-order), becomes
the normalised event tables.

All of it runs as Spark SQL over the ``plan_json`` column, in one pass per
plan: one ``from_json`` reads the node array straight into typed structs
holding only the fields lineage needs, and higher-order functions over that
array (``transform`` with the node index, ``filter``, ``flatten``) build the
rows of all five event tables at once.  One ``inline`` emits them, tagged
with the table they belong to, so the staged copy is written in one job
(partitioned by table) and every later read is a flat, pruned column scan.
No plan is ever parsed on the driver, and none is parsed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K

LOGICAL_RELATION = "org.apache.spark.sql.execution.datasources.LogicalRelation"
HIVE_RELATION = "org.apache.spark.sql.catalyst.catalog.HiveTableRelation"
PROJECT = "org.apache.spark.sql.catalyst.plans.logical.Project"
ALIAS = "org.apache.spark.sql.catalyst.expressions.Alias"
ATTRIBUTE = "org.apache.spark.sql.catalyst.expressions.AttributeReference"
# the leaf expressions with a name; a scalar subquery has an id too, but no name
NAMED_LEAVES = (ATTRIBUTE, "org.apache.spark.sql.catalyst.expressions.NamedLambdaVariable",
                "org.apache.spark.sql.catalyst.analysis.UnresolvedAttribute")

_EXPR = "struct<class:string,`num-children`:int,name:string,exprId:struct<id:bigint>>"
_META = "struct<identifier:struct<table:string,database:string>,partitionColumnNames:array<string>>"
# The few node fields lineage needs; every other field of Catalyst's JSON is ignored by the parser.
NODE_SCHEMA = (f"struct<class:string,`num-children`:int,catalogTable:{_META},tableMeta:{_META},"
               f"output:array<array<{_EXPR}>>,dataCols:array<array<{_EXPR}>>,"
               f"partitionCols:array<array<{_EXPR}>>,projectList:array<array<{_EXPR}>>>")


_ROW_FIELDS = (  # one row type for the rows of all five tables
    ("_t", "string"),            # event | rel | col | out | leaf
    ("event_id", "bigint"),
    ("pos", "bigint"),           # rel_pos (rel, col) or out_pos (out, leaf)
    ("leaf_pos", "int"),
    ("attr_id", "bigint"),       # col / leaf attribute id, out: the output's own id
    ("name", "string"),          # col name, out name
    ("flag", "boolean"),         # rel: is_catalog, col: is_partition_col, leaf: is_named
    ("db", "string"),
    ("tbl", "string"),
    ("n_children", "int"),
    ("expr_text", "string"),
    ("root_kind", "string"),
)
_EVENT_PREFIX = "e_"
_SKIP = ("plan_json", "expr_texts")


def _row(event_cols, log_schema, **vals):
    fields = [(vals[n] if n in vals else F.lit(None)).cast(t).alias(n) for n, t in _ROW_FIELDS]
    for c in event_cols:
        v = vals.get(_EVENT_PREFIX + c, F.lit(None))
        fields.append(v.cast(log_schema[c].dataType).alias(_EVENT_PREFIX + c))
    return F.struct(*fields)


def _is_relation(cls):
    return cls.isin(LOGICAL_RELATION, HIVE_RELATION) | cls.endswith("Relation") | cls.endswith("LogicalRDD")


def _meta(n):
    return F.coalesce(n["catalogTable"], n["tableMeta"])


def _attrs(n):
    """LogicalRelation: output; HiveTableRelation: dataCols ++ partitionCols."""
    return F.coalesce(F.when(n["dataCols"].isNotNull(), F.concat(n["dataCols"], F.coalesce(n["partitionCols"], F.array()))),
                      n["output"], F.array())


def root_kind_of(root):
    """PROJECT when the query root is a Project, RELATION when it is a
    catalog relation, OTHER otherwise (also for an empty or missing plan)."""
    cls = root["class"]
    return (F.when(cls == PROJECT, F.lit(K.ROOT_PROJECT))
            .when(_is_relation(cls) & _meta(root)["identifier"].isNotNull(), F.lit(K.ROOT_RELATION))
            .otherwise(F.lit(K.ROOT_OTHER)))


def shred_plans(log: DataFrame, plan_col: str = "plan_json") -> DataFrame:
    """S3-S5 in one pass: every plan is parsed once and yields, per event,

    * ``event``: the event's own columns (prefixed ``e_``) and its ``root_kind``;
    * ``rel``: every leaf relation with its pre-order position, catalog name
      and whether it is a catalog table (S4, Q6);
    * ``col``: data and partition columns of each relation with attr ids;
    * ``out``: the root project list, per output its name, id, child count
      and rendered child text (``expr_texts``) (S5);
    * ``leaf``: the leaves of every output in order (the output itself when
      it is a bare attribute); a leaf without an id is a literal.

    A relation is a catalog table when it carries a catalog identifier
    (``LogicalRelation.catalogTable`` or ``HiveTableRelation.tableMeta``);
    temp views over local rows, RDDs and path scans are not.
    """
    schema = log.schema
    ev_cols = [c for c in log.columns if c not in _SKIP]
    has_texts = "expr_texts" in log.columns
    row = lambda **kw: _row(ev_cols, schema, event_id=F.col("event_id"), **kw)
    parsed = log.select(*[F.col(c) for c in log.columns if c != plan_col],
                        F.from_json(plan_col, f"array<{NODE_SCHEMA}>").alias("_n"), F.col(plan_col).alias("_text"))
    first = F.get(F.col("_n"), 0)["class"]
    parsed = parsed.withColumn("_unread", F.col("_text").isNotNull() & (F.trim("_text") != "")
                               & (F.col("_n").isNull() | ((F.size("_n") > 0) & first.isNull())))
    nodes = F.coalesce(F.col("_n"), F.array())
    empty = F.array_repeat(row(_t=F.lit("none")), 0)
    # S3: every node with its pre-order index
    indexed = F.transform(nodes, lambda n, i: F.struct(i.cast("bigint").alias("i"), n.alias("n")))
    rels = F.filter(indexed, lambda x: _is_relation(x["n"]["class"]))
    rel_rows = F.transform(rels, lambda x: row(
        _t=F.lit("rel"), pos=x["i"], db=_meta(x["n"])["identifier"]["database"],
        tbl=_meta(x["n"])["identifier"]["table"], flag=_meta(x["n"])["identifier"].isNotNull()))
    col_rows = F.flatten(F.transform(rels, lambda x: F.transform(_attrs(x["n"]), lambda a: row(
        _t=F.lit("col"), pos=x["i"], attr_id=a[0]["exprId"]["id"], name=a[0]["name"],
        flag=F.array_contains(F.coalesce(_meta(x["n"])["partitionColumnNames"], F.array().cast("array<string>")),
                              a[0]["name"])))))
    root = F.get(nodes, 0)
    items = F.when(root["class"] == PROJECT, F.coalesce(root["projectList"], F.array())).otherwise(F.array())
    texts = F.col("expr_texts") if has_texts else F.lit(None).cast("array<string>")
    out_rows = F.transform(items, lambda e, i: row(
        _t=F.lit("out"), pos=i, name=e[0]["name"], attr_id=e[0]["exprId"]["id"],
        n_children=F.when(e[0]["class"] == ATTRIBUTE, F.lit(0)).otherwise(F.coalesce(e[0]["num-children"], F.lit(0))),
        expr_text=F.get(texts, i)))
    leaf_rows = F.flatten(F.transform(items, lambda e, i: F.transform(
        F.filter(e, lambda x: x["num-children"] == 0), lambda leaf, j: row(
            _t=F.lit("leaf"), pos=i, leaf_pos=j + 1, attr_id=leaf["exprId"]["id"], flag=leaf["class"].isin(*NAMED_LEAVES)))))
    # a text that is there and cannot be read is an error of its own, not an empty plan
    kind = F.when(F.col("_unread"), F.lit(K.ROOT_BAD)).otherwise(root_kind_of(root))
    event_row = F.array(row(_t=F.lit("event"), root_kind=kind,
                            **{_EVENT_PREFIX + c: F.col(c) for c in ev_cols}))
    parts = [event_row] + [F.coalesce(p, empty) for p in (rel_rows, col_rows, out_rows, leaf_rows)]
    return parsed.select(F.inline(F.concat(*parts)))


def event_tables_from_plans(log: DataFrame, stage_path: str | None = None):
    """Plan log (see ``plans.capture.PLAN_LOG_SCHEMA``) -> ``EventTables``.

    With ``stage_path`` (a folder under the shared ``spark.checkpoint.dir``)
    the plans are parsed exactly once: the shredded rows of all five tables
    are written there in one job, partitioned by table, and each table is
    read back with partition pruning.  Without it every derived table
    re-parses the JSON, which is fine for small logs.
    """
    from ..operators.lineage import EventTables
    ev_cols = [c for c in log.columns if c not in _SKIP]
    rows = shred_plans(log)
    if stage_path is not None:
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("_t").parquet(stage_path)
        rows = log.sparkSession.read.schema(rows.schema).parquet(stage_path)  # an empty batch writes no file

    def part(t):
        return rows.where(F.col("_t") == t)

    ev = part("event").select(*[F.col(_EVENT_PREFIX + c).alias(c) for c in ev_cols], "root_kind")
    rel = part("rel").select("event_id", F.col("pos").alias("rel_pos"), "db", "tbl",
                             F.col("flag").alias("is_catalog"))
    col = part("col").select("event_id", F.col("pos").alias("rel_pos"), "attr_id", F.col("name").alias("col"),
                             F.col("flag").alias("is_partition_col"))
    out = part("out").select("event_id", F.col("pos").cast("int").alias("out_pos"), F.col("name").alias("out_name"),
                             F.col("attr_id").alias("out_attr_id"), "n_children", "expr_text")
    leaves = part("leaf").select("event_id", F.col("pos").cast("int").alias("out_pos"), "leaf_pos", "attr_id",
                                 F.col("flag").alias("is_named"))
    return EventTables(ev, rel, col, out, leaves)


def output_texts(log: DataFrame, plan_col: str = "plan_json") -> DataFrame:
    """(event_id, out_pos, expression) of every output of a root projection that is more than a column's name, the
    text folded out of the plan itself."""
    from . import expr as X
    plan = F.from_json(plan_col, f"array<struct<class:string,projectList:array<array<{X.NODE}>>>>")
    root = F.get(plan, F.lit(0))
    items = F.when(root["class"] == PROJECT, root["projectList"])
    out = log.select("event_id", items.alias("items")).select("event_id", F.posexplode_outer("items").alias("out_pos", "e"))
    return (out.where(F.col("e")[0]["class"] != ATTRIBUTE)
            .select("event_id", "out_pos", X.expression_text(F.slice("e", 2, F.size("e"))).alias("expression")))
