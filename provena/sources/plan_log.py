"""A plan log in Catalyst's optimized-plan JSON format, derived from the
fixture event tables.

Production input is a log of captured plans (``plans.capture``).  To run the
shredder over data that grows with the scale factor, this module writes the
fixture events back out as plan JSON, one pre-order node array per event:

* PROJECT root:  Project -> Union(n) -> relations
* RELATION root: the relation alone
* OTHER root:    Aggregate -> Union(n) -> relations

Relations are ``LogicalRelation`` nodes with a ``catalogTable`` (catalog
tables) or ``LogicalRDD`` nodes without one.  A pass-through output is a bare
``AttributeReference``; a derived output is an ``Alias`` over a call of ``coalesce``
or a chain of additions of its leaves, as its text in the event tables has parentheses
or not.  Every list is built per event with ordered ``collect_list`` and serialised with
``to_json``: all on the executors.

``physical_log`` writes the executions' physical plans in the same way: a union over
the branches that an execution ran, or its only branch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.names import let
from ..operators.lineage import join_in_event
from ..plans import shred as S
from . import fixtures as fx

RDD = "org.apache.spark.sql.execution.LogicalRDD"
UNION = "org.apache.spark.sql.catalyst.plans.logical.Union"
AGGREGATE = "org.apache.spark.sql.catalyst.plans.logical.Aggregate"
COALESCE = "org.apache.spark.sql.catalyst.expressions.Coalesce"
ADD = "org.apache.spark.sql.catalyst.expressions.Add"
LITERAL = "org.apache.spark.sql.catalyst.expressions.Literal"
PHYSICAL_UNION = "org.apache.spark.sql.execution.UnionExec"


def _expr_node(cls, n_children, name=None, expr_id=None, value=None, kind=None):
    text = lambda x: (x if x is not None else F.lit(None)).cast("string")
    return F.struct(F.lit(cls).alias("class") if isinstance(cls, str) else cls.alias("class"),
                    F.lit(n_children).alias("num-children") if isinstance(n_children, int)
                    else n_children.alias("num-children"),
                    text(name).alias("name"),
                    F.when(expr_id.isNotNull(), F.struct(expr_id.alias("id"))).alias("exprId")
                    if expr_id is not None else F.lit(None).cast("struct<id:bigint>").alias("exprId"),
                    text(value).alias("value"), text(kind).alias("dataType"))


def relation_nodes(relations: DataFrame, columns: DataFrame) -> DataFrame:
    """One JSON relation node per (event_id, rel_pos)."""
    cols = (columns.groupBy("event_id", "rel_pos")
            .agg(F.sort_array(F.collect_list(F.struct("attr_id", "col", "is_partition_col"))).alias("c")))
    j = join_in_event(relations, cols, ["rel_pos"], "left")
    c = F.coalesce(F.col("c"), F.array().cast("array<struct<attr_id:bigint,col:string,is_partition_col:boolean>>"))
    output = F.transform(c, lambda a: F.array(_expr_node(S.ATTRIBUTE, 0, a["col"], a["attr_id"])))
    pcols = F.transform(F.filter(c, lambda a: a["is_partition_col"]), lambda a: a["col"])
    catalog = F.when(F.col("is_catalog"), F.struct(
        F.struct(F.col("tbl").alias("table"), F.col("db").alias("database")).alias("identifier"),
        pcols.alias("partitionColumnNames")))
    node = F.struct(F.when(F.col("is_catalog"), F.lit(S.LOGICAL_RELATION)).otherwise(F.lit(RDD)).alias("class"),
                    F.lit(0).alias("num-children"), output.alias("output"), catalog.alias("catalogTable"))
    return j.select("event_id", "rel_pos", F.to_json(node).alias("json"))


def project_items(outputs: DataFrame, leaves: DataFrame) -> DataFrame:
    """Per event: project list JSON items in output order, and the child texts."""
    lv = (leaves.groupBy("event_id", "out_pos")
          .agg(F.sort_array(F.collect_list(F.struct("leaf_pos", "attr_id"))).alias("l")))
    j = join_in_event(outputs, lv, ["out_pos"], "left")
    leaf_nodes = F.transform(
        F.coalesce(F.col("l"), F.array().cast("array<struct<leaf_pos:int,attr_id:bigint>>")),
        lambda x: _expr_node(F.when(x["attr_id"].isNotNull(), F.lit(S.ATTRIBUTE)).otherwise(F.lit(LITERAL)), 0,
                             F.when(x["attr_id"].isNotNull(), F.concat(F.lit("Col_"), F.floor(x["attr_id"] / 1000))),
                             x["attr_id"], F.when(x["attr_id"].isNull(), x["leaf_pos"]),
                             F.when(x["attr_id"].isNotNull(), F.lit("long")).otherwise(F.lit("integer"))))
    alias = F.array(_expr_node(S.ALIAS, 1, F.col("out_name"), F.col("out_attr_id")))
    # pre-order of (((a + b) + c) + d): as many additions as leaves but one, then the leaves
    added = F.array_repeat(_expr_node(ADD, 2), F.size(leaf_nodes) - 1)
    called = F.array(_expr_node(COALESCE, F.size(leaf_nodes)))
    derived = F.concat(alias, F.when(F.contains("expr_text", F.lit("(")), called).otherwise(added), leaf_nodes)
    bare = F.array(_expr_node(S.ATTRIBUTE, 0, F.col("out_name"), F.col("out_attr_id")))
    item = F.when(F.col("n_children") == 0, bare).otherwise(derived)
    per_event = (j.groupBy("event_id")
                 .agg(F.sort_array(F.collect_list(F.struct("out_pos", item.alias("item"), "expr_text"))).alias("o")))
    return per_event.select("event_id",
                            F.transform("o", lambda x: x["item"]).alias("project_list"),
                            F.transform("o", lambda x: x["expr_text"]).alias("expr_texts"))


def physical_log(t) -> DataFrame:
    """(event_id, plan_json): the physical plan of every execution."""
    b = (fx.plan_branch(t).groupBy("event_id").agg(F.sort_array(F.collect_list(F.struct("branch", "nodes"))).alias("b")))
    full = lambda n: F.struct(F.concat(F.lit("org.apache.spark.sql.execution."), n["class"]).alias("class"), n["num-children"].alias("num-children"))
    nodes = F.transform(F.flatten(F.transform("b", lambda x: x["nodes"])), full)
    union = F.array(F.struct(F.lit(PHYSICAL_UNION).alias("class"), F.size("b").alias("num-children")))
    return b.select("event_id", F.to_json(F.when(F.size("b") > 1, F.concat(union, nodes)).otherwise(nodes)).alias("plan_json"))


def _text(*parts) -> "F.Column":
    """Parts (literal strings, or texts) as one text.  Inside a lambda nothing is compiled, and there ``concat`` takes many
    times as long as joining an array."""
    flat: list = []
    for x in parts:
        if isinstance(x, str) and flat and isinstance(flat[-1], str):
            flat[-1] += x
        else:
            flat.append(x)
    return F.array_join(F.array(*(F.lit(x) if isinstance(x, str) else x for x in flat)), "")


def _if_known(value, *parts) -> "F.Column":
    """A field whose value may be null: then it is left out."""
    return F.when(value.isNotNull(), _text(*parts))


def _id(expr_id) -> list:
    return [',"exprId":{"id":', expr_id.cast("string"), "}"]


def _listed(texts) -> "F.Column":
    return _text("[", F.array_join(texts, ","), "]")


def _attr(x) -> "F.Column":
    return x["pk"] * 1000 + x["sk"]


def _relation_json(items, sk) -> "F.Column":
    """``fx.scan_relation`` and ``fx.scan_column`` of one relation of an event, as its node."""
    column = lambda x: F.transform(x["parts"], lambda p: F.struct(
        _attr(x).alias("attr_id"), x["pk"].alias("pk"), p["is_partition_col"].alias("part"), x["column"].alias("column")))
    cols = F.sort_array(F.array_distinct(F.flatten(F.transform(F.filter(items, lambda x: (x["sk"] == sk) & x["parts"].isNotNull()), column))))

    def node(c):
        output = _listed(F.transform(c, lambda a: a["column"]))
        parts = _listed(F.transform(F.filter(c, lambda a: a["part"]), lambda a: _text('"Col_', a["pk"].cast("string"), '"')))
        database = F.when(sk % 9 != 0, _text(',"database":"src', (sk % 4).cast("string"), '"'))
        return F.when(sk % 8 != 0, _text(
            f'{{"class":"{S.LOGICAL_RELATION}","num-children":0,"output":', output, ',"catalogTable":{"identifier":{"table":"S_', (sk % 40).cast("string"), '"',
            database, '},"partitionColumnNames":', parts, "}}")).otherwise(_text(f'{{"class":"{RDD}","num-children":0,"output":', output, "}"))

    return let(cols, node)


def _output_json(items, ln) -> "F.Column":
    """``fx.output_expr`` and ``fx.output_leaf`` of one output of an event: its expression and its text."""
    literal = lambda i: _text(f'{{"class":"{LITERAL}","num-children":0,"value":"', (i + 1).cast("string"), '","dataType":"integer"}')

    def out(own):
        flag, number = F.array_min(F.transform(own, lambda x: x["flag"])), ln.cast("string")
        single = (F.size(own) == 1) & (flag == "N")
        text = F.when(single, None).when(ln.isNotNull(), F.when(flag == "A", _text("f(", number, ")")).otherwise(_text("x", number)))
        # an output without a number has no name, and no leaf belongs to it
        name = lambda expr_id: [_if_known(ln, ',"name":"Out_', number, '"'), _if_known(expr_id, *_id(expr_id))]
        leaves = F.transform(F.sort_array(F.transform(F.filter(own, lambda x: x["ln"].isNotNull()), lambda x: F.struct(
            x["pk"].alias("pk"), x["sk"].alias("sk"), x["leaf"].alias("leaf")))), lambda x, i: F.coalesce(x["leaf"], literal(i)))
        call = F.when((flag == "A") & ln.isNotNull(), F.array(_text(f'{{"class":"{COALESCE}","num-children":', F.size(own).cast("string"), "}"))).otherwise(
            F.array_repeat(F.lit(f'{{"class":"{ADD}","num-children":2}}'), F.when(ln.isNotNull(), F.size(own)).otherwise(0) - 1))
        alias = _text(f'{{"class":"{S.ALIAS}","num-children":1', *name(-ln), "}")
        bare = let(F.array_min(F.transform(own, _attr)), lambda a: _text(f'{{"class":"{S.ATTRIBUTE}","num-children":0', *name(a), "}"))
        derived = F.flatten(F.array(F.array(alias), call, leaves))
        return F.struct(_listed(F.when(single, F.array(bare)).otherwise(derived)).alias("item"), text.alias("text"))

    return let(F.filter(items, lambda x: x["ln"].eqNullSafe(ln)), out)


def plan_log(t) -> DataFrame:
    """Write events + plan JSON + child texts, schema of ``plans.capture.PLAN_LOG_SCHEMA``: the rows of ``plan_log_from`` over
    the fixture tables.

    The line items of an event are put together once, before a plan is made of them, and its nodes are written in their row;
    no JSON is moved.  The log has a part for each shuffle partition."""
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    part = (t.part.selectExpr("p_partkey AS pk", "struct(p_type = 'PROMO' AS is_partition_col) AS p")
            .groupBy("pk").agg(F.collect_set("p").alias("parts")))
    items = (t.lineitem.selectExpr("l_orderkey", "l_linenumber AS ln", "l_partkey AS pk", "l_suppkey AS sk", "l_returnflag AS flag")
             .where("l_orderkey IS NOT NULL").join(part, "pk", "left").repartition(n, "l_orderkey"))
    # the nodes of a column and of a leaf follow from the line item alone; they are made here, where code is compiled
    attr = F.expr("pk * 1000 + sk")
    node = lambda name, *rest: F.concat(F.lit(f'{{"class":"{S.ATTRIBUTE}","num-children":0,"name":"Col_'), name.cast("string"),
                                        F.lit('","exprId":{"id":'), attr.cast("string"), *map(F.lit, rest))
    items = items.withColumn("column", F.concat(F.lit("["), node(F.col("pk"), "}}]"))).withColumn(
        "leaf", F.when(F.coalesce(F.col("sk") % 20 != 3, F.lit(True)), node(F.floor(attr / 1000), '},"dataType":"long"}')))
    per = items.groupBy("l_orderkey").agg(F.collect_list(F.struct("ln", "pk", "sk", "flag", "parts", "column", "leaf")).alias("it"))
    j = fx.write_event(t).repartition(n, "event_id").join(per.withColumnRenamed("l_orderkey", "_event_id"), F.col("event_id") == F.col("_event_id"), "left")
    it, rk = F.col("it"), F.col("root_kind")
    numbers = lambda c: F.sort_array(F.array_distinct(F.transform(it, lambda x: x[c])))
    rels = F.coalesce(numbers("sk"), F.array().cast("array<bigint>"))
    rels = F.when(rk == K.ROOT_RELATION, F.slice(rels, 1, 1)).otherwise(rels)
    j = j.withColumn("_rels", F.transform(rels, lambda sk: _relation_json(it, sk))).withColumn(
        "_outs", F.when(rk == K.ROOT_PROJECT, F.transform(numbers("ln"), lambda ln: _output_json(it, ln))))
    items_json = _listed(F.coalesce(F.transform("_outs", lambda o: o["item"]), F.array().cast("array<string>")))
    union = _text(f'{{"class":"{UNION}","num-children":', F.size("_rels").cast("string"), "}")
    project = _text(f'{{"class":"{S.PROJECT}","num-children":1,"projectList":', items_json, ',"child":0}')
    aggregate = F.lit(f'{{"class":"{AGGREGATE}","num-children":1}}')
    nodes = (F.when(rk == K.ROOT_RELATION, F.col("_rels"))
             .when(rk == K.ROOT_PROJECT, F.concat(F.array(project, union), "_rels"))
             .otherwise(F.concat(F.array(aggregate, union), "_rels")))
    return j.select("event_id", "ts", "session_id", "status", "command", "target_db", "target_table", "current_db", "sql_text",
                    _listed(nodes).alias("plan_json"), F.transform("_outs", lambda o: o["text"]).alias("expr_texts"))


def plan_log_from(ev: DataFrame, rel: DataFrame, columns: DataFrame, outputs: DataFrame,
                  leaves: DataFrame) -> DataFrame:
    """The plan log of given event tables (e.g. ones already stored), without re-deriving them."""
    rels = (relation_nodes(rel, columns).groupBy("event_id")
            .agg(F.sort_array(F.collect_list(F.struct("rel_pos", "json"))).alias("r")))
    items = project_items(outputs, leaves)
    j = ev.join(rels, "event_id", "left").join(items, "event_id", "left")
    rel_json = F.transform(F.coalesce("r", F.array().cast("array<struct<rel_pos:bigint,json:string>>")),
                           lambda x: x["json"])
    n_rel = F.size(rel_json)
    union = F.to_json(F.struct(F.lit(UNION).alias("class"), n_rel.alias("num-children")))
    project = F.to_json(F.struct(F.lit(S.PROJECT).alias("class"), F.lit(1).alias("num-children"),
                                 F.coalesce("project_list", F.array()).alias("projectList"),
                                 F.lit(0).alias("child")))
    aggregate = F.to_json(F.struct(F.lit(AGGREGATE).alias("class"), F.lit(1).alias("num-children")))
    rk = F.col("root_kind")
    nodes = (F.when(rk == K.ROOT_RELATION, F.slice(rel_json, 1, 1))
             .when(rk == K.ROOT_PROJECT, F.concat(F.array(project, union), rel_json))
             .otherwise(F.concat(F.array(aggregate, union), rel_json)))
    plan_json = F.concat(F.lit("["), F.array_join(nodes, ","), F.lit("]"))
    return j.select("event_id", "ts", "session_id", "status", "command", "target_db", "target_table",
                    "current_db", "sql_text", plan_json.alias("plan_json"),
                    F.when(rk == K.ROOT_PROJECT, F.col("expr_texts")).alias("expr_texts"))
