"""L1-L6 inside the plan's row: lineage of a plan log without a shuffle.

Everything that the lineage of one execution needs stands in its own plan, so it is worked out there, by higher-order
functions over the plan's nodes:

* the catalog relations with their columns give the ordered inputs (L1) and the attribute dictionary (J2), a map from
  attribute id to source column;
* each output of the root projection looks up its own id (L3) and those of its leaves (L4) in that map, or each column of
  a bare relation maps to itself (L5);
* process identity, reason of quarantine and lineage ids follow from the row's own columns and the command's rule.

``harvest`` gives one row per execution with its column lineage as an array; products explode it, or build their messages
from it, and nothing is regrouped.  The rules of commands are a literal map in the plan; a table of rules handed in is
joined instead, in the form that Spark chooses for its size.

A map is searched from its front, so a plan of n leaves over m source columns takes n * m steps; both are bounded by one
query's plan.  ``Lineage`` over event tables resolves by joins instead, and gives the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import names as N
from ..operators.lineage import Lineage, dependency_type
from ..operators.route import DEFAULT_POLICY, DEFAULT_RULES, RULE_SCHEMA, Policy, process_identity, quarantine_reason, resolve_target, route_writes, successful
from . import expr as X
from . import shred as S

_META = S._META
#: Of a relation's columns only the id and the name are read.
_COLUMN = "struct<name:string,exprId:struct<id:bigint>>"
_NODE = (f"struct<class:string,`num-children`:int,catalogTable:{_META},tableMeta:{_META},output:array<array<{_COLUMN}>>,"
         f"dataCols:array<array<{_COLUMN}>>,partitionCols:array<array<{_COLUMN}>>,projectList:array<array<{X.NODE}>>>")


def _latest(entries: Column) -> Column:
    """Of the entries (structs that begin with ``key``) the greatest of each key, in order of the keys."""
    return N.let(F.sort_array(entries), lambda ordered: F.filter(ordered, lambda x, i: (
        F.get(ordered, i + 1).isNull() | (F.get(ordered, i + 1)["key"] != x["key"]))))


def _dictionary(entries: Column) -> Column:
    """Attribute id -> input column; an id that is registered twice means the later relation, a partition column before
    a data column, the greater name."""
    return F.map_from_entries(F.transform(_latest(F.filter(entries, lambda e: e["key"].isNotNull())), lambda e: F.struct(e["key"], e["qn"])))


def routed(events: DataFrame, rules: DataFrame | None = None, ns: str = K.NAMESPACE) -> DataFrame:
    """S1 + P1 + N1 without an exchange: the default rules are a literal map."""
    events = successful(events)
    if rules is not None:
        return resolve_target(route_writes(events, rules), ns)
    fields = [f for f in RULE_SCHEMA.fields if f.name != "command"]
    pairs = [c for r in DEFAULT_RULES for c in (F.lit(r[0]), F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, r[1:]))))]
    one = events.withColumn("_rule", F.create_map(*pairs)[F.col("command")])
    one = one.select(*events.columns, F.coalesce("_rule.route", F.lit(K.ROUTE_UNSUPPORTED)).alias("route"),
                     *(F.col(f"_rule.{f.name}").alias(f.name) for f in fields if f.name != "route"))
    return resolve_target(one, ns)


def harvest(log: DataFrame, rules: DataFrame | None = None, policy: Policy = DEFAULT_POLICY, ns: str = K.NAMESPACE,
            plan_col: str = "plan_json") -> DataFrame:
    """One row per successful execution of a plan log (``plans.capture.PLAN_LOG_SCHEMA``): its own columns but for the
    plan, ``root_kind``, ``inputs``, ``n_inputs``, the rule's columns, ``target_qn``, ``process_qn``, ``query_text``,
    ``reason`` (null: harvested), and ``columns``, its column lineage (branch, out_pos, out_name, lineage_id, output_qn,
    inputs, n_inputs, expression, dep_type), whatever the reason."""
    ev = [c for c in log.columns if c not in (plan_col, "expr_texts")]
    texts = F.col("expr_texts") if "expr_texts" in log.columns else F.lit(None).cast("array<string>")
    d = routed(log, rules, ns).withColumn("_p", N.let(F.from_json(plan_col, f"array<{_NODE}>"), lambda n: _parts(n, F.col(plan_col), texts, ns)))
    for name in ("root_kind", "inputs", "n_inputs"):
        d = d.withColumn(name, F.col("_p")[name])
    d = process_identity(d.withColumn("reason", quarantine_reason(policy, _holds_literal(F.col("_p"), ns) if policy.literal == "strict" else None)))
    rule = [f.name for f in RULE_SCHEMA.fields if f.name != "command"]
    return d.select(*ev, *rule, "database", "target_qn", "root_kind", "inputs", "n_inputs", "reason", "process_qn", "query_text",
                    _columns(F.col("_p"), ns).alias("columns"))


def _parts(n: Column, text: Column, texts: Column, ns: str) -> Column:
    """What lineage needs of a parsed plan: ``root_kind``, ``inputs`` (L1), the catalog relations ``rels`` with the place of
    each and its columns, and the outputs ``outs`` of a root projection with the ids that they refer to."""
    root = F.get(n, F.lit(0))
    unread = (n.isNull() | ((F.size(n) > 0) & root["class"].isNull())) & text.isNotNull() & (F.trim(text) != "")
    kind = F.when(unread, F.lit(K.ROOT_BAD)).otherwise(S.root_kind_of(root))

    def relation(x, i):
        name = S._meta(x)["identifier"]
        of_part = lambda a: F.array_contains(F.coalesce(S._meta(x)["partitionColumnNames"], F.array().cast("array<string>")), a)
        column = lambda a: F.struct(a[0]["exprId"]["id"].alias("id"), a[0]["name"].alias("name"), of_part(a[0]["name"]).alias("is_part"))
        return F.when(S._is_relation(x["class"]) & name.isNotNull(), F.struct(
            i.alias("i"), name["database"].alias("db"), name["table"].alias("tbl"), F.transform(S._attrs(x), column).alias("cols")))

    rels = F.filter(F.transform(F.coalesce(n, F.array().cast(f"array<{_NODE}>")), relation), lambda r: r.isNotNull())

    def output(e, i):
        leaf = lambda x: x["num-children"] == 0
        bare = e[0]["class"] == S.ATTRIBUTE
        return F.struct(
            i.alias("pos"), e[0]["name"].alias("name"), e[0]["exprId"]["id"].alias("id"),
            F.when(bare, F.lit(0)).otherwise(F.coalesce(e[0]["num-children"], F.lit(0))).alias("n"),
            F.transform(F.filter(e, lambda x: leaf(x) & x["exprId"]["id"].isNotNull()), lambda x: x["exprId"]["id"]).alias("ids"),
            F.exists(e, lambda x: leaf(x) & ~x["class"].isin(*S.NAMED_LEAVES)).alias("literal"),
            F.coalesce(F.get(texts, i), F.when(texts.isNull() & ~bare, X.expression_text(F.slice(e, 2, F.size(e))))).alias("text"))

    items = F.when(root["class"] == S.PROJECT, F.coalesce(root["projectList"], F.array().cast(f"array<array<{X.NODE}>>")))
    return N.let(rels, lambda r: F.struct(
        kind.alias("root_kind"), F.transform(r, lambda x: N.table_qn(x["db"], x["tbl"], ns)).alias("inputs"), F.size(r).alias("n_inputs"),
        r.alias("rels"), F.transform(items, output).alias("outs")))


def _entries(p: Column, key: str, ns: str) -> Column:
    """The columns of the catalog relations by id or by name, with what decides between two of the same key."""
    return F.flatten(F.transform(p["rels"], lambda r: F.transform(r["cols"], lambda c: F.struct(
        c[key].alias("key"), r["i"].alias("rel_pos"), c["is_part"].alias("is_partition_col"),
        N.input_col_qn(r["db"], r["tbl"], c["name"], ns).alias("qn")))))


def _holds_literal(p: Column, ns: str) -> Column:
    """Q2: whether a derived output holds a leaf without a name."""
    found = N.let(_dictionary(_entries(p, "id", ns)), lambda d: F.exists(p["outs"], lambda o: d[o["id"]].isNull() & (o["n"] >= 1) & o["literal"]))
    return F.coalesce(F.when(p["outs"].isNotNull(), found), F.lit(False))


def _columns(p: Column, ns: str) -> Column:
    """The column lineage of a plan's parts, one struct per output."""
    def row(branch, out_pos, out_name, inputs, n_inputs, expression):
        return F.struct(
            branch.alias("branch"), out_pos.cast("int").alias("out_pos"), out_name.alias("out_name"),
            N.lineage_id(F.col("database"), F.col("target_table"), out_name, ns).alias("lineage_id"),
            N.output_col_qn(F.col("database"), F.col("target_table"), out_name, ns).alias("output_qn"),
            inputs.alias("inputs"), n_inputs.alias("n_inputs"), expression.alias("expression"), dependency_type(expression).alias("dep_type"))

    # outputs whose own id is a source column (L3), or that have children (L4): what their ids mean
    meant = N.let(_dictionary(_entries(p, "id", ns)), lambda d: F.transform(p["outs"], lambda o: F.struct(
        o["pos"].alias("pos"), o["name"].alias("name"), o["n"].alias("n"), o["text"].alias("text"), d[o["id"]].alias("own"),
        F.filter(F.transform(o["ids"], lambda i: d[i]), lambda q: q.isNotNull()).alias("hits"))))

    def projected(o):
        own, hits, text = o["own"], o["hits"], o["text"]
        renamed = (F.size(hits) == 1) & ~F.coalesce(text.contains("(") & text.contains(")"), F.lit(False))
        return row(F.when(own.isNotNull(), F.lit(K.BRANCH_PASSTHROUGH)).otherwise(F.lit(K.BRANCH_DERIVED)), o["pos"], o["name"],
                   F.when(own.isNotNull(), F.array(own)).otherwise(hits), F.when(own.isNotNull(), F.lit(1)).otherwise(F.size(hits)),
                   F.when(own.isNull() & ~renamed, text))

    direct = lambda c: row(F.lit(K.BRANCH_DIRECT), F.lit(None), c["key"], F.array(c["qn"]), F.lit(1), F.lit(K.DIRECT_MAPPING))
    kind = p["root_kind"]
    return (F.when(kind == K.ROOT_PROJECT, F.transform(F.filter(meant, lambda o: o["own"].isNotNull() | (o["n"] >= 1)), projected))
            .when(kind == K.ROOT_RELATION, F.transform(_latest(_entries(p, "name", ns)), direct))
            .otherwise(F.array()))


class PlanLineage(Lineage):
    """The lineage products of a plan log, each built from its execution's own row; or from the rows that ``harvest``
    gave and somebody stored (``rows``), so that several products read them without parsing the plans again."""

    def __init__(self, log: DataFrame | None = None, rules: DataFrame | None = None, policy: Policy = DEFAULT_POLICY,
                 ns: str = K.NAMESPACE, rows: DataFrame | None = None):
        self.rows = rows if rows is not None else harvest(log, rules, policy, ns)
        self.policy, self.rules, self.ns = policy, rules, ns

    def stage(self, path: str) -> "PlanLineage":
        """Store the harvested rows once under ``path`` and build every product from them."""
        self.rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return PlanLineage(rows=self.rows.sparkSession.read.schema(self.rows.schema).parquet(path), rules=self.rules, policy=self.policy, ns=self.ns)

    @cached_property
    def events(self) -> DataFrame:
        return self.rows

    @cached_property
    def routed(self) -> DataFrame:
        return self.rows.drop("inputs", "n_inputs", "reason", "process_qn", "query_text", "columns")

    @cached_property
    def column_lineage(self) -> DataFrame:
        # an outer explode: an inner one makes Spark test the size of the array, i.e. work all of it out, before the parsing too
        c = (self.good.select("event_id", "ts", "root_kind", "process_qn", F.explode_outer("columns").alias("c"))
             .where(F.col("c.branch").isNotNull()))
        return c.select("event_id", "ts", "root_kind", "c.branch", "c.out_pos", "c.out_name", "process_qn", "c.lineage_id", "c.output_qn",
                        "c.inputs", "c.n_inputs", "c.expression", "c.dep_type")

    def entity_lists(self, form=lambda entity: entity) -> DataFrame:
        """Per event its key, its process entity and the entities of its columns, in order; nothing is regrouped."""
        ordered = F.array_sort(F.transform("columns", lambda c: F.struct(F.coalesce(c["out_pos"], F.lit(0)).alias("p"), c["out_name"].alias("n"),
                                                                      c.alias("c"))))
        return self._entity_lists(self.good.withColumn("_cols", F.transform(ordered, lambda x: x["c"])), form)
