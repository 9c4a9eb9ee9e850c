"""Table and column lineage.

Inputs are the normalised event tables (``EventTables``).  The pipeline is
pure DataFrame algebra:

* per-event lists (inputs of a process) are built with ``collect_list`` of
  ``(position, value)`` structs and sorted afterwards, so order never depends
  on shuffle order and duplicates survive (a self-join lists its table twice);
* every join is by ``event_id``, and finer keys (``attr_id``, ``out_pos``) are
  compared inside the event: tables that lie together by event are joined
  where they are, and no name made of them crosses a shuffle;
* the lists that are collected are bounded by one plan's size: every leaf and
  output of one event came from one query plan held in one driver's memory.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import names as N
from .route import (DEFAULT_POLICY, Policy, process_identity, quarantine_reason, resolve_target, route_rules, route_writes,
                    successful)


@dataclass(frozen=True)
class EventTables:
    write_event: DataFrame
    scan_relation: DataFrame
    scan_column: DataFrame
    output_expr: DataFrame
    output_leaf: DataFrame

    @classmethod
    def from_tables(cls, t) -> "EventTables":
        from ..sources import fixtures as fx
        return cls(fx.write_event(t), fx.scan_relation(t), fx.scan_column(t), fx.output_expr(t), fx.output_leaf(t))


# ---------------------------------------------------------------------------
# building blocks


def input_tables(scan_relation: DataFrame, ns: str = K.NAMESPACE) -> DataFrame:
    """P3 + N2: catalog relations only, as qualified names."""
    return (scan_relation.where(F.col("is_catalog"))
            .select("event_id", "rel_pos", N.table_qn("db", "tbl", ns).alias("table_qn")))


def table_inputs(scan_relation: DataFrame, ns: str = K.NAMESPACE) -> DataFrame:
    """L1 + A1: ordered multiset of input tables per event."""
    agg = (input_tables(scan_relation, ns).groupBy("event_id")
           .agg(F.sort_array(F.collect_list(F.struct("rel_pos", "table_qn"))).alias("_rels")))
    return agg.select("event_id", F.transform("_rels", lambda r: r["table_qn"]).alias("inputs"))


def join_in_event(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by ``event_id`` and ``keys`` (numbers).

    For an equality of several columns Spark moves both sides by all of them, although rows that are dealt by event
    already lie together.  So ``keys`` are compared as a range of one value among the rows of an event, which are as few
    as its plan has."""
    r = right.select(F.col("event_id").alias("_event_id"), *(F.col(k).alias(f"_{k}") for k in keys),
                     *(c for c in right.columns if c != "event_id" and c not in keys))
    on = F.col("event_id") == F.col("_event_id")
    for k in keys:
        on = on & (F.col(k) <= F.col(f"_{k}")) & (F.col(k) >= F.col(f"_{k}"))
    return left.join(r, on, how).drop("_event_id", *(f"_{k}" for k in keys))


def catalog_columns(scan_relation: DataFrame, scan_column: DataFrame, ns: str = K.NAMESPACE) -> DataFrame:
    """Columns (data + partition) of catalog relations with their input qualified name."""
    rel = scan_relation.where(F.col("is_catalog")).select("event_id", "rel_pos", "db", "tbl")
    return (join_in_event(scan_column, rel, ["rel_pos"])
            .select("event_id", "rel_pos", "attr_id", "col", "is_partition_col",
                    N.input_col_qn("db", "tbl", "col", ns).alias("input_qn")))


def attr_dictionary(cat_cols: DataFrame) -> DataFrame:
    """J2 dictionary: (event, attr id) -> source column.  If an id occurs twice
    the later registration wins (later relation, partition after data; the
    greater name if even that ties, so the pick is deterministic).
    Columns that lie together by event are combined and looked up where they
    are."""
    return (cat_cols.groupBy("event_id", "attr_id")
            .agg(F.max_by("input_qn", F.struct("rel_pos", "is_partition_col", "input_qn")).alias("input_qn")))


def resolve_leaves(output_expr: DataFrame, output_leaf: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One dictionary lookup for both lineage branches.  Each output
    probes its own attribute id (L3) next to the ids of its leaves (L4).  Per
    output: ``pass_qn`` (its own id's source column) and ``inputs`` (leaf hits
    in leaf order, duplicates kept, literals and unknown ids skipped)."""
    own = output_expr.select("event_id", "out_pos", F.col("out_attr_id").alias("attr_id"),
                             F.lit(None).cast("int").alias("leaf_pos"), F.lit(True).alias("_own"))
    leaves = (output_leaf.where(F.col("attr_id").isNotNull())
              .select("event_id", "out_pos", "attr_id", "leaf_pos", F.lit(False).alias("_own")))
    hits = join_in_event(own.unionByName(leaves), dictionary, ["attr_id"])
    agg = hits.groupBy("event_id", "out_pos").agg(
        F.max(F.when(F.col("_own"), F.col("input_qn"))).alias("pass_qn"),
        F.sort_array(F.collect_list(F.when(~F.col("_own"), F.struct("leaf_pos", "input_qn")))).alias("_hits"))
    return agg.select("event_id", "out_pos", "pass_qn", F.transform("_hits", lambda h: h["input_qn"]).alias("inputs"))


def literal_outputs(output_expr: DataFrame, output_leaf: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Events where a derived output (not in the dictionary, has children)
    holds a non-named leaf: the original hook throws on these (Q2).  Only
    the outputs' own ids are looked up (an anti join), not their leaves."""
    lit_out = output_leaf.where(~F.col("is_named")).select("event_id", "out_pos").distinct()
    d = dictionary.select("event_id", F.col("attr_id").alias("out_attr_id"))
    derived = join_in_event(output_expr.where(F.col("n_children") >= 1), d, ["out_attr_id"], "left_anti")
    return join_in_event(derived, lit_out, ["out_pos"], "left_semi").select("event_id").distinct()


def dependency_type(expression) -> "F.Column":
    """No expression -> SIMPLE, else EXPRESSION."""
    e = F.col(expression) if isinstance(expression, str) else expression
    return F.when(e.isNull(), F.lit(K.SIMPLE)).otherwise(F.lit(K.EXPRESSION))


_REF = "struct<type_name:string,qualified_name:string,relationship_type:string>"


def _refs(arr_col, type_name: str, rel: str):
    return F.transform(arr_col, lambda x: F.struct(F.lit(type_name).alias("type_name"),
                                                   x.alias("qualified_name"),
                                                   F.lit(rel).alias("relationship_type")))


def entity_time(ts) -> "F.Column":
    """The text of a time in an entity."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def _attributes(qn, at, **given):
    """The attributes that either kind of entity has; what a kind lacks is null and left out of its JSON."""
    names = ("userName", "startTime", "endTime", "operationType", "queryId", "queryText", "recentQueries", "queryPlan", "clusterName",
             K.DEP_TYPE_ATTR, "expression")
    values = {"startTime": at, "endTime": at, "recentQueries": F.lit(None).cast("array<string>")} | given
    return F.struct(qn.alias("qualifiedName"), qn.alias("name"), *(values.get(n, F.lit(None).cast("string")).alias(n) for n in names))


def process_entity(ns: str = K.NAMESPACE, at=None, qn="process_qn", op_type="op_type", text="query_text", inputs="inputs",
                   target_qn="target_qn") -> "F.Column":
    """The hive_process of a harvested event, from its row: (type_name, qualified_name, attributes, relationships).
    ``at`` is the text of its time, if it is at hand."""
    qn, op_type, text, inputs = (F.col(c) if isinstance(c, str) else c for c in (qn, op_type, text, inputs))
    return F.struct(
        F.lit(K.TYPE_PROCESS).alias("type_name"), qn.alias("qualified_name"),
        _attributes(qn, entity_time("ts") if at is None else at, userName=F.lit(K.USER_NAME), operationType=op_type, queryId=text, queryText=text,
                    recentQueries=F.array(text), queryPlan=F.lit(K.QUERY_PLAN), clusterName=F.lit(ns)).alias("attributes"),
        F.struct(_refs(inputs, K.TYPE_TABLE, K.REL_INPUTS).alias("inputs"),
                 _refs(F.array(target_qn), K.TYPE_TABLE, K.REL_OUTPUTS).alias("outputs"),
                 F.lit(None).cast(_REF).alias("query")).alias("relationships"))


def column_entity(at, process_qn, lineage_id, output_qn, inputs, expression, dep_type) -> "F.Column":
    """The hive_column_lineage of a column, linked to its process; fields as in ``process_entity``, ``at`` the text of
    its time."""
    return F.struct(
        F.lit(K.TYPE_COLUMN_LINEAGE).alias("type_name"), lineage_id.alias("qualified_name"),
        _attributes(lineage_id, at, **{K.DEP_TYPE_ATTR: dep_type, "expression": expression}).alias("attributes"),
        F.struct(_refs(inputs, K.TYPE_COLUMN, K.REL_INPUTS).alias("inputs"),
                 _refs(F.array(output_qn), K.TYPE_COLUMN, K.REL_OUTPUTS).alias("outputs"),
                 F.struct(F.lit(K.TYPE_PROCESS).alias("type_name"), process_qn.alias("qualified_name"),
                          F.lit(K.REL_QUERY).alias("relationship_type")).alias("query")).alias("relationships"))


# ---------------------------------------------------------------------------
# the harvest


class Lineage:
    """All lineage products of one batch of events; attributes are lazy DataFrames."""

    def __init__(self, tables: EventTables, rules: DataFrame | None = None,
                 policy: Policy = DEFAULT_POLICY, ns: str = K.NAMESPACE):
        self.t = tables
        self.rules = rules
        self.policy = policy
        self.ns = ns

    def pin(self, **products: DataFrame) -> "Lineage":
        """Replace lazily built products (e.g. ``good``, ``column_lineage``) by
        materialised copies, so later products read them instead of
        recomputing the pipeline.  Used per micro-batch after writing them."""
        for name, df in products.items():
            if not isinstance(getattr(type(self), name, None), cached_property):
                raise AttributeError(name)
            self.__dict__[name] = df
        return self

    def stage(self, path: str) -> "Lineage":
        """Store ``good`` and ``column_lineage`` once under ``path`` (a folder
        in the shared ``spark.checkpoint.dir``) and build every later product
        (entities, messages, edges, de-dup) from the stored copies.  A batch
        job producing several products plans the harvested events once
        instead of once per product branch."""
        spark = self.t.write_event.sparkSession
        self.good.write.mode("overwrite").parquet(f"{path}/good")
        self.pin(good=spark.read.parquet(f"{path}/good"))
        for name in ("column_lineage", "process_entities", "column_entities", "entities"):
            self.__dict__.pop(name, None)  # rebuild from the stored events
        self.column_lineage.write.mode("overwrite").parquet(f"{path}/column_lineage")
        self.pin(column_lineage=spark.read.parquet(f"{path}/column_lineage"))
        for name in ("column_entities", "entities"):
            self.__dict__.pop(name, None)
        return self

    # -- events -------------------------------------------------------------
    @cached_property
    def routed(self) -> DataFrame:
        """S1 + P1 + N1: successful events with their rule and target."""
        rules = self.rules if self.rules is not None else route_rules(self.t.write_event.sparkSession)
        return resolve_target(route_writes(successful(self.t.write_event), rules), self.ns)

    @cached_property
    def catalog_cols(self) -> DataFrame:
        return catalog_columns(self.t.scan_relation, self.t.scan_column, self.ns)

    @cached_property
    def dictionary(self) -> DataFrame:
        return attr_dictionary(self.catalog_cols)

    @cached_property
    def events(self) -> DataFrame:
        """Routed events + inputs (L1) + process identity (L2) + quarantine reason."""
        ev = self.routed.join(table_inputs(self.t.scan_relation, self.ns), "event_id", "left")
        ev = ev.withColumn("inputs", F.coalesce("inputs", F.array().cast("array<string>")))
        ev = ev.withColumn("n_inputs", F.size("inputs"))
        if self.policy.literal == "strict":
            lit_ev = (literal_outputs(self.t.output_expr, self.t.output_leaf, self.dictionary)
                      .withColumn("_has_literal", F.lit(True)))
            ev = ev.join(lit_ev, "event_id", "left")
        return process_identity(ev.withColumn("reason", quarantine_reason(self.policy, F.col("_has_literal"))))

    @cached_property
    def quarantine(self) -> DataFrame:
        """T4: events that cannot be harvested, with reason code."""
        return self.events.where(F.col("reason").isNotNull()).select("event_id", "ts", "reason")

    @cached_property
    def good(self) -> DataFrame:
        return self.events.where(F.col("reason").isNull() & (F.col("route") == K.ROUTE_LINEAGE))

    # -- column lineage -----------------------------------------------------
    @cached_property
    def _outputs(self) -> DataFrame:
        """``output_expr`` with its lookups (``pass_qn``, ``inputs``; null when nothing hit)."""
        hits = resolve_leaves(self.t.output_expr, self.t.output_leaf, self.dictionary)
        return join_in_event(self.t.output_expr, hits, ["out_pos"], "left")

    @cached_property
    def project_rows(self) -> DataFrame:
        """L3 + L4 in one pass over the root project list (all events; the
        root-kind gate is applied when the rows meet their event).

        L3: the output attribute itself is a source column -> SIMPLE, one input.
        L4: otherwise, with children: inputs = dictionary hits among the leaves
        in leaf order; a single hit whose text lacks "(" or ")" is a rename
        (SIMPLE), anything else EXPRESSION.  No children and no hit: no row."""
        j = self._outputs.where(F.col("pass_qn").isNotNull() | (F.col("n_children") >= 1))
        is_pass = F.col("pass_qn").isNotNull()
        inputs = F.when(is_pass, F.array("pass_qn")).otherwise(
            F.coalesce(F.col("inputs"), F.array().cast("array<string>")))
        expr = (F.when(is_pass | ((F.size(inputs) == 1) & ~N.has_both_parens("expr_text")),
                       F.lit(None).cast("string"))
                .otherwise(F.col("expr_text")))
        branch = F.when(is_pass, F.lit(K.BRANCH_PASSTHROUGH)).otherwise(F.lit(K.BRANCH_DERIVED))
        return j.select("event_id", "out_pos", "out_name", inputs.alias("inputs"), expr.alias("expression"),
                        branch.alias("branch"))

    @cached_property
    def passthrough_rows(self) -> DataFrame:
        return self.project_rows.where(F.col("branch") == K.BRANCH_PASSTHROUGH)

    @cached_property
    def derived_rows(self) -> DataFrame:
        return self.project_rows.where(F.col("branch") == K.BRANCH_DERIVED)

    @cached_property
    def direct_rows(self) -> DataFrame:
        """Bare-relation query: each column maps to the same-named target column."""
        rel_events = self.t.write_event.where(F.col("root_kind") == K.ROOT_RELATION).select("event_id")
        cols = self.catalog_cols.join(rel_events, "event_id", "left_semi")
        return (cols.groupBy("event_id", "col")
                .agg(F.max_by("input_qn", F.struct("rel_pos", "is_partition_col", "input_qn")).alias("input_qn"))
                .select("event_id", F.lit(None).cast("int").alias("out_pos"), F.col("col").alias("out_name"),
                        F.array("input_qn").alias("inputs"), F.lit(K.DIRECT_MAPPING).alias("expression"),
                        F.lit(K.BRANCH_DIRECT).alias("branch")))

    @cached_property
    def column_lineage(self) -> DataFrame:
        """L3-L6 with the root-kind gate (P4): PROJECT -> pass-through/derived,
        RELATION -> direct mapping, anything else -> no column rows.  The
        harvested events are joined once, to all branches together."""
        rows = self.project_rows.unionByName(self.direct_rows)
        g = self.good.where(F.col("root_kind").isin(K.ROOT_PROJECT, K.ROOT_RELATION)).select(
            "event_id", "ts", "root_kind", "database", "target_table", "process_qn")
        # an equality of the two would become a join key, and move all rows once more
        fits = F.when(F.col("branch") == K.BRANCH_DIRECT, F.col("root_kind") == K.ROOT_RELATION).otherwise(F.col("root_kind") == K.ROOT_PROJECT)
        j = rows.join(g, "event_id").where(fits)
        return j.select(
            "event_id", "ts", "root_kind", "branch", "out_pos", "out_name", "process_qn",
            N.lineage_id("database", "target_table", "out_name", self.ns).alias("lineage_id"),
            N.output_col_qn("database", "target_table", "out_name", self.ns).alias("output_qn"),
            "inputs", F.size("inputs").alias("n_inputs"), "expression",
            dependency_type("expression").alias("dep_type"),
        )

    # -- entities -----------------------------------------------------------
    @cached_property
    def process_entities(self) -> DataFrame:
        """One hive_process per harvested event."""
        return self.good.select("event_id", "ts", F.col("target_qn").alias("message_key"), process_entity(self.ns).alias("e")).select(
            "event_id", "ts", "message_key", "e.*")

    @cached_property
    def column_entities(self) -> DataFrame:
        """One hive_column_lineage per column row, linked to its process."""
        e = column_entity(entity_time("ts"), *(F.col(c) for c in ("process_qn", "lineage_id", "output_qn", "inputs", "expression", "dep_type")))
        return self.column_lineage.select("event_id", "ts", "out_pos", "out_name", e.alias("e")).select("event_id", "ts", "out_pos", "out_name", "e.*")

    def entity_lists(self, form=lambda entity: entity) -> DataFrame:
        """Per harvested event its key, its process entity, the entities of its columns, in order, and how many all are.

        ``form`` is applied to each entity where it is made.  The columns' rows are put together per event before any
        entity is built, so what the shuffle carries is the lineage and not its entities."""
        parts = ("lineage_id", "output_qn", "inputs", "expression", "dep_type")
        order = F.struct(F.coalesce("out_pos", F.lit(0)).alias("p"), F.col("out_name").alias("n"), *parts)
        per_event = self.column_lineage.groupBy("event_id").agg(F.sort_array(F.collect_list(order)).alias("_cols"))
        j = self.good.join(per_event, "event_id", "left")
        some = F.coalesce("_cols", F.array().cast(j.schema["_cols"].dataType))
        return self._entity_lists(j.withColumn("_cols", some), form)

    def _entity_lists(self, events: DataFrame, form) -> DataFrame:
        """``entity_lists`` of events with their columns, in order, in ``_cols``."""
        column = lambda c: form(column_entity(
            F.col("_at"), F.col("process_qn"), *(c[p] for p in ("lineage_id", "output_qn", "inputs", "expression", "dep_type"))))
        return events.withColumn("_at", entity_time("ts")).select(
            "event_id", "ts", F.col("target_qn").alias("key"), form(process_entity(self.ns, F.col("_at"))).alias("process"),
            F.transform("_cols", column).alias("columns"), (F.size("_cols") + 1).alias("n_entities"))

    @cached_property
    def entities(self) -> DataFrame:
        """All entities in one schema (process entities get a null out_pos)."""
        cols = ["event_id", "ts", "type_name", "qualified_name", "attributes", "relationships"]
        return self.process_entities.select(*cols).unionByName(self.column_entities.select(*cols))

    def latest_entities(self) -> DataFrame:
        """A5 over ``entities``: the latest of each (type_name, qualified_name), by ts, event_id and then the other fields.

        What an entity is made of is compared in the order that it has in the entity, so the entities are built of the
        rows that are kept, and no other moves."""
        order = ("ts", "event_id", "kind", "text", "inputs", "output_qn", "process_qn")
        process = self.good.select(F.lit(K.TYPE_PROCESS).alias("type_name"), F.col("process_qn").alias("qualified_name"), F.struct(
            "ts", "event_id", F.col("op_type").alias("kind"), F.col("query_text").alias("text"), "inputs", F.col("target_qn").alias("output_qn"),
            F.lit(None).cast("string").alias("process_qn")).alias("_e"))
        column = self.column_lineage.select(F.lit(K.TYPE_COLUMN_LINEAGE).alias("type_name"), F.col("lineage_id").alias("qualified_name"), F.struct(
            "ts", "event_id", F.col("dep_type").alias("kind"), F.col("expression").alias("text"), "inputs", "output_qn", "process_qn").alias("_e"))
        kept = process.unionByName(column).groupBy("type_name", "qualified_name").agg(F.max("_e").alias("_e"))
        kept = kept.select("type_name", "qualified_name", *(F.col(f"_e.{c}").alias(c) for c in order))
        qn, at = F.col("qualified_name"), entity_time("ts")
        made = F.when(F.col("type_name") == K.TYPE_PROCESS, process_entity(self.ns, at, qn, *(F.col(c) for c in ("kind", "text", "inputs", "output_qn")))).otherwise(
            column_entity(at, F.col("process_qn"), qn, *(F.col(c) for c in ("output_qn", "inputs", "text", "kind"))))
        return kept.select("event_id", "ts", made.alias("_e")).select("event_id", "ts", "_e.*")
