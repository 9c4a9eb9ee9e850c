"""The nodes of a plan as a tree, worked out inside the plan's row.

A plan is a pre-order array of nodes, of which each tells how many children it has.  Two folds over the array give the
nested-set form of the tree, without a self-join and without a shuffle:

* from the right, a stack of subtree sizes: a node takes as many from it as it has children, and its own subtree has one
  node more than these together;
* from the left, a stack of the open nodes with the children they still wait for: its top is the next node's parent.

An array that is no single tree (children missing, or nodes left over) has no tree form: null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K

_NODE = "struct<class:string,`num-children`:int>"
_SIZES = "struct<stack:array<int>,sizes:array<int>,short:boolean>"
_OPEN = "struct<stack:array<struct<pos:int,left:int>>,parents:array<int>,at:int>"


def _sizes(nodes: Column) -> Column:
    """Struct of the sizes of all subtrees in pre-order (``sizes``), the sizes left on the stack, and whether a node found
    too few children."""

    def step(state, x):
        n = F.coalesce(x["num-children"], F.lit(0))
        taken = F.slice(state["stack"], 1, n)
        size = F.aggregate(taken, F.lit(1), lambda a, b: a + b)
        left = F.slice(state["stack"], n + 1, F.greatest(F.size(state["stack"]) - n, F.lit(0)))
        return F.struct(F.concat(F.array(size), left).alias("stack"), F.concat(F.array(size), state["sizes"]).alias("sizes"),
                        (state["short"] | (F.size(taken) < n)).alias("short"))

    none = F.array().cast("array<int>")
    start = F.struct(none.alias("stack"), none.alias("sizes"), F.lit(False).alias("short")).cast(_SIZES)
    return F.aggregate(F.reverse(nodes), start, step)


def _parents(nodes: Column) -> Column:
    """Place of each node's parent (null for the root)."""

    def step(state, x):
        n = F.coalesce(x["num-children"], F.lit(0))
        stack = state["stack"]
        top = F.get(stack, F.lit(0))
        rest = F.slice(stack, 2, F.greatest(F.size(stack) - 1, F.lit(0)))
        rest = F.when(top["left"] > 1, F.concat(F.array(F.struct(top["pos"].alias("pos"), (top["left"] - 1).alias("left"))), rest)).otherwise(rest)
        opened = F.concat(F.array(F.struct(state["at"].alias("pos"), n.alias("left"))), rest)
        return F.struct(F.when(n > 0, opened).otherwise(rest).alias("stack"), F.concat(state["parents"], F.array(top["pos"])).alias("parents"),
                        (state["at"] + 1).alias("at"))

    start = F.struct(F.array().cast("array<struct<pos:int,left:int>>").alias("stack"), F.array().cast("array<int>").alias("parents"),
                     F.lit(0).alias("at")).cast(_OPEN)
    return F.aggregate(nodes, start, step, lambda state: state["parents"])


def plan_trees(log: DataFrame, plan_col: str = "plan_json") -> DataFrame:
    """All columns but the plan's text, plus ``tree``: per node, in pre-order, (node_pos, parent_pos, last_pos, cls,
    parent_cls).  ``last_pos`` is the place of the last node of its subtree; ``cls`` is the class without its package.
    A plan that cannot be read or is no tree has a null tree, an empty plan an empty one."""
    kept = [c for c in log.columns if c != plan_col]
    nodes = log.select(*kept, F.from_json(plan_col, f"array<{_NODE}>").alias("_nodes"))
    nodes = nodes.select(*kept, "_nodes", _sizes(F.col("_nodes")).alias("_s"), _parents(F.col("_nodes")).alias("_p"))
    short = F.transform("_nodes", lambda n: F.element_at(F.split(n["class"], "[.]"), -1))
    nodes = nodes.select(*kept, "_nodes", "_s", "_p", short.alias("_c"))
    tree = F.transform(F.col("_nodes"), lambda n, i: F.struct(
        i.alias("node_pos"), F.get(F.col("_p"), i).alias("parent_pos"), (i + F.get(F.col("_s.sizes"), i) - 1).alias("last_pos"),
        F.get(F.col("_c"), i).alias("cls"), F.get(F.col("_c"), F.get(F.col("_p"), i)).alias("parent_cls")))
    whole = (F.size("_s.stack") <= 1) & ~F.col("_s.short")
    return nodes.select(*kept, F.when(whole, tree).alias("tree"))


def plan_nodes(log: DataFrame, plan_col: str = "plan_json") -> DataFrame:
    """S3: one row per node (event_id, node_pos, parent_pos, last_pos, cls)."""
    # an outer explode: for an inner one Spark would put a test of the whole tree, worked out anew, before the parsing
    t = plan_trees(log, plan_col).select("event_id", F.explode_outer("tree").alias("n")).where(F.col("n.node_pos").isNotNull())
    return t.select("event_id", "n.node_pos", "n.parent_pos", "n.last_pos", "n.cls")


def classify_plans(log: DataFrame, plan_col: str = "plan_json") -> DataFrame:
    """P2 (+ Q4): per execution which plan kinds it carries, from its own row.

    The hook collects the children of each union and then meets them again in its walk over the plan, so every write
    command right under a union counts twice (``n_write_cmds``).  A plan without a tree has nulls."""
    tree = F.col("tree")

    def has(cls):
        return F.exists(tree, lambda n: n["cls"] == cls)

    def many(cond):
        return F.size(F.filter(tree, cond)).cast("bigint")

    writes = many(lambda n: n["cls"] == K.NODE_WRITE) + many(lambda n: (n["cls"] == K.NODE_WRITE) & F.coalesce(n["parent_cls"] == K.NODE_UNION, F.lit(False)))
    out = plan_trees(log, plan_col).select(
        "event_id", has(K.NODE_DDL).alias("has_ddl"), has(K.NODE_WRITE).alias("has_write"), has(K.NODE_V2).alias("has_v2"),
        F.when(tree.isNotNull(), writes).alias("n_write_cmds"))
    return out
