"""Entity graph products: edge list (L10) and de-duplication (A5).

De-dup keeps the latest version of every entity per unique attribute
(typeName, qualifiedName).  ``max_by`` is an aggregate with a map-side partial
step, so a hot target written by a third of all events is combined before the
shuffle instead of being sorted whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def _edge(kind: str, src, dst):
    return F.struct(F.lit(kind).alias("kind"), src.alias("src"), dst.alias("dst"))


def edges(lineage) -> DataFrame:
    """Distinct (kind, src, dst) from the entity references.  Each
    process and each column row emits its edges as one array that is
    exploded, so every product is read once."""
    pq, cq = F.col("process_qn"), F.col("lineage_id")
    p = lineage.good.select(F.explode(F.concat(
        F.transform("inputs", lambda x: _edge(K.REL_INPUTS, x, pq)),
        F.array(_edge(K.REL_OUTPUTS, pq, F.col("target_qn"))))).alias("e"))
    c = lineage.column_lineage.select(F.explode(F.concat(
        F.transform("inputs", lambda x: _edge(K.REL_INPUTS, x, cq)),
        F.array(_edge(K.REL_OUTPUTS, cq, F.col("output_qn")), _edge(K.REL_QUERY, cq, pq)))).alias("e"))
    return p.unionByName(c).select("e.*").distinct()


def dedupe_entities(entities: DataFrame, keys=("type_name", "qualified_name")) -> DataFrame:
    """A5: latest event wins per (typeName, qualifiedName); order key (ts, event_id).
    The remaining fields break ties (two outputs of one event with the same
    name), so the kept row is deterministic and a recomputed task keeps the same."""
    others = [c for c in entities.columns if c not in keys]
    rest = [c for c in others if c not in ("ts", "event_id")]
    latest = F.max(F.struct("ts", "event_id", *rest)).alias("_latest")
    return entities.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in others])
