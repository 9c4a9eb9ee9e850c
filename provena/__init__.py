"""provena: Spark-native lineage and catalog engine.

Execution events, plan shreds and catalog events are DataFrames; every
operator is a DataFrame -> DataFrame function built from Spark SQL
built-ins so Catalyst plans, prunes and code-generates the whole pipeline.
"""

__all__ = ["constants", "session"]
