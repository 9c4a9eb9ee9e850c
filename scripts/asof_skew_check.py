"""Skew check for the SQL-text as-of join (J1), outside the query catalogue.

3 M executions and 1.5 M texts; one session holds two thirds of all rows, all
inside one day, the others spread over ten days.  The join runs on Spark and
is compared row by row with DuckDB's ASOF JOIN over the same files (texts
sharing an instant reduced to the greatest, the engine's tie rule).

usage: python scripts/asof_skew_check.py [out_dir]   (default: a fresh folder under /tmp)
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    import duckdb
    from pyspark.sql import functions as F

    from provena.operators.asof import attach_sql
    from provena.session import build_session

    out = argv[1] if len(argv) > 1 else tempfile.mkdtemp(prefix="asof-skew-")
    spark = build_session(shuffle_partitions=16)
    n_ex, n_tx = 3_000_000, 1_500_000

    def session(c):
        return F.when(c % 3 != 0, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(c), F.lit(5000)))

    def stamp(c, hot):
        span = F.when(hot, F.lit(86_400_000_000)).otherwise(F.lit(864_000_000_000))
        return F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.pmod(F.xxhash64(c, F.lit(7)), span))

    ex = spark.range(n_ex).select(F.col("id").alias("event_id"), session(F.col("id")).alias("session_id"))
    ex = ex.withColumn("ts", stamp(F.col("event_id") * 2, F.col("session_id") == 0).cast("timestamp_ntz"))
    tx = spark.range(n_tx).select("id", session(F.col("id")).alias("session_id"),
                                  F.concat(F.lit("q"), F.col("id")).alias("sql_text"))
    tx = tx.withColumn("ts", stamp(F.col("id") * 2 + 1, F.col("session_id") == 0).cast("timestamp_ntz")).drop("id")
    ex.write.parquet(f"{out}/ex")
    tx.write.parquet(f"{out}/tx")
    t0 = time.perf_counter()
    attach_sql(spark.read.parquet(f"{out}/ex"), spark.read.parquet(f"{out}/tx")).select(
        "event_id", "sql_text").write.parquet(f"{out}/out")
    secs = time.perf_counter() - t0
    spark.stop()
    n, same = duckdb.connect().execute(f"""
    WITH t AS (SELECT session_id, ts, max(sql_text) AS sql_text FROM read_parquet('{out}/tx/*.parquet') GROUP BY ALL),
         o AS (SELECT e.event_id, t.sql_text FROM read_parquet('{out}/ex/*.parquet') e
               ASOF LEFT JOIN t ON e.session_id = t.session_id AND e.ts >= t.ts),
         s AS (SELECT event_id, sql_text FROM read_parquet('{out}/out/*.parquet'))
    SELECT (SELECT count(*) FROM s),
           (SELECT count(*) FROM o JOIN s USING (event_id) WHERE o.sql_text IS NOT DISTINCT FROM s.sql_text)
    """).fetchone()
    print(f"as-of join: {n} rows in {secs:.1f} s, {same} equal to DuckDB ASOF ({'OK' if n == same == n_ex else 'MISMATCH'})")
    return 0 if n == same == n_ex else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
