"""Warehouse reads and writes the lineage workload is made of.

Thin, idiomatic wrappers over DataFrameReader/Writer and Spark SQL DDL/DML.
A write that would read the table it overwrites is staged first: the
source rows are written to the shared scratch folder and read back, which
also cuts the lineage of the plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir, scratch_path


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def fresh_database(spark: SparkSession, prefix: str = "wh") -> str:
    """A new database whose files live under the shared checkpoint folder."""
    name = f"{prefix}_{uuid.uuid4().hex[:10]}"
    loc = f"{checkpoint_dir(spark).rstrip('/')}/provena-warehouse/{name}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{loc}'")
    return name


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise rows in the shared scratch folder and read them back."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


# ---------------------------------------------------------------------------
# sources


def read_split_lines(lines: DataFrame, schema: T.StructType, sep_regex: str = r"\s+",
                     col: str = "value") -> DataFrame:
    """S6 (+ F3, F4): split each text line on a regex and cast the items by position.
    Casts follow the session's ANSI setting (error on bad input when ANSI is on)."""
    parts = F.split(F.col(col), sep_regex)
    return lines.select(*[parts.getItem(i).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def read_external_csv(spark: SparkSession, name: str, path: str, schema: T.StructType,
                      partition_cols: list[str] | None = None, sep: str = ",") -> DataFrame:
    """External delimited table over ``col=value`` partition folders."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE {_q(name)} ({cols}) USING csv OPTIONS (sep '{sep}'){part} LOCATION '{path}'")
    if partition_cols:
        spark.sql(f"ALTER TABLE {_q(name)} RECOVER PARTITIONS")
    return spark.table(name)


def read_text_table(spark: SparkSession, path: str, schema: T.StructType, field_sep: str = ",",
                    item_sep: str = "|", kv_sep: str = ">") -> DataFrame:
    """Delimited text with collection items and map keys: array and map
    columns of ``schema`` are read as text and split with the item / key separators."""
    flat = T.StructType([T.StructField(f.name, f.dataType if not isinstance(f.dataType, (T.ArrayType, T.MapType))
                                       else T.StringType()) for f in schema.fields])
    df = spark.read.schema(flat).option("sep", field_sep).csv(path)
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            c = F.split(c, _regex_literal(item_sep)).cast(f.dataType)
        elif isinstance(f.dataType, T.MapType):
            c = F.str_to_map(c, F.lit(_regex_literal(item_sep)), F.lit(_regex_literal(kv_sep))).cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in sep)


# ---------------------------------------------------------------------------
# writes


def ctas(df: DataFrame, name: str, fmt: str = "parquet", partitioned_by: list[str] | None = None) -> DataFrame:
    """K1: CREATE TABLE AS SELECT."""
    w = df.writeTo(name).using(fmt)
    if partitioned_by:
        w = w.partitionedBy(*[F.col(c) for c in partitioned_by])
    w.create()
    return df.sparkSession.table(name)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet",
               partition_by: list[str] | None = None) -> DataFrame:
    """K2: ``saveAsTable``."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, name: str) -> DataFrame:
    """K3: INSERT INTO ... SELECT (by position)."""
    df.write.insertInto(name)
    return df.sparkSession.table(name)


def overwrite_partition(df: DataFrame, table: str, partition: dict, staged: bool = True) -> DataFrame:
    """K4: INSERT OVERWRITE one static partition.  The rows are staged first,
    because a source reading the target table is rejected."""
    spark = df.sparkSession
    src = stage(df) if staged else df
    view = f"_src_{uuid.uuid4().hex[:8]}"
    src.createOrReplaceTempView(view)
    spec = ", ".join(f"`{k}` = {_lit(v)}" for k, v in partition.items())
    cols = ", ".join(f"`{c}`" for c in src.columns if c not in partition)
    spark.sql(f"INSERT OVERWRITE TABLE {_q(table)} PARTITION ({spec}) SELECT {cols} FROM {view}")
    spark.catalog.dropTempView(view)
    return spark.table(table)


def overwrite_dynamic(df: DataFrame, table: str) -> DataFrame:
    """K5: overwrite only the partitions present in ``df``, which may read the table itself.

    ``insertInto`` takes the mode from the session alone (a writer option is not heard, and the whole table would be
    overwritten), so the session's mode is set for this write and put back."""
    spark = df.sparkSession
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, "STATIC")
    spark.conf.set(key, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(key, before)
    return spark.table(table)


def multi_insert(src: DataFrame, table: str, branches: list[tuple[str, dict]], staged: bool = True) -> DataFrame:
    """K6: one source, N filtered static-partition overwrites in one statement
    (``FROM src INSERT OVERWRITE .. INSERT OVERWRITE ..``)."""
    spark = src.sparkSession
    s = stage(src) if staged else src
    view = f"_src_{uuid.uuid4().hex[:8]}"
    s.createOrReplaceTempView(view)
    parts = []
    for pred, partition in branches:
        spec = ", ".join(f"`{k}` = {_lit(v)}" for k, v in partition.items())
        cols = ", ".join(f"`{c}`" for c in s.columns if c not in partition)
        parts.append(f"INSERT OVERWRITE TABLE {_q(table)} PARTITION ({spec}) SELECT {cols} WHERE {pred}")
    spark.sql(f"FROM {view} " + " ".join(parts))
    spark.catalog.dropTempView(view)
    return spark.table(table)


def overwrite_table(spark: SparkSession, query_sql: str, table: str) -> DataFrame:
    """K7: ``FROM (query) INSERT OVERWRITE TABLE t SELECT *``."""
    spark.sql(f"FROM ({query_sql}) _q INSERT OVERWRITE TABLE {_q(table)} SELECT *")
    return spark.table(table)


def save_json(df: DataFrame, path: str) -> None:
    """K8: JSON files, overwrite."""
    df.write.mode("overwrite").json(path)


def load_overwrite(spark: SparkSession, path: str, table: str, schema: T.StructType,
                   partition: dict | None = None, fmt: str = "csv", options: dict | None = None) -> DataFrame:
    """K9: LOAD DATA ... OVERWRITE INTO TABLE [PARTITION]: read the file with the
    table's schema, then overwrite the table or one static partition."""
    df = spark.read.schema(schema).options(**(options or {})).format(fmt).load(path)
    if partition:
        for k, v in partition.items():
            df = df.withColumn(k, F.lit(v))
        return overwrite_partition(df, table, partition, staged=False)
    df.write.mode("overwrite").insertInto(table)
    return spark.table(table)


def create_like(spark: SparkSession, new: str, old: str) -> DataFrame:
    """CREATE TABLE new LIKE old (schema only)."""
    spark.sql(f"CREATE TABLE {_q(new)} LIKE {_q(old)}")
    return spark.table(new)


def rename_table(spark: SparkSession, old: str, new: str) -> DataFrame:
    """ALTER TABLE .. RENAME TO."""
    spark.sql(f"ALTER TABLE {_q(old)} RENAME TO {_q(new)}")
    return spark.table(new)


def drop_table(spark: SparkSession, name: str, view: bool = False) -> None:
    spark.sql(f"DROP {'VIEW' if view else 'TABLE'} IF EXISTS {_q(name)}")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {_q(name)} CASCADE")


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"USE {_q(name)}")


def _lit(v) -> str:
    return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"
