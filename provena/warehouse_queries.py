"""Warehouse workload queries.

``customer`` gives a table of accounts, partitioned by the region of their nation; ``customer`` and ``nation`` give the
joined rows, ``orders`` the text lines.  Every query writes into a fresh database under the shared checkpoint folder
and returns the final table content, so the oracle compares what actually landed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators import warehouse as W
from .queries import query
from .session import Tables, scratch_path

ACCOUNT_SQL = "SELECT c_acctbal AS balance, c_custkey AS account, c_mktsegment AS segment, c_nationkey // 5 AS zone FROM customer"
PLACES_SQL = ("SELECT c_custkey AS account, n_name || '/' || c_mktsegment AS market, abs(c_acctbal) AS exposure, n.* "
              "FROM customer LEFT JOIN nation n ON n_nationkey = c_nationkey AND c_acctbal > 0")
ACCOUNT_SCHEMA = T.StructType([T.StructField("balance", T.DoubleType()), T.StructField("account", T.LongType()),
                               T.StructField("segment", T.StringType())])
ACCOUNT_SCHEMA_P = T.StructType(ACCOUNT_SCHEMA.fields + [T.StructField("zone", T.IntegerType())])


def accounts(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select(F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("account"), F.col("c_mktsegment").alias("segment"),
                    F.expr("c_nationkey DIV 5").cast("int").alias("zone"))


def places(spark, sf_dir):
    """J3 + P6 + F1 + F2: customer LEFT JOIN nation (only where the balance is positive), derived columns, qualified star."""
    t = Tables(spark, sf_dir)
    c, n = t.customer, t.nation
    j = c.join(n, (n["n_nationkey"] == c["c_nationkey"]) & (c["c_acctbal"] > 0), "left")
    return j.select(c["c_custkey"].alias("account"), F.concat(n["n_name"], F.lit("/"), c["c_mktsegment"]).alias("market"),
                    F.abs(c["c_acctbal"]).alias("exposure"), n["*"])


def _account_table(spark, sf_dir, db, name="accounts"):
    return W.save_table(accounts(spark, sf_dir), f"{db}.{name}", partition_by=["zone"])


@query("emp_dept_left_join", PLACES_SQL)
def emp_dept_left_join(spark, sf_dir):
    return places(spark, sf_dir)


@query("ctas_readback", PLACES_SQL)
def ctas_readback(spark, sf_dir):
    db = W.fresh_database(spark)
    return W.ctas(places(spark, sf_dir), f"{db}.exposures")


@query("save_table_readback", PLACES_SQL)
def save_table_readback(spark, sf_dir):
    db = W.fresh_database(spark)
    name = f"{db}.exposures_kept"
    W.save_table(accounts(spark, sf_dir).where(F.col("account") % 2 == 0), name)
    return W.save_table(places(spark, sf_dir), name, mode="overwrite")


@query("append_readback", ACCOUNT_SQL)
def append_readback(spark, sf_dir):
    db = W.fresh_database(spark)
    name = f"{db}.accounts"
    rows = accounts(spark, sf_dir)
    W.ctas(rows.where(F.col("account") % 3 == 0), name)
    W.append_table(rows.where(F.col("account") % 3 == 1), name)
    return W.append_table(rows.where(F.col("account") % 3 == 2), name)


@query("static_partition_overwrite", f"""
SELECT * FROM ({ACCOUNT_SQL}) a WHERE zone <> 3
UNION ALL SELECT balance, account, segment, 3 AS zone FROM ({ACCOUNT_SQL}) a WHERE zone < 3 AND segment = 'BUILDING'""")
def static_partition_overwrite(spark, sf_dir):
    """The accounts of one segment from all lower zones replace a zone that the same table holds."""
    db = W.fresh_database(spark)
    t = _account_table(spark, sf_dir, db)
    return W.overwrite_partition(t.where("zone < 3 AND segment = 'BUILDING'"), f"{db}.accounts", {"zone": 3})


@query("dynamic_partition_overwrite", f"""
SELECT * FROM ({ACCOUNT_SQL}) a WHERE zone IN (1, 3) OR balance >= 0""")
def dynamic_partition_overwrite(spark, sf_dir):
    """Three zones of five are written anew without their overdrawn accounts; the others stay as they are."""
    db = W.fresh_database(spark)
    t = _account_table(spark, sf_dir, db)
    return W.overwrite_dynamic(t.where("zone IN (0, 2, 4) AND balance >= 0"), f"{db}.accounts")


@query("multi_insert", f"""
SELECT * FROM ({ACCOUNT_SQL}) a WHERE zone > 2
UNION ALL SELECT balance, account, segment, CASE WHEN balance < 0 THEN 0 WHEN balance < 5000 THEN 1 ELSE 2 END AS zone
FROM ({ACCOUNT_SQL}) a WHERE zone <= 2""")
def multi_insert(spark, sf_dir):
    """Accounts of the lower zones are dealt anew by their balance, three partitions in one statement."""
    db = W.fresh_database(spark)
    t = _account_table(spark, sf_dir, db)
    bands = ("balance < 0", "balance >= 0 AND balance < 5000", "balance >= 5000")
    return W.multi_insert(t.where("zone <= 2"), f"{db}.accounts", [(band, {"zone": i}) for i, band in enumerate(bands)])


@query("overwrite_table_from_first", PLACES_SQL)
def overwrite_table_from_first(spark, sf_dir):
    db = W.fresh_database(spark)
    name = f"{db}.exposures"
    W.ctas(places(spark, sf_dir).where(F.col("account") < 5), name)
    t = Tables(spark, sf_dir)
    cv, nv = f"customer_{uuid.uuid4().hex[:8]}", f"nation_{uuid.uuid4().hex[:8]}"
    t.customer.createOrReplaceTempView(cv)
    t.nation.createOrReplaceTempView(nv)
    q = (f"SELECT c_custkey account, concat(n_name, '/', c_mktsegment) market, abs(c_acctbal) exposure, n.* "
         f"FROM {cv} LEFT JOIN {nv} n ON n_nationkey = c_nationkey AND c_acctbal > 0")
    return W.overwrite_table(spark, q, name)


@query("json_readback", f"SELECT * FROM ({ACCOUNT_SQL}) a WHERE segment = 'MACHINERY'")
def json_readback(spark, sf_dir):
    path = scratch_path(spark, "accounts_json")
    W.save_json(accounts(spark, sf_dir).where(F.col("segment") == "MACHINERY"), path)
    return spark.read.schema(ACCOUNT_SCHEMA_P).json(path)


@query("load_overwrite", f"""
SELECT * FROM ({ACCOUNT_SQL}) a WHERE zone <> 4
UNION ALL SELECT balance, account, segment, 4 AS zone FROM ({ACCOUNT_SQL}) a""")
def load_overwrite(spark, sf_dir):
    db = W.fresh_database(spark)
    _account_table(spark, sf_dir, db)
    path = scratch_path(spark, "accounts_file")
    accounts(spark, sf_dir).drop("zone").write.csv(path)
    return W.load_overwrite(spark, path, f"{db}.accounts", ACCOUNT_SCHEMA, partition={"zone": 4})


@query("create_like", f"SELECT * FROM ({ACCOUNT_SQL}) a WHERE 1 = 0")
def create_like(spark, sf_dir):
    db = W.fresh_database(spark)
    _account_table(spark, sf_dir, db)
    return W.create_like(spark, f"{db}.accounts_empty", f"{db}.accounts").select("balance", "account", "segment", "zone")


HOLDER_SQL = ("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance, "
              "c_nationkey AS nation_no FROM customer")
HOLDER_SCHEMA_P = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                                T.StructField("segment", T.StringType()), T.StructField("balance", T.DoubleType()),
                                T.StructField("nation_no", T.IntegerType())])


@query("external_csv_partitioned", HOLDER_SQL)
def external_csv_partitioned(spark, sf_dir):
    """Every customer with the name, in a folder per nation."""
    db = W.fresh_database(spark)
    path = scratch_path(spark, "accounts_ext")
    c = Tables(spark, sf_dir).customer
    rows = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                    F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation_no"))
    rows.write.partitionBy("nation_no").csv(path)
    return W.read_external_csv(spark, f"{db}.accounts", path, HOLDER_SCHEMA_P, ["nation_no"])


@query("view_source", f"SELECT * FROM ({ACCOUNT_SQL}) a WHERE zone = 2")
def view_source(spark, sf_dir):
    db = W.fresh_database(spark)
    _account_table(spark, sf_dir, db)
    spark.sql(f"CREATE VIEW {db}.accounts_v AS SELECT * FROM {db}.accounts")
    return spark.table(f"{db}.accounts_v").where(F.col("zone") == 2)


@query("partition_filter", f"SELECT * FROM ({ACCOUNT_SQL}) a WHERE zone = 1")
def partition_filter(spark, sf_dir):
    db = W.fresh_database(spark)
    _account_table(spark, sf_dir, db)
    return spark.table(f"{db}.accounts").where(F.col("zone") == 1)


@query("rename_readback", ACCOUNT_SQL)
def rename_readback(spark, sf_dir):
    db = W.fresh_database(spark)
    W.ctas(accounts(spark, sf_dir), f"{db}.intake")
    W.drop_table(spark, f"{db}.ledger")
    return W.rename_table(spark, f"{db}.intake", f"{db}.ledger")


@query("split_lines", """
SELECT o_orderpriority <> '5-LOW' AS pressing, o_totalprice AS price, CAST(o_orderdate AS DATE) AS ordered, o_orderstatus AS status,
  CAST(o_custkey AS INT) AS account, o_orderkey AS number FROM orders""")
def split_lines(spark, sf_dir):
    """Lines of ``orders``, their items between one or several blanks, cast by position."""
    o = Tables(spark, sf_dir).orders
    path = scratch_path(spark, "order_lines")
    (o.select(F.concat_ws("  ", (F.col("o_orderpriority") != "5-LOW").cast("string"),
                          F.concat_ws(" ", "o_totalprice", F.col("o_orderdate").cast("date"), "o_orderstatus", "o_custkey"),
                          "o_orderkey").alias("value"))
     .write.text(path))
    schema = T.StructType([T.StructField("pressing", T.BooleanType()), T.StructField("price", T.DoubleType()),
                           T.StructField("ordered", T.DateType()), T.StructField("status", T.StringType()),
                           T.StructField("account", T.IntegerType()), T.StructField("number", T.LongType())])
    return W.read_split_lines(spark.read.text(path), schema)


@query("text_table_collections", """
SELECT c_custkey AS key, 3 AS n_items, CAST(c_nationkey AS VARCHAR) AS nat, c_mktsegment AS seg FROM customer""")
def text_table_collections(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    path = scratch_path(spark, "packed")
    items = F.concat_ws("|", "c_mktsegment", "c_nationkey", "c_name")
    kv = F.concat(F.lit("seg>"), F.col("c_mktsegment"), F.lit("|nat>"), F.col("c_nationkey").cast("string"))
    c.select(F.concat_ws(",", "c_custkey", "c_name", items, kv).alias("value")).write.text(path)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("items", T.ArrayType(T.StringType())),
                           T.StructField("attrs", T.MapType(T.StringType(), T.StringType()))])
    d = W.read_text_table(spark, path, schema, ",", "|", ">")
    return d.select("key", F.size("items").alias("n_items"), F.col("attrs")["nat"].alias("nat"),
                    F.col("attrs")["seg"].alias("seg"))
