"""Catalog and DDL event processing.

Catalog events become change rows; a rename is a rename record plus a
create record for the new name.  Create records are expanded to one row per
column from the current table definitions.  ``catalog_state`` folds all
changes into the current catalog: per object the last change decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from .asof import attach_sql, micros

ALIVE_CHANGES = ("CREATE_DATABASE", "ALTER_DATABASE", "CREATE_TABLE", "ALTER_TABLE")


def read_catalog_events(events: DataFrame, skip_when_external: bool = False) -> DataFrame:
    """Keep catalog event kinds; others ("pre" events, unrelated events) are ignored.
    With an external metastore the original hook ignores the whole feed."""
    kept = events.where(F.col("kind").isin(*K.CATALOG_KINDS))
    return kept.where(F.lit(False)) if skip_when_external else kept


def catalog_tally(events: DataFrame) -> DataFrame:
    """Events by kind; kinds that are not processed are counted together as UNSUPPORTED, with null among them."""
    known = F.coalesce(F.col("kind").isin(*K.CATALOG_KINDS), F.lit(False))
    return (events.groupBy(F.when(known, F.col("kind")).otherwise(F.lit(K.ROUTE_UNSUPPORTED)).alias("kind"))
            .agg(F.count(F.lit(1)).alias("n")))


def with_app(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Application tag (name, master) on each event."""
    sc = (spark or df.sparkSession).sparkContext
    return df.withColumn("app_name", F.lit(sc.appName)).withColumn("master", F.lit(sc.master))


def catalog_changes(events: DataFrame, databases: DataFrame | None = None) -> DataFrame:
    """C1-C3, C5-C7 (+ J5): one row per change:
    ``event_id, ts, kind, seq, change, db, tbl, detail``.

    ``detail``: database "description|location" for creates (null when the
    database is unknown), change kind for table alters, new name for renames.
    """
    kind = F.col("kind")

    def rec(change, tbl, detail, seq):
        return F.struct(F.lit(change).alias("change"), tbl.cast("string").alias("tbl"),
                        detail.cast("string").alias("detail"), F.lit(seq).alias("seq"))

    none = F.lit(None).cast("string")
    recs = (F.when(kind == "CreateDatabaseEvent", F.array(rec("CREATE_DATABASE", none, none, 0)))
            .when(kind == "DropDatabaseEvent", F.array(rec("DROP_DATABASE", none, none, 0)))
            .when(kind == "AlterDatabaseEvent", F.array(rec("ALTER_DATABASE", none, none, 0)))
            .when(kind == "CreateTableEvent", F.array(rec("CREATE_TABLE", F.col("tbl"), none, 0)))
            .when(kind == "DropTableEvent", F.array(rec("DROP_TABLE", F.col("tbl"), none, 0)))
            .when(kind == "AlterTableEvent", F.array(rec("ALTER_TABLE", F.col("tbl"), F.col("change_kind"), 0)))
            .when(kind == "RenameTableEvent", F.array(rec("RENAME_TABLE", F.col("tbl"), F.col("new_name"), 0),
                                                 rec("CREATE_TABLE", F.col("new_name"), none, 1))))
    ch = (read_catalog_events(events)
          .select("event_id", "ts", "kind", "db", F.explode(recs).alias("r"))
          .select("event_id", "ts", "kind", "r.seq", "r.change", "db", "r.tbl", "r.detail"))
    if databases is None:
        return ch
    d = databases.select(F.col("name").alias("db"),
                         F.concat(F.col("description"), F.lit("|"), F.col("location_uri")).alias("_db_detail"))
    ch = ch.join(d, "db", "left")
    return ch.withColumn("detail", F.when(F.col("change") == "CREATE_DATABASE", F.col("_db_detail"))
                         .otherwise(F.col("detail"))).drop("_db_detail")


def table_columns(changes: DataFrame, catalog_column: DataFrame) -> DataFrame:
    """C4 / C7 (+ J4): create records -> one row per column of the current
    definition (name, type, comment or ""); a table already gone keeps one
    row with null columns."""
    creates = changes.where(F.col("change") == "CREATE_TABLE")
    cols = catalog_column.select("db", "tbl", "pos", "name", "data_type", "comment")
    j = creates.join(cols, ["db", "tbl"], "left")
    return j.withColumn("comment", F.when(F.col("name").isNotNull(), F.coalesce("comment", F.lit(""))))


def table_columns_at(changes: DataFrame, history: DataFrame) -> DataFrame:
    """C4 / C7 (+ J4) at the time of the event: create records -> one row per column of the definition that was in force
    when the event came.

    ``history`` has the definitions' versions: db, tbl, valid_from, pos, name, data_type, comment.  A version holds
    until the table's next one; a version without columns (one row whose name is null) says that the table is gone.
    An event before the first version, or while the table is gone, keeps one row with null columns.

    The version of each event comes from the as-of join by rows of (table, time), so a table with very many versions or
    events is spread over many tasks; the columns then join by table and version.
    """
    creates = changes.where(F.col("change") == "CREATE_TABLE")
    name = F.to_json(F.struct("db", "tbl"))  # one text per table, whatever its name holds
    versions = history.select(name.alias("_table"), F.col("valid_from").alias("_at")).distinct()
    texts = versions.select("_table", F.col("_at").alias("ts"), micros("_at").cast("string").alias("sql_text"))
    dated = attach_sql(creates.withColumn("_table", name), texts, by="_table").drop("sql_ts")
    cols = history.where(F.col("name").isNotNull()).select(
        F.col("db").alias("_db"), F.col("tbl").alias("_tbl"), micros("valid_from").cast("string").alias("_version"), "pos", "name", "data_type", "comment")
    j = dated.join(cols, (F.col("db") == F.col("_db")) & (F.col("tbl") == F.col("_tbl")) & (F.col("sql_text") == F.col("_version")), "left")
    return (j.withColumn("comment", F.when(F.col("name").isNotNull(), F.coalesce("comment", F.lit(""))))
            .drop("_db", "_tbl", "_version", "_table", "sql_text"))


def catalog_state(changes: DataFrame) -> DataFrame:
    """Per object (db, tbl) the last change by (ts, event_id, seq) decides;
    drops and renames-away leave the object not alive, and so does a later
    drop of its database (the last drop per database: one short row each)."""
    order = F.struct("ts", "event_id", "seq")
    last = F.max_by(F.struct("change", "event_id", order.alias("at")), order)
    g = changes.groupBy("db", "tbl").agg(last.alias("_l"))
    gone = (changes.where(F.col("change") == "DROP_DATABASE").groupBy("db").agg(F.max(order).alias("_gone")))
    return g.join(gone, "db", "left").select(
        "db", "tbl", F.col("_l.change").alias("last_kind"), F.col("_l.event_id").alias("last_event_id"),
        (F.col("_l.change").isin(*ALIVE_CHANGES)
         & (F.col("_gone").isNull() | (F.col("_l.at") > F.col("_gone")))).alias("alive"))


def ddl_changes(ddl: DataFrame) -> DataFrame:
    """DDL commands -> change kind; anything else is "unsupported"."""
    cmd = F.col("command")
    change = (F.when(cmd == "DropTableCommand",
                     F.when(F.coalesce("is_view", F.lit(False)), "drop_view").otherwise("drop_table"))
              .when(cmd == "CreateTableCommand", "create_table")
              .when(cmd == "CreateTableLikeCommand", "create_table_like")
              .when(cmd == "AlterTableRenameCommand", "rename_table")
              .when(cmd == "CreateViewCommand", "create_view")
              .otherwise("unsupported"))
    return ddl.withColumn("change", change)
