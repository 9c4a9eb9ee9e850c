"""Messages, delivery with retry, dead letters.

A message is the keyed envelope of one process event: the process entity
first, then its column-lineage entities.  ``to_messages`` yields the Kafka
sink schema ``(topic, key, value)``; the same frame can be written to any
file format for tests or replay.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .ranking import ordinal


def _entity_ref(r):
    return F.struct(r["type_name"].alias("typeName"),
                    F.struct(r["qualified_name"].alias("qualifiedName")).alias("uniqueAttributes"),
                    r["relationship_type"].alias("relationshipType"))


def entity_json(entity) -> "F.Column":
    """An entity (type_name, attributes, relationships) as the struct of its JSON (``to_json`` leaves null attributes out)."""
    rel = entity["relationships"]
    return F.struct(
        entity["type_name"].alias("typeName"), entity["attributes"].alias("attributes"),
        F.struct(F.transform(rel["inputs"], _entity_ref).alias("inputs"), F.transform(rel["outputs"], _entity_ref).alias("outputs"),
                 F.when(rel["query"].isNotNull(), _entity_ref(rel["query"])).alias("query")).alias("relationshipAttributes"))


def envelopes(lineage) -> DataFrame:
    """One row per harvested event: key, entity list (process first), how many they are."""
    return lineage.entity_lists(entity_json).select(
        "event_id", "ts", "key", F.concat(F.array("process"), "columns").alias("entities"), "n_entities")


def to_messages(lineage, topic: str = K.HOOK_TOPIC) -> DataFrame:
    """``(topic, key, value)`` with value = JSON envelope from producer ``sparkhook``."""
    env = envelopes(lineage)
    value = F.to_json(F.struct(F.lit(K.MESSAGE_TYPE).alias("type"), F.lit(K.PRODUCER).alias("user"),
                               F.struct(F.col("entities").alias("entities")).alias("entities")))
    # the entities are read once, by their text: a second use would have them stored in the row, and copied, before it
    return env.select("event_id", F.lit(topic).alias("topic"), "key", value.alias("value"), "n_entities",
                      F.lit(K.TYPE_PROCESS).alias("first_type"))


def keyed_for_sink(messages: DataFrame) -> DataFrame:
    """T5: every message with its number ``seq`` among those of its key, in event order.

    The rows are range partitioned by (key, event), so a key that holds a
    third of them is written by many tasks, and a reader restores the order
    of a key from the numbers."""
    return ordinal(messages, ["key"], ["event_id"], "seq")


def sink_rows(messages: DataFrame, fmt: str = "kafka") -> DataFrame:
    """The columns a sink takes: ``(topic, key, value)`` and, where the messages are numbered, ``seq``.  Kafka has no such
    column, and a partition keeps the order of arrival, so there the number goes into the header ``seq`` (its digits)."""
    kept = ["topic", "key", "value"]
    if "seq" not in messages.columns:
        return messages.select(*kept)
    if fmt != "kafka":
        return messages.select(*kept, "seq")
    header = F.struct(F.lit("seq").alias("key"), F.col("seq").cast("string").cast("binary").alias("value"))
    return messages.select(*kept, F.array(header).alias("headers"))


def write_messages(messages: DataFrame, fmt: str = "kafka", options: dict | None = None,
                   path: str | None = None, mode: str = "append") -> None:
    """Write ``(topic, key, value)`` and the number within the key; ``fmt='kafka'`` needs the Kafka connector on the
    classpath."""
    w = sink_rows(messages, fmt).write.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        w = w.mode(mode)
    w.save(path) if path else w.save()


# ---------------------------------------------------------------------------
# retry / dead letter (inside foreachBatch)


def max_attempts(max_retries: int = K.MAX_RETRIES) -> int:
    """At least one attempt, even for 0 or negative retries."""
    return max(1, int(max_retries))


class DeliveryError(RuntimeError):
    """Messages that no attempt could send, and nowhere to keep them."""


def _noted(spark, ledger: str, batch_id: int) -> DataFrame | None:
    """What the ledger holds of a batch."""
    from ..streaming.store import versions
    done = versions(spark, f"{ledger}/batch_id={batch_id}", "attempt=")
    return spark.read.parquet(*(f"{ledger}/batch_id={batch_id}/attempt={a}" for a in done)) if done else None


def _note(tried: DataFrame, failed: DataFrame | None, path: str, attempt: int, ident: str) -> DataFrame:
    """Write an attempt into the ledger; returns the messages that it left."""
    rows = tried.select(ident).withColumn("delivered", F.lit(True))
    if failed is not None:
        missed = failed.select(ident).distinct().withColumn("delivered", F.lit(False))
        rows = rows.join(missed, ident, "left_anti").unionByName(missed)
    rows.select(ident, F.lit(attempt).alias("attempt"), "delivered").write.mode("overwrite").parquet(path)
    return tried.join(tried.sparkSession.read.parquet(path).where(~F.col("delivered")).select(ident), ident, "left_semi")


def send_with_retry(batch: DataFrame, send, dead_letter_path: str | None = None,
                    max_retries: int = K.MAX_RETRIES, retry_interval_ms: int = K.RETRY_INTERVAL_MS,
                    sleep=time.sleep, batch_id: int = 0, ledger: str | None = None, ident: str = "event_id") -> tuple[int, bool]:
    """Call ``send(messages)`` up to ``max_attempts`` times, waiting between attempts.

    ``send`` raises if nothing can be counted as sent, or returns the
    messages that failed (None or no rows: all are sent); only those go into
    the next attempt.  What is left after the last one is written to
    ``<dead_letter_path>/batch_id=N``, replacing what an earlier run of the
    same batch wrote there; without a path it raises ``DeliveryError``, so
    that the batch is run again.  Returns (attempts made, all sent).

    With a ``ledger``, every attempt writes which messages (by ``ident``) it
    tried and delivered, under ``<ledger>/batch_id=N/attempt=A``.  A batch that
    died half-way takes up where its ledger ends: what is delivered is not
    sent again, and the attempts go on counting.  Only the attempt that was
    under way is repeated (at least once).
    """
    n, spark = max_attempts(max_retries), batch.sparkSession
    left, error, first = batch, None, 1
    if ledger is not None and (noted := _noted(spark, ledger, batch_id)) is not None:
        first = noted.agg(F.max("attempt")).first()[0] + 1
        left = batch.join(noted.where("delivered").select(ident), ident, "left_anti")
        if left.isEmpty():
            return first - 1, True
    for attempt in range(first, n + 1):
        if attempt > 1:
            sleep(retry_interval_ms / 1000.0)
        failed = left
        try:
            failed, error = send(left), None
        except Exception as e:  # noqa: BLE001 - any send failure is retried
            error = e
        if ledger is not None:  # what failed is worked out once, and read from the ledger from then on
            failed = _note(left, failed, f"{ledger}/batch_id={batch_id}/attempt={attempt}", attempt, ident)
        if failed is None or failed.isEmpty():
            return attempt, True
        left = failed
    if dead_letter_path is None:
        raise DeliveryError(f"not delivered after {n} attempts") from error
    left.withColumn("last_attempt", F.lit(n)).write.mode("overwrite").parquet(f"{dead_letter_path}/batch_id={batch_id}")
    return n, False


def delivery_status(ledger: DataFrame, ident: str = "event_id") -> DataFrame:
    """Per message, from the ledger, how many attempts it took and whether it was delivered."""
    return ledger.groupBy(F.col(ident).alias("msg_id")).agg(
        F.max("attempt").cast("int").alias("attempts_used"), F.max("delivered").alias("delivered"))


def read_ledger(spark, ledger: str) -> DataFrame:
    """Every attempt of every batch: (ident, attempt, delivered, batch_id)."""
    return spark.read.option("recursiveFileLookup", "false").parquet(ledger)
