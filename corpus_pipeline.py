"""The corpus pipeline: documents go through the stages in order; each stage's result is stored and read by the next.

Near copies are decided row by row: of each group one row stays, the one with the smallest id, of several rows of that id
the one with the smallest digest of its text, then the first stored.  Rows without an id come after all ids.  Null and
empty texts go through the stages like any other: they have no toxic passage, whatever quality the classifier gives
them, no near copy, no benchmark item and no tokens.  The first four stages return the columns of their input, whatever
their names; the last one drops the text, and a column with a name of its results goes on under that name with ``_``.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provena.llm.bpe import bpe_encode
from provena.llm.common import stored, training_rows
from provena.llm.decontam import mark_items
from provena.llm.jaccard import jaccard_components
from provena.llm.quality import fit_quality, score_quality
from provena.llm.queries import table, tokenizer_path
from provena.llm.toxicity import fit_toxicity, score_toxicity

TOXIC_FROM = 0.5
QUALITY_FROM = 0.3
SHINGLE, SIMILAR = 5, (80, 100)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the input does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is under ``TOXIC_FROM``."""
    model = fit_toxicity(docs, training_rows(table(spark, sf_dir, "labels")))
    score, passages = _free(docs, "toxicity"), _free(docs, "passages")
    return score_toxicity(docs, model, name=score, passages_name=passages).where(F.col(score) < TOXIC_FROM).select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality is ``QUALITY_FROM`` or more."""
    model = fit_quality(docs, training_rows(table(spark, sf_dir, "labels")))
    score = _free(docs, "quality")
    return score_quality(docs, model, name=score).where(F.col(score) >= QUALITY_FROM).select(*docs.columns)


def with_rows(docs: DataFrame, name: str) -> DataFrame:
    """All columns plus a name for each row that stays the same however often it is read: its file and its place there.
    Rows that are not read from files are stored first."""
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).alias(name)
    try:
        return docs.select(*(docs[f"`{c}`"] for c in docs.columns), place)
    except AnalysisException:
        docs = stored(docs, "pipeline-rows")
        return docs.select(*(docs[f"`{c}`"] for c in docs.columns), place)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id, then the smallest digest of its text, then the
    smallest place in the stored input.  Rows without words are no copies, and stay."""
    key, at = _free(docs, "near_key"), _free(docs, "near_row")
    rows = with_rows(docs, at)
    keyed = rows.withColumn(key, F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"),
                                          F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("digest"), F.col(at).alias("row")))
    linked = jaccard_components(keyed.select(F.col(key).alias("doc_id"), "text"), SHINGLE, *SIMILAR)
    gone = stored(linked.where("doc_id <> component_id").select(F.col("doc_id.row").alias(at)), "near-copies", small=True)
    return rows.join(gone, at, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = _free(docs, "benchmark_items")
    return mark_items(docs, table(spark, sf_dir, "benchmark"), name=items).where(F.size(items) == 0).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns but for the text, plus token_ids (binary), n_tokens and decoded_sha256, the decoded text's
    digest.  A column of the input that has one of these names, or a name that the encoder uses, keeps its place under
    that name with ``_`` behind it."""
    own = {"token_ids", "n_tokens", "decoded_sha256"}
    taken = {c.lower() for c in docs.columns} | own
    kept = docs
    for c in docs.columns:
        if c.lower() in own:
            new = next(c + "_" * k for k in range(1, len(taken) + 2) if (c + "_" * k).lower() not in taken)
            taken.add(new.lower())
            kept = kept.withColumnRenamed(c, new)
    decoded = _free(kept, "decoded")
    out = bpe_encode(kept, tokenizer_path(), decoded=decoded).drop("text")
    return out.withColumn("decoded_sha256", F.sha2(F.col(decoded).cast("binary"), 256)).drop(decoded)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_poor),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", tokenise),
]

#: SQL cannot express the trained classifiers; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
