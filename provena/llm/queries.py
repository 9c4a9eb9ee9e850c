"""The registered query of each operator, and its DuckDB twin where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The tokenizer file of the contracts; a parameter of the operators.
TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every whole text, decode the ids, digest both."""
    from .bpe import bpe_encode
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe_encode(docs, tokenizer_path(), decoded="decoded")
    return out.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of all texts to token files, read the files back, digest the ids of each document."""
    from .tokenfile import read_token_files, token_folder, write_token_files
    folder = token_folder(spark)
    manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer_path(), folder)
    return read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of every text and its edited text, and their likeness."""
    from .fingerprint import fingerprint_neighbours
    out = fingerprint_neighbours(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      F.lower(F.hex("fingerprint")).alias("fingerprint"),
                      F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the pages to WARC archives, read them back."""
    from ..session import scratch_path
    from .warc import read_archives, write_archives
    folder = scratch_path(spark, "warc")
    files = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(files, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op4_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, lower(sha1(b)) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM m
"""


@query
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles have a Jaccard similarity of at least 0.9."""
    from .jaccard import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


ORACLE["op8_ngram_jaccard"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n p ON p.doc_id = a.doc_id JOIN n q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.x = d.doc_id GROUP BY d.doc_id, n.n
"""


@query
def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code length of every text under a byte model of the training texts, beside a word-count baseline."""
    from .ppm import ppm_score
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return ppm_score(docs.withColumn("held", held))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document holds, give or take a tenth of edits."""
    from .decontam import contamination
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def held_out(fold: int = 5):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % fold == 0


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learnt from the labels outside the held-out fold."""
    from .common import training_rows
    from .toxicity import fit_toxicity, score_toxicity
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, training_rows(table(spark, sf_dir, "labels")))
    return score_toxicity(docs, model).select(
        "doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"), F.size("passages").alias("n_passages"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learnt from the labels outside the held-out fold."""
    from .common import training_rows
    from .quality import fit_quality, score_quality
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, training_rows(table(spark, sf_dir, "labels")))
    return score_quality(docs, model).select(
        "doc_id", held_out().alias("held_out"), F.col("quality").alias("score"),
        F.when(F.col("quality") >= 0.3, 1).otherwise(0).alias("predicted"))


@query
def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence paragraphs of every text that a template confirms."""
    from .license import fit_licences, scan_licences
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licences(docs, fit_licences(docs)).where("confirmed")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each anchor and positive, the best rows of other labels within the window of scores."""
    from .hardneg import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label)


ORACLE["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS rank,
         id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    from .lexsearch import search
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_lexical_search"] = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w,
         row_number() OVER () AS r
  FROM documents WHERE text IS NOT NULL),
d AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM t WHERE len(w) > 0),
c AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM t) GROUP BY r, term),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY item_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, c WHERE term IN (SELECT term FROM q) GROUP BY term),
s AS (
  SELECT item_id, d.doc_id, d.r,
         CAST(sum(q.times * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * d.n * c.nd) // c.l)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d ON d.r = tf.r, c
  GROUP BY item_id, d.doc_id, d.r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


@query
def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by the paths its host's pages agree on."""
    from .maintext import main_text
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "path")
