"""Small tables with the cases every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("Score", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("token_ids", T.StringType()),
                     T.StructField("toxicity", T.StringType()), T.StructField("quality", T.DoubleType()), T.StructField("block", T.LongType())])

PASSAGE = "the quick brown fox jumps over the lazy dog while nine wizards box with five dozen liquor jugs near the old mill "


def odd_rows():
    """Nulls, empty and very long texts, white space only, ties, repeated rows, a missing id."""
    texts = [None, "", " \n\t ", "a", "İstanbul ΟΔΟΣ é <|endoftext|> x", "word " * 30_000, PASSAGE * 3, PASSAGE * 3,
             PASSAGE + "entirely other words follow here and nowhere else at all", "\x1c\x85 　 ideographic 漢字 😀😀"]
    rows = [(i, t, None, "s", None, "old", "old", None, i) for i, t in enumerate(texts)]
    return [*rows, rows[6], (None, PASSAGE * 3, "en", None, 1, None, None, 0.5, None), (None, None, None, None, None, None, None, None, None)]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
