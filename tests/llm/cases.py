"""Small inputs that every operator has to take: nulls, empty and long texts, repeats, clashes."""

from pyspark.sql import functions as F

LONG = "The quick brown fox, it jumps over the lazy dog no. %d. "
TEXTS = [
    (1, "A plain sentence of words that stands here alone.", "en", "src1"),
    (2, "A plain sentence of words that stands here alone.", "en", "src1"),
    (2, "A plain sentence of words that stands here alone.", "en", "src1"),
    (3, None, "en", "src2"),
    (4, "", None, None),
    (5, " \t\n", "de", "src0"),
    (6, "".join(LONG % i for i in range(4000)), "en", "src0"),
    (7, "Größe, Straße und Öl: <|endoftext|> zählt  nicht\n   mehr.", "de", "src0"),
    (8, "word", "fr", ""),
    (None, "no id", None, "src3"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def documents(spark, rows=TEXTS):
    return spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))


def clashing(df):
    """Extra columns with names that operators use themselves."""
    names = ("_key", "fp", "id", "label", "score", "epoch", "whole", "cut", "_range", "n", "_found", "component_id", "held_out")
    return df.withColumns({c: F.lit("x") for c in names if c not in df.columns})


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
