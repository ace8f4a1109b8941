"""Small tables and brute-force forms for the tests of the package."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, source="s", lang="en", first=0):
    rows = [(first + i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rows = [
        (None, "some words without an id here", None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \n\t ", None, "a", 4),
        (4, "tie of equal words one two", "en", "a", 26), (5, "tie of equal words one two", "en", "a", 26), (5, "tie of equal words one two", "en", "a", 26),
        (6, "word " * 30_000, "en", "b", 150_000), (7, "x" * 3_000, "en", "b", 3_000), (8, "日本語 🙂 é ▁ \u0001", "ja", "b", 12),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("score", "label", "word", "size", "chunk", "part", "class_id", "bucket", "target", "terms", "place", "n", "_key", "_row", "_cuts", "key", "digest", "text_key", "told", "row", "cuts", "cut", "words", "a.b", "a`b"):
        frame = frame.withColumn(name, F.lit("extra"))
    return frame


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def random_texts(seed, n, words=(0, 60), vocabulary=400):
    draw = random.Random(seed)
    known = ["".join(draw.choice("abcdefghijklmnopqrst") for _ in range(draw.randint(1, 9))) for _ in range(vocabulary)]
    return [" ".join(draw.choice(known) for _ in range(draw.randint(*words))) for _ in range(n)]
