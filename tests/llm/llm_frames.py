"""Small tables with every odd case: nulls, empty and long texts, repeats, clashing names."""

from pyspark.sql import types as T

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet consectetur " * 4000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "b", 1),
    (2, "The quick brown fox jumps over the lazy dog", "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog", "en", "a", 1),
    (3, "", None, "a", None),
    (4, None, "en", None, 0),
    (5, " \t\n ", "en", "", 3),
    (6, LONG, "la", "b", len(LONG)),
    (7, "Ünïcode wörds — été, ǅ 😀😀 don't WE'LL 12 345 <|endoftext|> x", "fr", "c", 9),
    (None, "no id at all here", "en", "c", 2),
    (8, "w" * 30_000, "en", "a", 1),
    (9, "a b", "en", "b", 3),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOC)


def crowded(docs):
    """The same rows with columns named like those that operators add."""
    from pyspark.sql import functions as F

    names = ("key", "size", "fp", "tokens", "decoded", "score", "shard", "slot", "rate", "copies", "label", "node", "part", "row", "at", "a", "b")
    return docs.select("*", *[F.lit("x").alias(name) for name in names])


def empty(spark, schema):
    return spark.createDataFrame([], T._parse_datatype_string(schema))
