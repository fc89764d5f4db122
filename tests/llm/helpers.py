"""Small tables for the tests of the operators on text."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("score", T.StringType()), T.StructField("node", T.StringType()),
    T.StructField("spans", T.StringType()), T.StructField("key", T.IntegerType()),
    T.StructField("_doc", T.IntegerType()), T.StructField("h", T.IntegerType()),
    T.StructField("length", T.StringType()),
])
LABELS = "doc_id long, quality int, toxic int, score double, text string"
ITEMS = "item_id long, text string, doc_id long"


def documents(spark, rows):
    """rows: (doc_id, text), or (doc_id, text, lang, source)."""
    rows = [(*r, *(["en", "s0"] if len(r) == 2 else [])) for r in rows]
    return spark.createDataFrame(
        [(*r, None if r[1] is None else len(r[1]), "x", "y", "z", 1, 2, 3, "w") for r in rows], DOCS)


def prose(seed, n, words=400):
    """Made-up text from a fixed list of made-up words."""
    draw = random.Random(seed)
    vocabulary = ["".join(random.Random(i).choices("abcdefghiklmnoprstuvw", k=2 + i % 7))
                  for i in range(words)]
    return " ".join(draw.choices(vocabulary, k=n))


LONG = prose(99, 30_000)
EDGES = [
    (1, None, None, None), (2, "", "en", "s0"), (3, "  \n\t ", "en", "s1"), (4, "one", "en", "s0"),
    (5, "1234 !! ??", None, "s0"), (6, prose(6, 300), "en", "s2"), (6, prose(6, 300), "en", "s2"),
    (6, prose(7, 50), "en", "s2"), (8, prose(6, 300), "de", "s1"), (None, prose(9, 80), "en", "s0"),
    (None, None, None, None), (10, LONG, "en", "s0"), (11, "Grüße, ñandú 漢字 😀 " * 9, "de", None),
    (12, "a\0b " * 120, "en", "s0"), (13, "ab " * 500, "en", "s0"),
]
