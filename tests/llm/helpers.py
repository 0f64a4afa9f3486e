"""Small tables and plain Python for the tests of the training-data operators."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def docs(spark, rows):
    """Documents from (doc_id, text[, source[, lang]]) rows."""
    full = [(r[0], r[1], (*r, None, None)[3], (*r, None)[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    """Nulls, empty and very long texts, repeated rows, ties."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choices(vocabulary, k=6000))
    same = "the quick brown fox jumps over the lazy dog and runs far away\nsecond line of the very same text"
    return [
        (1, None, None),
        (2, "", "a"),
        (3, " \n\t ", "a"),
        (4, long, "b"),
        (5, same, "b"),
        (5, same, "b"),
        (6, same, "a"),
        (None, same, None),
        (None, "a text without an id, of some words and no more", "a"),
        (7, "one", "b"),
        (8, "Ünïcode wörds — and, punctuation! of some kind", "b"),
    ]


def odd(spark):
    """The same with extra columns whose names operators use inside."""
    names = ["h", "node", "key", "_row", "row", "spans", "label", "score", "_own", "column 3", "a.b"]
    df = docs(spark, odd_rows())
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(name) for i, name in enumerate(names)])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
