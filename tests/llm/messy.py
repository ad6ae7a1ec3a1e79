"""Rows that every operator has to stand: nulls, empty and very long texts, repeats."""

import random

SCHEMA = (
    "doc_id long, text string, source string, key string, size string, shard int, "
    "name string, score string, spans int, _0 string, k1 string, n int, lang string"
)
LONG = " ".join(f"w{i % 7001}" for i in range(60_000))
COPY = "the same words stand here in every copy of this one short document again"


def row(doc_id, text, source="s"):
    return (doc_id, text, source, "k", "big", 7, "n", "high", 3, "zero", "one", 1, "en")


ROWS = [
    row(1, None),
    row(2, ""),
    row(3, " \n\t "),
    row(4, "one"),
    row(5, COPY),
    row(6, COPY),
    row(6, COPY),
    row(7, LONG),
    row(8, "äöü ß 😀 łódź Straße"),
    row(9, COPY, None),
    row(None, "a text without a key that has a few words of its own here"),
    row(10, "key ten has one text of some words that are its own"),
    row(10, "key ten has another text with other words in it than before"),
]


def messy(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def prose(n, seed=0, vocabulary=2000):
    random_ = random.Random(seed)
    return " ".join(f"v{random_.randrange(vocabulary)}" for _ in range(n))


def as_rows(frame, *columns):
    """Rows as sorted text, so that nulls compare."""
    return sorted(map(repr, frame.select(*columns).collect()))
