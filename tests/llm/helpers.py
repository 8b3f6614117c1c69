"""Small documents with the awkward cases every operator must define."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside or add themselves
    T.StructField("size", T.StringType()), T.StructField("doc", T.StringType()), T.StructField("tag", T.StringType()),
    T.StructField("row", T.StringType()), T.StructField("slot", T.StringType()), T.StructField("key", T.StringType()),
])


def words(seed, n, letters="abcdefghij"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows(texts, langs=None, sources=None, ids=None):
    out = []
    for i, t in enumerate(texts):
        out.append((
            ids[i] if ids else i, t, langs[i] if langs else "en", sources[i] if sources else "s",
            None if t is None else len(t), "x", None, "t", "r", "9", "k",
        ))
    return out


def frame(spark, data, parts=3):
    return spark.createDataFrame(data, SCHEMA).repartition(parts) if data else spark.createDataFrame([], SCHEMA)


def awkward():
    """Null, empty, blank, short, long, repeated and tied texts; null ids, languages and sources."""
    shared = words(7, 60)
    texts = [
        words(1, 80) + " " + shared, shared + "\n" + words(2, 80), None, "", " \t\n", "one", words(3, 60), words(3, 60),
        words(4, 5000) + " " + shared + " " + words(5, 5000), "été \u0085x  " + words(6, 50), "日本語 " * 50, "a " * 200, "a " * 200,
        words(3, 60), "\x00\x1f" + words(8, 70), words(9, 40) + "\n" + words(9, 40), "x" * 3000,
    ]
    ids = list(range(len(texts)))
    ids[7] = 6  # the same id and text again
    ids[13] = None
    langs = ["en"] * len(texts)
    langs[4] = None
    sources = ["a", "b", None] * 6
    return rows(texts, langs, sources[: len(texts)], ids)
