"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of byte n-grams (2 and 3 bytes of the lower-cased
text, ASCII non-letters read as spaces), hashed to ``DIM`` places, with
log-scaled counts and unit length. For each language, spherical k-means groups
the vectors of a bounded training sample (at most ``PER_LANGUAGE`` documents,
those with the least id hash) into up to ``CENTROIDS`` centroids. A text gets
the language of the centroid with the highest cosine, over its whole text.

Distance-based rejection: ``rejected`` is true where the best cosine lies below
the language's threshold, half of the ``QUANTILE`` quantile of its own training
cosines; texts without a letter, and null texts, get ``und``, score 0, and are
rejected. A few letters say little, so texts of under ``MIN_LETTERS`` bytes of
letters are not rejected by distance.

Defined results: a null id is never learned from and not held out; rows with a
null language are never learned from; with nothing to learn every row is
``und`` and only texts without a letter are rejected; ties go to the first language in code-point order; repeated rows get
equal results. The model's size is bounded by the number of languages; its
clustering runs in one Spark task per language, on the bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as WN
from pyspark.sql.pandas.types import to_arrow_schema

from .common import U64, cut, mix

DIM = 4096
PER_LANGUAGE = 400
CENTROIDS = 4
ROUNDS = 12
NOISE = 2  # the quantile is divided by it: above what letter noise and base64 lines reach, below what clean texts do
QUANTILE = 0.01
MIN_LETTERS = 32
UNKNOWN = "und"

# ASCII bytes that are no letter read as a space; bytes of other letters stay.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def _counts(raw: np.ndarray, dim: int) -> tuple[np.ndarray, int]:
    """Hashed 2- and 3-byte counts of one text and its number of letter bytes."""
    total, letters = np.zeros(dim, np.int64), 0
    for lo in range(0, len(raw), 1 << 20):  # pieces overlap by two bytes: no n-gram is lost
        body = _FOLD[raw[max(0, lo - 2) : lo + (1 << 20)]]
        body = body[~((body == 32) & (np.concatenate([[32], body[:-1]]) == 32))]  # one space between words
        letters += int((body != 32).sum())
        x = np.concatenate([[32], body, [32]]).astype(np.uint64)
        two = x[:-1] << U64(8) | x[1:]
        three = two[:-1] << U64(8) | x[2:]
        for gram in (two, three | U64(1 << 24)):
            total += np.bincount((mix(gram) % U64(dim)).astype(np.int64), minlength=dim)
    return total, letters


def _vector(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=-1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    """Lower-cased bytes of each text (null: empty)."""
    for text in column:
        text = text.as_py()
        yield np.frombuffer(text.lower().encode() if text else b"", dtype=np.uint8)


def _vectors(dim: int):
    def run(batches):
        for batch in batches:
            rows = [_vector(_counts(raw, dim)[0]).tobytes() for raw in _texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(rows, pa.binary())], names=["lang", "vector"])

    return run


def _frequencies(dim: int):
    """Document frequency of every place: one partial vector per task."""

    def run(batches):
        df, n = np.zeros(dim, np.int64), 0
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.float32).reshape(-1, dim)
            df += (rows > 0).sum(axis=0)
            n += len(rows)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([df.tobytes()], pa.binary())], names=["n", "df"])

    return run


def _cluster(idf: np.ndarray, k: int, rounds: int, quantile: float):
    """Spherical k-means over one language's sample; farthest-first start, so reruns agree."""

    def run(group: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(sorted(group.column("vector").to_pylist())), np.float32).reshape(-1, len(idf))
        rows = _unit(rows * idf)
        rows = rows[np.linalg.norm(rows, axis=1) > 0]
        if not len(rows):
            return pa.table({"lang": pa.array([], pa.string()), "least": pa.array([], pa.float64()), "centroids": pa.array([], pa.binary())})
        centroids = _unit(rows.mean(axis=0, keepdims=True))
        while len(centroids) < min(k, len(rows)):
            far = (rows @ centroids.T).max(axis=1).argmin()
            centroids = np.concatenate([centroids, rows[far : far + 1]])
        for _ in range(rounds):
            nearest = (rows @ centroids.T).argmax(axis=1)
            held = [rows[nearest == i].mean(axis=0) if (nearest == i).any() else centroids[i] for i in range(len(centroids))]
            centroids = _unit(np.stack(held))
        best = (rows @ centroids.T).max(axis=1)
        least = float(np.quantile(best, quantile)) / NOISE
        return pa.table({
            "lang": pa.array([group.column("lang")[0].as_py()], pa.string()), "least": pa.array([least]),
            "centroids": pa.array([centroids.astype(np.float32).tobytes()], pa.binary()),
        })

    return run


@dataclass
class Model:
    languages: list[str]  # of each centroid
    least: np.ndarray  # rejection threshold of each centroid's language
    centroids: np.ndarray
    idf: np.ndarray


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    dim: int = DIM, per_language: int = PER_LANGUAGE, k: int = CENTROIDS, rounds: int = ROUNDS, quantile: float = QUANTILE,
) -> Model:
    """Learns from rows with an id, a text and a language; at most ``per_language`` of each language."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.dropna(subset=["id", "text", "lang"]).withColumn("place", F.abs(F.xxhash64("id") % (1 << 30)))
    count = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not count:
        return Model([], np.zeros(0), np.zeros((0, dim), np.float32), np.zeros(dim, np.float32))
    # A hash range that surely holds the sample of each language, then the exact least hashes of it.
    near = {k: int((1 << 30) * min(1.0, (1.5 * per_language + 100) / n)) for k, n in count.items()}
    order = WN.Window.partitionBy("lang").orderBy("place", "id")
    ids = rows.select("id", "lang", "place").filter(F.col("place") <= _of_language(near))
    chosen = ids.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_language)
    last = {r.lang: r.place for r in chosen.groupBy("lang").agg(F.max("place").alias("place")).collect()}
    sample = rows.filter(F.col("place") <= _of_language(last)).select("lang", "text")
    vectors = cut(sample.mapInArrow(_vectors(dim), "lang string, vector binary"), "language-sample")
    df, n = np.zeros(dim, np.int64), 0
    for part in vectors.mapInArrow(_frequencies(dim), "n long, df binary").collect():
        df, n = df + np.frombuffer(part.df, np.int64), n + part.n
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    fitted = vectors.groupBy("lang").applyInArrow(_cluster(idf, k, rounds, quantile), "lang string, least double, centroids binary")
    found = sorted(((r.lang, r.least, np.frombuffer(r.centroids, np.float32).reshape(-1, dim)) for r in fitted.collect()), key=lambda x: x[0])
    if not found:
        return Model([], np.zeros(0), np.zeros((0, dim), np.float32), idf)
    return Model(
        [lang for lang, _, c in found for _ in c], np.array([least for _, least, c in found for _ in c]),
        np.concatenate([c for *_, c in found]), idf,
    )


def _of_language(values: dict) -> Column:
    """A literal by language; one entry per language, as in the model itself."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in sorted(values.items()) for x in kv]), F.col("lang"))


def _predict(model, dim: int, min_letters: int, schema: pa.Schema):
    def run(batches):
        languages, least = model.value.languages, model.value.least
        weights = (model.value.centroids * model.value.idf[None, :]).T.copy() if languages else None
        for batch in batches:
            texts = batch.column("text")
            pred, score, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            if not languages:  # nothing to be far from
                rejected = [not any(map(str.isalpha, x or "")) for x in texts.to_pylist()]
            for lo in range(0, len(texts) if languages else 0, 256):
                rows, letters = np.zeros((min(256, len(texts) - lo), dim), np.float32), []
                for i, raw in enumerate(_texts(texts.slice(lo, 256))):
                    counts, n = _counts(raw, dim) if len(raw) else (0, 0)
                    rows[i] = _vector(counts)
                    letters.append(n)
                norm = np.linalg.norm(rows * model.value.idf, axis=1)
                cosine = (rows @ weights) / np.where(norm > 0, norm, 1)[:, None]
                best = cosine.argmax(axis=1)
                for i, (b, n) in enumerate(zip(best.tolist(), letters, strict=True)):
                    text = texts[lo + i].as_py()
                    if n and any(map(str.isalpha, text)):
                        pred[lo + i] = languages[b]
                        score[lo + i] = float(min(1.0, max(0.0, cosine[i, b])))
                        rejected[lo + i] = n >= min_letters and score[lo + i] < least[b]
            columns = [c for name, c in zip(batch.schema.names, batch.columns, strict=True) if name != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(pred), pa.array(score), pa.array(rejected)], schema=schema)

    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text", min_letters: int = MIN_LETTERS) -> DataFrame:
    """Every row of ``docs`` packed as ``row`` with lang_pred, score and rejected."""
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    out = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("lang_pred", T.StringType()),
                        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    shared = spark.sparkContext.broadcast(model)
    return rows.mapInArrow(_predict(shared, len(model.idf), min_letters, to_arrow_schema(out)), out)
