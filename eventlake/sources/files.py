"""File sources: JSON lines, JSON-array documents, rotating batch files.

Listing a folder is metadata work done by Spark's file index; file contents
are only read by executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import as_items, json_wrappers

# Batch files are named batch_NN.json; the slot changes every
# ten minutes.
BATCH_GLOB = "batch_*.json"
SLOT_MINUTES = 10


# ---------------------------------------------------------------------------
# S1: one JSON document per line
# ---------------------------------------------------------------------------


def read_lines(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """``value: string`` per line. Blank lines are kept (they dead-letter)."""
    reader = spark.readStream if stream else spark.read
    return reader.options(**options).format("text").load(path)


# ---------------------------------------------------------------------------
# S3/S4: a document holding a JSON array of events (or a single object)
# ---------------------------------------------------------------------------


def read_documents(spark: SparkSession, path: str, glob: str | None = None, max_bytes: int | None = None) -> DataFrame:
    """``(path, value)`` with one row per file, the whole text in ``value``.

    A file is one JSON document, so it is read by one task; batch files are
    small by contract (tens of events). Use :func:`read_lines` for large
    newline-delimited inputs, and ``sources.arrays.read_arrays`` where array
    files may be large. Files of more than ``max_bytes`` are left out, unread.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.text(path, wholetext=True)
    if max_bytes is not None:
        files = files.where(F.col("_metadata.file_size") <= max_bytes)
    return files.select(F.col("_metadata.file_path").alias("path") if max_bytes is not None else F.input_file_name().alias("path"), "value")


def strict_value(text: Column) -> Column:
    """``text`` as a VARIANT where it is exactly one strict JSON value, else NULL."""
    as_element, as_member = json_wrappers(text)
    items = as_items(as_element)
    return F.when(as_member.isNotNull() & (F.size(items) == 1), items[0])


def lenient_value(text: Column, kind: str) -> Column:
    """``text`` as ``kind`` where the JSON reader takes it for one value (``NaN`` and the like included), else NULL."""
    items = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{kind}>")
    as_member = F.from_json(F.concat(F.lit('{"r":'), text, F.lit("}")), f"struct<r:{kind}>")
    return F.when((F.size(items) == 1) & as_member["r"].isNotNull(), items[0])


def explode_documents(docs: DataFrame, value: str = "value", limit: int | None = None) -> DataFrame:
    """One row per event of each document: the input columns, ``pos`` and ``value``.

    An array root yields its elements in order, each as JSON text; an object
    (or any other single value) root is a one-element list. A document that is
    strict JSON is split as a VARIANT, so its elements keep their JSON types.
    One that is not (a ``NaN`` or ``Infinity`` member somewhere) is split by
    the JSON reader instead, which accepts those tokens: they come back as
    strings in the one element that holds them, and cost no other event (an
    object root with such a member is one message, and dead-letters). Text
    that neither can read yields itself once, so the parser dead-letters it (or
    fails, in ``fail`` mode). Either way elements are re-serialised, so
    ``raw_message`` of a bad element is its JSON text, not its source bytes.

    ``limit`` keeps the first *n* events of each document; a falsy limit
    keeps all.
    """
    text = F.col(value)
    doc = strict_value(text)
    items = F.try_variant_get(doc, "$", "array<variant>")
    lenient = F.when(doc.isNull(), lenient_value(text, "array<string>"))
    # a NULL element is a JSON null; a reading without any element is no reading
    lenient = F.transform(lenient, lambda x: F.coalesce(x, F.lit("null")))
    loose = F.when(F.size(lenient) > 0, lenient).otherwise(F.array(text))
    texts = (
        F.when(doc.isNull(), loose)
        .when(items.isNull(), F.array(F.to_json(doc)))
        .otherwise(F.transform(items, lambda x: F.to_json(x)))
    )
    others = [c for c in docs.columns if c != value]
    out = docs.select(*others, F.posexplode(texts).alias("pos", value))
    if limit:
        out = out.where(F.col("pos") < limit)
    return out


# ---------------------------------------------------------------------------
# S5/L2: batch discovery and rotating selection
# ---------------------------------------------------------------------------


def rotation_slot(ts: Column, n_files: Column | int) -> Column:
    """1-based file number for a run at ``ts``: ``(minute // 10) % n + 1``.

    Only minutes 0-59 exist, so with ten files slots 7-10 are never chosen;
    the formula is kept as specified.
    """
    n = F.lit(n_files) if isinstance(n_files, int) else n_files
    return (F.pmod(F.floor(F.minute(ts) / SLOT_MINUTES), n) + 1).cast("bigint")


def list_batches(spark: SparkSession, folder: str, glob: str = BATCH_GLOB) -> DataFrame:
    """Batch files under ``folder`` with the number in their name: (batch_num, path).

    File contents are not read (only the ``path`` column of the binary-file
    source is selected), and the listing stays a DataFrame.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path")
    number = F.regexp_extract("path", r"_([0-9]+)\.[^/]*$", 1).try_cast("bigint")
    return files.select(number.alias("batch_num"), "path").where(F.col("batch_num").isNotNull())


def pick_batch(spark: SparkSession, folder: str, at, glob: str = BATCH_GLOB) -> str:
    """Path of the batch file a run at ``at`` (a datetime) processes: the one that carries the slot's number.

    The slot rotates over as many numbers as there are files. Raises when the
    folder has no batch file, or none with that number.
    """
    listing = list_batches(spark, folder, glob)
    n = listing.count()
    if not n:
        raise FileNotFoundError(f"no {glob} files under {folder}")
    slot = (at.minute // SLOT_MINUTES) % n + 1
    found = listing.where(F.col("batch_num") == slot).agg(F.min("path")).first()[0]
    if found is None:
        raise FileNotFoundError(f"no batch file number {slot} under {folder}")
    return found


def pick_batch_folder(spark: SparkSession, folder: str, at) -> str:
    """As :func:`pick_batch` where a batch is a folder of files (``batch_03`` or ``batch=3``) with a JSON document a line."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    number = F.regexp_extract("path", r"/batch[_=]([0-9]+)/[^/]*$", 1).try_cast("bigint")
    listing = files.select(number.alias("batch_num"), F.regexp_replace("path", "/[^/]*$", "").alias("path"))
    numbers = listing.where(F.col("batch_num").isNotNull()).groupBy("batch_num").agg(F.min("path").alias("path"))
    n = numbers.count()
    if not n:
        raise FileNotFoundError(f"no batch folders under {folder}")
    slot = (at.minute // SLOT_MINUTES) % n + 1
    found = numbers.where(F.col("batch_num") == slot).first()
    if found is None:
        raise FileNotFoundError(f"no batch folder number {slot} under {folder}")
    return found["path"]


def bounded(df: DataFrame, max_messages: int | None) -> DataFrame:
    """A pull of at most ``max_messages`` messages (batch form of a bounded pull)."""
    return df.limit(max_messages) if max_messages else df
