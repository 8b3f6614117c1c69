"""Publish events as JSON messages (one object per message)."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import path_exists, remove_path

# Fixed value: the largest message a topic takes, in bytes.
MAX_MESSAGE_BYTES = 10_000_000
NOT_ENCODABLE, TOO_LARGE = "NOT_ENCODABLE", "TOO_LARGE"


def encode(df: DataFrame, columns: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``value``: each row as one JSON object; NULL fields are written as null.

    ``keep`` columns are carried beside the message (not encoded).
    """
    cols = columns or [c for c in df.columns if c not in keep]
    return df.select(
        F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}).alias("value"),
        *keep,
    )


def first_events(df: DataFrame, limit: int | None, *order_by: str) -> DataFrame:
    """The first ``limit`` events in source order; a falsy limit means all.

    A DataFrame has no order of its own, so a limit needs the columns that hold
    the source order (for a document's events, the ``pos`` that
    ``sources.files.explode_documents`` gives).
    """
    if not limit:
        return df
    if not order_by:
        raise ValueError("a limit needs order_by: the columns that hold the source order")
    return df.orderBy(*order_by).limit(limit)


def publish(df: DataFrame, path: str, limit: int | None = None, order_by: tuple[str, ...] | str = (),
            columns: list[str] | None = None) -> None:
    """Append the events of ``df`` as JSON lines under ``path`` (an arrival folder).

    With ``limit`` the first events by ``order_by`` are sent. ``columns`` are
    the members to encode (default: all but the ``order_by`` column ``pos``).
    A streaming reader of that folder (``sources.files.read_lines(stream=True)``)
    picks each new file up exactly once.
    """
    order = (order_by,) if isinstance(order_by, str) else tuple(order_by)
    df = first_events(df, limit, *order)
    encode(df, columns or [c for c in df.columns if c != "pos" or "pos" not in order]).write.mode("append").text(path)


def outcomes(df: DataFrame, columns: list[str] | None = None, keep: tuple[str, ...] = (),
             max_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """Every event encoded, with the reason why it cannot be sent: ``value``, ``failure`` (null: none) and ``keep``.

    A message has to be one JSON value again when it is read (text that is no UTF-8 and numbers that are no JSON are
    not) and no larger than ``max_bytes``. A failed event costs only itself.
    """
    cols = columns or [c for c in df.columns if c not in keep]
    texts = [F.coalesce(F.is_valid_utf8(c), F.lit(True)) for c in cols if df.schema[c].dataType.typeName() == "string"]
    told = df.withColumn("_text", reduce(and_, texts, F.lit(True)))
    out = encode(told, cols, (*keep, "_text"))
    unreadable = F.try_parse_json("value").isNull() | ~F.col("_text")  # the encoder would replace bytes that are no text
    failure = F.when(unreadable, NOT_ENCODABLE).when(F.octet_length("value") > max_bytes, TOO_LARGE)
    return out.withColumn("failure", failure).drop("_text")


def publish_once(df: DataFrame, path: str, name: str, columns: list[str] | None = None, keep: tuple[str, ...] = (),
                 max_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """Publish the events of ``df`` under ``path`` as the batch ``name``, once; returns the outcome of every event.

    Messages and failures are written below ``path/_staging`` (which readers of the arrival folder do not see) in one
    pass. When all are there, one rename of the messages' folder to ``path/name`` makes them visible, together. A batch
    that is there already is not sent again, so a retry under the same name leaves each message once, wherever the
    first try stopped. The rename is atomic in file systems that rename folders (local, HDFS and the like); on a plain
    object store a retry is still without repeats, but a reader may see a part first.

    Returns ``status`` ('published' or 'failed'), ``reason`` and the ``keep`` columns, from what was stored.
    """
    spark = df.sparkSession
    staging, target = f"{path}/_staging/{name}", f"{path}/{name}"
    if not path_exists(spark, f"{staging}/_SUCCESS") and not path_exists(spark, target):
        coded = outcomes(df, columns, keep, max_bytes)
        # failed values may be no text at all; the event is told by its keep columns
        rows = coded.select(F.col("failure").isNotNull().alias("failed"), F.when(F.col("failure").isNull(), F.col("value")).alias("value"), "failure", *keep)
        rows.write.mode("overwrite").parquet(staging)
    stored = spark.read.parquet(staging)
    if not path_exists(spark, target):
        ready = f"{path}/_staging/{name}.messages"
        remove_path(spark, ready)
        stored.where("NOT failed").select("value").write.text(ready)
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(target)
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(ready), folder):
            raise FileExistsError(target)
    status = F.when(F.col("failed"), F.lit("failed")).otherwise(F.lit("published"))
    return stored.select(status.alias("status"), F.col("failure").alias("reason"), *keep)


def name_files(spark, parts: str, folder: str, name) -> None:
    """Give the one data file of every partition folder under ``parts`` the name ``name({column: value})`` in ``folder``.

    File system metadata only; for outputs with a file per partition, as numbered batch files are.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(path(f"{parts}/*/part-*")):
        source = found.getPath()
        column, value = source.getParent().getName().split("=", 1)
        if not fs.rename(source, path(f"{folder}/{name({column: value})}")):
            raise FileExistsError(f"{folder}/{name({column: value})}")
