"""From repeated-window spans back to documents: one shuffle of the texts by row key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_tag

KEY = ["doc", "tag", "null_id"]
SPAN = "doc long, tag long, null_id boolean, at int, size int"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns the operators read, under their own names.

    ``doc`` is the id (0 where it is null, told apart by ``null_id``) and
    ``tag`` a checksum of the text, so rows that repeat an id with another text
    keep their own spans and identical rows share theirs.
    """
    return docs.select(*_key(id_col, text_col), F.col(text_col).cast("string").alias("text"))


def with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The whole input rows, packed as ``row`` so that no column can clash, under the same key."""
    return docs.select(*_key(id_col, text_col), F.struct("*").alias("row"))


def _key(id_col: str, text_col: str) -> list[Column]:
    doc, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return [F.coalesce(doc, F.lit(0)).alias("doc"), text_tag(text).alias("tag"), doc.isNull().alias("null_id")]


def apply_spans(rows: DataFrame, spans: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function(batches)`` over every row with ``at``/``size`` lists of its spans (null: none).

    The span side is the small, hashed one; the texts are shuffled once and
    never sorted.
    """
    return with_spans(rows, spans, "left").mapInArrow(function, schema)


def with_spans(rows: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Rows with the ``at``/``size`` lists of their spans. A set, combined before the shuffle: rows that repeat share
    their spans, so a list is bounded by one text's length."""
    lists = spans.groupBy(*KEY).agg(F.collect_set(F.struct("at", "size")).alias("spans"))
    lists = lists.select(*KEY, F.col("spans.at").alias("at"), F.col("spans.size").alias("size"))
    return rows.join(lists.hint("shuffle_hash"), KEY, how).select(*KEY, "text", "at", "size")
