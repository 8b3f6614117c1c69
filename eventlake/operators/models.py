"""Silver and gold models over bronze.

silver
    the seven bronze columns of rows with an ``event_id`` (a view);
gold
    one row per ``event_id``: among rows with both ``event_id`` and
    ``event_type``, the earliest arrival (``ingestion_time``), plus
    ``transformed_at``.

The not-null filter runs *before* ranking: a first arrival with a NULL
``event_type`` must not hide a later typed copy of the same event.

Two physical forms of "earliest per key" are offered:

``aggregate`` (default)
    ``min(struct(order columns..., payload))`` per key. Spark computes a
    partial aggregate per input partition before the shuffle, so a key that
    holds a third of all rows (e.g. events whose missing id defaulted to 0)
    reaches the shuffle as at most one row per map task.
``window``
    ``row_number() over (partition by event_id order by ...) = 1``; Spark
    plans a partial ``WindowGroupLimit`` before the shuffle with the same
    effect, at the cost of a full sort of both sides.

Ties on ``ingestion_time`` (a micro-batch stamps all its rows alike) are
broken by the remaining columns, so the kept row never depends on input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S


def silver(bronze: DataFrame) -> DataFrame:
    """Staging model: rows with an event id, seven columns."""
    return bronze.where(F.col("event_id").isNotNull()).select(*S.BRONZE_COLUMNS)


def rankable(silver_df: DataFrame) -> DataFrame:
    """Rows eligible for ranking (filter placed before the ranking)."""
    return silver_df.where(F.col("event_id").isNotNull() & F.col("event_type").isNotNull())


def earliest_by_window(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("event_id").orderBy(*[F.col(c).asc_nulls_first() for c in S.GOLD_ORDER])
    return (
        df.select(*S.BRONZE_COLUMNS, F.row_number().over(w).alias("rn"))
        .where(F.col("rn") == 1)
        .select(*S.BRONZE_COLUMNS)
    )


def earliest_by_aggregate(df: DataFrame) -> DataFrame:
    # Struct comparison is field by field with NULL first, i.e. the same order
    # as the window's ``ASC NULLS FIRST`` keys.
    best = F.min(F.struct(*[F.col(c) for c in S.GOLD_ORDER])).alias("best")
    return df.groupBy("event_id").agg(best).select(
        "event_id", *[F.col(f"best.{c}").alias(c) for c in S.BRONZE_COLUMNS if c != "event_id"]
    )


def gold(
    silver_df: DataFrame,
    transformed_at: Column | None = None,
    method: str = "aggregate",
) -> DataFrame:
    """Fact model: earliest arrival per event plus ``transformed_at``."""
    eligible = rankable(silver_df)
    if method == "aggregate":
        kept = earliest_by_aggregate(eligible)
    elif method == "window":
        kept = earliest_by_window(eligible)
    else:
        raise ValueError(f"method must be 'aggregate' or 'window', got {method!r}")
    stamp = F.current_timestamp() if transformed_at is None else transformed_at
    return kept.select(*S.BRONZE_COLUMNS, stamp.alias("transformed_at"))


def dedup(silver_df: DataFrame, method: str = "aggregate") -> DataFrame:
    """Gold without ``transformed_at`` (comparable across engines and runs)."""
    return gold(silver_df, method=method).drop("transformed_at")


def append_all(*frames: DataFrame) -> DataFrame:
    """Bag append (UNION ALL by name): repeated deliveries stay in bronze."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
