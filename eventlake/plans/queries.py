"""Registered queries over the supplied tables, each with its SQL oracle.

Every query reads the whole ``events`` table (``corpus``), turns it into raw
messages, and runs the engine's operators on them. The oracle computes the
same answer straight from ``events`` in plain SQL (DuckDB dialect), so a
decoding, routing or ranking mistake shows up as a mismatch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import models as M
from ..operators import parse as P
from ..operators import quality as Q
from ..session import configure
from ..sinks import publish as K
from ..sources import files as SRC
from . import corpus as CP

# Fixed values for the queries: rotation over ten batch files, retention as of
# 2024-02-15 with the contract's 30 days, batch files of 50 events.
ROTATION_FILES = 10
RETENTION_AS_OF = "2024-02-15"
EVENTS_PER_BATCH_FILE = 50
REDELIVERY_DELAY = "INTERVAL 1 HOUR"
FIRST_EVENTS = 1000
# Fixture rows without a type (every tenth event's first arrival) and without an id.
UNTYPED_EVERY = 10
NO_ID_EVERY = 97
# Every 23rd event is a document of its own, an object root.
SINGLE_EVERY = 23

QueryFn = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return CP.events(spark, sf_dir)


def _ts() -> F.Column:
    return F.col("ts")


def _parse(df: DataFrame, **options) -> DataFrame:
    """Decode a frame made from the supplied ``events``, one file with one row group and so one split."""
    return P.parse(df, min_partitions=df.sparkSession.sparkContext.defaultParallelism, **options)


# ---------------------------------------------------------------------------
# Bronze fixtures: what the ingest would have appended
# ---------------------------------------------------------------------------


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed-encoding messages delivered twice: first at ``ts``, then all again an hour later.

    At-least-once delivery: each message arrives twice and each arrival is
    decoded with its own stamp (the fallback "now" moves with it); bronze
    keeps both, gold removes the copy. One decode pass over both arrivals.
    """
    e = _events(spark, sf_dir)
    deliveries = CP.mixed(e).select(
        "value", F.posexplode(F.array(_ts(), _ts() + F.expr(REDELIVERY_DELAY))).alias("copy", "arrival")
    )
    rows = P.valid_rows(_parse(deliveries, stamp=F.col("arrival"), keep=("copy",)), keep=("copy",))
    # what other writers may leave in a table that enforces nothing: rows without an
    # id, and first arrivals without a type (gold must fall back to the second)
    untyped = (F.col("copy") == 0) & (F.col("event_id") % UNTYPED_EVERY == 3)
    return rows.withColumns({
        "event_type": F.when(~untyped, F.col("event_type")),
        "event_id": F.when(F.col("event_id") % NO_ID_EVERY != 5, F.col("event_id")),
    }).drop("copy")


def bronze_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries in the same micro-batch (same hourly stamp); the copy carries ``99 - k``.

    Both versions of each message are exploded from one row and decoded in one pass.
    """
    e = _events(spark, sf_dir)
    k = CP.product_of(F.col("props"))
    versions = F.array(CP.mixed_message(e), CP.mixed_message(e, F.lit(99) - k))
    deliveries = e.select(
        F.explode(versions).alias("value"),
        F.date_trunc("hour", _ts()).cast("timestamp_ntz").alias("arrival"),
    )
    return P.valid_rows(_parse(deliveries, stamp=F.col("arrival")))


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------


def q_parse_events(spark, sf_dir):
    return P.valid_rows(_parse(CP.mixed(_events(spark, sf_dir)), stamp=_ts()))


def q_deadletter(spark, sf_dir):
    return P.deadletter_rows(_parse(CP.mixed(_events(spark, sf_dir)), stamp=_ts()))


def q_truncate_fields(spark, sf_dir):
    rows = P.valid_rows(_parse(CP.truncation(_events(spark, sf_dir)), stamp=_ts()))
    return rows.select("event_id", "event_type", "session_id")


def _date_ids(corpus_fn):
    def q(spark, sf_dir):
        rows = P.valid_rows(_parse(corpus_fn(_events(spark, sf_dir)), stamp=_ts()))
        return rows.select("event_id", "date_id")

    return q


def q_container_texts(spark, sf_dir):
    """Objects and arrays where a text is expected, coerced to the text that Python prints."""
    e = _events(spark, sf_dir)
    text = F.format_string(
        '{"event_id":%d,"session_id":{"user":%d, "k":[%d,true,null],"type":"%s\'s","value":%s},"event_type":["%s"],"event_timestamp":"%s"}',
        "event_id", "user_id", CP.product_of(F.col("props")), "event_type", F.col("value").cast("string"), "event_type",
        F.date_format("ts", "yyyy-MM-dd"),
    )
    rows = P.valid_rows(_parse(e.select(text.alias("value"), "ts"), stamp=_ts()))
    return rows.select("event_id", "session_id", "event_type")


def q_gold_dedup(spark, sf_dir):
    return M.dedup(M.silver(bronze(spark, sf_dir)), method="window")


def q_gold_dedup_agg(spark, sf_dir):
    return M.dedup(M.silver(bronze(spark, sf_dir)), method="aggregate")


def q_gold_dedup_ties(spark, sf_dir):
    return M.dedup(M.silver(bronze_ties(spark, sf_dir)), method="aggregate")


def q_dq_unique(spark, sf_dir):
    return Q.unique_failures(bronze(spark, sf_dir), "event_id")


def q_dq_accepted_values(spark, sf_dir):
    return Q.accepted_values_failures(bronze(spark, sf_dir), "event_type", S.ACCEPTED_EVENT_TYPES)


def q_dq_not_null(spark, sf_dir):
    return Q.not_null_counts(bronze(spark, sf_dir), S.BRONZE_COLUMNS)


def _layers(spark, sf_dir):
    """Bronze, silver, gold as the pipeline stores them: bronze and gold written once."""
    from ..sinks.tables import materialize

    b = materialize(bronze(spark, sf_dir), "bronze")
    s = M.silver(b)
    return b, s, materialize(M.gold(s), "gold")


def q_dq_suite(spark, sf_dir):
    _, s, g = _layers(spark, sf_dir)
    return Q.run_suite({"silver": s, "gold": g})


def q_layer_counts(spark, sf_dir):
    b, s, g = _layers(spark, sf_dir)
    return Q.layer_counts({"bronze": b, "silver": s, "gold": g})


def q_batch_rotation(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select("event_id", SRC.rotation_slot(F.col("ts"), ROTATION_FILES).alias("batch_num"))


def q_retention(spark, sf_dir):
    from ..sinks import tables as TB

    kept = TB.unexpired(TB.with_partition_date(bronze(spark, sf_dir)), RETENTION_AS_OF, S.RETENTION_DAYS)
    return kept.groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_json_roundtrip(spark, sf_dir):
    e = _events(spark, sf_dir)
    objects = e.select(
        "event_id",
        "event_type",
        F.col("user_id").alias("customer_id"),
        CP.product_of(F.col("props")).alias("product_id"),
        CP.session_of(F.col("user_id")).alias("session_id"),
        F.col("ts").alias("event_timestamp"),
        F.col("ts").alias("arrival"),
    )
    messages = K.encode(objects, keep=("arrival",))
    rows = P.valid_rows(_parse(messages, stamp=F.col("arrival")))
    return rows.drop("ingestion_time")


def batch_documents(spark, sf_dir) -> DataFrame:
    """Canonical messages packed into JSON documents: arrays of at most 50 events, and single objects.

    Every array holds one element with a ``NaN`` member, which must cost no event.

    Chunks are runs of consecutive rows within one input partition
    (``monotonically_increasing_id`` is contiguous per partition), so no
    document grows past 50 events whatever the key distribution.
    """
    msgs = CP.canonical(_events(spark, sf_dir))
    alone = F.col("event_id") % SINGLE_EVERY == 0
    chunk = F.floor(F.monotonically_increasing_id() / EVENTS_PER_BATCH_FILE)
    grouped = msgs.where(~alone).groupBy(chunk.alias("batch_no")).agg(
        F.sort_array(F.collect_list(F.struct("event_id", "value"))).alias("items"),
        F.min("ts").alias("arrival"),
    )
    # the first element of every document carries a member that is no strict JSON
    first = F.regexp_replace(F.col("items")[0]["value"], r"\}$", ', "score": NaN}')
    rest = F.transform(F.slice("items", 2, EVENTS_PER_BATCH_FILE), lambda x: x["value"])
    body = F.array_join(F.concat(F.array(first), rest), ",\n")
    text = F.concat(F.lit("[\n"), body, F.lit("\n]"))
    arrays = grouped.select("batch_no", "arrival", text.alias("value"))
    singles = msgs.where(alone).select(F.col("event_id").alias("batch_no"), F.col("ts").alias("arrival"), "value")
    return arrays.unionByName(singles)


def _batch_rows(spark, sf_dir, mode):
    docs = SRC.explode_documents(batch_documents(spark, sf_dir))
    parsed = P.parse(docs, stamp=F.col("arrival"), mode=mode)
    return parsed.where(F.col("error").isNull()).select(
        *[c for c in S.BRONZE_COLUMNS if c != "ingestion_time"]
    )


def q_batch_arrays(spark, sf_dir):
    return _batch_rows(spark, sf_dir, "deadletter")


def q_batch_ingest_strict(spark, sf_dir):
    return _batch_rows(spark, sf_dir, "fail")


def q_consumer_pull(spark, sf_dir):
    parsed = _parse(CP.mixed(_events(spark, sf_dir)), stamp=_ts(), mode="drop")
    valid, _ = P.drop_bad(parsed)
    return valid


def q_silver_view(spark, sf_dir):
    return M.silver(bronze(spark, sf_dir))


def q_first_events(spark, sf_dir):
    """Publish only the first ``FIRST_EVENTS`` events in source order (the limit is the feature)."""
    e = _events(spark, sf_dir)
    objects = e.select(
        "event_id",
        "event_type",
        F.col("user_id").alias("customer_id"),
        CP.product_of(F.col("props")).alias("product_id"),
        CP.session_of(F.col("user_id")).alias("session_id"),
        F.col("ts").alias("event_timestamp"),
    )
    first = K.first_events(objects, FIRST_EVENTS, "event_timestamp", "event_id")
    rows = P.valid_rows(P.parse(K.encode(first, keep=("event_timestamp",)), stamp=F.col("event_timestamp")))
    return rows.drop("ingestion_time")


QUERIES: dict[str, QueryFn] = {
    "parse_events": q_parse_events,
    "deadletter": q_deadletter,
    "truncate_fields": q_truncate_fields,
    "epoch_date_id": _date_ids(CP.epoch),
    "offset_date_id": _date_ids(CP.offsets),
    "iso_variants_date_id": _date_ids(CP.iso_variants),
    "container_texts": q_container_texts,
    "gold_dedup": q_gold_dedup,
    "gold_dedup_agg": q_gold_dedup_agg,
    "gold_dedup_ties": q_gold_dedup_ties,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_not_null": q_dq_not_null,
    "dq_suite": q_dq_suite,
    "layer_counts": q_layer_counts,
    "batch_rotation": q_batch_rotation,
    "retention": q_retention,
    "json_roundtrip": q_json_roundtrip,
    "batch_arrays": q_batch_arrays,
    "batch_ingest_strict": q_batch_ingest_strict,
    "consumer_pull": q_consumer_pull,
    "silver_view": q_silver_view,
    "first_events": q_first_events,
}


# ---------------------------------------------------------------------------
# Oracles (DuckDB SQL over the supplied tables)
# ---------------------------------------------------------------------------

_SESSION = "'sess_' || lpad(CAST(user_id AS VARCHAR), 6, '0')"
_PRODUCT = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_DATE_ID = "CAST(strftime(ts, '%Y%m%d') AS BIGINT)"
_ACCEPTED = ", ".join(f"'{v}'" for v in S.ACCEPTED_EVENT_TYPES)


def _bronze_select(stamp: str, product: str = _PRODUCT, now: str | None = None) -> str:
    """Valid rows of the mixed corpus delivered at ``stamp`` (``now``: the fallback for no timestamp)."""
    return f"""
    SELECT event_id,
           CASE WHEN event_type = 'signup' THEN CAST(strftime({now or stamp}, '%Y%m%d') AS BIGINT)
                ELSE {_DATE_ID} END AS date_id,
           user_id AS customer_id,
           CASE WHEN event_type = 'click' THEN 0 ELSE {product} END AS product_id,
           CASE WHEN event_type = 'signup' THEN 'None' ELSE {_SESSION} END AS session_id,
           event_type,
           {stamp} AS ingestion_time
    FROM events WHERE event_type <> 'error'"""


def _delivered(stamp: str, untyped: str) -> str:
    return f"""
    SELECT CASE WHEN event_id % {NO_ID_EVERY} <> 5 THEN event_id END AS event_id, date_id, customer_id, product_id,
           session_id, CASE WHEN NOT ({untyped}) THEN event_type END AS event_type, ingestion_time
    FROM ({_bronze_select(stamp)}) AS d"""


_BRONZE_CTE = f"""WITH bronze AS (
    {_delivered('ts', f'event_id % {UNTYPED_EVERY} = 3')}
    UNION ALL
    {_delivered('ts + INTERVAL 1 HOUR', 'false')}
)"""

_BRONZE_TIES_CTE = f"""WITH bronze AS (
    {_bronze_select("date_trunc('hour', ts)")}
    UNION ALL
    {_bronze_select("date_trunc('hour', ts)", product=f"(99 - {_PRODUCT})")}
)"""

_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in S.GOLD_ORDER)
_COLS7 = ", ".join(S.BRONZE_COLUMNS)
_GOLD_FROM_BRONZE = f"""
SELECT {_COLS7} FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {_ORDER}) AS rn
    FROM (SELECT {_COLS7} FROM bronze WHERE event_id IS NOT NULL) AS silver
    WHERE event_id IS NOT NULL AND event_type IS NOT NULL
) AS ranked WHERE rn = 1"""

_DATE_ID_ORACLE = f"SELECT event_id, {_DATE_ID} AS date_id FROM events"


def _suite_sql() -> str:
    parts = []
    for t in S.QUALITY_SUITE:
        rel = "silver" if t.model == "silver" else "gold"
        if t.test == "not_null":
            n = f"SELECT count(*) FROM {rel} WHERE {t.column} IS NULL"
        elif t.test == "unique":
            n = (f"SELECT count(*) FROM (SELECT {t.column} FROM {rel} WHERE {t.column} IS NOT NULL "
                 f"GROUP BY {t.column} HAVING count(*) > 1) AS d")
        else:
            n = (f"SELECT count(DISTINCT {t.column}) FROM {rel} "
                 f"WHERE {t.column} NOT IN ({_ACCEPTED})")
        parts.append(
            f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, '{t.test}' AS test, "
            f"CAST(({n}) AS BIGINT) AS n_failed"
        )
    union = "\nUNION ALL ".join(parts)
    return f"""{_BRONZE_CTE},
silver AS (SELECT {_COLS7} FROM bronze WHERE event_id IS NOT NULL),
gold AS (SELECT *, current_timestamp AS transformed_at
         FROM ({_GOLD_FROM_BRONZE.replace('FROM bronze', 'FROM silver')}) AS g),
results AS ({union})
SELECT model, column_name, test, n_failed,
       CASE WHEN n_failed = 0 THEN 'pass' ELSE 'fail' END AS status
FROM results"""


# Code points 1 to 500 of the message; the longest ones hold characters outside the BMP.
DEADLETTER_SQL = f"""
    SELECT left(CASE
             WHEN value < 10 THEN '{{"event_id": ' || CAST(event_id AS VARCHAR) || ', "event_type": "error"'
             WHEN value < 25 THEN '{{"event_id": "id-' || CAST(event_id AS VARCHAR) || '", "event_type": "error"}}'
             WHEN value < 50 THEN '{{"event_id": ' || CAST(event_id AS VARCHAR)
                  || ', "event_type": "error", "event_timestamp": "' || strftime(ts, '%Y-%m-%d') || 'T25:00:00Z"}}'
             ELSE '[' || CAST(event_id AS VARCHAR) || ', "error", "' || repeat('{CP.OUTSIDE_BMP}', 300) || '"]'
           END, {S.DEADLETTER_TEXT_MAX}) AS raw_message,
           CASE
             WHEN value < 10 THEN 'INVALID_JSON'
             WHEN value < 25 THEN 'INVALID_INT:event_id'
             WHEN value < 50 THEN 'INVALID_TIMESTAMP'
             ELSE 'NOT_AN_OBJECT'
           END AS error,
           ts AS ingestion_time
    FROM events WHERE event_type = 'error'"""

ORACLES: dict[str, str] = {
    "parse_events": _bronze_select("ts"),
    "deadletter": DEADLETTER_SQL,
    "truncate_fields": f"""
    SELECT event_id, left(repeat(event_type, 20), 50) AS event_type,
           left(repeat({_SESSION}, 30), 255) AS session_id
    FROM events""",
    "container_texts": f"""
    SELECT event_id,
           left('{{''user'': ' || CAST(user_id AS VARCHAR) || ', ''k'': [' || CAST({_PRODUCT} AS VARCHAR) || ', True, None], ''type'': "'
                || event_type || '''s", ''value'': ' || CAST(value AS VARCHAR) || '}}', 255) AS session_id,
           left('[''' || event_type || ''']', 50) AS event_type
    FROM events""",
    "epoch_date_id": _DATE_ID_ORACLE,
    "offset_date_id": _DATE_ID_ORACLE,
    "iso_variants_date_id": _DATE_ID_ORACLE,
    "gold_dedup": _BRONZE_CTE + _GOLD_FROM_BRONZE,
    "gold_dedup_agg": _BRONZE_CTE + _GOLD_FROM_BRONZE,
    "gold_dedup_ties": _BRONZE_TIES_CTE + _GOLD_FROM_BRONZE,
    "dq_unique": _BRONZE_CTE + """
    SELECT event_id AS value, count(*) AS n_records FROM bronze
    WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) > 1""",
    "dq_accepted_values": _BRONZE_CTE + f"""
    SELECT event_type AS value, count(*) AS n_records FROM bronze
    WHERE event_type NOT IN ({_ACCEPTED}) GROUP BY event_type""",
    "dq_not_null": _BRONZE_CTE + "\nSELECT "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n_null_{c}" for c in S.BRONZE_COLUMNS)
    + " FROM bronze",
    "dq_suite": _suite_sql(),
    "layer_counts": _BRONZE_CTE + f""",
    silver AS (SELECT {_COLS7} FROM bronze WHERE event_id IS NOT NULL),
    gold AS ({_GOLD_FROM_BRONZE.replace('FROM bronze', 'FROM silver')})
    SELECT 'bronze' AS layer, count(*) AS total FROM bronze
    UNION ALL SELECT 'silver', count(*) FROM silver
    UNION ALL SELECT 'gold', count(*) FROM gold""",
    "batch_rotation": f"""
    SELECT event_id, CAST((extract(minute FROM ts) // 10) % {ROTATION_FILES} + 1 AS BIGINT) AS batch_num
    FROM events""",
    "retention": _BRONZE_CTE + f"""
    SELECT CAST(ingestion_time AS DATE) AS ingestion_date, count(*) AS n_rows FROM bronze
    WHERE CAST(ingestion_time AS DATE) > DATE '{RETENTION_AS_OF}' - INTERVAL {S.RETENTION_DAYS} DAY
    GROUP BY 1""",
    "json_roundtrip": f"""
    SELECT event_id, {_DATE_ID} AS date_id, user_id AS customer_id, {_PRODUCT} AS product_id,
           {_SESSION} AS session_id, event_type
    FROM events""",
    "batch_arrays": f"""
    SELECT event_id, {_DATE_ID} AS date_id, user_id AS customer_id, {_PRODUCT} AS product_id,
           {_SESSION} AS session_id, event_type
    FROM events""",
    "consumer_pull": f"""
    SELECT event_id, {_DATE_ID} AS date_id, user_id AS customer_id,
           CASE WHEN event_type = 'click' THEN 0 ELSE {_PRODUCT} END AS product_id,
           CASE WHEN event_type = 'signup' THEN NULL ELSE {_SESSION} END AS session_id,
           event_type, ts AS ingestion_time
    FROM events WHERE event_type NOT IN ('error', 'purchase')""",
}
ORACLES["batch_ingest_strict"] = ORACLES["batch_arrays"]
ORACLES["silver_view"] = _BRONZE_CTE + f"""
SELECT {_COLS7} FROM bronze WHERE event_id IS NOT NULL"""
ORACLES["first_events"] = f"""
SELECT event_id, {_DATE_ID} AS date_id, user_id AS customer_id, {_PRODUCT} AS product_id,
       {_SESSION} AS session_id, event_type
FROM events ORDER BY ts, event_id LIMIT {FIRST_EVENTS}"""

from . import stored as _stored  # noqa: E402,F401  adds its queries, which use the fixtures above
