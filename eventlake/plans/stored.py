"""Queries over what the write paths leave behind: streams, loads, appends, retention, batch files, pulls.

Each writes into fresh scratch tables or folders when it is called and returns
the stored rows, so wrong columns, lost or repeated rows show up against the
oracle. Scratch is noted in the session and removed by
``session.release_scratch``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import parse as P
from ..session import configure, scratch_database, scratch_path
from ..sinks import publish as K
from ..sinks import tables as TB
from ..sources import arrays as ARR
from ..sources import files as SRC
from ..sources import messages as MSG
from ..streaming import ingest as ST
from . import corpus as CP
from . import medallion as PL
from . import queries as QQ

# The stamp of loads whose messages carry none, and the run's retention.
STAMP = "2024-06-01 00:00:00"
PULLED = 500
LOOKED_UP = [7, 111, 222, 333, 444, 555, 666, 777, 888, 999]
RANGE_BYTES = 64 << 10  # of the ranges that an array file is read by
BATCH_AT = dt.datetime(2024, 6, 1, 10, 25)  # slot 3


def _layout(spark, name: str) -> PL.Layout:
    root = scratch_path(spark, name)
    tag = root.rsplit("-", 1)[-1]
    return PL.Layout(
        root=root, bronze_db=scratch_database(f"bronze_{tag}"), silver_db=scratch_database(f"silver_{tag}"),
        gold_db=scratch_database(f"gold_{tag}"), gold_buckets=8,
    )


def _fixed_stamp():
    return F.lit(STAMP).cast("timestamp_ntz")


def _stored(df: DataFrame, output: str, columns) -> DataFrame:
    """Rows of one output in the union's columns; what an output does not have is NULL."""
    every = {**{f.name: f.dataType for f in S.BRONZE_SCHEMA}, **{f.name: f.dataType for f in S.DEADLETTER_SCHEMA}}
    picked = [F.col(c) if c in columns else F.lit(None).cast(t).alias(c) for c, t in every.items()]
    out = df.select(F.lit(output).alias("output"), *picked)
    return out.withColumn("ingestion_time", F.col("ingestion_time").cast("timestamp_ntz"))


def q_stream_split(spark, sf_dir):
    """The supplied events replayed as a stream (availableNow), decoded, fanned out: the rows of both sinks."""
    configure(spark)
    root = scratch_path(spark, "stream_split")
    source = (
        spark.readStream.schema(CP.events(spark, sf_dir).schema)
        .option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1).parquet(sf_dir)
    )
    ST.run_available_now(
        CP.mixed(source).select("value", "ts"),
        ST.path_sink(f"{root}/bronze", clustering=S.BRONZE_CLUSTER_KEYS),
        ST.path_sink(f"{root}/deadletter"),
        checkpoint=f"{root}/_checkpoint",
        # the supplied table is one file with one row group: one split
        min_partitions=spark.sparkContext.defaultParallelism,
        stamp=F.col("ts"),
    )
    dead = [f.name for f in S.DEADLETTER_SCHEMA]
    return _stored(spark.read.parquet(f"{root}/bronze"), "bronze", S.BRONZE_COLUMNS).unionByName(
        _stored(spark.read.parquet(f"{root}/deadletter"), "deadletter", dead)
    )


def q_medallion_run(spark, sf_dir):
    """Full medallion run over the mixed corpus into fresh tables, retention included: the stored rows.

    The supplied event types include ``signup``/``click``, outside the
    accepted domain, so the run records (not raises) the failing tests.
    """
    layout = _layout(spark, "medallion_run")
    messages = CP.mixed(CP.events(spark, sf_dir)).repartition(spark.sparkContext.defaultParallelism)
    PL.run(spark, messages, layout, raise_on_test_failure=False, stamp=F.col("ts"), expire_as_of=QQ.RETENTION_AS_OF)
    dead = [f.name for f in S.DEADLETTER_SCHEMA]
    out = _stored(spark.table(layout.bronze), "bronze", S.BRONZE_COLUMNS)
    out = out.unionByName(_stored(spark.table(layout.deadletter), "deadletter", dead))
    return out.unionByName(_stored(spark.table(layout.gold), "gold", S.BRONZE_COLUMNS))


def q_text_scan(spark, sf_dir):
    """Messages stored as text lines, scanned and decoded; lines carry no arrival, so one fixed stamp."""
    configure(spark)
    root = scratch_path(spark, "text_scan")
    CP.mixed(CP.events(spark, sf_dir)).select("value").write.text(root)
    return P.valid_rows(P.parse(SRC.read_lines(spark, root), stamp=_fixed_stamp()))


def q_binary_messages(spark, sf_dir):
    """Messages as bytes, those of type ``error`` with a byte that is no UTF-8: both outputs."""
    e = CP.events(spark, sf_dir)
    bad = F.when(F.col("event_type") == "error", F.lit(bytearray(b"\xff"))).otherwise(F.lit(bytearray(b"")))
    value = F.concat(F.encode(CP.canonical_event(e), "utf-8"), bad)
    parsed = P.parse(e.select("ts", value.alias("value")), stamp=F.col("ts"))
    dead = [f.name for f in S.DEADLETTER_SCHEMA]
    return _stored(P.valid_rows(parsed), "bronze", S.BRONZE_COLUMNS).unionByName(
        _stored(P.deadletter_rows(parsed), "deadletter", dead)
    )


def q_append_strict(spark, sf_dir):
    """A strict load with bad messages must fail and store nothing; a load of good ones is stored."""
    layout = _layout(spark, "append_strict")
    PL.setup(spark, layout)
    e = CP.events(spark, sf_dir)
    try:
        PL.ingest(spark, CP.mixed(e), layout, mode="fail", stamp=F.col("ts"))
    except Exception as failure:
        if "bad event" not in str(failure):
            raise
    else:
        if e.where("event_type = 'error'").count():
            raise AssertionError("a strict load stored a corpus with bad messages")
    PL.ingest(spark, CP.canonical(e), layout, mode="fail", stamp=F.col("ts"))
    return _stored(spark.table(layout.bronze), "bronze", S.BRONZE_COLUMNS).select(*S.BRONZE_COLUMNS)


def q_append_report(spark, sf_dir):
    """Rows without a REQUIRED value are rejected and counted, the others stored."""
    layout = _layout(spark, "append_report")
    PL.setup(spark, layout)
    seen = TB.append(spark, QQ.bronze(spark, sf_dir), layout.bronze, required=S.BRONZE_REQUIRED, on_reject="report")
    out = _stored(spark.table(layout.bronze), "bronze", S.BRONZE_COLUMNS).select(*S.BRONZE_COLUMNS)
    return out.withColumn("n_rejected", F.lit(seen.get["n_rejected"]).cast("bigint"))


def q_retention_drop(spark, sf_dir):
    """Bronze appended by day, expired partitions dropped, the rest read back."""
    layout = _layout(spark, "retention_drop")
    PL.setup(spark, layout)
    TB.append(spark, QQ.bronze(spark, sf_dir), layout.bronze)
    PL.expire(spark, layout, QQ.RETENTION_AS_OF)
    return _stored(spark.table(layout.bronze), "bronze", S.BRONZE_COLUMNS).select(*S.BRONZE_COLUMNS)


def q_rotating_batch(spark, sf_dir):
    """Ten numbered batch folders of documents of at most 50 events; a run at 10:25 strictly loads the third."""
    layout = _layout(spark, "rotating_batch")
    PL.setup(spark, layout)
    folder = scratch_path(spark, "batch_files")
    events = CP.canonical(CP.events(spark, sf_dir))
    number = F.col("event_id") % QQ.ROTATION_FILES + 1
    chunk = F.floor(F.monotonically_increasing_id() / (QQ.ROTATION_FILES * QQ.EVENTS_PER_BATCH_FILE))
    # by residue, so of 500 consecutive rows; a run without gaps in its ids gives 50 a document, others are cut to it
    place = F.floor((F.row_number().over(Window.partitionBy("batch", "chunk").orderBy("event_id")) - 1) / QQ.EVENTS_PER_BATCH_FILE)
    dealt = events.select("value", "event_id", number.alias("batch"), chunk.alias("chunk")).withColumn("part", place)
    texts = dealt.groupBy("batch", "chunk", "part").agg(F.array_join(F.collect_list("value"), ",").alias("body"))
    texts.select("batch", F.concat(F.lit("["), "body", F.lit("]")).alias("value")).write.partitionBy("batch").text(folder)
    PL.rotating_batch(spark, folder, BATCH_AT, layout, stamp=_fixed_stamp(), folders=True)
    return _stored(spark.table(layout.bronze), "bronze", S.BRONZE_COLUMNS).select(*S.BRONZE_COLUMNS)


def q_batch_files(spark, sf_dir):
    """Ten files batch_NN.json, each one array over many lines; a run at 10:25 strictly loads the third, by ranges."""
    layout = _layout(spark, "batch_files")
    PL.setup(spark, layout)
    folder = scratch_path(spark, "array_files")
    number = (F.col("event_id") % QQ.ROTATION_FILES + 1).cast("int")
    events = CP.canonical(CP.events(spark, sf_dir)).select("value", "event_id", number.alias("batch"))
    # a file is one stream of lines: an opening bracket, events with their commas, null as the last element
    edges = spark.range(1, QQ.ROTATION_FILES + 1).select(F.explode(F.array(F.lit("["), F.lit("null]"))).alias("value"), F.col("id").cast("int").alias("batch"))
    edges = edges.withColumn("event_id", F.when(F.col("value") == "[", F.lit(-1)).otherwise(F.lit(1 << 62)).cast("long"))
    lines = events.withColumn("value", F.concat("value", F.lit(","))).unionByName(edges)
    lines = lines.repartition(QQ.ROTATION_FILES, "batch").sortWithinPartitions("batch", "event_id")
    lines.select("value", "batch").write.partitionBy("batch").text(f"{folder}/parts")
    K.name_files(spark, f"{folder}/parts", folder, lambda p: f"batch_{int(p['batch']):02d}.json")
    path = SRC.pick_batch(spark, folder, BATCH_AT)
    rows = ARR.read_arrays(spark, path, whole_bytes=0, split_bytes=RANGE_BYTES).where("value <> 'null'")
    PL.ingest(spark, rows, layout, mode="fail", stamp=_fixed_stamp())
    return _stored(spark.table(layout.bronze), "bronze", S.BRONZE_COLUMNS).select(*S.BRONZE_COLUMNS)


def q_bounded_pull(spark, sf_dir):
    """The consumer: the first messages by arrival, bad ones dropped, the rest appended (the bound is the feature)."""
    layout = _layout(spark, "bounded_pull")
    PL.setup(spark, layout)
    pulled = K.first_events(CP.mixed(CP.events(spark, sf_dir)), PULLED, "ts", "event_id")
    PL.ingest(spark, pulled, layout, mode="drop", stamp=F.col("ts"), max_messages=PULLED)
    return _stored(spark.table(layout.bronze), "bronze", S.BRONZE_COLUMNS).select(*S.BRONZE_COLUMNS)


def q_message_pull(spark, sf_dir):
    """Pulls of half of the messages each, from arrival files with other sizes: every message is stored once."""
    configure(spark)
    root = scratch_path(spark, "message_pull")
    messages = CP.canonical(CP.events(spark, sf_dir))
    messages.select("value").repartition(7, "event_id").write.text(f"{root}/arrivals")
    total = messages.count()
    most, pulled = -(-total // 2), []
    while sum(pulled) < total:
        source = MSG.stream_messages(spark, f"{root}/arrivals", most, f"{root}/position")
        counts = ST.run_available_now(source, ST.path_sink(f"{root}/bronze"), ST.path_sink(f"{root}/dead"), f"{root}/_checkpoint", stamp=_fixed_stamp())
        pulled.append(counts["n_messages"])
    out = _stored(spark.read.parquet(f"{root}/bronze"), "bronze", S.BRONZE_COLUMNS).select(*S.BRONZE_COLUMNS)
    return out.withColumn("n_pulls", F.lit(len(pulled)).cast("bigint")).withColumn("largest_pull", F.lit(max(pulled, default=0)).cast("bigint"))


def q_closed_days(spark, sf_dir):
    """Bronze in two loads, days before a date rewritten, one more load for them, rewritten again: rows and partitions a day."""
    layout = _layout(spark, "closed_days")
    PL.setup(spark, layout)
    rows = QQ.bronze(spark, sf_dir).where("event_id IS NOT NULL")
    for part in range(3):
        some = F.col("event_id") % 3 == part
        TB.append(spark, rows.where(some), layout.bronze, batch=f"load-{part}")
        if part:
            TB.close_days(spark, layout.bronze, QQ.RETENTION_AS_OF)
    stored = spark.table(layout.bronze)
    out = _stored(stored, "bronze", S.BRONZE_COLUMNS)
    days = stored.groupBy(F.to_date("ingestion_time").alias("d")).agg(F.count_distinct(TB.BATCH_COLUMN).alias("n_batches"))
    out = out.select(*S.BRONZE_COLUMNS)
    return out.join(days, F.to_date(out["ingestion_time"]) == F.col("d")).drop("d")


def q_event_lookup(spark, sf_dir):
    """Point lookups by event id in closed days, whose Bloom filters and statistics skip row groups."""
    layout = _layout(spark, "event_lookup")
    PL.setup(spark, layout)
    TB.append(spark, QQ.bronze(spark, sf_dir), layout.bronze)
    PL.close_days(spark, layout, "2030-01-01")
    return _stored(PL.lookup(spark, layout, LOOKED_UP), "bronze", S.BRONZE_COLUMNS).select(*S.BRONZE_COLUMNS)


def q_stream_retention(spark, sf_dir):
    """A stream into tables that carry their retention; nothing else expires their days."""
    base = _layout(spark, "stream_retention")
    layout = PL.Layout(**{**base.__dict__, "retention_days": S.RETENTION_DAYS})
    PL.setup(spark, layout)
    TB.append(spark, QQ.bronze(spark, sf_dir), layout.bronze, today="2024-01-02")  # what earlier batches left
    root = scratch_path(spark, "stream_retention_in")
    source = spark.readStream.schema(CP.events(spark, sf_dir).schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    today = lambda: QQ.RETENTION_AS_OF
    recent = CP.canonical(source).select("value").withColumn("ts", F.lit(f"{QQ.RETENTION_AS_OF} 12:00:00").cast("timestamp_ntz"))
    ST.run_available_now(
        recent, ST.table_sink(spark, layout.bronze, S.BRONZE_REQUIRED, today), ST.table_sink(spark, layout.deadletter, S.DEADLETTER_REQUIRED, today),
        f"{root}/_checkpoint", stamp=F.col("ts"), min_partitions=spark.sparkContext.defaultParallelism)
    return _stored(spark.table(layout.bronze), "bronze", S.BRONZE_COLUMNS).select(*S.BRONZE_COLUMNS)


def q_append_rejects(spark, sf_dir):
    """Rows that the table rejects, with column and reason, beside those that it stored; the load is run twice."""
    layout = _layout(spark, "append_rejects")
    PL.setup(spark, layout)
    rejects = scratch_path(spark, "rejects")
    for _ in range(2):
        bad = TB.append_or_reject(spark, QQ.bronze(spark, sf_dir), layout.bronze, S.BRONZE_REQUIRED, rejects, batch=f"load-{layout.root[-8:]}")
    none = F.lit(None).cast("string")
    out = _stored(spark.table(layout.bronze), "stored", S.BRONZE_COLUMNS).select("output", *S.BRONZE_COLUMNS, none.alias("column"), none.alias("reason"))
    bad = bad.withColumn("ingestion_time", F.col("ingestion_time").cast("timestamp_ntz"))
    return out.unionByName(bad.select(F.lit("rejected").alias("output"), *S.BRONZE_COLUMNS, "column", "reason"))


def q_publish_named(spark, sf_dir):
    """Events published twice under one name, some of which cannot be sent: the messages, read back, and every outcome."""
    configure(spark)
    root = scratch_path(spark, "publish_named")
    e = CP.events(spark, sf_dir)
    # events of type error cannot be encoded (a byte that is no UTF-8), long ones are over the limit
    broken = F.concat(F.encode("event_type", "utf-8"), F.lit(bytearray(b"\xff"))).cast("string")
    label = F.when(F.col("event_type") == "error", broken).when(F.col("event_id") % 101 == 0, F.repeat(F.lit("x"), 400)).otherwise(F.col("event_type"))
    events = e.select("event_id", label.alias("event_type"), F.col("user_id").alias("customer_id"))
    for _ in range(2):
        done = K.publish_once(events.withColumn("id", F.col("event_id")), f"{root}/topic", "monday", ["event_id", "event_type", "customer_id"], ("id",), 300)
    sent = P.valid_rows(P.parse(SRC.read_lines(spark, f"{root}/topic/monday"), stamp=_fixed_stamp()))
    sent = sent.select(F.lit("message").alias("output"), "event_id", "event_type", F.lit(None).cast("string").alias("status"), F.lit(None).cast("string").alias("reason"))
    return sent.unionByName(done.select(F.lit("outcome").alias("output"), F.col("id").alias("event_id"), F.lit(None).cast("string").alias("event_type"), "status", "reason"))


def q_stream_progress(spark, sf_dir):
    """A stream in pulls, whose second dies after both appends and is replayed: the counts kept, beside the rows stored."""
    configure(spark)
    root = scratch_path(spark, "stream_progress")
    messages = CP.mixed(CP.events(spark, sf_dir)).select("value")
    messages.repartition(7, "value").write.text(f"{root}/arrivals")
    most, pulls = max(1, -(-messages.count() // 2)), 0
    bronze, dead = ST.path_sink(f"{root}/bronze"), ST.path_sink(f"{root}/dead")

    def dies(df, batch):
        dead(df, batch)
        raise RuntimeError("after both appends")

    while pulls < 3:
        source = MSG.stream_messages(spark, f"{root}/arrivals", most, f"{root}/position")
        sink, pulls = (dies if pulls == 1 else dead), pulls + 1
        try:
            ST.run_available_now(source, bronze, sink, f"{root}/_checkpoint", stamp=_fixed_stamp(), progress=f"{root}/progress")
        except Exception as lost:
            if "after both appends" not in str(lost):
                raise
    names = ("n_batches", "n_messages", "n_valid", "n_deadletter", "stored_bronze", "stored_dead")
    kept = ST.read_progress(spark, f"{root}/progress").agg(
        F.count(F.lit(1)).alias("n_batches"), *[F.sum(c).alias(c) for c in names[1:4]])
    for n in ("bronze", "dead"):
        stored = spark.read.parquet(f"{root}/{n}").agg(F.count(F.lit(1)).alias(f"stored_{n}"))
        kept = kept.unionByName(stored, allowMissingColumns=True)
    return kept.agg(*[F.max(n).alias(n) for n in names])


QUERIES = {
    "stream_progress": q_stream_progress,
    "message_pull": q_message_pull,
    "closed_days": q_closed_days,
    "event_lookup": q_event_lookup,
    "stream_retention": q_stream_retention,
    "append_rejects": q_append_rejects,
    "publish_named": q_publish_named,
    "stream_split": q_stream_split,
    "medallion_run": q_medallion_run,
    "text_scan": q_text_scan,
    "binary_messages": q_binary_messages,
    "append_strict": q_append_strict,
    "append_report": q_append_report,
    "retention_drop": q_retention_drop,
    "rotating_batch": q_rotating_batch,
    "batch_files": q_batch_files,
    "bounded_pull": q_bounded_pull,
}

_COLS = ", ".join(S.BRONZE_COLUMNS)


def _bronze_out(output: str, select: str) -> str:
    return (f"SELECT '{output}' AS output, {_COLS}, NULL::VARCHAR AS raw_message, NULL::VARCHAR AS error "
            f"FROM ({select}) AS b")


def _dead_out(select: str) -> str:
    nulls = ", ".join(f"NULL::{t} AS {c}" for c, t in (
        ("event_id", "BIGINT"), ("date_id", "BIGINT"), ("customer_id", "BIGINT"), ("product_id", "BIGINT"),
        ("session_id", "VARCHAR"), ("event_type", "VARCHAR")))
    return f"SELECT 'deadletter' AS output, {nulls}, ingestion_time, raw_message, error FROM ({select}) AS d"


def _unexpired(select: str) -> str:
    return (f"SELECT * FROM ({select}) AS u WHERE CAST(ingestion_time AS DATE) > "
            f"DATE '{QQ.RETENTION_AS_OF}' - INTERVAL {S.RETENTION_DAYS} DAY")


_CANONICAL = f"""
    SELECT event_id, {QQ._DATE_ID} AS date_id, user_id AS customer_id, {QQ._PRODUCT} AS product_id,
           {QQ._SESSION} AS session_id, event_type, ts AS ingestion_time FROM events"""
_CANONICAL_TEXT = f"""
    SELECT '{{"event_id":' || event_id || ',"event_type":"' || event_type || '","customer_id":' || user_id
      || ',"product_id":' || {QQ._PRODUCT} || ',"session_id":"' || {QQ._SESSION}
      || '","event_timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}}' || chr(65533) AS raw_message,
      'INVALID_UTF8' AS error, ts AS ingestion_time FROM events WHERE event_type = 'error'"""

ORACLES = {
    "stream_progress": f"""
    WITH good AS (SELECT count(*) AS n FROM ({QQ._bronze_select("ts")})), bad AS (SELECT count(*) AS n FROM ({QQ.DEADLETTER_SQL}))
    SELECT 2::BIGINT AS n_batches, (good.n + bad.n)::BIGINT AS n_messages, good.n::BIGINT AS n_valid, bad.n::BIGINT AS n_deadletter,
           good.n::BIGINT AS stored_bronze, bad.n::BIGINT AS stored_dead FROM good, bad""",
    "message_pull": f"""
    SELECT b.*, 2::BIGINT AS n_pulls, (SELECT (count(*) + 1) // 2 FROM events)::BIGINT AS largest_pull
    FROM ({_CANONICAL.replace("ts AS ingestion_time", f"TIMESTAMP '{STAMP}' AS ingestion_time")}) AS b""",
    "closed_days": QQ._BRONZE_CTE + f"""
    , counted AS (
      SELECT d, CASE WHEN d < DATE '{QQ.RETENTION_AS_OF}' THEN 1 ELSE n END::BIGINT AS n_batches FROM (
        SELECT CAST(ingestion_time AS DATE) AS d, count(DISTINCT event_id % 3) AS n FROM bronze WHERE event_id IS NOT NULL GROUP BY 1))
    SELECT {_COLS}, n_batches FROM bronze JOIN counted ON CAST(ingestion_time AS DATE) = d WHERE event_id IS NOT NULL""",
    "event_lookup": QQ._BRONZE_CTE + f"SELECT {_COLS} FROM bronze WHERE event_id IN ({', '.join(map(str, LOOKED_UP))})",
    "stream_retention": QQ._BRONZE_CTE + _unexpired(f"SELECT {_COLS} FROM bronze") + "\nUNION ALL\n"
    + _CANONICAL.replace("ts AS ingestion_time", f"TIMESTAMP '{QQ.RETENTION_AS_OF} 12:00:00' AS ingestion_time"),
    "append_rejects": QQ._BRONZE_CTE + f"""
    SELECT 'stored' AS output, {_COLS}, NULL::VARCHAR AS "column", NULL::VARCHAR AS reason FROM bronze WHERE event_id IS NOT NULL
    UNION ALL
    SELECT 'rejected', {_COLS}, 'event_id', 'REQUIRED value is NULL: event_id' FROM bronze WHERE event_id IS NULL""",
    "publish_named": """
    WITH e AS (
      SELECT event_id, CASE WHEN event_type = 'error' THEN 'NOT_ENCODABLE' WHEN event_id % 101 = 0 THEN 'TOO_LARGE' END AS reason,
        event_type FROM events)
    SELECT 'message' AS output, event_id, event_type, NULL::VARCHAR AS status, NULL::VARCHAR AS reason FROM e WHERE reason IS NULL
    UNION ALL
    SELECT 'outcome', event_id, NULL, CASE WHEN reason IS NULL THEN 'published' ELSE 'failed' END, reason FROM e""",
    "stream_split": _bronze_out("bronze", QQ._bronze_select("ts")) + "\nUNION ALL\n" + _dead_out(QQ.DEADLETTER_SQL),
    "medallion_run": "\nUNION ALL\n".join([
        _bronze_out("bronze", _unexpired(QQ._bronze_select("ts"))), _dead_out(_unexpired(QQ.DEADLETTER_SQL)),
        _bronze_out("gold", _unexpired(QQ._bronze_select("ts"))),
    ]),
    "text_scan": QQ._bronze_select(f"TIMESTAMP '{STAMP}'"),
    "binary_messages": _bronze_out("bronze", _CANONICAL + " WHERE event_type <> 'error'")
    + "\nUNION ALL\n" + _dead_out(_CANONICAL_TEXT),
    "append_strict": _CANONICAL,
    "append_report": QQ._BRONZE_CTE + f"""
    SELECT {_COLS}, (SELECT count(*) FROM bronze WHERE event_id IS NULL) AS n_rejected
    FROM bronze WHERE event_id IS NOT NULL""",
    "retention_drop": QQ._BRONZE_CTE + _unexpired(f"SELECT {_COLS} FROM bronze"),
    "rotating_batch": _CANONICAL.replace("ts AS ingestion_time", f"TIMESTAMP '{STAMP}' AS ingestion_time")
    + f" WHERE event_id % {QQ.ROTATION_FILES} + 1 = 3",
    "batch_files": _CANONICAL.replace("ts AS ingestion_time", f"TIMESTAMP '{STAMP}' AS ingestion_time")
    + f" WHERE event_id % {QQ.ROTATION_FILES} + 1 = 3",
    "bounded_pull": QQ.ORACLES["consumer_pull"].replace(
        "FROM events", f"FROM (SELECT * FROM events ORDER BY ts, event_id LIMIT {PULLED}) AS events"),
}

QQ.QUERIES.update(QUERIES)
QQ.ORACLES.update(ORACLES)
