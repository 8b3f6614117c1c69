"""Namespaces, tables, layout, appends and retention.

Tables are catalog Parquet tables. Bronze and dead-letter tables are
partitioned by day on a derived ``ingestion_date`` (a Parquet table cannot
partition on a timestamp expression); bronze files are sorted by the
clustering keys inside each day, so row-group min/max statistics let scans on
``event_type``/``customer_id`` skip data. Appends add no shuffle: each task
writes its own sorted files for the days it holds.

Below its day every append has a partition of its own, ``ingestion_batch``,
named by the load or micro-batch that wrote it. Appending a batch again
replaces its partitions (dynamic partition overwrite), so a replay after a
crash leaves each row once.

A day-partitioned table is a view over two tables: the open one takes the
appends, the closed one holds rewritten days (:func:`close_days`): one
partition a day, range-partitioned and sorted by the clustering keys, with
Bloom filters for point lookups. A day's rewrite becomes visible by one
``CREATE OR REPLACE VIEW``; readers see its batches or its rewrite, each row
once. A table may carry its retention (:func:`enforce_retention`), which every
writer enforces once a day.

Parquet tables do not enforce ``NOT NULL``; REQUIRED columns are checked in
the write projection (``operators.quality.enforce_required``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import enforce_required

PARTITION_COLUMN = "ingestion_date"
BATCH_COLUMN = "ingestion_batch"
SOURCE_BATCH = "source_batch"  # of rows in closed days
ROW_GROUP_BYTES = 16 << 20  # of closed days
_PROP_CLUSTER = "eventlake.cluster_by"
_PROP_SOURCE = "eventlake.partition_source"
_PROP_VERSION = "eventlake.version"
_PROP_PREVIOUS = "eventlake.previous_version"
_PROP_CLOSED = "eventlake.closed_versions"  # of a view: the published version of every closed day
_PROP_RETENTION = "eventlake.retention_days"
_PROP_EXPIRED = "eventlake.expired_on"
OPEN, CLOSED, MERGED = "__open", "__closed", "__merged"


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (an existing one is left as it is)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def _sql_type(t: T.DataType) -> str:
    return t.simpleString().upper()


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_field: str | None = None,
    clustering_fields: Iterable[str] = (),
    location: str | None = None,
    retention_days: int | None = None,
    lookup_fields: Iterable[str] = (),
) -> bool:
    """Create ``name`` if absent; an existing table is left untouched (no migration).

    ``partition_field`` (a timestamp column) adds the daily ``ingestion_date``
    partition column and the ``ingestion_batch`` below it; ``name`` is then
    the view over its open and closed days. ``retention_days`` is kept on the
    table and enforced by its writers. ``lookup_fields`` get Bloom filters in
    closed days. Returns True when the table was created.
    """
    if spark.catalog.tableExists(name):
        return False
    cols = [f"`{f.name}` {_sql_type(f.dataType)}" for f in schema.fields]
    clauses, options, props = [], [], {}
    if partition_field:
        cols += [f"`{PARTITION_COLUMN}` DATE", f"`{BATCH_COLUMN}` STRING"]
        options.append("partitionOverwriteMode 'dynamic'")
        clauses.append(f"PARTITIONED BY ({PARTITION_COLUMN}, {BATCH_COLUMN})")
        props[_PROP_SOURCE] = partition_field
    clustering = list(clustering_fields)
    if clustering:
        props[_PROP_CLUSTER] = ",".join(clustering)
    if retention_days:
        props[_PROP_RETENTION] = str(retention_days)

    def create(table: str, cols: list[str], options: list[str], where: str | None) -> None:
        parts = [f"OPTIONS ({', '.join(options)})"] if options else []
        parts += clauses + ([f"LOCATION '{where}'"] if where else [])
        if props:
            parts.append("TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in props.items()) + ")")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(cols)}) USING parquet " + " ".join(parts))

    if not partition_field:
        create(name, cols, options, location)
        return True
    create(name + OPEN, cols, options, location)
    # small row groups, so that a lookup or a range of the clustering keys skips most of a file
    lookups = [o for f in lookup_fields for o in (f"'parquet.bloom.filter.enabled#{f}' 'true'", f"'parquet.bloom.filter.expected.ndv#{f}' '200000'")]
    lookups += [f"'parquet.block.size' '{ROW_GROUP_BYTES}'"]
    create(name + CLOSED, [f"`{SOURCE_BATCH}` STRING", *cols], options + lookups, f"{location}{CLOSED}" if location else None)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}{MERGED} (`{PARTITION_COLUMN}` DATE, batch STRING, version STRING) USING parquet")
    _show(spark, name, {})
    return True


def _show(spark: SparkSession, name: str, closed: dict[str, str], previous: dict[str, str] | None = None) -> None:
    """Point the view ``name`` at the open batches and the published versions of closed days: one catalog operation."""
    cols = ", ".join(f"`{c}`" for c in spark.table(name + OPEN).columns)
    sql = f"SELECT {cols} FROM {name}{OPEN}"
    if closed:
        versions = ", ".join(f"'{v}'" for v in sorted(set(closed.values())))
        # a batch that a published version holds is hidden where it is (or, replayed, is again) in the open table
        sql += (f" o WHERE NOT EXISTS (SELECT 1 FROM {name}{MERGED} m WHERE m.version IN ({versions}) "
                f"AND m.{PARTITION_COLUMN} = o.{PARTITION_COLUMN} AND m.batch = o.{BATCH_COLUMN})")
        pairs = " OR ".join(f"({PARTITION_COLUMN} = DATE'{d}' AND {BATCH_COLUMN} = '{v}')" for d, v in sorted(closed.items()))
        sql += f" UNION ALL SELECT {cols} FROM {name}{CLOSED} WHERE {pairs}"
    text = lambda days: ",".join(f"{d}={v}" for d, v in sorted(days.items()))
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_PROP_CLOSED}' = '{text(closed)}', "
              f"'{_PROP_PREVIOUS}' = '{text(previous or {})}') AS {sql}")


def _days(text: str | None) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in (text or "").split(",") if pair)


def appended_to(spark: SparkSession, name: str) -> str:
    """The table that appends to ``name`` are written to."""
    return name + OPEN if spark.catalog.tableExists(name + OPEN) else name


def close_days(spark: SparkSession, name: str, before, partitions: int | None = None) -> list[dt.date]:
    """Rewrite the days of ``name`` before ``before`` that have open batches, each as one partition; returns them.

    The rows of those days, with what an earlier rewrite holds, are dealt by ranges of day, clustering keys and a
    hash of the row (which splits a hot key), sorted, and written as a new version. Then one replacement of the view
    shows it. A run that dies before leaves the old view, and its unpublished version is dropped by the next run; a
    run that dies after leaves hidden batches, which the next run drops. Nothing that the last view showed is deleted
    in the run that replaces it, so running readers end; rows may arrive for a closed day and are merged by the
    next run. A batch that is replayed after its day was closed stays hidden, as its rows are in the rewrite.

    Without ``partitions`` the number of files follows the shuffle's target size (adaptive execution).
    """
    open_table, closed_table = name + OPEN, name + CLOSED
    props = _props(spark, name)
    published, previous = _days(props.get(_PROP_CLOSED)), _days(props.get(_PROP_PREVIOUS))
    _drop_replaced(spark, name, published, previous)
    listed = _partition_values(spark, open_table).where(F.col(PARTITION_COLUMN) < F.lit(_as_date(before)))
    if published:
        known = spark.table(name + MERGED).where(F.col("version").isin(*published.values()))
        listed = listed.join(known.select(PARTITION_COLUMN, F.col("batch").alias(BATCH_COLUMN)), [PARTITION_COLUMN, BATCH_COLUMN], "left_anti")
    listed = materialize(listed, "batches")  # one row a batch; batches that arrive from now on wait for the next run
    days = sorted(r[0] for r in listed.select(PARTITION_COLUMN).distinct().collect())
    if not days:
        return []
    version = f"v{uuid.uuid4().hex[:16]}"
    cols = spark.table(open_table).columns
    rows = spark.table(open_table).where(F.col(PARTITION_COLUMN).isin(*days)).join(listed, [PARTITION_COLUMN, BATCH_COLUMN], "left_semi")
    rows = rows.select(F.col(BATCH_COLUMN).alias(SOURCE_BATCH), *cols)
    merged = listed.select(PARTITION_COLUMN, F.col(BATCH_COLUMN).alias("batch"))
    again = {str(d): published[str(d)] for d in days if str(d) in published}
    if again:
        old = F.lit(False)
        for d, v in again.items():
            old = old | ((F.col(PARTITION_COLUMN) == F.lit(d).cast("date")) & (F.col(BATCH_COLUMN) == v))
        rows = rows.unionByName(spark.table(closed_table).where(old).select(SOURCE_BATCH, *cols))
        merged = merged.unionByName(spark.table(name + MERGED).where(F.col("version").isin(*again.values()) & F.col(PARTITION_COLUMN).isin(*days)).select(PARTITION_COLUMN, "batch"))
    clustering = [c for c in _props(spark, open_table).get(_PROP_CLUSTER, "").split(",") if c]
    salt = F.xxhash64(*[c for c in cols if c not in (PARTITION_COLUMN, BATCH_COLUMN)])
    keys = [PARTITION_COLUMN, *clustering, salt]
    dealt = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    dealt = dealt.withColumn(BATCH_COLUMN, F.lit(version)).sortWithinPartitions(PARTITION_COLUMN, *clustering)
    # what was merged is noted first: without the version in the view it has no effect
    merged.select(PARTITION_COLUMN, "batch", F.lit(version).alias("version")).write.insertInto(name + MERGED)
    dealt.select(SOURCE_BATCH, *cols).write.insertInto(closed_table, overwrite=True)
    _show(spark, name, {**published, **{str(d): version for d in days}}, published)
    return days


def _drop_replaced(spark: SparkSession, name: str, published: dict[str, str], previous: dict[str, str]) -> None:
    """Drop what no reader of the present view, or of the one before, can see: merged batches and stray versions."""
    shown = set(published.items())
    if not shown and not previous:
        stray = _partition_values(spark, name + CLOSED)
    else:
        live = spark.createDataFrame([(dt.date.fromisoformat(d), v) for d, v in shown], f"{PARTITION_COLUMN} date, {BATCH_COLUMN} string")
        stray = _partition_values(spark, name + CLOSED).join(live, [PARTITION_COLUMN, BATCH_COLUMN], "left_anti")
        hidden = spark.table(name + MERGED).where(F.col("version").isin(*published.values()))
        hidden = hidden.select(PARTITION_COLUMN, F.col("batch").alias(BATCH_COLUMN))
        _drop_partitions(spark, name + OPEN, _partition_values(spark, name + OPEN).join(hidden, [PARTITION_COLUMN, BATCH_COLUMN], "left_semi"))
    _drop_partitions(spark, name + CLOSED, stray)


def _props(spark: SparkSession, name: str) -> dict:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r.key: r.value for r in rows}


def with_partition_date(df: DataFrame, source: str = "ingestion_time") -> DataFrame:
    """Add the daily partition column derived from a timestamp."""
    return df.withColumn(PARTITION_COLUMN, F.to_date(F.col(source)))


def layout(df: DataFrame, clustering: Iterable[str] = ()) -> DataFrame:
    """Sort each task's rows by day, then by the clustering keys (no shuffle)."""
    keys = ([PARTITION_COLUMN] if PARTITION_COLUMN in df.columns else []) + list(clustering)
    return df.sortWithinPartitions(*keys) if keys else df


def prepare_append(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    required: Iterable[str] = (),
    on_reject: str = "raise",
    batch: str | None = None,
):
    """The frame an append to ``name`` writes: REQUIRED check, partitions, layout.

    Returns ``(frame, observation_or_None)``.
    """
    name = appended_to(spark, name)
    props = _props(spark, name)
    obs = None
    required = list(required)
    if required:
        if on_reject == "raise":
            df = enforce_required(df, required, "raise")
        elif on_reject == "report":
            df, obs = enforce_required(df, required, "drop")
        else:
            raise ValueError(on_reject)
    if _PROP_SOURCE in props:
        df = with_partition_date(df, props[_PROP_SOURCE])
        df = df.withColumn(BATCH_COLUMN, F.lit(batch or uuid.uuid4().hex))
    clustering = [c for c in props.get(_PROP_CLUSTER, "").split(",") if c]
    df = layout(df, clustering)
    target = spark.table(name).columns
    return df.select(*target), obs


def append(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    required: Iterable[str] = (),
    on_reject: str = "raise",
    batch: str | None = None,
    today=None,
):
    """Append ``df`` to table ``name`` (bag semantics: duplicates are kept).

    ``batch`` names the append: the same rows appended again under one name
    replace the first ones. Without it every append is a batch of its own.

    ``on_reject='raise'``: a NULL in a REQUIRED column fails the job and
    nothing is committed. ``'report'``: such rows are skipped and counted;
    returns the Observation (``n_rejected``).

    A table with a retention is relieved of expired days first, once a day
    (``today``, by default the present UTC day).
    """
    enforce_retention(spark, name, today)
    frame, obs = prepare_append(spark, df, name, required, on_reject, batch)
    frame.write.insertInto(appended_to(spark, name), overwrite=BATCH_COLUMN in frame.columns)
    return obs


def append_or_reject(
    spark: SparkSession, df: DataFrame, name: str, required: Iterable[str], rejects: str, batch: str
) -> DataFrame:
    """Append the rows of ``df`` that ``name`` takes; keep the others, with column and reason, under ``rejects``.

    Rows are routed in one pass to a staged copy and appended from there under the batch's name, so a retry leaves
    each row, accepted or not, once. A row with several faults is kept once for each. Returns this batch's rejected
    rows: the columns of ``df`` and ``column``, ``reason``.
    """
    from ..session import checkpoint_root, path_exists, remove_path

    faults = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    staged = f"{checkpoint_root(spark)}/routed-{batch}"
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        routed = df.withColumn("_faults", faults).withColumn("_rejected", F.size("_faults") > 0)
        routed.write.mode("overwrite").partitionBy("_rejected").parquet(staged)
    schema = T.StructType([*df.schema.fields, T.StructField("_faults", T.ArrayType(T.StringType())), T.StructField("_rejected", T.BooleanType())])
    stored = spark.read.schema(schema).parquet(staged)
    append(spark, stored.where("NOT _rejected").drop("_rejected", "_faults"), name, required, batch=batch)
    bad = stored.where("_rejected").withColumn("column", F.explode("_faults")).drop("_rejected", "_faults")
    bad = bad.withColumn("reason", F.concat(F.lit("REQUIRED value is NULL: "), "column")).withColumn(BATCH_COLUMN, F.lit(batch))
    bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN).parquet(rejects)
    remove_path(spark, staged)
    return spark.read.schema(bad.schema).parquet(rejects).where(F.col(BATCH_COLUMN) == batch).drop(BATCH_COLUMN)


def create_or_replace_view(spark: SparkSession, name: str, select_sql: str) -> None:
    """A model materialised as a view (re-evaluated, and inlined, on every read)."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select_sql}")


def build_version(
    df: DataFrame, name: str, bucket_by: str | None = None, num_buckets: int | None = None
) -> str:
    """Write ``df`` as a new version of ``name`` (``name__v...``) and return the version's name.

    Readers of ``name`` are not affected until :func:`publish_version`; a build
    that fails leaves the published version as it is. ``bucket_by`` writes the
    version bucketed and sorted on that key, so later aggregations and joins on
    it (e.g. the ``unique`` test on ``event_id``) read co-partitioned files
    instead of shuffling. Rows are dealt by the key first, so every bucket is
    one file.
    """
    if bucket_by and not num_buckets:
        raise ValueError("a bucketed table needs its number of buckets")
    version = f"{name}__v{uuid.uuid4().hex[:12]}"
    writer = df.repartition(num_buckets, bucket_by).write if bucket_by else df.write
    if bucket_by:
        writer = writer.bucketBy(num_buckets, bucket_by).sortBy(bucket_by)
    try:
        writer.format("parquet").saveAsTable(version)
    except Exception:
        drop_version(df.sparkSession, version)
        raise
    return version


def publish_version(spark: SparkSession, name: str, version: str) -> None:
    """Point the view ``name`` at ``version``: one catalog operation, readers see the old or the new.

    The version shown before stays for readers that began before the switch;
    the one before that is dropped.
    """
    shown = _props(spark, name) if spark.catalog.tableExists(name) else {}
    previous, older = shown.get(_PROP_VERSION, ""), shown.get(_PROP_PREVIOUS, "")
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_PROP_VERSION}' = '{version}', "
        f"'{_PROP_PREVIOUS}' = '{previous}') AS SELECT * FROM {version}"
    )
    if older and older not in (version, previous):
        drop_version(spark, older)


def current_version(spark: SparkSession, name: str) -> str | None:
    """The version that the view ``name`` shows, if it has been published."""
    return _props(spark, name).get(_PROP_VERSION) if spark.catalog.tableExists(name) else None


def drop_version(spark: SparkSession, version: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {version}")


def analyze_sizes(spark: SparkSession, name: str) -> None:
    """Record a table's size in the catalog from its file listing (no data scan)."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")


# ---------------------------------------------------------------------------
# Retention
# ---------------------------------------------------------------------------


def _as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


def unexpired(df: DataFrame, as_of, days: int) -> DataFrame:
    """Rows whose day has not expired at ``as_of``: ``ingestion_date + days > as_of``.

    The predicate is on the partition column, so a table scan prunes whole
    partitions.
    """
    cutoff = _as_date(as_of) - dt.timedelta(days=days)
    return df.where(F.col(PARTITION_COLUMN) > F.lit(cutoff))


def _partition_values(spark: SparkSession, name: str) -> DataFrame:
    value = lambda key: F.regexp_extract("partition", f"{key}=([^/]*)", 1)
    return spark.sql(f"SHOW PARTITIONS {name}").select(
        F.to_date(value(PARTITION_COLUMN)).alias(PARTITION_COLUMN), value(BATCH_COLUMN).alias(BATCH_COLUMN)
    )


def partitions(spark: SparkSession, name: str) -> DataFrame:
    """``(ingestion_date)`` for every day of ``name`` (catalog metadata)."""
    found = [_partition_values(spark, t).select(PARTITION_COLUMN) for t in _stored_tables(spark, name)]
    return (found[0] if len(found) == 1 else found[0].unionByName(found[1])).distinct()


def _stored_tables(spark: SparkSession, name: str) -> list[str]:
    open_table = appended_to(spark, name)
    return [open_table, name + CLOSED] if open_table != name else [name]


def _drop_partitions(spark: SparkSession, table: str, found: DataFrame) -> set[dt.date]:
    """Drop the listed (day, batch) partitions; returns their days.

    Spark's ``DROP PARTITION`` takes equality specs only, so the batches are
    listed from the catalog (metadata: one row per batch) and dropped some
    hundreds at a time.
    """
    gone, specs = set(), []

    def drop():
        if specs:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")
            specs.clear()

    for r in found.toLocalIterator():
        gone.add(r[PARTITION_COLUMN])
        specs.append(f"PARTITION ({PARTITION_COLUMN} = DATE'{r[PARTITION_COLUMN].isoformat()}', {BATCH_COLUMN} = '{r[BATCH_COLUMN]}')")
        if len(specs) == 200:
            drop()
    drop()
    return gone


def expire_partitions(spark: SparkSession, name: str, as_of, days: int) -> list[dt.date]:
    """Drop the partitions of ``name`` that expired at ``as_of``, open and closed; returns their days."""
    cutoff = _as_date(as_of) - dt.timedelta(days=days)
    gone = set()
    for table in _stored_tables(spark, name):
        gone |= _drop_partitions(spark, table, _partition_values(spark, table).where(F.col(PARTITION_COLUMN) <= F.lit(cutoff)))
    return sorted(gone)


def enforce_retention(spark: SparkSession, name: str, today=None) -> list[dt.date]:
    """Expire ``name`` by the retention it carries, if that has not been done on or after ``today``; returns the days.

    The day of the last expiry is kept on the table, so a writer that appends every few seconds pays one look at the
    table's properties, and one that starts again does not expire again. Expiring twice is harmless.
    """
    table = appended_to(spark, name)
    props = _props(spark, table)
    if _PROP_RETENTION not in props:
        return []
    today = _as_date(today or dt.datetime.now(dt.timezone.utc))
    if props.get(_PROP_EXPIRED, "") >= today.isoformat():
        return []
    gone = expire_partitions(spark, name, today, int(props[_PROP_RETENTION]))
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_PROP_EXPIRED}' = '{today.isoformat()}')")
    return gone


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint root and read it back.

    Cuts the lineage where several consumers read one computed frame: it is
    computed once, survives the loss of any executor (the files are in the
    shared checkpoint folder, not in executor memory), and the read-back
    keeps column pruning and filter pushdown.
    """
    from ..session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
