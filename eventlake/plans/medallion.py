"""The full medallion run: setup -> ingest -> silver/gold -> tests -> validate.

Each step is a plain function over a :class:`Layout` (namespaces, table names,
storage root), called in order; the first failure stops the run, like the
scheduled chain it replaces. Model order follows the references between
models: gold reads the silver view, which reads bronze.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import models as M
from ..operators import parse as P
from ..operators import quality as Q
from ..session import checkpoint_root, configure
from ..sinks import tables as TB
from ..sources import arrays as ARR
from ..sources import files as SRC
from ..streaming import ingest as ST


@dataclass(frozen=True)
class Layout:
    """Where the three layers live. ``root`` (a shared folder) holds their files."""

    root: str | None = None
    bronze_db: str = S.BRONZE_DB
    silver_db: str = S.SILVER_DB
    gold_db: str = S.GOLD_DB
    bronze_table: str = S.BRONZE_TABLE
    deadletter_table: str = S.DEADLETTER_TABLE
    silver_view: str = S.SILVER_VIEW
    gold_table: str = S.GOLD_TABLE
    retention_days: int | None = None  # kept on the tables, so that every writer enforces it; None: only `expire` does
    gold_buckets: int = 64  # of every gold version; choose it for the table's size, about 256 MB a bucket

    @property
    def bronze(self) -> str:
        return f"{self.bronze_db}.{self.bronze_table}"

    @property
    def deadletter(self) -> str:
        return f"{self.bronze_db}.{self.deadletter_table}"

    @property
    def silver(self) -> str:
        return f"{self.silver_db}.{self.silver_view}"

    @property
    def gold(self) -> str:
        return f"{self.gold_db}.{self.gold_table}"

    def location(self, db: str) -> str | None:
        return f"{self.root.rstrip('/')}/{db}.db" if self.root else None


@dataclass
class RunResult:
    ingest: dict = field(default_factory=dict)
    tests: list = field(default_factory=list)
    layers: dict = field(default_factory=dict)
    expired: list = field(default_factory=list)


# ---------------------------------------------------------------------------
# Steps
# ---------------------------------------------------------------------------


def setup(spark: SparkSession, layout: Layout) -> None:
    """Namespaces and the two bronze tables (day partitions; bronze clustered)."""
    for db in (layout.bronze_db, layout.silver_db, layout.gold_db):
        TB.create_namespace(spark, db, layout.location(db))
    TB.create_table(
        spark, layout.bronze, S.BRONZE_SCHEMA,
        partition_field="ingestion_time", clustering_fields=S.BRONZE_CLUSTER_KEYS,
        retention_days=layout.retention_days, lookup_fields=S.BRONZE_LOOKUP_KEYS,
    )
    TB.create_table(spark, layout.deadletter, S.DEADLETTER_SCHEMA, partition_field="ingestion_time", retention_days=layout.retention_days)


def ingest(
    spark: SparkSession,
    messages: DataFrame,
    layout: Layout,
    mode: str = "deadletter",
    value: str = "value",
    stamp: Column | None = None,
    load_id: str | None = None,
    max_messages: int | None = None,
) -> dict:
    """Decode ``messages`` and append to bronze (and dead-letter); returns counts.

    ``mode='fail'`` (strict batch ingest): the first bad message fails the
    bronze write, and nothing is appended. ``mode='drop'`` (the consumer): bad
    messages are dropped and counted, rows that the table rejects are reported
    and the rest is appended; ``max_messages`` bounds the pull.

    ``load_id`` names the load: a load that failed on the way is run again
    under its name and leaves every row once. A name must not be given to
    other messages.
    """
    load_id = load_id or uuid.uuid4().hex
    if max_messages:
        messages = SRC.bounded(messages, max_messages)
    parsed = P.parse(messages, value=value, stamp=stamp, mode=mode)
    bronze = ST.table_sink(spark, layout.bronze, S.BRONZE_REQUIRED)
    if mode == "deadletter":
        # the same callback as a streaming micro-batch: decode once, two appends,
        # row counts observed on the writes themselves
        totals = {"n_messages": 0, "n_valid": 0, "n_deadletter": 0, "batches": 0}
        deadletter = ST.table_sink(spark, layout.deadletter, S.DEADLETTER_REQUIRED)
        staging = f"{checkpoint_root(spark)}/loads"
        ST.fan_out(bronze, deadletter, staging, totals, lambda: load_id)(parsed, 0)
        return {"n_valid": totals["n_valid"], "n_deadletter": totals["n_deadletter"]}
    if mode == "drop":
        valid, obs = P.drop_bad(parsed)
        rejected = TB.append(spark, valid, layout.bronze, S.BRONZE_REQUIRED, on_reject="report", batch=load_id)
        return {**obs.get, **rejected.get}
    seen = Observation()
    bronze(P.valid_rows(parsed).observe(seen, F.count(F.lit(1)).alias("n_valid")), load_id)
    return dict(seen.get)


def rotating_batch(spark: SparkSession, folder: str, at, layout: Layout, stamp: Column | None = None, folders: bool = False, **ranges) -> dict:
    """One scheduled batch run: the file whose number is the slot of ``at``, strictly parsed and appended.

    A file is one JSON array, read by ranges where it is large. With ``folders`` a batch is a folder of any number of
    files with a JSON document a line.

    Any bad event fails the run and appends nothing; a run repeated for one
    file and day replaces its own append.
    """
    path = SRC.pick_batch_folder(spark, folder, at) if folders else SRC.pick_batch(spark, folder, at)
    events = SRC.explode_documents(SRC.read_lines(spark, path)) if folders else ARR.read_arrays(spark, path, **ranges)
    name = f"{path.rsplit('/', 1)[-1]}-{at:%Y%m%dT%H%M}"
    return ingest(spark, events, layout, mode="fail", stamp=stamp, load_id=name)


def silver_sql(layout: Layout) -> str:
    cols = ", ".join(S.BRONZE_COLUMNS)
    return f"SELECT {cols} FROM {layout.bronze} WHERE event_id IS NOT NULL"


def build_models(
    spark: SparkSession,
    layout: Layout,
    method: str = "aggregate",
    transformed_at: Column | None = None,
    publish: bool = True,
) -> str:
    """Silver as a view over bronze, gold as a fully rebuilt table read from silver.

    Gold is built as a new version, bucketed by ``event_id`` (its ``unique``
    test and later joins on the key read co-partitioned files), and then
    published by one switch of the gold view: readers see the old version or
    the new one, and a failed rebuild leaves the old one. Returns the version;
    with ``publish=False`` the caller switches (see :func:`run`).
    """
    TB.create_or_replace_view(spark, layout.silver, silver_sql(layout))
    gold = M.gold(spark.table(layout.silver), transformed_at=transformed_at, method=method)
    version = TB.build_version(gold, layout.gold, bucket_by="event_id", num_buckets=layout.gold_buckets)
    if publish:
        TB.publish_version(spark, layout.gold, version)
    return version


def models_of(spark: SparkSession, layout: Layout, gold_table: str | None = None) -> dict[str, DataFrame]:
    return {"silver": spark.table(layout.silver), "gold": spark.table(gold_table or layout.gold)}


def test(spark: SparkSession, layout: Layout, raise_on_failure: bool = True, gold_table: str | None = None) -> list:
    """Run the 11 column tests; one row per test."""
    result = Q.run_suite(models_of(spark, layout, gold_table))
    return Q.assert_suite(result) if raise_on_failure else result.collect()


def layer_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    return Q.layer_counts(
        {
            "bronze": spark.table(layout.bronze),
            "deadletter": spark.table(layout.deadletter),
            "silver": spark.table(layout.silver),
            "gold": spark.table(layout.gold),
        }
    )


def validate(spark: SparkSession, layout: Layout) -> dict:
    """Layer counts; only an empty bronze is an error."""
    return Q.validate_layers(layer_counts(spark, layout))


def expire(spark: SparkSession, layout: Layout, as_of=None, days: int = S.RETENTION_DAYS) -> list:
    """Drop expired days of the bronze and dead-letter tables."""
    as_of = as_of or dt.datetime.now(dt.timezone.utc)
    out = []
    for name in (layout.bronze, layout.deadletter):
        out += TB.expire_partitions(spark, name, as_of, days)
    return out


def close_days(spark: SparkSession, layout: Layout, before=None, partitions: int | None = None) -> dict:
    """Maintenance: rewrite the days before ``before`` (default: today), one partition each; returns them by table."""
    before = before or dt.datetime.now(dt.timezone.utc)
    return {name: TB.close_days(spark, name, before, partitions) for name in (layout.bronze, layout.deadletter)}


def lookup(spark: SparkSession, layout: Layout, event_ids: list[int], days=None) -> DataFrame:
    """Bronze rows of some events: row-group statistics and Bloom filters of closed days skip what cannot hold them."""
    rows = spark.table(layout.bronze).where(F.col("event_id").isin(*event_ids))
    if days:
        rows = rows.where(F.col(TB.PARTITION_COLUMN).isin(*days))
    return rows.select(*S.BRONZE_COLUMNS)


def run(
    spark: SparkSession,
    messages: DataFrame,
    layout: Layout,
    mode: str = "deadletter",
    method: str = "aggregate",
    raise_on_test_failure: bool = True,
    stamp: Column | None = None,
    expire_as_of=None,
    test_before_publish: bool = False,
    load_id: str | None = None,
) -> RunResult:
    """Setup -> ingest -> retention -> silver/gold -> tests -> validation.

    Days older than the retention at ``expire_as_of`` (default: now) are
    dropped after the ingest; ``False`` keeps them. By default gold is
    published first and tested after, so a failing test leaves the new gold
    visible (the original order). With ``test_before_publish`` the new version
    is tested before the switch and dropped when a test fails.
    """
    configure(spark)
    result = RunResult()
    setup(spark, layout)
    result.ingest = ingest(spark, messages, layout, mode=mode, stamp=stamp, load_id=load_id)
    if expire_as_of is not False:
        result.expired = expire(spark, layout, expire_as_of)
    version = build_models(spark, layout, method=method, publish=not test_before_publish)
    if test_before_publish:
        result.tests = test(spark, layout, raise_on_failure=False, gold_table=version)
        if all(r.status == "pass" for r in result.tests):
            TB.publish_version(spark, layout.gold, version)
        else:
            TB.drop_version(spark, version)
            if raise_on_test_failure:
                Q.check_rows(result.tests)
    else:
        result.tests = test(spark, layout, raise_on_failure=raise_on_test_failure)
    result.layers = validate(spark, layout)
    return result
