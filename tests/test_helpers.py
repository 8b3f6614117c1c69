"""Scale helpers: gold versions and their files, retention predicate, scratch folders."""

import datetime as dt
import glob
import uuid

import pytest
from pyspark.sql import functions as F

from eventlake.session import checkpoint_root, path_exists, release_scratch, scratch_database, scratch_path
from eventlake.sinks import publish as K
from eventlake.sinks import tables as TB

SF = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark, tmp_path):
    name = scratch_database(f"d_{uuid.uuid4().hex[:8]}")
    TB.create_namespace(spark, name, str(tmp_path / "db"))
    return name


@pytest.mark.parametrize("buckets", [8, 13, 50])
def test_a_bucket_is_a_file(spark, database, tmp_path, buckets):
    """Also where the number of buckets is no multiple of the shuffle partitions."""
    rows = spark.range(0, 5000, 1, 7).select(F.col("id").alias("event_id"))
    version = TB.build_version(rows, f"{database}.gold", "event_id", buckets)
    assert len(glob.glob(f"{tmp_path}/db/{version.split('.')[1]}/part-*")) == buckets
    with pytest.raises(ValueError):
        TB.build_version(rows, f"{database}.gold", "event_id")


def test_failed_build_leaves_the_published_version(spark, database):
    name = f"{database}.gold"
    TB.publish_version(spark, name, TB.build_version(spark.range(4), name, "id", 2))
    broken = spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        TB.build_version(broken, name, "id", 2)
    assert spark.table(name).count() == 4
    old = TB.current_version(spark, name)
    versions = [TB.build_version(spark.range(n), name, "id", 2) for n in (5, 6)]
    for v in versions:
        TB.publish_version(spark, name, v)
    assert spark.table(name).count() == 6 and TB.current_version(spark, name) == versions[1]
    assert spark.catalog.tableExists(versions[0])  # for readers that began before the switch
    assert not spark.catalog.tableExists(old)


def test_files_are_sorted_by_the_clustering_keys(spark, tmp_path):
    rows = spark.range(0, 2000, 1, 3).select(
        (F.col("id") * 7919 % 50).alias("customer_id"), F.concat(F.lit("t"), F.col("id") % 5).alias("event_type"),
        F.expr("date_add(date'2024-01-01', cast(id % 3 as int))").alias("ingestion_date"),
    )
    out = str(tmp_path / "sorted")
    TB.layout(rows, ("event_type", "customer_id")).write.partitionBy("ingestion_date").parquet(out)
    for file in glob.glob(f"{out}/*/part-*"):
        got = [(r.event_type, r.customer_id) for r in spark.read.parquet(file).collect()]
        assert got and got == sorted(got)


def test_publish_keeps_source_order(spark, tmp_path):
    events = spark.createDataFrame([(9, 0), (1, 1), (5, 2)], "event_id bigint, pos int")
    K.publish(events, str(tmp_path / "a"), limit=1, order_by="pos")
    assert [r.value for r in spark.read.text(str(tmp_path / "a")).collect()] == ['{"event_id":9}']
    with pytest.raises(ValueError):
        K.publish(events, str(tmp_path / "b"), limit=1)


def test_scratch_is_released(spark):
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    name = scratch_database(f"d_{uuid.uuid4().hex[:8]}")
    TB.create_namespace(spark, name)
    assert path_exists(spark, path)
    release_scratch(spark)
    assert not path_exists(spark, path) and not spark.catalog.databaseExists(name)


def test_unexpired_keeps_days_after_the_cutoff(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (14, 15, 16, 17)], "ingestion_date date")
    kept = TB.unexpired(days, "2024-02-15", 30)  # cutoff: 2024-01-16
    assert sorted(r.ingestion_date.day for r in kept.collect()) == [17]
    kept_ts = TB.unexpired(days, dt.datetime(2024, 2, 15, 23, 59), 30)
    assert kept_ts.count() == 1


def test_checkpoint_root_and_scratch(spark):
    root = checkpoint_root(spark)
    assert root and not root.endswith("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)
