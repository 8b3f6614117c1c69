"""Rewritten days: equal rows, one partition a day, crashes, late and replayed batches; retention kept on the table."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.plans import medallion as PL
from eventlake.sinks import tables as TB
from eventlake.streaming import ingest as ST

from .test_pipeline_stream import canonical_event, fresh_layout, write_lines

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def load(spark, layout, name, ids, day):
    rows = [(json.dumps(canonical_event(i, et="view" if i % 3 else "login")), dt.datetime.combine(day, dt.time(12))) for i in ids]
    PL.ingest(spark, spark.createDataFrame(rows, "value string, at timestamp"), layout, stamp=F.col("at"), load_id=name)


def ids(spark, layout):
    return sorted(r.event_id for r in spark.table(layout.bronze).select("event_id").collect())


def batches(spark, layout, day):
    return {r.ingestion_batch for r in spark.table(layout.bronze).where(F.col("ingestion_date") == F.lit(day)).select("ingestion_batch").collect()}


@pytest.fixture
def layout(spark, tmp_path):
    out = fresh_layout(tmp_path)
    PL.setup(spark, out)
    for k in range(6):
        load(spark, out, f"batch{k}", range(10 * k, 10 * k + 10), DAYS[k % 3])
    return out


def test_days_become_one_partition(spark, layout):
    before = sorted(map(tuple, spark.table(layout.bronze).select(*S.BRONZE_COLUMNS).collect()))
    assert all(len(batches(spark, layout, d)) == 2 for d in DAYS)
    assert TB.close_days(spark, layout.bronze, DAYS[2]) == DAYS[:2]
    assert sorted(map(tuple, spark.table(layout.bronze).select(*S.BRONZE_COLUMNS).collect())) == before
    assert [len(batches(spark, layout, d)) for d in DAYS] == [1, 1, 2]
    assert TB.close_days(spark, layout.bronze, DAYS[2]) == []  # drops what the last run merged
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {layout.bronze}{TB.OPEN}").collect()} == {
        f"ingestion_date=2024-01-03/ingestion_batch=batch{k}-0" for k in (2, 5)}
    assert sorted(map(tuple, spark.table(layout.bronze).select(*S.BRONZE_COLUMNS).collect())) == before
    assert sorted(r.ingestion_date for r in TB.partitions(spark, layout.bronze).collect()) == DAYS
    # a closed day is sorted by the clustering keys
    day = spark.table(layout.bronze).where(F.col("ingestion_date") == F.lit(DAYS[0])).select(*S.BRONZE_CLUSTER_KEYS).collect()
    assert [tuple(r) for r in day] == sorted(tuple(r) for r in day)


def test_late_and_replayed_batches(spark, layout):
    TB.close_days(spark, layout.bronze, DAYS[2])
    load(spark, layout, "late", [100, 101], DAYS[0])
    assert ids(spark, layout) == [*range(60), 100, 101]
    load(spark, layout, "batch0", range(10), DAYS[0])  # the replay of a batch that is in the rewrite
    assert ids(spark, layout) == [*range(60), 100, 101]
    assert TB.close_days(spark, layout.bronze, DAYS[2]) == [DAYS[0]]
    assert ids(spark, layout) == [*range(60), 100, 101] and len(batches(spark, layout, DAYS[0])) == 1
    load(spark, layout, "late", [100, 101], DAYS[0])
    TB.close_days(spark, layout.bronze, DAYS[2])
    assert ids(spark, layout) == [*range(60), 100, 101]


@pytest.mark.parametrize("step", ["merged", "written", "shown", "dropped"])
def test_a_crash_leaves_the_old_or_the_new(spark, layout, monkeypatch, step):
    class Crash(Exception):
        pass

    def crash(*args, **kwargs):
        raise Crash(step)

    with monkeypatch.context() as m:
        if step == "merged":  # before the rewrite is written
            m.setattr(TB, "_props", lambda spark, name, real=TB._props: crash() if name.endswith(TB.OPEN) else real(spark, name))
        elif step == "written":
            m.setattr(TB, "_show", crash)
        elif step == "shown":
            m.setattr(TB, "_show", lambda *a, real=TB._show: (real(*a), crash()))
        else:
            TB.close_days(spark, layout.bronze, DAYS[2])
            m.setattr(TB, "_drop_replaced", lambda *a, real=TB._drop_replaced: (real(*a), crash()))
        with pytest.raises(Crash):
            TB.close_days(spark, layout.bronze, DAYS[2])
    assert ids(spark, layout) == list(range(60))
    TB.close_days(spark, layout.bronze, DAYS[2])
    assert ids(spark, layout) == list(range(60)) and [len(batches(spark, layout, d)) for d in DAYS] == [1, 1, 2]
    TB.close_days(spark, layout.bronze, DAYS[2])
    left = spark.sql(f"SHOW PARTITIONS {layout.bronze}{TB.CLOSED}").count()
    assert left == 2 and ids(spark, layout) == list(range(60))


def test_closed_days_expire(spark, layout):
    TB.close_days(spark, layout.bronze, DAYS[2])
    assert TB.expire_partitions(spark, layout.bronze, "2024-02-01", 30) == [DAYS[0], DAYS[1]]
    assert ids(spark, layout) == sorted([*range(20, 30), *range(50, 60)])


def test_a_stream_drops_its_31st_day(spark, tmp_path):
    """Nothing but the stream runs: its sinks enforce the retention that the tables carry."""
    layout = PL.Layout(**{**fresh_layout(tmp_path).__dict__, "retention_days": 30})
    PL.setup(spark, layout)
    arrivals = str(tmp_path / "arrivals")
    for n in range(3):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=15 * n + (n > 1))  # 1, 16 and 32 January
        write_lines(arrivals, f"{n}.json", [json.dumps(canonical_event(n))] + ["bad"])
        sinks = [ST.table_sink(spark, t, r, today=lambda day=day: day) for t, r in (
            (layout.bronze, S.BRONZE_REQUIRED), (layout.deadletter, S.DEADLETTER_REQUIRED))]
        stamp = F.lit(f"{day} 12:00:00").cast("timestamp")
        ST.run_available_now(ST.stream_source_lines(spark, arrivals), *sinks, str(tmp_path / "ckpt"), stamp=stamp)
        assert TB.enforce_retention(spark, layout.bronze, day) == []  # done for this day
    assert ids(spark, layout) == [1, 2]
    assert spark.table(layout.deadletter).count() == 2


def test_lookup_skips_row_groups(spark, tmp_path):
    """Clustering statistics skip files; of an event id, which is spread over its day, Bloom filters do."""
    layout = fresh_layout(tmp_path)
    PL.setup(spark, layout)
    rows = spark.range(40000).select(
        F.col("id").alias("event_id"), F.lit(20240101).cast("long").alias("date_id"), (F.col("id") % 500).alias("customer_id"), F.col("id").alias("product_id"),
        F.concat(F.lit("s"), "id").alias("session_id"), F.element_at(F.array(*map(F.lit, S.ACCEPTED_EVENT_TYPES)), (F.col("id") % 6 + 1).cast("int")).alias("event_type"),
        F.lit("2024-01-01 10:00:00").cast("timestamp").alias("ingestion_time"))
    TB.append(spark, rows, layout.bronze)
    TB.close_days(spark, layout.bronze, DAYS[2], partitions=8)
    TB.close_days(spark, layout.bronze, DAYS[2])
    closed = spark.table(layout.bronze + TB.CLOSED)

    def scanned(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        nodes, found = [df._jdf.queryExecution().executedPlan()], 0
        while nodes:
            node = nodes.pop()
            if "AdaptiveSparkPlan" in node.nodeName():
                nodes.append(node.executedPlan())
            if "Scan" in node.nodeName():
                found += node.metrics().apply("numOutputRows").value()
            kids = node.children()
            nodes += [kids.apply(i) for i in range(kids.size())]
        assert "PushedFilters" in plan or "FileScan" in plan
        return found

    assert scanned(closed.where("event_type = 'login' AND customer_id < 40")) <= 12000
    assert scanned(closed.where("event_id = 20001").select("event_id", "session_id")) <= 12000
    assert [r.session_id for r in PL.lookup(spark, layout, [20001]).collect()] == ["s20001"]
