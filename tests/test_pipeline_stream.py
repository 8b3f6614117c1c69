"""Tables, retention, pipeline, streaming (stream = batch, restart) and file sources."""

import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import parse as P
from eventlake.plans import corpus as CP
from eventlake.plans import medallion as PL
from eventlake.sinks import publish as K
from eventlake.sinks import tables as TB
from eventlake.sources import files as SRC
from eventlake.streaming import ingest as ST

SF = "/root/testdata/sf0.001"


def fresh_layout(tmp_path):
    tag = uuid.uuid4().hex[:8]
    return PL.Layout(root=str(tmp_path), bronze_db=f"b_{tag}", silver_db=f"s_{tag}", gold_db=f"g_{tag}", gold_buckets=8)


def canonical_event(i, ts="2026-07-18T10:00:00Z", et="view"):
    return {"event_id": i, "event_type": et, "customer_id": 100 + i, "product_id": i % 3,
            "session_id": f"sess_{i:06d}", "event_timestamp": ts}


def test_medallion_end_to_end(spark, tmp_path):
    layout = fresh_layout(tmp_path)
    msgs = CP.mixed(CP.events(spark, SF))
    result = PL.run(spark, msgs, layout, raise_on_test_failure=False)
    n_total = CP.events(spark, SF).count()
    n_error = CP.events(spark, SF).where("event_type = 'error'").count()
    assert result.ingest == {"n_valid": n_total - n_error, "n_deadletter": n_error}
    assert result.layers["bronze"] == n_total - n_error
    assert result.layers["deadletter"] == n_error
    assert result.layers["gold"] == n_total - n_error
    failed = {(r.model, r.column_name, r.test) for r in result.tests if r.status == "fail"}
    assert failed == {("silver", "event_type", "accepted_values"), ("gold", "event_type", "accepted_values")}
    # raising mode stops the run at the tests
    with pytest.raises(Exception, match="quality tests failed"):
        PL.test(spark, layout)
    # a second ingest of the same batch is appended (bag), gold absorbs it
    PL.ingest(spark, msgs, layout)
    PL.build_models(spark, layout)
    layers = PL.validate(spark, layout)
    assert layers["bronze"] == 2 * (n_total - n_error)
    assert layers["gold"] == n_total - n_error
    # gold is bucketed on event_id: its unique test needs no shuffle
    plan = Q_plan(spark.table(layout.gold).groupBy("event_id").count())
    assert "Exchange" not in plan
    version = TB.current_version(spark, layout.gold)
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {version}").collect()}
    assert info["Num Buckets"] == str(layout.gold_buckets)


def Q_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_layout_and_retention(spark, tmp_path):
    layout = fresh_layout(tmp_path)
    PL.setup(spark, layout)
    PL.setup(spark, layout)  # idempotent: existing tables untouched
    rows = [json.dumps(canonical_event(i, f"2024-01-{d:02d}T10:00:00Z")) for i, d in enumerate(range(1, 11))]
    df = spark.createDataFrame([(r, dt.datetime(2024, 1, 1 + i, 12)) for i, r in enumerate(rows)],
                               "value string, arrival timestamp")
    PL.ingest(spark, df, layout, stamp=F.col("arrival"))
    parts = sorted(r.ingestion_date for r in TB.partitions(spark, layout.bronze).collect())
    assert len(parts) == 10
    # partition pruning on the derived day column
    pruned = TB.unexpired(spark.table(layout.bronze), "2024-02-05", 30)
    assert "PartitionFilters: [isnotnull(ingestion_date" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 4  # days 7..10 survive (day + 30 > Feb 5)
    dropped = TB.expire_partitions(spark, layout.bronze, "2024-02-05", 30)
    assert dropped == [dt.date(2024, 1, d) for d in range(1, 7)]
    assert spark.table(layout.bronze).count() == 4
    assert TB.expire_partitions(spark, layout.bronze, "2024-02-05", 30) == []


def test_required_columns_on_append(spark, tmp_path):
    layout = fresh_layout(tmp_path)
    PL.setup(spark, layout)
    bad = spark.createDataFrame(
        [(None, 20240101, 1, 1, "s", "view", dt.datetime(2024, 1, 1))],
        "event_id bigint, date_id bigint, customer_id bigint, product_id bigint, session_id string, "
        "event_type string, ingestion_time timestamp",
    )
    with pytest.raises(Exception, match="REQUIRED"):
        TB.append(spark, bad, layout.bronze, required=S.BRONZE_REQUIRED)
    assert spark.table(layout.bronze).count() == 0  # the failed job committed nothing
    obs = TB.append(spark, bad, layout.bronze, required=S.BRONZE_REQUIRED, on_reject="report")
    assert obs.get["n_rejected"] == 1 and spark.table(layout.bronze).count() == 0


def test_strict_batch_ingest_appends_nothing_on_bad_event(spark, tmp_path):
    layout = fresh_layout(tmp_path)
    PL.setup(spark, layout)
    df = spark.createDataFrame([(json.dumps(canonical_event(1)),), ("not json",)], "value string")
    with pytest.raises(Exception, match="bad event"):
        PL.ingest(spark, df, layout, mode="fail")
    assert spark.table(layout.bronze).count() == 0


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_equals_batch_and_restart(spark, tmp_path):
    arrivals = str(tmp_path / "arrivals")
    msgs = [json.dumps(canonical_event(i, et="view" if i % 2 else "purchase")) for i in range(40)]
    msgs += ["not json", "", json.dumps([1, 2]), '{"event_id": "x"}']
    write_lines(arrivals, "part-000.json", msgs[:20])
    write_lines(arrivals, "part-001.json", msgs[20:])
    out = str(tmp_path / "out")
    ckpt = str(tmp_path / "ckpt")
    source = ST.stream_source_lines(spark, arrivals, max_files_per_trigger=1)
    totals = ST.run_available_now(
        source, ST.path_sink(f"{out}/bronze"), ST.path_sink(f"{out}/dead"), ckpt
    )
    assert totals == {"n_messages": 44, "n_valid": 40, "n_deadletter": 4, "batches": 2}
    stream_rows = spark.read.parquet(f"{out}/bronze").drop("ingestion_time", "ingestion_date", "ingestion_batch")
    batch_rows = P.valid_rows(P.parse(SRC.read_lines(spark, arrivals))).drop("ingestion_time")
    assert stream_rows.exceptAll(batch_rows).count() == 0 and batch_rows.exceptAll(stream_rows).count() == 0
    dead = spark.read.parquet(f"{out}/dead")
    assert sorted(r.error for r in dead.collect()) == ["INVALID_INT:event_id", "INVALID_JSON", "INVALID_JSON", "NOT_AN_OBJECT"]
    # restart from the checkpoint: nothing re-read, only the new file
    write_lines(arrivals, "part-002.json", [json.dumps(canonical_event(100))])
    again = ST.run_available_now(ST.stream_source_lines(spark, arrivals), ST.path_sink(f"{out}/bronze"),
                                 ST.path_sink(f"{out}/dead"), ckpt)
    assert again["n_messages"] == 1
    assert spark.read.parquet(f"{out}/bronze").count() == 41


def test_stream_into_catalog_tables(spark, tmp_path):
    layout = fresh_layout(tmp_path)
    PL.setup(spark, layout)
    arrivals = str(tmp_path / "arrivals")
    write_lines(arrivals, "a.json", [json.dumps(canonical_event(i)) for i in range(5)] + ["oops"])
    totals = ST.run_available_now(
        ST.stream_source_lines(spark, arrivals),
        ST.table_sink(spark, layout.bronze, S.BRONZE_REQUIRED),
        ST.table_sink(spark, layout.deadletter, S.DEADLETTER_REQUIRED),
        str(tmp_path / "ckpt"),
    )
    assert totals["n_valid"] == 5
    assert spark.table(layout.bronze).count() == 5 and spark.table(layout.deadletter).count() == 1
    (dead,) = spark.table(layout.deadletter).collect()
    assert (dead.raw_message, dead.error) == ("oops", "INVALID_JSON") and dead.ingestion_time is not None


def test_publish_then_stream(spark, tmp_path):
    arrivals = str(tmp_path / "topic")
    events = spark.createDataFrame([(i, "view", i) for i in range(7)], "event_id bigint, event_type string, pos int")
    K.publish(events, arrivals, limit=5, order_by="pos")
    got = P.valid_rows(P.parse(SRC.read_lines(spark, arrivals)))
    assert sorted(r.event_id for r in got.collect()) == [0, 1, 2, 3, 4]
    K.publish(events.drop("pos"), arrivals, limit=0)  # falsy limit: all
    assert SRC.read_lines(spark, arrivals).count() == 12


def test_json_array_documents(spark, tmp_path):
    folder = tmp_path / "batches"
    folder.mkdir()
    for n in range(1, 4):
        events = [canonical_event(100 * n + i) for i in range(3)]
        (folder / f"batch_{n:02d}.json").write_text(json.dumps(events, indent=2))
    (folder / "single.json").write_text(json.dumps(canonical_event(999)))
    (folder / "notes.txt").write_text("ignored")
    docs = SRC.read_documents(spark, str(folder), glob="*.json")
    rows = SRC.explode_documents(docs)
    assert rows.count() == 10
    parsed = P.valid_rows(P.parse(rows))
    assert sorted(r.event_id for r in parsed.collect()) == sorted([100 * n + i for n in range(1, 4) for i in range(3)] + [999])
    first_two = SRC.explode_documents(SRC.read_documents(spark, str(folder), glob="batch_*.json"), limit=2)
    assert first_two.count() == 6 and sorted({r.pos for r in first_two.collect()}) == [0, 1]
    listing = SRC.list_batches(spark, str(folder))
    assert sorted(r.batch_num for r in listing.collect()) == [1, 2, 3]
    assert SRC.pick_batch(spark, str(folder), dt.datetime(2026, 7, 18, 10, 25)).endswith("batch_03.json")
    assert SRC.pick_batch(spark, str(folder), dt.datetime(2026, 7, 18, 10, 31)).endswith("batch_01.json")
    assert SRC.pick_batch(spark, str(folder), dt.datetime(2026, 7, 18, 10, 15)).endswith("batch_02.json")
    with pytest.raises(FileNotFoundError):
        SRC.pick_batch(spark, str(tmp_path), dt.datetime(2026, 7, 18, 10, 15))
    (folder / "batch_01.json").unlink()  # by number, not by position
    assert SRC.pick_batch(spark, str(folder), dt.datetime(2026, 7, 18, 10, 15)).endswith("batch_02.json")
    with pytest.raises(FileNotFoundError, match="number 1"):
        SRC.pick_batch(spark, str(folder), dt.datetime(2026, 7, 18, 10, 25))


def test_non_json_document_dead_letters(spark, tmp_path):
    (tmp_path / "bad.json").write_text("[{\"event_id\": 1}, oops")
    rows = SRC.explode_documents(SRC.read_documents(spark, str(tmp_path)))
    (row,) = P.deadletter_rows(P.parse(rows)).collect()
    assert row.error == "INVALID_JSON"


def test_rotation_formula(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1, 0, m),) for m in (0, 9, 10, 35, 59)], "ts timestamp_ntz")
    assert [r.s for r in df.select(SRC.rotation_slot(F.col("ts"), 10).alias("s")).collect()] == [1, 1, 2, 4, 6]
    assert [r.s for r in df.select(SRC.rotation_slot(F.col("ts"), 4).alias("s")).collect()] == [1, 1, 2, 4, 2]


def test_processing_time_trigger(spark, tmp_path):
    arrivals = str(tmp_path / "arrivals")
    write_lines(arrivals, "a.json", [json.dumps(canonical_event(i)) for i in range(3)])
    out = str(tmp_path / "out")
    query = ST.start_ingest(
        ST.stream_source_lines(spark, arrivals),
        ST.path_sink(f"{out}/bronze"),
        ST.path_sink(f"{out}/dead"),
        str(tmp_path / "ckpt"),
        trigger="1 second",
        query_name=f"ingest_{uuid.uuid4().hex[:6]}",
    )
    try:
        query.processAllAvailable()
        write_lines(arrivals, "b.json", [json.dumps(canonical_event(10 + i)) for i in range(2)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(f"{out}/bronze").count() == 5


def test_kafka_source_is_gated(spark):
    with pytest.raises(Exception):
        ST.stream_source_kafka(spark, "localhost:1", "events")


def test_binary_messages_decode_like_text(spark):
    msgs = [json.dumps(canonical_event(1)).encode(), b"\xff\xfe", b"not json"]
    df = spark.createDataFrame([(bytearray(m),) for m in msgs], "value binary")
    parsed = P.parse(df)
    assert [r.event_id for r in P.valid_rows(parsed).collect()] == [1]
    assert sorted(r.error for r in P.deadletter_rows(parsed).collect()) == ["INVALID_JSON", "INVALID_UTF8"]


def test_test_before_publish(spark, tmp_path):
    layout = fresh_layout(tmp_path)
    good = spark.createDataFrame(
        [(json.dumps(canonical_event(i, et="view")),) for i in range(4)], "value string")
    PL.run(spark, good, layout, test_before_publish=True)
    assert spark.table(layout.gold).count() == 4
    published = TB.current_version(spark, layout.gold)
    # a batch that fails accepted_values: the published gold stays as it was
    bad = spark.createDataFrame([(json.dumps(canonical_event(9, et="bogus")),)], "value string")
    with pytest.raises(Exception, match="quality tests failed"):
        PL.run(spark, bad, layout, test_before_publish=True)
    assert sorted(r.event_id for r in spark.table(layout.gold).collect()) == [0, 1, 2, 3]
    assert TB.current_version(spark, layout.gold) == published


def test_failed_rebuild_keeps_gold(spark, tmp_path):
    layout = fresh_layout(tmp_path)
    good = spark.createDataFrame([(json.dumps(canonical_event(i)),) for i in range(4)], "value string")
    PL.run(spark, good, layout)
    with pytest.raises(Exception, match="no build"):
        PL.build_models(spark, layout, transformed_at=F.raise_error(F.lit("no build")).cast("timestamp"))
    assert sorted(r.event_id for r in spark.table(layout.gold).collect()) == [0, 1, 2, 3]


class Crash(Exception):
    pass


@pytest.mark.parametrize("after", ["bronze", "deadletter"])
@pytest.mark.parametrize("kind", ["stream-paths", "stream-tables", "load"])
def test_replay_leaves_every_message_once(spark, tmp_path, kind, after):
    """A crash right after either append, then the same work again."""
    layout = fresh_layout(tmp_path)
    PL.setup(spark, layout)
    arrivals = str(tmp_path / "arrivals")
    write_lines(arrivals, "a.json", [json.dumps(canonical_event(i)) for i in range(6)] + ["bad one", "bad two"])
    out = str(tmp_path / "out")
    if kind == "stream-paths":
        sinks = {"bronze": ST.path_sink(f"{out}/bronze"), "deadletter": ST.path_sink(f"{out}/deadletter")}
        read = lambda name: spark.read.parquet(f"{out}/{name}")
    else:
        sinks = {"bronze": ST.table_sink(spark, layout.bronze, S.BRONZE_REQUIRED),
                 "deadletter": ST.table_sink(spark, layout.deadletter, S.DEADLETTER_REQUIRED)}
        read = lambda name: spark.table(getattr(layout, name))

    def crashing(df, batch):
        sinks[after](df, batch)
        raise Crash("after the append")

    broken = {**sinks, after: crashing}
    if kind == "load":
        parsed = P.parse(SRC.read_lines(spark, arrivals))
        for s in (broken, sinks):
            try:
                ST.fan_out(s["bronze"], s["deadletter"], str(tmp_path / "staging"), None, lambda: "load-7")(parsed, 0)
            except Crash:
                assert s is broken
    else:
        source = lambda: ST.stream_source_lines(spark, arrivals)
        with pytest.raises(Exception, match="after the append"):
            ST.run_available_now(source(), broken["bronze"], broken["deadletter"], str(tmp_path / "ckpt"))
        ST.run_available_now(source(), sinks["bronze"], sinks["deadletter"], str(tmp_path / "ckpt"))
        # a further batch is appended, not replaced
        write_lines(arrivals, "b.json", [json.dumps(canonical_event(6))])
        ST.run_available_now(source(), sinks["bronze"], sinks["deadletter"], str(tmp_path / "ckpt"))
    assert sorted(r.event_id for r in read("bronze").collect()) == list(range(6 if kind == "load" else 7))
    assert sorted(r.raw_message for r in read("deadletter").collect()) == ["bad one", "bad two"]


def test_named_load_run_again(spark, tmp_path):
    layout = fresh_layout(tmp_path)
    PL.setup(spark, layout)
    msgs = spark.createDataFrame([(json.dumps(canonical_event(i)), dt.datetime(2024, 1, 1)) for i in range(3)], "value string, at timestamp")
    for name in ("monday", "monday", "tuesday"):
        PL.ingest(spark, msgs, layout, stamp=F.col("at"), load_id=name)
    assert spark.table(layout.bronze).count() == 6


def test_nan_costs_no_other_event(spark, tmp_path):
    text = '[{"event_id": 1}, {"event_id": 2, "score": NaN, "session_id": 7}, {"event_id": 3, "x": -Infinity}]'
    (tmp_path / "nan.json").write_text(text)
    (tmp_path / "one.json").write_text('{"event_id": 4, "score": NaN}')
    (tmp_path / "cut.json").write_text('[{"event_id": 5}, {"event_id"')
    parsed = P.parse(SRC.explode_documents(SRC.read_documents(spark, str(tmp_path))))
    assert sorted(r.event_id for r in P.valid_rows(parsed).collect()) == [1, 2, 3]
    # an object root is one message, and NaN is no strict JSON; text cut off is none at all
    assert [r.error for r in P.deadletter_rows(parsed).collect()] == ["INVALID_JSON"] * 2


def test_run_expires_by_default(spark, tmp_path):
    layout = fresh_layout(tmp_path)
    old = dt.datetime.now() - dt.timedelta(days=90)
    msgs = spark.createDataFrame([(json.dumps(canonical_event(1)), old), (json.dumps(canonical_event(2)), dt.datetime.now())], "value string, at timestamp")
    result = PL.run(spark, msgs, layout, stamp=F.col("at"))
    assert result.expired == [old.date()] and [r.event_id for r in spark.table(layout.gold).collect()] == [2]


def test_rotating_batch_documents_are_bounded(spark, monkeypatch):
    """No document of the written batches holds more than 50 events, and the slot's batch is loaded whole."""
    from eventlake.plans import stored
    from eventlake.session import release_scratch

    seen = []
    explode = SRC.explode_documents
    monkeypatch.setattr(SRC, "explode_documents", lambda docs, *a, **k: seen.append(docs) or explode(docs, *a, **k))
    rows = stored.q_rotating_batch(spark, "/root/testdata/sf0.001").count()
    held = [len(json.loads(r.value)) for r in seen[0].select("value").collect()]
    assert sum(held) == rows > 50 and max(held) <= 50
    release_scratch(spark)
