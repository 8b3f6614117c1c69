"""Pulls of n messages, publishing once with outcomes, and rejected rows that are kept."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import parse as P
from eventlake.plans import medallion as PL
from eventlake.sinks import publish as K
from eventlake.sinks import tables as TB
from eventlake.sources import files as SRC
from eventlake.sources import messages as MSG
from eventlake.streaming import ingest as ST

from .test_pipeline_stream import canonical_event, fresh_layout, write_lines


def test_three_pulls_with_a_crash_between(spark, tmp_path):
    """25 messages in two files, pulls of ten; the second pull dies after its append and is run again."""
    arrivals, out = str(tmp_path / "arrivals"), str(tmp_path / "out")
    texts = [json.dumps(canonical_event(i)) for i in range(25)]
    write_lines(arrivals, "a.json", texts[:14])
    with open(os.path.join(arrivals, "b.json"), "w") as f:
        f.write("\r\n".join(texts[14:]))  # the last line has no end

    def pull(crash=False):
        source = MSG.stream_messages(spark, arrivals, 10, str(tmp_path / "position"))
        bronze = ST.path_sink(f"{out}/bronze")

        def broken(df, batch):
            bronze(df, batch)
            raise RuntimeError("after the append")

        return ST.run_available_now(source, broken if crash else bronze, ST.path_sink(f"{out}/dead"), str(tmp_path / "ckpt"))["n_messages"]

    stored = lambda: sorted(r.event_id for r in spark.read.parquet(f"{out}/bronze").select("event_id").collect())
    assert pull() == 10 and stored() == list(range(10))
    with pytest.raises(Exception, match="after the append"):
        pull(crash=True)
    assert pull() == 10 and stored() == list(range(20))  # the replay of the second pull
    assert pull() == 5  # the third
    assert stored() == list(range(25))
    write_lines(arrivals, "c.json", [json.dumps(canonical_event(99))])
    assert pull() == 1 and stored() == [*range(25), 99]


def test_line_ends_of_a_pull(tmp_path):
    (tmp_path / "x").write_bytes(b"a\n\nbc\nd")
    with open(tmp_path / "x", "rb") as f:
        f.read_at = lambda n, at: (f.seek(at), f.read(n))[1]
        assert [MSG._after_lines(f, 0, 7, n)[:2] for n in range(6)] == [(0, 0), (2, 1), (3, 2), (6, 3), (7, 4), (7, 4)]


def events(spark):
    bad = F.concat(F.encode(F.lit("x"), "utf-8"), F.lit(bytearray(b"\xff"))).cast("string")
    return spark.range(8).select(
        F.col("id").alias("event_id"), F.when(F.col("id") == 3, bad).when(F.col("id") == 5, F.repeat(F.lit("y"), 500)).otherwise("view").alias("event_type"),
        F.col("id").alias("id"))


@pytest.mark.parametrize("crash", [None, "encoded", "renamed"])
def test_published_once_with_outcomes(spark, tmp_path, monkeypatch, crash):
    topic = str(tmp_path / "topic")
    send = lambda: K.publish_once(events(spark), topic, "monday", ["event_id", "event_type"], ("id",), max_bytes=200)
    if crash:
        target = topic + "/monday"
        with monkeypatch.context() as m:
            if crash == "encoded":  # the messages are staged, the rename has not happened
                m.setattr(K, "remove_path", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
                with pytest.raises(RuntimeError, match="stop"):
                    send()
                assert not os.path.exists(target)
            else:
                send()  # the caller died before it knew
    for _ in range(2):
        done = {r.id: (r.status, r.reason) for r in send().collect()}
    assert done == {i: ("failed", K.NOT_ENCODABLE) if i == 3 else ("failed", K.TOO_LARGE) if i == 5 else ("published", None) for i in range(8)}
    got = P.valid_rows(P.parse(SRC.read_lines(spark, f"{topic}/*")))
    assert sorted(r.event_id for r in got.collect()) == [0, 1, 2, 4, 6, 7]


def test_rejected_rows_are_kept(spark, tmp_path):
    layout = fresh_layout(tmp_path)
    PL.setup(spark, layout)
    at = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [(1, 20240101, 1, 1, "s", "view", at), (None, 20240101, 2, 2, "s", "view", at), (None, None, 3, 3, "s", "view", at)],
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.BRONZE_SCHEMA))
    rejects = str(tmp_path / "rejects")
    for name in ("one", "one", "two"):
        bad = TB.append_or_reject(spark, rows, layout.bronze, S.BRONZE_REQUIRED, rejects, batch=name)
        assert sorted((r.customer_id, r.column, r.reason) for r in bad.collect()) == [
            (2, "event_id", "REQUIRED value is NULL: event_id"), (3, "date_id", "REQUIRED value is NULL: date_id"), (3, "event_id", "REQUIRED value is NULL: event_id")]
    assert [r.event_id for r in spark.table(layout.bronze).collect()] == [1, 1]
    assert spark.read.parquet(rejects).count() == 6


def test_progress_outlives_the_driver(spark, tmp_path):
    """Counts kept by batch: a crash before they are kept, a replay, a restart; the sums equal the rows stored."""
    arrivals, out, kept = str(tmp_path / "arrivals"), str(tmp_path / "out"), str(tmp_path / "progress")
    assert ST.read_progress(spark, kept).collect() == []
    write_lines(arrivals, "a.json", [json.dumps(canonical_event(i)) for i in range(7)] + ["oops"])
    write_lines(arrivals, "b.json", [json.dumps(canonical_event(i)) for i in range(7, 12)] + ["", "no"])
    dead = ST.path_sink(f"{out}/dead")

    def dies(df, batch):
        dead(df, batch)
        raise RuntimeError("after both appends")

    def pull(sink):
        source = MSG.stream_messages(spark, arrivals, 8, str(tmp_path / "position"))
        ST.run_available_now(source, ST.path_sink(f"{out}/bronze"), sink, str(tmp_path / "ckpt"), progress=kept)

    counts = lambda: sorted((r.batch_id, r.n_messages, r.n_valid, r.n_deadletter) for r in ST.read_progress(spark, kept).collect())
    pull(dead)
    first = counts()
    assert first == [(0, 8, 7, 1)]
    with pytest.raises(Exception, match="after both appends"):
        pull(dies)
    assert counts() == first
    pull(dead)
    assert counts() == [*first, (1, 7, 5, 2)]
    assert spark.read.parquet(f"{out}/bronze").count() == 12 and spark.read.parquet(f"{out}/dead").count() == 3
    ST.keep_progress(spark, kept, ST.read_progress(spark, kept).where("batch_id = 1").first().ingestion_batch, 1, 5, 2)
    assert counts() == [*first, (1, 7, 5, 2)]  # kept again by a replay after it was kept
