"""Parser: whole messages, then edge messages (FIXTURES.md §4)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventlake.operators import parse as P

NOW = dt.datetime(2030, 5, 6, 7, 8, 9)
TODAY = 20300506


def run(spark, messages, mode="deadletter", binary=False):
    if binary:
        df = spark.createDataFrame([(bytearray(m),) for m in messages], "value binary")
    else:
        df = spark.createDataFrame([(m,) for m in messages], "value string")
    df = df.withColumn("pos", F.monotonically_increasing_id())
    stamp = F.lit(NOW).cast("timestamp_ntz")
    out = P.parse(df, stamp=stamp, mode=mode, keep=("pos",)).orderBy("pos")
    return [r.asDict() for r in out.collect()]


def test_whole_event_from_bytes(spark):
    msg = json.dumps({
        "event_id": 42, "event_type": "checkout", "customer_id": 7, "product_id": 31,
        "session_id": "s-42", "event_timestamp": "2025-03-09T23:59:59Z",
    }).encode("utf-8")
    (row,) = run(spark, [msg], binary=True)
    assert row["error"] is None
    assert (row["event_id"], row["date_id"], row["customer_id"], row["product_id"],
            row["session_id"], row["event_type"]) == (42, 20250309, 7, 31, "s-42", "checkout")
    assert row["ingestion_time"] is not None


def test_text_that_is_no_json_goes_to_deadletter(spark):
    df = spark.createDataFrame([(bytearray(b"{oops"),)], "value binary")
    valid, dead = P.split(P.parse(df))
    assert valid.count() == 0
    (row,) = dead.collect()
    assert row.raw_message == "{oops" and row.error == "INVALID_JSON"
    assert row.ingestion_time is not None


def test_long_text_is_cut(spark):
    msg = json.dumps({"event_id": 3, "event_type": "t" * 51, "session_id": "u" * 256, "event_timestamp": "2025-03-09"})
    (row,) = run(spark, [msg])
    assert row["event_type"] == "t" * 50 and row["session_id"] == "u" * 255
    assert row["date_id"] == 20250309


EDGE = [
    ('{"event_id":1,"event_timestamp":"2026-07-18T23:30:00-05:00"}', dict(date_id=20260718)),
    ('{"event_id":"2","event_timestamp":1784368800}', dict(event_id=2, date_id=20260718)),
    ("{}", dict(event_id=0, date_id=TODAY, customer_id=0, product_id=0, session_id="", event_type="unknown")),
    ("not json", "INVALID_JSON"),
    ("[1]", "NOT_AN_OBJECT"),
    ('{"event_id":null}', "INVALID_INT:event_id"),
    ('{"event_id":12.9,"event_timestamp":"20260718"}', dict(event_id=12, date_id=20260718)),
    ('{"event_id":"12.5"}', "INVALID_INT:event_id"),
    ('{"event_id":1,"session_id":null,"event_type":true}', dict(session_id="None", event_type="True")),
    ('{"event_id":1,"event_timestamp":"2026-7-18"}', "INVALID_TIMESTAMP"),
    ('{"event_id":1,"event_timestamp":"2026-02-30"}', "INVALID_TIMESTAMP"),
    ('{"event_id":1,"event_timestamp":0}', dict(date_id=TODAY)),
    ('{"event_id":1,"event_timestamp":""}', dict(date_id=TODAY)),
    ('{"event_id":1,"event_timestamp":true}', dict(date_id=19700101)),
    ('{"event_id":1,"event_timestamp":[]}', dict(date_id=TODAY)),
    ('{"event_id":1,"event_timestamp":[1]}', "INVALID_TIMESTAMP"),
    ('{"event_id":1,"event_timestamp":"2026-07-18T10:00:00Z"} x', "INVALID_JSON"),
    ('{"event_id":1,"event_timestamp":"10:00"}', "INVALID_TIMESTAMP"),
    ('{"event_id":18446744073709551616}', "INVALID_INT:event_id"),
    ('{"event_id":1,"event_timestamp":1784368800000}', "INVALID_TIMESTAMP"),
    ('{"event_id":1,"event_timestamp":"2026-07-18T10:00:00.5Z"}', dict(date_id=20260718)),
    ('{"event_id":1,"session_id":12,"event_type":{"a":1}}', dict(session_id="12", event_type="{'a': 1}")),
    ("null", "NOT_AN_OBJECT"),
    ('"x"', "NOT_AN_OBJECT"),
    ('{"event_id":1,"event_timestamp":1e18}', "INVALID_TIMESTAMP"),
    # the four primitives-only cases
    ("", "INVALID_JSON"),
    ('{"event_id":1,"event_id":7}', dict(event_id=7)),
    ('{"event_id":1,"event_timestamp":"[]"}', "INVALID_TIMESTAMP"),
    # more of the coercion table
    ('{"event_id":-12.9}', dict(event_id=-12)),
    ('{"event_id":" 12 ","customer_id":"+7","product_id":true}', dict(event_id=12, customer_id=7, product_id=1)),
    ('{"event_id":"abc"}', "INVALID_INT:event_id"),
    ('{"event_id":1,"customer_id":[]}', "INVALID_INT:customer_id"),
    ('{"event_id":1,"product_id":{}}', "INVALID_INT:product_id"),
    ('{"event_id":"1e3"}', "INVALID_INT:event_id"),
    ("{'event_id':1}", "INVALID_JSON"),
    ('{"event_id":1,"event_timestamp":null}', dict(date_id=TODAY)),
    ('{"event_id":1,"event_timestamp":false}', dict(date_id=TODAY)),
    ('{"event_id":1,"event_timestamp":{}}', dict(date_id=TODAY)),
    ('{"event_id":1,"event_timestamp":{"a":1}}', "INVALID_TIMESTAMP"),
    ('{"event_id":1,"event_timestamp":-1}', dict(date_id=19691231)),
    ('{"event_id":1,"event_timestamp":"2026-W29-6"}', dict(date_id=20260718)),
    ('{"event_id":1,"event_timestamp":"2026W29"}', dict(date_id=20260713)),
    ('{"event_id":1,"event_timestamp":"2026-W53-1"}', dict(date_id=20261228)),
    ('{"event_id":1,"event_timestamp":"2025-W53-1"}', "INVALID_TIMESTAMP"),
    ('{"event_id":1,"event_timestamp":"20260718T101112"}', dict(date_id=20260718)),
    ('{"event_id":1,"event_timestamp":"2026-07-18 10:00:00+05:30"}', dict(date_id=20260718)),
    ('{"event_id":1,"event_timestamp":"2026-07-18T24:00:00"}', "INVALID_TIMESTAMP"),
    ('{"event_id":1,"event_timestamp":"2026-07-18T10:00:00+24:00"}', "INVALID_TIMESTAMP"),
    ('{"event_id":1,"event_timestamp":"0000-01-01"}', "INVALID_TIMESTAMP"),
    ('{"event_id":1,"event_timestamp":"0001-01-01"}', dict(date_id=10101)),
    ('{"event_id":1,"event_timestamp":"2026-07-18Z"}', dict(date_id=20260718)),
    ('{"event_id":1,"event_timestamp":"2026-07-18\\n"}', "INVALID_TIMESTAMP"),
    ('{"event_id":1,"event_timestamp":" 2026-07-18"}', "INVALID_TIMESTAMP"),
    ('{"event_id":1,"event_timestamp":"2026-07-18T10:0000"}', "INVALID_TIMESTAMP"),
    ('  {"event_id":5}  ', dict(event_id=5)),
    ('{"event_id":"1_000","customer_id":" -2_0 "}', dict(event_id=1000, customer_id=-20)),
    ('{"event_id":"1__0"}', "INVALID_INT:event_id"),
    ('{"event_id":1,"session_id":1.0,"event_type":1e20}', dict(session_id="1.0", event_type="1e+20")),
    ('{"event_id":1,"session_id":-0.00001,"event_type":12345678.25}', dict(session_id="-1e-05", event_type="12345678.25")),
    ('{"event_id":1,"session_id":1e16,"event_type":0.0001}', dict(session_id="1e+16", event_type="0.0001")),
    ('{"event_id":1,"session_id":18446744073709551616}', dict(session_id="18446744073709551616")),
    ('1, 2', "INVALID_JSON"),
    ('{"a":1}, "b": 2', "INVALID_JSON"),
    ('1],[2', "INVALID_JSON"),
    ('{"EVENT_ID":5,"Event_Type":"view"}', dict(event_id=0, event_type="unknown")),  # keys are case-sensitive
    ('{"event_id":5,"extra":{"event_id":9}}', dict(event_id=5)),  # only top-level members
]


@pytest.mark.parametrize("message,expected", EDGE, ids=[str(i) for i in range(len(EDGE))])
def test_edge_message(spark, message, expected):
    (row,) = run(spark, [message])
    if isinstance(expected, str):
        assert row["error"] == expected, row
    else:
        assert row["error"] is None, row
        for k, v in expected.items():
            assert row[k] == v, (k, row)


def test_invalid_utf8(spark):
    (row,) = run(spark, [b"\xffA"], binary=True)
    assert row["error"] == "INVALID_UTF8"


def test_code_points_truncation(spark):
    msg = json.dumps({"event_type": "\U0001F600" * 60}, ensure_ascii=False)
    (row,) = run(spark, [msg])
    assert row["event_type"] == "\U0001F600" * 50


def test_fail_mode_raises(spark):
    df = spark.createDataFrame([('{"event_id":1}',), ("not json",)], "value string")
    with pytest.raises(Exception, match="bad event"):
        P.valid_rows(P.parse(df, mode="fail")).collect()


def test_fail_mode_passes_good_batch(spark):
    df = spark.createDataFrame([('{"event_id":1}',), ('{"event_id":2}',)], "value string")
    assert P.valid_rows(P.parse(df, mode="fail")).count() == 2


def test_drop_mode_pass_through(spark):
    msgs = [
        '{"event_id":1,"session_id":null,"event_timestamp":"2026-07-18T10:00:00Z"}',
        '{"event_id":2,"event_timestamp":1784368800}',      # number: ISO text only
        '{"event_id":3,"event_type":"' + "x" * 80 + '"}',   # no truncation
        '{"event_id":12.9}',                               # no int() truncation
        "not json",
    ]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    valid, obs = P.drop_bad(P.parse(df, mode="drop"))
    rows = sorted(valid.collect(), key=lambda r: r.event_id)
    assert [r.event_id for r in rows] == [1, 3]
    assert rows[0].session_id is None
    assert rows[1].event_type == "x" * 80
    assert obs.get == {"n_valid": 2, "n_dropped": 3}


def test_edge_messages_without_ansi(spark):
    """Same answers when the session runs with ANSI mode off (a session we did not create)."""
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        rows = run(spark, [m for m, _ in EDGE])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    for (message, expected), row in zip(EDGE, rows):
        if isinstance(expected, str):
            assert row["error"] == expected, (message, row)
        else:
            assert row["error"] is None, (message, row)
            for k, v in expected.items():
                assert row[k] == v, (message, k, row)


def test_parse_applies_the_settings_it_needs(spark):
    """Duplicate keys keep the last value even if the session had them switched off."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    df = spark.createDataFrame([('{"event_id":1,"event_id":7}',)], "value string")
    (row,) = P.parse(df).collect()
    assert (row.error, row.event_id) == (None, 7)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
