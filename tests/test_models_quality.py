"""Gold dedup and quality cases (FIXTURES.md §5), plus gold properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import models as M
from eventlake.operators import quality as Q

SCHEMA = (
    "event_id bigint, date_id bigint, customer_id bigint, product_id bigint, "
    "session_id string, event_type string, ingestion_time timestamp_ntz"
)


def t(h, m=0):
    return dt.datetime(2026, 7, 18, h, m)


def bronze(spark, rows):
    full = [(e, 20260718, 1, 1, "s", et, ts) for e, et, ts in rows]
    return spark.createDataFrame(full, SCHEMA)


def gold_rows(spark, rows, method):
    df = M.dedup(M.silver(bronze(spark, rows)), method=method)
    return sorted((r.event_id, r.event_type, r.ingestion_time) for r in df.collect())


CASES = [
    ("replay", [(1, "view", t(10)), (1, "view", t(10, 10))], [(1, "view", t(10))]),
    ("changed replay", [(1, "view", t(10, 10)), (1, "purchase", t(10))], [(1, "purchase", t(10))]),
    ("null type first", [(1, None, t(10)), (1, "view", t(10, 10))], [(1, "view", t(10, 10))]),
    ("null key", [(None, "view", t(10))], []),
    ("id-less events", [(0, "view", t(10)), (0, "login", t(10, 1))], [(0, "view", t(10))]),
    ("tie", [(1, "view", t(10)), (1, "purchase", t(10))], [(1, "purchase", t(10))]),
]


@pytest.mark.parametrize("method", ["window", "aggregate"])
@pytest.mark.parametrize("name,rows,expected", CASES, ids=[c[0] for c in CASES])
def test_gold_cases(spark, method, name, rows, expected):
    assert gold_rows(spark, rows, method) == expected


def test_null_ingestion_time_sorts_first(spark):
    rows = [(1, "view", None), (1, "purchase", t(9))]
    assert gold_rows(spark, rows, "aggregate") == gold_rows(spark, rows, "window") == [(1, "view", None)]


def test_silver_drops_null_keys(spark):
    b = bronze(spark, [(None, "view", t(10)), (2, "view", t(10))])
    assert [r.event_id for r in M.silver(b).collect()] == [2]
    assert M.silver(b).columns == list(S.BRONZE_COLUMNS)


def test_gold_has_transformed_at(spark):
    g = M.gold(M.silver(bronze(spark, [(1, "view", t(10))])))
    assert g.columns == list(S.GOLD_COLUMNS)
    assert g.first().transformed_at is not None


def test_gold_properties_on_supplied_events(spark):
    """Unique key, subset of silver, invariant under replay and row order."""
    from eventlake.plans import queries as QQ

    b = QQ.bronze(spark, "/root/testdata/sf0.001")
    s = M.silver(b)
    g = M.dedup(s)
    assert g.count() == g.select("event_id").distinct().count()
    assert g.exceptAll(s).count() == 0
    replayed = M.dedup(M.silver(M.append_all(b, b.orderBy(F.rand(7)))))
    assert replayed.exceptAll(g).count() == 0 and g.exceptAll(replayed).count() == 0
    assert M.dedup(s, "window").exceptAll(g).count() == 0


def test_suite_counts_failure_units(spark):
    b = bronze(
        spark,
        [(1, "view", t(10)), (2, "unknown", t(10)), (3, "unknown", t(11)), (4, "bogus", t(10)),
         (5, None, t(10))],
    )
    s = M.silver(b)
    rows = {(r.model, r.column_name, r.test): r for r in Q.run_suite({"silver": s, "gold": M.gold(s)}).collect()}
    assert len(rows) == 11
    # accepted_values counts distinct failing values; NULL passes
    assert rows[("silver", "event_type", "accepted_values")].n_failed == 2
    assert rows[("gold", "event_type", "accepted_values")].n_failed == 2
    # gold filtered the NULL type before ranking, so its not_null passes
    assert rows[("gold", "event_type", "not_null")].n_failed == 0
    assert rows[("gold", "event_id", "unique")].status == "pass"
    with pytest.raises(Q.QualityError, match="2 of 11"):
        Q.assert_suite(Q.run_suite({"silver": s, "gold": M.gold(s)}))


def test_unique_counts_duplicated_keys(spark):
    b = bronze(spark, [(1, "view", t(1)), (1, "view", t(2)), (1, "view", t(3)), (2, "view", t(1)), (None, "view", t(1)), (None, "view", t(2))])
    assert sorted(tuple(r) for r in Q.unique_failures(b, "event_id").collect()) == [(1, 3)]


def test_empty_bronze_fails_validation(spark):
    empty = bronze(spark, [])
    counts = Q.layer_counts({"bronze": empty, "silver": M.silver(empty)})
    with pytest.raises(Q.QualityError, match="no rows in bronze"):
        Q.validate_layers(counts)


def test_enforce_required(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "event_id bigint, x string")
    with pytest.raises(Exception, match="REQUIRED"):
        Q.enforce_required(df, ["event_id"]).collect()
    kept, obs = Q.enforce_required(df, ["event_id"], "drop")
    assert kept.count() == 1 and obs.get["n_rejected"] == 1
