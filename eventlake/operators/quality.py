"""Declarative data-quality checks and layer validation.

Each check is an aggregation, not a row dump: ``not_null`` counts rows,
``unique`` counts duplicated keys, ``accepted_values`` counts distinct
unexpected values (the failure units of the usual column tests). All
``not_null`` and ``accepted_values`` tests of one model share one scan; a
``unique`` test is one grouped aggregation (partial aggregation before its
shuffle). The whole suite is one lazy DataFrame, so a single job evaluates it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..schemas import ColumnTest

SUITE_COLUMNS = ("model", "column_name", "test", "n_failed", "status")


# ---------------------------------------------------------------------------
# Single checks (each returns the failing units)
# ---------------------------------------------------------------------------


def not_null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: ``n_null_<column>`` per column, from one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_null_{c}") for c in columns])


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Duplicated keys: (value, n_records) for each non-null value seen twice or more."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def accepted_values_failures(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Unexpected values: (value, n_records) per distinct value not in ``values``.

    NULL passes (three-valued ``NOT IN``), as in the usual column test.
    """
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


# ---------------------------------------------------------------------------
# Suite runner
# ---------------------------------------------------------------------------


def _failed_units(test: ColumnTest) -> Column:
    c = F.col(test.column)
    if test.test == "not_null":
        return F.count_if(c.isNull())
    if test.test == "accepted_values":
        return F.count_distinct(F.when(~c.isin(*test.values), c))
    raise ValueError(test.test)


def _rows(items: list[tuple[ColumnTest, Column]]) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(t.model).alias("model"),
                    F.lit(t.column).alias("column_name"),
                    F.lit(t.test).alias("test"),
                    n.cast("bigint").alias("n_failed"),
                )
                for t, n in items
            ]
        )
    )


def run_suite(models: Mapping[str, DataFrame], suite: Iterable[ColumnTest] = S.QUALITY_SUITE) -> DataFrame:
    """Evaluate ``suite`` over ``models`` (name -> DataFrame).

    Returns (model, column_name, test, n_failed, status) with one row per test.
    """
    suite = list(suite)
    parts: list[DataFrame] = []
    for model, df in models.items():
        scanned = [t for t in suite if t.model == model and t.test in ("not_null", "accepted_values")]
        if scanned:
            agg = df.agg(*[_failed_units(t).alias(f"t{i}") for i, t in enumerate(scanned)])
            parts.append(agg.select(_rows([(t, F.col(f"t{i}")) for i, t in enumerate(scanned)])))
        for t in suite:
            if t.model == model and t.test == "unique":
                n = unique_failures(df, t.column).agg(F.count(F.lit(1)).alias("n"))
                parts.append(n.select(_rows([(t, F.col("n"))])))
    unknown = {t.model for t in suite} - set(models)
    if unknown:
        raise KeyError(f"suite names models not given: {sorted(unknown)}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn(
        "status", F.when(F.col("n_failed") == 0, F.lit("pass")).otherwise(F.lit("fail"))
    )


class QualityError(RuntimeError):
    pass


def assert_suite(result: DataFrame) -> list:
    """Collect the (small, one row per test) suite result; raise if any test failed."""
    return check_rows(result.collect())


def check_rows(rows: list) -> list:
    """Raise :class:`QualityError` if any collected suite row failed; return the rows."""
    failed = [r for r in rows if r.status != "pass"]
    if failed:
        text = ", ".join(f"{r.model}.{r.column_name} {r.test}: {r.n_failed}" for r in failed)
        raise QualityError(f"{len(failed)} of {len(rows)} quality tests failed: {text}")
    return rows


# ---------------------------------------------------------------------------
# Layer validation
# ---------------------------------------------------------------------------


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """(layer, total) for each named layer; one count aggregation each."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("layer"), "total")
        for name, df in layers.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_layers(counts: DataFrame, required: str = "bronze") -> dict:
    """Collect the counts (one row per layer); only an empty ``required`` layer is an error."""
    totals = {r.layer: r.total for r in counts.collect()}
    if totals.get(required, 0) == 0:
        raise QualityError(f"no rows in {required}: check the ingestion")
    return totals


# ---------------------------------------------------------------------------
# REQUIRED columns (Parquet tables accept NULL in NOT NULL columns)
# ---------------------------------------------------------------------------


def enforce_required(df: DataFrame, required: Iterable[str], on_violation: str = "raise"):
    """Guard REQUIRED columns before a write.

    ``raise``
        the check is part of the projection (no extra pass); the first NULL
        fails the job, which then commits nothing;
    ``drop``
        rows with a NULL there are removed and counted: returns
        ``(df, Observation)`` with ``n_rejected``.
    """
    required = list(required)
    if on_violation == "raise":
        cols = []
        for c in df.columns:
            if c in required:
                cols.append(
                    F.when(
                        F.col(c).isNull(),
                        F.raise_error(F.lit(f"NULL in REQUIRED column {c}")).cast(
                            df.schema[c].dataType
                        ),
                    )
                    .otherwise(F.col(c))
                    .alias(c)
                )
            else:
                cols.append(F.col(c))
        return df.select(*cols)
    if on_violation == "drop":
        from pyspark.sql import Observation

        bad = F.lit(False)
        for c in required:
            bad = bad | F.col(c).isNull()
        obs = Observation("required_rejects")
        observed = df.observe(obs, F.count_if(bad).alias("n_rejected"))
        return observed.where(~bad), obs
    raise ValueError(on_violation)
