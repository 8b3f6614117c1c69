"""Raw-message corpora derived from the supplied ``events`` table.

The supplied table is ``event_id, ts (timestamp_ntz), user_id, event_type,
value, props '{"k": N}'``. Each helper turns *every* row into one message, so
the work of every query grows with the table. Mapping to the event model:

* ``customer_id`` <- ``user_id``; ``product_id`` <- ``props.k``;
* ``session_id`` <- ``'sess_' || lpad(user_id, 6, '0')``;
* the event timestamp <- ``ts`` (its wall clock), rendered per corpus;
* the ingestion stamp <- ``ts`` (fixed, so results compare across engines).

The "mixed" corpus gives each supplied ``event_type`` its own encoding, so
one pass exercises every decoding branch:

``view``      canonical object, ISO-8601 UTC text with ``Z``
``purchase``  ids as JSON strings, epoch seconds as a decimal number
``click``     local wall clock with offset ``-05:00``; no ``product_id`` key
``signup``    no timestamp key (falls back to the ingestion stamp);
              ``session_id`` is JSON ``null``
``error``     a broken message; which break depends on ``value``:
              < 10 unterminated object, < 25 non-numeric id,
              < 50 impossible hour, otherwise an array root of over 600 code
              points, half of them outside the BMP
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table (parquet scan; filters and projections push down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# ---------------------------------------------------------------------------
# Field renderings
# ---------------------------------------------------------------------------


def session_of(user_id: Column) -> Column:
    return F.concat(F.lit("sess_"), F.lpad(user_id.cast("string"), 6, "0"))


def product_of(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("bigint")


def iso_utc(ts: Column) -> Column:
    """``2024-01-01T00:06:29.165275Z``."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def iso_with_offset(ts: Column, offset: Column) -> Column:
    """The wall clock of ``ts`` labelled with ``offset`` (the date must not move)."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), offset)


def epoch_seconds(ts: Column) -> Column:
    """Wall clock read as UTC, in seconds with microseconds (a JSON decimal)."""
    micros = F.unix_micros(ts.cast("timestamp"))  # session zone is UTC
    return (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(20,6)")


def iso_week_text(ts: Column) -> Column:
    """ISO week-date form with a time: ``2024-W01-1T00:06``."""
    d = F.to_date(ts)
    thursday = F.date_add(d, 3 - F.weekday(d))
    return F.concat(
        F.year(thursday).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(d).cast("string"), 2, "0"),
        F.lit("-"),
        (F.weekday(d) + 1).cast("string"),
        F.lit("T"),
        F.date_format(ts, "HH:mm"),
    )


def _obj(**members: Column) -> Column:
    """JSON object text; NULL members are written as JSON null."""
    return F.to_json(
        F.struct(*[v.alias(k) for k, v in members.items()]),
        {"ignoreNullFields": "false"},
    )


def canonical_event(e: DataFrame, ts_text: Column | None = None) -> Column:
    return _obj(
        event_id=F.col("event_id"),
        event_type=F.col("event_type"),
        customer_id=F.col("user_id"),
        product_id=product_of(F.col("props")),
        session_id=session_of(F.col("user_id")),
        event_timestamp=iso_utc(F.col("ts")) if ts_text is None else ts_text,
    )


# ---------------------------------------------------------------------------
# Corpora: (event_id, ts, value) with ``value`` the message text
# ---------------------------------------------------------------------------


def _frame(e: DataFrame, message: Column) -> DataFrame:
    return e.select("event_id", "ts", message.alias("value"))


def canonical(e: DataFrame) -> DataFrame:
    """Every event as a canonical message (ISO-8601 UTC timestamp)."""
    return _frame(e, canonical_event(e))


# Two characters, one of them outside the Basic Multilingual Plane.
OUTSIDE_BMP = "\U0001F600x"


def broken_message(e_id: Column, ts: Column, value: Column) -> Column:
    sid = e_id.cast("string")
    return (
        F.when(value < 10, F.concat(F.lit('{"event_id": '), sid, F.lit(', "event_type": "error"')))
        .when(
            value < 25,
            F.concat(F.lit('{"event_id": "id-'), sid, F.lit('", "event_type": "error"}')),
        )
        .when(
            value < 50,
            F.concat(
                F.lit('{"event_id": '),
                sid,
                F.lit(', "event_type": "error", "event_timestamp": "'),
                F.date_format(ts, "yyyy-MM-dd"),
                F.lit('T25:00:00Z"}'),
            ),
        )
        .otherwise(F.concat(F.lit("["), sid, F.lit(f', "error", "{OUTSIDE_BMP * 300}"]')))
    )


def mixed(e: DataFrame) -> DataFrame:
    """One encoding per supplied event type (see the module docstring)."""
    return _frame(e, mixed_message(e))


def mixed_message(e: DataFrame, product: Column | None = None) -> Column:
    """The mixed-corpus message of each row; ``product`` overrides ``props.k``."""
    et = F.col("event_type")
    product = product_of(F.col("props")) if product is None else product
    view = _obj(
        event_id=F.col("event_id"),
        event_type=et,
        customer_id=F.col("user_id"),
        product_id=product,
        session_id=session_of(F.col("user_id")),
        event_timestamp=iso_utc(F.col("ts")),
    )
    purchase = _obj(
        event_id=F.col("event_id").cast("string"),
        event_type=et,
        customer_id=F.col("user_id").cast("string"),
        product_id=product.cast("string"),
        session_id=session_of(F.col("user_id")),
        event_timestamp=epoch_seconds(F.col("ts")),
    )
    click = _obj(
        event_id=F.col("event_id"),
        event_type=et,
        customer_id=F.col("user_id"),
        session_id=session_of(F.col("user_id")),
        event_timestamp=iso_with_offset(F.col("ts"), F.lit("-05:00")),
    )
    signup = _obj(
        event_id=F.col("event_id"),
        event_type=et,
        customer_id=F.col("user_id"),
        product_id=product,
        session_id=F.lit(None).cast("string"),
    )
    broken = broken_message(F.col("event_id"), F.col("ts"), F.col("value"))
    return (
        F.when(et == "purchase", purchase)
        .when(et == "click", click)
        .when(et == "signup", signup)
        .when(et == "error", broken)
        .otherwise(view)
    )


def truncation(e: DataFrame) -> DataFrame:
    """Over-long ``event_type`` (x20) and ``session_id`` (x30) in every message."""
    return _frame(
        e,
        _obj(
            event_id=F.col("event_id"),
            event_type=F.repeat(F.col("event_type"), 20),
            customer_id=F.col("user_id"),
            product_id=product_of(F.col("props")),
            session_id=F.repeat(session_of(F.col("user_id")), 30),
            event_timestamp=iso_utc(F.col("ts")),
        ),
    )


def epoch(e: DataFrame) -> DataFrame:
    """Every event with its timestamp as epoch seconds."""
    return _frame(e, canonical_event(e, epoch_seconds(F.col("ts"))))


# The UTC offset attached to each supplied event type's wall clock.
OFFSETS = {"view": "+09:30", "click": "-05:00", "purchase": "+14:00", "signup": "-12:00", "error": "Z"}


def offsets(e: DataFrame) -> DataFrame:
    """Every event as local wall-clock text with an offset that varies by type."""
    off = F.lit("+00:00")
    for et, o in OFFSETS.items():
        off = F.when(F.col("event_type") == et, F.lit(o)).otherwise(off)
    return _frame(e, canonical_event(e, iso_with_offset(F.col("ts"), off)))


def iso_variants(e: DataFrame) -> DataFrame:
    """Other ISO-8601 shapes: basic, week date, comma fraction, date only, hour only."""
    ts = F.col("ts")
    text = (
        F.when(F.col("event_type") == "view", F.date_format(ts, "yyyyMMdd'T'HHmmss"))
        .when(F.col("event_type") == "click", iso_week_text(ts))
        .when(F.col("event_type") == "purchase", F.date_format(ts, "yyyy-MM-dd HH:mm:ss,SSS"))
        .when(F.col("event_type") == "signup", F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH"))
    )
    return _frame(e, canonical_event(e, text))
