"""Table schemas, domains and the declarative quality suite.

Everything in the "fixed values" blocks must equal what the event contract
specifies; change them only together with that contract.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (event contract)
# ---------------------------------------------------------------------------

# Accepted event types, in contract order.
ACCEPTED_EVENT_TYPES = ("login", "view", "add_to_cart", "checkout", "purchase", "cart_abandoned")

# Defaults used when a key is absent from the message.
DEFAULT_EVENT_ID = 0
DEFAULT_CUSTOMER_ID = 0
DEFAULT_PRODUCT_ID = 0
DEFAULT_SESSION_ID = ""
DEFAULT_EVENT_TYPE = "unknown"

# Maximum stored lengths, in code points.
SESSION_ID_MAX = 255
EVENT_TYPE_MAX = 50
DEADLETTER_TEXT_MAX = 500

# Partition expiry of the bronze and dead-letter tables, in days.
RETENTION_DAYS = 30

# Clustering keys of the bronze table.
BRONZE_CLUSTER_KEYS = ("event_type", "customer_id")

# Columns of the bronze table that point lookups ask for.
BRONZE_LOOKUP_KEYS = ("event_id", "customer_id")

# Default namespaces and table names.
BRONZE_DB = "bronze"
SILVER_DB = "silver"
GOLD_DB = "gold"
BRONZE_TABLE = "bronze_events"
DEADLETTER_TABLE = "deadletter_events"
SILVER_VIEW = "stg_bronze_events"
GOLD_TABLE = "fact_events"

# Dead-letter reason codes, in evaluation order (first failure wins).
ERR_INVALID_UTF8 = "INVALID_UTF8"
ERR_INVALID_JSON = "INVALID_JSON"
ERR_NOT_AN_OBJECT = "NOT_AN_OBJECT"
ERR_INVALID_TIMESTAMP = "INVALID_TIMESTAMP"
ERR_INVALID_INT = "INVALID_INT:"  # followed by the field name

# Streaming write cadence.
DEFAULT_TRIGGER = "30 seconds"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

BRONZE_COLUMNS = (
    "event_id",
    "date_id",
    "customer_id",
    "product_id",
    "session_id",
    "event_type",
    "ingestion_time",
)

# REQUIRED columns (Parquet tables do not enforce NOT NULL; see operators.quality).
BRONZE_REQUIRED = ("event_id", "date_id", "ingestion_time")
DEADLETTER_REQUIRED = ("raw_message", "error", "ingestion_time")

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("date_id", T.LongType(), False),
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("product_id", T.LongType(), True),
        T.StructField("session_id", T.StringType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("ingestion_time", T.TimestampType(), False),
    ]
)

DEADLETTER_SCHEMA = T.StructType(
    [
        T.StructField("raw_message", T.StringType(), False),
        T.StructField("error", T.StringType(), False),
        T.StructField("ingestion_time", T.TimestampType(), False),
    ]
)

# Order used to make "earliest arrival wins" total: rows equal in all of
# these columns are identical, so the kept row is deterministic.
GOLD_ORDER = (
    "ingestion_time",
    "date_id",
    "customer_id",
    "product_id",
    "session_id",
    "event_type",
)

GOLD_COLUMNS = BRONZE_COLUMNS + ("transformed_at",)


# ---------------------------------------------------------------------------
# Quality suite as data
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnTest:
    model: str  # "silver" or "gold"
    column: str
    test: str  # "not_null" | "unique" | "accepted_values"
    values: tuple = field(default=())


# The 4 silver and 7 gold column tests of the contract.
QUALITY_SUITE = (
    ColumnTest("silver", "event_id", "not_null"),
    ColumnTest("silver", "date_id", "not_null"),
    ColumnTest("silver", "event_type", "accepted_values", ACCEPTED_EVENT_TYPES),
    ColumnTest("silver", "ingestion_time", "not_null"),
    ColumnTest("gold", "event_id", "unique"),
    ColumnTest("gold", "event_id", "not_null"),
    ColumnTest("gold", "date_id", "not_null"),
    ColumnTest("gold", "event_type", "not_null"),
    ColumnTest("gold", "event_type", "accepted_values", ACCEPTED_EVENT_TYPES),
    ColumnTest("gold", "ingestion_time", "not_null"),
    ColumnTest("gold", "transformed_at", "not_null"),
)
