"""Names, grains and column contracts of every dataset."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Delivery format. These must equal the published data format.
# ---------------------------------------------------------------------------
FILE_PATTERN = "sms-call-internet-mi-*.csv"

RAW_COLUMNS = [
    "datetime", "CellID", "countrycode", "smsin", "smsout", "callin", "callout", "internet",
]
RAW_MEASURES = ["smsin", "smsout", "callin", "callout", "internet"]

CANONICAL_NAMES = {
    "datetime": "timestamp",
    "CellID": "grid_id",
    "countrycode": "country_code",
    "smsin": "sms_in",
    "smsout": "sms_out",
    "callin": "call_in",
    "callout": "call_out",
    "internet": "internet_activity",
}

# lower-cased spelling variants accepted by the general name normaliser
NAME_SYNONYMS = {
    "datetime": "timestamp",
    "cellid": "grid_id",
    "cell_id": "grid_id",
    "countrycode": "country_code",
    "country_code": "country_code",
    "smsin": "sms_in",
    "smsout": "sms_out",
    "callin": "call_in",
    "callout": "call_out",
    "internet": "internet_activity",
}

MEASURES = ["sms_in", "sms_out", "call_in", "call_out", "internet_activity"]
TOTALS = ["total_sms", "total_calls", "total_activity"]
CALENDAR = ["date", "hour", "day_of_week"]
DECIMALS = 4

CLEAN_COLUMNS = ["timestamp", *CALENDAR, "grid_id", "country_code", *MEASURES, *TOTALS]
HOURLY_COLUMNS = ["timestamp", *CALENDAR, "grid_id", *MEASURES, *TOTALS]
ACTIVITY_COLUMNS = ["timestamp", "grid_id", *MEASURES, "total_activity", "geometry"]
FACT_MEASURES = [*MEASURES, "total_activity"]

GRID_PERFORMANCE_COLUMNS = ["grid_id", *[f"window_{m}" for m in FACT_MEASURES]]
TEMPORAL_PERFORMANCE_COLUMNS = ["timestamp", "timestamp_total_activity"]

RAW_GRAIN = ["datetime", "CellID", "countrycode"]
CLEAN_GRAIN = ["timestamp", "grid_id", "country_code"]
HOURLY_GRAIN = ["timestamp", "grid_id"]

ALERT_COLUMNS = [
    "alert_id", "timestamp", "grid_id", "alert_type", "severity", "metric", "value", "threshold",
]
LEDGER_COLUMNS = ["filename", "status", "row_count", "reason", "processed_at"]

RAW_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

LEDGER_SCHEMA = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("reason", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
])


def missing_columns(columns, required) -> list[str]:
    have = set(columns)
    return [c for c in required if c not in have]


def require_columns(df, required, label: str = "dataset") -> None:
    """Raise when a required column is absent (a schema look-up, no job)."""
    missing = missing_columns(df.columns, required)
    if missing:
        raise ValueError(f"{label}: missing required columns: {missing}")


def require_exact_columns(df, expected, label: str = "dataset") -> None:
    """Raise unless the columns are exactly ``expected``, in that order."""
    if list(df.columns) != list(expected):
        raise ValueError(f"{label}: columns {df.columns} differ from {list(expected)}")


def require_absent(df, forbidden, label: str = "dataset") -> None:
    present = [c for c in forbidden if c in df.columns]
    if present:
        raise ValueError(f"{label}: forbidden columns present: {present}")
