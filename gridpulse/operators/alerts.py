"""Rule-based alerts over the hourly grid."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from gridpulse.operators.ordering import ordinal, previous_value
from gridpulse.operators.quantiles import exact_quantiles, histogram_quantiles
from gridpulse.schemas import ALERT_COLUMNS, require_columns
from gridpulse.sources.scratch import cut

# Rule parameters and labels.
HIGH_PERCENTILE = 0.95
LOW_PERCENTILE = 0.05
SPIKE_FACTOR = 2.0
RULES = [
    # number, alert type, severity, metric
    (1, "HIGH_ACTIVITY", "HIGH", "total_activity"),
    (2, "HIGH_INTERNET", "MEDIUM", "internet_activity"),
    (3, "SUDDEN_SPIKE", "HIGH", "total_activity"),
    (4, "LOW_ACTIVITY", "LOW", "total_activity"),
]

# cells per block when alert numbers are summed up block by block
_GRID_BLOCK = 4096


@dataclass(frozen=True)
class Limits:
    """Quantile thresholds of the three fixed-limit rules; None without rows."""

    high_activity: float | None
    high_internet: float | None
    low_activity: float | None


# metrics that thresholds are taken of
LIMITED = ["total_activity", "internet_activity"]


def thresholds(hourly: DataFrame, high: float = HIGH_PERCENTILE, low: float = LOW_PERCENTILE,
               histogram: DataFrame | None = None) -> Limits:
    """The three exact quantile thresholds over all hourly rows.

    ``hourly`` is read once per counting pass and should be a stored table. With its stored
    ``histogram`` (``quantiles.value_histogram`` of ``LIMITED``) only rows near a threshold are read.
    """
    wanted = {"total_activity": [high, low], "internet_activity": [high]}
    q = exact_quantiles(hourly, wanted) if histogram is None else histogram_quantiles(histogram, hourly, wanted)
    return Limits(q["total_activity", high], q["internet_activity", high], q["total_activity", low])


def with_previous(hourly: DataFrame) -> DataFrame:
    """Add the cell's previous row (not previous clock hour) of total activity.

    One window per cell: the hourly grain holds at most one row per cell and
    hour, so no cell can outgrow the number of hours in the data.
    """
    return previous_value(hourly, ["grid_id"], "timestamp", "total_activity", "previous_activity")


def fired(hourly: DataFrame, limits: Limits, spike_factor: float = SPIKE_FACTOR) -> DataFrame:
    """One row per rule that fires, all four rules in one pass over the rows."""
    require_columns(hourly, ["timestamp", "grid_id", "total_activity", "internet_activity"], "hourly grid")
    rows = with_previous(hourly.select("timestamp", "grid_id", "total_activity", "internet_activity"))
    total, internet = F.col("total_activity"), F.col("internet_activity")
    spike = F.col("previous_activity") * F.lit(float(spike_factor))
    high, internet_high, low = (
        F.lit(x).cast("double")
        for x in (limits.high_activity, limits.high_internet, limits.low_activity)
    )
    tests = {
        "HIGH_ACTIVITY": (total > high, high),
        "HIGH_INTERNET": (internet > internet_high, internet_high),
        "SUDDEN_SPIKE": (total > spike, spike),
        "LOW_ACTIVITY": (total < low, low),
    }
    hits = F.array_compact(F.array(*[
        F.when(tests[kind][0], F.struct(
            F.lit(no).alias("rule_no"), F.lit(kind).alias("alert_type"),
            F.lit(severity).alias("severity"), F.lit(metric).alias("metric"),
            F.col(metric).alias("value"), tests[kind][1].alias("threshold"),
        ))
        for no, kind, severity, metric in RULES
    ]))
    return rows.select("timestamp", "grid_id", F.inline(hits))


def numbered(alerts: DataFrame) -> DataFrame:
    """Give alerts their sequence number: by rule, then cell, then timestamp."""
    levels = [
        {"_rule": F.col("rule_no"), "_block": F.floor(F.col("grid_id") / _GRID_BLOCK)},
        {"_cell": F.col("grid_id")},
    ]
    return ordinal(alerts, levels, ["timestamp"], "alert_id").select(*ALERT_COLUMNS)


def alert_table(hourly: DataFrame, limits: Limits, renumber: bool = False) -> DataFrame:
    """Numbered alerts ordered by timestamp, cell and type.

    Numbers follow the rules' order, not the output order, unless ``renumber``.
    An empty result keeps the schema. Numbering counts the alerts and then
    reads them again, so they are stored first instead of being found twice.
    """
    hits = cut(fired(hourly, limits))
    if renumber:
        levels = [{"_day": F.to_date("timestamp")}, {"_hour": F.col("timestamp")}]
        out = ordinal(hits, levels, ["grid_id", "alert_type"], "alert_id").select(*ALERT_COLUMNS)
    else:
        out = numbered(hits)
    return out.orderBy("timestamp", "grid_id", "alert_type")
