"""Size-checked broadcast: the only place that asks for a broadcast by hint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A side is broadcast by hint only when its measured content is below this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def content_bytes(df: DataFrame) -> Column:
    """Bytes of one row: text and binary by length, numbers and dates as 8.

    Nested columns are measured by their JSON text, so a wide one counts as wide.
    """
    total = F.lit(8)
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            wrapped = F.to_json(F.struct(F.col(f.name)))
            total = total + F.coalesce(F.octet_length(wrapped), F.lit(0))
        else:
            total = total + F.lit(8)
    return total.cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Content size of ``df`` by one aggregate over it (a job, one row back)."""
    return df.agg(F.coalesce(F.sum(content_bytes(df)), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast when the measured size allows it, else leave the choice.

    Without the hint Catalyst shuffles both sides on the join key and adaptive
    execution splits a skewed partition, so size costs time, never the job.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit_bytes else df
