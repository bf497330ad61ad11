"""Activity deliveries derived from the ``events`` table.

Five event types stand for the five measures, hour and user for the grain, so
the pivot has the shape of a real delivery, naturally blank measures included.
Known defects are written into some rows (every row stays): they give the gate,
the cleaner and the checks something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridpulse.functions.columns import rounded
from gridpulse.operators.aggregate import hourly_grid
from gridpulse.operators.clean import clean
from gridpulse.schemas import RAW_COLUMNS, RAW_MEASURES

# Event type behind each delivered measure.
MEASURE_OF_EVENT = {
    "smsin": "click", "smsout": "view", "callin": "signup", "callout": "purchase", "internet": "error",
}


def raw_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered rows with ``source_filename`` and the order keys h, g, cc.

    One pass over five columns of ``events``; the pivot is conditional sums,
    which combine map-side.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    keyed = events.select(
        F.window("ts", "1 hour")["start"].alias("h"),
        (F.col("user_id") + 1).alias("g"),
        (F.get_json_object("props", "$.k").cast("bigint") % 10).alias("cc"),
        "event_type", "value",
    )
    pivoted = keyed.groupBy("h", "g", "cc").agg(*[
        rounded(F.sum(F.when(F.col("event_type") == e, F.col("value"))), 2).alias(m)
        for m, e in MEASURE_OF_EVENT.items()
    ])
    # defects, on every fifth day: which kind a row gets depends on its key
    kind = (F.col("g") * 31 + F.col("cc") * 7 + F.hour("h")) % 97
    defect = F.when(F.dayofmonth("h") % 5 == 0, kind)
    is_defect = lambda n: defect.eqNullSafe(F.lit(n))
    return pivoted.select(
        "h", "g", "cc",
        F.concat(F.lit("sms-call-internet-mi-"), F.date_format("h", "yyyy-MM-dd"),
                 F.lit(".csv")).alias("source_filename"),
        F.when(is_defect(1), "bad-ts").otherwise(F.date_format("h", "yyyy-MM-dd HH:mm:ss")).alias("datetime"),
        F.when(~is_defect(0), F.col("g")).alias("CellID"),
        F.col("cc").alias("countrycode"),
        F.when(is_defect(2), F.lit(-1.0)).otherwise(F.col("smsin")).alias("smsin"),
        *RAW_MEASURES[1:],
    )


def as_text(raw: DataFrame) -> DataFrame:
    """The same rows as the gate sees them: every delivered field is text."""
    return raw.withColumns({c: F.col(c).cast("string") for c in RAW_COLUMNS})


def clean_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_activity(spark, sf_dir).select("source_filename", *RAW_COLUMNS))


def hourly_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_grid(clean_activity(spark, sf_dir))


def square_geometry(g: Column) -> Column:
    """GeoJSON text of the cell's square: 100 cells per row, side 0.002 degrees."""
    col = ((g - 1) % 100).cast("double")
    row = F.floor((g - 1) / 100).cast("double")
    x, y = F.lit(9.0) + col * 0.003, F.lit(45.3) + row * 0.003

    def corner(dx, dy):
        return F.array(F.round(x + dx, 6), F.round(y + dy, 6))

    ring = F.array(corner(0, 0), corner(0.002, 0), corner(0.002, 0.002), corner(0, 0.002), corner(0, 0))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))


def odd_geometry(g: Column) -> Column:
    """GeoJSON text of other shapes: two squares side by side, or a triangle, by the cell's number."""
    col = ((g - 1) % 100).cast("double")
    row = F.floor((g - 1) / 100).cast("double")
    x, y = F.lit(9.0) + col * 0.003, F.lit(45.3) + row * 0.003

    def ring(*corners):
        return F.array(*[F.array(F.round(x + dx, 6), F.round(y + dy, 6)) for dx, dy in corners])

    first = ring((0, 0), (0.002, 0), (0.002, 0.002), (0, 0.002), (0, 0))
    second = ring((0.01, 0), (0.012, 0), (0.012, 0.002), (0.01, 0.002), (0.01, 0))
    triangle = ring((0, 0), (0.003, 0), (0, 0.006), (0, 0))
    return F.when(g % 3 == 1, F.to_json(F.struct(
        F.lit("MultiPolygon").alias("type"), F.array(F.array(first), F.array(second)).alias("coordinates"),
    ))).when(g % 3 == 2, F.to_json(F.struct(
        F.lit("Polygon").alias("type"), F.array(triangle).alias("coordinates"))))


def cell_lookup(spark: SparkSession, sf_dir: str, skip: Column | None = None) -> DataFrame:
    """(grid_id, geometry) of every user's cell, without those where ``skip`` holds."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cells = events.select((F.col("user_id") + 1).alias("grid_id")).distinct()
    if skip is not None:
        cells = cells.where(~skip)
    return cells.withColumn("geometry", square_geometry(F.col("grid_id")))
