"""Registered queries of the file side: deliveries, GeoJSON and published tables.

The fixture's rows are written as real files into the scratch folder and read
back with the library's readers, so each query covers a source or a sink whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridpulse.operators import aggregate, alerts, clean, datestates, gate, layout, quantiles, star
from gridpulse.plans import daily, fixture
from gridpulse.plans.catalog import EARLIER_DELIVERY, QUERIES, query  # noqa: F401  QUERIES then holds both sides
from gridpulse.schemas import RAW_COLUMNS
from gridpulse.sources import delimited, geojson, sinks, tables
from gridpulse.sources.scratch import cut, scratch_path
from gridpulse.streaming import arrivals

HEADER = ",".join(RAW_COLUMNS)


def place_files(spark: SparkSession, lines: DataFrame, folder: str) -> str:
    """Write (filename, at, value) as one text file per name, in the order of ``at``."""
    staged = scratch_path(spark, "staged")
    ordered = lines.repartition("filename").sortWithinPartitions("filename", "at")
    ordered.select("filename", "value").write.partitionBy("filename").text(staged)
    # a delivery has a name of its own, which a partitioned write cannot give
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for part in fs.globStatus(path(f"{staged}/filename=*/part-*")):
        source = part.getPath()
        fs.rename(source, path(folder, source.getParent().getName().removeprefix("filename=")))
    return folder


def delivery_lines(raw: DataFrame, line: Column | None = None, header: Column | None = None) -> DataFrame:
    """Text lines of the fixture's files: a header, then the rows in order."""
    number = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_COLUMNS])
    at = F.struct(F.lit(1).alias("kind"), "h", "g", "cc")
    rows = raw.select(F.col("source_filename").alias("filename"), at.alias("at"), (number if line is None else line).alias("value"))
    heads = raw.groupBy("source_filename").agg(F.min("h").alias("h")).select(
        F.col("source_filename").alias("filename"),
        F.struct(F.lit(0).alias("kind"), "h", F.lit(0).cast("bigint").alias("g"), F.lit(0).cast("bigint").alias("cc")).alias("at"),
        (F.lit(HEADER) if header is None else header).alias("value"))
    return rows.unionByName(heads)


def deliveries(spark: SparkSession, sf_dir: str) -> str:
    """Landing folder with the fixture's daily files."""
    return place_files(spark, delivery_lines(fixture.raw_activity(spark, sf_dir)), scratch_path(spark, "landing"))


@query
def delivered_clean_rows(spark, sf_dir):
    """Clean rows of all files, read as deliveries with their lineage."""
    delimited.require_files(spark, landing := deliveries(spark, sf_dir))
    read = delimited.read_deliveries(spark, landing)
    stem = read.withColumn("stem", delimited.file_stem(F.col("source_file"))).where(F.col("stem") == F.col("source_filename"))
    typed = clean.coerce(clean.canonical_names(stem))
    return clean.finish(clean.kept(typed))


@query
def delivered_files(spark, sf_dir):
    """Rows and files found by name: the loose rule takes every case and spelling."""
    landing = deliveries(spark, sf_dir)
    strict = delimited.read_deliveries(spark, landing).groupBy("source_filename").agg(F.count(F.lit(1)).alias("rows"))
    loose = delimited.list_files(spark, landing, delimited.LOOSE_PATTERN).withColumnRenamed("filename", "source_filename")
    return strict.join(loose, "source_filename")


def damaged_lines(raw: DataFrame) -> DataFrame:
    """Every day its own kind of damage in its last row, besides the fixture's own defects."""
    last = F.struct("h", "g", "cc")
    ends = cut(raw.groupBy("source_filename").agg(F.max(last).alias("_last")))
    rows = raw.join(ends, "source_filename").withColumn("_hit", F.col("_last") == last)
    day = F.dayofmonth("h") % 16
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_COLUMNS}
    change = {
        1: {"datetime": " "}, 2: {"datetime": "2024-13-01 00:00:00"}, 3: {"CellID": ""}, 4: {"CellID": "1.5"}, 6: {"countrycode": "x"},
        7: {"smsin": "abc"}, 8: {"smsout": "-1"}, 9: {"callin": "1,5"}, 11: {"callout": "-2.5"}, 12: {"internet": "ten"},
    }
    fields = []
    for c in RAW_COLUMNS:
        value = text[c]
        for d, values in change.items():
            if c in values:
                value = F.when(F.col("_hit") & (day == d), values[c]).otherwise(value)
        fields.append(value)
    head = F.dayofmonth("h") % 16
    header = (
        F.when(head == 13, HEADER.replace(",internet", "")).when(head == 14, HEADER.replace("smsin,smsout", "smsout,smsin"))
        .otherwise(HEADER))
    return delivery_lines(rows, F.concat_ws(",", *fields), header)


@query
def line_file_verdicts(spark, sf_dir):
    """Verdicts from text lines: every rule is broken by some file."""
    raw = fixture.raw_activity(spark, sf_dir)
    landing = place_files(spark, damaged_lines(raw), scratch_path(spark, "landing"))
    return gate.file_verdicts(delimited.read_records(spark, landing), delimited.list_files(spark, landing))


def broken_lines(raw: DataFrame) -> DataFrame:
    """Deliveries with quoted line breaks: around a value, inside one, and with an empty line between."""
    keys = F.struct("h", "g", "cc")
    ends = cut(raw.groupBy("source_filename").agg(F.min(keys).alias("_first"), F.max(keys).alias("_last")))
    rows = raw.join(ends, "source_filename")
    day, first, last = F.dayofmonth("h") % 8, F.col("_first") == keys, F.col("_last") == keys
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_COLUMNS}
    text["CellID"] = F.when(last & (day == 1), F.concat(F.lit('"'), text["CellID"], F.lit('\n"'))).otherwise(text["CellID"])
    text["countrycode"] = F.when(first & day.isin(1, 3), F.concat(F.lit('"\n\n'), text["countrycode"], F.lit('"'))).otherwise(text["countrycode"])
    text["smsin"] = F.when(last & (day == 2), '"a\n""b"').otherwise(text["smsin"])
    text["smsout"] = F.when(last & (day == 3), "-1").otherwise(text["smsout"])
    return delivery_lines(rows, F.concat_ws(",", *text.values()))


@query
def line_break_verdicts(spark, sf_dir):
    """Verdicts of files whose quoted fields hold line breaks; row numbers count records, not lines."""
    raw = fixture.raw_activity(spark, sf_dir)
    landing = place_files(spark, broken_lines(raw), scratch_path(spark, "landing"))
    return gate.file_verdicts(delimited.read_records(spark, landing), delimited.list_files(spark, landing))


@query
def validation_results(spark, sf_dir):
    """Verdicts of the landing zone without routing, kept as JSON rows."""
    return daily.validate_landing(spark, deliveries(spark, sf_dir), scratch_path(spark, "results"))


@query
def ledger_after_two_runs(spark, sf_dir):
    """The ledger after the same deliveries were taken in twice."""
    landing, zones = deliveries(spark, sf_dir), arrivals.Zones(scratch_path(spark, "lake"))
    for _ in range(2):
        arrivals.ingest(spark, landing, zones)
    return sinks.read_ledger(spark, zones.ledger).drop("processed_at")


@query
def streamed_arrivals(spark, sf_dir):
    """The ledger and the rows of the raw zone after three runs of the file stream, the second with later files, the third with none."""
    lines = cut(delivery_lines(fixture.raw_activity(spark, sf_dir)))
    landing, zones, checkpoint = scratch_path(spark, "landing"), arrivals.Zones(scratch_path(spark, "lake")), scratch_path(spark, "stream")
    early = F.col("filename") <= EARLIER_DELIVERY
    for arriving in (early, ~early, None):
        if arriving is not None:
            place_files(spark, lines.where(arriving), landing)
        arrivals.ingest_new(spark, landing, zones, checkpoint, files_per_batch=12)
    stored = arrivals.read_raw(spark, zones).groupBy(F.col("source_filename").alias("filename")).agg(F.count(F.lit(1)).alias("raw_rows"))
    return sinks.read_ledger(spark, zones.ledger).drop("processed_at").join(stored, "filename", "left")


@query
def raw_zone_rows(spark, sf_dir):
    """Rows of the accepted files, read back from the raw zone, cleaned."""
    zones = arrivals.Zones(scratch_path(spark, "lake"))
    arrivals.ingest(spark, deliveries(spark, sf_dir), zones)
    return clean.clean(arrivals.read_raw(spark, zones))


@query
def delivery_totals(spark, sf_dir):
    """Totals of the deliveries as the ingestion summary reports them."""
    text = cut(fixture.as_text(fixture.raw_activity(spark, sf_dir)).select(*RAW_COLUMNS, "source_filename"))
    return daily.delivery_totals(text).drop("partition_count")


@query
def delivery_listing(spark, sf_dir):
    """One line per delivered file."""
    text = fixture.as_text(fixture.raw_activity(spark, sf_dir)).select(*RAW_COLUMNS, "source_filename")
    return aggregate.file_summary(clean.coerce(clean.canonical_names(text)))


@query
def geojson_cells(spark, sf_dir):
    """Cell polygons out of GeoJSON: one document, and one feature per line."""
    cells = cut(fixture.cell_lookup(spark, sf_dir))
    feature = F.concat(F.lit('{"type":"Feature","id":'), (F.col("grid_id") - 1).cast("string"), F.lit(',"properties":{"cellId":'),
                       F.col("grid_id").cast("string"), F.lit('},"geometry":'), F.col("geometry"), F.lit("}"))
    per_line, staged = scratch_path(spark, "geojson"), scratch_path(spark, "geojson")
    cells.select(feature.alias("value")).write.text(per_line)
    # a document is one file, so one task writes it, row by row; the features before each comma end at no line
    ends = cut(cells.agg(F.min("grid_id").alias("low"), F.max("grid_id").alias("high")))
    opening = F.when(F.col("grid_id") == F.col("low"), '{"type":"FeatureCollection","features":[').otherwise("")
    closing = F.when(F.col("grid_id") == F.col("high"), "]}").otherwise(",")
    row = cells.join(F.broadcast(ends)).select("grid_id", F.concat(opening, feature, closing).alias("value"))
    row.repartition(1).sortWithinPartitions("grid_id").select("value").write.option("lineSep", " ").text(staged)
    document = staged
    sources = {"document": geojson.read_lookup(spark, document), "lines": geojson.read_lookup(spark, per_line, one_per_line=True)}
    out = [geojson.require_cells(df).withColumn("source", F.lit(n)) for n, df in sources.items()]
    return out[0].unionByName(out[1])


def _published(spark, sf_dir) -> tuple[str, DataFrame]:
    """A root with the four published tables under their zone contracts."""
    root = scratch_path(spark, "published")
    hourly = cut(fixture.hourly_activity(spark, sf_dir))
    sinks.write_zone(hourly, f"{root}/processed/hourly_grid", "processed", rebalance=True)
    sinks.write_zone(hourly.drop("date"), f"{root}/analytics/hourly_grid_summary", "analytics")
    sinks.write_zone(aggregate.grid_performance(hourly), f"{root}/analytics/grid_performance", "analytics")
    sinks.write_zone(aggregate.temporal_performance(hourly), f"{root}/analytics/temporal_performance", "analytics")
    return root, hourly


@query
def published_tables(spark, sf_dir):
    """Each published table, read back and verified, one that is missing, and what discovery finds."""
    root, hourly = _published(spark, sf_dir)
    grains = {"processed/hourly_grid": hourly, "analytics/grid_performance": hourly.select("grid_id").distinct(),
              "analytics/temporal_performance": hourly.select("timestamp").distinct()}
    out = []
    for name, keys in grains.items():
        back = sinks.verify(spark, f"{root}/{name}", keys.count(), not_null=tuple(c for c in ("grid_id", "timestamp") if c in keys.columns))
        out.append(back.agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit(name)))
    for kind, df in tables.discover(spark, f"{root}/analytics").items():
        out.append(df.agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit(f"discovered {kind}")))
    there = tables.present(spark, {n: f"{root}/{n}" for n in (*grains, "analytics/none")})
    out.append(there.where("present").agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit("present")))
    both = out[0]
    for df in out[1:]:
        both = both.unionByName(df)
    return both


@query
def tree_rows(spark, sf_dir):
    """Every Parquet file below a partitioned root as one table."""
    root, _ = _published(spark, sf_dir)
    return tables.read_tree(spark, f"{root}/processed").groupBy("grid_id").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("total_activity"), 2).alias("total_activity"))


@query
def rebuilt_date(spark, sf_dir):
    """Partitioned table after one date was rebuilt and another appended."""
    hourly = cut(fixture.hourly_activity(spark, sf_dir))
    path = scratch_path(spark, "dated")
    sinks.replace_partitions(hourly.where(F.col("date") < "2024-01-15"), path)
    sinks.append_partitions(hourly.where(F.col("date") == "2024-01-15"), path)
    again = hourly.where(F.col("date") == "2024-01-10").withColumn("sms_in", F.lit(0.0))
    sinks.replace_partitions(again, path)
    return spark.read.parquet(path).groupBy("date").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("sms_in"), 2).alias("sms_in"), F.round(F.sum("sms_out"), 2).alias("sms_out"))


# The date that comes late, or is delivered again, in the queries below.
LATE = "2024-01-10"


def _late_states(spark, sf_dir, state) -> tuple[DataFrame, DataFrame, str]:
    """The hourly table, and states per date: all but one date first, that one last."""
    hourly, path = cut(fixture.hourly_activity(spark, sf_dir)), scratch_path(spark, "states")
    for part in (hourly.where(F.col("date") != LATE), hourly.where(F.col("date") == LATE)):
        sinks.write_zone(state(part), path, "processed", rebalance=True)
    return hourly, spark.read.parquet(path), path


@query
def thresholds_by_date(spark, sf_dir):
    """Alert limits from histograms per date, after one date was delivered again with doubled values."""
    twice = lambda df: df.withColumns({c: F.col(c) * 2 for c in alerts.LIMITED})
    hourly, histogram, path = _late_states(spark, sf_dir, lambda df: quantiles.value_histogram(df, alerts.LIMITED))
    changed = cut(twice(hourly.where(F.col("date") == LATE)))
    sinks.replace_partitions(quantiles.value_histogram(changed, alerts.LIMITED), path)
    table = cut(hourly.where(F.col("date") != LATE).unionByName(changed))
    t = alerts.thresholds(table, histogram=spark.read.parquet(path))
    df = spark.createDataFrame([(t.high_activity, t.high_internet, t.low_activity)],
                               "high_activity double, high_internet double, low_activity double")
    return df.select(*[F.round(c, 4).alias(c) for c in df.columns])


@query
def date_states(spark, sf_dir):
    """What the checks keep of every date of the clean rows, and how its keys reconcile with the hourly rows."""
    rows = cut(fixture.clean_activity(spark, sf_dir))
    hourly = cut(aggregate.hourly_grid(rows))
    states = datestates.rule_states(rows, daily.table_rules()[0])
    # one stored sum too high on the late date, and one of its cells not stored at all
    damaged = hourly.where((F.col("date") != LATE) | (F.col("grid_id") != 1)).withColumn(
        "sms_in", F.when((F.col("date") == LATE) & (F.col("hour") == 5), F.col("sms_in") + 1).otherwise(F.col("sms_in")))
    found = datestates.reconcile_states(rows, damaged)
    return states.join(found, "date").select(
        "date", "rows", "keys", "dup_groups", "stamps", F.bit_count("hours").alias("hours"), "null_grid_id", "neg_sms_in",
        "reconciled_keys", "missing_in_hourly", "missing_in_detail", "mismatched_keys")


@query
def distinct_ids_by_date(spark, sf_dir):
    """Distinct cells, countries and timestamps of all dates from the bitmaps of each."""
    rows = cut(fixture.clean_activity(spark, sf_dir).select("date", "timestamp", "grid_id", "country_code"))
    ids = {"grid_id": F.col("grid_id"), "country_code": F.col("country_code"), "timestamp": datestates.second_of("timestamp")}
    path = scratch_path(spark, "ids")
    for part in (rows.where(F.col("date") != LATE), rows.where(F.col("date") == LATE)):
        sinks.write_zone(datestates.id_bitmaps(part, ids), path, "processed", rebalance=True)
    return datestates.bitmap_counts(spark.read.parquet(path), list(ids))


@query
def late_date_fact(spark, sf_dir):
    """The fact table under its time keys after a date came late; no other date was written again."""
    rules = daily.table_rules()[1]
    hourly, states, _ = _late_states(spark, sf_dir, lambda df: datestates.rule_states(df, rules))
    path = scratch_path(spark, "fact")
    for part in (hourly.where(F.col("date") != LATE), hourly.where(F.col("date") == LATE)):
        sinks.write_zone(star.dated_fact(part), path, "processed", rebalance=True)
    return star.numbered_fact(spark.read.parquet(path), datestates.time_offsets(states))


@query
def footer_facts(spark, sf_dir):
    """Rows and extremes per date of a stored table, from its footers."""
    root, _ = _published(spark, sf_dir)
    columns = ["grid_id", "hour", "total_activity"]
    return tables.footer_facts(spark, f"{root}/processed/hourly_grid", columns, by=("date",))


@query
def bucketed_rollup(spark, sf_dir):
    """Sums per cell of a table in buckets of the cell: grouped without a shuffle."""
    path = scratch_path(spark, "bucketed")
    table = layout.bucketed(fixture.hourly_activity(spark, sf_dir), path.rsplit("/", 1)[-1].replace("-", "_"), path, "grid_id", 8)
    sums = aggregate.grid_performance(table)
    return sums.select("grid_id", *[F.round(c, 4).alias(c) for c in sums.columns[1:]])


@query
def exported_rows(spark, sf_dir):
    """The CSV export of the hourly grid with day names, read back."""
    hourly = aggregate.with_day_names(fixture.hourly_activity(spark, sf_dir))
    path = scratch_path(spark, "export")
    sinks.write_csv(hourly, path)
    schema = hourly.schema
    return delimited.read_csv(spark, path, schema)


@query
def normalised_names(spark, sf_dir):
    """Rows whose columns arrive under loose spellings, brought to canonical names."""
    raw = fixture.raw_activity(spark, sf_dir)
    loose = raw.select(*[F.col(c).alias(n) for c, n in LOOSE_NAMES.items()])
    return clean.finish(clean.kept(clean.coerce(clean.normalise_names(loose))))


# A loose spelling for each delivered column.
LOOSE_NAMES = {
    "datetime": " DateTime ", "CellID": "Cell_ID", "countrycode": "CountryCode", "smsin": "SMS In", "smsout": "SMS-Out",
    "callin": "CALL/IN", "callout": "call.out", "internet": "Internet",
}
