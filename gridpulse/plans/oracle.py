"""The registered queries written independently as SQL, for a second engine.

Texts share three common table expressions: ``raw`` (delivered rows with their
number inside the file), ``cleaned`` and ``hourly``.
"""

from __future__ import annotations

RAW = """
base AS (
  SELECT date_trunc('hour', ts) AS h, user_id + 1 AS g,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS cc,
         round(sum(value) FILTER (WHERE event_type = 'click'), 2) AS smsin,
         round(sum(value) FILTER (WHERE event_type = 'view'), 2) AS smsout,
         round(sum(value) FILTER (WHERE event_type = 'signup'), 2) AS callin,
         round(sum(value) FILTER (WHERE event_type = 'purchase'), 2) AS callout,
         round(sum(value) FILTER (WHERE event_type = 'error'), 2) AS internet
  FROM events GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN day(h) % 5 = 0 THEN (g * 31 + cc * 7 + hour(h)) % 97 END AS defect,
         'sms-call-internet-mi-' || strftime(h, '%Y-%m-%d') || '.csv' AS source_filename
  FROM base),
raw AS (
  SELECT source_filename, h, g, cc,
         row_number() OVER (PARTITION BY source_filename ORDER BY h, g, cc) AS row_no,
         CASE WHEN defect = 1 THEN 'bad-ts' ELSE strftime(h, '%Y-%m-%d %H:%M:%S') END AS datetime,
         CASE WHEN defect = 0 THEN NULL ELSE g END AS "CellID",
         cc AS countrycode,
         CASE WHEN defect = 2 THEN -1.0 ELSE smsin END AS smsin,
         smsout, callin, callout, internet
  FROM marked)
"""

TYPED = RAW + """,
typed AS (
  SELECT source_filename, datetime AS delivered, TRY_CAST(datetime AS TIMESTAMP) AS timestamp,
         "CellID" AS grid_id, countrycode AS country_code, smsin AS sms_in, smsout AS sms_out,
         callin AS call_in, callout AS call_out, internet AS internet_activity
  FROM raw),
kept AS (
  SELECT * FROM typed
  WHERE timestamp IS NOT NULL AND grid_id IS NOT NULL
    AND coalesce(least(sms_in, sms_out, call_in, call_out, internet_activity), 0) >= 0)
"""

CLEAN = TYPED + """,
filled AS (
  SELECT timestamp, CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour,
         CAST(dayofweek(timestamp) + 1 AS INTEGER) AS day_of_week, grid_id, country_code,
         round(coalesce(sms_in, 0), 4) AS sms_in, round(coalesce(sms_out, 0), 4) AS sms_out,
         round(coalesce(call_in, 0), 4) AS call_in, round(coalesce(call_out, 0), 4) AS call_out,
         round(coalesce(internet_activity, 0), 4) AS internet_activity
  FROM kept),
cleaned AS (
  SELECT *, round(sms_in + sms_out, 4) AS total_sms, round(call_in + call_out, 4) AS total_calls,
         round(sms_in + sms_out + call_in + call_out + internet_activity, 4) AS total_activity
  FROM filled)
"""

HOURLY = CLEAN + """,
summed AS (
  SELECT timestamp, date, hour, day_of_week, grid_id,
         round(sum(sms_in), 4) AS sms_in, round(sum(sms_out), 4) AS sms_out,
         round(sum(call_in), 4) AS call_in, round(sum(call_out), 4) AS call_out,
         round(sum(internet_activity), 4) AS internet_activity
  FROM cleaned GROUP BY ALL),
hourly AS (
  SELECT *, round(sms_in + sms_out, 4) AS total_sms, round(call_in + call_out, 4) AS total_calls,
         round(sms_in + sms_out + call_in + call_out + internet_activity, 4) AS total_activity
  FROM summed)
"""

LIMITS = HOURLY + """,
limits AS (
  SELECT quantile_cont(total_activity, 0.95) AS high_activity,
         quantile_cont(internet_activity, 0.95) AS high_internet,
         quantile_cont(total_activity, 0.05) AS low_activity
  FROM hourly)
"""

FIRED = LIMITS + """,
lagged AS (
  SELECT *, lag(total_activity) OVER (PARTITION BY grid_id ORDER BY timestamp) AS previous FROM hourly),
fired AS (
  SELECT 1 AS rule_no, timestamp, grid_id, 'HIGH_ACTIVITY' AS alert_type, 'HIGH' AS severity,
         'total_activity' AS metric, total_activity AS value, high_activity AS threshold
  FROM lagged, limits WHERE total_activity > high_activity
  UNION ALL
  SELECT 2, timestamp, grid_id, 'HIGH_INTERNET', 'MEDIUM', 'internet_activity', internet_activity, high_internet
  FROM lagged, limits WHERE internet_activity > high_internet
  UNION ALL
  SELECT 3, timestamp, grid_id, 'SUDDEN_SPIKE', 'HIGH', 'total_activity', total_activity, 2 * previous
  FROM lagged WHERE total_activity > 2 * previous
  UNION ALL
  SELECT 4, timestamp, grid_id, 'LOW_ACTIVITY', 'LOW', 'total_activity', total_activity, low_activity
  FROM lagged, limits WHERE total_activity < low_activity)
"""

STAR = HOURLY + """,
dim_time AS (
  SELECT CAST(row_number() OVER (ORDER BY timestamp) AS INTEGER) AS time_id, timestamp,
         CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour,
         CAST(dayofweek(timestamp) + 1 AS INTEGER) AS day_of_week
  FROM (SELECT DISTINCT timestamp FROM hourly)),
fact AS (
  SELECT time_id, CAST(grid_id AS INTEGER) AS grid_id, sms_in, sms_out, call_in, call_out,
         internet_activity, total_activity
  FROM hourly JOIN dim_time USING (timestamp))
"""

# geometry of a cell: closed square ring, coordinates rounded to 6 decimals
_X = "(9.0 + ((g - 1) % 100) * 0.003)"
_Y = "(45.3 + ((g - 1) // 100) * 0.003)"


def _corner(dx: str, dy: str) -> str:
    return (f"'[' || CAST(round({_X} + {dx}, 6) AS DOUBLE) || ',' || "
            f"CAST(round({_Y} + {dy}, 6) AS DOUBLE) || ']'")


_RING = " || ',' || ".join(
    _corner(dx, dy) for dx, dy in
    [("0.0", "0.0"), ("0.002", "0.0"), ("0.002", "0.002"), ("0.0", "0.002"), ("0.0", "0.0")])
GEOMETRY = """'{"type":"Polygon","coordinates":[[' || """ + _RING + " || ']]}'"
GEOMETRY = GEOMETRY.replace("9.0 +", "CAST(9.0 AS DOUBLE) +").replace("45.3 +", "CAST(45.3 AS DOUBLE) +")


def _cells(name: str, where: str = "") -> str:
    return f""",
{name}_ids AS (SELECT DISTINCT user_id + 1 AS g FROM events {where}),
{name} AS (SELECT g AS grid_id, {GEOMETRY} AS geometry FROM {name}_ids)
"""


LOOKUP = _cells("lookup")
LACKING = _cells("lacking", "WHERE user_id + 1 <> 7")

VERDICTS = RAW + """,
judged AS (
  SELECT source_filename, row_no,
    CASE WHEN TRY_CAST(datetime AS TIMESTAMP) IS NULL THEN 'invalid datetime at row ' || row_no || ': ' || datetime
         WHEN "CellID" IS NULL THEN 'missing CellID at row ' || row_no
         WHEN smsin < 0 THEN 'negative smsin at row ' || row_no || ': ' || CAST(CAST(smsin AS DOUBLE) AS VARCHAR)
    END AS reason
  FROM raw),
verdicts AS (
  SELECT source_filename AS filename, count(reason) = 0 AS valid,
         coalesce(min(row_no) FILTER (WHERE reason IS NOT NULL), count(*)) AS row_count,
         coalesce(arg_min(reason, row_no) FILTER (WHERE reason IS NOT NULL), 'Minimum quality checks passed') AS reason
  FROM judged GROUP BY 1)
"""

ROUTED = VERDICTS + """,
routed AS (
  SELECT filename,
         CASE WHEN valid AND filename <= 'sms-call-internet-mi-2024-01-10.csv' THEN 'SKIPPED_DUPLICATE'
              WHEN valid THEN 'ACCEPTED'
              WHEN filename <= 'sms-call-internet-mi-2024-01-10.csv' THEN 'REJECTED_DUPLICATE'
              ELSE 'REJECTED' END AS status,
         CASE WHEN valid THEN 'raw' ELSE 'rejected' END AS zone,
         row_count,
         CASE WHEN valid AND filename <= 'sms-call-internet-mi-2024-01-10.csv'
              THEN 'File already exists in raw; not overwritten' ELSE reason END AS reason
  FROM verdicts)
"""

MEASURES = ["sms_in", "sms_out", "call_in", "call_out", "internet_activity"]
TOTALS = ["total_sms", "total_calls", "total_activity"]
RAW_COLUMNS = ["datetime", "CellID", "countrycode", "smsin", "smsout", "callin", "callout", "internet"]
CLEAN_COLUMNS = ["timestamp", "date", "hour", "day_of_week", "grid_id", "country_code", *MEASURES, *TOTALS]
HOURLY_COLUMNS = [c for c in CLEAN_COLUMNS if c != "country_code"]
SHIPMENTS = """
shipments AS (
  SELECT l_shipdate AS timestamp, l_suppkey AS grid_id, round(sum(l_quantity), 4) AS sms_in,
         round(sum(l_extendedprice), 4) AS sms_out, round(sum(l_discount), 4) AS call_in,
         round(sum(l_tax), 4) AS call_out, 0.0::DOUBLE AS internet_activity
  FROM lineitem GROUP BY 1, 2),
shipped AS (
  SELECT *, round(sms_in + sms_out, 4) AS total_sms, round(call_in + call_out, 4) AS total_calls,
         round(round(sms_in + sms_out, 4) + round(call_in + call_out, 4) + internet_activity, 4) AS total_activity
  FROM shipments)
"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _null_rows(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE "{c}" IS NULL) AS null_count,
        count("{c}") AS non_null_count,
        round(count(*) FILTER (WHERE "{c}" IS NULL) * 100.0::DOUBLE / count(*), 2) AS null_percentage FROM {table}"""
        for c in columns)


def _checks() -> str:
    rows: list[str] = []

    def add(dataset, name, observed, expected, op="="):
        rows.append(
            f"SELECT '{dataset}' AS dataset, '{name}' AS check_name, "
            f"coalesce(({observed}) {op} ({expected}), false) AS passed, "
            f"CAST(({observed}) AS DOUBLE) AS observed, CAST(({expected}) AS DOUBLE) AS expected")

    cells = "SELECT max(user_id) + 1 FROM events"

    def count(t, where="true"):
        return f"SELECT count(*) FROM {t} WHERE {where}"

    for dataset, t, columns, grain in (
        ("clean", "cleaned", CLEAN_COLUMNS, "timestamp, grid_id, country_code"),
        ("hourly grid", "hourly", HOURLY_COLUMNS, "timestamp, grid_id"),
    ):
        add(dataset, "required columns missing", "0", "0")
        add(dataset, "exact ordered columns", "1", "1")
        if t == "hourly":
            add(dataset, "forbidden columns present", "0", "0")
        rows.append(f"SELECT '{dataset}', 'not empty', count(*) > 0, CAST(count(*) AS DOUBLE), 1.0::DOUBLE FROM {t}")
        distinct = f"SELECT count(*) FROM (SELECT DISTINCT {grain} FROM {t})"
        add(dataset, "rows beyond first per key", f"({count(t)}) - ({distinct})", "0")
        add(dataset, "keys more than once",
            f"SELECT count(*) FROM (SELECT {grain} FROM {t} GROUP BY {grain} HAVING count(*) > 1)", "0")
        for c in columns:
            add(dataset, f"nulls in {c}", count(t, f"{c} IS NULL"), "0")
        for c in [*MEASURES, *TOTALS]:
            add(dataset, f"negatives in {c}", count(t, f"{c} < 0"), "0")
        add(dataset, "hours of day seen", f"SELECT count(DISTINCT hour) FROM {t}", "24")
    add("hourly grid", "row bound", count("hourly"), f"720 * ({cells})", "<=")
    add("hourly grid", "fewer rows than input", count("hourly"), count("cleaned"), "<")
    add("hourly grid", "distinct timestamp", "SELECT count(DISTINCT timestamp) FROM hourly", "720")
    add("hourly grid", "distinct dates", "SELECT count(DISTINCT date) FROM hourly", "30")
    add("hourly grid", "smallest id", "SELECT min(grid_id) FROM hourly", "1")
    add("hourly grid", "largest id", "SELECT max(grid_id) FROM hourly", cells)
    add("hourly grid", "distinct ids", "SELECT count(DISTINCT grid_id) FROM hourly", cells)
    # a table held against the columns of the other, by the names that its rows carry
    for dataset, t, held, wanted in (
        ("clean as hourly grid", "cleaned", CLEAN_COLUMNS, HOURLY_COLUMNS), ("hourly grid as clean", "hourly", HOURLY_COLUMNS, CLEAN_COLUMNS),
    ):
        names = f"SELECT json_keys(to_json(r)) FROM (SELECT {', '.join(held)} FROM {t} LIMIT 1) r"
        add(dataset, "required columns missing", f"SELECT count(*) FROM unnest({wanted}) w(c) WHERE NOT list_contains(({names}), c)", "0")
        add(dataset, "exact ordered columns", f"CAST(({names}) = {wanted} AS INTEGER)", "1")
        if wanted is HOURLY_COLUMNS:
            add(dataset, "forbidden columns present", f"CAST(list_contains(({names}), 'country_code') AS INTEGER)", "0")
    for dataset, t in (("reference", "features"), ("damaged reference", "damaged")):
        add(dataset, "not empty", count(t), "1", ">=")
        add(dataset, "features outside a collection", count(t, "kind <> 'FeatureCollection'"), "0")
        add(dataset, "missing ids", count(t, "cell_id IS NULL"), "0")
        add(dataset, "ids not integer", count(t, "cell_id IS NOT NULL AND TRY_CAST(cell_id AS BIGINT) IS NULL"), "0")
        add(dataset, "ids more than once", f"SELECT count(*) FROM (SELECT TRY_CAST(cell_id AS BIGINT) AS i FROM {t} "
            "WHERE i IS NOT NULL GROUP BY 1 HAVING count(*) > 1)", "0")
        add(dataset, "missing geometry", count(t, "geometry IS NULL"), "0")
        add(dataset, "distinct ids", f"SELECT count(DISTINCT TRY_CAST(cell_id AS BIGINT)) FROM {t}", cells)
    add("clean", "timestamp cadence", "SELECT count(DISTINCT timestamp) FROM kept",
        "SELECT 24 * count(DISTINCT source_filename) FROM kept")
    add("raw", "source files", "SELECT count(DISTINCT source_filename) FROM typed", "30")
    add("hourly grid", "gaps between timestamps",
        "SELECT count(*) FROM (SELECT timestamp - lag(timestamp) OVER (ORDER BY timestamp) AS d "
        "FROM (SELECT DISTINCT timestamp FROM hourly)) WHERE d <> INTERVAL 1 HOUR", "0")
    add("enriched", "coverage percent", "SELECT 100.0 * count(DISTINCT lookup.grid_id) / count(DISTINCT hourly.grid_id) "
        "FROM hourly LEFT JOIN lookup ON hourly.grid_id = lookup.grid_id", "100")
    add("enriched", "join keeps rows", "SELECT count(*) FROM hourly LEFT JOIN lookup USING (grid_id)", count("hourly"))
    add("enriched", "same cells as reference",
        "SELECT CAST(NOT EXISTS (SELECT grid_id FROM lookup EXCEPT SELECT grid_id FROM hourly) AS INTEGER)", "1")
    again = ", ".join(f"round(sum({m}), 4) AS {m}" for m in MEASURES)
    add("hourly grid", "keys that do not reconcile",
        f"SELECT count(*) FROM hourly h FULL JOIN (SELECT timestamp, grid_id, {again} FROM cleaned GROUP BY 1, 2) d "
        "ON h.timestamp = d.timestamp AND h.grid_id = d.grid_id WHERE "
        + " OR ".join(f"h.{m} IS DISTINCT FROM d.{m}" for m in MEASURES), "0")
    add("hourly grid", "layout keeps rows", "SELECT sum(n) FROM (SELECT count(*) AS n FROM hourly GROUP BY grid_id)", count("hourly"))
    materialized = HOURLY + LOOKUP + """,
features AS (SELECT 'FeatureCollection' AS kind, CAST(grid_id AS VARCHAR) AS cell_id, geometry FROM lookup),
damaged AS (
  SELECT CASE WHEN grid_id % 11 = 0 THEN 'Feature' ELSE 'FeatureCollection' END AS kind,
         CASE grid_id % 13 WHEN 1 THEN NULL WHEN 2 THEN 'x' || grid_id WHEN 3 THEN CAST(grid_id - 1 + 2 AS VARCHAR)
                           ELSE CAST(grid_id AS VARCHAR) END AS cell_id,
         CASE WHEN grid_id % 7 <> 0 THEN geometry END AS geometry FROM lookup)
"""
    for name in ("hourly", "cleaned", "kept", "typed", "lookup"):
        materialized = materialized.replace(f"\n{name} AS (", f"\n{name} AS MATERIALIZED (")
    return _with(materialized, "\nUNION ALL ".join(rows))


def _reconcile(stored_where: str) -> str:
    sums = ", ".join(f"round(sum({m}), 4) AS {m}" for m in MEASURES)
    differ = " OR ".join(f"abs(d.{m} - s.{m}) > 0.00005" for m in MEASURES)
    return _with(CLEAN + f""",
detail AS (SELECT timestamp, grid_id, {sums} FROM cleaned GROUP BY 1, 2),
stored AS (SELECT timestamp, grid_id, {sums} FROM cleaned WHERE {stored_where} GROUP BY 1, 2)
""", f"""
SELECT count(*) AS keys, count(*) FILTER (WHERE s.grid_id IS NULL) AS missing_in_hourly,
       count(*) FILTER (WHERE d.grid_id IS NULL) AS missing_in_detail,
       CAST(0 AS BIGINT) AS stored_more_than_once,
       count(*) FILTER (WHERE d.grid_id IS NOT NULL AND s.grid_id IS NOT NULL AND ({differ})) AS mismatched_keys
FROM detail d FULL JOIN stored s ON d.timestamp = s.timestamp AND d.grid_id = s.grid_id""")


def _gaps(where: str) -> str:
    return _with(HOURLY + f""",
stamps AS (SELECT DISTINCT timestamp FROM hourly WHERE {where}),
pairs AS (SELECT lag(timestamp) OVER (ORDER BY timestamp) AS previous_timestamp, timestamp FROM stamps)
""", """
SELECT previous_timestamp, timestamp,
       CAST(epoch(timestamp) - epoch(previous_timestamp) AS BIGINT) AS diff_seconds
FROM pairs WHERE previous_timestamp IS NOT NULL AND timestamp - previous_timestamp <> INTERVAL 1 HOUR""")


def _kpi(key: str, extra: str = "") -> str:
    return f"""
SELECT {key}, round(sum(total_sms), 4) AS total_sms, round(sum(total_calls), 4) AS total_calls,
       round(sum(internet_activity), 4) AS internet_activity,
       round(sum(total_activity), 4) AS total_activity{extra}
FROM hourly GROUP BY {key}"""


def _stats() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, count({m}) AS count, round(avg({m}), 4) AS mean,
        round(stddev_samp({m}), 4) AS std, min({m}) AS min, round(quantile_cont({m}, 0.5), 4) AS median,
        max({m}) AS max FROM typed""" for m in MEASURES)


def _ranges() -> str:
    ctes = TYPED + """,
zeroed AS (
  SELECT *, coalesce(sms_in, 0) + coalesce(sms_out, 0) AS total_sms,
         coalesce(call_in, 0) + coalesce(call_out, 0) AS total_calls FROM typed),
full_rows AS (
  SELECT *, total_sms + total_calls + coalesce(internet_activity, 0) AS total_activity FROM zeroed)"""
    return _with(ctes, " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, round(min({m}), 4) AS min, round(max({m}), 4) AS max,
        round(avg({m}), 4) AS mean FROM full_rows""" for m in [*MEASURES, *TOTALS]))


def _duplicates(scope: str, columns: list[str]) -> str:
    names = ", ".join(f'"{c}"' for c in columns)
    return f"""SELECT '{scope}' AS scope, CAST(sum(n) AS BIGINT) AS row_count,
    CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows, count(*) FILTER (WHERE n > 1) AS duplicate_groups
    FROM (SELECT count(*) AS n FROM raw GROUP BY {names})"""


def _alert_rows(numbering: str) -> str:
    return _with(FIRED, f"""
SELECT row_number() OVER (ORDER BY {numbering}) AS alert_id, timestamp, grid_id, alert_type, severity,
       metric, round(value, 4) AS value, round(threshold, 4) AS threshold
FROM fired""")


def _entries(limit: str = "") -> str:
    return f"""
SELECT filename, status, row_count, reason, TIMESTAMP '2024-02-01 00:00:00' AS processed_at
FROM routed ORDER BY processed_at DESC, filename {limit}"""


STALE = STAR + """,
stale_time AS (SELECT * FROM dim_time WHERE timestamp < TIMESTAMP '2024-01-02 00:00:00'),
stale_grid AS (SELECT DISTINCT grid_id FROM hourly WHERE timestamp < TIMESTAMP '2024-01-02 00:00:00')
"""

STATUS = ROUTED.replace("WITH ", "") + STAR[len(RAW):]


def _leading(metric: str, out: str) -> str:
    return f"""
SELECT CAST(grid_id AS INTEGER) AS grid_id, {out} FROM (
  SELECT *, row_number() OVER (ORDER BY {out} DESC, grid_id) AS place
  FROM (SELECT grid_id, round(sum({metric}), 2) AS {out} FROM hourly GROUP BY 1)) WHERE place <= 10"""


def build() -> dict[str, str]:
    clean_list, hourly_list = ", ".join(CLEAN_COLUMNS), ", ".join(HOURLY_COLUMNS)
    measure_list = ", ".join(MEASURES)
    return {
        "clean_rows": _with(CLEAN, f"SELECT {clean_list} FROM cleaned"),
        "rejected_rows": _with(TYPED, """
SELECT source_filename, delivered, grid_id, country_code, sms_in,
       concat_ws(',', CASE WHEN timestamp IS NULL THEN 'missing_timestamp' END,
                      CASE WHEN grid_id IS NULL THEN 'missing_grid_id' END,
                      CASE WHEN sms_in < 0 THEN 'negative_activity' END) AS reasons
FROM typed WHERE timestamp IS NULL OR grid_id IS NULL OR sms_in < 0"""),
        "reject_summary": _with(TYPED, """
SELECT count(*) AS input_rows, count(*) FILTER (WHERE timestamp IS NULL) AS missing_timestamp,
       count(*) FILTER (WHERE grid_id IS NULL) AS missing_grid_id,
       count(*) FILTER (WHERE sms_in < 0) AS negative_activity,
       count(*) - (SELECT count(*) FROM kept) AS rejected_rows,
       (SELECT count(*) FROM kept) AS clean_rows
FROM typed"""),
        "nulls_to_fill": _with(TYPED, _null_rows("kept", MEASURES)),
        "row_reconciliation": _with(HOURLY, """
SELECT (SELECT count(*) FROM typed) AS input_rows,
       (SELECT count(*) FROM typed) - (SELECT count(*) FROM kept) AS rejected_rows,
       (SELECT count(*) FROM kept) AS clean_rows, (SELECT count(*) FROM hourly) AS hourly_rows,
       true AS conserved, (SELECT count(*) FROM hourly) < (SELECT count(*) FROM kept) AS reduced"""),
        "null_profile": _with(RAW, _null_rows("raw", RAW_COLUMNS)),
        "total_nulls": _with(RAW, "SELECT " + " + ".join(
            f'count(*) FILTER (WHERE "{c}" IS NULL)' for c in RAW_COLUMNS) + " AS total_nulls FROM raw"),
        "measure_stats": _with(TYPED, _stats()),
        "activity_totals": _with(TYPED, """
SELECT round(sum(coalesce(sms_in, 0) + coalesce(sms_out, 0)), 4) AS total_sms,
       round(sum(coalesce(call_in, 0) + coalesce(call_out, 0)), 4) AS total_calls,
       round(sum(coalesce(sms_in, 0) + coalesce(sms_out, 0) + coalesce(call_in, 0)
             + coalesce(call_out, 0) + coalesce(internet_activity, 0)), 4) AS total_activity
FROM typed"""),
        "activity_ranges": _ranges(),
        "duplicate_rows": _with(RAW, _duplicates("whole row", RAW_COLUMNS) + " UNION ALL "
                                + _duplicates("raw grain", RAW_COLUMNS[:3])),
        "duplicate_groups": _with(RAW, """
SELECT datetime, "CellID", count(*) AS count FROM raw GROUP BY 1, 2 HAVING count(*) > 1"""),
        "distinct_counts": _with(TYPED, """
SELECT count(DISTINCT grid_id) AS unique_grid_id, count(DISTINCT country_code) AS unique_country_code,
       count(DISTINCT timestamp) AS unique_timestamp, count(DISTINCT CAST(timestamp AS DATE)) AS unique_date,
       count(DISTINCT source_filename) AS unique_source_filename
FROM typed"""),
        "distinct_counts_with_null": _with(TYPED, """
SELECT (SELECT count(*) FROM (SELECT DISTINCT grid_id FROM typed)) AS unique_grid_id,
       (SELECT count(*) FROM (SELECT DISTINCT country_code FROM typed)) AS unique_country_code,
       (SELECT count(*) FROM (SELECT DISTINCT timestamp FROM typed)) AS unique_timestamp"""),
        "id_time_ranges": _with(HOURLY, " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, "
            f"CAST(max({c}) AS VARCHAR) AS max_value, count(DISTINCT {c}) AS distinct_values FROM hourly"
            for c in ("grid_id", "date", "hour"))),
        "invalid_timestamps": _with(RAW, """
SELECT count(*) FILTER (WHERE datetime = 'bad-ts') AS invalid_timestamps,
       CAST(0 AS BIGINT) AS blank_timestamps FROM raw"""),
        "table_size": _with(HOURLY, "SELECT count(*) AS row_count, CAST(13 AS BIGINT) AS column_count FROM hourly"),
        "first_rows": _with(HOURLY, f"SELECT {hourly_list} FROM hourly ORDER BY timestamp, grid_id LIMIT 10"),
        "hourly_grid": _with(HOURLY, f"SELECT {hourly_list} FROM hourly"),
        "hourly_grid_named_days": _with(HOURLY, f"""
SELECT timestamp, date, hour, dayname(timestamp) AS day_of_week, grid_id, {measure_list}, {', '.join(TOTALS)}
FROM hourly"""),
        "hourly_grid_geo": _with(HOURLY + LOOKUP, f"""
SELECT timestamp, grid_id, {measure_list}, total_activity, geometry FROM hourly JOIN lookup USING (grid_id)"""),
        "daily_kpi": _with(HOURLY, _kpi("date")),
        "grid_kpi_share": _with(HOURLY, _kpi(
            "grid_id",
            ", round(sum(internet_activity) / nullif(sum(total_activity), 0), 4) AS internet_share")),
        "grid_performance": _with(HOURLY, "SELECT grid_id, " + ", ".join(
            f"round(sum({m}), 4) AS window_{m}" for m in [*MEASURES, "total_activity"])
            + " FROM hourly GROUP BY grid_id"),
        "temporal_performance": _with(HOURLY, """
SELECT timestamp, round(sum(total_activity), 4) AS timestamp_total_activity FROM hourly
GROUP BY timestamp ORDER BY timestamp"""),
        "file_summary": _with(TYPED, """
SELECT source_filename, count(*) AS rows, count(DISTINCT grid_id) AS unique_grids,
       min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp
FROM typed GROUP BY 1"""),
        "date_coverage": _with(TYPED, """
SELECT CAST(timestamp AS DATE) AS date, count(*) AS rows FROM typed WHERE timestamp IS NOT NULL GROUP BY 1"""),
        "hour_coverage": _with(TYPED + """,
hours AS (SELECT DISTINCT CAST(hour(timestamp) AS INTEGER) AS hour FROM typed WHERE timestamp IS NOT NULL)""", """
SELECT count(*) AS hour_count, string_agg(CAST(hour AS VARCHAR), ',' ORDER BY hour) AS hours_seen,
       coalesce((SELECT string_agg(CAST(d.i AS VARCHAR), ',' ORDER BY d.i) FROM range(24) d(i)
                 WHERE d.i NOT IN (SELECT hour FROM hours)), '') AS hours_missing,
       count(*) = 24 AS complete FROM hours"""),
        "top_grids_geo": _with(HOURLY + LOOKUP, """
SELECT grid_id, total_activity, geometry FROM (
  SELECT grid_id, round(sum(total_activity), 4) AS total_activity FROM hourly GROUP BY 1
  ORDER BY 2 DESC, 1 LIMIT 10) JOIN lookup USING (grid_id)"""),
        "timestamp_gaps": _gaps("true"),
        "busy_hour_gaps": _gaps("total_activity >= 100"),
        "previous_activity": _with(HOURLY, """
SELECT timestamp, grid_id, total_activity,
       lag(total_activity) OVER (PARTITION BY grid_id ORDER BY timestamp) AS previous_activity FROM hourly"""),
        "alert_thresholds": _with(LIMITS, """
SELECT round(high_activity, 4) AS high_activity, round(high_internet, 4) AS high_internet,
       round(low_activity, 4) AS low_activity FROM limits"""),
        "alert_table": _alert_rows("rule_no, grid_id, timestamp"),
        "alert_table_renumbered": _alert_rows("timestamp, grid_id, alert_type"),
        "alert_counts": _with(FIRED, "SELECT alert_type, severity, count(*) AS n FROM fired GROUP BY 1, 2"),
        "alerts_by_severity": _with(FIRED, "SELECT severity, count(*) AS count FROM fired GROUP BY 1"),
        "dim_time": _with(STAR, "SELECT * FROM dim_time"),
        "dim_grid": _with(HOURLY + LOOKUP, """
SELECT CAST(grid_id AS INTEGER) AS grid_id, geometry
FROM (SELECT DISTINCT grid_id FROM hourly) JOIN lookup USING (grid_id)"""),
        "fact_activity": _with(STAR, "SELECT * FROM fact"),
        "orphan_keys": _with(STALE, """
SELECT 'dim_time' AS dimension, count(*) AS orphan_rows FROM fact
WHERE time_id NOT IN (SELECT time_id FROM stale_time)
UNION ALL
SELECT 'dim_grid', count(*) FROM fact WHERE grid_id NOT IN (SELECT grid_id FROM stale_grid)"""),
        "star_constraints": _with(STAR, """
SELECT 'dim_time primary key' AS constraint_name, count(*) - count(DISTINCT time_id) AS violations FROM dim_time
UNION ALL SELECT 'dim_time unique timestamp', count(*) - count(DISTINCT timestamp) FROM dim_time
UNION ALL SELECT 'dim_grid primary key', count(*) - count(DISTINCT grid_id) FROM (SELECT DISTINCT grid_id FROM hourly)
UNION ALL SELECT 'fact primary key', count(*) - count(DISTINCT (time_id, grid_id)) FROM fact
UNION ALL SELECT 'fact measures not null', count(*) FILTER (WHERE sms_in + sms_out + call_in + call_out
    + internet_activity + total_activity IS NULL) FROM fact
UNION ALL SELECT 'fact time foreign key', count(*) FROM fact WHERE time_id NOT IN (SELECT time_id FROM dim_time)
UNION ALL SELECT 'fact grid foreign key', count(*) FROM fact
    WHERE grid_id NOT IN (SELECT user_id + 1 FROM events)"""),
        "broken_constraints": _with(STAR + """,
bad AS (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE grid_id = 3),
early AS (SELECT * FROM dim_time WHERE timestamp < TIMESTAMP '2024-01-02 00:00:00'),
cells AS (SELECT DISTINCT grid_id FROM hourly WHERE grid_id <> 6),
grids AS (SELECT * FROM cells UNION ALL SELECT * FROM cells WHERE grid_id = 4)
""", """
SELECT 'dim_time primary key' AS constraint_name, count(*) - count(DISTINCT time_id) AS violations FROM early
UNION ALL SELECT 'dim_time unique timestamp', count(*) - count(DISTINCT timestamp) FROM early
UNION ALL SELECT 'dim_grid primary key', count(*) - count(DISTINCT grid_id) FROM grids
UNION ALL SELECT 'fact primary key', count(*) - count(DISTINCT (time_id, grid_id)) FROM bad
UNION ALL SELECT 'fact measures not null', count(*) FROM bad WHERE grid_id = 5
UNION ALL SELECT 'fact time foreign key', count(*) FROM bad WHERE time_id NOT IN (SELECT time_id FROM early)
UNION ALL SELECT 'fact grid foreign key', count(*) FROM bad WHERE grid_id NOT IN (SELECT grid_id FROM grids)"""),
        "report_top_grids": _with(HOURLY, _leading("total_activity", "total_activity")),
        "report_hourly_trend": _with(HOURLY, """
SELECT hour, round(sum(total_activity), 2) AS total_activity, round(sum(internet_activity), 2) AS internet_activity
FROM hourly GROUP BY hour"""),
        "report_internet_windows": _with(HOURLY, """
SELECT timestamp, CAST(grid_id AS INTEGER) AS grid_id, round(internet_activity, 2) AS internet_activity,
       round(total_activity, 2) AS total_activity
FROM (SELECT *, row_number() OVER (ORDER BY internet_activity DESC, timestamp, grid_id) AS place FROM hourly)
WHERE place <= 10"""),
        "report_top_internet": _with(HOURLY, _leading("internet_activity", "total_internet_activity")),
        "report_join_count": _with(STAR, """
SELECT count(*) AS joined_rows FROM fact
WHERE time_id IN (SELECT time_id FROM dim_time) AND grid_id IN (SELECT grid_id FROM hourly)"""),
        "run_status": _with(STATUS, """
SELECT 'fixture' AS run_id, CASE WHEN orphan_time_keys + orphan_grid_keys = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status, *
FROM (SELECT (SELECT count(*) FROM typed) AS rows_in,
       (SELECT count(*) FROM typed) - (SELECT count(*) FROM kept) AS rows_rejected,
       (SELECT 5 * count(*) - count(sms_in) - count(sms_out) - count(call_in) - count(call_out)
               - count(internet_activity) FROM kept) AS nulls_handled,
       (SELECT count(*) FROM fact) AS rows_published, (SELECT max(timestamp) FROM hourly) AS as_of,
       (SELECT count(*) FROM dim_time) AS dim_time_rows,
       (SELECT count(DISTINCT grid_id) FROM hourly) AS dim_grid_rows,
       (SELECT count(*) FROM fact) AS fact_rows,
       (SELECT count(*) FROM fact WHERE time_id NOT IN (SELECT time_id FROM dim_time)) AS orphan_time_keys,
       (SELECT count(*) FROM fact WHERE grid_id NOT IN (SELECT grid_id FROM hourly)) AS orphan_grid_keys,
       (SELECT count(*) FROM routed WHERE status LIKE 'REJECTED%') AS files_rejected)"""),
        "file_verdicts": _with(VERDICTS, "SELECT * FROM verdicts"),
        "batch_verdicts": _with(VERDICTS, """
SELECT filename, valid, row_count, CASE WHEN valid THEN 'Validation passed' ELSE reason END AS reason
FROM verdicts"""),
        "file_routing": _with(ROUTED, "SELECT * FROM routed"),
        "rows_by_route": _with(ROUTED, """
SELECT status, zone, count(DISTINCT filename) AS files, count(*) AS rows
FROM routed JOIN raw ON filename = source_filename GROUP BY 1, 2"""),
        "ledger_entries": _with(ROUTED, _entries("LIMIT 10")),
        "rejected_file_count": _with(ROUTED, """
SELECT count(*) AS files_rejected FROM routed WHERE status IN ('REJECTED', 'REJECTED_DUPLICATE')"""),
        "header_verdicts": _with(RAW, """
SELECT DISTINCT source_filename, day(h) > 20 AS valid,
       CASE WHEN day(h) <= 5 THEN 'missing columns: [''internet'']'
            WHEN day(h) <= 10 THEN 'unexpected columns: [''extra'']'
            WHEN day(h) <= 15 THEN 'columns are in an unexpected order'
            WHEN day(h) <= 20 THEN 'missing columns: [''CellID'']; unexpected columns: [''cellid'']'
            ELSE 'Schema valid' END AS reason
FROM raw"""),
        "grid_centroids": f"""
SELECT g AS grid_id, round({_X} + 0.001, 6) AS longitude, round({_Y} + 0.001, 6) AS latitude
FROM (SELECT DISTINCT user_id + 1 AS g FROM events)""".replace(
            "9.0 +", "CAST(9.0 AS DOUBLE) +").replace("45.3 +", "CAST(45.3 AS DOUBLE) +"),
        "odd_centroids": f"""
SELECT g AS grid_id, CASE g % 3 WHEN 1 THEN round({_X} + 0.006, 5) WHEN 2 THEN round({_X} + 0.001, 5) END AS longitude,
       CASE g % 3 WHEN 1 THEN round({_Y} + 0.001, 5) WHEN 2 THEN round({_Y} + 0.002, 5) END AS latitude
FROM (SELECT DISTINCT user_id + 1 AS g FROM events)""".replace(
            "9.0 +", "CAST(9.0 AS DOUBLE) +").replace("45.3 +", "CAST(45.3 AS DOUBLE) +"),
        "enriched_activity": _with(HOURLY + LACKING, f"""
SELECT timestamp, grid_id, {measure_list}, total_activity, geometry
FROM hourly LEFT JOIN lacking USING (grid_id)"""),
        "enrichment_coverage": _with(HOURLY + LOOKUP + LACKING, " UNION ALL ".join(f"""
SELECT '{label}' AS lookup, count(DISTINCT h.grid_id) AS activity_grids, count(DISTINCT e.grid_id) AS matched_grids,
       count(*) FILTER (WHERE e.grid_id IS NULL) AS unmatched_rows,
       round(count(DISTINCT e.grid_id) * 100.0::DOUBLE / count(DISTINCT h.grid_id), 4) AS coverage_pct
FROM hourly h LEFT JOIN {name} e ON h.grid_id = e.grid_id""" for label, name in (("full", "lookup"), ("one missing", "lacking")))),
        "unmatched_cells": _with(HOURLY + LACKING, """
SELECT DISTINCT grid_id FROM hourly WHERE grid_id NOT IN (SELECT grid_id FROM lacking)"""),
        "geo_spot_check": f"""
WITH placed AS (SELECT g, {_X} + 0.001 AS x, {_Y} + 0.001 AS y FROM (SELECT DISTINCT user_id + 1 AS g FROM events) WHERE g IN (1, 2, 15))
SELECT count(*) = 3 AS all_located,
       round(sqrt(pow(max(x) FILTER (g = 1) - max(x) FILTER (g = 2), 2) + pow(max(y) FILTER (g = 1) - max(y) FILTER (g = 2), 2)), 8) AS neighbour_distance,
       max(x) FILTER (g = 1) <> max(x) FILTER (g = 2) OR max(y) FILTER (g = 1) <> max(y) FILTER (g = 2) AS neighbours_differ,
       max(x) FILTER (g = 15) BETWEEN 8.8 AND 9.6 AND max(y) FILTER (g = 15) BETWEEN 45.2 AND 45.8 AS inside_box
FROM placed""".replace("(9.0 +", "(CAST(9.0 AS DOUBLE) +").replace("(45.3 +", "(CAST(45.3 AS DOUBLE) +"),
        "reconcile_all_keys": _reconcile("true"),
        "reconcile_stale_hourly": _reconcile("country_code > 0"),
        "reconcile_first_key": _with(HOURLY + """,
chosen AS (SELECT timestamp, grid_id FROM hourly ORDER BY timestamp, grid_id LIMIT 1),
detail AS (SELECT c.* FROM cleaned c JOIN chosen USING (timestamp, grid_id)),
stored AS (SELECT h.* FROM hourly h JOIN chosen USING (timestamp, grid_id))""", " UNION ALL ".join(
            f"SELECT timestamp, grid_id, '{m}' AS metric, (SELECT round(sum({m}), 4) FROM detail) AS recomputed, "
            f"{m} AS stored FROM stored" for m in MEASURES)),
        "key_set_compare": _with(HOURLY + LACKING, """
SELECT (SELECT count(*) FROM hourly) AS left_rows, (SELECT count(*) FROM lacking) AS right_rows,
       (SELECT count(DISTINCT grid_id) FROM hourly) AS left_keys,
       (SELECT count(*) FROM lacking) AS right_keys,
       (SELECT count(*) FROM (SELECT grid_id FROM hourly EXCEPT SELECT grid_id FROM lacking)) AS only_left,
       (SELECT count(*) FROM (SELECT grid_id FROM lacking EXCEPT SELECT grid_id FROM hourly)) AS only_right,
       (SELECT count(*) FROM (SELECT grid_id FROM hourly EXCEPT SELECT grid_id FROM lacking)) = 0
       AND (SELECT count(*) FROM (SELECT grid_id FROM lacking EXCEPT SELECT grid_id FROM hourly)) = 0
       AS keys_equal"""),
        "quality_checks": _checks(),
        "layout_keeps_rows": _with(HOURLY, " UNION ALL ".join(
            f"SELECT '{n}' AS layout, count(*) AS row_count FROM hourly"
            for n in ("as stored", "by key", "rebalanced", "fewer"))),
        "shipment_grid": _with(SHIPMENTS, f"SELECT timestamp, grid_id, {measure_list}, total_activity FROM shipped"),
        "shipment_daily_kpi": _with(SHIPMENTS, """
SELECT CAST(timestamp AS DATE) AS date, round(sum(total_sms), 2) AS total_sms,
       round(sum(total_calls), 2) AS total_calls, round(sum(internet_activity), 2) AS internet_activity,
       round(sum(total_activity), 2) AS total_activity
FROM shipped GROUP BY 1"""),
        "shipment_top_cells": _with(SHIPMENTS, """
SELECT grid_id, round(sum(total_activity), 2) AS total_activity FROM shipped GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 10"""),
        "shipment_quantiles": " UNION ALL ".join(
            f"SELECT '{m}' AS metric, {p}::DOUBLE AS p, round(quantile_cont({c}, {p}), 4) AS value FROM lineitem"
            for m, c in (("sms_in", "l_quantity"), ("sms_out", "l_extendedprice")) for p in (0.05, 0.5, 0.95)),
        "shipment_order_orphans": """
SELECT 'all' AS orders, count(*) AS orphan_rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL
SELECT 'before 1995', count(*) FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01 00:00:00')""",
        "negative_balances": """
SELECT count(*) AS input_rows, count(*) FILTER (WHERE false) AS missing_timestamp,
       count(*) FILTER (WHERE c_custkey IS NULL) AS missing_grid_id, count(*) FILTER (WHERE c_acctbal < 0) AS negative_activity,
       count(*) FILTER (WHERE c_custkey IS NULL OR c_acctbal < 0) AS rejected_rows,
       count(*) FILTER (WHERE c_custkey IS NOT NULL AND c_acctbal >= 0) AS clean_rows FROM customer""",
        "partition_rows": _with(HOURLY, "SELECT grid_id, count(*) AS rows, CAST(1 AS BIGINT) AS partitions FROM hourly GROUP BY 1"),
    }
