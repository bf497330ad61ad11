"""SQL counterparts of the file-side queries."""

from __future__ import annotations

from gridpulse.plans.oracle import (
    CLEAN, CLEAN_COLUMNS, HOURLY, HOURLY_COLUMNS, LOOKUP, RAW, ROUTED, STAR, TYPED, VERDICTS, _with,
)

# The damage of a file goes by its day; the last row of the file has it.
DAMAGED = RAW + """,
placed AS (
  SELECT *, row_no = max(row_no) OVER (PARTITION BY source_filename) AS hit, day(h) % 16 AS d FROM raw),
judged AS (
  SELECT source_filename, row_no, d,
    CASE WHEN hit AND d = 9 THEN 'wrong field count at row ' || row_no
         WHEN hit AND d = 1 THEN 'missing datetime at row ' || row_no
         WHEN hit AND d = 2 THEN 'invalid datetime at row ' || row_no || ': 2024-13-01 00:00:00'
         WHEN TRY_CAST(datetime AS TIMESTAMP) IS NULL THEN 'invalid datetime at row ' || row_no || ': ' || datetime
         WHEN hit AND d = 4 THEN 'invalid CellID at row ' || row_no || ': 1.5'
         WHEN "CellID" IS NULL OR (hit AND d = 3) THEN 'missing CellID at row ' || row_no
         WHEN hit AND d = 6 THEN 'invalid countrycode at row ' || row_no || ': x'
         WHEN hit AND d = 7 THEN 'non-numeric smsin at row ' || row_no || ': abc'
         WHEN smsin < 0 THEN 'negative smsin at row ' || row_no || ': -1.0'
         WHEN hit AND d = 8 THEN 'negative smsout at row ' || row_no || ': -1.0'
         WHEN hit AND d = 11 THEN 'negative callout at row ' || row_no || ': -2.5'
         WHEN hit AND d = 12 THEN 'non-numeric internet at row ' || row_no || ': ten'
    END AS reason
  FROM placed)
"""

# Line breaks in quotes: only days 2 and 3 of eight have a row that fails for it, their last one.
BROKEN = RAW + """,
placed AS (
  SELECT *, row_no = max(row_no) OVER (PARTITION BY source_filename) AS hit, day(h) % 8 AS d FROM raw),
judged AS (
  SELECT source_filename, row_no,
    CASE WHEN TRY_CAST(datetime AS TIMESTAMP) IS NULL THEN 'invalid datetime at row ' || row_no || ': ' || datetime
         WHEN "CellID" IS NULL THEN 'missing CellID at row ' || row_no
         WHEN hit AND d = 2 THEN 'non-numeric smsin at row ' || row_no || ': a' || chr(10) || '"b'
         WHEN smsin < 0 THEN 'negative smsin at row ' || row_no || ': -1.0'
         WHEN hit AND d = 3 THEN 'negative smsout at row ' || row_no || ': -1.0'
    END AS reason
  FROM placed)
"""

ACCEPTED = VERDICTS + CLEAN[len(RAW):].replace(
    "FROM kept)", "FROM kept WHERE source_filename IN (SELECT filename FROM verdicts WHERE valid))")


def build() -> dict[str, str]:
    clean_list, hourly_list = ", ".join(CLEAN_COLUMNS), ", ".join(HOURLY_COLUMNS)
    return {
        "delivered_clean_rows": _with(CLEAN, f"SELECT {clean_list} FROM cleaned"),
        "normalised_names": _with(CLEAN, f"SELECT {clean_list} FROM cleaned"),
        "delivered_files": _with(RAW, "SELECT source_filename, count(*) AS rows FROM raw GROUP BY 1"),
        "line_file_verdicts": _with(DAMAGED, """
SELECT source_filename AS filename, max(d) NOT IN (13, 14) AND count(reason) = 0 AS valid,
       CASE WHEN max(d) IN (13, 14) THEN 0
            ELSE coalesce(min(row_no) FILTER (WHERE reason IS NOT NULL), count(*)) END AS row_count,
       CASE max(d) WHEN 13 THEN 'missing columns: [''internet'']' WHEN 14 THEN 'columns are in an unexpected order'
            ELSE coalesce(arg_min(reason, row_no) FILTER (WHERE reason IS NOT NULL), 'Minimum quality checks passed')
       END AS reason
FROM judged GROUP BY 1"""),
        "line_break_verdicts": _with(BROKEN, """
SELECT source_filename AS filename, count(reason) = 0 AS valid,
       coalesce(min(row_no) FILTER (WHERE reason IS NOT NULL), count(*)) AS row_count,
       coalesce(arg_min(reason, row_no) FILTER (WHERE reason IS NOT NULL), 'Minimum quality checks passed') AS reason
FROM judged GROUP BY 1"""),
        "validation_results": _with(VERDICTS, """
SELECT filename AS file_path, valid, row_count, CASE WHEN valid THEN 'Validation passed' ELSE reason END AS reason
FROM verdicts"""),
        "ledger_after_two_runs": _with(VERDICTS, """
SELECT filename, CASE WHEN valid THEN 'ACCEPTED' ELSE 'REJECTED' END AS status, row_count, reason FROM verdicts
UNION ALL
SELECT filename, CASE WHEN valid THEN 'SKIPPED_DUPLICATE' ELSE 'REJECTED_DUPLICATE' END, row_count,
       CASE WHEN valid THEN 'File already exists in raw; not overwritten' ELSE reason END FROM verdicts"""),
        "streamed_arrivals": _with(VERDICTS, """
SELECT filename, CASE WHEN valid THEN 'ACCEPTED' ELSE 'REJECTED' END AS status, row_count, reason,
       CASE WHEN valid THEN row_count END AS raw_rows FROM verdicts"""),
        "raw_zone_rows": _with(ACCEPTED, f"SELECT {clean_list} FROM cleaned"),
        "delivery_totals": _with(TYPED, """
SELECT count(DISTINCT CAST(timestamp AS DATE)) + max(CAST(timestamp IS NULL AS INTEGER)) AS unique_date,
       count(DISTINCT grid_id) + max(CAST(grid_id IS NULL AS INTEGER)) AS unique_grid_id,
       count(DISTINCT country_code) + max(CAST(country_code IS NULL AS INTEGER)) AS unique_country_code,
       count(DISTINCT source_filename) AS unique_source_filename, count(*) AS row_count, 9 AS column_count,
       count(*) FILTER (WHERE timestamp IS NULL) AS invalid_timestamps
FROM typed"""),
        "delivery_listing": _with(TYPED, """
SELECT source_filename, count(*) AS rows, count(DISTINCT grid_id) AS unique_grids,
       min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp FROM typed GROUP BY 1"""),
        "geojson_cells": "WITH " + LOOKUP.strip().lstrip(",") + """
SELECT grid_id, geometry, 'document' AS source FROM lookup UNION ALL SELECT grid_id, geometry, 'lines' FROM lookup""",
        "published_tables": _with(HOURLY, """
SELECT 'processed/hourly_grid' AS name, count(*) AS rows FROM hourly
UNION ALL SELECT 'analytics/grid_performance', count(DISTINCT grid_id) FROM hourly
UNION ALL SELECT 'analytics/temporal_performance', count(DISTINCT timestamp) FROM hourly
UNION ALL SELECT 'discovered grid', count(DISTINCT grid_id) FROM hourly
UNION ALL SELECT 'discovered temporal', count(DISTINCT timestamp) FROM hourly
UNION ALL SELECT 'present', count(*) FROM (VALUES (1), (2), (3)) t WHERE EXISTS (SELECT 1 FROM hourly)"""),
        "tree_rows": _with(HOURLY, """
SELECT grid_id, count(*) AS rows, round(sum(total_activity), 2) AS total_activity FROM hourly GROUP BY 1"""),
        "rebuilt_date": _with(HOURLY, """
SELECT date, count(*) AS rows, CASE WHEN date = DATE '2024-01-10' THEN 0.0::DOUBLE ELSE round(sum(sms_in), 2) END AS sms_in,
       round(sum(sms_out), 2) AS sms_out
FROM hourly WHERE date <= DATE '2024-01-15' GROUP BY 1"""),
        "thresholds_by_date": _with(HOURLY, """
SELECT round(quantile_cont(t, 0.95), 4) AS high_activity, round(quantile_cont(i, 0.95), 4) AS high_internet,
       round(quantile_cont(t, 0.05), 4) AS low_activity
FROM (SELECT total_activity * f AS t, internet_activity * f AS i
      FROM (SELECT *, CASE WHEN date = DATE '2024-01-10' THEN 2 ELSE 1 END AS f FROM hourly))"""),
        "date_states": _with(HOURLY, """
SELECT c.*, h.reconciled_keys, h.missing_in_hourly, 0 AS missing_in_detail, h.mismatched_keys
FROM (SELECT date, sum(n)::BIGINT AS rows, count(*) AS keys, count(*) FILTER (WHERE n > 1) AS dup_groups,
             count(DISTINCT timestamp) AS stamps, count(DISTINCT hour(timestamp)) AS hours, 0 AS null_grid_id, 0 AS neg_sms_in
      FROM (SELECT date, timestamp, grid_id, country_code, count(*) AS n FROM cleaned GROUP BY ALL) GROUP BY date) c
JOIN (SELECT date, count(*) AS reconciled_keys, count(*) FILTER (WHERE late AND grid_id = 1) AS missing_in_hourly,
             count(*) FILTER (WHERE late AND grid_id <> 1 AND hour = 5) AS mismatched_keys
      FROM (SELECT *, date = DATE '2024-01-10' AS late FROM hourly) GROUP BY date) h USING (date)"""),
        "distinct_ids_by_date": _with(CLEAN, """
SELECT count(DISTINCT grid_id) AS unique_grid_id, count(DISTINCT country_code) AS unique_country_code,
       count(DISTINCT timestamp) AS unique_timestamp FROM cleaned"""),
        "late_date_fact": _with(STAR, "SELECT * FROM fact"),
        "footer_facts": _with(HOURLY, """
SELECT date, count(*) AS rows, min(grid_id) AS min_grid_id, max(grid_id) AS max_grid_id, min(hour) AS min_hour,
       max(hour) AS max_hour, min(total_activity) AS min_total_activity, max(total_activity) AS max_total_activity
FROM hourly GROUP BY date"""),
        "bucketed_rollup": _with(HOURLY, """
SELECT grid_id, round(sum(sms_in), 4) AS window_sms_in, round(sum(sms_out), 4) AS window_sms_out,
       round(sum(call_in), 4) AS window_call_in, round(sum(call_out), 4) AS window_call_out,
       round(sum(internet_activity), 4) AS window_internet_activity, round(sum(total_activity), 4) AS window_total_activity
FROM hourly GROUP BY 1"""),
        "exported_rows": _with(HOURLY, f"""
SELECT {hourly_list.replace("day_of_week", "strftime(date, '%A') AS day_of_week")} FROM hourly"""),
    }
