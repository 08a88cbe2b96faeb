"""The same queries as plain SQL over the same tables, written without regard to the engine."""

from __future__ import annotations

_RAW = """
raw AS (
  SELECT event_id,
         strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS "timestamp",
         CAST(value AS VARCHAR) AS grid_purchase,
         json_extract_string(props, '$.k') AS grid_feedin,
         CASE WHEN event_type = 'error' THEN 'Dev test'
              WHEN event_type = 'view' THEN 'n/a'
              WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END AS direct_consumption,
         strftime(ts, '%Y-%m-%d') AS "date",
         ts
  FROM events
)"""

_RAW_COLUMNS = 'event_id, "timestamp", grid_purchase, grid_feedin, direct_consumption, "date"'

_TOKENS = (
    "('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', "
    "'1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'n/a', 'nan', 'null')"
)

_LOADED = (
    "loaded AS (SELECT event_id, "
    + ", ".join(
        f'CASE WHEN "{c}" NOT IN {_TOKENS} THEN "{c}" END AS "{c}"'
        for c in ("timestamp", "grid_purchase", "grid_feedin", "direct_consumption", "date")
    )
    + " FROM raw)"
)


def _number(column: str) -> str:
    return f"COALESCE(CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS BIGINT), 0)"


_TYPED = f"""
typed AS (
  SELECT event_id,
         TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp",
         {_number("grid_purchase")} AS grid_purchase,
         {_number("grid_feedin")} AS grid_feedin,
         {_number("direct_consumption")} AS direct_consumption,
         {_number("direct_consumption")} > 0 AS direct_consumption_flag,
         ts
  FROM raw
  WHERE direct_consumption IS DISTINCT FROM 'Dev test'
    AND TRY_CAST("timestamp" AS TIMESTAMP) IS NOT NULL
)"""

_CLEAN = """
clean AS (
  SELECT * EXCLUDE (ts) FROM typed
  QUALIFY row_number() OVER (PARTITION BY "timestamp" ORDER BY event_id) = 1
)"""

_TOTALS = """
totals AS (
  SELECT CAST(hour("timestamp") AS INTEGER) AS hour,
         CAST(sum(grid_purchase) AS BIGINT) AS grid_purchase_total,
         CAST(sum(grid_feedin) AS BIGINT) AS grid_feedin_total
  FROM clean GROUP BY 1
)"""

_MAXIMA = """
maxima AS (
  SELECT CAST("timestamp" AS DATE) AS day,
         max(grid_purchase) AS max_grid_purchase,
         max(grid_feedin) AS max_grid_feedin
  FROM clean GROUP BY 1
)"""

_ENRICHED = """
enriched AS (
  SELECT c.*, t.grid_purchase_total, t.grid_feedin_total,
         c.grid_purchase = max(c.grid_purchase) OVER d AS max_grid_purchase_hour,
         c.grid_feedin = max(c.grid_feedin) OVER d AS max_grid_feedin_hour
  FROM clean c LEFT JOIN totals t ON hour(c."timestamp") = t.hour
  WINDOW d AS (PARTITION BY CAST(c."timestamp" AS DATE))
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


_ENRICHED_ROWS = _with(_RAW, _TYPED, _CLEAN, _TOTALS, _ENRICHED, select="SELECT * FROM enriched")
_CLEAN_ROWS = _with(_RAW, _TYPED, _CLEAN, select="SELECT * FROM clean")
_RAW_ROWS = _with(_RAW, select=f"SELECT {_RAW_COLUMNS} FROM raw")
_REJECTED = "{0} IS NOT NULL AND {0} NOT IN " + _TOKENS + " AND TRY_CAST({0} AS DOUBLE) IS NULL"

# The messy view, with the values its texts stand for.
_MESSY = """
messy AS (
  SELECT event_id,
         CASE event_id % 23 WHEN 3 THEN 'not-a-date' WHEN 7 THEN '1600-01-01 00:00:00' WHEN 11 THEN ''
           WHEN 13 THEN '2024-02-30 00:00:00' WHEN 5 THEN "timestamp" || '+05:30'
           ELSE "timestamp" END AS "timestamp",
         CASE event_id % 19 WHEN 2 THEN '1d' WHEN 4 THEN '0x1F' WHEN 6 THEN '1e20' WHEN 8 THEN 'inf'
           WHEN 10 THEN '9007199254740993' WHEN 12 THEN ' 12.9 ' WHEN 14 THEN '-7.9' WHEN 16 THEN '1e3'
           ELSE grid_purchase END AS grid_purchase,
         CASE WHEN event_id % 41 < 18 THEN (['', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN',
             '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'n/a', 'nan', 'null'])[event_id % 41 + 1]
           ELSE grid_feedin END AS grid_feedin,
         direct_consumption, "date", ts,
         CASE WHEN event_id % 23 NOT IN (3, 7, 11, 13) THEN date_trunc('minute', ts) END AS moment,
         CASE event_id % 19 WHEN 2 THEN 0 WHEN 4 THEN 0 WHEN 6 THEN 0 WHEN 8 THEN 0
           WHEN 10 THEN 9007199254740993 WHEN 12 THEN 12 WHEN 14 THEN -7 WHEN 16 THEN 1000
           ELSE COALESCE(CAST(trunc(TRY_CAST(grid_purchase AS DOUBLE)) AS BIGINT), 0) END AS purchase,
         CASE WHEN event_id % 41 < 18 THEN 0
           ELSE COALESCE(CAST(trunc(TRY_CAST(grid_feedin AS DOUBLE)) AS BIGINT), 0) END AS feedin
  FROM raw)"""

_MESSY_TYPED = f"""
typed AS (
  SELECT event_id, moment AS "timestamp", CAST(purchase AS BIGINT) AS grid_purchase,
         CAST(feedin AS BIGINT) AS grid_feedin,
         {_number("direct_consumption")} AS direct_consumption,
         {_number("direct_consumption")} > 0 AS direct_consumption_flag, ts
  FROM messy
  WHERE direct_consumption IS DISTINCT FROM 'Dev test' AND moment IS NOT NULL)"""

_MESSY_LINES = """
fields AS (
  SELECT *, concat_ws(';', event_id::VARCHAR, coalesce("timestamp", ''), coalesce(grid_purchase, ''),
                      coalesce(grid_feedin, ''), coalesce(direct_consumption, ''), coalesce("date", '')) AS line
  FROM messy)"""
_WATERMARK = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM typed)"

ORACLES: dict[str, str] = {
    "readings_with_metrics": _ENRICHED_ROWS,
    "readings_with_metrics_in_one_plan": _ENRICHED_ROWS,
    "raw_readings": _RAW_ROWS,
    "missing_tokens": _with(_RAW, _LOADED, select="SELECT * FROM loaded"),
    "sentinel_filtered": _RAW_ROWS + " WHERE direct_consumption IS DISTINCT FROM 'Dev test'",
    "numeric_coerced": _with(
        _RAW,
        select="SELECT event_id, "
        + ", ".join(
            f"{_number(c)} AS {c}" for c in ("grid_purchase", "grid_feedin", "direct_consumption")
        )
        + " FROM raw",
    ),
    "rejected_values": _with(
        _RAW,
        select="\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, "
            f"count(*) FILTER (WHERE {_REJECTED.format(c)}) AS rejected_count FROM raw"
            for c in ("grid_purchase", "grid_feedin", "direct_consumption")
        ),
    ),
    "date_dropped": _with(_RAW, select='SELECT * EXCLUDE ("date", ts) FROM raw'),
    "timestamp_parsed": """
        SELECT event_id, date_trunc('minute', ts) AS "timestamp" FROM events
        WHERE ts IS NOT NULL""",
    "timestamp_formats": """
        SELECT event_id,
               CASE WHEN event_id % 2 = 0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
                    ELSE date_trunc('minute', ts) END AS "timestamp"
        FROM events""",
    "first_per_timestamp": """
        SELECT date_trunc('minute', ts) AS "timestamp", min(event_id) AS event_id
        FROM events WHERE event_type IS DISTINCT FROM 'error' AND ts IS NOT NULL
        GROUP BY 1""",
    "consumption_flagged": _with(
        _RAW,
        select=f"""SELECT event_id, {_number("direct_consumption")} AS direct_consumption,
                   {_number("direct_consumption")} > 0 AS direct_consumption_flag
                   FROM raw WHERE direct_consumption IS DISTINCT FROM 'Dev test'""",
    ),
    "clean_readings": _CLEAN_ROWS,
    "hourly_rollup": _with(
        _RAW,
        _TYPED,
        _CLEAN,
        select="""SELECT CAST("timestamp" AS DATE) AS reading_day,
                  CAST(hour("timestamp") AS INTEGER) AS hour,
                  CAST(sum(grid_purchase) AS BIGINT) AS grid_purchase_total,
                  CAST(sum(grid_feedin) AS BIGINT) AS grid_feedin_total,
                  max(grid_purchase) AS max_grid_purchase, max(grid_feedin) AS max_grid_feedin
                  FROM clean GROUP BY 1, 2""",
    ),
    "hour_of_day_totals": _with(_RAW, _TYPED, _CLEAN, _TOTALS, select="SELECT * FROM totals"),
    "hour_totals_joined": _with(
        _RAW,
        _TYPED,
        _CLEAN,
        _TOTALS,
        select="""SELECT c.*, t.grid_purchase_total, t.grid_feedin_total
                  FROM clean c LEFT JOIN totals t ON hour(c."timestamp") = t.hour""",
    ),
    "daily_maxima": _with(_RAW, _TYPED, _CLEAN, _MAXIMA, select="SELECT * FROM maxima"),
    "daily_peak_flags": _with(
        _RAW,
        _TYPED,
        _CLEAN,
        _TOTALS,
        _ENRICHED,
        select='SELECT "timestamp", max_grid_purchase_hour, max_grid_feedin_hour FROM enriched',
    ),
    "daily_peak_hours": _with(
        _RAW,
        _TYPED,
        _CLEAN,
        select="""SELECT day, measure, hour, total FROM (
                    SELECT CAST("timestamp" AS DATE) AS day, 'grid_purchase' AS measure,
                           CAST(hour("timestamp") AS INTEGER) AS hour,
                           CAST(sum(grid_purchase) AS BIGINT) AS total
                    FROM clean GROUP BY 1, 3
                    UNION ALL
                    SELECT CAST("timestamp" AS DATE), 'grid_feedin',
                           CAST(hour("timestamp") AS INTEGER), CAST(sum(grid_feedin) AS BIGINT)
                    FROM clean GROUP BY 1, 3)
                  QUALIFY total = max(total) OVER (PARTITION BY day, measure)""",
    ),
    "column_profile": _with(
        _RAW,
        _LOADED,
        select="\nUNION ALL\n".join(
            f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, "
            f'count("{name}") AS non_null_count FROM loaded'
            for name, kind in (
                ("event_id", "bigint"),
                ("timestamp", "string"),
                ("grid_purchase", "string"),
                ("grid_feedin", "string"),
                ("direct_consumption", "string"),
                ("date", "string"),
            )
        ),
    ),
    "messy_missing_tokens": _with(
        _RAW,
        _MESSY,
        _LOADED.replace("FROM raw", "FROM messy"),
        select="SELECT * FROM loaded",
    ),
    "messy_rejected_values": _with(
        _RAW,
        _MESSY,
        select="""SELECT 'grid_purchase' AS column_name,
                  count(*) FILTER (WHERE event_id % 19 IN (2, 4, 6, 8)) AS rejected_count FROM messy
                  UNION ALL SELECT 'grid_feedin', 0
                  UNION ALL SELECT 'direct_consumption',
                  count(*) FILTER (WHERE direct_consumption = 'Dev test') FROM messy""",
    ),
    "messy_clean_readings": _with(_RAW, _MESSY, _MESSY_TYPED, _CLEAN, select="SELECT * FROM clean"),
    "messy_metrics": _with(
        _RAW, _MESSY, _MESSY_TYPED, _CLEAN, _TOTALS, _ENRICHED, select="SELECT * FROM enriched"
    ),
    "quarantined_lines": _with(
        _RAW,
        _MESSY,
        _MESSY_LINES,
        select="""SELECT CASE event_id % 50 WHEN 7 THEN line || ';one;more' ELSE '"' || line END AS line
                  FROM fields WHERE event_id % 50 IN (7, 13)""",
    ),
    "job_counts": _with(
        _RAW,
        _MESSY,
        select="""SELECT count(*) AS loaded_rows,
                  (SELECT count(*) FROM messy WHERE event_id % 50 IN (7, 13)) AS quarantined_rows,
                  count(*) FILTER (WHERE moment IS NULL AND kept) AS without_timestamp_rows,
                  count(DISTINCT moment) FILTER (WHERE kept) AS exported_rows
                  FROM (SELECT moment, event_id % 50 = 9 OR direct_consumption IS DISTINCT FROM 'Dev test' AS kept
                        FROM messy WHERE event_id % 50 NOT IN (7, 13))""",
    ),
    "inferred_profile": _with(
        _RAW,
        _MESSY,
        _LOADED.replace("FROM raw", "FROM messy"),
        select="SELECT 'event_id' AS column_name, 'bigint' AS data_type, count(*) AS row_count, "
        "count(event_id) AS non_null_count FROM loaded\nUNION ALL\n"
        + "\nUNION ALL\n".join(
            f"""SELECT '{c}', CASE WHEN count("{c}") = 0 THEN 'void'
                  WHEN bool_and(regexp_full_match("{c}", '\\s*[+-]?[0-9]+\\s*')) THEN 'bigint'
                  WHEN bool_and(regexp_full_match("{c}", '\\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*'))
                  THEN 'double'
                  WHEN bool_and(lower("{c}") IN ('true', 'false')) THEN 'boolean'
                  WHEN bool_and(regexp_full_match("{c}", '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
                                AND TRY_CAST("{c}" AS DATE) IS NOT NULL) THEN 'date'
                  WHEN bool_and(TRY_CAST("{c}" AS TIMESTAMP) IS NOT NULL) THEN 'timestamp'
                  ELSE 'string' END, count(*), count("{c}") FROM loaded"""
            for c in ("timestamp", "grid_purchase", "grid_feedin", "direct_consumption", "date")
        ),
    ),
    "non_null_consumption": _with(
        _RAW, _LOADED, select="SELECT * FROM loaded WHERE direct_consumption IS NOT NULL"
    ),
    "head_rows": _RAW_ROWS + " ORDER BY event_id LIMIT 10",
    "tail_rows": _RAW_ROWS + " ORDER BY event_id DESC LIMIT 10",
    "load_metrics": "SELECT count(*) AS row_count, CAST(6 AS BIGINT) AS column_count FROM events",
    "loaded_from_files": _with(_RAW, _LOADED, select="SELECT * FROM loaded"),
    "csv_round_trip": _ENRICHED_ROWS,
    "multiline_readings": _with(
        _RAW,
        _LOADED,
        select="""SELECT * EXCLUDE ("date"),
                  CASE WHEN event_id % 7 = 0
                       THEN concat('first;line', chr(10), 'second "quoted"', chr(10), chr(10), 'last of ', event_id)
                       WHEN event_id % 11 <> 0 THEN concat('plain ', event_id) END AS note
                  FROM loaded""",
    ),
    "file_head": _with(_RAW, _LOADED, select="SELECT * FROM loaded ORDER BY event_id LIMIT 10"),
    "file_tail": _with(_RAW, _LOADED, select="SELECT * FROM loaded ORDER BY event_id DESC LIMIT 10"),
    "snapshot_export": _ENRICHED_ROWS,
    "parquet_round_trip": _ENRICHED_ROWS,
    "export_text": _with(
        _RAW,
        _TYPED,
        _CLEAN,
        _TOTALS,
        _ENRICHED,
        select="SELECT strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS \"timestamp\", "
        + ", ".join(
            f"CASE WHEN {c} THEN 'True' ELSE 'False' END AS {c}"
            for c in ("direct_consumption_flag", "max_grid_purchase_hour", "max_grid_feedin_hour")
        )
        + " FROM enriched",
    ),
    "stream_clean_readings": _CLEAN_ROWS,
    "stream_metrics": _ENRICHED_ROWS,
    "stream_export": _ENRICHED_ROWS,
    "stream_late_files": _CLEAN_ROWS,
    "stream_rewritten_file": _CLEAN_ROWS,
    "stream_rewritten_metrics": _ENRICHED_ROWS,
    "stream_hour_totals": _with(
        _RAW, _TYPED, _TOTALS.replace("FROM clean", "FROM typed"), select="SELECT * FROM totals"
    ),
    "stream_daily_maxima": _with(
        _RAW,
        _TYPED,
        select=f"""SELECT CAST(ts AS DATE) AS day, max(grid_purchase) AS max_grid_purchase,
                   max(grid_feedin) AS max_grid_feedin
                   FROM typed GROUP BY 1
                   HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= {_WATERMARK}""",
    ),
}
