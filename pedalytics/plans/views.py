"""Reports and audit checks as stored views: SQL text that is planned anew by every reader.

A view names folders, not frames, so it shows the files that are there when it is read, and nothing is
worked out when it is made. Each scans the fact once: route ranks are taken over the distinct counts
(see ``operators.ranking``), whose branch shares the counting exchange with the report's own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pedalytics.config import Region

_MINUTES = "trip_duration_min"


def _stats(total: str) -> str:
    """Rides, mean and exact median minutes over counted durations."""
    return f"""sum(n) AS {total},
      CAST(round(CAST(sum(CAST(n AS DECIMAL(18,0)) * {_MINUTES}) AS DECIMAL(20,2))
        / nullif(CAST(sum(n) AS DECIMAL(18,0)), 0), 2) AS DECIMAL(18,2)) AS avg_duration_min,
      CAST(round(CAST(percentile({_MINUTES}, 0.5, n) AS DECIMAL(18,4)), 2) AS DECIMAL(18,2)) AS median_duration_min"""


def _growth(before: str) -> str:
    return (f"CAST(round(CAST(total_rides - {before} AS DECIMAL(18,0)) * CAST(100 AS DECIMAL(3,0))"
            f" / CAST(nullif({before}, 0) AS DECIMAL(15,0)), 2) AS DECIMAL(18,2))")


def ridership_over_time(fact: str, dates: str) -> str:
    month = "year_num, month_num, month_short, year_month"
    return f"""
    WITH counted AS (
      SELECT {month}, member_casual, {_MINUTES}, count(*) AS n
      FROM parquet.`{fact}` JOIN parquet.`{dates}` ON start_date_sk = date_sk GROUP BY ALL),
    monthly AS (SELECT {month}, member_casual, {_stats('total_rides')} FROM counted GROUP BY {month}, member_casual),
    before AS (
      SELECT *, lag(total_rides) OVER (PARTITION BY member_casual ORDER BY year_month) AS prev_month_rides,
        lag(total_rides, 12) OVER (PARTITION BY member_casual ORDER BY year_month) AS same_month_prev_year FROM monthly)
    SELECT {month}, member_casual, total_rides, avg_duration_min, median_duration_min,
      prev_month_rides, {_growth('prev_month_rides')} AS mom_growth_pct,
      same_month_prev_year, {_growth('same_month_prev_year')} AS yoy_growth_pct
    FROM before ORDER BY year_month, member_casual"""


def top_stations(fact: str, stations: str) -> str:
    """Ranks are windows over one row a station."""
    return f"""
    WITH ends AS (
      SELECT inline(array(
        named_struct('station_sk', start_station_sk, 'arrival', false, 'minutes', {_MINUTES}),
        named_struct('station_sk', end_station_sk, 'arrival', true, 'minutes', CAST(NULL AS DECIMAL(10,2)))))
      FROM parquet.`{fact}`),
    activity AS (
      SELECT station_sk, count_if(NOT arrival) AS departures, count_if(arrival) AS arrivals, sum(minutes) AS departure_minutes
      FROM ends WHERE station_sk IS NOT NULL GROUP BY station_sk),
    flows AS (
      SELECT station_sk, station_name, station_lat, station_lng, availability, coalesce(departures, 0) AS total_departures,
        coalesce(arrivals, 0) AS total_arrivals,
        CAST(round(CAST(departure_minutes AS DECIMAL(20,2)) / nullif(CAST(departures AS DECIMAL(18,0)), 0), 2) AS DECIMAL(18,2))
          AS avg_departure_duration_min
      FROM parquet.`{stations}` LEFT JOIN activity USING (station_sk))
    SELECT station_sk, station_name, station_lat, station_lng, availability, total_departures, total_arrivals,
      total_departures + total_arrivals AS total_activity, total_departures - total_arrivals AS net_flow,
      CASE WHEN total_departures > total_arrivals THEN 'NET EXPORTER' WHEN total_departures < total_arrivals THEN 'NET IMPORTER'
        ELSE 'BALANCED' END AS flow_type,
      avg_departure_duration_min,
      dense_rank() OVER (ORDER BY total_departures DESC) AS departure_rank,
      dense_rank() OVER (ORDER BY total_arrivals DESC) AS arrival_rank,
      dense_rank() OVER (ORDER BY total_departures + total_arrivals DESC) AS activity_rank
    FROM flows ORDER BY total_activity DESC"""


def top_routes(fact: str, stations: str, region: Region) -> str:
    lat, lng = region.route_start_columns
    pair = "start_station_sk, end_station_sk"
    return f"""
    WITH counted AS (
      SELECT {pair}, {_MINUTES}, count(*) AS n FROM parquet.`{fact}`
      WHERE start_station_sk IS NOT NULL AND end_station_sk IS NOT NULL GROUP BY ALL),
    routes AS (SELECT {pair}, {_stats('total_trips')} FROM counted GROUP BY {pair}),
    totals AS (SELECT DISTINCT total_trips FROM (SELECT sum(n) AS total_trips FROM counted GROUP BY {pair})),
    ranks AS (SELECT total_trips, dense_rank() OVER (ORDER BY total_trips DESC) AS route_rank FROM totals)
    SELECT s.station_name AS start_station, e.station_name AS end_station, s.station_lat AS {lat}, s.station_lng AS {lng},
      e.station_lat AS end_lat, e.station_lng AS end_lng, total_trips, avg_duration_min, median_duration_min,
      start_station_sk = end_station_sk AS is_round_trip, route_rank
    FROM routes JOIN ranks USING (total_trips) JOIN parquet.`{stations}` s ON s.station_sk = start_station_sk
      JOIN parquet.`{stations}` e ON e.station_sk = end_station_sk
    ORDER BY total_trips DESC"""


def _latest(log: str) -> str:
    return f"SELECT inline(array(last)) FROM (SELECT max_by(struct(*), log_id) AS last FROM parquet.`{log}` GROUP BY output_file)"


def latest_ingest_status(log: str) -> str:
    return _latest(log)


def pending_files(manifest: str, log: str | None) -> str:
    """Without a log nothing has been tried yet."""
    none = ("SELECT CAST(NULL AS STRING) AS output_file, CAST(NULL AS STRING) AS status, CAST(NULL AS INT) AS attempt,"
            " CAST(NULL AS STRING) AS error_message, CAST(NULL AS TIMESTAMP_NTZ) AS ended_at_utc")
    return f"""
    SELECT m.output_file, m.region, m.sf_schema, m.sf_table, m.gzip_size_bytes, l.status AS last_status,
      l.attempt AS last_attempt, l.error_message AS last_error, l.ended_at_utc AS last_attempt_at
    FROM parquet.`{manifest}` m LEFT JOIN ({_latest(log) if log else none}) l ON m.output_file = l.output_file
    WHERE coalesce(l.status, 'PENDING') <> 'SUCCESS'
    ORDER BY m.region NULLS LAST, m.sf_table NULLS LAST, m.output_file NULLS LAST"""


def table_row_counts(log: str, staging: Mapping[tuple[str, str], str], label: str) -> str:
    """Rows the log claims against committed rows of the staging tables; ``label`` gives a part's lineage name in SQL."""
    done = f"""
    done AS (
      SELECT sf_schema, sf_table, {label} AS _source_file,
        timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', max(started_at_utc)) AS _load
      FROM parquet.`{log}` WHERE status = 'SUCCESS' GROUP BY sf_schema, sf_table, output_file)"""
    counts = " UNION ALL ".join(
        f"""SELECT '{schema}' AS sf_schema, '{table}' AS sf_table, count(*) AS actual_row_count FROM parquet.`{path}` t
        LEFT SEMI JOIN (SELECT * FROM done WHERE sf_schema = '{schema}' AND sf_table = '{table}') d
          ON t._load = d._load AND t._source_file = d._source_file WHERE NOT t._rejected"""
        for (schema, table), path in staging.items())
    return f"""
    WITH {done},
    actual AS ({counts}),
    claimed AS (
      SELECT sf_schema, sf_table, sum(rows_loaded) AS log_rows_loaded, count(*) AS files_loaded
      FROM parquet.`{log}` WHERE status = 'SUCCESS' GROUP BY sf_schema, sf_table)
    SELECT sf_schema, sf_table, log_rows_loaded, files_loaded, actual_row_count, log_rows_loaded - actual_row_count AS discrepancy
    FROM claimed JOIN actual USING (sf_schema, sf_table) ORDER BY sf_schema, sf_table"""
