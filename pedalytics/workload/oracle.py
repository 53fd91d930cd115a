"""The named queries in DuckDB SQL, written on their own as a check on the Spark results.

Row values that a double cannot hold exactly (means, growth) are worked out in whole numbers, so that
both sides round the same exact figure.
"""

from __future__ import annotations

NYC = ("nyc", "lat BETWEEN 40.0 AND 42.0 AND lng BETWEEN -75.0 AND -72.0")
JC = ("jersey_city", "lat BETWEEN 40.0 AND 41.0 AND lng BETWEEN -74.5 AND -73.9")


def _name(no: str, row: str) -> str:
    return f"""CASE WHEN ({row}) % 97 = 0 THEN '' WHEN ({row}) % 89 = 0 THEN NULL
        WHEN ({row}) % 3 = 0 THEN '  ' || upper('Pier ' || ({no}) || ' St') || ' '
        ELSE 'Pier ' || ({no}) || ' St' END"""


def _lat(no: str, row: str) -> str:
    return f"(4e1 + (({no}) % 250)::DOUBLE / 1e2 + ((({row}) % 7) - 3)::DOUBLE / 1e4)"


def _lng(no: str, row: str) -> str:
    return f"(-752e-1 + (({no}) % 170)::DOUBLE / 5e1 + ((({row}) % 11) - 5)::DOUBLE / 1e4)"


def _trips(region: str = "nyc") -> str:
    """CTEs modern, v1, v2 and their union, trips."""
    s1, e1 = "l_suppkey", "l_partkey % 300"
    s2, e2 = "o_custkey % 300", "o_orderkey % 400"
    sm, em = "user_id % 240", "event_id % 240"
    return f"""
modern AS (
  SELECT event_id::VARCHAR AS ride_id, ' ' || upper(event_type) AS rideable_type, NULL::BIGINT AS bikeid,
    ts AS started_at, ts + to_microseconds(round(round(value * 37, 2) * 1e6)::BIGINT) AS ended_at,
    {_name(sm, 'event_id')} AS start_station_name, ({sm})::VARCHAR AS start_station_id,
    {_name(em, 'event_id + 1')} AS end_station_name, ({em})::VARCHAR AS end_station_id,
    {_lat(sm, 'event_id')} AS start_lat, {_lng(sm, 'event_id')} AS start_lng,
    {_lat(em, 'event_id + 1')} AS end_lat, {_lng(em, 'event_id + 1')} AS end_lng,
    CASE user_id % 3 WHEN 0 THEN 'member' WHEN 1 THEN ' Casual ' END AS member_casual,
    NULL::BIGINT AS birth_year, NULL::BIGINT AS gender
  FROM events),
v1 AS (
  SELECT *, CAST(floor(l_extendedprice) AS BIGINT) AS secs,
    l_shipdate + INTERVAL 17 YEAR + to_seconds((l_orderkey * 61 + l_partkey) % 86400) AS began
  FROM lineitem),
v2 AS (
  SELECT *, CAST(floor(o_totalprice) AS BIGINT) % 100000 AS secs,
    o_orderdate + INTERVAL 17 YEAR + to_seconds((o_custkey * 53 + o_orderkey) % 86400) AS began
  FROM orders),
trips AS MATERIALIZED (
  SELECT ride_id, rideable_type, bikeid, started_at, ended_at,
    date_diff('second', started_at, ended_at) AS trip_duration,
    start_station_name, start_station_id, end_station_name, end_station_id,
    start_lat, start_lng, end_lat, end_lng, member_casual, birth_year, gender,
    '{region}_dc497b4333c4_part-events.csv.gz' AS _source_file
  FROM modern
  UNION ALL
  SELECT NULL, NULL, l_partkey, began, began + to_seconds(secs), secs,
    {_name(s1, 'l_orderkey')}, ({s1})::VARCHAR, {_name(e1, 'l_orderkey + l_linenumber')}, ({e1})::VARCHAR,
    {_lat(s1, 'l_orderkey')}, {_lng(s1, 'l_orderkey')}, {_lat(e1, 'l_partkey')}, {_lng(e1, 'l_partkey')},
    CASE WHEN l_returnflag = 'A' THEN 'member' WHEN l_returnflag = 'R' THEN 'casual'
      WHEN l_linenumber < 7 THEN 'dependent' END,
    CASE WHEN l_linenumber <> 6 THEN 1880 + l_orderkey % 140 END, l_linenumber % 3,
    '{region}_473144999085_part-lineitem.csv.gz'
  FROM v1
  UNION ALL
  SELECT NULL, NULL, o_custkey, began, began + to_seconds(secs), secs,
    {_name(s2, 'o_orderkey')}, ({s2})::VARCHAR, {_name(e2, 'o_orderkey + 1')}, ({e2})::VARCHAR,
    {_lat(s2, 'o_orderkey')}, {_lng(s2, 'o_orderkey')},
    {_lat(e2, 'o_orderkey + 1')}, {_lng(e2, 'o_orderkey + 1')},
    CASE o_orderstatus WHEN 'F' THEN 'member' WHEN 'O' THEN 'casual' END,
    1900 + o_custkey % 125, o_orderkey % 3,
    '{region}_e24ee8457e0e_part-orders.csv.gz'
  FROM v2)"""


_LABEL = """CASE regexp_extract(_source_file, '_([0-9a-f]{12})_part', 1)
    WHEN 'dc497b4333c4' THEN 'MODERN' WHEN '473144999085' THEN 'LEGACY_V1' ELSE 'LEGACY_V2' END"""
_SPLIT_LABEL = """CASE split_part(_source_file, '_', 2)
    WHEN 'dc497b4333c4' THEN 'MODERN' WHEN '473144999085' THEN 'LEGACY_V1' ELSE 'LEGACY_V2' END"""


def _dim(region: tuple[str, str], label: str = _LABEL) -> str:
    """CTEs from the raw tables down to dim, the station dimension."""
    name, box = region
    return f"""{_trips(name)},
sighted AS (
  SELECT trim(upper(start_station_name)) AS station_name, start_station_id AS station_id,
    start_lat AS lat, start_lng AS lng, {label} AS source_schema FROM trips
  UNION ALL
  SELECT trim(upper(end_station_name)), end_station_id, end_lat, end_lng, {label} FROM trips),
seen AS MATERIALIZED (SELECT * FROM sighted WHERE station_name IS NOT NULL AND {box}),
legacy_ids AS (
  SELECT station_name, max(station_id) AS legacy_station_id FROM seen
  WHERE source_schema <> 'MODERN' GROUP BY station_name),
modern_ids AS (
  SELECT station_name, max(station_id) AS modern_station_id FROM seen
  WHERE source_schema = 'MODERN' GROUP BY station_name),
coords AS (
  SELECT station_name, median(lat) AS lat, median(lng) AS lng, max(lat) - min(lat) AS dlat,
    max(lng) - min(lng) AS dlng, count(*) AS n FROM seen GROUP BY station_name),
eras AS (
  SELECT station_name, bool_or(source_schema <> 'MODERN') AS in_legacy,
    bool_or(source_schema = 'MODERN') AS in_modern FROM seen GROUP BY station_name),
dim AS MATERIALIZED (
  SELECT station_name, legacy_station_id, modern_station_id, round(lat, 8) AS station_lat,
    round(lng, 8) AS station_lng, in_legacy, in_modern,
    CASE WHEN in_legacy AND in_modern THEN 'BOTH' WHEN in_legacy THEN 'LEGACY_ONLY'
      ELSE 'MODERN_ONLY' END AS availability,
    n AS trip_observations, round(dlat, 6) AS lat_variance, round(dlng, 6) AS lng_variance
  FROM coords JOIN eras USING (station_name)
    LEFT JOIN legacy_ids USING (station_name) LEFT JOIN modern_ids USING (station_name))"""


_QUALIFIES = """trip_duration BETWEEN 60 AND 86400
    AND CAST(started_at AS DATE) BETWEEN DATE '2013-01-01' AND DATE '2030-12-31'"""
_CENTS = "CAST(round(trip_duration * 100 / 60.0) AS BIGINT)"


def _key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS BIGINT)"


_AGE = "CASE WHEN birth_year BETWEEN 1900 AND 2010 THEN year(started_at) - birth_year END"
_BAND = """CASE WHEN birth_year IS NULL THEN NULL
    WHEN year(started_at) - birth_year < 18 THEN '<18' WHEN year(started_at) - birth_year < 25 THEN '18-24'
    WHEN year(started_at) - birth_year < 35 THEN '25-34' WHEN year(started_at) - birth_year < 45 THEN '35-44'
    WHEN year(started_at) - birth_year < 55 THEN '45-54' WHEN year(started_at) - birth_year < 65 THEN '55-64'
    ELSE '65+' END"""
_RIDER = "coalesce(lower(trim(member_casual)), 'unknown')"


def _rides(region: tuple[str, str] = NYC) -> str:
    """CTEs down to rides, the fact with station names in place of station keys."""
    return f"""{_dim(region)},
rides AS (
  SELECT t.*, s.station_name AS s_name, s.station_lat AS s_lat, s.station_lng AS s_lng,
    e.station_name AS e_name, e.station_lat AS e_lat, e.station_lng AS e_lng, {_CENTS} AS cents
  FROM trips t
    LEFT JOIN dim s ON s.station_name = trim(upper(t.start_station_name))
    LEFT JOIN dim e ON e.station_name = trim(upper(t.end_station_name))
  WHERE {_QUALIFIES})"""


_FACT = f"""ride_id, s_name IS NOT NULL AS has_start_station, e_name IS NOT NULL AS has_end_station,
  {_key('started_at')} AS start_date_sk, {_key('ended_at')} AS end_date_sk, started_at, ended_at,
  trip_duration AS trip_duration_sec, cents / 1e2 AS trip_duration_min, hour(started_at) AS start_hour,
  lower(trim(rideable_type)) AS rideable_type, bikeid, {_RIDER} AS member_casual, birth_year, gender,
  {_AGE} AS age_at_ride, {_BAND} AS age_bucket, {_LABEL} AS source_schema, _source_file"""

_PLAIN_RIDES = f"""{_trips()},
rides AS (SELECT *, {_CENTS} AS cents, {_RIDER} AS rider FROM trips WHERE {_QUALIFIES})"""

# Weekday holidays by their window of days in the month; the others by day with the weekend rule.
_CALENDAR = """
spine AS (
  SELECT CAST(g AS DATE) AS d FROM generate_series(DATE '2013-01-01', DATE '2030-12-31', INTERVAL 1 DAY) t(g)),
weekday_rule AS (
  SELECT d, CASE
    WHEN month(d) = 1 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 'MLK Day'
    WHEN month(d) = 2 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 'Presidents Day'
    WHEN month(d) = 5 AND isodow(d) = 1 AND day(d) >= 25 THEN 'Memorial Day'
    WHEN month(d) = 9 AND isodow(d) = 1 AND day(d) <= 7 THEN 'Labor Day'
    WHEN month(d) = 10 AND isodow(d) = 1 AND day(d) BETWEEN 8 AND 14 THEN 'Columbus Day'
    WHEN month(d) = 11 AND isodow(d) = 4 AND day(d) BETWEEN 22 AND 28 THEN 'Thanksgiving' END AS holiday
  FROM spine),
fixed_days AS (
  SELECT d, CASE
    WHEN month(d) = 1 AND day(d) = 1 THEN 'New Years Day'
    WHEN month(d) = 6 AND day(d) = 19 AND year(d) >= 2021 THEN 'Juneteenth'
    WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence Day'
    WHEN month(d) = 11 AND day(d) = 11 THEN 'Veterans Day'
    WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas Day' END AS holiday
  FROM spine),
holidays AS (
  SELECT d AS on_day, holiday FROM weekday_rule WHERE holiday IS NOT NULL
  UNION ALL
  SELECT CASE
      WHEN d = DATE '2022-01-01' THEN DATE '2022-01-17'
      WHEN d IN (DATE '2015-07-04', DATE '2021-06-19', DATE '2022-06-19', DATE '2028-01-01') THEN d
      WHEN isodow(d) = 6 THEN d - 1 WHEN isodow(d) = 7 THEN d + 1 ELSE d END,
    CASE WHEN isodow(d) < 6 OR d IN (DATE '2021-06-19', DATE '2022-06-19') THEN holiday
      ELSE holiday || ' (observed)' END
  FROM fixed_days WHERE holiday IS NOT NULL)"""
_ONE_HOLIDAY = "(SELECT on_day, min_by(holiday, holiday LIKE '%(observed)') AS holiday FROM holidays GROUP BY on_day)"


def _dates(fanout: bool) -> str:
    listed = "holidays" if fanout else _ONE_HOLIDAY
    return f"{_CALENDAR},\ndates AS (SELECT d, holiday FROM spine LEFT JOIN {listed} h ON h.on_day = d)"


_PER_DAY = "per_day AS (SELECT CAST(started_at AS DATE) AS d, count(*) AS n FROM trips GROUP BY 1)"


def _mean(total: str, n: str) -> str:
    """Exact mean of whole cents, half up, in units."""
    return f"((2 * ({total}) + ({n})) // (2 * ({n}))) / 1e2"


def _growth(now: str, before: str) -> str:
    num = f"({now} - {before})"
    return (
        f"CASE WHEN {before} IS NULL OR {before} = 0 THEN NULL ELSE "
        f"sign({num}) * ((2 * abs({num}) * 10000 + {before}) // (2 * {before})) / 1e2 END"
    )


_MEDIAN = "CAST(round(median(CAST(cents / 1e2 AS DECIMAL(18, 4))), 2) AS DOUBLE)"


def _monthly(fanout: bool = False) -> str:
    return f"""{_PLAIN_RIDES}, {_dates(fanout)},
monthly AS (
  SELECT year(d) AS year_num, month(d) AS month_num, strftime(d, '%b') AS month_short,
    strftime(d, '%Y-%m') AS year_month, rider AS member_casual, count(*) AS total_rides,
    {_mean('sum(cents)', 'count(*)')} AS avg_duration_min, {_MEDIAN} AS median_duration_min
  FROM rides JOIN dates ON dates.d = CAST(started_at AS DATE) GROUP BY ALL)"""


_GROWTH = f"""
lagged AS (
  SELECT *, lag(total_rides) OVER w AS prev_month_rides, lag(total_rides, 12) OVER w AS same_month_prev_year
  FROM monthly WINDOW w AS (PARTITION BY member_casual ORDER BY year_month))
SELECT *, {_growth('total_rides', 'prev_month_rides')} AS mom_growth_pct,
  {_growth('total_rides', 'same_month_prev_year')} AS yoy_growth_pct
FROM lagged"""


def _flows(region: tuple[str, str]) -> str:
    return f"""{_rides(region)},
dep AS (
  SELECT s_name AS station_name, count(*) AS departures, sum(cents) AS dep_cents
  FROM rides WHERE s_name IS NOT NULL GROUP BY 1),
arr AS (SELECT e_name AS station_name, count(*) AS arrivals FROM rides WHERE e_name IS NOT NULL GROUP BY 1),
flows AS (
  SELECT station_name, station_lat, station_lng, availability,
    coalesce(departures, 0) AS total_departures, coalesce(arrivals, 0) AS total_arrivals,
    coalesce(departures, 0) + coalesce(arrivals, 0) AS total_activity,
    coalesce(departures, 0) - coalesce(arrivals, 0) AS net_flow,
    CASE WHEN departures IS NULL THEN NULL ELSE {_mean('dep_cents', 'departures')} END
      AS avg_departure_duration_min
  FROM dim LEFT JOIN dep USING (station_name) LEFT JOIN arr USING (station_name)),
top_stations AS (
  SELECT *, CASE WHEN net_flow > 0 THEN 'NET EXPORTER' WHEN net_flow < 0 THEN 'NET IMPORTER'
      ELSE 'BALANCED' END AS flow_type,
    dense_rank() OVER (ORDER BY total_departures DESC) AS departure_rank,
    dense_rank() OVER (ORDER BY total_arrivals DESC) AS arrival_rank,
    dense_rank() OVER (ORDER BY total_activity DESC) AS activity_rank
  FROM flows)"""


def _routes(region: tuple[str, str], start: str = "start") -> str:
    return f"""{_rides(region)},
routes AS (
  SELECT s_name AS start_station, e_name AS end_station, s_lat AS {start}_lat, s_lng AS {start}_lng,
    e_lat AS end_lat, e_lng AS end_lng, count(*) AS total_trips,
    {_mean('sum(cents)', 'count(*)')} AS avg_duration_min, {_MEDIAN} AS median_duration_min,
    s_name = e_name AS is_round_trip
  FROM rides WHERE s_name IS NOT NULL AND e_name IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY total_trips DESC) AS route_rank FROM routes)"""


_UNIFIED = "SELECT * FROM trips"

# ---- load audit ----------------------------------------------------------------------------------

_PARTS = """
tagged AS (
  SELECT *, left(o_orderpriority, 1) AS p,
    CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'jersey_city'
      WHEN left(o_orderpriority, 1) = '5' THEN 'uptown' ELSE 'nyc' END AS region,
    CASE WHEN left(o_orderpriority, 1) = '4' THEN 'ffffffffffff' WHEN o_orderstatus = 'F' THEN 'dc497b4333c4'
      WHEN o_orderstatus = 'O' THEN '473144999085' ELSE 'e24ee8457e0e' END AS schema_key,
    CAST(round(o_totalprice * 100) AS BIGINT) AS size
  FROM orders),
parts AS (
  SELECT *, region || '/' || schema_key || '/' || region || '_' || schema_key || '_part'
    || strftime(o_orderdate, '%Y%m') || p || o_orderstatus || '.csv.gz' AS output_file
  FROM tagged),
part_manifest AS (
  SELECT output_file, region, schema_key, CAST(sum(size) AS BIGINT) AS gzip_size_bytes,
    count(*) % 4 AS source_file_count FROM parts GROUP BY ALL),
routes AS (
  SELECT *, CASE region WHEN 'nyc' THEN 'STAGING_NYC' WHEN 'jersey_city' THEN 'STAGING_JC' END AS sf_schema,
    CASE schema_key WHEN 'dc497b4333c4' THEN 'TRIPS_MODERN' WHEN '473144999085' THEN 'TRIPS_LEGACY_V1'
      WHEN 'e24ee8457e0e' THEN 'TRIPS_LEGACY_V2' END AS sf_table
  FROM part_manifest),
manifest AS (SELECT * FROM routes WHERE sf_schema IS NOT NULL AND sf_table IS NOT NULL),
log AS (
  SELECT o_orderkey AS log_id, output_file, region, schema_key,
    CASE region WHEN 'jersey_city' THEN 'STAGING_JC' ELSE 'STAGING_NYC' END AS sf_schema,
    CASE schema_key WHEN 'dc497b4333c4' THEN 'TRIPS_MODERN' WHEN '473144999085' THEN 'TRIPS_LEGACY_V1'
      WHEN 'e24ee8457e0e' THEN 'TRIPS_LEGACY_V2' END AS sf_table,
    size / 1024e0 AS gzip_size_mb, 1 + o_orderkey % 5 AS attempt,
    o_orderdate + to_seconds(o_orderkey) AS ended_at_utc, status, o_custkey AS rows_loaded,
    CASE WHEN o_custkey % 6 <> 5 THEN o_orderkey % 4 END AS errors_seen,
    status || '|' || o_orderstatus AS copy_status_raw,
    CASE WHEN status = 'FAILED' THEN 'error ' || o_custkey END AS error_message,
    o_custkey % 3 = 0 AS stage_verified
  FROM (SELECT *, CASE WHEN o_custkey % 4 = 0 THEN 'FAILED' WHEN o_custkey % 9 = 1 THEN 'DRY_RUN'
      ELSE 'SUCCESS' END AS status FROM parts)
  WHERE NOT (p = '3' AND month(o_orderdate) % 4 = 0)),
latest AS (SELECT log.* FROM log JOIN (SELECT max(log_id) AS m FROM log GROUP BY output_file) ON log_id = m)"""

_INVENTORY = """
raw AS (
  SELECT p_partkey, p_size, p_type, p_name, CAST(round(p_retailprice * 100) AS BIGINT) AS size_bytes,
    CASE WHEN p_size % 4 = 0 THEN 'jc-' ELSE '' END || p_brand AS bundle_name,
    p_size % 3 = 0 OR p_brand LIKE '%1' AS is_zip
  FROM part),
files AS (
  SELECT *, bundle_name || '/' || replace(p_name, ' ', '/') || '/'
      || CASE WHEN p_size % 5 = 0 THEN 'JC-' ELSE '' END || p_partkey
      || CASE WHEN is_zip THEN '.zip' ELSE '.CSV' END AS relative_path,
    CASE WHEN p_size % 5 = 0 OR p_size % 4 = 0 THEN 'jersey_city' ELSE 'nyc' END AS region,
    CASE WHEN NOT is_zip THEN 'Trip Id|' || upper(p_name) || '|' || p_type || '|station' END AS columns
  FROM raw),
inventory AS (
  SELECT *, CASE WHEN is_zip THEN 'zip' ELSE 'csv' END AS file_type,
    CASE WHEN NOT is_zip THEN 4 END AS column_count, left(md5(lower(columns)), 12) AS schema_key
  FROM files)"""

_SIGNATURES = f"""{_INVENTORY},
placed AS (
  SELECT columns, relative_path, row_number() OVER (PARTITION BY columns ORDER BY relative_path) AS nth,
    count(*) OVER (PARTITION BY columns) AS file_count FROM inventory WHERE columns IS NOT NULL),
headers AS (
  SELECT columns, file_count, string_agg(relative_path, ' ; ' ORDER BY relative_path) AS sample_paths
  FROM placed WHERE nth <= 5 GROUP BY ALL),
signatures AS (
  SELECT 'schema_' || row_number() OVER (ORDER BY file_count DESC, columns) AS schema_signature, file_count,
    4 AS column_count, columns, sample_paths FROM headers)"""

_ARCHIVES = """
archives AS (
  SELECT o_orderkey || '-trips.zip' AS file_name, CAST(round(o_totalprice * 100) AS BIGINT) AS expected,
    o_custkey AS c, o_orderstatus FROM orders),
local AS (
  SELECT file_name, expected + CASE WHEN c % 5 = 0 THEN 1000 WHEN c % 7 = 0 THEN 5000 ELSE 0 END AS size
  FROM archives WHERE c % 11 <> 0),
entries AS (
  SELECT file_name, CASE o_orderstatus WHEN 'P' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN c % 17 = 0 THEN NULL WHEN c % 19 = 0 THEN expected + 3 ELSE expected END AS logged
  FROM archives WHERE c % 13 <> 0)"""


def _decisions(verified: str, attempts: str) -> str:
    return f"""WITH {_PARTS}
SELECT m.output_file, l.status AS last_status, l.attempt AS last_attempt,
  CASE WHEN l.status IS NULL OR l.status = 'DRY_RUN' THEN 'RUN' WHEN l.status = 'SUCCESS' AND {verified} THEN 'DONE'
    WHEN {attempts} THEN 'RUN' ELSE 'GIVEN_UP' END AS decision,
  coalesce(l.attempt, 0) + 1 AS attempt
FROM part_manifest m LEFT JOIN latest l USING (output_file)"""


_PENDING = """SELECT m.output_file, m.region, m.sf_schema, m.sf_table, m.gzip_size_bytes,
  l.status AS last_status, l.attempt AS last_attempt, l.error_message AS last_error,
  l.ended_at_utc AS last_attempt_at
FROM manifest m LEFT JOIN latest l USING (output_file) WHERE coalesce(l.status, 'PENDING') <> 'SUCCESS'"""

_COUNTED = """counted AS (
          SELECT CASE WHEN l_partkey % 3 = 0 THEN 'STAGING_JC' ELSE 'STAGING_NYC' END AS sf_schema,
            'TRIPS_LEGACY_V2' AS sf_table, count(*) AS n FROM lineitem GROUP BY 1
          UNION ALL
          SELECT CASE WHEN event_id % 3 = 0 THEN 'STAGING_JC' ELSE 'STAGING_NYC' END, 'TRIPS_MODERN', count(*)
          FROM events GROUP BY 1)"""

_DIM_COLUMNS = "SELECT * FROM dim"
_STATION_COLUMNS = """SELECT station_name, station_lat, station_lng, availability, total_departures,
  total_arrivals, total_activity, net_flow, flow_type, avg_departure_duration_min, departure_rank,
  arrival_rank, activity_rank FROM top_stations"""

ORACLE: dict[str, str] = {
    "union_layouts": f"WITH {_trips()} {_UNIFIED}",
    "modern_duration": f"""WITH {_trips()} SELECT ride_id, started_at, ended_at,
        date_diff('second', started_at, ended_at) AS trip_duration FROM modern""",
    "anti_join_incremental": f"WITH {_trips()} {_UNIFIED} WHERE year(started_at) >= 2014",
    "trips_by_natural_key": f"""WITH {_trips()}, keyed AS (
        SELECT ride_id, CASE WHEN ride_id IS NULL THEN bikeid END AS bikeid,
          CASE WHEN ride_id IS NULL THEN started_at END AS started_at, _source_file FROM trips)
        SELECT ride_id, bikeid, started_at, count(*) AS trips, count(DISTINCT _source_file) AS source_files
        FROM keyed GROUP BY ride_id, bikeid, started_at HAVING count(*) > 1""",
    "rider_types": f"""WITH {_trips()} SELECT {_RIDER} AS member_casual,
        lower(trim(rideable_type)) AS rideable_type, count(*) AS trips FROM trips GROUP BY 1, 2""",
    "dim_dates": f"""WITH {_trips()}, {_dates(False)}, {_PER_DAY}
        SELECT {_key('d')} AS date_sk, strftime(d, '%Y-%m-%d') AS full_date, isodow(d) AS day_of_week_num,
          strftime(d, '%A') AS day_of_week_name, strftime(d, '%a') AS day_of_week_short,
          isodow(d) > 5 AS is_weekend, day(d) AS day_of_month, dayofyear(d) AS day_of_year,
          weekofyear(d) AS week_of_year, month(d) AS month_num, strftime(d, '%B') AS month_name,
          strftime(d, '%b') AS month_short, quarter(d) AS quarter_num, year(d) AS year_num,
          strftime(d, '%Y-%m') AS year_month,
          CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) < 6 THEN 'Spring'
            WHEN month(d) < 9 THEN 'Summer' ELSE 'Autumn' END AS season,
          holiday IS NOT NULL AS is_holiday, holiday AS holiday_name,
          strftime(date_trunc('month', d), '%Y-%m-%d') AS first_day_of_month,
          strftime(last_day(d), '%Y-%m-%d') AS last_day_of_month,
          year(d) || '-01-01' AS first_day_of_year, year(d) || '-12-31' AS last_day_of_year,
          coalesce(n, 0) AS trips
        FROM dates LEFT JOIN per_day USING (d)""",
    "dim_dates_holiday_fanout": f"""WITH {_trips()}, {_dates(True)}, {_PER_DAY}
        SELECT {_key('d')} AS date_sk, strftime(d, '%Y-%m-%d') AS full_date,
          strftime(d, '%a') AS day_of_week_name, strftime(d, '%b') AS month_name,
          holiday AS holiday_name, coalesce(n, 0) AS trips
        FROM dates LEFT JOIN per_day USING (d) WHERE holiday IS NOT NULL""",
    "rides_by_season": f"""WITH {_PLAIN_RIDES}, {_dates(False)}
        SELECT CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) < 6 THEN 'Spring'
            WHEN month(d) < 9 THEN 'Summer' ELSE 'Autumn' END AS season,
          isodow(d) > 5 AS is_weekend, holiday IS NOT NULL AS is_holiday, count(*) AS rides
        FROM rides JOIN dates ON d = CAST(started_at AS DATE) GROUP BY 1, 2, 3""",
    "dim_station": f"WITH {_dim(NYC)} {_DIM_COLUMNS}",
    "dim_station_jc_box": f"WITH {_dim(JC)} {_DIM_COLUMNS}",
    "dim_station_by_split_key": f"WITH {_dim(JC, _SPLIT_LABEL)} {_DIM_COLUMNS}",
    "dim_station_header_keys": f"WITH {_dim(NYC)} {_DIM_COLUMNS}",
    "station_observations": f"WITH {_dim(NYC)} SELECT * FROM seen",
    "availability_counts": f"""WITH {_dim(NYC)}
        SELECT availability, count(*) AS stations FROM dim GROUP BY 1""",
    "fact_ride": f"WITH {_rides()} SELECT {_FACT} FROM rides",
    "fact_incremental": f"WITH {_rides()} SELECT {_FACT} FROM rides WHERE year(started_at) >= 2015",
    "fact_ride_jc": f"WITH {_rides(JC)} SELECT {_FACT} FROM rides",
    "age_bucket": f"""WITH {_trips()} SELECT {_AGE} AS age_at_ride, {_BAND} AS age_bucket,
        count(*) AS trips FROM trips GROUP BY 1, 2""",
    "source_schema_label": f"""WITH {_trips()}, names AS (
          SELECT _source_file FROM trips UNION ALL
          SELECT replace(_source_file, 'nyc_', 'jersey_city_') FROM trips)
        SELECT _source_file, {_LABEL} AS by_pattern, {_SPLIT_LABEL} AS by_split, count(*) AS trips
        FROM names GROUP BY 1, 2, 3""",
    "role_playing_join": f"""WITH {_dim(NYC)}
        SELECT s.availability AS start_known, e.availability AS end_known, count(*) AS trips
        FROM trips LEFT JOIN dim s ON s.station_name = trim(upper(start_station_name))
          LEFT JOIN dim e ON e.station_name = trim(upper(end_station_name)) GROUP BY 1, 2""",
    "ridership_over_time": f"WITH {_monthly()}, {_GROWTH}",
    "ridership_holiday_fanout": f"WITH {_monthly(True)}, {_GROWTH}",
    "top_stations": f"WITH {_flows(NYC)} {_STATION_COLUMNS}",
    "top_stations_jc": f"WITH {_flows(JC)} {_STATION_COLUMNS}",
    "top_stations_limit20": f"""WITH {_flows(NYC)}
        SELECT station_name, total_departures, total_arrivals, net_flow, flow_type FROM top_stations
        ORDER BY activity_rank, station_name LIMIT 20""",
    "top_routes": f"WITH {_routes(NYC)} SELECT * FROM ranked",
    "top_routes_jc": f"WITH {_routes(JC, 'station')} SELECT * FROM ranked",
    "top_routes_rank10": f"""WITH {_routes(NYC)} SELECT start_station, end_station, total_trips,
        is_round_trip, route_rank FROM ranked WHERE route_rank <= 10""",
    "station_activity": f"""WITH {_flows(NYC)} SELECT station_name, coalesce(departures, 0) AS departures,
        coalesce(arrivals, 0) AS arrivals, dep_cents / 1e2 AS departure_minutes
        FROM dep FULL JOIN arr USING (station_name)""",
    "monthly_median": f"""WITH {_monthly()} SELECT year_month, member_casual, median_duration_min,
        avg_duration_min FROM monthly""",
    "lag_growth": f"""WITH monthly AS (
        SELECT strftime(o_orderdate, '%Y-%m') AS year_month, o_orderpriority AS member_casual,
          count(*) AS total_rides FROM orders GROUP BY 1, 2), {_GROWTH}""",
    "dense_rank_counts": """SELECT l_partkey, l_suppkey, count(*) AS n,
        dense_rank() OVER (ORDER BY count(*) DESC) AS pair_rank FROM lineitem GROUP BY 1, 2""",
    "exact_median_of_doubles": """SELECT l_returnflag, round(median(l_extendedprice), 6) AS median_price
        FROM lineitem GROUP BY 1""",
    "rides_by_year": f"""WITH {_PLAIN_RIDES}
        SELECT year(started_at) AS year_num, count(*) AS rides FROM rides GROUP BY 1""",
    "missing_station": f"""WITH {_rides()} SELECT count(*) FILTER (s_name IS NULL) AS missing_start_station,
        count(*) FILTER (e_name IS NULL) AS missing_end_station FROM rides""",
    "end_date_check": f"""WITH {_PLAIN_RIDES} SELECT count(*) FILTER (ended_at IS NULL) AS no_end_date,
        count(*) FILTER (CAST(ended_at AS DATE) > DATE '2017-12-31') AS past_calendar FROM rides""",
    "latest_status": f"WITH {_PARTS} SELECT * FROM latest",
    "pending_files": f"WITH {_PARTS} {_PENDING}",
    "pending_files_jc": f"""WITH {_PARTS} SELECT output_file, last_status
        FROM ({_PENDING}) WHERE region = 'jersey_city'""",
    "work_queue": f"""WITH {_PARTS} SELECT m.output_file, m.region, m.schema_key, m.sf_schema, m.sf_table,
        m.gzip_size_bytes, coalesce(l.attempt, 0) + 1 AS attempt
        FROM manifest m LEFT JOIN latest l USING (output_file) WHERE coalesce(l.status, '') <> 'SUCCESS'""",
    "row_count_check": f"""WITH {_PARTS}, actual AS (
          SELECT 'TRIPS_MODERN' AS sf_table, count(*) AS n FROM events UNION ALL
          SELECT 'TRIPS_LEGACY_V1', count(*) FROM lineitem UNION ALL
          SELECT 'TRIPS_LEGACY_V2', count(*) FROM orders)
        SELECT sf_schema, sf_table, CAST(sum(rows_loaded) AS BIGINT) AS log_rows_loaded, count(*) AS files_loaded,
          any_value(n) AS actual_row_count, CAST(sum(rows_loaded) - any_value(n) AS BIGINT) AS discrepancy
        FROM log JOIN actual USING (sf_table) WHERE status = 'SUCCESS' GROUP BY 1, 2""",
    "failed_files": f"""WITH {_PARTS} SELECT output_file, attempt, error_message, ended_at_utc
        FROM latest WHERE status = 'FAILED'""",
    "partial_loads": f"""WITH {_PARTS} SELECT output_file, sf_table, rows_loaded, errors_seen, copy_status_raw
        FROM log WHERE status = 'SUCCESS' AND errors_seen > 0""",
    "run_overview": f"""WITH {_PARTS} SELECT status, region, sf_table, count(*) AS file_count,
        CAST(sum(rows_loaded) AS BIGINT) AS total_rows, CAST(sum(errors_seen) AS BIGINT) AS total_errors
        FROM log GROUP BY 1, 2, 3""",
    "run_summary": f"""WITH {_PARTS} SELECT status, count(*) AS files,
        CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded FROM log GROUP BY 1""",
    "copy_statuses": f"""WITH {_PARTS} SELECT output_file, CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded,
        CAST(sum(errors_seen) AS BIGINT) AS errors_seen,
        string_agg(DISTINCT status, '|' ORDER BY status) AS copy_status_raw FROM log GROUP BY 1""",
    "retry_queue": _decisions("TRUE", "l.attempt < 3"),
    "retry_queue_reset": _decisions("TRUE", "TRUE"),
    "upload_queue": _decisions("l.stage_verified", "l.attempt < 3"),
    "route_manifest": f"""WITH {_PARTS} SELECT output_file, region, schema_key, sf_schema, sf_table,
        gzip_size_bytes, source_file_count FROM manifest""",
    "skipped_manifest": f"""WITH {_PARTS} SELECT output_file, region, schema_key,
        CASE WHEN sf_schema IS NULL THEN 'no schema for region ' || region
          ELSE 'no table for key ' || schema_key END AS reason
        FROM routes WHERE sf_schema IS NULL OR sf_table IS NULL""",
    "new_manifest_rows": f"""WITH {_PARTS} SELECT output_file, sf_table FROM manifest m WHERE NOT EXISTS (
        SELECT 1 FROM log WHERE log.output_file = m.output_file AND status = 'SUCCESS')""",
    "manifest_summary": f"""WITH {_PARTS} SELECT region, sf_table, count(*) AS files
        FROM manifest GROUP BY 1, 2""",
    "schema_fingerprint": f"""WITH {_INVENTORY} SELECT relative_path, file_type, region, column_count,
        columns, schema_key FROM inventory""",
    "schema_signatures": f"WITH {_SIGNATURES} SELECT * FROM signatures",
    "common_schemas": f"""WITH {_SIGNATURES} SELECT schema_signature, file_count, column_count
        FROM signatures ORDER BY file_count DESC, columns LIMIT 5""",
    "bundle_structure": f"""WITH {_INVENTORY}, counted AS (
          SELECT bundle_name, count(*) FILTER (NOT is_zip) AS csv_file_count,
            count(*) FILTER (is_zip) AS nested_zip_count FROM inventory GROUP BY 1)
        SELECT *, CASE WHEN csv_file_count = 0 THEN 'nested_zip_only' WHEN nested_zip_count = 0 THEN 'csv_present'
            ELSE 'mixed_csv_and_nested_zip' END AS structure_type,
          csv_file_count = 0 AS needs_nested_extract FROM counted""",
    "file_groups": f"""WITH {_INVENTORY} SELECT region, schema_key, count(*) AS files,
        round(sum(size_bytes) / 1048576e0, 2) AS megabytes FROM inventory GROUP BY 1, 2""",
    "size_audit": f"""WITH {_ARCHIVES}, judged AS (
          SELECT a.file_name, expected AS file_size_bytes, CASE
            WHEN size IS NULL THEN 'missing_local_file'
            WHEN size <> expected THEN 'size_mismatch (local=' || size || ', expected=' || expected || ')'
            WHEN e.file_name IS NULL THEN 'no_log_entry'
            WHEN status <> 'SUCCESS' THEN 'log_status=' || status
            WHEN logged IS NULL THEN 'log_missing_size'
            WHEN logged <> expected THEN 'log_size_mismatch (logged=' || logged || ', expected=' || expected || ')'
            ELSE 'complete' END AS reason
          FROM archives a LEFT JOIN local l USING (file_name) LEFT JOIN entries e ON e.file_name = a.file_name)
        SELECT *, reason = 'complete' AS is_complete FROM judged""",
    "size_tolerance": f"""WITH {_ARCHIVES} SELECT abs(size - expected) <= 1024 AS agree, count(*) AS files
        FROM archives JOIN local USING (file_name) GROUP BY 1""",
    "missing_members": f"""WITH {_ARCHIVES} SELECT file_name FROM archives
        WHERE file_name NOT IN (SELECT file_name FROM local)""",
    "csv_ingest": f"""WITH {_trips()}, written AS (
          SELECT *, o_custkey % 50 <> 0 AS good,
            CASE WHEN o_custkey % 70 IN (3, 4) THEN NULL WHEN o_custkey % 70 = 5 THEN 'x'
              ELSE nullif({_name('o_custkey % 300', 'o_orderkey')}, '') END AS name,
            CASE o_orderstatus WHEN 'F' THEN 'subscriber' WHEN 'O' THEN 'Customer' END AS user_type
          FROM v2)
        SELECT year(began) AS start_year, user_type, count(*) FILTER (good) AS rows_loaded,
          count(*) FILTER (NOT good) AS errors_seen, count(*) FILTER (name IS NULL) AS unnamed_starts,
          CAST(sum(secs) FILTER (good) AS BIGINT) AS seconds, CAST(sum(o_custkey) FILTER (good) AS BIGINT) AS bikes
        FROM written GROUP BY 1, 2""",
    "csv_row_numbers": "SELECT count(*) AS total_rows, 0::BIGINT AS misnumbered_files FROM orders",
    "part_writer": f"""WITH {_trips()}, written AS (
          SELECT CASE WHEN l_partkey % 3 = 0 THEN 'jersey_city' ELSE 'nyc' END AS region,
            'e24ee8457e0e' AS schema_key, secs FROM v1
          UNION ALL
          SELECT CASE WHEN ride_id::BIGINT % 3 = 0 THEN 'jersey_city' ELSE 'nyc' END, 'dc497b4333c4', NULL
          FROM modern)
        SELECT region, schema_key, count(*) AS good_rows, 0::BIGINT AS bad_rows, CAST(sum(secs) AS BIGINT) AS seconds,
          0::BIGINT AS parts_without_source, 0::BIGINT AS empty_parts FROM written GROUP BY 1, 2""",
    "staged_ingest": """WITH counted AS (
          SELECT CASE WHEN l_partkey % 3 = 0 THEN 'STAGING_JC' ELSE 'STAGING_NYC' END AS sf_schema,
            'TRIPS_LEGACY_V2' AS sf_table, count(*) AS n FROM lineitem GROUP BY 1
          UNION ALL
          SELECT CASE WHEN event_id % 3 = 0 THEN 'STAGING_JC' ELSE 'STAGING_NYC' END, 'TRIPS_MODERN', count(*)
          FROM events GROUP BY 1)
        SELECT sf_schema, sf_table, n AS log_rows_loaded, 0::BIGINT AS discrepancy,
          CAST(sum(n) OVER (PARTITION BY sf_schema) AS BIGINT) AS unified, 0::BIGINT AS added_again FROM counted""",
    "incremental_stream": f"""WITH {_trips()} SELECT member_casual, count(*) AS trips, count(*) AS expected_trips,
        CAST(sum(date_diff('second', started_at, ended_at)) AS BIGINT) AS seconds FROM modern GROUP BY 1""",
    "ingest_recovery": f"""WITH {_COUNTED} SELECT sf_schema, sf_table, n AS log_rows_loaded, n AS actual_row_count,
          0::BIGINT AS discrepancy, CAST(sum(n) OVER (PARTITION BY sf_schema) AS BIGINT) AS unified,
          0::BIGINT AS rows_before_commit, 1::BIGINT AS failed_first, 1::BIGINT AS tried_again, 1::BIGINT AS failed_again,
          1::BIGINT AS left_behind, 1::BIGINT AS dropped, 0::BIGINT AS added_again FROM counted""",
    "ingest_forced": f"""WITH {_COUNTED} SELECT sf_schema, sf_table, n AS actual_row_count, 2::BIGINT AS attempts,
          0::BIGINT AS failed, 0::BIGINT AS skipped, 0::BIGINT AS added FROM counted""",
    "ingest_archive": f"""WITH {_COUNTED} SELECT CASE sf_schema WHEN 'STAGING_JC' THEN 'jersey_city' ELSE 'nyc' END AS region,
          CASE sf_table WHEN 'TRIPS_MODERN' THEN 'dc497b4333c4' ELSE 'e24ee8457e0e' END AS schema_key, n AS archived_rows,
          TRUE AS all_moved, 0::BIGINT AS moved_again, 0::BIGINT AS left_in_inbox FROM counted""",
    "stream_rejects": """SELECT count(*) FILTER (o_custkey % 50 <> 0) AS trips,
          CAST(sum(o_custkey) FILTER (o_custkey % 50 <> 0) AS BIGINT) AS bikes,
          count(*) FILTER (o_custkey % 50 = 0) AS rejected, 1::BIGINT AS kinds_of_error, 2::BIGINT AS streams,
          count(*) FILTER (o_custkey % 50 <> 0) AS logged_least, count(*) FILTER (o_custkey % 50 <> 0) AS logged_most,
          count(*) FILTER (o_custkey % 50 = 0) AS logged_errors, 0::BIGINT AS logged_twice FROM orders""",
    "incremental_loads": f"""WITH {_trips()}, qualified AS (
          SELECT * FROM trips WHERE trip_duration BETWEEN 60 AND 86400
            AND started_at >= TIMESTAMP '2013-01-01' AND started_at < TIMESTAMP '2031-01-01'),
        done AS (
          SELECT {_LABEL} AS loaded, count(*) FILTER (year(started_at) < 2014) AS first,
            count(*) FILTER (year(started_at) >= 2014) AS second, 0::BIGINT AS third FROM trips GROUP BY 1
          UNION ALL SELECT 'FACT', count(*), 0, count(*) FROM qualified)
        SELECT *, TRUE AS same_calendar FROM done""",
    "read_manifest_file": f"""WITH {_PARTS} SELECT output_file, region, schema_key, gzip_size_bytes, source_file_count,
        TRUE AS undated FROM part_manifest WHERE region = 'jersey_city'""",
    "read_load_log_file": f"""WITH {_PARTS}, ordered AS (
          SELECT *, row_number() OVER (PARTITION BY output_file ORDER BY attempt DESC, ended_at_utc DESC) AS nth FROM log)
        SELECT output_file, region, attempt, status, strftime(ended_at_utc, '%Y-%m-%d %H:%M:%S') AS ended_at_utc
        FROM ordered WHERE nth = 1""",
    "read_index_file": """WITH entries AS (
          SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'csv' ELSE 'zip' END AS file_format, strftime(o_orderdate, '%Y-%m') AS month,
            CAST(round(o_totalprice * 100) AS BIGINT) AS size FROM orders)
        SELECT file_format, month, count(*) AS archives, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS addressed,
          count(*) AS named FROM entries GROUP BY 1, 2""",
    "ridership_in_order": f"""WITH {_monthly()} SELECT row_number() OVER (ORDER BY year_month, member_casual NULLS FIRST) AS place,
        year_month, member_casual, total_rides FROM monthly""",
    "stations_in_order": f"""WITH {_flows(NYC)}, placed AS (
          SELECT total_activity, row_number() OVER (ORDER BY total_activity DESC) AS place FROM flows)
        SELECT total_activity, min(place) AS first_place, max(place) AS last_place FROM placed GROUP BY 1""",
    "routes_in_order": f"""WITH {_routes(NYC)}, placed AS (
          SELECT total_trips, row_number() OVER (ORDER BY total_trips DESC) AS place FROM routes)
        SELECT total_trips, min(place) AS first_place, max(place) AS last_place FROM placed GROUP BY 1""",
    "pending_in_order": f"""WITH {_PARTS} SELECT row_number() OVER (ORDER BY region, sf_table, output_file) AS place, output_file
        FROM ({_PENDING})""",
    "failed_in_order": f"""WITH {_PARTS}, placed AS (
          SELECT ended_at_utc, row_number() OVER (ORDER BY ended_at_utc DESC) AS place FROM latest WHERE status = 'FAILED')
        SELECT ended_at_utc, min(place) AS first_place, max(place) AS last_place FROM placed GROUP BY 1""",
    "rides_by_hour": f"""WITH {_PLAIN_RIDES} SELECT hour(started_at) AS start_hour, rider AS member_casual,
        count(*) AS rides FROM rides GROUP BY 1, 2""",
    "load_stamps": f"""WITH {_trips()} SELECT _source_file, count(*) AS rows, 1::BIGINT AS stamps, count(*) AS of_now
        FROM trips GROUP BY 1""",
    "repeated_inventory": f"""WITH {_INVENTORY} SELECT file_type, region, count(*) AS files,
        count(DISTINCT columns) AS schema_ids, count(DISTINCT schema_key) AS schema_keys FROM inventory GROUP BY 1, 2""",
    "fact_compaction": f"""WITH {_trips()}, qualified AS (
          SELECT *, year(started_at) * 10000 + month(started_at) * 100 + day(started_at) AS sk FROM trips
          WHERE trip_duration BETWEEN 60 AND 86400
            AND started_at >= TIMESTAMP '2013-01-01' AND started_at < TIMESTAMP '2031-01-01')
        SELECT year(started_at) AS start_year, month(started_at) AS start_month, count(*) AS rides,
          CAST(sum(trip_duration) AS BIGINT) AS seconds, min(sk) AS first_day, max(sk) AS last_day, TRUE AS was_crowded,
          TRUE AS all_compacted, 0::BIGINT AS crowded_left FROM qualified GROUP BY 1, 2""",
    "part_plan": f"""WITH {_INVENTORY}, placed AS (
          SELECT relative_path, region, left(schema_key, 1) AS schema_key, coalesce(sum(size_bytes) OVER (
            PARTITION BY region, left(schema_key, 1) ORDER BY size_bytes, relative_path
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM inventory WHERE schema_key IS NOT NULL)
        SELECT relative_path, region, schema_key, lpad(CAST(CAST(before // 120000 + 1 AS BIGINT) AS VARCHAR), 4, '0') AS part FROM placed""",
    "part_writer_capped": f"""WITH {_trips()} SELECT CASE WHEN o_custkey % 3 = 0 THEN 'jersey_city' ELSE 'nyc' END AS region,
          count(*) AS good_rows, 0::BIGINT AS bad_rows, CAST(sum(o_custkey) AS BIGINT) AS bikes,
          CAST(sum(secs) AS BIGINT) AS seconds, count(*) FILTER (o_custkey % 7 = 5) AS broken_names,
          count(DISTINCT (began, o_custkey)) AS different, 0::BIGINT AS oversized, TRUE AS several_parts FROM v2 GROUP BY 1""",
}
ORACLE["view_ridership_jc"] = ORACLE["ridership_over_time"]
ORACLE["view_top_routes"] = ORACLE["top_routes"]
ORACLE["view_top_stations"] = ORACLE["top_stations"]
