"""The registered queries in SQL for DuckDB, written over the given tables only."""

RANGE_FROM, RANGE_TO = "2024-01-05 06:30:00", "2024-01-12 18:00:00"


def _rides(key: str, more: str = "", time: str = "CAST(ts AS TIMESTAMP)") -> str:
    return f"""SELECT CAST({key} AS VARCHAR) AS key,
       value AS fare_amount,
       {time} AS pickup_datetime,
       CASE WHEN event_id % 50 = 0 THEN NULL
            ELSE CAST(-74.23 AS DOUBLE) + CAST(0.0071 AS DOUBLE) * (event_id % 53) END AS pickup_longitude,
       CAST(40.48 AS DOUBLE) + CAST(0.0037 AS DOUBLE) * (user_id % 47) AS pickup_latitude,
       CASE WHEN event_id % 61 = 0 THEN CAST(-173.5 AS DOUBLE)
            ELSE CAST(-74.21 AS DOUBLE) + CAST(0.0071 AS DOUBLE) * (user_id % 53) END AS dropoff_longitude,
       CAST(40.49 AS DOUBLE) + CAST(0.0037 AS DOUBLE) * (event_id % 47) AS dropoff_latitude,
       CAST(CASE WHEN event_id % 83 = 0 THEN 208 ELSE event_id % 6 + 1 END AS INTEGER) AS passenger_count{more}
  FROM events"""


_RIDES = f"rides AS ({_rides('event_id')})"
_USER_RIDES = f"rides AS ({_rides('user_id', ', CAST(event_id AS VARCHAR) AS ride')})"
_UNTIMED = "CASE WHEN event_id % 71 <> 0 THEN CAST(ts AS TIMESTAMP) END"
_UNTIMED_RIDES = f"rides AS ({_rides('user_id', time=_UNTIMED)})"
_TWICE = "twice AS (SELECT * FROM rides UNION ALL SELECT * FROM rides WHERE CAST(key AS BIGINT) % 20 = 0)"

_RAW_COLUMNS = """key, CAST(CAST(fare_amount AS FLOAT) AS DOUBLE) AS fare_amount, pickup_datetime,
       pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
       CAST(TRY_CAST(passenger_count AS TINYINT) AS DOUBLE) AS passenger_count,
       CAST(year(pickup_datetime) AS DOUBLE) AS year,
       CAST(month(pickup_datetime) AS DOUBLE) AS month,
       CAST(day(pickup_datetime) AS DOUBLE) AS day"""


def _coordinate(name: str) -> str:
    return f"CAST(TRY_CAST({name} AS DECIMAL(8,6)) AS DOUBLE) AS {name}"


_CURATED_COLUMNS = f"""key, CAST(CAST(fare_amount AS FLOAT) AS DOUBLE) AS fare_amount, pickup_datetime,
       {_coordinate('pickup_longitude')}, {_coordinate('pickup_latitude')},
       {_coordinate('dropoff_longitude')}, {_coordinate('dropoff_latitude')},
       CAST(TRY_CAST(passenger_count AS TINYINT) AS DOUBLE) AS passenger_count,
       CAST(year(pickup_datetime) AS DOUBLE) AS year,
       CAST(month(pickup_datetime) AS DOUBLE) AS month,
       CAST(day(pickup_datetime) AS DOUBLE) AS day"""

# Neighbourhoods in twelve known groups, the groups' mean points, and the group
# whose mean lies nearest to each ride's pickup point.
_PLACES = """places AS (
  SELECT n_name AS neighborhood,
         CAST(40.50 + 0.05 * FLOOR((n_nationkey % 12) / 4.0) + 0.001 * FLOOR(n_nationkey / 12.0)
              AS DECIMAL(8,6)) AS latitude,
         CAST(-74.20 + 0.10 * (n_nationkey % 4) + 0.0013 * FLOOR(n_nationkey / 12.0)
              AS DECIMAL(8,6)) AS longitude,
         n_nationkey % 12 AS grp
  FROM nation),
means AS (
  SELECT grp, AVG(CAST(latitude AS DOUBLE)) AS la, AVG(CAST(longitude AS DOUBLE)) AS lo FROM places GROUP BY grp),
points AS (
  SELECT DISTINCT pickup_latitude, pickup_longitude FROM rides
  WHERE pickup_latitude IS NOT NULL AND pickup_longitude IS NOT NULL),
nearest AS (
  SELECT pickup_latitude AS near_lat, pickup_longitude AS near_lon,
         ARG_MIN(grp, (pickup_latitude - la) * (pickup_latitude - la)
                    + (pickup_longitude - lo) * (pickup_longitude - lo)) AS grp
  FROM points CROSS JOIN means GROUP BY 1, 2),
grouped AS (
  SELECT rides.*, nearest.grp FROM rides JOIN nearest
    ON pickup_latitude = near_lat AND pickup_longitude = near_lon)"""

_REGION_RIDES = f"{_RIDES}, {_PLACES}"
_CURATED = f"""SELECT {_CURATED_COLUMNS}, neighborhood AS pickup_region
FROM grouped JOIN places ON grouped.grp = places.grp"""

_CENTS = "CAST(SUM(CAST(ROUND(CAST(CAST(fare_amount AS FLOAT) AS DOUBLE) * 100) AS BIGINT)) AS BIGINT)"
_FARES = f"""COUNT(*) AS rides, {_CENTS} AS fare_cents,
       CAST({_CENTS} AS DOUBLE) / COUNT(fare_amount) / 100 AS avg_fare"""

_FARE_BY_DAY_REGION = f"""WITH {_REGION_RIDES}
SELECT CAST(CAST(pickup_datetime AS DATE) AS VARCHAR) AS pickup_day, neighborhood AS pickup_region, {_FARES}
FROM grouped JOIN places ON grouped.grp = places.grp GROUP BY 1, 2"""

# Rides with the groups of all rides of their key within ten minutes.
_REATTACHED = f"""near AS (
  SELECT a.*, b.grp FROM (SELECT * FROM rides WHERE pickup_latitude IS NOT NULL AND pickup_longitude IS NOT NULL) a
  LEFT JOIN grouped b ON a.key = b.key
   AND a.pickup_datetime BETWEEN b.pickup_datetime - INTERVAL 10 MINUTES
                             AND b.pickup_datetime + INTERVAL 10 MINUTES)
SELECT DISTINCT {_CURATED_COLUMNS}, neighborhood AS pickup_region
FROM near LEFT JOIN places ON near.grp = places.grp"""

# Rides with coordinates, and whether a ride is late if every twentieth comes a part of time after its own.
_LATE = """span AS (
  SELECT MIN(epoch_us(pickup_datetime)) AS first, (MAX(epoch_us(pickup_datetime)) - MIN(epoch_us(pickup_datetime))) // 3 + 1 AS width
  FROM rides),
parted AS (
  SELECT grouped.*, (epoch_us(pickup_datetime) - first) // width AS part, CAST(key AS BIGINT) % 20 = 0 AS moved,
         date_trunc('hour', pickup_datetime) AS window_start
  FROM grouped, span),
-- How far event time is closed after each part: ten minutes before the latest ride, in whole milliseconds.
closed AS (
  SELECT part, MAX(epoch_us(pickup_datetime)) // 1000 - 600000 AS until FROM parted WHERE NOT moved GROUP BY part),
told AS (
  SELECT parted.*, CASE WHEN moved AND epoch_ms(window_start + INTERVAL 1 HOUR) <= until THEN 1 ELSE 0 END AS late
  FROM parted JOIN closed USING (part))"""

_RAW_TABLE = f"WITH {_RIDES} SELECT {_RAW_COLUMNS} FROM rides"
_CURATED_TABLE = f"WITH {_REGION_RIDES} {_CURATED}"

ORACLES: dict[str, str] = {
    "event_roundtrip": _RAW_TABLE,
    "bad_record_split": f"""WITH {_RIDES}, {_TWICE}
SELECT key, CASE WHEN CAST(key AS BIGINT) % 97 = 0 THEN 1 ELSE 0 END AS is_bad,
       CASE WHEN CAST(key AS BIGINT) % 97 <> 0 THEN CAST(CAST(fare_amount AS FLOAT) AS DOUBLE) END AS fare_amount,
       CASE WHEN CAST(key AS BIGINT) % 97 = 0 THEN '{{bad' END AS text
FROM twice""",
    "filter_coords": f"""WITH {_RIDES}
SELECT key, fare_amount, pickup_latitude, pickup_longitude FROM rides
WHERE pickup_latitude IS NOT NULL AND pickup_longitude IS NOT NULL""",
    "curate_types": f"WITH {_RIDES}, {_TWICE} SELECT DISTINCT {_CURATED_COLUMNS} FROM twice",
    "dedupe_rides": f"WITH {_RIDES}, {_TWICE} SELECT DISTINCT * FROM twice",
    "split_counts": f"""WITH {_RIDES}
SELECT CAST(CAST(key AS BIGINT) % 10 AS INTEGER) AS part, COUNT(*) AS n, MAX(fare_amount) AS max_fare
FROM rides GROUP BY 1""",
    "random_split": f"WITH {_RIDES} SELECT key, COUNT(*) AS n FROM rides GROUP BY key",
    "region_assign": f"""WITH {_REGION_RIDES}
SELECT key, fare_amount, pickup_datetime, neighborhood AS pickup_region
FROM grouped JOIN places ON grouped.grp = places.grp""",
    "ride_clusters": f"""WITH {_REGION_RIDES}, firsts AS (
  SELECT grp, MIN(neighborhood) AS first_region FROM places GROUP BY grp)
SELECT first_region, COUNT(*) AS n FROM grouped JOIN firsts ON grouped.grp = firsts.grp GROUP BY 1""",
    "nearest_place": f"""WITH {_RIDES},
centers AS (
  SELECT latitude, longitude, CAST(row_number() OVER (ORDER BY latitude, longitude) - 1 AS INTEGER) AS place
  FROM (SELECT DISTINCT CAST(40.46 AS DOUBLE) + CAST(0.003 AS DOUBLE) * (c_custkey % 61) AS latitude,
               CAST(-74.25 AS DOUBLE) + CAST(0.006 AS DOUBLE) * (c_custkey % 67) AS longitude FROM customer)),
points AS (SELECT DISTINCT pickup_latitude AS la, pickup_longitude AS lo FROM rides),
nearest AS (
  SELECT la, lo, MIN({{'square': (la - latitude) * (la - latitude) + (lo - longitude) * (lo - longitude), 'place': place}}).place AS place
  FROM points CROSS JOIN centers WHERE la IS NOT NULL AND lo IS NOT NULL GROUP BY la, lo)
SELECT place, COUNT(*) AS rides
FROM rides LEFT JOIN nearest ON pickup_latitude = la AND pickup_longitude = lo GROUP BY place""",
    "interval_reattach": f"""WITH {_USER_RIDES}
SELECT a.key, a.ride, a.pickup_datetime, b.ride AS near_ride
FROM rides a LEFT JOIN rides b ON a.key = b.key
 AND a.pickup_datetime BETWEEN b.pickup_datetime - INTERVAL 10 MINUTES AND b.pickup_datetime + INTERVAL 10 MINUTES""",
    "region_reattach": f"WITH {_USER_RIDES}, {_PLACES}, {_REATTACHED}",
    "curate_direct": _CURATED_TABLE,
    "fare_by_day": f"""WITH {_RIDES}
SELECT CAST(CAST(pickup_datetime AS DATE) AS VARCHAR) AS pickup_day, {_FARES} FROM rides GROUP BY 1""",
    "fare_by_day_region": _FARE_BY_DAY_REGION,
    "fare_by_day_region_early": _FARE_BY_DAY_REGION,
    "rides_of_region_sets": f"""WITH {_USER_RIDES}, {_PLACES},
curated AS (WITH {_REATTACHED}),
sets AS (
  SELECT 'region ' || n_regionkey AS name, n_name AS pickup_region FROM nation
  UNION ALL SELECT 'odd', n_name FROM nation WHERE n_nationkey % 2 = 1),
-- A row that differs from another in its region only is the same ride.
met AS (SELECT DISTINCT name, * EXCLUDE (pickup_region, name) FROM curated JOIN sets USING (pickup_region))
SELECT name, year, month, day, COUNT(*) AS rides FROM met GROUP BY 1, 2, 3, 4""",
    "date_range_read": f"""{_RAW_TABLE}
WHERE pickup_datetime >= TIMESTAMP '{RANGE_FROM}' AND pickup_datetime < TIMESTAMP '{RANGE_TO}'""",
    "box_read": f"""{_RAW_TABLE}
WHERE pickup_datetime >= TIMESTAMP '{RANGE_FROM}' AND pickup_datetime < TIMESTAMP '{RANGE_TO}'
  AND pickup_latitude BETWEEN CAST(40.5 AS DOUBLE) AND CAST(40.56 AS DOUBLE)
  AND pickup_longitude BETWEEN CAST(-74.2 AS DOUBLE) AND CAST(-74.05 AS DOUBLE)""",
    "raw_append": f"{_RAW_TABLE} UNION ALL SELECT {_RAW_COLUMNS} FROM rides",
    "table_overwrite": f"{_RAW_TABLE} WHERE pickup_latitude IS NOT NULL AND pickup_longitude IS NOT NULL",
    "schema_evolution": f"""WITH {_REGION_RIDES},
curated AS ({_CURATED}),
typed AS (SELECT DISTINCT key, pickup_region, fare_amount FROM curated)
SELECT key, pickup_region, fare_amount, CAST(NULL AS DOUBLE) AS fare_cents FROM typed
UNION ALL SELECT key, pickup_region, fare_amount, ROUND(fare_amount * 100) FROM typed""",
    "payload_evolution": f"""WITH {_REGION_RIDES},
typed AS (SELECT DISTINCT key, pickup_region, fare_amount FROM ({_CURATED}))
SELECT key, pickup_region, fare_amount,
       CASE WHEN CAST(key AS BIGINT) % 3 = 0 THEN 1 + CAST(0.25 AS DOUBLE) * (CAST(key AS BIGINT) % 7) END AS surge,
       CASE WHEN CAST(key AS BIGINT) % 9 = 0 THEN 'none'
            WHEN CAST(key AS BIGINT) % 3 = 0 THEN CAST(CAST(key AS BIGINT) % 5 AS VARCHAR) END AS tip
FROM typed""",
    "land_against_history": _RAW_TABLE,
    "curate_rerun": _CURATED_TABLE,
    "csv_source": f"WITH {_RIDES} SELECT * FROM rides",
    "event_log": f"""WITH {_RIDES}
SELECT key, CAST(CAST(fare_amount AS FLOAT) AS DOUBLE) AS fare_amount, pickup_datetime FROM rides""",
    "curate_batch": _CURATED_TABLE,
    "stream_land": f"""WITH {_RIDES}, {_TWICE},
kept AS (SELECT {_RAW_COLUMNS} FROM twice WHERE CAST(key AS BIGINT) % 97 <> 0)
SELECT * FROM kept
UNION ALL
SELECT key, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM twice WHERE CAST(key AS BIGINT) % 97 = 0""",
    "compacted_raw": _RAW_TABLE,
    "stream_curate": _CURATED_TABLE,
    "stream_window_fare": f"""WITH {_REGION_RIDES}
SELECT date_trunc('hour', pickup_datetime) AS window_start,
       date_trunc('hour', pickup_datetime) + INTERVAL 1 HOUR AS window_end,
       neighborhood AS pickup_region, {_FARES}
FROM grouped JOIN places ON grouped.grp = places.grp
GROUP BY 1, 2, 3""",
    "late_rows_backfilled": f"""WITH {_REGION_RIDES}, {_LATE}
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, neighborhood AS pickup_region, {_FARES},
       CAST(SUM(late) AS BIGINT) AS late_rides
FROM told JOIN places ON told.grp = places.grp
GROUP BY 1, 2, 3""",
    "pending_windows_state": f"""WITH {_REGION_RIDES},
closed AS (SELECT MAX(epoch_us(pickup_datetime)) // 1000 - 3 * 86400000 AS until FROM grouped),
windowed AS (SELECT *, time_bucket(INTERVAL 6 HOURS, pickup_datetime, TIMESTAMP '1970-01-01') AS window_start FROM grouped)
SELECT window_start, window_start + INTERVAL 6 HOURS AS window_end, neighborhood AS pickup_region, {_FARES}
FROM windowed JOIN places ON windowed.grp = places.grp, closed
WHERE epoch_ms(window_start + INTERVAL 6 HOURS) > until
GROUP BY 1, 2, 3""",
    "conservation": f"""WITH {_REGION_RIDES}, {_TWICE}, {_LATE},
events_in AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (CAST(key AS BIGINT) % 97 = 0) AS bad FROM twice),
-- And the ride that closes the windows.
rides_in AS (SELECT COUNT(*) + 1 AS n, CAST(SUM(late) AS BIGINT) AS late FROM told)
SELECT 'batch' AS run, n AS read, bad, 0 AS late, n - bad AS written FROM events_in
UNION ALL SELECT 'stream', n, bad, 0, n FROM events_in
UNION ALL SELECT 'windows', n, 0, late, n - late FROM rides_in""",
    "stream_first_deliveries": f"""WITH {_RIDES}
SELECT key, CAST(CAST(fare_amount AS FLOAT) AS DOUBLE) AS fare_amount, pickup_datetime FROM rides""",
    "stream_interval_join": f"""WITH {_USER_RIDES},
typed AS (SELECT * REPLACE (CAST(CAST(fare_amount AS FLOAT) AS DOUBLE) AS fare_amount) FROM rides)
SELECT a.key, a.pickup_datetime, a.fare_amount, b.pickup_datetime AS near_pickup, b.fare_amount AS near_fare
FROM typed a LEFT JOIN typed b ON a.key = b.key AND b.pickup_longitude IS NOT NULL AND b.pickup_latitude IS NOT NULL
 AND a.pickup_datetime BETWEEN b.pickup_datetime - INTERVAL 10 MINUTES AND b.pickup_datetime + INTERVAL 10 MINUTES""",
    "stream_reattach": f"WITH {_UNTIMED_RIDES}, {_PLACES}, {_REATTACHED}",
    "replay_land_curate": _CURATED_TABLE,
}
