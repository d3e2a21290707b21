"""Plain SQL for the named queries, written independently for another engine to run."""

from __future__ import annotations

import re

from velomet.fixed_values import (
    CLIMATOLOGY_DRIVERS,
    COMFORT_EDGES,
    COMFORT_LABELS,
    DAILY_ELEMENTS,
    DISPLAY_TEMP_EDGES,
    DISPLAY_TEMP_LABELS,
    HAC_MAX_LAGS,
    HOUR_TEMP_LABELS,
    MODEL_TEMP_EDGES,
    MODEL_TEMP_LABELS,
    OBSERVATION_NUMBERS,
    PRESENT_WEATHER_CODES,
    RAIN_EDGES,
    RAIN_LABELS,
    SEGMENTS,
    TRIP_COUNTS,
    WIND_EDGES,
    WIND_LABELS,
)
from velomet.operators.weather_daily import WEATHER_DAILY_COLUMNS, WEATHER_DAILY_HOME_COLUMNS
from velomet.plans import oracle_fits as fits
from velomet.plans import oracle_upkeep as upkeep
from velomet.sources.descriptions import COLUMN_DESCRIPTIONS
from velomet.plans.standins import COUNTIES, CUTOVER, ELEMENT_ORDER, TRIANGLE, zip_rectangles


def r(expr: str, digits: int) -> str:
    """Rounding through a decimal with spare digits, so sums in another order agree."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,{digits + 5})), {digits}) AS DOUBLE)"


def band(c: str, edges, labels) -> str:
    cases = " ".join(
        f"WHEN {c} > {edges[i]}::DOUBLE AND {c} <= {edges[i + 1]}::DOUBLE THEN '{label}'"
        for i, label in enumerate(labels)
    )
    return f"CASE {cases} END"


def f(c: str) -> str:
    return f"({c} * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE)"


def station_name(key: str) -> str:
    return (
        f"CASE WHEN {key} % 3 = 0 THEN '  Dock  St ' || ({key} % 60) WHEN {key} % 3 = 1 THEN 'DOCK ST  ' || ({key} % 60) "
        f"WHEN {key} % 11 = 0 THEN NULL ELSE 'Dock St ' || ({key} % 60) || ' ' END"
    )


def lon(key: str) -> str:
    return f"(-74.0::DOUBLE + ({key} % 100) / 500.0::DOUBLE)"


def lat(key: str) -> str:
    return f"(40.6::DOUBLE + ({key} % 37) / 200.0::DOUBLE)"


def haversine(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    a = (
        f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    )
    return f"(2 * 6371010.0::DOUBLE * asin(sqrt({a})))"


def name_key(c: str) -> str:
    return f"upper(trim(regexp_replace({c}, '\\s+', ' ', 'g')))"


def counts() -> str:
    return ", ".join(f"count(*) FILTER (WHERE {cond}) AS {name}" for name, cond in TRIP_COUNTS)


LEGACY_SECOND = "((o_orderkey * 37) % 86400)"
CURRENT_SECOND = "((l_orderkey * 37 + l_linenumber * 3671) % 86400)"
DISTANCE = haversine(
    "start_station_longitude", "start_station_latitude", "end_station_longitude", "end_station_latitude"
)
STATIONS = ", ".join(
    ["start_station_id", "start_station_name", "start_station_latitude", "start_station_longitude",
     "end_station_id", "end_station_name", "end_station_latitude", "end_station_longitude"]
)
OWNED = f"NOT (source_era = 'current' AND CAST(start_time AS DATE) < DATE '{CUTOVER}')"


def day_mart(source: str, where: str) -> str:
    return f"""SELECT CAST(start_time AS DATE) AS date, count(*) AS num_trips, {counts()},
      {r('avg(trip_duration_seconds) / 60', 3)} AS avg_trip_duration_minutes,
      {r('quantile_disc(trip_duration_seconds, 0.5) / 60.0::DOUBLE', 3)} AS median_trip_duration_minutes,
      {r('avg(distance_meters)', 1)} AS avg_distance_meters
    FROM {source} WHERE {where} GROUP BY 1"""


def hour_mart(source: str, where: str) -> str:
    return f"""SELECT date_trunc('hour', start_time) AS hour_ts, CAST(start_time AS DATE) AS date,
      CAST(extract(hour FROM start_time) AS INTEGER) AS hour, count(*) AS num_trips, {counts()},
      {r('avg(trip_duration_seconds) / 60', 3)} AS avg_trip_duration_minutes,
      {r('avg(distance_meters)', 1)} AS avg_distance_meters
    FROM {source} WHERE {where} GROUP BY 1, 2, 3"""


def reported(code: str, divisor: float) -> str:
    return f"max(CASE WHEN element = '{code}' AND qflag IS NULL THEN CAST(value AS DOUBLE) / {divisor}::DOUBLE END)"


def flag3(measured: str, cond: str) -> str:
    return f"CAST(CASE WHEN {measured} IS NULL THEN NULL WHEN {cond} THEN 1 ELSE 0 END AS INTEGER)"


def derived_columns() -> str:
    own = {
        "year": "CAST(year(date) AS INTEGER)",
        "month": "CAST(month(date) AS INTEGER)",
        "day": "CAST(day(date) AS INTEGER)",
        "day_of_week": "CAST(dayofweek(date) + 1 AS INTEGER)",
        "is_weekend": "CAST(CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER)",
        "season": "CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5) THEN 'Spring' WHEN month(date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END",
        "tavg_c": r("tavg_c", 1),
        "prcp_inches": r("prcp_mm / 25.4::DOUBLE", 2),
        "snow_inches": r("snow_mm / 25.4::DOUBLE", 1),
        "snow_depth_inches": r("snow_depth_mm / 25.4::DOUBLE", 1),
        "is_rainy": flag3("prcp_mm", "prcp_mm > 0"),
        "is_snowy": flag3("snow_mm", "snow_mm > 0"),
        "is_hot_day": flag3("tmax_c", f"{f('tmax_c')} > 90"),
        "is_freezing": flag3("tmin_c", f"{f('tmin_c')} < 32"),
        "is_humid": flag3("rh_avg", "rh_avg >= 70"),
        "heating_degree_days": r(f"CASE WHEN tavg_c IS NOT NULL THEN greatest(0, 65 - {f('tavg_c')}) END", 1),
        "cooling_degree_days": r(f"CASE WHEN tavg_c IS NOT NULL THEN greatest(0, {f('tavg_c')} - 65) END", 1),
        "sea_level_pressure_hpa": r("slp_hpa", 1),
        "station_pressure_hpa": r("stp_hpa", 1),
        "wind_avg_ms": r("wind_avg_ms", 1),
        "wind_avg_mph": r("wind_avg_ms * 2.23694::DOUBLE", 1),
        "wind_gust_ms": r("wind_gust_ms", 1),
        "wind_gust_mph": r("wind_gust_ms * 2.23694::DOUBLE", 1),
        "dewpoint_c": r("dewpoint_c", 1),
        "wetbulb_c": r("wetbulb_c", 1),
    }
    for name in ("tmin", "tmax", "tavg", "dewpoint", "wetbulb"):
        own[f"{name}_f"] = r(f(f"{name}_c"), 1)
    place = {"station_name", "city", "state", "zip_code", "county_name", "longitude", "latitude", "geo_coord"}
    return ", ".join(
        f"{own.get(c, c)} AS {c}" for c in WEATHER_DAILY_COLUMNS if c not in place
    )


def zip_hits(points: str, point_id: str, px: str, py: str) -> str:
    boxes = ", ".join(f"('{z}', 'City {z[3]}', {w}::DOUBLE, {e}::DOUBLE, {s}::DOUBLE, {n}::DOUBLE)" for z, w, e, s, n in zip_rectangles())
    (ax, ay), (bx, by), (cx, cy) = TRIANGLE
    slant = f"({bx}::DOUBLE + ({cx - bx}::DOUBLE) * ({py} - {by}::DOUBLE) / ({cy - by}::DOUBLE))"
    return f"""SELECT {point_id}, zip_code, city FROM {points}
      JOIN (VALUES {boxes}) AS b(zip_code, city, west, east, south, north)
        ON {px} >= west AND {px} < east AND {py} >= south AND {py} < north
    UNION ALL
    SELECT {point_id}, '20000', 'Triangle' FROM {points}
      WHERE {px} >= {ax}::DOUBLE AND {py} >= {ay}::DOUBLE AND {py} < {cy}::DOUBLE AND {px} < {slant}"""


def county_hits(points: str, point_id: str) -> str:
    boxes = ", ".join(f"('{n}', {w}::DOUBLE, {e}::DOUBLE, {s}::DOUBLE, {t}::DOUBLE)" for n, (w, e, s, t) in COUNTIES.items())
    return f"""SELECT {point_id}, county_name FROM {points}
      JOIN (VALUES {boxes}) AS b(county_name, west, east, south, north)
        ON longitude >= west AND longitude < east AND latitude >= south AND latitude < north"""


def observation_number(c: str, trace: bool) -> str:
    s = f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    t = "0.0" if trace else "NULL"
    return f"""CASE WHEN {c} IS NULL OR {s} = '' THEN NULL WHEN {s} = 'T' THEN {t} WHEN {s} LIKE '%s' THEN NULL
      ELSE TRY_CAST(regexp_replace({s}, 'V$', '') AS DOUBLE) END"""


def preferred(c: str, fallback: str = "avg") -> str:
    mean = f"COALESCE(avg({c}) FILTER (WHERE report_type = 'FM-15'), {fallback}({c}))"
    return f"{r(mean, 6)} AS {c}"


def segment_rows(columns: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {columns}, '{name}' AS segment, {t} AS trips, {m} AS member, {c} AS casual FROM {source}"
        for name, (t, m, c, _) in SEGMENTS.items()
    )


WIDE_NAMES = [name for name, _, _ in DAILY_ELEMENTS]
RAW_NUMBERS = {src: (name, trace) for src, name, trace in OBSERVATION_NUMBERS}

CTES: dict[str, str] = {
    "legacy": f"""SELECT NULL AS ride_id, NULL AS rideable_type,
        CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + to_seconds({LEGACY_SECOND}) END AS start_time,
        o_orderdate + to_seconds({LEGACY_SECOND} + 60 + o_custkey % 3600) AS stop_time,
        CASE WHEN o_orderkey % 7 <> 0 THEN CAST(floor(o_totalprice / 100) AS BIGINT) + 60 END AS trip_duration,
        CAST(o_custkey AS VARCHAR) AS start_station_id, {station_name('o_custkey')} AS start_station_name,
        {lat('o_custkey')} AS start_station_latitude, {lon('o_custkey')} AS start_station_longitude,
        CAST(o_custkey % 500 AS VARCHAR) AS end_station_id, {station_name('(o_custkey + 1)')} AS end_station_name,
        {lat('o_orderkey')} AS end_station_latitude, {lon('o_orderkey')} AS end_station_longitude,
        CASE o_orderstatus WHEN 'F' THEN 'member' WHEN 'O' THEN 'casual' END AS member_casual,
        CAST(o_orderkey % 5000 AS VARCHAR) AS bike_id,
        CASE WHEN o_custkey % 5 <> 0 THEN 1940 + CAST((o_custkey % 120 + 1) // 2 AS BIGINT) END AS birth_year,
        CAST(o_custkey % 3 AS BIGINT) AS gender,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'JC' ELSE 'NYC' END AS region
      FROM orders""",
    "current": f"""SELECT l_orderkey || '-' || l_linenumber AS ride_id,
        CASE l_returnflag WHEN 'A' THEN 'classic_bike' WHEN 'R' THEN 'electric_bike' ELSE 'docked_bike' END AS rideable_type,
        l_shipdate + to_seconds({CURRENT_SECOND}) AS start_time,
        l_shipdate + to_seconds({CURRENT_SECOND} + CAST(l_quantity AS BIGINT) * 60 + l_partkey % 60) AS stop_time,
        l_suppkey || '.05' AS start_station_id, {station_name('l_suppkey')} AS start_station_name,
        CASE WHEN l_partkey % 50 <> 0 THEN {lat('l_partkey')} END AS start_station_latitude,
        CASE WHEN l_partkey % 50 <> 0 THEN {lon('l_partkey')} END AS start_station_longitude,
        (l_suppkey % 80) || '.05' AS end_station_id, {station_name('(l_suppkey + 1)')} AS end_station_name,
        {lat('l_orderkey')} AS end_station_latitude, {lon('l_orderkey')} AS end_station_longitude,
        CASE WHEN l_linestatus = 'F' THEN 'member' ELSE 'casual' END AS member_casual,
        CASE WHEN l_suppkey % 3 = 0 THEN 'JC' ELSE 'NYC' END AS region
      FROM lineitem""",
    "trips": f"""SELECT CAST(ride_id AS VARCHAR) AS ride_id, CAST(rideable_type AS VARCHAR) AS rideable_type, start_time, stop_time,
        COALESCE(trip_duration, date_sub('second', start_time, stop_time)) AS trip_duration_seconds,
        {STATIONS}, member_casual, bike_id, birth_year, gender, {DISTANCE} AS distance_meters, region,
        'legacy' AS source_era, 'orders.parquet' AS source_file FROM legacy
      UNION ALL
      SELECT ride_id, rideable_type, start_time, stop_time, date_sub('second', start_time, stop_time),
        {STATIONS}, member_casual, NULL, NULL, NULL, {DISTANCE}, region, 'current', 'lineitem.parquet' FROM current""",
    "event_start": """SELECT *, CASE WHEN hour(ts) IN (2, 3) AND day(ts) % 3 = 0 THEN ts + to_seconds(7200) ELSE ts END AS start_time FROM events""",
    "event_trips": f"""SELECT start_time,
        date_sub('second', start_time, start_time + to_seconds(CAST(floor(value * 60) AS BIGINT))) AS trip_duration_seconds,
        CASE WHEN event_type IN ('view', 'click') THEN 'classic_bike' ELSE 'electric_bike' END AS rideable_type,
        CASE WHEN event_id % 3 <> 0 THEN 'member' ELSE 'casual' END AS member_casual,
        CASE WHEN user_id % 4 = 0 THEN 'JC' ELSE 'NYC' END AS region, 'current' AS source_era,
        {haversine(lon('user_id'), lat('user_id'), lon('event_id'), lat('event_id'))} AS distance_meters
      FROM event_start""",
    "daily": day_mart("trips", OWNED),
    "hourly_all": hour_mart("trips", OWNED),
    "hourly": hour_mart("event_trips", "TRUE"),
    "station_months": f"""SELECT date_trunc('month', CAST(start_time AS DATE))::DATE AS month, region,
        count(DISTINCT {name_key('start_station_name')}) AS num_stations, count(*) AS num_trips
      FROM trips WHERE {OWNED} AND start_station_name IS NOT NULL GROUP BY 1, 2""",
    "long_obs": f"""SELECT id, date, element, qflag, CAST(CASE
          WHEN element = 'TMAX' THEN warm + noise + 50 WHEN element = 'TMIN' THEN warm + noise - 50
          WHEN element IN ('TAVG', 'AWBT') THEN warm + noise WHEN element = 'ADPT' THEN warm + noise - 40
          WHEN element = 'PRCP' THEN CASE WHEN l_partkey % 3 = 0 THEN l_partkey % 400 ELSE 0 END
          WHEN element IN ('SNOW', 'SNWD') THEN CASE WHEN warm < 60 AND l_partkey % 2 = 0 THEN l_partkey % 150 ELSE 0 END
          WHEN element IN ('RHAV', 'RHMN', 'RHMX') THEN l_partkey % 70 + 30
          WHEN element IN ('ASLP', 'ASTP') THEN l_partkey % 400 + 9900
          WHEN element IN ('AWND', 'WSF2') THEN l_partkey % 90 + 5
          WHEN element = 'WDF2' THEN l_partkey % 360 ELSE 1 END AS BIGINT) AS value
      FROM (SELECT l_partkey, CAST(l_shipdate AS DATE) AS date,
          [{', '.join(repr(e) for e in ELEMENT_ORDER)}][(l_orderkey * 7 + l_linenumber * 5 + l_partkey) % {len(ELEMENT_ORDER)} + 1] AS element,
          260 - 50 * abs(month(l_shipdate) - 7) AS warm, l_partkey % 121 - 60 AS noise,
          CASE WHEN l_suppkey % 3 = 2 THEN (CASE WHEN l_suppkey % 10 = 9 THEN 'CA' ELSE 'US' END) || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')
               ELSE 'USW00094728' END AS id,
          CASE WHEN l_orderkey % 13 = 0 THEN 'X' END AS qflag FROM lineitem)""",
    "wide": f"""SELECT id AS station_id, date,
        COALESCE({reported('TAVG', 10.0)}, ({reported('TMAX', 10.0)} + {reported('TMIN', 10.0)}) / 2) AS tavg_c,
        {', '.join(f'{reported(code, div)} AS {name}' for name, code, div in DAILY_ELEMENTS)},
        CAST(max(CASE WHEN element = 'WT01' AND qflag IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS is_foggy,
        CAST(max(CASE WHEN element = 'WT03' AND qflag IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS is_thunder,
        CAST(max(CASE WHEN element = 'WT08' AND qflag IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS is_hazy
      FROM long_obs WHERE id LIKE 'US%' GROUP BY 1, 2""",
    "derived": f"SELECT {derived_columns()} FROM wide",
    "stations": f"""SELECT CASE WHEN s_suppkey = 0 THEN 'USW00094728' ELSE (CASE WHEN s_suppkey % 10 = 9 THEN 'CA' ELSE 'US' END) || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') END AS id,
        s_name AS station_name, 'NY' AS state, CASE WHEN s_suppkey % 29 <> 28 THEN {lat('s_suppkey')} END AS latitude, {lon('s_suppkey')} AS longitude
      FROM supplier""",
    "us_stations": "SELECT * FROM stations WHERE id LIKE 'US%' AND latitude IS NOT NULL",
    "in_zip": zip_hits("us_stations", "id", "longitude", "latitude"),
    "in_county": county_hits("us_stations", "id"),
    "mapped": """SELECT id AS station_id, station_name, longitude, latitude, zip_code, city, state, county_name FROM (
        SELECT s.*, z.zip_code, z.city, c.county_name, row_number() OVER (PARTITION BY s.id ORDER BY z.zip_code, c.county_name) AS nth
        FROM us_stations s JOIN in_zip z ON s.id = z.id JOIN in_county c ON s.id = c.id) WHERE nth = 1""",
    "home": f"""SELECT {', '.join(WEATHER_DAILY_HOME_COLUMNS)} FROM derived WHERE station_id = 'USW00094728'
        AND station_id IN (SELECT station_id FROM mapped)""",
    "joined": "SELECT d.*, h.* EXCLUDE (date) FROM daily d LEFT JOIN home h ON d.date = h.date",
    "long_days": segment_rows("* EXCLUDE (year, is_weekend)", "(SELECT * FROM joined WHERE date IS NOT NULL)"),
    "launched": "SELECT * FROM (SELECT *, min(CASE WHEN trips > 0 THEN date END) OVER (PARTITION BY segment) AS launch FROM long_days) WHERE date >= launch",
    "indexed": """SELECT *, CASE WHEN count(trips) OVER w >= 10 AND median(trips) OVER w <> 0
          THEN CAST(trips AS DOUBLE) / median(trips) OVER w * 100.0::DOUBLE END AS ridership_index
      FROM launched WINDOW w AS (PARTITION BY segment ORDER BY date ROWS BETWEEN 14 PRECEDING AND 14 FOLLOWING)""",
    "days": """SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
        CASE WHEN is_snowy = 1 THEN 'Snowy' WHEN is_rainy = 1 THEN 'Rainy' WHEN is_rainy = 0 THEN 'Dry' END AS condition,
        CASE WHEN trips > 0 THEN casual / trips * 100 END AS pct_casual FROM indexed""",
    "raw_obs": """SELECT *, (dd * 7 + hh * 3) % 10 AS spell, CAST(dd % 25 + hh // 2 + user_id % 5 - 8 AS INTEGER) AS degrees
      FROM (SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              hour(ts) AS hh, day(ts) AS dd FROM events)""",
    "cells": """SELECT event_id, date_trunc('minute', ts) AS obs_time_lst,
        CASE WHEN event_type IN ('view', 'click') THEN 'FM-15' WHEN event_type IN ('purchase', 'signup') THEN 'FM-16' ELSE 'SOD' END AS report_type,
        CASE k % 11 WHEN 0 THEN '' WHEN 1 THEN degrees || '.' || (k % 10) || 's' WHEN 2 THEN degrees || '.' || (k % 10) || 'V' WHEN 3 THEN '*'
             ELSE degrees || '.' || (k % 10) END AS dry, (degrees - 3) || '.5' AS dew, k, spell, user_id FROM raw_obs""",
    "typed_obs": f"""SELECT 'USW00094728' AS station_id, obs_time_lst, report_type,
        {observation_number('dry', False)} AS temp_c, CAST(dew AS DOUBLE) AS dewpoint_c,
        {observation_number('(CASE WHEN k % 2 = 0 THEN dry END)', False)} AS wetbulb_c,
        CAST(k % 70 + 30 AS DOUBLE) AS rh_pct,
        CASE WHEN spell < 3 THEN [0.0, 0.8, 4.3][k % 3 + 1]::DOUBLE WHEN spell < 7 THEN 0.0::DOUBLE END AS precip_mm,
        CAST((k + 980) || '.1' AS DOUBLE) AS slp_hpa, NULL::DOUBLE AS station_pressure_hpa, NULL::DOUBLE AS altimeter_hpa,
        CAST((user_id % 15) || '.' || (k % 10) AS DOUBLE) AS wind_speed_ms,
        CASE WHEN k % 4 = 0 THEN CAST(user_id % 20 + 5 AS DOUBLE) END AS wind_gust_ms,
        CASE WHEN k % 5 <> 0 THEN CAST(k % 36 * 10 AS DOUBLE) END AS wind_dir_deg,
        CASE WHEN k % 3 = 0 THEN 4.023::DOUBLE ELSE 16.093::DOUBLE END AS visibility_km,
        CASE WHEN k % 2 = 0 THEN 'FEW:02 72.43' END AS sky_conditions,
        CASE WHEN spell < 3 AND k % 2 = 0 THEN '-RA:02 |RA |RA' WHEN spell = 4 AND k % 5 = 0 THEN '-SN:03 |SN |'
             WHEN spell = 5 AND k % 5 = 1 THEN 'FG:30 |FG |TS:7' WHEN spell = 6 AND k % 7 = 1 THEN 'HZ:7 | |HZ' END AS present_weather,
        'events' AS source_file
      FROM (SELECT *, row_number() OVER (PARTITION BY obs_time_lst, report_type ORDER BY event_id) AS nth FROM cells
            WHERE report_type <> 'SOD') WHERE nth = 1""",
    "local_obs": f"""SELECT station_id, report_type, obs_time_lst,
        timezone('UTC', timezone('Etc/GMT+5', obs_time_lst)) AS obs_time_utc,
        timezone('America/New_York', timezone('Etc/GMT+5', obs_time_lst)) AS obs_time_local,
        CAST(timezone('America/New_York', timezone('Etc/GMT+5', obs_time_lst)) AS DATE) AS date_local,
        CAST(hour(timezone('America/New_York', timezone('Etc/GMT+5', obs_time_lst))) AS INTEGER) AS hour_local,
        {r(f('temp_c'), 1)} AS temp_f, {r(f('dewpoint_c'), 1)} AS dewpoint_f, {r(f('wetbulb_c'), 1)} AS wetbulb_f, rh_pct,
        {r('precip_mm / 25.4::DOUBLE', 3)} AS prcp_inches, slp_hpa AS sea_level_pressure_hpa,
        {r('wind_speed_ms * 2.23694::DOUBLE', 1)} AS wind_mph, {r('wind_gust_ms * 2.23694::DOUBLE', 1)} AS wind_gust_mph, wind_dir_deg,
        {r('visibility_km / 1.609344::DOUBLE', 1)} AS visibility_miles,
        {', '.join(f"CAST(CASE WHEN regexp_matches(COALESCE(present_weather, ''), '{code}') THEN 1 ELSE 0 END AS INTEGER) AS {flag}" for flag, code in PRESENT_WEATHER_CODES.items())},
        sky_conditions, present_weather, temp_c, dewpoint_c, wetbulb_c, precip_mm, wind_speed_ms, wind_gust_ms, visibility_km, source_file
      FROM typed_obs""",
    "weather_hours": f"""SELECT date_trunc('hour', obs_time_local) AS hour_dt, {preferred('temp_f')}, {preferred('dewpoint_f')},
        {preferred('wetbulb_f')}, {preferred('rh_pct')}, {preferred('prcp_inches', 'max')}, {preferred('wind_mph')},
        max(wind_gust_mph) AS wind_gust_mph, {preferred('visibility_miles')},
        {', '.join(f'max({flag}) AS {flag}' for flag in PRESENT_WEATHER_CODES)} FROM local_obs GROUP BY 1""",
    "hour_joined": "SELECT h.*, w.* EXCLUDE (hour_dt) FROM hourly h LEFT JOIN weather_hours w ON h.hour_ts = w.hour_dt",
    "long_hours": "SELECT * EXCLUDE (launch) FROM (SELECT *, min(CASE WHEN trips > 0 THEN date END) OVER (PARTITION BY segment) AS launch FROM ("
    + segment_rows("hour_ts, date, hour, temp_f, prcp_inches, is_raining, is_snowing", "hour_joined")
    + ")) WHERE date >= launch",
    "grid": """SELECT segment, CAST(d AS DATE) AS date, CAST(h AS INTEGER) AS hour FROM
        (SELECT segment, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d FROM long_hours GROUP BY segment),
        (SELECT unnest(generate_series(0, 23)) AS h)""",
    "filled": """SELECT g.segment, g.date, g.hour, COALESCE(CAST(l.trips AS DOUBLE), 0) AS trips, COALESCE(CAST(l.member AS DOUBLE), 0) AS member,
        COALESCE(CAST(l.casual AS DOUBLE), 0) AS casual
      FROM grid g LEFT JOIN long_hours l ON g.segment = l.segment AND g.date = l.date AND g.hour = l.hour""",
    "kpi_days": """SELECT date, CAST(num_nyc_trips AS DOUBLE) AS y, CAST(is_thunder AS DOUBLE) AS is_thunder, CAST(is_foggy AS DOUBLE) AS is_foggy,
        tavg_f, wind_avg_mph, snow_depth_inches,
        CASE WHEN prcp_inches IS NOT NULL THEN least(greatest(prcp_inches, 0.0), 1.25) END AS prcp_cap,
        CASE WHEN prcp_inches > 0 THEN 1.0::DOUBLE WHEN prcp_inches IS NOT NULL THEN 0.0::DOUBLE END AS rain01,
        CASE WHEN snow_inches IS NOT NULL THEN least(greatest(snow_inches, 0.0), 6.0) END AS snow_cap
      FROM joined WHERE date IS NOT NULL AND num_nyc_trips > 0""",
    "slots": " UNION ALL ".join(
        f"SELECT '{c}' AS driver, CAST(g.doy AS INTEGER) AS doy, m.v AS value FROM (SELECT unnest(generate_series(1, 366)) AS doy) g "
        f"LEFT JOIN (SELECT dayofyear(date) AS doy, avg({c}) AS v FROM kpi_days GROUP BY 1) m ON g.doy = m.doy"
        for c in CLIMATOLOGY_DRIVERS
    ),
    "snow_slots": " UNION ALL ".join(
        f"SELECT '{c}' AS driver, CAST(g.doy AS INTEGER) AS doy, m.v AS value FROM (SELECT unnest(generate_series(1, 366)) AS doy) g "
        f"LEFT JOIN (SELECT dayofyear(date) AS doy, avg({c}) AS v FROM kpi_days WHERE snow_cap > 0 GROUP BY 1) m ON g.doy = m.doy"
        for c in ("snow_cap", "tavg_f")
    ),
    "adjusted": """SELECT segment, date, CAST(trips AS DOUBLE) AS actual, trips / (1 + (member % 7 - 3) / 50.0::DOUBLE) AS adjusted FROM days""",
    "adjusted_years": """SELECT segment, CAST(year(date) AS INTEGER) AS year, sum(actual) AS actual, sum(adjusted) AS adjusted, count(*) AS n,
        (sum(actual) / sum(adjusted) - 1) * 100 AS weather_pct FROM adjusted GROUP BY 1, 2 HAVING count(*) >= 200""",
    "model_days": """SELECT date, CAST(year(date) * 12 + month(date) AS INTEGER) AS ym, isodow(date) - 1 AS dow, ln(num_trips) AS y, wind_avg_mph AS x, rh_avg AS z
      FROM joined WHERE date IS NOT NULL AND num_trips > 0""",
    "slope_days": """SELECT *, y - avg(y) OVER (PARTITION BY ym) AS yd, x - avg(x) OVER (PARTITION BY ym) AS xd
      FROM model_days WHERE x IS NOT NULL""",
    "slope": "SELECT count(*) AS n, sum(xd * yd) / sum(xd * xd) AS b, sum(xd * xd) AS sxx FROM slope_days",
    "psi": "SELECT date, ym, xd * (yd - xd * b) / sxx AS psi FROM slope_days CROSS JOIN slope",
}


def filled_slots(source: str) -> str:
    """Linear interpolation with held ends, spelled out with correlated neighbours."""
    return f"""SELECT s.driver, s.doy, CASE WHEN s.value IS NOT NULL THEN s.value
        WHEN lo.doy IS NOT NULL AND hi.doy IS NOT NULL THEN lo.value + (hi.value - lo.value) * (s.doy - lo.doy) / (hi.doy - lo.doy)
        ELSE COALESCE(lo.value, hi.value) END AS value
      FROM (SELECT a.*, (SELECT max(doy) FROM {source} b WHERE b.driver = a.driver AND b.doy <= a.doy AND b.value IS NOT NULL) AS ld,
                   (SELECT min(doy) FROM {source} b WHERE b.driver = a.driver AND b.doy >= a.doy AND b.value IS NOT NULL) AS rd FROM {source} a) s
      LEFT JOIN {source} lo ON lo.driver = s.driver AND lo.doy = s.ld LEFT JOIN {source} hi ON hi.driver = s.driver AND hi.doy = s.rd"""


CTES["filled_slots"] = filled_slots("slots")


def with_ctes(body: str) -> str:
    """Prefix a body with the CTEs it mentions, in dependency order."""
    order: list[str] = []
    open_names: set[str] = set()

    def visit(sql: str) -> None:
        for word in re.findall(r"(?i)\b(?:from|join)\s+([a-z_0-9]+)", sql):
            if word in CTES and word not in order and word not in open_names:
                open_names.add(word)
                visit(CTES[word])
                order.append(word)

    visit(body)
    if not order:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + body


HOLIDAYS = """WITH ranged AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1),
years AS (SELECT unnest(generate_series(1990, 2005)) AS y),
fixed AS (SELECT make_date(y, m, d) AS on_day FROM years, (VALUES (1, 1), (7, 4), (11, 11), (12, 25)) v(m, d)),
observed AS (SELECT CASE isodow(on_day) WHEN 6 THEN on_day - 1 WHEN 7 THEN on_day + 1 ELSE on_day END AS h FROM fixed),
first_of AS (SELECT make_date(y, m, 1) AS f, wd, nth FROM years, (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) v(m, wd, nth)),
nth_day AS (SELECT f + CAST((wd - isodow(f) + 7) % 7 + (nth - 1) * 7 AS INTEGER) AS h FROM first_of),
memorial AS (SELECT make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER) AS h FROM years),
holidays AS (SELECT h FROM observed UNION SELECT h FROM nth_day UNION SELECT h FROM memorial)
SELECT date, n, CAST(CASE WHEN date IN (SELECT h FROM holidays) THEN 1 ELSE 0 END AS INTEGER) AS holiday FROM ranged"""

TEMP_BAND = band("tavg_f", DISPLAY_TEMP_EDGES, DISPLAY_TEMP_LABELS)
WEATHER_HOUR_ROUNDS = ["temp_f", "dewpoint_f", "wetbulb_f", "rh_pct", "prcp_inches", "wind_mph", "visibility_miles"]
REPLACE_HOURS = "REPLACE (" + ", ".join(f"{r(c, 6)} AS {c}" for c in WEATHER_HOUR_ROUNDS) + ")"


def leads(value: str, name: str, ts: str) -> str:
    parts = []
    for k, label in [(1, "lead1"), (2, "lead2"), (-1, "lag1"), (-2, "lag2"), (-3, "lag3"), (-4, "lag4")]:
        alias = f"n{label}"
        parts.append((f"{alias}.{value} AS {name}_{label}", alias, k))
    return parts


def lead_lag(source: str, value: str, name: str, series: bool, columns: str) -> str:
    picks = leads(value, name, "ts")
    same = " AND {a}.segment = s.segment" if series else ""
    joins = " ".join(
        f"LEFT JOIN {source} {a} ON {a}.ts = s.ts + to_hours({k})" + same.format(a=a) for _, a, k in picks
    )
    return f"SELECT {columns}, {', '.join(p for p, _, _ in picks)} FROM {source} s {joins}"


CTES["hour_points"] = "SELECT segment, hour_ts AS ts, trips, is_raining FROM long_hours"
CTES["hour_points_all"] = "SELECT hour_ts AS ts, num_trips FROM hourly_all WHERE hour_ts IS NOT NULL"

# Codes the daily mart reads, written out here so that the query under test does not lend them.
DAILY_WANTED = (
    "'TAVG', 'TMAX', 'TMIN', 'PRCP', 'SNOW', 'SNWD', 'ADPT', 'AWBT', 'RHAV', 'RHMN', 'RHMX', 'ASLP', 'ASTP', 'AWND', 'WSF2', 'WDF2', "
    "'WT01', 'WT03', 'WT08'"
)
RAW_CELLS = """(SELECT o_orderkey AS row_id, o_custkey, o_orderdate, o_orderpriority, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders)"""
FILES = """(SELECT archive, path, max(size) AS size FROM (SELECT year(o_orderdate) || '.zip' AS archive, o_orderkey % 7 + 1 AS size,
   CASE o_orderkey % 6 WHEN 3 THEN 'nested/' WHEN 4 THEN 'nested/deep/' WHEN 5 THEN '__MACOSX/' ELSE '' END
   || CASE WHEN o_orderkey % 8 = 7 THEN 'JC-' ELSE '' END || strftime(o_orderdate, '%Y%m') || '-tripdata'
   || CASE o_orderkey % 5 WHEN 1 THEN '_' || (o_orderkey % 9) WHEN 2 THEN '-part' || (o_orderkey % 9) ELSE '' END
   || CASE o_orderkey % 10 WHEN 9 THEN '.txt' WHEN 8 THEN '.CSV' ELSE '.csv' END AS path FROM orders) GROUP BY 1, 2)"""


def file_name(key: str) -> str:
    return f"(CASE WHEN {key} % 4 = 0 THEN 'jc-' ELSE '' END || (201300 + {key} % 1200) || '-tripdata-' || {key} || CASE WHEN {key} % 9 = 0 THEN '.html' ELSE '.zip' END)"


CTES["listing"] = f"SELECT {file_name('c_custkey')} AS path, c_custkey * 3 % 1000 AS size FROM customer"
CTES["stored"] = f"""SELECT {file_name('o_custkey')} AS path, o_custkey * 3 % 1000 + CASE WHEN min(o_orderkey) % 5 = 0 THEN 1 ELSE 0 END AS size
  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey"""

BODIES: dict[str, str] = {
    "trips_unified": f"SELECT * REPLACE ({r('distance_meters', 3)} AS distance_meters) FROM trips",
    "daily_trips": "SELECT * FROM daily",
    "hourly_trips": "SELECT * FROM hourly",
    "hourly_trips_stream": "SELECT * FROM hourly",
    "hourly_trips_all_years": "SELECT * FROM hourly_all",
    "station_counts_monthly": "SELECT * FROM station_months",
    "station_key_comparison": f"""SELECT CAST(year(start_time) AS INTEGER) AS year, count(DISTINCT start_station_id) AS by_raw_id,
        count(DISTINCT {name_key('start_station_name')}) AS by_name,
        count(DISTINCT CASE WHEN start_station_latitude IS NOT NULL THEN {r('start_station_latitude', 3)} || ',' || {r('start_station_longitude', 3)} END) AS by_latlng
      FROM trips WHERE region = 'NYC' AND start_station_name IS NOT NULL AND year(start_time) BETWEEN 1995 AND 2001 AND {OWNED} GROUP BY 1""",
    "daily_trips_weather": "SELECT * FROM joined",
    "hourly_trips_weather": f"SELECT * {REPLACE_HOURS} FROM hour_joined",
    "missing_start_times": "SELECT region, source_era, count(*) AS trips, count(*) FILTER (WHERE start_time IS NULL) AS missing FROM trips GROUP BY 1, 2",
    "repeated_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "observation_pivot": "SELECT * FROM wide",
    "weather_daily_derived": "SELECT * FROM derived",
    "weather_daily_stations": "SELECT d.*, m.* EXCLUDE (station_id) FROM derived d JOIN mapped m ON d.station_id = m.station_id",
    "weather_daily_nyc": "SELECT * FROM home",
    "station_map": "SELECT * FROM mapped",
    "observation_typing": "SELECT * FROM typed_obs",
    "observation_years": "SELECT * EXCLUDE (source_file) FROM typed_obs",
    "daily_observation_folders": f"""SELECT span, element, count(*) AS n, CAST(sum(value) AS BIGINT) AS total
      FROM long_obs JOIN (VALUES ('all', 0, 9999), ('from 1995', 1995, 9999), ('to 1994', 0, 1994)) s(span, a, b) ON year(date) BETWEEN a AND b
      WHERE id LIKE 'US%' AND element IN ({DAILY_WANTED}) GROUP BY 1, 2""",
    "mart_snapshots": """SELECT kind, date, num_trips, num_nyc_trips, (SELECT count(*) FROM daily) AS rows
      FROM daily CROSS JOIN (VALUES ('snapshot'), ('text')) k(kind)""",
    "trip_files_typed": f"""SELECT 'NYC' AS region, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (WHERE row_id % 6 NOT IN (0, 1)) AS named,
        CAST(sum(price) FILTER (WHERE row_id % 11 NOT IN (0, 1, 2)) AS BIGINT) AS seconds, sum(CASE WHEN o_custkey % 3 <> 0 THEN CAST(1940 + o_custkey % 60 AS DOUBLE) END) AS birth_years,
        count(DISTINCT o_custkey) AS stations, 1::BIGINT AS bad_files
      FROM {RAW_CELLS} WHERE o_orderdate >= DATE '1993-01-01' AND NOT (row_id % 4 = 3 AND row_id % 5 = 0) GROUP BY 1, 2""",
    "weather_hourly_nyc": "SELECT * FROM local_obs",
    "obs_hour_collapse": f"SELECT * {REPLACE_HOURS} FROM weather_hours",
    "tz_local_key": """SELECT l_orderkey, l_linenumber, t AS obs_time_lst, z AS obs_time_local, CAST(z AS DATE) AS date_local, CAST(hour(z) AS INTEGER) AS hour_local
      FROM (SELECT *, timezone('America/New_York', timezone('Etc/GMT+5', t)) AS z FROM
        (SELECT l_orderkey, l_linenumber, l_shipdate + to_minutes((l_orderkey * 61 + l_linenumber * 7) % 1440) AS t FROM lineitem))""",
    "text_flags": "SELECT doc_id, " + ", ".join(
        f"CAST(CASE WHEN trim(text, ' ') <> '' AND regexp_matches(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '{code}') THEN 1 ELSE 0 END AS INTEGER) AS {flag}"
        for flag, code in PRESENT_WEATHER_CODES.items()
    ) + " FROM documents",
    "clean_markers": f"""SELECT row_id, CASE WHEN row_id % 11 IN (0, 1, 2) THEN NULL ELSE price END AS trip_duration,
        CASE WHEN row_id % 4 = 3 AND row_id % 5 = 0 THEN NULL ELSE o_orderdate END AS start_time,
        CAST(o_custkey AS VARCHAR) AS start_station_id,
        CASE WHEN row_id % 6 IN (0, 1) THEN NULL ELSE o_orderpriority END AS start_station_name,
        CASE WHEN row_id % 9 = 0 THEN NULL ELSE (row_id % 90) + 0.25::DOUBLE END AS start_station_latitude,
        CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(1940 + o_custkey % 60 AS DOUBLE) END AS birth_year,
        CAST(o_custkey % 3 AS BIGINT) AS gender, CAST(NULL AS VARCHAR) AS bike_id FROM {RAW_CELLS}""",
    "quarantine_counts": f"""SELECT 'orders' AS source_file, c AS "column", count(*) AS n, min(v) AS example FROM (
        SELECT 'trip_duration' AS c, CASE row_id % 11 WHEN 1 THEN price || '.5' ELSE '1d' END AS v FROM {RAW_CELLS} WHERE row_id % 11 IN (1, 2)
        UNION ALL SELECT 'start_time', 'junk' FROM {RAW_CELLS} WHERE row_id % 4 = 3 AND row_id % 5 = 0
        UNION ALL SELECT 'start_station_latitude', 'n/a' FROM {RAW_CELLS} WHERE row_id % 9 = 0) GROUP BY 2""",
    "name_keys": f"""SELECT p_brand, count(DISTINCT name) AS raw_names, count(DISTINCT {name_key('name')}) AS stations, min({name_key('name')}) AS first_name
      FROM (SELECT p_brand, CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN '  ' || p_name WHEN 2 THEN replace(p_name, ' ', ' ' || chr(9) || ' ') ELSE p_name END AS name FROM part) GROUP BY 1""",
    "shard_antijoin": f"""WITH files AS (SELECT *, regexp_extract(path, '([^/]*)$', 1) AS base FROM {FILES} WHERE lower(path) LIKE '%.csv' AND path NOT LIKE '\\_\\_MACOSX%' ESCAPE '\\'),
      best AS (SELECT *, left(base, length(base) - 4) AS stem FROM (SELECT *, row_number() OVER (PARTITION BY archive, base ORDER BY length(path) - length(replace(path, '/', '')), path) AS nth FROM files) WHERE nth = 1)
      SELECT archive, path, size FROM best b WHERE NOT EXISTS (SELECT 1 FROM best c WHERE c.archive = b.archive AND c.stem = regexp_extract(b.stem, '^(.+)_\\d+$', 1))""",
    "manifest_diff": "SELECT l.path, l.size, s.size AS stored_size, CASE WHEN l.size = s.size THEN 'skip' ELSE 'mirror' END AS action FROM listing l LEFT JOIN stored s ON l.path = s.path",
    "archive_selection": "SELECT path, size FROM listing WHERE path LIKE '%.zip' AND upper(path) LIKE 'JC-%' ORDER BY path LIMIT 25",
    "not_yet_loaded": "SELECT path, size FROM listing WHERE path NOT IN (SELECT path FROM stored)",
    "high_water_mark": """SELECT path FROM (SELECT strftime(o_orderdate, '%Y%m') || '-tripdata-' || o_orderkey || '.zip' AS path FROM orders)
      WHERE left(path, 6) > (SELECT max(strftime(o_orderdate, '%Y%m')) FROM orders WHERE o_orderdate < DATE '1999-06-01')""",
    "keep_first_dedup": """SELECT date_trunc('minute', ts) AS minute, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY 1, 2""",
    "great_circle": f"""SELECT start_station_id, count(*) AS n, count({DISTANCE}) AS n_located, {r(f'max({DISTANCE})', 3)} AS longest, {r(f'avg({DISTANCE})', 3)} AS mean FROM current GROUP BY 1""",
    "point_in_polygon": "WITH spots AS (SELECT c_custkey, " + lon("c_custkey") + " AS px, " + lat("c_custkey") + " AS py FROM customer) " + zip_hits("spots", "c_custkey", "px", "py"),
    "condition_label": "SELECT segment, condition, count(*) AS days, CAST(sum(trips) AS BIGINT) AS trips FROM days GROUP BY 1, 2",
    "daily_frame": f"""SELECT segment, date, year, is_weekend, condition, trips, member, casual, {r('pct_casual', 6)} AS pct_casual,
        {r('ridership_index', 6)} AS ridership_index, tavg_f FROM days""",
    "user_slice": f"SELECT segment, date, trips, {r('ridership_index', 6)} AS ridership_index FROM days WHERE year BETWEEN 1998 AND 2000 AND is_weekend = 1",
    "ridership_index": f"SELECT segment, date, {r('ridership_index', 6)} AS ridership_index FROM days",
    "rolling_30d_mean": f"""SELECT segment, date, trips, {r('CASE WHEN count(trips) OVER w >= 7 THEN avg(trips) OVER w END', 6)} AS trips_30d FROM days
      WINDOW w AS (PARTITION BY segment ORDER BY date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)""",
    "band_means": f"SELECT segment, {TEMP_BAND} AS band, {r('avg(trips)', 6)} AS trips, {r('avg(member)', 6)} AS member, {r('avg(casual)', 6)} AS casual FROM days WHERE {TEMP_BAND} IS NOT NULL GROUP BY 1, 2",
    "rider_mix_unpivot": " UNION ALL ".join(
        f"SELECT segment, {TEMP_BAND} AS band, '{label}' AS rider, {r(f'avg({c})', 6)} AS trips FROM days WHERE {TEMP_BAND} IS NOT NULL GROUP BY 1, 2"
        for label, c in (("Member", "member"), ("Casual", "casual"))
    ),
    "band_medians": f"""SELECT segment, {band('wind_avg_mph', WIND_EDGES, WIND_LABELS)} AS band, {r('median(ridership_index)', 6)} AS ridership_index FROM days
      WHERE wind_avg_mph IS NOT NULL AND ridership_index IS NOT NULL GROUP BY 1, 2""",
    "comfort_medians": f"""SELECT segment, {band('dewpoint_f', COMFORT_EDGES, COMFORT_LABELS)} AS band, {r('median(ridership_index)', 6)} AS ridership_index FROM days
      WHERE tavg_f >= 68 AND dewpoint_f IS NOT NULL AND ridership_index IS NOT NULL GROUP BY 1, 2""",
    "month_year_mean": f"SELECT segment, CAST(month(date) AS INTEGER) AS month, year, {r('avg(trips)', 6)} AS trips FROM days GROUP BY 1, 2, 3",
    "month_year_table": f"""SELECT CAST(g.month AS INTEGER) AS month, CAST(y.year AS VARCHAR) AS year, {r('avg(trips)', 6)} AS trips
      FROM (SELECT unnest(generate_series(1, 12)) AS month) g CROSS JOIN (SELECT DISTINCT year FROM days WHERE segment = 'NYC only') y
      LEFT JOIN days d ON month(d.date) = g.month AND d.year = y.year AND d.segment = 'NYC only' GROUP BY 1, 2""",
    "calendar_month_mean": f"SELECT segment, CAST(month(date) AS INTEGER) AS m, monthname(date) AS month, {r('avg(trips)', 6)} AS trips FROM days GROUP BY 1, 2, 3",
    "five_number": f"""WITH known AS (SELECT segment, condition, trips FROM ({{days}}) WHERE tavg_f IS NOT NULL AND condition IS NOT NULL),
      box AS (SELECT segment, condition, count(*) AS n, quantile_cont(trips, 0.25) AS q1, quantile_cont(trips, 0.5) AS median, quantile_cont(trips, 0.75) AS q3,
                CAST(min(trips) AS DOUBLE) AS low, CAST(max(trips) AS DOUBLE) AS high FROM known GROUP BY 1, 2)
      SELECT b.segment, b.condition, n, {r('q1', 6)} AS q1, {r('median', 6)} AS median, {r('q3', 6)} AS q3, low, high,
        CAST(min(trips) AS DOUBLE) AS whisker_low, CAST(max(trips) AS DOUBLE) AS whisker_high
      FROM box b JOIN known k ON b.segment = k.segment AND b.condition = k.condition AND trips BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
      GROUP BY b.segment, b.condition, n, q1, median, q3, low, high""",
    "headline_kpis": f"""SELECT segment, CAST(sum(trips) AS BIGINT) AS total, count(*) AS days, {r('avg(trips)', 6)} AS per_day,
        {r('avg(trips) FILTER (WHERE tavg_f >= 65) / nullif(avg(trips) FILTER (WHERE tavg_f < 40), 0)', 6)} AS warm_cold_ratio FROM days GROUP BY 1""",
    "snow_days": " UNION ALL ".join(
        f"SELECT segment, '{c}' AS amount, count(*) AS days, CAST(sum(trips) AS BIGINT) AS trips FROM days WHERE tavg_f IS NOT NULL AND {c} > 0 GROUP BY 1"
        for c in ("snow_inches", "prcp_inches", "snow_depth_inches")
    ),
    "latest_rows": "SELECT date, num_trips, tavg_f, is_rainy FROM joined WHERE date IS NOT NULL ORDER BY date DESC LIMIT 30",
    "holiday_flag": HOLIDAYS,
    "calendar_keys": """SELECT DISTINCT date, CAST(year(date) * 12 + month(date) AS INTEGER) AS ym, CAST(isodow(date) - 1 AS INTEGER) AS dow,
        CAST(dayofweek(date) + 1 AS INTEGER) AS dow_sql, CAST(dayofyear(date) AS INTEGER) AS doy, CAST(CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
        ['Winter','Winter','Spring','Spring','Spring','Summer','Summer','Summer','Fall','Fall','Fall','Winter'][month(date)] AS season,
        date_trunc('month', date)::DATE AS month, date + INTERVAL 7 HOUR AS seven FROM (SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem)""",
    "zero_filled_hours": "SELECT * FROM filled",
    "zero_filled_profile": f"SELECT segment, CASE WHEN isodow(date) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type, hour, {r('avg(trips)', 6)} AS trips FROM filled GROUP BY 1, 2, 3",
    "weekday_rider_profile": " UNION ALL ".join(
        f"SELECT segment, hour, '{label}' AS rider, {r(f'avg({c})', 6)} AS trips FROM filled WHERE isodow(date) < 6 GROUP BY 1, 2"
        for label, c in (("Member", "member"), ("Casual", "casual"))
    ),
    "rain_haircut": f"""SELECT segment, hour, {r('sum(((wet / dry) - 1) * 100 * n_wet) / sum(n_wet)', 6)} AS pct, CAST(sum(n_wet) AS BIGINT) AS n_wet FROM (
        SELECT f.segment, f.hour, month(f.date) AS m, isodow(f.date) >= 6 AS we, avg(f.trips) FILTER (WHERE l.is_raining = 1) AS wet,
          avg(f.trips) FILTER (WHERE l.is_raining = 0) AS dry, count(*) FILTER (WHERE l.is_raining = 1) AS n_wet
        FROM filled f JOIN long_hours l ON f.segment = l.segment AND f.date = l.date AND f.hour = l.hour WHERE l.is_raining IS NOT NULL GROUP BY 1, 2, 3, 4)
      WHERE wet IS NOT NULL AND dry IS NOT NULL GROUP BY 1, 2""",
    "heat_index": f"""SELECT c.segment, c.band, c.hour, {r('c.m / h.m * 100', 6)} AS pct FROM
        (SELECT segment, band, hour, avg(trips) AS m FROM ({{heat}}) GROUP BY 1, 2, 3) c
        JOIN (SELECT segment, hour, avg(trips) AS m FROM ({{heat}}) GROUP BY 1, 2) h ON c.segment = h.segment AND c.hour = h.hour WHERE c.band IS NOT NULL""".replace(
        "{heat}",
        f"SELECT f.segment, f.hour, f.trips, {band('l.temp_f', MODEL_TEMP_EDGES, HOUR_TEMP_LABELS)} AS band FROM filled f JOIN long_hours l ON f.segment = l.segment AND f.date = l.date AND f.hour = l.hour WHERE l.temp_f IS NOT NULL",
    ),
    "complete_hours": """SELECT s.segment, s.ts, h.trips FROM (SELECT segment, unnest(generate_series(min(hour_ts), max(hour_ts), INTERVAL 1 HOUR)) AS ts FROM long_hours GROUP BY 1) s
      LEFT JOIN long_hours h ON h.segment = s.segment AND h.hour_ts = s.ts""",
    "lead_lag_grid": lead_lag("hour_points", "is_raining", "rain", True, "s.segment, s.ts, s.trips, s.is_raining"),
    "lead_lag_all_years": lead_lag("hour_points_all", "num_trips", "trips", False, "s.ts, s.num_trips"),
    "within_day_demean": f"""SELECT segment, date, hour, {r('logy - avg(logy) OVER w', 6)} AS logy, {r('rain - avg(rain) OVER w', 6)} AS is_raining FROM
        (SELECT segment, date, hour, CASE WHEN trips > 0 THEN ln(trips) END AS logy, CAST(is_raining AS DOUBLE) AS rain FROM long_hours) WINDOW w AS (PARTITION BY segment, date)""",
    "climatology_doy": f"SELECT driver, doy, {r('value', 6)} AS value FROM slots",
    "interpolate_doy": f"SELECT driver, doy, {r('value', 6)} AS value FROM ({filled_slots('snow_slots')})",
    "climatology_smooth": f"""SELECT a.driver, a.doy, {r('avg(b.value)', 6)} AS value FROM filled_slots a JOIN filled_slots b ON a.driver = b.driver
      AND (b.doy - a.doy + 7 + 366) % 366 <= 14 GROUP BY 1, 2""",
    "yearly_rollup": f"""SELECT segment, year, {r('actual', 4)} AS actual, {r('adjusted', 4)} AS adjusted, n, {r('weather_pct', 4)} AS weather_pct,
        CASE WHEN weather_pct >= 0 THEN 'favorable' ELSE 'unfavorable' END AS sign FROM adjusted_years""",
    "growth_statement": f"""SELECT segment, prev_year, year, {r('raw', 4)} AS raw_growth, {r('adj', 4)} AS adjusted_growth, {r('adj - raw', 4)} AS gap,
        CASE WHEN abs(adj - raw) >= 0.5 THEN CASE WHEN pw >= weather_pct THEN prev_year ELSE year END END AS favored_year,
        {r('CASE WHEN abs(adj - raw) >= 0.5 THEN greatest(pw, weather_pct) END', 4)} AS favored_pct,
        {r('CASE WHEN abs(adj - raw) >= 0.5 THEN least(pw, weather_pct) END', 4)} AS other_pct,
        CASE WHEN abs(adj - raw) >= 0.5 THEN CASE WHEN adj > raw THEN 'understating' ELSE 'overstating' END END AS direction
      FROM (SELECT b.segment, a.year AS prev_year, b.year, (b.actual / a.actual - 1) * 100 AS raw, (b.adjusted / a.adjusted - 1) * 100 AS adj, a.weather_pct AS pw, b.weather_pct
        FROM adjusted_years b JOIN adjusted_years a ON a.segment = b.segment
         AND a.year = (SELECT max(year) FROM adjusted_years c WHERE c.segment = b.segment AND c.year < b.year)
        WHERE b.year = (SELECT max(year) FROM adjusted_years c WHERE c.segment = b.segment))""",
    "period_kpi": f"""SELECT segment, {r('sum(actual)', 4)} AS actual, {r('sum(adjusted)', 4)} AS adjusted, {r('(sum(actual) / sum(adjusted) - 1) * 100', 4)} AS weather_pct FROM adjusted GROUP BY 1""",
    "adjusted_slice": f"""SELECT date, {r('actual', 6)} AS actual, {r('adjusted', 6)} AS adjusted, CAST(year(date) AS INTEGER) AS year
      FROM adjusted WHERE segment = 'Jersey City only' AND year(date) BETWEEN 1997 AND 1999""",
    "rolling_28d_adjusted": "SELECT segment, date, " + ", ".join(
        f"{r(c, 6)} AS {c}, {r(f'CASE WHEN count({c}) OVER w >= 7 THEN avg({c}) OVER w END', 6)} AS {c}_28" for c in ("actual", "adjusted")
    ) + " FROM adjusted WINDOW w AS (PARTITION BY segment ORDER BY date RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW)",
    "network_intensity": "",
    "intensity_change": "",
    "ols_gram": "",
    "within_slope": f"SELECT n, {r('b', 6)} AS slope FROM slope",
    "hac_variance": "",
    "cluster_variance": f"SELECT count(*) AS groups, CAST(sum(n) AS BIGINT) AS rows, {r('sum(g * g)', 9)} AS variance FROM (SELECT ym, count(*) AS n, sum(psi) AS g FROM psi GROUP BY 1)",
    "model_bands": "",
}


def _network(regions: str) -> str:
    return f"""SELECT CAST(year(month) AS INTEGER) AS year, avg(stations) AS stations, CAST(sum(trips) AS BIGINT) AS trips, count(*) AS months, sum(trips) / avg(stations) AS tps
      FROM (SELECT month, sum(num_stations) AS stations, sum(num_trips) AS trips FROM station_months WHERE region IN ({regions}) GROUP BY 1) GROUP BY 1 HAVING count(*) >= 10"""


CTES["network_both"] = _network("'NYC', 'JC'")
CTES["network_home"] = _network("'NYC'")
BODIES["network_intensity"] = f"SELECT year, {r('stations', 6)} AS stations, trips, months, {r('tps', 6)} AS trips_per_station FROM network_both"
BODIES["intensity_change"] = f"""SELECT prev_year, year, {r('(trips / pt - 1) * 100', 6)} AS trips_pct, {r('(stations / ps - 1) * 100', 6)} AS stations_pct,
    {r('(tps / pp - 1) * 100', 6)} AS trips_per_station_pct FROM (SELECT *, lag(year) OVER w AS prev_year, lag(trips) OVER w AS pt, lag(stations) OVER w AS ps, lag(tps) OVER w AS pp
      FROM network_home WINDOW w AS (ORDER BY year)) WHERE prev_year IS NOT NULL"""
BODIES["five_number"] = BODIES["five_number"].replace("({days})", "days")

# Long form of the design: one row per (day, column index, value).
CTES["design_rows"] = """SELECT date, ym, 0 AS i, 1.0::DOUBLE AS v FROM model_days WHERE x IS NOT NULL AND z IS NOT NULL
  UNION ALL SELECT date, ym, 1, y FROM model_days WHERE x IS NOT NULL AND z IS NOT NULL
  UNION ALL SELECT date, ym, 2, x FROM model_days WHERE x IS NOT NULL AND z IS NOT NULL
  UNION ALL SELECT date, ym, 3, z FROM model_days WHERE x IS NOT NULL AND z IS NOT NULL
  UNION ALL SELECT date, ym, 4 + dow, 1.0 FROM model_days WHERE x IS NOT NULL AND z IS NOT NULL"""
CTES["design_months"] = "SELECT ym, i, sum(v) AS v, count(DISTINCT date) AS days FROM design_rows GROUP BY 1, 2"
BODIES["ols_gram"] = f"""SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {r('sum(raw)', 4)} AS raw, {r('sum(absorbed)', 4)} AS absorbed FROM (
    SELECT a.i, b.i AS j, a.v * b.v AS raw, 0.0 AS absorbed FROM design_rows a JOIN design_rows b ON a.date = b.date AND a.i <= b.i
    UNION ALL SELECT a.i, b.i, 0.0, a.v * b.v / n.v FROM design_months a JOIN design_months b ON a.ym = b.ym AND a.i <= b.i JOIN design_months n ON n.ym = a.ym AND n.i = 0)
  GROUP BY 1, 2"""
_WEIGHTED = " + ".join(
    f"{(HAC_MAX_LAGS + 1 - k)}::DOUBLE / {HAC_MAX_LAGS + 1} * coalesce(lag(psi, {k}) OVER (ORDER BY date), 0)" for k in range(1, HAC_MAX_LAGS + 1)
)
BODIES["hac_variance"] = f"""SELECT contrast, {r('sum(w * w * psi * (psi + 2 * behind))', 9)} AS variance
  FROM (SELECT psi, {_WEIGHTED} AS behind FROM psi), (VALUES ('wind', 1.0::DOUBLE), ('ten', 10.0::DOUBLE)) c(contrast, w) GROUP BY 1"""
CTES["holiday_list"] = HOLIDAYS[HOLIDAYS.index("years AS"):HOLIDAYS.index("SELECT date, n,")].join(["WITH ", "SELECT h FROM holidays"])
BODIES["model_bands"] = f"""SELECT {band('tavg_f', MODEL_TEMP_EDGES, MODEL_TEMP_LABELS)} AS temp_band, {band('prcp_inches', RAIN_EDGES, RAIN_LABELS)} AS rain_band,
    CASE WHEN date IN (SELECT h FROM holiday_list) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS holiday, count(*) AS n, {r('avg(ln(num_trips))', 6)} AS mean_log
  FROM joined WHERE date IS NOT NULL AND num_trips > 0 AND tavg_f IS NOT NULL AND wind_avg_mph IS NOT NULL AND prcp_inches IS NOT NULL GROUP BY 1, 2, 3"""


CTES |= fits.impact_ctes(band) | fits.hourly_ctes() | fits.adjusted_ctes() | fits.lowess_ctes() | fits.lowess_ctes(frac="0.4", p_="la_")
BODIES |= {
    "fit_impacts": fits.impacts_sql(r),
    "fit_humidity": fits.humidity_sql(r),
    "rain_profile": fits.profile_sql(r),
    "rain_daypart": fits.daypart_sql(r),
    "weather_adjusted_trips": fits.adjusted_sql(r),
    "lowess_grid": fits.lowess_sql(r),
    "lowess_fit": fits.lowess_fit_sql(r),
    "fit_impacts_meta": fits.impacts_meta_sql(r),
    "rain_totals": fits.totals_sql(lambda e, d: f"CASE WHEN abs({e}) >= 1e6 THEN {r(e, 0)} ELSE {r(e, d)} END"),
    "empty_years": "SELECT m AS model, (SELECT count(*) FROM joined WHERE year(date) IN (1850, 1851)) AS n FROM (VALUES ('adjusted'), ('impacts'), ('profile'), ('dayparts')) t(m)",
}
CTES |= upkeep.lowess_ctes()
CTES |= upkeep.closed_ctes(CTES["event_trips"], hour_mart) | upkeep.LOADS_CTES | upkeep.station_rows(OWNED, name_key)
BODIES |= {
    "near_collinear_slopes": f"SELECT name, {r('slope', 3)} AS slope FROM ({upkeep.NEAR_COLLINEAR})",
    "lowess_observations": upkeep.lowess_sql(r),
    "hourly_trips_closed": upkeep.CLOSED,
    "daily_trips_three_loads": upkeep.LOADS,
    "median_rollups": upkeep.medians(OWNED),
    "catalog_views": f"SELECT *, 3::BIGINT AS sources FROM ({day_mart('trips', OWNED + chr(32) + upkeep.PRESENT)})",
    "observation_pivot_bucketed": "SELECT * FROM wide",
    "daily_trips_weather_bucketed": "SELECT * FROM joined",
    "catalog_station_view": "SELECT * FROM station_months",
    "catalog_hourly_views": "SELECT * FROM hour_joined",
    "snapshot_descriptions": upkeep.descriptions(WEATHER_DAILY_HOME_COLUMNS, COLUMN_DESCRIPTIONS["weather_daily_nyc"]),
    "trip_files_one_scan": upkeep.one_scan(RAW_CELLS),
    "station_totals_merged": upkeep.STATION_TOTALS,
    "stations_between_years": upkeep.STATIONS_KEPT,
}


def _finish(body: str) -> str:
    """Merge the shared CTEs with a body that brings its own WITH."""
    own = body.lstrip()
    if own.startswith("WITH "):
        shared = with_ctes(own)
        if shared == own:
            return own
        head = shared[: -len(own)].rstrip()
        return head + ",\n" + own[len("WITH "):]
    return with_ctes(own)


ORACLE_SQL: dict[str, str] = {name: _finish(body) for name, body in BODIES.items()}
