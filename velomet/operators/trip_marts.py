"""Day, hour and month marts of the canonical trips.

Each mart is one shuffle on its grain key with partial aggregation below it, so the rows that
travel number tasks x keys, not trips, and a very busy day or region costs no more than a
quiet one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from velomet.fixed_values import CURRENT_ERA_START, TRIP_COUNTS
from velomet.functions.calendar import clock_hour, month_start
from velomet.functions.text import name_key
from velomet.functions.units import steady_round
from velomet.operators.unify import owned_rows

MEDIAN_ACCURACY = 10000


def _counts() -> list[Column]:
    named = [F.count_if(F.expr(condition)).alias(name) for name, condition in TRIP_COUNTS]
    return [F.count(F.lit(1)).alias("num_trips"), *named]


def _mean_minutes() -> Column:
    return steady_round(F.avg("trip_duration_seconds") / 60, 3).alias("avg_trip_duration_minutes")


def _mean_distance() -> Column:
    return steady_round(F.avg("distance_meters"), 1).alias("avg_distance_meters")


def hour_measures() -> list[Column]:
    """Counts and means of one hour's trips."""
    return [*_counts(), _mean_minutes(), _mean_distance()]


def daily_trips(trips: DataFrame, cutover: str = CURRENT_ERA_START) -> DataFrame:
    """One row per local day. The median is a mergeable sketch, lower middle for even counts."""
    median = F.percentile_approx("trip_duration_seconds", 0.5, MEDIAN_ACCURACY)
    return (
        owned_rows(trips, cutover)
        .groupBy(F.to_date("start_time").alias("date"))
        .agg(
            *_counts(),
            _mean_minutes(),
            steady_round(median / 60, 3).alias("median_trip_duration_minutes"),
            _mean_distance(),
        )
    )


def hourly_trips(trips: DataFrame, cutover: str = CURRENT_ERA_START) -> DataFrame:
    """One row per local clock hour with at least one trip."""
    hours = owned_rows(trips, cutover).groupBy(clock_hour(F.col("start_time")).alias("hour_ts"))
    mart = hours.agg(*hour_measures())
    keys = [
        "hour_ts",
        F.to_date("hour_ts").alias("date"),
        F.hour("hour_ts").alias("hour"),
    ]
    return mart.select(*keys, *[c for c in mart.columns if c != "hour_ts"])


def station_counts_monthly(trips: DataFrame, cutover: str = CURRENT_ERA_START) -> DataFrame:
    """Active stations, by normalized name, and trips per month and region.

    Trips are first counted per (month, region, name as written). Folding the name then costs one
    pattern per spelling instead of one per trip, and the distinct step sees a few rows per
    station even when a single region holds most trips.
    """
    per_spelling = (
        owned_rows(trips, cutover)
        .filter(F.col("start_station_name").isNotNull())
        .groupBy(
            month_start(F.to_date("start_time")).alias("month"), "region", "start_station_name"
        )
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    return per_spelling.groupBy("month", "region").agg(
        F.count_distinct(name_key(F.col("start_station_name"))).alias("num_stations"),
        F.sum("trips").alias("num_trips"),
    )


def station_key_comparison(
    trips: DataFrame,
    region: str = "NYC",
    years: tuple[int, int] = (2018, 2025),
    cutover: str = CURRENT_ERA_START,
) -> DataFrame:
    """Distinct stations per year under three rival keys: id, name, coordinates to 3 places.

    Trips are reduced to distinct key combinations before the three distinct counts, which
    would otherwise triple every trip row below the shuffle.
    """
    lat, lon = F.col("start_station_latitude"), F.col("start_station_longitude")
    point = F.struct(steady_round(lat, 3).alias("lat"), steady_round(lon, 3).alias("lon"))
    keys = (
        owned_rows(trips, cutover)
        .filter((F.col("region") == region) & F.col("start_station_name").isNotNull())
        .filter(F.col("start_time") >= F.lit(f"{years[0]:04d}-01-01 00:00:00").cast("timestamp_ntz"))
        .filter(F.col("start_time") < F.lit(f"{years[1] + 1:04d}-01-01 00:00:00").cast("timestamp_ntz"))
        .select(
            F.year("start_time").alias("year"),
            F.col("start_station_id").alias("id"),
            F.when(lat.isNotNull() & lon.isNotNull(), point).alias("point"),
            F.col("start_station_name").alias("name"),
        )
        .distinct()
    )
    return keys.groupBy("year").agg(
        F.count_distinct("id").alias("by_raw_id"),
        F.count_distinct(name_key(F.col("name"))).alias("by_name"),
        F.count_distinct("point").alias("by_latlng"),
    )


def join_daily_weather(daily: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily mart with the weather of the same day; days without weather keep NULLs.

    Both sides have one row per day. No broadcast hint: the adaptive planner picks it from the
    measured size of the weather side.
    """
    return daily.join(weather, "date", "left")


def join_hourly_weather(hourly: DataFrame, hour_weather: DataFrame) -> DataFrame:
    """Hourly mart with the collapsed weather of the same local clock hour."""
    return hourly.join(
        hour_weather, hourly["hour_ts"] == hour_weather["hour_dt"], "left"
    ).drop("hour_dt")
