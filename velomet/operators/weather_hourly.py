"""Hourly observations: local time, imperial units, and one row per clock hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from velomet.fixed_values import (
    LOCAL_TIME_ZONE,
    PRESENT_WEATHER_CODES,
    ROUTINE_REPORT,
    STANDARD_TIME_ZONE,
)
from velomet.functions.calendar import clock_hour
from velomet.functions.text import present_weather_flag
from velomet.functions.units import fahrenheit, inches, miles, miles_per_hour, steady_round

FLAGS = list(PRESENT_WEATHER_CODES)


def local_time(standard: Column) -> Column:
    """Local standard time to the daylight-saving wall clock trips are stamped in."""
    return F.convert_timezone(F.lit(STANDARD_TIME_ZONE), F.lit(LOCAL_TIME_ZONE), standard)


def utc_time(standard: Column) -> Column:
    return F.convert_timezone(F.lit(STANDARD_TIME_ZONE), F.lit("UTC"), standard)


def weather_hourly(observations: DataFrame) -> DataFrame:
    """Observation-level view: local keys, imperial values, falling-now flags, SI originals."""
    c = F.col
    with_time = observations.withColumn("obs_time_utc", utc_time(c("obs_time_lst"))).withColumn(
        "obs_time_local", local_time(c("obs_time_lst"))
    )
    return with_time.select(
        "station_id",
        "report_type",
        "obs_time_lst",
        "obs_time_utc",
        "obs_time_local",
        F.to_date("obs_time_local").alias("date_local"),
        F.hour("obs_time_local").alias("hour_local"),
        steady_round(fahrenheit(c("temp_c")), 1).alias("temp_f"),
        steady_round(fahrenheit(c("dewpoint_c")), 1).alias("dewpoint_f"),
        steady_round(fahrenheit(c("wetbulb_c")), 1).alias("wetbulb_f"),
        "rh_pct",
        steady_round(inches(c("precip_mm")), 3).alias("prcp_inches"),
        c("slp_hpa").alias("sea_level_pressure_hpa"),
        steady_round(miles_per_hour(c("wind_speed_ms")), 1).alias("wind_mph"),
        steady_round(miles_per_hour(c("wind_gust_ms")), 1).alias("wind_gust_mph"),
        "wind_dir_deg",
        steady_round(miles(c("visibility_km")), 1).alias("visibility_miles"),
        *[present_weather_flag(c("present_weather"), flag).alias(flag) for flag in FLAGS],
        "sky_conditions",
        "present_weather",
        "temp_c",
        "dewpoint_c",
        "wetbulb_c",
        "precip_mm",
        "wind_speed_ms",
        "wind_gust_ms",
        "visibility_km",
        "source_file",
    )


def collapse_hours(observations: DataFrame) -> DataFrame:
    """One row per local clock hour, keyed ``hour_dt``.

    The routine report is the hour's reading; specials only fill hours without one. Their
    precipitation overlaps the routine total, so such an hour takes the largest. Gusts and flags
    take the hour's maximum. A repeated hour in autumn averages both of its readings. Means are
    rounded to six digits, so that a mean on the edge of a band lies there whatever the order of its readings.
    """

    def preferred(name: str, fallback=F.avg) -> Column:
        routine = F.when(F.col("report_type") == ROUTINE_REPORT, F.col(name))
        return steady_round(F.coalesce(F.avg(routine), fallback(F.col(name))), 6).alias(name)

    return observations.groupBy(clock_hour(F.col("obs_time_local")).alias("hour_dt")).agg(
        preferred("temp_f"),
        preferred("dewpoint_f"),
        preferred("wetbulb_f"),
        preferred("rh_pct"),
        preferred("prcp_inches", F.max),
        preferred("wind_mph"),
        F.max("wind_gust_mph").alias("wind_gust_mph"),
        preferred("visibility_miles"),
        *[F.max(flag).alias(flag) for flag in FLAGS],
    )
