"""Long daily observations to the wide daily weather mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from velomet.fixed_values import (
    DAILY_ELEMENTS,
    DAILY_FLAGS,
    DAILY_MEAN_ELEMENT,
    HOME_STATION,
)
from velomet.functions.calendar import season
from velomet.functions.flags import degree_days, three_valued
from velomet.functions.units import fahrenheit, inches, miles_per_hour, steady_round
from velomet.operators.spatial import points_in_polygons
from velomet.sources.weather_files import daily_elements

# Column order of the marts.
WEATHER_DAILY_COLUMNS = [
    "date", "year", "month", "day", "day_of_week", "is_weekend", "season",
    "station_name", "city", "state", "zip_code", "county_name", "longitude", "latitude", "geo_coord",
    "tmin_c", "tmax_c", "tavg_c", "tmin_f", "tmax_f", "tavg_f",
    "prcp_mm", "prcp_inches", "snow_mm", "snow_inches",
    "is_rainy", "is_snowy", "is_hot_day", "is_freezing",
    "heating_degree_days", "cooling_degree_days",
    "snow_depth_mm", "snow_depth_inches", "rh_avg", "rh_min", "rh_max", "is_humid",
    "dewpoint_c", "dewpoint_f", "wetbulb_c", "wetbulb_f",
    "sea_level_pressure_hpa", "station_pressure_hpa",
    "wind_avg_ms", "wind_avg_mph", "wind_gust_ms", "wind_gust_mph", "wind_dir_deg",
    "is_foggy", "is_thunder", "is_hazy", "station_id",
]
WEATHER_DAILY_HOME_COLUMNS = [
    "date", "year", "month", "day", "day_of_week", "is_weekend", "season",
    "tmin_f", "tmax_f", "tavg_f", "prcp_inches", "snow_inches",
    "is_rainy", "is_snowy", "is_hot_day", "is_freezing",
    "snow_depth_inches", "rh_avg", "rh_min", "rh_max", "is_humid",
    "dewpoint_f", "wetbulb_f", "sea_level_pressure_hpa",
    "wind_avg_mph", "wind_gust_mph", "wind_dir_deg",
    "is_foggy", "is_thunder", "is_hazy",
]


def _reported(element: str, divisor: float) -> Column:
    """Largest good-quality value of one element in the group, NULL when there is none."""
    good = (F.col("element") == element) & F.col("qflag").isNull()
    return F.max(F.when(good, F.col("value").cast("double") / F.lit(divisor)))


def pivot_observations(observations: DataFrame) -> DataFrame:
    """One row per (station, day): every element in one pass of conditional maxima.

    Filters on station prefix and element apply before the shuffle. All aggregates are partial,
    so a station that dominates the input still sends one row per task and day.
    """
    measures = [_reported(code, divisor).alias(name) for name, code, divisor in DAILY_ELEMENTS]
    flags = [
        F.max(F.when((F.col("element") == code) & F.col("qflag").isNull(), 1).otherwise(0)).alias(name)
        for name, code in DAILY_FLAGS
    ]
    mean = F.coalesce(
        _reported(DAILY_MEAN_ELEMENT, 10.0), (_reported("TMAX", 10.0) + _reported("TMIN", 10.0)) / 2
    )
    return (
        observations.filter(F.col("id").startswith("US") & F.col("element").isin(daily_elements()))
        .groupBy(F.col("id").alias("station_id"), "date")
        .agg(mean.alias("tavg_c"), *measures, *flags)
    )


def derive_daily(wide: DataFrame) -> DataFrame:
    """Calendar context, imperial units, three-valued flags and degree days."""
    c = F.col
    date = c("date")
    own = {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": F.dayofweek(date),
        "is_weekend": F.dayofweek(date).isin(1, 7).cast("int"),
        "season": season(date),
        "tavg_c": steady_round(c("tavg_c"), 1),
        "prcp_inches": steady_round(inches(c("prcp_mm")), 2),
        "snow_inches": steady_round(inches(c("snow_mm")), 1),
        "snow_depth_inches": steady_round(inches(c("snow_depth_mm")), 1),
        "is_rainy": three_valued(c("prcp_mm"), c("prcp_mm") > 0),
        "is_snowy": three_valued(c("snow_mm"), c("snow_mm") > 0),
        "is_hot_day": three_valued(c("tmax_c"), fahrenheit(c("tmax_c")) > 90),
        "is_freezing": three_valued(c("tmin_c"), fahrenheit(c("tmin_c")) < 32),
        "is_humid": three_valued(c("rh_avg"), c("rh_avg") >= 70),
        "heating_degree_days": steady_round(degree_days(fahrenheit(c("tavg_c")), True), 1),
        "cooling_degree_days": steady_round(degree_days(fahrenheit(c("tavg_c")), False), 1),
        "dewpoint_c": steady_round(c("dewpoint_c"), 1),
        "wetbulb_c": steady_round(c("wetbulb_c"), 1),
        "sea_level_pressure_hpa": steady_round(c("slp_hpa"), 1),
        "station_pressure_hpa": steady_round(c("stp_hpa"), 1),
        "wind_avg_ms": steady_round(c("wind_avg_ms"), 1),
        "wind_avg_mph": steady_round(miles_per_hour(c("wind_avg_ms")), 1),
        "wind_gust_ms": steady_round(c("wind_gust_ms"), 1),
        "wind_gust_mph": steady_round(miles_per_hour(c("wind_gust_ms")), 1),
    }
    for name in ("tmin", "tmax", "tavg", "dewpoint", "wetbulb"):
        own[f"{name}_f"] = steady_round(fahrenheit(c(f"{name}_c")), 1)
    present = set(wide.columns)
    return wide.select(
        *[
            (own[name] if name in own else c(name)).alias(name)
            for name in WEATHER_DAILY_COLUMNS
            if name in own or name in present
        ]
    )


def station_map(stations: DataFrame, zip_areas: DataFrame, counties: DataFrame) -> DataFrame:
    """Each located US station with one ZIP area and one county that contain it.

    A station inside several areas keeps the smallest (zip, county), and a station listed several times
    the smallest of its rows. Those are minima, so they are aggregated rather than ranked; stations
    outside every area drop out.
    """
    listed = stations.filter(
        F.col("id").startswith("US") & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )
    columns = ["name", "longitude", "latitude", "state"]
    located = listed.groupBy("id").agg(F.min(F.struct(*columns)).alias("s")).select("id", *[f"s.{c}" for c in columns])
    in_zip = points_in_polygons(located, zip_areas, "id", ["zip_code", "city"])
    in_county = points_in_polygons(located, counties, "id", ["county_name"])
    first_zip = in_zip.groupBy("id").agg(F.min(F.struct("zip_code", "city")).alias("z"))
    first_county = in_county.groupBy("id").agg(F.min("county_name").alias("county_name"))
    return (
        located.join(first_zip, "id")
        .join(first_county, "id")
        .select(
            F.col("id").alias("station_id"),
            F.col("name").alias("station_name"),
            "longitude",
            "latitude",
            F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat")).alias("geo_coord"),
            "z.zip_code",
            "z.city",
            "state",
            "county_name",
        )
    )


def weather_daily(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """All stations: wide daily weather with the station's place. ``stations`` is a station map."""
    return derive_daily(pivot_observations(observations).join(stations, "station_id"))


def weather_daily_home(
    weather: DataFrame, station: str = HOME_STATION, newest_first: bool = True
) -> DataFrame:
    """One station's slice in the 30-column layout the trip marts join to."""
    home = weather.filter(F.col("station_id") == station).select(*WEATHER_DAILY_HOME_COLUMNS)
    return home.orderBy(F.desc("date")) if newest_first else home
