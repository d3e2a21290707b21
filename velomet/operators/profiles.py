"""Descriptive answers on the daily and hourly frames.

Inputs are day or hour rows in long form (see ``series.by_segment``). ``by`` names the series
columns; every answer is computed for all series in one pass. Exact medians and quartiles keep
one counter per distinct value of a group, which the calendar bounds at this grain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from velomet.fixed_values import (
    COMFORT_EDGES,
    COMFORT_LABELS,
    DISPLAY_TEMP_EDGES,
    DISPLAY_TEMP_LABELS,
    HOUR_TEMP_LABELS,
    MIN_YEAR_DAYS,
    MIN_YEAR_MONTHS,
    MODEL_TEMP_EDGES,
    WARM_DAY_F,
    WIND_EDGES,
    WIND_LABELS,
)
from velomet.functions.bands import band
from velomet.functions.calendar import day_type, is_weekend
from velomet.functions.units import percent_change
from velomet.operators.series import previous_value, rolling_day_mean

SEGMENT = ("segment",)


def temperature_band_means(d: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Mean trips, member and casual trips per display temperature band."""
    label = band(F.col("tavg_f"), DISPLAY_TEMP_EDGES, DISPLAY_TEMP_LABELS)
    return (
        d.withColumn("band", label)
        .filter(F.col("band").isNotNull())
        .groupBy(*by, "band")
        .agg(*[F.avg(c).alias(c) for c in ("trips", "member", "casual")])
    )


def rider_mix(means: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Member and casual columns as (rider, trips) rows."""
    return means.select(
        *keys, F.col("member").alias("Member"), F.col("casual").alias("Casual")
    ).unpivot(list(keys), ["Member", "Casual"], "rider", "trips")


def wind_band_medians(d: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Median ridership index per wind band."""
    return _index_medians(d, band(F.col("wind_avg_mph"), WIND_EDGES, WIND_LABELS), by)


def comfort_band_medians(d: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Median ridership index per dew-point comfort band, warm days only."""
    warm = d.filter(F.col("tavg_f") >= WARM_DAY_F)
    return _index_medians(warm, band(F.col("dewpoint_f"), COMFORT_EDGES, COMFORT_LABELS), by)


def _index_medians(d: DataFrame, label: Column, by: Sequence[str]) -> DataFrame:
    return (
        d.withColumn("band", label)
        .filter(F.col("band").isNotNull() & F.col("ridership_index").isNotNull())
        .groupBy(*by, "band")
        .agg(F.median("ridership_index").alias("ridership_index"))
    )


def day_type_profile(filled: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Mean trips by day type and hour, on zero-filled hours."""
    return filled.groupBy(*by, day_type(F.col("date")).alias("day_type"), "hour").agg(
        F.avg("trips").alias("trips")
    )


def weekday_rider_profile(filled: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Mean weekday trips by hour for each rider type."""
    means = (
        filled.filter(F.weekday("date") < 5)
        .groupBy(*by, "hour")
        .agg(F.avg("member").alias("member"), F.avg("casual").alias("casual"))
    )
    return rider_mix(means, [*by, "hour"])


def known_hours(hourly: DataFrame, column: str) -> DataFrame:
    """Hours with trips on which a weather column was reported.

    Zero-filled hours are absent from the mart and so carry no weather; attaching weather to the
    filled grid and dropping hours without it leaves exactly these rows, with no grid and no join.
    """
    return hourly.filter(F.col(column).isNotNull())


def rain_haircut(cells: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Loss in rain by hour, comparing like with like.

    Within (month, weekend, hour) wet hours are compared to dry ones; cells lacking either drop.
    The cells of an hour are averaged weighted by their number of wet hours.
    """
    wet, dry = F.col("is_raining") == 1, F.col("is_raining") == 0
    trips = F.col("trips")
    cell = (
        cells.groupBy(
            *by, F.month("date").alias("month"), is_weekend(F.col("date")).alias("weekend"), "hour"
        )
        .agg(
            F.avg(F.when(wet, trips)).alias("wet"),
            F.avg(F.when(dry, trips)).alias("dry"),
            F.count_if(wet).alias("n_wet"),
        )
        .filter("wet IS NOT NULL AND dry IS NOT NULL")
        .withColumn("pct", percent_change(F.col("wet"), F.col("dry")))
    )
    weighted = F.sum(F.col("pct") * F.col("n_wet"))
    return cell.groupBy(*by, "hour").agg(
        F.try_divide(weighted, F.sum("n_wet")).alias("pct"), F.sum("n_wet").alias("n_wet")
    )


def heat_index(cells: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Mean trips per (temperature band, hour) as percent of the hour's overall mean."""
    per_band = (
        cells.withColumn("band", band(F.col("temp_f"), MODEL_TEMP_EDGES, HOUR_TEMP_LABELS))
        .groupBy(*by, "band", "hour")
        .agg(F.sum("trips").alias("total"), F.count("trips").alias("n"))
    )
    hour = Window.partitionBy(*by, "hour")
    norm = F.sum("total").over(hour) / F.sum("n").over(hour)
    return (
        per_band.withColumn("norm", norm)
        .filter(F.col("band").isNotNull())
        .select(*by, "band", "hour", (F.try_divide(F.col("total") / F.col("n"), F.col("norm")) * 100).alias("pct"))
    )


def month_year_mean(d: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Mean trips per (month, year), long form."""
    return d.groupBy(*by, F.month("date").alias("month"), F.year("date").alias("year")).agg(
        F.avg("trips").alias("trips")
    )


def month_year_table(d: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Months as 12 rows, years as columns; cells without days are NULL.

    Without ``years``, every year that occurs has a column; that takes a job over the daily mart.
    """
    if years is None:
        years = [r["year"] for r in d.select("year").distinct().orderBy("year").collect() if r["year"] is not None]
    months = d.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    means = (
        d.groupBy(F.month("date").alias("month"))
        .pivot("year", list(years))
        .agg(F.avg("trips"))
    )
    return months.join(means, "month", "left")


def calendar_month_mean(d: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Mean trips per calendar month, in month order."""
    return (
        d.groupBy(*by, F.month("date").alias("m"), F.date_format("date", "MMMM").alias("month"))
        .agg(F.avg("trips").alias("trips"))
        .orderBy(*by, "m")
    )


def five_number(d: DataFrame, value: str = "trips", by: Sequence[str] = ("segment", "condition")) -> DataFrame:
    """Box-plot numbers per group: quartiles, extremes, and whiskers at 1.5 interquartile ranges.

    A whisker ends at the furthest value within the fence. Quartiles interpolate linearly over counts per
    distinct value, which tasks sum up before they meet; the few rows they make join the values again.
    """
    values = d.dropna(subset=[value, *by]).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    quartiles = values.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(
        *[F.percentile(value, F.lit(k / 4), F.col("_n")).alias(f"_q{k}") for k in (1, 2, 3)]
    )
    known = values.join(quartiles, [F.col(c) == F.col(f"_{c}") for c in by])
    reach = 1.5 * (F.col("_q3") - F.col("_q1"))
    inside = F.col(value).between(F.col("_q1") - reach, F.col("_q3") + reach)
    within = F.when(inside, F.col(value))
    return known.groupBy(*by).agg(
        F.sum("_n").alias("n"),
        F.first("_q1").alias("q1"),
        F.first("_q2").alias("median"),
        F.first("_q3").alias("q3"),
        F.min(value).cast("double").alias("low"),
        F.max(value).cast("double").alias("high"),
        F.min(within).cast("double").alias("whisker_low"),
        F.max(within).cast("double").alias("whisker_high"),
    )


def headline(d: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Total, days, mean per day, and how many times busier warm days are than cold ones."""
    warm = F.avg(F.when(F.col("tavg_f") >= 65, F.col("trips")))
    cold = F.avg(F.when(F.col("tavg_f") < 40, F.col("trips")))
    return d.groupBy(*by).agg(
        F.sum("trips").alias("total"),
        F.count(F.lit(1)).alias("days"),
        F.avg("trips").alias("per_day"),
        F.try_divide(warm, cold).alias("warm_cold_ratio"),
    )


def sub_population(d: DataFrame, column: str) -> DataFrame:
    """Days on which a measured amount is above zero."""
    return d.filter(F.col(column) > 0)


def amount_days(d: DataFrame, amounts: Sequence[str], by: Sequence[str] = SEGMENT) -> DataFrame:
    """Days and trips on which each amount is above zero, all amounts in one pass."""
    rows = F.array(*[F.struct(F.lit(c).alias("amount"), F.col(c).alias("measured")) for c in amounts])
    return (
        sub_population(d.select(*by, "trips", F.inline(rows)), "measured")
        .groupBy(*by, "amount")
        .agg(F.count(F.lit(1)).alias("days"), F.sum("trips").alias("trips"))
    )


# ---------------------------------------------------------------- adjusted ridership
def adjusted_slice(
    adjusted: DataFrame, daily: DataFrame, trips_col: str, first_year: int, last_year: int
) -> DataFrame:
    """Adjusted days that the daily mart holds, from the first day with trips, in a year range.

    The launch day travels as a scalar subquery: one value, no join.
    """
    launch = daily.filter(F.col(trips_col) > 0).select(F.min("date").alias("launch"))
    days = daily.select("date", F.year("date").alias("year"))
    return adjusted.join(days, "date").filter(
        F.col("year").between(first_year, last_year) & (F.col("date") >= launch.scalar())
    )


def period_totals(adjusted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Actual and adjusted totals and the weather's share in percent."""
    return adjusted.groupBy(*by).agg(
        F.sum("actual").alias("actual"),
        F.sum("adjusted").alias("adjusted"),
        percent_change(F.sum("actual"), F.sum("adjusted")).alias("weather_pct"),
    )


def rolling_adjusted(adjusted: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """28-day means of actual and adjusted trips."""
    for name in ("actual", "adjusted"):
        adjusted = rolling_day_mean(adjusted, name, 28, f"{name}_28", series)
    return adjusted


def yearly_totals(adjusted: DataFrame, by: Sequence[str] = (), min_days: int = MIN_YEAR_DAYS) -> DataFrame:
    """Near-complete years: totals, days, weather percent, and whether weather helped."""
    weather = percent_change(F.col("actual"), F.col("adjusted"))
    return (
        adjusted.groupBy(*by, F.year("date").alias("year"))
        .agg(
            F.sum("actual").alias("actual"),
            F.sum("adjusted").alias("adjusted"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter(F.col("n") >= min_days)
        .withColumn("weather_pct", weather)
        .withColumn("sign", F.when(F.col("weather_pct") >= 0, "favorable").otherwise("unfavorable"))
    )


def growth_statement(years: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Last near-complete year against the one before, on paper and net of weather.

    A gap of at least half a point names the year the weather favoured and whether the figure
    on paper under- or overstates growth.
    """
    prev = previous_value(years, ["year", "actual", "adjusted", "weather_pct"], "year", by)
    last = Window.partitionBy(*by).orderBy(F.desc("year"))
    pair = (
        prev.withColumn("nth", F.row_number().over(last))
        .filter("nth = 1 AND prev_year IS NOT NULL")
        .withColumn("raw_growth", percent_change(F.col("actual"), F.col("prev_actual")))
        .withColumn("adjusted_growth", percent_change(F.col("adjusted"), F.col("prev_adjusted")))
        .withColumn("gap", F.col("adjusted_growth") - F.col("raw_growth"))
    )
    uneven = F.abs("gap") >= 0.5
    earlier = F.col("prev_weather_pct") >= F.col("weather_pct")
    return pair.select(
        *by,
        "prev_year",
        "year",
        "raw_growth",
        "adjusted_growth",
        "gap",
        F.when(uneven, F.when(earlier, F.col("prev_year")).otherwise(F.col("year"))).alias("favored_year"),
        F.when(uneven, F.greatest("prev_weather_pct", "weather_pct")).alias("favored_pct"),
        F.when(uneven, F.least("prev_weather_pct", "weather_pct")).alias("other_pct"),
        F.when(uneven, F.when(F.col("gap") > 0, "understating").otherwise("overstating")).alias("direction"),
    )


def network_intensity(
    station_counts: DataFrame, regions: Sequence[str], min_months: int = MIN_YEAR_MONTHS
) -> DataFrame:
    """Stations, trips and trips per station for near-complete years."""
    per_month = (
        station_counts.filter(F.col("region").isin(*regions))
        .groupBy("month")
        .agg(F.sum("num_stations").alias("stations"), F.sum("num_trips").alias("trips"))
    )
    return (
        per_month.groupBy(F.year("month").alias("year"))
        .agg(
            F.avg("stations").alias("stations"),
            F.sum("trips").alias("trips"),
            F.count(F.lit(1)).alias("months"),
        )
        .filter(F.col("months") >= min_months)
        .withColumn("trips_per_station", F.col("trips") / F.col("stations"))
    )


def intensity_change(network: DataFrame) -> DataFrame:
    """Each year against the one before: trips = stations x trips per station, in percent."""
    names = ["trips", "stations", "trips_per_station"]
    prev = previous_value(network, ["year", *names], "year")
    return prev.filter("prev_year IS NOT NULL").select(
        "prev_year",
        "year",
        *[percent_change(F.col(n), F.col(f"prev_{n}")).alias(f"{n}_pct") for n in names],
    )
