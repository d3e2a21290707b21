"""Trips net of the weather: expected, weather effect and adjusted trips per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from velomet.fixed_values import CLIMATOLOGY_DRIVERS, RAIN_CAP_INCHES, SNOW_CAP_INCHES
from velomet.functions.flags import clip
from velomet.operators.climatology import fill_from_normals, normals
from velomet.operators.regression import Design, collect_moments, solve
from velomet.operators.splines import quantile_knots
from velomet.plans.daily_impacts import WEEKDAYS, calendar_outcome
from velomet.session import checkpoint_dir

SPLINE_COLUMNS = 5
_SPLINE = [f"bs{k}" for k in range(1, SPLINE_COLUMNS + 1)]
_LINEAR = [c for c in CLIMATOLOGY_DRIVERS if c != "tavg_f"]

ADJUSTED_SCHEMA = "date date, actual double, expected double, weather_effect double, adjusted double"
ADJUSTED_DESIGN = Design(
    outcome="logy",
    numbers=("holiday", *_SPLINE, *_LINEAR),
    levels={"dow": WEEKDAYS},
    absorb=("ym",),
)


def kpi_frame(daily: DataFrame, trips_col: str) -> DataFrame:
    """Days with trips and their drivers, unreported weather kept NULL."""
    measured = ["prcp_inches", "snow_inches", "snow_depth_inches", "is_thunder", "is_foggy", "tavg_f", "wind_avg_mph"]
    rows = calendar_outcome(daily, trips_col).withColumns({c: F.col(c).cast("double") for c in measured})
    prcp = F.col("prcp_inches")
    return rows.withColumns(
        {
            "prcp_cap": clip(prcp, 0.0, RAIN_CAP_INCHES),
            "rain01": F.when(prcp.isNotNull(), (prcp > 0).cast("double")),
            "snow_cap": clip(F.col("snow_inches"), 0.0, SNOW_CAP_INCHES),
        }
    ).select("date", "y", "logy", "ym", "dow", "holiday", *CLIMATOLOGY_DRIVERS)


def weather_adjusted_daily(daily: DataFrame, trips_col: str) -> DataFrame:
    """One row per day: date, actual, expected, weather_effect, adjusted.

    The model is fitted once, on drivers filled from their day-of-year normals. The month
    effect, being absorbed, is recovered as the month's mean residual; it cancels in the weather
    effect, which compares the day's weather to the normal of its day of year. No days, or none with a
    temperature, give no rows. The day rows are checkpointed because normals, knots, fit and result each read them: trips are scanned once.
    """
    checkpoint_dir(daily.sparkSession)
    days = kpi_frame(daily, trips_col).checkpoint()
    filled = fill_from_normals(days, normals(days, CLIMATOLOGY_DRIVERS), CLIMATOLOGY_DRIVERS)
    knots = quantile_knots(filled, "tavg_f", SPLINE_COLUMNS)
    if knots is None:
        return daily.sparkSession.createDataFrame([], ADJUSTED_SCHEMA)
    model = filled.withColumns(dict(zip(_SPLINE, knots.basis(F.col("tavg_f")))))
    weights = solve(collect_moments(model, ADJUSTED_DESIGN)).weights
    normal = dict(zip(_SPLINE, knots.basis(F.col("tavg_f_normal"))))
    gap: Column = F.lit(0.0)
    for c in _SPLINE:
        gap = gap + F.lit(weights[c]) * (F.col(c) - normal[c])
    for c in _LINEAR:
        gap = gap + F.lit(weights[c]) * (F.col(c) - F.col(f"{c}_normal"))
    score = ADJUSTED_DESIGN.score(weights)
    month_level = F.avg(F.col("logy") - F.col("score")).over(Window.partitionBy("ym"))
    effect = F.exp(gap) - 1
    return (
        model.withColumn("score", score)
        .select(
            "date",
            F.col("y").alias("actual"),
            F.exp(F.col("score") + month_level).alias("expected"),
            effect.alias("weather_effect"),
        )
        .withColumn("adjusted", F.col("actual") / (1 + F.col("weather_effect")))
    )
