"""Rain at the hour it falls, from contrasts within the same day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from velomet.fixed_values import DAYPARTS, HEAVY_RAIN_INCHES, RAIN_LAGS, RAIN_LEADS
from velomet.functions.bands import hour_range_indicator
from velomet.functions.calendar import hour_weekend
from velomet.functions.flags import true_as_one
from velomet.operators.regression import (
    Design,
    cluster_factor,
    cluster_sums,
    collect_moments,
    percent_effect,
    solve,
)
from velomet.operators.series import lead_lag_hours, with_clock

HOUR_WEEKEND = [f"{hour}_{weekend}" for weekend in (0, 1) for hour in range(24)]
PROFILE_SCHEMA = "k int, pct double, lo double, hi double"
DAYPART_SCHEMA = "daypart string, pct double, lo double, hi double"


def hourly_frame(hourly: DataFrame, trips_col: str) -> DataFrame:
    """Model frame: log trips, diurnal key, heavy rain, and rain before and after the hour.

    Leads and lags are taken on the clock before hours without trips drop out.
    """
    rows = with_clock(hourly).withColumns(
        {
            "y": F.col(trips_col).cast("double"),
            "is_raining": F.col("is_raining").cast("double"),
            "is_snowing": F.col("is_snowing").cast("double"),
            "heavy_rain": true_as_one(
                (F.col("is_raining") == 1) & (F.col("prcp_inches") >= HEAVY_RAIN_INCHES)
            ),
        }
    )
    shifted = lead_lag_hours(rows, "is_raining", RAIN_LEADS, RAIN_LAGS, "rain")
    dayparts = {
        f"rain_{first}_{last}": F.col("is_raining") * hour_range_indicator(F.col("hour"), first, last)
        for first, last, _ in DAYPARTS
    }
    return shifted.filter(F.col("y") > 0).withColumns(
        {"logy": F.log("y"), "hw": hour_weekend(F.col("date"), F.col("hour"))} | dayparts
    )


def _design(regressors: list[str]) -> Design:
    return Design("logy", tuple(regressors), {"hw": HOUR_WEEKEND}, absorb=("date",))


def _fit_within_day(frame: DataFrame, regressors: list[str], contrasts: dict[str, dict[str, float]]):
    """Effects of each contrast with day-clustered intervals; n and n_days.

    Columns counted for the small-sample factor are the regressors and all diurnal levels but
    one, taken before incomplete rows drop.
    """
    design = _design(regressors)
    moments = collect_moments(frame, design)
    if moments.n == 0:
        return dict.fromkeys(contrasts, (None, None, None)), {"n": 0, "n_days": 0}
    fit = solve(moments)
    levels = frame.agg(F.count_distinct("hw")).first()[0]
    sums = cluster_sums(frame, design, fit, contrasts).first()
    factor = cluster_factor(sums["groups"], sums["rows"], len(regressors) + levels - 1)
    effects = {
        name: percent_effect(fit.point(c), sums[f"m{k}"] * factor)
        for k, (name, c) in enumerate(contrasts.items())
    }
    return effects, {"n": sums["rows"], "n_days": sums["groups"]}


def rain_profile(hourly: DataFrame, trips_col: str) -> tuple[DataFrame, dict]:
    """Effect by hour from two before to four after rain, and the cumulative effect from 0 on. No hours give no rows."""
    leads = [f"rain_lead{k}" for k in range(RAIN_LEADS, 0, -1)]
    after = ["is_raining", *[f"rain_lag{k}" for k in range(1, RAIN_LAGS + 1)]]
    contrasts = {name: {name: 1.0} for name in leads + after}
    contrasts["cumulative"] = {name: 1.0 for name in after}
    frame = hourly_frame(hourly, trips_col).persist()
    try:
        effects, meta = _fit_within_day(frame, [*leads, *after, "is_snowing"], contrasts)
    finally:
        frame.unpersist()
    offsets = range(-RAIN_LEADS, RAIN_LAGS + 1)
    rows = [(k, *effects[name]) for k, name in zip(offsets, leads + after)] if meta["n"] else []
    meta |= dict(zip(("cum_pct", "cum_lo", "cum_hi"), effects["cumulative"]))
    return hourly.sparkSession.createDataFrame(rows, PROFILE_SCHEMA), meta


def rain_by_daypart(hourly: DataFrame, trips_col: str) -> tuple[DataFrame, dict]:
    """Effect of rain by part of the day; meta carries the extra effect of heavy rain."""
    columns = {f"rain_{first}_{last}": label for first, last, label in DAYPARTS}
    contrasts = {name: {name: 1.0} for name in [*columns, "heavy_rain"]}
    frame = hourly_frame(hourly, trips_col).persist()
    try:
        effects, meta = _fit_within_day(frame, [*columns, "heavy_rain", "is_snowing"], contrasts)
    finally:
        frame.unpersist()
    rows = [(label, *effects[name]) for name, label in columns.items()] if meta["n"] else []
    meta["heavy_extra"] = dict(zip(("pct", "lo", "hi"), effects["heavy_rain"]))
    return hourly.sparkSession.createDataFrame(rows, DAYPART_SCHEMA), meta


def rain_by_rider(hourly: DataFrame, member_col: str, casual_col: str) -> DataFrame:
    """Daypart effects of both rider types, stacked. The mart is computed once for both fits."""
    columns = ["date", "hour", member_col, casual_col, "is_raining", "is_snowing", "prcp_inches"]
    hours = hourly.select(*dict.fromkeys(columns)).persist()
    try:
        member, _ = rain_by_daypart(hours, member_col)
        casual, _ = rain_by_daypart(hours, casual_col)
    finally:
        hours.unpersist()
    return member.withColumn("rider", F.lit("Member")).unionByName(
        casual.withColumn("rider", F.lit("Casual"))
    )
