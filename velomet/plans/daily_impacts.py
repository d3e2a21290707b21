"""Isolated effect of each weather factor on daily trips."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from velomet.fixed_values import (
    EFFECT_GROUPS,
    HUMIDITY_MIN_ROWS,
    MODEL_TEMP_EDGES,
    MODEL_TEMP_LABELS,
    MODEL_TEMP_REFERENCE,
    RAIN_EDGES,
    RAIN_LABELS,
    WARM_DAY_F,
    WINDY_DAY_MPH,
)
from velomet.functions.bands import band
from velomet.functions.calendar import is_federal_holiday, year_month
from velomet.functions.flags import zero_if_unreported
from velomet.operators.regression import Design, collect_moments, hac_sums, percent_effect, solve

EFFECT_SCHEMA = "label string, `group` string, pct double, lo double, hi double"
WEEKDAYS = list(range(7))

# Columns of the daily mart the models read, next to the date and a trips column.
MODEL_COLUMNS = [
    "tavg_f", "prcp_inches", "snow_inches", "snow_depth_inches", "wind_avg_mph", "dewpoint_f",
    "is_thunder", "is_foggy",
]

IMPACT_DESIGN = Design(
    outcome="logy",
    numbers=(
        "holiday", "snow_inches", "snow_depth_inches", "wind_avg_mph", "is_thunder", "is_foggy",
    ),
    levels={
        "dow": WEEKDAYS,
        "temp_band": [MODEL_TEMP_REFERENCE] + [b for b in MODEL_TEMP_LABELS if b != MODEL_TEMP_REFERENCE],
        "rain_band": RAIN_LABELS,
    },
    absorb=("ym",),
)
HUMIDITY_DESIGN = Design(
    outcome="logy",
    numbers=("holiday", "tavg_f", "dewpoint_f", "wind_avg_mph"),
    levels={"dow": WEEKDAYS, "rain_band": RAIN_LABELS},
    absorb=("ym",),
)


def calendar_outcome(daily: DataFrame, trips_col: str) -> DataFrame:
    """Rows with trips: log outcome, month key, weekday, holiday."""
    return (
        daily.withColumn("y", F.col(trips_col).cast("double"))
        .filter(F.col("y") > 0)
        .withColumns(
            {
                "logy": F.log("y"),
                "ym": year_month(F.col("date")),
                "dow": F.weekday("date"),
                "holiday": is_federal_holiday(F.col("date")).cast("double"),
            }
        )
    )


def impact_frame(daily: DataFrame, trips_col: str) -> DataFrame:
    """Model frame: rows without temperature, wind or rain reports drop; snow and flags read 0."""
    rows = calendar_outcome(daily, trips_col).dropna(subset=["tavg_f", "wind_avg_mph", "prcp_inches"])
    filled = {
        c: zero_if_unreported(F.col(c))
        for c in ("snow_inches", "snow_depth_inches", "is_thunder", "is_foggy")
    }
    return rows.withColumns(
        filled
        | {
            "temp_band": band(F.col("tavg_f"), MODEL_TEMP_EDGES, MODEL_TEMP_LABELS),
            "rain_band": band(F.col("prcp_inches"), RAIN_EDGES, RAIN_LABELS),
        }
    ).select("date", "logy", "ym", *IMPACT_DESIGN.numbers, *IMPACT_DESIGN.levels)


def humidity_frame(daily: DataFrame, trips_col: str) -> DataFrame:
    """Warm days with dew point and wind; unreported rain reads dry."""
    return (
        calendar_outcome(daily, trips_col)
        .filter((F.col("tavg_f") >= WARM_DAY_F) & F.col("dewpoint_f").isNotNull())
        .dropna(subset=["wind_avg_mph"])
        .withColumn("rain_band", band(F.coalesce("prcp_inches", F.lit(0.0)), RAIN_EDGES, RAIN_LABELS))
        .select("date", "logy", "ym", *HUMIDITY_DESIGN.numbers, *HUMIDITY_DESIGN.levels)
    )


@dataclass
class Humidity:
    per_f: float
    p10: float
    lo10: float
    hi10: float
    n: int


def humidity_impact(daily: DataFrame, trips_col: str) -> Humidity | None:
    """Effect of ten degrees of dew point at a given temperature; None under 100 rows."""
    frame = humidity_frame(daily, trips_col).persist()
    try:
        moments = collect_moments(frame, HUMIDITY_DESIGN)
        if moments.n < HUMIDITY_MIN_ROWS:
            return None
        fit = solve(moments)
        contrasts = {"per_f": {"dewpoint_f": 1.0}, "ten": {"dewpoint_f": 10.0}}
        variance = _variances(frame, HUMIDITY_DESIGN, fit, contrasts)
    finally:
        frame.unpersist()
    per_f = percent_effect(fit.point(contrasts["per_f"]), variance["per_f"])[0]
    return Humidity(per_f, *percent_effect(fit.point(contrasts["ten"]), variance["ten"]), moments.n)


def _variances(frame, design, fit, contrasts) -> dict[str, float]:
    return {r.contrast: r.variance for r in hac_sums(frame, design, fit, contrasts, "date").collect()}


def _representative_days(frame: DataFrame) -> dict[str, float]:
    """Typical snowfall, snow depth and wind used to express the continuous terms."""

    def mean_where(condition, c):
        return F.avg(F.when(condition, F.col(c)))

    row = frame.agg(
        mean_where(F.col("snow_inches") > 0, "snow_inches").alias("snow"),
        mean_where(F.col("snow_depth_inches") > 0, "snow_depth_inches").alias("depth"),
        mean_where(F.col("wind_avg_mph") >= WINDY_DAY_MPH, "wind_avg_mph").alias("windy"),
        F.avg("wind_avg_mph").alias("wind"),
    ).first()
    return {k: float("nan") if v is None else float(v) for k, v in row.asDict().items()}


def fit_impacts(daily: DataFrame, trips_col: str) -> tuple[DataFrame, dict]:
    """Effects (label, group, pct, lo, hi) and meta (n, R2 of controls and full, partial R2).

    The columns the models read are kept while both fits run, so the mart is computed once. A
    slice without usable days gives no effects and ``n`` 0. Month effects are absorbed, so the number of months does not widen the system.
    """
    days = daily.select("date", trips_col, *MODEL_COLUMNS).persist()
    try:
        return _fit_impacts(days, trips_col)
    finally:
        days.unpersist()


def _fit_impacts(days: DataFrame, trips_col: str) -> tuple[DataFrame, dict]:
    frame = impact_frame(days, trips_col).persist()
    try:
        moments = collect_moments(frame, IMPACT_DESIGN)
        if moments.n == 0:
            return days.sparkSession.createDataFrame([], EFFECT_SCHEMA), {"n": 0}
        fit = solve(moments)
        controls = solve(
            moments, moments.number_columns(["holiday"]) + moments.level_columns("dow")
        )
        typical = _representative_days(frame)
        plan = _impact_contrasts(typical)
        known = {label: c for label, (_, c) in plan.items() if all(w == w for w in c.values())}
        variance = _variances(frame, IMPACT_DESIGN, fit, known)
    finally:
        frame.unpersist()
    rows = []
    for label, (group, contrast) in plan.items():
        if label in known:
            effect = percent_effect(fit.point(contrast), variance[label])
        else:  # no day of that kind occurred
            effect = (None, None, None)
        rows.append((label, group, *effect))
    humidity = humidity_impact(days, trips_col)
    if humidity is not None:
        rows.append(
            ("+10°F muggier (warm days)", EFFECT_GROUPS["humidity"], humidity.p10, humidity.lo10, humidity.hi10)
        )
    total = moments.total_squares
    r2_controls = 1 - controls.residual_squares / total
    r2_full = 1 - fit.residual_squares / total
    meta = {
        "n": moments.n,
        "r2_controls": r2_controls,
        "r2_full": r2_full,
        "weather_partial_r2": (r2_full - r2_controls) / (1 - r2_controls),
    }
    return days.sparkSession.createDataFrame(rows, EFFECT_SCHEMA), meta


def _impact_contrasts(typical: dict[str, float]) -> dict[str, tuple[str, dict[str, float]]]:
    groups = EFFECT_GROUPS
    plan: dict[str, tuple[str, dict[str, float]]] = {}
    for label in MODEL_TEMP_LABELS:
        if label != MODEL_TEMP_REFERENCE:
            plan[f"{label}°F"] = (groups["temperature"], {f"temp_band={label}": 1.0})
    for label in RAIN_LABELS[1:]:
        plan[f"{label} rain"] = (groups["rain"], {f"rain_band={label}": 1.0})
    plan["typical snow day"] = (
        groups["snow"],
        {"snow_inches": typical["snow"], "snow_depth_inches": typical["depth"]},
    )
    plan[f"windy day (~{typical['windy']:.0f} mph)"] = (
        groups["wind"],
        {"wind_avg_mph": typical["windy"] - typical["wind"]},
    )
    plan["thunderstorm"] = (groups["storms"], {"is_thunder": 1.0})
    plan["fog"] = (groups["storms"], {"is_foggy": 1.0})
    return plan


def by_size(effects: DataFrame) -> DataFrame:
    """Effects from the largest loss to the largest gain."""
    return effects.orderBy("pct")
