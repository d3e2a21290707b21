"""Time-series operators: long segments, rolling windows, complete grids, leads and lags.

Rows here are marts, one per day or hour and series, so a series is bounded by the calendar
(366 rows a year by day, 8,784 by hour) however many trips it counts. Windows are partitioned
by series. Hour-grain windows are also cut into spans of time with the few neighbouring rows
they need repeated, so one long series still runs on many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from velomet.fixed_values import SEGMENTS
from velomet.functions.calendar import day_number, hour_number, hour_stamp
from velomet.functions.flags import casual_share

SPAN_HOURS = 24 * 31


def by_segment(
    mart: DataFrame, carry: Sequence[str], segments: Mapping[str, tuple] = SEGMENTS
) -> DataFrame:
    """The wide region columns as rows: segment, carried columns, trips, member, casual."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("segment"),
                F.col(trips).alias("trips"),
                F.col(member).alias("member"),
                F.col(casual).alias("casual"),
            )
            for name, (trips, member, casual, _) in segments.items()
        ]
    )
    return mart.select(*carry, F.inline(rows))


def from_launch(df: DataFrame, series: Sequence[str] = ("segment",)) -> DataFrame:
    """Rows from the first day with trips of each series on; a series never launched drops out."""
    launch = df.filter(F.col("trips") > 0).groupBy(*[F.col(c).alias(f"_{c}") for c in series]).agg(F.min("date").alias("launch"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in series]
    return df.join(launch, [*same, F.col("date") >= F.col("launch")], "left_semi")


def user_slice(
    df: DataFrame,
    first_year: int | None = None,
    last_year: int | None = None,
    days: str = "All days",
) -> DataFrame:
    """Year range and day-type choice. An empty slice is an empty frame with the same schema."""
    # Ranges of the day itself, which a scan can use; a function of it would not reach the files.
    if first_year is not None:
        df = df.filter(F.col("date") >= F.lit(f"{first_year:04d}-01-01").cast("date"))
    if last_year is not None:
        df = df.filter(F.col("date") < F.lit(f"{last_year + 1:04d}-01-01").cast("date"))
    if days == "Weekdays only":
        return df.filter(F.weekday("date") < 5)
    if days == "Weekends only":
        return df.filter(F.weekday("date") >= 5)
    return df


def ridership_index(
    df: DataFrame,
    series: Sequence[str] = ("segment",),
    value: str = "trips",
    half_width: int = 14,
    min_rows: int = 10,
) -> DataFrame:
    """Value as percent of the centred median over ``2 * half_width + 1`` rows.

    Counts rows, not days; fewer than ``min_rows`` known values in the frame give NULL.
    """
    frame = Window.partitionBy(*series).orderBy("date").rowsBetween(-half_width, half_width)
    median = F.percentile(F.col(value).cast("double"), F.lit(0.5)).over(frame)
    known = F.count(value).over(frame)
    baseline = F.when(known >= min_rows, median)
    return df.withColumn(
        "ridership_index", F.try_divide(F.col(value).cast("double"), baseline) * 100.0
    )


def rolling_day_mean(
    df: DataFrame,
    value: str,
    days: int,
    out: str,
    series: Sequence[str] = ("segment",),
    min_rows: int = 7,
) -> DataFrame:
    """Mean over the trailing ``days`` calendar days, the current one included."""
    frame = (
        Window.partitionBy(*series)
        .orderBy(day_number(F.col("date")))
        .rangeBetween(-(days - 1), 0)
    )
    return df.withColumn(
        out, F.when(F.count(value).over(frame) >= min_rows, F.avg(value).over(frame))
    )


def with_halo(
    df: DataFrame, position: Column, before: int, after: int, span: int
) -> DataFrame:
    """Cut positions into spans and repeat the rows a window at a span's edge reaches for.

    Adds ``span_no`` to partition windows by and ``is_core``, true on the one copy of each row
    that lies in its own span. A window reaching ``before`` back and ``after`` ahead is exact
    on core rows.
    """
    first = F.floor((position - after) / span)
    last = F.floor((position + before) / span)
    return (
        df.withColumn("span_no", F.explode(F.sequence(first, last)))
        .withColumn("is_core", F.col("span_no") == F.floor(position / span))
    )


def lead_lag_hours(
    df: DataFrame,
    value: str,
    leads: int,
    lags: int,
    name: str,
    series: Sequence[str] = (),
    ts: str = "ts",
    span: int = SPAN_HOURS,
) -> DataFrame:
    """Value exactly k clock hours later (``<name>_lead<k>``) and earlier (``<name>_lag<k>``).

    A one-hour range frame finds the neighbour on the complete clock without generating it: an
    hour that has no row yields NULL instead of shifting its neighbours.
    """
    hour = hour_number(F.col(ts))
    spread = with_halo(df.withColumn("hour_no", hour), F.col("hour_no"), lags, leads, span)
    order = Window.partitionBy(*series, "span_no").orderBy("hour_no")
    shifted = {f"{name}_lead{k}": F.max(value).over(order.rangeBetween(k, k)) for k in range(1, leads + 1)}
    shifted |= {f"{name}_lag{k}": F.max(value).over(order.rangeBetween(-k, -k)) for k in range(1, lags + 1)}
    return (
        spread.withColumns(shifted).filter("is_core").drop("hour_no", "span_no", "is_core")
    )


def zero_filled_hours(
    hourly: DataFrame,
    values: Sequence[str] = ("trips", "member", "casual"),
    series: Sequence[str] = ("segment",),
) -> DataFrame:
    """Every hour of every day between a series' first and last date; absent hours count 0."""
    days = (
        hourly.groupBy(*series)
        .agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
        .select(*series, F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias("date"))
    )
    grid = days.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    keys = [*series, "date", "hour"]
    counted = hourly.select(*keys, *values)
    return grid.join(counted, keys, "left").select(
        *keys, *[F.coalesce(F.col(v).cast("double"), F.lit(0.0)).alias(v) for v in values]
    )


def complete_hours(
    hourly: DataFrame, ts: str = "ts", series: Sequence[str] = ("segment",)
) -> DataFrame:
    """One row per clock hour from a series' first to last hour; absent hours stay NULL."""
    spine = (
        hourly.groupBy(*series)
        .agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
        .select(*series, F.explode(F.expr("sequence(lo, hi, interval 1 hour)")).alias(ts))
    )
    return spine.join(hourly, [*series, ts], "left")


def with_clock(hourly: DataFrame) -> DataFrame:
    """Timestamp of a (date, hour) row."""
    return hourly.withColumn("ts", hour_stamp(F.col("date"), F.col("hour")))


def within_group_demean(
    df: DataFrame, columns: Sequence[str], group: Sequence[str]
) -> DataFrame:
    """Each column minus its mean within the group."""
    groups = Window.partitionBy(*group)
    return df.withColumns({c: F.col(c) - F.avg(c).over(groups) for c in columns})


def latest_rows(df: DataFrame, n: int = 30, order: str = "date") -> DataFrame:
    """The last n rows, oldest first (a top-n, not a full sort)."""
    return df.orderBy(F.desc(order)).limit(n).orderBy(order)


def previous_value(
    df: DataFrame, columns: Sequence[str], order: str, series: Sequence[str] = ()
) -> DataFrame:
    """``prev_<c>`` from the period before, for period tables of a few rows per series."""
    w = Window.partitionBy(*series).orderBy(order)
    return df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in columns})


def daily_frame(daily_weather: DataFrame, **slice_options) -> DataFrame:
    """The daily mart as segments with calendar fields, condition, share and index.

    The index spans each segment's whole history; the slice is applied afterwards so that it
    never moves the baseline.
    """
    from velomet.functions.calendar import is_weekend
    from velomet.functions.flags import condition_label

    weather = [
        c
        for c in daily_weather.columns
        if c not in ("year", "is_weekend") and not c.startswith("num_")
    ]
    days = daily_weather.filter(F.col("date").isNotNull())
    long = from_launch(by_segment(days, weather))
    return user_slice(
        ridership_index(long).withColumns(
            {
                "year": F.year("date"),
                "is_weekend": is_weekend(F.col("date")),
                "condition": condition_label(F.col("is_snowy"), F.col("is_rainy")),
                "pct_casual": casual_share(F.col("casual"), F.col("trips")),
            }
        ),
        **slice_options,
    )
