"""Marts of mergeable sketches: medians and distinct stations of any period from daily or monthly rows.

A median or a distinct count of a month does not follow from those of its days, so each period would scan its trips
again. Sketches do follow: a row per day and region holds a KLL sketch of durations, a row per month and region a theta and
an HLL sketch of station names, and every longer period, every set of regions and every comparison of two periods is a merge of
a few hundred rows. Building a sketch is a partial aggregation like any other, so a hot day or region travels as one
sketch per task.

Error bounds are those published for the sketches, at 99 % for one quantile or count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from velomet.fixed_values import CURRENT_ERA_START
from velomet.functions.calendar import month_start
from velomet.functions.text import name_key
from velomet.operators.unify import owned_rows

#: Size of a KLL sketch of durations, and binary logarithms of the entries of a theta and an HLL sketch.
KLL_SIZE, THETA_BITS, HLL_BITS = 2048, 14, 14


def rank_error(size: int = KLL_SIZE) -> float:
    """How far, as a share of all values, the rank of a KLL quantile may be off, with 99 % confidence (fixed
    values: the fit published with the sketch)."""
    return 2.296 / size**0.9723


def theta_error(bits: int = THETA_BITS) -> float:
    """Relative error of a theta count at 99 % confidence; sets of up to 2^bits entries are exact."""
    return 2.576 / 2 ** (bits / 2)


def hll_error(bits: int = HLL_BITS) -> float:
    """Relative error of an HLL count at 99 % confidence."""
    return 2.576 * 1.04 / 2 ** (bits / 2)


# ---------------------------------------------------------------- durations
def daily_durations(trips: DataFrame, cutover: str = CURRENT_ERA_START, size: int = KLL_SIZE) -> DataFrame:
    """(date, region, trips, durations): one KLL sketch of trip seconds per day and region."""
    return owned_rows(trips, cutover).groupBy(F.to_date("start_time").alias("date"), "region").agg(
        F.count(F.lit(1)).alias("trips"), F.kll_sketch_agg_bigint("trip_duration_seconds", F.lit(size)).alias("durations")
    )


def duration_quantiles(
    daily: DataFrame, by: Sequence[Column | str], quantiles: Sequence[float] = (0.5,), size: int = KLL_SIZE
) -> DataFrame:
    """Quantiles of trip seconds over groups of the daily rows: trips, timed (trips with a duration), least, most, and
    ``q<percent>`` per quantile. Least and most are exact; null where no trip has a duration."""
    merged = daily.groupBy(*by).agg(
        F.sum("trips").alias("trips"), F.kll_merge_agg_bigint("durations", F.lit(size)).alias("durations")
    )
    timed = F.kll_sketch_get_n_bigint("durations")
    quantile = lambda q: F.when(timed > 0, F.kll_sketch_get_quantile_bigint("durations", F.lit(float(q))))
    asked = {f"q{q * 100:g}": quantile(q) for q in quantiles}
    ends = {"timed": timed, "least": quantile(0.0), "most": quantile(1.0)}
    return merged.withColumns(ends | asked).drop("durations")


# ---------------------------------------------------------------- stations
def monthly_station_sets(
    trips: DataFrame, cutover: str = CURRENT_ERA_START, theta_bits: int = THETA_BITS, hll_bits: int = HLL_BITS
) -> DataFrame:
    """(month, region, trips, stations, stations_hll): theta and HLL sketches of start stations by normalized name.

    As in the exact mart, trips are counted per spelling first, so names are folded per spelling and not per trip.
    """
    per_spelling = (
        owned_rows(trips, cutover)
        .filter(F.col("start_station_name").isNotNull())
        .groupBy(month_start(F.to_date("start_time")).alias("month"), "region", "start_station_name")
        .agg(F.count(F.lit(1)).alias("trips"))
        .withColumn("key", name_key(F.col("start_station_name")))
    )
    return per_spelling.groupBy("month", "region").agg(
        F.sum("trips").alias("trips"),
        F.theta_sketch_agg("key", F.lit(theta_bits)).alias("stations"),
        F.hll_sketch_agg("key", F.lit(hll_bits)).alias("stations_hll"),
    )


def station_totals(sets: DataFrame, by: Sequence[Column | str], bits: int = THETA_BITS) -> DataFrame:
    """Distinct stations over groups of the monthly rows: trips, stations (theta), stations_hll."""
    return sets.groupBy(*by).agg(
        F.sum("trips").alias("trips"),
        F.theta_sketch_estimate(F.theta_union_agg("stations", F.lit(bits))).alias("stations"),
        F.hll_sketch_estimate(F.hll_union_agg("stations_hll")).alias("stations_hll"),
    )


def stations_kept(sets: DataFrame, by: Sequence[str] = (), bits: int = THETA_BITS) -> DataFrame:
    """Per year and the one before it: stations, before, kept in both, opened and closed, as counted by set
    operations on the yearly sketches. The first year, or one after a gap, has no year before it and is left out."""
    yearly = sets.filter(F.col("month").isNotNull()).groupBy(*by, F.year("month").alias("year")).agg(
        F.theta_union_agg("stations", F.lit(bits)).alias("own")
    )
    before = yearly.select(*by, (F.col("year") + 1).alias("year"), F.col("own").alias("earlier"))
    count = F.theta_sketch_estimate
    return yearly.join(before, [*by, "year"]).select(
        *by,
        "year",
        count("own").alias("stations"),
        count("earlier").alias("before"),
        count(F.theta_intersection("own", "earlier")).alias("kept"),
        count(F.theta_difference("own", "earlier")).alias("opened"),
        count(F.theta_difference("earlier", "own")).alias("closed"),
    )
