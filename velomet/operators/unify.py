"""Both trip layouts as one canonical relation."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from velomet.fixed_values import CURRENT_ERA_START, RIDER_OF_USER_TYPE, UNIFIED_COLUMNS
from velomet.functions.geo import great_circle_meters


def _whole_number(c: Column) -> Column:
    """Number to integer, halves away from zero; out of range becomes NULL."""
    return F.round(c.cast("double")).try_cast("bigint")


def unified_branch(typed: DataFrame, era: str, region: str | Column) -> DataFrame:
    """One (region, layout) source in canonical shape. Columns a layout lacks are typed NULLs.

    ``era`` stays a literal, so filters on it fold away per branch and what is left of them
    reaches the scan.
    """
    elapsed = F.timestamp_diff("SECOND", F.col("start_time"), F.col("stop_time"))
    if era == "legacy":
        rider = F.lit(None).cast("string")
        for user_type, name in RIDER_OF_USER_TYPE.items():
            rider = F.when(F.col("user_type") == user_type, name).otherwise(rider)
        own = {
            "trip_duration_seconds": F.coalesce(F.col("trip_duration"), elapsed),
            "member_casual": rider,
            "birth_year": _whole_number(F.col("birth_year")),
            "gender": _whole_number(F.col("gender")),
        }
    else:
        own = {"trip_duration_seconds": elapsed}
    own["distance_meters"] = great_circle_meters(
        F.col("start_station_longitude"),
        F.col("start_station_latitude"),
        F.col("end_station_longitude"),
        F.col("end_station_latitude"),
    )
    own["region"] = F.lit(region) if isinstance(region, str) else region
    own["source_era"] = F.lit(era)
    present = set(typed.columns)

    def pick(name: str, kind: str) -> Column:
        if name in own:
            c = own[name]
        elif name in present:
            c = F.col(name)
        else:
            c = F.lit(None)
        return c.cast(kind).alias(name)

    return typed.select(*[pick(name, kind) for name, kind in UNIFIED_COLUMNS])


def unify(branches: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, branches)


def owned_rows(trips: DataFrame, cutover: str = CURRENT_ERA_START) -> DataFrame:
    """Drop current-layout rows before the cutover, which legacy files already cover.

    Written on the raw timestamp rather than its date so that Parquet statistics apply. A row
    without a start time stays for legacy and drops for current: NOT(TRUE AND NULL) is NULL.
    """
    before = F.col("start_time") < F.lit(cutover).cast("timestamp_ntz")
    return trips.filter(~((F.col("source_era") == "current") & before))
