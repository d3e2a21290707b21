"""Checks on inputs whose failure would change results silently."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def missing_start_times(trips: DataFrame) -> DataFrame:
    """Trips without a start time per source. Legacy ones form a NULL day in the daily mart."""
    return trips.groupBy("region", "source_era").agg(
        F.count(F.lit(1)).alias("trips"), F.count_if(F.col("start_time").isNull()).alias("missing")
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grain keys that occur more than once; shifts on a time grid need there to be none."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
