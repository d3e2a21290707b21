"""Day-of-year normals of the weather drivers.

Normals are 366 slots per driver. They are kept long, (driver, doy, value), so all drivers go
through each step together and windows are partitioned by driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

SLOTS = 366


def day_of_year_means(d: DataFrame, drivers: Sequence[str]) -> DataFrame:
    """Mean per day of year and driver, unreported days skipped; slots without data are NULL."""
    wide = d.groupBy(F.dayofyear("date").alias("doy")).agg(*[F.avg(c).alias(c) for c in drivers])
    means = wide.unpivot(["doy"], list(drivers), "driver", "value")
    names = F.explode(F.array(*[F.lit(c) for c in drivers])).alias("driver")
    slots = d.sparkSession.range(1, SLOTS + 1).select(F.col("id").cast("int").alias("doy"), names)
    return slots.join(means, ["driver", "doy"], "left")


def interpolate_slots(means: DataFrame) -> DataFrame:
    """Empty slots filled on the straight line between neighbours; ends hold the nearest value."""
    before = Window.partitionBy("driver").orderBy("doy").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("driver").orderBy("doy").rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col("value").isNotNull(), F.struct("doy", "value"))
    near = means.withColumns(
        {"left": F.last(at, ignorenulls=True).over(before), "right": F.first(at, ignorenulls=True).over(after)}
    )
    lv, rv = F.col("left.value"), F.col("right.value")
    ld, rd = F.col("left.doy"), F.col("right.doy")
    line = lv + (rv - lv) * (F.col("doy") - ld) / (rd - ld)
    filled = (
        F.when(F.col("value").isNotNull(), F.col("value"))
        .when(lv.isNotNull() & rv.isNotNull(), line)
        .otherwise(F.coalesce(lv, rv))
    )
    return near.select("driver", "doy", filled.alias("value"))


def circular_mean(slots: DataFrame, half_width: int = 7) -> DataFrame:
    """Centred mean over ``2 * half_width + 1`` slots that wraps around the year end.

    Each slot is handed to the neighbours it counts for, so no window has to run over the
    tripled series.
    """
    shift = F.explode(F.sequence(F.lit(-half_width), F.lit(half_width)))
    return (
        slots.withColumn("shift", shift)
        .select(
            "driver",
            (F.pmod(F.col("doy") - 1 + F.col("shift"), F.lit(SLOTS)) + 1).alias("doy"),
            "value",
        )
        .groupBy("driver", "doy")
        .agg(F.avg("value").alias("value"))
    )


def normals(d: DataFrame, drivers: Sequence[str]) -> DataFrame:
    """Smoothed normals, wide: one row per day of year with a ``<driver>_normal`` column each."""
    smooth = circular_mean(interpolate_slots(day_of_year_means(d, drivers)))
    return smooth.groupBy("doy").agg(
        *[F.max(F.when(F.col("driver") == c, F.col("value"))).alias(f"{c}_normal") for c in drivers]
    )


def fill_from_normals(d: DataFrame, normal: DataFrame, drivers: Sequence[str]) -> DataFrame:
    """Join normals by day of year and fill unreported drivers with them."""
    joined = d.withColumn("doy", F.dayofyear("date")).join(normal, "doy", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}_normal")) for c in drivers})
