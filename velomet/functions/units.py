"""Unit conversions with the fixed rounding of the marts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from velomet.fixed_values import KM_PER_MILE, MM_PER_INCH, MPH_PER_MS


def steady_round(c: Column, digits: int) -> Column:
    """Half-up rounding that ignores noise in the last bits.

    A double average depends on the order partial sums met. Passing through a decimal with a
    few spare digits removes that noise first, so a value on a rounding tie comes out the same
    however the work was split or retried. Values too large for the decimal keep plain rounding.
    """
    c = c.cast("double")
    exact = F.round(c.try_cast(f"decimal(38,{digits + 5})"), digits).cast("double")
    return F.coalesce(exact, F.round(c, digits))


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9.0 / 5.0 + 32.0


def inches(mm: Column) -> Column:
    return mm / F.lit(MM_PER_INCH)


def miles_per_hour(meters_per_second: Column) -> Column:
    return meters_per_second * F.lit(MPH_PER_MS)


def miles(km: Column) -> Column:
    return km / F.lit(KM_PER_MILE)


def percent_change(new: Column, old: Column) -> Column:
    """Change in percent; NULL when the base is zero or missing."""
    return (F.try_divide(new, old) - 1) * 100
