"""Three-valued flags, labels and fill rules.

NULL weather means "not reported". Each rule below says what a consumer does with that:
labels leave it unlabelled, the daily model fills only snow and flags with 0, the adjusted
series fills from climatology (see ``operators.climatology``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def three_valued(measured: Column, condition: Column) -> Column:
    """1 / 0 where ``measured`` was reported, NULL where it was not."""
    return F.when(measured.isNull(), F.lit(None).cast("int")).when(condition, 1).otherwise(0)


def degree_days(tavg_f: Column, heating: bool) -> Column:
    gap = (65 - tavg_f) if heating else (tavg_f - 65)
    return F.when(tavg_f.isNotNull(), F.greatest(F.lit(0.0), gap))


def condition_label(is_snowy: Column, is_rainy: Column) -> Column:
    """Snow wins over rain; a day without a precipitation report has no label."""
    return (
        F.when(is_snowy == 1, "Snowy").when(is_rainy == 1, "Rainy").when(is_rainy == 0, "Dry")
    )


def casual_share(casual: Column, trips: Column) -> Column:
    return F.when(trips > 0, casual / trips * 100)


def clip(c: Column, low: float, high: float) -> Column:
    """Bound a value, keeping NULL (``greatest`` alone would turn NULL into the bound)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def zero_if_unreported(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def true_as_one(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("double")
