"""Calendar keys and the federal holiday flag."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

MONDAY, THURSDAY, FRIDAY = 0, 3, 4

# Holidays on a date, moved to the nearest workday (month, day, first observed day).
DATED_HOLIDAYS = [
    (1, 1, None),
    (6, 19, "2021-06-18"),
    (7, 4, None),
    (11, 11, None),
    (12, 25, None),
]
# Holidays on the nth weekday of a month (month, weekday, nth, first day); -1 is last.
WEEKDAY_HOLIDAYS = [
    (1, MONDAY, 3, "1986-01-01"),
    (2, MONDAY, 3, None),
    (5, MONDAY, -1, None),
    (9, MONDAY, 1, None),
    (10, MONDAY, 2, None),
    (11, THURSDAY, 4, None),
]


def clock_hour(ts: Column) -> Column:
    """The local clock hour a zone-less timestamp falls in, still zone-less."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def hour_stamp(date: Column, hour: Column) -> Column:
    return date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour.cast("int"))


def hour_number(ts: Column) -> Column:
    """Whole hours since 1970 of a zone-less timestamp, for range frames and chunking."""
    return day_number(F.to_date(ts)) * 24 + F.hour(ts)


def day_number(date: Column) -> Column:
    return F.unix_date(date).cast("bigint")


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def year_month(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def is_weekend(date: Column) -> Column:
    return (F.weekday(date) >= 5).cast("int")


def day_type(date: Column) -> Column:
    return F.when(F.weekday(date) >= 5, "Weekend").otherwise("Weekday")


def season(date: Column) -> Column:
    month = F.month(date)
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )


def hour_weekend(date: Column, hour: Column) -> Column:
    return F.concat_ws("_", hour.cast("int").cast("string"), is_weekend(date).cast("string"))


def _observed(date: Column, month: int, day: int) -> Column:
    def falls(d: Column) -> Column:
        return (F.month(d) == month) & (F.dayofmonth(d) == day)

    weekday = F.weekday(date)
    return (
        (falls(date) & (weekday <= FRIDAY))
        | (falls(F.date_add(date, 1)) & (weekday == FRIDAY))
        | (falls(F.date_sub(date, 1)) & (weekday == MONDAY))
    )


def _nth_weekday(date: Column, month: int, weekday: int, nth: int) -> Column:
    in_month = (F.month(date) == month) & (F.weekday(date) == weekday)
    if nth < 0:
        return in_month & (F.month(F.date_add(date, 7)) != month)
    return in_month & (F.ceil(F.dayofmonth(date) / 7) == nth)


def is_federal_holiday(date: Column) -> Column:
    """1 on an observed federal holiday.

    Pure calendar arithmetic: no holiday table has to be generated, sized or joined.
    """
    rules = []
    for month, day, first in DATED_HOLIDAYS:
        rules.append((_observed(date, month, day), first))
    for month, weekday, nth, first in WEEKDAY_HOLIDAYS:
        rules.append((_nth_weekday(date, month, weekday, nth), first))
    hits = [
        rule if first is None else rule & (date >= F.lit(first).cast("date"))
        for rule, first in rules
    ]
    return reduce(lambda a, b: a | b, hits).cast("int")
