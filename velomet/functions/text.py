"""Cleaning of raw text cells."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from velomet.fixed_values import MISSING_TOKENS, NULL_MARKERS, PRESENT_WEATHER_CODES

# Whitespace removed at both ends, and the characters a plain number may have.
_SPACES = " \t\n\x0b\f\r"
_NUMBER_CHARACTERS = "0123456789+-.eE"
_MONTH_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})(.*)$"
_THIS_CENTURY = r"^(\d{1,2}/\d{1,2}/)([0-5]\d|6[0-8])(?!\d)"
_HOUR = r"[ T](\d{1,2}):"
_LAST_CENTURY = r"^(\d{1,2}/\d{1,2}/)(69|[7-9]\d)(?!\d)"


def strip(c: Column) -> Column:
    """Remove whitespace of any kind at both ends."""
    return F.trim(c, F.lit(_SPACES))


def markers_to_null(c: Column) -> Column:
    """A cell that is exactly a null marker becomes NULL."""
    return F.when(~c.isin(NULL_MARKERS), c)


def drop_point_zero(c: Column) -> Column:
    """``497.0`` -> ``497``; ``7079.05`` is left alone."""
    return F.when(c.endswith(".0"), F.substring(c, F.lit(1), F.length(c) - 2)).otherwise(c)


def to_text(c: Column) -> Column:
    """Trimmed text; blanks and null markers become NULL."""
    return F.when(~strip(c).isin(["", *NULL_MARKERS]), strip(c))


def to_double(c: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL.

    Literals a bare cast accepts, such as ``1d`` or ``Infinity``, are kept out by the characters
    a number may have. Cells are tested without patterns, which cost most of a scan of text.
    """
    s = strip(c)
    other = F.translate(s, _NUMBER_CHARACTERS, "")
    return F.when(other == "", s.try_cast("double"))


def to_long(c: Column) -> Column:
    """Text to integer; junk and fractional numbers become NULL."""
    number = to_double(c)
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(strip(c).try_cast("bigint"), whole)


def to_wall_clock(c: Column) -> Column:
    """Text to a zone-less timestamp over the layouts trip files have used.

    Year-first text goes straight to the cast; month-first text is rewritten year-first, a year of two
    digits being one from 1969 to 2068, and hours before noon or after it are moved to the day's 24. No
    zoned type is involved, so the session time zone cannot shift a value. A year or month
    alone is no time: a full date has its second dash after the sixth character.
    """
    s = strip(c)
    half = F.upper(F.right(s, F.lit(2)))
    bare = F.rtrim(F.left(s, F.length(s) - 2))
    # The hour as written, so that the time itself stands in the expression once.
    hour = F.coalesce(F.regexp_extract(bare, _HOUR, 1).try_cast("int"), F.lit(0))
    moved = F.when((half == "PM") & (hour < 12), 12).when((half == "AM") & (hour == 12), -12).otherwise(0)
    halves = F.when(hour <= 12, _whole_day(bare) + F.make_dt_interval(hours=moved))
    return F.when(half.isin("AM", "PM"), halves).otherwise(_whole_day(s))


def _whole_day(s: Column) -> Column:
    """A time of 24 hours, year first or month first."""
    years = F.regexp_replace(F.regexp_replace(s, _THIS_CENTURY, "$120$2"), _LAST_CENTURY, "$119$2")
    iso = F.regexp_replace(years, _MONTH_FIRST, "$3-$1-$2$4")
    return F.when(s.contains("/"), iso.try_cast("timestamp_ntz")).when(F.locate("-", s, 6) > 0, s.try_cast("timestamp_ntz"))


def typed_cell(c: Column, type_name: str) -> Column:
    """A cleaned text cell as one of the four types trip files use."""
    if type_name == "timestamp_ntz":
        return to_wall_clock(c)
    if type_name == "bigint":
        return to_long(c)
    if type_name == "double":
        return to_double(c)
    return to_text(c)


def clean_cells(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cell-level cleaning that precedes typing: markers to NULL, then ``.0`` off, then trimmed.

    The steps are separate projections. Later expressions mention a cell several times; with
    one projection per step each text is worked on once and generated methods stay small.
    """
    columns = list(columns)
    for step in (markers_to_null, drop_point_zero, strip):
        df = df.withColumns({c: step(F.col(c)) for c in columns})
    return df


def coerce_cells(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Raw text columns cleaned and typed in place."""
    cleaned = clean_cells(df, types)
    return cleaned.withColumns({c: typed_cell(F.col(c), kind) for c, kind in types.items()})


def missing_to_null(c: Column) -> Column:
    """Cells the weather reader counts as missing."""
    return F.when(~c.isin(MISSING_TOKENS), c)


def observation_number(s: Column, trace_is_zero: bool = False) -> Column:
    """One trimmed observation cell to double.

    ``T`` is a trace (0.0 for precipitation, otherwise unusable), a trailing ``s`` marks a
    suspect value (NULL), a trailing ``V`` a variable one (the number stands), ``VRB`` and
    other text are not numbers.
    """
    number = F.when(s.endswith("V"), F.substring(s, F.lit(1), F.length(s) - 1)).otherwise(s)
    trace = F.lit(0.0) if trace_is_zero else F.lit(None).cast("double")
    return F.when(s == "T", trace).otherwise(to_double(number))


def observation_cells(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Observation cells trimmed, missing ones NULL, as a projection of their own."""
    return df.withColumns({c: strip(missing_to_null(F.col(c))) for c in columns})


def optional_text(s: Column) -> Column:
    return F.nullif(s, F.lit(""))


def present_weather_flag(c: Column, flag: str) -> Column:
    """0/1 for one present-weather group; no text reads as 0."""
    return F.coalesce(c, F.lit("")).rlike(PRESENT_WEATHER_CODES[flag]).cast("int")


def name_key(c: Column) -> Column:
    """Station name with case and spacing folded, the key that survives layout changes."""
    return F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))
