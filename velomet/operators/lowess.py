"""Locally weighted trend line, on a fixed grid or at every observation.

On a grid every step is an aggregation. Rows are first reduced to distinct x values, each of which
contributes to the grid points within their bandwidth, so no pair of data rows is ever formed.
Between passes only the grid itself (``points`` numbers per series) is carried on.

At the observations each distinct x has its own nearest rows and its own line. Which rows are nearest follows from
ranks in one ordered pass; the lines are sums over pairs of an x and a block of ranks, so a series of n rows is
n x share of neighbours of work, spread over blocks and not over series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from velomet.session import checkpoint_dir

ROBUST_PASSES = 3


def _with_grid(df: DataFrame, by: Sequence[str], points: int) -> DataFrame:
    """Series with their grid: first point, step and the number of nearest rows to use."""
    return df.groupBy(*by).agg(
        F.min("x").alias("lo"),
        ((F.max("x") - F.min("x")) / F.lit(points - 1)).alias("step"),
        F.count(F.lit(1)).alias("n"),
    )


def _bandwidths(df: DataFrame, by: Sequence[str], points: int, frac: float) -> DataFrame:
    """Per series an array of bandwidths: distance from each grid point to its k-th nearest row."""
    at = df.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("m"))
    grid = _with_grid(df, by, points)
    spread = at.join(grid, list(by)).select(
        *by,
        "m",
        F.greatest(F.lit(1), F.floor(F.lit(frac) * F.col("n") + 1e-10)).alias("k"),
        "x",
        "lo",
        "step",
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("j"),
    )
    spread = spread.withColumn("far", F.abs(F.col("x") - F.col("lo") - F.col("j") * F.col("step")))
    near = Window.partitionBy(*by, "j").orderBy("far").rangeBetween(Window.unboundedPreceding, 0)
    widths = (
        spread.withColumn("seen", F.sum("m").over(near))
        .groupBy(*by, "j")
        .agg(F.min(F.when(F.col("seen") >= F.col("k"), F.col("far"))).alias("h"))
    )
    arrays = widths.groupBy(*by).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("j", "h"))), lambda s: s["h"]).alias("h")
    )
    return arrays.join(grid, list(by))


def _fit_grid(weighted: DataFrame, grid: DataFrame, by: Sequence[str]) -> DataFrame:
    """Tricube-weighted line at every grid point from five sums; ``r`` holds row weights."""
    at = weighted.groupBy(*by, "x").agg(
        F.sum("r").alias("r"), F.sum(F.col("r") * F.col("y")).alias("ry")
    )
    near = at.join(grid, list(by)).select(*by, "x", "r", "ry", "lo", "step", F.posexplode("h").alias("j", "h"))
    d = F.col("x") - F.col("lo") - F.col("j") * F.col("step")
    near = near.withColumn("d", d).filter((F.abs("d") < F.col("h")) | (F.col("d") == 0))
    ratio = F.coalesce(F.try_divide(F.abs("d"), F.col("h")), F.lit(0.0))
    w = F.pow(1 - F.pow(ratio, F.lit(3.0)), F.lit(3.0))
    sums = near.withColumn("w", w).groupBy(*by, "j", "lo", "step").agg(
        F.sum(F.col("w") * F.col("r")).alias("s0"),
        F.sum(F.col("w") * F.col("r") * F.col("d")).alias("s1"),
        F.sum(F.col("w") * F.col("r") * F.col("d") * F.col("d")).alias("s2"),
        F.sum(F.col("w") * F.col("ry")).alias("t0"),
        F.sum(F.col("w") * F.col("ry") * F.col("d")).alias("t1"),
    )
    det = F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1")
    line = (F.col("s2") * F.col("t0") - F.col("s1") * F.col("t1")) / det
    flat = F.try_divide(F.col("t0"), F.col("s0"))
    return sums.select(
        *by,
        "j",
        (F.col("lo") + F.col("j") * F.col("step")).alias("x"),
        F.when(det > 1e-12 * F.col("s0") * F.col("s0"), line).otherwise(flat).alias("fit"),
    )


def _interpolated(x: Column) -> Column:
    """Grid line at x, from the joined arrays ``fits`` and the grid's lo and step."""
    at = F.coalesce(F.try_divide(x - F.col("lo"), F.col("step")), F.lit(0.0))
    j = F.least(F.greatest(F.floor(at), F.lit(0)), F.size("fits") - 2).cast("int")
    left, right = F.get(F.col("fits"), j), F.get(F.col("fits"), j + 1)
    return left + (right - left) * (at - j)


def lowess(
    df: DataFrame,
    x: str,
    y: str,
    frac: float = 2.0 / 3.0,
    by: Sequence[str] = (),
    points: int = 41,
    passes: int = ROBUST_PASSES,
) -> DataFrame:
    """Trend of y over x per series: by, x, fit at ``points`` grid positions.

    After the first fit, ``passes`` refits weigh rows by their residual (bisquare of six median
    absolute residuals), with the line interpolated between grid points.
    """
    return _trend(df, x, y, frac, by, points, passes, ())[1].select(*by, "x", "fit")


def lowess_at_rows(
    df: DataFrame,
    x: str,
    y: str,
    frac: float = 2.0 / 3.0,
    by: Sequence[str] = (),
    carry: Sequence[str] = (),
    points: int = 41,
    passes: int = ROBUST_PASSES,
) -> DataFrame:
    """The trend at every row with x and y: by, carry, x, y, fit, read off the grid's line."""
    rows, fitted, grid, keys = _trend(df, x, y, frac, by, points, passes, carry)
    lines = _lines(fitted, grid, keys)
    return rows.join(lines, keys).select(*by, *carry, "x", "y", _interpolated(F.col("x")).alias("fit"))


def _lines(fitted: DataFrame, grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per series the grid's fits as one array, with the grid's first point and step."""
    fits = fitted.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("j", "fit"))), lambda s: s["fit"]).alias("fits")
    )
    return fits.join(grid.select(*keys, "lo", "step"), keys)


def _trend(df, x, y, frac, by, points, passes, carry) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """Rows, fitted grid, grid and keys. What a pass hands to the next, a few numbers per series, goes through
    the checkpoint folder and not through the driver."""
    checkpoint_dir(df.sparkSession)
    keys = list(by) or ["_all"]
    rows = df.select(
        *[F.col(c) for c in by],
        *([] if by else [F.lit(0).alias("_all")]),
        *carry,
        F.col(x).cast("double").alias("x"),
        F.col(y).cast("double").alias("y"),
    ).dropna(subset=["x", "y", *by]).checkpoint()
    grid = _bandwidths(rows, keys, points, frac).checkpoint()
    weighted = rows.withColumn("r", F.lit(1.0))
    for turn in range(passes + 1):
        fitted = _fit_grid(weighted, grid, keys).checkpoint()
        if turn == passes:
            break
        lines = _lines(fitted, grid, keys)
        residual = rows.join(lines, keys).select(*keys, "x", "y", F.abs(F.col("y") - _interpolated(F.col("x"))).alias("a"))
        scales = residual.groupBy(*keys).agg(F.median("a").alias("mad")).checkpoint()
        share = F.coalesce(F.try_divide(F.col("a"), 6 * F.col("mad")), F.lit(0.0))
        bisquare = F.when(share < 1, F.pow(1 - share * share, F.lit(2.0))).otherwise(0.0)
        weighted = residual.join(scales, keys).select(*keys, "x", "y", bisquare.alias("r"))
    return rows, fitted, grid, keys


# ---------------------------------------------------------------- at the observations
#: Ranks of a block of neighbours.
BLOCK = 256


def _neighbourhoods(rows: DataFrame, keys: Sequence[str], frac: float) -> DataFrame:
    """Per series and distinct x: first rank, bandwidth ``h``, and first and last rank of the k nearest rows.

    The k rows nearest to x are consecutive ranks l to l + k - 1. The middle between the two ends rises with l, so the
    best l is the last one whose middle lies below x or the first whose middle does not: the neighbours of x in the
    order of both kinds of numbers.
    """
    order = Window.partitionBy(*keys).orderBy("x")
    k = F.greatest(F.lit(1), F.floor(F.lit(frac) * F.count(F.lit(1)).over(Window.partitionBy(*keys)) + 1e-10))
    ranked = rows.select(*keys, "x").withColumns(
        {"l": F.row_number().over(order) - 1, "first": F.rank().over(order) - 1, "k": k}
    )
    # The x that is k - 1 ranks further on: a self-join by rank, since a lead's distance must be a constant.
    ends = ranked.select(*keys, F.col("l").alias("far"), F.col("x").alias("x_end"))
    spans = ranked.withColumn("far", F.col("l") + F.col("k") - 1).join(ends, [*keys, "far"])
    span = F.struct("first", "far", F.col("x").alias("from"), F.col("x_end").alias("to")).alias("span")
    middles = spans.select(*keys, ((F.col("x") + F.col("x_end")) / 2).alias("at"), F.lit(1).alias("kind"), "l", span)
    none = F.lit(None).cast(middles.schema["span"].dataType)
    points = ranked.groupBy(*keys, "x").agg(F.min("first").alias("rank")).select(
        *keys, F.col("x").alias("at"), F.lit(0).alias("kind"), F.col("rank").alias("l"), none.alias("span")
    )
    line = Window.partitionBy(*keys).orderBy("at", "kind", "l")
    below = F.last("span", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    above = F.first("span", ignorenulls=True).over(line.rowsBetween(1, Window.unboundedFollowing))
    found = middles.unionByName(points).withColumns({"below": below, "above": above}).filter("kind = 0")
    left, right = F.col("at") - F.col("below.from"), F.col("above.to") - F.col("at")
    nearer = F.col("above").isNull() | F.coalesce(left < right, F.lit(False))
    best = F.when(nearer, F.col("below")).otherwise(F.col("above"))
    return found.select(
        *keys,
        F.col("at").alias("x"),
        F.col("l").alias("rank"),
        F.when(nearer, left).otherwise(right).alias("h"),
        best["first"].alias("low"),
        best["far"].alias("high"),
    )


def _fit_observations(weighted: DataFrame, near: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, x, fit): the tricube-weighted line of every distinct x at that x; ``r`` holds row weights."""
    at = weighted.groupBy(*keys, "x").agg(F.sum("r").alias("r"), F.sum(F.col("r") * F.col("y")).alias("ry"))
    block = F.floor(F.col("rank") / BLOCK)
    others = at.join(near.select(*keys, "x", "rank"), [*keys, "x"]).select(*keys, block.alias("block"), F.col("x").alias("other"), "r", "ry")
    blocks = F.explode(F.sequence(F.floor(F.col("low") / BLOCK), F.floor(F.col("high") / BLOCK)))
    pairs = near.select(*keys, "x", "h", blocks.alias("block")).join(others, [*keys, "block"])
    pairs = pairs.withColumn("d", F.col("other") - F.col("x")).filter((F.abs("d") < F.col("h")) | (F.col("d") == 0))
    ratio = F.coalesce(F.try_divide(F.abs("d"), F.col("h")), F.lit(0.0))
    w = F.pow(1 - F.pow(ratio, F.lit(3.0)), F.lit(3.0))
    sums = pairs.withColumn("w", w).groupBy(*keys, "x").agg(
        F.sum(F.col("w") * F.col("r")).alias("s0"),
        F.sum(F.col("w") * F.col("r") * F.col("d")).alias("s1"),
        F.sum(F.col("w") * F.col("r") * F.col("d") * F.col("d")).alias("s2"),
        F.sum(F.col("w") * F.col("ry")).alias("t0"),
        F.sum(F.col("w") * F.col("ry") * F.col("d")).alias("t1"),
    )
    det = F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1")
    line = (F.col("s2") * F.col("t0") - F.col("s1") * F.col("t1")) / det
    flat = F.try_divide(F.col("t0"), F.col("s0"))
    return sums.select(*keys, "x", F.when(det > 1e-12 * F.col("s0") * F.col("s0"), line).otherwise(flat).alias("fit"))


def lowess_at_observations(
    df: DataFrame,
    x: str,
    y: str,
    frac: float = 2.0 / 3.0,
    by: Sequence[str] = (),
    carry: Sequence[str] = (),
    passes: int = ROBUST_PASSES,
) -> DataFrame:
    """The trend at every row with x and y, each fitted to its own nearest rows: by, carry, x, y, fit.

    ``frac`` of a series' rows, rounded down and one at least, are a row's neighbours; the farthest of them has weight
    zero. After the first fit ``passes`` refits weigh rows by their residual. Where all neighbours share one x, or all
    weights sit on it, the line is their mean. Ordering by rank takes one task per series, everything else is spread.
    """
    checkpoint_dir(df.sparkSession)
    keys = list(by) or ["_all"]
    rows = df.select(
        *[F.col(c) for c in by],
        *([] if by else [F.lit(0).alias("_all")]),
        *carry,
        F.col(x).cast("double").alias("x"),
        F.col(y).cast("double").alias("y"),
    ).dropna(subset=["x", "y", *by]).checkpoint()
    near = _neighbourhoods(rows, keys, frac).checkpoint()
    weighted = rows.withColumn("r", F.lit(1.0))
    for turn in range(passes + 1):
        fitted = _fit_observations(weighted, near, keys).checkpoint()
        if turn == passes:
            break
        residual = rows.join(fitted, [*keys, "x"]).select(*keys, "x", "y", F.abs(F.col("y") - F.col("fit")).alias("a"))
        scales = residual.groupBy(*keys).agg(F.median("a").alias("mad")).checkpoint()
        share = F.coalesce(F.try_divide(F.col("a"), 6 * F.col("mad")), F.lit(0.0))
        bisquare = F.when(share < 1, F.pow(1 - share * share, F.lit(2.0))).otherwise(0.0)
        weighted = residual.join(scales, keys).select(*keys, "x", "y", bisquare.alias("r"))
    return rows.join(fitted, [*keys, "x"]).select(*by, *carry, "x", "y", "fit")
