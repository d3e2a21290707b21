"""Least squares with absorbed group effects, from sums that Spark computes.

A fit needs only sums of products of regressors. Rows become sparse (index, value) pairs, so
a categorical costs one entry and not one column per level, and the sums are one aggregation.
The driver solves a k x k system; k is the number of declared columns and does not grow with
the data.

One grouping (months, days) is absorbed instead of being spelled out as dummies. Its
contribution is removed from the sums by

    sum_rows x x'  -  sum_groups (sum x)(sum x)' / n

which equals demeaning every row first but keeps rows sparse. Standard errors of a contrast
w'b are sums over rows of the scalar influence h * u, where h = w'(X'X)^-1 x and u is the
residual, both demeaned within the group; the k x k sandwich is never formed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from velomet.fixed_values import HAC_MAX_LAGS, INTERVAL_Z

ONE, OUTCOME = 0, 1
RANK_TOLERANCE = 1e-10
#: The same for fits that are refined, and the most passes of refinement.
NEAR_RANK, REFINEMENTS = 1e-13, 6


@dataclass(frozen=True)
class Design:
    """Outcome, numeric regressors, categorical regressors, and the absorbed grouping.

    Level lists are in reference order: the first level that occurs is the reference. Without
    ``absorb`` only an intercept is absorbed.
    """

    outcome: str
    numbers: tuple[str, ...]
    levels: Mapping[str, Sequence] = field(default_factory=dict)
    absorb: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        dummies = [f"{c}={v}" for c, values in self.levels.items() for v in values]
        return ["one", "outcome", *self.numbers, *dummies]

    def groups(self) -> list[Column]:
        if not self.absorb:
            return [F.lit(0).alias("_all")]
        return [F.col(c) for c in self.absorb]

    def group_names(self) -> list[str]:
        return list(self.absorb) or ["_all"]

    def complete(self, df: DataFrame) -> DataFrame:
        """Rows on which every column of the model is known."""
        return df.dropna(subset=[self.outcome, *self.numbers, *self.levels])

    def _position(self, column: str) -> str:
        """SQL for the 1-based position of a row's level, 0 when it is not listed."""
        texts = ", ".join(_literal(v) for v in self.levels[column])
        return f"array_position(array({texts}), `{column}`)"

    def sparse(self) -> Column:
        """Row as sorted ``array<struct<i int, v double>>`` without zeros."""
        entries = [(f"{ONE}", "1D"), (f"{OUTCOME}", f"CAST(`{self.outcome}` AS DOUBLE)")]
        at = 2
        for c in self.numbers:
            entries.append((f"{at}", f"CAST(`{c}` AS DOUBLE)"))
            at += 1
        for c, values in self.levels.items():
            position = self._position(c)
            entries.append((f"CAST({position} + {at - 1} AS INT)", f"IF({position} > 0, 1D, 0D)"))
            at += len(values)
        structs = ", ".join(f"named_struct('i', {i}, 'v', {v})" for i, v in entries)
        return F.expr(f"filter(array({structs}), e -> e.v != 0 OR e.i <= {OUTCOME})")

    def score(self, weights: Mapping[str, float]) -> Column:
        """Weighted sum of a row's regressors; columns without a weight count 0."""
        terms = [f"{_literal(weights[c])} * `{c}`" for c in self.numbers if weights.get(c)]
        for c, values in self.levels.items():
            lookup = [float(weights.get(f"{c}={v}", 0.0)) for v in values]
            if any(lookup):
                table = ", ".join(_literal(w) for w in lookup)
                terms.append(f"coalesce(get(array({table}), CAST({self._position(c)} - 1 AS INT)), 0D)")
        return F.expr(" + ".join(["0D", *terms]))


def _literal(value) -> str:
    """A level or weight as a SQL literal; one parsed text replaces many small column calls."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def _pair_sums(arrays: DataFrame, value: Column, name: str) -> DataFrame:
    """Sum of products per index pair i <= j over arrays ``f`` of (i, v)."""
    left = arrays.select("f", "n", F.posexplode("f").alias("p", "a"))
    pairs = left.select("n", "a", F.explode(F.expr("slice(f, p + 1, size(f))")).alias("b"))
    return pairs.groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(F.sum(value).alias(name))


def moment_sums(df: DataFrame, design: Design) -> DataFrame:
    """Upper triangle of the raw and the absorbed moment matrix: i, j, raw, absorbed.

    Row pairs and group pairs are both combined below the shuffle; what travels is at most
    k(k+1)/2 sums per task. Groups of any size are fine: they are summed before they meet.
    """
    rows = design.complete(df).select(*design.groups(), design.sparse().alias("f"))
    product = F.col("a.v") * F.col("b.v")
    raw = _pair_sums(rows.select("f", F.lit(1.0).alias("n")), product, "raw")
    keys = design.group_names()
    sums = (
        rows.select(*keys, F.explode("f").alias("e"))
        .groupBy(*keys, F.col("e.i").alias("i"))
        .agg(F.sum("e.v").alias("v"))
    )
    # At most one entry per declared column: this list is bounded by the design.
    per_group = sums.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("i", "v"))).alias("f"),
        F.max(F.when(F.col("i") == ONE, F.col("v"))).alias("n"),
    )
    absorbed = _pair_sums(per_group.select("f", "n"), product / F.col("n"), "absorbed")
    both = raw.withColumn("absorbed", F.lit(0.0)).unionByName(absorbed.withColumn("raw", F.lit(0.0)))
    return both.groupBy("i", "j").agg(F.sum("raw").alias("raw"), F.sum("absorbed").alias("absorbed"))


@dataclass
class Moments:
    """Moment matrices of a design on the driver."""

    design: Design
    raw: np.ndarray
    within: np.ndarray

    @property
    def n(self) -> int:
        return int(round(self.raw[ONE, ONE]))

    @property
    def total_squares(self) -> float:
        return float(self.raw[OUTCOME, OUTCOME] - self.raw[ONE, OUTCOME] ** 2 / self.raw[ONE, ONE])

    def columns(self) -> list[int]:
        """Indices of numeric columns and of occurring, non-reference levels."""
        return self.number_columns() + [i for c in self.design.levels for i in self.level_columns(c)]

    def number_columns(self, names: Sequence[str] | None = None) -> list[int]:
        wanted = self.design.numbers if names is None else names
        return [2 + self.design.numbers.index(c) for c in wanted]

    def level_columns(self, name: str) -> list[int]:
        at = 2 + len(self.design.numbers)
        for c, values in self.design.levels.items():
            if c == name:
                occurring = [at + k for k in range(len(values)) if self.raw[at + k, at + k] > 0]
                return occurring[1:]
            at += len(values)
        raise KeyError(name)


def collect_moments(df: DataFrame, design: Design) -> Moments:
    k = len(design.names)
    raw, absorbed = np.zeros((k, k)), np.zeros((k, k))
    for row in moment_sums(df, design).collect():
        raw[row.i, row.j] = raw[row.j, row.i] = row.raw
        absorbed[row.i, row.j] = absorbed[row.j, row.i] = row.absorbed
    return Moments(design, raw, raw - absorbed)


@dataclass
class Fit:
    """Coefficients by name, the inverse of the moment matrix, and the residual squares."""

    names: list[str]
    beta: np.ndarray
    inverse: np.ndarray
    residual_squares: float

    @property
    def weights(self) -> dict[str, float]:
        return dict(zip(self.names, map(float, self.beta)))

    def point(self, contrast: Mapping[str, float]) -> float:
        return sum(w * self.weights[c] for c, w in contrast.items() if c in self.weights)

    def influence(self, contrast: Mapping[str, float]) -> dict[str, float]:
        """(X'X)^-1 w by column; names the model lacks are skipped."""
        w = np.array([contrast.get(c, 0.0) for c in self.names])
        return dict(zip(self.names, map(float, self.inverse @ w)))


def solve(moments: Moments, columns: Sequence[int] | None = None, tolerance: float = RANK_TOLERANCE) -> Fit:
    """Least squares on chosen columns, by pseudo-inverse so that collinear columns are allowed: those whose part
    beyond the others is below ``tolerance`` of the largest, in squares."""
    cols = list(moments.columns() if columns is None else columns)
    a = moments.within[np.ix_(cols, cols)]
    b = moments.within[cols, OUTCOME]
    size = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    inverse = np.linalg.pinv(a / np.outer(size, size), rcond=tolerance, hermitian=True)
    inverse = inverse / np.outer(size, size)
    beta = inverse @ b
    residual = float(moments.within[OUTCOME, OUTCOME] - b @ beta)
    return Fit([moments.design.names[c] for c in cols], beta, inverse, residual)


def centred(df: DataFrame, design: Design) -> DataFrame:
    """The complete rows with outcome and numbers less their overall means, which no slope depends on.

    Sums of squares of what is left do not cancel as those of values far from zero do.
    """
    rows = design.complete(df)
    names = [design.outcome, *design.numbers]
    means = rows.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{k}") for k, c in enumerate(names)]).first()
    return rows.withColumns({c: F.col(c).cast("double") - F.lit(float(m or 0.0)) for c, m in zip(names, means)})


def stable_fit(
    df: DataFrame, design: Design, columns: Sequence[int] | None = None, steps: int = REFINEMENTS, tolerance: float = NEAR_RANK
) -> Fit:
    """Least squares for regressors that are nearly collinear, by refining the solution of the sums.

    Sums of products square the condition of a design, so what they lose is made up by passes over the rows:
    each computes the residuals of the coefficients so far, row by row and in full precision, sums their products with the
    regressors as the sums of a design whose outcome they are, and adds what these leave to explain. A pass gains as many
    digits as the sums still have right, so a few suffice for conditions of up to about 10^6; it stops
    when a pass no longer moves anything. ``residual_squares`` are those of the last residuals.
    """
    rows = centred(df, design).persist()
    try:
        moments = collect_moments(rows, design)
        fit = solve(moments, columns, tolerance)
        cols = [design.names.index(name) for name in fit.names]
        left = replace(design, outcome="_left")
        for _ in range(steps):
            residuals = rows.withColumn("_left", F.col(design.outcome).cast("double") - design.score(fit.weights))
            found = collect_moments(residuals, left).within
            fit.residual_squares = float(found[OUTCOME, OUTCOME])
            step = fit.inverse @ found[cols, OUTCOME]
            if not np.abs(step).max(initial=0.0) > 1e-14 * np.abs(fit.beta).max(initial=0.0):
                break
            fit.beta = fit.beta + step
        return fit
    finally:
        rows.unpersist()


def _influence_columns(fit: Fit, design: Design, contrasts: Mapping[str, Mapping[str, float]]) -> dict[str, Column]:
    columns = {"_e": F.col(design.outcome) - design.score(fit.weights)}
    for k, contrast in enumerate(contrasts.values()):
        columns[f"_h{k}"] = design.score(fit.influence(contrast))
    return columns


def hac_sums(
    df: DataFrame,
    design: Design,
    fit: Fit,
    contrasts: Mapping[str, Mapping[str, float]],
    order: str,
    max_lags: int = HAC_MAX_LAGS,
) -> DataFrame:
    """Newey-West variance per contrast: (contrast, variance). Lags count rows in ``order``.

    Bartlett weights 1 - l / (max_lags + 1), no small-sample factor. Contrasts run side by side,
    one window partition each; rows are calendar-grain.
    """
    names = list(contrasts)
    within = Window.partitionBy(*design.group_names())
    rows = design.complete(df)
    if not design.absorb:
        rows = rows.withColumn("_all", F.lit(0))
    rows = rows.withColumns(_influence_columns(fit, design, contrasts))

    def demeaned(c: str) -> Column:
        return F.col(c) - F.avg(c).over(within)

    psi = rows.select(
        F.col(order).alias("at"),
        demeaned("_e").alias("u"),
        *[demeaned(f"_h{k}").alias(f"h{k}") for k in range(len(names))],
    )
    stacked = psi.select(
        "at",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("contrast"), (F.col(f"h{k}") * F.col("u")).alias("psi"))
                    for k, name in enumerate(names)
                ]
            )
        ),
    )
    line = Window.partitionBy("contrast").orderBy("at")
    weighted = F.lit(0.0)
    for lag in range(1, max_lags + 1):
        weighted = weighted + F.lit(1 - lag / (max_lags + 1)) * F.lag("psi", lag, 0.0).over(line)
    return (
        stacked.withColumn("behind", weighted)
        .groupBy("contrast")
        .agg(F.sum(F.col("psi") * (F.col("psi") + 2 * F.col("behind"))).alias("variance"))
    )


def cluster_sums(
    df: DataFrame, design: Design, fit: Fit, contrasts: Mapping[str, Mapping[str, float]]
) -> DataFrame:
    """Squared influence summed per absorbed group: one row with groups, rows and ``m<k>``.

    Within a group the sum of h(u - mean u) is sum(h e) - sum(h) sum(e) / n, so one partial
    aggregation per group is enough and no row has to be demeaned.
    """
    rows = design.complete(df).withColumns(_influence_columns(fit, design, contrasts))
    h = [f"_h{k}" for k in range(len(contrasts))]
    groups = rows.groupBy(*design.absorb).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_e").alias("e"),
        *[F.sum(c).alias(f"s{c}") for c in h],
        *[F.sum(F.col(c) * F.col("_e")).alias(f"p{c}") for c in h],
    )

    def meat(c: str) -> Column:
        g = F.col(f"p{c}") - F.col(f"s{c}") * F.col("e") / F.col("n")
        return F.sum(g * g)

    return groups.agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("n").alias("rows"),
        *[meat(c).alias(f"m{k}") for k, c in enumerate(h)],
    )


def cluster_factor(groups: int, rows: int, columns: int) -> float:
    """Usual small-sample factor of clustered covariance; NaN with one group or no spare row."""
    if groups < 2 or rows == columns:
        return float("nan")
    return groups / (groups - 1) * (rows - 1) / (rows - columns)


def percent_effect(beta: float, variance: float) -> tuple[float | None, ...]:
    """Log-scale effect and its interval in percent.

    With more columns than rows the variance is no number or negative: the interval is NULL.
    """
    point = float(np.expm1(beta) * 100)
    if not variance >= 0:
        return point, None, None
    half = INTERVAL_Z * float(np.sqrt(variance))
    return point, float(np.expm1(beta - half) * 100), float(np.expm1(beta + half) * 100)
