"""Cubic B-spline basis as column expressions, with remembered knots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

DEGREE = 3


@dataclass(frozen=True)
class Knots:
    """Boundary and inner knots; ``basis`` gives the columns for any value within the boundary."""

    low: float
    high: float
    inner: tuple[float, ...]

    @property
    def full(self) -> list[float]:
        return [self.low] * (DEGREE + 1) + list(self.inner) + [self.high] * (DEGREE + 1)

    def basis(self, x: Column) -> list[Column]:
        """All basis functions but the first, which an intercept makes redundant."""
        t = self.full
        last = max(i for i in range(len(t) - 1) if t[i] < t[i + 1])
        level: list[Column | None] = []
        for i in range(len(t) - 1):
            if t[i] == t[i + 1]:
                level.append(None)
                continue
            right = x <= t[i + 1] if i == last else x < t[i + 1]
            level.append(F.when((x >= t[i]) & right, 1.0).otherwise(0.0))
        for d in range(1, DEGREE + 1):
            raised: list[Column | None] = []
            for i in range(len(level) - 1):
                parts = []
                if level[i] is not None and t[i + d] > t[i]:
                    parts.append((x - t[i]) / (t[i + d] - t[i]) * level[i])
                if level[i + 1] is not None and t[i + d + 1] > t[i + 1]:
                    parts.append((t[i + d + 1] - x) / (t[i + d + 1] - t[i + 1]) * level[i + 1])
                raised.append(parts[0] + parts[1] if len(parts) == 2 else (parts[0] if parts else None))
            level = raised
        return [F.lit(0.0) if c is None else c for c in level[1:]]


def quantile_knots(df: DataFrame, column: str, columns_out: int = 5) -> Knots | None:
    """Inner knots at equally spaced quantiles so that the basis has ``columns_out`` columns; None without values."""
    n_inner = columns_out - DEGREE
    at = [(k + 1) / (n_inner + 1) for k in range(n_inner)]
    row = df.agg(
        F.min(column).alias("low"),
        F.max(column).alias("high"),
        F.percentile(column, F.array(*[F.lit(q) for q in at])).alias("inner"),
    ).first()
    if row.low is None:
        return None
    return Knots(float(row.low), float(row.high), tuple(map(float, row.inner)))
