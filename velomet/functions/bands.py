"""Right-closed binning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def band(c: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """Label of the interval ``(edges[i], edges[i+1]]`` a value falls in, NULL outside all.

    Right-closed, so 32.0 belongs to the band that ends at 32 (the ML bucketizer is left-closed).
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("one label per interval is needed")
    low = F.lit(float(edges[0]))
    chain = None
    for edge, label in zip(edges[1:], labels):
        inside = (c > low) & (c <= F.lit(float(edge)))
        chain = F.when(inside, F.lit(label)) if chain is None else chain.when(inside, F.lit(label))
    return chain


def hour_range_indicator(hour: Column, first: int, last: int) -> Column:
    return hour.between(first, last).cast("double")
