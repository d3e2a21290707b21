"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomet.llm.work import discard, keep

#: Edges of a batch.
ROWS = 50_000


def stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges (a, b) of one task as stars: each node they connect, with the smallest node it reaches by them."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for at in range(0, len(nodes), ROWS):
        part = nodes[at : at + ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(map(find, part), pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b), root being the smallest node it can reach.

    Both steps are a minimum per node, which is summed up below the shuffle, and a join that puts it
    back on the node's edges, so a node with very many edges is split like any other skewed join. Every
    round is written to the shared folder and replaces the one before. Loops and null ends are ignored;
    an edge may be given in any direction and any number of times. Empty edges give an empty table.
    """
    # Dealt by the greater end, a node's links to many small ones meet in one task, which hangs all it connects on the
    # smallest. In a tight group that is the same node in most tasks, so of links between small ones, which most tasks
    # hold, one is left: a group keeps few more edges than it has nodes, however many were found.
    now = keep(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .repartition("a")
        .mapInArrow(stars, "a long, b long")
        .distinct()
    )
    seen = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        after = keep(
            small.where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small.select("a", F.col("m").alias("b")))
            .distinct()
        )
        mark = after.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        discard(now)
        now = after
        if mark == seen or mark[0] == 0:
            break
        seen = mark
    # Stars now: every node but the root points at the root.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
