"""Exact top-k inner products by Fagin's threshold algorithm over sorted per-dimension lists.

Candidates are cut into blocks and queries into groups, both of vectors of one length. A task holds one block and
one group: it sorts the block once per dimension, and for every query walks down the lists of all dimensions at the same depth, from the large end
where the query's component is positive and from the small end where it is negative. What is met is scored
in full. At any depth, no vector not yet met can score more than the inner product of the query with the
list entries at that depth, so a query stops where this bound falls below its kth score. A bound equal to
the kth score does not stop it: a smaller id could still win the tie.

The kth score over a fixed set of the rows, taken first, is a lower bound of the final one, so it starts the
search of every block and most blocks end early or return few rows. Blocks and groups have a fixed size and their
number follows the rows, so no task grows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from velomet.llm.work import keep

#: Rows of a block of candidates and of a group of queries.
BLOCK, GROUP = 8_192, 4_096
#: Fractions of a block's depth at which the bound is looked at.
DEPTHS = (0.002, 0.008, 0.03, 0.1, 0.3)


def finite(vector: Column) -> Column:
    """True for vectors that are not null and hold neither null nor non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def search_block(
    ids: np.ndarray, rows: np.ndarray, block: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k of a block for every query that score at least its floor: the query's row, id and score.
    A query's own row, by its number, is not met.

    Components are whole numbers whose products sum to well under 2^53, so doubles hold scores exactly.
    """
    n, width = block.shape
    order = np.argsort(block, axis=0, kind="stable")
    lists = np.take_along_axis(block, order, axis=0)
    depths = sorted({min(n, max(k, math.ceil(f * n))) for f in DEPTHS} | {n})
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    # Bound at depth t for every query: what the t-th entries from the right end of each list allow.
    bounds = np.stack([up @ lists[n - t] + down @ lists[t - 1] for t in depths], axis=1)
    rising = [np.ascontiguousarray(order[:, d][::-1]) for d in range(width)]
    falling = [np.ascontiguousarray(order[:, d]) for d in range(width)]
    out = []
    for q in range(len(queries)):
        query, least = queries[q], floor[q]
        if bounds[q, 0] < least and depths[0] == n:
            continue
        walk = [rising[d] if query[d] > 0 else falling[d] for d in np.flatnonzero(query)] or [np.arange(n)]
        met = np.zeros(n, bool)
        scores = np.empty(0)
        at = np.empty(0, np.int64)
        done = 0
        for i, t in enumerate(depths):
            fresh = np.zeros(n, bool)
            if t == n:
                fresh[:] = True
            else:
                for ranked in walk:
                    fresh[ranked[done:t]] = True
            fresh &= ~met
            met |= fresh
            done = t
            new = np.flatnonzero(fresh)
            found = block[new] @ query
            good = (found >= least) & (rows[new] != query_rows[q])
            scores, at = np.concatenate([scores, found[good]]), np.concatenate([at, new[good]])
            if len(scores) > k:
                best = np.lexsort((ids[at], -scores))[:k]
                scores, at = scores[best], at[best]
            if len(scores) == k:
                least = max(least, scores.min())
            if bounds[q, i] < least:
                break
        out.append((np.full(len(at), query_rows[q]), ids[at], scores))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.array(rows.tolist(), dtype=np.float64).reshape(len(rows), -1)


def top_k(candidates: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every query row, ties to the smaller id.

    Both tables have row, a number of the row's own, vec_id and v, an array of whole numbers. A candidate with the
    query's row number is not its own result; rows that share an id are candidates, and queries, each for
    itself. A query meets the candidates whose vectors are as long as its own. Fewer than k candidates: all. A
    query without candidates has no rows.
    """
    sizes = keep(
        candidates.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
        .join(queries.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("m")), "width")
        .select("width", F.ceil(F.col("n") / block).cast("int").alias("blocks"), F.ceil(F.col("m") / group).cast("int").alias("groups"))
    )
    schema = "query_row long, query_id long, vec_id long, score double"
    part = lambda name, parts, seed: F.pmod(F.xxhash64(name, F.lit(seed)), F.col(parts)).cast("int")
    c = candidates.withColumn("width", F.size("v")).join(sizes, "width").withColumn("b", part("row", "blocks", 1))
    # Names of its own, since queries are often rows of the same table.
    q = (
        queries.select(F.size("v").alias("width"), F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
        .join(sizes, "width").withColumn("g", part("query_row", "groups", 2))
    )
    best = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """left: a block of candidates; right: a group of queries with their floors."""
        if not len(left) or not len(right):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
        a, b, s = search_block(
            left["vec_id"].to_numpy(),
            left["row"].to_numpy(),
            _matrix(left["v"]),
            right["query_row"].to_numpy(),
            _matrix(right["q"]),
            right["floor"].to_numpy(),
            k,
        )
        asking = right["query_id"].set_axis(right["query_row"])[a].to_numpy()
        return pd.DataFrame({"query_row": a, "query_id": asking, "vec_id": b, "score": s})

    def tiles(rows: DataFrame, asked: DataFrame, met: Column) -> DataFrame:
        """Every block of a length with every group of queries of that length, a task per pair."""
        left = rows.select("width", "b", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"), "row", "vec_id", "v")
        right = asked.select("width", F.explode(met).alias("b"), "g", "query_row", "query_id", "q", "floor")
        return left.groupBy("width", "b", "g").cogroup(right.groupBy("width", "b", "g")).applyInPandas(search, schema)

    # Block 0 of every length first: its kth score is a floor for the others.
    opening = keep(tiles(c.where("b = 0"), q.withColumn("floor", F.lit(float("-inf"))), F.array(F.lit(0))))
    floors = opening.groupBy("query_row").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("f"))
    asked = q.where("blocks > 1").join(floors, "query_row", "left").withColumn("floor", F.coalesce("f", F.lit(float("-inf"))))
    found = opening.union(tiles(c.where("b > 0"), asked, F.sequence(F.lit(1), F.col("blocks") - 1)))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


def quantised(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and v = floor(scale * x) of every component, of the vectors that can be searched: null
    vectors, vectors that hold null or non-finite components and rows without an id take no part."""
    v = F.col("embedding").cast("array<double>")
    usable = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("e")).where(
        finite(F.col("e")) & F.col("vec_id").isNotNull()
    )
    # Doubles that hold whole numbers: what the search multiplies.
    return usable.select("vec_id", F.transform("e", lambda x: F.floor(x * scale).cast("double")).alias("v"))


def report(embeddings: DataFrame, k: int = 20, every: int = 20, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """The k nearest of every row whose id is divisible by `every`, over all other rows.

    Rows of an id are rows of their own: each is a candidate of all queries but itself, the query of the same id
    included, and each is a query, with ranks of its own. Vectors of different lengths have no inner product,
    so a query meets those as long as itself; empty vectors score 0 with one another. An empty table gives no rows.
    """
    v = keep(quantised(embeddings).withColumn("row", F.monotonically_increasing_id()))
    return top_k(v, v.where(F.col("vec_id") % every == 0), k, block, group)


REPORT_SQL = """
WITH usable AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row_no, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND c.row_no <> q.row_no AND len(c.v) = len(q.v)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
