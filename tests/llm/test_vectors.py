"""Top-k search and near-duplicate vectors against brute force."""

import math

import numpy as np
import pytest

from velomet.llm import forest, topk

SCHEMA = "vec_id long, embedding array<double>, label int, v int, b int, cell int, node int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, 1, 2, 3, 4) for i, v, l in rows], SCHEMA)


def awkward_rows(n=120, width=6):
    draw = np.random.default_rng(4)
    rows = [(i, draw.standard_normal(width).round(1).tolist(), int(i % 3)) for i in range(n)]
    rows += [(n + i, rows[5][1], rows[5][2]) for i in range(30)]  # equal vectors
    nan, inf = float("nan"), float("inf")
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * width, 1), (303, [nan] * width, 1), (304, [inf] * width, 1)]
    rows += [(305, [None] * width, 1), (306, [1.0, 2.0], 1), (307, rows[0][1], None), (None, rows[0][1], 0), rows[7], rows[7]]
    return rows


def usable(v, width):
    return v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)


def best(rows, k, every=20):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows if i is not None and v is not None and usable(v, len(v))]
    out = []
    for at, (q, vec) in enumerate(kept):
        if q % every == 0:
            others = (w for n, w in enumerate(kept) if n != at and len(w[1]) == len(vec))
            scored = sorted((-sum(a * b for a, b in zip(vec, w)), i) for i, w in others)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,group", [(10_000, 1_000), (16, 3), (1, 1)])
def test_top_k(spark, block, group):
    rows = awkward_rows(60 if block == 1 else 120)
    # Ids given twice, once with another vector; queries of other lengths; empty ones.
    rows += [rows[20], (40, rows[3][1], 0), (340, [1.0, 2.0], 1), (341, [3.0, -4.0], 1), (360, [], 1), (380, [5.0], 1)]
    got = topk.report(table(spark, rows), 20, 20, block, group)
    assert sorted(map(tuple, got.collect())) == best(rows, 20)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]


def test_top_k_small_tables(spark):
    assert topk.report(table(spark, [])).collect() == []
    rows = [(0, [1.0, 2.0], 0), (1, [3.0, -1.0], 0), (7, [0.0, 0.0], None)]
    assert sorted(map(tuple, topk.report(table(spark, rows)).collect())) == best(rows, 20)
    assert topk.report(table(spark, [(0, [1.0], 0)])).collect() == []


def test_search_stops_early():
    """One vector far ahead in every list: the bound ends the walk, the result stays exact."""
    draw = np.random.default_rng(1)
    block = draw.integers(-3, 4, (4_000, 8)).astype(float)
    block[:25] += 200
    ids = np.arange(4_000)
    q = np.abs(draw.integers(1, 5, (3, 8))).astype(float)
    a, b, s = topk.search_block(ids, ids, block, np.array([-1, -2, -3]), q, np.full(3, -np.inf), 20)
    for k in range(3):
        want = sorted((-x, i) for i, x in enumerate(block @ q[k]))[:20]
        assert sorted((-x, i) for x, i in zip(s[a == -1 - k], b[a == -1 - k])) == want


def links(rows, least=0.93):
    """Links and components over all pairs."""
    n = len(rows)
    unit = []
    for i, v, l in rows:
        ok = i is not None and l is not None and v and usable(v, len(v)) and any(v)
        x = np.array(v, float) if ok else None
        unit.append(None if x is None else x / np.sqrt((x * x).sum()))
    near = {k: [] for k in range(n)}
    for i in range(n):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                same = rows[i][1] == rows[j][1]
                if same or a @ b >= least:
                    near[i].append(j)
                    near[j].append(i)
    out, seen = [None] * n, [None] * n
    for i in range(n):
        if seen[i] is None:
            group, front = {i}, [i]
            while front:
                for j in near[front.pop()]:
                    if j not in group:
                        group.add(j)
                        front.append(j)
            for j in group:
                seen[j] = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
    for i in range(n):
        out[i] = (rows[i][0], len(near[i]), seen[i], rows[i][0] is None or rows[i][0] == seen[i])
    return sorted(out, key=str)


def clusters(count, size, width=16, noise=0.06):
    draw = np.random.default_rng(6)
    rows = []
    for c in range(count):
        centre = draw.standard_normal(width)
        centre /= np.linalg.norm(centre)
        rows += [(0, (centre + noise * draw.standard_normal(width)).tolist(), c % 2) for _ in range(size)]
    return [(i, v, l) for i, (_, v, l) in enumerate(rows)]


def test_forest_awkward(spark):
    rows = awkward_rows()
    assert sorted(map(tuple, forest.near_duplicates(table(spark, rows)).collect()), key=str) == links(rows)
    assert forest.near_duplicates(table(spark, [])).collect() == []


def test_forest_splits_and_finds(spark):
    rows = clusters(60, 12)
    got = sorted(map(tuple, forest.near_duplicates(table(spark, rows), leaf=40).collect()), key=str)
    want = links(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert there > 2_000 and found >= 0.9 * there
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_crowd_of_near_copies_in_tiles(spark, monkeypatch):
    """A cell that no split shrinks is compared in tiles, every pair once."""
    monkeypatch.setattr(forest, "TILE", 50)
    rows = clusters(1, 260, noise=0.01)
    got = forest.near_duplicates(table(spark, rows), trees=2, leaf=40)
    assert sorted(map(tuple, got.collect()), key=str) == links(rows)


def crowds(count, n, mean, width=64):
    """Rows of one label in crowds, two rows of a crowd having the mean cosine given."""
    draw = np.random.default_rng(11)
    centres = draw.standard_normal((count, width))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    away = draw.standard_normal((n, width)) / math.sqrt(width)
    return math.sqrt(mean) * centres[draw.integers(0, count, n)] + math.sqrt(1 - mean) * away


@pytest.mark.parametrize("count,n,mean,least", [(1, 6_000, 0.91, 1), (24, 12_000, 0.91, 0.998)])
def test_forest_keeps_links_of_large_labels(spark, count, n, mean, least):
    """Production parameters on one label of many rows: one crowd about the threshold, and many."""
    x = crowds(count, n, mean)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    there = np.concatenate([(unit[i : i + 2_000] @ unit.T >= 0.93).sum(1) - 1 for i in range(0, n, 2_000)])
    rows = [(i, v, 0) for i, v in enumerate(x.tolist())]
    got = {r["vec_id"]: r["n_links"] for r in forest.near_duplicates(table(spark, rows)).collect()}
    found = np.array([got[i] for i in range(n)])
    assert there.sum() > 10_000 and (found <= there).all() and found.sum() >= least * there.sum()


def test_real_vectors(spark, sf_dir):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    rows += [(10_000 + i, [x + 0.01 for x in v], l) for i, v, l in rows[:60]]
    got = sorted(map(tuple, forest.near_duplicates(table(spark, rows)).collect()), key=str)
    assert got == links(rows)


def test_labels_beyond_a_leaf_grow_trees(spark):
    """One label of 1,500 spread rows and one of 100: the first ends in many cells, the second in one that is not listed."""
    x = np.random.default_rng(3).standard_normal((1_600, 64))
    x[1_490:1_500] = x[:10] + 0.02
    rows = [(i, v, int(i >= 1_500)) for i, v in enumerate(x.tolist())]
    (grown,) = forest.remainder(table(spark, rows)).collect()
    assert grown["label"] == 0 and grown["nodes"] == 1_500 and grown["cells"] > forest.TREES
    assert grown["whole"] < 150 and grown["largest"] < 700
    assert sorted(map(tuple, forest.near_duplicates(table(spark, rows)).collect()), key=str) == links(rows)


def test_remainder_counts_a_crowd(spark):
    (crowd,) = forest.remainder(table(spark, clusters(1, 260, noise=0.01)), trees=2, leaf=40).collect()
    assert (crowd["nodes"], crowd["whole"], crowd["largest"], crowd["cells"]) == (260, 260, 260, 1)
