"""Hard negatives: against all pairs of small tables, ties, copies, hot labels and awkward rows."""

import numpy as np
import pytest

from velomet.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row long, cells string, width string, score double, opened string"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(table, every=100):
    usable = []
    for k, (i, v, label) in enumerate(table):
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        usable.append((i, k, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * x)) for x in v]))
    out = []
    for i, k, label, v in usable:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m, other) for j, m, other, w in usable if m != k and len(w) == len(v)]
        for p, pid, _, _ in sorted(s for s in scored if s[3] == label)[:5]:
            near = [(s, j) for s, j, _, other in sorted(scored) if other != label and 80 * -p <= 100 * -s <= 100 * -p]
            out += [(i, pid, r, j, -p, -s) for r, (s, j) in enumerate(near[:5], 1)]
    return sorted(out)


def run(spark, table, **how):
    df = spark.createDataFrame([(i, v, label, 1, "x", "y", 0.5, "z") for i, v, label in table], SCHEMA)
    return sorted(tuple(r[c] for c in NAMES) for r in negatives.report(df, **how).collect())


def made(n, width, labels, seed, crowd=0.0, first=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(3, width))
    v = base[rng.integers(0, 3, n)] * crowd + rng.normal(size=(n, width)) * 0.3
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(first + i, v[i].tolist(), int(rng.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 60)
    monkeypatch.setattr(negatives, "GROUP", 2)
    table = made(700, 16, (1, 2, 10)[seed], seed, crowd=1.0)
    got = run(spark, table)
    assert got == brute(table) and (seed == 0 or len(got) > 50)


def test_ties_copies_and_hot_label(spark):
    one, other = [0.5, 0.5, 0.25], [0.5, 0.25, 0.5]
    table = [(i, one, 3) for i in range(-300, 300)] + [(1_000 + i, other if i % 2 else one, 4) for i in range(300)]
    table += [(200, one, 3), (200, other, 5)]  # repeated ids
    assert run(spark, table) == brute(table)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    table = [(0, [0.1, 0.2], 1), (100, [0.2, 0.2], 1), (1, [0.3, 0.1], 1), (2, [0.1, 0.3], 2), (3, [0.2, 0.1], 2), (200, [0.0, 0.0], 2)]
    table += [(4, None, 1), (5, [None, 0.1], 2), (6, [nan, 0.1], 2), (8, [inf, 0.1], 1), (None, [0.1, 0.1], 1), (9, [0.1, 0.1], None), (10, [], 1)]
    table += [(300, [1.0, 2.0, 3.0], 1), (11, [1.0, 2.0, 2.5], 1), (12, [1.0, 2.0, 2.9], 2)]  # another length
    table += [(400, [-1.0, 0.1], 6), (13, [1.0, 0.1], 6), (14, [0.9, 0.0], 2)]  # a positive below zero
    table += [(15, [3e5, 1.0, 1e6], 1), (16, [2e5, 5.0, 1e6], 2), (500, [4e5, 1.0, 1e6], 2)]  # beyond two bytes and doubles
    assert run(spark, table) == brute(table)
    assert run(spark, []) == []


def test_keys_sort_as_they_should():
    rng = np.random.default_rng(3)
    rows = [(int(a), int(s), int(r), int(i), int(k)) for a, s, r, i, k in zip(*rng.integers(-50, 50, (5, 500)))]
    rows = [(abs(a) << 33, s << 40, r % 2, i << 50, abs(k) << 33) for a, s, r, i, k in rows]
    packed = sorted(negatives.pack(*row) for row in rows)
    assert [negatives.unpack(p) for p in packed] == sorted(rows, key=lambda x: (x[0], -x[1], *x[2:]))


def test_the_walk_holds_only_open_windows():
    """A stream far longer than memory would hold; the walk is lazy and stops feeding full windows."""
    def stream():
        yield negatives.pack(1, 1_000, 0, 7, 7), None
        for k in range(200_000):
            yield negatives.pack(1, 1_000, 1, k, k), None
    assert [r[3] for r in negatives.mined(stream(), 5, 80)] == [0, 1, 2, 3, 4]
