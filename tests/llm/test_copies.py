"""Groups of near copies against every pair's similarity."""

import random

import numpy as np
from edge import awkward, empty

from velomet.llm import copies, simhash


def plain_groups(texts, least):
    """The smallest key each text reaches over pairs of the asked similarity."""
    sets = {}
    for i, t in texts.items():
        words = (t or "").lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in texts}
    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if (len(x & y) / len(x | y) if x | y else 1.0) >= least:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return root


def edited(words, share, rng):
    """The words with a share of them, next to each other, replaced: similarity about 1 - share over 1 + share."""
    n = int(len(words) * share)
    at = rng.randrange(len(words) - n)
    return [*words[:at], *(f"new{rng.random()}" for _ in range(n)), *words[at + n :]]


def test_groups_equal_all_pairs(spark):
    """Tight groups, a group of texts at 0.6 to 0.9 of each other, chains and unlike texts."""
    rng = random.Random(3)
    made = []
    for group in range(6):
        words = [f"w{group}_{rng.randrange(400)}" for _ in range(300)]
        made += [" ".join(words)] + [" ".join(edited(words, 0.04, rng)) for _ in range(30)]
    crowd = [f"c{rng.randrange(400)}" for _ in range(300)]
    made += [" ".join(edited(crowd, rng.choice([0.1, 0.18, 0.25]), rng)) for _ in range(40)]
    chain = [f"d{rng.randrange(400)}" for _ in range(300)]
    for _ in range(8):
        made.append(" ".join(chain))
        chain = edited(chain, 0.08, rng)
    made += [" ".join(f"u{k}_{rng.randrange(900)}" for _ in range(200)) for k in range(60)]
    rng.shuffle(made)
    texts = dict(enumerate(made))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in copies.near_copies(docs, 5, 25, 2, 0.01, 0.8).collect()}
    want = plain_groups(texts, 0.8)
    assert got.keys() == want.keys()
    # No two texts are together that are not linked; few linked ones are apart.
    assert all(want[i] == want[c] for i, c in got.items())
    assert sum(got[i] == want[i] for i in got) >= 0.98 * len(got)


def test_awkward_rows(spark):
    from pyspark.sql import functions as F

    docs = awkward(spark).withColumn("doc_id", F.xxhash64("doc_id", "text"))
    rows = {(r["doc_id"], r["text"]) for r in docs.collect()}
    texts = dict(rows)
    got = copies.near_copies(docs, 5, 25, 2, 0.01, 0.8)
    assert got.count() == docs.count()
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == plain_groups(texts, 0.8)
    assert copies.near_copies(empty(spark), 5, 25, 2, 0.01, 0.8).count() == 0


def test_spanning_forest():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(2, 15))
        i, j = np.nonzero(np.triu(rng.random((n, n)) < 0.4, 1))
        d = rng.integers(0, 6, len(i))
        part, total = list(range(n)), 0
        for k in np.argsort(d, kind="stable"):
            a, b = part[i[k]], part[j[k]]
            if a != b:
                part, total = [a if p == b else p for p in part], total + d[k]
        tree = copies.spanning(i, j, d, n)
        assert d[tree].sum() == total and len(tree) == n - len(set(part))


def test_direct_links_are_close():
    """Every link is within the radius, and every row of a tight run is linked."""
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 2, dtype=np.uint64)
    rows = [base.copy() for _ in range(100)]
    for r in rows[1:]:
        for b in rng.choice(128, 7, replace=False):
            r[b // 64] ^= np.uint64(1 << int(b % 64))
    prints = [np.array([r[k] for r in rows]) for k in range(2)]
    for key, linked in ((np.zeros(100, np.int64), 100), (np.repeat(np.arange(10), 10), 100)):
        got = copies.direct_links(key, np.arange(100) * 7, prints, 25).to_pandas()
        d = simhash.distance([p[got["a"] // 7] for p in prints], [p[got["b"] // 7] for p in prints])
        assert (d == got["d"]).all() and (d <= 25).all()
        assert len(set(got["a"]) | set(got["b"])) == linked and len(got) < 100


def test_short_texts_whose_fingerprints_lie_apart(spark):
    """Of texts of few shingles, pairs of the asked similarity have fingerprints beyond the radius; none stays apart."""
    rng = random.Random(5)
    made = []
    for group in range(120):
        words = [f"s{group}_{rng.random()}" for _ in range(rng.randrange(10, 16))]
        made += [" ".join(words), " ".join([*words, f"t{group}"])]
    texts = dict(enumerate(made))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in copies.near_copies(docs, 5, 25, 2, 0.01, 0.8).collect()}
    assert got == plain_groups(texts, 0.8)


def test_crowd_around_the_similarity(spark, monkeypatch):
    """A crowd at 0.6 to 0.9, few links of which are those of a centre, in rounds of one pair of a shingle and two groups."""
    monkeypatch.setattr(copies, "PAIRS", 1)
    rng = random.Random(8)
    crowd = [f"c{rng.randrange(400)}" for _ in range(120)]
    texts = {i: " ".join(edited(crowd, rng.choice([0.1, 0.14, 0.2]), rng)) for i in range(70)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in copies.near_copies(docs, 5, 25, 2, 0.01, 0.8).collect()}
    assert got == plain_groups(texts, 0.8)


def test_rare_shingles_meet_for_all_pairs_of_the_similarity():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 60)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.93], rng.integers(0, 2**63, int(rng.integers(0, 4)), dtype=np.uint64)]))
        counts = rng.integers(0, 3, 1 << copies.SLOT_BITS)
        if len(b) and copies.similarity(a, b) >= 0.8:
            assert len(np.intersect1d(copies.prefix(a, counts, 0.8), copies.prefix(b, counts, 0.8)))
            apart = np.abs(copies.histogram(a).astype(int) - copies.histogram(b)).sum()
            assert apart <= len(np.setxor1d(a, b)) <= (len(a) + len(b)) / 9 + 1e-6
