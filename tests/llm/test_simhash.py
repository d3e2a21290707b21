"""SimHash against fingerprints made bit by bit and components over all pairs."""

import random

import numpy as np
import xxhash
from edge import awkward, empty, rows

from velomet.llm import simhash
from velomet.llm.components import components


def plain_fingerprint(text, size=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints, radius):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(prints))]


def check(spark, docs, radius=4):
    given = docs.select("doc_id", "text").collect()
    found = simhash.near_duplicates(docs, 4, radius).collect()
    assert len(found) == len(given)
    prints = [plain_fingerprint(r["text"]) for r in given]
    groups = plain_components(prints, radius)
    least = {}
    for r, g in zip(given, groups):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, f"{p:016x}", least.get(g)) for r, p, g in zip(given, prints, groups))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in found) == want


def test_awkward_texts(spark):
    check(spark, awkward(spark))


def test_no_rows(spark):
    assert simhash.near_duplicates(empty(spark), 4, 4).collect() == []


def test_whole_table(spark, sf_dir):
    check(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_near_copies_join_over_others(spark):
    draw = random.Random(5)
    base = [draw.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(draw.randint(0, 50)) for _ in range(400)]
    texts = []
    for k in range(40):  # a chain: each differs from the last by a word
        base = [*base]
        base[draw.randrange(len(base))] = f"new{k}"
        texts.append(" ".join(base))
    check(spark, spark.createDataFrame(rows(*texts), "doc_id long, text string, lang string, source string, n_chars int, f0 string, t string, ids string, score string, a string"))


def test_every_close_pair_shares_a_key():
    draw = np.random.default_rng(1)
    masks = simhash.pigeonhole_masks(1, 4)
    for _ in range(300):
        a = int(draw.integers(0, 2**63))
        b = a
        for bit in draw.choice(64, size=4, replace=False).tolist():
            b ^= 1 << bit
        assert any(a & m == b & m for (m,) in masks)
        # and, within a key, one of the finer blocks of the free bits
        (shared,) = next(m for m in masks if a & m[0] == b & m[0])
        assert any(a & m == b & m for (m,) in simhash.finer_masks((shared,), 4))


def test_crowded_keys_lose_no_link(spark, monkeypatch):
    """With every key of more than two rows counted as crowded, and every run walked, results stay."""
    monkeypatch.setattr(simhash, "CROWDED", 2)
    monkeypatch.setattr(simhash, "SHORT", 1)
    draw = np.random.default_rng(3)
    prints = []
    for centre in draw.integers(0, 2**63, 6).tolist():
        for _ in range(20):
            x = centre
            for bit in draw.choice(64, size=draw.integers(0, 6), replace=False).tolist():
                x ^= 1 << bit
            prints.append(x)
    prints = sorted(set(prints))
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    nodes = spark.createDataFrame([(s, s) for s in signed], "node long, f0 long")
    edges = simhash.close_pairs(nodes, 1, 4, simhash.pigeonhole_masks(1, 4))
    root = {r["node"]: r["root"] for r in components(edges).collect()}
    want = plain_components(prints, 4)
    got = {}
    for s, g in zip(signed, want):
        got.setdefault(g, set()).add(root.get(s, s))
    assert all(len(x) == 1 for x in got.values()) and len({next(iter(x)) for x in got.values()}) == len(got)


def test_sampled_masks_find_wide_pairs(spark):
    draw = np.random.default_rng(8)
    found = 0
    masks = simhash.sampled_masks(2, 25, 5_000, 0.01)
    for _ in range(200):
        a = [int(x) for x in draw.integers(0, 2**63, 2)]
        b = [*a]
        for bit in draw.choice(128, size=16, replace=False).tolist():
            b[bit // 64] ^= 1 << bit % 64
        found += any(all(x & m == y & m for x, y, m in zip(a, b, mask)) for mask in masks)
    assert found >= 190


def test_sampled_masks_miss_no_more_on_many_rows():
    """At every distance up to the radius, for the number of rows of a large corpus."""
    draw = np.random.default_rng(12)
    masks = np.array(simhash.sampled_masks(2, 25, 10_000_000, 0.01), dtype=np.uint64)
    for apart in (19, 22, 25):
        flips = [simhash.as_words(draw.choice(128, size=apart, replace=False).tolist(), 2) for _ in range(2_000)]
        flips = np.array(flips, dtype=np.uint64)
        missed = np.mean([((f & masks) != 0).any(1).all() for f in flips])
        assert missed <= 0.02, (apart, missed)


def test_keys_in_several_goes(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(200)
    whole = sorted(map(str, simhash.near_duplicates(docs, 5, 25, 2, 0.01).collect()))
    monkeypatch.setattr(simhash, "KEYS", 16)
    assert sorted(map(str, simhash.near_duplicates(docs, 5, 25, 2, 0.01).collect())) == whole


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(64)]
    edges += [(5, 5), (None, 3), *edges[:10]]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
