"""The language model: base scores by hand, seatings against the exact law, probabilities that sum to one."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import awkward, empty
from pyspark.sql import functions as F

from velomet.llm import hpylm


def plain_base(docs):
    rows = docs.select("doc_id", "text").collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    c = Counter(x for r in rows if not held(r["doc_id"]) for x in tokens(r["text"]))
    n, v = sum(c.values()), len(c)
    out = []
    for r in rows:
        w = tokens(r["text"])
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        out.append((r["doc_id"], held(r["doc_id"]), len(w), sum(x in c for x in w), n, round(base, 6)))
    return sorted(out, key=str)


def check(docs):
    got = hpylm.score(docs).collect()
    assert sorted(((*r[:5], round(r["base_score"], 6)) for r in got), key=str) == plain_base(docs)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    return got


def test_awkward_texts(spark):
    check(awkward(spark))
    assert hpylm.score(empty(spark)).collect() == []


def test_no_training_texts(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    check(spark.createDataFrame([(held, "a b")], "doc_id long, text string"))


def test_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = check(docs)
    for held in (True, False):
        mine = [r for r in got if r["held_out"] == held]
        n = sum(r["n_tokens"] for r in mine)
        assert 10 ** (-sum(r["score"] for r in mine) / n) < 0.6 * 10 ** (-sum(r["base_score"] for r in mine) / n)
    again = {r["doc_id"]: r["score"] for r in hpylm.score(docs).collect()}
    assert all(again[r["doc_id"]] == pytest.approx(r["score"]) for r in got)


def test_common_words_and_many_buckets(spark, sf_dir, monkeypatch):
    """Small buckets and runs: words spread over buckets, batches over runs; counts stay exact."""
    monkeypatch.setattr(hpylm, "BUCKET", 8_000)
    monkeypatch.setattr(hpylm, "RUN", 5_000)
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@pytest.mark.parametrize("extra", [{}, {"COMMON_SHARE": 0.05, "BUCKET": 40}, {"CONTEXT_SHARE": 0.2}])
def test_probabilities_sum_to_one(spark, monkeypatch, extra):
    """After every context, known words, the end and one unknown word have probability one in all."""
    for k, v in extra.items():
        monkeypatch.setattr(hpylm, k, v)
    draw = np.random.default_rng(0)
    words = list("abcdefgh")
    chance = [0.3, 0.2, 0.1, 0.1, 0.1, 0.1, 0.05, 0.05]
    p = predictive(spark, [(i, " ".join(draw.choice(words, size=9, p=chance))) for i in range(400)])
    for context in [None, *words]:
        assert sum(p(context, w) for w in [*words, "\n", None]) == pytest.approx(1)


@pytest.mark.parametrize("extra", [{}, {"BUCKET": 8_000, "RUN": 5_000}])
def test_infrequent_contexts_have_restaurants(spark, sf_dir, monkeypatch, extra):
    """With no context frequent enough for the table of contexts the model is the same but for the draws."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = check(docs)
    for k, v in ({"CONTEXT_SHARE": 2.0} | extra).items():
        monkeypatch.setattr(hpylm, k, v)
    apart = check(docs)
    for held in (True, False):
        of = lambda rows: sum(r["score"] for r in rows if r["held_out"] == held) / sum(r["n_tokens"] for r in rows if r["held_out"] == held)
        assert of(apart) == pytest.approx(of(whole), rel=0.005)


def test_texts_sum_to_one_without_frequent_contexts(spark, monkeypatch):
    """All texts of known words and one unknown word have probability one in all. With S of a text, the step from w to x
    weighs S(w x) / S(x), every start 1 and an end after w S(w), which leaves every text's product as it is."""
    monkeypatch.setattr(hpylm, "CONTEXT_SHARE", 2.0)
    held = [i for i in range(4_000) if zlib.crc32(str(i).encode()) % 7 == 2]
    draw = np.random.default_rng(0)
    words = [*"abcdefgh", "unknown"]
    texts = ["", *words, *(f"{w} {x}" for w in words for x in words)]
    rows = [(i, " ".join(draw.choice(words[:-1], size=9))) for i in range(400) if i not in held]
    rows += list(zip(held, texts))
    got = {r["doc_id"]: 10 ** r["score"] for r in hpylm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    of = {text: got[i] for i, text in zip(held, texts)}
    end = np.array([of[w] for w in words])
    step = np.array([[of[f"{w} {x}"] / of[x] for x in words] for w in words])
    assert of[""] + np.linalg.solve(np.eye(len(words)) - step, end).sum() == pytest.approx(1)


def predictive(spark, rows):
    """The model's probability of a word after a context, by its rule from the seatings that the steps draw."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = hpylm._training(docs)
    counts = hpylm.count_words(texts)
    pairs = hpylm.count_pairs(texts, counts).collect()
    width = len(counts.contexts) + 1
    customers, opened = np.zeros(width), np.zeros(width)
    for r in pairs:
        for c, n in zip(r["contexts"], r["n"]):
            customers[c] += n
            opened[c] += 1
    start = hpylm.State(customers, opened, float(opened[1:].sum() + customers[0]), float(counts.words), {})
    df = spark.createDataFrame(pairs, "bucket int, word long, contexts array<int>, n array<long>")
    seated = hpylm.keep(hpylm.seated(df, counts, start, (0.5, 0.5), 1))
    state = hpylm.totals(seated, counts, 0, 1)
    of_word = {}
    for r in seated.collect():
        row = of_word.setdefault(r["word"], {"c": 0, "t": 0, "pairs": {}})
        row["c"] += sum(r["t"])
        row["t"] = max(row["t"], r["top"][0])
        row["pairs"] |= {c: (n, t) for c, n, t in zip(r["contexts"], r["n"], r["t"])}
    number = {int(w): k + 1 for k, w in enumerate(counts.contexts)}

    def p(context, word):
        own = of_word.get(word and hpylm.word_id(word.encode()), {"c": 0, "t": 0, "pairs": {}})
        at_parent = np.array([float(own["c"])]), np.array([float(own["t"])])
        parent = float(hpylm.parent_probability(*at_parent, state, 0.5, counts.words)[0])
        k = number.get(hpylm.word_id(b"\r" if context is None else context.encode()), 0)
        if not k:
            return parent
        n, t = own["pairs"].get(k, (0, 0))
        return (n - 0.5 * t + (hpylm.STRENGTH + 0.5 * state.tables[k]) * parent) / (hpylm.STRENGTH + state.customers[k])

    return p


def test_seating_follows_the_law():
    """Tables of a dish: the chance of t is in proportion to fresh^t times generalised Stirling numbers."""
    d, fresh, n = 0.6, 1.3, 6
    s = {(1, 1): 1.0}
    for m in range(1, n):
        for t in range(1, m + 2):
            s[m + 1, t] = s.get((m, t), 0) * (m - d * t) + s.get((m, t - 1), 0)
    law = np.array([fresh**t * s[n, t] for t in range(1, n + 1)])
    law /= law.sum()
    got = hpylm.seat(np.full(40_000, n), np.full(40_000, fresh), d, np.random.default_rng(1), 6)
    assert np.abs(np.bincount(got, minlength=n + 1)[1:] / 40_000 - law).max() < 0.012


def test_large_parties():
    got = hpylm.seat(np.full(400, 10_000), np.full(400, 2.0), 0.5, np.random.default_rng(1))
    assert 1 <= got.min() and got.max() < 1_000
    assert hpylm.seat(np.array([0, 1]), np.ones(2), 0.5, np.random.default_rng(1)).tolist() == [0, 1]


def test_runs_come_back_whole():
    draw = np.random.default_rng(2)
    keys = np.sort(draw.integers(0, 2**61, 1_000))
    a, b = draw.integers(0, 9, 1_000), draw.integers(0, 10**6, 1_000)
    for x, y in zip(hpylm.unpack(hpylm.pack(keys, a, b), 3), (keys, a, b)):
        assert (x == y).all()
    assert [len(x) for x in hpylm.unpack(hpylm.pack(keys[:0], a[:0]), 2)] == [0, 0]


@pytest.mark.parametrize("passes", [1, 3])
def test_texts_are_scored_in_turns(spark, sf_dir, monkeypatch, passes):
    """Scores are the same whatever the number of turns, and a turn asks for its share of the texts only."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(docs.limit(20)).unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType)))
    same = lambda rows: sorted(((*r[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in rows), key=str)
    two = same(check(docs))
    written = []
    keep = hpylm.keep
    monkeypatch.setattr(hpylm, "PASSES", passes)
    monkeypatch.setattr(hpylm, "keep", lambda df: written.append(keep(df)) or written[-1])
    assert same(check(docs)) == two
    turns = [df.count() for df in written if "base_score" in df.columns]
    assert len(turns) == passes - 1 and all(0 < n < len(two) for n in turns)


def test_states_come_from_one_reading(spark, monkeypatch):
    """Sums of all samples at once, words that hold much of the tokens being spread over rows."""
    monkeypatch.setattr(hpylm, "COMMON_SHARE", 0.1)
    a, b = 5, 9
    rows = [(0, a, [1, 2], [4, 3], [2, 1, 3, 2], [3, 5], [2, 4]), (1, a, [3], [5], [1, 2], [3, 5], [2, 4]), (0, b, [0, 2], [6, 7], [1, 1, 2, 2], [2, 4], [1, 3])]
    kind = "bucket int, word long, contexts array<int>, n array<long>, t array<long>, customers array<long>, top array<long>"
    counts = hpylm.Counts(np.array([20, 30, 40]), np.array([a]), 25, 2, 2)
    states, common = hpylm.states_of(spark.createDataFrame(rows, kind).repartition(2), counts, 2)
    assert common == {a: 12}
    assert [s.customers.tolist() for s in states] == [[6, 4, 10, 5]] * 2
    assert [s.tables.tolist() for s in states] == [[1, 2, 2, 1], [2, 3, 4, 2]]
    assert [(s.parent_customers, s.parent_tables, s.common) for s in states] == [(6.0, 3.0, {a: (4, 2)}), (11.0, 7.0, {a: (7, 4)})]
