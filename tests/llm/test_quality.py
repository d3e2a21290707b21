"""The weak-label classifier: votes and estimates on made cases, accuracy against labels it never saw."""

import numpy as np
from edge import PROSE, awkward, empty

from velomet.llm import quality


def test_votes_know_their_faults():
    at = {name: i for i, name in enumerate(quality.LABELLERS)}
    vote = lambda text: quality.opinions(quality.votes(text.encode()))
    assert quality.BAD not in vote(PROSE * 3)
    assert vote(PROSE.upper())[at["capitals"]] == quality.BAD
    assert vote("spam " * 50)[at["repetition"]] == quality.BAD
    assert vote("word$$$ " * 8 + PROSE)[at["symbols"]] == quality.BAD
    assert vote("one | two | three | four | five | six")[at["loose_marks"]] == quality.BAD
    assert quality.votes(b"four words are few") == 0


def test_repetition_is_looked_for_in_whole_texts():
    at = quality.LABELLERS.index("repetition")
    varied = " ".join(f"word{i}" for i in range(quality.CHUNK))
    vote = lambda text: quality.opinions(quality.votes(text.encode()))[at]
    assert vote(varied) == vote(f"{varied} spam spam spam") == quality.GOOD
    for more in (quality.CHUNK, quality.CHUNK + 7, 3 * quality.CHUNK):
        assert vote(varied + " spam" * more) == quality.BAD


def test_estimate_tells_unlike_faults_apart():
    """Two faults that never meet, and a labeller that votes bad at random."""
    draw = np.random.default_rng(0)
    counts, truth = {}, {}
    for _ in range(20_000):
        kind = draw.choice(3, p=[0.8, 0.1, 0.1])
        row = [quality.GOOD] * 7
        if kind:
            row[2 * kind] = row[2 * kind + 1] = quality.BAD
        code = sum(v * 3**i for i, v in enumerate(row))
        counts[code] = counts.get(code, 0) + 1
        truth[code] = kind == 0
    got = quality.estimate(counts)
    assert all((p > 0.5) == truth[c] for c, p in got.items())


def test_held_out_labels(spark):
    base = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    scorer = quality.fit(docs)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    kept = {r["doc_id"]: r["keep"] for r in quality.score(docs, scorer).collect()}
    good = [kept[i] for i, q in labels.items() if q == 1]
    bad = [kept[i] for i, q in labels.items() if q == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.4
    left = {r["doc_id"] for r in quality.kept(docs, scorer).collect()}
    assert left == {i for i, k in kept.items() if k}
    again = quality.fit(docs)
    assert again.posterior == scorer.posterior and np.allclose(again.weights, scorer.weights)


def test_awkward_texts(spark):
    docs = awkward(spark)
    scorer = quality.fit(docs)
    got = quality.score(docs, scorer).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["keep"] for r in got if r["doc_id"] in (0, 1, 2, 3))
    assert quality.kept(docs, scorer).columns == docs.columns
    nothing = quality.fit(empty(spark))
    assert quality.score(empty(spark), nothing).collect() == []
    assert all(r["keep"] for r in quality.score(docs, nothing).collect())


def test_long_texts_are_read_whole():
    head = (PROSE + " ").encode() * 2_000
    assert not np.allclose(quality.features(head), quality.features(head + b"$$$ &&& ### " * 9_000))
    assert np.isclose(np.linalg.norm(quality.features(head)), 1)
