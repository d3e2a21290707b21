"""Quality classifier from weak labels.

Seven heuristic labellers vote on every text: good, bad, or no opinion. How often each combination of votes
occurs is counted over all documents; expectation-maximisation on those counts estimates how reliable
each labeller is and how common bad texts are, without any label given by hand. Its posterior for each
combination labels a bounded sample of documents, on which a logistic scorer over hashed features is
trained. The scorer then reads every whole text.

The sample is the `SAMPLE` documents of smallest hash, half of them from either side of the posterior as far as
there are enough; it bounds the training, which runs in one task, and nothing else. Votes, counts and scores
cover all rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents the scorer is fitted on at most, and buckets that features are hashed into.
SAMPLE, BUCKETS = 3_000, 1 << 12
LABELLERS = ("symbols", "capitals", "repetition", "loose_marks", "sentences", "word_length", "shouting")
#: A text is rejected when its score is below this. Under a half, since losing a clean text costs more
#: than keeping a bad one.
REJECT_BELOW = 0.35

GOOD, BAD, NONE = 2, 1, 0
CHUNK = 1 << 16

_KIND = np.zeros(256, np.uint8)
for _i in range(256):
    _c = chr(_i)
    _KIND[_i] = (
        1 if _i in (32, 9, 10, 11, 12, 13) else 2 if "a" <= _c <= "z" else 3 if "A" <= _c <= "Z" else 4 if "0" <= _c <= "9"
        else 5 if _c in ".,;:'()-?\"" else 6 if _i >= 128 else 0
    )
#: The shape of a byte: letters by case, digits, white space and bytes beyond ASCII as one each, marks as they are.
_SHAPE = np.arange(256, dtype=np.uint8)
for _kind, _to in ((1, 32), (2, 97), (3, 65), (4, 48), (6, 97)):
    _SHAPE[_KIND == _kind] = _to


def votes(text: bytes) -> int:
    """The votes of the labellers on a text, one base-3 digit each. Texts of under five words get no opinion."""
    words = text.split()
    n = len(words)
    if n < 5:
        return 0
    data = np.frombuffer(text, np.uint8)
    kinds = np.bincount(_KIND[data], minlength=7).tolist()
    marks, lower, upper = kinds[0], kinds[2], kinds[3]
    shown = max(1, len(data) - kinds[1])
    letters = max(1, lower + upper)
    loose = sum(len(w) == 1 and not w.isalnum() and w < b"\x80" for w in words)
    ends = sum(text.count(c) for c in (b".", b"?", b"\n"))
    # In the worst stretch of CHUNK words, since longer texts repeat their words by nature; the last ends the text.
    size = min(n, CHUNK)
    different = min(len(set(words[at : at + size])) for at in (*range(0, n - size, size), n - size)) / size
    length = shown / n

    def cast(bad: bool, good: bool) -> int:
        return BAD if bad else GOOD if good else NONE

    cast_votes = (
        cast(marks > 0.05 * shown, marks < 0.015 * shown),
        cast(upper > 0.5 * letters, upper < 0.15 * letters),
        cast(n >= 20 and different < 0.2, n >= 20 and different > 0.3),
        cast(loose > 0.15 * n, loose < 0.02 * n),
        cast(n > 60 * max(1, ends), 2 * ends < n < 40 * ends),
        cast(length > 14 or length < 2, 3 < length < 10),
        cast(text.count(b"!!") > 0.1 * n, False),
    )
    code = 0
    for v in reversed(cast_votes):
        code = code * 3 + v
    return code


def opinions(code: int) -> list[int]:
    out = []
    for _ in LABELLERS:
        code, v = divmod(code, 3)
        out.append(v)
    return out


def features(text: bytes) -> np.ndarray:
    """Hashed counts of three-byte sequences, of the text's bytes and of its shape, damped and scaled to
    length one. Long texts are read piece by piece."""
    total = np.zeros(BUCKETS)
    for at in range(0, max(0, len(text) - 2), CHUNK):
        data = np.frombuffer(text, np.uint8)[at : at + CHUNK + 2]
        for seed, x in ((40_503, data), (26_339, _SHAPE[data])):
            x = x.astype(np.uint32)
            h = ((x[:-2] * 65_599 + x[1:-1]) * 65_599 + x[2:]) * np.uint32(2_654_435_761) ^ np.uint32(seed * 65_537)
            total += np.bincount(h >> np.uint32(20), minlength=BUCKETS)
    total = np.log1p(total)
    return total / max(np.linalg.norm(total), 1e-9)


def estimate(counts: dict[int, int], rounds: int = 100) -> dict[int, float]:
    """Posterior probability of "good" for every combination of votes, by expectation-maximisation.

    Texts are good, or bad in one of as many kinds as there are labellers. Given its kind, each labeller has
    a rate of voting good, bad or not at all, independent of the others. The kinds are needed because most
    labellers know one fault only: over all bad texts together their votes exclude one another, which one
    rate per labeller would take for unreliability. Start: a kind holds the texts its labeller votes bad
    on, shared with the other labellers that do; good holds the rest.
    """
    codes = list(counts)
    seen = np.array([opinions(c) for c in codes]).reshape(len(codes), len(LABELLERS))
    weight = np.array([counts[c] for c in codes], float)
    against = (seen == BAD).astype(float)
    none = against.sum(1, keepdims=True) == 0
    of_kind = 0.9 * against / np.maximum(1, against.sum(1, keepdims=True))
    share = np.hstack([np.where(none, 0.95, 0.1), np.where(none, 0.05 / len(LABELLERS), of_kind)])
    for _ in range(rounds):
        before = share
        mass = weight @ share
        odds = np.tile(np.log((mass + 0.1) / (mass + 0.1).sum()), (len(codes), 1))
        for j in range(len(LABELLERS)):
            for vote in (GOOD, BAD, NONE):
                hit = seen[:, j] == vote
                odds += np.outer(hit, np.log((weight[hit] @ share[hit] + 0.1) / (mass + 0.3)))
        share = np.exp(odds - odds.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        if np.abs(share - before).max(initial=0) < 1e-6:
            break
    return dict(zip(codes, share[:, 0].tolist(), strict=True))


@dataclass(frozen=True)
class Scorer:
    weights: list[float]
    bias: float
    #: Posterior by combination of votes, kept for inspection.
    posterior: dict[int, float]

    def __call__(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(features(text) @ np.array(self.weights) + self.bias, -30, 30))))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("t")
    )


def train(x: np.ndarray, y: np.ndarray, rounds: int = 300, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels y, either side weighing the same: momentum on the full gradient."""
    y = y.astype(x.dtype)
    bulk = np.where(y >= 0.5, 0.5 / max(1, (y >= 0.5).sum()), 0.5 / max(1, (y < 0.5).sum())).astype(x.dtype)
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, v = np.zeros(x.shape[1], x.dtype), np.zeros(x.shape[1], x.dtype)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ ((p - y) * bulk) + ridge * w
        v = 0.95 * v - 4.0 * g
        w = w + v
    return w


def fit(docs: DataFrame, sample: int = SAMPLE) -> Scorer:
    """The scorer of a corpus. Without texts that some labeller has an opinion on, it lets all pass."""
    texts = _texts(docs)

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [votes(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int32())], ["doc_id", "votes"])

    cast_votes = texts.mapInArrow(vote, "doc_id long, votes int")
    # At most 3^7 combinations, whatever the number of documents.
    table = cast_votes.groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["votes"]: r["n"] for r in table.collect()}
    opined = {c: n for c, n in counts.items() if c}
    posterior = estimate(opined) if opined else {}
    if not posterior or min(posterior.values()) >= 0.5 or max(posterior.values()) < 0.5:
        return Scorer([0.0] * BUCKETS, 30.0, posterior)
    # The sample: rows whose hash is below a bound that leaves about half the sample on either side.
    sides = {good: sum(n for c, n in opined.items() if (posterior[c] >= 0.5) == good) for good in (True, False)}
    bounds = {good: min(1.0, sample / 2 / n) for good, n in sides.items()}
    passed = texts.where(F.col("doc_id").isNotNull()).withColumn(
        "u", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 40)) / float(1 << 40)
    ).where(F.col("u") < max(bounds.values()))

    def described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for t, u in zip(batch.column("t"), batch.column("u").to_pylist(), strict=True):
                text = t.as_py()
                p = posterior.get(votes(text))
                if p is not None and u < bounds[p >= 0.5]:
                    kept.append((p, u, features(text).astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in kept], pa.float64()),
                    pa.array([k[1] for k in kept], pa.float64()),
                    pa.array([k[2] for k in kept], pa.binary()),
                ],
                ["p", "u", "x"],
            )

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["u", "p"])
        x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), BUCKETS)
        return pd.DataFrame({"w": [train(x, rows["p"].to_numpy()).tolist()]})

    drawn = passed.mapInArrow(described, "p double, u double, x binary")
    bounded = drawn.orderBy("u", "p").limit(2 * sample)
    weights = bounded.groupBy(F.lit(0).alias("all")).applyInPandas(learn, "w array<double>").first()["w"]
    return Scorer(weights[:-1], weights[-1], posterior)


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, score (probability of good quality) and keep (score of REJECT_BELOW or more) for every row.

    Null and empty texts, and texts of under five words, give too little to judge by: they score 0.5 and are kept.
    Repeated rows each get a row, null doc_ids stay null, other columns are left out whatever their
    names. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own(t) if len(t.split(None, 5)) >= 5 else 0.5 for t in map(lambda t: t.as_py(), batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return _texts(docs).mapInArrow(each, "doc_id long, score double").withColumn("keep", F.col("score") >= REJECT_BELOW)


def kept(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """The rows of docs that the scorer keeps, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = ((t.as_py() or "").encode() for t in batch.column(batch.schema.names.index("text")))
            yield batch.filter(pa.array([len(t.split(None, 5)) < 5 or own(t) >= REJECT_BELOW for t in texts], pa.bool_()))

    return docs.mapInArrow(each, docs.schema)
