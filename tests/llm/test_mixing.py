"""Mixing: targets by the rule in rounds, copies by a plain walk along each source's line."""

import math
import re

import pytest
from edge import awkward, empty

from velomet.llm import mixing


def rounds(sizes):
    """Targets by sharing again and again: sizes by source, in order."""
    total = 1.5 * sum(sizes)
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    capped = set()
    while True:
        rest = total - sum(2 * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        targets = [2 * s if i in capped else rest * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, t in enumerate(targets) if i not in capped and t > 2 * sizes[i]}
        if not over:
            return targets
        capped |= over


@pytest.mark.parametrize("sizes", [[10], [5, 5, 5], [100, 1, 1], [1, 2, 3, 1000, 5, 6, 70], [3, 1, 2], [7, 0, 9], [900, 300, 600, 1]])
def test_targets(spark, sizes):
    rows = [(f"s{i:02d}", s) for i, s in enumerate(sizes[:-1])] + [(None, sizes[-1])]
    got = mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()
    by = {r["source"]: r["target"] for r in got}
    want = rounds(sizes)
    for (source, _), t, f in zip(rows, want, mixing.fill([(s, (3, 1, 2)[i % 3]) for i, s in enumerate(sizes)])):
        assert by[source] == pytest.approx(t) and f == pytest.approx(t)


def check(docs):
    given = docs.select("doc_id", "source", "text").collect()
    got = mixing.plan(docs).collect()
    again = mixing.plan(docs.repartition(3)).collect()
    key = lambda r: (str(r["source"]), r["size"], r["doc_id"] is None, r["doc_id"] or 0, r["copies"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert len(got) == len(given)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(r["size"] for r in got) == sorted(size(r["text"]) for r in given)
    for source in {r["source"] for r in given}:
        mine = [r for r in got if r["source"] == source]
        words, target = sum(r["size"] for r in mine), mine[0]["target"]
        assert {r["source_size"] for r in mine} == {words} and {r["target"] for r in mine} == {target}
        rate = target / words if words else 0
        # One per integer crossed: never off the expected copies by one, alone or along the line.
        line = sorted(mine, key=lambda r: (r["size"], r["doc_id"] is not None, r["doc_id"] or 0))
        run = 0
        for n, r in enumerate(line, 1):
            run += r["copies"]
            assert abs(r["copies"] - rate) < 1 and r["copies"] <= math.ceil(mixing.MOST)
            assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        assert abs(run - n * rate) <= 1
        assert abs(sum(r["taken"] for r in mine) - target) <= 2 * max(r["size"] for r in mine)


def test_awkward_texts(spark):
    check(awkward(spark))
    assert mixing.plan(empty(spark)).collect() == []


def test_whole_table(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_mixed_keeps_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan(docs).collect()}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    seen = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert seen == {k: v for k, v in copies.items() if v}
    assert out.exceptAll(out.join(docs, docs.columns, "left_semi")).count() == 0
