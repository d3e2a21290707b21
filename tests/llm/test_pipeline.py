"""The pipeline stage by stage, each against what its input says it should do, and as a whole."""

import re

import corpus_pipeline
import pytest
from edge import PROSE, texts_of

from velomet.llm import bpe, pii
from velomet.llm.work import keep


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Tables after every stage, by name, the first being documents with planted copies and faults."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = " ".join(f"{a}{b}" for a in ("river", "stone", "cloud", "amber", "north") for b in ("ing", "ed", "ly", "er", "est", "ward")) + ". "
    base = base * 2 + PROSE
    planted = [(90_001, base), (90_002, base), (90_003, base.replace("cloudly", "cloudily", 1)), (90_004, PROSE.upper().replace(" ", "!! ") * 4)]
    planted += [(90_005, "Write to ann@mail.example.com or call +1 (743) 555-3824 today. " + base[::-1])]
    planted += [(90_006, None), (90_007, ""), (None, base)]
    extra = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in planted], docs.schema)
    now = keep(docs.union(extra))
    out = {"documents": now}
    for name, stage in corpus_pipeline.STAGES:
        now = out[name] = keep(stage(spark, now, sf_dir))
    return out


def test_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_quality(stages, spark, sf_dir):
    left = texts_of(stages["quality"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [i in left for i, q in labels.items() if q == 1]
    assert sum(good) >= 0.97 * len(good)
    assert 90_004 not in left and {90_001, 90_002, 90_003, 90_006, 90_007} <= left.keys()


def test_near_copies(stages):
    given, left = stages["quality"].collect(), texts_of(stages["near_copies"])

    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {r["doc_id"]: shingles(r["text"]) for r in given if r["doc_id"] is not None}
    gone = sets.keys() - left.keys()
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    ids = sorted(sets)
    close = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if like(sets[a], sets[b]) >= 0.8]
    assert close and sum(a in left and b in left for a, b in close) <= 0.1 * len(close)
    assert {90_001} == {i for i in left if i in (90_001, 90_002, 90_003)}
    assert all(max(like(sets[i], sets[j]) for j in ids if j != i) >= 0.8 for i in gone)  # no other text goes
    assert stages["near_copies"].where("doc_id IS NULL").count() == 0  # a copy of 90_001


def test_rows_are_not_lost_to_their_ids(spark, sf_dir):
    """Repeated and missing ids: unlike texts all stay, of copies one stays, and it is one that has an id."""
    texts = [" ".join(f"{w}{k}" for k in range(60)) for w in ("amber", "river", "stone", "cloud", "field")]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[2]), (None, texts[3]), (7, texts[3]), (5, texts[4]), (5, texts[4])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.without_near_copies(spark, docs, sf_dir)
    assert left.columns == docs.columns
    got = sorted((str(r["doc_id"]), r["text"]) for r in left.collect())
    assert got == sorted([("1", texts[0]), ("1", texts[1]), ("None", texts[2]), ("7", texts[3]), ("5", texts[4])])


def test_personal_data(stages):
    before, after = texts_of(stages["near_copies"]), texts_of(stages["personal_data"])
    assert before.keys() == after.keys()
    assert after == {i: None if t is None else pii.mask(t) for i, t in before.items()}
    assert "<email>" in after[90_005] and "<phone>" in after[90_005] and "555" not in after[90_005]
    assert all(r["n_chars"] == len(r["text"]) for r in stages["personal_data"].collect() if r["text"] is not None)


def test_mix(stages):
    given, taken = stages["personal_data"].collect(), stages["mix"].collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    known = {(r["doc_id"], r["text"], r["source"]) for r in given}
    assert all((r["doc_id"], r["text"], r["source"]) in known for r in taken)
    total = sum(size(r["text"]) for r in given)
    assert sum(size(r["text"]) for r in taken) == pytest.approx(1.5 * total, rel=0.1)


def test_tokens(stages):
    path = corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")
    own = bpe.codec(open(path, encoding="utf-8").read())
    texts = texts_of(stages["mix"])
    rows = stages["tokens"].collect()
    assert len(rows) == stages["mix"].count()
    assert all(r["ids"] == own.encode(texts[r["doc_id"]] or "") and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_run(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "ids", "n_tokens"] and got.count() > 100


def test_no_rows(spark, sf_dir):
    now = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = keep(stage(spark, now, sf_dir))
        assert now.count() == 0
