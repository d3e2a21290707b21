"""Small tables with everything awkward in them, shared by the tests of the operators."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, f0 string, t string, ids string, score string, a string"

PROSE = "The quick brown fox jumps over the lazy dog near the river bank. It rests there, and then it runs home again."


def rows(*texts):
    """Documents with columns whose names the operators use inside."""
    return [(i, t, "en", "s", None if t is None else len(t), "x", "y", "z", "w", "v") for i, t in enumerate(texts)]


def awkward(spark):
    """Nulls in every column, empty and white texts, a very long text, repeated rows, ties, odd characters."""
    long_text = " ".join(f"word{i % 997}" for i in range(60_000))
    made = rows(None, "", " \t\n", "one", PROSE, PROSE, PROSE.upper(), long_text, "x" * 20_000, "naïve Ünïcode 東京 🙂 \u0000 end")
    made += [made[4], made[4], (None, PROSE, None, None, None, None, None, None, None, None), (None,) * 10]
    return spark.createDataFrame(made, DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
