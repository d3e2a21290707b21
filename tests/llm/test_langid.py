"""Language of pages: truth of made pages, sums by hand, awkward pages."""

import time

import numpy as np
import pytest

from velomet.llm import langid

SCHEMA = "page_id long, url string, html string, lang string, host string, t0 string, q0 int"
TEXT = {
    "en": "the weather in the north was cold and the people stayed at home with their books and their thoughts ",
    "de": "das wetter im norden war kalt und die leute blieben zu hause mit ihren büchern und ihren gedanken ",
    "fr": "le temps dans le nord était froid et les gens restaient à la maison avec leurs livres et leurs pensées ",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, TEXT[x] * 20, x) for i, x in enumerate(TEXT)] + [(7, None, "en"), (8, "text without a language", None)]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def pages(spark, *rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z", 1) for i, (u, h) in enumerate(rows)], SCHEMA)


def test_made_pages(spark, model):
    rows = [(f"https://www.site{x}.example.{x}/a", f'<html lang="{x}"><p>{TEXT[x]}</p>') for x in TEXT for _ in range(4)]
    rows += [(None, f"<p>{TEXT['de']}</p>"), ("https://www.sitede.example.de/b", "<p></p>"), ("https://www.sitefr.example.fr/c", None)]
    got = {r["page_id"]: r for r in langid.identify(pages(spark, *rows), model).collect()}
    want = [x for x in TEXT for _ in range(4)] + ["de", "de", "fr"]
    assert [got[i]["lang"] for i in range(len(rows))] == want
    assert got[0]["declared"] == "en" and got[12]["declared"] is None and got[12]["host"] is None
    assert all(0 < r["probability"] <= 1 for r in got.values())


def test_host_counts_others_only(spark, model):
    """A page without evidence of its own follows the other pages of its host, not itself."""
    rows = [("https://h.example.org/1", f"<p>{TEXT['fr']}</p>")] * 9 + [("https://h.example.org/2", "")]
    rows += [("https://other.example.com/", f"<p>{TEXT['en']}</p>")] * 40 + [("https://alone.test/", "")]
    got = {r["page_id"]: r for r in langid.identify(pages(spark, *rows), model).collect()}
    assert got[9]["lang"] == "fr" and got[50]["lang"] == "en"


def test_trigram_counts_are_sums(model):
    text = (TEXT["fr"] * 1_000).encode()
    whole = langid.trigrams(text)
    assert whole.sum() == len(text) - 2
    assert model.languages == sorted(TEXT)
    assert np.allclose(np.exp(model.likelihood).sum(1), 1)


def test_addresses():
    assert langid.address("https://a.b.co.uk/x") == ("a.b.co.uk", "b.co.uk", "uk")
    assert langid.address("http://Shop.Example.COM:80/") == ("shop.example.com", "example.com", "com")
    assert langid.address("http://10.0.0.1/") == ("10.0.0.1", "10.0.0.1", None)
    assert langid.address("http://[bad") == langid.address(None) == langid.address("no address") == (None, None, None)


def test_awkward_pages(spark, model):
    rows = [(None, None), ("", ""), ("x", "<"), ("https://h.example/", "<p>" + TEXT["en"] * 5_000), ("https://h.example/", "<script>" + "x" * 9_999)]
    docs = pages(spark, *rows, rows[0], rows[3])
    assert langid.identify(docs, model).count() == 7
    assert langid.identify(docs.limit(0), model).collect() == []
    blank = langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang"] for r in langid.identify(docs, blank).collect()} == {None}


def test_held_out_languages(spark):
    """The text alone, on documents that the model has not seen."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fitted = langid.fit(docs.where("doc_id % 2 = 0"))
    rest = docs.where("doc_id % 2 = 1 AND n_chars >= 100")
    as_pages = rest.selectExpr("doc_id AS page_id", "CAST(NULL AS STRING) AS url", "text AS html")
    got = {r["page_id"]: r["lang"] for r in langid.identify(as_pages, fitted).collect()}
    truth = {r["doc_id"]: r["lang"] for r in rest.collect()}
    assert np.mean([got[i] == x for i, x in truth.items()]) > 0.97


@pytest.mark.parametrize("piece", ["<script", "<!--", "<script>", "<nav><!-- ", "</script ", "<style></styl", "<", "<html lang=", "<html lang= ", " "])
def test_ten_megabytes_of_bad_markup(piece):
    page = "<html lang=" + piece * (10_000_000 // len(piece))
    start = time.monotonic()
    langid.visible(page)
    langid.DECLARED.search(page)
    assert time.monotonic() - start < 20


def test_visible():
    assert langid.visible("a<!-- x <b> --> b<SCRIPT src=1>no</script >c<style>no<!--</Style>d").split() == ["a", "b", "c", "d"]
    assert langid.visible("a<script>b<nav>no</nav>c<!-- d").split() == ["a", "b", "c<!--", "d"]
    assert langid.visible("<!-->a--> <scripts>b</scripts> &amp;<p>c").split() == ["b", "&", "c"]
