import difflib
import random
import re

from pyspark.sql import functions as F

from reportloom.functions import matching
from reportloom.operators import quality
from reportloom.plans import catalog

SF = "/root/testdata/sf0.001"


def plain(a, b):
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


def test_ratio_is_difflibs(monkeypatch):
    r = random.Random(5)
    for n in range(400):
        monkeypatch.setattr(matching, "SMALL", r.choice([0, 20, 8000]))
        words = [str(i) for i in range(r.choice([1, 2, 5, 40, 300]))]
        a = [r.choice(words) for _ in range(r.randrange(160))]
        b = [w if r.random() < 0.8 else r.choice(words) for w in a if r.random() < 0.9] if n % 2 else [r.choice(words) for _ in range(r.randrange(160))]
        assert matching.ratio(a, b) == plain(a, b)
    assert matching.ratio(["a"] * 30_000, ["a", "b"] * 15_000) == 0.5


def words(t):
    return re.findall("[a-z]{2,}", (t or "").lower())


def test_every_document_is_scored(spark):
    out = {r.doc_id: r for r in catalog.queries()["ocr_agreement"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.regexp_replace("text", "the", "tho").alias("other")).collect()
    assert len(out) == len(rows) and any(len(r.text or "") >= 2000 for r in rows)
    for r in rows:
        a, b = words(r.text), words(r.other)
        if len(a) < 1500:
            assert out[r.doc_id].agreement == (plain(a, b) if a and b else 0.0)


def test_agreement_counts_words_and_nothing_else(spark):
    rows = [(1, "", ""), (2, "Ab, 12!", "ab 12"), (3, None, "ab"), (4, "one two\nTHREE", "one two four"), (5, "a 1", "a 1")]
    df = spark.createDataFrame(rows, "doc_id int, primary string, cross_check string")
    got = {r.doc_id: (r.agreement, r.agree_ok) for r in quality.agreement(df).collect()}
    assert got == {1: (0.0, False), 2: (1.0, True), 3: (0.0, False), 4: (2 / 3, False), 5: (0.0, False)}


def test_figures(spark):
    rows = [(1, "cost $1,200.50 or 5%", "cost $1,200.50 or 6%"), (2, "none", "1"), (3, None, None), (4, "1.2.3", "1.2 .3")]
    df = spark.createDataFrame(rows, "doc_id int, primary string, cross_check string")
    assert sorted(tuple(r) for r in quality.figure_agreement(df).collect()) == [(1, 2, 0.5), (2, 0, 0.0), (3, 0, 0.0), (4, 2, 1.0)]


def test_promotion_fails_closed(spark):
    good = " ".join(["reading matter of the page"] * 30) + " 5% of $1,000"
    rows = [("a", good, good), ("b", good, None), ("c", good, "else"), ("d", "few words", "few words"), ("e", None, None)]
    df = spark.createDataFrame(rows, "doc_id string, primary string, cross_check string")
    known = spark.createDataFrame([(w,) for w in ("reading", "matter", "of", "the", "page", "few", "words")], "word string")
    got = {r.doc_id: (r.decision, r.note) for r in quality.promoted(df, known).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": "promoted", "b": "second engine unavailable", "c": "failed the two-engine bar", "d": "failed the two-engine bar", "e": "second engine unavailable"}
    assert "agree on 100% of the word sequence and 100% of the 2 figures, 100% dictionary-recognizable; NOT human-verified" in got["a"][1] and got["c"][1] is None


def test_no_ocr_in_the_vocabulary(spark):
    docs = spark.createDataFrame([(1, "plain words", "pdf-text"), (2, "pernitted rrine", "ocr"), (3, "other", None)], "doc_id int, text string, text_source string")
    assert {r.word for r in quality.vocabulary(docs).collect()} == {"plain", "words", "other"}
