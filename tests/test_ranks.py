import random

from pyspark.sql import functions as F

from reportloom.operators import quality, ranks


def test_ranks_of_any_key(spark, monkeypatch):
    """Text with ties and nulls, in few and many ranges: the places of a sort."""
    rng = random.Random(8)
    rows = [(rng.choice([None, "", "a", "é", "Z", "zz/1", f"p/{rng.randint(0, 300)}"]), rng.choice([None, 1, 2]), i, {"k": i}) for i in range(3_000)] + [("hot", 1, i, None) for i in range(2_000)]
    df = spark.createDataFrame(rows, "path string, year int, i int, m map<string,int>").repartition(7)
    want = sorted(rows, key=lambda r: ((r[0] is not None, (r[0] or "").encode()), (r[1] is not None, r[1] or 0), r[2]))
    for size in (100, 1_000_000):
        monkeypatch.setattr(ranks, "RANGE_ROWS", size)
        got = ranks.ranked(df, ["path", "year", "i"]).collect()
        assert [r.i for r in sorted(got, key=lambda r: r["rank"])] == [r[2] for r in want] and sorted(r["rank"] for r in got) == list(range(len(rows)))
        assert sorted(got[0].asDict()) == ["i", "m", "path", "rank", "year"]
        # ties in any order: each place once, keys ascending
        ties = sorted(ranks.ranked(df, ["path"]).collect(), key=lambda r: r["rank"])
        assert [r.path for r in ties] == [r[0] for r in want] and [r["rank"] for r in ties] == list(range(len(rows)))
        assert sorted(r.i for r in ranks.every(df, 7, ["path", "year", "i"]).collect()) == sorted(r[2] for r in want[::7])
        assert ranks.every(df.limit(0), 3, ["path"]).count() == 0


def test_no_range_holds_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(ranks, "RANGE_ROWS", 500)
    made = []
    monkeypatch.setattr(ranks, "stored", lambda df, name: made.append((name, df.cache())) or made[-1][1])
    df = spark.range(10_000).select(F.when(F.col("id") % 3 > 0, "same").otherwise(F.col("id").cast("string")).alias("k"), "id")
    assert ranks.ranked(df, ["k"]).count() == 10_000
    sizes = [r["count"] for r in dict(made)["ranges"].groupBy("range_").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 1_100


def test_vocabulary_of_text_ids(spark):
    docs = spark.createDataFrame([(f"id-{i:03}", f"Word{i} common x") for i in range(10)] + [(None, "first")], "doc_id string, text string")
    assert {r.word for r in quality.vocabulary(docs, most=5).collect()} == {"first", "word", "common"}
