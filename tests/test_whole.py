"""Queries take whole tables."""

import random

from pyspark.sql import functions as F

from reportloom.operators import catalogue, search
from reportloom.operators import vectors as vectors_
from reportloom.plans import catalog
from reportloom.sources import storage

SF = "/root/testdata/sf0.001"


def test_whole_tables(spark):
    got = catalog.queries()
    count = lambda t: spark.read.parquet(f"{SF}/{t}.parquet").count()
    assert got["document_view"](spark, SF).count() == got["document_view_all"](spark, SF).count() == count("customer")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert got["url_union"](spark, SF).count() == got["url_union_all"](spark, SF).count() == got["url_normalise"](spark, SF).select("url").distinct().count() <= pages.count()


def test_runs_of_every_length_are_counted(spark):
    out = {r.k: r.ways for r in catalog.queries()["embedding_count"](spark, SF).collect()}
    runs = spark.read.parquet(f"{SF}/orders.parquet").orderBy("o_orderkey").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("p")).collect()
    assert len(out) == len(runs) and any(len(r.p) > 10 for r in runs)
    for r in runs:
        long = [x.o_orderpriority for x in r.p]
        short = [x for i, x in enumerate(long, 1) if i % 3]
        ways = [1] + [0] * len(short)
        for v in long:
            for j in range(len(short), 0, -1):
                ways[j] += ways[j - 1] * (short[j - 1] == v)
        assert out[r.o_custkey] == min(2, ways[-1])


def test_furniture_goes_from_every_page(spark):
    pages = spark.createDataFrame([("d", p, f"Head\n\nbody {p}\n Head\nm\nx\ny\nfoot") for p in range(5)] + [("e", 0, "Head\nb")], "doc_id string, page_no int, text string")
    out = {(r.doc_id, r.page_no): (r.text, r.removed) for r in catalogue.without_furniture(pages).collect()}
    assert out == {("d", p): (f"\nbody {p}\nm", 5) for p in range(5)} | {("e", 0): ("Head\nb", 0)}
    whole = catalog.queries()["page_furniture_removed"](spark, SF).groupBy("doc_id").count().collect()
    assert len(whole) == spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").count() and max(r["count"] for r in whole) > 5


def test_searches_take_a_table_of_queries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vectors_, "QUERIES", 2)
    monkeypatch.setattr(vectors_, "VECTORS", 7)
    vectors = spark.createDataFrame([(i, [float(i % 5), 1.0, float(i)]) for i in range(30)] + [(30, [0.0, 0.0, 0.0]), (31, [1.0]), (32, None)], "vec_id long, embedding array<float>")
    asked = vectors.where("vec_id in (3, 8, 20, 30)")
    got = search.vector_all(asked.select(F.col("vec_id").alias("query_id"), "embedding"), vectors, 4).collect()
    docs = spark.createDataFrame([(i, f"w{i % 3} w{i % 7} common") for i in range(20)] + [(20, None)], "doc_id long, text string")
    search.write_index(docs, f"{tmp_path}/index")
    found = search.keyword_all(docs.where("doc_id % 5 = 0").select(F.col("doc_id").alias("query_id"), "text"), f"{tmp_path}/index", 4).collect()
    assert {r.query_id for r in got} == {3, 8, 20} and {r.query_id for r in found} == {0, 5, 10, 15}
    for q in (3, 8, 20):
        one = search.vector(vectors.where("size(embedding) = 3"), [float(q % 5), 1.0, float(q)], 4).collect()
        assert sorted((-r.score, r.vec_id) for r in got if r.query_id == q) == [(-r.score, r.vec_id) for r in one]
    for q in (0, 5, 10, 15):
        one = search.keyword(spark, f"{tmp_path}/index", f"w{q % 3} w{q % 7} common", 4).collect()
        assert sorted((-r.score, r.doc_id) for r in found if r.query_id == q) == [(-r.score, r.doc_id) for r in one]
    assert search.vector_all(asked.limit(0).select(F.col("vec_id").alias("query_id"), "embedding"), vectors).count() == 0
    vectors.where("vec_id <> 7").write.parquet(f"{tmp_path}/embeddings.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert catalog.queries()["vector_search"](spark, str(tmp_path)).count() == 0


def test_many_queries_in_several_passes(spark, tmp_path, monkeypatch):
    """Queries travel to the shards a pass at a time; each finds what it finds alone, and blocks are shuffled once."""
    monkeypatch.setattr(search, "PASS", 4)
    monkeypatch.setattr(search, "SLICE", 2)
    monkeypatch.setattr(search, "SHARD", 16)
    text = F.concat_ws(" ", F.concat(F.lit("w"), (F.col("id") % 3).cast("string")), F.concat(F.lit("w"), (F.col("id") % 7).cast("string")), F.lit("common"))
    docs = spark.range(60).select(F.col("id").alias("doc_id"), text.alias("text"))
    with storage.scratch(spark):
        search.write_index(docs, f"{tmp_path}/index")
        queries = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
        found = search.keyword_all(queries, f"{tmp_path}/index", 4).collect()
        for q in queries.collect():
            mine = sorted(((-r.score, r.doc_id) for r in found if r.query_id == q.query_id))
            assert mine == [(-r.score, r.doc_id) for r in search.keyword(spark, f"{tmp_path}/index", q.text, 4).collect()]
        assert search.keyword_all(queries.limit(0), f"{tmp_path}/index", 4).count() == 0


def test_shards_give_only_what_reaches_the_scores_learned(spark, tmp_path, monkeypatch):
    """Many queries learn in some shards what others must reach: what comes back is far below queries times shards, and exact."""
    monkeypatch.setattr(search, "SHARD", 16)
    monkeypatch.setattr(search, "SLICE", 7)
    monkeypatch.setattr(search, "LEARNED", 3)
    rng, counts, stored = random.Random(3), [], search.stored
    rows = [(i, " ".join(rng.choice("abcdefgh") if rng.random() < 0.5 else f"w{rng.randrange(80)}" for _ in range(rng.randrange(30)))) for i in range(640)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    with storage.scratch(spark):
        search.write_index(docs, f"{tmp_path}/index")

        def seen(df, name):
            out = stored(df, name)
            counts.extend([out.count()] if name == "hits" else [])
            return out

        monkeypatch.setattr(search, "stored", seen)
        queries = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
        found = search.keyword_all(queries, f"{tmp_path}/index", 4).collect()
        assert 0 < sum(counts) < 32 * 40 * 4 * 0.6
        for q, text in rows[::160]:
            mine = sorted((-r.score, r.doc_id) for r in found if r.query_id == q)
            assert mine == [(-r.score, r.doc_id) for r in search.keyword(spark, f"{tmp_path}/index", text, 4).collect()]


def test_index_is_made_without_a_row_for_each_posting(spark, tmp_path, monkeypatch):
    """Blocks are made of whole texts' lists; a shard whose postings come in parts gives a term several blocks, and the same answers."""
    monkeypatch.setattr(search, "postings", None)  # a call would fail
    monkeypatch.setattr(search, "SHARD", 16)
    monkeypatch.setattr(search, "TEXTS", 3)
    docs = spark.createDataFrame([(i, f"W{i % 3} w{i % 7} w{i % 7} common" if i % 11 else None) for i in range(60)], "doc_id int, text string")
    asked, found = "w1 w3 common", []
    with storage.scratch(spark):
        for n, most in (("whole", search.POSTINGS), ("parts", 8)):
            monkeypatch.setattr(search, "POSTINGS", most)
            search.write_index(docs, f"{tmp_path}/{n}")
            found.append(sorted(map(tuple, search.keyword(spark, f"{tmp_path}/{n}", asked, 60).collect())))
        once, parted = (spark.read.parquet(f"{tmp_path}/{n}/blocks") for n in ("whole", "parts"))
        postings = lambda b: sorted((r.term, r.shard, p, x) for r in b.collect() for p, x in zip(r.places, r.parts, strict=True))
        assert postings(once) == postings(parted) and parted.count() > once.count() == once.select("term", "shard").distinct().count()
        terms = {r.doc_id: (r.text or "").lower().split() for r in docs.collect()}
        assert found[0] == found[1] and {i for i, _ in found[0]} == {i for i, t in terms.items() if set(t) & set(asked.split())}
    assert "Exchange" not in search.tallied(docs)._jdf.queryExecution().executedPlan().toString()
