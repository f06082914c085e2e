from pyspark.sql import functions as F

from reportloom.functions import text
from reportloom.operators import catalogue, citations, entities, graph, quality, search
from reportloom.sources import frontmatter, storage, tables


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column).first()[0]


def test_names_have_one_key(spark):
    names = ["Board of Accountancy", "Accountancy, Board of", "Geology & Mineral Industries, Department of", "Department of Geology and Mineral Industries", "", "Oregon Youth Authority"]
    df = spark.createDataFrame([(n,) for n in names], "x string")
    assert [r[0] for r in df.select(text.entity_key("x")).collect()] == ["accountancy", "accountancy", "geology-industries-mineral", "geology-industries-mineral", "", "authority-youth"]


def test_urls_files_and_years(spark):
    assert one(spark, " http://h/a b~(1).pdf?q=1#f ", text.normalise_url("x")) == "https://h/a%20b~%281%29.pdf?q=1"
    assert one(spark, "APPR_B & W.PDF", text.slug("x")) == "appr-b-w" and one(spark, "??", text.slug("x")) == "untitled"
    parsed = text.parse_filename("x")
    assert tuple(one(spark, "Updated 2016 APPR_CFB_2017-16-02.pdf", parsed)) == (None, None, None, "approved")
    assert tuple(one(spark, "APPRProposed_deq_2024-10-29.pdf", parsed)) == ("DEQ", "2024", "filename", "proposed")
    assert one(spark, "Reporting\n Year: 2019", text.reporting_year("x", F.lit(""))) == "2019"
    cover = "9/25/23, 5:36 PM\nhttps://k.example\nKPM - View Report\n Department of Veterans' Affairs \nReporting Year 2023"
    assert tuple(one(spark, cover, text.agency("x", F.lit(None)))) == ("Department of Veterans' Affairs", "document")
    assert tuple(one(spark, "", text.agency("x", F.lit("")))) == ("", "unknown")


def test_cleaning(spark):
    assert one(spark, "a\x00b\tc\nd\x1f", text.strip_control("x")) == "ab\tc\nd"
    assert one(spark, "A n n u a l " * 10, text.is_letter_spaced("x")) and not one(spark, "A n n", text.is_letter_spaced("x"))
    curly = "“It’s”   a  test " * 20
    plain = ("\"It's\" a test " * 20).strip()
    import hashlib

    assert one(spark, curly, text.content_hash("x")) == hashlib.sha256(plain.encode()).hexdigest()
    assert one(spark, "short", text.content_hash("x")) == hashlib.sha256(b"short").hexdigest()


def test_front_matter(spark):
    md = "---\nid: a-1\ntitle: \"X: y\"\n  nested: no\nid: a-2\n---\nbody"
    assert one(spark, md, frontmatter.fields("x")) == {"id": "a-2", "title": "X: y"}
    assert one(spark, "---\nid: a", frontmatter.block("x")) is None
    assert one(spark, "---\nid: a", frontmatter.block("x", strict=False)) == ""


def test_scan_skips_underscored_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, body in [("a.md", "---\nid: a\n---\n\n## Full text\nhello\n## End\n"), ("_b.md", "x"), ("CHANGELOG.md", "x"), ("sub/c.md", "---\nid: c\n---\n")]:
        (tmp_path / name).write_text(body)
    rows = frontmatter.scan(spark, str(tmp_path)).select("fields", "full_text").collect()
    assert sorted((r.fields["id"], r.full_text.strip()) for r in rows) == [("a", "hello"), ("c", "")]


def test_crosswalk_rules(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("new",)], "agency_key string")
    mapping = spark.createDataFrame([("a", "s-a", "alias", None), ("b", "s-b", "exact", None)], "agency_key string, slug string, basis string, note string")
    unmapped = spark.createDataFrame([("a", ""), ("old", "merged")], "agency_key string, reason string")
    registry = spark.createDataFrame([("s-a",)], "slug string")
    got = sorted(tuple(r) for r in entities.crosswalk_problems(keys, mapping, unmapped, registry).collect())
    assert got == [("a", "mapped and unmapped"), ("a", "needs a note"), ("a", "needs a reason"), ("b", "slug not in registry"), ("new", "unclassified"), ("old", "stale")]
    # an entry without a slug is not judged further; a part of the corpus without its slug is one problem
    bare = spark.createDataFrame([("a", "", "guess", None), ("b", "s-b", "exact", None)], mapping.schema)
    docs = spark.createDataFrame([("1", "a", None), ("2", "b", "s-b"), ("3", "b", ""), ("4", "new", None)], "id string, agency_key string, agency_registry_slug string")
    got = {tuple(r) for r in entities.crosswalk_problems(keys, bare, unmapped.limit(0), None, docs).collect()}
    assert got == {("a", "no slug"), ("new", "unclassified"), (None, "2 mapped document(s) carry no slug")}


def test_crosswalk_join_of_stamped_documents(spark):
    docs = spark.createDataFrame([("1", "Board of Accountancy", "old", "k"), ("2", "Nobody", None, None)], "id string, agency string, agency_registry_slug string, agency_key string")
    walk = spark.createDataFrame([("accountancy", "s-1"), ("accountancy", "s-2"), ("accountancy", None)], "agency_key string, slug string")
    got = entities.crosswalk_join(docs, walk).select("id", "agency_key", "agency_registry_slug").orderBy("id").collect()
    assert [tuple(r) for r in got] == [("1", "accountancy", "s-2"), ("2", "nobody", None)]


def test_links_folders_and_fields(spark):
    docs = spark.createDataFrame([("a", "k", "s", "r", "performance_report", "x/reports/a.md", ["id", "assessment"]), ("b", "k", "t", None, "memo", "reports/b.md", ["id"]), ("c", None, None, None, "performance_report", "c.md", None)], "id string, agency_key string, agency_registry_slug string, agency_registry_corpus string, doc_type string, path string, field_names array<string>")
    mapping = spark.createDataFrame([("k", "s")], "agency_key string, slug string")
    link = quality.registry_link(mapping, "r")(docs).collect()
    assert sorted(map(tuple, link)) == [("b", "agency_registry_slug is not the crosswalk's"), ("b", "agency_registry_slug without its corpus")]
    assert sorted(map(tuple, quality.placed_by_type()(docs).collect())) == [("b", "doc_type is not known"), ("c", "not in the folder of its doc_type")]
    assert [tuple(r) for r in quality.unassessed(docs).collect()] == [("a", "carries an assessment field")]
    series = spark.createDataFrame([("a",), ("z",)], "agency_doc string")
    assert [r.id for r in quality.series_documents(series)(docs).collect()] == ["z"]


def test_chain_skips_gaps_and_takes_the_last_path(spark):
    docs = spark.createDataFrame([("a", "k", "2018", "1"), ("b", "k", "2020", "2"), ("c", "k", "2021", "3"), ("d", "k", "2021", "4"), ("e", "", "2019", "5")], "id string, agency_key string, reporting_year string, path string")
    assert [tuple(r) for r in graph.series_edges(docs).collect()] == [("d", "related", "b")]
    assert [r.documents for r in graph.collisions(docs).collect()] == [2]


def reach(spark, pairs, start):
    edges = spark.createDataFrame([(a, "t", b) for a, b in pairs], "`from` string, type string, `to` string")
    return {r.id: r.depth for r in graph.authority_chain(edges, start).collect()}


def test_reach_ends_in_cycles(spark):
    assert reach(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("b", "d"), ("d", "d")], "a") == {"b": 1, "c": 2, "d": 2}
    clique = [(f"n{i}", f"n{j}") for i in range(12) for j in range(12)]
    assert reach(spark, [*clique, ("n3", "x"), ("x", None)], "n0") == {f"n{i}": 1 for i in range(1, 12)} | {"x": 2}
    assert reach(spark, [("a", "b")], "z") == {}


def test_reach_has_no_depth_cap(spark, monkeypatch):
    monkeypatch.setattr(graph, "COMPACT", 5)
    chain = [(f"n{i}", f"n{i + 1}") for i in range(200)] + [("n2", "n0"), ("n0", "d"), ("d", "n2"), ("n1", "n1"), ("n1", None)]
    assert reach(spark, chain, "n0") == {f"n{i}": i for i in range(1, 201)} | {"d": 1}


def test_a_step_leaves_links_where_they_are(spark):
    hub = [("hub", f"n{i}") for i in range(400)] + [(f"n{i}", "end") for i in range(400)] + [("hub", "n1")] * 5
    edges = spark.createDataFrame([(a, "t", b) for a, b in hub], "`from` string, type string, `to` string")
    with storage.scratch(spark):
        links = graph.linked(edges, 50)
        assert links.count() == 800 and links.where("`from` = 'hub'").select("salt").distinct().count() == graph.SPREAD
        # a hub's links are in several buckets
        assert len({r[0] for r in links.where("`from` = 'hub'").select(F.input_file_name()).collect()}) > 1
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            found = graph.step(spark.createDataFrame([("hub",), ("n7",), ("none",)], "id string"), links)
            assert {r.id for r in found.collect()} == {f"n{i}" for i in range(400)} | {"end"}
            plan = graph.step(spark.createDataFrame([("hub",)], "id string"), links)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        # nodes to the buckets, and what is reached to be made distinct
        assert plan.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("reportloom_")]


def test_suggestions_lose_no_link(spark, monkeypatch):
    import difflib
    import random

    monkeypatch.setattr(entities, "BLOCK", 7)
    rng = random.Random(3)
    name = lambda: "".join(rng.choice("abcde-") for _ in range(rng.randint(1, 9)))
    keys, slugs = sorted({name() for _ in range(40)} | {"ab", "abxde"}), sorted({name() for _ in range(30)} | {"abc", "abyde"})
    got = {r.agency_key: r.slug for r in entities.suggestions(spark.createDataFrame([(k,) for k in [*keys, None]], "agency_key string"), spark.createDataFrame([(s,) for s in slugs], "slug string")).collect()}
    assert got == {k: m[0] for k in keys if (m := difflib.get_close_matches(k, slugs, n=1, cutoff=0.6))}
    assert "ab" in got and "abxde" in got


def test_citations(spark):
    docs = spark.createDataFrame([("d", "ORS 192.355, ORS 238.4, OAR 123-456-7890 and ORS\n 12A.100")], "doc_id string, text string")
    both = citations.found(docs, "ors-section").union(citations.found(docs, "oar-rule"))
    assert sorted(r.target for r in both.collect()) == ["oar-123-456-7890", "ors-12A.100", "ors-192.355"]
    assert {r.state for r in citations.sibling_state(both, None).collect()} == {"sibling_unavailable"}
    metas = spark.createDataFrame([("x", None, "Geology and Mineral Industries Board", "2019")], "doc_id string, agency_code string, agency string, reporting_year string")
    cited = metas.select(text.citation("agency_code", "agency", "reporting_year").alias("cited"))
    assert citations.resolve(cited, metas).first().doc_ids == "x" and citations.resolve(cited, metas, strict=True).first().doc_ids == ""


def test_no_assessment_is_found_at_depth(spark):
    df = spark.createDataFrame([], "a struct<b: array<struct<assessment: string>>>, Assessment int")
    assert quality.no_assessment(df) == ["a.b.assessment", "Assessment"]
    assert (quality.outcome(True, 0), quality.outcome(False, 0), quality.outcome(False, 3)) == (2, 0, 1)


def test_furniture_and_outcomes(spark):
    pages = spark.createDataFrame([("d", p, f"Head\n\nbody {p}\nx\ny\nfoot") for p in range(5)] + [("e", 0, "Head"), ("e", 1, "Head")], "doc_id string, page_no int, text string")
    assert sorted(tuple(r) for r in catalogue.page_furniture(pages).collect()) == [("d", "Head"), ("d", "foot"), ("d", "x"), ("d", "y")]


def test_search_falls_back(spark, tmp_path):
    docs = spark.createDataFrame([(1, "alpha beta beta"), (2, "beta"), (3, None)], "doc_id int, text string")
    search.write_index(docs, str(tmp_path))
    assert [r.doc_id for r in search.search(spark, str(tmp_path), "alpha").collect()] == [1]
    assert search.keyword(spark, str(tmp_path), "").count() == 0 and search.keyword(spark, str(tmp_path), "gamma").count() == 0
    index = {(r.term, r.doc_id): (r.tf, r.length) for r in search.inverted_index(docs).collect()}
    assert index == {("alpha", 1): (1, 3), ("beta", 1): (2, 3), ("beta", 2): (1, 1), ("", 3): (1, 0)}
    assert tuple(spark.read.parquet(f"{tmp_path}/sizes").first()) == (3, 4 / 3)


def test_search_reads_only_the_terms_asked_for(spark, tmp_path):
    search.write_index(spark.createDataFrame([(i, f"w{i} w{i % 3}") for i in range(500)], "doc_id int, text string"), str(tmp_path))
    plan = search.keyword(spark, str(tmp_path), "w1 w400")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "In(term, [w1,w400])" in plan


def test_names_of_files_and_agencies(spark):
    parsed = text.parse_filename("x")
    assert tuple(one(spark, "APPR_B%26W_2019.pdf", parsed)) == ("B&W", "2019", "filename", "approved")
    assert tuple(one(spark, "APPR_a+b%_2019%2Epdf", parsed)) == (None, "2019", "filename-scan", "approved")
    assert one(spark, "100%+%20", text.unescape("x")) == "100%+ "
    assert tuple(one(spark, "  Board  of \t Nursing ", text.agency("x", F.lit(None)))) == ("Board of Nursing", "document")
    assert tuple(one(spark, "ab\rOffice of X", text.agency("x", F.lit(None)))) == ("Office of X", "document")


def test_probes(spark):
    rows = [(200, "application/pdf", None, None, None), (200, "text/html", 206, "application/pdf", "%PDF-1.7"), (200, "text/html", 206, "application/pdf", "<html>"), (405, None, 200, "application/pdf", "<html>"), (405, None, 403, None, None), (0, "timed out", None, None, None), (404, None, 206, None, "%PDF")]
    df = spark.createDataFrame(rows, "c int, t string, rc int, rt string, h string")
    assert [r[0] for r in df.select(catalogue.probe_state(*map(F.col, ["c", "t", "rc", "rt", "h"]))).collect()] == ["verified", "verified by range", "unreachable", "verified by range", "unreachable", "network error", "unreachable"]


    good, bad = catalogue.split_verified(spark.createDataFrame([("verified",), ("verified by range",), ("unreachable",), (None,)], "state string"))
    assert (good.count(), bad.count()) == (2, 2)


def test_tables_are_kept_and_sought(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(len(built))

    for refresh, n in ((False, 1), (False, 1), (True, 2)):
        assert tables.kept(spark, f"{tmp_path}/kept", build, refresh).count() == n
    assert tables.first_table(spark, [f"{tmp_path}/none", f"{tmp_path}/kept"]).count() == 2
    assert tables.first_table(spark, [f"{tmp_path}/none"]) is None


def test_samples_survive_outliers(spark):
    ids = [*range(1000), 10**15, -(10**15), 5, 5]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long").repartition(4)
    assert sorted(r[0] for r in quality.systematic(df, 7).collect()) == sorted(ids)[::7]
    assert quality.systematic(df.limit(0), 7).count() == 0


def test_ids_and_summaries(spark):
    docs = spark.createDataFrame([("ok-1", "r/ok-1.md"), ("Bad", "r/Bad.md"), ("a-b", "r/other.md"), (None, "r/x.md")], "id string, path string")
    assert sorted((str(r.id), r.problem) for r in quality.odd_ids(docs).collect()) == [("Bad", "id outside its pattern"), ("None", "id outside its pattern"), ("a-b", "id is not the file's name")]
    many = spark.createDataFrame([("r", f"i{k:03}", "p") for k in range(300)], "rule string, id string, problem string")
    got = {r.rule: (r.violations, r.passed, r.first) for r in quality.summary(many, {"r": None, "s": None}).collect()}
    assert got == {"r": (300, False, [f"i{k:03}: p" for k in range(10)]), "s": (0, True, [])}
    assert quality.unassessed(docs).count() == 0 and [r.id for r in quality.unassessed(docs.withColumn("assessment", F.lit("green"))).collect()] == ["assessment"]


def test_a_lookup_reads_one_bucket(spark, tmp_path):
    pairs = [(f"n{i}", f"n{i % 7}") for i in range(200)] + [("hub", f"n{i}") for i in range(300)] + [(None, "n1"), ("n1", None), ("n1", "n1")]
    edges = spark.createDataFrame([(a, "t", b) for a, b in pairs], "`from` string, type string, `to` string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # as if partitions were large
    graph.write_adjacency(edges, f"{tmp_path}/a", each=50)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = spark.read.parquet(f"{tmp_path}/a/rows")
    assert whole.select("bucket").distinct().count() > 10
    for id in ("n1", "n3", "hub", "n150", "nobody"):
        got = sorted(map(tuple, graph.stored_neighbours(spark, f"{tmp_path}/a", id).collect()))
        assert got == sorted([("out", "t", b) for a, b in pairs if a == id and b] + [("in", "t", a) for a, b in pairs if b == id and a])
    found = graph.looked_up(spark, f"{tmp_path}/a", "hub")
    assert found.select(F.regexp_extract(F.col("_metadata.file_path"), "bucket=([0-9]+)", 1)).distinct().count() == 1
    assert "PartitionFilters: [isnotnull(bucket" in found._jdf.queryExecution().executedPlan().toString()
    # a hub is written by several tasks
    assert found.select(F.col("_metadata.file_path")).distinct().count() > 3
    docs = spark.createDataFrame([(f"d{i}", i) for i in range(100)] + [(None, 5)], "id string, n int")
    graph.write_documents(docs, f"{tmp_path}/d", each=10)
    assert graph.looked_up(spark, f"{tmp_path}/d", "d42").first().n == 42 and graph.looked_up(spark, f"{tmp_path}/d", "x").isEmpty()


def test_steps_of_a_walk_broadcast_nothing(spark):
    """Files of links are many times smaller than their rows, and so are nodes than their copies."""
    with storage.scratch(spark):
        links = graph.linked(spark.createDataFrame([("a", "b"), ("b", "c")], "from string, to string"), 1)
        found = graph.step(spark.createDataFrame([("a",)], "id string"), links)
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().sparkPlan().toString()
        assert [r.id for r in found.collect()] == ["b"]
