import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from reportloom import cli
from reportloom.operators import catalogue, quality, sinks
from reportloom.sources import files, frontmatter, ledger, listings
from reportloom.sources.reports import reports


def test_series_is_written_and_checked(spark, tmp_path):
    docs = reports(spark, "/root/testdata/sf0.001").where("n < 2")
    docs.write.parquet(f"{tmp_path}/docs")
    out = f"{tmp_path}/out"
    assert cli.main(["series", f"{tmp_path}/docs", "--out", out], spark) == 0
    assert cli.main(["series", f"{tmp_path}/docs", "--out", out, "--check"], spark) == 0
    assert cli.main(["series", f"{tmp_path}/docs", "--out", out, "--check", "--only", "rpt-1-2000"], spark) == 1
    assert cli.main(["series", f"{tmp_path}/docs", "--only", "none"], spark) == 2
    assert cli.main(["crosswalk", f"{tmp_path}/docs"], spark) == 2


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("a", "T", "x", None, "# head\nbody"), ("b", "U|V", "x", "2019", None)], "id string, title string, doc_type string, reporting_year string, full_text string")
    sinks.write_reports(docs, f"{tmp_path}/md")
    back = {r.id: r for r in frontmatter.documents(spark, f"{tmp_path}/md").collect()}
    assert set(back) == {"a", "b"} and back["b"].title == "U|V" and back["a"].reporting_year is None and back["b"].reporting_year == "2019"
    assert back["a"].text == "# head\nbody" or back["a"].text == " # head\nbody".strip() and quality.CAVEAT in back["a"].body
    sinks.write_texts(docs.select("id", F.col("full_text").alias("text"), F.lit("  x").alias("layout")), f"{tmp_path}/texts")
    assert sorted((r.id, r.kind, r.text) for r in spark.read.parquet(f"{tmp_path}/texts").collect()) == [("a", "layout", "  x"), ("a", "text", "# head\nbody"), ("b", "layout", "  x")]
    late = quality.freshness(docs.withColumn("last_verified", F.lit("")), "2025-01-01")
    assert "- 1 more" in sinks.status_report(docs, late, 3, named=1)
    problems = spark.createDataFrame([("a|b", "stale")], "agency_key string, problem string")
    assert "a\\|b" in sinks.work_list(problems)
    several = spark.createDataFrame([(f"k{i}", "stale") for i in range(5)] + [("a", "no slug")], "agency_key string, problem string")
    assert sinks.work_list(several, named=2).split("\n")[2:-1] == ["| no slug | a |", "| stale | k0 |", "| stale | k1 |", "| stale | 3 more |"]
    sinks.write_work_list(several, f"{tmp_path}/work")
    assert spark.read.text(f"{tmp_path}/work").count() == 6


def test_manifest_graph_and_site(spark, tmp_path):
    sources = spark.createDataFrame([("b", "2019", None, 5), ("a", "2019", "X", 6), ("c", None, "Y", 7)], "id string, reporting_year string, agency_code string, bytes long")
    sinks.write_manifest(sources, f"{tmp_path}/m", "note", 2018, 2020)
    back = sinks.read_manifest(spark, f"{tmp_path}/m")
    assert sorted((r.id, r.reporting_year, r.bytes) for r in back.collect()) == [("a", "2019", 6), ("b", "2019", 5), ("c", None, 7)]
    rows = sorted((r.kind, r.name) for r in spark.read.json(f"{tmp_path}/m/coverage").collect())
    assert rows == [("gap", "2018"), ("gap", "2020"), ("note", "note"), ("unparsed", "b"), ("unparsed", "c"), ("year", "2019"), ("year", "None")]
    nodes = spark.createDataFrame([("a", "A & B", "report", "current", "p/a.md")], "id string, title string, doc_type string, status string, path string")
    edges = spark.createDataFrame([("a", "related", "a"), ("a", "related", "z")], "`from` string, type string, `to` string")
    sinks.write_graph(nodes, edges, f"{tmp_path}/g", as_json=True)
    assert tuple(spark.read.json(f"{tmp_path}/g/counts").select("n_nodes", "n_edges", "n_edges_external").first()) == (1, 2, 1)
    sinks.write_site(nodes, nodes.select(F.lit(1).alias("nodes"), F.lit("2019").alias("first_year")), f"{tmp_path}/site")
    assert spark.read.json(f"{tmp_path}/site/corpus-index").first().row == ["A & B", "report", "p/a.md"]
    assert "<b>2019</b> first year" in "\n".join(r.value for r in spark.read.text(f"{tmp_path}/site/page").collect())


def test_search_command(spark, tmp_path, capsys):
    spark.createDataFrame([(1, "alpha"), (2, "beta")], "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    assert cli.main(["index", f"{tmp_path}/d", "--out", f"{tmp_path}/i"], spark) == 0
    assert cli.main(["search", f"{tmp_path}/i", "--query", "beta"], spark) == 0
    assert "|2 " in capsys.readouterr().out.replace("| 2", "|2").replace("|     2", "|2")


def test_files_are_written_as_a_set(spark, tmp_path):
    """A file for each row; a task that fails leaves the old files, and nothing beside them."""
    rows = spark.createDataFrame([(f"d{i % 3}/n{i}.md", f"é {i}\n") for i in range(40)], "name string, content string").repartition(4)
    out = tmp_path / "set"
    files.write_files(rows, str(out))
    read = lambda: {str(p.relative_to(out)): p.read_text() for p in out.rglob("*.md")}
    assert read() == {f"d{i % 3}/n{i}.md": f"é {i}\n" for i in range(40)}
    with pytest.raises(Exception, match="no name for a file"):
        files.write_files(rows.select("name", F.lit("new").alias("content")).union(spark.sql("SELECT '../x', 'y'")), f"file://{out}")
    assert len(read()) == 40 and "new" not in read().values() and [p.name for p in tmp_path.iterdir()] == ["set"]
    # a task that outlives the abort brings no folder back
    late = files.FolderWriter(str(out))
    late.begin()
    late.abort([])
    with pytest.raises(OSError):
        late.write(iter([Row(name="d0/n0.md", content="late")]))
    assert [p.name for p in tmp_path.iterdir()] == ["set"]
    with pytest.raises(ValueError, match="one name"):
        files.write_files(rows.union(rows.limit(1)), str(out))
    with pytest.raises(Exception, match="overwrite"):
        rows.write.format("file_for_each").mode("append").save(str(out))
    files.write_files(rows.limit(1), str(out))
    assert len(read()) == 1 and [p.name for p in tmp_path.iterdir()] == ["set"]


def test_stale_json(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 1)], "x string, n int")
    df.write.json(f"{tmp_path}/j")
    assert not sinks.is_stale(spark, f"{tmp_path}/j", df, True) and sinks.is_stale(spark, f"{tmp_path}/j", df.limit(1), True)


def test_pages_that_a_sweep_reads(spark):
    def brute(pages, size):
        out = []
        for q in {p[0] for p in pages}:
            at = 1
            while own := [p for p in pages if p[:2] == (q, at)]:
                last = max(own, key=lambda p: p[4])
                if not last[2]:
                    break
                out.append(last)
                if len(last[3] or []) < size:
                    break
                at += size
        return sorted(out, key=str)

    rng = random.Random(1)
    pages = [(q, 1 + 3 * s + (q % 9 == 0), rng.random() > 0.1, [1] * rng.choice([3, 3, 3, 4, 2, 0]), t) for q in range(60) for s in range(6) for t in range(rng.choice([0, 1, 1, 1, 1, 2]))] + [(99, 1, None, None, 0), (98, 1, True, None, 0)]
    df = spark.createDataFrame(pages, "query int, start int, ok boolean, items array<int>, at int")
    got = catalogue.taken(df, 3, "at").select("query", "start", "ok", "items", "at").collect()
    assert sorted(map(tuple, got), key=str) == brute(pages, 3) and len(got) > 60


def test_commands_on_files(spark, tmp_path, capsys):
    """From rows to report files, and every command on the files."""
    rows = [("r-2018", "Board of Ants", "ants", "ANT", "2018", None, "s-1"), ("r-2019", "Ants, Board of", "ants", None, "2019", ["r-x"], "s-1"), ("r-x", "Bees", "bees", "BEE", None, [], None)]
    docs = spark.createDataFrame([(*r, "document", "approved", "pdf-text", "performance_report", "k", "alpha beta") for r in rows], "id string, agency string, agency_key string, agency_code string, reporting_year string, implements array<string>, agency_registry_slug string, year_source string, measure_status string, text_source string, doc_type string, status string, full_text string")
    docs = docs.withColumn("relationships", F.struct(*[(F.col("implements") if r == "implements" else F.lit(None).cast("array<string>")).alias(r) for r in frontmatter.RELATIONS]))
    docs = docs.withColumn("agency_registry_corpus", F.when(F.col("agency_registry_slug").isNotNull(), "registry")).withColumn("conversion_notes", F.lit(""))
    at, out = f"{tmp_path}/c", f"{tmp_path}/out"
    sinks.write_reports(docs, at, "reports")
    said = lambda *args: (cli.main([args[0], args[1], *args[2:]], spark), capsys.readouterr().out)
    code, shown = said("document", at, "--markdown", "--only", "r-2019")
    assert code == 0 and json.loads(shown)["relationships"]["implements"] == ["r-x"] and "agency_code" not in json.loads(shown)
    assert said("document", at, "--markdown", "--only", "none")[0] == 1
    code, shown = said("neighbours", at, "--markdown", "--only", "r-2019")
    assert code == 0 and [tuple(json.loads(x).values()) for x in shown.split()] == [("out", "implements", "r-x"), ("out", "related", "r-2018")]
    assert [json.loads(x)["id"] for x in said("chain", at, "--markdown", "--only", "r-2019")[1].split()] == ["r-2018", "r-x"]
    assert json.loads(said("resolve", at, "--markdown", "--query", "APPR ANT 2018")[1])["doc_ids"] == "r-2018"
    spark.createDataFrame([("ants", "s-1", "exact", None), ("bees", "s-2", "exact", None)], "agency_key string, slug string, basis string, note string").createOrReplaceTempView("m")
    walk = f"{tmp_path}/walk.yml"
    listings.write_crosswalk(spark.table("m"), spark.createDataFrame([], "agency_key string, reason string"), walk, {"note": "n"})
    code, shown = said("rules", at, "--markdown", "--mapping", walk)
    assert code == 1 and "year_provenance|1" in shown.replace(" ", "") and "registry_link|0" in shown.replace(" ", "") and "caveat|0" in shown.replace(" ", "")
    sound = f"{tmp_path}/sound"
    sinks.write_reports(docs.where("reporting_year is not null"), sound, "reports")
    assert said("rules", sound, "--markdown", "--mapping", walk)[0] == 2  # no series was given: not a pass
    code, shown = said("crosswalk", at, "--markdown", "--mapping", walk)
    assert code == 1 and "1 mapped document(s) carry no slug" in shown
    assert said("graph", at, "--markdown", "--out", out, "--json")[0] == 0 and said("graph", at, "--markdown", "--out", out, "--json", "--check")[0] == 0
    assert said("neighbours", out, "--only", "r-2019") == said("neighbours", at, "--markdown", "--only", "r-2019") and said("neighbours", out, "--only", "zz")[0] == 1
    assert said("site", at, "--markdown", "--out", f"{tmp_path}/site")[0] == 0 and "<b>2</b> edges" in "".join(r.value for r in spark.read.text(f"{tmp_path}/site/page").collect())
    docs.select("id", F.col("agency_code"), "reporting_year", "agency").write.parquet(f"{tmp_path}/s")
    assert said("manifest", f"{tmp_path}/s", "--out", f"{tmp_path}/m.yml")[0] == 0
    assert "2019|1" in said("manifest", f"{tmp_path}/m.yml")[1].replace(" ", "")
    spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/v")
    assert json.loads(said("vectors", f"{tmp_path}/v", "--query", "[0, 2]", "--limit", "1")[1]) == {"vec_id": 2, "score": 1.0}


def test_difference_by_fingerprints(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), {"k": rng.randint(0, 3)} if rng.random() < 0.1 else None) for _ in range(400)]
    plain = [r[:2] for r in rows]
    old = spark.createDataFrame(plain, "x string, n int")
    swapped = spark.createDataFrame([("1", None), (None, 1)], "x string, n int")
    for split in (2, 1024):
        monkeypatch.setattr(catalogue, "SPLIT", split)
        new = spark.createDataFrame(plain[5:] + plain[-3:] + [("z", 9)], "x string, n int").repartition(5)
        want = sorted([("old", *r) for r in old.exceptAll(new).collect()] + [("new", *r) for r in new.exceptAll(old).collect()], key=str)
        assert sorted(map(tuple, catalogue.difference(old, new).collect()), key=str) == want and want
        assert catalogue.difference(old, old.orderBy("n")).isEmpty() and catalogue.difference(swapped.limit(1), spark.createDataFrame([(None, 1)], "x string, n int")).count() == 2
    same = spark.createDataFrame(rows, "x string, n int, m map<string,int>")
    assert catalogue._odd_buckets(same, same.repartition(3), 0) == []
    # tables that are equal are not compared row by row
    plan = catalogue.difference(old, old)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Scan" not in plan


def test_ingest_keeps_the_series_of_a_folder(spark, tmp_path, capsys):
    docs = reports(spark, "/root/testdata/sf0.001").where("n < 2").withColumns({"id": F.col("doc_id"), "title": F.col("doc_id")})
    root, out = f"{tmp_path}/files", f"{tmp_path}/kept"
    sinks.write_reports(docs, root)
    assert cli.main(["ingest", root], spark) == 2
    assert cli.main(["ingest", root, "--out", out], spark) == 0
    assert "6 file(s) read, 6 document(s) worked out, 0 gone" in capsys.readouterr().out
    assert cli.main(["ingest", root, "--out", out], spark) == 0
    assert "0 file(s) read, 0 document(s) worked out, 0 gone" in capsys.readouterr().out
    assert {r.agency_doc for r in ledger.table_of(spark, out, "rows").collect()} == {r.id for r in docs.collect()}
