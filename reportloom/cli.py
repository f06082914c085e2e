"""Commands: ``python -m reportloom.cli COMMAND PATH ...``.

``series graph rules crosswalk manifest site index search cite`` work on a collection; ``ingest``
keeps the series of a folder of files at ``--out`` and works out only what has changed;
``document resolve neighbours chain vectors`` ask it for one thing, as a reader does.

Documents are a Parquet table with the columns that the operators name, or a folder of Markdown
files with ``--markdown``; manifests and crosswalks may be listings (``.yml``); ``search`` takes
what ``index`` wrote, ``vectors`` a Parquet table ``(vec_id, embedding)``, and
``neighbours`` what ``graph --out`` wrote as well.  A check exits with 0
(all well), 1 (violations or a stale table) or 2 (it could not run, which is not a pass).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text
from .operators import catalogue, citations, entities, graph, quality, search, series, sinks
from .sources import frontmatter, ledger, listings, storage, tables

COMMANDS = ["series", "graph", "rules", "crosswalk", "manifest", "site", "index", "search", "cite", "document", "resolve", "neighbours", "chain", "vectors", "ingest"]


def _crosswalk(spark: SparkSession, path: str, section: str) -> DataFrame:
    """Mapped or unmapped keys, from a listing or a Parquet table."""
    if not path.endswith((".yml", ".yaml")):
        return spark.read.parquet(path)
    fields = ["slug", "basis", "note"] if section == "mapping" else ["reason"]
    rows = listings.read_map(spark, path, section)
    return rows.select(F.col("key").alias("agency_key"), *[F.element_at("fields", F.lit(c)).alias(c) for c in fields])


def _sources(spark: SparkSession, path: str) -> DataFrame:
    """A manifest's sources, from a listing or a Parquet table."""
    if not path.endswith((".yml", ".yaml")):
        return spark.read.parquet(path)
    rows = listings.read_items(spark, path)
    return rows.select(*[F.element_at("fields", F.lit(c)).alias(c) for c in sinks.SOURCE])


def _rules(spark: SparkSession, docs: DataFrame, a: argparse.Namespace) -> int:
    """Every rule that the documents have the columns for; one that cannot run makes the check no pass."""
    wanted: dict[str, tuple[list[str], quality.Rule | None]] = {
        "year_provenance": (["reporting_year", "year_source"], quality.year_provenance),
        "status": (["measure_status"], quality.status_domain),
        "caveat": (["body"], quality.has_caveat(a.caveat or quality.CAVEAT)),
        "no_assessment": ([], quality.unassessed),
        "ocr_declared": (["text_source", "body", "conversion_notes"], quality.ocr_declared()),
        "registry_link": (["agency_registry_slug", "agency_registry_corpus", "agency_key"], quality.registry_link(_crosswalk(spark, a.mapping, "mapping"), a.corpus) if a.mapping else None),
        "series": ([], quality.series_documents(spark.read.parquet(f"{a.series}/rows")) if a.series else None),
        "ids": (["path"], quality.odd_ids),
        "doc_type": (["path", "doc_type"], quality.placed_by_type()),
    }
    rules = {name: rule for name, (columns, rule) in wanted.items() if rule and {*columns, "id"} <= set(docs.columns)}
    skipped = sorted(set(wanted) - set(rules))
    if not rules:
        print("skipped: no rule has its columns", file=sys.stderr)
        return quality.outcome(True, 0)
    found = storage.stored(quality.run_rules(docs, rules), "violations")
    bad = quality.summary(found, rules)
    bad.show(truncate=False)
    if skipped:
        print(f"skipped: {', '.join(skipped)}", file=sys.stderr)
    violations = found.count()
    return quality.outcome(bool(skipped) and not violations, violations)


def _show(rows: DataFrame) -> int:
    """Rows of a bounded answer as JSON lines; 1 if there is none."""
    lines = [r["line"] for r in rows.select(F.to_json(F.struct("*")).alias("line")).collect()]
    print("\n".join(lines))
    return int(not lines)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="reportloom")
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("path", help="Parquet table of documents, or what the command names")
    p.add_argument("--out", help="folder to write to")
    p.add_argument("--check", action="store_true", help="compare with what is in --out and write nothing")
    p.add_argument("--years", nargs="*", help="keep these reporting years, and unknown ones")
    p.add_argument("--only", help="one document id")
    p.add_argument("--limit", type=int)
    p.add_argument("--report", action="store_true", help="print counts")
    p.add_argument("--registry", nargs="*", help="Parquet table of slugs: the first of these paths that is there")
    p.add_argument("--mapping", help="Parquet table of the crosswalk, or a listing")
    p.add_argument("--unmapped", help="Parquet table of keys without a slug, or a listing")
    p.add_argument("--corpus", default="registry", help="name of the corpus that defines slugs")
    p.add_argument("--caveat", help="the sentence that every body must carry")
    p.add_argument("--series", help="folder of a written series")
    p.add_argument("--first", type=int, default=2014, help="first year that a manifest attempts")
    p.add_argument("--last", type=int, default=2026, help="last year that a manifest attempts")
    p.add_argument("--note", default="", help="note at the head of a manifest")
    p.add_argument("--query", default="")
    p.add_argument("--markdown", action="store_true", help="PATH is a folder of Markdown files")
    p.add_argument("--json", action="store_true", help="write JSON lines instead of Parquet")
    a = p.parse_args(args)
    spark = spark or SparkSession.builder.appName("reportloom").getOrCreate()
    with storage.scratch(spark):
        return _run(spark, a)


def _run(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.command == "search":
        search.keyword(spark, a.path, a.query, a.limit or 20).show(truncate=False)
        return 0
    if a.command == "ingest":
        if not a.out:
            print("ingest needs --out", file=sys.stderr)
            return quality.outcome(True, 0)
        done = ledger.refresh(spark, a.path, a.out, series.of_files)
        print(f"{done.read} file(s) read, {done.built} document(s) worked out, {done.gone} gone")
        return 0
    if a.command == "vectors":
        return _show(search.vector(spark.read.parquet(a.path), json.loads(a.query), a.limit or 20))
    if a.command == "manifest":
        sources = _sources(spark, a.path)
        catalogue.count_by_year(sources).orderBy("year").show()
        if a.out and a.json:
            sinks.write_manifest(sources, a.out)
        elif a.out:
            columns = [c for c in sinks.SOURCE if c in sources.columns]
            facts = catalogue.facts(sources, a.first, a.last, note=a.note, recheck="annual")
            listings.write_manifest(sources, a.out, facts, columns)
        return 0
    if a.command == "neighbours" and tables.there(spark, f"{a.path}/adjacency/layout"):
        return _show(graph.stored_neighbours(spark, f"{a.path}/adjacency", a.only).orderBy("direction", "type", "id"))
    docs = frontmatter.documents(spark, a.path) if a.markdown else spark.read.parquet(a.path)
    if a.command in ("document", "neighbours", "chain", "resolve"):
        return _asked(spark, docs, a)
    if a.years:
        docs = catalogue.year_filter(docs, a.years)
    if a.only:
        docs = docs.where(F.col("doc_id" if "doc_id" in docs.columns else "id") == a.only)
        if docs.isEmpty():
            print(f"no document {a.only}", file=sys.stderr)
            return 2
    if a.limit:
        docs = docs.orderBy(docs.columns[0]).limit(a.limit)
    if a.command == "series":
        found = series.extract(docs)
        if a.report:
            series.counts(found).show(truncate=False)
        rows = found.rows.drop("measure_text", "block", "run", "year_index")
        if a.check:
            return int(sinks.is_stale(spark, f"{a.out}/rows", rows, a.json))
        if a.out:
            sinks.write_series(found, a.out, a.json)
        return 0
    if a.command == "graph":
        edges = graph.all_edges(docs)
        if a.check:
            return int(sinks.is_stale(spark, f"{a.out}/edges", edges, a.json))
        if a.out:
            sinks.write_graph(graph.nodes(docs), edges, a.out, a.json)
        return 0
    if a.command == "rules":
        return _rules(spark, docs, a)
    if a.command == "crosswalk":
        registry = tables.first_table(spark, a.registry or [])
        unmapped = a.unmapped or (a.mapping if (a.mapping or "").endswith((".yml", ".yaml")) else None)
        if not (a.mapping and unmapped) or (a.registry and registry is None):
            print("skipped: a mapping and unmapped keys are needed, and the registry if one is named", file=sys.stderr)
            return quality.outcome(True, 0)
        keyed = docs.withColumn("agency_key", text.entity_key("agency"))
        stamps = keyed.select("agency_key", "agency_registry_slug") if "agency_registry_slug" in docs.columns else None
        keys = keyed.select("agency_key").where("agency_key <> ''").distinct()
        problems = storage.stored(entities.crosswalk_problems(keys, _crosswalk(spark, a.mapping, "mapping"), _crosswalk(spark, unmapped, "unmapped"), registry, stamps), "problems")
        print(sinks.work_list(problems))
        return quality.outcome(False, problems.count())
    if a.command == "site":
        sinks.write_site(graph.nodes(docs), graph.overview(docs), a.out)
        return 0
    if a.command == "index":
        search.write_index(docs, a.out)
        return 0
    found = citations.found(docs, "ors-section").union(citations.found(docs, "oar-rule"))
    citations.counts(found).show()
    return 0


def _asked(spark: SparkSession, docs: DataFrame, a: argparse.Namespace) -> int:
    """One document, what a citation means, or what stands around a document."""
    if a.command == "document":
        return _show(docs.where(F.col("id") == a.only))
    if a.command == "resolve":
        cited = spark.createDataFrame([(a.query.strip(),)], "cited string")
        return _show(citations.resolve(cited, docs.withColumn("doc_id", F.col("id"))).where("doc_ids <> ''"))
    edges = graph.all_edges(docs)
    if a.command == "neighbours":
        return _show(graph.neighbours(edges, a.only).orderBy("direction", "type", "id"))
    return _show(graph.authority_chain(edges, a.only).orderBy("depth", "id"))


if __name__ == "__main__":
    sys.exit(main())
