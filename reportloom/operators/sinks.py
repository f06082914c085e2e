"""Tables, texts and reports that the operators' results are written to."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fields, text
from ..sources import files, frontmatter
from . import catalogue, graph, quality
from . import series as s

#: Fields of a source in a manifest, in order.
SOURCE = ["id", "url", "format", "filename", "doc_type", "agency_code", "agency", "reporting_year", "year_source", "measure_status", "date_published", "bytes", "recheck", "sha256"]
#: Texts in a folder, about.
TEXTS = 100_000


def markdown(docs: DataFrame) -> Column:
    """A report as Markdown: its fields, a glance at them, and its whole text.

    Every field that ``docs`` has a column for is written so that it reads back as it is, null as
    null; an agency without a registry slug has no such field.  ``relationships`` and ``tags`` are
    lists.  The glance carries the caveat that every report must show, and says so if OCR read the
    text (``full_text``, or ``text``).
    """
    optional = ("agency_registry_slug", "agency_registry_corpus")
    said = lambda c: F.col(c).cast("string")
    lines = []
    for f in (c for c in frontmatter.SCALARS if c in docs.columns):
        line = F.concat(F.lit(f"{f}: "), fields.written(said(f)))
        lines.append(F.when(F.col(f).isNotNull(), line) if f in optional else line)
    listed = lambda name, items, pad: F.when(F.coalesce(F.size(items), F.lit(0)) <= 0, f"{pad}{name}: []").otherwise(F.concat(F.lit(f"{pad}{name}:"), F.array_join(F.transform(items, lambda x: F.concat(F.lit(f"\n{pad}- "), fields.written(x))), "")))
    if "relationships" in docs.columns:
        lines += [F.lit("relationships:"), *[listed(r, F.col(f"relationships.{r}"), "  ") for r in frontmatter.RELATIONS]]
    if "tags" in docs.columns:
        lines.append(listed("tags", F.col("tags"), ""))
    has = lambda c: F.nullif(said(c), F.lit("")) if c in docs.columns else F.lit(None).cast("string")
    who, year = F.coalesce(has("agency"), F.lit("unnamed agency")), F.coalesce(has("reporting_year"), F.lit("not stated"))
    status = F.when(has("measure_status") == "proposed", "proposed").otherwise("approved")
    glance = [
        F.concat(F.lit("**"), F.coalesce(has("citation"), has("id"), F.lit("")), F.lit("**, "), who),
        F.lit(""),
        F.concat(F.lit("- Reporting year: "), year),
        F.concat(F.lit("- Measures: "), status),
        F.when(has("source_filename").isNotNull(), F.concat(F.lit("- Source file: `"), has("source_filename"), F.lit("`"))),
        F.lit(""),
        F.lit(f"_A copy. Figures and assessments are {quality.CAVEAT}, and nobody else's finding; check figures and periods at the source._"),
        F.when(has("text_source") == "ocr", f"\n_The source has no text of its own: what follows is a {quality.OCR_SENTENCE}, with errors in words and figures._"),
    ]
    whole = F.coalesce(F.col("full_text" if "full_text" in docs.columns else "text"), F.lit(""))
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n\n## At a glance\n\n"), F.concat_ws("\n", *glance), F.lit("\n\n## Full text\n\n"), text.escape_headings(whole), F.lit("\n"))


def write_reports(docs: DataFrame, path: str, folder: str = "") -> None:
    """Reports as Markdown, a file ``<id>.md`` for each, in place of what the folder held (see :mod:`files`).

    ``folder`` puts them below the path.  A document without an id is left out, as it has no name.
    """
    named = docs.where(F.coalesce("id", F.lit("")) != "")
    files.write_files(named.select(F.concat(F.lit(folder and f"{folder}/"), "id", F.lit(".md")).alias("name"), markdown(docs).alias("content")), path)


def write_texts(docs: DataFrame, path: str, each: int = TEXTS) -> None:
    """Texts and layout sidecars, ``(id, kind, text)``: a row for each that a document has, about ``each`` to a folder."""
    kinds = [docs.select("id", F.lit(kind).alias("kind"), F.col(c).alias("text")) for kind, c in (("text", "text"), ("layout", "layout")) if c in docs.columns]
    rows = kinds[0]
    for x in kinds[1:]:
        rows = rows.union(x)
    rows = rows.where("text is not null")
    buckets = max(1, -(-rows.count() // each))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")).repartition(buckets, "bucket")
    dealt.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(path)


def write_manifest(sources: DataFrame, path: str, note: str = "", first: int | None = None, last: int | None = None) -> None:
    """A manifest as JSON lines in the order of year, code and id, and its coverage beside them.

    ``coverage`` holds the sources of each year, attempted years without any (``first`` to
    ``last``), names that no pattern parsed, and the note.
    """
    spark = sources.sparkSession
    order = [catalogue.as_text(F.col(c)) for c in ("reporting_year", "agency_code")]
    sources.orderBy(*order, "id").write.mode("overwrite").json(f"{path}/sources")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    rows = catalogue.count_by_year(sources).select(F.lit("year").alias("kind"), F.col("year").alias("name"), F.col("sources").cast("long").alias("n"))
    if first is not None and last is not None:
        rows = rows.union(catalogue.year_gaps(sources, first, last).select(F.lit("gap"), "year", F.lit(0).cast("long")))
    rows = rows.union(sources.where(blank("agency_code") | blank("reporting_year")).select(F.lit("unparsed"), "id", F.lit(1).cast("long")))
    rows.union(spark.createDataFrame([("note", note, 0)], "kind string, name string, n long")).orderBy("kind", "name").write.mode("overwrite").json(f"{path}/coverage")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The sources of a written manifest; numbers and years stay text, but for ``bytes``."""
    df = spark.read.option("primitivesAsString", "true").json(f"{path}/sources")
    return df.withColumn("bytes", F.col("bytes").cast("long")) if "bytes" in df.columns else df


def write_graph(nodes: DataFrame, edges: DataFrame, path: str, as_json: bool = False) -> None:
    """Nodes, edges, and their counts with the edges that end outside the corpus; ``adjacency`` is for lookups."""
    graph.write_adjacency(edges, f"{path}/adjacency")
    external = edges.join(nodes.select(F.col("id").alias("to")), "to", "left_anti").agg(F.count("*").alias("n_edges_external"))
    counts = nodes.agg(F.count("*").alias("n_nodes")).join(edges.agg(F.count("*").alias("n_edges"))).join(external)
    for name, df in (("nodes", nodes), ("edges", edges), ("counts", counts)):
        writer = df.write.mode("overwrite")
        writer.json(f"{path}/{name}") if as_json else writer.parquet(f"{path}/{name}")


def write_series(found: s.Series, path: str, as_json: bool = False) -> None:
    """A series as tables: rows, problems, measures, restatements, conflicts and counts."""
    rows = found.rows
    tables = {
        "rows": rows.drop("measure_text", "block", "run", "year_index"),
        "problems": found.problems,
        "measures": s.lookup(rows),
        "restatements": s.restatements(rows),
        "conflicts": s.conflicts(rows),
        "counts": s.counts(found),
    }
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        writer.json(f"{path}/{name}") if as_json else writer.parquet(f"{path}/{name}")


def is_stale(spark: SparkSession, path: str, new: DataFrame, as_json: bool = False) -> bool:
    """Whether a written table, as Parquet or JSON lines, differs from what a rebuild gives, repeats counted."""
    old = spark.read.schema(new.schema).json(path) if as_json else spark.read.parquet(path)
    return not catalogue.difference(old.select(*new.columns), new).isEmpty()


def write_site(nodes: DataFrame, stats: DataFrame, path: str) -> None:
    """An index of ``[title, doc_type, path]`` rows in JSON, and a page of tiles and sections.

    The page shows the one row of ``stats`` as tiles and the documents of each type as a count.
    """
    index = nodes.select(F.array("title", "doc_type", "path").alias("row"))
    index.write.mode("overwrite").json(f"{path}/corpus-index")
    spark = nodes.sparkSession
    tiles = [f"<div class=tile><b>{v}</b> {k.replace('_', ' ')}</div>" for k, v in stats.first().asDict().items()]
    types = nodes.groupBy("doc_type").agg(F.count("*").alias("n")).orderBy("doc_type").collect()
    page = ["<!doctype html>", "<title>Corpus</title>", *tiles, *[f"<section><h2>{html.escape(str(r.doc_type))}</h2><p>{r.n} documents</p></section>" for r in types]]
    spark.createDataFrame([("\n".join(page),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/page")


def status_report(docs: DataFrame, overdue: DataFrame, sources: int, named: int = 50) -> str:
    """Counts by type, sources declared, and the first overdue documents, as Markdown."""
    types = docs.groupBy("doc_type").agg(F.count("*").alias("n")).orderBy("doc_type").collect()
    late = overdue.where("overdue").select("id").orderBy("id")
    first, n = late.limit(named).collect(), late.count()
    lines = ["# Status", "", *[f"- {r.doc_type}: {r.n}" for r in types], f"- sources declared: {sources}", "", f"## Overdue ({n})", "", *[f"- {r.id}" for r in first]]
    return "\n".join(lines + ([f"- {n - len(first)} more"] if n > len(first) else [])) + "\n"


def work_list(problems: DataFrame, named: int = 500) -> str:
    """Crosswalk problems as a Markdown table in buckets, pipes escaped, so many rows of each.

    A bucket that holds more ends with a row that says how many.  The whole list is the table
    ``problems``; :func:`write_work_list` writes it without a limit.
    """
    ranked = problems.withColumn("k", F.row_number().over(Window.partitionBy("problem").orderBy("agency_key"))).where(F.col("k") <= named)
    rows = ranked.orderBy("problem", "agency_key").select("problem", text.escape_pipes("agency_key").alias("key")).collect()
    more = {r.problem: r.n - named for r in problems.groupBy("problem").agg(F.count("*").alias("n")).collect() if r.n > named}
    out = ["| problem | agency |", "|-|-|"]
    for i, r in enumerate(rows):
        out.append(f"| {r.problem} | {r.key} |")
        if r.problem in more and (i + 1 == len(rows) or rows[i + 1].problem != r.problem):
            out.append(f"| {r.problem} | {more[r.problem]} more |")
    return "\n".join(out) + "\n"


def write_work_list(problems: DataFrame, path: str) -> None:
    """Every crosswalk problem as a line of a Markdown table, in order."""
    lines = problems.orderBy("problem", "agency_key").select(F.concat(F.lit("| "), "problem", F.lit(" | "), text.escape_pipes("agency_key"), F.lit(" |")).alias("value"))
    lines.write.mode("overwrite").text(path)
