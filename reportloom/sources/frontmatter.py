"""Markdown documents that begin with fields between two rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as f
from ..functions import text


def block(md: str | Column, strict: bool = True) -> Column:
    """The text between the rules; null without both (strict), or up to the next ``---`` (lenient)."""
    md = F.col(md) if isinstance(md, str) else md
    if strict:
        return F.when(md.rlike(r"(?s)\A---\n.*?\n---\n"), F.regexp_extract(md, r"(?s)\A---\n(.*?)\n---\n", 1))
    parts = F.split(md, "---", 3)
    return F.when(F.size(parts) == 3, F.get(parts, F.lit(1))).otherwise("")


#: What reports state, in the order in which they are written.
SCALARS = [
    "schema_version", "corpus", "jurisdiction", "id", "title", "doc_type", "citation", "authority_level", "issuing_body", "agency", "agency_key",
    "agency_registry_slug", "agency_registry_corpus", "agency_code", "reporting_year", "year_source", "text_source", "filename_year", "measure_status",
    "source_url", "source_filename", "source_format", "retrieved", "source_sha256", "status", "content_mode", "snapshot_policy", "conversion_notes",
    "maintainer", "last_verified", "verified_by",
]
RELATIONS = ["implements", "implemented_by", "references_external", "related", "supersedes"]


def fields(md: str | Column, strict: bool = True) -> Column:
    """A map of the scalar fields, nested names joined by dots; a field that is null has a null value."""
    return f.stated(block(md, strict))["fields"]


def scan(spark: SparkSession, root: str) -> DataFrame:
    """``(path, md, fields, lists, problem, full_text)`` of content files, those named ``_*`` and CHANGELOG.md left out.

    Rows come in no order; the path is what first and last wins go by.
    """
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    named = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("md"))
    named = named.where(~F.col("name").startswith("_") & (F.col("name") != "CHANGELOG.md"))
    return read(named.drop("name"))


def read(files: DataFrame, md: str = "md") -> DataFrame:
    """``files`` with ``fields``, ``lists``, ``problem`` and ``full_text`` of the Markdown in a column."""
    said = files.withColumn("said_", f.stated(block(md)))
    return said.select(*files.columns, "said_.fields", "said_.lists", "said_.problem", text.section(md, "Full text").alias("full_text"))


def documents(spark: SparkSession, root: str) -> DataFrame:
    """Content files as documents (see :func:`as_documents`)."""
    return as_documents(scan(spark, root))


def as_documents(rows: DataFrame) -> DataFrame:
    """A column for each field that reports carry, null where it is null or absent.

    ``relationships`` is a struct of lists and ``tags`` a list, null where the file has none;
    ``field_names`` are all names that stand in the file.  ``doc_id`` is the id; ``text`` the full
    text; ``body`` all that stands after the fields; ``notes`` the conversion notes.
    """
    scalars = [F.element_at("fields", F.lit(k)).alias(k) for k in SCALARS]
    relations = F.struct(*[F.element_at("lists", F.lit(f"relationships.{r}")).alias(r) for r in RELATIONS])
    body = F.regexp_replace("md", r"(?s)\A---\n.*?\n---\n", "")
    return rows.select(
        "path",
        *scalars,
        relations.alias("relationships"),
        F.element_at("lists", F.lit("tags")).alias("tags"),
        F.array_sort(F.array_union(F.map_keys("fields"), F.map_keys("lists"))).alias("field_names"),
        "problem",
        F.element_at("fields", F.lit("id")).alias("doc_id"),
        F.element_at("fields", F.lit("conversion_notes")).alias("notes"),
        body.alias("body"),
        text.strip("full_text").alias("text"),
    )
