"""Citations in texts: named schemes, what each resolves to, and counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text


@dataclass(frozen=True)
class Scheme:
    """A kind of citation: how it looks, and the prefix of the ids it renders to (none: by lookup)."""

    name: str
    pattern: str
    target: str | None = None
    corpus: str | None = None


# How the citations of each scheme look.
SCHEMES = {
    "appr": Scheme("appr", r"APPR\s+[A-Z][A-Z0-9&.\- ]{1,40}?\s+(?:19|20)[0-9]{2}"),
    "ors-section": Scheme("ors-section", r"\bORS\s+([0-9]{1,3}[A-C]?\.[0-9]{3,4})\b", "ors-", "statutes"),
    "oar-rule": Scheme("oar-rule", r"\bOAR\s+([0-9]{3}-[0-9]{3}-[0-9]{4})\b", "oar-", "rules"),
}


def register(name: str, pattern: str, target: str | None = None, corpus: str | None = None) -> Scheme:
    SCHEMES[name] = Scheme(name, pattern, target, corpus)
    return SCHEMES[name]


def found(docs: DataFrame, scheme: str, column: str = "text") -> DataFrame:
    """``(doc_id, scheme, cited, target)`` for each occurrence, also over line ends."""
    s = SCHEMES[scheme]
    hits = docs.select("doc_id", F.explode(F.regexp_extract_all(column, F.lit(s.pattern), F.lit(0))).alias("cited"))
    cited = text.loose("cited")
    target = F.concat(F.lit(s.target), F.regexp_extract("cited", s.pattern, 1)) if s.target else cited
    return hits.select("doc_id", F.lit(scheme).alias("scheme"), cited.alias("cited"), target.alias("target"))


def counts(citations: DataFrame) -> DataFrame:
    """Occurrences, documents and distinct targets of each scheme."""
    return citations.groupBy("scheme").agg(
        F.count("*").alias("occurrences"), F.count_distinct("doc_id").alias("documents"), F.count_distinct("target").alias("targets")
    )


def _spaced(x: Column) -> Column:
    return F.regexp_replace(F.upper(x), r"\s+", "-")


def index(docs: DataFrame, strict: bool = False) -> DataFrame:
    """``(key, year, doc_id)``: documents by code, by agency slug and, unless strict, by its cut form.

    Stamped citations cut a slug to 24 characters; with the cut form indexed they find themselves.
    """
    slug = F.upper(text.slug("agency"))
    keys = [_spaced(F.nullif("agency_code", F.lit(""))), slug] + ([] if strict else [F.substring(slug, 1, 24)])
    return docs.select(F.explode(F.array_distinct(F.array_compact(F.array(*keys)))).alias("key"), F.col("reporting_year").alias("year"), "doc_id")


def resolve(cited: DataFrame, docs: DataFrame, strict: bool = False) -> DataFrame:
    """``(cited, doc_ids)`` of distinct APPR citations: the sorted ids that each names, none perhaps."""
    each = cited.select("cited").distinct()
    each = each.select("cited", _spaced(F.regexp_extract("cited", r"^APPR\s+(.*)\s+[0-9]{4}$", 1)).alias("key"), F.regexp_extract("cited", r"([0-9]{4})$", 1).alias("year"))
    ids = index(docs, strict).groupBy("key", "year").agg(F.array_sort(F.collect_set("doc_id")).alias("ids"))
    met = each.join(ids, ["key", "year"], "left")
    return met.select("cited", F.array_join(F.coalesce("ids", F.array().cast("array<string>")), ",").alias("doc_ids"))


def sibling_state(citations: DataFrame, published: DataFrame | None) -> DataFrame:
    """``(target, state)``: whether a sibling corpus has each cited id, or is not at hand."""
    targets = citations.select("target").distinct()
    if published is None:
        return targets.select("target", F.lit("sibling_unavailable").alias("state"))
    met = targets.join(published.select(F.col("id").alias("target"), F.lit(True).alias("there")).distinct(), "target", "left")
    return met.select("target", F.when(F.col("there"), "resolved").otherwise("unresolved").alias("state"))
