"""Rules over documents and series: each gives the rows that violate it."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import matching, text
from . import ranks

# Domains and thresholds of the rules.
YEAR_SOURCES = ["document", "filename", "filename-scan", "socrata"]
STATUSES = ["approved", "proposed"]
TEXT_SOURCES = ["pdf-text", "ocr"]
CAVEAT = "THE AGENCY'S OWN REPORT ON ITSELF"
OCR_SENTENCE = "MACHINE READING OF AN IMAGE"
OCR_PHRASES = ["agree on", "dictionary-recognizable", "NOT human-verified"]
DOC_TYPES = {"performance_report": "reports"}
OCR_WORDS, OCR_RATIO, OCR_AGREEMENT = 100, 0.80, 0.80
COVERAGE_FAIL, COVERAGE_WARN = 0.70, 0.90
REVERIFY_DAYS = 90
ID_PATTERN = r"^[a-z0-9][a-z0-9-]+$"
#: Problems of a rule that a summary names, and parts that they are ranked in first.
NAMED, PARTS = 10, 64
WORD = r"[a-z]{2,}"
FIGURE = r"\$?-?\p{Nd}[\p{Nd},]*(?:\.\p{Nd}+)?%?"
ENGINES = ["tesseract (ocrmypdf)", "paddleocr PP-OCRv6"]

Rule = Callable[[DataFrame], DataFrame]


def _bad(docs: DataFrame, where: Column, what: Column | str) -> DataFrame:
    return docs.where(F.coalesce(where, F.lit(True))).select("id", (F.lit(what) if isinstance(what, str) else what).alias("problem"))


def year_provenance(docs: DataFrame) -> DataFrame:
    """A reporting year is present and its source is a known one."""
    none = F.coalesce("reporting_year", F.lit("")) == ""
    odd = ~F.coalesce("year_source", F.lit("")).isin(YEAR_SOURCES)
    return _bad(docs, none, "no reporting year").union(_bad(docs, odd, "year_source outside its domain"))


def status_domain(docs: DataFrame) -> DataFrame:
    return _bad(docs, ~F.coalesce("measure_status", F.lit("")).isin(STATUSES), "measure_status outside its domain")


def has_caveat(caveat: str = CAVEAT) -> Rule:
    return lambda docs: _bad(docs, ~F.contains(F.coalesce("body", F.lit("")), F.lit(caveat)), "caveat missing")


def ocr_declared(phrases: list[str] | None = None, sentence: str = OCR_SENTENCE) -> Rule:
    """A text source in its domain; a text read by OCR says so in its body, in these words, and in its notes."""
    wanted_phrases = OCR_PHRASES if phrases is None else phrases

    def rule(docs: DataFrame) -> DataFrame:
        source = F.coalesce("text_source", F.lit(""))
        ocr = docs.where(source == "ocr")
        silent = ocr.where(~F.contains(F.coalesce("body", F.lit("")), F.lit(sentence))).select("id", F.lit("body does not say that OCR read it").alias("problem"))
        notes = "conversion_notes" if "conversion_notes" in docs.columns else "notes"
        wanted = ocr.select("id", F.coalesce(notes, F.lit("")).alias("notes"), F.explode(F.array(*[F.lit(p) for p in wanted_phrases])).alias("p"))
        lacking = wanted.where(~F.contains("notes", F.col("p"))).select("id", F.concat(F.lit("notes lack: "), F.col("p")).alias("problem"))
        return _bad(docs, ~source.isin(TEXT_SOURCES), "text_source outside its domain").union(silent).union(lacking)

    return rule


def no_assessment(df: DataFrame) -> list[str]:
    """Columns, nested ones too, that hold a verdict: there must be none."""
    from pyspark.sql import types as T

    def names(t: T.DataType, at: str) -> list[str]:
        if isinstance(t, T.StructType):
            return [x for f in t.fields for x in ([at + f.name] if f.name.lower() == "assessment" else []) + names(f.dataType, at + f.name + ".")]
        if isinstance(t, T.ArrayType):
            return names(t.elementType, at)
        return names(t.valueType, at) if isinstance(t, T.MapType) else []

    return names(df.schema, "")


def orphans(series: DataFrame, docs: DataFrame) -> DataFrame:
    """Documents that series rows name and the corpus lacks."""
    return series.select(F.col("agency_doc").alias("id")).distinct().join(docs.select("id"), "id", "left_anti")


def linked_corpus(corpus: str) -> Rule:
    """A stamped registry slug comes with the name of the corpus that defines it."""

    def rule(docs: DataFrame) -> DataFrame:
        stamped = docs.where(F.coalesce("agency_registry_slug", F.lit("")) != "")
        return _bad(stamped, F.coalesce("agency_registry_corpus", F.lit("")) != corpus, "agency_registry_slug without its corpus")

    return rule


def unassessed(docs: DataFrame) -> DataFrame:
    """No column holds a verdict of our own: a row for each that does, under its name.

    Documents read from files, which have their fields' names, must have no such field either.
    """
    found = no_assessment(docs)
    columns = docs.sparkSession.createDataFrame([(c, "column holds an assessment") for c in found], "id string, problem string")
    if "field_names" not in docs.columns:
        return columns
    return columns.union(_bad(docs, F.coalesce(F.array_contains("field_names", "assessment"), F.lit(False)), "carries an assessment field"))


def registry_link(mapping: DataFrame, corpus: str) -> Rule:
    """A stamped slug is the one that the crosswalk has for the document's key, and names its corpus."""

    def rule(docs: DataFrame) -> DataFrame:
        stamped = docs.where(F.coalesce("agency_registry_slug", F.lit("")) != "")
        known = mapping.groupBy("agency_key").agg(F.max("slug").alias("wanted_slug"))
        met = stamped.select("id", F.coalesce("agency_key", F.lit("")).alias("agency_key"), "agency_registry_slug").join(known, "agency_key", "left")
        return _bad(met, ~F.col("agency_registry_slug").eqNullSafe(F.col("wanted_slug")), "agency_registry_slug is not the crosswalk's").union(linked_corpus(corpus)(docs))

    return rule


def series_documents(series: DataFrame) -> Rule:
    """Every document that a series names is there."""
    return lambda docs: orphans(series, docs).select("id", F.lit("series row without a document").alias("problem"))


def placed_by_type(folders: dict[str, str] | None = None) -> Rule:
    """A document stands in the folder of its ``doc_type``; types without a folder are not known."""
    known = DOC_TYPES if folders is None else folders

    def rule(docs: DataFrame) -> DataFrame:
        folder = F.element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), F.coalesce("doc_type", F.lit(""))) if known else F.lit(None).cast("string")
        inside = F.concat(F.lit("/"), "path")
        wrong = folder.isNotNull() & ~F.contains(inside, F.concat(F.lit("/"), folder, F.lit("/")))
        return _bad(docs, folder.isNull(), "doc_type is not known").union(_bad(docs, F.coalesce(wrong, F.lit(False)), "not in the folder of its doc_type"))

    return rule


def run_rules(docs: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """``(rule, id, problem)`` over all rules."""
    parts = [rule(docs).select(F.lit(name).alias("rule"), "id", "problem") for name, rule in rules.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def summary(found: DataFrame, rules: dict[str, Rule], named: int = NAMED) -> DataFrame:
    """``(rule, violations, passed, first)`` with a row for each rule, violated or not.

    ``first`` holds the first ``named`` problems in the order of ids, as text.  Problems are ranked
    within :data:`PARTS` parts of a rule before those that are left are ranked together, so no
    task orders all problems of one rule.
    """
    spark = found.sparkSession
    rows = spark.createDataFrame([(r,) for r in rules], "rule string")
    counted = found.groupBy("rule").agg(F.count("*").alias("n"))
    shown = found.select("rule", F.concat_ws(": ", "id", "problem").alias("p"), F.pmod(F.xxhash64("id", "problem"), F.lit(PARTS)).alias("part"))
    for by in (["rule", "part"], ["rule"]):
        shown = shown.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy("p"))).where(F.col("k") <= named)
    first = shown.groupBy("rule").agg(F.array_sort(F.collect_list("p")).alias("first"))
    met = rows.join(counted, "rule", "left").join(first, "rule", "left")
    return met.select("rule", F.coalesce("n", F.lit(0)).cast("long").alias("violations"), F.col("n").isNull().alias("passed"), F.coalesce("first", F.array().cast("array<string>")).alias("first"))


def outcome(skipped: bool, violations: int) -> int:
    """The exit code of a check: 2 for one that could not run, which is not a pass."""
    return 2 if skipped else int(violations > 0)


def ocr_scores(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(doc_id, words, dict_ratio, glued, figures, gate_ok)`` of the first text of each pair.

    Words in lower case of two letters or more are looked up in the vocabulary by a join.  A null
    text has no words.
    """
    own = F.coalesce("primary", F.lit(""))
    found = pairs.select("doc_id", F.regexp_extract_all(F.lower(own), F.lit(WORD), 0).alias("ws"), own.alias("primary"))
    known = found.select("doc_id", F.explode("ws").alias("word")).join(vocabulary.select("word").distinct(), "word").groupBy("doc_id").agg(F.count("*").alias("known"))
    counted = found.select(
        "doc_id",
        F.size("ws").cast("long").alias("words"),
        F.size(F.filter(F.split("primary", r"[^\p{L}\p{N}_]+"), lambda w: w.rlike("^[A-Za-z]{18,}$"))).cast("long").alias("glued"),
        F.size(F.regexp_extract_all(F.lower("primary"), F.lit(FIGURE), 0)).cast("long").alias("figures"),
    )
    met = counted.join(known, "doc_id", "left")
    ratio = F.when(F.col("words") > 0, F.coalesce("known", F.lit(0)) / F.col("words")).otherwise(0.0)
    return met.select("doc_id", "words", ratio.alias("dict_ratio"), "glued", "figures", ((F.col("words") >= OCR_WORDS) & (ratio >= OCR_RATIO)).alias("gate_ok"))


def _alike(pattern: str) -> Column:
    """How alike the matches of a pattern are in two readings, 0 if one has none; compared in lower case.

    Equal readings are told apart here; only others go to Python.
    """
    found = lambda c: F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(pattern), 0)

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([matching.ratio(list(x), list(y)) if x is not None and len(x) and len(y) else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")

    a, b = found("primary"), found("cross_check")
    odd = lambda x: F.when(a != b, x)
    return F.when(a == b, (F.size(a) > 0).cast("double")).otherwise(ratio(odd(a), odd(b)))


def agreement(pairs: DataFrame) -> DataFrame:
    """``(doc_id, agreement, agree_ok)``: how far two readings of one page give the same words."""
    return pairs.select("doc_id", _alike(WORD).alias("agreement")).withColumn("agree_ok", F.col("agreement") >= OCR_AGREEMENT)


def figure_agreement(pairs: DataFrame) -> DataFrame:
    """``(doc_id, figures, figure_agreement)``: the same for figures alone; told, not gated."""
    n = F.size(F.regexp_extract_all(F.lower(F.coalesce("primary", F.lit(""))), F.lit(FIGURE), 0)).cast("long")
    return pairs.select("doc_id", n.alias("figures"), _alike(FIGURE).alias("figure_agreement"))


def ocr_note(agreement: Column, figure_agreement: Column, figures: Column, dict_ratio: Column, glued: Column) -> Column:
    """What a text read by OCR says of itself: agreements, dictionary, glued words, and that nobody checked it."""
    # The wording of the note.
    lost = F.when(glued > 0, F.concat(F.lit("; "), glued.cast("string"), F.lit(" heading/letterhead token(s) lost their word spacing in extraction and are left as-is rather than reconstructed"))).otherwise("")
    return F.concat(
        F.lit(f"no text layer in the source PDF; text recovered by OCR. Two independent engines ({' + '.join(ENGINES)}) agree on "), text.percent(agreement),
        F.lit(" of the word sequence and "), text.percent(figure_agreement), F.lit(" of the "), figures.cast("string"), F.lit(" figures, "),
        text.percent(dict_ratio), F.lit(" dictionary-recognizable"), lost, F.lit("; NOT human-verified — treat every number as unchecked against the source"),
    )


def promoted(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(doc_id, decision, note)`` for texts read by OCR: whether each may be used.

    A text is promoted only if a second engine has read the page too (``cross_check`` is not null),
    the text passes the gate of words and dictionary, and the readings agree; otherwise it is
    refused, and why is the decision.  The note of a refused text is null.
    """
    both = pairs.select("doc_id", F.col("cross_check").isNotNull().alias("second")).join(ocr_scores(pairs, vocabulary), "doc_id")
    both = both.join(agreement(pairs), "doc_id").join(figure_agreement(pairs).drop("figures"), "doc_id")
    why = F.when(~F.col("second"), "second engine unavailable").when(~(F.col("gate_ok") & F.col("agree_ok")), "failed the two-engine bar").otherwise("promoted")
    note = ocr_note(F.col("agreement"), F.col("figure_agreement"), F.col("figures"), F.col("dict_ratio"), F.col("glued"))
    return both.select("doc_id", why.alias("decision"), F.when(why == "promoted", note).alias("note"))


def vocabulary(docs: DataFrame, most: int = 400) -> DataFrame:
    """Words of a systematic sample of the documents, about ``most`` of them in the order of ids.

    Documents whose ``text_source`` is OCR are left out before the sample is taken, so that the
    errors of OCR never become words that vouch for it.
    """
    own = docs.where(F.coalesce("text_source", F.lit("")) != "ocr") if "text_source" in docs.columns else docs
    sample = systematic(own.select("doc_id", "text"), max(1, own.count() // most))
    return sample.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0)).alias("word")).distinct()


def systematic(docs: DataFrame, step: int, order: str | list[str] = "doc_id") -> DataFrame:
    """Every ``step``-th row in the order of ids of any kind, or of other columns; nulls come first (see :mod:`ranks`)."""
    return ranks.every(docs, step, [order] if isinstance(order, str) else order)


def freshness(docs: DataFrame, today: str, days: int = REVERIFY_DAYS) -> DataFrame:
    """``(id, last_verified, overdue)``: never verified, or longer ago than ``days``."""
    seen = F.nullif("last_verified", F.lit("")).cast("date")
    return docs.select("id", "last_verified", (seen.isNull() | (F.datediff(F.lit(today).cast("date"), seen) > days)).alias("overdue"))


def provenance(pairs: DataFrame) -> DataFrame:
    """``(doc_id, lines, found, coverage, verdict)``: how many lines of a body its snapshot has in order.

    A greedy walk: each line is looked for from where the last one was found.
    """
    @F.pandas_udf("struct<lines: long, found: long>")
    def walk(body: pd.Series, snapshot: pd.Series) -> pd.DataFrame:
        out = []
        for b, s in zip(body, snapshot, strict=True):
            source = " ".join((s or "").split())
            at = hit = n = 0
            for line in filter(None, (" ".join(x.split()) for x in (b or "").split("\n"))):
                n += 1
                k = source.find(line, at)
                if k >= 0:
                    hit, at = hit + 1, k + len(line)
            out.append((n, hit))
        return pd.DataFrame(out, columns=["lines", "found"])

    met = pairs.select("doc_id", walk("body", "snapshot").alias("w")).select("doc_id", "w.lines", "w.found")
    share = F.when(F.col("lines") > 0, F.col("found") / F.col("lines")).otherwise(1.0)
    return met.withColumn("coverage", share).withColumn("verdict", F.when(share < COVERAGE_FAIL, "fail").when(share < COVERAGE_WARN, "warn").otherwise("ok"))


def odd_ids(docs: DataFrame) -> DataFrame:
    """Documents whose id is not lower-case letters, digits and hyphens, or not their file's name."""
    stem = F.regexp_extract("path", r"([^/]*)\.md$", 1)
    bad = ~F.coalesce("id", F.lit("")).rlike(ID_PATTERN)
    return _bad(docs, bad, "id outside its pattern").union(_bad(docs, ~bad & (stem != F.col("id")), "id is not the file's name"))
