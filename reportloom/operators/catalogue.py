"""From feeds to a manifest of sources: links, probes, names, ranks and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


#: Buckets of a level of fingerprints, and levels of buckets that rows are told apart by before they are compared.
SPLIT, LEVELS = 1024, 2


def feed_links(feeds: DataFrame, column: str = "xml", wanted: str = "/lfo/appr/") -> DataFrame:
    """Distinct normalised links of feed items whose address holds ``wanted`` in any case."""
    links = feeds.select(F.explode(F.regexp_extract_all(column, F.lit(r"<link>([^<]*)</link>"), F.lit(1))).alias("url"))
    return links.where(F.contains(F.lower("url"), F.lit(wanted))).select(text.normalise_url("url").alias("url")).distinct()


def probe_state(code: Column, content_type: Column, range_code: Column, range_type: Column, range_head: Column) -> Column:
    """What a HEAD probe and the range probe after it say of a source.

    A PDF is verified at once.  Another type, and servers that refuse HEAD (405, 501), are asked for
    the first bytes instead (``range_head``), and a PDF's magic there outweighs any declared type;
    without it, a declared PDF counts only with code 200.  A network error (0) and other codes are
    final.
    """
    pdf = lambda c: F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit("pdf"))
    again = ((code == 200) & ~pdf(content_type)) | code.isin(405, 501)
    answered = F.coalesce(range_code, F.lit(0)).isin(200, 206)
    magic = answered & F.coalesce(range_head, F.lit("")).startswith("%PDF")
    good = magic | ((F.coalesce(range_code, F.lit(0)) == 200) & pdf(range_type))
    return F.when((code == 200) & pdf(content_type), "verified").when(again & good, "verified by range").when(code == 0, "network error").otherwise("unreachable")


def split_verified(probes: DataFrame, state: str = "state") -> tuple[DataFrame, DataFrame]:
    """Probed sources that may be ingested, and those that are listed as unreachable."""
    good = F.coalesce(state, F.lit("")).startswith("verified")
    return probes.where(good), probes.where(~good)


def fallback(primary: Column, other: Column, least: int = 500) -> Column:
    """The other extraction where the first is short and it is longer."""
    return F.when((F.length(primary) < least) & (F.length(other) > F.length(primary)), other).otherwise(primary)


def last_wins(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """Left join on a key of which the last row counts."""
    columns = [c for c in right.columns if c not in (key,)]
    one = right.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("r"))
    return left.join(one, key, "left").select(*left.columns, *[F.col(f"r.{c}").alias(c) for c in columns if c != order])


def year_filter(sources: DataFrame, years: list[str]) -> DataFrame:
    """Sources of some years, and those whose year is not known yet."""
    return sources.where(F.col("reporting_year").isin(years) | F.col("reporting_year").isNull())


def with_provenance(listed: Column, parsed: Column, source: Column) -> tuple[Column, Column]:
    """A field and where it came from, in lock-step; an empty string is no value."""
    has = F.coalesce(listed, F.lit("")) != ""
    return F.when(has, listed).otherwise(parsed), F.when(has, F.lit("socrata")).otherwise(source)


def as_text(x: Column) -> Column:
    """A null as the text that sorts and counts show for it."""
    return F.coalesce(x.cast("string"), F.lit("None"))


def count_by_year(sources: DataFrame) -> DataFrame:
    return sources.groupBy(as_text(F.col("reporting_year")).alias("year")).agg(F.count("*").alias("sources"))


def year_gaps(sources: DataFrame, first: int, last: int) -> DataFrame:
    """Attempted years without a source."""
    spine = sources.sparkSession.range(first, last + 1).select(F.col("id").cast("string").alias("year"))
    return spine.join(sources.select(F.col("reporting_year").cast("string").alias("year")), "year", "left_anti")


def outcomes(docs: DataFrame, least: int = 500) -> DataFrame:
    """``(outcome, n)``: documents too short fail, those without a year are skipped, others are read."""
    failed = F.coalesce(F.length("text"), F.lit(0)) < least
    outcome = F.when(failed, "failed").when(F.coalesce(F.col("reporting_year"), F.lit("")) == "", "skipped").otherwise("ok")
    return docs.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def page_furniture(pages: DataFrame, edge: int = 3, least: int = 4) -> DataFrame:
    """``(doc_id, line)``: lines that stand in the first or last ``edge`` lines of over half the pages.

    Blank lines count for the edges and are then left out; occurrences count, not pages.
    """
    lines = pages.select("doc_id", "page_no", F.posexplode(F.split("text", "\n")).alias("i", "line"), F.size(F.split("text", "\n")).alias("n"))
    sizes = pages.groupBy("doc_id").agg(F.count("*").alias("pages")).where(F.col("pages") >= least)
    stripped = lines.withColumn("line", text.strip("line"))
    head = stripped.where(F.col("i") < edge).withColumn("part", F.lit("head"))
    foot = stripped.where(F.col("i") >= F.col("n") - edge).withColumn("part", F.lit("foot"))
    counted = head.union(foot).where("line <> ''").groupBy("doc_id", "part", "line").agg(F.count("*").alias("c"))
    return counted.join(sizes, "doc_id").where(F.col("c") > F.col("pages") / 2).select("doc_id", "line").distinct()


def without_furniture(pages: DataFrame, edge: int = 3, least: int = 4) -> DataFrame:
    """Every page without its document's furniture lines, wherever they stand, and how many were ``removed``.

    A document's furniture is one list (its lines are few), so pages meet it whole and keep the
    order of their lines.
    """
    lists = page_furniture(pages, edge, least).groupBy("doc_id").agg(F.collect_list("line").alias("found"))
    met = pages.join(lists, "doc_id", "left").withColumn("lines", F.split("text", "\n"))
    left = F.when(F.col("found").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("found"), text.strip(x))))
    kept = met.withColumn("left", left)
    return kept.select("doc_id", "page_no", F.array_join("left", "\n").alias("text"), (F.size("lines") - F.size("left")).cast("long").alias("removed"))


def conversion_notes(ocr_note: Column, missing: Column, listed_year: Column, stated_year: Column, agency_source: Column) -> Column:
    """Notes in a fixed order, joined by semicolons; OCR comes first.

    ``ocr_note`` is null for texts that were not read by OCR (see ``quality.ocr_note``).  A listed
    year that differs from the one a document states is named, as is an agency's source other than
    the document's own cover.
    """
    # The wording of notes.
    anchors = F.when(F.size(missing) > 0, F.concat(F.lit("missing expected anchors: "), F.array_join(missing, ", ")))
    differs = F.when(listed_year != stated_year, F.concat(F.lit("filename implied reporting year "), listed_year, F.lit("; the document states "), stated_year, F.lit(" and the document wins")))
    taken = F.when(agency_source != "document", F.concat(F.lit("agency name taken from "), agency_source, F.lit(", not the document's own cover page")))
    return F.concat_ws("; ", ocr_note, anchors, differs, taken)


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(side, ...)`` rows that only one of two tables has, counted with repeats: none means not stale.

    Tables are compared by fingerprints first: for each bucket of row hashes the number of rows and
    two sums of hashes, which no order of rows changes and repeats count in.  Buckets that differ
    are split into finer ones, and only rows of the fine buckets that differ are compared as rows.
    Equal tables shuffle a few thousand sums and no row.
    """
    for level in range(LEVELS):
        odd = _odd_buckets(old, new, level)
        if not odd:
            old, new = old.limit(0), new.limit(0)
            break
        old, new = old.where(_bucket_of(old, level).isin(odd)), new.where(_bucket_of(new, level).isin(odd))
    return old.exceptAll(new).select(F.lit("old").alias("side"), "*").union(new.exceptAll(old).select(F.lit("new").alias("side"), "*"))


def _row_hash(df: DataFrame, seed: int) -> Column:
    """A hash of a whole row.  Which columns are null is hashed too, as nulls leave a hash unchanged."""
    kinds = dict(df.dtypes)
    plain = lambda c: F.to_json(F.struct(F.col(c))) if "map<" in kinds[c] else F.col(c)
    return F.xxhash64(F.lit(seed), F.array(*[F.col(c).isNull() for c in df.columns]), *[plain(c) for c in df.columns])


def _bucket_of(df: DataFrame, level: int) -> Column:
    return F.pmod(_row_hash(df, 10 + level), F.lit(SPLIT)).cast("int")


def _odd_buckets(old: DataFrame, new: DataFrame, level: int) -> list[int]:
    """Buckets of a level in which two tables differ; at most :data:`SPLIT` numbers."""
    wide = lambda seed, df: F.sum(_row_hash(df, seed).cast("decimal(38,0)"))
    sums = [df.groupBy(_bucket_of(df, level).alias("b")).agg(F.count("*").alias("n"), wide(1, df).alias("x"), wide(2, df).alias("y")) for df in (old, new)]
    signed = sums[0].select("b", "n", "x", "y").union(sums[1].select("b", -F.col("n"), -F.col("x"), -F.col("y")))
    left = signed.groupBy("b").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y")]).where("n <> 0 or x <> 0 or y <> 0")
    return [r["b"] for r in left.collect()]


def taken(pages: DataFrame, size: int, recorded: str | None = None) -> DataFrame:
    """Of pages ``(query, start, ok, items)`` those that a sweep would have read.

    A query's pages start at row 1, 1 + ``size`` and so on.  A sweep reads them in order and stops
    at the first that failed or was never recorded, and after the first that holds less than
    ``size`` items.  Of a page that was recorded several times the last by ``recorded`` counts.
    """
    if recorded is not None:
        last = [F.max_by(c, recorded).alias(c) for c in pages.columns if c not in ("query", "start", recorded)]
        pages = pages.groupBy("query", "start").agg(*last, F.max(recorded).alias(recorded))
    order = Window.partitionBy("query").orderBy("start")
    stops = ~F.coalesce("ok", F.lit(False)) | (F.coalesce(F.size("items"), F.lit(0)) < size)
    ended = F.coalesce(F.max(stops).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    in_turn = F.col("start") == 1 + size * (F.row_number().over(order) - 1)
    return pages.withColumns({"in_turn_": in_turn, "ended_": ended}).where("in_turn_ and ok and not ended_").drop("in_turn_", "ended_")


def facts(sources: DataFrame, first: int, last: int, named: int = 1_000, **more: str) -> dict[str, str | list[str] | dict[str, str]]:
    """What a manifest's header says: coverage by year, years without a source, and up to ``named`` names that did not parse.

    Years are few; names beyond ``named`` are counted in a last line, and :func:`unparsed` has them all.
    """
    years = {r["year"]: str(r["sources"]) for r in count_by_year(sources).orderBy("year").collect()}
    gaps = [f"{r['year']}: no report found" for r in year_gaps(sources, first, last).orderBy("year").collect()]
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    odd = sources.where(blank("agency_code") | blank("reporting_year")).select("id")
    names, n = [r["id"] for r in odd.orderBy("id").limit(named).collect()], odd.count()
    rest = [f"and {n - len(names)} more"] if n > len(names) else []
    return {**more, "by_year": years, "years_attempted": [str(y) for y in range(first, last + 1)], "gaps": gaps or ["none"], "unparsed_filenames": names + rest}
