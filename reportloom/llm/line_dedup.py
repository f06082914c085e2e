"""Lines that a site repeats over its pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, quoted, stored, text_or_empty

#: Boilerplate lines of all hosts that are broadcast: so many at most (16 bytes each and the hosts).
BROADCAST_LINES = 200_000
SALTS = 16


def line_key(line: Column) -> Column:
    """What of a line is compared: all but blanks, tabs and returns at its ends."""
    return F.btrim(line, F.lit(" \t\r"))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.05, least: int = 2, distinct: bool = False) -> DataFrame:
    """Lines that more than ``ratio`` of a host's pages hold: ``(host, line, pages, total)``.

    ``line`` is a 64-bit hash of the line's key.  A page counts once for a line however often it
    repeats it.  A line must stand on ``least`` pages: one that stands on a single page repeats
    nothing, whatever share of a small host that page is.  With ``distinct``, pages of one host with
    the same text count as one page in both numbers, so that copies of a page do not turn its own
    sentences into boilerplate.  Blank lines are never boilerplate.  Null is a host of its own, and
    pages without a text are pages.
    """
    t = text_or_empty(quoted(text))
    pages = docs.select(F.col(quoted(host)).cast("string").alias("host"), F.xxhash64(t).alias("page"), t.alias("t"))
    keys = F.filter(F.transform(F.split("t", "\n"), line_key), lambda x: x != "")
    lines = pages.select("host", "page", F.explode(F.array_distinct(F.transform(keys, lambda x: F.xxhash64(x)))).alias("line"))
    if distinct:
        pages, lines = pages.groupBy("host", "page").count(), lines.groupBy("host", "line", "page").count()
    totals = pages.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("total"))
    counted = lines.groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= least)
    met = counted.join(totals, F.col("host").eqNullSafe(F.col("of")))
    return met.where(F.col("pages") > F.col("total") * F.lit(float(ratio))).select("host", "line", "pages", "total")


def drop_lines(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.05, least: int = 2, lines: str = "n_lines", dropped: str = "n_dropped", section: str | None = None, distinct: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and counts of lines and dropped lines.

    The lines that stay keep their order and bytes.  Every row stays, if with an empty text.

    With ``section`` named (a language, say), lines that are boilerplate among the host's pages of
    one section go from those pages as well: a French menu is held against the French pages, not
    against those of all languages.

    * Null texts stay null and have no lines (0); an empty text has one line, which stays.
    * Columns that clash with the counts are replaced; repeated rows are all cleaned; an empty
      table gives an empty table.

    See :func:`boilerplate` for ``ratio``, ``least`` and ``distinct``.

    Plan: each page's distinct line hashes are counted with combining before the shuffle; no text is
    shuffled for that.  A host has at most (lines of a page / ratio) such lines on average,
    so the table of them is small: it is written once, measured, and broadcast as one list for each
    host if within :data:`BROADCAST_LINES`.  Beyond that, texts and lists meet in a join over
    :data:`SALTS` salted copies of each host's list, so a host with a third of all pages is spread.
    """
    kept = [c for c in docs.columns if c.lower() not in {lines.lower(), dropped.lower()}]
    known, s, at = free_name(docs, "known__"), free_name(docs, "salt__"), free_name(docs, "section__")
    met = docs.select(*[F.col(quoted(c)) for c in kept])
    parts = {known: F.col(quoted(host)).cast("string")}
    if section is not None:
        parts[known + at] = F.to_json(F.struct(F.col(quoted(host)).cast("string").alias("h"), F.col(quoted(section)).cast("string").alias("s")))
    for name, part in parts.items():
        keyed = docs.select(part.alias("host"), F.col(quoted(text)).alias("text"))
        found = stored(boilerplate(keyed, "host", "text", ratio, least, distinct).select("host", "line"), "boilerplate")
        of = name + "of"
        lists = found.groupBy(F.col("host").alias(of)).agg(F.collect_list("line").alias(name))
        same = part.eqNullSafe(F.col(of))
        if found.count() <= BROADCAST_LINES:
            met = met.join(F.broadcast(lists), same, "left")
        else:
            spread = lists.withColumn(s + "_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            met = met.withColumn(s, F.pmod(F.xxhash64(quoted(text)), F.lit(SALTS)).cast("int")).join(spread, same & (F.col(s) == F.col(s + "_")), "left").drop(s, s + "_")
        met = met.drop(of)
    if section is not None:
        met = met.withColumn(known, F.coalesce(F.array_union(known, known + at), F.col(known), F.col(known + at)))
    all_lines = F.split(F.col(quoted(text)).cast("string"), "\n")
    is_known = lambda x: F.array_contains(F.col(known), F.xxhash64(line_key(x)))
    left = F.when(F.col(known).isNull(), all_lines).otherwise(F.filter(all_lines, lambda x: ~is_known(x) | (line_key(x) == "")))
    staged = met.withColumn(known + "left", left).withColumn(known + "all", F.greatest(F.size(all_lines), F.lit(0)))
    columns = [F.array_join(F.col(known + "left"), "\n").alias(c) if c.lower() == text.lower() else F.col(quoted(c)) for c in kept]
    return staged.select(
        *columns,
        F.col(known + "all").cast("long").alias(lines),
        (F.col(known + "all") - F.greatest(F.size(known + "left"), F.lit(0))).cast("long").alias(dropped),
    )
