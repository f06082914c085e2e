"""From report text to a tidy series of values.

A report is cut into blocks, one for each measure; a block has a title, perhaps a collection
period, a run of years, and runs of actual and target values.  Every step is a window over the
lines of one document, so one exchange by document serves all of them.  Runs that do not have one
value for each year are placed by the geometry of a layout sidecar or refused: a gap is known, a
value under the wrong year is false.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays, text
from ..sources import frontmatter
from ..sources.storage import bucketed, buckets, discarded, spread, stored

FAR = 2_147_483_647
#: Lines after its own that a collection period may take; characters of a label line, below which.
PERIOD_LINES, LABEL_CHARS = 3, 120


def lines_of(docs: DataFrame, column: str = "text") -> DataFrame:
    """``(doc_id, pos, line, s)``: the lines of each text, ``s`` without white space at its ends.

    Line ends of other systems count as line feeds.  Rows are dealt out by document here, once, and
    into as many parts as the session names: a small text makes many rows of windows.
    """
    split = F.split(F.regexp_replace(F.col(column), r"\r\n?", "\n"), "\n")
    rows = docs.where(F.col(column).isNotNull()).repartition(buckets(docs.sparkSession), "doc_id").select("doc_id", F.posexplode(split).alias("pos", "line"))
    return rows.withColumn("s", text.strip("line"))


def blocks_of(lines: DataFrame) -> DataFrame:
    """Lines with their block (from 1) and place in it (from 0); those before the first heading go."""
    running = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("block", F.sum(F.col("line").rlike(text.KPM_HEAD).cast("int")).over(running)).where("block > 0")
    return numbered.withColumn("i", F.row_number().over(Window.partitionBy("doc_id", "block").orderBy("pos")) - 1)


def _first(block: Window, where: Column) -> Column:
    return F.coalesce(F.min(F.when(where, F.col("i"))).over(block), F.lit(FAR))


def headers_of(blocks: DataFrame) -> DataFrame:
    """Block lines with where the parts of their block begin.

    ``head_end``: the first series head or collection period; ``period_end``: past the period and
    up to three wrapped lines; ``year_at``: the series head from there; ``run_from``: past the years.
    """
    block = Window.partitionBy("doc_id", "block")
    after = F.col("i") > 0
    series, period, year = text.is_series_head("s"), F.col("line").rlike(text.PERIOD), F.col("s").rlike(f"^{text.YEAR}$")
    out = blocks.withColumns({"is_series": series, "is_period": period, "is_year": year})
    out = out.withColumn("head_end", _first(block, after & (F.col("is_series") | F.col("is_period"))))
    out = out.withColumn("has_period", F.max((F.col("is_period") & (F.col("i") == F.col("head_end"))).cast("int")).over(block) == 1)
    ends = (F.col("i") > F.col("head_end")) & (F.col("is_series") | F.col("is_year") | (F.col("s") == ""))
    length = F.max("i").over(block) + 1
    stop = F.least(_first(block, ends), F.col("head_end") + PERIOD_LINES + 1, length)
    out = out.withColumn("period_end", F.when(F.col("has_period"), stop).otherwise(F.col("head_end")))
    out = out.withColumn("year_at", _first(block, (F.col("i") >= F.col("period_end")) & F.col("is_series") & after))
    inline = F.max(F.when(F.col("i") == F.col("year_at"), F.size(F.regexp_extract_all("line", F.lit(text.YEAR), 0)))).over(block)
    out = out.withColumn("inline_years", F.coalesce(inline, F.lit(0)))
    listed = _first(block, (F.col("i") > F.col("year_at")) & ~F.col("is_year"))
    after_list = F.when(F.col("inline_years") > 0, F.col("year_at") + 1).otherwise(F.least(listed, length))
    return out.withColumn("run_from", F.when(F.col("year_at") == FAR, FAR).otherwise(after_list))


def _joined(at: Column, value: Column) -> Column:
    """Values of a group in the order of their lines, joined by blanks."""
    pairs = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(at.alias("i"), value.alias("v")))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), " ")


def measures_of(headed: DataFrame) -> DataFrame:
    """``(doc_id, block, kpm_number, measure, data_collection_period, years)`` of each block."""
    i, s = F.col("i"), F.col("s")
    heading = r"^KPM ?# ?([0-9]+)[ \t]*(.*)"
    title = F.when(i == 0, F.nullif(F.regexp_extract(s, heading, 2), F.lit(""))).when((i < F.col("head_end")) & (s != "") & ~s.rlike(text.STOP), s)
    labels = F.lower(s).isin("actual", "target")
    period = F.when(F.col("has_period") & (i == F.col("head_end")), text.strip(F.regexp_extract("line", text.PERIOD, 1)))
    period = period.when(F.col("has_period") & (i > F.col("head_end")) & (i < F.col("period_end")) & ~labels, s)
    years = F.when((i == F.col("year_at")) & (F.col("inline_years") > 0), F.regexp_extract_all("line", F.lit(text.YEAR), 0))
    years = years.when((F.col("inline_years") == 0) & (i > F.col("year_at")) & (i < F.col("run_from")), F.array("s"))
    listed = F.array_sort(F.collect_list(F.when(years.isNotNull(), F.struct(i.alias("i"), years.alias("v")))))
    return headed.groupBy("doc_id", "block").agg(
        F.max(F.when(i == 0, F.regexp_extract(s, heading, 1))).alias("kpm_number"),
        text.strip(text.loose(_joined(i, title))).alias("measure"),
        F.nullif(F.btrim(text.loose(_joined(i, period)), F.lit(" -")), F.lit("")).alias("data_collection_period"),
        F.flatten(F.transform(listed, lambda p: p["v"])).alias("years"),
    )


def runs_of(headed: DataFrame) -> DataFrame:
    """``(doc_id, block, run, submeasure, actual, target)``: value runs of each block, from run 1.

    A line that begins with actual or target opens a run of values: those on the line, then bare
    value lines below it until there is one for each year.  An actual takes the last label line
    since the actual before it, and the target that follows it directly; a target alone is a run too.
    """
    i, s = F.col("i"), F.col("s")
    block = Window.partitionBy("doc_id", "block")
    years = F.when(F.col("inline_years") > 0, F.col("inline_years")).otherwise(F.col("run_from") - F.col("year_at") - 1)
    rows = headed.where(i >= F.col("run_from")).select("doc_id", "block", "i", "s", years.alias("n")).where("n > 0")
    rows = rows.withColumn("stop_at", _first(block, s.rlike(text.STOP) | s.startswith("KPM #"))).where("i < stop_at")
    word = text.first_word(F.regexp_replace(F.lower(s), ":+$", ""))
    rows = rows.withColumns({"kind": F.when(word.isin("actual", "target"), word), "is_value": text.is_value(s)})
    run = block.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("run", F.count("kind").over(run))
    # a label belongs to the next actual: actuals strictly before a line tell which that is
    rows = rows.withColumn("actuals", F.count(F.when(F.col("kind") == "actual", 1)).over(block.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)))
    is_label = F.col("kind").isNull() & (s != "") & ~F.col("is_value") & (F.length(s) < LABEL_CHARS) & (F.lower(s) != "metric value")
    rows = rows.withColumn("label", F.max_by(F.when(is_label, s), F.when(is_label, i)).over(Window.partitionBy("doc_id", "block", "actuals")))
    inside = Window.partitionBy("doc_id", "block", "run").orderBy("i")
    first = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inline = F.when(F.col("kind").isNotNull(), text.value_tokens(F.substring(s, F.length("kind") + 1, F.length(s))))
    rows = rows.where("run > 0").withColumn("inline", inline)
    rows = rows.withColumns({
        "opens": F.max("kind").over(first),
        "given": F.max(F.size("inline")).over(first),
        "broken": F.sum((~F.col("is_value") & F.col("kind").isNull()).cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        "k": F.row_number().over(inside) - 1,
    })
    taken = F.when(F.col("kind").isNotNull(), F.col("inline")).when((F.col("broken") == 0) & (F.col("k") <= F.col("n") - F.col("given")), F.array(s))
    pairs = F.array_sort(F.collect_list(F.when(taken.isNotNull(), F.struct(i.alias("i"), taken.alias("v")))))
    values = rows.groupBy("doc_id", "block", "run").agg(
        F.max("opens").alias("kind"),
        F.flatten(F.transform(pairs, lambda p: p["v"])).alias("values"),
        F.max(F.when(F.col("kind") == "actual", F.col("label"))).alias("label"),
    )
    order = Window.partitionBy("doc_id", "block").orderBy("run")
    beside = values.withColumns({"before": F.lag("kind").over(order), "after": F.lead("kind").over(order), "next": F.lead("values").over(order)})
    empty = F.array().cast("array<string>")
    is_actual, closed = F.col("kind") == "actual", F.col("after") == "target"
    runs = beside.where(is_actual | F.col("before").isNull() | (F.col("before") == "target"))
    runs = runs.select(
        "doc_id", "block", "run",
        F.when(is_actual, F.col("label")).alias("submeasure"),
        F.when(is_actual, F.col("values")).otherwise(empty).alias("actual"),
        F.when(~is_actual, F.col("values")).when(closed, F.col("next")).otherwise(empty).alias("target"),
        F.col("after").isNull().alias("last"), is_actual.alias("is_actual"),
    )
    runs = runs.where(~F.col("last") | ~F.col("is_actual") | (F.size("actual") > 0))
    whole = Window.partitionBy("doc_id", "block")
    runs = runs.withColumns({"run": F.row_number().over(order).cast("int"), "siblings": F.count("*").over(whole)})
    named = F.when((F.col("siblings") > 1) & (F.coalesce("submeasure", F.lit("")) == ""), F.concat(F.lit("unlabelled run "), F.col("run").cast("string"))).otherwise(F.col("submeasure"))
    return runs.select("doc_id", "block", "run", named.alias("submeasure"), "actual", "target")


def layout_runs(docs: DataFrame, column: str = "layout") -> DataFrame:
    """``(doc_id, kpm, ordinal, label, a, t)``: value rows of a layout sidecar, placed by column.

    A heading starts a measure and a series head sets its year columns.  ``Actual`` (capital) opens
    a row; ``Target`` belongs to the actual above it unless a label, a series head or a lower-case
    ``target`` came between.  Null arrays were refused, null elements are blank cells.
    """
    lines = lines_of(docs, column).withColumnRenamed("line", "raw")
    running = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("head", F.col("s").rlike(text.LAYOUT_HEAD))
    rows = rows.withColumn("part", F.sum(F.col("head").cast("int")).over(running)).where("part > 0")
    part = Window.partitionBy("doc_id", "part")
    rows = rows.withColumn("kpm", F.max(F.when(F.col("head"), F.regexp_extract("s", text.LAYOUT_HEAD, 1))).over(part))
    series = ~F.col("head") & text.is_layout_series_head("s")
    word = F.regexp_replace(text.first_word("s"), ":+$", "")
    kind = F.when(F.col("head"), "head").when(series, "series").when(word.isin("Actual", "Target"), word).when(F.lower(word) == "target", "off")
    rows = rows.withColumn("kind", kind)
    upto = part.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    before = part.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "columns_at": F.last(F.when(F.col("kind") == "series", F.col("raw")), ignorenulls=True).over(upto),
        "reset": F.count("kind").over(before),
        "prior": F.last(F.col("kind"), ignorenulls=True).over(before),
    })
    is_label = F.col("kind").isNull() & (F.col("s") != "") & ~text.is_value("s") & (F.length("s") < LABEL_CHARS)
    label = F.max_by(F.when(is_label, F.col("s")), F.when(is_label, F.col("pos"))).over(Window.partitionBy("doc_id", "part", "reset"))
    rows = rows.withColumn("label", label).where(F.col("kind").isin("Actual", "Target"))
    start = F.length("raw") - F.length(F.regexp_replace("raw", rf"\A{text.WHITE}+", "")) + F.length("kind")
    rows = rows.withColumn("placed", arrays.align_under(F.col("raw"), start, F.col("columns_at")))
    order = part.orderBy("pos")
    rows = rows.withColumns({"t_kind": F.lead("kind").over(order), "t_prior": F.lead("prior").over(order), "t_placed": F.lead("placed").over(order)})
    bound = (F.col("t_kind") == "Target") & (F.col("t_prior") == "Actual")
    actual = rows.where("kind = 'Actual'").withColumn("t", F.when(bound, F.col("t_placed")))
    ordinal = F.row_number().over(Window.partitionBy("doc_id", "kpm").orderBy("pos")) - 1
    return actual.select("doc_id", "kpm", ordinal.alias("ordinal"), "label", F.col("placed").alias("a"), "t")


@dataclass
class Series:
    """What a set of reports yields."""

    rows: DataFrame
    problems: DataFrame


def _agree(a: Column, b: Column) -> Column:
    bare = lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]", "")
    return (F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "") | (bare(a) == bare(b))


def gated(runs: DataFrame, measures: DataFrame, layout: DataFrame | None) -> DataFrame:
    """Runs with years, the layout row that answers to each, and whether they are accepted.

    The layout row is the one with the run's own label, if that is unique, else the one with its
    ordinal among all runs of its number in the document.  A short run is accepted if the layout
    row has as many values as it, or it has none and the layout some, or it is a subsequence of the
    layout's values in exactly one way and the labels agree.  A target of another length than the
    years is accepted on equal values or a single embedding, else it is dropped whole.
    """
    out = runs.join(spread(measures), ["doc_id", "block"])
    out = out.withColumn("ordinal", F.row_number().over(Window.partitionBy("doc_id", "kpm_number").orderBy("block", "run")) - 1)
    none = F.lit(None).cast("array<string>")
    if layout is None:
        out = out.withColumns({"l_label": F.lit(None).cast("string"), "a": none, "t": none})
    else:
        short = (F.size("actual") != F.size("years")) | (F.size("target") != F.size("years"))
        keyed = layout.withColumn("key", text.measure_key("label"))
        once = keyed.where("label <> ''").groupBy("doc_id", "kpm", "key").agg(F.count("*").alias("c"), F.first(F.struct("label", "a", "t")).alias("by_label")).where("c = 1")
        own = F.col("submeasure").isNotNull() & ~F.col("submeasure").startswith("unlabelled run ") & (F.col("submeasure") != "")
        out = out.withColumn("want", F.when(short & own, text.measure_key("submeasure")))
        a, b = once.withColumnsRenamed({"doc_id": "d1", "kpm": "k1"}), layout.select(F.col("doc_id").alias("d2"), F.col("kpm").alias("k2"), F.col("ordinal").alias("o2"), F.struct("label", "a", "t").alias("by_order"))
        out = out.join(spread(a), (F.col("doc_id") == F.col("d1")) & (F.col("kpm_number") == F.col("k1")) & (F.col("want") == F.col("key")), "left")
        out = out.join(spread(b), (F.col("doc_id") == F.col("d2")) & (F.col("kpm_number") == F.col("k2")) & (F.col("ordinal") == F.col("o2")), "left")
        pick = F.coalesce("by_label", "by_order")
        out = out.withColumns({"l_label": pick["label"], "a": pick["a"], "t": pick["t"]})
    n = F.size("years")
    some = arrays.compact(F.coalesce("a", F.array().cast("array<string>")))
    given = F.size("actual")
    fits = F.col("a").isNotNull() & (F.size("a") == n)
    once_only = (given > 0) & (F.size(some) > given) & (arrays.embeddings(F.col("actual"), some) == 1) & _agree(F.col("l_label"), F.col("submeasure"))
    recovered = fits & ((F.size(some) == given) | ((given == 0) & (F.size(some) > 0)) | once_only)
    whole = given == n
    out = out.withColumns({"whole": whole, "accepted": whole | F.coalesce(recovered, F.lit(False)), "had": given})
    seen = arrays.compact(F.coalesce("t", F.array().cast("array<string>")))
    wants = F.size("target")
    fits_t = F.col("t").isNotNull() & (F.size("t") == n)
    ok_t = fits_t & ((seen == F.col("target")) | ((wants == 0) & (F.size(seen) > 0)) | ((wants > 0) & (F.size(seen) > wants) & (arrays.embeddings(F.col("target"), seen) == 1)))
    empty = F.array().cast("array<string>")
    target = F.when(wants == n, F.col("target")).when(F.coalesce(ok_t, F.lit(False)), F.col("t")).otherwise(empty)
    return out.withColumns({"actual": F.when(whole, F.col("actual")).otherwise(F.col("a")), "target": target})


def extract(docs: DataFrame, geometry: bool = True) -> Series:
    """Series rows and problems of ``docs(doc_id, agency, reporting_year, measure_status, source_url, text, layout)``.

    A blank cell gives no row; a written non-value such as ``No Data`` does.  Every block or run
    that is refused, and every document without text or blocks, is one row of ``problems``.  Lines
    with the parts of their block, measures and gated runs are each worked out once and written to
    the shared folder; rows and problems read the latter two.  Lines are kept in buckets by document:
    measures and runs are windows over them without another exchange.
    """
    headed = bucketed(headers_of(blocks_of(lines_of(docs))), "headed", buckets(docs.sparkSession), "doc_id")
    measures = stored(measures_of(headed), "measures")
    runs = runs_of(headed)
    layout = layout_runs(docs.where(F.col("layout").isNotNull())) if geometry and "layout" in docs.columns else None
    checked = stored(gated(runs, measures, layout), "runs")
    discarded(headed)
    cells = F.arrays_zip(F.col("years").alias("year"), F.col("actual").alias("actual"), F.col("target").alias("target"))
    values = checked.where("accepted").select("doc_id", "block", "run", "kpm_number", "measure", "submeasure", "data_collection_period", F.posexplode(cells).alias("year_index", "c"))
    values = values.where(F.col("c.actual").isNotNull())
    facts = docs.select("doc_id", "agency", "reporting_year", "measure_status", "source_url")
    rows = values.join(spread(facts), "doc_id").select(
        "agency", F.col("doc_id").alias("agency_doc"), "reporting_year", "measure_status", "kpm_number",
        F.substring(text.measure_key("measure"), 1, text.KEY_CHARS).alias("measure_key"),
        F.substring("measure", 1, text.TEXT_CHARS).alias("measure_text"),
        "submeasure", F.col("c.year").alias("year"), F.col("c.actual").alias("actual"), F.col("c.target").alias("target"),
        "data_collection_period", F.col("source_url").alias("source_report"), "block", "run", "year_index",
    )
    label = F.when(F.coalesce("submeasure", F.lit("")) == "", "").otherwise(F.concat(F.lit("/"), F.col("submeasure")))
    refused = checked.where("not accepted").select("doc_id", F.concat(F.lit("KPM #"), F.col("kpm_number"), label, F.lit(": "), F.col("had").cast("string"), F.lit(" actual(s) vs "), F.size("years").cast("string"), F.lit(" year(s)")).alias("problem"))
    yearless = measures.where(F.size("years") == 0).select("doc_id", F.concat(F.lit("KPM block "), F.col("block").cast("string"), F.lit(": no Report Year run")).alias("problem"))
    blockless = docs.where(F.col("text").isNotNull()).join(measures.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", F.lit("no 'KPM #n' blocks").alias("problem"))
    textless = docs.where(F.col("text").isNull()).select("doc_id", F.lit("no snapshot text").alias("problem"))
    return Series(rows, refused.union(yearless).union(blockless).union(textless))


def of_files(files: DataFrame) -> dict[str, DataFrame]:
    """``rows`` and ``problems`` of reports in files ``(doc_id, path, content)``, for ``ledger.refresh``.

    ``<id>.md`` has the fields and the text, unless ``<id>.txt`` has the text; ``<id>.layout.txt`` is
    the layout.  Of several files of one name the last path counts.  Without ``<id>.md`` there is no
    report.
    """
    layout, md = F.col("path").endswith(".layout.txt"), F.col("path").endswith(".md")
    last = lambda where: F.max_by(F.when(where, F.col("content")), F.when(where, F.col("path")))
    plain = F.col("path").endswith(".txt") & ~layout
    each = files.groupBy("doc_id").agg(last(md).alias("md"), last(plain).alias("plain"), last(layout).alias("layout"))
    read = frontmatter.read(each.where("md is not null").withColumn("path", F.col("doc_id")))
    facts = frontmatter.as_documents(read).select("path", "agency", "reporting_year", "measure_status", "source_url", "text")
    docs = facts.withColumnRenamed("path", "doc_id").join(each.select("doc_id", "plain", "layout"), "doc_id")
    docs = stored(docs.withColumn("text", F.coalesce("plain", F.nullif("text", F.lit("")))).drop("plain"), "reports")
    found = extract(docs)
    return {"rows": found.rows.withColumn("doc_id", F.col("agency_doc")), "problems": found.problems}


IDENTITY = ["agency", "measure_key", "submeasure", "year"]


def disagreements(rows: DataFrame, identity: list[str] | None = None) -> DataFrame:
    """Groups of one identity with more than one actual value: none is preferred.

    ``documents`` over 1 makes a restatement; a document that disagrees with itself is a parsing
    conflict.  Values are compared as written.  Groups are as large as the reports that repeat one
    year, and counts are combined before the shuffle.
    """
    keys = identity or IDENTITY
    grouped = rows.groupBy(*keys).agg(
        F.count_distinct("actual").alias("values"),
        F.count_distinct("agency_doc").alias("documents"),
        F.array_sort(F.collect_set(F.struct("agency_doc", "reporting_year", "actual"))).alias("reported"),
    )
    return grouped.where("values > 1")


def restatements(rows: DataFrame) -> DataFrame:
    return disagreements(rows).where("documents > 1").select(*IDENTITY, "reported")


def conflicts(rows: DataFrame) -> DataFrame:
    return disagreements(rows).where("documents = 1").select(*IDENTITY, "reported")


def lookup(rows: DataFrame) -> DataFrame:
    """``(measure_key, text)``: the text of the first row of each key, in document order."""
    at = F.struct("agency_doc", "block", "run", "year_index")
    return rows.where("measure_text <> ''").groupBy("measure_key").agg(F.min_by("measure_text", at).alias("text"))


def counts(series: Series) -> DataFrame:
    """The coverage counters of a series, as one row."""
    r = series.rows
    blank = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) == "")
    row = r.agg(
        F.count("*").alias("rows"),
        F.count_distinct("agency_doc").alias("documents_with_rows"),
        F.count_distinct(F.nullif("agency", F.lit(""))).alias("agencies"),
        F.count_distinct(F.struct("agency", "measure_key")).alias("measures"),
        blank("target").alias("rows_without_target"),
        blank("data_collection_period").alias("rows_without_collection_period"),
    )
    found = disagreements(r).agg(F.count_if(F.col("documents") > 1).alias("restatements"), F.count_if(F.col("documents") == 1).alias("intra_document_conflicts"))
    # three tables of one row each
    return row.join(series.problems.agg(F.count("*").alias("unparsed_blocks"))).join(found)
