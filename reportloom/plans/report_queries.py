"""Reports rendered from the order tables and read back: the expected rows never pass through text."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import arrays, text
from ..operators import catalogue, series, sinks
from ..sources import files, ledger, storage
from ..sources import reports as source
from .base import query

_CELLS = f"WITH cells AS ({source.CELLS}), e AS ({source.EXPECTED})"
_DOC = "'rpt-' || n || '-' || ry"


def _headed(spark, sf):
    return series.headers_of(series.blocks_of(series.lines_of(source.reports(spark, sf))))


@query(f"{_CELLS} SELECT DISTINCT {_DOC} AS doc_id, CAST(k AS BIGINT) AS block FROM cells")
def segment_blocks(spark, sf):
    return series.blocks_of(series.lines_of(source.reports(spark, sf))).where("i = 0").select("doc_id", "block")


@query(f"{_CELLS} SELECT DISTINCT {_DOC} AS doc_id, CAST(k AS VARCHAR) AS kpm_number, 'Orders of priority ' || k || ' per segment' AS measure FROM cells")
def block_title(spark, sf):
    return series.measures_of(_headed(spark, sf)).select("doc_id", "kpm_number", "measure")


@query(f"{_CELLS} SELECT DISTINCT {_DOC} AS doc_id, CAST(k AS VARCHAR) AS kpm_number, CASE WHEN k <> 4 THEN 'Jul 01 - Jun 30' END AS period FROM cells")
def collection_period(spark, sf):
    return series.measures_of(_headed(spark, sf)).select("doc_id", "kpm_number", F.col("data_collection_period").alias("period"))


@query(f"{_CELLS} SELECT {_DOC} AS doc_id, CAST(k AS VARCHAR) AS kpm_number, string_agg(DISTINCT CAST(yr AS VARCHAR), ',' ORDER BY CAST(yr AS VARCHAR)) AS years FROM cells GROUP BY n, ry, k")
def year_run(spark, sf):
    return series.measures_of(_headed(spark, sf)).select("doc_id", "kpm_number", F.array_join("years", ",").alias("years"))


@query(f"""{_CELLS} SELECT {_DOC} AS doc_id, CAST(k AS BIGINT) AS block, CAST(s AS INT) AS run, any_value(CASE WHEN k <> 5 THEN seg END) AS submeasure,
 string_agg(CASE WHEN NOT blank THEN CASE WHEN c = 0 THEN 'No Data' ELSE CAST(c AS VARCHAR) END END, ',' ORDER BY yr) AS actual, string_agg(CAST(2 * c + 10 AS VARCHAR), ',' ORDER BY yr) AS target FROM cells GROUP BY n, ry, k, s""")
def value_runs(spark, sf):
    headed = _headed(spark, sf)
    return series.runs_of(headed).select("doc_id", "block", "run", "submeasure", F.array_join("actual", ",").alias("actual"), F.array_join("target", ",").alias("target"))


@query(f"{_CELLS} SELECT DISTINCT {_DOC} AS doc_id, CAST(k AS VARCHAR) AS kpm_number, CAST(s - 1 AS INT) AS ordinal, CASE WHEN k <> 5 THEN seg END AS submeasure FROM cells")
def run_ordinal(spark, sf):
    headed = _headed(spark, sf)
    measures = series.measures_of(headed)
    return series.gated(series.runs_of(headed), measures, None).select("doc_id", "kpm_number", "ordinal", "submeasure")


@query(f"""{_CELLS} SELECT {_DOC} AS doc_id, CAST(k AS VARCHAR) AS kpm, CAST(s - 1 AS INT) AS ordinal, any_value(CASE WHEN k <> 5 THEN seg END) AS label,
 string_agg(CASE WHEN blank THEN '_' WHEN c = 0 THEN 'No Data' ELSE CAST(c AS VARCHAR) END, ',' ORDER BY yr) AS a, string_agg(CAST(2 * c + 10 AS VARCHAR), ',' ORDER BY yr) AS t FROM cells WHERE n % 7 <> 0 GROUP BY n, ry, k, s""")
def layout_runs(spark, sf):
    found = series.layout_runs(source.reports(spark, sf).where("layout is not null"))
    return found.select("doc_id", "kpm", "ordinal", "label", F.array_join("a", ",", "_").alias("a"), F.array_join("t", ",", "_").alias("t"))


@query(f"""{_CELLS}, r AS (SELECT n, ry, k, s, sum(CAST(blank AS INT)) AS b FROM cells GROUP BY ALL)
SELECT {_DOC} AS doc_id, CAST(k AS VARCHAR) AS kpm_number, CAST(s - 1 AS INT) AS ordinal, b = 0 AS whole, b = 0 OR n % 7 <> 0 AS accepted FROM r""")
def recover_runs(spark, sf):
    docs = source.reports(spark, sf)
    headed = series.headers_of(series.blocks_of(series.lines_of(docs)))
    measures = series.measures_of(headed)
    checked = series.gated(series.runs_of(headed), measures, series.layout_runs(docs.where("layout is not null")))
    return checked.select("doc_id", "kpm_number", "ordinal", "whole", "accepted")


@query(f"""{_CELLS}, r AS (SELECT n, ry, k, s, bool_or(blank) AS b FROM cells GROUP BY ALL)
SELECT {_DOC} AS doc_id, 'KPM #' || k || '/' || (SELECT seg FROM cells c WHERE c.s = r.s LIMIT 1) || ': ' || (SELECT count(*) FROM cells c WHERE c.n = r.n AND c.ry = r.ry AND c.k = r.k AND c.s = r.s AND NOT blank) || ' actual(s) vs 5 year(s)' AS problem FROM r WHERE b AND n % 7 = 0""")
def length_gate(spark, sf):
    return series.extract(source.reports(spark, sf)).problems


@query(f"{_CELLS} SELECT {_DOC} AS doc_id, CAST(k AS VARCHAR) AS kpm_number, CAST(s - 1 AS INT) AS ordinal, CASE WHEN (n + k + s) % 4 = 0 THEN '' ELSE string_agg(CAST(2 * c + 10 AS VARCHAR), ',' ORDER BY yr) END AS target FROM cells GROUP BY n, ry, k, s")
def target_gate(spark, sf):
    docs = source.reports(spark, sf)
    headed = series.headers_of(series.blocks_of(series.lines_of(docs)))
    measures = series.measures_of(headed)
    # a quarter of the targets lose their last value, and no layout says where it belongs
    k = F.regexp_extract("doc_id", "rpt-([0-9]+)-", 1).cast("int") + F.col("block") + F.col("run")
    runs = series.runs_of(headed).withColumn("target", F.when(k % 4 == 0, F.slice("target", 1, 4)).otherwise(F.col("target")))
    return series.gated(runs, measures, None).select("doc_id", "kpm_number", "ordinal", F.array_join("target", ",").alias("target"))


COLUMNS = ["agency", "agency_doc", "reporting_year", "measure_status", "kpm_number", "measure_key", "submeasure", "year", "actual", "target", "data_collection_period"]


@query(source.EXPECTED)
def kpm_series(spark, sf):
    return series.extract(source.reports(spark, sf)).rows.select(*COLUMNS)


_GROUPS = "SELECT agency, measure_key, submeasure, \"year\", string_agg(DISTINCT agency_doc || ' ' || reporting_year || ' ' || actual, ';' ORDER BY agency_doc || ' ' || reporting_year || ' ' || actual) AS reported FROM e GROUP BY ALL"


def _reported(df):
    shown = F.array_sort(F.transform("reported", lambda r: F.concat_ws(" ", r["agency_doc"], r["reporting_year"], r["actual"])))
    return df.withColumn("reported", F.array_join(shown, ";"))


@query(f"{_CELLS} {_GROUPS} HAVING count(DISTINCT actual) > 1 AND count(DISTINCT agency_doc) > 1")
def restatements(spark, sf):
    return _reported(series.restatements(series.extract(source.reports(spark, sf)).rows))


@query(f"{_CELLS}, x AS (SELECT agency, agency_doc, measure_key, submeasure, \"year\", actual FROM e UNION ALL SELECT agency, agency_doc, measure_key, submeasure, \"year\", '-1' FROM e WHERE \"year\" = '1997' AND measure_key LIKE '%5%') SELECT agency, measure_key, submeasure, \"year\", count(DISTINCT actual) AS \"values\" FROM x GROUP BY ALL HAVING count(DISTINCT actual) > 1 AND count(DISTINCT agency_doc) = 1")
def intra_conflicts(spark, sf):
    rows = series.extract(source.reports(spark, sf)).rows
    again = rows.where("year = '1997' and measure_key like '%5%'").withColumn("actual", F.lit("-1"))
    found = series.conflicts(rows.union(again))
    return found.select(*series.IDENTITY, F.size(F.array_distinct(F.transform("reported", lambda r: r["actual"]))).cast("long").alias("values"))


@query(f"""{_CELLS}, g AS ({_GROUPS} HAVING count(DISTINCT actual) > 1 AND count(DISTINCT agency_doc) > 1), r AS (SELECT n, ry, k, s FROM cells GROUP BY ALL HAVING bool_or(blank) AND n % 7 = 0)
SELECT count(*) AS "rows", count(DISTINCT agency_doc) AS documents_with_rows, count(DISTINCT agency) AS agencies, count(DISTINCT (agency, measure_key)) AS measures, count_if(target IS NULL) AS rows_without_target,
 count_if(data_collection_period IS NULL) AS rows_without_collection_period, (SELECT count(*) FROM r) AS unparsed_blocks, (SELECT count(*) FROM g) AS restatements, CAST(0 AS BIGINT) AS intra_document_conflicts FROM e""")
def series_counts(spark, sf):
    return series.counts(series.extract(source.reports(spark, sf)))


@query(f"{_CELLS} SELECT DISTINCT measure_key, 'Orders' || substr(measure_key, 7) AS text FROM e")
def measures_lookup(spark, sf):
    return series.lookup(series.extract(source.reports(spark, sf)).rows)


@query(f"SELECT DISTINCT agency_doc AS id FROM ({source.EXPECTED}) WHERE CAST(reporting_year AS INT) = 2001 AND measure_status = 'approved'")
def series_orphans(spark, sf):
    from ..operators import quality

    docs = source.reports(spark, sf).where("not (reporting_year = '2001' and measure_status = 'approved')").select(F.col("doc_id").alias("id"))
    return quality.orphans(series.extract(source.reports(spark, sf)).rows, docs)


_ALIGN = """
SELECT c_custkey AS k, 'Actual' || lpad(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '73%' END, 14, ' ') || lpad(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '4.10' END, 12, ' ') || lpad(CASE WHEN c_custkey % 5 = 0 THEN '($14.00)' WHEN c_custkey % 7 = 0 THEN '1  2' ELSE CAST(c_nationkey AS STRING) END, 12, ' ') AS raw,
 'Report Year' || lpad('2019', 9, ' ') || lpad('2020', 12, ' ') || lpad('2021', 12, ' ') AS head FROM customer
"""


@query(f"SELECT k, CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN NULL ELSE CASE WHEN k % 2 = 0 THEN '_' ELSE '73%' END || ',' || CASE WHEN k % 3 = 0 THEN '_' ELSE '4.10' END || ',' || trim(substr(raw, 33)) END AS placed FROM ({_ALIGN.replace('AS STRING', 'AS VARCHAR')})")
def align_columns(spark, sf):
    from .base import portable

    rows = portable(spark, sf, _ALIGN).withColumn("centres", arrays.year_centres("head"))
    placed = arrays.align(F.col("raw"), F.lit(6), F.col("centres"), F.size("centres"))
    return rows.select("k", F.array_join(placed, ",", "_").alias("placed"))


@query(f"SELECT DISTINCT agency_doc AS doc_id, CASE WHEN CAST(substr(agency_doc, 5, length(agency_doc) - 9) AS INT) % 3 = 0 THEN agency_doc || ': no snapshot text' END AS problem FROM ({source.EXPECTED}) WHERE CAST(substr(agency_doc, 5, length(agency_doc) - 9) AS INT) % 3 = 0")
def missing_text_problems(spark, sf):
    docs = source.reports(spark, sf)
    texts = docs.where("n % 3 <> 0").select("doc_id", F.col("text").alias("snapshot"))
    return docs.join(texts, "doc_id", "left").where("snapshot is null").select("doc_id", F.concat("doc_id", F.lit(": no snapshot text")).alias("problem"))


@query(f"SELECT rule, CAST(row_number() OVER (ORDER BY problem) AS INT) AS place, problem FROM (SELECT 'gap' AS rule, problem FROM (SELECT agency_doc || ' ' || measure_key || ' ' || \"year\" AS problem FROM ({source.EXPECTED}) WHERE actual = 'No Data' ORDER BY 1 LIMIT 10))")
def top_n_problems(spark, sf):
    rows = series.extract(source.reports(spark, sf)).rows.where("actual = 'No Data'")
    shown = rows.select(F.concat_ws(" ", "agency_doc", "measure_key", "year").alias("problem")).orderBy("problem").limit(10)
    return shown.select(F.lit("gap").alias("rule"), F.row_number().over(Window.orderBy("problem")).alias("place"), "problem")


@query(source.EXPECTED)
def series_refreshed(spark, sf):
    """Reports in files, some of which change, come and go: the kept series is that of the files as they are."""
    docs = source.reports(spark, sf)
    root, target = storage.new_path(spark, "files"), storage.new_path(spark, "kept")
    stale = F.regexp_replace("text", "No Data", "999")
    before = docs.where("n % 4 <> 1").withColumn("text", F.when(F.col("n") % 3 == 0, stale).otherwise(F.col("text")))
    gone = docs.where("n = 2").withColumn("doc_id", F.concat("doc_id", F.lit("-draft")))
    for state in (before.unionByName(gone), docs):
        files.write_files(_files(state), root)
        ledger.refresh(spark, root, target, series.of_files)
    return ledger.table_of(spark, target, "rows").select(*COLUMNS)


def _files(docs):
    """Reports as ``<id>.md`` and, where there is one, ``<id>.layout.txt``."""
    facts = docs.withColumns({"id": F.col("doc_id"), "title": F.col("doc_id")})
    written = facts.select(F.concat("doc_id", F.lit(".md")).alias("name"), sinks.markdown(facts).alias("content"))
    return written.union(docs.where("layout is not null").select(F.concat("doc_id", F.lit(".layout.txt")), "layout"))
