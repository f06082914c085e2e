"""Text, URL and file name functions over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, text
from ..operators import catalogue, quality
from ..sources.tables import table
from .base import DUCK_KEY, SQL, portable, query

W = text.WHITE
UNESCAPED = "replace(url_encode({0}), '%2F', '/')"


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


_URL = rf"""
WITH l AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '\A{W}+', ''), '{W}+\z', ''), '\Ahttp://', 'https://') AS u FROM pages),
p AS (SELECT page_id, regexp_extract(u, '\A((?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?)([^?#]*)(\?[^#]*)?', 1) AS a,
             regexp_extract(u, '\A((?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?)([^?#]*)(\?[^#]*)?', 2) AS b,
             regexp_extract(u, '\A((?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?)([^?#]*)(\?[^#]*)?', 3) AS c FROM l)
SELECT page_id, a || {UNESCAPED.format("b")} || CASE WHEN c = '?' THEN '' ELSE c END AS url FROM p
"""


@query(_URL)
def url_normalise(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.normalise_url("url").alias("url"))


@query("SELECT p_partkey, coalesce(nullif(trim(regexp_replace(lower(p_name || ' (' || p_brand || ')'), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'untitled') AS slug FROM part")
def slugify(spark, sf):
    return portable(spark, sf, "SELECT p_partkey, p_name || ' (' || p_brand || ').PDF' AS f FROM part").select("p_partkey", text.slug("f").alias("slug"))


_NAMES = "SELECT n_nationkey AS k, 'Board of ' || n_name AS name FROM nation UNION ALL SELECT n_nationkey, n_name || ' and Their Deputies, State of' FROM nation UNION ALL SELECT s_suppkey, s_name FROM supplier"


@query(f"SELECT k, name, {DUCK_KEY.format('name')} AS agency_key FROM ({_NAMES})")
def entity_key(spark, sf):
    return portable(spark, sf, _NAMES).select("k", "name", text.entity_key("name").alias("agency_key"))


@query(f"SELECT doc_id, md5(regexp_replace(text, '{W}+', ' ', 'g')) AS loose FROM documents")
def loose_ws(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(text.loose("text").cast("binary")).alias("loose"))


@query(r"SELECT doc_id, md5(regexp_replace(chr(7) || text || chr(27) || chr(9), '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')) AS cleaned FROM documents")
def strip_control(spark, sf):
    dirty = F.concat(F.char(F.lit(7)), F.col("text"), F.char(F.lit(27)), F.char(F.lit(9)))
    return _docs(spark, sf).select("doc_id", F.md5(text.strip_control(dirty).cast("binary")).alias("cleaned"))


@query(r"SELECT conv_id, turn, regexp_replace(regexp_replace('## ' || role || chr(10) || chr(10) || chr(10) || chr(10) || '# x', '(^|\n)(#{1,6}\s)', '\1 \2', 'g'), '\n{3,}', chr(10) || chr(10), 'g') AS escaped FROM conversations")
def escape_headings(spark, sf):
    body = F.concat(F.lit("## "), F.col("role"), F.lit("\n\n\n\n# x"))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.escape_headings(body).alias("escaped"))


_PAGED = "SELECT l_orderkey AS k, l_linenumber AS j, CASE l_linenumber % 5 WHEN 0 THEN 'Page ' || CAST(l_linenumber AS STRING) || ' of ' || CAST(l_suppkey % 2000 AS STRING) WHEN 1 THEN CAST(l_linenumber AS STRING) WHEN 2 THEN CAST(l_suppkey AS STRING) || '/ 12' WHEN 3 THEN 'page two' ELSE 'p. ' || CAST(l_linenumber AS STRING) END AS s, l_linenumber AS n FROM lineitem"


@query(f"SELECT k, j, regexp_matches(s, '^(?i)(page\\s+)?[0-9]{{1,3}}(\\s*(of|/)\\s*[0-9]{{1,3}})?$') AND length(s) <= 16 AND n > 1 AS is_number FROM ({_PAGED.replace('AS STRING', 'AS VARCHAR')})")
def page_number_lines(spark, sf):
    return portable(spark, sf, _PAGED).select("k", "j", text.is_page_number("s", "n").alias("is_number"))


_SPACED = "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN regexp_replace(text, '(.)', '$1 ') ELSE text END AS t FROM documents"


@query(rf"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(CASE WHEN doc_id % 2 = 0 THEN regexp_replace(text, '(.)', '\1 ', 'g') ELSE text END, '{W}+'), lambda x: x <> '') AS w FROM documents)
SELECT doc_id, len(w) >= 50 AND len(list_filter(w, lambda x: length(x) = 1)) / len(w) > 0.6 AS spaced FROM t""")
def letter_spaced(spark, sf):
    return portable(spark, sf, _SPACED).select("doc_id", text.is_letter_spaced("t").alias("spaced"))


PAGE = 1000
_WHOLE_PAGES = f"""
SELECT doc_id, p AS page_no, 'Report ' || CAST(doc_id AS STRING) || '\\n' || CASE WHEN p % 3 = 0 THEN 'odd' ELSE ' Board ' END || '\\n\\n' || substr(text, p * {PAGE} + 1, {PAGE}) || '\\nfoot ' || CAST(p % 2 AS STRING) AS text
FROM (SELECT doc_id, text, explode(sequence(0, CAST(greatest(length(text) - 1, 0) AS INT) DIV {PAGE})) AS p FROM documents WHERE text IS NOT NULL)
"""
_DUCK_WHOLE = f"""
WITH p AS (SELECT doc_id, p AS page_no, string_split('Report ' || doc_id || chr(10) || CASE WHEN p % 3 = 0 THEN 'odd' ELSE ' Board ' END || chr(10) || chr(10) || substr(text, p * {PAGE} + 1, {PAGE}) || chr(10) || 'foot ' || (p % 2), chr(10)) AS ls
 FROM (SELECT doc_id, text, unnest(range(0, greatest(length(text) - 1, 0) // {PAGE} + 1)) AS p FROM documents WHERE text IS NOT NULL)),
n AS (SELECT doc_id, count(*) AS pages FROM p GROUP BY doc_id HAVING count(*) >= 4),
e AS (SELECT doc_id, 'h' AS part, unnest(ls[1:3]) AS line FROM p UNION ALL SELECT doc_id, 'f', unnest(ls[greatest(1, len(ls) - 2):]) FROM p),
t AS (SELECT doc_id, part, regexp_replace(regexp_replace(line, '\\A{W}+', ''), '{W}+\\z', '') AS line FROM e),
d AS (SELECT DISTINCT doc_id, line FROM (SELECT doc_id, part, line, count(*) AS c FROM t WHERE line <> '' GROUP BY ALL) JOIN n USING (doc_id) WHERE c > pages / 2)"""


@query(f"{_DUCK_WHOLE} SELECT doc_id, line FROM d")
def page_furniture(spark, sf):
    """Furniture of whole texts, cut into pages of a fixed size."""
    return catalogue.page_furniture(portable(spark, sf, _WHOLE_PAGES))


@query(SQL["page_furniture"])
def page_furniture_whole(spark, sf):
    return page_furniture(spark, sf)


@query(f"""{_DUCK_WHOLE}, a AS (SELECT doc_id, page_no, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM p), k AS (SELECT *, regexp_replace(regexp_replace(line, '\\A{W}+', ''), '{W}+\\z', '') AS body FROM a)
SELECT k.doc_id, page_no, md5(coalesce(string_agg(k.line, chr(10) ORDER BY i) FILTER (WHERE d.line IS NULL), '')) AS text_md5, count(d.line) AS removed FROM k LEFT JOIN d ON k.doc_id = d.doc_id AND body = d.line GROUP BY k.doc_id, page_no""")
def page_furniture_removed(spark, sf):
    pages = portable(spark, sf, _WHOLE_PAGES)
    return catalogue.without_furniture(pages).select("doc_id", "page_no", F.md5(F.col("text").cast("binary")).alias("text_md5"), "removed")


_COVERS = r"""
SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'Annual Performance Report' || chr(10) || 'Reporting  Year: ' || CAST(year(o_orderdate) AS STRING)
  WHEN 1 THEN 'Agency Management Report' || chr(10) || '  Board   of ' || chr(9) || CAST(o_custkey AS STRING) WHEN 2 THEN '9/25/23, 5:36 PM' || chr(10) || 'Rep orting Ye ar ' || CAST(year(o_orderdate) AS STRING)
  WHEN 3 THEN 'a b' || chr(10) || 'https://x.example' || chr(10) || 'Office of ' || o_orderpriority ELSE '' END AS first,
 'Reporting' || chr(10) || 'Year ' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(1900 + o_orderkey % 200 AS STRING) END AS body, CASE WHEN o_orderkey % 2 = 0 THEN 'Listed ' || o_orderstatus END AS listed FROM orders
"""
_DUCK_COVERS = _COVERS.replace("AS STRING", "AS VARCHAR")


@query(r"""SELECT k, coalesce(nullif(regexp_extract(regexp_replace(first, '\s+', ' ', 'g'), '(?i)Reporting\s+Year\s*[:\-]?\s*((?:19|20)[0-9]{2})', 1), ''), nullif(regexp_extract(regexp_replace(body, '\s+', ' ', 'g'), '(?i)Reporting\s+Year\s*[:\-]?\s*((?:19|20)[0-9]{2})', 1), ''),
 nullif(regexp_extract(regexp_replace(first, '\s+', '', 'g'), '(?i)ReportingYear[:\-]?((?:19|20)[0-9]{2})', 1), ''), nullif(regexp_extract(regexp_replace(body, '\s+', '', 'g'), '(?i)ReportingYear[:\-]?((?:19|20)[0-9]{2})', 1), '')) AS reporting_year FROM (""" + _DUCK_COVERS + ")")
def reporting_year(spark, sf):
    return portable(spark, sf, _COVERS).select("k", text.reporting_year("first", "body").alias("reporting_year"))


@query("SELECT k, CASE k % 5 WHEN 1 THEN 'Board of ' || split_part(first, chr(9), 2) WHEN 2 THEN split_part(first, chr(10), 2) WHEN 3 THEN split_part(first, chr(10), 3) ELSE coalesce(listed, '') END AS agency, CASE WHEN k % 5 IN (1, 2, 3) THEN 'document' WHEN listed IS NOT NULL THEN 'socrata' ELSE 'unknown' END AS agency_source FROM (" + _DUCK_COVERS + ")")
def agency_from_cover(spark, sf):
    found = text.agency("first", "listed")
    return portable(spark, sf, _COVERS).select("k", found["agency"].alias("agency"), found["agency_source"].alias("agency_source"))


_FILES = """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 16 = 15 THEN 'APPR_B%26' || o_orderstatus || '_' || y || '.pdf' WHEN o_orderkey % 16 = 3 THEN 'OBD%20' || y || ' Annual%20Performance Progress Report 100%.pdf' ELSE CASE o_orderkey % 8 WHEN 0 THEN 'APPR_b' || o_orderstatus || '_' || y || '-09-' || d || '.pdf' WHEN 1 THEN 'APPRProposed_dEq_' || y || '_01_' || d || '.pdf'
 WHEN 2 THEN 'appr_' || o_orderstatus || '.x_' || y || '.PDF' WHEN 3 THEN 'OBD ' || y || ' Annual Performance Progress Report final.pdf' WHEN 4 THEN 'Annual Performance Progress Report - ' || y || ' (Ob' || o_orderstatus || ').pdf'
 WHEN 5 THEN 'Updated 20' || d || ' of 2016 APPR.pdf' WHEN 6 THEN 'appr proposed 2019.pdf' ELSE 'Report ' || d || '.pdf' END END AS f, y, d, o_orderstatus AS s
FROM (SELECT *, CAST(year(o_orderdate) + 15 AS STRING) AS y, CAST(10 + o_orderkey % 15 AS STRING) AS d FROM orders) q
"""


@query("""SELECT k, CASE WHEN k % 16 = 15 THEN 'B&' || s ELSE CASE k % 8 WHEN 0 THEN 'B' || s WHEN 1 THEN 'DEQ' WHEN 2 THEN s || '.X' WHEN 3 THEN 'OBD' WHEN 4 THEN 'OB' || s END END AS agency_code,
 CASE WHEN k % 8 <= 4 OR k % 16 = 15 THEN y WHEN k % 8 = 5 THEN CASE WHEN CAST(d AS INT) BETWEEN 13 AND 26 AND d <> '16' THEN NULL ELSE '2016' END WHEN k % 8 = 6 THEN '2019' END AS reporting_year,
 CASE WHEN k % 8 <= 4 OR k % 16 = 15 THEN 'filename' WHEN k % 8 = 5 AND CAST(d AS INT) BETWEEN 13 AND 26 AND d <> '16' THEN NULL WHEN k % 8 <= 6 THEN 'filename-scan' END AS year_source,
 CASE WHEN k % 8 IN (1, 6) THEN 'proposed' ELSE 'approved' END AS measure_status, CASE WHEN lower(f) LIKE '%.pdf' THEN substr(f, 1, length(f) - 4) ELSE f END AS id FROM (""" + _FILES.replace("AS STRING", "AS VARCHAR") + ")")
def filename_parse(spark, sf):
    p = text.parse_filename("f")
    return portable(spark, sf, _FILES).select("k", *[p[c].alias(c) for c in ("agency_code", "reporting_year", "year_source", "measure_status")], text.id_of_file("f").alias("id"))


@query("SELECT p_partkey, substr(trim(regexp_replace(lower(p_type || ': ' || p_name || '!'), '[^a-z0-9]+', ' ', 'g')), 1, 200) AS measure_key FROM part")
def norm_measure(spark, sf):
    titled = F.concat("p_type", F.lit(": "), "p_name", F.lit("!"))
    return table(spark, sf, "part").select("p_partkey", F.substring(text.measure_key(titled), 1, text.KEY_CHARS).alias("measure_key"))


_CELLS = """
SELECT l_orderkey AS k, l_linenumber AS j, CASE l_suppkey % 13 WHEN 0 THEN '$' || CAST(l_partkey AS STRING) || '%' WHEN 1 THEN '-' || CAST(l_partkey AS STRING) || '.5' WHEN 2 THEN '-$5' WHEN 3 THEN '$-5' WHEN 4 THEN ','
 WHEN 5 THEN 'no data' WHEN 6 THEN 'N/A' WHEN 7 THEN '--' WHEN 8 THEN '*' WHEN 9 THEN 'Not Reported' WHEN 10 THEN '1,' || CAST(l_partkey AS STRING) WHEN 11 THEN '5 %' ELSE 'Pending review' END AS s FROM lineitem
"""
_DUCK_CELLS = _CELLS.replace("AS STRING", "AS VARCHAR")
_NUM = r"\$?-?[0-9,]+(?:\.[0-9]+)?%?"
_NON = r"No\s*Data|Not\s*(?:Available|Reported)|N/?A|TBD|Pending|--?|\*"


@query(f"SELECT k, j, regexp_matches(s, '(?i)^{_NUM}$|^(?:{_NON})$') AS is_value FROM ({_DUCK_CELLS})")
def value_cells(spark, sf):
    return portable(spark, sf, _CELLS).select("k", "j", text.is_value("s").alias("is_value"))


@query(f"SELECT k, array_to_string(regexp_extract_all('Actual: ' || string_agg(s, '  ' ORDER BY j, s), '(?i){_NUM}|{_NON}'), '|') AS tokens FROM ({_DUCK_CELLS}) GROUP BY k")
def value_tokens(spark, sf):
    cells = portable(spark, sf, _CELLS).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("j", "s"))).alias("c"))
    line = F.concat(F.lit("Actual: "), F.array_join(F.transform("c", lambda x: x["s"]), "  "))
    return cells.select("k", F.array_join(text.value_tokens(line), "|").alias("tokens"))


@query(f"SELECT k, j, regexp_matches(CASE WHEN k % 2 = 0 THEN '( ' || s || ')' ELSE '(' || s END, '\\(\\s*{_NUM}\\s*\\)') AS refused FROM ({_DUCK_CELLS})")
def accounting_refusal(spark, sf):
    shown = F.when(F.col("k") % 2 == 0, F.concat(F.lit("( "), F.col("s"), F.lit(")"))).otherwise(F.concat(F.lit("("), F.col("s")))
    return portable(spark, sf, _CELLS).select("k", "j", shown.rlike(text.ACCOUNTING).alias("refused"))


_HEADS = """
SELECT l_orderkey AS k, l_linenumber AS j, CASE l_suppkey % 9 WHEN 0 THEN 'Report Year 2016' WHEN 1 THEN 'METRIC' WHEN 2 THEN 'Metric  Value' WHEN 3 THEN 'Metric values' WHEN 4 THEN 'R e p o r t Year' WHEN 5 THEN 'The Report Year' WHEN 6 THEN 'M etric Value' WHEN 7 THEN 'me tric' ELSE 'report yearly' END AS s FROM lineitem
"""


@query(f"""SELECT k, j, p AS is_head, p OR starts_with(q, 'reportyear') OR (starts_with(q, 'metric') AND NOT starts_with(q, 'metricvalue')) AS is_layout_head FROM (
 SELECT k, j, regexp_matches(s, '^(?i)(Report Year|Metric)') AND NOT regexp_matches(s, '^(?i)Metric +Value') AS p, lower(regexp_replace(substr(s, 1, 20), '\\s+', '', 'g')) AS q FROM ({_HEADS}))""")
def series_head(spark, sf):
    return portable(spark, sf, _HEADS).select("k", "j", text.is_series_head("s").alias("is_head"), text.is_layout_series_head("s").alias("is_layout_head"))


_KPMS = """
SELECT l_orderkey AS k, l_linenumber AS j, CASE l_suppkey % 10 WHEN 0 THEN 'KPM #1' WHEN 1 THEN 'KPM# 2 Traffic deaths' WHEN 2 THEN 'KPM #7PERCENTAGE of' WHEN 3 THEN 'KPM #2A' WHEN 4 THEN 'KPM #14 documents how' WHEN 5 THEN 'KPM# Approved' WHEN 6 THEN 'KPM#3   ' WHEN 7 THEN ' KPM #1' WHEN 8 THEN 'KPM #4   (a)' ELSE 'KPM # 12Average wait' END AS s FROM lineitem
"""


@query(f"SELECT k, j, regexp_matches(s, '^KPM ?# ?([0-9]+)([ \\t]*$|[ \\t]+[A-Z]|[A-Z][a-zA-Z])') AS is_head, regexp_matches(s, '^KPM ?# ?([0-9]+)([ \\t]*$|[ \\t]+[A-Z]|[ \\t]{{2,}}\\S|[A-Z][a-zA-Z])') AS is_layout_head FROM ({_KPMS})")
def kpm_heading(spark, sf):
    return portable(spark, sf, _KPMS).select("k", "j", F.col("s").rlike(text.KPM_HEAD).alias("is_head"), F.col("s").rlike(text.LAYOUT_HEAD).alias("is_layout_head"))


@query("SELECT s_suppkey, 'APPR ' || coalesce(CASE WHEN s_suppkey % 2 = 0 THEN 'C' || s_suppkey END, upper(substr(trim(regexp_replace(lower('Office of ' || s_name || ' & Partners'), '[^a-z0-9]+', '-', 'g'), '-'), 1, 24))) || ' ' || (2010 + s_suppkey % 9) AS citation FROM supplier")
def citation_string(spark, sf):
    s = table(spark, sf, "supplier")
    code = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("C"), F.col("s_suppkey").cast("string")))
    name = F.concat(F.lit("Office of "), F.col("s_name"), F.lit(" & Partners"))
    return s.select("s_suppkey", text.citation(code, name, (F.lit(2010) + F.col("s_suppkey") % 9).cast("string")).alias("citation"))


@query("""SELECT o_orderkey AS k, array_to_string(list_filter(['KPM #', 'Report Year', 'Actual', 'Target', 'Data Collection Period'], lambda a: NOT contains(regexp_replace(t, '\\s+', ' ', 'g'), a) AND NOT contains(regexp_replace(t, '\\s+', '', 'g'), replace(a, ' ', ''))), ',') AS missing
 FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'KPM #1 ' ELSE '' END || CASE WHEN o_orderkey % 3 = 0 THEN 'Re port' || chr(10) || 'Year ' ELSE 'report year' END || CASE WHEN o_orderkey % 5 = 0 THEN 'Actual' ELSE 'A c t u a l' END || CASE WHEN o_orderkey % 7 = 0 THEN ' Data  Collection Period' ELSE '' END AS t FROM orders)""")
def missing_anchors(spark, sf):
    k = F.col("o_orderkey")
    t = F.concat(F.when(k % 2 == 0, "KPM #1 ").otherwise(""), F.when(k % 3 == 0, "Re port\nYear ").otherwise("report year"), F.when(k % 5 == 0, "Actual").otherwise("A c t u a l"), F.when(k % 7 == 0, " Data  Collection Period").otherwise(""))
    return table(spark, sf, "orders").select(k.alias("k"), F.array_join(text.missing_anchors(t), ",").alias("missing"))


@query("SELECT l_orderkey AS k, l_linenumber AS j, CASE WHEN l_linenumber = 3 THEN FALSE ELSE year(l_shipdate) <> 1995 + l_linenumber END AS differs, CAST(1995 + l_linenumber AS VARCHAR) AS reporting_year FROM lineitem")
def year_disagreement(spark, sf):
    stated = (F.lit(1995) + F.col("l_linenumber")).cast("string")
    listed = F.when(F.col("l_linenumber") != 3, F.year("l_shipdate").cast("string"))
    differs = F.coalesce(listed != stated, F.lit(False))
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("j"), differs.alias("differs"), stated.alias("reporting_year"))


@query("""SELECT c_custkey AS k, concat_ws('; ', CASE WHEN c_custkey % 2 = 0 THEN 'no text layer in the source PDF; text recovered by OCR. Two independent engines (tesseract (ocrmypdf) + paddleocr PP-OCRv6) agree on ' || CAST(round_even((c_custkey % 200) / 200.0 * 100, 0) AS INT) || '% of the word sequence and ' || CAST(round_even((c_custkey % 8) / 8.0 * 100, 0) AS INT)
 || '% of the ' || c_custkey || ' figures, ' || CAST(round_even((c_custkey % 1000) / 1000.0 * 100, 0) AS INT) || '% dictionary-recognizable' || CASE WHEN c_custkey % 4 > 0 THEN '; ' || (c_custkey % 4) || ' heading/letterhead token(s) lost their word spacing in extraction and are left as-is rather than reconstructed' ELSE '' END || '; NOT human-verified — treat every number as unchecked against the source' END,
 CASE WHEN c_custkey % 3 = 0 THEN 'missing expected anchors: Actual, Target' END, CASE WHEN c_custkey % 5 = 0 THEN 'filename implied reporting year 2019; the document states 2020 and the document wins' END,
 CASE c_custkey % 7 WHEN 0 THEN 'agency name taken from socrata, not the document''s own cover page' WHEN 1 THEN 'agency name taken from unknown, not the document''s own cover page' END) AS notes FROM customer""")
def conversion_notes(spark, sf):
    k = F.col("c_custkey")
    missing = F.when(k % 3 == 0, F.array(F.lit("Actual"), F.lit("Target"))).otherwise(F.array().cast("array<string>"))
    note = F.when(k % 2 == 0, quality.ocr_note((k % 200) / 200, (k % 8) / 8, k, (k % 1000) / 1000, k % 4))
    listed = F.when(k % 5 == 0, "2019").when(k % 5 == 1, "2020")
    source = F.when(k % 7 == 0, "socrata").when(k % 7 == 1, "unknown").otherwise("document")
    return table(spark, sf, "customer").select(k.alias("k"), catalogue.conversion_notes(note, missing, listed, F.lit("2020"), source).alias("notes"))


@query(f"SELECT doc_id, CASE WHEN length(t) >= 200 THEN sha256(trim(regexp_replace(translate(t, '‘’“”', '''''\"\"'), '{W}+', ' ', 'g'), ' ')) ELSE sha256(t) END AS content_sha256 FROM (SELECT doc_id, '“' || text || '’' AS t FROM documents)")
def content_hash(spark, sf):
    return _docs(spark, sf).select("doc_id", text.content_hash(F.concat(F.lit("“"), F.col("text"), F.lit("’"))).alias("content_sha256"))


@query("SELECT doc_id, md5(chr(10) || CASE WHEN doc_id % 2 = 0 THEN replace(text, '#', '') || chr(10) ELSE '' END) AS section FROM documents")
def section_extract(spark, sf):
    body = F.concat(F.lit("# T\n\n## At a glance\n\nx\n\n## Full text\n"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.replace("text", F.lit("#"), F.lit("")), F.lit("\n"))).otherwise(""), F.lit("## Notes\n\ny\n"))
    return _docs(spark, sf).select("doc_id", F.md5(text.section(body, "Full text").cast("binary")).alias("section"))


@query("""WITH RECURSIVE r AS (SELECT o_custkey AS k, list(o_orderpriority ORDER BY o_orderkey) AS long FROM orders GROUP BY o_custkey), s AS (SELECT k, long, list_filter(long, lambda x, i: i % 3 <> 0) AS short FROM r),
f(k, long, short, i, ways) AS (SELECT k, long, short, 0, list_transform(range(0, len(short) + 1), lambda j: CASE WHEN j = 0 THEN 1 ELSE 0 END) FROM s
 UNION ALL SELECT k, long, short, i + 1, list_transform(range(0, len(short) + 1), lambda j: CASE WHEN j > 0 AND short[j] = long[i + 1] THEN least(2, ways[j + 1] + ways[j]) ELSE ways[j + 1] END) FROM f WHERE i < len(long))
SELECT k, CAST(ways[len(short) + 1] AS BIGINT) AS ways FROM f WHERE i = len(long)""")
def embedding_count(spark, sf):
    """Runs of every length."""
    runs = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("p"))
    runs = runs.select("k", F.transform("p", lambda x: x["o_orderpriority"]).alias("long"))
    short = F.filter("long", lambda x, i: (i + 1) % 3 != 0)
    return runs.select("k", arrays.embeddings(short, F.col("long")).cast("long").alias("ways"))


@query(SQL["embedding_count"])
def embedding_count_all(spark, sf):
    return embedding_count(spark, sf)


@query("SELECT o_custkey AS k, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS i, CAST(o_orderkey AS VARCHAR) AS year, o_orderpriority AS actual, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 2 THEN o_orderstatus END AS target FROM orders")
def zip_series(spark, sf):
    runs = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority", "o_orderstatus"))).alias("p"))
    part = lambda c: F.transform("p", lambda x: x[c].cast("string"))
    cells = F.arrays_zip(part("o_orderkey").alias("year"), part("o_orderpriority").alias("actual"), F.slice(part("o_orderstatus"), 1, 2).alias("target"))
    return runs.select("k", F.posexplode(cells).alias("i", "c")).select("k", "i", "c.year", "c.actual", "c.target")


@query("""WITH r AS (SELECT o_custkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS c, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority WHEN o_orderkey % 3 = 0 THEN '' END AS s FROM orders)
SELECT k, CAST(i - 1 AS INT) AS i, CASE WHEN c > 1 AND coalesce(s, '') = '' THEN 'unlabelled run ' || i ELSE s END AS submeasure FROM r""")
def unlabelled_runs(spark, sf):
    k = F.col("o_orderkey")
    label = F.when(k % 2 == 0, F.col("o_orderpriority")).when(k % 3 == 0, F.lit(""))
    runs = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct(k, label.alias("submeasure"), F.lit(None).cast("string").alias("actual"), F.lit(None).cast("string").alias("target")))).alias("p"))
    shaped = F.transform("p", lambda x: F.struct(x["submeasure"].alias("submeasure"), x["actual"].alias("actual"), x["target"].alias("target")))
    return runs.select("k", F.posexplode(arrays.label_runs(shaped)).alias("i", "r")).select("k", "i", "r.submeasure")
