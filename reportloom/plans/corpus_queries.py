"""Entities, graph, rules, citations, search and manifests over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import catalogue, citations, entities, graph, quality, ranks, search, sinks
from ..sources import frontmatter, listings, storage
from ..sources.tables import table
from .base import DUCK_KEY, DUCK_META, META, SQL, portable, query


def _meta(spark, sf, rendered=""):
    return portable(spark, sf, META, rendered)


M = f"WITH m AS (SELECT *, {DUCK_KEY.format('agency')} AS agency_key FROM ({DUCK_META}))"


def _keyed(spark, sf, rendered=""):
    return _meta(spark, sf, rendered).withColumn("agency_key", text.entity_key("agency"))


# --- scans ---------------------------------------------------------------


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 7 <> 0 THEN 'cust-' || c_custkey END AS id, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS title, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS doc_type FROM customer")
def frontmatter_scan(spark, sf):
    md = portable(spark, sf, "SELECT c_custkey AS k, concat('---', chr(10), 'id: cust-', c_custkey, chr(10), 'title: \"', c_name, '\"', chr(10), 'doc_type: ', c_mktsegment, chr(10), CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '---' END, chr(10), 'body: x', chr(10)) AS md FROM customer", "customer")
    said = md.select("k", frontmatter.fields("md").alias("fields"))
    return said.select("k", *[F.element_at("fields", F.lit(f)).alias(f) for f in ("id", "title", "doc_type")])


#: Front matter in each form that a value can take; ``k`` picks the form.
_FORMS = r"""
SELECT c_custkey AS k, concat_ws(chr(10), '---', 'schema_version: 1', concat('id: cust-', c_custkey), concat('title: "', c_name, ' says \\"hi\\" \\u00e9', chr(10), '  on two lines"'),
 concat('agency: ', chr(39), 'O', chr(39), chr(39), 'Brien', chr(10), chr(10), '    of ', c_mktsegment, chr(39), ' # who'),
 CASE c_custkey % 5 WHEN 0 THEN 'agency_code: null' WHEN 1 THEN 'agency_code: ~' WHEN 2 THEN 'agency_code: ""' WHEN 3 THEN 'agency_code:' ELSE concat('agency_code: C', c_nationkey, '   # code') END,
 'conversion_notes: first part', concat('  and ', c_mktsegment), '  # a remark', 'maintainer: >-', '  folded', '  line', '', '  last',
 'source_url: https://h.example/a:b#c', 'relationships:',
 CASE WHEN c_custkey % 3 = 0 THEN '  implements: []' ELSE concat('  implements: [a-', c_custkey, ', "b, c",', chr(10), '    ', chr(39), 'd', chr(39), ']') END,
 '  related:', CASE WHEN c_custkey % 2 = 0 THEN concat('  - cust-', c_custkey + 1, chr(10), '  - "x: y"') ELSE concat('    - cust-', c_custkey - 1) END, 'tags:', '- kpm', concat('- ry', 2000 + c_custkey % 20), concat('id: last-', c_custkey),
 '---', '', '## Full text', '', 'body') AS md FROM customer
"""


@query("""SELECT c_custkey AS k, '1' AS schema_version, 'last-' || c_custkey AS id, c_name || ' says "hi" é on two lines' AS title, 'O''Brien' || chr(10) || 'of ' || c_mktsegment AS agency,
 CASE c_custkey % 5 WHEN 2 THEN '' WHEN 4 THEN 'C' || c_nationkey END AS agency_code, 'first part and ' || c_mktsegment AS conversion_notes, 'folded line' || chr(10) || 'last' AS maintainer, 'https://h.example/a:b#c' AS source_url,
 CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'a-' || c_custkey || '|b, c|d' END AS implements, CASE WHEN c_custkey % 2 = 0 THEN 'cust-' || (c_custkey + 1) || '|x: y' ELSE 'cust-' || (c_custkey - 1) END AS related,
 'kpm|ry' || (2000 + c_custkey % 20) AS tags, TRUE AS sound FROM customer""")
def frontmatter_forms(spark, sf):
    """Null, empty, quoted, escaped, folded and repeated fields, lists of both kinds, one level of names below a name."""
    docs = frontmatter.as_documents(frontmatter.read(portable(spark, sf, _FORMS, "customer").withColumn("path", F.col("k").cast("string"))))
    joined = lambda c: F.array_join(c, "|").alias(c.split(".")[-1])
    scalars = ["schema_version", "id", "title", "agency", "agency_code", "conversion_notes", "maintainer", "source_url"]
    return docs.select(F.col("path").cast("long").alias("k"), *scalars, joined("relationships.implements"), joined("relationships.related"), joined("tags"), F.col("problem").isNull().alias("sound"))


@query("""SELECT 'last-' || c_custkey AS "from", 'implements' AS type, unnest(['a-' || c_custkey, 'b, c', 'd']) AS "to" FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'last-' || c_custkey, 'related', unnest(CASE WHEN c_custkey % 2 = 0 THEN ['cust-' || (c_custkey + 1), 'x: y'] ELSE ['cust-' || (c_custkey - 1)] END) FROM customer""")
def graph_edges_of_files(spark, sf):
    """Relations that the files themselves state."""
    return graph.stated_edges(frontmatter.as_documents(frontmatter.read(portable(spark, sf, _FORMS, "customer").withColumn("path", F.lit("x.md")))))


@query("SELECT DISTINCT 'https://h.example/LFO/APPR/' || (page_id % 50) || '%20x.pdf?v=' || (page_id % 3) AS url FROM pages WHERE page_id % 3 <> 0")
def feed_link_extract(spark, sf):
    feeds = portable(spark, sf, "SELECT CASE WHEN page_id % 3 = 0 THEN '<item><link>http://h.example/other/a.pdf</link></item>' ELSE concat('<item><title>t</title><link>http://h.example/LFO/APPR/', page_id % 50, ' x.pdf?v=', page_id % 3, '#p</link></item>') END AS xml FROM pages")
    return catalogue.feed_links(feeds)


_PROBES = """
SELECT l_orderkey AS k, l_linenumber AS j, CASE l_suppkey % 6 WHEN 0 THEN 405 WHEN 1 THEN 404 WHEN 2 THEN 0 WHEN 3 THEN 501 ELSE 200 END AS code, CASE WHEN l_partkey % 3 = 0 THEN 'text/html' ELSE 'Application/PDF' END AS ctype,
 CASE WHEN l_partkey % 5 = 0 THEN 206 WHEN l_partkey % 5 = 1 THEN 200 ELSE 403 END AS rcode, CASE WHEN l_partkey % 2 = 0 THEN 'application/pdf' END AS rtype, CASE WHEN l_partkey % 4 = 0 THEN '%PDF-1.4' WHEN l_partkey % 4 = 2 THEN '<html>%PDF' END AS rhead FROM lineitem
"""


@query(f"""SELECT k, j, CASE WHEN code = 200 AND ctype LIKE '%PDF%' THEN 'verified' WHEN code IN (200, 405, 501) AND (rcode IN (200, 206) AND coalesce(starts_with(rhead, '%PDF'), FALSE) OR rcode = 200 AND rtype IS NOT NULL) THEN 'verified by range' WHEN code = 0 THEN 'network error' ELSE 'unreachable' END AS state FROM ({_PROBES})""")
def probe_classify(spark, sf):
    state = catalogue.probe_state(F.col("code"), F.col("ctype"), F.col("rcode"), F.col("rtype"), F.col("rhead"))
    return portable(spark, sf, _PROBES).select("k", "j", state.alias("state"))


@query("SELECT doc_id, length(CASE WHEN doc_id % 700 < 500 AND length(text) > least(length(text), doc_id % 700) THEN text ELSE substr(text, 1, CAST(doc_id % 700 AS INT)) END) AS n FROM documents")
def fallback_choice(spark, sf):
    short = F.expr("substring(text, 1, cast(doc_id % 700 as int))")
    return table(spark, sf, "documents").select("doc_id", F.length(catalogue.fallback(short, F.col("text"))).cast("long").alias("n"))


@query("""WITH o AS (SELECT o_custkey % 50 AS c, o_orderpriority AS p FROM orders WHERE o_orderkey % 10 <> 0), n AS (SELECT o_custkey % 50 AS c, o_orderpriority AS p FROM orders WHERE o_orderkey % 10 <> 1)
SELECT 'old' AS side, * FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n) UNION ALL SELECT 'new', * FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o)""")
def staleness_diff(spark, sf):
    part = lambda r: portable(spark, sf, f"SELECT o_custkey % 50 AS c, o_orderpriority AS p FROM orders WHERE o_orderkey % 10 <> {r}")
    return catalogue.difference(part(0), part(1))


# --- filters and outcomes ------------------------------------------------


@query(f"{M} SELECT id, reporting_year FROM m WHERE reporting_year IN ('2016', '2019') OR reporting_year IS NULL")
def year_filter_nullpass(spark, sf):
    return catalogue.year_filter(_meta(spark, sf), ["2016", "2019"]).select("id", "reporting_year")


@query(f"{M} SELECT id, path FROM m WHERE status = 'current' ORDER BY path LIMIT 25")
def point_limit(spark, sf):
    return _meta(spark, sf).where("status = 'current'").select("id", "path").orderBy("path").limit(25)


@query(f"{M} SELECT id FROM m WHERE coalesce(agency_code, '') = '' OR coalesce(reporting_year, '') = ''")
def unparsed_names(spark, sf):
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return _meta(spark, sf).where(blank("agency_code") | blank("reporting_year")).select("id")


@query(f"{M} SELECT id, coalesce(nullif(CASE WHEN n % 3 = 0 THEN '' WHEN n % 3 = 1 THEN '2001' END, ''), reporting_year) AS reporting_year, CASE WHEN n % 3 = 1 THEN 'socrata' ELSE year_source END AS year_source FROM m")
def provenance_coalesce(spark, sf):
    listed = F.when(F.col("n") % 3 == 0, "").when(F.col("n") % 3 == 1, "2001")
    value, origin = catalogue.with_provenance(listed, F.col("reporting_year"), F.col("year_source"))
    return _meta(spark, sf).select("id", value.alias("reporting_year"), origin.alias("year_source"))


@query("SELECT doc_id, length(text) AS n FROM documents WHERE length(text) >= 500")
def min_length_gate(spark, sf):
    return table(spark, sf, "documents").where(F.length("text") >= 500).select("doc_id", F.length("text").cast("long").alias("n"))


@query("SELECT CASE WHEN length(text) < 500 THEN 'failed' WHEN doc_id % 9 = 0 THEN 'skipped' ELSE 'ok' END AS outcome, count(*) AS n FROM documents GROUP BY 1")
def ingest_outcomes(spark, sf):
    docs = table(spark, sf, "documents").withColumn("reporting_year", F.when(F.col("doc_id") % 9 == 0, "").otherwise("2019"))
    return catalogue.outcomes(docs)


VIEW = ["id", "title", "doc_type", "status", "agency", "agency_key", "agency_code", "reporting_year", "year_source", "text_source", "measure_status"]


@query(f"{M} SELECT {', '.join(VIEW)} FROM m")
def document_view(spark, sf):
    return _keyed(spark, sf).select(*VIEW)


@query(SQL["document_view"])
def document_view_all(spark, sf):
    return document_view(spark, sf)


# --- joins and entities --------------------------------------------------


@query("SELECT c_custkey, c_name, max_by(o_orderpriority, o_orderkey) AS o_orderpriority, max_by(o_orderstatus, o_orderkey) AS o_orderstatus FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL")
def left_lookup_last_wins(spark, sf):
    right = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority", "o_orderstatus")
    return catalogue.last_wins(table(spark, sf, "customer").select("c_custkey", "c_name"), right, "c_custkey", "o_orderkey")


_NATION = "coalesce(array_to_string(list_sort(string_split(regexp_replace(lower(n_name), '[^a-z0-9]', ' ', 'g'), ' ')), '-'), '')"
_WALK = f"""mapping AS (SELECT {_NATION} AS agency_key, CASE WHEN n_nationkey % 6 <> 5 THEN 'nation-' || n_nationkey ELSE '' END AS slug,
 CASE n_nationkey % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'alias' WHEN 2 THEN 'successor' WHEN 3 THEN 'manual' ELSE 'guess' END AS basis, CASE WHEN n_nationkey % 3 = 0 THEN 'seen' END AS note FROM nation WHERE n_nationkey % 4 <> 0),
unmapped AS (SELECT {_NATION} AS agency_key, CASE WHEN n_nationkey % 8 = 0 THEN 'closed' ELSE '' END AS reason FROM nation WHERE n_nationkey % 4 = 0 AND n_nationkey > 4 OR n_nationkey = 7 UNION ALL SELECT 'gone', 'merged'),
registry AS (SELECT 'nation-' || n_nationkey AS slug FROM nation WHERE n_nationkey < 20)"""


def _walk(spark, sf):
    n = table(spark, sf, "nation").withColumn("agency_key", text.entity_key("n_name")).withColumn("k", F.col("n_nationkey"))
    basis = F.element_at(F.array(*map(F.lit, ["exact", "alias", "successor", "manual", "guess"])), F.col("k") % 5 + 1)
    mapping = n.where("k % 4 <> 0").select("agency_key", F.when(F.col("k") % 6 != 5, F.concat(F.lit("nation-"), "k")).otherwise("").alias("slug"), basis.alias("basis"), F.when(F.col("k") % 3 == 0, "seen").alias("note"))
    unmapped = n.where("k % 4 = 0 and k > 4 or k = 7").select("agency_key", F.when(F.col("k") % 8 == 0, "closed").otherwise("").alias("reason"))
    unmapped = unmapped.union(spark.sql("SELECT 'gone', 'merged'"))
    return mapping, unmapped, n.where("k < 20").select(F.concat(F.lit("nation-"), "k").alias("slug"))


@query(f"{M}, {_WALK} SELECT id, m.agency_key, slug AS agency_registry_slug FROM m LEFT JOIN mapping ON m.agency_key = mapping.agency_key")
def crosswalk_join(spark, sf):
    return entities.crosswalk_join(_meta(spark, sf), _walk(spark, sf)[0]).select("id", "agency_key", "agency_registry_slug")


@query(f"""{M}, {_WALK}, l AS (SELECT agency_key FROM mapping UNION SELECT agency_key FROM unmapped)
SELECT DISTINCT agency_key, 'unclassified' AS state FROM m WHERE agency_key NOT IN (SELECT * FROM l) UNION ALL SELECT agency_key, 'stale' FROM l WHERE agency_key NOT IN (SELECT agency_key FROM m)""")
def crosswalk_coverage(spark, sf):
    mapping, unmapped, _ = _walk(spark, sf)
    return entities.coverage(_keyed(spark, sf).select("agency_key").distinct(), mapping, unmapped)


@query(f"WITH {_WALK} SELECT agency_key, slug FROM mapping WHERE slug <> '' AND slug NOT IN (SELECT slug FROM registry)")
def registry_orphans(spark, sf):
    mapping, _, registry = _walk(spark, sf)
    return mapping.where("slug <> ''").join(registry, "slug", "left_anti").select("agency_key", "slug")


@query(f"""{M}, {_WALK}, l AS (SELECT agency_key FROM mapping UNION SELECT agency_key FROM unmapped)
SELECT agency_key, 'mapped and unmapped' AS problem FROM mapping WHERE agency_key IN (SELECT agency_key FROM unmapped) UNION ALL SELECT DISTINCT agency_key, 'unclassified' FROM m WHERE agency_key NOT IN (SELECT * FROM l)
UNION ALL SELECT agency_key, 'stale' FROM l WHERE agency_key NOT IN (SELECT agency_key FROM m) UNION ALL SELECT agency_key, 'no slug' FROM mapping WHERE slug = '' UNION ALL SELECT agency_key, 'bad basis' FROM mapping WHERE slug <> '' AND basis = 'guess'
UNION ALL SELECT agency_key, 'needs a note' FROM mapping WHERE slug <> '' AND basis IN ('alias', 'successor', 'manual') AND note IS NULL UNION ALL SELECT agency_key, 'needs a reason' FROM unmapped WHERE reason = ''
UNION ALL SELECT agency_key, 'slug not in registry' FROM mapping WHERE slug <> '' AND slug NOT IN (SELECT slug FROM registry)
UNION ALL SELECT NULL, count(*) || ' mapped document(s) carry no slug' FROM m WHERE agency_key IN (SELECT agency_key FROM mapping) AND agency_registry_slug IS NULL HAVING count(*) > 0""")
def crosswalk_check(spark, sf):
    mapping, unmapped, registry = _walk(spark, sf)
    docs = _keyed(spark, sf)
    return entities.crosswalk_problems(docs.select("agency_key").distinct(), mapping, unmapped, registry, docs)


@query(f"WITH {_WALK} SELECT agency_key FROM mapping INTERSECT SELECT agency_key FROM unmapped")
def both_classified(spark, sf):
    mapping, unmapped, _ = _walk(spark, sf)
    return mapping.select("agency_key").intersect(unmapped.select("agency_key"))


@query(f"{M}, {_WALK} SELECT count(DISTINCT agency_key) AS keys, count(DISTINCT agency_key) FILTER (WHERE agency_key IN (SELECT agency_key FROM mapping UNION SELECT agency_key FROM unmapped)) AS accounted FROM m")
def accounted_for(spark, sf):
    mapping, unmapped, _ = _walk(spark, sf)
    listed = mapping.select("agency_key").union(unmapped.select("agency_key")).distinct().withColumn("listed", F.lit(True))
    keys = _keyed(spark, sf).select("agency_key").distinct().join(listed, "agency_key", "left")
    return keys.agg(F.count("*").alias("keys"), F.count("listed").alias("accounted"))


def _stamped(spark, sf):
    mapping = _walk(spark, sf)[0].select("agency_key", "slug")
    docs = _keyed(spark, sf).select(F.col("id").alias("doc_id"), "n", "agency_key").join(mapping.withColumnRenamed("slug", "wanted"), "agency_key", "left")
    return docs.withColumn("stamped", F.when(F.col("n") % 3 == 0, F.col("wanted")).when(F.col("n") % 3 == 1, "old-slug")), mapping


@query(f"{M}, {_WALK} SELECT count(slug) AS want, count(slug) FILTER (WHERE n % 3 <> 2) AS stamped FROM m LEFT JOIN mapping ON m.agency_key = mapping.agency_key")
def stamp_state(spark, sf):
    return entities.stamp_state(_stamped(spark, sf)[0])


@query(f"{M}, {_WALK} SELECT id AS doc_id, m.agency_key, 'old-slug' AS stamped, slug FROM m LEFT JOIN mapping ON m.agency_key = mapping.agency_key WHERE n % 3 = 1")
def registry_drift(spark, sf):
    return entities.drift(*_stamped(spark, sf))


@query(f"{M} SELECT agency_key, array_to_string(list_sort(list(DISTINCT agency)), ';') AS names FROM m GROUP BY agency_key")
def names_per_key(spark, sf):
    return entities.names_per_key(_meta(spark, sf)).select("agency_key", F.array_join("names", ";").alias("names"))


@query()
def fuzzy_suggest(spark, sf):
    return entities.suggestions(_keyed(spark, sf).select("agency_key"), table(spark, sf, "nation").select(text.slug("n_name").alias("slug")))


@query(f"{M} SELECT id, title, doc_type, status, agency, agency_key, agency_code, reporting_year, year_source, text_source, measure_status, agency_registry_slug, agency_registry_corpus, last_verified, 'it''s: ' || title || chr(10) || '# ' || agency AS conversion_notes, CASE WHEN n % 2 = 0 THEN 'a-' || n || '|b: c' ELSE '' END AS related, 'kpm|null' AS tags, TRUE AS sound FROM m")
def report_round_trip(spark, sf):
    """Reports written as Markdown and read again: every field as it was, null as null."""
    docs = _keyed(spark, sf, "customer").withColumn("conversion_notes", F.concat(F.lit("it's: "), "title", F.lit("\n# "), "agency"))
    ends = F.when(F.col("n") % 2 == 0, F.array(F.concat(F.lit("a-"), F.col("n").cast("string")), F.lit("b: c")))
    none = F.array().cast("array<string>")
    docs = docs.withColumns({"relationships": F.struct(*[(ends if r == "related" else none).alias(r) for r in frontmatter.RELATIONS]), "tags": F.array(F.lit("kpm"), F.lit("null")), "full_text": F.col("body")})
    back = frontmatter.as_documents(frontmatter.read(docs.select("path", sinks.markdown(docs).alias("md"))))
    same = ["id", "title", "doc_type", "status", "agency", "agency_key", "agency_code", "reporting_year", "year_source", "text_source", "measure_status", "agency_registry_slug", "agency_registry_corpus", "last_verified", "conversion_notes"]
    joined = lambda c: F.coalesce(F.array_join(c, "|"), F.lit("")).alias(c.split(".")[-1])
    return back.select(*same, joined("relationships.related"), joined("tags"), F.col("problem").isNull().alias("sound"))


@query(f"{M} SELECT id, path AS url, agency_code, agency, reporting_year, n * 1000 AS bytes, CAST(row_number() OVER (ORDER BY coalesce(reporting_year, 'None'), coalesce(agency_code, 'None'), id) - 1 AS BIGINT) AS place FROM m")
def manifest_round_trip(spark, sf):
    """A manifest written as one listing and read again by its records, which come in the order of year, code and id."""
    columns = ["id", "url", "agency_code", "agency", "reporting_year", "bytes"]
    sources = _meta(spark, sf).select("id", F.col("path").alias("url"), "agency_code", "agency", "reporting_year", (F.col("n") * 1000).alias("bytes"))
    path = storage.new_path(spark, "manifest")
    listings.write_manifest(sources, path, catalogue.facts(sources, 2010, 2030), columns)
    rows = listings.read_items(spark, path).select("place", *[F.element_at("fields", c).alias(c) for c in columns]).withColumn("bytes", F.col("bytes").cast("long"))
    return ranks.ranked(rows.withColumnRenamed("place", "at"), ["at"], "place").drop("at")


@query(f"WITH {_WALK} SELECT agency_key, slug, basis, note FROM mapping")
def crosswalk_round_trip(spark, sf):
    """A crosswalk written as one listing and read again."""
    mapping, unmapped, _ = _walk(spark, sf)
    path = storage.new_path(spark, "crosswalk")
    listings.write_crosswalk(mapping, unmapped, path, {"note": "Keys, and slugs of the registry: curated.", "registry_corpus": "registry"})
    back = listings.read_map(spark, path, "mapping")
    return back.select(F.col("key").alias("agency_key"), *[F.element_at("fields", c).alias(c) for c in ("slug", "basis", "note")])


#: Recorded answers to paged queries: pages of up to five rows from row 1 on; some are short, some failed, some were never asked.
_PAGES = """
SELECT o_custkey % 40 AS q, 1 + 5 * (o_custkey % 7) AS start, o_custkey % 11 <> 3 AS ok, o_orderkey AS k, CASE WHEN o_custkey % 5 = 4 THEN o_orderkey % 3 ELSE 5 END AS rows FROM orders WHERE o_custkey % 13 <> 6
"""


@query(f"""WITH p AS (SELECT q, start, max_by(ok, k) AS ok, max_by(rows, k) AS rows, max(k) AS k FROM ({_PAGES}) GROUP BY q, start),
r AS (SELECT *, row_number() OVER w - 1 = (start - 1) // 5 AS there, bool_or(NOT ok OR rows < 5) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended FROM p WINDOW w AS (PARTITION BY q ORDER BY start))
SELECT q, start, k, rows FROM r WHERE there AND ok AND NOT coalesce(ended, FALSE)""")
def paged_sweep(spark, sf):
    """Pages of each query up to its first short, failed or missing page; of a page recorded twice the last counts."""
    pages = portable(spark, sf, _PAGES).select(F.col("q").alias("query"), "start", "ok", "k", F.expr("transform(sequence(1, 5), i -> if(i <= rows, i, null))").alias("items"))
    pages = pages.withColumn("items", F.filter("items", lambda x: x.isNotNull()))
    taken = catalogue.taken(pages, 5, "k")
    return taken.select(F.col("query").alias("q"), "start", "k", F.size("items").cast("long").alias("rows"))


# --- counts, ranks and samples -------------------------------------------


@query(f"{M} SELECT coalesce(reporting_year, 'None') AS year, count(*) AS sources FROM m GROUP BY 1")
def count_by_year(spark, sf):
    return catalogue.count_by_year(_meta(spark, sf))


@query(f"{M} SELECT CAST(y AS VARCHAR) AS year FROM (SELECT unnest(range(2010, 2031)) AS y) WHERE CAST(y AS VARCHAR) NOT IN (SELECT reporting_year FROM m WHERE reporting_year IS NOT NULL)")
def year_gaps(spark, sf):
    return catalogue.year_gaps(_meta(spark, sf), 2010, 2030)


@query(f"{M} SELECT id, CAST(row_number() OVER (PARTITION BY coalesce(reporting_year, 'None') ORDER BY coalesce(agency_code, 'None'), id) AS INT) AS place FROM m")
def manifest_rank(spark, sf):
    from pyspark.sql import Window

    year, code = catalogue.as_text(F.col("reporting_year")), catalogue.as_text(F.col("agency_code"))
    return _meta(spark, sf).select("id", F.row_number().over(Window.partitionBy(year).orderBy(code, "id")).alias("place"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents) WHERE r % 7 = 0")
def systematic_sample(spark, sf):
    return quality.systematic(table(spark, sf, "documents").select("doc_id"), 7)


@query(f"{M} SELECT path, id FROM (SELECT path, id, row_number() OVER (ORDER BY path, id) - 1 AS r FROM m) WHERE r % 5 = 0")
def systematic_sample_of_paths(spark, sf):
    return quality.systematic(_meta(spark, sf).select("path", "id"), 5, ["path", "id"])


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority, row_number() OVER (ORDER BY o_orderstatus, o_orderpriority, o_orderkey) - 1 AS place FROM orders")
def places_in_order(spark, sf):
    """A place for each order: three states hold all rows, so the ranges are split by what follows them."""
    return ranks.ranked(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_orderstatus", "o_orderpriority", "o_orderkey"], "place")


#: Documents as texts with a source: one in eight was read by OCR.
_READ = "SELECT doc_id, text, CASE WHEN doc_id % 8 = 0 THEN 'ocr' ELSE 'pdf-text' END AS text_source FROM documents"
_VOCAB = f"d AS ({_READ}), v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{2,}}')) AS word FROM (SELECT text, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS n FROM d WHERE text_source <> 'ocr') WHERE r % greatest(1, n // 400) = 0)"


@query(f"WITH {_VOCAB} SELECT word FROM v")
def vocabulary(spark, sf):
    """Words of a sample of the documents that no OCR has read."""
    return quality.vocabulary(portable(spark, sf, _READ))


@query(f"WITH {_VOCAB.replace('ORDER BY doc_id', 'ORDER BY CAST(doc_id AS VARCHAR)')} SELECT word FROM v")
def vocabulary_by_text_ids(spark, sf):
    """As vocabulary, with ids that are text, as those of files are."""
    return quality.vocabulary(portable(spark, sf, _READ).withColumn("doc_id", F.col("doc_id").cast("string")))


@query(f"{M} SELECT count(*) AS nodes, count(DISTINCT coalesce(nullif(agency_key, ''), agency)) AS agencies, min(reporting_year) AS first_year, max(reporting_year) AS last_year FROM m")
def corpus_stats(spark, sf):
    who = F.coalesce(F.nullif("agency_key", F.lit("")), F.col("agency"))
    return _keyed(spark, sf).agg(F.count("*").alias("nodes"), F.count_distinct(who).alias("agencies"), F.min("reporting_year").alias("first_year"), F.max("reporting_year").alias("last_year"))


@query(f"{M} SELECT id, last_verified, coalesce(date_diff('day', CAST(nullif(last_verified, '') AS DATE), DATE '2025-10-01') > 90, TRUE) AS overdue FROM m")
def freshness(spark, sf):
    return quality.freshness(_meta(spark, sf), "2025-10-01")


@query("SELECT DISTINCT replace(regexp_replace(url, '#.*', ''), 'http://', 'https://') AS url FROM pages")
def url_union(spark, sf):
    """The union of two lists that each hold every page, as listed and in its https form."""
    pages = table(spark, sf, "pages")
    secure = pages.select(F.replace("url", F.lit("http://"), F.lit("https://")).alias("url"))
    return pages.select("url").union(secure).select(text.normalise_url("url").alias("url")).distinct()


@query(SQL["url_union"])
def url_union_all(spark, sf):
    return url_union(spark, sf)


# --- graph ---------------------------------------------------------------

_EDGES = """e AS (SELECT 'cust-' || c_custkey AS "from", CASE WHEN c_custkey % 5 = 0 THEN 'implements' ELSE 'related' END AS type, 'cust-' || (c_custkey * 2) AS "to" FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 13 <> 0
 UNION ALL SELECT 'cust-' || c_custkey, 'references_external', 'ors-' || (c_custkey % 40) FROM customer WHERE c_custkey % 4 = 0 AND c_custkey % 13 <> 0)"""


def _related(spark, sf):
    n = F.col("n")
    some = lambda when, value: F.when(when, F.array(value)).otherwise(F.array().cast("array<string>"))
    twice = F.concat(F.lit("cust-"), (n * 2).cast("string"))
    relations = {
        "implements": some((n % 3 != 0) & (n % 5 == 0), twice),
        "implemented_by": F.lit(None).cast("array<string>"),
        "references_external": some(n % 4 == 0, F.concat(F.lit("ors-"), (n % 40).cast("string"))),
        "related": some((n % 3 != 0) & (n % 5 != 0), twice),
        "supersedes": F.array().cast("array<string>"),
    }
    docs = _keyed(spark, sf).withColumn("relationships", F.struct(*[c.alias(k) for k, c in relations.items()]))
    return docs.withColumn("id", F.when(n % 13 != 0, F.col("id")))


@query(f"WITH {_EDGES} SELECT * FROM e")
def graph_edges(spark, sf):
    return graph.stated_edges(_related(spark, sf))


@query(f"{M} SELECT id, title, doc_type, status, path FROM m WHERE n % 13 <> 0")
def graph_nodes(spark, sf):
    return graph.nodes(_related(spark, sf))


@query(f"""{M}, l AS (SELECT agency_key AS k, CAST(reporting_year AS INT) AS y, max_by(id, path) AS id FROM m WHERE agency_key <> '' AND reporting_year IS NOT NULL GROUP BY ALL)
SELECT a.id AS "from", 'related' AS type, b.id AS "to" FROM l a JOIN l b ON a.k = b.k AND a.y = b.y + 1""")
def consecutive_edges(spark, sf):
    return graph.series_edges(_keyed(spark, sf))


@query(f"{M} SELECT agency_key AS key, reporting_year, count(*) AS documents FROM m WHERE agency_key <> '' AND reporting_year IS NOT NULL GROUP BY ALL HAVING count(*) > 1")
def year_collisions(spark, sf):
    return graph.collisions(_keyed(spark, sf))


@query(f"{M}, {_EDGES} SELECT count(*) AS n_edges_external FROM e WHERE \"to\" NOT IN (SELECT id FROM m WHERE n % 13 <> 0)")
def external_edges(spark, sf):
    docs = _related(spark, sf)
    return graph.external_edges(graph.stated_edges(docs), graph.nodes(docs))


@query(f"""WITH {_EDGES} SELECT 'out' AS direction, type, "to" AS id FROM e WHERE "from" = 'cust-8' UNION ALL SELECT 'in', type, "from" FROM e WHERE "to" = 'cust-8'""")
def graph_neighbors(spark, sf):
    return graph.neighbours(graph.stated_edges(_related(spark, sf)), "cust-8")


@query(SQL["graph_neighbors"].replace("cust-8'", "cust-16'"))
def graph_neighbors_stored(spark, sf):
    """Neighbours from an adjacency that is stored in buckets, of which one is read."""
    path = storage.new_path(spark, "adjacency")
    graph.write_adjacency(graph.stated_edges(_related(spark, sf)), path, 64)
    return graph.stored_neighbours(spark, path, "cust-16")


#: Rings of 100 documents, each related to the next, with a shortcut here and there.
_RING = """
SELECT 'cust-' || CAST(c_custkey AS STRING) AS `from`, 'related' AS type, 'cust-' || CAST(CASE WHEN c_custkey % 100 = 99 THEN c_custkey - 99 ELSE c_custkey + 1 END AS STRING) AS `to` FROM customer
UNION ALL SELECT 'cust-' || CAST(c_custkey AS STRING), 'implements', 'cust-' || CAST(c_custkey + 7 AS STRING) FROM customer WHERE c_custkey % 35 = 0 AND c_custkey % 100 < 92
"""


@query(f"""WITH RECURSIVE e AS ({_RING.replace('`', '"').replace('AS STRING', 'AS VARCHAR')}), r(id, depth) AS (SELECT 'cust-1', 0 UNION SELECT "to", depth + 1 FROM r JOIN e ON "from" = r.id WHERE depth < 150)
SELECT id, min(depth) AS depth FROM r WHERE id <> 'cust-1' GROUP BY id""")
def authority_chain(spark, sf):
    """A ring is a cycle, and deeper than 50 steps."""
    return graph.authority_chain(portable(spark, sf, _RING), "cust-1")


# --- citations and search ------------------------------------------------

_CITING = """
SELECT o_orderkey AS doc_id, 'see ' || CASE o_orderkey % 5 WHEN 0 THEN 'ORS 192.' || CAST(300 + o_orderkey % 90 AS STRING) || ', and ORS' || chr(10) || '238.4' WHEN 1 THEN 'OAR 123-456-' || CAST(1000 + o_orderkey % 70 AS STRING) WHEN 2 THEN 'ORS' || chr(10) || '12A.' || CAST(100 + o_orderkey % 9 AS STRING) WHEN 3 THEN 'oar 123-456-7890' ELSE 'OAR 1-2-3' END || '.' AS text FROM orders
"""
_CITED = "c AS (SELECT o_orderkey AS doc_id, 'ors-section' AS scheme, 'ORS 192.' || (300 + o_orderkey % 90) AS cited, 'ors-192.' || (300 + o_orderkey % 90) AS target FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT o_orderkey, 'ors-section', 'ORS 12A.' || (100 + o_orderkey % 9), 'ors-12A.' || (100 + o_orderkey % 9) FROM orders WHERE o_orderkey % 5 = 2 UNION ALL SELECT o_orderkey, 'oar-rule', 'OAR 123-456-' || (1000 + o_orderkey % 70), 'oar-123-456-' || (1000 + o_orderkey % 70) FROM orders WHERE o_orderkey % 5 = 1)"


def _cited(spark, sf):
    docs = portable(spark, sf, _CITING)
    return citations.found(docs, "ors-section").union(citations.found(docs, "oar-rule"))


@query(f"WITH {_CITED} SELECT * FROM c")
def citation_extract(spark, sf):
    return _cited(spark, sf)


@query(f"WITH {_CITED} SELECT scheme, count(*) AS occurrences, count(DISTINCT doc_id) AS documents, count(DISTINCT target) AS targets FROM c GROUP BY scheme")
def citation_counts(spark, sf):
    return citations.counts(_cited(spark, sf))


@query(f"WITH {_CITED} SELECT DISTINCT target, CASE WHEN target LIKE 'ors-192%' THEN 'resolved' ELSE 'unresolved' END AS state FROM c")
def sibling_resolve(spark, sf):
    found = _cited(spark, sf)
    return citations.sibling_state(found, found.where("target like 'ors-192%'").select(F.col("target").alias("id")))


@query(f"""{M}, k AS (SELECT DISTINCT unnest(list_filter([agency_code, upper(s), upper(substr(s, 1, 24))], lambda x: x IS NOT NULL)) AS key, reporting_year AS year, id FROM (SELECT *, trim(regexp_replace(lower(agency), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM m)),
c AS (SELECT DISTINCT 'APPR ' || coalesce(agency_code, upper(substr(trim(regexp_replace(lower(agency), '[^a-z0-9]+', '-', 'g'), '-'), 1, 24))) || ' ' || reporting_year AS cited FROM m WHERE reporting_year IS NOT NULL)
SELECT cited, coalesce(array_to_string(list_sort(list(DISTINCT id) FILTER (WHERE id IS NOT NULL)), ','), '') AS doc_ids FROM c LEFT JOIN k ON split_part(cited, ' ', 2) = key AND split_part(cited, ' ', 3) = year GROUP BY cited""")
def citation_resolve(spark, sf):
    docs = _meta(spark, sf).withColumnRenamed("id", "doc_id")
    stamped = docs.where("reporting_year is not null").select("doc_id", F.concat(F.lit("cf. "), text.citation("agency_code", "agency", "reporting_year")).alias("text"))
    return citations.resolve(citations.found(stamped, "appr"), docs)


_QUERY = ["license", "que", "reserved"]
_TF = ", ".join(f"CAST(len(list_filter(ts, lambda t: t = '{w}')) AS DOUBLE) AS tf{i}" for i, w in enumerate(sorted(_QUERY)))
_DF = ", ".join(f"count_if(tf{i} > 0) AS df{i}" for i in range(3))
_SCORE = " + ".join(f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * l / mean))" for i in range(3))


@query(f"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS ts FROM documents), c AS (SELECT doc_id, CAST(len(ts) AS DOUBLE) AS l, {_TF} FROM t), s AS (SELECT count(*) AS n, avg(l) AS mean, {_DF} FROM c)
SELECT doc_id, round({_SCORE}, 6) AS score FROM c, s WHERE round({_SCORE}, 6) > 0 ORDER BY score DESC, doc_id LIMIT 20""")
def keyword_search(spark, sf):
    return search.search(spark, _index(spark, sf), " ".join(_QUERY))


def _index(spark, sf):
    """An index of a data directory's documents, in the shared folder: a block of ``storage.scratch`` deletes it."""
    path = storage.new_path(spark, "index")
    search.write_index(table(spark, sf, "documents"), path)
    return path


@query("""WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 7), n AS (SELECT vec_id, unnest(embedding) AS x, unnest((SELECT e FROM q)) AS y FROM embeddings)
SELECT vec_id, round(sum(CAST(x AS DOUBLE) * y) / (sqrt(sum(CAST(x AS DOUBLE) * x)) * sqrt(sum(CAST(y AS DOUBLE) * y))), 6) AS score FROM n GROUP BY vec_id ORDER BY score DESC, vec_id LIMIT 20""")
def vector_search(spark, sf):
    vectors = table(spark, sf, "embeddings")
    asked = vectors.where("vec_id = 7").select("embedding").first()
    if asked is None:
        return search.vector(vectors.limit(0), [0.0])
    return search.search(spark, "", "", vectors, list(asked["embedding"]))


@query("""WITH t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS ts FROM documents), s AS (SELECT count(*) AS n, avg(len(ts)) AS mean FROM t),
p AS (SELECT doc_id, len(ts) AS l, unnest(ts) AS term FROM t), i AS (SELECT doc_id, term, any_value(l) AS l, count(*) AS tf FROM p GROUP BY doc_id, term),
d AS (SELECT term, count(*) AS df FROM i GROUP BY term), q AS (SELECT doc_id AS query_id, term FROM i WHERE doc_id % 50 = 0),
c AS (SELECT query_id, i.doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score FROM q JOIN i USING (term) JOIN d USING (term), s GROUP BY query_id, i.doc_id)
SELECT query_id, doc_id, score FROM c WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 20""")
def keyword_search_all(spark, sf):
    """Documents whose id is divisible by 50 as queries against all documents."""
    docs = table(spark, sf, "documents")
    return search.keyword_all(docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), "text"), _index(spark, sf))


@query("""WITH q AS (SELECT vec_id AS query_id, unnest(embedding) AS y, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE vec_id % 50 = 0), v AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
nq AS (SELECT query_id, sqrt(sum(CAST(y AS DOUBLE) * y)) AS b FROM q GROUP BY query_id), nv AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * x)) AS a FROM v GROUP BY vec_id),
d AS (SELECT query_id, vec_id, sum(CAST(x AS DOUBLE) * y) AS dot FROM q JOIN v USING (i) GROUP BY query_id, vec_id)
SELECT query_id, vec_id, round(dot / (a * b), 6) AS score FROM d JOIN nq USING (query_id) JOIN nv USING (vec_id) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(dot / (a * b), 6) DESC, vec_id) <= 20""")
def vector_search_all(spark, sf):
    """Vectors whose id is divisible by 50 as queries against all vectors."""
    vectors = table(spark, sf, "embeddings")
    return search.vector_all(vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), vectors)


# --- rules ---------------------------------------------------------------

CAVEAT = "the agency's own"
PHRASES = ["two engines", "not proofread", "figures disclosed"]
SENTENCE = "Read by OCR"
RULES = {
    "year_provenance": quality.year_provenance,
    "status": quality.status_domain,
    "caveat": quality.has_caveat(CAVEAT),
    "ocr_declared": quality.ocr_declared(PHRASES, SENTENCE),
    "registry_corpus": quality.linked_corpus("registry"),
    "no_assessment": quality.unassessed,
}
_YEAR = "SELECT id, 'no reporting year' AS problem FROM m WHERE coalesce(reporting_year, '') = '' UNION ALL SELECT id, 'year_source outside its domain' FROM m WHERE coalesce(year_source, '') NOT IN ('document', 'filename', 'filename-scan', 'socrata')"
_STATUS = "SELECT id, 'measure_status outside its domain' AS problem FROM m WHERE measure_status NOT IN ('approved', 'proposed')"
_CAVEAT = "SELECT id, 'caveat missing' AS problem FROM m WHERE NOT contains(body, 'the agency''s own')"
_LINKED = "SELECT id, 'agency_registry_slug without its corpus' AS problem FROM m WHERE agency_registry_slug IS NOT NULL AND coalesce(agency_registry_corpus, '') <> 'registry'"
_OCR = "SELECT id, 'text_source outside its domain' AS problem FROM m WHERE text_source NOT IN ('pdf-text', 'ocr') UNION ALL SELECT id, 'body does not say that OCR read it' FROM m WHERE text_source = 'ocr' AND NOT contains(body, 'Read by OCR') UNION ALL SELECT id, 'notes lack: ' || p FROM m, (VALUES ('two engines'), ('not proofread'), ('figures disclosed')) t(p) WHERE text_source = 'ocr' AND NOT contains(notes, p)"


@query(f"{M} {_YEAR}")
def rule_year_provenance(spark, sf):
    return RULES["year_provenance"](_meta(spark, sf))


@query(f"{M} {_STATUS}")
def rule_status(spark, sf):
    return RULES["status"](_meta(spark, sf))


@query(f"{M} {_CAVEAT}")
def rule_caveat(spark, sf):
    return RULES["caveat"](_meta(spark, sf))


@query(f"{M} {_OCR}")
def rule_ocr_declared(spark, sf):
    return RULES["ocr_declared"](_meta(spark, sf))


@query(f"{M} {_LINKED}")
def rule_registry_corpus(spark, sf):
    return RULES["registry_corpus"](_meta(spark, sf))


@query(f"{M}, {_WALK} SELECT id, 'agency_registry_slug is not the crosswalk''s' AS problem FROM m LEFT JOIN mapping ON m.agency_key = mapping.agency_key WHERE agency_registry_slug IS NOT NULL AND agency_registry_slug IS DISTINCT FROM slug UNION ALL {_LINKED}")
def rule_registry_link(spark, sf):
    return quality.registry_link(_walk(spark, sf)[0], "registry")(_keyed(spark, sf))


@query(f"{M} SELECT id, 'doc_type is not known' AS problem FROM m WHERE doc_type NOT IN ('BUILDING', 'MACHINERY') UNION ALL SELECT id, 'not in the folder of its doc_type' FROM m WHERE doc_type = 'MACHINERY' OR doc_type = 'BUILDING' AND n % 97 <> 5")
def rule_doc_type(spark, sf):
    """Buildings belong in folder 5, and machinery in a folder that nothing is in."""
    return quality.placed_by_type({"BUILDING": "reports/5", "MACHINERY": "elsewhere"})(_meta(spark, sf))


@query(f"""{M}, f AS (SELECT 'year_provenance' AS rule, * FROM ({_YEAR}) UNION ALL SELECT 'status', * FROM ({_STATUS}) UNION ALL SELECT 'caveat', * FROM ({_CAVEAT}) UNION ALL SELECT 'ocr_declared', * FROM ({_OCR}) UNION ALL SELECT 'registry_corpus', * FROM ({_LINKED})),
k AS (SELECT rule, string_agg(p, '|' ORDER BY p) AS first FROM (SELECT rule, id || ': ' || problem AS p, row_number() OVER (PARTITION BY rule ORDER BY id || ': ' || problem) AS k FROM f) WHERE k <= 10 GROUP BY rule)
SELECT rule, count(f.id) AS violations, count(f.id) = 0 AS passed, coalesce(any_value(first), '') AS first FROM (VALUES ('year_provenance'), ('status'), ('caveat'), ('ocr_declared'), ('registry_corpus'), ('no_assessment')) r(rule) LEFT JOIN f USING (rule) LEFT JOIN k USING (rule) GROUP BY rule""")
def rule_summary(spark, sf):
    found = quality.summary(quality.run_rules(_meta(spark, sf), RULES), RULES)
    return found.withColumn("first", F.array_join("first", "|"))


@query(f"{M} SELECT id, 'id is not the file''s name' AS problem FROM m WHERE n % 5 = 0")
def rule_ids(spark, sf):
    """Ids of customers are sound; one in five stands in a file of another name."""
    named = F.when(F.col("n") % 5 == 0, F.concat(F.lit("x-"), F.col("id"))).otherwise(F.col("id"))
    return quality.odd_ids(_meta(spark, sf).withColumn("path", F.concat(F.lit("reports/"), named, F.lit(".md"))))


_SCORED = f"""{_VOCAB}, w AS (SELECT doc_id, text, regexp_extract_all(lower(text), '[a-z]{{2,}}') AS ws FROM documents), k AS (SELECT doc_id, count(v.word) AS known FROM (SELECT doc_id, unnest(ws) AS word FROM w) x LEFT JOIN v USING (word) GROUP BY doc_id),
s AS (SELECT w.doc_id, text, len(ws) AS words, CASE WHEN len(ws) > 0 THEN coalesce(known, 0) / len(ws) ELSE 0 END AS ratio FROM w LEFT JOIN k USING (doc_id))"""
_FIGURES = r"len(regexp_extract_all(lower(text), '\$?-?\p{Nd}[\p{Nd},]*(?:\.\p{Nd}+)?%?'))"
_GLUED = r"len(list_filter(regexp_split_to_array(text, '[^\p{L}\p{N}_]+'), lambda w: regexp_matches(w, '^[A-Za-z]{18,}$')))"


@query(f"WITH {_SCORED} SELECT doc_id, words >= 100 AND ratio >= 0.80 AS gate_ok, round(ratio, 9) AS dict_ratio FROM s")
def ocr_gate(spark, sf):
    docs = portable(spark, sf, _READ)
    return quality.ocr_scores(docs.select("doc_id", F.col("text").alias("primary")), quality.vocabulary(docs)).select("doc_id", "gate_ok", F.round("dict_ratio", 9).alias("dict_ratio"))


@query(f"SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z]{{2,}}')) AS words, {_GLUED} AS glued, {_FIGURES} AS figures FROM documents")
def ocr_counts(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.ocr_scores(docs.select("doc_id", F.col("text").alias("primary")), docs.select(F.lit("x").alias("word")).limit(1)).select("doc_id", "words", "glued", "figures")


@query()
def ocr_agreement(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.agreement(docs.select("doc_id", F.col("text").alias("primary"), F.regexp_replace("text", "the", "tho").alias("cross_check")))


@query()
def figure_agreement(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.figure_agreement(docs.select("doc_id", F.col("text").alias("primary"), F.replace("text", F.lit("0"), F.lit("8")).alias("cross_check")))


@query(f"""WITH {_SCORED}, f AS (SELECT *, {_FIGURES} AS figures, {_GLUED} AS glued, doc_id % 3 = 0 AS one, words >= 100 AND ratio >= 0.80 AND doc_id % 3 = 1 AS good FROM s),
t AS (SELECT *, round_even(ratio * 100, 0) AS pc FROM f)
SELECT doc_id, CASE WHEN one THEN 'second engine unavailable' WHEN good THEN 'promoted' ELSE 'failed the two-engine bar' END AS decision,
 CASE WHEN good THEN 'no text layer in the source PDF; text recovered by OCR. Two independent engines (tesseract (ocrmypdf) + paddleocr PP-OCRv6) agree on 100% of the word sequence and ' || CASE WHEN figures > 0 THEN '100' ELSE '0' END || '% of the ' || figures || ' figures, ' || CAST(pc AS INT)
 || '% dictionary-recognizable' || CASE WHEN glued > 0 THEN '; ' || glued || ' heading/letterhead token(s) lost their word spacing in extraction and are left as-is rather than reconstructed' ELSE '' END || '; NOT human-verified — treat every number as unchecked against the source' END AS note FROM t""")
def ocr_promotion(spark, sf):
    """A third of the texts lack a second reading, a third have the same one, a third an empty one."""
    docs = portable(spark, sf, _READ)
    other = F.when(F.col("doc_id") % 3 == 1, F.col("text")).when(F.col("doc_id") % 3 == 2, F.lit(""))
    return quality.promoted(docs.select("doc_id", F.col("text").alias("primary"), other.alias("cross_check")), quality.vocabulary(docs))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents), n AS (SELECT doc_id, count(*) FILTER (WHERE trim(regexp_replace(x, '[\\s\\x{00A0}]+', ' ', 'g')) <> '') AS c FROM l GROUP BY doc_id)
SELECT doc_id, c AS lines, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE c END AS found, CASE WHEN c > 0 AND doc_id % 3 = 0 THEN 'fail' ELSE 'ok' END AS verdict FROM n""")
def provenance_coverage(spark, sf):
    snapshot = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("text"))
    pairs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"), snapshot.alias("snapshot"))
    return quality.provenance(pairs).select("doc_id", "lines", "found", "verdict")


_KEPT = "count(*) FILTER (WHERE o_orderkey % 4 <> 0)"


@query(f"""WITH g AS (SELECT o_custkey AS doc_id, count(*) AS lines, CASE WHEN o_custkey % 5 = 0 THEN least(1, {_KEPT}) ELSE {_KEPT} END AS found FROM orders GROUP BY o_custkey)
SELECT doc_id, lines, found, round(found / lines, 9) AS coverage, CASE WHEN found / lines < 0.70 THEN 'fail' WHEN found / lines < 0.90 THEN 'warn' ELSE 'ok' END AS verdict FROM g""")
def provenance_in_order(spark, sf):
    """Bodies of a line for each order; snapshots lack some lines, and some have theirs in reverse order."""
    line = F.concat(F.lit("order-"), F.col("o_orderkey").cast("string"), F.lit("."))
    rows = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("line")))).alias("all"))
    kept = F.transform(F.filter("all", lambda x: x["o_orderkey"] % 4 != 0), lambda x: x["line"])
    there = F.when(F.col("doc_id") % 5 == 0, F.reverse(kept)).otherwise(kept)
    pairs = rows.select("doc_id", F.array_join(F.transform("all", lambda x: x["line"]), "\n").alias("body"), F.array_join(there, " \n").alias("snapshot"))
    return quality.provenance(pairs).withColumn("coverage", F.round("coverage", 9))
