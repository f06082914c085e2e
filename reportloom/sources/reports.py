"""Report texts rendered from order tables, in the layouts that the extraction reads.

A nation's customers, 1,500 to a group, are an agency that reports order counts: a measure for each
priority, a submeasure for each market segment, over the five years up to the reporting year.  Fixed rules on integers restate
values, write ``No Data``, leave cells blank, withhold layouts and vary headings, so that what a
correct reading yields can be stated in SQL over the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .storage import spread, stored
from .tables import table

#: Cells of all reports, in SQL that Spark and DuckDB both run.
CELLS = """
SELECT n.n_nationkey AS n, n.n_name AS name, y.y AS ry, m.k AS k, s.seg AS seg, s.s AS s, p.yr AS yr,
       coalesce(c.c, 0) + CASE WHEN y.y = 2001 AND p.yr = 1998 AND (n.n_nationkey + m.k) % 3 = 0 THEN 1 ELSE 0 END AS c,
       m.k = 2 AND (n.n_nationkey + s.s + p.yr) % 11 = 0 AS blank
FROM (SELECT n_nationkey + 25 * g AS n_nationkey, n_nationkey AS nk, g, n_name || CASE WHEN g = 0 THEN '' ELSE ' ' || CAST(g AS STRING) END AS n_name FROM nation CROSS JOIN (SELECT DISTINCT CAST(floor(c_custkey / 1500) AS INT) AS g FROM customer) gs) n
CROSS JOIN (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS k FROM orders) m
CROSS JOIN (SELECT c_mktsegment AS seg, CAST(row_number() OVER (ORDER BY c_mktsegment) AS INT) AS s FROM (SELECT DISTINCT c_mktsegment FROM customer) q) s
CROSS JOIN (VALUES (1999), (2000), (2001)) y(y)
CROSS JOIN (VALUES (1995), (1996), (1997), (1998), (1999), (2000), (2001)) p(yr)
LEFT JOIN (SELECT c_nationkey, CAST(floor(c_custkey / 1500) AS INT) AS g, CAST(substr(o_orderpriority, 1, 1) AS INT) AS k, c_mktsegment, year(o_orderdate) AS yr, count(*) AS c
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4, 5) c
  ON c.c_nationkey = n.nk AND c.g = n.g AND c.k = m.k AND c.c_mktsegment = s.seg AND c.yr = p.yr
WHERE p.yr BETWEEN y.y - 4 AND y.y AND (m.k <> 5 OR s.s = 1)
"""

#: What a correct reading of the reports yields, in DuckDB SQL.
EXPECTED = f"""
WITH cells AS ({CELLS}),
runs AS (SELECT *, bool_or(blank) OVER (PARTITION BY n, ry, k, s) AS short FROM cells),
named AS (SELECT *, CASE WHEN ry % 2 = 0 THEN name || ', Board of' ELSE 'Board of ' || name END AS agency FROM runs)
SELECT agency, 'rpt-' || n || '-' || ry AS agency_doc, CAST(ry AS VARCHAR) AS reporting_year,
       CASE WHEN n % 5 = 0 THEN 'proposed' ELSE 'approved' END AS measure_status,
       CAST(k AS VARCHAR) AS kpm_number, 'orders of priority ' || k || ' per segment' AS measure_key,
       CASE WHEN k <> 5 THEN seg END AS submeasure, CAST(yr AS VARCHAR) AS "year",
       CASE WHEN c = 0 THEN 'No Data' ELSE CAST(c AS VARCHAR) END AS actual, CAST(2 * c + 10 AS VARCHAR) AS target,
       CASE WHEN k = 4 THEN NULL ELSE 'Jul 01 - Jun 30' END AS data_collection_period
FROM named WHERE NOT blank AND NOT (short AND n % 7 = 0)
"""

_RENDER = f"""
WITH cells AS ({CELLS}),
texts AS (SELECT *, CASE WHEN c = 0 THEN 'No Data' ELSE CAST(c AS STRING) END AS a, CAST(2 * c + 10 AS STRING) AS t FROM cells),
runs AS (SELECT n, name, ry, k, s, seg,
    array_sort(collect_list(struct(yr, CASE WHEN blank THEN '' ELSE a END AS a, t))) AS v FROM texts GROUP BY n, name, ry, k, s, seg),
lines AS (SELECT n, name, ry, k, s, v,
    CASE WHEN k <> 5 THEN concat(seg, '\\n') ELSE '' END AS label,
    transform(v, x -> CAST(x.yr AS STRING)) AS ys, transform(v, x -> x.a) AS av, transform(v, x -> x.t) AS tv FROM runs),
parts AS (SELECT n, name, ry, k, max(ys) AS ys,
    array_join(transform(array_sort(collect_list(struct(s, concat(label,
        CASE WHEN k % 2 = 1 THEN concat('Actual\\n', array_join(filter(av, x -> x <> ''), '\\n'), '\\nTarget\\n', array_join(tv, '\\n'))
             ELSE concat('Actual ', array_join(filter(av, x -> x <> ''), ' '), '\\nTarget ', array_join(tv, ' ')) END) AS x))), p -> p.x), '\\n') AS body,
    array_join(transform(array_sort(collect_list(struct(s, concat(label, rpad('Actual', 20, ' '), array_join(transform(av, x -> lpad(x, 12, ' ')), ''),
        '\\n', rpad('Target', 20, ' '), array_join(transform(tv, x -> lpad(x, 12, ' ')), '')) AS x))), p -> p.x), '\\n') AS grid
    FROM lines GROUP BY n, name, ry, k),
blocks AS (SELECT n, name, ry, k,
    concat(CASE WHEN n % 2 = 0 THEN concat('KPM #', k, '\\nOrders of priority ', k, '\\nper segment') ELSE concat('KPM#', k, ' Orders of priority ', k, '  per segment') END,
        CASE WHEN k = 4 THEN '' ELSE '\\nData Collection Period: Jul 01\\n- Jun 30' END,
        CASE WHEN ry = 2000 THEN '\\nMetric' ELSE '\\nReport Year' END,
        CASE WHEN k % 2 = 1 THEN concat('\\n', array_join(ys, '\\n')) ELSE concat(' ', array_join(ys, ' ')) END,
        CASE WHEN ry = 2000 THEN '\\nMetric Value\\n' ELSE '\\n' END, body, '\\nHow Are We Doing\\nActual results vary.') AS x,
    concat('KPM #', k, '\\n', rpad(CASE WHEN ry = 2000 THEN 'Metric' ELSE 'Report Year' END, 20, ' '), array_join(transform(ys, y -> lpad(y, 12, ' ')), ''), '\\n', grid) AS g
    FROM parts)
SELECT concat('rpt-', n, '-', ry) AS doc_id, max(n) AS n,
    max(CASE WHEN ry % 2 = 0 THEN concat(name, ', Board of') ELSE concat('Board of ', name) END) AS agency,
    CAST(max(ry) AS STRING) AS reporting_year, CASE WHEN max(n) % 5 = 0 THEN 'proposed' ELSE 'approved' END AS measure_status,
    concat('https://reports.example.org/', n, '/', ry, '.pdf') AS source_url,
    concat('Annual Performance Progress Report\\nReporting Year ', ry, '\\n', array_join(transform(array_sort(collect_list(struct(k, x))), p -> p.x), '\\n')) AS text,
    CASE WHEN max(n) % 7 = 0 THEN NULL ELSE array_join(transform(array_sort(collect_list(struct(k, g))), p -> p.g), '\\n') END AS layout
FROM blocks GROUP BY n, ry
"""


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, n, agency, reporting_year, measure_status, source_url, text, layout)``.

    There are three for each nation and group of customers.  They are written to the shared folder,
    as an extraction reads them several times.
    """
    query = _RENDER
    for name in ("nation", "orders", "customer"):
        query = query.replace(f"FROM {name} ", f"FROM {{{name}}} ").replace(f"FROM {name})", f"FROM {{{name}}})").replace(f"JOIN {name} ", f"JOIN {{{name}}} ")
    rendered = spark.sql(query, nation=table(spark, sf_dir, "nation"), orders=table(spark, sf_dir, "orders"), customer=spread(table(spark, sf_dir, "customer")))
    return stored(rendered, "reports")
