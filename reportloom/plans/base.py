"""Registration of queries, and inputs in SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.storage import dealt
from ..sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with DuckDB SQL for the same result if SQL can express it."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def portable(spark: SparkSession, sf_dir: str, sql: str, rendered: str = "") -> DataFrame:
    """Run SQL whose FROM and JOIN name tables of the data directory; texts are rendered from rows of the one ``rendered``."""
    used = set()

    def name(m: re.Match) -> str:
        used.add(m[2])
        return f"{m[1]} {{{m[2]}}}"

    text = re.sub(rf"\b(FROM|JOIN) ({'|'.join(TABLES)})\b", name, sql.replace("{", "{{").replace("}", "}}"))
    return spark.sql(text, **{t: dealt(table(spark, sf_dir, t)) if t == rendered else table(spark, sf_dir, t) for t in used})


#: Documents with the metadata of reports, from customers and nations.
META = """
SELECT 'cust-' || CAST(c_custkey AS STRING) AS id, c_custkey AS n, c_name AS title, c_mktsegment AS doc_type,
       CASE WHEN c_custkey % 13 = 0 THEN 'withdrawn' ELSE 'current' END AS status,
       'reports/' || CAST(c_custkey % 97 AS STRING) || '/' || CAST(c_custkey AS STRING) || '.md' AS path,
       CASE c_custkey % 4 WHEN 0 THEN 'Board of ' || n_name WHEN 1 THEN n_name || ', Board of'
            WHEN 2 THEN 'Department of ' || n_name || ' and the State' ELSE 'Oregon ' || n_name || ' Commission' END AS agency,
       c_nationkey AS nation,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(2014 + c_custkey % 10 AS STRING) END AS reporting_year,
       CASE c_custkey % 7 WHEN 0 THEN 'guess' WHEN 1 THEN NULL WHEN 2 THEN 'filename' ELSE 'document' END AS year_source,
       CASE c_custkey % 9 WHEN 0 THEN 'draft' WHEN 1 THEN 'proposed' ELSE 'approved' END AS measure_status,
       CASE c_custkey % 8 WHEN 0 THEN 'ocr' WHEN 1 THEN 'scan' ELSE 'pdf-text' END AS text_source,
       CASE WHEN c_custkey % 3 = 0 THEN 'Figures are the agency''s own. Read by OCR.' ELSE 'Figures are as stated.' END AS body,
       CASE c_custkey % 16 WHEN 0 THEN 'two engines; not proofread; figures disclosed' ELSE 'two engines' END AS notes,
       CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE '2025-' || CASE c_custkey % 3 WHEN 0 THEN '01' WHEN 1 THEN '06' ELSE '09' END || '-15' END AS last_verified,
       CASE WHEN c_custkey % 6 <> 0 THEN 'nation-' || CAST(c_nationkey AS STRING) END AS agency_registry_slug,
       CASE WHEN c_custkey % 10 = 1 THEN 'elsewhere' WHEN c_custkey % 15 <> 7 THEN 'registry' END AS agency_registry_corpus,
       CASE WHEN c_custkey % 2 = 0 THEN 'C' || CAST(c_nationkey AS STRING) END AS agency_code
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
#: META under DuckDB.
DUCK_META = META.replace("AS STRING", "AS VARCHAR")
#: The key of META's agencies, stated anew: the words of the nation's name in sorted order.
DUCK_KEY = "array_to_string(list_sort(list_filter(string_split(regexp_replace(lower({0}), '[^a-z0-9 ]', ' ', 'g'), ' '), lambda w: w <> '' AND w NOT IN ('department', 'dept', 'of', 'the', 'oregon', 'state', 'board', 'commission', 'office', 'division', 'bureau', 'and', 'their'))), '-')"
