"""All queries of the library outside the training-data operators."""

from __future__ import annotations

from . import base, corpus_queries, report_queries, text_queries  # noqa: F401 (they register)


def queries() -> dict[str, base.Query]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)
