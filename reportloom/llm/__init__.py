"""Training-data operators: tokenising, filtering, deduplication and mixing of document corpora.

Nothing outside this folder imports it.  Every operator takes and returns Spark DataFrames.
"""
