"""Work on rows of small files is dealt out to tasks, whatever the files' bytes or row groups."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from reportloom.operators import graph, quality
from reportloom.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["frontmatter_scan", "frontmatter_forms", "graph_edges_of_files", "report_round_trip"])
def test_front_matter_is_rendered_and_read_in_all_tasks(spark, name):
    df = catalog.queries()[name](spark, SF)
    assert df.rdd.getNumPartitions() == 8
    assert plan(df).count("EvalPython") == 1


def test_folders_do_not_grow_with_small_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(graph, "FOLDERS", 4)
    edges = spark.range(3000).select(F.col("id").cast("string").alias("from"), F.lit("related").alias("type"), (F.col("id") + 1).cast("string").alias("to"))
    graph.write_adjacency(edges, f"{tmp_path}/a", each=10)
    assert len([f for f in os.listdir(f"{tmp_path}/a/rows") if f.startswith("bucket=")]) == 4
    for id in ("0", "17", "3000", "x"):
        want = sorted(map(tuple, graph.neighbours(edges, id).collect()))
        assert sorted(map(tuple, graph.stored_neighbours(spark, f"{tmp_path}/a", id).collect())) == want


def test_equal_readings_do_not_go_to_python(spark, monkeypatch):
    monkeypatch.setattr(quality, "matching", SimpleNamespace(ratio=None))  # a call would fail
    df = spark.createDataFrame([(1, "one two", "One, two"), (2, "", None), (3, "1", "2")], "doc_id int, primary string, cross_check string")
    assert [(r.doc_id, r.agreement) for r in quality.agreement(df).orderBy("doc_id").collect()] == [(1, 1.0), (2, 0.0), (3, 0.0)]
