import os

import pytest
from pyspark.sql import functions as F

from reportloom.sources import ledger, storage


def words(files):
    """A word count for each document, and its files."""
    rows = files.groupBy("doc_id").agg(F.sum(F.size(F.split("content", " "))).cast("long").alias("n"))
    return {"counts": rows, "paths": files.select("doc_id", F.substring_index("path", "/", -1).alias("name"))}


def put(root, name, content, at=None):
    os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
    with open(f"{root}/{name}", "w") as f:
        f.write(content)
    if at:
        os.utime(f"{root}/{name}", (at, at))


def kept(spark, target, name="counts"):
    return {r.doc_id: r.n for r in ledger.table_of(spark, target, name).collect()}


def test_only_changed_documents_are_built_again(spark, tmp_path):
    root, target = f"{tmp_path}/files", f"{tmp_path}/kept"
    for i in range(60):
        put(root, f"{i % 3}/d{i}.md", "a b", 1_000_000)
    put(root, "d1.txt", "c", 1_000_000)
    put(root, "_skip.md", "x")
    put(root, "CHANGELOG.md", "x")
    go = lambda: ledger.refresh(spark, root, target, words, buckets=8)
    assert go() == ledger.Refreshed(61, 60, 0)
    assert go() == ledger.Refreshed(0, 0, 0)
    put(root, "0/d0.md", "a b c d")
    put(root, "0/d3.md", "a b", 2_000_000)  # touched, not changed
    os.remove(f"{root}/1/d4.md")
    os.remove(f"{root}/d1.txt")
    put(root, "new.md", "x")
    put(root, "empty.md", "")
    assert go() == ledger.Refreshed(3, 3, 1)
    want = {f"d{i}": 2 for i in range(60) if i != 4} | {"d0": 4, "new": 1}
    assert kept(spark, target) == want
    assert ledger.table_of(spark, target, "paths").count() == 60
    again = f"{tmp_path}/again"
    ledger.refresh(spark, root, again, words)
    for name in ("counts", "paths"):
        one, other = (sorted(map(str, ledger.table_of(spark, t, name).collect())) for t in (target, again))
        assert one == other
    assert go() == ledger.Refreshed(0, 0, 0)


def test_a_lost_run_changes_nothing_or_is_finished(spark, tmp_path, monkeypatch):
    root, target = f"{tmp_path}/files", f"{tmp_path}/kept"
    put(root, "a.md", "a")
    put(root, "b.md", "b")
    ledger.refresh(spark, root, target, words, 2)
    put(root, "a.md", "a a a")
    os.remove(f"{root}/b.md")

    def lost(*_):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ledger.refresh(spark, root, target, lost)
    assert kept(spark, target) == {"a": 1, "b": 1}
    put_ = ledger._put
    monkeypatch.setattr(ledger, "_put", lambda s, t: put_(s, t) if not os.path.exists(f"{target}/pending") else lost())
    with pytest.raises(RuntimeError):
        ledger.refresh(spark, root, target, words)
    assert kept(spark, target) == {"a": 1, "b": 1} and os.path.exists(f"{target}/pending/ledger/_SUCCESS")
    monkeypatch.setattr(ledger, "_put", put_)
    assert ledger.refresh(spark, root, target, words) == ledger.Refreshed(0, 0, 0)
    assert kept(spark, target) == {"a": 3} and not os.path.exists(f"{target}/pending")


def test_empty_folders_and_odd_bytes(spark, tmp_path):
    root, target = f"{tmp_path}/files", f"{tmp_path}/kept"
    os.makedirs(root)
    assert ledger.refresh(spark, root, target, words) == ledger.Refreshed(0, 0, 0)
    with open(f"{root}/x y%20é.md", "wb") as f:
        f.write(b"a \xff b")
    put(root, "long.md", "w " * 300_000)
    assert ledger.refresh(spark, root, target, words) == ledger.Refreshed(2, 2, 0)
    assert kept(spark, target) == {"x y%20é": 3, "long": 300_001}
    for name in os.listdir(root):
        os.remove(f"{root}/{name}")
    assert ledger.refresh(spark, root, target, words) == ledger.Refreshed(0, 0, 2)
    assert kept(spark, target) == {}
    with pytest.raises(ValueError):
        put(root, "a.md", "a")
        ledger.refresh(spark, root, target, lambda f: {"ledger": f})


def test_files_are_listed_many_in_a_task(spark, tmp_path):
    """A listing opens no file, so its tasks are as few as the session's cores; the rows are those of Spark's own listing."""
    for i in range(200):
        (tmp_path / f"d{i}.md").write_text(f"text {i}")
    (tmp_path / "_no.md").write_text("x")
    with storage.scratch(spark):
        now = ledger.listed(spark, str(tmp_path))
        assert len(now.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism
        assert {(r.doc_id, r.length) for r in now.collect()} == {(f"d{i}", len(f"text {i}")) for i in range(200)}
        assert {r.doc_id: r.content for r in ledger.contents(now).collect()} == {f"d{i}": f"text {i}" for i in range(200)}
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(1 << 20)
