import hashlib
from collections import defaultdict

from reportloom.llm import exact


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep if len(ids) > 1 else i, len(ids), i == (keep if len(ids) > 1 else i), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_copies(spark, monkeypatch):
    long = "é" * 300
    rows = [(1, "a"), (5, "a"), (5, "a"), (2, "b"), (3, None), (4, ""), (None, "a"), (None, "z"), (6, long + "x"), (7, long + "y"), (8, long + "x"), (9, long + "x ")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, keep_id int, KEPT string")
    got = sorted((tuple(r) for r in exact.copies(df, digest=True).collect()), key=str)
    assert got == brute(rows)
    for limit in (0, exact.BROADCAST_GROUPS):
        monkeypatch.setattr(exact, "BROADCAST_GROUPS", limit)
        monkeypatch.setattr(exact, "HEAVY", 3 if limit else 1_000)
        assert sorted((tuple(r) for r in exact.copies(df, digest=True).collect()), key=str) == brute(rows)
    lazy = {r.doc_id: r.text_sha256 for r in exact.copies(df).where("doc_id in (2, 7, 8)").collect()}
    assert lazy[2] is None and lazy[8] is not None
    left = exact.deduplicated(df)
    assert sorted((str(r.doc_id), r.text or "") for r in left.collect()) == sorted([("5", "a"), ("2", "b"), ("4", ""), ("None", "z"), ("7", long + "y"), ("8", long + "x"), ("9", long + "x ")])
    assert exact.copies(df.limit(0)).count() == 0


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = exact.copies(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_no_text_crosses_an_exchange(spark, tmp_path):
    """A text is hashed where it is read: what is stored and dealt out afterwards holds digests only."""
    spark.createDataFrame([(i, "t" * (i % 7) * 1_000) for i in range(50)], "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    rows, groups = exact._grouped(spark.read.parquet(f"{tmp_path}/d"), "doc_id", "text", True)
    assert rows.dtypes == [("id", "bigint"), ("met", "boolean"), ("sha", "binary")] and groups.count() == 7
    plan = exact.copies(spark.read.parquet(f"{tmp_path}/d"), digest=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan.replace("text_sha256", "")


def test_copies_with_clashing_columns(spark):
    """Of rows that share id and text one stays, the same whatever the order of the rows."""
    rows = [(1, "a", 7, "x"), (1, "a", 8, "y"), (0, "a", 9, "z"), (2, None, None, None), (3, "", 1, "w"), (4, "b" * 50_000, 1, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, sha__ int, `keep__.of` string")
    one = sorted(map(tuple, exact.deduplicated(df).collect()))
    assert one == sorted(map(tuple, exact.deduplicated(df.orderBy("sha__", ascending=False)).collect()))
    assert [r[0] for r in one] == [1, 3, 4] and exact.deduplicated(df).columns == df.columns
    assert exact.deduplicated(df.limit(0)).count() == 0
