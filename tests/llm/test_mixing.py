import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from reportloom.llm import mixing


def poisson_count(rate, u):
    p = math.exp(-rate)
    k, c = 0, p
    while c <= u and k < 10_000:
        k += 1
        p *= rate / k
        c += p
    return k


def test_counts_invert_the_distribution(spark, monkeypatch):
    rows = [(i, f"t{i}", "big" if i % 3 else "small") for i in range(900)] + [(None, None, None), (None, "", None), (7, "again", "big")]
    df = spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, source string, COPY string")
    weights = {"big": 1.0, "small": 3.0, None: 0.01, "absent": 9.0}
    n = Counter(s for _, _, s in rows)
    total = sum(weights[s] for s in n)
    want = Counter()
    for i, t, s in rows:
        u = int(hashlib.md5(f"17:{'' if i is None else i}".encode()).hexdigest()[:13], 16) / 2**52
        for k in range(poisson_count(weights[s] / total * len(rows) / n[s], u)):
            want[(i, t, s, k + 1)] += 1
    for limit in (mixing.BROADCAST_SOURCES, 0):
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", limit)
        out = mixing.mix(df, weights=weights)
        assert out.columns == ["doc_id", "text", "source", "copy"]
        assert Counter(tuple(r) for r in out.collect()) == want
    assert mixing.mix(df.limit(0)).count() == 0


def test_shares_meet_their_targets(spark):
    df = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 8, "a").otherwise("b").alias("source"))
    got = {r.source: r["count"] for r in mixing.mix(df, weights={"a": 1.0, "b": 1.0}).groupBy("source").count().collect()}
    assert abs(got["a"] - 30_000) < 1_000 and abs(got["b"] - 30_000) < 1_000
    ids = [r.doc_id for r in mixing.mix(df).limit(200).collect()]
    assert sum(a < b for a, b in zip(ids, ids[1:], strict=False)) in range(70, 130)


def test_large_rates(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (40.0,), (900.0,), (20_000.0,)], "r double")
    for row in df.select("r", mixing.distribution(F.col("r")).alias("d")).collect():
        first, values = row.d["first"], row.d["values"]
        assert abs(values[-1] - 1) < 1e-6 and (first == 0 or values[0] < 1e-9)
        middle = first + sum(c <= 0.5 for c in values)
        assert abs(middle - row.r) <= 1


def test_rate_and_no_python(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, source string")
    rates = {r.source: r.rate for r in mixing.rates(df, weights={"a": 1.0, "b": 1.0}, total=8).collect()}
    assert rates == {"a": 2.0, "b": 4.0}
    plan = mixing.mix(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
