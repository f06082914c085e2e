import numpy as np
import pytest
from pyspark.sql import functions as F

from reportloom.llm import embeddings, queries


def brute(ids, vectors, threshold=0.95):
    good = [i for i, v in enumerate(vectors) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(ids))}
    for i in good:
        for j in good:
            if i < j and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], np.float64), np.array(vectors[j], np.float64)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    label = list(ids)
    for _ in ids:
        label = [min([label[i], *(label[j] for j in links[i])]) for i in range(len(ids))]
    return sorted((ids[i], len(links[i]), label[i], ids[i] == label[i]) for i in range(len(ids)))


def rows_of(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


@pytest.mark.parametrize("joined", [1, 2])
def test_groups_and_odd_vectors(spark, joined, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 40)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 24)).astype(np.float32)
    v = [*base, *(base[0] + 0.02 * rng.normal(size=(90, 24))).astype(np.float32), *base[:5], *base[:5], *(base[9] * 3.0).astype(np.float32)[None]]
    v = [[float(np.float32(x)) for x in row] for row in v]
    v += [None, [], [0.0] * 24, [None] * 24, [float("nan")] * 24, [float("inf"), *[0.0] * 23], [1.0, 2.0], [2.0, 4.0], [1.0]]
    ids = [int(x) for x in rng.permutation(len(v))]
    df = spark.createDataFrame(list(zip(ids, v, strict=True)), "vec_id long, embedding array<float>")
    assert rows_of(embeddings.near_vectors(df, joined=joined)) == brute(ids, v)


def test_query_recall_is_measured(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    truth = int(((x @ x.T >= 0.95).sum() - len(x)) // 1)
    got = queries.op10_embedding_dedup(spark, sf).agg({"n_links": "sum"}).first()[0]
    assert truth * 0.98 <= got <= truth


@pytest.mark.parametrize("joined", [1, 2, 3])
def test_recall_at_the_threshold(joined):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = rng.normal(size=x.shape)
    g -= (g * x).sum(1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * g / np.linalg.norm(g, axis=1, keepdims=True)
    h = embeddings.Hasher(64, *embeddings.plan_of(10**5, 64, joined), 29)
    a, b = h.buckets(x), h.buckets(y)
    assert ((a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)).any(1).mean() > 0.97


def test_other_columns_and_repeated_rows(spark):
    rows = [(1, [1.0, 0.0], 5, "x"), (1, [1.0, 0.0], 6, "y"), (2, [1.0, 0.01], 7, None), (None, [0.0, 1.0], 8, "z"), (4, [0.0, 1.0], 9, "z"), (5, [3e38, 3e38], 1, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int, `component_id` string")
    got = sorted(((str(r.vec_id), r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()), key=str)
    assert got == [("1", 2, 1), ("1", 2, 1), ("2", 2, 1), ("4", 1, 4), ("5", 0, 5), ("None", 1, 4)]
    doubles = df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    assert sorted((str(r.vec_id), r.n_links) for r in embeddings.near_vectors(doubles).collect()) == [(a, b) for a, b, _ in got]
    with pytest.raises(TypeError):
        embeddings.near_vectors(df.withColumn("vec_id", F.lit("a")))


def test_transform_and_empty(spark):
    eye = embeddings.hadamard(np.eye(8))
    assert np.allclose(eye @ eye.T, np.eye(8))
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
