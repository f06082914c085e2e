import random
import re

import numpy as np
import pytest

from reportloom.llm import jaccard, queries


def brute(rows, width, percent):
    """Classes by comparing all pairs of texts."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for i, s in enumerate(sets):
        near = {}
        for x in s:
            for j in index.setdefault(x, []):
                near[j] = near.get(j, 0) + 1
            index[x].append(i)
        for j, both in near.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return {k: (len(sets[i]), least[find(i)]) for i, (k, _) in enumerate(rows)}


def edited(rng, words, vocabulary, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at : at + 1] = [[rng.choice(vocabulary)], [], [words[at], rng.choice(vocabulary)]][rng.randrange(3)]
    return words


def made(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(50)]
    texts = []
    for size, group in [(200, 90), (60, 60), (40, 12), (9, 20), (7, 20), (8, 40), (400, 30)]:
        base = [rng.choice(vocabulary) for _ in range(size)]
        for k in range(group):
            texts.append(edited(rng, base, vocabulary, rng.randrange(max(1, size // 40), max(2, size // 12)) if k else 0))
    for _ in range(150):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(5, 80))]
        at = rng.randrange(len(own))
        texts.append(own[:at] + passage + own[at:])
    texts += [[rng.choice(vocabulary) for _ in range(rng.randint(1, 30))] for _ in range(100)] + texts[:5] + [[], ["one"], ["one", "two"], ["one"]]
    rng.shuffle(texts)
    rows = [(i, " ".join(t) if i % 3 else "\t".join(t).upper()) for i, t in enumerate(texts)]
    return [*rows, (len(rows), None), (len(rows) + 1, " \n ")]


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 4, 85), (2, 5, 80), (3, 1, 60)])
def test_classes_equal_brute_force(spark, seed, width, percent):
    rows = made(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_classes(df, width=width, percent=percent).collect()}
    assert got == brute(rows, width, percent)


@pytest.mark.parametrize("texts", [7, 60])
def test_split_clusters_give_the_same(spark, monkeypatch, texts):
    monkeypatch.setattr(jaccard, "CLUSTER_TEXTS", texts)
    monkeypatch.setattr(jaccard, "CLUSTER_SHINGLES", 9000)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    rows = made(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_classes(df, width=4, percent=85).collect()}
    assert got == brute(rows, 4, 85)


def test_a_passage_on_many_pages_joins_nothing(spark):
    """10,000 pages share a passage and no more: sets that only share it never meet in a comparison."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join([f"w{rng.randrange(50_000)}" for _ in range(rng.randint(60, 140))] + passage)) for i in range(10_000)]
    rows += [(20_000 + i, rows[i][1] + " end") for i in range(5)] + [(30_000, "漢" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in jaccard.near_classes(df, width=4, percent=85).collect()}
    assert got == {i: i - 20_000 if 20_000 <= i < 30_000 else i for i, _ in rows}
    sets = jaccard.Sets([jaccard.shingles(t, 4) for _, t in rows[:2_000]], 85, 100)
    assert len(sets.posting) < 200


def test_texts_that_cannot_link_are_not_compared_again(spark, monkeypatch):
    """Of texts of one size a link needs 2 * 85 / 185 of the shingles of each: with fewer shared ones none meets the blocks of its cluster."""
    rng, counts, stored = random.Random(5), {}, jaccard.stored
    base = [f"w{i}" for i in range(103)]
    rows = [(i, " ".join(f"n{i}x{j}" if j in at else w for j, w in enumerate(base))) for i in range(60) for at in [{j + rng.randrange(10) for j in (10, 40, 70)}]]

    def seen(df, name):
        out = stored(df, name)
        counts.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", seen)
    monkeypatch.setattr(jaccard, "CLUSTER_TEXTS", 20)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), width=4, percent=85).collect()}
    assert got == brute(rows, 4, 85) and counts["named"][0] > 50 and counts["supported"] == [0]


def test_queries_tables_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op6_ngram_join(spark, sf).collect()}
    assert got == brute(rows, 4, 85)


def test_edges(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_classes(df).count() == 0
    t = "a b c d e f g h i j"
    rows = [(1, t), (1, t), (2, t), (None, t), (None, None), (5, "A  B\nc d e f g h i j"), (7, "z y"), (7, t + " k l m n o p q")]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect())
    assert got == sorted([("1", 7, "1"), ("1", 7, "1"), ("2", 7, "1"), ("None", 7, "1"), ("None", 0, "None"), ("5", 7, "1"), ("7", 1, "7"), ("7", 14, "7")])
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), width=4)
    assert sorted((str(r.doc_id), r.text) for r in kept.where("doc_id is not null").collect()) == [("1", t), ("7", t + " k l m n o p q"), ("7", "z y")]
    assert kept.where("doc_id is null").count() == 2
    with pytest.raises(TypeError):
        jaccard.near_classes(spark.createDataFrame([("a", t)], "doc_id string, text string"))


def test_keep_one_keeps_other_columns(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(3, t, 1, "x"), (2, t + " end", 2, "y"), (5, "", 3, "z"), (6, None, 4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `keep__` int, `a.b` string")
    assert sorted(map(tuple, jaccard.keep_one(df).collect())) == [rows[1], rows[2], rows[3]]
    again = spark.createDataFrame([*rows, (2, t + " end", 9, "y"), (5, "", 3, "z"), (2, "another text", 0, "w")], df.schema)
    out = [tuple(sorted(map(tuple, jaccard.keep_one(x).collect()), key=str)) for x in (again, again.orderBy("keep__", ascending=False))]
    assert out[0] == out[1] and [r[0] for r in out[0]] == [2, 2, 5, 6] and out[0][1][1] in ("another text", t + " end")
    assert jaccard.keep_one(df.limit(0)).count() == 0 and jaccard.keep_one(df).columns == df.columns


def test_linked_forgets_nothing():
    rng = np.random.default_rng(1)
    base = rng.choice(10**6, 300, replace=False).astype(np.uint64)
    sets = []
    for _ in range(400):
        s = base.copy()
        s[rng.choice(300, rng.integers(0, 30), replace=False)] = rng.choice(10**9, 1)
        sets.append(np.unique(s))
    both = np.array([[len(np.intersect1d(x, y)) for y in sets[:60]] for x in sets[:60]])
    size = np.array([len(x) for x in sets[:60]])
    links = 100 * both >= 85 * (size[:, None] + size - both)
    index = jaccard.Sets(sets[:60], 85, 100)
    for x in range(60):
        assert (np.isin(np.arange(60), index.near(x, np.ones(60, bool))) == links[x]).all()
    a, b = jaccard.Sets(sets, 85, 100).classes(np.arange(400))
    assert set(b) <= set(range(400)) and (b <= a).all()


def test_growing_tables_are_not_broadcast(spark):
    """Files of ids are many times smaller than their rows: their joins are dealt out by the keys whatever the files' size."""
    from reportloom.llm.components import _met

    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, "x y z")], "doc_id long, text string")
    found = jaccard.near_classes(docs, width=4, percent=85)
    assert "SortMergeJoin" in plan(found) and "BroadcastHashJoin" not in plan(found)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 2, 1), (2, 2, 1), (3, 1, 3)]
    rows = spark.createDataFrame([(2, 1), (3, 1)], "u long, v long")
    assert "SortMergeJoin" in plan(_met(rows, spark.createDataFrame([(2, 1, 1), (3, 1, 1)], "u long, m long, c long"), 2))
