import random

import numpy as np
from pyspark.sql import functions as F

from reportloom.llm import linear, quality, queries, toxicity
from reportloom.llm.common import read_table

SF = "/root/testdata/sf0.1"


def test_fit_recovers_weights():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    y = (rng.random(4000) < linear.sigmoid(x @ [2.0, -1.0, 0.0] + 0.5)).astype(float)
    assert np.allclose(linear.fit_logistic(x, y, l2=1e-6), [2.0, -1.0, 0.0, 0.5], atol=0.25)
    one = linear.fit_logistic(x, np.ones(4000))
    assert (one[:3] == 0).all() and one[3] > 5


def test_toxicity_on_held_out_documents(spark):
    """A tenth of these labels is at odds with the words of the texts."""
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    chain = toxicity.fit(docs, toxicity.categories_of(labels), toxicity.CATEGORIES, sample=2_000)
    assert chain.categories == ("low_quality", "toxic") and len(chain.weights[1]) == len(chain.features) + 2
    used = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2_000).select("doc_id")
    held = docs.join(labels, "doc_id").join(used, "doc_id", "left_anti")
    rows = toxicity.score(held, chain).select("toxic", "quality", "p_toxic", "p_low_quality").toPandas()
    toxic, called = rows["toxic"] == 1, rows["p_toxic"] >= 0.5
    hits, misses, alarms = int((toxic & called).sum()), int((toxic & ~called).sum()), int((~toxic & called).sum())
    assert misses <= 0.2 * toxic.sum() and alarms <= 0.01 * (~toxic).sum(), (hits, misses, alarms)


def test_quality_on_all_labels(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    out = quality.judge(docs, labels, F.col("source"), F.col("lang")).join(labels, "doc_id").select("quality", "kept").toPandas()
    good = out["quality"] == 1
    assert (good & out["kept"]).sum() >= 0.99 * good.sum() and (~good & ~out["kept"]).sum() >= 0.95 * (~good).sum()


def test_shrinkage(spark):
    rows = [(i, "large", "p", 0.9) for i in range(400)] + [(i, "large", "bad", 0.1) for i in range(400)] + [(1, "tiny", "q", 0.0), (2, None, None, 0.9)] + [(i, "low", "r", 0.1) for i in range(300)]
    scores = spark.createDataFrame(rows, "id long, host string, path string, p double")
    got = {(r.host, r.path): r for r in quality.posteriors(scores).collect()}
    assert abs(got["large", "p"].p_path - 0.9) < 0.05 and abs(got["large", "bad"].p_path - 0.1) < 0.05
    overall = got["tiny", "q"].p_global
    assert 0.1 * overall < got["tiny", "q"].p_path < overall and len(got) == 5


def plain_fit(x, y, l2):
    """Ridge logistic regression by plain Newton steps with halving: none of the library's code."""
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    if len(y) == 0 or y.min() == y.max():
        return np.r_[np.zeros(x.shape[1]), np.log(rate / (1 - rate))]
    x1 = np.c_[x, np.ones(len(x))]
    ridge = np.r_[np.full(x.shape[1], l2), 1e-9]
    loss = lambda w: np.logaddexp(0, np.where(y == 1, -1, 1) * (x1 @ w)).sum() + (ridge * w * w).sum() / 2
    w = np.zeros(x1.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-(x1 @ w)))
        step = np.linalg.solve(x1.T @ (x1 * (p * (1 - p))[:, None]) + np.diag(ridge), x1.T @ (p - y) + ridge * w)
        size = 1.0
        while size > 1e-9 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-10:
            break
    return w


def plain_words(text):
    out = set()
    for w in text.lower().split():
        out |= {"-" + w[-k:] for k in (2, 3) if len(w) > k}
        bare = w.strip(toxicity.PUNCTUATION)
        out |= {bare} | {bare[:k] + "-" for k in (3, 4, 5, 6, 7, 8) if len(bare) > k}
    return out - {""}


def small():
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(160):
        bad, junk = i % 4 == 0, i % 5 == 0
        words = [rng.choice(["river", "stone", "garden", "winter", "paper"]) for _ in range(rng.randint(3, 9))] + ["nasty"] * (bad and rng.random() < 0.9) + ["zzz!!"] * (junk and rng.random() < 0.9)
        rng.shuffle(words)
        rows.append((f"id{i}", " ".join(words)))
        labels.append((f"id{i}", int(not junk), int(bad)))
    return rows, labels


def test_chain_equals_a_plain_refit(spark):
    """Features, out-of-fold inputs and the chain, built again without Spark; ids are strings here."""
    rows, labels = small()
    docs, marks = spark.createDataFrame(rows, "doc_id string, text string"), spark.createDataFrame(labels, "doc_id string, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.judge(docs, marks).collect()}
    mix = {r.doc_id: r.m for r in docs.select("doc_id", F.xxhash64("doc_id").alias("m")).collect()}
    order = sorted(range(len(rows)), key=lambda i: mix[rows[i][0]])
    held = [plain_words(rows[i][1]) for i in order]
    ys = [np.array([1 - labels[i][1] for i in order], float), np.array([labels[i][2] for i in order], float)]
    names = []
    for y in ys:
        worth = {}
        for f in set().union(*held):
            has = np.array([f in h for h in held])
            if has.sum() >= toxicity.LEAST:
                z = 0.0
                for a in (has, ~has):
                    for b in (y == 1, y == 0):
                        o = float((a & b).sum())
                        z += o * np.log(o * len(y) / (a.sum() * b.sum())) if o else 0.0
                worth[f] = round(z, 6)
        best = sorted(worth, key=lambda f: (-worth[f], f))[: toxicity.FEATURES]
        names += [f for f in best if f not in names]
    x = np.array([[float(f in h) for f in names] for h in held])
    folds = np.array([mix[rows[i][0]] % toxicity.FOLDS for i in order])
    logit = lambda p: np.log(np.clip(p, 1e-3, 1 - 1e-3) / (1 - np.clip(p, 1e-3, 1 - 1e-3)))
    earlier, final = np.empty((len(x), 0)), np.empty((len(x), 0))
    for y in ys:
        inputs, cross = np.c_[x, logit(earlier)], np.empty(len(x))
        for k in range(toxicity.FOLDS):
            w = plain_fit(inputs[folds != k], y[folds != k], toxicity.PENALTY)
            cross[folds == k] = 1 / (1 + np.exp(-(inputs[folds == k] @ w[:-1] + w[-1])))
        w = plain_fit(inputs, y, toxicity.PENALTY)
        final = np.c_[final, 1 / (1 + np.exp(-(np.c_[x, logit(final)] @ w[:-1] + w[-1])))]
        earlier = np.c_[earlier, cross]
    got = np.array([[out[rows[i][0]].p_low_quality, out[rows[i][0]].p_toxic] for i in order])
    assert np.abs(got - final).max() < 1e-5
    assert [out[rows[i][0]].toxic for i in order] == (final[:, 1] >= 0.5).tolist()


def test_quality_equals_a_plain_refit(spark):
    """Classifier, prior weights and shrinkage, built again without Spark."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "DELTA", "x9", "!!", "|"]) for _ in range(rng.randint(1, 40))), f"h{i % 7}" if i % 11 else None, f"p{i % 3}") for i in range(240)]
    labels = [(i, int(len(rows[i][1]) % 3 > 0), 0) for i in range(0, 240, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = {r.doc_id: r for r in quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.col("source"), F.col("lang")).collect()}
    x = np.array([quality.shape(t) for _, t, _, _ in rows])
    seen, y = [i for i, _, _ in labels], np.array([q for _, q, _ in labels], float)
    z = np.clip((x - x[seen].mean(0)) / (x[seen].std(0) + 1e-9), -6, 6)
    z = np.c_[z, z * z]
    w = plain_fit(z[seen], y, 1.0)
    p = 1 / (1 + np.exp(-(z @ w[:-1] + w[-1])))
    assert max(abs(out[i].p_document - p[i]) for i in range(240)) < 1e-5

    def grouped(key):
        sums = {}
        for i, r in enumerate(rows):
            n, s = sums.get(key(r), (0, 0.0))
            sums[key(r)] = n + 1, s + p[i]
        return sums

    def weight(groups, centre):
        between = sum(n * (s / n - centre(k)) ** 2 for k, (n, s) in groups.items())
        within = sum(centre(k) * (1 - centre(k)) for k in groups)
        scale = sum(n * centre(k) * (1 - centre(k)) for k, (n, _) in groups.items())
        excess = (between - within) / scale
        return min(quality.STRONGEST, max(quality.WEAKEST, 1 / excess - 1)) if excess > 0 else quality.STRONGEST

    mean, hosts, paths = p.mean(), grouped(lambda r: r[2]), grouped(lambda r: (r[2], r[3]))
    k = weight(hosts, lambda _: mean)
    host = {h: (k * mean + s) / (k + n) for h, (n, s) in hosts.items()}
    k = weight(paths, lambda x: host[x[0]])
    path = {x: (k * host[x[0]] + s) / (k + n) for x, (n, s) in paths.items()}
    logit = lambda v: np.log(v / (1 - v))
    for i, r in enumerate(rows):
        q = 1 / (1 + np.exp(-(logit(np.clip(p[i], 1e-6, 1 - 1e-6)) + logit(path[r[2], r[3]]) - logit(mean))))
        assert abs(out[i].p_host - host[r[2]]) < 1e-6 and abs(out[i].p_path - path[r[2], r[3]]) < 1e-6 and abs(out[i].p_quality - q) < 1e-5 and out[i].kept == (q >= 0.5)


def test_nothing_is_toxic_without_labels_of_both_kinds(spark):
    rows, labels = small()
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    marks = spark.createDataFrame(labels, "doc_id string, quality int, toxic int")
    for some in (marks.limit(0), marks.where("toxic = 1"), marks.where("toxic = 0"), marks.withColumn("toxic", F.lit(None).cast("int"))):
        assert toxicity.judge(docs, some).where("toxic is null or toxic").count() == 0


def test_clashing_labels_have_one_outcome(spark):
    rows, labels = small()
    docs = spark.createDataFrame([*rows, ("id0", "another text"), ("id0", rows[0][1])], "doc_id string, text string")
    twice = spark.createDataFrame([*labels, ("id0", 0, 0), ("id4", 1, 0), ("id3", 0, 1)], "doc_id string, quality int, toxic int")
    ways = [sorted(map(tuple, toxicity.judge(d, m).select("doc_id", "text", "p_toxic").collect())) for d, m in ((docs, twice), (docs.orderBy("text"), twice.orderBy(F.desc("toxic"), "quality")))]
    assert ways[0] == ways[1]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", None, "x"), (2, None, "h", None), (3, "", "h", "x"), (3, "", "h", "x"), (None, "w " * 60_000, "h", "x")], "doc_id long, text string, source string, lang string")
    clash = docs.withColumns({"p_document": F.lit("old"), "kept": F.lit("old"), "a.b": F.lit(1)})
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 0), (3, 1, 1), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        t = toxicity.judge(docs.withColumn("P_Toxic", F.lit("old")), some)
        assert t.columns == ["doc_id", "text", "source", "lang", "p_low_quality", "p_toxic", "toxic"] and t.where("not toxic").count() == 5
        assert quality.judge(clash, some, F.col("source"), F.col("lang")).where("kept").count() >= 0
        q = quality.judge(docs, some, F.col("source"), F.col("lang"))
        assert q.count() == 5 and q.where("p_quality is null or kept is null").count() == 0
    assert toxicity.judge(docs.limit(0), labels).count() == 0 and quality.judge(docs.limit(0), labels, F.col("source"), F.col("lang")).count() == 0


def test_queries_cover_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    n = read_table(spark, sf, "documents").count()
    assert queries.op2_toxicity(spark, sf).count() == n and queries.op4_quality(spark, sf).count() == n
