"""Toxicity by a classifier chain over word and affix features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discarded, free_name, mapped, quoted, slices, stored, text_or_empty
from .linear import fit_logistic, sigmoid

#: Labelled documents that the chain is fitted on, at most: those whose ids hash lowest.
SAMPLE = 8_000
#: Features of one category, at most, and the labelled documents that must hold one.
FEATURES, LEAST = 200, 5
FOLDS = 5
#: Ridge penalty of the linear models.
PENALTY = 0.1


@dataclass(frozen=True)
class Chain:
    """Linear models in order: each sees the features and the probabilities before it."""

    categories: tuple[str, ...]
    features: dict[str, int]
    weights: tuple[np.ndarray, ...]
    #: Whether the sample had documents on both sides of a category: without, its model knows nothing.
    learnt: tuple[bool, ...]

    def probabilities(self, present: np.ndarray) -> np.ndarray:
        """Category probabilities (document, category) from 0/1 features."""
        out = np.empty((len(present), len(self.categories)))
        for k, w in enumerate(self.weights):
            out[:, k] = sigmoid(np.hstack([present, _logit(out[:, :k])]) @ w[:-1] + w[-1])
        return out


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


#: What words shed at both ends, and the lengths of the beginnings that are features.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
HEADS = (3, 4, 5, 6, 7, 8)


def features_of(text: str) -> set[str]:
    """Distinct words in lower case without punctuation at their ends, and their first 3 to 8 characters.

    The last 2 and 3 characters of words as they stand, punctuation included, are features too.
    """
    out: set[str] = set()
    for w in set(text.lower().split()):
        for k in (2, 3):
            if len(w) > k:
                out.add("-" + w[-k:])
        w = w.strip(PUNCTUATION)
        out.add(w)
        for k in HEADS:
            if len(w) > k:
                out.add(w[:k] + "-")
    out.discard("")
    return out


def fit(docs: DataFrame, labels: DataFrame, categories: Sequence[str], id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Chain:
    """Fit the chain on at most ``sample`` labelled documents.

    Features are chosen by Spark over the sample: for each category those whose presence
    tells most of it, by the likelihood ratio.  Each model's inputs from the chain are out-of-fold predictions:
    a document's probability comes from a model that did not see it, so later models learn how far
    earlier ones can be trusted.  Only the chosen features' 0/1 rows of the sample reach the driver.
    Rows with a null id or label are left out.  Of labels that repeat an id the largest of each
    category counts, and of texts that repeat one that whose hash is smallest, so a rerun fits the
    same chain.
    """
    named = labels.select(F.col(quoted(id)).alias("id"), *[F.col(c).cast("int").alias(f"y{k}") for k, c in enumerate(categories)]).dropna()
    named = named.groupBy("id").agg(*[F.max(f"y{k}").alias(f"y{k}") for k in range(len(categories))])
    chosen = named.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(quoted(id)).alias("id"), text_or_empty(quoted(text)).alias("t"))
    met = texts.join(F.broadcast(chosen), "id").groupBy("id", *[f"y{k}" for k in range(len(categories))]).agg(F.min(F.struct(F.xxhash64("t"), "t")).alias("t"))
    taken = stored(met.select(F.xxhash64("id").alias("mix"), F.col("t.t").alias("t"), *[f"y{k}" for k in range(len(categories))]), "labelled")
    ys = [f"y{k}" for k in range(len(categories))]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            rows, found = [], []
            for at, t in enumerate(batch.column(0).to_pylist()):
                f = features_of(t)
                rows += [at] * len(f)
                found += f
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *[batch.column(1 + k).take(pa.array(rows, pa.int64())) for k in range(len(ys))]], names=["f", *ys])

    seen = taken.select("t", *ys).mapInArrow(listed, "f string, " + ", ".join(f"{y} int" for y in ys))
    counted = stored(seen.groupBy("f").agg(F.count("*").alias("n"), *[F.sum(y).cast("double").alias(y) for y in ys]).where(F.col("n") >= LEAST), "features")
    totals = taken.agg(F.count("*").alias("n"), *[F.sum(y).cast("double").alias(y) for y in ys]).first()
    names: dict[str, int] = {}
    for y in ys:
        yes, no = totals[y] or 0.0, float(totals["n"]) - (totals[y] or 0.0)
        # the likelihood ratio of a feature's presence and the category: what telling it apart is worth
        n, k = F.col("n").cast("double"), F.col(y)
        cells = [(k, n * yes), (n - k, n * no), (yes - k, (yes + no - n) * yes), (no - (n - k), (yes + no - n) * no)]
        worth = sum((F.when(o > 0, o * F.log(o * (yes + no) / e)).otherwise(0.0) for o, e in cells), F.lit(0.0))
        best = counted.select("f", F.round(worth, 6).alias("z")).orderBy(F.desc("z"), "f").limit(FEATURES).collect()
        for r in best:
            names.setdefault(r["f"], len(names))
    sparse = taken.select("mix", "t", *ys).mapInArrow(_present(names, ys), "mix long, at array<int>, " + ", ".join(f"{y} int" for y in ys)).toPandas()
    discarded(taken, counted)
    sparse = sparse.sort_values("mix", kind="stable")
    x = np.zeros((len(sparse), len(names)))
    for i, at in enumerate(sparse["at"]):
        x[i, at] = 1.0
    folds = sparse["mix"].to_numpy(np.int64) % FOLDS
    earlier, weights, learnt = np.empty((len(x), 0)), [], []
    for y in ys:
        target = sparse[y].to_numpy(np.float64)
        inputs = np.hstack([x, _logit(earlier)])
        held_out = np.empty(len(x))
        for k in range(FOLDS):
            w = fit_logistic(inputs[folds != k], target[folds != k], PENALTY)
            held_out[folds == k] = sigmoid(inputs[folds == k] @ w[:-1] + w[-1])
        weights.append(fit_logistic(inputs, target, PENALTY))
        learnt.append(bool(len(target)) and target.min() != target.max())
        earlier = np.hstack([earlier, held_out[:, None]])
    return Chain(tuple(categories), names, tuple(weights), tuple(learnt))


def _hits(text: str, names: dict[str, int]) -> list[int]:
    """Which features a text holds, without building those that no model uses."""
    out = set()
    get = names.get
    bare = set()
    for w in set(text.lower().split()):
        n = len(w)
        if n > 2:
            out.add(get("-" + w[-2:]))
            if n > 3:
                out.add(get("-" + w[-3:]))
        bare.add(w.strip(PUNCTUATION))
    heads = set()
    for w in bare:
        out.add(get(w))
        if len(w) > 3:
            heads.add(w[:9])
    for w in heads:
        for k in HEADS:
            if len(w) <= k:
                break
            out.add(get(w[:k] + "-"))
    out.discard(None)
    return sorted(out)


def _present(names: dict[str, int], ys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = pa.array([_hits(t, names) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), at, *batch.columns[2:]], names=["mix", "at", *ys])

    return run


def score(docs: DataFrame, chain: Chain, text: str = "text", prefix: str = "p_") -> DataFrame:
    """All columns of ``docs`` and ``p_<category>`` for each category, from whole texts.

    Null and empty texts hold no feature: their probabilities are the models' intercepts.  Repeated
    rows score alike, clashing columns are replaced, and an empty table gives an empty table.
    A pass without a shuffle; the models are a few hundred numbers, whatever the input.
    """
    added = [prefix + c for c in chain.categories]
    kept = [c for c in docs.columns if c.lower() not in {a.lower() for a in added}]
    t = free_name(docs, "text__")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros((batch.num_rows, len(chain.features)))
            for i, s in enumerate(batch.column(t).to_pylist()):
                x[i, _hits(s, chain.features)] = 1.0
            p = chain.probabilities(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(p[:, k]) for k in range(len(added))]], names=[*kept, *added])

    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(a, T.DoubleType()) for a in added])
    return mapped(docs.select(*[F.col(quoted(c)) for c in kept], text_or_empty(quoted(text)).alias(t)), scored, schema)


def categories_of(labels: DataFrame) -> DataFrame:
    """The annotated categories in the order of the chain: ``low_quality``, then ``toxic``."""
    return labels.withColumn("low_quality", 1 - F.col("quality"))


#: Order of the chain over the labels table: junk first, since junk is rarely labelled toxic.
CATEGORIES = ("low_quality", "toxic")


def judge(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``p_low_quality``, ``p_toxic`` and ``toxic`` (at ``threshold`` or above).

    Without labelled documents of both kinds nothing is known of toxicity, and no row is toxic.
    Ids may be of any type.  See :func:`fit` for clashing labels and :func:`score` for other rows.
    """
    chain = fit(docs, categories_of(labels), CATEGORIES, id, text)
    scored = score(docs, chain, text)
    kept = [c for c in scored.columns if c.lower() != "toxic"]
    return scored.select(*[F.col(quoted(c)) for c in kept], ((F.col("p_toxic") >= threshold) & F.lit(chain.learnt[-1])).alias("toxic"))
