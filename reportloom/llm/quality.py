"""Document quality by hierarchical empirical Bayes over hosts and paths."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, slices, stored, text_or_empty
from .linear import fit_logistic, sigmoid

#: Labelled documents that the classifier is fitted on, at most: those whose ids hash lowest.
SAMPLE = 8_000
#: Bytes of hosts, paths and their posteriors that are broadcast, at most.
BROADCAST_BYTES = 32 << 20
SALTS = 16
#: Bounds of the prior's weight, in documents.
WEAKEST, STRONGEST = 1.0, 1_000.0
NAMES = ("length", "distinct", "repeated", "word", "upper", "digit", "symbol", "odd_end", "loud_end", "line", "bar")


def shape(text: str) -> list[float]:
    """Numbers that describe the form of a whole text, each of a bounded range."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    counts = Counter(words)
    joined = "".join(words)
    upper = sum(c for w, c in counts.items() if w.isupper() and len(w) > 1)
    odd = sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,;:?!")
    bang = sum(c for w, c in counts.items() if w[-1] in "!?")
    symbol = len(joined) - len(joined.translate(_SYMBOLS))
    digits = len(joined) - len(joined.translate(_DIGITS))
    return [
        min(np.log1p(n), 10.0),
        len(counts) / n,
        max(counts.values()) / n,
        min(len(joined) / n, 30.0),
        upper / n,
        digits / len(joined),
        symbol / len(joined),
        odd / n,
        bang / n,
        min(text.count("\n") / n, 1.0),
        counts.get("|", 0) / n,
    ]


_SYMBOLS = {ord(c): None for c in "!\"#$%&'()*+-/<=>@[\\]^_`{|}~"}
_DIGITS = {ord(c): None for c in "0123456789"}


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def document_scores(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id: str, text: str, sample: int = SAMPLE) -> DataFrame:
    """``(id, host, path, p)``: the classifier's evidence for each document, written once.

    Of labels that repeat an id the largest counts, and of texts that repeat one that whose hash is
    smallest.
    """
    named = labels.where(F.col(quoted(id)).isNotNull() & F.col("quality").isNotNull()).select(F.col(quoted(id)).alias("id"), F.col("quality").cast("double").alias("y"))
    chosen = named.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(quoted(id)).alias("id"), host.alias("host"), path.alias("path"), text_or_empty(quoted(text)).alias("t"))

    def shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = [shape(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(x, pa.list_(pa.float64()))], names=[*batch.schema.names[:-1], "x"])

    kind = dict(rows.dtypes)["id"]
    sampled = rows.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("t"), "t")).alias("t"))
    known = sampled.select(F.xxhash64("id").alias("mix"), "y", "t.t").mapInArrow(shaped, "mix long, y double, x array<double>").toPandas().sort_values("mix", kind="stable")
    x = np.array(known["x"].tolist(), np.float64).reshape(len(known), len(NAMES))
    mean, spread = (x.mean(0), x.std(0) + 1e-9) if len(x) else (np.zeros(len(NAMES)), np.ones(len(NAMES)))
    w = fit_logistic(_terms(x, mean, spread), known["y"].to_numpy(np.float64))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            z = np.array([shape(t) for t in batch.column(3).to_pylist()]).reshape(batch.num_rows, len(NAMES))
            p = sigmoid(_terms(z, mean, spread) @ w[:-1] + w[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(p)], names=["id", "host", "path", "p"])

    return stored(rows.mapInArrow(scored, f"id {kind}, host string, path string, p double"), "quality")


def _terms(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / spread, -6, 6)
    return np.hstack([z, z * z])


def _prior_weight(groups: DataFrame, rate: str, centre: str) -> float:
    """How many documents a prior is worth, by the method of moments over groups.

    What groups' rates scatter beyond what their sizes explain is the scatter of sites; the less
    there is of it, the more a prior weighs.  One row comes back, whatever the number of groups.
    """
    r, c, n = F.col(rate), F.col(centre), F.col("n")
    s = groups.agg(F.sum(n * (r - c) ** 2).alias("between"), F.sum(c * (1 - c)).alias("within"), F.sum(n * c * (1 - c)).alias("scale"), F.sum(n).alias("n")).first()
    if not s["n"] or not s["scale"]:
        return STRONGEST
    excess = (s["between"] - s["within"]) / s["scale"]
    return float(min(STRONGEST, max(WEAKEST, 1.0 / excess - 1.0))) if excess > 0 else STRONGEST


def posteriors(scores: DataFrame) -> DataFrame:
    """``(host, path, p_global, p_host, p_path)``: rates of good documents, shrunk level by level.

    A host's rate is drawn towards the global one and a path's towards its host's, each by the
    prior weight of its level, so a site with few documents says little and one with many speaks
    for itself.  Sums are grouped with combining before each shuffle: a host with a third of all
    rows costs one row from each task.
    """
    paths = stored(scores.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = total["s"] / total["n"] if total["n"] else 0.5
    hosts = hosts.withColumn("rate", F.col("s") / F.col("n")).withColumn("mean", F.lit(float(mean)))
    k = _prior_weight(hosts, "rate", "mean")
    hosts = hosts.select(F.col("host").alias("of"), "mean", ((k * F.col("mean") + F.col("s")) / (k + F.col("n"))).alias("p_host"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("of"))).withColumn("rate", F.col("s") / F.col("n"))
    k = _prior_weight(both, "rate", "p_host")
    return both.select("host", "path", F.col("mean").alias("p_global"), "p_host", ((k * F.col("p_host") + F.col("s")) / (k + F.col("n"))).alias("p_path"))


def judge(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """For each row ``(id, p_document, p_host, p_path, p_quality, kept)``.

    The log odds of a document are those of its classifier, moved by how much the log odds of its
    path's posterior differ from the global ones.  A row is kept at ``threshold`` or above.  Ids may be of any type.

    * Null and empty texts have the form of nothing; the classifier scores them like any other.
    * Null hosts and paths are groups of their own; repeated rows count each and score alike.
    * The result has its own columns only, so none of ``docs`` can clash with it.
    * Without labelled rows every ``p_document`` is one half; an empty table gives an empty table.
    """
    scores = document_scores(docs, labels, host, path, id, text)
    levels = stored(posteriors(scores), "levels").withColumnsRenamed({"host": "of_host", "path": "of_path"})
    same = F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path"))
    size = levels.agg(F.sum(F.coalesce(F.length("of_host"), F.lit(0)) + F.coalesce(F.length("of_path"), F.lit(0)) + 60).alias("b")).first()
    if (size["b"] or 0) <= BROADCAST_BYTES:
        met = scores.join(F.broadcast(levels), same)
    else:
        spread = levels.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = scores.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(spread, same & (F.col("salt") == F.col("of_salt")))
    odds = _logit(F.col("p")) + _logit(F.col("p_path")) - _logit(F.col("p_global"))
    p = 1 / (1 + F.exp(-odds))
    return met.select(F.col("id").alias(id), F.col("p").alias("p_document"), "p_host", "p_path", p.alias("p_quality"), (p >= threshold).alias("kept"))
