"""Mixing sources to target weights by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, quoted

#: Sources whose rates are broadcast: so many, with names and tables of so many bytes in all, at most.
BROADCAST_SOURCES, BROADCAST_BYTES = 10_000, 32 << 20
SALTS = 16


def uniform(seed: int, *columns: str | Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 digest of the seed and the columns."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, source: str = "source", weights: Mapping[str, float] | None = None, temperature: float = 0.5, total: int | None = None) -> DataFrame:
    """The mean repetition of each source: ``(source, n, rate)``.

    Target shares are ``weights`` over the sources that occur, scaled to 1, or in their absence
    the powers ``n ** temperature`` of the sources' row counts.  A source without a weight has
    rate 0.  ``total`` rows are aimed at (None: as many as there are).  Null is a source of its own,
    named by None in ``weights``.
    """
    counted = docs.groupBy(F.col(quoted(source)).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        if any(not w >= 0 for w in weights.values()):
            raise ValueError("weights must not be negative")
        share = F.lit(0.0)
        for name, w in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(share)
    counted = counted.withColumn("share", share)
    of = counted.agg(F.sum("share").alias("share"), F.sum("n").alias("n")).first()
    aim = float((of["n"] or 0) if total is None else total)
    scale = aim / of["share"] if of["share"] else 0.0
    return counted.select("source", "n", (F.col("share") * F.lit(scale) / F.col("n")).alias("rate"))


def distribution(rate: Column) -> Column:
    """Of a Poisson distribution: the least count worth a look, and the cumulative values from it.

    Values cover 12 standard deviations and more on both sides, so what is left out weighs less
    than the 52 bits of the number that is inverted.  Sums run in logarithms up to the first value.
    """
    rate = F.greatest(rate, F.lit(1e-300))
    first = F.greatest(F.lit(0), F.floor(rate - 12 * F.sqrt(rate) - 10)).cast("int")
    last = (first + F.ceil(24 * F.sqrt(rate)) + 40).cast("int")
    log0 = F.when(first == 0, -rate).otherwise(-rate + first * F.log(rate) - F.aggregate(F.sequence(F.lit(1), F.greatest(first, F.lit(1))), F.lit(0.0), lambda s, k: s + F.log(k.cast("double"))))
    start = F.struct(F.exp(log0).alias("p"), F.array(F.exp(log0)).alias("c"))
    steps = F.sequence(first + 1, last)
    ran = F.aggregate(steps, start, lambda s, k: F.struct((s["p"] * rate / k).alias("p"), F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * rate / k)).alias("c")))
    return F.struct(first.alias("first"), ran["c"].alias("values"))


def mix(docs: DataFrame, id: str = "doc_id", source: str = "source", weights: Mapping[str, float] | None = None, temperature: float = 0.5, total: int | None = None, seed: int = 17, copy: str = "copy") -> DataFrame:
    """``docs`` repeated to the target weights and globally shuffled, with a copy number from 1.

    The count of each row is the inverse of its source's Poisson distribution (see :func:`rates`)
    at a number that the seed and the row's id fix, so a rerun or a repeated task gives the same
    rows.  Rows whose count is 0 are absent: that is the feature.

    * Null sources form one source; null ids draw one number between them, as do rows that repeat
      an id.  Null, empty and long texts pass through unread.
    * A column that clashes with ``copy`` is replaced.  An empty table gives an empty table.

    Plan: a grouped count (combined before the shuffle) gives a table of rates, which is broadcast
    if its measured size is within :data:`BROADCAST_SOURCES` and :data:`BROADCAST_BYTES`; else rows
    and rates meet in a join over :data:`SALTS` salted copies of each source.  Rows are exploded
    and then dealt out once, by a hash of id, copy and seed, and sorted by it in each partition.
    """
    kept = [c for c in docs.columns if c.lower() != copy.lower()]
    table = rates(docs, source, weights, temperature, total)
    names = {x: free_name(docs, x) for x in ("rate__", "of__", "salt__", "key__")}
    table = table.select(F.col("source").alias(names["of__"]), distribution(F.col("rate")).alias(names["rate__"]))
    size = table.agg(F.count("*").alias("n"), F.sum(F.coalesce(F.length(names["of__"]), F.lit(0)) + 8 * F.size(f"{names['rate__']}.values") + 40).alias("b")).first()
    rows = docs.select(*[F.col(quoted(c)) for c in kept])
    if size["n"] <= BROADCAST_SOURCES and (size["b"] or 0) <= BROADCAST_BYTES:
        met = rows.join(F.broadcast(table), F.col(quoted(source)).eqNullSafe(F.col(names["of__"])))
    else:
        s = names["salt__"]
        spread = table.withColumn(s + "_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = rows.withColumn(s, F.pmod(F.xxhash64(quoted(id)), F.lit(SALTS)).cast("int"))
        met = salted.join(spread, F.col(quoted(source)).eqNullSafe(F.col(names["of__"])) & (F.col(s) == F.col(s + "_")))
    u = uniform(seed, quoted(id))
    dist = F.col(names["rate__"])
    count = dist["first"] + F.size(F.filter(dist["values"], lambda c: c <= u))
    many = met.withColumn(names["rate__"], count).where(F.col(names["rate__"]) > 0)
    many = many.select(*[F.col(quoted(c)) for c in kept], F.explode(F.sequence(F.lit(1), F.col(names["rate__"]))).alias(copy))
    key = F.xxhash64(F.lit(seed), F.col(quoted(id)), F.col(quoted(copy)))
    dealt = many.withColumn(names["key__"], key).repartition(F.col(names["key__"]))
    return dealt.sortWithinPartitions(names["key__"]).drop(names["key__"])
