"""Positions of rows in the order of any columns that can be ordered, without ordering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import stored

#: Rows that a range holds, about; and keys that are sampled for each range's end.
RANGE_ROWS, SAMPLED = 200_000, 50
#: Ranges at most; beyond, ranges hold more rows.
RANGES = 4_000


def ranked(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """``df`` with the position of each row, from 0, in the order of some columns; nulls come first.

    Keys may be text, dates, numbers or structs.  Ends of ranges are taken from a sample of the
    keys, chosen by their hash so that a task that runs again chooses alike; a row finds its range
    by bisection; ranges are counted and the counts summed up, and rows are numbered within their
    range.  Rows of equal keys follow a hash of the whole row, which is a second key of the ranges
    too, so a key that very many rows have is split over ranges as others are.

    Rows are written once with their range, which the count and the numbering then agree on.
    """
    key = F.struct(*[F.col(c) for c in order], F.xxhash64(*[_hashable(df, c) for c in df.columns]).alias("tie_"))
    n = df.count()
    ranges = min(RANGES, max(1, -(-n // RANGE_ROWS)))
    keyed = df.withColumn("key_", key)
    if ranges == 1:
        cut = keyed.withColumn("range_", F.lit(0))
    else:
        # about SAMPLED keys for each end: the one row of ends is small, whatever the table's size
        some = F.pmod(F.xxhash64("key_"), F.lit(max(1, n // (ranges * SAMPLED)))) == 0
        keys = keyed.where(some).agg(F.array_sort(F.collect_list("key_")).alias("keys"))
        ends = keys.select(F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("keys", (i * F.size("keys") / ranges).cast("int"))).alias("ends_"))
        ends = stored(ends, "ends")
        cut = keyed.join(F.broadcast(ends)).withColumn("range_", _bisected(F.col("ends_"), F.col("key_"), ranges)).drop("ends_")
    cut = stored(cut, "ranges")
    before = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy("range_").agg(F.count("*").alias("n_")).select("range_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("before_"))
    place = F.row_number().over(Window.partitionBy("range_").orderBy("key_")) - 1 + F.col("before_")
    return cut.join(F.broadcast(sizes), "range_").withColumn(name, place.cast("long")).drop("key_", "range_", "before_")


def _hashable(df: DataFrame, c: str) -> Column:
    return F.to_json(F.struct(F.col(c))) if "map<" in df.schema[c].dataType.simpleString() else F.col(c)


def _bisected(ends: Column, key: Column, ranges: int) -> Column:
    """How many of the sorted ends are less than the key."""
    start = F.struct(F.lit(0).alias("lo"), F.size(ends).alias("hi"))

    def halved(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        less = (s["lo"] < s["hi"]) & (F.get(ends, mid) < key)
        return F.struct(F.when(less, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(less, s["hi"]).otherwise(F.when(s["lo"] < s["hi"], mid).otherwise(s["hi"])).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ranges.bit_length() + 1)), start, halved)["lo"]


def every(df: DataFrame, step: int, order: list[str]) -> DataFrame:
    """Every ``step``-th row in the order of some columns, from the first on."""
    return ranked(df, order, "rank_").where(F.pmod("rank_", F.lit(step)) == 0).select(*df.columns)
