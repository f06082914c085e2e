"""Exact search for the nearest vectors, which skips what the triangle inequality rules out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import stored

#: Queries that meet a block of vectors at a time, and vectors of a block, about.
QUERIES, VECTORS = 4096, 2048
#: Vectors that centres are fitted on at most, their bytes at most, and centres at most.
SAMPLE, SAMPLE_BYTES, CENTRES = 16_384, 32 << 20, 1_024
#: Vectors for each centre, about, until there are enough centres; smaller blocks cost more than they spare.
CENTRE_ROWS = 256
#: Rounds of fitting, and the width of a ring around a centre in radians.
ROUNDS, RING = 4, 0.2
#: More than the rings of a centre.
RINGS = 64
#: What rounding may add to an angle, and to a score of six places.
SLACK, PLACES = 1e-6, 1e-6


def vector_all(queries: DataFrame, vectors: DataFrame, k: int = 20, counted: bool = False) -> DataFrame:
    """``(query_id, vec_id, score)``: the ``k`` nearest vectors of each query by cosine, ties to the smaller id.

    ``queries`` are ``(query_id, embedding)``, ids 64-bit integers, each query's its own.  Null and zero vectors, and those with a
    component that is null or no finite number, are left out; a query meets vectors of its own
    length.  Scores are rounded to six places.

    Centres are fitted on a bounded sample; every vector belongs to its nearest centre and there to
    a ring of angles.  A query's angle to a vector is no less than its angle to the centre differs
    from the vector's.  So rings are searched first that can be nearest, and then those that can
    reach the ``k``-th best score found: the result is exact whatever the centres are.  Vectors of a
    length that the sample lacks form a ring that is always searched.  Rings travel in blocks of about
    :data:`VECTORS` vectors, and a query once to a block that has rings for it.

    ``counted`` adds ``compared``, the number of vectors that the query was held against.
    """
    centres = fitted(vectors)
    v = stored(_placed(vectors, "vec_id", centres), "vectors")
    q = stored(_placed(queries, "query_id", centres).withColumn("group", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-queries.count() // QUERIES)))).cast("int")), "queries")
    rings = stored(v.groupBy("size", "centre", "ring").agg(F.count("*").alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high")), "rings")
    # at most CENTRES centres, of a few dozen rings each
    known = rings.where("centre >= 0").toPandas()
    homes = stored(_homes(rings, known), "homes")
    v = v.join(homes, ["size", "centre"]).select("id", "e", "centre", "ring", _block(F.pmod(F.xxhash64("id"), "parts")).alias("block"))

    def visits(asked: DataFrame) -> DataFrame:
        """Queries with the blocks that hold a ring they ask for, and the rings there."""
        met = asked.join(homes, ["size", "centre"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return met.groupBy("id", _block(F.col("part")).alias("block")).agg(F.collect_list(F.col("centre") * RINGS + F.col("ring")).alias("rings"))

    def searched(asked: DataFrame) -> DataFrame:
        return stored(_searched(visits(asked).join(q.select("id", "e", "group"), "id"), v, k), "hits")

    lone = q.join(rings.where("centre < 0").select("size", F.lit(-1).alias("c"), F.lit(0).alias("r")), "size").select("id", "size", "c", "r")
    first = stored(_rings(q.select("id", "e", F.lit(None).cast("double").alias("least")), known, centres, k).union(lone), "asked")
    hits = searched(first)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    kth = hits.withColumn("k", place).where(F.col("k") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    # a query with fewer than k hits so far may ask for every ring
    wide = q.select("id", "e").join(kth, "id", "left").select("id", "e", F.coalesce("least", F.lit(-2.0)).alias("least"))
    rest = stored(_rings(wide, known, centres, k).join(first, ["id", "size", "centre", "ring"], "left_anti"), "asked")
    best = hits.union(searched(rest)).withColumn("k", place).where(F.col("k") <= k).select("query_id", "vec_id", "score")
    if not counted:
        return best
    work = first.union(rest).join(rings, ["size", "centre", "ring"]).groupBy(F.col("id").alias("query_id")).agg(F.sum("n").alias("compared"))
    return best.join(work, "query_id")


def _homes(rings: DataFrame, known: pd.DataFrame) -> DataFrame:
    """``(size, centre, home, parts)``: centres of few vectors share a block, one of many has several of its own."""
    rows = []
    for size, each in known.groupby("size"):
        n = each.groupby("centre")["n"].sum()
        for centre, here, before in zip(n.index, n, n.cumsum() - n, strict=True):
            rows.append((int(size), int(centre), f"c{centre}" if here > VECTORS else f"b{before // VECTORS}", int(-(-here // VECTORS))))
    listed = rings.sparkSession.createDataFrame(rows, "size int, centre int, home string, parts int")
    lone = rings.where("centre < 0").select("size", "centre", F.lit("c").alias("home"), F.ceil(F.col("n") / VECTORS).cast("int").alias("parts"))
    return listed.union(lone)


def _block(part: Column) -> Column:
    return F.concat_ws(" ", "size", "home", part.cast("string"))


def fitted(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Unit centres for each length of vector, fitted on at most :data:`SAMPLE` vectors and :data:`SAMPLE_BYTES` bytes.

    The sample is the first vectors in the order of a hash, so it is the same in every run.
    """
    sizes = vectors.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("size")).first()
    if not sizes["n"] or (sizes["size"] or 0) < 1:
        return {}
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * sizes["size"])))
    some = vectors.where(F.size("embedding") > 0).orderBy(F.xxhash64("vec_id"), "vec_id").limit(most)
    unit: dict[int, list[np.ndarray]] = {}
    for row in _sound(some, "vec_id").toLocalIterator():
        unit.setdefault(row["size"], []).append(np.array(row["e"]))
    total = max(1, sum(map(len, unit.values())))
    wanted = min(CENTRES, -(-sizes["n"] // CENTRE_ROWS))
    out = {}
    for size, rows in unit.items():
        e = _unit(np.stack(rows))
        # lengths that the sample hardly holds get no centre, so that there are never more than CENTRES
        if n := min(wanted * len(e) // total, len(e)):
            out[size] = _means(e, n)
    return out


def _means(e: np.ndarray, n: int) -> np.ndarray:
    """``n`` unit vectors near which those of ``e`` lie: each moves to the mean of its own."""
    centres = e[:n]
    for _ in range(ROUNDS):
        own = (e @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, e)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def _sound(df: DataFrame, id: str) -> DataFrame:
    """``(id, size, e)``: vectors that have a direction, their components as they come if they are floats."""
    e = F.col("embedding").cast("array<double>")
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    floats = df.schema["embedding"].dataType.simpleString() == "array<float>"
    rows = df.where(F.col(id).isNotNull() & sound)
    return rows.select(F.col(id).cast("long").alias("id"), F.size("embedding").alias("size"), (F.col("embedding") if floats else e).alias("e"))


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision."""
    rows = rows.astype(np.float64)
    # squares of very large or small components leave the range of doubles
    peak = np.abs(rows).max(axis=1, keepdims=True)
    rows = np.where((peak > 1e-100) & (peak < 1e100), rows, rows / peak)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), sizes


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The places of a batch's vectors of one length, and their unit vectors."""
    flat, sizes = _flat(batch["e"])
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield size, at, _unit(flat[starts[at][:, None] + np.arange(size)])


def _angles(e: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(e @ centres.T, -1.0, 1.0))


def _placed(df: DataFrame, id: str, centres: dict[int, np.ndarray]) -> DataFrame:
    """``(id, e, size, centre, ring, angle)``; centre -1 and ring 0 for a length without centres."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            own, angle = np.full(n, -1), np.zeros(n)
            for size, at, e in _by_size(batch):
                if size in centres:
                    angles = _angles(e, centres[size])
                    own[at] = angles.argmin(axis=1)
                    angle[at] = angles[np.arange(len(at)), own[at]]
            columns = [batch["id"], batch["e"], batch["size"], pa.array(own, pa.int32()), pa.array((angle / RING).astype(np.int32)), pa.array(angle)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "e", "size", "centre", "ring", "angle"])

    sound = _sound(df, id)
    return sound.mapInArrow(place, f"id long, e {sound.schema['e'].dataType.simpleString()}, size int, centre int, ring int, angle double")


def _rings(asked: DataFrame, known: pd.DataFrame, centres: dict[int, np.ndarray], k: int) -> DataFrame:
    """``(id, size, centre, ring)``: the rings that can reach a query's ``least``.

    Where that is null, the nearest rings that hold ``k`` vectors at least, and two at least.
    """
    tables = {int(size): tuple(rows[c].to_numpy() for c in ("centre", "ring", "n", "low", "high")) for size, rows in known.groupby("size")}

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = batch["least"].to_numpy(zero_copy_only=False)
            ids = batch["id"].to_numpy()
            for size, at, e in _by_size(batch):
                if size not in tables:
                    continue
                centre, ring, n, low, high = tables[size]
                angles = _angles(e, centres[size])[:, centre]
                gap = np.maximum(np.maximum(low - angles, angles - high) - SLACK, 0.0)
                for i, row in zip(at, gap, strict=True):
                    if np.isnan(least[i]):
                        near = np.argsort(row, kind="stable")
                        take = near[: max(2, 1 + int(np.searchsorted(np.cumsum(n[near]), k)))]
                    else:
                        take = np.flatnonzero(np.cos(row) + PLACES >= least[i])
                    columns = [np.full(len(take), ids[i]), np.full(len(take), size, np.int32), centre[take].astype(np.int32), ring[take].astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "size", "centre", "ring"])

    return asked.mapInArrow(ask, "id long, size int, centre int, ring int")


def _searched(asked: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """``(query_id, vec_id, score)``: of each query of ``(id, block, rings, e, group)`` the ``k`` best of every block."""
    held = asked.select("group", "block").distinct().join(vectors, "block").select(F.col("group").alias("g"), F.col("block").alias("b"), "id", "e", "centre", "ring")
    none = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    def best(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return none
        matrix = lambda t: _unit(np.stack(t["e"].to_numpy()))
        of, ids, a, b = asked["id"].to_numpy(), held["id"].to_numpy(), matrix(asked), matrix(held)
        cell = held["centre"].to_numpy() * RINGS + held["ring"].to_numpy()
        out = []
        for i, wanted in enumerate(asked["rings"].to_numpy()):
            at = np.flatnonzero(np.isin(cell, wanted))
            score = np.round(b[at] @ a[i], 6)
            top = np.lexsort((ids[at], -score))[:k]
            out.append((np.full(len(top), of[i]), ids[at][top], score[top]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    left = asked.select(F.col("group").alias("g1"), F.col("block").alias("b1"), "id", "e", "rings").groupBy("g1", "b1")
    return left.cogroup(held.groupBy("g", "b")).applyInArrow(best, "query_id long, vec_id long, score double")
