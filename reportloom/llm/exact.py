"""Exact deduplication by progressive refinement, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HEAVY, discarded, free_name, quoted, stored, text_or_empty

#: Characters of a text that its prefix hash covers.
PREFIX = 256
#: Surviving groups of length and prefix hash that are broadcast (12 bytes each), at most.
BROADCAST_GROUPS = 200_000


def copies(docs: DataFrame, id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """For each row ``(id, keep_id, group_size, kept, text_sha256)``.

    Rows are grouped by the length of their text, then by a hash of its first :data:`PREFIX`
    characters, then by the SHA-256 of all of it; each step takes only rows whose group of the step
    before has two or more.  The row with the largest id of equal texts stays.

    * Null texts count as empty, and are copies of each other and of empty ones.
    * Repeated rows count each in ``group_size``; rows that share both id and text are all marked
      as kept (see :func:`deduplicated`, which leaves one).  Null ids never win over others; if a
      group has no other, its rows have a null ``keep_id`` and are kept.
    * ``text_sha256`` of rows without a copy may be null, as their whole text need not be read,
      unless ``digest`` asks for it.  An empty table gives an empty table; other columns are not used.

    No text crosses an exchange.  A scan counts lengths and prefix hashes, combined before their
    shuffle.  A second scan hashes the rows of surviving groups (all rows, if ``digest`` asks for
    that or the groups are too many to broadcast) and stores ids and digests, which are all that
    later steps move.  A group of copies with over one in :data:`HEAVY` of the rows meets its
    result by broadcast: there are fewer such groups than that.
    """
    rows, groups = _grouped(docs, id, text, digest)
    n = rows.count()
    heavy = F.broadcast(groups.where(F.col("size") * HEAVY > n).select(F.col("sha").alias("of"), F.col("keep").alias("keep_"), F.col("size").alias("size_")))
    light = groups.where(F.col("size") * HEAVY <= n).withColumnRenamed("sha", "of")
    out = rows.join(heavy, F.col("sha") == F.col("of"), "left").drop("of")
    # rows that have met their group, and those without one, are dealt out by a digest of their own
    alone = F.md5(F.monotonically_increasing_id().cast("string").cast("binary"))
    out = out.withColumn("by", F.when(F.col("met") & F.col("size_").isNull(), F.col("sha")).otherwise(F.unhex(alone)))
    out = out.join(light, F.col("by") == F.col("of"), "left")
    size = F.coalesce("size_", "size")
    keep = F.when(size.isNull(), F.col("id")).when(F.col("size_").isNotNull(), F.col("keep_")).otherwise(F.col("keep"))
    return out.select(
        F.col("id").alias(id),
        keep.alias("keep_id"),
        F.coalesce(size, F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _grouped(docs: DataFrame, id: str, text: str, digest: bool) -> tuple[DataFrame, DataFrame]:
    """Stored rows ``(id, met, sha)``, and the groups ``(sha, keep, size)`` of two or more."""
    t = text_or_empty(quoted(text))
    length, prefix = F.length(t).alias("n"), F.xxhash64(F.substring(t, 1, PREFIX)).alias("p")
    # a group of length and prefix has two rows only if its length has, so one pass counts both
    survivors = stored(docs.select(length, prefix).groupBy("n", "p").agg(F.count("*").alias("c")).where("c > 1").select("n", "p"), "survivors")
    full = F.unhex(F.sha2(F.col("t").cast("binary"), 256))
    rows = docs.select(F.col(quoted(id)).alias("id"), length, prefix, t.alias("t"))
    if survivors.count() <= BROADCAST_GROUPS:
        rows = rows.join(F.broadcast(survivors.withColumn("met", F.lit(True))), ["n", "p"], "left").withColumn("met", F.col("met").isNotNull())
    else:
        rows = rows.withColumn("met", F.lit(True))
    rows = stored(rows.select("id", "met", (full if digest else F.when(F.col("met"), full)).alias("sha")), "digests")
    discarded(survivors)
    return rows, rows.where("met").groupBy("sha").agg(F.max("id").alias("keep"), F.count("*").alias("size")).where("size > 1")


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each distinct text, all columns kept: that with the largest id.

    Of rows that share text and id that stays whose columns hash lowest.  A null id stays only if
    its text has no other.
    """
    groups = _grouped(docs, id, text, False)[1]
    sha, keep, at = (free_name(docs, x) for x in ("sha__", "keep__", "row__"))
    marked = docs.withColumns({sha: F.unhex(F.sha2(text_or_empty(quoted(text)).cast("binary"), 256)), at: F.xxhash64(F.to_json(F.struct(*[F.col(quoted(c)) for c in docs.columns])))})
    groups = stored(groups.select(F.col("sha").alias(keep + "of"), F.col("keep").alias(keep)), "copies")
    single = marked.join(groups, F.col(sha) == F.col(keep + "of"), "left_anti")
    met = marked.join(groups, (F.col(sha) == F.col(keep + "of")) & F.col(quoted(id)).eqNullSafe(F.col(keep)))
    first = met.groupBy(F.col(sha).alias(keep + "of")).agg(F.min(at).alias(keep))
    left = met.drop(keep, keep + "of").join(first, (F.col(sha) == F.col(keep + "of")) & (F.col(at) == F.col(keep))).select(*[F.col(quoted(c)) for c in marked.columns])
    return single.union(left.dropDuplicates([sha])).drop(sha, at)
