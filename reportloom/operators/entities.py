"""Agencies: one key for the many ways a name is written, and a curated crosswalk to slugs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import matching, text
from ..sources.storage import stored

#: Bases of a mapping, and those that need a note.
BASES = ["exact", "alias", "successor", "manual"]
NOTED = ["alias", "successor", "manual"]
#: Keys or slugs of a block, and characters of a block.
BLOCK, CHARS = 1_000, 1 << 20
#: Slugs that are shown for a least trigram, and odd factors that order trigrams.
SHOWN = 4
MIX = np.array([2 * (0x9E3779B97F4A7C15 * k % (1 << 63)) + 1 for k in range(1, 9)], dtype=np.uint64)


def names_per_key(names: DataFrame, column: str = "agency") -> DataFrame:
    """``(agency_key, names)``: the distinct spellings behind each key, sorted."""
    keyed = names.select(text.entity_key(column).alias("agency_key"), F.col(column).alias("name"))
    return keyed.groupBy("agency_key").agg(F.array_sort(F.collect_set("name")).alias("names"))


def crosswalk_join(docs: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """``docs`` with the slug of their agency's key, null where it is not mapped.

    A slug and a key that documents carry already give way to those found here.  Of several rows of
    one key in the crosswalk the last slug in order counts, so no document is doubled.
    """
    keyed = docs.drop("agency_registry_slug").withColumn("agency_key", text.entity_key("agency"))
    known = crosswalk.groupBy("agency_key").agg(F.max("slug").alias("agency_registry_slug"))
    return keyed.join(known, "agency_key", "left")


def coverage(keys: DataFrame, mapping: DataFrame, unmapped: DataFrame) -> DataFrame:
    """``(agency_key, state)``: keys that no list classifies, and listed keys that no document has."""
    listed = mapping.select("agency_key").union(unmapped.select("agency_key")).distinct()
    missing = keys.join(listed, "agency_key", "left_anti").select("agency_key", F.lit("unclassified").alias("state"))
    stale = listed.join(keys, "agency_key", "left_anti").select("agency_key", F.lit("stale").alias("state"))
    return missing.union(stale)


def crosswalk_problems(keys: DataFrame, mapping: DataFrame, unmapped: DataFrame, registry: DataFrame | None = None, docs: DataFrame | None = None) -> DataFrame:
    """``(agency_key, problem)``: every violation of the crosswalk's rules.

    An entry without a slug is not judged further.  With documents (``id, agency_key,
    agency_registry_slug``), a corpus of which only a part carries its mapped slugs is a problem of
    its own, under a null key.  Without a registry slugs are not looked up.
    """
    say = lambda df, what: df.select("agency_key", F.lit(what).alias("problem"))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    judged = mapping.where(~blank("slug"))
    found = [
        say(mapping.select("agency_key").intersect(unmapped.select("agency_key")), "mapped and unmapped"),
        coverage(keys, mapping, unmapped).select("agency_key", F.col("state").alias("problem")),
        say(mapping.where(blank("slug")), "no slug"),
        say(judged.where(~F.coalesce("basis", F.lit("")).isin(BASES)), "bad basis"),
        say(judged.where(F.col("basis").isin(NOTED) & blank("note")), "needs a note"),
        say(unmapped.where(blank("reason")), "needs a reason"),
    ]
    if registry is not None:
        found.append(say(judged.join(registry.select("slug"), "slug", "left_anti"), "slug not in registry"))
    if docs is not None:
        stamp = F.nullif("agency_registry_slug", F.lit(""))
        wanted = docs.select("agency_key", stamp.alias("stamped")).join(mapping.select("agency_key").distinct(), "agency_key", "left_semi")
        short = wanted.agg(F.count_if(F.col("stamped").isNull()).alias("n")).where("n > 0")
        found.append(short.select(F.lit(None).cast("string").alias("agency_key"), F.concat(F.col("n").cast("string"), F.lit(" mapped document(s) carry no slug")).alias("problem")))
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def stamp_state(docs: DataFrame) -> DataFrame:
    """How many documents should carry a slug, and how many do."""
    return docs.agg(
        F.count_if(F.col("wanted").isNotNull()).alias("want"),
        F.count_if(F.col("wanted").isNotNull() & F.col("stamped").isNotNull()).alias("stamped"),
    )


def drift(docs: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Documents whose stamped slug is not the crosswalk's for their key."""
    met = docs.where(F.col("stamped").isNotNull()).join(crosswalk.select("agency_key", "slug"), "agency_key", "left")
    return met.where(~F.col("stamped").eqNullSafe(F.col("slug"))).select("doc_id", "agency_key", "stamped", "slug")


def suggestions(keys: DataFrame, slugs: DataFrame, cutoff: float = 0.6, counted: bool = False) -> DataFrame:
    """``(agency_key, slug, likeness)``: the nearest slug of each key, if near enough to be of use.

    Likeness is difflib's ratio; of equally near slugs the last in order is taken.  Nulls and empty
    strings are neither keys nor slugs.  The result is exact, and few pairs are compared:

    * a first likeness of each key comes from slugs that share a least trigram with it;
    * what is nearer must have a length that the first likeness allows, so slugs are dealt into
      bands of length and a block of keys visits the bands that its keys allow;
    * of a visited block only slugs are compared whose bounds reach the best likeness so far (see
      ``matching.Held``), the most promising first.

    ``counted`` adds ``compared``, the ratios that were taken for a key, and a row for each key
    (its slug null where none is near).  ``cutoff`` is above 0.  Advice for a person: nothing else
    reads it.
    """
    one = lambda df, c: df.select(F.col(c).cast("string").alias("s")).where("s <> ''").distinct()
    held = stored(one(slugs, "slug"), "slugs")
    firsts = stored(_firsts(one(keys, "agency_key"), held, cutoff), "firsts")

    # a band holds lengths of which the longest is a tenth above the shortest, about
    band = lambda length: F.floor(F.log(length) / math.log(1.1) + 1e-9).cast("int")
    size = F.length("s").cast("double")
    least = F.coalesce("likeness", F.lit(cutoff))
    share = least / (2 - least)
    asked = firsts.withColumns({"least": least, "low": band(F.greatest(size * share - 1e-6, F.lit(1.0))), "high": band(size / share + 1e-6)})
    k = _blocks(asked, ["low", "high"], F.struct("s", "least", "slug")).withColumnRenamed("block", "k")
    s = _blocks(held.withColumn("band", band(size)), ["band"], F.col("s")).withColumnRenamed("block", "b")
    k, s = stored(k, "keys"), stored(s, "slugs")
    visits = k.select("k", F.explode(F.sequence("low", "high")).alias("band")).join(s.select("band", "b"), "band").select("k", "b")

    def best(keys: pd.DataFrame, slugs: pd.DataFrame) -> pd.DataFrame:
        near, found = matching.Held(list(slugs["rows"].iloc[0])), []
        for row in keys["rows"].iloc[0]:
            (likeness, slug), taken = near.best(row["s"], (row["least"], row["slug"] or ""))
            found.append((row["s"], slug or None, likeness if slug else None, taken))
        out = pd.DataFrame(found, columns=["s", "slug", "likeness", "compared"])
        return out.astype({"likeness": "float64", "compared": "int64"})

    # both sides come from one table of visits, so their columns get names of their own
    own = visits.join(k, "k").select("k", "b", "rows").toDF("k1", "b1", "rows").groupBy("k1", "b1")
    near = visits.join(s, "b").select("k", "b", "rows").toDF("k2", "b2", "rows").groupBy("k2", "b2")
    more = own.cogroup(near).applyInPandas(best, "s string, slug string, likeness double, compared long")
    every = firsts.select("s", "slug", "likeness", "compared").union(more)
    nearest = F.max(F.when(F.col("slug").isNotNull(), F.struct("likeness", "slug")))
    top = every.groupBy("s").agg(nearest.alias("b"), F.sum("compared").alias("compared"))
    out = top.select(F.col("s").alias("agency_key"), "b.slug", F.round("b.likeness", 6).alias("likeness"), "compared")
    return out if counted else out.where("slug is not null").drop("compared")


def _blocks(rows: DataFrame, by: list[str], row: Column) -> DataFrame:
    """``(*by, block, rows)``: rows of equal ``by``, in arrays of about :data:`BLOCK` rows or :data:`CHARS` characters."""
    # bands are under 250, so these are few rows
    sizes = rows.groupBy(*by).agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.length("s")) / CHARS)).alias("parts"))
    dealt = rows.join(F.broadcast(sizes), by).withColumn("part", F.pmod(F.xxhash64("s"), F.col("parts")).cast("int"))
    each = dealt.groupBy(*by, "part").agg(F.collect_list(row).alias("rows"))
    return each.withColumn("block", F.concat_ws(" ", *by, "part")).drop("part")


def _firsts(keys: DataFrame, slugs: DataFrame, cutoff: float) -> DataFrame:
    """``(s, slug, likeness, compared)``: each key with the nearest of a few slugs that look like it, null if none is near.

    Of its trigrams each string gives the least under some hashes; a key meets up to :data:`SHOWN`
    slugs of each of its own.  What is missed here costs time later, and no result.
    """

    @F.pandas_udf("array<long>")
    def least(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            c = np.frombuffer(f"  {t} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
            grams = (c[:-2] << np.uint64(42)) ^ (c[1:-1] << np.uint64(21)) ^ c[2:]
            mixed = (grams[None, :] * MIX[:, None]) >> np.uint64(11)
            out.append(mixed.min(axis=1).astype(np.int64))
        return pd.Series(out)

    shown = F.row_number().over(Window.partitionBy("seed", "h").orderBy(F.xxhash64("s"), "s"))
    signed = lambda df: df.select("s", F.posexplode(least("s")).alias("seed", "h"))
    few = signed(slugs).withColumn("n", shown).where(F.col("n") <= SHOWN).select("seed", "h", F.col("s").alias("slug"))
    met = signed(keys).join(few, ["seed", "h"]).groupBy("s").agg(F.collect_set("slug").alias("slugs"))

    @F.pandas_udf("slug string, likeness double, compared long")
    def nearest(key: pd.Series, slugs: pd.Series) -> pd.DataFrame:
        out = []
        for k, near in zip(key, slugs, strict=True):
            (likeness, slug), taken = matching.Held(list(near)).best(k, (cutoff, "")) if near is not None else ((0.0, ""), 0)
            out.append((slug or None, likeness if slug else None, taken))
        return pd.DataFrame(out, columns=["slug", "likeness", "compared"]).astype({"likeness": "float64", "compared": "int64"})

    return keys.join(met, "s", "left").select("s", nearest("s", "slugs").alias("near")).select("s", "near.*")
