"""Documents as a graph: nodes, stated relations, and a chain of reports over the years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import bucketed, discarded, spread, stored

#: Relations that a document states.
RELATIONS = ["implements", "implemented_by", "references_external", "related", "supersedes"]
#: Steps in one round of a walk, and rounds after which the nodes seen are one table again.
HOPS, COMPACT = 8, 12
#: Rows of a stored bucket, about, files or buckets that a hub's edges are spread over, and buckets that Spark takes at most.
EACH, SPREAD, MOST = 100_000, 16, 100_000
#: Buckets that smaller ones are joined into where they would be more; larger tables have one for each :data:`EACH` rows.
FOLDERS = 256


def nodes(docs: DataFrame) -> DataFrame:
    """Documents that have an id."""
    return docs.where(F.coalesce("id", F.lit("")) != "").select("id", "title", "doc_type", "status", "path")


def stated_edges(docs: DataFrame) -> DataFrame:
    """``(from, type, to)`` for each relation that a document lists."""
    rows = docs.where(F.coalesce("id", F.lit("")) != "")
    named = F.array(*[F.struct(F.lit(r).alias("type"), F.col(f"relationships.{r}").alias("ends")) for r in RELATIONS])
    each = rows.select(F.col("id").alias("from"), F.explode(named).alias("r"))
    return each.select("from", F.col("r.type").alias("type"), F.explode("r.ends").alias("to"))


def all_edges(docs: DataFrame) -> DataFrame:
    """Edges that documents state, if they have ``relationships``, and those of the chain of years."""
    chain = series_edges(docs)
    return stated_edges(docs).union(chain) if "relationships" in docs.columns else chain


def overview(docs: DataFrame) -> DataFrame:
    """One row: how many documents, agencies and edges, and the first and last reporting year."""
    who = [F.nullif(c, F.lit("")) for c in ("agency_key", "agency") if c in docs.columns]
    year = F.col("reporting_year") if "reporting_year" in docs.columns else F.lit(None).cast("string")
    agencies = F.count_distinct(F.coalesce(*who)) if who else F.lit(0)
    counts = docs.agg(F.count("*").alias("documents"), agencies.alias("agencies"), F.min(year).alias("first_year"), F.max(year).alias("last_year"))
    linked = {"agency_key", "reporting_year"} <= set(docs.columns)
    # one row each
    return counts.join(F.broadcast(all_edges(docs).agg(F.count("*").alias("edges")))) if linked else counts


def series_edges(docs: DataFrame, key: str = "agency_key") -> DataFrame:
    """An edge from each report to its agency's report of the year before, where there is one.

    The agency is ``key``, or its stated name where there is none.  Years that are no number link
    nothing.  Of two reports of one agency and year the one with the last path counts.
    """
    rows = _by_agency(docs, key)
    last = rows.groupBy("key", "year").agg(F.max_by("id", "path").alias("id"))
    before = last.select("key", (F.col("year") + 1).alias("year"), F.col("id").alias("to"))
    return last.join(before, ["key", "year"]).select(F.col("id").alias("from"), F.lit("related").alias("type"), "to")


def _by_agency(docs: DataFrame, key: str) -> DataFrame:
    who = F.nullif(F.col(key), F.lit(""))
    who = F.coalesce(who, F.nullif("agency", F.lit(""))) if "agency" in docs.columns else who
    rows = docs.where(F.coalesce("id", F.lit("")) != "")
    return rows.withColumns({"key": who, "year": F.col("reporting_year").try_cast("int")}).where("key is not null and year is not null")


def collisions(docs: DataFrame, key: str = "agency_key") -> DataFrame:
    """Agency years with several reports: all but the last are outside the chain."""
    return _by_agency(docs, key).groupBy("key", "reporting_year").agg(F.count("*").alias("documents")).where("documents > 1")


def external_edges(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """The number of edges that end outside the corpus."""
    return edges.join(ids.select(F.col("id").alias("to")), "to", "left_anti").agg(F.count("*").alias("n_edges_external"))


def neighbours(edges: DataFrame, id: str) -> DataFrame:
    """``(direction, type, id)`` of the edges at a node."""
    out = edges.where(F.col("from") == id).select(F.lit("out").alias("direction"), "type", F.col("to").alias("id"))
    return out.union(edges.where(F.col("to") == id).select(F.lit("in").alias("direction"), "type", F.col("from").alias("id")))

def write_adjacency(edges: DataFrame, path: str, each: int = EACH) -> None:
    """Edges stored for lookups from both ends: ``(id, direction, type, other)`` in buckets of about ``each`` rows.

    A bucket is a folder, by a hash of the id; buckets grow in number with the edges.  Where ``each`` would
    make very many, several share a folder: it is sorted by ``place_``, the hash before, and id, so that a lookup
    skips what else it holds by the files' statistics.  A hub's edges, which one bucket holds, are
    written by several tasks to several files.
    Null ends are no edges.
    """
    ways = F.inline(F.array(*[F.struct(F.col(a).cast("string").alias("id"), F.lit(d).alias("direction"), F.col("type"), F.col(b).cast("string").alias("other")) for a, d, b in (("from", "out", "to"), ("to", "in", "from"))]))
    rows = edges.where("`from` is not null and `to` is not null").select(ways)
    _bucketed(rows, path, each, F.pmod(F.xxhash64("other"), F.lit(SPREAD)))


def write_documents(docs: DataFrame, path: str, each: int = EACH) -> None:
    """Documents stored for lookups by ``id``, in buckets of about ``each`` rows; those without an id are left out."""
    _bucketed(docs.where("id is not null"), path, each, F.lit(0))


def _bucketed(rows: DataFrame, path: str, each: int, salt: Column) -> None:
    n = rows.count()
    places = max(1, -(-n // each))
    buckets = min(places, max(FOLDERS, -(-n // EACH)))
    dealt = rows.withColumn("place_", _bucket(F.col("id"), F.lit(places))).withColumn("bucket", F.col("place_") % buckets)
    dealt = dealt.repartition("bucket", salt).sortWithinPartitions("bucket", "place_", "id")
    dealt.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/rows")
    rows.sparkSession.range(1).select(F.lit(places).alias("places"), F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/layout")


def _bucket(id: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(id.cast("string")), buckets).cast("int")


def looked_up(spark: SparkSession, path: str, id: str) -> DataFrame:
    """The rows of one id in what :func:`write_adjacency` or :func:`write_documents` stored: one bucket is read, and of it what can hold its place."""
    layout = spark.read.parquet(f"{path}/layout")
    place, buckets = layout.select(_bucket(F.lit(id), F.col("places")), "buckets").first()
    here = (F.col("bucket") == place % buckets) & (F.col("place_") == place) & (F.col("id") == id)
    return spark.read.parquet(f"{path}/rows").where(here).drop("bucket", "place_")


def stored_neighbours(spark: SparkSession, path: str, id: str) -> DataFrame:
    """As :func:`neighbours`, from a stored adjacency."""
    return looked_up(spark, path, id).select("direction", "type", F.col("other").alias("id"))


def linked(edges: DataFrame, each: int = EACH) -> DataFrame:
    """``(from, to, salt)``: distinct links, stored in buckets of about ``each`` by start and salt."""
    ends = edges.select(F.col("from").cast("string").alias("from"), F.col("to").cast("string").alias("to"))
    ends = ends.where("`from` is not null and `to` is not null and `from` <> `to`").distinct()
    once = stored(ends.withColumn("salt", F.pmod(F.xxhash64("to"), F.lit(SPREAD)).cast("int")), "links")
    parts = min(MOST, once.count() // each + 1)
    links = bucketed(once.repartition(parts, "from", "salt"), "links", parts, "from", "salt")
    discarded(once)
    return links


def step(at: DataFrame, links: DataFrame) -> DataFrame:
    """``(id)``: where the links of :func:`linked` lead from the nodes of ``at(id)``; nodes are copied to each salt, links stay where they are.

    A join by hash in each bucket: copies count for no more than the nodes in a plan, so a broadcast would send many times its limit.
    """
    starts = at.select(F.col("id").alias("from"), F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt"))
    return starts.hint("shuffle_hash").join(links, ["from", "salt"]).select(F.col("to").alias("id")).distinct()


def authority_chain(edges: DataFrame, id: str) -> DataFrame:
    """``(id, depth)``: what a node reaches along edges, at its least depth; cycles end there.

    A walk by breadth without a cap on depth: each round takes :data:`HOPS` steps from the nodes
    that the last one found, keeps those not seen before, and the walk ends with a round that finds
    none.  Every step keeps distinct nodes only, so diamonds and cliques do not multiply.  Rounds
    are written to the shared folder.  Ids are compared as text; null ends are no edges, and the
    node itself is not part of what it reaches.

    Links are shuffled once, into buckets by their start and a salt of their end, which spreads a
    hub over :data:`SPREAD` of them; a step moves only the nodes that it starts from.
    """
    spark = edges.sparkSession
    links = linked(edges)
    front = spark.createDataFrame([(id, 0)], "id string, depth int")
    seen, depth = [front], 0
    while True:
        at, steps = front.select("id"), []
        for hop in range(1, HOPS + 1):
            at = step(at, links)
            steps.append(at.withColumn("depth", F.lit(depth + hop)))
        found = _union(steps).groupBy("id").agg(F.min("depth").alias("depth"))
        front = stored(found.join(spread(_union(seen).select("id")), "id", "left_anti"), "front")
        if front.isEmpty():
            discarded(links)
            return _union(seen).where(F.col("id") != id)
        depth += HOPS
        seen.append(front)
        front = front.where(F.col("depth") == depth)
        if len(seen) > COMPACT:
            one = stored(_union(seen).coalesce(16), "seen")
            front = one.where(F.col("depth") == depth)
            discarded(*seen[1:])
            seen = [one]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
