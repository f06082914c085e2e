"""Set-similarity join of documents on word shingles, with token-combination prefixes.

Let ``x`` have ``n`` shingles, of which a linked text may lack ``t = n - ceil(threshold * n)``.  With
shingles in one global order (that of their hashes), two linked texts share at least
``min(l(x), l(y))`` of the first ``t + l`` shingles of each: prefixes are extended by ``l`` beyond
``t`` so that one chance hit no longer makes a candidate.  Shingles fall in two classes by the number
of prefixes that hold them.  Rare ones are indexed singly, and a pair is a candidate if what it
shares, and at best could share among frequent ones, reaches the bound.  Pairs that share no rare
one must share that many frequent ones; these are dealt into fewer subclasses than that, so one
subclass holds two shared ones, and 2-combinations within subclasses are the index.

Candidates only say which texts belong in one cluster.  Each cluster's whole sets are then
compared exactly: a breadth-first search over an index of each set's rarest shingles finds every
link that joins two of its parts, so large groups of near copies never become a list of all pairs,
and texts that only share a passage never meet.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import _BASE, _INVERSE, _powers
from .common import discarded, free_name, quoted, slices, spread, stored, text_or_empty
from .components import connected_components

#: Prefixes that hold a frequent shingle, at least.
FREQUENT = 24
#: Shingles and texts of one cluster that one task compares; larger clusters are dealt into blocks.
CLUSTER_SHINGLES, CLUSTER_TEXTS = 1_000_000, 250
#: Clustered documents whose places are broadcast (about 100 bytes each), at most.
BROADCAST_IDS = 250_000
#: Sets that share a combination and make it a popular one, over; popular ones that are broadcast, at most.
POPULAR, BROADCAST_POPULAR = 500, 100_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingles(text: str, width: int) -> np.ndarray:
    """The set of word shingles as sorted 64-bit hashes.

    Words are runs of anything but ``[ \\t-\\r]``, with A-Z in lower case.  A text with fewer words
    than ``width`` has its whole sequence as one shingle; one without words has none.
    """
    data = text.encode("utf-8", "surrogatepass")
    b = np.frombuffer(data, np.uint8)
    inside = np.r_[False, ~((b == 32) | ((b >= 9) & (b <= 13))), False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    run = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((_LOWER[b].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(b)), out=run[1:])
    words = (run[ends] - run[starts]) * _powers(_INVERSE, len(b))[starts]
    words = _mixed(words + (ends - starts).astype(np.uint64) * _FACTORS[1])
    k = min(width, len(words))
    total = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        total = (total + words[i : len(words) - k + 1 + i]) * _FACTORS[i % len(_FACTORS)]
        total ^= total >> np.uint64(29)
    return np.unique(_mixed(total))


def _need(n, num: int, den: int):
    """Shingles that a linked text must share at least with one of ``n``."""
    return -(-num * n // den)


def _extra(n: int, num: int, den: int) -> int:
    """By how many shingles the prefix exceeds what a linked text may lack."""
    lack = n - _need(n, num, den)
    return min(n - lack, (lack + 1) // 4 + 2)


def _extra_column(n: Column, num: int, den: int) -> Column:
    lack = n - F.ceil(n * num / den)
    return F.least(n - lack, F.floor((lack + 1) / 4) + 2)


def near_classes(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """For each row ``(id, n_shingles, component_id)``: its class of texts linked by likeness.

    Two texts link when ``100 * intersection >= percent * union`` of their shingle sets.  A class is
    what links reach; its id is the smallest id in it.

    * Null, empty and blank texts have no shingles, link with nothing and are their own class.
    * Texts with equal sets (copies, repeated rows) are one class before anything is compared.
      Rows that share an id are taken as one document: their classes are joined.  Rows with a null
      id keep the class of their set, null if no row of it has an id.
    * Long texts are compared whole.  An empty table gives an empty table; other columns are not used.

    At scale: shuffles move shingle prefixes (about a quarter of the hashes), not sets; a frequent
    shingle is counted with combining and its rows meet in skew-split joins; texts cross a shuffle
    only if they are in a cluster.  A cluster beyond :data:`CLUSTER_SHINGLES` or
    :data:`CLUSTER_TEXTS` is dealt into blocks (see :func:`_verified`), exactly.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    if dict(docs.dtypes)[id] not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError("ids must be integers")
    num, den = percent, 100
    base = docs.select(F.col(quoted(id)).cast("long").alias("id"), text_or_empty(quoted(text)).alias("t"))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, keys, heads = [], [], []
            for t in batch.column(1).to_pylist():
                s = shingles(t, width)
                n = len(s)
                sizes.append(n)
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if n else None)
                heads.append(s[: n - _need(n, num, den) + _extra(n, num, den)].view(np.int64) if n > 1 else np.empty(0, np.int64))
            offsets = np.r_[0, np.cumsum([len(h) for h in heads])].astype(np.int32)
            region = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(heads) if heads else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), region], names=["id", "n", "key", "region"])

    rows = stored(base.mapInArrow(prefixes, "id long, n long, key binary, region array<long>"), "prefixes")
    sets = rows.where("n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("region").alias("region")).where("rep is not null")
    edges = _candidates(sets.where("n > 1"), num, den)
    # rows that share an id belong together whatever their texts are
    twice = rows.where("id is not null and n > 0").groupBy("id").agg(F.count_distinct("key").alias("c")).where("c > 1").select("id")
    same = rows.join(spread(twice), "id", "left_semi").join(spread(sets.select("key", "rep")), "key").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    clusters = connected_components(edges)
    labels = _verified(base, sets.select("rep", "n"), clusters, width, num, den, same)
    classes = sets.select("key", "rep").join(spread(labels), sets["rep"] == labels["node"], "left").select(F.col("key").alias("of"), F.coalesce("component", "rep").alias("component"))
    return rows.join(spread(classes), F.col("key") == F.col("of"), "left").select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )


def _candidates(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Edges ``(a, b)`` whose connected parts hold every pair of sets that may link."""
    tokens = sets.select(F.explode("region").alias("h"), "rep", F.col("n").cast("int").alias("n"))
    counts = tokens.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    seen = tokens.join(counts, "h").withColumn("frequent", (F.col("df") >= FREQUENT).cast("int"))
    many = seen.where("frequent = 1").groupBy("rep").agg(F.count("*").alias("hot")).withColumnRenamed("rep", "of")
    seen = seen.join(many, F.col("rep") == F.col("of"), "left").select("h", "rep", "n", "frequent", F.coalesce("hot", F.lit(0)).alias("hot"))
    seen = stored(seen, "shared")
    # rare: lists of under FREQUENT sets, their pairs, and how much each pair shares
    lists = seen.where("frequent = 0").groupBy("h").agg(F.array_sort(F.collect_list(F.struct("rep", "n", "hot"))).alias("xs"))
    of = F.flatten(F.transform("xs", lambda x, i: F.transform(F.slice(F.col("xs"), i + 2, F.size("xs")), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    fit = F.filter(of, lambda p: (F.least(p["x"]["n"], p["y"]["n"]) * den >= F.greatest(p["x"]["n"], p["y"]["n"]) * num) & (p["x"]["rep"] != p["y"]["rep"]))
    pairs = lists.select(F.explode(fit).alias("p")).groupBy("p").agg(F.count("*").alias("s"))
    least = F.least(*[_extra_column(F.col(f"p.{x}.n"), num, den) for x in "xy"])
    rare = pairs.where(F.col("s") + F.least("p.x.hot", "p.y.hot") >= least).select(F.col("p.x.rep").alias("a"), F.col("p.y.rep").alias("b"))
    # frequent: 2-combinations within subclasses, each linked to the smallest set that has it
    low = _extra_column(F.ceil(F.col("n") * num / den), num, den)
    high = _extra_column(F.col("n"), num, den)
    band = lambda x: F.floor(F.log2(F.greatest(x - 1, F.lit(1)).cast("double")) + 1e-9).cast("int")
    hot = seen.where("frequent = 1").where(F.col("hot") >= low).select("h", "rep", "n", F.explode(F.array_distinct(F.array(band(low), band(high)))).alias("band"))
    sub = F.col("h").bitwiseAND(F.expr("shiftleft(1L, band) - 1"))
    grouped = hot.groupBy("rep", "n", "band", sub.alias("sub")).agg(F.array_sort(F.collect_list("h")).alias("hs")).where(F.size("hs") > 1)
    # sets of sizes that cannot link never meet
    span = _span("n", num, den)
    two = F.flatten(F.transform("hs", lambda x, i: F.transform(F.slice(F.col("hs"), i + 2, F.size("hs")), lambda y: F.xxhash64(F.col("band"), F.col("span"), x, y))))
    combos = grouped.withColumn("span", F.explode(F.array(span, span + 1))).select("rep", F.explode(two).alias("sig"))
    hubs = combos.groupBy("sig").agg(F.min("rep").alias("hub"), F.max("rep").alias("far"), F.count("*").alias("c")).where("hub <> far")
    hubs = stored(hubs.select("sig", "hub", "c"), "hubs")
    popular = hubs.where(F.col("c") > POPULAR)
    if popular.count() <= BROADCAST_POPULAR:  # their sets stay spread over the tasks that have them
        popular = F.broadcast(popular)
        met = combos.join(popular, "sig").union(combos.join(popular.select("sig"), "sig", "left_anti").join(spread(hubs.where(F.col("c") <= POPULAR)), "sig"))
    else:
        met = combos.join(spread(hubs), "sig")
    return rare.union(met.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")))


def _verified(base: DataFrame, sizes: DataFrame, clusters: DataFrame, width: int, num: int, den: int, same: DataFrame) -> DataFrame:
    """The classes ``(node, component)`` that exact comparison within clusters leaves.

    A cluster too large for one task is dealt into blocks, each compared in itself.  Then the
    smallest texts' ids of all classes found so far are compared with each other, which makes one
    class of a large group of near copies.  What may still be missed joins two classes, so all texts
    outside the largest class of their cluster are compared with every text of it, block by block;
    but first those go that cannot link: too few of their shingles occur in another text of the
    cluster, which may be mostly a chain of chance hits.  Blocks are made anew of what is left.
    """

    def blocked(labels: DataFrame) -> DataFrame:
        """Rows ``(node, component)`` with their sizes and the block of the cluster that they fall in."""
        sized = labels.join(spread(sizes), labels["node"] == sizes["rep"]).select("node", "component", "n")
        totals = sized.groupBy("component").agg(_blocks().alias("blocks"))
        return sized.join(totals, "component").select("node", "component", "n", "blocks", _block(F.col("blocks")).alias("block"))

    def texts_of(rows: DataFrame) -> DataFrame:
        few = rows.count() <= BROADCAST_IDS
        return base.join(F.broadcast(rows) if few else spread(rows), base["id"] == rows["node"])

    def compared(rows: DataFrame, between: bool = False) -> DataFrame:
        """Links within each ``(component, i, j)`` of rows, or of those that ask with all."""
        met = texts_of(rows).select("component", "i", "j", "asks", "label", "id", "t")
        met = met.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for asks, labels, ids, texts in _runs(batches, 3):
                asks, labels, ids = np.array(asks, bool), np.array(labels, np.int64), np.array(ids, np.int64)
                sets = Sets([shingles(t, width) for t in texts], num, den)
                a, b = sets.between(ids, asks, labels) if between else sets.classes(ids)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        return stored(met.mapInArrow(run, "a long, b long"), "links")

    def supported(rows: DataFrame) -> DataFrame:
        """Of rows those of which enough shingles occur in another text of the cluster, for one as small as any there.

        Each text's shingles are dealt out by their hash, as lists, to parts of a cluster that one
        task can hold; a part counts its shingles and tells each text how many it shares.
        """
        parts = rows.groupBy("component").agg(F.ceil(F.sum("n") / CLUSTER_SHINGLES).cast("int").alias("parts"), F.min("n").alias("least"))
        # linked sets share num / (num + den) of both their sizes, and the smaller has num / den of the larger
        enough = (F.col("c") * den >= F.col("n") * num) & (F.col("c") * (num + den) >= (F.col("n") + F.col("least")) * num)

        def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                out: list[tuple[int, int, int, np.ndarray]] = []
                for c, x, n, t in zip(*[col.to_pylist() for col in batch.columns], strict=True):
                    h = shingles(t, width)
                    part = h % np.uint64(n)
                    out += [(c, int(p), x, h[part == p].view(np.int64)) for p in np.unique(part)]
                c, p, x, hs = zip(*out, strict=True) if out else ((), (), (), ())
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(h) for h in hs])].astype(np.int32)), pa.array(np.concatenate(hs) if hs else np.empty(0, np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(p, pa.int32()), pa.array(x, pa.int64()), lists], names=["component", "part", "node", "hs"])

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for nodes, hs in _runs(batches, 2):
                _, token, df = np.unique(np.concatenate([np.array(h, np.int64) for h in hs]), return_inverse=True, return_counts=True)
                shared = np.add.reduceat((df[token] > 1).astype(np.int64), np.r_[0, np.cumsum([len(h) for h in hs])[:-1]])
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(shared)], names=["node", "c"])

        met = texts_of(rows.join(F.broadcast(parts), "component").select("component", "node", "parts")).select("component", "node", "parts", "t")
        lists = met.mapInArrow(dealt, "component long, part int, node long, hs array<long>").repartition("component", "part").sortWithinPartitions("component", "part")
        held = lists.mapInArrow(counted, "node long, c long").groupBy(F.col("node").alias("of")).agg(F.sum("c").alias("c"))
        return stored(rows.join(F.broadcast(parts.select("component", "least")), "component").join(spread(held), F.col("node") == F.col("of")).where(enough).drop("of", "c", "least"), "supported")

    placed = stored(blocked(clusters), "placed")
    # what has a row for each large cluster is broadcast: over CLUSTER_TEXTS texts or CLUSTER_SHINGLES shingles make one
    zero, no = F.lit(0), F.lit(False)
    found = compared(placed.select("node", "component", F.col("block").alias("i"), zero.alias("j"), no.alias("asks"), F.col("node").alias("label")))
    large = placed.where("blocks > 1")
    if not large.isEmpty():
        own = large.join(spread(found), F.col("node") == F.col("a"), "left").select("node", "component", F.coalesce("b", "node").alias("label"))
        first = own.where("node = label")
        fits = first.groupBy("component").agg(F.count("*").alias("c")).where(F.col("c") <= CLUSTER_TEXTS).select("component")
        more = compared(first.join(F.broadcast(fits), "component").select("node", "component", zero.alias("i"), zero.alias("j"), no.alias("asks"), "label"))
        merged = connected_components(found.select("a", "b").union(more.select("a", "b")))
        named = large.join(spread(merged.select(F.col("node").alias("of"), F.col("component").alias("to"))), F.col("node") == F.col("of"), "left")
        named = stored(named.select("node", "component", "n", "blocks", "block", F.coalesce("to", "node").alias("label")), "named")
        main = named.groupBy("component", "label").agg(F.count("*").alias("c")).groupBy("component").agg(F.max_by("label", F.struct("c", "label")).alias("main"))
        rest = named.join(F.broadcast(main), "component").withColumn("asks", F.col("label") != F.col("main"))
        rest = supported(rest.join(F.broadcast(rest.where("asks").select("component").distinct()), "component", "left_semi"))
        # blocks are made anew, of the texts that are left
        left = rest.groupBy("component").agg(F.ceil(F.count_if("asks") / CLUSTER_TEXTS).cast("int").alias("parts"), _blocks().alias("blocks")).where("parts > 0")
        rest = rest.drop("blocks", "block").join(F.broadcast(left), "component").withColumn("block", _block(F.col("blocks")))
        every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
        mine = F.pmod(F.xxhash64(F.lit(1), "node"), F.col("parts")).cast("int")
        asking = rest.where("asks").select("node", "component", F.explode(every("blocks")).alias("i"), mine.alias("j"), "asks", "label")
        held = rest.select("node", "component", F.col("block").alias("i"), F.explode(every("parts")).alias("j"), no.alias("asks"), "label")
        across = compared(asking.union(held), between=True)
        found = found.select("a", "b").union(more.select("a", "b")).union(across.select("a", "b"))
        return connected_components(found.union(same))
    if not same.isEmpty():
        return connected_components(found.select("a", "b").union(same))
    discarded(placed)
    return found.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _blocks() -> Column:
    """Into how many blocks a cluster of texts of ``n`` shingles is dealt."""
    return F.greatest(F.ceil(F.sum("n") / CLUSTER_SHINGLES), F.ceil(F.count("*") / CLUSTER_TEXTS)).cast("int")


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("node"), blocks).cast("int")


def _span(n: str, num: int, den: int) -> Column:
    """Sizes of linked sets lie in one span or in two that touch."""
    return F.floor(F.log(F.col(n).cast("double")) / F.lit(math.log(max(den / num, 1.01) * (1 + 1e-6)))).cast("int")


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, ...]]:
    """Runs of rows with the same first columns: the columns after those."""
    key, kept = None, []
    for batch in batches:
        for row in zip(*[col.to_pylist() for col in batch.columns], strict=True):
            if row[:keys] != key:
                if kept:
                    yield tuple(zip(*kept, strict=True))
                key, kept = row[:keys], []
            kept.append(row[keys:])
    if kept:
        yield tuple(zip(*kept, strict=True))


class Sets:
    """Shingle sets with an index that finds all sets that link with one of them.

    Two linked sets share a shingle among the first ``n - need + 1`` of each, in the order of how
    few of these sets hold a shingle.  Only those are indexed, and only if two sets hold them; what
    they find is compared whole.
    """

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.num, self.den = num, den
        self.size = size = np.array([len(s) for s in sets], np.int64)
        _, self.token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        self.start = np.r_[0, np.cumsum(size)]
        doc = np.repeat(np.arange(len(sets)), size)
        order = np.lexsort((self.token, df[self.token], doc))
        rank = np.arange(len(doc)) - self.start[doc]
        lack = size - _need(size, num, den)
        head = order[(rank <= lack[doc]) & (df[self.token[order]] > 1)]
        doc, token = doc[head], self.token[head]
        self.heads, self.by_doc = token, np.searchsorted(doc, np.arange(len(sets) + 1))
        by_token = np.argsort(token, kind="stable")
        self.posting, self.at = doc[by_token], np.searchsorted(token[by_token], np.arange(len(df) + 1))
        self.held = np.zeros(len(df), bool)

    def forget(self, keep: np.ndarray) -> None:
        """Drop sets from the index."""
        mask = keep[self.posting]
        self.posting, self.at = self.posting[mask], np.r_[0, np.cumsum(mask)][self.at]

    def near(self, x: int, among: np.ndarray) -> np.ndarray:
        """The sets of those flagged that link with set ``x``."""
        mine = self.heads[self.by_doc[x] : self.by_doc[x + 1]]
        lo, n = self.at[mine], self.at[mine + 1] - self.at[mine]
        hits = self.posting[np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())] if len(mine) else self.posting[:0]
        hits = np.unique(hits[among[hits]])
        size, own = self.size, self.size[x]
        hits = hits[(np.minimum(size[hits], own) * self.den >= np.maximum(size[hits], own) * self.num)]
        if not len(hits):
            return hits
        self.held[self.token[self.start[x] : self.start[x + 1]]] = True
        ends = np.cumsum(size[hits])
        flat = np.repeat(self.start[hits] - np.r_[0, ends[:-1]], size[hits]) + np.arange(ends[-1])
        both = np.add.reduceat(self.held[self.token[flat]].astype(np.int64), np.r_[0, ends[:-1]])
        self.held[self.token[self.start[x] : self.start[x + 1]]] = False
        return hits[self.den * both >= self.num * (own + size[hits] - both)]

    def classes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(id, smallest id of its class)`` for all sets that link with another.

        Breadth-first: each set is compared once with all that no class has reached yet.  Sets with
        equal ids are one from the start.
        """
        m = len(ids)
        open_, label = np.ones(m, bool), np.arange(m)
        one, times = np.unique(ids, return_counts=True)
        twins = {int(x): np.flatnonzero(ids == x) for x in one[times > 1]}
        left = live = m
        for first in np.argsort(ids, kind="stable"):
            if not open_[first]:
                continue
            open_[first] = False
            left -= 1
            queue = [first]
            while queue:
                x = queue.pop()
                new = self.near(x, open_)
                if int(ids[x]) in twins:
                    new = np.union1d(new, twins[int(ids[x])][open_[twins[int(ids[x])]]])
                open_[new] = False
                label[new] = first
                left -= len(new)
                queue += new.tolist()
                if left * 2 < live:  # the index forgets what classes have taken
                    self.forget(open_)
                    live = left
        label = ids[label]
        far = label != ids
        return np.r_[ids[far], np.unique(label[far])], np.r_[label[far], np.unique(label[far])]

    def between(self, ids: np.ndarray, asks: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(id, label)`` for each set that asks and each other label among the sets it links with."""
        out = []
        self.forget(~asks)
        for x in np.flatnonzero(asks):
            out += [(ids[x], y) for y in np.unique(labels[self.near(x, ~asks & (labels != labels[x]))])]
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return a, b


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row for each class of :func:`near_classes`: that with the smallest id.

    * Rows without an id stay, and so do texts without words, each under its own id.
    * Rows that share an id are told apart by their texts, each a document of its own: of a class
      the one with the smallest id (then the smallest digest) stays.
    * Of rows that share id and text that stays whose columns hash lowest.
    * Other columns pass through whatever their names.  An empty table gives an empty table.

    Texts cross one exchange, in the join with the ids that stay.
    """
    key, own, row = (free_name(docs, x) for x in ("keep__", "own__", "row__"))
    named = docs.where(F.col(quoted(id)).isNotNull())
    nameless = docs.where(F.col(quoted(id)).isNull())
    if named.groupBy(quoted(id)).count().where("count > 1").isEmpty():
        kept = near_classes(named, id, text, width, percent).where(F.col("component_id") == F.col(quoted(id))).select(F.col(quoted(id)).alias(key))
        return named.join(spread(kept), F.col(quoted(id)) == F.col(key), "left_semi").union(nameless)
    each = named.withColumns({own: F.xxhash64(quoted(id), text_or_empty(quoted(text))), row: F.xxhash64(F.to_json(F.struct(*[F.col(quoted(c)) for c in docs.columns])))})
    classes = near_classes(each.select(F.col(own).alias("doc"), F.col(quoted(text)).alias("text")), "doc", "text", width, percent).distinct()
    ids = each.select(F.col(own).alias("own"), F.col(quoted(id)).alias("id"), F.col(row).alias("row"))
    first = ids.join(spread(classes), F.col("own") == F.col("doc")).groupBy("component_id").agg(F.min(F.struct("id", "own", "row")).alias("k"))
    kept = stored(first.select(F.col("k.own").alias(key), F.col("k.row").alias(key + "row")), "kept")
    left = each.join(spread(kept), (F.col(own) == F.col(key)) & (F.col(row) == F.col(key + "row")), "left_semi").dropDuplicates([own, row])
    return left.drop(own, row).union(nameless)
