"""Benchmark passages in documents: an FM-index of each training shard, searched backwards for all windows at once."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BATCH_BYTES, mapped, quoted, stored, text_or_empty

#: ASCII digits and letters and all that is not ASCII make words; texts are lower-cased (A-Z only) before.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bytes of benchmark text that one broadcast holds; a larger benchmark is searched in pieces.
PIECE_BYTES = 4 << 20
#: Words of a benchmark row after it is cut, its overlap with the next row not counted.
SEGMENT = 2_000
#: Words of one shard, its overlap with the next not counted.
SHARD = 1 << 19
#: Every so many positions of a shard are kept with their suffixes; the others are walked to.
SAMPLE = 8

_SPAN = T.StructType([T.StructField(c, T.LongType()) for c in ("first", "last", "start", "end")])
ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(_SPAN)),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_ARROW = [pa.int64(), pa.int64(), pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")])), pa.list_(pa.string())]


class Wavelet:
    """Ranks of symbols in a sequence: a level for each bit, with running counts of ones."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for shift in range(bits - 1, -1, -1):
            one = ((symbols >> shift) & 1).astype(bool)
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.levels.append((shift, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate((symbols[~one], symbols[one]))

    def rank(self, symbol: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """How often each symbol stands before each of its ends."""
        at = [np.zeros(len(symbol), np.int64), *ends]
        for shift, ones, zeros in self.levels:
            up = ((symbol >> shift) & 1).astype(bool)
            at = [np.where(up, zeros + (r := ones[i]), i - r) for i in at]
        return [i - at[0] for i in at[1:]]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before it."""
        symbol, start = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for _, ones, zeros in self.levels:
            before = ones[at]
            up = ones[at + 1] > before
            at = np.where(up, zeros + before, at - before)
            r = ones[start]
            start = np.where(up, zeros + r, start - r)
            symbol = 2 * symbol + up
        return symbol, at - start


def suffixes(words: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order.  A 0 is a separator unlike any other one (earlier ones are less); the last is 0.

    Ranks by the first ``h`` words give ranks by ``2 h``; only suffixes that still tie are sorted
    again, so copies cost a round for each doubling of their length and everything else two or three.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    below = np.concatenate(([0], np.cumsum(np.bincount(words))))
    rank = below[words]
    zeros = int(below[1])
    rank[order[:zeros]] = np.arange(zeros)
    size = np.diff(below)[words[order]]
    tied = np.flatnonzero((size > 1) & (np.arange(n) >= zeros))
    h = 1
    while len(tied):
        at = order[tied]
        key = rank[at] * (n + 1) + rank[at + h]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[tied] = at
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        alone = new & np.concatenate((new[1:], [True]))
        tied, h = tied[~alone], 2 * h
    return order


class FMIndex:
    """Where phrases of words stand in a shard, by backward search over its Burrows-Wheeler transform."""

    def __init__(self, words: np.ndarray, symbols: int) -> None:
        order = suffixes(words)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(words, minlength=symbols))))
        self.wavelet = Wavelet(words[order - 1], max(1, int(symbols - 1).bit_length()))
        # walks end at a sampled place: every few words, and at the start of each run, so none meets a separator
        kept = (np.arange(len(words)) % SAMPLE == 0) | (np.roll(words, 1) == 0)
        self.sampled = kept[order]
        self.before = np.cumsum(self.sampled) - 1
        self.starts = order[self.sampled]

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that begin with a symbol and go on as those of ``lo`` to ``hi``."""
        a, b = self.wavelet.rank(symbol, lo, hi)
        return self.below[symbol] + a, self.below[symbol] + b

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of some rows start."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            there = self.sampled[rows[open_]]
            met = open_[there]
            out[met] = self.starts[self.before[rows[met]]] + steps[met]
            open_ = open_[~there]
            symbol, n = self.wavelet.read(rows[open_])
            rows[open_] = self.below[symbol] + n
            steps[open_] += 1
        return out


class Phrases:
    """Windows of benchmark items, read backwards into a trie whose levels are arrays."""

    def __init__(self, rows: list[tuple[str, bytes]], width: int) -> None:
        split = [(item, words.split(b" ")) for item, words in rows]
        self.ids = {w: i + 1 for i, w in enumerate(sorted({w for _, ws in split for w in ws}))}
        self.names = sorted({item for item, _ in split})
        number = {x: i for i, x in enumerate(self.names)}
        backwards, owners = [], []
        for item, words in split:
            ids = np.array([self.ids[w] for w in words], np.int32)
            if len(ids) >= width:
                made = np.lib.stride_tricks.sliding_window_view(ids, width)[:, ::-1]
            else:
                made = np.zeros((1, width), np.int32)
                made[0, : len(ids)] = ids[::-1]
            backwards.append(made)
            owners.append(np.full(len(made), number[item], np.int64))
        windows, which = np.unique(np.concatenate(backwards), axis=0, return_inverse=True)
        self.lengths = (windows > 0).sum(axis=1)
        self.shortest = int(self.lengths.min())
        pairs = np.unique(which.reshape(-1).astype(np.int64) * len(self.names) + np.concatenate(owners))
        self.owner = pairs % len(self.names)
        self.owned = np.searchsorted(pairs // len(self.names), np.arange(len(windows) + 1))
        #: for each depth: symbols of nodes, first child of each node, window that ends in each node or -1
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        new, starts = np.zeros(len(windows), bool), []
        new[0] = True
        for d in range(width):
            new[1:] |= windows[1:, d] != windows[:-1, d]
            starts.append(np.flatnonzero(new & (windows[:, d] > 0)))
        for d, at in enumerate(starts):
            ends = at if d + 1 == width else np.where(windows[at, d + 1] == 0, at, -1)
            below = starts[d + 1] if d + 1 < width else np.zeros(0, np.int64)
            first = np.searchsorted(below, np.concatenate((at, [len(windows)])))
            self.levels.append((windows[at, d].astype(np.int64), first, ends))

    def found(self, index: FMIndex) -> tuple[np.ndarray, np.ndarray]:
        """``(window, start)`` of every occurrence: the trie is walked down while some suffix agrees."""
        symbol, first, ends = self.levels[0]
        node, lo, hi = np.arange(len(symbol)), index.below[symbol], index.below[symbol + 1]
        spans = []
        for d in range(len(self.levels)):
            live = hi > lo
            node, lo, hi = node[live], lo[live], hi[live]
            if not len(node):
                break
            _, first, ends = self.levels[d]
            done = ends[node] >= 0
            spans.append((ends[node][done], lo[done], hi[done]))
            if d + 1 < len(self.levels):
                parent, child = expanded(first[node], first[node + 1])
                node = child
                lo, hi = index.step(self.levels[d + 1][0][child], lo[parent], hi[parent])
        if not spans:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        window, lo, hi = (np.concatenate(x) for x in zip(*spans, strict=True))
        of, row = expanded(lo, hi)
        return window[of], index.locate(row)


def expanded(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each ``lo`` up to its ``hi``, and which pair each comes from."""
    n = hi - lo
    of = np.repeat(np.arange(len(n)), n)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + lo[of]


def occurrences(stream: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """``(window, place)`` in a stream of word numbers, 0 for words of no item and between texts.

    What is indexed are the runs of benchmark words that are long enough to hold a window, a
    separator after each; in the others no window can stand.  Streams are cut into shards that
    overlap by a window.
    """
    width = len(phrases.levels)
    known = np.concatenate(([0], (stream > 0).astype(np.int8), [0]))
    edge = np.diff(known)
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    wide = hi - lo >= phrases.shortest
    _, place = expanded(lo[wide], hi[wide] + 1)
    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = np.append(stream, 0)[place].astype(np.int64)
    out = []
    for at in range(0, len(words), SHARD):
        part = words[at : at + SHARD + width - 1]
        window, start = phrases.found(FMIndex(np.append(part, 0), len(phrases.ids) + 1))
        out.append((window, place[at + start]))
    return np.concatenate([w for w, _ in out]), np.concatenate([p for _, p in out])


def segments(benchmark: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """``(item, words)``: the words of each item, cut so that each window lies in one row or more."""
    given = benchmark.select(text_or_empty(quoted(item_id)).alias("item"), text_or_empty(quoted(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = WORD.findall(t.encode().lower())
                cut = [b" ".join(words[i : i + SEGMENT + width - 1]).decode() for i in range(0, max(len(words) - width + 1, min(len(words), 1)), SEGMENT)]
                if cut:
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(cut)), pa.array(cut)], names=["item", "words"])

    return mapped(given, run, T.StructType([T.StructField("item", T.StringType()), T.StructField("words", T.StringType())]))


def pieces(benchmark: DataFrame, item_id: str, text: str, width: int) -> Iterator[Phrases]:
    """The benchmark's windows, so many bytes of text at a time (:data:`PIECE_BYTES`, by measure)."""
    rows = stored(segments(benchmark, item_id, text, width).distinct(), "segments")
    many = -(-(rows.agg(F.sum(F.octet_length("words") + F.octet_length("item"))).first()[0] or 0) // PIECE_BYTES)
    for k in range(many):
        own = rows.where(F.pmod(F.xxhash64("item", "words"), F.lit(many)) == k).collect()
        if own:
            yield Phrases([(r.item, r.words.encode()) for r in own], width)


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 10, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` and ``items`` of benchmark passages.

    A window is ``width`` consecutive words of an item, or all words of an item with fewer.  Words
    that lie in any occurrence of a window are hit; ``spans`` are the hit stretches, merged, as
    words ``first`` to ``last`` (excluded) and code points ``start`` to ``end`` (excluded);
    ``items`` are the ids, as text and in order, of the items with a window in the document.

    Each task indexes its own batches of whole documents and searches the windows in them, so no
    row is shuffled, however often a passage or a document repeats, and a lost task is run again by
    itself.  Windows come by broadcast, :data:`PIECE_BYTES` of benchmark text at a time; a larger
    benchmark takes a pass of tasks for each piece, which adds to what the last one found.

    * Null and empty texts have no words; items without words have no windows; a null item id
      counts as the empty one; repeated items count once; a repeated document is judged each time.
    * Without ``keep_text`` the text column is left out.  Columns named like an added one are
      replaced.  Empty tables give an empty table, or documents without hits.
    """
    wanted = {f.name.lower() for f in ADDED}
    if text.lower() in wanted:
        raise ValueError(f"the text column may not have the name of an added one: {text}")
    kept = [c for c in docs.columns if c.lower() not in wanted]
    nothing = {"n_words": "cast(0 as bigint)", "n_hit": "cast(0 as bigint)", "spans": f"cast(array() as {_SPAN_SQL})", "items": "cast(array() as array<string>)"}
    out = docs.select(*[quoted(c) for c in kept], *[F.expr(e).alias(c) for c, e in nothing.items()])
    shared = [docs.sparkSession.sparkContext.broadcast(phrases) for phrases in pieces(benchmark, item_id, item_text, width)]
    for piece in shared or [None]:  # without windows, words are counted all the same
        out = _pass(out, text, piece)
    return out if keep_text else out.select(*[quoted(c) for c in out.columns if c != text])


_SPAN_SQL = "array<struct<first: bigint, last: bigint, start: bigint, end: bigint>>"


def _pass(docs: DataFrame, text: str, shared) -> DataFrame:
    """``docs``, which have the added columns last, with what one piece of the benchmark adds to them."""
    at, n_kept = docs.columns.index(text), len(docs.columns) - len(ADDED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = size = 0
            for i in range(batch.num_rows):  # a batch of long texts is taken in parts
                size += len(batch.column(at)[i].as_buffer() or b"") if batch.column(at)[i].is_valid else 0
                if size > BATCH_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(start, i + 1 - start)
                    columns = _judged(part.column(at), part.column(n_kept + 2), part.column(n_kept + 3), shared.value if shared else None)
                    yield pa.RecordBatch.from_arrays([*part.columns[:n_kept], *columns], names=[str(k) for k in range(len(part.columns))])
                    start, size = i + 1, 0

    return mapped(docs, run, T.StructType([docs.schema[c] for c in docs.columns[:n_kept]] + list(ADDED)))


def _judged(texts: pa.Array, spans: pa.Array, items: pa.Array, phrases: Phrases | None) -> list[pa.Array]:
    get = phrases.ids.get if phrases else None
    raw = [(t.as_buffer().to_pybytes() if t.is_valid else b"").lower() for t in texts]
    counts, parts = np.zeros(len(raw), np.int64), []
    for i, t in enumerate(raw):
        words = WORD.findall(t)
        counts[i] = len(words)
        if phrases:
            parts.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
            parts.append(np.zeros(1, np.int32))
    starts = np.concatenate(([0], np.cumsum(counts + 1)))
    window = place = np.zeros(0, np.int64)
    if parts:
        window, place = occurrences(np.concatenate(parts), phrases)
    doc = np.searchsorted(starts, place, "right") - 1
    lengths = phrases.lengths[window] if phrases else place
    found_spans, found_items, hits = spans.to_pylist(), items.to_pylist(), np.zeros(len(raw), np.int64)
    by = np.argsort(doc, kind="stable")
    cut = np.searchsorted(doc[by], np.arange(len(raw) + 1))
    for i in range(len(raw)):
        own = by[cut[i] : cut[i + 1]]
        if len(own):
            first = place[own] - starts[i]
            old = [(s["first"], s["last"]) for s in found_spans[i]]
            merged = _merged(np.concatenate((first, [a for a, _ in old])).astype(np.int64), np.concatenate((first + lengths[own], [b for _, b in old])).astype(np.int64), int(counts[i]))
            found_spans[i] = _placed(merged, raw[i])
            of, at = expanded(phrases.owned[w := np.unique(window[own])], phrases.owned[w + 1])
            found_items[i] = sorted({phrases.names[k] for k in np.unique(phrases.owner[at])} | set(found_items[i]))
        hits[i] = sum(s["last"] - s["first"] for s in found_spans[i])
    return [pa.array(c, t) for c, t in zip((counts, hits, found_spans, found_items), _ARROW, strict=True)]


def _merged(first: np.ndarray, last: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Stretches of words that any of the spans covers; touching ones are one."""
    depth = np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(last, minlength=n + 1))
    edge = np.diff(np.concatenate(([0], (depth[:n] > 0).astype(np.int8), [0])))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def _placed(spans: list[tuple[int, int]], raw: bytes) -> list[dict[str, int]]:
    """Spans of words with the code points that they take up."""
    bounds = np.array([m.span() for m in WORD.finditer(raw)], np.int64)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [{"first": a, "last": b, "start": int(points[bounds[a, 0]]), "end": int(points[bounds[b - 1, 1]])} for a, b in spans]


def cleaned(found: DataFrame, text: str = "text") -> Column:
    """The text of rows of :func:`find` without its spans."""
    t, s = quoted(text), "spans"
    return F.expr(
        f"CASE WHEN size({s}) = 0 THEN {t} ELSE array_join(transform(sequence(0, size({s})), i -> substring({t}, "
        f"if(i = 0, 0, cast({s}[i - 1].end as int)) + 1, if(i = size({s}), char_length({t}), cast({s}[i].start as int)) - if(i = 0, 0, cast({s}[i - 1].end as int)))), '') END"
    )
