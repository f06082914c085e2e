"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes of a text cuts it where the content says so, so that a passage that
stands in many documents is cut alike in all of them.  Chunks that occur more than once are encoded
once, by the document that owns them; all others are encoded in place.  BPE is not additive over a
cut, so each join of two chunks is repaired: a window around the cut is encoded again, and grows,
until the ids before and after it agree exactly with those of the chunks on either side.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BATCH_BYTES, HEAVY, free_name, mapped, quoted, slices, stored, text_or_empty

#: Split of a text before the merges (fixed value: the byte-level pattern of the vocabulary).
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of the rolling window, least bytes of a chunk, and 1 in how many bytes ends one.
WINDOW, LEAST, ONE_IN = 24, 1024, 1024
#: Texts that one copy of a shared chunk's ids goes out to, about.
SHARERS = 500


class Codec:
    """A byte-level BPE vocabulary in the ``tokenizers`` JSON format, and its exact encoder.

    The merges run in tiktoken's encoder, whose results on this vocabulary equal those of the
    tokenizers library.  Strings of special tokens in a text become their ids, as there.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        shown = {ord("!") + i: chr(ord("!") + i) for i in range(94)}
        shown |= {b: chr(b) for b in [*range(0xA1, 0xAD), *range(0xAE, 0x100)]}
        rest = [b for b in range(256) if b not in shown]
        byte_of = {c: b for b, c in (shown | {b: chr(256 + i) for i, b in enumerate(rest)}).items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in self.special}
        self.encoding = tiktoken.Encoding("reportloom", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens=self.special)
        self.known = np.zeros(max([*ranks.values(), *self.special.values()]) + 1, bool)
        self.known[[*ranks.values(), *self.special.values()]] = True
        #: How ids travel between tasks: in two bytes where the vocabulary allows it.
        self.kind = "<u2" if len(self.known) <= 1 << 16 else "<u4"
        self.scan = regex.compile(PRETOKENS)
        self.word = regex.compile(r"(?<=\S)(?=\s)")
        self.stops = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def plain(self, text: str) -> np.ndarray:
        """Ids of a text without special tokens."""
        return self.encoding.encode_to_numpy(text, disallowed_special=()) if text else np.empty(0, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text encoded in one go: what :meth:`joined` must equal."""
        return _concat([np.array([x], np.uint32) if isinstance(x, int) else self.plain(x) for x in self.segments(text)])

    def segments(self, text: str) -> list[str | int]:
        """The text between special tokens, and their ids, in order."""
        out: list[str | int] = []
        at = 0
        for m in self.stops.finditer(text) if self.stops else ():
            out += [text[at : m.start()], self.special[m[0]]]
            at = m.end()
        return [*out, text[at:]]

    def joined(self, chunks: list[str], ids: list[np.ndarray]) -> np.ndarray:
        """The ids of the text that the chunks make up, from the ids of each.

        A chunk that is one piece of the pattern from end to end gives a repair nothing to agree on:
        it becomes one with the chunk before it, and a run of such chunks is encoded once, at its end.
        """
        runs: list[list[int]] = []
        for i, x in enumerate(chunks):
            if runs and self.scan.match(x).end() == len(x):
                runs[-1].append(i)
            else:
                runs.append([i])
        texts = ["".join(chunks[i] for i in run) for run in runs]
        known = [ids[run[0]] if len(run) == 1 else self.plain(x) for run, x in zip(runs, texts, strict=True)]
        done: list[np.ndarray] = []
        text, tail = texts[0], known[0]
        for nxt, more in zip(texts[1:], known[1:], strict=True):
            before, window, after, rest = self._repair(text, tail, nxt, more)
            # what stands before the window is final; the window and the next chunk go on
            done.append(tail[:before])
            text, tail = rest, np.concatenate([window, more[after:]])
        return _concat([*done, tail])

    def _repair(self, a: str, a_ids: np.ndarray, b: str, b_ids: np.ndarray):
        """Encode a growing window over the cut until both sides agree.

        Returns (ids kept of a, ids of the window, ids dropped from b, text from the window on).
        A boundary of a's scan holds in the joined text if its match ended two or more characters
        before the cut: the pattern looks no further ahead.  One of b's scan holds as soon as the
        scan of the window meets it: both go on from there alike.  With all of both chunks in the
        window their ends are such boundaries, so an agreement is found at the latest then.
        """
        back = ahead = 32
        while True:
            back, ahead = min(back, len(a)), min(ahead, len(b))
            near, head = a[len(a) - back :], b[:ahead]
            begin = 0
            if back < len(a):  # no match goes on from another character to white space: a boundary of any scan
                m = self.word.search(near)
                begin = m.start() if m else back
            left, start = [], begin
            for m in self.scan.finditer(near, begin):
                if m.end() <= back - 2:
                    start, left = m.end(), []
                else:
                    left.append(m[0])
            if begin < back or back == len(a):
                tail = self._ids(left)
                if tail == a_ids[len(a_ids) - len(tail) :].tolist():
                    found = self._meeting(near[start:], head, ahead if ahead == len(b) else ahead - 2)
                    if found and (right := self._ids(found[1])) == b_ids[: len(right)].tolist():
                        return len(a_ids) - len(tail), np.array(self._ids(found[0]), np.uint32), len(right), near[start:] + b
            if back == len(a) and ahead == len(b):
                raise ValueError("the ids of a chunk are not those of its text")
            back, ahead = back * 4, ahead * 4

    def _meeting(self, left: str, head: str, limit: int) -> tuple[list[str], list[str]] | None:
        """The pieces of left + head and those of head up to the first boundary that both have."""
        own, at = {}, 0
        for m in self.scan.finditer(head):
            if m.end() > limit:
                break
            at += 1
            own[m.end()] = at
        pieces = []
        for m in self.scan.finditer(left + head):
            pieces.append(m[0])
            if (end := m.end() - len(left)) in own:
                return pieces, [m[0] for m, _ in zip(self.scan.finditer(head), range(own[end]), strict=False)]
            if end > limit:
                break
        return None

    def _ids(self, pieces: list[str]) -> list[int]:
        return [i for x in pieces for i in self.encoding._encode_single_piece(x)]

    def text(self, ids: np.ndarray) -> str:
        """The text of ids; ids outside the vocabulary are skipped, broken UTF-8 is replaced."""
        ids = ids[ids < len(self.known)]
        return self.encoding.decode_bytes(ids[self.known[ids]].tolist()).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _concat(parts: list[np.ndarray]) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint32)


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(of: int, n: int) -> np.ndarray:
    """The first powers of a number modulo 2**64, as many as the longest text so far needs."""
    if len(_POWERS.get(of, ())) < n:
        _POWERS[of] = np.cumprod(np.r_[np.uint64(1), np.full(max(n, 1 << 16), of, np.uint64)])
    return _POWERS[of][:n]


def cuts(data: bytes) -> list[int]:
    """Where the chunks of UTF-8 bytes end, the last end included.

    A chunk ends before a character if the rolling hash of the bytes before it says so and the
    chunk has its least length; what stands elsewhere in the text has no say in it.
    """
    n = len(data)
    if n <= LEAST + WINDOW:
        return [n]
    b = np.frombuffer(data, np.uint8)
    run = np.cumsum(b.astype(np.uint64) * _powers(_BASE, n))
    window = run[WINDOW - 1 :].copy()
    window[1:] -= run[:-WINDOW]
    window *= _powers(_INVERSE, len(window))  # makes it independent of its place
    at = np.flatnonzero((window >> np.uint64(40)) % np.uint64(ONE_IN) == 0) + WINDOW
    at = at[at < n]
    at = at[(b[at] & 0xC0) != 0x80]
    out, last = [], 0
    for x in at.tolist():
        if x - last >= LEAST:
            out.append(x)
            last = x
    return [*out, n]


def _pieces(c: Codec, text: str) -> list[list[bytes] | int]:
    """The chunks of each segment, and the ids of the special tokens between them."""
    out: list[list[bytes] | int] = []
    for s in c.segments(text):
        if isinstance(s, int):
            out.append(s)
        elif s:
            data = s.encode("utf-8", "surrogatepass")
            ends = cuts(data)
            out.append([data[i:j] for i, j in zip([0, *ends], ends, strict=False)])
    return out


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str | None = None, keep_text: bool = True) -> DataFrame:
    """Encode the whole text of every row: all columns of ``docs`` and the binary column ``ids``.

    With ``decoded`` named, that column holds what :func:`decode` makes of the ids, in the same pass.
    Without ``keep_text`` the text column is left out.

    ``ids`` holds little-endian unsigned 32-bit integers (see :func:`ids_of` for arrays).

    * Null and empty texts get no ids (an empty binary).
    * Repeated rows and repeated ids of rows are kept, each with its own ids; texts are told apart
      by a 128-bit digest, not by a column.
    * A column that clashes with an added one (in any case) is replaced; other columns pass through.
    * An empty table gives an empty table.

    Plan: one pass lists and stores the chunk digests of each text (no text is shuffled); a grouped
    count keeps those that occur twice or more, with the smallest (text, place) as owner.  Chunks
    with over one in :data:`HEAVY` of all places, of which there are fewer than that, meet their
    places by broadcast.  The texts, compressed, are dealt out by their digest once, and both joins
    read that one exchange: owners encode their chunks, whose ids go to the texts that share them
    (one copy of the ids for each :data:`SHARERS` places, so no task gathers a popular chunk's); the
    last pass encodes what is left and repairs the joins.  Copies of one text lie side by side
    there, and the first one's ids serve all; a text with over one in :data:`HEAVY` of the rows is
    dealt out in parts of about :data:`SHARERS` rows.  No step holds more than one text and its shared
    chunks at a time.
    """
    added = [ids] + ([decoded] if decoded else [])
    lost = {x.lower() for x in added} | (set() if keep_text else {text.lower()})
    order = [c for c in docs.columns if c.lower() not in lost]
    rest = [c for c in order if c.lower() != text.lower()]
    key, part, parts, packed, owned, shared = (free_name(docs, x) for x in ("key__", "part__", "parts__", "packed__", "owned__", "shared__"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in slices(batches):
            keys, places, digests = [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                i = 0
                for part in _pieces(c, t):
                    if not isinstance(part, int):
                        for x in part:
                            keys.append(k)
                            places.append(i)
                            digests.append(_digest(x))
                            i += 1
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(places, pa.int32()), pa.array(digests, pa.binary())], names=["k", "i", "h"])

    keyed = F.unhex(F.md5(text_or_empty(quoted(text)).cast("binary")))
    refs = stored(docs.select(keyed.alias("k"), text_or_empty(quoted(text)).alias("t")).mapInArrow(listed, "k binary, i int, h binary"), "chunks")
    total = refs.count()
    counts = refs.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("k", "i")).alias("owner")).where("n > 1")
    # copies of a text have the same places: each counts once from here on
    each = refs.groupBy("k", "i", "h").count().drop("count")
    heavy = F.broadcast(counts.where(F.col("n") * HEAVY > total))
    places = each.join(heavy, "h").union(each.join(heavy.select("h"), "h", "left_anti").join(counts.where(F.col("n") * HEAVY <= total), "h"))
    salts = F.ceil(F.col("n") / SHARERS).cast("int")
    places = places.select("k", "i", "h", (F.struct("k", "i") == F.col("owner")).alias("own"), salts.alias("salts"), F.pmod(F.xxhash64("k", "i"), salts).cast("int").alias("salt"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packs = pa.array([level.compress(t.encode("utf-8", "surrogatepass")) for t in batch.column(len(batch.schema) - 1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packs], names=[*batch.schema.names[:-1], packed])

    # a text of very many copies is dealt out in parts, each of which gets its shared chunks
    texts = refs.where("i = 0").groupBy("k").agg(F.count("*").alias("c"))
    often = F.broadcast(texts.where(F.col("c") * HEAVY > docs.count()).select(F.col("k").alias(key), F.ceil(F.col("c") / SHARERS).cast("int").alias(parts)))
    fields = [T.StructField(c, docs.schema[c].dataType) for c in rest]
    spread = F.monotonically_increasing_id()
    any_part = F.when(F.length(packed) == 0, F.pmod(spread, F.lit(1 << 30))).when(F.col(parts).isNotNull(), F.pmod(spread, F.col(parts))).otherwise(0).cast("int")
    base = docs.select(*[F.col(quoted(c)) for c in rest], keyed.alias(key), text_or_empty(quoted(text)).alias(packed))
    base = base.join(often, key, "left").select(*[F.col(quoted(c)) for c in rest], key, any_part.alias(part), packed)
    base = mapped(base, pack, T.StructType([*fields, T.StructField(key, T.BinaryType()), T.StructField(part, T.IntegerType()), T.StructField(packed, T.BinaryType())]))

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, unpack = codec(vocabulary), zstandard.ZstdDecompressor()
        last = None
        for batch in batches:
            hs, copies, out = [], [], []
            for k, data, mine in zip(*(batch.column(x).to_pylist() for x in (key, packed, owned)), strict=True):
                if mine and k != last:  # the join leaves copies of a text side by side: one of them is enough
                    last, wanted = k, {x["i"]: x["salts"] for x in mine}
                    flat = [x for part in _pieces(c, unpack.decompress(data).decode("utf-8", "surrogatepass")) if not isinstance(part, int) for x in part]
                    for i, salts in wanted.items():
                        hs.append(_digest(flat[i]))
                        copies.append(salts)
                        out.append(c.plain(flat[i].decode("utf-8", "surrogatepass")).astype(c.kind).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(hs, pa.binary()), pa.array(copies, pa.int32()), pa.array(out, pa.binary())], names=["h", "salts", "ids"])

    own = places.where("own").groupBy("k").agg(F.collect_list(F.struct("i", "salts")).alias(owned)).withColumnRenamed("k", key)
    # part 0, in a form that is no literal: a literal would become a filter of the texts, and they another exchange
    own = own.withColumn(part, F.pmod(F.hash(key), F.lit(1)))
    encoded = mapped(base.join(own, [key, part], "left"), owners, T.StructType([T.StructField("h", T.BinaryType()), T.StructField("salts", T.IntegerType()), T.StructField("ids", T.BinaryType())]))
    encoded = encoded.groupBy("h", "salts").agg(F.first("ids").alias("ids")).select("h", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "ids")
    given = places.select("k", "i", "h", "salt").join(encoded, ["h", "salt"]).groupBy("k").agg(F.collect_list(F.struct("i", "ids")).alias(shared)).withColumnRenamed("k", key)
    given = given.join(often, key, "left").withColumn(part, F.explode(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1))).drop(parts)

    def whole_of(c: Codec, t: str, had: dict[int, np.ndarray]) -> np.ndarray:
        parts, i = [], 0
        for part in _pieces(c, t):
            if isinstance(part, int):
                parts.append(np.array([part], np.uint32))
                continue
            chunks = [x.decode("utf-8", "surrogatepass") for x in part]
            parts.append(c.joined(chunks, [had[i + j] if i + j in had else c.plain(x) for j, x in enumerate(chunks)]))
            i += len(chunks)
        return _concat(parts)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, unpack = codec(vocabulary), zstandard.ZstdDecompressor()
        last, t, coded, back = None, "", b"", ""
        for batch in batches:
            out: dict[str, list] = {"texts": [], "found": [], "back": []}
            size = start = 0
            for at, (k, data, got) in enumerate(zip(batch.column(key), batch.column(packed), batch.column(shared), strict=True)):
                if k != last:
                    last, t = k, unpack.decompress(data.as_py()).decode("utf-8", "surrogatepass")
                    whole = whole_of(c, t, {x["i"]: np.frombuffer(x["ids"], c.kind).astype(np.uint32) for x in got.as_py() or ()})
                    coded, back = whole.astype("<u4").tobytes(), c.text(whole) if decoded else ""
                out["found"].append(coded)
                if keep_text:
                    out["texts"].append(t)
                if decoded:
                    out["back"].append(back)
                size += 2 * len(t) + len(coded)
                if size > BATCH_BYTES:
                    yield _out(batch.slice(start, at + 1 - start), **out)
                    out = {k: [] for k in out}
                    size, start = 0, at + 1
            yield _out(batch.slice(start), **out)

    def _out(batch: pa.RecordBatch, texts: list[str], found: list[bytes], back: list[str]) -> pa.RecordBatch:
        columns = {c: batch.column(c) for c in rest} | {text: pa.array(texts, pa.string()), ids: pa.array(found, pa.binary())}
        if decoded:
            columns[decoded] = pa.array(back, pa.string())
        return pa.RecordBatch.from_arrays([columns[c] for c in [*order, *added]], names=[*order, *added])

    schema = T.StructType([T.StructField(c, T.StringType() if c.lower() == text.lower() else docs.schema[c].dataType) for c in order] + [T.StructField(ids, T.BinaryType())])
    if decoded:
        schema = schema.add(decoded, T.StringType())
    return mapped(base.join(given, [key, part], "left"), finished, schema)


def ids_of(data: bytes) -> list[int]:
    """The ids in a binary of :func:`encode`."""
    return np.frombuffer(data, "<u4").tolist()


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Add the text of the binary column ``ids`` as ``to``; null ids give an empty text.

    Ids that the vocabulary lacks are skipped, and bytes that are no UTF-8 become U+FFFD, as in the
    tokenizers library.  Special tokens are written out.  No shuffle.  A column that clashes with
    ``to`` is replaced.
    """
    kept = [c for c in encoded.columns if c.lower() != to.lower()]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            out, size, start = [], 0, 0
            for at, data in enumerate(batch.column(ids).to_pylist()):
                out.append(c.text(np.frombuffer(data or b"", "<u4")))
                size += len(out[-1]) + len(data or b"")
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([*batch.slice(start, at + 1 - start).columns, pa.array(out, pa.string())], names=[*kept, to])
                    out, size, start = [], 0, at + 1
            yield pa.RecordBatch.from_arrays([*batch.slice(start).columns, pa.array(out, pa.string())], names=[*kept, to])

    schema = T.StructType([encoded.schema[c] for c in kept] + [T.StructField(to, T.StringType())])
    return mapped(encoded.select(*[F.col(quoted(c)) for c in kept]), texts, schema)
