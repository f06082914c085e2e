"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import _BASE, _INVERSE, _powers
from .common import free_name, mapped, quoted, text_or_empty

#: Bytes of a word that the trie takes whole; longer ones are cut where no piece of the vocabulary crosses.
TRIE_BYTES = 48
#: Distinct words in one trie, and bytes of words whose counts a worker remembers between batches.
TRIE_WORDS, REMEMBERED_BYTES = 50_000, 64 << 20
#: Bytes of a long word whose pieces are looked up at a time.
STRETCH = 1 << 20
SPACE = "▁".encode()
#: How much less likely than the rarest piece a single byte outside the vocabulary is (log).
BYTE_PENALTY = 10.0
#: Scores are whole multiples of one in so many, so that equal sums are equal in whatever order they are added.
FIXED = 1 << 24
WORST = -(1 << 62)


class Pieces:
    """A vocabulary with scores: a piece of rank r weighs 1 / (r + 10), by Zipf's law.

    The file gives pieces in order of rank and no probabilities, and none are estimated, since
    tokenizers are not trained here: the scores stand for a unigram model's logarithms.  Every
    single byte is a piece, if only at :data:`BYTE_PENALTY` below the rarest.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        weights = 1.0 / (np.arange(len(plain)) + 10.0)
        logs = np.log(weights / weights.sum())
        fixed = lambda x: round(float(x) * FIXED)
        self.log = {model.id_to_piece(i).encode(): fixed(p) for i, p in zip(plain, logs, strict=True)}
        low = fixed(logs.min() - BYTE_PENALTY)
        for b in range(256):
            self.log.setdefault(bytes([b]), low)
        self.longest = max(map(len, self.log))
        self.tables = {}
        for size in sorted({len(p) for p in self.log}):
            some = [p for p in self.log if len(p) == size]
            h = _hashes(np.frombuffer(b"".join(some), np.uint8).reshape(len(some), size))[:, -1]
            order = np.argsort(h)
            self.tables[size] = h[order], np.array([self.log[p] for p in some], np.int64)[order]

    def alone(self, word: bytes) -> int:
        """Tokens of one word, by the plain recurrence."""
        best, count = [0] + [WORST] * len(word), [0] * (len(word) + 1)
        for d in range(1, len(word) + 1):
            for size in range(1, min(d, self.longest) + 1):
                p = self.log.get(word[d - size : d])
                if p is not None and best[d - size] + p > best[d]:
                    best[d], count[d] = best[d - size] + p, count[d - size] + 1
        return count[-1]

    def parts(self, word: bytes) -> list[bytes]:
        """A word cut wherever no piece of the vocabulary crosses: its segmentations are those of the parts.

        Occurrences of pieces are looked up by hash for a stretch of the word at a time.
        """
        n = len(word)
        crossed = np.zeros(n + 1, np.int32)
        for lo in range(0, n, STRETCH):
            some = np.frombuffer(word[lo : lo + STRETCH + self.longest - 1], np.uint8)
            run = np.r_[np.uint64(0), _hashes(some[None, :])[0]]
            for size, (keys, _) in self.tables.items():
                if size < 2 or size > len(some):
                    continue
                h = (run[size:] - run[:-size]) * _powers(_INVERSE, len(some))[: len(some) - size + 1]
                found = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                at = np.flatnonzero(keys[found] == h) + lo
                # a piece at [i, i + size) forbids the cuts i + 1 .. i + size - 1
                crossed += np.bincount(at + 1, minlength=n + 1)[: n + 1].astype(np.int32) - np.bincount(at + size, minlength=n + 1)[: n + 1].astype(np.int32)
        ends = np.flatnonzero(np.cumsum(crossed) == 0)
        return [word[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Tokens of distinct words of at most :data:`TRIE_BYTES` bytes, by one trie.

        Sorted words make the trie: a node for each distinct prefix.  Scores go forward level by
        level, and each node's best score is computed once however many words pass through it.
        """
        order = sorted(range(len(words)), key=words.__getitem__)
        size = np.array([len(words[i]) for i in order])
        depth = int(size.max())
        grid = np.zeros((len(words), depth), np.uint8)
        grid[np.arange(depth) < size[:, None]] = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
        prefix = _hashes(grid)
        # a word begins a new node at depth d unless it shares d bytes with the one before it
        same = np.logical_and.accumulate((grid[1:] == grid[:-1]) & (np.arange(depth) < np.minimum(size[1:], size[:-1])[:, None]), axis=1)
        node = np.zeros((depth + 1, len(words)), np.int32)
        best, count = [np.zeros(1, np.int64)], [np.zeros(1, np.int32)]
        inverse = _powers(_INVERSE, depth + 1)
        out = np.zeros(len(words), np.int64)
        for d in range(1, depth + 1):
            new = np.r_[True, ~same[:, d - 1]] & (size >= d)
            node[d] = np.maximum(np.cumsum(new) - 1, 0)
            at = np.flatnonzero(new)
            score, tokens = np.full(len(at), WORST), np.zeros(len(at), np.int32)
            for length, (keys, logs) in self.tables.items():
                if length > d:
                    break
                h = prefix[at, d - 1]
                if length < d:
                    h = (h - prefix[at, d - length - 1]) * inverse[d - length]
                found = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[found] == h
                back = node[d - length][at[hit]]
                value = best[d - length][back] + logs[found[hit]]
                where = np.flatnonzero(hit)
                better = value > score[where]
                where, back = where[better], back[better]
                score[where] = value[better]
                tokens[where] = count[d - length][back] + 1
            best.append(score)
            count.append(tokens)
            ends = size == d
            out[ends] = tokens[node[d][ends]]
        result = np.empty(len(words), np.int64)
        result[order] = out
        return result


def _hashes(grid: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes of each row; that of a part follows from two of them."""
    return np.cumsum((grid.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, grid.shape[1]), axis=1)


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Counts:
    """Tokens of words, and what a worker remembers of them."""

    def __init__(self, model: Pieces):
        self.model, self.known, self.bytes = model, {}, 0

    def of(self, words: set[bytes]) -> dict[bytes, int]:
        """Tokens of distinct words: short ones, and the parts of long ones, by the trie."""
        if self.bytes > REMEMBERED_BYTES:
            self.known, self.bytes = {}, 0
        long = {w: self.model.parts(w) for w in words if len(w) > TRIE_BYTES}
        short = {w for w in words if len(w) <= TRIE_BYTES}.union(*long.values())
        fresh = [w for w in short if len(w) <= TRIE_BYTES and w not in self.known]
        for lo in range(0, len(fresh), TRIE_WORDS):
            some = fresh[lo : lo + TRIE_WORDS]
            self.known.update(zip(some, self.model.counts(some).tolist(), strict=True))
        self.bytes += sum(map(len, fresh))
        single = {w: self.model.alone(w) for w in short if len(w) > TRIE_BYTES}
        one = lambda w: single[w] if len(w) > TRIE_BYTES else self.known[w]
        return {w: sum(map(one, long[w])) if w in long else self.known[w] for w in words}


#: One for each vocabulary that this worker has met.
_COUNTS: dict[str, Counts] = {}


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", words: str = "n_words", tokens: str = "n_tokens") -> DataFrame:
    """All columns of ``docs`` with the numbers of pre-tokens and of unigram tokens of whole texts.

    A pre-token is a run between white space with the vocabulary's space mark before it; its tokens
    are those of its most likely segmentation (of equally likely ones, that whose last piece is
    shortest).

    * Null, empty and blank texts count 0 and 0.
    * Repeated rows count each; clashing columns are replaced; an empty table gives an empty table.

    A pass without a shuffle.  Tasks insert the distinct words of some megabytes of text in a trie.
    A word over :data:`TRIE_BYTES`, such as a passage in a script without blanks, goes in as the
    parts that no piece crosses; only a longer part runs alone.  Long words are not remembered, so
    memory is bounded by :data:`TRIE_WORDS` and :data:`REMEMBERED_BYTES`, not by the input.
    """
    kept = [c for c in docs.columns if c.lower() not in {words.lower(), tokens.lower()}]
    t = free_name(docs, "text__")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _COUNTS:
            _COUNTS[vocabulary] = Counts(pieces(vocabulary))
        counts = _COUNTS[vocabulary]
        for batch in batches:
            n, m = [], []
            texts = batch.column(t).to_pylist()
            start = 0
            while start < len(texts):
                stop, size = start, 0
                while stop < len(texts) and (size < 1 << 22 or stop == start):
                    size += len(texts[stop])
                    stop += 1
                split = [s.split() for s in texts[start:stop]]
                coded = {w: SPACE + w.encode("utf-8", "surrogatepass") for w in set().union(*split)}
                got = counts.of(set(coded.values()))
                of = {w: got[b] for w, b in coded.items()}
                n += [len(s) for s in split]
                m += [sum(map(of.__getitem__, s)) for s in split]
                start = stop
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(m, pa.int64())], names=[*kept, words, tokens])

    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(words, T.LongType()), T.StructField(tokens, T.LongType())])
    return mapped(docs.select(*[F.col(quoted(c)) for c in kept], text_or_empty(quoted(text)).alias(t)), counted, schema)
