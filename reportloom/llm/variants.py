"""Spelling variants: words one edit apart, found by a join over single deletions, and grouped under their commonest form."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discarded, mapped, quoted, stored, text_or_empty

#: What words are made of: Latin letters without and with marks.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Different words that a task counts before it hands them on.
COUNTED = 200_000
#: Code points of a word, or of what is left after a deletion, that travel as they are; longer ones as digests.
LONG = 64
#: Rows of keys in one Arrow batch.
KEYS = 50_000
#: Modulus and base of the hash of long words' deletions; equal hashes are only candidates.
MOD, BASE = (1 << 61) - 1, 1_000_003


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3, typos: int | None = None) -> DataFrame:
    """``(word, n)``: runs of letters, A-Z lower-cased, of at least so many code points and occurrences.

    ``typos`` puts misspellings in: where it divides ``h``, the CRC-32 of ``<doc_id>:<run>``, the
    run loses its code point ``h % length``.  Null texts have no words; a null id is an empty one.
    Words are counted in tasks, then by Spark with combining, so what is shuffled is at most a row
    for each task and word.
    """
    given = docs.select(text_or_empty(quoted(doc_id)).alias("id"), text_or_empty(quoted(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for id, t in zip(*batch.columns, strict=True):
                own = Counter(RUN.findall(t.as_buffer().to_pybytes().lower().decode()))
                seed = zlib.crc32(f"{id.as_py()}:".encode())
                for word, n in own.items():
                    if typos and (h := zlib.crc32(word.encode(), seed)) % typos == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1 :]
                    if len(word) >= least_length:
                        total[word] += n
            if len(total) >= COUNTED:
                yield from counted(total)
                total = Counter()
        yield from counted(total)

    def counted(total: Counter[str]) -> Iterator[pa.RecordBatch]:
        words = list(total)
        for i in range(0, len(words), KEYS):
            yield pa.RecordBatch.from_arrays([pa.array(words[i : i + KEYS], pa.string()), pa.array([total[w] for w in words[i : i + KEYS]], pa.int64())], names=["word", "n"])

    partial = mapped(given, run, T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]))
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def deletions(word: str) -> Iterator[str]:
    """The word and what is left of it after each single deletion, each once, as keys.

    A letter of a stretch of equal letters is deleted once.  Keys beyond :data:`LONG` code points
    are hashes, all of a word's in linear time.
    """
    n = len(word)
    at = [i for i in range(n) if i == 0 or word[i] != word[i - 1]]
    if n > LONG + 1:
        yield from _long(word, at)
        return
    yield word if n <= LONG else next(_long(word, []))
    for i in at:
        yield word[:i] + word[i + 1 :]


def _long(word: str, at: list[int]) -> Iterator[str]:
    """Hashed keys of a long word: from hashes of its beginnings, that of each deletion in one step."""
    n = len(word)
    head, power = [0], [1]
    for c in word:
        head.append((head[-1] * BASE + ord(c)) % MOD)
        power.append(power[-1] * BASE % MOD)
    yield f"#{n}:{head[n]:x}"
    for i in at:
        rest = (head[n] - head[i + 1] * power[n - i - 1]) % MOD
        yield f"#{n - 1}:{(head[i] * power[n - i - 1] + rest) % MOD:x}"


def keyed(words: DataFrame) -> DataFrame:
    """``(key, ref, n)``: a row for each key of each word; ``ref`` is the word, or a digest of a long one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[str] = []
        refs: list[str] = []
        counts: list[int] = []
        for batch in batches:
            for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ref = word if len(word) <= LONG else f"#{hashlib.sha256(word.encode()).hexdigest()}"
                for key in deletions(word):
                    keys.append(key)
                    refs.append(ref)
                    counts.append(n)
                    if len(keys) >= KEYS:
                        yield made(keys, refs, counts)
                        keys, refs, counts = [], [], []
        yield made(keys, refs, counts)

    def made(keys: list[str], refs: list[str], counts: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(refs, pa.string()), pa.array(counts, pa.int64())], names=["key", "ref", "n"])

    fields = [T.StructField("key", T.StringType()), T.StructField("ref", T.StringType()), T.StructField("n", T.LongType())]
    return mapped(words.select("word", "n"), run, T.StructType(fields))


def near(words: DataFrame) -> DataFrame:
    """``(word, other, other_n)``, both ways round: words of a table ``(word, n)`` exactly one edit apart.

    Words that share a key are candidates; what they share may be two deletions at different
    places, so each is verified.  A key has at most as many words as there are ways to put one
    letter into it.  A pair that shares several keys comes several times.
    """
    keys = stored(keyed(words), "keys")
    digest = lambda x: F.col(x).startswith("#")
    short = _met(keys.where(~digest("ref"))).where(F.levenshtein("ref_a", "ref_b", 1) == 1)
    # a digest sorts before any letter, so of a pair with one it is ref_a; such pairs share a key of LONG code points or more
    far = _met(keys.where(digest("key") | (F.length("key") >= LONG))).where(digest("ref_a")).drop("key").distinct()
    long = words.where(F.length("word") > LONG).select(F.concat(F.lit("#"), F.sha2("word", 256)).alias("of"), "word")
    far = far.join(long.select(F.col("of").alias("ref_a"), F.col("word").alias("word_a")), "ref_a")
    far = far.join(long.select(F.col("of").alias("ref_b"), F.col("word").alias("word_b")), "ref_b", "left").withColumn("word_b", F.coalesce("word_b", "ref_b"))
    far = far.where(F.levenshtein("word_a", "word_b", 1) == 1)
    pairs = short.select("ref_a", "n_a", "ref_b", "n_b").union(far.select("word_a", "n_a", "word_b", "n_b")).toDF("a", "na", "b", "nb")
    ways = F.inline(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("other_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("other_n"))))
    return pairs.select(ways)


def _met(keys: DataFrame) -> DataFrame:
    """Pairs of words that share a key."""
    a, b = (keys.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("ref", "n")]) for x in "ab")
    return a.join(b, "key").where(F.col("ref_a") < F.col("ref_b"))


def forms(words: DataFrame) -> DataFrame:
    """``words`` (``word, n``) with ``n_near``, ``form`` and ``form_n``.

    ``form`` is the near word with the largest ``n`` (of equal ones the least in code-point order),
    if that is at least twice the word's own; else null.
    """
    # dealt out by word alone, distinct pairs and their counts need no second exchange
    pairs = near(words).repartition("word").groupBy("word", "other").agg(F.max("other_n").alias("other_n"))
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    met = words.join(best, "word", "left")
    takes = -F.col("best.less") >= 2 * F.col("n")
    pick = lambda c: F.when(takes, c)
    return met.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), pick(F.col("best.other")).alias("form"), pick(-F.col("best.less")).alias("form_n"))


def rooted(links: DataFrame) -> DataFrame:
    """``(word, root)`` for links ``(word, form)``: where following forms ends.

    Each round joins the pointers with themselves and doubles how far they reach; words whose
    pointer has arrived take no further part.  Counts at least double along a link, so a chain has
    at most the logarithm of the largest count and there is no ring.
    """
    now = stored(links.select("word", F.col("form").alias("at"), F.lit(False).alias("there")), "roots")
    while True:
        reach = now.select(F.col("word").alias("by"), F.col("at").alias("next"))
        step = now.where("not there").join(reach, F.col("at") == F.col("by"), "left")
        step = step.select("word", F.coalesce("next", "at").alias("at"), F.col("by").isNull().alias("there"))
        following = stored(now.where("there").union(step), "roots")
        discarded(now)
        now = following
        if now.where("not there").isEmpty():
            return now.select("word", F.col("at").alias("root"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3, typos: int | None = None) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)``: the words of all texts and the spellings they go back to.

    See :func:`word_counts` for what a word is and :func:`forms` for its form; ``root`` is where the
    forms lead, the word itself if it has none.

    * Null and empty texts have no words, and repeated rows count each time; a table without words
      gives an empty table.  Other columns are not used.
    * A very long run of letters is a word like others: its keys are hashes, linear in its length.
    """
    words = stored(word_counts(docs, doc_id, text, least_length, least_count, typos), "words")
    formed = stored(forms(words), "forms")
    discarded(words)
    roots = rooted(formed.where("form is not null").select("word", "form"))
    return formed.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
