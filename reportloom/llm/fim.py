"""Fill-in-the-middle: texts cut into prefix, middle and suffix between tokens, and put in another order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BATCH_BYTES, free_name, mapped, quoted, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts, those that are transformed; of a hundred of these, those with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
ADDED = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType()),
])


def boundaries(codes: np.ndarray) -> np.ndarray:
    """Where tokens begin, and the end of the text: a run of ASCII letters is a token, any other code point is one.

    A token begins between two neighbours unless both are letters.
    """
    if not len(codes):
        return np.zeros(1, np.int64)
    letter = ((codes | 0x20) >= 0x61) & ((codes | 0x20) <= 0x7A)
    inner = np.flatnonzero(~(letter[1:] & letter[:-1])) + 1
    return np.concatenate(([0], inner, [len(codes)]))


def transform(text: str, seed: str) -> tuple[int, str, int | None, int | None, str]:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text; ``seed`` decides cuts and form.

    Four numbers are read from the seed's SHA-256: two ranks among the ``n + 1`` places between
    tokens, the share that stays plain, and the share with the suffix first.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at = boundaries(codes)
    n = len(at) - 1
    digest = hashlib.sha256(seed.encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= TRANSFORMED:
        return n, "plain", None, None, text
    lo, hi = at[sorted((h[0] % (n + 1), h[1] % (n + 1)))]
    prefix, middle, suffix = (part.tobytes().decode("utf-32-le") for part in (codes[:lo], codes[lo:hi], codes[hi:]))
    if h[3] % 100 < SUFFIX_FIRST:
        return n, "spm", int(lo), int(hi - lo), f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", int(lo), int(hi - lo), f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that an output was made from.  Parts hold no mark, so the first of each kind is the one put in."""
    if form == "plain":
        return output
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    parts, rest = {}, output.removeprefix(order[0])
    for mark, after in zip(order, order[1:], strict=False):
        parts[mark], _, rest = rest.partition(after)
    return parts[PREFIX] + rest + parts[SUFFIX]


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1) -> DataFrame:
    """``docs`` with ``n`` (tokens), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Each row is transformed for itself by ``seed`` and its id, so a task that runs again gives the
    same rows, and nothing is shuffled.  ``form`` is ``plain`` (the text as it is), ``psm`` or
    ``spm``; the counts of code points are null for plain rows.

    A null text counts as empty, an empty text and one that holds a mark stay plain, a null id
    counts as an empty one; repeated rows give equal rows.  An empty table gives an empty table.
    Columns of ``docs`` that are named like an added one are replaced by it; others stay.
    """
    return _appended(docs, F.concat(F.lit(f"{seed}:"), text_or_empty(quoted(doc_id))), text_or_empty(quoted(text)), ADDED, transform)


def restored(rows: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``rows`` with ``restored``: the exact text, from output and form alone.  Null if either is null."""
    added = T.StructType([T.StructField("restored", T.StringType())])
    return _appended(rows, F.col(quoted(form)), F.col(quoted(output)), added, lambda text, kind: (None if text is None or kind is None else restore(text, kind),))


def _appended(rows: DataFrame, first, second, added: T.StructType, make) -> DataFrame:
    """``rows`` and what ``make(second, first)`` gives for each, as columns ``added``."""
    wanted = {f.name.lower() for f in added}
    kept = [c for c in rows.columns if c.lower() not in wanted]
    a = free_name(rows, "seed_")
    b = free_name(rows, "text_")
    given = rows.select(*[quoted(c) for c in kept], first.alias(a), second.alias(b))
    out_types = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.string() for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, made, size = 0, [], 0
            seeds, texts = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            for i in range(batch.num_rows):
                made.append(make(texts[i].as_py(), seeds[i].as_py()))
                size += sum(len(x) for x in made[-1] if isinstance(x, str))
                if size > BATCH_BYTES or i + 1 == batch.num_rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), out_types, strict=True)]
                    same = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([*same.columns[: len(kept)], *columns], names=[str(k) for k in range(len(kept) + len(columns))])
                    start, made, size = i + 1, [], 0

    schema = T.StructType([given.schema[c] for c in kept] + list(added))
    return mapped(given, run, schema)
