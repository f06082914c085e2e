"""From raw documents to token ids: five stages, each by one operator of ``reportloom.llm``.

Every stage reads what the one before it kept, whole; all but the last return the columns of the
documents table.  Columns that a stage does not read travel beside it in a struct, so none of them
can clash with what its operator adds, whatever their names.  An empty table passes through every
stage, and repeated rows are judged, cleaned and encoded alike.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.llm import bpe, jaccard, line_dedup, mixing, toxicity
from reportloom.llm.common import free_name, quoted, read_table, removed, scratch, shared_dir
from reportloom.llm.queries import LINE_PAGES, LINE_RATIO, MIX_SEED, MIX_TEMPERATURE, vocabulary

#: SQL cannot express classifiers, near-duplicate classes or BPE; tests hold stages to brute force.
ORACLE_SQL = None


def _carried(docs: DataFrame, *read: str) -> DataFrame:
    """The columns that a stage reads, and all others in the struct ``CARRIED``."""
    rest = [c for c in docs.columns if c not in read]
    return docs.select(*[F.col(quoted(c)) for c in read], F.struct(*[F.col(quoted(c)).alias(c) for c in rest]).alias(CARRIED))


def _restored(df: DataFrame, docs: DataFrame, read: tuple[str, ...], **changed: Column) -> DataFrame:
    """The columns of ``docs``, in their order, those named with a new value."""
    of = lambda c: changed.get(c, F.col(quoted(c)) if c in read else F.col(CARRIED).getField(c))
    return df.select(*[of(c).alias(c) for c in docs.columns])


#: Columns that a stage does not read, as a struct.
CARRIED = "carried__"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity chain rejects go.

    Null and empty texts hold no feature and are judged by what is left: they stay where toxic
    documents are the fewer.  Without labels of both kinds every document stays.
    """
    read = ("doc_id", "text")
    judged = toxicity.judge(_carried(docs, *read), read_table(spark, sf_dir, "labels"))
    return _restored(judged.where("not toxic"), docs, read)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a source repeats over its documents, or those of one language, go; ``n_chars`` follows the text.

    Documents of a source with the same text count as one page, so that copies, which the next
    stage removes, do not turn their own lines into boilerplate.  Null texts stay null with a null
    ``n_chars``; every document stays, if with an empty text.
    """
    read = ("source", "lang", "text")
    cleaned = line_dedup.drop_lines(_carried(docs, *read), ratio=LINE_RATIO, least=LINE_PAGES, section="lang", distinct=True)
    return _restored(cleaned, docs, read, n_chars=F.length("text").cast("long"))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a likeness of 0.8, the smallest id stays.

    Documents without words are their own class and stay, as do rows without an id; rows that share
    an id are told apart by their texts, and of those that share both one stays.
    """
    read = ("doc_id", "text")
    return _restored(jaccard.keep_one(_carried(docs, *read), width=5, percent=80), docs, read)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat to the sources' target weights, in a shuffled order.

    Null is a source of its own.  A document's count hangs on its id: rows that share one, or have
    none, repeat alike.  That some documents are drawn no time is what mixing does.
    """
    read = ("doc_id", "source")
    return _restored(mixing.mix(_carried(docs, *read), temperature=MIX_TEMPERATURE, seed=MIX_SEED), docs, read)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each whole text, with their number and the SHA-256 of the text decoded from them.

    Null and empty texts have no ids.  An input column named as one of the three is replaced.
    """
    added = ["ids", "n_tokens", "decoded_sha256"]
    decoded = free_name(docs, "decoded__")
    both = bpe.encode(docs.select(*[F.col(quoted(c)) for c in docs.columns if c.lower() not in added]), vocabulary(), decoded=decoded)
    both = both.withColumns({"n_tokens": F.floor(F.length("ids") / 4).cast("long"), "decoded_sha256": F.sha2(F.col(decoded).cast("binary"), 256)})
    return both.drop(decoded)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_boilerplate),
    ("ngram_join", one_of_each_class),
    ("mixing", mixed),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data directory, each written before the next reads it.

    What a stage stored on its way goes when its result is written, and each result goes when the
    next one is; only what the last stage reads stays.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/reportloom/pipeline-{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            removed(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
