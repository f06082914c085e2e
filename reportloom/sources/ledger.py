"""Tables derived from a folder of files, kept up to date by what has changed in it.

The ledger has a row for each file: path, length, time and content hash.  A refresh lists the
folder, reads only files whose length or time is new, and derives rows anew only for documents of
which a file's content is new or a file is gone.  Ledger and tables are parted into buckets by the
document, and only the buckets of such documents are written again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import located
from .storage import new_path, removed, scratch, stored
from .tables import there

#: Folders of a table, and bytes of files that a task reads.
BUCKETS, TASK_BYTES = 256, 64 << 20
#: Files that a task lists, and bytes of contents that a task hands on at a time, about.
LISTED, BATCH_BYTES = 4096, 8 << 20
#: Files that are part of a document.
GLOB = "*.{md,txt}"
_FILE = "path string, doc_id string, length long, modified timestamp, sha256 string"

#: From ``(doc_id, path, content)``, all files of some documents, to tables by name, each with a column ``doc_id``.
Build = Callable[[DataFrame], dict[str, DataFrame]]


@dataclass(frozen=True)
class Refreshed:
    """Files that were read, documents whose rows were derived anew, and documents that are gone."""

    read: int
    built: int
    gone: int


def listed(spark: SparkSession, root: str, glob: str = GLOB) -> DataFrame:
    """``(path, doc_id, length, modified)`` of the files below a folder, stored; none is opened.

    Spark deals files out to tasks as if each cost the reading of 4 MB: where none is read, a session
    with other such costs lists :data:`LISTED` of them in a task.

    A document's files share their name up to the first dot.  Names that begin with ``_`` or a dot
    and CHANGELOG files belong to none.  Spark lists no file without a byte: such a file is as one that
    is not there, for a refresh as for a scan.
    """
    own = spark.newSession()
    for name, size in (("openCostInBytes", 1 << 20), ("maxPartitionBytes", LISTED << 20)):
        own.conf.set(f"spark.sql.files.{name}", str(size))
    files = own.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    doc = F.substring_index(F.element_at(F.split("path", "/"), -1), ".", 1)
    rows = files.select("path", doc.alias("doc_id"), "length", F.col("modificationTime").alias("modified"))
    rows, path = rows.where(~F.col("doc_id").startswith("_") & ~F.col("doc_id").isin("", "CHANGELOG")), new_path(spark, "listing")
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def contents(files: DataFrame) -> DataFrame:
    """``files`` with ``content`` and ``sha256``, read in tasks of about :data:`TASK_BYTES`; stored.

    What is no UTF-8 is replaced in ``content``; the hash is of the bytes.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, hashes, first, size = [], [], 0, 0
            for i, path in enumerate(batch["path"].to_pylist(), 1):
                system, at = located(path)
                with system.open_input_stream(at) as f:
                    data = f.read()
                texts.append(data.decode(errors="replace"))
                hashes.append(hashlib.sha256(data).hexdigest())
                size += len(data)
                if size >= BATCH_BYTES or i == batch.num_rows:
                    rows = batch.slice(first, i - first)
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string()), pa.array(hashes, pa.string())], names=[*rows.schema.names, "content", "sha256"])
                    texts, hashes, first, size = [], [], i, 0

    found = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    tasks = max(1, min(found["n"], found["bytes"] // TASK_BYTES + files.sparkSession.sparkContext.defaultParallelism))
    kept = files.select("path", "doc_id", "length", "modified").repartition(tasks, "path")
    return stored(kept.mapInArrow(read, "path string, doc_id string, length long, modified timestamp, content string, sha256 string"), "contents")


def refresh(spark: SparkSession, root: str, target: str, build: Build, buckets: int = BUCKETS, glob: str = GLOB) -> Refreshed:
    """Bring the tables at ``target`` up to date with the files below ``root``.

    The new rows of the buckets that change are written beside the tables first.  A run that is lost
    before they are whole has changed nothing; one that is lost later is finished by the next, which
    puts them in place again.  One run at a time; ``buckets`` counts for the first run, and later ones
    keep it.  What ``build`` gives for a document must depend on its files alone and keep its columns.
    """
    target = target.rstrip("/")
    _put(spark, target)
    if not there(spark, f"{target}/layout/_SUCCESS"):
        spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").parquet(f"{target}/layout")
    buckets = spark.read.parquet(f"{target}/layout").first()["buckets"]
    with scratch(spark):
        return _refresh(spark, root, target, build, buckets, glob)


def table_of(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A table that :func:`refresh` keeps, its bucket left out."""
    schema = spark.read.parquet(f"{target}/schemas/{name}").schema
    return _rows(spark, f"{target}/{name}", schema).drop("bucket")


def _rows(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if there(spark, path) else spark.createDataFrame([], schema)


def _refresh(spark: SparkSession, root: str, target: str, build: Build, buckets: int, glob: str) -> Refreshed:
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")
    ledger_type = spark.createDataFrame([], f"{_FILE}, bucket int").schema
    ledger = _rows(spark, f"{target}/ledger", ledger_type)
    now = listed(spark, root, glob)
    odd = contents(now.join(ledger, ["path", "length", "modified"], "left_anti"))
    lost = stored(ledger.join(now, "path", "left_anti").select("path", "doc_id"), "lost")
    fresh = odd.join(ledger.select("path", "sha256"), ["path", "sha256"], "left_anti").select("doc_id")
    changed = stored(fresh.union(lost.select("doc_id")).distinct(), "changed")
    read, n_changed = odd.count(), changed.count()
    if not read and not n_changed:
        return Refreshed(0, 0, 0)

    names: list[str] = []
    marks: list[DataFrame] = []
    if n_changed:
        rest = now.join(changed, "doc_id", "left_semi").join(odd, "path", "left_anti")
        files = odd.join(changed, "doc_id", "left_semi").unionByName(contents(rest))
        touched = _of(changed, bucket)
        for name, rows in build(files.select("doc_id", "path", "content")).items():
            if name in ("ledger", "layout", "schemas", "pending"):
                raise ValueError(f"a table cannot be named {name}")
            rows = rows.withColumn("bucket", bucket)
            old = _rows(spark, f"{target}/{name}", rows.schema).where(F.col("bucket").isin(touched))
            _pend(old.join(changed, "doc_id", "left_anti").unionByName(rows), target, name)
            marks.append(spark.createDataFrame([(name, b) for b in touched], "name string, bucket int"))
            names.append(name)
    moved = odd.select("doc_id").union(lost.select("doc_id")).distinct()
    touched = _of(moved, bucket)
    old = ledger.where(F.col("bucket").isin(touched)).join(odd.select("path").union(lost.select("path")), "path", "left_anti")
    marks.append(spark.createDataFrame([("ledger", b) for b in touched], "name string, bucket int"))
    reduce(DataFrame.union, marks).coalesce(1).write.mode("overwrite").parquet(f"{target}/pending/buckets")
    # the ledger comes last: when it is whole, so is all that it speaks of
    _pend(old.unionByName(odd.drop("content").withColumn("bucket", bucket)), target, "ledger")
    _put(spark, target)
    gone = changed.join(now, "doc_id", "left_anti").count()
    return Refreshed(read, n_changed - gone, gone)


def _of(docs: DataFrame, bucket) -> list[int]:
    """The buckets of some documents: numbers, as many as there are buckets at most."""
    return sorted(r["b"] for r in docs.select(bucket.alias("b")).distinct().collect())


def _pend(rows: DataFrame, target: str, name: str) -> None:
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/pending/{name}")


def _put(spark: SparkSession, target: str) -> None:
    """Put pending buckets in place, if they are whole; doing so again changes nothing."""
    pending = f"{target}/pending"
    if there(spark, f"{pending}/ledger/_SUCCESS"):
        marks: dict[str, set[int]] = {}
        for row in spark.read.parquet(f"{pending}/buckets").collect():
            marks.setdefault(row["name"], set()).add(row["bucket"])
        for name in sorted(marks, key=lambda n: (n == "ledger", n)):
            rows = spark.read.parquet(f"{pending}/{name}")
            rows.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{target}/schemas/{name}")
            filled = {r["bucket"] for r in rows.select("bucket").distinct().collect()}
            dealt = rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            dealt.option("compression", "zstd").partitionBy("bucket").parquet(f"{target}/{name}")
            for b in sorted(marks[name] - filled):
                removed(spark, f"{target}/{name}/bucket={b}")
        # without the ledger the rest is no pending set any more
        removed(spark, f"{pending}/ledger")
    removed(spark, pending)
