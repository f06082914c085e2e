"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables that each open :func:`scratch` block has written, innermost last.
_OPEN: list[list[str]] = []
#: What names of tables begin with that the session's catalogue knows.
_BUCKETED = "reportloom_"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the one that the cluster names in ``spark.checkpoint.dir``.  Where that is unset, a
    temporary folder serves local masters; on a cluster that would be a different disk for each
    executor, so an unset setting is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), f"reportloom-{spark.sparkContext.applicationId}")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of its own for a table, which the :func:`scratch` block around it deletes."""
    path = f"{shared_dir(spark)}/reportloom/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table to the shared folder and read again: its lineage ends there.

    A lost executor costs only the tasks that it ran, since every reader finds the files.  Results
    that are not computed yet read such tables: they stay until the :func:`scratch` block around
    them ends, or until :func:`discarded`.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buckets(spark: SparkSession) -> int:
    """In how many parts a shuffle of this session is dealt out: ``spark.sql.shuffle.partitions``."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, name: str, parts: int, *keys: str) -> DataFrame:
    """As :func:`stored`, in ``parts`` buckets by a hash of ``keys``: joins and groups by them do not shuffle it again.

    ``df`` is to be repartitioned by ``keys`` into as many ``parts``, which makes a file for each; tasks that
    hold rows of several buckets write several files.  The session's catalogue names the table until it is deleted.
    """
    path = new_path(df.sparkSession, f"{_BUCKETED}{name}")
    df.write.bucketBy(parts, *keys).option("path", path).option("compression", "zstd").saveAsTable(_table(path))
    return df.sparkSession.table(_table(path))


def spread(df: DataFrame) -> DataFrame:
    """``df`` for a join by keys whose sides both grow: it is dealt out by the keys, never sent whole to the driver.

    A table's size is taken for that of its files, and rows that are exploded from it for no larger: what
    compresses well would be broadcast at many times the session's limit for that.
    """
    return df.hint("merge")


def dealt(df: DataFrame) -> DataFrame:
    """Narrow rows that long work follows, dealt out to as many tasks as :func:`buckets` says.

    Spark cuts a scan by the bytes of its files and never inside a row group: millions of short rows that
    texts are rendered from may be one task.
    """
    return df.repartition(buckets(df.sparkSession))


def _table(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


def discarded(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` that nothing reads any more."""
    for t in tables:
        for path in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            if "/reportloom/" in path:
                _dropped(t.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that operators store inside the block are deleted when it ends.

    What is computed from them must be written or collected inside it.
    """
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            _dropped(spark, path)


def _dropped(spark: SparkSession, path: str) -> None:
    if path.rsplit("/", 1)[1].startswith(_BUCKETED):
        spark.sql(f"DROP TABLE IF EXISTS {_table(path)}")
    removed(spark, path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, if it is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
