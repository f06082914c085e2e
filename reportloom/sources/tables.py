"""Parquet tables of a data directory, of candidate folders, and of results kept from run to run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def there(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, by Hadoop's file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def first_table(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """The table at the first of some candidate paths that is there; None if none is.

    A check that needs it is then skipped, which is not a pass (see ``quality.outcome``).
    """
    found = next((p for p in paths if there(spark, p)), None)
    return None if found is None else spark.read.parquet(found)


def kept(spark: SparkSession, path: str, build: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
    """The table at ``path``, built and written if it is not there yet or ``refresh`` asks for it.

    A folder counts once its writer has marked it as whole, so a run that was lost is built again.
    """
    if refresh or not there(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
