"""Helpers shared by the operators: shared-folder tables, readers and small expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.storage import discarded, new_path, removed, scratch, shared_dir, spread, stored

__all__ = ["discarded", "new_path", "removed", "scratch", "shared_dir", "spread", "stored"]

#: Rows written to one Arrow batch by the Python stages hold at most about this many bytes.
BATCH_BYTES = 8 << 20
#: Rows whose texts a task turns into Python strings at a time.
SLICE = 1_000
#: A key is heavy if it has over one in so many rows: fewer keys than that can be, so they may be broadcast.
HEAVY = 1_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of so many at most, without a copy."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` for columns of any name, dots included, :data:`SLICE` rows at a time."""
    given, made = df.columns, [f"c{i}" for i in range(len(schema))]

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(pa.RecordBatch.from_arrays(b.columns, names=given) for b in slices(batches)):
            yield pa.RecordBatch.from_arrays(out.columns, names=made)

    plain = T.StructType([T.StructField(n, f.dataType) for n, f in zip(made, schema, strict=True)])
    return df.toDF(*[f"c{i}" for i in range(len(given))]).mapInArrow(renamed, plain).toDF(*schema.names)


def text_or_empty(column: str | Column) -> Column:
    """A text column with null read as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def quoted(name: str) -> str:
    """A column name as a reference that survives dots and backticks."""
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name like ``wanted`` that ``df`` does not use in any letter case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
