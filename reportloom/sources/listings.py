"""Large listings in one text file: a header of fields, and records under some of its names.

A listing is what a manifest or a crosswalk is: fields at the margin, of which some hold a list of
records (``- id: ...``) or a map of records (``  key:`` with fields below).  Such a file is read by
several tasks: Spark deals out its lines in blocks, each block is cut into pieces at the marks of
records, and the pieces that a block boundary has cut in two are joined again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fields
from .storage import stored

#: A name at the margin, an item of a list, and a name one level below.
_NAME, _ITEM, _BELOW = re.compile(r"([^\s:#-][^:]*):(\s|$)"), re.compile(r"- |-$"), re.compile(r"  [^\s#-]")
_PIECES = "file string, block long, seq int, section string, kind string, text string"


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, seq, section, kind, text)``: the whole of a listing in pieces, stored.

    ``kind`` is ``name`` (a line at the margin and what follows it), ``item``, ``below`` or ``rest``
    (what a block begins with before its first mark).  ``section`` is the name that a piece stands
    under, null at the beginning of a block.  In the order of file, block and seq the texts are the
    file, line by line.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[str, int] | None = None
        section: str | None = None
        kind, seq, held = "rest", 0, []
        for batch in batches:
            out: list[tuple] = []
            for file, block, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mark = "name" if _NAME.match(line) else "item" if _ITEM.match(line) else "below" if _BELOW.match(line) else None
                if (file, block) != at or mark:
                    if held:
                        out.append((*at, seq, section, kind, "\n".join(held)))
                        seq, held = seq + 1, []
                    if (file, block) != at:
                        at, section, seq = (file, block), None, 0
                    section = _NAME.match(line)[1] if mark == "name" else section
                    kind = mark or "rest"
                held.append(line)
            yield made(out)
        if held:
            yield made([(*at, seq, section, kind, "\n".join(held))])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in _PIECES.split(", ")])

    found = stored(lines.mapInArrow(cut, _PIECES), "pieces")
    # of a block one row: the last name in it; blocks are few, and a block without a name takes the one before it
    blocks = found.groupBy("file", "block").agg(F.max_by("section", F.when(F.col("section").isNotNull(), F.col("seq"))).alias("last"))
    before = F.last("last", ignorenulls=True).over(Window.partitionBy(F.lit(0)).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))
    known = blocks.select("file", "block", before.alias("before"))
    return found.join(F.broadcast(known), ["file", "block"]).withColumn("section", F.coalesce("section", "before")).drop("before")


def records(parts: DataFrame, section: str) -> DataFrame:
    """``(file, block, seq, text)``: the records under a name, each whole, from :func:`pieces`.

    Under a name, items are records, or else what stands one level below.
    """
    own = parts.where(F.col("section") == section)
    mark = own.where(F.col("kind").isin("item", "below")).agg(F.max(F.when(F.col("kind") == "item", "item").otherwise("below")).alias("mark"))
    begins = F.col("kind") == F.col("mark")
    marked = own.where("kind <> 'name'").join(F.broadcast(mark)).withColumn("begins", begins)
    # within a block a piece belongs to the last record that began before it; one before the first, to an earlier block's last
    order = Window.partitionBy("file", "block").orderBy("seq")
    within = marked.withColumn("of", F.last(F.when(F.col("begins"), F.col("seq")), ignorenulls=True).over(order))
    lasts = within.groupBy("file", "block").agg(F.max("of").alias("last"))
    ahead = Window.partitionBy(F.lit(0)).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("last").isNotNull(), F.struct("file", "block", F.col("last").alias("seq"))), ignorenulls=True).over(ahead)
    met = within.join(F.broadcast(lasts.select("file", "block", owner.alias("earlier"))), ["file", "block"])
    of = F.when(F.col("of").isNotNull(), F.struct("file", "block", F.col("of").alias("seq"))).otherwise(F.col("earlier"))
    whole = met.withColumn("record", of).where("record is not null").groupBy("record").agg(F.array_sort(F.collect_list(F.struct("file", "block", "seq", "text"))).alias("parts"))
    return whole.select("record.*", F.array_join("parts.text", "\n").alias("text"))


def header(parts: DataFrame, *sections: str) -> DataFrame:
    """One row ``(text, fields, lists)``: all of a listing but the records under some names, whose bare names stay."""
    own = parts.where(~F.col("section").isin(*sections) | (F.col("kind") == "name")) if sections else parts
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file", "block", "seq", "text"))), lambda p: p["text"]), "\n")
    return own.agg(text.alias("text")).select("text", fields.stated(F.col("text")).alias("s")).select("text", "s.fields", "s.lists")


def read_items(spark: SparkSession, path: str, section: str = "sources") -> DataFrame:
    """``(place, text, fields, lists)`` for the records of a list: ``fields`` by name, all text, null where null."""
    found = records(pieces(spark, path), section)
    block = F.regexp_replace(F.regexp_replace("text", r"\A- ", ""), r"(?m)^  ", "")
    return found.select(_place(), "text", fields.stated(block).alias("s")).select("place", "text", "s.fields", "s.lists")


def read_map(spark: SparkSession, path: str, section: str) -> DataFrame:
    """``(place, key, text, fields)`` for the records of a map: ``fields`` below each key."""
    found = records(pieces(spark, path), section)
    block = F.regexp_replace("text", r"(?m)^  ", "")
    said = found.select(_place(), "text", fields.stated(block).alias("s")).select("place", "text", "s.fields")
    # of a record, names are ``key`` or ``key.field``: the key is what the first line says
    bare = F.element_at(F.map_keys(fields.stated(F.concat(F.regexp_extract("text", r"\A\s*(.*?:)(?:\s|$)", 1), F.lit(" x")))["fields"]), 1)
    keyed = said.select("place", bare.alias("key"), "text", "fields")
    below = F.map_from_entries(F.transform(F.filter(F.map_entries("fields"), lambda e: F.startswith(e["key"], F.concat("key", F.lit(".")))), lambda e: F.struct(F.substr(e["key"], F.length("key") + 2), e["value"])))
    return keyed.select("place", "key", "text", below.alias("fields"))


def _place() -> Column:
    """What orders records as the file does."""
    return F.struct("file", "block", "seq").alias("place")


def item(df: DataFrame, columns: list[str]) -> Column:
    """A record of a list from columns, in their order; nulls are written as null."""
    lines = [F.concat(F.lit(f"{'- ' if i == 0 else '  '}{c}: "), fields.written(F.col(c).cast("string"))) for i, c in enumerate(columns)]
    return F.concat_ws("\n", *lines)


def below(key: str, columns: list[str]) -> Column:
    """A record of a map from a key and columns; null columns are left out."""
    lines = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"    {c}: "), fields.written(F.col(c).cast("string")))) for c in columns]
    return F.concat_ws("\n", F.concat(F.lit("  "), fields.written(F.col(key)), F.lit(":")), *lines)


def write_listing(parts: list[str | DataFrame], path: str) -> None:
    """A listing from texts and tables ``(place, text)`` in order, as a folder of part files in the order of the listing.

    The parts one after the other are the listing.  Records are ordered over all tasks, none of
    which holds more than its range; a folder reads back as a file does.
    """
    spark = next(p for p in parts if isinstance(p, DataFrame)).sparkSession
    rows = None
    for k, p in enumerate(parts):
        df = spark.createDataFrame([(p,)], "text string").select(F.lit(k).alias("k"), F.lit("").alias("place"), "text") if isinstance(p, str) else p.select(F.lit(k).alias("k"), _sortable(p).alias("place"), "text")
        rows = df if rows is None else rows.union(df)
    rows.orderBy("k", "place").select("text").write.mode("overwrite").text(path)


def _sortable(p: DataFrame) -> Column:
    """Places as texts that sort alike: numbers are padded."""
    kind = p.schema["place"].dataType.simpleString()
    if kind.startswith("struct"):
        return F.concat_ws("/", "place.file", F.lpad(F.col("place.block").cast("string"), 20, "0"), F.lpad(F.col("place.seq").cast("string"), 12, "0"))
    return F.col("place").cast("string") if kind == "string" else F.lpad(F.col("place").cast("string"), 20, "0")


def write_manifest(sources: DataFrame, path: str, facts: dict[str, str | list[str] | dict[str, str]], columns: list[str]) -> None:
    """A manifest: facts as its header, then the sources by year, code and id, with these fields in this order."""
    order = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in ("reporting_year", "agency_code")]
    records_ = sources.select(F.concat_ws("\x01", *order, F.col("id")).alias("place"), item(sources, columns).alias("text"))
    write_listing([*_stated(sources.sparkSession, facts), "sources:", records_], path)


def write_crosswalk(mapping: DataFrame, unmapped: DataFrame, path: str, facts: dict[str, str | list[str] | dict[str, str]]) -> None:
    """A crosswalk: facts, then the mapped keys with their slugs and the unmapped ones with reasons, in order."""
    parts: list[str | DataFrame] = _stated(mapping.sparkSession, facts)
    for name, df in (("mapping", mapping), ("unmapped", unmapped)):
        columns = [c for c in df.columns if c != "agency_key"]
        parts += [f"{name}: {{}}"] if df.isEmpty() else [f"{name}:", df.select(F.col("agency_key").alias("place"), below("agency_key", columns).alias("text"))]
    write_listing(parts, path)


def _stated(spark: SparkSession, facts: dict) -> list[str]:
    """Header lines of a few facts: texts, lists of texts, and one level of names."""
    values = [v for f in facts.values() for v in ([f] if isinstance(f, str) else f if isinstance(f, list) else [*f.keys(), *f.values()])]
    said = spark.createDataFrame([(i, v) for i, v in enumerate(values)] or [(0, "")], "i int, v string").select("i", fields.written(F.col("v"))).collect()
    quoted = iter([r[1] for r in sorted(said)])
    out = []
    for name, f in facts.items():
        if isinstance(f, str):
            out.append(f"{name}: {next(quoted)}")
        elif isinstance(f, list):
            out.append("\n".join([f"{name}:", *[f"- {next(quoted)}" for _ in f]]) if f else f"{name}: []")
        else:
            keys = [next(quoted) for _ in f]
            out.append("\n".join([f"{name}:", *[f"  {k}: {next(quoted)}" for k in keys]]) if f else f"{name}: {{}}")
    return out
