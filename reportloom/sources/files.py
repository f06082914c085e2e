"""A writer of one file for each row: Spark's own writers put many rows into a file."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Wrote(WriterCommitMessage):
    files: int


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path on it; local paths and the URIs that Arrow knows."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.rstrip("/"))


class FileForEach(DataSource):
    """``df.write.format("file_for_each").mode("overwrite").save(folder)`` for rows ``(name, content)``."""

    @classmethod
    def name(cls) -> str:
        return "file_for_each"

    def schema(self) -> str:
        return "name string, content string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if not overwrite:
            raise ValueError("a folder of files is written as a whole: mode must be overwrite")
        writer = FolderWriter(self.options["path"].rstrip("/"))
        writer.begin()
        return writer


class FolderWriter(DataSourceWriter):
    """Tasks write to a folder beside the target, and the whole set takes the target's place at once.

    A task that runs again writes the same names again.  If a task fails for good, the folder beside
    is renamed and deleted: tasks that still run make folders only inside it, so they fail then and
    bring nothing back.  The old files are as they were.  Taking the place is two renames, whatever the number
    of files; file systems without renames of folders are no place for this.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.own = uuid.uuid4().hex

    def aside(self, kind: str) -> str:
        return f"{located(self.path)[1]}.{kind}-{self.own}"

    def begin(self) -> None:
        files, _ = located(self.path)
        files.create_dir(self.aside("new"), recursive=True)

    def write(self, iterator: Iterator[Row]) -> Wrote:
        files, _ = located(self.path)
        made, n = set(), 0
        for row in iterator:
            parts = (row["name"] or "").split("/")
            if any(p in ("", ".", "..") for p in parts):
                raise ValueError(f"no name for a file: {row['name']!r}")
            folder = self.aside("new")
            for part in parts[:-1]:
                folder = f"{folder}/{part}"
                if folder not in made:
                    files.create_dir(folder, recursive=False)
                    made.add(folder)
            with files.open_output_stream(f"{folder}/{parts[-1]}") as out:
                out.write((row["content"] or "").encode())
            n += 1
        return Wrote(n)

    def commit(self, messages: list[Wrote | None]) -> None:
        files, path = located(self.path)
        there = files.get_file_info(path).type != fs.FileType.NotFound
        if there:
            files.move(path, self.aside("old"))
        try:
            files.move(self.aside("new"), path)
        except Exception:
            if there:
                files.move(self.aside("old"), path)
            raise
        if there:
            files.delete_dir(self.aside("old"))

    def abort(self, messages: list[Wrote | None]) -> None:
        files, _ = located(self.path)
        if files.get_file_info(self.aside("new")).type != fs.FileType.NotFound:
            files.move(self.aside("new"), self.aside("gone"))
            files.delete_dir(self.aside("gone"))


def write_files(rows: DataFrame, path: str) -> None:
    """Rows ``(name, content)`` as files of a folder, which they replace as a whole.

    Names may hold folders; two rows of one name are an error, found before anything is written.
    The folder must be one that every executor can reach by that path.
    """
    named = rows.select("name", "content")
    again = named.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").orderBy("name").limit(5).collect()
    if again:
        raise ValueError(f"several rows have one name: {[r['name'] for r in again]}")
    rows.sparkSession.dataSource.register(FileForEach)
    named.write.format("file_for_each").mode("overwrite").save(path)
