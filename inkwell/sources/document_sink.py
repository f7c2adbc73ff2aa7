"""One output file per input document, at the same relative path.

``write_documents`` is a batch data source writer.  Rows are partitioned and
sorted by path; each task streams its documents into a staging folder beside the
target, file by file, and keeps nothing.  A file is written under another name
and then moved, so an attempt that is repeated leaves whole files only.  The
job's commit is one rename of the staging folder to the target, whatever the
number of documents; a failed job removes the staging folder, and the target
stays as it was.  (An object store renames a folder file by file: there the
commit is not atomic.)

Two rows of one path, a null path, or one that leaves the target folder fail the
job.  A null content is an empty file; no rows make an empty folder."""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from inkwell.session import ship_package

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def relative_path(path: Column, root: str) -> Column:
    """Where a scanned file (its URI or path) lies below ``root``; null if it
    does not."""
    base = re.sub(SCHEME, "", root).rstrip("/") + "/"
    plain = F.url_decode(F.replace(F.regexp_replace(path, SCHEME, ""), F.lit("+"), F.lit("%2B")))
    return F.when(plain.startswith(base), F.substr(plain, F.lit(len(base) + 1)))


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^s3a:", "s3:", uri))


def _exists(files: pafs.FileSystem, path: str) -> bool:
    return files.get_file_info(path).type != pafs.FileType.NotFound


def _checked(path: str | None) -> str:
    if not path or path.startswith("/") or {"", ".", ".."} & set(path.split("/")):
        raise ValueError(f"not a path below the target folder: {path!r}")
    return path


@dataclass
class _Documents(WriterCommitMessage):
    n: int


class _DocumentWriter(DataSourceWriter):
    def __init__(self, target: str, stage: str, overwrite: bool):
        self.target, self.stage, self.overwrite = target, stage, overwrite

    def write(self, rows: Iterator[Row]) -> _Documents:
        files, stage = _filesystem(self.stage)
        attempt = uuid.uuid4().hex
        files.create_dir(f"{stage}/attempts", recursive=True)
        last = folder = None
        n = 0
        for path, content in rows:
            path = _checked(path)
            if path == last:
                raise ValueError(f"two documents for {path!r}")
            last, final, part = path, f"{stage}/documents/{path}", f"{stage}/attempts/{attempt}"
            if posixpath.dirname(final) != folder:
                folder = posixpath.dirname(final)
                files.create_dir(folder, recursive=True)
            with files.open_output_stream(part) as out:
                out.write((content or "").encode())
            files.move(part, final)
            n += 1
        return _Documents(n)

    def commit(self, messages: list[_Documents | None]) -> None:
        files, stage = _filesystem(self.stage)
        target = _filesystem(self.target)[1]
        files.create_dir(f"{stage}/documents", recursive=True)
        if _exists(files, target):
            if not self.overwrite:
                raise FileExistsError(self.target)
            files.move(target, f"{stage}/replaced")
        files.create_dir(posixpath.dirname(target), recursive=True)
        files.move(f"{stage}/documents", target)
        files.delete_dir(stage)

    def abort(self, messages: list[_Documents | None]) -> None:
        files, stage = _filesystem(self.stage)
        if _exists(files, stage):
            files.delete_dir(stage)


class DocumentFiles(DataSource):
    """``(path, content)`` rows as files."""

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _DocumentWriter(self.options["target"], self.options["stage"], overwrite)


def write_documents(df: DataFrame, target: str, path: str = "path", content: str = "content",
                    overwrite: bool = False) -> None:
    """Write the text of each row to its path below ``target``.  An existing
    target is an error, or replaced as a whole with ``overwrite``."""
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(DocumentFiles)
    target = target.rstrip("/")
    files, plain = _filesystem(target)
    if not overwrite and _exists(files, plain):
        raise FileExistsError(target)
    rows = df.select(F.col(path).cast("string").alias("path"), F.col(content).cast("string").alias("content"))
    rows.repartition("path").sortWithinPartitions("path").write.format("document_files") \
        .mode("overwrite" if overwrite else "append") \
        .options(target=target, stage=f"{target}.staging-{uuid.uuid4().hex}").save()
