"""Folders of many small files, listed and read by tasks.

Spark's reader lists every file on the driver and keeps its status there, so one
document per file fills the driver.  Here the driver lists ``LISTED`` entries at
most; of a larger tree each level of folders is listed by tasks into a table, and
the files are dealt to reading tasks by number and size.  One folder is listed by
one task, as a stream.

This needs paths that all executors open, so it covers ``file:`` paths (a shared
mount; in local mode any folder).  ``local_roots`` tells them from those that stay
with Spark's reader: other file systems, globs and missing paths.  The same entries
count as for Spark: no empty file and no name with a leading ``_`` or ``.``."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections import deque
from collections.abc import Iterator
from functools import reduce
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.session import materialize_table, ship_package

#: Entries that the driver lists itself, and that a listing task gives at a time.
LISTED = 10_000
#: Folders of a listing task, files and bytes of a reading task, and of one batch.
FOLDERS, FILES, BYTES, BATCH = 5_000, 2_000, 64 << 20, 4 << 20
#: Up to so many tasks a scan heeds ``spark.sql.files.maxPartitionBytes``.
TASKS = 256
#: Larger files are Spark's to read.
LARGE = 64 << 20

_GLOB = re.compile(r"[{}\[\]*?\\]")
_ESCAPED = re.compile(r"[^A-Za-z0-9\-_.!~*'():@&=+$,;/]")


def local_roots(spark: SparkSession, path: str | list[str]) -> list[str] | None:
    """The paths without scheme, if all are existing ``file:`` paths."""
    default = spark._jsparkSession.sessionState().newHadoopConf().get("fs.defaultFS", "file:///")
    roots = []
    for p in [path] if isinstance(path, str) else path:
        scheme, rest = re.match(r"(?s)(?:([A-Za-z][A-Za-z0-9+.-]*):(?://(?=/))?)?(.*)", p).groups()
        if (scheme or default.partition(":")[0]) != "file" or _GLOB.search(p) or not rest or not os.path.exists(rest):
            return None
        roots.append(os.path.abspath(rest))
    return roots


def file_uri(path: str) -> str:
    """As in Spark's ``_metadata``: ASCII but for a URI's legal characters is
    escaped, and so are other spaces and control characters."""
    def escaped(c: re.Match) -> str:
        return c[0] if c[0] > "\x7f" and unicodedata.category(c[0]) not in ("Zs", "Zl", "Zp", "Cc") else quote(c[0], safe="")
    return _ESCAPED.sub(escaped, path)


def _is_data(name: str) -> bool:
    return not (name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_"))


def _entries(folder: str) -> Iterator[tuple[str, int | None]]:
    """Paths in a folder: files with their size, folders with none."""
    with os.scandir(folder) as found:
        for e in found:
            if e.is_dir():
                if _is_data(e.name) or e.name.startswith(("_metadata", "_common_metadata")):
                    yield e.path, None
            elif _is_data(e.name) and e.is_file() and (size := e.stat().st_size):
                yield e.path, size


def _begun(roots: list[str]) -> tuple[list[tuple[str, int]], list[str]]:
    """Files of the first ``LISTED`` entries, and the folders that are left."""
    folders = deque(dict.fromkeys(r for r in roots if os.path.isdir(r)))
    files = [(r, size) for r in roots if not os.path.isdir(r) and _is_data(os.path.basename(r)) and (size := os.path.getsize(r))]
    seen = 0
    while folders:
        found = list(islice(_entries(folders[0]), LISTED + 1 - seen))
        seen += len(found)
        if seen > LISTED:
            break
        folders.popleft()
        files += [e for e in found if e[1] is not None]
        folders += [path for path, size in found if size is None]
    return files, list(folders)


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            entries = _entries(folder)
            while some := list(islice(entries, LISTED)):
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in some], pa.string()),
                                                  pa.array([n for _, n in some], pa.int64())], ["path", "bytes"])


def list_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    """``path, bytes`` of every file below the roots.  Levels that the driver
    does not list are jobs of their own, run when the plan is built."""
    ship_package(spark)
    files, folders = _begun(roots)
    found = [spark.createDataFrame(files, "path string, bytes long")]
    level, n = spark.createDataFrame([(f,) for f in folders], "path string"), len(folders)
    while n:
        tasks = max(min(n, spark.sparkContext.defaultParallelism), -(-n // FOLDERS))
        entries = materialize_table(level.repartition(tasks).mapInArrow(_list, "path string, bytes long"), "files-listed")
        found.append(entries.where("bytes IS NOT NULL"))
        level = entries.where("bytes IS NULL").select("path")
        n = level.count()
    listed = reduce(DataFrame.unionByName, found)
    return listed if len(roots) == 1 else listed.dropDuplicates(["path"])


def _text(raw: bytes) -> str:
    """Decoded as a JSON parser does.  Bytes that are no character become one
    that no JSON value may hold, so that the parser fails there as on the bytes."""
    encoding = json.detect_encoding(raw)
    try:
        return raw.decode(encoding)
    except UnicodeDecodeError:
        return raw.decode(encoding, "replace").replace("\ufffd", "\x01")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (keys, names, texts)], ["path_key", "file_name", "content"])

    keys, names, texts, held = [], [], [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with open(path, "rb") as f:
                raw = f.read()
            text = _text(raw)
            if not text.strip(" \t\r\n"):
                continue
            uri = file_uri(path)
            keys.append(f"file:{uri}")
            names.append(uri.rpartition("/")[2])
            texts.append(text)
            held += len(raw)
            if held >= BATCH or len(keys) >= FILES:
                yield packed()
                keys, names, texts, held = [], [], [], 0
    if keys:
        yield packed()


def read_small(listed: DataFrame) -> tuple[DataFrame, list[str]]:
    """``path_key, file_name, content`` of the listed files that are not blank,
    and the paths of the large ones, which are not among them."""
    spark = listed.sparkSession
    small = listed.where(F.col("bytes") <= LARGE)
    n, total = small.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    wanted = -(-total // max(1, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()))
    tasks = max(1, min(n, max(spark.sparkContext.defaultParallelism, min(wanted, TASKS))), -(-n // FILES), -(-total // BYTES))
    contents = small.select("path").repartition(tasks).mapInArrow(_read, "path_key string, file_name string, content string")
    return contents, [r["path"] for r in listed.where(F.col("bytes") > LARGE).select("path").collect()]
