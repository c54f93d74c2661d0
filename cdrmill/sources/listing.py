"""Input files from the listing: which are new, how large, how compressed.

A file is known by its full path, so files of one name in two hour folders
are two files.  Logged files are taken out of the listing before anything is
read, so a load over a growing landing folder scans its new files only.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrmill.functions.parse import base_name
from cdrmill.operators.lookup import sized_broadcast
from cdrmill.session import in_bytes, setting
from cdrmill.sources.text import UNSPLITTABLE

WHOLE_FILE = 64 << 20  # compressed files up to this size are read by a task each
MANY_FILES = 8         # so many of them keep the tasks busy without being spread
PACKED = 8             # text bytes taken for a byte of a compressed file


@dataclass(frozen=True)
class InputFile:
    path: str
    name: str    # base name, or the folder partition that names the logical file
    length: int
    modified: float = 0.0

    @property
    def splittable(self) -> bool:
        return not self.path.lower().endswith(UNSPLITTABLE)

    @property
    def text_bytes(self) -> int:
        """About the size of its text."""
        return self.length * (1 if self.splittable else PACKED)


def logical_name(path, source_col: str | None):
    """Column: the file's name as the outputs show it."""
    if source_col is None:
        return base_name(path)
    return F.regexp_extract(path, rf"/{re.escape(source_col)}=([^/]+)/", 1)


def list_files(spark: SparkSession, paths: str | Sequence[str],
               source_col: str | None = None) -> DataFrame:
    """``path, name, length, modificationTime`` of the input files, folders listed to the
    bottom; no content is read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
            .select("path", logical_name(F.col("path"), source_col).alias("name"), "length",
                    "modificationTime"))


def without_logged(files: DataFrame, log: DataFrame) -> DataFrame:
    """The files not in the log.  A log entry without a path (written by hand or
    by an older version) stands for every file of its name."""
    paths, _ = sized_broadcast(log.where("path is not null").select("path").distinct())
    names, _ = sized_broadcast(log.where("path is null and filename is not null")
                               .select(F.col("filename").alias("name")).distinct())
    return files.join(paths, "path", "left_anti").join(names, "name", "left_anti")


def new_input_files(spark: SparkSession, paths: str | Sequence[str],
                    log: DataFrame | None = None,
                    source_col: str | None = None) -> list[InputFile]:
    """The files that are not in the log, in path order (a listing, as the driver
    plans scans from)."""
    files = list_files(spark, paths, source_col)
    files = files if log is None else without_logged(files, log)
    return sorted((InputFile(r["path"], r["name"], r["length"], r["modificationTime"].timestamp())
                   for r in files.collect()), key=lambda f: f.path)


def literal(path: str) -> str:
    """A path as a pattern that matches only itself."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def scan_groups(files: Sequence[InputFile], source_col: str | None = None
                ) -> list[tuple[list[str], str | None, bool]]:
    """(paths, base path, splittable) per scan: large compressed files apart, so that
    only their rows are spread after the scan; per partition root if folders name
    the logical files.  Compressed files that come in numbers and are small enough for
    a task each need no spreading: that would send every line through a shuffle."""
    packed = [f for f in files if not f.splittable]
    many = len(packed) >= MANY_FILES
    groups: dict[tuple[str | None, bool], list[str]] = {}
    for f in files:
        base = f.path.split(f"/{source_col}=")[0] if source_col else None
        fits = f.splittable or (many and f.length <= WHOLE_FILE)
        groups.setdefault((base, fits), []).append(literal(f.path))
    return [(paths, base, splittable) for (base, splittable), paths in sorted(
        groups.items(), key=str)]


@contextmanager
def sized_scan(spark: SparkSession, files: Sequence[InputFile]):
    """While a job scans ``files``: Spark packs small files into a task by their stored
    length, which for compressed ones would be ``PACKED`` times the text a task is meant
    to read."""
    key = "spark.sql.files.maxPartitionBytes"
    size = in_bytes(spark.conf.get(key))
    packed = any(not f.splittable for f in files)
    with setting(spark, key, max(1, size // PACKED) if packed else size):
        yield
