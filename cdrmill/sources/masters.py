"""Master-data sources: pipe or comma separated files with a header.

A master read with the wrong separator would silently become one column
whose every lookup misses; the header is checked eagerly and a mismatch is an
error.  Single broken lines are set aside, up to a limit.  Of several snapshots (dated files, or dated folders) only the
newest is read, chosen from the file listing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrmill.functions.parse import DATE_IN_NAME, date_from_name, parent_name
from cdrmill.schema import NODE_COLUMNS, TRUNK_COLUMNS

KINDS = {"trunk": TRUNK_COLUMNS, "node": NODE_COLUMNS}


class MasterFormatError(ValueError):
    pass


def _schema(cols: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def check_header(spark: SparkSession, path: str | list[str], columns: Sequence[str],
                 sep: str) -> None:
    """Read only the header and compare it with the expected columns."""
    found = spark.read.option("header", True).option("sep", sep).csv(path).columns
    if [c.strip().upper() for c in found] != [c.upper() for c in columns]:
        raise MasterFormatError(
            f"master header {found!r} does not match {list(columns)!r} with separator {sep!r}")


BROKEN = "ragged"          # another number of fields than the header
BLANK_KEY = "blank_key"    # no lookup can ever find the line
KEYS = {"trunk": ["ID", "FK_NNOD"], "node": ["ID"]}
MAX_BROKEN = 0.01


def master_lines(spark: SparkSession, path: str | list[str], kind: str = "trunk",
                 sep: str = "|") -> DataFrame:
    """Every line of the master files but headers and blank ones: the columns (all
    strings), ``line``, ``problem`` (NULL, ``ragged`` or ``blank_key``), ``file_path`` and
    ``file_name``."""
    cols = KINDS[kind]
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"))
    squeezed = F.upper(F.translate("line", ' "\ufeff', ""))
    body = lines.where((F.trim("line") != "") & (squeezed != sep.join(cols).upper()))
    record = F.from_csv("line", ", ".join(f"{c} string" for c in [*cols, "_broken"]), {
        "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    fields = body.select("*", record.alias("_r"))
    blank = F.lit(False)
    for k in KEYS[kind]:
        blank = blank | F.coalesce(F.trim(F.col("_r")[k]) == "", F.lit(True))
    return fields.select(
        *[F.col("_r")[c].alias(c) for c in cols], "line",
        F.when(F.col("_r")["_broken"].isNotNull(), BROKEN).when(blank, BLANK_KEY).alias("problem"),
        "file_path", "file_name")


def read_master(spark: SparkSession, path: str | list[str], kind: str = "trunk",
                sep: str = "|", check: bool = True, max_broken: float = MAX_BROKEN,
                rejects_path: str | None = None) -> DataFrame:
    """All sound rows of the master files at ``path`` (glob or list), all strings,
    plus ``file_path`` and ``file_name`` of the snapshot each row came from.

    A broken line costs itself, not the job, as long as no more than the share
    ``max_broken`` of all lines is broken; beyond it the master is refused.  With
    ``rejects_path`` the lines left out are written there (``kind=<kind>/``: line,
    problem, file), replacing those of the run before."""
    if check:
        check_header(spark, path, KINDS[kind], sep)
    lines = master_lines(spark, path, kind, sep)
    n, broken = lines.agg(F.count(F.lit(1)), F.count_if(F.col("problem") == BROKEN)).first()
    if broken > max_broken * n:
        raise MasterFormatError(
            f"{broken} of {n} lines of the {kind} master {path!r} are broken, more than the share "
            f"{max_broken}")
    if rejects_path:
        (lines.where("problem is not null").select("line", "problem", "file_name")
         .write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/kind={kind}"))
    # lines with a blank key stay: they are counted where masters are de-duplicated
    return lines.where(F.coalesce(F.col("problem") != BROKEN, F.lit(True))).select(
        *KINDS[kind], "file_path", "file_name")


def read_rejects(spark: SparkSession, rejects_path: str) -> DataFrame:
    """Master lines that the last run left out: kind, line, problem, file_name."""
    return (spark.read.schema("line string, problem string, file_name string, kind string")
            .option("basePath", rejects_path).parquet(rejects_path))


def snapshot_key(by: str = "name_date") -> Column:
    """Order key of a snapshot: the 8-digit date in its file name, or the
    name of the folder that holds it (last in sort order is newest)."""
    if by == "name_date":
        return date_from_name(F.col("file_name"))
    if by == "folder":
        return parent_name(F.col("file_path"))
    raise ValueError(by)


def latest_snapshot(df: DataFrame, key: Column) -> DataFrame:
    """Rows of the newest snapshot only.

    The newest key is a one-row aggregate, joined back by equality (a
    broadcast of a single row; no driver round trip, no cross join).
    """
    keyed = df.withColumn("_snap", key)
    newest = keyed.agg(F.max("_snap").alias("_newest"))
    return (keyed.join(F.broadcast(newest), F.col("_snap") == F.col("_newest"), "inner")
            .drop("_newest").withColumnRenamed("_snap", "snapshot"))


def _key_of(path: str, by: str) -> str | None:
    if by == "name_date":
        m = re.search(DATE_IN_NAME, path.rstrip("/").rsplit("/", 1)[-1])
        return m.group(0) if m else None
    if by == "folder":
        parts = path.rstrip("/").rsplit("/", 2)
        return parts[-2] if len(parts) >= 2 else None
    raise ValueError(by)


def newest_files(spark: SparkSession, path: str | list[str], by: str = "name_date") -> list[str]:
    """The files of the newest snapshot, chosen from the file listing (no
    data is read), so older snapshots are never scanned."""
    files = spark.read.text(path).inputFiles()
    keys = {f: _key_of(f, by) for f in files}
    dated = [k for k in keys.values() if k]
    if not dated:
        raise MasterFormatError(f"no dated snapshot under {path!r} (by {by})")
    newest = max(dated)
    return sorted(f for f, k in keys.items() if k == newest)


def read_latest_master(spark: SparkSession, path: str | list[str], kind: str = "trunk",
                       sep: str = "|", by: str = "name_date", **how) -> DataFrame:
    """Rows of the newest snapshot only (by date in the file name, or by
    last folder name), with its key in ``snapshot``; ``how`` as for ``read_master``."""
    files = newest_files(spark, path, by)
    return read_master(spark, files, kind, sep, **how).withColumn(
        "snapshot", F.lit(_key_of(files[0], by)))
