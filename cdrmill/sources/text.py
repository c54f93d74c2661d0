"""Text scans of call-record files with file provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def plain(path: Column) -> Column:
    """A ``_metadata`` path or name (URL-encoded) as the file system has it."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), decoded).otherwise(path)


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, paths: str | Sequence[str],
               source_col: str | None = None, base_path: str | None = None) -> DataFrame:
    """``value, file_path, file_name`` for every line of the given files/globs.

    Provenance comes from the ``_metadata`` column.  ``source_col`` names a
    folder partition (``<dir>/<source_col>=<name>/part-*``) whose value is
    the logical file name: that is the shape of a folder written by Spark
    for one input file (the per-file output and hold folders).
    """
    r = spark.read
    if source_col:
        r = r.schema(f"value STRING, {source_col} STRING")
    if base_path:
        r = r.option("basePath", base_path)
    df = r.text(_paths(paths))
    name = F.col(source_col) if source_col else plain(F.col("_metadata.file_name"))
    return df.select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file_path"),
        name.alias("file_name"),
    )


def read_lines_with_position(spark: SparkSession, paths: str | Sequence[str],
                             source_col: str | None = None,
                             base_path: str | None = None) -> DataFrame:
    """As ``read_lines`` plus the line position inside its file:
    ``_blk`` (start offset of the split that read the line) and ``_pos``
    (increasing, consecutive within one split).  Only valid on the scan
    itself, before any shuffle."""
    r = spark.read
    if source_col:
        r = r.schema(f"value STRING, {source_col} STRING")
    if base_path:
        r = r.option("basePath", base_path)
    df = r.text(_paths(paths))
    name = F.col(source_col) if source_col else plain(F.col("_metadata.file_name"))
    return df.select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file_path"),
        name.alias("file_name"),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_pos"),
    )


# Codecs whose files Spark cannot split: one task reads a whole file.
UNSPLITTABLE = (".gz", ".zst", ".zstd", ".snappy", ".lz4", ".deflate", ".z")


def unsplittable(df: DataFrame) -> bool:
    """Whether any input file of the scan is in an unsplittable format
    (from the file listing; no data is read)."""
    try:
        return any(f.lower().endswith(UNSPLITTABLE) for f in df.inputFiles())
    except Exception:  # noqa: BLE001 - not a file scan
        return False


def read_line_groups(spark: SparkSession, groups, source_col: str | None = None) -> DataFrame:
    """``value, file_path, file_name`` of the scans ``(paths, base path,
    splittable)``; only the rows of compressed files are spread."""
    out = None
    for paths, base, splittable in groups:
        df = read_lines(spark, paths, source_col, base)
        df = df if splittable else df.hint("rebalance")
        out = df if out is None else out.unionByName(df)
    return out


def spread_if_unsplittable(df: DataFrame, scan: DataFrame | None = None) -> DataFrame:
    """Rebalance rows right after the scan when whole compressed files land
    in single tasks, so a huge file is parsed and pre-aggregated by many
    tasks (AQE sizes the partitions).  Splittable input is left alone."""
    return df.hint("rebalance") if unsplittable(scan if scan is not None else df) else df
