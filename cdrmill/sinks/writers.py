"""Sinks: partitioned enriched output, hold store, tables, CSV exports.

Every write is a distributed Spark write (no collect, no single task).
Each load writes its own leaf partition (``load_id``) under dynamic partition
overwrite, beside and never over another load's rows.  That also makes
back-dated loading safe: held rows reprocessed days later land in the
partition of their original date beside the rows already there.  Rows are
rebalanced on the partition columns before a write, so the number of files
follows the data and not tasks x partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrmill.operators.lookup import sized_broadcast
from cdrmill.session import unsorted_write
from cdrmill.sinks.commits import is_missing, only_committed, replaced_loads, superseded_leaves
from cdrmill.sinks.master_store import node_bucket

CSV_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
STORE_CODEC = "zstd"  # of Parquet files: every row is written once and kept


def _dynamic(df: DataFrame):
    return df.write.option("partitionOverwriteMode", "dynamic")


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str],
                      fmt: str = "parquet", load_id: str | None = None,
                      header: bool = True, null_token: str | None = None,
                      time_format: str = CSV_TIME_FORMAT,
                      written: Observation | None = None,
                      compression: str | None = None, rebalance: bool = True) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite).

    With ``load_id`` the load's own leaf partition is added under the
    given ones.  ``written`` observes the number of rows in the tasks that write them.
    """
    parts = list(partition_by)
    if load_id is not None:
        df = df.withColumn("load_id", F.lit(load_id))
        parts.append("load_id")
    if partition_by and rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if written is not None:
        df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    w = _dynamic(df).mode("overwrite").partitionBy(*parts)
    if fmt == "csv":
        w = w.option("header", header).option("timestampFormat", time_format)
        if null_token is not None:
            w = w.option("nullValue", null_token).option("emptyValue", "")
        if compression is not None:
            w = w.option("compression", compression)
    elif fmt == "parquet":
        w = w.option("compression", STORE_CODEC)
    with unsorted_write(df.sparkSession):
        w.format(fmt).save(path)


def write_enriched(df: DataFrame, path: str, load_id: str, fmt: str = "parquet",
                   null_token: str | None = None, time_format: str = CSV_TIME_FORMAT,
                   written: Observation | None = None,
                   compression: str | None = None, rebalance: bool = True) -> None:
    """Enriched rows by original date and processing date (back-dated
    loads included), one leaf per load.  ``rebalance`` is left out where they are so already.  ``time_format`` renders
    PROCESSEDTIME in CSV output (e.g. ``dd/MM/yyyy HH:mm``)."""
    write_partitioned(df, path, ["original_date", "processing_date"], fmt, load_id,
                      null_token=null_token, time_format=time_format, written=written,
                      compression=compression, rebalance=rebalance)


def write_per_file(df: DataFrame, path: str, name_col: str = "INPUTFILENAME",
                   partition_by: Sequence[str] = ("processing_date",), fmt: str = "csv",
                   load_id: str | None = None, compression: str | None = None,
                   rebalance: bool = True) -> None:
    """One folder per input file (then by date, then by load), as the per-file
    export.  ``rebalance`` is left out where the rows are spread already."""
    write_partitioned(df, path, [name_col, *partition_by], fmt, load_id, compression=compression,
                      rebalance=rebalance)


def hold_class(reason: str = "hold_reason"):
    """``final`` for rows no newer master can fix (no leg, no date in the file
    name, a broken line or header), ``lookup`` for rows waiting for master data."""
    r = F.col(reason)
    return (F.when(r.contains("no_leg") | r.contains("no_date") | r.contains("ragged")
                   | r.contains("bad_header"), F.lit("final"))
            .otherwise(F.lit("lookup")))


FINAL_BUCKET = -1  # rows that no master can help need no bucket


def write_hold(held: DataFrame, path: str, load_id: str) -> None:
    """Held rows by class, bucket of their node and original date, one leaf per load
    that held them.  A reprocess reads only the ``lookup`` class, and of it the
    buckets whose master entries changed."""
    node = F.coalesce(F.col("incoming_node"), F.col("outgoing_node"))
    rows = held.withColumn("hold_class", hold_class()).withColumn("hold_bucket", F.when(
        F.col("hold_class") == "final", F.lit(FINAL_BUCKET)).otherwise(node_bucket(node)))
    write_partitioned(rows, path, ["hold_class", "hold_bucket", "original_date"], "parquet", load_id)


def read_partitioned(spark: SparkSession, path: str, *leaves: str) -> DataFrame:
    """A folder written by ``write_partitioned`` (or only ``leaves`` of it); partition
    values keep the types they were written with whatever the session's type inference."""
    df = spark.read.option("basePath", path).parquet(*(leaves or [path]))
    casts = {}
    for c, t in (("original_date", "string"), ("load_id", "string"),
                 ("hold_class", "string"), ("hold_bucket", "int"), ("processing_date", "date")):
        if c in df.columns:
            casts[c] = F.col(c).cast(t)
    return df.withColumns(casts)


def read_hold(spark: SparkSession, path: str, superseded: DataFrame | None = None) -> DataFrame:
    """Current held rows: every load's leaf minus the loads a reprocess has
    already taken over (``superseded``: one ``load_id`` per row)."""
    held = read_partitioned(spark, path)
    if superseded is not None:
        gone, _ = sized_broadcast(superseded.select("load_id").distinct())
        held = held.join(gone, "load_id", "left_anti")
    return held


def read_enriched(spark: SparkSession, path: str, hold_path: str) -> DataFrame:
    """Enriched rows (Parquet output) of committed loads."""
    gone, _ = sized_broadcast(replaced_loads(spark, hold_path))
    return only_committed(read_partitioned(spark, path), hold_path).join(gone, "load_id", "left_anti")


def write_audit(audit: DataFrame, path: str, load_id: str) -> None:
    """Per-file counts of one load."""
    write_partitioned(audit, path, [], "parquet", load_id)


def read_audit(spark: SparkSession, path: str, hold_path: str) -> DataFrame:
    """Per-file counts of committed loads."""
    return only_committed(read_partitioned(spark, path), hold_path)


def has_hold(spark: SparkSession, hold_path: str) -> bool:
    """Whether any held row was ever written."""
    try:
        read_partitioned(spark, hold_path)
        return True
    except AnalysisException as e:
        if is_missing(e, empty_too=True):
            return False
        raise


def current_hold(spark: SparkSession, hold_path: str, cls: str | None = None,
                 buckets: Sequence[int] | None = None) -> DataFrame:
    """Held rows of committed loads.  A leaf (load and bucket) counts until a committed
    run replaced it; ``final`` rows, which no reprocess reads, are replaced by a
    compaction of their whole load only.  ``cls`` and ``buckets`` restrict to partitions
    (others are not read)."""
    gone, _ = sized_broadcast(superseded_leaves(spark, hold_path).select(
        F.col("load_id").alias("_gone"), F.col("bucket").alias("_bucket")))
    held = read_partitioned(spark, hold_path)
    if cls is not None:
        held = held.where(F.col("hold_class") == cls)
    if buckets is not None:
        held = held.where(F.col("hold_bucket").isin([int(b) for b in buckets]))
    held = only_committed(held, hold_path)
    return held.join(gone, (F.col("load_id") == F.col("_gone")) & (
        F.col("_bucket").isNull() | (F.col("hold_bucket") == F.col("_bucket"))), "left_anti")


def create_partitioned_table(spark: SparkSession, name: str, schema: T.StructType,
                             partition_by: Sequence[str], fmt: str = "parquet",
                             location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING fmt PARTITIONED BY``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    loc = f" LOCATION '{location}'" if location else ""
    codec = f" OPTIONS (compression '{STORE_CODEC}')" if fmt == "parquet" else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}{codec} "
              f"PARTITIONED BY ({', '.join(partition_by)}){loc}")


def append_table(df: DataFrame, name: str) -> None:
    """Append by position into an existing (partitioned) table, in the
    table's own format."""
    cols = df.sparkSession.table(name).columns
    with unsorted_write(df.sparkSession):
        df.select(*cols).write.insertInto(name, overwrite=False)


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "parquet":
        w = w.option("compression", STORE_CODEC)
    w.saveAsTable(name)


def export_csv(df: DataFrame, path: str, header: bool = False, sep: str = ",",
               null_token: str | None = None, compression: str | None = None) -> None:
    """Plain CSV export (a directory of part files written in parallel)."""
    w = df.write.mode("overwrite").option("header", header).option("sep", sep) \
        .option("timestampFormat", CSV_TIME_FORMAT)
    if null_token is not None:
        w = w.option("nullValue", null_token)
    if compression is not None:
        w = w.option("compression", compression)
    w.csv(path)


def convert_separator(spark: SparkSession, src: str, dst: str, schema: T.StructType,
                      sep_in: str = "|", sep_out: str = ",") -> None:
    """Re-write a separated text file with another separator."""
    df = (spark.read.schema(schema).option("header", True).option("sep", sep_in)
          .option("enforceSchema", False).csv(src))
    df.write.mode("overwrite").option("header", True).option("sep", sep_out).csv(dst)
