"""The processed-file log: one row per loaded input file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrmill.operators.lookup import sized_broadcast
from cdrmill.schema import LOG_SCHEMA
from cdrmill.sinks.commits import is_missing, read_commits


def read_log(spark: SparkSession, path: str, hold_path: str | None = None) -> DataFrame:
    """The log as a DataFrame; an absent log is an empty one.  With the store
    that holds the commit table, entries of uncommitted loads don't count
    (entries without a load id always do)."""
    try:
        log = spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException as e:
        if is_missing(e):
            return spark.createDataFrame([], LOG_SCHEMA)
        raise
    if hold_path is None:
        return log
    ids, _ = sized_broadcast(read_commits(spark, hold_path).select("load_id").distinct())
    return log.where("load_id is null").unionByName(log.join(ids, "load_id", "left_semi"))


def log_entries(df: DataFrame, name_col: str = "file_name",
                date_col: str | None = "original_date",
                processing_date=None) -> DataFrame:
    """Distinct (filename, original_date, processing_date) of a loaded frame."""
    date = F.col(date_col) if date_col else F.lit(None).cast("string")
    pdate = processing_date if processing_date is not None else F.current_date()
    return (df.select(F.col(name_col).alias("filename"), date.alias("original_date"))
            .distinct().withColumn("processing_date", pdate))


def append_log(spark: SparkSession, path: str, entries: DataFrame) -> None:
    """Append the names not yet in the log (append only: the files being
    read are never rewritten)."""
    existing = read_log(spark, path).select(F.col("filename").alias("_seen"))
    new = (entries.select("filename", "original_date", "processing_date")
           .join(existing, F.col("filename") == F.col("_seen"), "left_anti"))
    _append(new, path)


def log_files(files: DataFrame, path: str, original_date, processing_date, load_id: str) -> None:
    """Append the scanned files (``path``, ``name``) of one load, whatever became
    of their records."""
    _append(files.select(
        F.col("name").alias("filename"), original_date.alias("original_date"),
        processing_date.alias("processing_date"), "path", F.lit(load_id).alias("load_id")), path)


def _append(entries: DataFrame, path: str) -> None:
    missing = [f for f in LOG_SCHEMA.fields if f.name not in entries.columns]
    entries = entries.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    entries.select(*LOG_SCHEMA.names).write.mode("append").parquet(path)
