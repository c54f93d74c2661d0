"""Store of the duplicate-check keys already loaded.

Lets a load drop calls that an earlier load (or micro-batch) already kept,
however long ago.  The store is a bucketed table over ``keys_dir``: keys are
bucketed by the four columns the check joins on, so a load joins its kept calls
with the store without shuffling the store.  The key holds the event date, so the
table is partitioned by its month and a load reads exactly the partitions of the
months that occur in it; text that is no date shares one partition.  Below the month
each load has its own leaf.

Blank key parts are stored as empty text, as the check compares them.  The number
of buckets is laid down with the first load (``_layout/``).
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrmill.functions.parse import parse_yyyymmdd
from cdrmill.operators.lookup import sized_broadcast
from cdrmill.sinks.commits import commit_list, put_if_absent

KEY_COLUMNS = ["anum", "bnum", "event_start_date", "event_start_time"]
NO_DATE = "none"
LAYOUT = "_layout/buckets.json"


def key_month(date: str = "event_start_date") -> Column:
    date = F.col(date)
    return F.when(parse_yyyymmdd(date).isNotNull(), F.substring(date, 1, 6)).otherwise(
        F.lit(NO_DATE))


def key_buckets(spark: SparkSession, keys_dir: str, buckets: int) -> int:
    """The store's number of buckets; ``buckets`` if this is its first use."""
    path = f"{keys_dir.rstrip('/')}/{LAYOUT}"
    put_if_absent(spark, path, json.dumps({"buckets": buckets}) + "\n")
    return int(spark.read.schema("buckets int").json(path).first()["buckets"])


def _declared(spark: SparkSession, keys_dir: str, buckets: int) -> str:
    """The store as a table of this session's catalog, as far as it knows the leaves."""
    n = key_buckets(spark, keys_dir, buckets)
    name = "loaded_keys_" + hashlib.sha1(keys_dir.rstrip("/").encode()).hexdigest()[:16]
    cols = ", ".join(f"{c} string" for c in [*KEY_COLUMNS, "key_month", "load_id"])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"PARTITIONED BY (key_month, load_id) CLUSTERED BY ({', '.join(KEY_COLUMNS)}) "
              f"SORTED BY ({', '.join(KEY_COLUMNS)}) INTO {n} BUCKETS LOCATION '{keys_dir}'")
    return name


def keys_table(spark: SparkSession, keys_dir: str, buckets: int) -> str:
    """The store as a table of this session's catalog; its name."""
    name = _declared(spark, keys_dir, buckets)
    spark.sql(f"MSCK REPAIR TABLE {name}")  # leaves that other sessions wrote
    return name


def loaded_keys(spark: SparkSession, keys_dir: str, hold_path: str, months: DataFrame | None,
                buckets: int, loads: list[str] | None = None) -> DataFrame:
    """Keys that committed loads kept (only ``loads``, if given), of the event
    ``months`` (``key_month``; None: all).  Months and loads are broadcast (the calendar
    bounds the one, its measured size the other), which prunes partitions at run
    time and leaves the buckets where they are.

    The commits are listed here and not read by the plan: Spark forgets the cached rows of
    a plan that reads below a folder when that folder is written (the hold store's)."""
    keys = spark.table(keys_table(spark, keys_dir, buckets))
    committed = [c.load_id for c in commit_list(spark, hold_path)]
    if loads is not None:
        committed = [i for i in committed if i in loads]
    if months is not None:
        keys = keys.join(F.broadcast(months), "key_month", "left_semi")
    ids, _ = sized_broadcast(spark.createDataFrame([(i,) for i in committed], "load_id string"))
    return keys.join(ids, "load_id", "left_semi").select(*KEY_COLUMNS)


def kept_keys(legs: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the calls that a load kept (one per call: the first leg row), named
    and filled as the store has them."""
    first = legs.where(F.col("leg_index").isNull() | (F.col("leg_index") == 0))
    return first.select(*[F.coalesce(F.col(k), F.lit("")).alias(c)
                          for k, c in zip(keys, KEY_COLUMNS)])


def write_keys(kept: DataFrame, keys_dir: str, load_id: str, buckets: int) -> None:
    """The ``kept_keys`` of a load as its leaf: one file a month and bucket.  The table is
    not repaired first: that would drop the cached legs, which were checked against it, and
    compute them anew.  The write itself does so when it is done."""
    spark = kept.sparkSession
    name = _declared(spark, keys_dir, buckets)
    (kept.withColumns({"key_month": key_month(), "load_id": F.lit(load_id)})
     .repartition(key_buckets(spark, keys_dir, buckets), *KEY_COLUMNS)
     .write.mode("append").insertInto(name))


def written_keys(spark: SparkSession, keys_dir: str, buckets: int, load_id: str) -> DataFrame:
    """The leaf of a load, committed or not."""
    keys = spark.table(keys_table(spark, keys_dir, buckets))
    return keys.where(F.col("load_id") == load_id).select(*KEY_COLUMNS)


def any_shared(kept: DataFrame, others: DataFrame) -> bool:
    """Whether the two sets of keys meet."""
    small, _ = sized_broadcast(others)
    return kept.join(small, KEY_COLUMNS, "left_semi").limit(1).count() > 0
