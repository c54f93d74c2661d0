"""The corpus pipeline: toxic documents go, one document of each near-duplicate
class stays, benchmark passages go, the rest is drawn for the target mix and
placed in shards.

Each stage takes ``(spark, docs, sf_dir)`` and its result is written as Parquet
and reread as the next stage's ``docs``.  All stages but the last return the
columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cdrmill.llm.common import table
from cdrmill.llm.decontam import decontaminate
from cdrmill.llm.mixing import mix
from cdrmill.llm.near_dup import one_per_class
from cdrmill.llm.shard_ring import assign_shards
from cdrmill.llm.toxicity import without_toxic
from cdrmill.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def draw_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return assign_shards(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", draw_mix),
    ("sharding", place_in_shards),
]

# SQL expresses neither the trees nor the weighted samples nor the ring; the stages
# are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
