"""The non-default plan paths give the same rows as the default ones:
shuffle joins when a master is over the broadcast limit, the big-log file
check, and a third of all records sharing one duplicate-check key."""

from pyspark.sql import functions as F

from cdrmill import fixtures as fx
from cdrmill.operators.files import new_files
from cdrmill.operators.lookup import Masters
from cdrmill.operators.mapping import FIXED_CLOCK
from cdrmill.plans.med import dedup_records, enrich_med, parse_records
from conftest import SF
from tools.oracle_check import digest


def _rows(df):
    return digest(df.toPandas())


def test_shuffle_join_fallback_matches_broadcast(spark):
    lines = fx.cdr_lines(spark, SF)
    small = Masters.build(fx.trunk_master(spark, SF), fx.node_master(spark, SF))
    a = _rows(enrich_med(lines, small, FIXED_CLOCK).enriched)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        big = Masters.build(fx.trunk_master(spark, SF), fx.node_master(spark, SF), limit=0)
        assert small.trunk_broadcast and not big.trunk_broadcast and not big.node_broadcast
        b_df = enrich_med(lines, big, FIXED_CLOCK).enriched
        b = _rows(b_df)
        plan = b_df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert a == b


def test_big_log_path_matches_broadcast_path(spark):
    lines = fx.cdr_lines(spark, SF)
    log = fx.processed_log(spark, SF)
    a = new_files(lines, log)
    spark.conf.set("spark.cdrmill.broadcast.maxBytes", "0")
    try:
        b = new_files(lines, log)
        ra = _rows(a)
        rb = _rows(b)
    finally:
        spark.conf.unset("spark.cdrmill.broadcast.maxBytes")
    assert ra == rb and ra[1] < lines.count()


def test_hot_duplicate_key_keeps_every_other_call(spark):
    rec = parse_records(fx.cdr_lines(spark, SF))
    hot = F.col("record_sequence_number").endswith("1")  # about a third of the records
    skewed = rec.withColumns({k: F.when(hot, F.lit(None)).otherwise(F.col(k))
                              for k in ["anum", "bnum", "event_start_date", "event_start_time"]})
    n_hot = skewed.where(F.col("anum").isNull()).count()
    n_cold_keys = skewed.where(F.col("anum").isNotNull()).select(
        "anum", "bnum", "event_start_date", "event_start_time").distinct().count()
    kept = dedup_records(skewed)
    assert n_hot > rec.count() / 10
    assert kept.count() == n_cold_keys + 1  # the hot group is one call, nothing else lost
