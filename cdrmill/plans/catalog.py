"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Inputs come from ``cdrmill.fixtures`` (shaped from the test tables; work
grows with them).  Every step a query is named for runs through the
library's own operators.  Queries named for a source or sink write their
stand-in files into a fresh folder under the session's shared checkpoint
folder and read them back.  Date and timestamp columns are rendered as text
for the cross-engine check (``comparable``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrmill import fixtures as fx
from cdrmill.functions.parse import (date_from_name, duration_seconds, hhmiss,
                                     parse_fixed_width, parse_yyyymmdd)
from cdrmill.operators.audit import file_audit, load_totals
from cdrmill.operators.files import new_files
from cdrmill.operators.lookup import (Masters, clean_master, lookup_node, lookup_trunk,
                                     sql_trunk_lookup, unique_master)
from cdrmill.operators.mapping import FIXED_CLOCK, Clock, map_med
from cdrmill.operators.split import split_transit
from cdrmill.plans.hold import reprocess_ict_hold, reprocess_med_hold
from cdrmill.plans.ict import enrich_ict
from cdrmill.plans.job_queries import extract_parts, write_extracts, write_lines
from cdrmill.plans.med import dedup_records, enrich_med, med_legs, original_date, parse_records
from cdrmill.session import scratch_path
from cdrmill.sinks.writers import (convert_separator, read_hold, read_partitioned,
                                   write_enriched, write_hold, write_partitioned)
from cdrmill.sources.envelope import read_envelope_csv
from cdrmill.sources.log import append_log, log_entries, read_log
from cdrmill.sources.masters import read_latest_master, read_master
from cdrmill.streaming.incremental import IncrementalConfig, run_med_incremental
from cdrmill.schema import ENRICHED_COLUMNS, ICT_DEDUP_KEYS, MED_DEDUP_KEYS, TRUNK_SCHEMA

REPROCESS_CLOCK = Clock("2024-07-03 09:00:00", "2024-07-03")


def comparable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text; every other column unchanged."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _masters(spark: SparkSession, sf_dir: str) -> Masters:
    return Masters.build(fx.trunk_master(spark, sf_dir), fx.node_master(spark, sf_dir))


def _fixed_masters(spark: SparkSession, sf_dir: str) -> Masters:
    return Masters.build(fx.corrected_trunk_master(spark, sf_dir),
                         fx.corrected_node_master(spark, sf_dir))


def _med_run(spark: SparkSession, sf_dir: str):
    """W1 on the fixture: skip logged files, then enrich."""
    lines = new_files(fx.cdr_lines(spark, sf_dir), fx.processed_log(spark, sf_dir))
    return enrich_med(lines, _masters(spark, sf_dir), FIXED_CLOCK)


# ------------------------------------------------------------ parsing
def q_fixed_width_parse(spark, sf_dir):
    return parse_fixed_width(fx.cdr_lines(spark, sf_dir))


def q_event_fields(spark, sf_dir):
    p = parse_records(fx.cdr_lines(spark, sf_dir))
    return comparable(p.select(
        "file_name", "record_sequence_number",
        F.col("event_start_date").alias("EVENT_START_DATE"),
        parse_yyyymmdd("event_start_date").alias("event_date"),
        hhmiss("event_start_time").alias("EVENT_START_TIME"),
        duration_seconds("event_duration").alias("EVENT_DURATION")))


def q_usage_seconds(spark, sf_dir):
    p = parse_records(fx.cdr_lines(spark, sf_dir))
    usage = duration_seconds("event_duration")
    return p.select("file_name", "record_sequence_number", "event_duration",
                    usage.alias("ACTUAL_USAGE"), usage.alias("CHARGED_USAGE"))


def q_original_date(spark, sf_dir):
    names = fx.cdr_lines(spark, sf_dir).select("file_name").distinct()
    return names.select("file_name", original_date("file_name").alias("original_date"))


# ------------------------------------------------------------ file / record checks
def q_new_files_only(spark, sf_dir):
    return new_files(fx.cdr_lines(spark, sf_dir), fx.processed_log(spark, sf_dir)).select(
        "value", "file_name")


def q_record_dedup(spark, sf_dir):
    return dedup_records(parse_records(fx.cdr_lines(spark, sf_dir)))


def q_transit_split(spark, sf_dir):
    legs = split_transit(parse_records(fx.cdr_lines(spark, sf_dir)))
    direction = (F.when(F.col("incoming_path").isNotNull(), F.lit("I"))
                 .when(F.col("outgoing_path").isNotNull(), F.lit("O")))
    return legs.drop("event_direction").withColumn("EVENT_DIRECTION", direction)


# ------------------------------------------------------------ lookups
def _trunk_side(spark, sf_dir, side):
    up = side.upper()
    p = parse_records(fx.cdr_lines(spark, sf_dir))
    m = _masters(spark, sf_dir)
    j = lookup_trunk(p, m.trunk, F.col(f"{side}_path"), F.col(f"{side}_node"),
                     poi_as=f"{up}_POI", operator_as=f"{up}_OPERATOR")
    return j.select("file_name", "record_sequence_number", f"{side}_path", f"{side}_node",
                    f"{up}_POI", f"{up}_OPERATOR", "trunk_hit")


def q_trunk_lookup_incoming(spark, sf_dir):
    return _trunk_side(spark, sf_dir, "incoming")


def q_trunk_lookup_outgoing(spark, sf_dir):
    return _trunk_side(spark, sf_dir, "outgoing")


def q_trunk_lookup_sql(spark, sf_dir):
    """The incoming trunk lookup as Spark SQL over temp views."""
    p = parse_records(fx.cdr_lines(spark, sf_dir))
    m = _masters(spark, sf_dir)
    j = sql_trunk_lookup(p, m.trunk, "incoming", broadcast=m.trunk_broadcast)
    return j.select("file_name", "record_sequence_number", "incoming_path", "incoming_node",
                    "INCOMING_POI", "INCOMING_OPERATOR", "trunk_hit")


def q_franchise_lookup(spark, sf_dir):
    p = parse_records(fx.cdr_lines(spark, sf_dir))
    m = _masters(spark, sf_dir)
    j = lookup_node(p, m.node, F.coalesce(F.col("incoming_node"), F.col("outgoing_node")),
                    franchise_as="FRANCHISE")
    return j.select("file_name", "record_sequence_number", "incoming_node", "outgoing_node",
                    "FRANCHISE", "node_hit")


def q_unique_master(spark, sf_dir):
    return unique_master(clean_master(fx.trunk_master(spark, sf_dir)), ["ID", "FK_NNOD"])


def q_latest_master(spark, sf_dir):
    """Two dated snapshots written as pipe files, one folder each; both are
    read and the reader keeps only the newest."""
    root = scratch_path(spark, "snapshots")
    snaps = fx.trunk_snapshots(spark, sf_dir)
    (snaps.repartition("snapshot_name").write.option("header", True).option("sep", "|")
     .partitionBy("snapshot_name").csv(root))
    latest = read_latest_master(spark, f"{root}/*/*.csv", "trunk", "|", by="folder")
    key = date_from_name(F.col("snapshot"))
    return latest.select("ID", "NAME", "FK_NNOD", "OPERATOR", "POI", key.alias("snapshot"))


# ------------------------------------------------------------ mapping
def _all_legs_mapped(spark, sf_dir):
    lines = new_files(fx.cdr_lines(spark, sf_dir), fx.processed_log(spark, sf_dir))
    legs = med_legs(parse_records(lines), _masters(spark, sf_dir), FIXED_CLOCK)
    return map_med(legs, FIXED_CLOCK)


def q_direction_and_cash_flow(spark, sf_dir):
    return _all_legs_mapped(spark, sf_dir).select(
        "INPUTFILENAME", "ANUM", "BNUM", "EVENT_START_DATE", "EVENT_START_TIME", "leg",
        "EVENT_DIRECTION", "CASH_FLOW", "COMPONENT_DIRECTION")


def q_effective_ids(spark, sf_dir):
    return _all_legs_mapped(spark, sf_dir).select(
        "INPUTFILENAME", "ANUM", "BNUM", "EVENT_START_DATE", "EVENT_START_TIME", "leg",
        "BILLING_OPERATOR", "BILLED_PRODUCT", "switch_id", "trunk_group_id", "poi_id",
        "product_id", "network_operator_id")


# ------------------------------------------------------------ MED workflow
def q_med_enriched(spark, sf_dir):
    """Flagship: the MED job end to end (log check, parse, duplicate check,
    transit split, lookups, hold split, 42-column mapping)."""
    return comparable(_med_run(spark, sf_dir).enriched)


def q_med_held(spark, sf_dir):
    return comparable(_med_run(spark, sf_dir).held)


def _held_and_reprocessed(spark, sf_dir, run=None):
    """Held rows (of ``run``) go to the hold store; a later run with corrected masters
    reads the store and enriches what now matches."""
    hold = scratch_path(spark, "hold")
    write_hold((run or _med_run(spark, sf_dir)).held, hold, "first")
    held = read_hold(spark, hold).where(F.col("hold_class") == "lookup")
    done, still = reprocess_med_hold(held, _fixed_masters(spark, sf_dir), REPROCESS_CLOCK)
    return done, still


def q_hold_reprocess(spark, sf_dir):
    done, _ = _held_and_reprocessed(spark, sf_dir)
    return comparable(done)


def _audit(spark, sf_dir):
    lines = new_files(fx.cdr_lines(spark, sf_dir), fx.processed_log(spark, sf_dir))
    out = enrich_med(lines, _masters(spark, sf_dir), FIXED_CLOCK, counted=True)
    return file_audit(out.legs, MED_DEDUP_KEYS)


def q_file_audit(spark, sf_dir):
    return _audit(spark, sf_dir)


def q_load_metrics(spark, sf_dir):
    return load_totals(_audit(spark, sf_dir))


def q_backdated_partitions(spark, sf_dir):
    """First load writes by (original_date, processing_date); the reprocess
    of its held rows runs a day later but lands in the original partitions
    beside the first load's rows."""
    out_root = scratch_path(spark, "enriched")
    run = _med_run(spark, sf_dir)
    legs = run.legs.persist(StorageLevel.MEMORY_AND_DISK)  # for the matched and the held rows
    try:
        write_enriched(run.enriched, out_root, "first")
        done, _ = _held_and_reprocessed(spark, sf_dir, run)
    finally:
        legs.unpersist()
    write_enriched(done, out_root, "reprocess")
    back = read_partitioned(spark, out_root)
    return (back.groupBy("original_date", F.col("processing_date").cast("string")
                         .alias("processing_date"))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.countDistinct("load_id").alias("n_loads")))


def q_processed_log_append(spark, sf_dir):
    """The log holds earlier files; the names this load processed are
    appended (names already there are not added twice)."""
    path = scratch_path(spark, "log")
    earlier = fx.processed_log(spark, sf_dir).select(
        "filename", date_from_name(F.col("filename")).alias("original_date"),
        F.to_date(F.lit("2024-07-01")).alias("processing_date"))
    earlier.write.mode("overwrite").parquet(path)
    lines = new_files(fx.cdr_lines(spark, sf_dir), read_log(spark, path))
    entries = log_entries(lines.withColumn("original_date", original_date("file_name")),
                          processing_date=FIXED_CLOCK.date())
    append_log(spark, path, entries)
    append_log(spark, path, entries)  # offering the same files again adds nothing
    return comparable(read_log(spark, path).select("filename", "original_date",
                                                   "processing_date"))


def q_export_round_trip(spark, sf_dir):
    """Enriched rows exported as header CSV with an ``NA`` null token,
    partitioned by processing date, read back as text."""
    path = scratch_path(spark, "export")
    enriched = _med_run(spark, sf_dir).enriched
    write_partitioned(enriched, path, ["processing_date"], fmt="csv", null_token="NA")
    cols = ENRICHED_COLUMNS + ["original_date", "leg", "processing_date"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    back = spark.read.schema(schema).option("header", True).option("basePath", path).csv(path)
    return back


def q_pipe_to_comma(spark, sf_dir):
    """Pipe-separated master file converted to comma-separated, read back
    through the master reader (header checked)."""
    src, dst = scratch_path(spark, "pipe"), scratch_path(spark, "comma")
    (fx.trunk_master(spark, sf_dir).write.option("header", True).option("sep", "|")
     .csv(src))
    convert_separator(spark, src, dst, TRUNK_SCHEMA, "|", ",")
    return read_master(spark, dst, "trunk", sep=",").select("ID", "NAME", "FK_NNOD",
                                                            "OPERATOR", "POI")


def write_cdr_files(spark, sf_dir) -> str:
    """Stand-in call-record files: one folder per logical file, each written
    by every task (record order inside a CDR file carries no meaning)."""
    root = scratch_path(spark, "cdr-in")
    write_lines(fx.cdr_lines(spark, sf_dir).select(
        "value", F.col("file_name").alias("source")), root, "source")
    return root


def q_incremental_load(spark, sf_dir):
    """The MED load as a Structured Streaming query over the call-record
    files (``availableNow``), output read back."""
    root = write_cdr_files(spark, sf_dir)
    cfg = IncrementalConfig(root, scratch_path(spark, "inc-out"), scratch_path(spark, "inc-hold"),
                            scratch_path(spark, "inc-ckpt"), source_col="source")
    run_med_incremental(spark, cfg, _masters(spark, sf_dir), fx.processed_log(spark, sf_dir),
                        FIXED_CLOCK)
    back = read_partitioned(spark, cfg.output_dir)
    return comparable(back.select(*ENRICHED_COLUMNS, "original_date", "processing_date", "leg"))


# ------------------------------------------------------------ ICT workflow
def _write_ict_files(spark, sf_dir) -> str:
    """Envelope extract files, one folder per extract, lines in file order."""
    root = scratch_path(spark, "ict-in")
    write_extracts(fx.ict_envelope_lines(spark, sf_dir), extract_parts(spark, sf_dir), root)
    return root


def _ict_records(spark, sf_dir) -> DataFrame:
    root = _write_ict_files(spark, sf_dir)
    return read_envelope_csv(spark, root, source_col="source", base_path=root, spread=False)


def q_envelope_csv(spark, sf_dir):
    return _ict_records(spark, sf_dir).select("file_name", *ENRICHED_COLUMNS)


def q_ict_enriched(spark, sf_dir):
    out = enrich_ict(_ict_records(spark, sf_dir), _masters(spark, sf_dir), FIXED_CLOCK)
    return comparable(out.enriched)


def q_ict_held(spark, sf_dir):
    out = enrich_ict(_ict_records(spark, sf_dir), _masters(spark, sf_dir), FIXED_CLOCK)
    return comparable(out.held)


def q_ict_hold_reprocess(spark, sf_dir):
    """ICT held rows through the hold store, then the corrected trunk
    master; released rows keep their first processing date."""
    hold = scratch_path(spark, "ict-hold")
    out = enrich_ict(_ict_records(spark, sf_dir), _masters(spark, sf_dir), FIXED_CLOCK)
    write_hold(out.held, hold, "first")
    held = read_hold(spark, hold).where(F.col("hold_class") == "lookup")
    done, _ = reprocess_ict_hold(held, _fixed_masters(spark, sf_dir), REPROCESS_CLOCK)
    return comparable(done)


def q_ict_file_audit(spark, sf_dir):
    """Per ICT extract: records read, duplicates dropped, legs matched/held."""
    out = enrich_ict(_ict_records(spark, sf_dir), _masters(spark, sf_dir), FIXED_CLOCK, counted=True)
    return file_audit(out.legs, ICT_DEDUP_KEYS, "INPUTFILENAME")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fixed_width_parse": q_fixed_width_parse,
    "event_fields": q_event_fields,
    "usage_seconds": q_usage_seconds,
    "original_date": q_original_date,
    "new_files_only": q_new_files_only,
    "record_dedup": q_record_dedup,
    "transit_split": q_transit_split,
    "trunk_lookup_incoming": q_trunk_lookup_incoming,
    "trunk_lookup_outgoing": q_trunk_lookup_outgoing,
    "trunk_lookup_sql": q_trunk_lookup_sql,
    "franchise_lookup": q_franchise_lookup,
    "unique_master": q_unique_master,
    "latest_master": q_latest_master,
    "direction_and_cash_flow": q_direction_and_cash_flow,
    "effective_ids": q_effective_ids,
    "med_enriched": q_med_enriched,
    "med_held": q_med_held,
    "hold_reprocess": q_hold_reprocess,
    "file_audit": q_file_audit,
    "load_metrics": q_load_metrics,
    "backdated_partitions": q_backdated_partitions,
    "processed_log_append": q_processed_log_append,
    "export_round_trip": q_export_round_trip,
    "pipe_to_comma": q_pipe_to_comma,
    "incremental_load": q_incremental_load,
    "ict_enriched": q_ict_enriched,
    "ict_held": q_ict_held,
    "envelope_csv": q_envelope_csv,
    "ict_hold_reprocess": q_ict_hold_reprocess,
    "ict_file_audit": q_ict_file_audit,
}
