"""The jobs a user runs: MED load, ICT load, hold reprocess, parsed-only export.

Each job is one lazy plan with a few writes.  The leg rows feed all of them
(enriched, held, audit, loaded keys), so they are persisted once (memory, then
disk; a lost executor recomputes its blocks from lineage, which is
deterministic).  The pass that fills them counts them, and they carry a row of
counts per input file, so the audit reads nothing again.

Every run has an id of its own and writes all its rows under it.  Its commit,
written last, makes them count; every reader (enriched, held, audit, keys,
table, log) takes committed loads only.  So a run that died is as if it never
was: its files are not logged, and the next run loads them.  Two runs of one job
on one day stand beside each other, also when they overlap: the one that commits
second and finds a file, a call key or a held row of its own committed meanwhile
starts again from what is left.

Input files are known by full path.  Logged ones are taken out of the listing
before the scan, and every scanned file is logged, whatever became of its
records.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cdrmill.functions.parse import parse_fixed_width
from cdrmill.operators.audit import file_audit
from cdrmill.operators.dedup import FILE_LINES, without_counts
from cdrmill.operators.lookup import Masters, sized_broadcast
from cdrmill.operators.mapping import Clock
from cdrmill.plans.hold import reprocess_ict_hold, reprocess_med_hold
from cdrmill.plans.ict import finish_ict, ict_legs
from cdrmill.plans.med import finish_med, med_legs, original_date, parse_records
from cdrmill.schema import ICT_DEDUP_KEYS, LOG_SCHEMA, MED_DEDUP_KEYS
from cdrmill.session import OPEN_FILES, parallelism, partitions_for, sized_shuffle
from cdrmill.sinks.commits import (Commit, commit_list, commit_load, latest_version, new_load_id,
                                   only_committed, until_committed)
from cdrmill.sinks.keys import (any_shared, kept_keys, key_buckets, key_month, loaded_keys, write_keys,
                                written_keys)
from cdrmill.sinks.master_store import changed_buckets, keep_snapshot, met_snapshots
from cdrmill.sinks.writers import (CSV_TIME_FORMAT, append_table, create_partitioned_table,
                                   current_hold, export_csv, has_hold, overwrite_table, write_audit,
                                   write_enriched, write_hold, write_per_file)
from cdrmill.sources.envelope import envelope_records
from cdrmill.sources.listing import InputFile, new_input_files, scan_groups, sized_scan
from cdrmill.sources.log import log_files, read_log
from cdrmill.sources.masters import MAX_BROKEN, read_latest_master, read_master
from cdrmill.sources.text import read_line_groups, read_lines_with_position


KEYED_TASK = 64 << 20  # bytes a shuffle partition up to which a load takes the store's buckets
LOAD_TASK = 64 << 20   # bytes a shuffle partition of a load: sorts and cached blocks stay small
LYING_ROWS = 200_000   # enriched rows a task from which a load's need not be gathered by date
LEG_COUNTS = ("leg_rows", "matched", "held")


@dataclass
class MasterPaths:
    trunk: str | list[str]
    node: str | list[str] | None = None
    sep: str = "|"
    snapshot_by: str | None = "name_date"  # "folder", or None: every file of the glob
    max_broken: float = MAX_BROKEN         # share of broken lines from which a master is refused
    rejects_path: str | None = None        # broken lines go here

    def _read(self, spark: SparkSession, path, kind: str) -> DataFrame:
        how = {"max_broken": self.max_broken, "rejects_path": self.rejects_path}
        if self.snapshot_by is None:
            return read_master(spark, path, kind, self.sep, **how)
        return read_latest_master(spark, path, kind, self.sep, self.snapshot_by, **how)

    def load(self, spark: SparkSession) -> Masters:
        trunk = self._read(spark, self.trunk, "trunk")
        if self.node is None:  # ICT needs no node master
            node = spark.createDataFrame([], "ID string, NAME string, FK_ORGA_FRAN string")
        else:
            node = self._read(spark, self.node, "node")
        return Masters.build(trunk, node)


@dataclass
class JobConfig:
    inputs: str | list[str]           # files or globs, e.g. <base>/*/*.cdr (hour folders)
    masters: MasterPaths
    output_path: str
    hold_path: str
    log_path: str
    audit_path: str | None = None
    output_format: str = "parquet"    # or "csv" (header, text)
    null_token: str | None = None
    time_format: str = CSV_TIME_FORMAT  # PROCESSEDTIME in CSV output
    date_mode: str = "regex"
    source_col: str | None = None
    load_id: str | None = None        # first part of the run's id (default: job and date)
    keys_dir: str | None = None       # also drop calls kept by earlier loads
    keys_buckets: int = 32            # of a new keys store, at least; a larger first load lays down more
    size_partitions: bool = True      # enough shuffle partitions for the new files' bytes
    table: str | None = None          # also append into this partitioned table
    table_replace: bool = False       # the table holds the rows of the last run only
    plain_csv_path: str | None = None  # also one CSV folder: no header, no partitions, last run's rows
    per_file_path: str | None = None  # also write one CSV folder per input file
    csv_compression: str | None = None  # codec of all CSV that the job writes, e.g. "gzip"
    hold_after: bool = False          # then reprocess the held rows in the same call
    count_lines: bool = False         # also count the records read (the audit does so, too)
    hold_full: bool = False           # reprocess all waiting rows, not just those of changed masters
    before_commit: Callable[[], None] | None = None  # called when all is written


def _write_matched(enriched: DataFrame, cfg: JobConfig, load_id: str,
                   written: Observation | None = None, spread: DataFrame | None = None,
                   by_file: DataFrame | None = None) -> None:
    """The enriched rows of a run, into every sink that is set.  ``spread``: the same rows,
    spread over the tasks already, for the output store; ``by_file``: for the folders per
    input file."""
    write_enriched(enriched if spread is None else spread, cfg.output_path, load_id,
                   cfg.output_format, cfg.null_token, cfg.time_format, written,
                   cfg.csv_compression, rebalance=spread is None)
    if cfg.plain_csv_path:
        export_csv(enriched, cfg.plain_csv_path, null_token=cfg.null_token,
                   compression=cfg.csv_compression)
    if cfg.table and cfg.table_replace:
        overwrite_table(enriched, cfg.table)
    elif cfg.table:
        rows = enriched.withColumn("load_id", F.lit(load_id))
        create_partitioned_table(enriched.sparkSession, cfg.table, rows.schema,
                                 ["processing_date", "load_id"])
        append_table(rows, cfg.table)
    if cfg.per_file_path:
        write_per_file(enriched if by_file is None else by_file, cfg.per_file_path,
                       load_id=load_id, compression=cfg.csv_compression, rebalance=by_file is None)


def read_table(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """The rows of committed loads in the job's table."""
    return only_committed(spark.table(cfg.table), cfg.hold_path)


@dataclass
class JobResult:
    load_id: str
    metrics: dict = field(default_factory=dict)
    seconds: float = 0.0


def _listed(spark: SparkSession, files: list[InputFile]) -> DataFrame:
    return spark.createDataFrame([(f.path, f.name) for f in files], "path string, name string")


def _nothing(load_id: str, t0: float) -> JobResult:
    return JobResult(load_id, dict.fromkeys(LEG_COUNTS, 0), time.time() - t0)


def _then_hold(spark: SparkSession, cfg: JobConfig, source: str, clock: Clock,
               result: JobResult) -> JobResult:
    if cfg.hold_after:
        again = run_hold_reprocess(spark, cfg, source, clock)
        result.metrics["released"] = again.metrics["released"]
        result.seconds += again.seconds
    return result


def _counted(legs: DataFrame) -> dict:
    """Compute the persisted legs in one pass and count them on the way."""
    reason, call = F.col("hold_reason"), F.lit(True)
    counts = []
    if FILE_LINES in legs.columns:
        call = F.col(FILE_LINES).isNull()
        counts = [F.coalesce(F.sum(FILE_LINES), F.lit(0)).alias("records")]
    return legs.agg(F.count_if(call).alias("leg_rows"),
                    F.count_if(call & reason.isNull()).alias("matched"),
                    F.count_if(call & reason.isNotNull()).alias("held"), *counts).first().asDict()


def same_files(spark: SparkSession, log_path: str, loads: list[str], files: DataFrame) -> bool:
    """Whether one of ``files`` (path) was logged by ``loads``."""
    log = spark.read.schema(LOG_SCHEMA).parquet(log_path).where(F.col("load_id").isin(loads))
    theirs, _ = sized_broadcast(log.select("path").distinct())
    return files.join(theirs, "path", "left_semi").limit(1).count() > 0


@dataclass
class _Source:
    """What differs between the loads of the two sources."""
    kind: str
    keys: list[str]
    name_col: str                      # of the legs
    records: Callable                  # (spark, files, cfg) -> parsed records
    legs: Callable                     # (records, masters, clock, date_mode, loaded, counted)
    finish: Callable                   # (legs, clock) -> (matched, held)


def _med_records(spark: SparkSession, files: list[InputFile], cfg: JobConfig) -> DataFrame:
    return parse_records(read_line_groups(spark, scan_groups(files, cfg.source_col), cfg.source_col))


def _ict_records(spark: SparkSession, files: list[InputFile], cfg: JobConfig) -> DataFrame:
    out = None
    for paths, base, whole in scan_groups(files, cfg.source_col):
        part = envelope_records(read_lines_with_position(spark, paths, cfg.source_col, base),
                                spread=not whole)
        out = part if out is None else out.unionByName(part)
    return out


MED = _Source("med", MED_DEDUP_KEYS, "file_name", _med_records, med_legs, finish_med)
ICT = _Source("ict", ICT_DEDUP_KEYS, "INPUTFILENAME", _ict_records, ict_legs,
              lambda legs, clock: finish_ict(legs))


def _load(spark: SparkSession, src: _Source, cfg: JobConfig, clock: Clock) -> JobResult:
    """One attempt at a load: new files to legs to all sinks, then the commit."""
    t0 = time.time()
    load_id = new_load_id(src.kind, clock.processing_date, cfg.load_id)
    seen = latest_version(spark, cfg.hold_path)
    files = new_input_files(spark, cfg.inputs, read_log(spark, cfg.log_path, cfg.hold_path),
                            cfg.source_col)
    if not files:
        return _nothing(load_id, t0)
    return load_files(spark, src, files, cfg, clock, load_id, seen, t0)


def load_files(spark: SparkSession, src: _Source, files: list[InputFile], cfg: JobConfig,
               clock: Clock, load_id: str, seen: int, t0: float,
               batch: str | None = None, records: DataFrame | None = None) -> JobResult:
    """Load the given files under ``load_id`` and commit, or raise ``CommitConflict``.
    ``records`` are their records, where a stream has parsed them already."""
    masters = cfg.masters.load(spark)
    snapshot = keep_snapshot(spark, cfg.hold_path, masters)
    records = src.records(spark, files, cfg) if records is None else records
    size = sum(f.text_bytes for f in files)
    buckets = exactly = None
    if cfg.keys_dir:
        buckets = key_buckets(spark, cfg.keys_dir, max(cfg.keys_buckets, partitions_for(size)))
        # a store of few buckets must not hold a large load to as few tasks: its keys are
        # shuffled then, which are far narrower than the calls
        exactly = buckets if buckets >= partitions_for(size, target_bytes=KEYED_TASK) else None
    with sized_shuffle(spark, size, cfg.size_partitions, target_bytes=LOAD_TASK,
                       exactly=exactly) as parts:
        loaded = None
        if cfg.keys_dir and seen:  # before the first commit the store counts no keys
            dates = records.select(src.keys[2]).distinct()  # far fewer than records to parse
            months = dates.select(key_month(src.keys[2]).alias("key_month")).distinct()
            loaded = loaded_keys(spark, cfg.keys_dir, cfg.hold_path, months, buckets)
        legs = src.legs(records, masters, clock, cfg.date_mode, loaded,
                        cfg.audit_path is not None or cfg.count_lines).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            with sized_scan(spark, files):
                m = _counted(legs)
            enriched, held = src.finish(legs, clock)
            # the legs are far narrower than the rows mapped from them (of ICT they are the
            # same), and one load has one processing date
            listed = _listed(spark, files) if files else None
            tasks = m["matched"] // LYING_ROWS
            if listed is not None and tasks >= parallelism(spark) and listed.select(
                    original_date("name", cfg.date_mode)).distinct().count() <= OPEN_FILES:
                # large as they lie: tasks write long files of every date without a shuffle
                spread = src.finish(legs.coalesce(tasks), clock)[0]
            else:
                spread = src.finish(legs.hint("rebalance", "original_date"), clock)[0] \
                    if src is MED else None
            by_file = None
            if cfg.per_file_path and src is MED:
                # as for the output store: files are long as the rows lie, or the narrow legs
                # are gathered by file and not their 42 columns
                few = tasks >= parallelism(spark) and len({f.name for f in files}) <= OPEN_FILES
                by_file = src.finish(legs.coalesce(tasks) if files and few else legs.hint(
                    "rebalance", src.name_col), clock)[0]
            _write_matched(enriched, cfg, load_id, spread=spread, by_file=by_file)
            write_hold(held, cfg.hold_path, load_id)
            if cfg.audit_path:
                write_audit(file_audit(legs, src.keys, src.name_col), cfg.audit_path, load_id)
            if src is ICT:
                m["bad_headers"] = (legs.where(F.col("hold_reason").contains("bad_header"))
                                    .agg(F.countDistinct("INPUTFILENAME").alias("n")).first()["n"])
            kept = kept_keys(without_counts(legs), src.keys) if cfg.keys_dir else None
            if kept is not None:  # last of what reads the legs: this write drops them
                write_keys(kept, cfg.keys_dir, load_id, buckets)
            if files:
                log_files(listed, cfg.log_path, original_date("name", cfg.date_mode), clock.date(),
                          load_id)
        finally:
            legs.unpersist()  # all is written; other runs may take long until the commit

        def conflicts(newer: list[str]) -> bool:
            return (listed is not None and same_files(
                spark, cfg.log_path, newer, listed)) or (
                kept is not None and any_shared(
                    written_keys(spark, cfg.keys_dir, buckets, load_id),
                    loaded_keys(spark, cfg.keys_dir, cfg.hold_path, None, buckets, newer)))

        if cfg.before_commit:
            cfg.before_commit()
        commit_load(spark, cfg.hold_path, Commit(load_id, seen, masters=snapshot, batch=batch),
                    conflicts)
    secs = time.time() - t0
    m.update(files=len(files), rows_per_sec=round(m["leg_rows"] / secs, 1) if secs else None,
             master_rows_dropped=masters.trunk_dropped + masters.node_dropped,
             shuffle_partitions=parts)
    return JobResult(load_id, m, secs)


def run_med(spark: SparkSession, cfg: JobConfig, clock: Clock = Clock()) -> JobResult:
    """New files only -> duplicate check -> split -> lookups -> enriched
    rows by (original_date, processing_date), held rows to the hold store,
    per-file audit, log, commit."""
    clock = clock.resolved(spark)
    done = until_committed(lambda: _load(spark, MED, cfg, clock))
    return _then_hold(spark, cfg, "MED", clock, done)


def run_ict(spark: SparkSession, cfg: JobConfig, clock: Clock = Clock()) -> JobResult:
    """Envelope CSV extracts -> duplicate check -> split -> trunk lookup
    -> enriched / held, per-file audit, log, commit."""
    clock = clock.resolved(spark)
    done = until_committed(lambda: _load(spark, ICT, cfg, clock))
    return _then_hold(spark, cfg, "ICT", clock, done)


def hold_work(spark: SparkSession, cfg: JobConfig, masters: Masters,
              snapshot: str) -> DataFrame | None:
    """The waiting rows that ``masters`` (stored as ``snapshot``) may look up otherwise
    than the masters they have met: whole leaves of the buckets that hold a node
    whose entries changed.  Leaves of other buckets are not read and stay where they
    are.  None if no bucket is touched."""
    met = met_snapshots(commit_list(spark, cfg.hold_path))
    touched = {old: changed_buckets(spark, cfg.hold_path, None if cfg.hold_full else old, masters)
               for old in set(met.values()) if cfg.hold_full or old != snapshot}
    pairs = [(load, b) for load, old in met.items() for b in touched.get(old, ())]
    if not pairs:
        return None
    work, _ = sized_broadcast(spark.createDataFrame(pairs, "load_id string, hold_bucket int"))
    held = current_hold(spark, cfg.hold_path, "lookup", sorted({b for _, b in pairs}))
    return held.join(work, ["load_id", "hold_bucket"], "left_semi")


def _reprocess(spark: SparkSession, cfg: JobConfig, source_type: str, clock: Clock) -> JobResult:
    t0 = time.time()
    load_id = new_load_id(f"hold-{source_type.lower()}", clock.processing_date, cfg.load_id)
    seen = latest_version(spark, cfg.hold_path)
    if not has_hold(spark, cfg.hold_path):
        return JobResult(load_id, {"released": 0}, time.time() - t0)
    masters = cfg.masters.load(spark)
    snapshot = keep_snapshot(spark, cfg.hold_path, masters)
    held = hold_work(spark, cfg, masters, snapshot)
    if held is None:
        return JobResult(load_id, {"released": 0}, time.time() - t0)
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        base = held.drop("load_id", "hold_class", "hold_bucket")
        reprocess = reprocess_med_hold if source_type == "MED" else reprocess_ict_hold
        done, still = reprocess(base, masters, clock)
        released = Observation("released")
        spread = reprocess(base, masters, clock, spread=True)[0] if source_type == "MED" else None
        _write_matched(done, cfg, load_id, released, spread)
        # before the write to the hold store, which drops the cached rows read from it
        taken = [(r["load_id"], r["hold_bucket"]) for r in
                 held.select("load_id", "hold_bucket").distinct().collect()]  # leaves, no rows
        write_hold(still, cfg.hold_path, load_id)
    finally:
        held.unpersist()
    if cfg.before_commit:
        cfg.before_commit()
    commit_load(spark, cfg.hold_path, Commit(load_id, seen, "hold", masters=snapshot,
                                             supersedes=taken))
    return JobResult(load_id, {"released": released.get["rows"]}, time.time() - t0)


def run_hold_reprocess(spark: SparkSession, cfg: JobConfig, source_type: str = "MED",
                       clock: Clock = Clock()) -> JobResult:
    """Held rows of earlier loads meet the newest masters, as far as these
    changed since (``hold_work``).  Rows that match are written back-dated (their first
    processing date) to the same sinks as a load's; the rest of the leaves read are
    held again under this run's id, and the commit marks those leaves as replaced
    (the folder being read is never rewritten)."""
    clock = clock.resolved(spark)
    return until_committed(lambda: _reprocess(spark, cfg, source_type, clock))


def run_parse(spark: SparkSession, inputs: str | list[str], output_path: str,
              header: bool = True, null_token: str | None = None,
              compression: str | None = None) -> int:
    """Parsed-only export: every call record's 21 fields and its file name as CSV.
    Returns the number of records."""
    files = new_input_files(spark, inputs)
    if not files:
        return 0
    lines = read_line_groups(spark, scan_groups(files)).select("value", "file_name")
    written = Observation("parsed")  # counted by the tasks that write, so one scan is enough
    export_csv(parse_fixed_width(lines).observe(written, F.count(F.lit(1)).alias("rows")),
               output_path, header=header, null_token=null_token, compression=compression)
    return written.get["rows"]
