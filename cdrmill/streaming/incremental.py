"""Incremental loading with Structured Streaming.

New files make a micro-batch.  It takes the files of the folder that the
processed-file log does not have, which is shared with the batch jobs, and loads them
exactly as a batch job would: same sinks, audit, table, log (also of empty files),
commit and conflict check.  Logged files are not read, and a batch that was offered
files which a batch job has loaded meanwhile loads nothing.  A replayed batch does
nothing if some attempt at it was committed.

Within a micro-batch the duplicate check is the batch one (deterministic
winner).  Repeats of earlier batches are dropped in two ways:

* ``keys_dir``: against the store of all keys ever loaded, however old;
* ``repeats_within``: by the stream's own state, for calls that began no longer ago
  than that.  The state store keeps the keys of that span only.  No call is lost:
  records of older calls, or without a valid time, pass by the state, and times in the
  future count as now, so they can't move the watermark.  Which copy stays among
  several in one micro-batch is not determined here.  Such a stream reads its files
  through the stream source, whose checkpoint then is the file memory; it shares no log.

ICT extracts are loaded once their trailer is there; until then they wait, and later
batches look at them again.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cdrmill.functions.parse import parse_fixed_width
from cdrmill.operators.lookup import sized_broadcast
from cdrmill.operators.mapping import Clock
from cdrmill.plans.jobs import ICT, MED, JobConfig, load_files
from cdrmill.plans.med import blanked_keys, filled_keys
from cdrmill.schema import CDR_USED, MED_DEDUP_KEYS
from cdrmill.sinks.commits import is_committed, latest_version, until_committed
from cdrmill.sources.listing import InputFile, new_input_files, scan_groups
from cdrmill.sources.log import read_log
from cdrmill.sources.text import plain, read_lines_with_position
from cdrmill.streaming.metrics import BatchMetrics

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
STATE_ON_DISK = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{ROCKSDB}.boundedMemoryUsage": "true",  # of all stores of an executor together
    f"{ROCKSDB}.maxMemoryUsageMB": "256",
    f"{ROCKSDB}.trackTotalNumberOfRows": "false",  # a look-up more for every row
}


@dataclass
class IncrementalConfig:
    input_dir: str
    output_dir: str
    hold_dir: str
    checkpoint_dir: str
    source_col: str | None = None      # folder partition naming the logical file
    max_files_per_trigger: int | None = None
    name: str = "med"
    keys_dir: str | None = None  # set: also drop calls loaded by earlier batches
    log_path: str | None = None  # set: share the processed-file log with batch jobs
    date_mode: str = "regex"
    audit_path: str | None = None
    table: str | None = None
    per_file_path: str | None = None
    metrics_path: str | None = None    # set: a row of counts and times per micro-batch
    repeats_within: str | None = None  # e.g. "2 days": drop repeats by the stream's state (MED,
                                       # without log_path)
    trailer: str = "EOF"               # how the last line of a finished extract begins (ICT)

    def batch_name(self, batch_id: int) -> str:
        """The same for every attempt at a batch, and no other stream's."""
        place = hashlib.sha1(self.checkpoint_dir.encode()).hexdigest()[:10]
        return f"{self.name}-{place}-{batch_id}"

    def job(self, masters) -> JobConfig:
        """The batch job that a micro-batch is.  Without a log of its own the stream
        keeps one beside the hold store."""
        if self.repeats_within and self.log_path:
            raise ValueError("repeats_within keeps its own file memory: leave log_path unset")
        log = self.log_path or f"{self.hold_dir.rstrip('/')}/_stream_log"
        return JobConfig(self.input_dir, masters, self.output_dir, self.hold_dir, log,
                         audit_path=self.audit_path, date_mode=self.date_mode,
                         source_col=self.source_col, keys_dir=self.keys_dir, table=self.table,
                         per_file_path=self.per_file_path)


@dataclass
class _Given:
    """Masters that are built already, where ``MasterPaths`` is expected."""
    masters: object

    def load(self, spark: SparkSession):
        return self.masters


def stream_lines(spark: SparkSession, cfg: IncrementalConfig) -> DataFrame:
    r = spark.readStream.format("text")
    if cfg.source_col:
        r = r.schema(f"value STRING, {cfg.source_col} STRING")
    if cfg.max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    df = r.load(cfg.input_dir)
    name = F.col(cfg.source_col) if cfg.source_col else plain(F.col("_metadata.file_name"))
    return df.select(F.col("value"), plain(F.col("_metadata.file_path")).alias("file_path"),
                     name.alias("file_name"))


def first_in_state(lines: DataFrame, within: str) -> DataFrame:
    """Parsed records of a stream without those whose call was met before in the span
    ``within`` of event time (``dropDuplicatesWithinWatermark``).

    The time of a record is its call's begin, but not after the batch's own time.
    Records of calls that began longer ago than ``within``, or have no valid time, get a
    key of their own and the batch's time: they are neither compared nor dropped as late.
    """
    parsed = parse_fixed_width(lines, keep=CDR_USED, drop_value=False)
    began = F.try_to_timestamp(F.concat("event_start_date", F.substring("event_start_time", 1, 6)),
                               F.lit("yyyyMMddHHmmss"))
    now = F.current_timestamp()
    old = began.isNull() | (began < now - F.expr(f"INTERVAL {within}"))
    timed = filled_keys(parsed).withColumns({
        "seen_at": F.when(old, now).otherwise(F.least(began, now)),
        # a hash: the state keeps the key, and a line is ten times as long
        "own": F.when(old, F.sha2(F.concat("file_path", F.lit("#"), "value"), 256)).otherwise("")})
    met = timed.withWatermark("seen_at", within).dropDuplicatesWithinWatermark(
        [*MED_DEDUP_KEYS, "own"])
    return blanked_keys(met).select(*[c for c in parsed.columns if c not in ("value", "file_path")])


def finished(spark: SparkSession, files: list[InputFile], cfg: IncrementalConfig) -> list[InputFile]:
    """The extracts whose last line is a trailer's last line."""
    done = set()
    for paths, base, _ in scan_groups(files, cfg.source_col):
        lines = read_lines_with_position(spark, paths, cfg.source_col, base)
        # numbers only, so that lines need not be sorted by file: position and mark in one
        ends = F.startswith("value", F.lit(cfg.trailer)).cast("long")
        splits = lines.groupBy("file_path", "_blk").agg(F.max(F.col("_pos") * 2 + ends).alias("_last"))
        last = splits.groupBy("file_path").agg(F.max(F.struct("_blk", "_last")).alias("l"))
        done |= {r["path"] for r in last.where(F.col("l._last") % 2 == 1)
                 .select(plain(F.col("file_path")).alias("path")).collect()}  # a row a file
    return [f for f in files if re.sub(r"^file:/+", "file:/", f.path) in
            {re.sub(r"^file:/+", "file:/", p) for p in done}]


def _batch_loader(spark: SparkSession, cfg: IncrementalConfig, source, masters,
                  skip: DataFrame | None, clock: Clock, batches: list,
                  metrics: BatchMetrics | None) -> Callable[[DataFrame, int], None]:
    """The per-micro-batch load.  ``masters`` is a built ``Masters`` or anything with
    ``load(spark) -> Masters`` (e.g. ``MasterPaths``), which is then re-read every
    micro-batch so newer master snapshots apply at once.  ``skip`` names files
    (``filename``) that are not to be loaded."""
    job = cfg.job(masters if hasattr(masters, "load") else _Given(masters))
    job.count_lines = cfg.metrics_path is not None

    def load(batch: DataFrame, batch_id: int) -> None:
        name = cfg.batch_name(batch_id)
        if is_committed(spark, cfg.hold_dir, name):
            return  # a replay of a batch that was done
        held_rows = batch.persist(StorageLevel.MEMORY_AND_DISK) if cfg.repeats_within else None

        def attempt():
            t0, bclock = time.time(), clock.resolved(spark)  # one time per attempt
            seen = latest_version(spark, cfg.hold_dir)
            load_id = f"{name}-{uuid.uuid4().hex[:8]}"
            if held_rows is not None:
                if held_rows.isEmpty():
                    return None
                return load_files(spark, source, [], job, bclock, load_id, seen, t0, name, held_rows)
            files = _unlogged(spark, cfg, job, source, skip)[:cfg.max_files_per_trigger]
            return load_files(spark, source, files, job, bclock, load_id, seen, t0,
                              name) if files else None

        try:
            done = until_committed(attempt)
        finally:
            if held_rows is not None:
                held_rows.unpersist()
        if metrics is not None:
            metrics.counted(batch_id, done.metrics if done else {})
        batches.append(batch_id)

    return load


def _unlogged(spark: SparkSession, cfg: IncrementalConfig, job: JobConfig, source,
              skip: DataFrame | None = None) -> list[InputFile]:
    """The files of the folder that the log does not have, oldest first; of extracts the
    finished ones."""
    files = sorted(new_input_files(spark, cfg.input_dir, read_log(
        spark, job.log_path, cfg.hold_dir), cfg.source_col), key=lambda f: (f.modified, f.path))
    if skip is not None and files:
        files = _not_named(spark, files, skip)
    return finished(spark, files, cfg) if source is ICT and files else files


def _not_named(spark: SparkSession, files: list[InputFile], skip: DataFrame) -> list[InputFile]:
    rows = spark.createDataFrame([(f.path, f.name) for f in files], "path string, filename string")
    gone, _ = sized_broadcast(skip.select("filename").where("filename is not null").distinct())
    kept = {r["path"] for r in rows.join(gone, "filename", "left_anti").collect()}
    return [f for f in files if f.path in kept]


@contextmanager
def state_on_disk(spark: SparkSession):
    """A stream started meanwhile keeps its state on the executors' disks, with a bounded
    cache, and not as maps in their memory.  A checkpoint that was begun otherwise goes on as
    it was."""
    before = {k: spark.conf.get(k, None) for k in STATE_ON_DISK}
    for k, v in STATE_ON_DISK.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _start(spark: SparkSession, cfg: IncrementalConfig, load, trigger: dict) -> StreamingQuery:
    rows = stream_lines(spark, cfg)
    if cfg.repeats_within:
        rows = first_in_state(rows, cfg.repeats_within)
    with state_on_disk(spark):
        return (rows.writeStream.foreachBatch(load).option("checkpointLocation", cfg.checkpoint_dir)
                .trigger(**trigger).queryName(f"cdrmill-{cfg.batch_name(0)}").start())


def _metrics(spark: SparkSession, cfg: IncrementalConfig) -> BatchMetrics | None:
    if not cfg.metrics_path:
        return None
    metrics = BatchMetrics(spark, cfg.metrics_path, f"cdrmill-{cfg.batch_name(0)}")
    spark.streams.addListener(metrics)
    return metrics


def start_med_stream(spark: SparkSession, cfg: IncrementalConfig, masters,
                     log: DataFrame | None = None, clock: Clock = Clock(),
                     interval: str = "1 minute") -> StreamingQuery:
    """A long-running incremental load: a micro-batch every ``interval``
    over the files that arrived since the last one.  Returns the query."""
    load = _batch_loader(spark, cfg, MED, masters, log, clock, [], _metrics(spark, cfg))
    return _start(spark, cfg, load, {"processingTime": interval})


def _run(spark: SparkSession, cfg: IncrementalConfig, source, masters, log, clock) -> int:
    batches: list = []
    metrics = _metrics(spark, cfg)
    load = _batch_loader(spark, cfg, source, masters, log, clock, batches, metrics)
    try:
        q = _start(spark, cfg, load, {"availableNow": True})
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        if metrics is not None:
            metrics.wait()
    finally:
        if metrics is not None:
            spark.streams.removeListener(metrics)
    return len(batches)


def run_med_incremental(spark: SparkSession, cfg: IncrementalConfig, masters,
                        log: DataFrame | None = None, clock: Clock = Clock()) -> int:
    """Process every file not yet seen, then stop (``availableNow``).
    Returns the number of micro-batches run."""
    return _run(spark, cfg, MED, masters, log, clock)


def run_ict_incremental(spark: SparkSession, cfg: IncrementalConfig, masters,
                        clock: Clock = Clock()) -> int:
    """The same for ICT extracts.  Those without their trailer wait; they are looked at
    again by every later batch and, as an extract that grows is no new file, once more
    after the last one.  Returns the number of micro-batches that ran."""
    n = _run(spark, cfg, ICT, masters, None, clock)
    job = cfg.job(masters if hasattr(masters, "load") else _Given(masters))

    def sweep():
        seen = latest_version(spark, cfg.hold_dir)
        files = _unlogged(spark, cfg, job, ICT)
        if files:
            t0, at = time.time(), clock.resolved(spark)
            load_id = f"{cfg.batch_name(n)}-waited-{uuid.uuid4().hex[:8]}"
            load_files(spark, ICT, files, job, at, load_id, seen, t0)

    until_committed(sweep)
    return n
