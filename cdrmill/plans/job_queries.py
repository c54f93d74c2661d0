"""Registered queries that run the jobs over real files.

Stand-in call-record files are written once per query, split over two hour
folders; the jobs then list, load, log, hold, reprocess and commit as a user's
would, and the query returns what the stores hold afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdrmill import fixtures as fx
from cdrmill.operators.mapping import FIXED_CLOCK, Clock
from cdrmill.plans.ict import enrich_ict
from cdrmill.plans.jobs import (JobConfig, MasterPaths, read_table, run_hold_reprocess, run_ict,
                                run_med, run_parse)
from cdrmill.schema import CDR_COLUMNS, ENRICHED_COLUMNS
from cdrmill.session import scratch_path, unsorted_write
from cdrmill.sinks.commits import commit_list, hadoop_path
from cdrmill.sinks.maintenance import (clean_up, compact_hold, compact_output, load_sizes,
                                       rewrite_loads)
from cdrmill.sinks.writers import append_table, current_hold, read_audit, read_enriched
from cdrmill.sources.envelope import read_envelope_csv
from cdrmill.sources.log import read_log
from cdrmill.sources.masters import read_rejects
from cdrmill.streaming.incremental import (IncrementalConfig, run_ict_incremental,
                                           run_med_incremental)
from cdrmill.streaming.metrics import read_metrics

LATER = Clock("2024-07-03 09:00:00", "2024-07-03")
KEYS_BUCKETS = 4  # the stand-in calls are spread over 84 months
LINES_A_FILE = 400_000
SOURCES = 8       # ICT extracts
CALL = ["ANUM", "BNUM", "EVENT_START_DATE", "EVENT_START_TIME"]


# ---------------------------------------------------------------- inputs
def masters_as_files(spark: SparkSession, sf_dir: str, corrected: bool = False,
                     date: str = "20240401", added: DataFrame | None = None) -> MasterPaths:
    """The stand-in masters (with further trunk rows) as pipe files in dated folders."""
    root = scratch_path(spark, "masters")
    trunk = (fx.corrected_trunk_master if corrected else fx.trunk_master)(spark, sf_dir)
    node = (fx.corrected_node_master if corrected else fx.node_master)(spark, sf_dir)
    trunk = trunk if added is None else trunk.unionByName(added)
    for kind, df in (("trunk", trunk), ("node", node)):
        df.write.option("header", True).option("sep", "|").csv(f"{root}/{kind}/{date}")
    return MasterPaths(f"{root}/trunk/*/*.csv", f"{root}/node/*/*.csv", snapshot_by="folder")


def hour_by_file(value: Column, name: Column) -> Column:
    """Files 0 and 1 come in hour 10, the others in hour 11."""
    return F.when(F.substring(name, 4, 1).isin("0", "1"), "10").otherwise("11")


def hour_by_caller(value: Column, name: Column) -> Column:
    """Calls by the last digit of the caller's number, so that both hours have a
    file of every name."""
    return F.when(F.substring(value, 78, 1).cast("int") % 2 == 0, "10").otherwise("11")


def write_lines(lines: DataFrame, root: str, *folders: str, mode: str = "errorifexists") -> None:
    """``value`` as gzip text, in folders by the given columns; files of at most
    ``LINES_A_FILE`` lines, so that their number follows the data and a task can read each."""
    with unsorted_write(lines.sparkSession):
        (lines.select("value", *folders).write.mode(mode).option("compression", "gzip")
         .option("maxRecordsPerFile", LINES_A_FILE).partitionBy(*folders).text(root))


def write_hours(spark: SparkSession, sf_dir: str, hour: Callable = hour_by_file) -> str:
    """``<root>/hour=<hh>/source=<file name>/part-*``."""
    root = scratch_path(spark, "hours")
    lines = fx.cdr_lines(spark, sf_dir)
    write_lines(lines.select("value", hour(F.col("value"), F.col("file_name")).alias("hour"),
                             F.col("file_name").alias("source")), root, "hour", "source")
    return root


def write_extracts(lines: DataFrame, parts: int, root: str, *folders: str,
                   line: Column | None = None) -> None:
    """Extract lines (``source, section, value`` and further folder columns) as gzip files,
    each with its whole envelope: ``parts`` files an extract, dealt by record.  ``line``
    makes the line of further columns, after the shuffle: those are narrower."""
    given = [c for c in lines.columns if c not in ("source", "section", *folders)]
    part = F.pmod(F.hash(*given), F.lit(parts))
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    dealt = lines.withColumn("part", F.explode(F.when(
        F.col("section") == 2, F.array(part)).otherwise(every)))
    by = [*folders, "source", "part"]
    (dealt.repartition(SOURCES * parts, *by).sortWithinPartitions(*by, "section")
     .select(F.col("value") if line is None else line.alias("value"), *by)
     .write.option("compression", "gzip").partitionBy(*by).text(root))


def write_extract_hours(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The first four extracts in hour 10, the others in hour 11."""
    rows = fx.ict_envelope_rows(spark, sf_dir).withColumn(
        "hour", F.when(F.substring("source", 4, 1) < "4", "10").otherwise("11"))
    write_extracts(rows, extract_parts(spark, sf_dir), root, "hour", line=fx.ict_line())


def extract_parts(spark: SparkSession, sf_dir: str) -> int:
    """Files an extract, so that they stay within ``LINES_A_FILE`` lines or so."""
    records = fx._table(spark, sf_dir, "lineitem").count()  # from the files' footers
    return max(1, -(-records // (SOURCES * LINES_A_FILE)))


def job_config(spark: SparkSession, sf_dir: str, inputs: str, **more) -> JobConfig:
    root = scratch_path(spark, "job")
    return JobConfig(inputs, more.pop("masters", None) or masters_as_files(spark, sf_dir),
                     f"{root}/out", f"{root}/hold", f"{root}/log", audit_path=f"{root}/audit",
                     source_col="source", keys_buckets=KEYS_BUCKETS,
                     csv_compression="gzip", **more)


# ---------------------------------------------------------------- results
def stored_calls(spark: SparkSession, cfg: JobConfig, released: DataFrame | None = None) -> DataFrame:
    """Every leg the stores hold: the call, its leg, file and state.  ``released``: the
    rows of hold runs, in place of those in the output store."""
    done = read_enriched(spark, cfg.output_path, cfg.hold_path)
    if released is not None:
        loaded = done.where(~F.startswith("load_id", F.lit("hold-")))
        done = loaded.unionByName(released.select(*loaded.columns))
    done = done.select(
        *CALL, "leg", F.col("INPUTFILENAME").alias("file_name"), F.lit("matched").alias("state"))
    held = current_hold(spark, cfg.hold_path).select(
        F.col("anum").alias("ANUM"), F.col("bnum").alias("BNUM"),
        F.col("event_start_date").alias("EVENT_START_DATE"),
        F.substring("event_start_time", 1, 6).alias("EVENT_START_TIME"), "leg", "file_name",
        F.col("hold_reason").alias("state"))
    return done.unionByName(held)


def _two_loads(spark: SparkSession, sf_dir: str, hour: Callable, keys: bool = False) -> JobConfig:
    """The first hour loaded, then both hours offered to the same job that day."""
    root = write_hours(spark, sf_dir, hour)
    cfg = job_config(spark, sf_dir, f"{root}/hour=10")
    cfg.keys_dir = cfg.output_path + "-keys" if keys else None
    run_med(spark, cfg, FIXED_CLOCK)
    cfg.inputs = f"{root}/hour=*"
    run_med(spark, cfg, FIXED_CLOCK)
    return cfg


def q_med_two_loads_same_day(spark, sf_dir):
    """Two runs of one job on one day: both loads' legs, matched and held."""
    return stored_calls(spark, _two_loads(spark, sf_dir, hour_by_file))


def q_same_name_two_hours(spark, sf_dir):
    """Files of the same names in two hour folders: both are loaded."""
    return stored_calls(spark, _two_loads(spark, sf_dir, hour_by_caller))


def q_cross_load_dedup(spark, sf_dir):
    """The second load drops the calls that the first one kept, however old."""
    return stored_calls(spark, _two_loads(spark, sf_dir, hour_by_file, keys=True))


def q_file_log_all_repeats(spark, sf_dir):
    """Files whose calls were all loaded before are logged too, and a further run
    finds nothing new.  Per file: how often logged, runs that logged it, legs."""
    root = write_hours(spark, sf_dir, lambda value, name: F.lit("10"))
    again = write_hours(spark, sf_dir, lambda value, name: F.lit("11"))
    cfg = job_config(spark, sf_dir, f"{root}/hour=10")
    cfg.keys_dir = cfg.output_path + "-keys"
    for inputs in (f"{root}/hour=10", f"{again}/hour=11", [f"{root}/hour=10", f"{again}/hour=11"]):
        cfg.inputs = inputs
        run_med(spark, cfg, FIXED_CLOCK)
    log = read_log(spark, cfg.log_path, cfg.hold_path)
    runs = log.groupBy("filename").agg(F.countDistinct("load_id").alias("n_runs"))
    legs = (stored_calls(spark, cfg).groupBy(F.col("file_name").alias("filename"))
            .agg(F.count(F.lit(1)).alias("n_legs")))
    return runs.join(legs, "filename", "left")


def q_stream_then_batch(spark, sf_dir):
    """The stream loads the first hour, the batch job is offered both: no file is
    loaded twice, for they share the log."""
    root = write_hours(spark, sf_dir, hour_by_caller)
    cfg = job_config(spark, sf_dir, f"{root}/hour=*")
    inc = IncrementalConfig(f"{root}/hour=10", cfg.output_path, cfg.hold_path,
                            scratch_path(spark, "stream-ckpt"), source_col="source",
                            log_path=cfg.log_path)
    run_med_incremental(spark, inc, cfg.masters, clock=FIXED_CLOCK)
    run_med(spark, cfg, FIXED_CLOCK)
    return stored_calls(spark, cfg)


def q_hold_reprocess_twice_same_day(spark, sf_dir):
    """Held rows meet the old masters, then the corrected ones, on one day; a
    table gets the released rows as well.  Returns every leg and its state, the released
    legs from the table.  Both passes look up all waiting rows: the second one takes over
    what the first one held again."""
    root = write_hours(spark, sf_dir)
    cfg = job_config(spark, sf_dir, f"{root}/hour=*", hold_full=True)
    run_med(spark, cfg, FIXED_CLOCK)
    cfg.table = "released_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    released = run_hold_reprocess(spark, cfg, "MED", LATER).metrics["released"]
    cfg.masters = masters_as_files(spark, sf_dir, corrected=True)
    released += run_hold_reprocess(spark, cfg, "MED", LATER).metrics["released"]
    rows = read_table(spark, cfg)
    if rows.count() != released:
        raise AssertionError("the table has other rows than those released")
    return stored_calls(spark, cfg, released=rows)


def q_table_append_repeat(spark, sf_dir):
    """The job's table after a run that died before its commit, a full run and a
    hold run: each leg once, counted by date and kind of load."""
    root = write_hours(spark, sf_dir)
    name = "enriched_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    cfg = job_config(spark, sf_dir, f"{root}/hour=*", table=name)
    run_med(spark, cfg, FIXED_CLOCK)
    died = spark.table(name).withColumn("load_id", F.lit("died-before-commit"))
    append_table(died, name)
    cfg.masters = masters_as_files(spark, sf_dir, corrected=True)
    run_hold_reprocess(spark, cfg, "MED", LATER)
    rows = read_table(spark, cfg)
    return (rows.groupBy("original_date", F.col("processing_date").cast("string")
                         .alias("processing_date"),
                         F.substring_index("load_id", "-", 1).alias("kind"))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.col("CHARGED_USAGE").cast("long")).alias("usage")))


def q_med_job_files(spark, sf_dir):
    """The MED job over files in hour folders: masters by dated folder, the date as
    second ``_`` field of the file name, CSV output with ``dd/MM/yyyy HH:mm``
    times, read back as text with its partitions."""
    root = scratch_path(spark, "named")
    name = F.concat(F.substring("file_name", 1, 4), F.lit("_"), F.substring("file_name", 6, 8),
                    F.lit("_x.cdr"))
    write_lines(fx.cdr_lines(spark, sf_dir).select("value", name.alias("source")), root, "source")
    cfg = job_config(spark, sf_dir, f"{root}/source=*", output_format="csv", date_mode="split",
                     time_format="dd/MM/yyyy HH:mm")
    run_med(spark, cfg, FIXED_CLOCK)
    cols = [*ENRICHED_COLUMNS, "leg"]
    back = (spark.read.schema(", ".join(f"`{c}` string" for c in
                                        [*cols, "original_date", "processing_date", "load_id"]))
            .option("header", True).option("basePath", cfg.output_path).csv(cfg.output_path))
    return back.drop("load_id")


def q_per_file_export(spark, sf_dir):
    """The job's per-file CSV folders read back: legs and usage per input file."""
    root = write_hours(spark, sf_dir)
    cfg = job_config(spark, sf_dir, f"{root}/hour=*")
    cfg.per_file_path = cfg.output_path + "-per-file"
    run_med(spark, cfg, FIXED_CLOCK)
    written = [c for c in ENRICHED_COLUMNS if c != "INPUTFILENAME"] + ["original_date", "leg"]
    back = (spark.read.schema(", ".join(f"`{c}` string" for c in [
        *written, "INPUTFILENAME", "processing_date", "load_id"]))
        .option("header", True).option("basePath", cfg.per_file_path).csv(cfg.per_file_path))
    return back.groupBy("INPUTFILENAME", "original_date", "processing_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("CHARGED_USAGE").cast("long")).alias("usage"))


def q_parsed_csv_export(spark, sf_dir):
    """The parsed-only job's CSV read back: all 21 fields of every record."""
    root = scratch_path(spark, "plain-in")
    write_lines(fx.cdr_lines(spark, sf_dir), root)
    out = scratch_path(spark, "plain-out")
    run_parse(spark, f"{root}/part-*", out, compression="gzip")
    schema = ", ".join(f"`{c}` string" for c in ["file_name", *CDR_COLUMNS])
    return spark.read.schema(schema).option("header", True).csv(out).drop("file_name")


# ---------------------------------------------------------------- ICT
BROKEN_AFTER = 40  # fields that a ragged line keeps


def write_odd_extracts(spark: SparkSession, sf_dir: str) -> str:
    """Extracts as ``fx.ict_envelope_lines``, but: files 0 and 4 have their columns
    in reverse order, file 1 lacks the column BNUM, in file 2 the lines of callers
    ending in 7 are cut off, and the name of file 3 has no date."""
    c = F.col
    rec = fx.ict_records(spark, sf_dir)
    no = F.substring("source", 4, 1)
    line = (F.when(no.isin("0", "4"), F.concat_ws(",", *[c(n) for n in reversed(ENRICHED_COLUMNS)]))
            .when(no == "1", F.concat_ws(",", *[c(n) for n in ENRICHED_COLUMNS if n != "BNUM"]))
            .when((no == "2") & (F.substring("ANUM", -1, 1) == "7"),
                  F.concat_ws(",", *[c(n) for n in ENRICHED_COLUMNS[:BROKEN_AFTER]]))
            .otherwise(c("value")))
    header = (F.when(no.isin("0", "4"), ",".join(reversed(ENRICHED_COLUMNS)))
              .when(no == "1", ",".join(n for n in ENRICHED_COLUMNS if n != "BNUM"))
              .otherwise(fx.ICT_HEADER_LINE))
    source = F.when(no == "3", "ICT3_undated.csv").otherwise(c("source")).alias("source")
    body = rec.select(source, F.lit(2).alias("section"), line.alias("value"))
    env = rec.select("source").distinct().select(source, F.explode(F.array(
        F.struct(F.lit(0).alias("section"), F.lit("HDR,x").alias("value")),
        F.struct(F.lit(1).alias("section"), header.alias("value")),
        F.struct(F.lit(3).alias("section"), F.lit("TRL,x").alias("value")),
        F.struct(F.lit(4).alias("section"), F.lit("EOF").alias("value")))).alias("e")).select(
        "source", "e.section", "e.value")
    root = scratch_path(spark, "odd-ict")
    write_extracts(body.unionByName(env), extract_parts(spark, sf_dir), root)
    return root


def q_envelope_reordered_header(spark, sf_dir):
    """Records of all odd extracts: columns by header name whatever their order, and what
    is wrong with the lines of the others."""
    root = write_odd_extracts(spark, sf_dir)
    rows = read_envelope_csv(spark, root, source_col="source", base_path=root, spread=False)
    return rows.select("file_name", "line_problem", *ENRICHED_COLUMNS)


def q_ict_bad_records_held(spark, sf_dir):
    """Legs of the odd extracts per file and state: broken lines, files without a
    column or a date are held with their reason."""
    root = write_odd_extracts(spark, sf_dir)
    rows = read_envelope_csv(spark, root, source_col="source", base_path=root, spread=False)
    out = enrich_ict(rows, masters_as_files(spark, sf_dir).load(spark), FIXED_CLOCK)
    return out.legs.groupBy(F.col("INPUTFILENAME").alias("file_name"),
                            F.coalesce("hold_reason", F.lit("matched")).alias("state")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def q_ict_two_loads_same_day(spark, sf_dir):
    """Two runs of the ICT job on one day over a growing folder: legs per file and
    state of both."""
    root = scratch_path(spark, "ict-hours")
    write_extract_hours(spark, sf_dir, root)
    cfg = job_config(spark, sf_dir, f"{root}/hour=10")
    run_ict(spark, cfg, FIXED_CLOCK)
    cfg.inputs = f"{root}/hour=*"
    run_ict(spark, cfg, FIXED_CLOCK)
    return _ict_states(spark, cfg)


# ---------------------------------------------------------------- overlapping runs
def _interleaved(first: JobConfig, second: JobConfig, run: Callable) -> None:
    """``first`` runs; when all its rows are written and only the commit is left,
    ``second`` runs from beginning to end."""
    begun = []

    def other() -> None:
        if not begun:
            begun.append(True)
            run(second)

    first.before_commit = other
    run(first)


def _copy(cfg: JobConfig, **changed) -> JobConfig:
    return JobConfig(**{**cfg.__dict__, **changed})


def q_overlapping_runs(spark, sf_dir):
    """Two loads that overlap: one is offered both hours, the other the first hour only
    and commits first.  Every leg is there once."""
    root = write_hours(spark, sf_dir)
    both = job_config(spark, sf_dir, f"{root}/hour=*")
    _interleaved(both, _copy(both, inputs=f"{root}/hour=10"),
                 lambda cfg: run_med(spark, cfg, FIXED_CLOCK))
    return stored_calls(spark, both)


def q_overlapping_runs_keys(spark, sf_dir):
    """Two loads of different files with calls in common overlap: the one that commits
    second drops the calls that the other one kept."""
    root = write_hours(spark, sf_dir)
    late = job_config(spark, sf_dir, f"{root}/hour=11")
    late.keys_dir = late.output_path + "-keys"
    _interleaved(late, _copy(late, inputs=f"{root}/hour=10"),
                 lambda cfg: run_med(spark, cfg, FIXED_CLOCK))
    return stored_calls(spark, late)


def q_overlapping_hold_runs(spark, sf_dir):
    """Two hold runs that overlap release every held leg once."""
    root = write_hours(spark, sf_dir)
    cfg = job_config(spark, sf_dir, f"{root}/hour=*")
    run_med(spark, cfg, FIXED_CLOCK)
    cfg.masters = masters_as_files(spark, sf_dir, corrected=True)
    _interleaved(cfg, _copy(cfg), lambda c: run_hold_reprocess(spark, c, "MED", LATER))
    return stored_calls(spark, cfg)


# ---------------------------------------------------------------- hold by difference
def q_hold_master_difference(spark, sf_dir):
    """Masters that gain a few entries: only the held rows of their nodes are read again.
    Returns every leg and its state, as after a full pass."""
    root = write_hours(spark, sf_dir)
    cfg = job_config(spark, sf_dir, f"{root}/hour=*")
    run_med(spark, cfg, FIXED_CLOCK)
    added = fx.corrected_trunk_master(spark, sf_dir).where(
        (F.col("ID") == "TG999999") & (F.col("FK_NNOD") < "ND05"))
    cfg.masters = masters_as_files(spark, sf_dir, added=added)
    run_hold_reprocess(spark, cfg, "MED", LATER)
    return stored_calls(spark, cfg)


def q_ict_hold_job(spark, sf_dir):
    """The ICT job, then its hold job with corrected masters: released legs keep their
    first processing date.  Legs per file, state and date."""
    root = scratch_path(spark, "ict-hold-in")
    write_extracts(fx.ict_envelope_rows(spark, sf_dir), extract_parts(spark, sf_dir), root,
                   line=fx.ict_line())
    cfg = job_config(spark, sf_dir, root)
    run_ict(spark, cfg, FIXED_CLOCK)
    cfg.masters = masters_as_files(spark, sf_dir, corrected=True)
    run_hold_reprocess(spark, cfg, "ICT", LATER)
    return _ict_states(spark, cfg, "processing_date")


# ---------------------------------------------------------------- counts and odd lines
def odd_lines(lines: DataFrame) -> DataFrame:
    """Call records, some with blank numbers (blank duplicate-check keys), some cut off
    after the numbers."""
    v, digit = F.col("value"), F.substring("value", 106, 1)
    return lines.withColumn("value", F.when(digit == "3", F.concat(
        F.substring(v, 1, 66), F.lit(" " * 56), F.substring(v, 123, 296)))
        .when(digit == "5", F.rtrim(F.substring(v, 1, 122))).otherwise(v))


def q_odd_lines_audit(spark, sf_dir):
    """The job's audit over odd lines: records merged under a blank key have a column of
    their own."""
    root = scratch_path(spark, "odd-lines")
    write_lines(odd_lines(fx.cdr_lines(spark, sf_dir)).select(
        "value", F.col("file_name").alias("source")), root, "source")
    cfg = job_config(spark, sf_dir, root)
    run_med(spark, cfg, FIXED_CLOCK)
    return read_audit(spark, cfg.audit_path, cfg.hold_path).drop("load_id")


# ---------------------------------------------------------------- streams
STREAM_STEPS = (("0", "1"), ("2",), ("3",))  # files that arrive together


def recent(lines: DataFrame) -> DataFrame:
    """Call records of yesterday; those of callers ending in 9 are a month old.  The date
    they had goes behind the called number, so that calls stay as distinct as they are."""
    v = F.col("value")
    days = F.when(F.substring(v, 78, 1) == "9", 30).otherwise(1)
    day = F.date_format(F.date_sub(F.current_date(), days), "yyyyMMdd")
    return lines.withColumn("value", F.concat(
        F.substring(v, 1, 40), day, F.substring(v, 49, 58), F.substring(v, 41, 8),
        F.substring(v, 115, 304)))


def _streamed(spark: SparkSession, sf_dir: str, lines: DataFrame, **how) -> IncrementalConfig:
    """The stream run three times over a growing folder."""
    root = scratch_path(spark, "stream")
    base = scratch_path(spark, "stream-out")
    cfg = IncrementalConfig(root, f"{base}/out", f"{base}/hold", f"{base}/ckpt",
                            source_col="source", **how)
    masters = masters_as_files(spark, sf_dir)
    for files in STREAM_STEPS:
        write_lines(lines.where(F.substring("file_name", 4, 1).isin(*files)).select(
            "value", F.col("file_name").alias("source")), root, "source", mode="append")
        run_med_incremental(spark, cfg, masters, clock=FIXED_CLOCK)
    return cfg


def _states(spark: SparkSession, cfg: IncrementalConfig) -> DataFrame:
    return stored_calls(spark, JobConfig(None, None, cfg.output_dir, cfg.hold_dir, None))


def q_stream_late_repeats(spark, sf_dir):
    """A stream that drops repeats by its own state: those within two days of event time
    go, in whichever batch they come; older calls pass by the state."""
    cfg = _streamed(spark, sf_dir, recent(fx.cdr_lines(spark, sf_dir)), repeats_within="2 days")
    return _states(spark, cfg).drop("EVENT_START_DATE", "file_name")


def q_stream_batch_metrics(spark, sf_dir):
    """Rows per micro-batch from the stream's metrics table."""
    metrics = scratch_path(spark, "stream-metrics")
    _streamed(spark, sf_dir, fx.cdr_lines(spark, sf_dir), metrics_path=metrics)
    return read_metrics(spark, metrics).where("batch_ms > 0 and records_per_sec > 0").select(
        F.row_number().over(Window.orderBy("batch_id")).cast("long").alias("batch_no"),
        "records", "leg_rows", "matched", "held")


def _place(spark: SparkSession, folder: str, target: str, only: str) -> None:
    """Move the extract files of a written folder to ``target/<name>/extract-<part>.csv.gz``."""
    _, path, fs = hadoop_path(spark, folder)
    for d in fs.listStatus(path):
        name = d.getPath().getName()
        if not name.startswith("source=") or name[len("source=ICT")] not in only:
            continue
        for sub in fs.listStatus(d.getPath()):
            part = next(p.getPath() for p in fs.listStatus(sub.getPath())
                        if p.getPath().getName().startswith("part-"))
            no = sub.getPath().getName()[len("part="):]
            _, to, _ = hadoop_path(spark, f"{target}/{name}/extract-{no}.csv.gz")
            fs.mkdirs(to.getParent())
            fs.delete(to, False)
            fs.rename(part, to)


def q_ict_stream(spark, sf_dir):
    """Extracts as a stream: half of them have no trailer when the first batch runs and
    wait; later they are whole.  Legs per file and state, as from two batch loads."""
    rows = fx.ict_envelope_rows(spark, sf_dir)
    early = F.substring("source", 4, 1) < "4"
    landing = scratch_path(spark, "ict-landing")
    parts = extract_parts(spark, sf_dir)
    for complete in (False, True):
        whole = scratch_path(spark, "ict-part")
        offered = rows.where(~early if complete else early | (F.col("section") < 3))
        write_extracts(offered, parts, whole, line=fx.ict_line())
        _place(spark, whole, landing, "4567" if complete else "01234567")
        base = f"{landing}-out"
        cfg = IncrementalConfig(landing, f"{base}/out", f"{base}/hold", f"{base}/ckpt",
                                source_col="source", name="ict", log_path=f"{base}/log")
        run_ict_incremental(spark, cfg, masters_as_files(spark, sf_dir), FIXED_CLOCK)
    return _ict_states(spark, JobConfig(None, None, cfg.output_dir, cfg.hold_dir, None))


def _ict_states(spark: SparkSession, cfg: JobConfig, *more: str) -> DataFrame:
    """Legs per file and state (and more columns, as text) that the stores hold."""
    more = [F.col(c).cast("string").alias(c) for c in more]
    done = read_enriched(spark, cfg.output_path, cfg.hold_path).select(
        "INPUTFILENAME", F.lit("matched").alias("state"), *more)
    held = current_hold(spark, cfg.hold_path).select(
        "INPUTFILENAME", F.col("hold_reason").alias("state"), *more)
    both = done.unionByName(held).withColumnRenamed("INPUTFILENAME", "file_name")
    return both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("n_rows"))


def q_ict_cross_load_dedup(spark, sf_dir):
    """Two runs of the ICT job: the second drops the calls that the first one kept."""
    root = scratch_path(spark, "ict-hours")
    write_extract_hours(spark, sf_dir, root)
    cfg = job_config(spark, sf_dir, f"{root}/hour=10")
    cfg.keys_dir = cfg.output_path + "-keys"
    run_ict(spark, cfg, FIXED_CLOCK)
    cfg.inputs = f"{root}/hour=*"
    run_ict(spark, cfg, FIXED_CLOCK)
    return _ict_states(spark, cfg)


# ---------------------------------------------------------------- upkeep
def q_compacted_stores(spark, sf_dir):
    """Two loads and a hold run, then both stores compacted and dead leaves removed (also
    those of a run that died): the same legs as before, fewer leaves."""
    cfg = _two_loads(spark, sf_dir, hour_by_file)
    cfg.masters = masters_as_files(spark, sf_dir, corrected=True)
    run_hold_reprocess(spark, cfg, "MED", LATER)
    rewrite_loads(spark, cfg.output_path, [c.load_id for c in commit_list(spark, cfg.hold_path)],
                  "died-before-commit")
    leaves = lambda: sum(load_sizes(spark, p).count() for p in (cfg.output_path, cfg.hold_path))
    before = leaves()
    compact_output(spark, cfg.output_path, cfg.hold_path, "2024-07-04")
    compact_hold(spark, cfg.hold_path, "2024-07-04")
    clean_up(spark, cfg.hold_path, cfg.output_path, grace_seconds=0)
    if leaves() >= before:
        raise AssertionError("compaction left as many leaves as there were")
    return stored_calls(spark, cfg)


# ---------------------------------------------------------------- masters
def q_master_rejects(spark, sf_dir):
    """A trunk master with broken lines, lines without a key and padded ones: what is left
    out, with the reason, and what is used."""
    c = F.col
    trunk = fx.trunk_master(spark, sf_dir).withColumn(
        "d", F.substring("ID", -1, 1))
    fields = [F.when((c("d") == "1") & F.lit(n == "ID"), " ").when(
        c("d") == "2", F.concat(F.lit("  "), c(n), F.lit("   "))).otherwise(c(n))
        for n in ("ID", "NAME", "FK_NNOD", "OPERATOR", "POI")]
    line = F.concat_ws("|", *fields)
    line = (F.when(c("d") == "3", F.concat_ws("|", c("ID"), c("NAME")))
            .when(c("d") == "4", F.concat(line, F.lit("|x"))).otherwise(line))
    lines = trunk.select(F.lit(1).alias("n"), line.alias("value"))
    head = spark.createDataFrame([(0, "ID|NAME|FK_NNOD|OPERATOR|POI")], "n int, value string")
    root = scratch_path(spark, "broken-masters")
    (lines.unionByName(head).repartition(1).sortWithinPartitions("n").select("value")
     .write.text(f"{root}/trunk/20240401"))
    paths = MasterPaths(f"{root}/trunk/*/*.txt", None, snapshot_by="folder", max_broken=0.5,
                        rejects_path=f"{root}/rejects")
    used = paths.load(spark).trunk
    return read_rejects(spark, f"{root}/rejects").select(c("problem").alias("state"), "line").unionByName(
        used.select(F.lit("used").alias("state"),
                    F.concat_ws("|", "ID", "NAME", "FK_NNOD", "OPERATOR", "POI").alias("line")))


# ---------------------------------------------------------------- other sinks and names
def q_table_replace(spark, sf_dir):
    """A job that replaces its table: after two loads it holds the second one's rows."""
    name = "latest_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    root = write_hours(spark, sf_dir)
    cfg = job_config(spark, sf_dir, f"{root}/hour=10", table=name, table_replace=True)
    run_med(spark, cfg, FIXED_CLOCK)
    cfg.inputs = f"{root}/hour=*"
    run_med(spark, cfg, FIXED_CLOCK)
    return spark.table(name).groupBy("INPUTFILENAME", "leg").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("CHARGED_USAGE").cast("long")).alias("usage"))


def q_plain_csv_export(spark, sf_dir):
    """The job's CSV without header and partitions, read back by position."""
    root = write_hours(spark, sf_dir)
    cfg = job_config(spark, sf_dir, f"{root}/hour=*")
    cfg.plain_csv_path = cfg.output_path + "-plain"
    run_med(spark, cfg, FIXED_CLOCK)
    cols = [*ENRICHED_COLUMNS, "original_date", "processing_date", "leg"]
    return spark.read.schema(", ".join(f"`{c}` string" for c in cols)).csv(cfg.plain_csv_path)


def q_named_files_open_clock(spark, sf_dir):
    """Files with names of their own (no folder names them), masters by the date in their
    file name, the session's clock: calls with their file's first letters, the operator
    of the newest master, and whether time and date are those of the run."""
    root = scratch_path(spark, "named-in")
    staged = scratch_path(spark, "staged")
    write_lines(fx.cdr_lines(spark, sf_dir).select(
        "value", F.col("file_name").alias("source")), staged, "source")
    _, path, fs = hadoop_path(spark, staged)
    for d in fs.listStatus(path):
        name = d.getPath().getName()
        if name.startswith("source="):
            _, to, _ = hadoop_path(spark, f"{root}/{name[7:11]}")
            fs.mkdirs(to)
            for i, p in enumerate(p for p in fs.listStatus(d.getPath())
                                  if p.getPath().getName().startswith("part-")):
                _, to, _ = hadoop_path(spark, f"{root}/{name[7:11]}/{i}_{name[7:]}.gz")
                fs.rename(p.getPath(), to)
    masters = scratch_path(spark, "named-masters")
    snaps = fx.trunk_snapshots(spark, sf_dir)
    for kind, date, df in (("trunk", "20240401", snaps.where("OPERATOR = 'OLD'")),
                           ("trunk", "20240410", snaps.where("OPERATOR <> 'OLD'")),
                           ("node", "20240401", fx.node_master(spark, sf_dir))):
        stage = scratch_path(spark, "stage-master")
        df.drop("snapshot_name").coalesce(1).write.option("header", True).option("sep", "|").csv(stage)
        _, path, fs = hadoop_path(spark, stage)
        part = next(p.getPath() for p in fs.listStatus(path) if p.getPath().getName().startswith("part-"))
        _, to, _ = hadoop_path(spark, f"{masters}/{kind}/{kind}_{date}.csv")
        fs.mkdirs(to.getParent())
        fs.rename(part, to)
    cfg = job_config(spark, sf_dir, f"{root}/*/*.cdr.gz",
                     masters=MasterPaths(f"{masters}/trunk/*.csv", f"{masters}/node/*.csv"))
    cfg.source_col = None
    begun = Clock().resolved(spark)
    run_med(spark, cfg)
    ended = Clock().resolved(spark)
    time, date = F.col("PROCESSEDTIME"), F.col("processing_date")
    return read_enriched(spark, cfg.output_path, cfg.hold_path).select(
        *CALL, "leg", "network_operator_id",
        F.regexp_extract("INPUTFILENAME", r"^\d+_(MED\d\.\d+\.cdr)\.gz$", 1).alias("file_name"),
        time.between(begun.time(), ended.time()).alias("time_of_run"),
        date.between(begun.date(), ended.date()).alias("date_of_run"))


JOB_QUERIES = {
    "med_two_loads_same_day": q_med_two_loads_same_day,
    "same_name_two_hours": q_same_name_two_hours,
    "cross_load_dedup": q_cross_load_dedup,
    "file_log_all_repeats": q_file_log_all_repeats,
    "stream_then_batch": q_stream_then_batch,
    "hold_reprocess_twice_same_day": q_hold_reprocess_twice_same_day,
    "table_append_repeat": q_table_append_repeat,
    "med_job_files": q_med_job_files,
    "per_file_export": q_per_file_export,
    "parsed_csv_export": q_parsed_csv_export,
    "envelope_reordered_header": q_envelope_reordered_header,
    "ict_bad_records_held": q_ict_bad_records_held,
    "ict_two_loads_same_day": q_ict_two_loads_same_day,
    "overlapping_runs": q_overlapping_runs,
    "overlapping_runs_keys": q_overlapping_runs_keys,
    "overlapping_hold_runs": q_overlapping_hold_runs,
    "hold_master_difference": q_hold_master_difference,
    "ict_hold_job": q_ict_hold_job,
    "odd_lines_audit": q_odd_lines_audit,
    "stream_late_repeats": q_stream_late_repeats,
    "stream_batch_metrics": q_stream_batch_metrics,
    "ict_stream": q_ict_stream,
    "ict_cross_load_dedup": q_ict_cross_load_dedup,
    "compacted_stores": q_compacted_stores,
    "master_rejects": q_master_rejects,
    "table_replace": q_table_replace,
    "plain_csv_export": q_plain_csv_export,
    "named_files_open_clock": q_named_files_open_clock,
}
