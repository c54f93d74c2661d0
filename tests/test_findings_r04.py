"""Faults found in round 4: work left out or done more than once."""

import datetime
from unittest.mock import patch

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from cdrmill.operators.lookup import Masters
from cdrmill.plans import job_queries as jq
from cdrmill.plans import jobs
from cdrmill.plans.jobs import run_hold_reprocess, run_med
from cdrmill.sinks.commits import commit_list
from cdrmill.streaming.incremental import IncrementalConfig, run_med_incremental
from conftest import NODE, TRUNK, cdr_line


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A few calls of every kind, in the shape of the driver's tables."""
    d = str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(1995, 3, 1)
    lines = [(k, k % 44, 1 + k % 8, 1 + k % 6, float(k % 50), "NAR"[k % 3], "OF"[k % 2],
              day + datetime.timedelta(days=k % 90)) for k in range(400)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                          "l_quantity double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(s, f"S{s}", s % 3 + 14) for s in range(1, 9)],
                          "s_suppkey long, s_name string, s_nationkey int"
                          ).write.parquet(f"{d}/supplier.parquet")
    spark.createDataFrame([(n, f"N{n}", n % 5) for n in range(25)],
                          "n_nationkey int, n_name string, n_regionkey int"
                          ).write.parquet(f"{d}/nation.parquet")
    return d


def rows(df):
    return sorted(map(repr, df.collect()))


# the first hold run, over masters that had not changed, looked nothing up
def test_both_hold_runs_look_up_all_waiting_rows(spark, tables):
    cfgs, calls = [], jobs.reprocess_med_hold

    def run(spark, cfg, *how):
        cfgs.append(cfg)
        return run_hold_reprocess(spark, cfg, *how)

    with patch.object(jq, "run_hold_reprocess", run), \
            patch.object(jobs, "reprocess_med_hold", side_effect=calls) as looked_up:
        got = jq.q_hold_reprocess_twice_same_day(spark, tables)
    assert {c.args[1] is looked_up.call_args_list[0].args[1] for c in looked_up.call_args_list} \
        == {True, False}  # both masters
    load, first, second = commit_list(spark, cfgs[0].hold_path)
    assert (load.kind, first.kind, second.kind) == ("load", "hold", "hold")
    assert {i for i, _ in first.supersedes} == {load.load_id}
    assert {i for i, _ in second.supersedes} == {first.load_id}
    released = jobs.read_table(spark, cfgs[0])  # the table has them as well
    assert released.count() and {r["load_id"] for r in released.select("load_id").distinct().collect()
                                 } == {second.load_id}
    assert rows(got) == rows(jq.stored_calls(spark, cfgs[0]))


# a load that checks its calls against the store computed its legs three times
@pytest.mark.parametrize("run, inputs", [
    (run_med, lambda s, d: jq.write_hours(s, d)),
    (jobs.run_ict, lambda s, d: extract_hours(s, d))], ids=["med", "ict"])
def test_the_legs_of_a_keyed_load_stay_cached(spark, tables, run, inputs):
    root = inputs(spark, tables)
    cfg = jq.job_config(spark, tables, f"{root}/hour=10")
    cfg.keys_dir = cfg.output_path + "-keys"
    run(spark, cfg, jq.FIXED_CLOCK)
    legs, builders, insert = [], [], DataFrameWriter.insertInto
    counted = jobs._counted

    def at_count(df):
        out = counted(df)
        legs.append(df)
        builders.append(cached(df))
        return out

    def at_insert(writer, name, *args):
        if name.startswith("loaded_keys_"):
            builders.append(cached(legs[0]))
        return insert(writer, name, *args)

    with patch.object(jobs, "_counted", at_count), \
            patch.object(DataFrameWriter, "insertInto", at_insert):
        cfg.inputs = f"{root}/hour=*"
        assert run(spark, cfg, jq.FIXED_CLOCK).metrics["leg_rows"] > 0
    assert len(builders) == 2 and builders[0] == builders[1] is not None


# A hold run read its waiting rows again after it had written those held on
def test_the_rows_of_a_hold_run_stay_cached(spark, tables):
    cfg = jq.job_config(spark, tables, f"{jq.write_hours(spark, tables)}/hour=*")
    run_med(spark, cfg, jq.FIXED_CLOCK)
    cfg.masters = jq.masters_as_files(spark, tables, corrected=True)
    written, work, write = [], jobs.hold_work, jobs.write_hold
    held = []

    def kept(*args):
        held.append(work(*args))
        return held[0]

    def at_write(*args):
        out = write(*args)
        written.append(held[0])
        return out

    class Counting:  # actions on the held rows after the write to the hold store
        late = 0

    collect = type(spark.range(1)).collect

    def collected(df):
        Counting.late += bool(written) and df.columns == ["load_id", "hold_bucket"]
        return collect(df)

    with patch.object(jobs, "hold_work", kept), patch.object(jobs, "write_hold", at_write), \
            patch.object(type(spark.range(1)), "collect", collected):
        assert run_hold_reprocess(spark, cfg, "MED", jq.LATER).metrics["released"] > 0
    assert written and Counting.late == 0


# tasks of a load sorted and cached 256 MB of its input each
def test_a_load_is_shuffled_in_small_partitions(spark, tables):
    cfg = jq.job_config(spark, tables, f"{jq.write_hours(spark, tables)}/hour=*")
    asked, sized = [], jobs.sized_shuffle

    def shuffle(spark, size, *args, **how):
        asked.append(how.get("target_bytes"))
        return sized(spark, size, *args, **how)

    with patch.object(jobs, "sized_shuffle", shuffle):
        run_med(spark, cfg, jq.FIXED_CLOCK)
    assert asked == [64 << 20]


# the folders per input file shuffled their 42 columns
def test_the_per_file_folders_shuffle_narrow_legs(spark, tables):
    cfg = jq.job_config(spark, tables, f"{jq.write_hours(spark, tables)}/hour=*")
    cfg.per_file_path = cfg.output_path + "-per-file"
    seen, write = [], DataFrameWriter.save

    def save(writer, path=None, *args, **how):
        if path == cfg.per_file_path:
            seen.append(writer._df._jdf.queryExecution().optimizedPlan().toString().split("\n"))
        return write(writer, path, *args, **how)

    with patch.object(DataFrameWriter, "save", save):
        run_med(spark, cfg, jq.FIXED_CLOCK)
    plan, = seen
    at = [line for line in plan if "RebalancePartitions" in line]
    assert len(at) == 1 and "[file_name" in at[0]  # a column of the legs, not yet INPUTFILENAME
    back = spark.read.option("header", True).csv(cfg.per_file_path)
    done = jq.read_enriched(spark, cfg.output_path, cfg.hold_path)
    per_file = lambda df: rows(df.groupBy("INPUTFILENAME").count())
    assert per_file(back) == per_file(done)


# a stream's state lay in the executors' memory, with whole lines as keys
def test_the_state_of_a_stream_is_on_disk_and_narrow(spark, tmp_path):
    from cdrmill.streaming.incremental import PROVIDER, first_in_state
    lines = spark.readStream.format("rate").load().select(
        F.lit("x" * 418).alias("value"), F.lit("/a/file").alias("file_path"),
        F.lit("file").alias("file_name"))
    plan = first_in_state(lines, "2 days")._jdf.queryExecution().analyzed().toString()
    assert "sha2" in plan
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "MED0.20240701.cdr").write_text(cdr_line(anum="1", bnum="2") + "\n")
    cfg = IncrementalConfig(str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "hold"),
                            str(tmp_path / "ckpt"), repeats_within="2 days")
    before = spark.conf.get(PROVIDER)
    assert run_med_incremental(spark, cfg, masters_of(spark), clock=jq.FIXED_CLOCK) >= 1
    assert spark.conf.get(PROVIDER) == before
    assert "RocksDB" in (tmp_path / "ckpt" / "offsets" / "0").read_text()


def masters_of(spark):
    return Masters.build(spark.createDataFrame(TRUNK, "ID string, NAME string, FK_NNOD string, "
                                               "OPERATOR string, POI string"),
                         spark.createDataFrame(NODE, "ID string, NAME string, FK_ORGA_FRAN string"))


def extract_hours(spark, tables):
    root = jq.scratch_path(spark, "ict-hours")
    jq.write_extract_hours(spark, tables, root)
    return root


def cached(df):
    """Which buffers hold the rows of a persisted frame (None: they must be computed anew)."""
    jvm = df.sparkSession._jvm
    found = df.sparkSession._jsparkSession.sharedState().cacheManager().lookupCachedData(df._jdf)
    if not found.isDefined():
        return None
    builder = found.get().cachedRepresentation().cacheBuilder()
    return jvm.System.identityHashCode(builder) if builder.isCachedColumnBuffersLoaded() else None
