"""Faults found in round 3: work that grew faster than the input."""

import gzip
import os
import tracemalloc
from unittest.mock import patch

import numpy as np
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from cdrmill import fixtures as fx
from cdrmill.llm.near_dup import idf_table, places, shingles
from cdrmill.functions.parse import parse_fixed_width
from cdrmill.operators.dedup import keep_first_counted
from cdrmill.operators.mapping import Clock
from cdrmill.plans import catalog
from cdrmill.plans.job_queries import write_extracts
from cdrmill.plans.jobs import JobConfig, MasterPaths, run_hold_reprocess, run_med
from cdrmill.session import OPEN_FILES, in_bytes
from cdrmill.sinks.keys import key_buckets
from cdrmill.sinks.maintenance import compact_output
from cdrmill.sinks.writers import (append_table, create_partitioned_table, read_enriched,
                                   write_enriched, write_partitioned)
from cdrmill.sources.envelope import envelope_positions, read_envelope_csv, split_fields
from cdrmill.sources.listing import (MANY_FILES, PACKED, WHOLE_FILE, InputFile, scan_groups,
                                     sized_scan)
from cdrmill.sources.text import read_lines_with_position
from cdrmill.streaming.incremental import IncrementalConfig, finished
from conftest import SF, cdr_line


def _extract(path, header, *lines):
    with open(path, "w") as f:
        f.write("\n".join(["HDR,x", header, *lines, "TRL,x", "EOF"]) + "\n")


def test_reordered_line_is_split_once(spark, tmp_path):
    _extract(tmp_path / "ICT1_20240701.csv", "EVENT_START_DATE,BNUM,ANUM", '20240701,"b,1",a1',
             "20240702,b2,a2", "20240703,b3")
    rows = read_envelope_csv(spark, str(tmp_path), ["ANUM", "BNUM", "EVENT_START_DATE"])
    assert {(r.ANUM, r.BNUM, r.EVENT_START_DATE, r.line_problem) for r in rows.collect()} == {
        ("a1", "b,1", "20240701", None), ("a2", "b2", "20240702", None),
        (None, "b3", "20240703", "ragged")}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    ordering = [line for line in plan.splitlines() if "transform(_order" in line]
    assert ordering and not any("split(" in line for line in ordering)


def test_fields_of_lines_with_and_without_quotes(spark):
    rows = spark.createDataFrame([("a,b,",), ('"a,b",c',), (',"x",,',), ("",)], "value string")
    got = [r.f for r in rows.select(split_fields(F.col("value")).alias("f")).collect()]
    assert got == [["a", "b", ""], ['"a,b"', "c"], ["", '"x"', "", ""], [""]]


def _file(length, name="a.cdr.gz"):
    return InputFile(f"/in/{name}", name, length)


def test_small_compressed_files_in_numbers_are_not_spread():
    several = [_file(10 << 20, f"{i}.cdr.gz") for i in range(MANY_FILES)]
    assert [fits for _, _, fits in scan_groups(several)] == [True]
    assert [fits for _, _, fits in scan_groups([_file(10 << 20)])] == [False]
    large = scan_groups([*several, _file(WHOLE_FILE + 1, "large.cdr.gz")])
    assert sorted((fits, len(paths)) for paths, _, fits in large) == [(False, 1), (True, len(several))]
    assert _file(100).text_bytes > 100 == _file(100, "a.cdr").text_bytes


def _job(tmp_path, **more):
    root = str(tmp_path)
    for kind, line in (("trunk", "ID|NAME|FK_NNOD|OPERATOR|POI\nTG1|t|ND1|OP1|POI1"),
                       ("node", "ID|NAME|FK_ORGA_FRAN\nND1|n|FR1")):
        os.makedirs(f"{root}/{kind}")
        with open(f"{root}/{kind}/m.csv", "w") as f:
            f.write(line + "\n")
    return JobConfig(f"{root}/in/*/*.cdr", MasterPaths(f"{root}/trunk/*.csv", f"{root}/node/*.csv",
                                                     snapshot_by=None),
                     f"{root}/out", f"{root}/hold", f"{root}/log", **more)


def _calls(tmp_path, hour, numbers):
    os.makedirs(f"{tmp_path}/in/{hour}")
    with open(f"{tmp_path}/in/{hour}/MED.20240701.cdr", "w") as f:
        f.writelines(cdr_line(anum=f"91{n}", bnum="92", event_start_date="20240701",
                              event_start_time="10000000", event_duration="00000100",
                              incoming_node="ND1", incoming_path="TG1") + "\n" for n in numbers)


def test_large_load_takes_more_tasks_than_the_store_has_buckets(spark, tmp_path, monkeypatch):
    """A store of few buckets, then a load that needs more tasks: repeats go all the same."""
    cfg = _job(tmp_path, keys_dir=f"{tmp_path}/keys", keys_buckets=2)
    _calls(tmp_path, "10", range(40))
    assert run_med(spark, cfg, Clock("2024-07-02 09:00:00", "2024-07-02")).metrics["matched"] == 40
    _calls(tmp_path, "11", range(30, 60))
    monkeypatch.setattr("cdrmill.plans.jobs.KEYED_TASK", 100)
    done = run_med(spark, cfg, Clock("2024-07-02 10:00:00", "2024-07-02")).metrics
    assert done["matched"] == 20
    assert done["shuffle_partitions"] == int(spark.conf.get("spark.sql.shuffle.partitions")) > 2


def test_large_first_load_lays_down_more_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("cdrmill.plans.jobs.partitions_for", lambda size, **how: 5)
    cfg = _job(tmp_path, keys_dir=f"{tmp_path}/keys", keys_buckets=2)
    _calls(tmp_path, "10", range(40))
    assert run_med(spark, cfg, Clock("2024-07-02 09:00:00", "2024-07-02")).metrics["matched"] == 40
    assert key_buckets(spark, cfg.keys_dir, 2) == 5


def test_output_rows_are_spread_before_they_are_mapped(spark, tmp_path):
    """42 columns need not cross the shuffle; compressed exports hold the same rows."""
    seen = []

    def written(df, *args, **how):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write_enriched(df, *args, **how)

    cfg = _job(tmp_path, plain_csv_path=f"{tmp_path}/plain", csv_compression="gzip")
    _calls(tmp_path, "10", range(40))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        with patch("cdrmill.plans.jobs.write_enriched", written):
            run_med(spark, cfg, Clock("2024-07-02 09:00:00", "2024-07-02"))
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    plan = seen[0].splitlines()
    at = next(i for i, line in enumerate(plan) if "RebalancePartitions" in line)
    assert any("SOURCETYPE" in line for line in plan[:at])
    assert not any("SOURCETYPE" in line for line in plan[at:])
    assert spark.read.csv(f"{tmp_path}/plain").count() == 40
    assert [f for f in os.listdir(f"{tmp_path}/plain") if f.endswith(".csv.gz")]


def test_extracts_in_parts_have_whole_envelopes(spark, tmp_path):
    lines = spark.createDataFrame([("ICT0.csv", 0, "HDR"), ("ICT0.csv", 1, "A,B"), ("ICT0.csv", 3, "T"),
                                   ("ICT0.csv", 4, "EOF"),
                                   *[("ICT0.csv", 2, f"{i},b") for i in range(50)]],
                                  "source string, section int, value string")
    write_extracts(lines, 3, f"{tmp_path}/x")
    files = [os.path.join(d, n) for d, _, names in os.walk(f"{tmp_path}/x") for n in names
             if n.endswith(".gz")]
    texts = [gzip.open(f, "rt").read().splitlines() for f in files]
    assert len(files) == 3
    assert all(t[:2] == ["HDR", "A,B"] and t[-2:] == ["T", "EOF"] for t in texts)
    assert sorted(x for t in texts for x in t[2:-2]) == sorted(f"{i},b" for i in range(50))


def test_legs_are_released_before_the_commit(spark, tmp_path):
    """A run that overlaps finds the executors' storage free, whatever the run before holds."""
    cfg = _job(tmp_path, keys_dir=f"{tmp_path}/keys")
    _calls(tmp_path, "10", range(40))
    held = []
    kept = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = kept()
    cfg.before_commit = lambda: held.append(kept() - before)
    run_med(spark, cfg, Clock("2024-07-02 09:00:00", "2024-07-02"))
    _calls(tmp_path, "11", range(40, 50))
    with open(f"{tmp_path}/in/11/MED.20240701.cdr", "a") as f:
        f.write(cdr_line(anum="9199", bnum="92", event_start_date="20240701",
                         event_start_time="10000000", event_duration="00000100",
                         incoming_node="ND1", incoming_path="TG9") + "\n")
    run_med(spark, cfg, Clock("2024-07-02 10:00:00", "2024-07-02"))
    with open(f"{tmp_path}/trunk/m.csv", "a") as f:
        f.write("TG9|t|ND1|OP1|POI1\n")
    assert run_hold_reprocess(spark, cfg, "MED", Clock("2024-07-03 09:00:00", "2024-07-03")
                              ).metrics == {"released": 1}
    assert held == [0, 0, 0]


def test_large_partitions_are_compacted_without_a_shuffle(spark, tmp_path, monkeypatch):
    cfg = _job(tmp_path)
    for hour in range(3):
        _calls(tmp_path, str(hour), range(hour * 10, hour * 10 + 10))
        run_med(spark, cfg, Clock("2024-07-02 09:00:00", "2024-07-02"))
    calls = lambda: sorted(tuple(r) for r in read_enriched(
        spark, cfg.output_path, cfg.hold_path).drop("load_id").collect())
    before = calls()
    monkeypatch.setattr("cdrmill.sinks.maintenance.LARGE_PARTITION", 1)
    with patch("cdrmill.sinks.maintenance.write_enriched") as shuffled:
        assert compact_output(spark, cfg.output_path, cfg.hold_path, "2024-07-04") == 3
    assert not shuffled.called
    assert len(before) == 30 and calls() == before
    ids = {r["load_id"] for r in read_enriched(spark, cfg.output_path, cfg.hold_path).collect()}
    assert len(ids) == 1 and next(iter(ids)).startswith("compact-output")


def test_the_driver_holds_little_beside_the_table_of_frequencies(spark):
    docs = spark.createDataFrame([("one two three four five six",), ("one two three four five",),
                                  (None,)], "text string").repartition(3)
    tracemalloc.start()
    table = idf_table(docs, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert table.dtype == np.float32 and len(table) == 3 << 20
    both, one = shingles("one two three four five")[0], shingles("two three four five six")[0]
    assert np.allclose(table[places(both, 2)], np.log(3 / 2) / np.log(3))
    assert np.allclose(table[places(one, 2)], 1) and (table < 1).sum() == 3
    assert peak < 2 * table.nbytes
    empty = idf_table(docs.where("text is null"))
    assert len(empty) == 1 << 20 and (empty == 1).all()


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def test_partitioned_writes_need_no_sort(spark, tmp_path):
    before, seen = spark.conf.get(WRITERS), []
    save, insert = DataFrameWriter.save, DataFrameWriter.insertInto

    def saved(self, *args, **more):
        seen.append(int(spark.conf.get(WRITERS)))
        return save(self, *args, **more)

    def inserted(self, *args, **more):
        seen.append(int(spark.conf.get(WRITERS)))
        return insert(self, *args, **more)

    n = 3 * OPEN_FILES  # more partitions than a task keeps open
    rows = spark.range(50 * n).select("id", (F.col("id") % n).cast("string").alias("original_date"))
    out, name = str(tmp_path / "out"), "unsorted_" + tmp_path.name.replace("-", "_")
    create_partitioned_table(spark, name, rows.schema, ["original_date"])
    with patch.object(DataFrameWriter, "save", saved), \
            patch.object(DataFrameWriter, "insertInto", inserted):
        write_partitioned(rows.coalesce(1), out, ["original_date"], load_id="a", rebalance=False)
        append_table(rows.coalesce(1), name)
    assert seen == [OPEN_FILES] * 2 and spark.conf.get(WRITERS) == before
    for back in (spark.read.parquet(out), spark.table(name)):
        assert back.count() == 50 * n == back.where(
            F.col("id") % n == F.col("original_date").cast("long")).count()


def test_compressed_files_are_packed_into_tasks_by_their_text(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    with sized_scan(spark, [_file(10 << 20)]):
        assert in_bytes(spark.conf.get(key)) == in_bytes(before) // PACKED
    with sized_scan(spark, [_file(10 << 20, "a.cdr")]):
        assert in_bytes(spark.conf.get(key)) == in_bytes(before)
    assert spark.conf.get(key) == before
    assert [in_bytes(s) for s in ("7", "1024b", "16m", "2GB")] == [7, 1024, 16 << 20, 2 << 30]


def test_lines_are_shaped_in_tasks_that_do_not_grow(spark):
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    with patch.object(fx, "ROWS_A_TASK", -(-rows // 24)):
        assert fx.cdr_lines(spark, SF).rdd.getNumPartitions() >= 23


def test_first_load_is_computed_once_for_matched_and_held_rows(spark):
    runs, run = [], catalog._med_run
    with patch.object(catalog, "_med_run", lambda *args: runs.append(run(*args)) or runs[-1]):
        got = catalog.q_backdated_partitions(spark, SF)
    assert len(runs) == 1 and not runs[0].legs.storageLevel.useMemory  # released again
    assert got.count() > 0


def test_extract_records_are_shaped_after_the_shuffle(spark, tmp_path):
    """The same lines as ``ict_envelope_lines``, from narrow rows."""
    rows = fx.ict_envelope_rows(spark, SF)
    got = rows.select("source", "section", fx.ict_line().alias("value"))
    want = fx.ict_envelope_lines(spark, SF)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    seen, write = [], DataFrameWriter.text

    def text(self, *args, **more):
        seen.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, *args, **more)

    with patch.object(DataFrameWriter, "text", text):
        write_extracts(rows, 2, f"{tmp_path}/x", line=fx.ict_line())
    above, below = seen[0].split("RepartitionByExpression", 1)
    assert "concat_ws" in above and "concat_ws" not in below and "Repartition" not in below
    back = spark.read.text(f"{tmp_path}/x").select("source", "value")
    envelopes = want.where("section <> 2")  # in each of two parts
    every = want.unionByName(envelopes).select("source", "value")
    assert back.count() == every.count() and back.exceptAll(every).isEmpty()


def test_large_loads_are_written_as_they_lie(spark, tmp_path, monkeypatch):
    """the rows of a large load cross no shuffle between the legs and the output."""
    seen = []

    def written(df, *args, **how):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write_enriched(df, *args, **how)

    monkeypatch.setattr("cdrmill.plans.jobs.LYING_ROWS", 5)
    monkeypatch.setattr("cdrmill.plans.jobs.write_enriched", written)
    cfg = _job(tmp_path)
    _calls(tmp_path, "10", range(40))
    run_med(spark, cfg, Clock("2024-07-02 09:00:00", "2024-07-02"))
    assert "Rebalance" not in seen[0] and "Repartition 8, false" in seen[0]
    rows = read_enriched(spark, cfg.output_path, cfg.hold_path)
    assert sorted(r.ANUM for r in rows.collect()) == sorted(f"91{n}" for n in range(40))


def test_fields_are_cut_from_lines_with_and_without_wide_characters(spark):
    """where every character is a byte, fields are cut from the bytes."""
    plain = cdr_line(incoming_node="ND1", anum=" 911 ", bnum="922", user_data_3="end")
    wide = cdr_line(incoming_node="Nä€1", anum=" 911 ", bnum="922", user_data_3="ü")
    rows = parse_fixed_width(spark.createDataFrame(
        [(plain,), (wide,), (plain[:94],), ("",), (None,)], "value string"))
    got = [(r.incoming_node, r.anum, r.bnum, r.user_data_3) for r in rows.collect()]
    assert got == [("ND1", "911", "922", "end"), ("Nä€1", "911", "922", "ü"),
                   ("ND1", "911", None, None), (None,) * 4, (None,) * 4]
    assert "as binary" in rows._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_counts_carry_no_content_into_the_sort(spark):
    """the duplicate check sorts the content of each record once."""
    rows = spark.createDataFrame([("f1", "a", "1"), ("f2", "a", "0"), ("f1", None, "2"),
                                  ("f2", None, "3"), ("f2", "", "4")],
                                 "file_name string, k string, v string")
    order = ["file_name", "v"]
    want = {("f1", "a", "1", None, None), ("f1", None, "2", None, None),
            ("f2", "", "4", None, None), ("f1", None, None, 2, 1), ("f2", None, None, 3, 2)}
    out = keep_first_counted(rows, ["k"], order)
    assert {tuple(r) for r in out.collect()} == want and out.count() == 5
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN NOT _counts" in plan[plan.index("Aggregate"):].split("\n", 1)[1]


def test_finished_extracts_are_found_without_a_sort(spark, tmp_path):
    """F16: extracts whose last line is the trailer's, also of files read in several splits."""
    os.makedirs(f"{tmp_path}/in")
    for name, last in (("a", "EOF"), ("b", "x,y"), ("c", "EOF,1")):
        with open(f"{tmp_path}/in/{name}.csv", "w") as f:
            f.write("EOF\n" + "r,1\n" * 200 + last + "\n")
    files = [InputFile(f"file:{tmp_path}/in/{n}.csv", f"{n}.csv", 800) for n in "abc"]
    cfg = IncrementalConfig(f"{tmp_path}/in", "", "", "")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in (before, "100"):
            spark.conf.set(key, size)
            assert [f.name for f in finished(spark, files, cfg)] == ["a.csv", "c.csv"]
    finally:
        spark.conf.set(key, before)


def test_only_header_lines_go_through_the_search_for_headers(spark, tmp_path):
    """text of records is left out before the rows are sorted by file."""
    _extract(tmp_path / "ICT1_20240701.csv", "ANUM,BNUM,EVENT_START_DATE", "a1,b1,20240701")
    lines = read_lines_with_position(spark, str(tmp_path))
    found = envelope_positions(lines)
    assert {(r._env, r.header) for r in found.collect()} == {
        (1, None), (2, "ANUM,BNUM,EVENT_START_DATE"), (-1, None), (-2, None)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "min(_h#" in plan
