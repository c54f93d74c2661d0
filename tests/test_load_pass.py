"""Counts in the load's own pass, two scans of extracts, a bucketed keys store, broken masters."""
import os
import re

import pytest

from cdrmill.operators.audit import file_audit
from cdrmill.operators.dedup import FILE_LINES, keep_first, keep_first_counted, without_counts
from cdrmill.operators.lookup import Masters
from cdrmill.operators.mapping import FIXED_CLOCK
from cdrmill.plans.ict import enrich_ict, ict_legs
from cdrmill.plans.jobs import JobConfig, MasterPaths, run_med
from cdrmill.plans.med import drop_loaded, enrich_med, filled_keys, dedup_records, parse_records
from cdrmill.schema import ENRICHED_COLUMNS, ICT_DEDUP_KEYS, MED_DEDUP_KEYS
from cdrmill.sinks.keys import kept_keys, loaded_keys, write_keys
from cdrmill.sinks.commits import Commit, commit_load
from cdrmill.sources.envelope import read_envelope_csv
from cdrmill.sources.masters import MasterFormatError, read_master, read_rejects
from cdrmill.sources.text import read_lines
from conftest import NODE, TRUNK, cdr_line
from test_jobs import DAY1, _call, _masters, _write


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _small_masters(spark):
    return Masters.build(
        spark.createDataFrame(TRUNK, "ID string, NAME string, FK_NNOD string, OPERATOR string, POI string"),
        spark.createDataFrame(NODE, "ID string, NAME string, FK_ORGA_FRAN string"))


def test_counted_check_keeps_the_same_rows(spark):
    rows = [("k1", "a", "f1", "2"), ("k1", "a", "f2", "1"), (None, None, "f1", "3"), (None, None, "f1", "4"),
            ("", "b", "f2", "5"), ("k2", None, "f3", "6")]
    df = spark.createDataFrame(rows, "k string, k2 string, file_name string, v string")
    plain = keep_first(df, ["k", "k2"], ["file_name", "v"]).collect()
    counted = keep_first_counted(df, ["k", "k2"], ["file_name", "v"])
    assert sorted(map(str, without_counts(counted).collect())) == sorted(map(str, plain))
    counts = {r.file_name: (r.file_lines, r.file_blank_keys)
              for r in counted.where(f"{FILE_LINES} is not null").collect()}
    assert counts == {"f1": (3, 2), "f2": (2, 1), "f3": (1, 1)}


def test_audit_reads_the_input_once(spark, tmp_path):
    call = dict(incoming_node="ND1", incoming_path="TG1")
    _write(f"{tmp_path}/in/MED.20240701.cdr", "\n".join([
        _call("1", **call), _call("1", **call), _call("2", incoming_node="ND9", incoming_path="TG1"),
        _call("", bnum="", **call), _call("", bnum="", record_sequence_number="x", **call), "short"]) + "\n")
    legs = enrich_med(read_lines(spark, f"{tmp_path}/in/*.cdr"), _small_masters(spark), FIXED_CLOCK,
                      counted=True).legs
    audit = file_audit(legs, MED_DEDUP_KEYS)
    assert _plan(audit).count("FileScan text") == 1
    assert [tuple(r) for r in audit.collect()] == [("MED.20240701.cdr", 6, 2, 1, 2, 2)]


def test_extracts_are_scanned_twice_only(spark, tmp_path):
    rows = [",".join([f"N{i}"] + [""] * 41) for i in range(5)] + ["cut,off"]
    text = "\n".join(["HDR", ",".join(ENRICHED_COLUMNS), *rows, "TRL", "EOF"]) + "\n"
    _write(f"{tmp_path}/ict/ICT_20240701.csv", text)
    records = read_envelope_csv(spark, f"{tmp_path}/ict/*.csv")
    out = enrich_ict(records, _small_masters(spark), FIXED_CLOCK, counted=True)
    for df in (out.legs, out.held, file_audit(out.legs, ICT_DEDUP_KEYS, "INPUTFILENAME")):
        assert _plan(df).count("FileScan text") == 2
    assert [tuple(r) for r in file_audit(out.legs, ICT_DEDUP_KEYS, "INPUTFILENAME").collect()] == [
        ("ICT_20240701.csv", 6, 4, 4, 0, 2)]
    assert out.held.where("hold_reason = 'ragged'").count() == 1


def test_only_the_batch_moves_to_the_keys(spark, tmp_path):
    hold, keys = f"{tmp_path}/hold", f"{tmp_path}/keys"
    lines = lambda *n: spark.createDataFrame(
        [(_call(i, incoming_node="ND1", incoming_path="TG1"), "MED.20240701.cdr") for i in n],
        "value string, file_name string")
    first = dedup_records(filled_keys(parse_records(lines("1", "2", "")))).selectExpr("*", "0 AS leg_index")
    write_keys(kept_keys(first, MED_DEDUP_KEYS), keys, "one", 8)
    write_keys(kept_keys(first, MED_DEDUP_KEYS), keys, "not-committed", 8)
    commit_load(spark, hold, Commit("one"))
    store = loaded_keys(spark, keys, hold, None, 99)  # the layout laid down first stays
    assert store.count() == 3
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # 8 shuffle partitions in this session, as many as buckets
        kept = drop_loaded(dedup_records(filled_keys(parse_records(lines("2", "3", "")))), store)
        plan = _plan(kept)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert len(re.findall(r"Exchange hashpartitioning\(anum", plan)) == 1  # the duplicate check's own
    assert [r.anum for r in kept.collect()] == ["3"]


def test_broken_master_lines_are_set_aside(spark, tmp_path):
    head = "ID|NAME|FK_NNOD|OPERATOR|POI\n"
    good = "".join(f"TG{i}|n|ND1|OP|POI\n" for i in range(98))
    _write(f"{tmp_path}/t/Trunk_20240401.csv", head + good + "TG98|n\n |n|ND1|OP|POI\n\n")
    path, rejects = f"{tmp_path}/t/*.csv", f"{tmp_path}/rejects"
    rows = read_master(spark, path, rejects_path=rejects, max_broken=0.01)
    assert rows.count() == 99  # the line without a key is dropped, and counted, with the repeats
    assert {(r.kind, r.problem, r.line) for r in read_rejects(spark, rejects).collect()} == {
        ("trunk", "ragged", "TG98|n"), ("trunk", "blank_key", " |n|ND1|OP|POI")}
    assert Masters.build(rows, spark.createDataFrame([], "ID string, NAME string, FK_ORGA_FRAN string")
                         ).trunk_dropped == 1
    _write(f"{tmp_path}/t/Trunk_20240401.csv", head + good + "TG98|n\nx\n")
    with pytest.raises(MasterFormatError, match="2 of 100 lines"):
        read_master(spark, path, max_broken=0.01)


def test_table_is_replaced_and_plain_csv_written(spark, tmp_path):
    root = str(tmp_path)
    masters = _masters(root, [("TG1", "a", "ND1", "OP", "POI")], [("ND1", "n", "FR")], "20240401")
    cfg = JobConfig("", masters, f"{root}/out", f"{root}/hold", f"{root}/log", table="latest_rows",
                    table_replace=True, plain_csv_path=f"{root}/plain")
    for n in (1, 2):
        _write(f"{root}/in{n}/MED.2024070{n}.cdr", _call(str(n), incoming_node="ND1", incoming_path="TG1") + "\n")
        cfg.inputs = f"{root}/in{n}/*.cdr"
        run_med(spark, cfg, DAY1)
    assert [r.ANUM for r in spark.table("latest_rows").collect()] == ["2"]
    spark.sql("DROP TABLE latest_rows")
    lines = [line for f in os.listdir(f"{root}/plain") if f.startswith("part")
             for line in open(f"{root}/plain/{f}")]
    assert len(lines) == 1 and lines[0].count(",") == len(ENRICHED_COLUMNS) + 2
