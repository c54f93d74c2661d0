import os

from pyspark.sql import functions as F

from cdrmill.operators.mapping import Clock
from cdrmill.plans.jobs import JobConfig, MasterPaths, run_hold_reprocess, run_ict, run_med
from cdrmill.schema import ENRICHED_COLUMNS
from cdrmill.sinks.writers import current_hold, read_hold, read_partitioned
from conftest import cdr_line

DAY1 = Clock("2024-07-02 10:00:00", "2024-07-02")
DAY2 = Clock("2024-07-03 09:00:00", "2024-07-03")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _masters(root, trunk_rows, node_rows, date):
    _write(f"{root}/trunk/Trunk_Group_{date}.csv",
           "ID|NAME|FK_NNOD|OPERATOR|POI\n" + "".join("|".join(r) + "\n" for r in trunk_rows))
    _write(f"{root}/node/Network_Node_{date}.csv",
           "ID|NAME|FK_ORGA_FRAN\n" + "".join("|".join(r) + "\n" for r in node_rows))
    return MasterPaths(f"{root}/trunk/*.csv", f"{root}/node/*.csv")


def _call(anum, **kw):
    base = dict(anum=anum, bnum="92", event_start_date="20240701",
                event_start_time="10203000", event_duration="00000130")
    base.update(kw)
    return cdr_line(**base)


def test_med_job_rerun_hold_and_backdating(spark, tmp_path):
    root = str(tmp_path)
    masters = _masters(root, [("TG1", "a", "ND1", "OP1", "POI1")], [("ND1", "n", "FR1")], "20240401")
    # two hour folders; both files carry original date 20240701
    _write(f"{root}/in/10/MED.20240701100000.cdr", "\n".join([
        _call("1", incoming_node="ND1", incoming_path="TG1", outgoing_node="ND1",
              outgoing_path="TG1"),
        _call("2", incoming_node="ND1", incoming_path="TG2"),       # trunk unknown -> held
        _call("1", incoming_node="ND1", incoming_path="TG1", outgoing_node="ND1",
              outgoing_path="TG1", record_sequence_number="dup"),   # duplicate call
    ]) + "\n")
    _write(f"{root}/in/11/MED.20240701110000.cdr",
           _call("3", outgoing_node="ND1", outgoing_path="TG1") + "\n")
    cfg = JobConfig(f"{root}/in/*/*.cdr", masters, f"{root}/out", f"{root}/hold", f"{root}/log",
                    audit_path=f"{root}/audit")
    r1 = run_med(spark, cfg, DAY1)
    assert r1.metrics == {"leg_rows": 4, "matched": 3, "held": 1, "records": 4, "master_rows_dropped": 0,
                          "rows_per_sec": r1.metrics["rows_per_sec"], "shuffle_partitions": 8, "files": 2}
    out = read_partitioned(spark, f"{root}/out")
    assert out.count() == 3
    assert {r.INPUTFILENAME for r in out.collect()} == {"MED.20240701100000.cdr",
                                                       "MED.20240701110000.cdr"}  # both hours kept
    audit = {r.filename: r for r in spark.read.parquet(f"{root}/audit").collect()}
    assert audit["MED.20240701100000.cdr"].n_duplicates == 1

    # same files again: the log makes the second load add nothing
    r2 = run_med(spark, JobConfig(**{**cfg.__dict__, "load_id": "again"}), DAY1)
    assert r2.metrics["leg_rows"] == 0
    assert read_partitioned(spark, f"{root}/out").count() == 3

    # newer master knows TG2: the held row is released, back-dated to day 1
    masters2 = _masters(root, [("TG1", "a", "ND1", "OP1", "POI1"), ("TG2", "b", "ND1", "OP2", "POI2")],
                        [("ND1", "n", "FR1")], "20240501")
    cfg2 = JobConfig(**{**cfg.__dict__, "masters": masters2})
    r3 = run_hold_reprocess(spark, cfg2, "MED", DAY2)
    assert r3.metrics == {"released": 1}
    out = read_partitioned(spark, f"{root}/out")
    rel = out.where(F.col("ANUM") == "2").collect()
    assert len(rel) == 1 and str(rel[0].processing_date) == "2024-07-02"
    assert rel[0].poi_id == "POI2"
    # the hold folder was not rewritten; the reprocessed load is superseded
    assert current_hold(spark, f"{root}/hold").count() == 0
    assert read_hold(spark, f"{root}/hold").count() == 1  # the first load's leaf is still there
    # a load that died before its commit leaves a hold leaf nobody reads
    from cdrmill.sinks.writers import write_hold
    write_hold(read_hold(spark, f"{root}/hold").drop("load_id"), f"{root}/hold", "crashed")
    assert current_hold(spark, f"{root}/hold").count() == 0
    r4 = run_hold_reprocess(spark, JobConfig(**{**cfg2.__dict__, "load_id": "r4"}), "MED", DAY2)
    assert r4.metrics == {"released": 0}


def _envelope(name, rows):
    head = ",".join(ENRICHED_COLUMNS)
    return "\n".join([f"HDR,{name}", head, *rows, f"TRL,{name}", "EOF"]) + "\n"


def _ict_row(**kw):
    vals = {c: "" for c in ENRICHED_COLUMNS}
    vals.update(kw)
    return ",".join(vals[c] for c in ENRICHED_COLUMNS)


def test_ict_job(spark, tmp_path):
    root = str(tmp_path)
    masters = MasterPaths(f"{root}/trunk/*.csv", None)
    _write(f"{root}/trunk/Trunk_Group_20240401.csv",
           "ID|NAME|FK_NNOD|OPERATOR|POI\nTG1|a|ND1|OP1|POI1\n")
    rows = [
        _ict_row(INCOMING_NODE="ND1", INCOMING_PATH="TG1", OUTGOING_NODE="ND1", OUTGOING_PATH="TG1",
                 ANUM="1", BNUM="2", EVENT_START_DATE="20240701", EVENT_START_TIME="10203099",
                 CALL_COUNT="1"),
        _ict_row(INCOMING_NODE="ND1", INCOMING_PATH="TG9", ANUM="3", BNUM="2",
                 EVENT_START_DATE="20240701", EVENT_START_TIME="10203000"),
    ]
    _write(f"{root}/in/ICT_20240701.csv", _envelope("ICT_20240701.csv", rows))
    cfg = JobConfig(f"{root}/in/*.csv", masters, f"{root}/out", f"{root}/hold", f"{root}/log",
                    audit_path=f"{root}/audit", table="ict_processed",
                    per_file_path=f"{root}/per_file")
    r = run_ict(spark, cfg, DAY1)
    assert spark.table("ict_processed").count() == 2
    assert os.path.isdir(f"{root}/per_file/INPUTFILENAME=ICT_20240701.csv")
    spark.sql("DROP TABLE ict_processed")
    counts = {k: r.metrics[k] for k in ("leg_rows", "matched", "held", "records", "files", "bad_headers")}
    assert counts == {"leg_rows": 3, "matched": 2, "held": 1, "records": 2, "files": 1, "bad_headers": 0}
    out = read_partitioned(spark, f"{root}/out").collect()
    assert {x.leg for x in out} == {"I", "O"}
    assert all(x.poi_id == "POI1" and x.EVENT_START_TIME == "102030" and x.SOURCETYPE == "ICT"
               for x in out)
    assert read_hold(spark, f"{root}/hold").first().hold_reason == "trunk"
    a = spark.read.parquet(f"{root}/audit").first()
    assert (a.filename, a.n_records, a.n_duplicates, a.n_matched, a.n_held) == \
        ("ICT_20240701.csv", 2, 0, 2, 1)


def test_open_clock_is_fixed_once(spark):
    c = Clock().resolved(spark)
    assert c.processed_time and c.processing_date and c.resolved(spark) == c


def test_cli_med_job(spark, tmp_path):
    from cdrmill.__main__ import main
    root = str(tmp_path)
    _write(f"{root}/trunk/Trunk_Group_20240401.csv", "ID|NAME|FK_NNOD|OPERATOR|POI\nTG1|a|ND1|OP1|POI1\n")
    _write(f"{root}/node/Network_Node_20240401.csv", "ID|NAME|FK_ORGA_FRAN\nND1|n|FR1\n")
    _write(f"{root}/in/MED.20240701100000.cdr",
           _call("1", incoming_node="ND1", incoming_path="TG1") + "\n")
    out = main(["med", "--inputs", f"{root}/in/*.cdr", "--trunk", f"{root}/trunk/*.csv",
                "--node", f"{root}/node/*.csv", "--output", f"{root}/out", "--hold",
                f"{root}/hold", "--log", f"{root}/log", "--format", "csv",
                "--processing-date", "2024-07-02"])
    assert out["matched"] == 1 and out["held"] == 0
    assert os.path.isdir(f"{root}/out/original_date=20240701/processing_date=2024-07-02")


def test_incremental_drops_calls_loaded_by_earlier_batches(spark, tmp_path):
    from cdrmill.operators.lookup import Masters
    from cdrmill.streaming.incremental import IncrementalConfig, run_med_incremental
    root = str(tmp_path)
    call = dict(incoming_node="ND1", incoming_path="TG1")
    _write(f"{root}/in/B.20240702.cdr", _call("1", **call) + "\n" + _call("2", **call) + "\n")
    _write(f"{root}/in/A.20240703.cdr", _call("1", **call) + "\n" + _call("3", **call) + "\n")
    os.utime(f"{root}/in/B.20240702.cdr", (1_700_000_000, 1_700_000_000))  # B arrives first
    os.utime(f"{root}/in/A.20240703.cdr", (1_700_000_100, 1_700_000_100))
    trunk = spark.createDataFrame([("TG1", "a", "ND1", "OP", "P")],
                                  "ID string, NAME string, FK_NNOD string, OPERATOR string, POI string")
    node = spark.createDataFrame([("ND1", "n", "F")], "ID string, NAME string, FK_ORGA_FRAN string")
    cfg = IncrementalConfig(f"{root}/in", f"{root}/out", f"{root}/hold", f"{root}/ckpt",
                            max_files_per_trigger=1, keys_dir=f"{root}/keys")
    m = Masters.build(trunk, node)
    assert run_med_incremental(spark, cfg, m, clock=DAY1) == 2
    out = read_partitioned(spark, f"{root}/out")
    got = sorted((r.ANUM, r.INPUTFILENAME) for r in out.collect())
    assert got == [("1", "B.20240702.cdr"), ("2", "B.20240702.cdr"), ("3", "A.20240703.cdr")]
    assert run_med_incremental(spark, cfg, m, clock=DAY1) == 0  # nothing new


def test_batch_job_drops_calls_of_earlier_loads(spark, tmp_path):
    root = str(tmp_path)
    masters = _masters(root, [("TG1", "a", "ND1", "OP1", "POI1")], [("ND1", "n", "FR1")], "20240401")
    call = dict(incoming_node="ND1", incoming_path="TG1")
    _write(f"{root}/d1/MED.20240701.cdr", _call("1", **call) + "\n")
    _write(f"{root}/d2/MED.20240702.cdr", _call("1", **call) + "\n" + _call("5", **call) + "\n")
    base = dict(masters=masters, output_path=f"{root}/out", hold_path=f"{root}/hold",
                log_path=f"{root}/log", keys_dir=f"{root}/keys")
    run_med(spark, JobConfig(inputs=f"{root}/d1/*.cdr", **base), DAY1)
    r2 = run_med(spark, JobConfig(inputs=f"{root}/d2/*.cdr", **base), DAY2)
    assert r2.metrics["matched"] == 1
    got = sorted(r.ANUM for r in read_partitioned(spark, f"{root}/out").collect())
    assert got == ["1", "5"]
    # an earlier call is known however long ago it was loaded
    far = Clock("2024-09-30 10:00:00", "2024-09-30")
    _write(f"{root}/d3/MED.20240703.cdr", _call("1", **call) + "\n")
    r3 = run_med(spark, JobConfig(inputs=f"{root}/d3/*.cdr", **base), far)
    assert r3.metrics["matched"] == 0


def test_long_running_stream_reloads_masters(spark, tmp_path):
    from cdrmill.streaming.incremental import IncrementalConfig, start_med_stream
    root = str(tmp_path)
    masters = _masters(root, [("TG1", "a", "ND1", "OP1", "POI1")], [("ND1", "n", "FR1")], "20240401")
    call = dict(incoming_node="ND1", incoming_path="TG2")
    _write(f"{root}/in/M.20240701.cdr", _call("1", **call) + "\n")
    cfg = IncrementalConfig(f"{root}/in", f"{root}/out", f"{root}/hold", f"{root}/ckpt")
    q = start_med_stream(spark, cfg, masters, clock=DAY1, interval="1 second")
    try:
        q.processAllAvailable()
        assert current_hold(spark, f"{root}/hold").count() == 1  # TG2 unknown: held
        # a newer trunk snapshot arrives; the next file's batch uses it
        _masters(root, [("TG1", "a", "ND1", "OP1", "POI1"), ("TG2", "b", "ND1", "OP2", "POI2")],
                 [("ND1", "n", "FR1")], "20240501")
        _write(f"{root}/in/M.20240702.cdr", _call("2", **call) + "\n")
        q.processAllAvailable()
    finally:
        q.stop()
    out = read_partitioned(spark, f"{root}/out").collect()
    assert [(r.ANUM, r.poi_id) for r in out] == [("2", "POI2")]


def test_ict_hold_reprocess_job(spark, tmp_path):
    root = str(tmp_path)
    _write(f"{root}/trunk/Trunk_Group_20240401.csv", "ID|NAME|FK_NNOD|OPERATOR|POI\nTG1|a|ND1|OP1|POI1\n")
    rows = [_ict_row(INCOMING_NODE="ND1", INCOMING_PATH="TG9", ANUM="3", BNUM="2",
                     EVENT_START_DATE="20240701", EVENT_START_TIME="10203000")]
    _write(f"{root}/in/ICT_20240701.csv", _envelope("ICT_20240701.csv", rows))
    cfg = JobConfig(f"{root}/in/*.csv", MasterPaths(f"{root}/trunk/*.csv"), f"{root}/out",
                    f"{root}/hold", f"{root}/log")
    assert run_ict(spark, cfg, DAY1).metrics["held"] == 1
    _write(f"{root}/trunk/Trunk_Group_20240501.csv",
           "ID|NAME|FK_NNOD|OPERATOR|POI\nTG1|a|ND1|OP1|POI1\nTG9|b|ND1|OP9|POI9\n")
    r = run_hold_reprocess(spark, cfg, "ICT", DAY2)
    assert r.metrics == {"released": 1}
    out = read_partitioned(spark, f"{root}/out").collect()
    assert [(x.ANUM, x.poi_id, x.network_operator_id, str(x.processing_date)) for x in out] == \
        [("3", "POI9", "OP9", "2024-07-02")]
    assert current_hold(spark, f"{root}/hold").count() == 0


def test_gzip_input_is_rebalanced_and_loads(spark, tmp_path):
    import gzip
    from cdrmill.sources.text import read_lines, spread_if_unsplittable
    root = str(tmp_path)
    masters = _masters(root, [("TG1", "a", "ND1", "OP1", "POI1")], [("ND1", "n", "FR1")], "20240401")
    os.makedirs(f"{root}/in")
    with gzip.open(f"{root}/in/MED.20240701.cdr.gz", "wt") as f:
        f.write("".join(_call(str(i), incoming_node="ND1", incoming_path="TG1") + "\n"
                        for i in range(50)))
    scan = read_lines(spark, f"{root}/in/*.gz")
    plan = spread_if_unsplittable(scan)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    cfg = JobConfig(f"{root}/in/*.gz", masters, f"{root}/out", f"{root}/hold", f"{root}/log")
    assert run_med(spark, cfg, DAY1).metrics["matched"] == 50
    assert read_partitioned(spark, f"{root}/out").first().INPUTFILENAME == "MED.20240701.cdr.gz"


def test_shuffle_partitions_sized_for_the_job_only(spark):
    from cdrmill.session import sized_shuffle
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    with sized_shuffle(spark, 1500, shuffle_ratio=1.0, target_bytes=100) as n:
        assert n == 15 and spark.conf.get(key) == "15"
    assert spark.conf.get(key) == old
    with sized_shuffle(spark, 10, shuffle_ratio=1.0, target_bytes=100) as n:
        assert n == int(old)  # never fewer than set


def test_final_hold_rows_are_not_reprocessed(spark, tmp_path):
    root = str(tmp_path)
    masters = _masters(root, [("TG1", "a", "ND1", "OP1", "POI1")], [("ND1", "n", "FR1")], "20240401")
    _write(f"{root}/in/MED.20240701.cdr",
           _call("1", incoming_node="ND1", incoming_path="TG2") + "\n" + _call("2") + "\n")
    cfg = JobConfig(f"{root}/in/*.cdr", masters, f"{root}/out", f"{root}/hold", f"{root}/log")
    assert run_med(spark, cfg, DAY1).metrics["held"] == 2
    classes = {(r.anum, r.hold_class) for r in current_hold(spark, f"{root}/hold").collect()}
    assert classes == {("1", "lookup"), ("2", "final")}
    masters2 = _masters(root, [("TG1", "a", "ND1", "OP1", "POI1"), ("TG2", "b", "ND1", "OP2", "POI2")],
                        [("ND1", "n", "FR1")], "20240501")
    r = run_hold_reprocess(spark, JobConfig(**{**cfg.__dict__, "masters": masters2}), "MED", DAY2)
    assert r.metrics == {"released": 1}
    left = [(x.anum, x.hold_reason) for x in current_hold(spark, f"{root}/hold").collect()]
    assert left == [("2", "no_leg")]  # still held, written once, never re-read
    assert current_hold(spark, f"{root}/hold", "lookup").count() == 0


def test_cli_ict_and_hold(spark, tmp_path):
    from cdrmill.__main__ import main
    root = str(tmp_path)
    _write(f"{root}/trunk/Trunk_Group_20240401.csv", "ID|NAME|FK_NNOD|OPERATOR|POI\nTG1|a|ND1|OP1|POI1\n")
    rows = [_ict_row(INCOMING_NODE="ND1", INCOMING_PATH="TG1", ANUM="1", BNUM="2",
                     EVENT_START_DATE="20240701", EVENT_START_TIME="10203000"),
            _ict_row(INCOMING_NODE="ND1", INCOMING_PATH="TG9", ANUM="3", BNUM="2",
                     EVENT_START_DATE="20240701", EVENT_START_TIME="10203000")]
    _write(f"{root}/in/ICT_20240701.csv", _envelope("ICT_20240701.csv", rows))
    common = ["--trunk", f"{root}/trunk/*.csv", "--output", f"{root}/out", "--hold",
              f"{root}/hold", "--log", f"{root}/log", "--processing-date", "2024-07-02"]
    out = main(["ict", "--inputs", f"{root}/in/*.csv", *common])
    assert (out["matched"], out["held"], out["files"], out["bad_headers"]) == (1, 1, 1, 0)
    _write(f"{root}/trunk/Trunk_Group_20240501.csv",
           "ID|NAME|FK_NNOD|OPERATOR|POI\nTG1|a|ND1|OP1|POI1\nTG9|b|ND1|OP9|POI9\n")
    out = main(["hold", "--source", "ICT", *common[:-1], "2024-07-03"])
    assert out["released"] == 1
