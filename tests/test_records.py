from pyspark.sql import functions as F

from cdrmill.operators.dedup import keep_first
from cdrmill.operators.lookup import Masters, lookup_trunk, unique_master
from cdrmill.operators.mapping import FIXED_CLOCK
from cdrmill.operators.split import split_transit
from cdrmill.plans.med import MED_HOLD_COLUMNS, dedup_records, enrich_med, parse_records
from conftest import NODE, TRUNK, cdr_line

LEG_COLS = ("incoming_node string, incoming_path string, incoming_product string, "
            "outgoing_node string, outgoing_path string, outgoing_product string, id int")


def test_transit_split_counts_and_nulling(spark):
    rows = [("N1", "P1", "X1", "N2", "P2", "X2", 1), ("N1", "P1", None, None, None, None, 2),
            (None, None, None, "N2", "P2", None, 3), (None, None, None, None, None, None, 4)]
    legs = split_transit(spark.createDataFrame(rows, LEG_COLS)).collect()
    by_id = {}
    for r in legs:
        by_id.setdefault(r["id"], []).append(r)
    assert [len(by_id[i]) for i in (1, 2, 3, 4)] == [2, 1, 1, 1]
    i_leg = [r for r in by_id[1] if r["leg"] == "I"][0]
    o_leg = [r for r in by_id[1] if r["leg"] == "O"][0]
    assert i_leg["outgoing_node"] is None and i_leg["outgoing_path"] is None
    assert i_leg["outgoing_product"] is None and i_leg["incoming_node"] == "N1"
    assert o_leg["incoming_node"] is None and o_leg["outgoing_path"] == "P2"
    assert by_id[2][0]["leg"] == "I" and by_id[3][0]["leg"] == "O"
    assert by_id[4][0]["leg"] is None


def test_dedup_lower_file_name_wins_and_null_keys_group(spark):
    rows = [("b.cdr", "k1", "s2"), ("a.cdr", "k1", "s9"), ("a.cdr", "k1", "s1"),
            ("c.cdr", None, "s1"), ("d.cdr", None, "s0")]
    df = spark.createDataFrame(rows, "file_name string, key string, seq string")
    got = {(r["key"], r["file_name"], r["seq"]) for r in
           keep_first(df, ["key"], ["file_name", "seq"]).collect()}
    assert got == {("k1", "a.cdr", "s1"), (None, "c.cdr", "s1")}


def test_same_call_twice_in_file_and_across_files(spark):
    call = dict(anum="911", bnum="922", event_start_date="20240701", event_start_time="10000000",
                incoming_node="ND1", incoming_path="TG1")
    rows = [(cdr_line(record_sequence_number="2", **call), "B.20240701.cdr"),
            (cdr_line(record_sequence_number="1", **call), "B.20240701.cdr"),
            (cdr_line(record_sequence_number="0", **call), "C.20240701.cdr")]
    kept = dedup_records(parse_records(spark.createDataFrame(rows, "value string, file_name string")))
    r = kept.collect()
    assert len(r) == 1 and r[0]["file_name"] == "B.20240701.cdr"
    assert r[0]["record_sequence_number"] == "1"


def _masters(spark, trunk=TRUNK, node=NODE):
    return Masters.build(spark.createDataFrame(trunk, "ID string, NAME string, FK_NNOD string, "
                                                      "OPERATOR string, POI string"),
                         spark.createDataFrame(node, "ID string, NAME string, FK_ORGA_FRAN string"))


def test_padded_key_matches_and_repeated_master_key_keeps_count(spark):
    trunk = TRUNK + [("TG1", "t1-dup", "ND1", "OPZ", "POIZ"), ("  TG2 ", "t2", "ND2 ", "OPB", "POIB")]
    m = _masters(spark, trunk)
    assert unique_master(spark.createDataFrame(trunk, "ID string, NAME string, FK_NNOD string, "
                                                      "OPERATOR string, POI string"),
                         ["ID", "FK_NNOD"]).count() == 3  # untrimmed: the padded TG2 is a key of its own
    assert m.trunk.count() == 2
    assert m.trunk_dropped == 2  # the repeated TG1 key and the padded TG2 copy
    calls = spark.createDataFrame([("TG1", "ND1"), ("TG2", "ND2"), ("TG9", "ND1")],
                                  "path string, node string")
    got = lookup_trunk(calls, m.trunk, F.col("path"), F.col("node")).collect()
    assert len(got) == 3
    hit = {r["path"]: (r["t_poi"], r["trunk_hit"]) for r in got}
    assert hit["TG1"] == ("POIA", True) and hit["TG9"] == (None, False)


def test_padded_key_in_line_unpadded_in_master(spark):
    line = cdr_line(incoming_node="ND1", incoming_path="TG1", anum="1", bnum="2",
                    event_start_date="20240701", event_start_time="10000000",
                    event_duration="00000130")
    df = spark.createDataFrame([(line, "MED.20240701.cdr")], "value string, file_name string")
    out = enrich_med(df, _masters(spark), FIXED_CLOCK)
    r = out.enriched.collect()
    assert len(r) == 1 and r[0]["INCOMING_POI"] == "POIA" and r[0]["FRANCHISE"] == "FR1"
    assert r[0]["EVENT_DURATION"] == 90 and r[0]["CASH_FLOW"] == "R"
    assert r[0]["EVENT_DIRECTION"] == "I" and r[0]["SOURCETYPE"] == "MED"


def test_hold_reasons(spark):
    base = dict(bnum="2", event_start_date="20240701", event_start_time="10000000")
    rows = [
        (cdr_line(anum="1", incoming_node="ND1", incoming_path="TG9", **base), "M.20240701.cdr"),
        (cdr_line(anum="2", incoming_node="ND7", incoming_path="TG1", **base), "M.20240701.cdr"),
        (cdr_line(anum="3", outgoing_node="ND7", outgoing_path="TG9", **base), "M.20240701.cdr"),
        (cdr_line(anum="4", **base), "M.20240701.cdr"),
        (cdr_line(anum="5", incoming_node="ND1", incoming_path="TG1", **base), "nodate.cdr"),
        (cdr_line(anum="6", incoming_node="ND1", incoming_path="TG1", **base), "M.20240701.cdr"),
    ]
    df = spark.createDataFrame(rows, "value string, file_name string")
    trunk = TRUNK + [("TG1", "t7", "ND7", "OPC", "POIC")]  # trunk known on an unknown node
    out = enrich_med(df, _masters(spark, trunk), FIXED_CLOCK)
    reasons = {r["anum"]: r["hold_reason"] for r in out.held.collect()}
    assert reasons == {"1": "trunk", "2": "node", "3": "trunk+node", "4": "no_leg",
                       "5": "no_date"}
    assert [r["ANUM"] for r in out.enriched.collect()] == ["6"]
    assert out.held.columns == MED_HOLD_COLUMNS


def test_records_in_equal_duplicates_plus_kept_and_legs_partition(spark):
    from cdrmill import fixtures as fx
    from conftest import SF
    lines = fx.cdr_lines(spark, SF)
    m = Masters.build(fx.trunk_master(spark, SF), fx.node_master(spark, SF))
    out = enrich_med(lines, m, FIXED_CLOCK)
    n_in, n_kept = out.records.count(), dedup_records(out.records).count()
    legs = out.legs
    assert n_in == lines.count() and n_kept < n_in
    assert legs.count() == out.enriched.count() + out.held.count()
    # every kept record appears as one or two leg rows; no leg row is lost
    assert legs.select("anum", "bnum", "event_start_date", "event_start_time").distinct().count() \
        == n_kept
