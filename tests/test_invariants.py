"""Invariants of SURVEY §5 and a randomized parse check."""

import random

from cdrmill import fixtures as fx
from cdrmill.functions.parse import parse_fixed_width
from cdrmill.operators.lookup import Masters
from cdrmill.operators.mapping import FIXED_CLOCK
from cdrmill.plans.hold import reprocess_med_hold
from cdrmill.plans.med import enrich_med
from cdrmill.schema import CDR_FIELDS_AND_WIDTHS
from cdrmill.sources.text import read_lines
from conftest import SF, cdr_line

KEY = ["INPUTFILENAME", "ANUM", "BNUM", "EVENT_START_DATE", "EVENT_START_TIME", "leg"]


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_holding_then_fixing_equals_right_master_first(spark):
    lines = fx.cdr_lines(spark, SF)
    wrong = Masters.build(fx.trunk_master(spark, SF), fx.node_master(spark, SF))
    right = Masters.build(fx.corrected_trunk_master(spark, SF),
                          fx.corrected_node_master(spark, SF))
    first = enrich_med(lines, wrong, FIXED_CLOCK)
    released, still = reprocess_med_hold(first.held, right, FIXED_CLOCK)
    direct = enrich_med(lines, right, FIXED_CLOCK)
    cols = [c for c in direct.enriched.columns if c != "PROCESSEDTIME"]
    assert _rows(first.enriched.unionByName(released), cols) == _rows(direct.enriched, cols)
    # what stays held is exactly what the right master cannot match either
    assert _rows(still, ["anum", "hold_reason"]) == _rows(direct.held, ["anum", "hold_reason"])
    assert {r[0] for r in still.select("hold_reason").distinct().collect()} == {"no_leg"}


def test_digits_only_in_directory_give_no_date(spark, tmp_path):
    d = tmp_path / "20240701"
    d.mkdir()
    (d / "calls.cdr").write_text(cdr_line(anum="1", bnum="2", incoming_node="ND1",
                                          incoming_path="TG1") + "\n")
    lines = read_lines(spark, str(d / "*.cdr"))
    trunk = spark.createDataFrame([("TG1", "a", "ND1", "OP", "P")],
                                  "ID string, NAME string, FK_NNOD string, OPERATOR string, POI string")
    node = spark.createDataFrame([("ND1", "n", "F")], "ID string, NAME string, FK_ORGA_FRAN string")
    out = enrich_med(lines, Masters.build(trunk, node), FIXED_CLOCK)
    held = out.held.collect()
    assert out.enriched.count() == 0 and held[0].hold_reason == "no_date"
    assert held[0].file_name == "calls.cdr"


def test_random_lines_parse_like_plain_slicing(spark):
    rnd = random.Random(42)
    alphabet = "AB 12-_.#"
    lines = []
    for _ in range(300):
        fields = {n: "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, w)))
                  for n, w in CDR_FIELDS_AND_WIDTHS}
        line = cdr_line(**fields)
        lines.append(line[: rnd.choice([418, 418, rnd.randint(0, 418)])])
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [tuple(r) for r in parse_fixed_width(df).collect()]
    want = []
    for x in lines:
        pos, row = 0, []
        for _, w in CDR_FIELDS_AND_WIDTHS:
            v = x[pos:pos + w].strip(" ")
            row.append(v or None)
            pos += w
        want.append(tuple(row))
    assert got == want


def test_keep_first_matches_brute_force(spark):
    from cdrmill.operators.dedup import keep_first
    rnd = random.Random(7)
    pick = lambda xs: rnd.choice(xs)
    rows = [(pick(["a", "b", None]), pick(["x", None]), pick(["f1", "f2", "f3", None]),
             pick(["1", "2", None]), pick(["p", "q", None])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k1 string, k2 string, file string, seq string, v string")
    got = {tuple(r) for r in keep_first(df, ["k1", "k2"], ["file", "seq"]).collect()}

    def order(r):  # NULL first, then value; by file, seq, then the remaining column
        return tuple((x is not None, x or "") for x in (r[2], r[3], r[4]))
    want = {}
    for r in rows:
        k = (r[0], r[1])
        if k not in want or order(r) < order(want[k]):
            want[k] = r
    assert got == set(want.values())


def test_split_matches_brute_force(spark):
    from cdrmill.operators.split import split_transit
    rnd = random.Random(11)
    pick = lambda: rnd.choice(["N", None])
    rows = [(i, pick(), pick(), pick(), pick(), pick(), pick()) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, incoming_node string, incoming_path string, "
                                     "incoming_product string, outgoing_node string, "
                                     "outgoing_path string, outgoing_product string")
    got = sorted((r.id, r.leg, r.incoming_node, r.incoming_path, r.incoming_product,
                  r.outgoing_node, r.outgoing_path, r.outgoing_product)
                 for r in split_transit(df).collect())
    want = []
    for i, inn, inp, inr, on, op, orr in rows:
        has_in, has_out = inn is not None or inp is not None, on is not None or op is not None
        if has_in:
            want.append((i, "I", inn, inp, inr, None, None, None))
        if has_out:
            want.append((i, "O", None, None, None, on, op, orr))
        if not has_in and not has_out:
            want.append((i, None, inn, inp, inr, on, op, orr))
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_med_flow_matches_python_model_on_random_rows(spark):
    import re
    from datetime import datetime
    rnd = random.Random(5)
    ch = rnd.choice
    nodes, paths = ["ND1", "ND2", "ND3", ""], ["TG1", "TG2", "TG3", ""]
    lines = []
    for i in range(400):
        f = dict(anum=ch(["1", "2", "3", ""]), bnum=ch(["7", "8"]),
                 event_start_date=ch(["20240701", "20240702"]), event_start_time="10000000",
                 event_duration=ch(["00000130", "0000ZZ00", ""]),
                 incoming_node=ch(nodes), incoming_path=ch(paths),
                 outgoing_node=ch(nodes), outgoing_path=ch(paths),
                 incoming_product=ch(["MA", ""]), outgoing_product=ch(["MB", ""]),
                 record_sequence_number=str(rnd.randint(0, 5)))
        lines.append((cdr_line(**f), ch(["A.20240701.cdr", "B.20240702.cdr", "C.nodate.cdr",
                                         "D.20241399.cdr"])))
    trunk = [("TG1", "t", "ND1", "OP1", "P1"), ("TG1", "s", "ND1", "OP9", "P9"),
             ("TG2", "t", "ND2", "OP2", "P2"), ("TG3", "t", "ND1", "OP3", "P3")]
    node = [("ND1", "n", "F1"), ("ND2", "n", "F2")]
    df = spark.createDataFrame(lines, "value string, file_name string")
    m = Masters.build(spark.createDataFrame(trunk, "ID string, NAME string, FK_NNOD string, "
                                                   "OPERATOR string, POI string"),
                      spark.createDataFrame(node, "ID string, NAME string, FK_ORGA_FRAN string"))
    out = enrich_med(df, m, FIXED_CLOCK)
    cols = ["INPUTFILENAME", "ANUM", "BNUM", "EVENT_START_DATE", "leg", "INCOMING_POI",
            "OUTGOING_POI", "FRANCHISE", "BILLING_OPERATOR", "poi_id", "network_operator_id",
            "EVENT_DURATION", "original_date"]
    got = [tuple(r) for r in out.enriched.select(*cols).collect()]
    got_held = [(r.file_name, r.anum, r.leg, r.hold_reason) for r in out.held.collect()]

    # ---- plain Python model
    recs = []
    for value, fname in lines:
        pos, r = 0, {}
        for n, w in CDR_FIELDS_AND_WIDTHS:
            r[n] = value[pos:pos + w].strip() or None
            pos += w
        r["file_name"] = fname
        recs.append(r)
    used = ["incoming_node", "outgoing_node", "event_duration", "incoming_path", "outgoing_path",
            "incoming_product", "outgoing_product", "event_direction"]
    nf = lambda x: (x is not None, x or "")  # noqa: E731  NULL first
    best = {}
    for r in recs:
        k = (r["anum"], r["bnum"], r["event_start_date"], r["event_start_time"])
        o = tuple(nf(r[c]) for c in ["file_name", "record_sequence_number"] + used)
        if k not in best or o < best[k][0]:
            best[k] = (o, r)
    tm = {}
    for t in trunk:
        if (t[0], t[2]) not in tm or (t[1], t[3], t[4]) < tm[(t[0], t[2])][0]:
            tm[(t[0], t[2])] = ((t[1], t[3], t[4]), t)
    nm = {n[0]: n[2] for n in node}

    def odate(fname):
        mt = re.search(r"\d{8}", fname)
        if not mt:
            return None
        try:
            datetime.strptime(mt.group(0), "%Y%m%d")
            return mt.group(0)
        except ValueError:
            return None

    def secs(d):
        if d is None or not (d[:4].isdigit() and d[4:6].isdigit() and d[6:8].isdigit()):
            return None
        return int(d[:4]) * 3600 + int(d[4:6]) * 60 + int(d[6:8])

    want, want_held = [], []
    for _, r in best.values():
        has_in = r["incoming_node"] is not None or r["incoming_path"] is not None
        has_out = r["outgoing_node"] is not None or r["outgoing_path"] is not None
        legs = ([("I", r["incoming_node"], r["incoming_path"])] if has_in else []) + \
               ([("O", r["outgoing_node"], r["outgoing_path"])] if has_out else [])
        od = odate(r["file_name"])
        for leg, nd, pth in legs or [(None, None, None)]:
            t = tm.get((pth, nd))
            fr = nm.get(nd)
            reasons = ([] if leg else ["no_leg"]) + (["trunk"] if leg and not t else []) + \
                      (["node"] if leg and fr is None else []) + ([] if od else ["no_date"])
            if reasons:
                want_held.append((r["file_name"], r["anum"], leg, "+".join(reasons)))
                continue
            poi, op = t[1][4], t[1][3]
            want.append((r["file_name"], r["anum"], r["bnum"], r["event_start_date"], leg,
                         poi if leg == "I" else None, poi if leg == "O" else None, fr,
                         op, poi, op, secs(r["event_duration"]), od))
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sorted(got_held, key=key) == sorted(want_held, key=key)
