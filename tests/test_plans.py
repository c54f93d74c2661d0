"""Plan shape: the physical plans keep the properties the scale design
relies on (one shuffle for the duplicate check, broadcast lookups, one scan
of the input, no sort-merge join)."""

import os

from cdrmill import fixtures as fx
from cdrmill.operators.lookup import Masters
from cdrmill.operators.mapping import FIXED_CLOCK
from cdrmill.plans.ict import enrich_ict
from cdrmill.plans.med import enrich_med
from cdrmill.sources.envelope import read_envelope_csv
from cdrmill.sources.text import read_lines
from conftest import SF, cdr_line


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _masters(spark):
    return Masters.build(fx.trunk_master(spark, SF), fx.node_master(spark, SF))


def test_med_plan_one_key_shuffle_and_broadcast_lookups(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "MED.20240701.cdr").write_text(
        "".join(cdr_line(anum=str(i), bnum="2", incoming_node="ND01", incoming_path="TG000001") + "\n"
                for i in range(20)))
    plan = _plan(enrich_med(read_lines(spark, str(d / "*.cdr")), _masters(spark),
                            FIXED_CLOCK).enriched)
    assert plan.count("Exchange hashpartitioning(anum") == 1
    assert plan.count("FileScan text") == 1          # the split does not scan twice
    assert plan.count("BroadcastHashJoin") >= 2       # trunk and node lookups
    assert "SortMergeJoin" not in plan
    assert "partial_min(struct(file_name" in plan     # map-side combine before the shuffle


def test_ict_plan_envelope_broadcast_and_one_key_shuffle(spark, tmp_path):
    from cdrmill.schema import ENRICHED_COLUMNS
    rows = [",".join([f"N{i}"] + [""] * 41) for i in range(5)]
    text = "\n".join(["HDR", ",".join(ENRICHED_COLUMNS), *rows, "TRL", "EOF"]) + "\n"
    os.makedirs(tmp_path / "ict")
    (tmp_path / "ict" / "ICT_20240701.csv").write_text(text)
    recs = read_envelope_csv(spark, str(tmp_path / "ict" / "*.csv"))
    plan = _plan(enrich_ict(recs, _masters(spark), FIXED_CLOCK).enriched)
    assert plan.count("Exchange hashpartitioning(ANUM") == 1
    assert "BroadcastHashJoin [file_path" in plan     # envelope positions, broadcast
    assert "SortMergeJoin" not in plan
    # the duplicate check carries the raw line, not 42 parsed columns
    assert "partial_min(struct(file_name" in plan and "value" in plan
