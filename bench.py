"""Headline timings: runs the main registered queries at ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON
line.  Each query is fully executed into Spark's ``noop`` sink (every row
produced, nothing collected)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cdrmill.plans.catalog import QUERIES  # noqa: E402
from cdrmill.session import get_session  # noqa: E402

HEADLINE = ["fixed_width_parse", "record_dedup", "transit_split", "med_enriched",
            "hold_reprocess", "file_audit", "ict_enriched", "incremental_load"]


def run(spark, name, sf_dir):
    spark.catalog.clearCache()  # no cached data carried from one query to the next
    t = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - t


def run_job(spark, sf_dir):
    """The MED job over real files: text scan, log, dated master files,
    enriched CSV by date, hold, audit, log append."""
    from cdrmill import fixtures as fx
    from cdrmill.operators.mapping import FIXED_CLOCK
    from cdrmill.plans.catalog import write_cdr_files
    from cdrmill.plans.jobs import JobConfig, MasterPaths, run_med
    from cdrmill.session import scratch_path
    inputs = write_cdr_files(spark, sf_dir)
    m = scratch_path(spark, "bench-masters")
    fx.trunk_master(spark, sf_dir).write.option("header", True).option("sep", "|").csv(f"{m}/trunk")
    fx.node_master(spark, sf_dir).write.option("header", True).option("sep", "|").csv(f"{m}/node")
    out = scratch_path(spark, "bench-job")
    cfg = JobConfig(inputs, MasterPaths(f"{m}/trunk/*.csv", f"{m}/node/*.csv", snapshot_by=None),
                    f"{out}/enriched", f"{out}/hold", f"{out}/log", f"{out}/audit",
                    output_format="csv", source_col="source")
    t = time.time()
    r = run_med(spark, cfg, FIXED_CLOCK)
    return time.time() - t, r.metrics


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="cdrmill-bench",
                        shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        run(spark, "med_enriched", warm)  # JIT warm-up, not timed
    times = {n: round(run(spark, n, sf_dir), 3) for n in names}
    job_metrics = None
    if not sys.argv[1:]:
        secs, job_metrics = run_job(spark, sf_dir)
        times["med_job_files"] = round(secs, 3)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf, "cpus": int(cpus),
        "med_records_per_sec": round(lines / times["med_enriched"]) if "med_enriched" in times
        else None,
        "med_job": job_metrics,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
