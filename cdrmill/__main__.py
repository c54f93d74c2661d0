"""Command line: ``python -m cdrmill {med,ict,hold,parse,stream,upkeep} ...`` (or spark-submit it).

Examples::

    python -m cdrmill med --inputs 'hdfs:///cdr/med/*/*.cdr' \\
        --trunk 'hdfs:///cdr/trunk/*.csv' --node 'hdfs:///cdr/network/*.csv' \\
        --output hdfs:///cdr/out --hold hdfs:///cdr/hold --log hdfs:///cdr/log \\
        --audit hdfs:///cdr/audit --format csv
    python -m cdrmill hold --source MED ...same paths...
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if not __package__:  # run as a file (spark-submit cdrmill/__main__.py): find the package
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cdrmill.operators.mapping import Clock  # noqa: E402
from cdrmill.plans.jobs import (JobConfig, MasterPaths, run_hold_reprocess,  # noqa: E402
                                run_ict, run_med, run_parse)
from cdrmill.session import get_session  # noqa: E402
from cdrmill.sinks.maintenance import clean_up, compact_hold, compact_output  # noqa: E402
from cdrmill.streaming.incremental import (IncrementalConfig, run_ict_incremental,  # noqa: E402
                                           run_med_incremental)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cdrmill")
    p.add_argument("job", choices=["med", "ict", "hold", "parse", "stream", "upkeep"],
                   help="stream: load what has arrived in --inputs since the last call; "
                        "upkeep: compact small loads and remove dead leaves")
    p.add_argument("--inputs", nargs="+", default=[], help="input files or globs")
    p.add_argument("--trunk", help="trunk group master file(s) or glob (all but parse)")
    p.add_argument("--node", help="network node master file(s) or glob (MED)")
    p.add_argument("--master-sep", default="|")
    p.add_argument("--snapshot-by", default="name_date", choices=["name_date", "folder", "all"])
    p.add_argument("--output", required=True)
    p.add_argument("--hold", help="hold store (all but parse)")
    p.add_argument("--log", help="processed-file log (all but parse)")
    p.add_argument("--keys", help="also drop calls that earlier loads kept")
    p.add_argument("--keys-buckets", type=int, default=32, help="of a new keys store")
    p.add_argument("--rejects", help="broken master lines go here")
    p.add_argument("--max-broken", type=float, default=0.01,
                   help="share of broken lines from which a master is refused")
    p.add_argument("--metrics", help="stream only: a row per micro-batch goes here")
    p.add_argument("--repeats-within", help="stream only, e.g. '2 days': drop repeats by its state")
    p.add_argument("--grace-days", type=float, default=7.0, help="upkeep only")
    p.add_argument("--checkpoint", help="stream only: its checkpoint folder")
    p.add_argument("--hold-after", action="store_true", help="then reprocess the held rows")
    p.add_argument("--audit")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--null-token")
    p.add_argument("--time-format", default="yyyy-MM-dd HH:mm:ss")
    p.add_argument("--date-mode", default="regex", choices=["regex", "split"])
    p.add_argument("--table", help="also append into this partitioned table")
    p.add_argument("--table-replace", action="store_true", help="the table holds the last run's rows")
    p.add_argument("--plain-csv", help="also write one CSV folder without header and partitions")
    p.add_argument("--per-file", help="also write one CSV folder per input file")
    p.add_argument("--source", default="MED", choices=["MED", "ICT"], help="hold and stream jobs only")
    p.add_argument("--load-id", help="first part of the run's id")
    p.add_argument("--processing-date", help="yyyy-MM-dd (default: today)")
    p.add_argument("--master", help="Spark master URL (default: from spark-submit)")
    return p


def main(argv: list[str] | None = None) -> dict:
    parser = _parser()
    a = parser.parse_args(argv)
    needed = {"parse": ["inputs"], "upkeep": ["hold"]}.get(a.job, ["trunk", "hold"] + (
        ["inputs", "checkpoint"] if a.job == "stream" else []) + (
        [] if a.repeats_within else ["log"]))
    if lacking := [f"--{n}" for n in needed if not getattr(a, n)]:
        parser.error(f"{a.job} needs {', '.join(lacking)}")
    spark = get_session(a.master)
    if a.job == "parse":
        out = {"job": a.job, "records": run_parse(spark, a.inputs, a.output,
                                                  null_token=a.null_token)}
        print(json.dumps(out))
        return out
    if a.job == "upkeep":
        date = a.processing_date or "upkeep"
        out = {"job": a.job, "output_loads": compact_output(spark, a.output, a.hold, date),
               "hold_loads": compact_hold(spark, a.hold, date),
               "leaves_removed": clean_up(spark, a.hold, a.output, a.grace_days * 86_400)}
        print(json.dumps(out))
        return out
    masters = MasterPaths(a.trunk, a.node, a.master_sep,
                          None if a.snapshot_by == "all" else a.snapshot_by,
                          a.max_broken, a.rejects)
    cfg = JobConfig(a.inputs, masters, a.output, a.hold, a.log, a.audit, a.format,
                    a.null_token, a.time_format, a.date_mode, load_id=a.load_id,
                    table=a.table, table_replace=a.table_replace, plain_csv_path=a.plain_csv,
                    per_file_path=a.per_file, keys_dir=a.keys, keys_buckets=a.keys_buckets,
                    hold_after=a.hold_after)
    clock = Clock(None, a.processing_date)
    if a.job == "stream":
        inc = IncrementalConfig(a.inputs[0], a.output, a.hold, a.checkpoint, name=a.source.lower(),
                                keys_dir=a.keys, log_path=a.log, date_mode=a.date_mode,
                                audit_path=a.audit, table=a.table, per_file_path=a.per_file,
                                metrics_path=a.metrics, repeats_within=a.repeats_within)
        run = run_med_incremental if a.source == "MED" else run_ict_incremental
        out = {"job": a.job, "batches": run(spark, inc, masters, clock=clock)}
        print(json.dumps(out))
        return out
    if a.job == "med":
        r = run_med(spark, cfg, clock)
    elif a.job == "ict":
        r = run_ict(spark, cfg, clock)
    else:
        r = run_hold_reprocess(spark, cfg, a.source, clock)
    out = {"job": a.job, "load_id": r.load_id, "seconds": round(r.seconds, 3), **r.metrics}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
