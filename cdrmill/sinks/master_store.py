"""Master snapshots that held rows have met, and what changed since.

A hold reprocess can only change the rows whose master entries changed.  Each run
keeps the masters it used beside the hold store, under an id made of their content
(one copy however many runs use it), and names that id in its commit.  The next
reprocess compares snapshots row by row, in both directions, and takes the nodes
of the differing entries: the node is part of both lookup keys, and held rows lie
in buckets of their node.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrmill.operators.lookup import Masters
from cdrmill.sinks.commits import Commit, is_missing

HOLD_BUCKETS = 16  # a layout constant: rows lie in pmod(xxhash64(node), HOLD_BUCKETS)
SNAPSHOTS = "_masters"
KEPT = {"trunk": ["ID", "FK_NNOD", "OPERATOR", "POI"], "node": ["ID", "FK_ORGA_FRAN"]}
NODE_OF = {"trunk": "FK_NNOD", "node": "ID"}


def node_bucket(node: Column) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(HOLD_BUCKETS)).cast("int")


def snapshot_id(masters: Masters) -> str:
    """Hash of the masters' rows, whatever their order: equal content, equal id."""
    marks = []
    for kind, cols in KEPT.items():
        texts = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in cols]
        row = F.sha2(F.concat_ws("\x1f", *texts), 256)
        lane = [F.conv(F.substring(row, 1 + 15 * k, 15), 16, 10).cast("long") for k in range(2)]
        got = getattr(masters, kind).agg(F.count(F.lit(1)), F.bit_xor(lane[0]), F.bit_xor(lane[1]))
        marks += [str(v or 0) for v in got.first()]
    return "-".join(marks)


def snapshot_path(hold_path: str, snapshot: str, kind: str) -> str:
    return f"{hold_path.rstrip('/')}/{SNAPSHOTS}/{snapshot}/{kind}"


def keep_snapshot(spark: SparkSession, hold_path: str, masters: Masters) -> str:
    """Store the masters under their id, unless they are there; returns the id."""
    snapshot = snapshot_id(masters)
    for kind, cols in KEPT.items():
        if read_snapshot(spark, hold_path, snapshot, kind) is None:
            # the same rows whoever writes them, so runs that overlap may both write
            getattr(masters, kind).select(*cols).write.mode("overwrite").parquet(
                snapshot_path(hold_path, snapshot, kind))
    return snapshot


def read_snapshot(spark: SparkSession, hold_path: str, snapshot: str, kind: str) -> DataFrame | None:
    path = snapshot_path(hold_path, snapshot, kind)
    try:
        spark.read.text(f"{path}/_SUCCESS")  # a copy whose writer died doesn't count
        return spark.read.schema(", ".join(f"{c} string" for c in KEPT[kind])).parquet(path)
    except AnalysisException as e:
        if is_missing(e):
            return None
        raise


def changed_nodes(spark: SparkSession, hold_path: str, old: str, masters: Masters) -> DataFrame | None:
    """Nodes (``node``) of the entries that ``masters`` and the snapshot ``old`` do not
    share; None if ``old`` is not stored."""
    out = None
    for kind, cols in KEPT.items():
        before = read_snapshot(spark, hold_path, old, kind)
        if before is None:
            return None
        now = getattr(masters, kind).select(*cols)
        differing = now.exceptAll(before).unionByName(before.exceptAll(now))
        nodes = differing.select(F.col(NODE_OF[kind]).alias("node"))
        out = nodes if out is None else out.unionByName(nodes)
    return out.distinct()


def changed_buckets(spark: SparkSession, hold_path: str, old: str | None,
                    masters: Masters) -> list[int]:
    """Hold buckets whose rows may look up otherwise than with ``old`` (all of them
    where it is unknown)."""
    nodes = None if old is None else changed_nodes(spark, hold_path, old, masters)
    if nodes is None:
        return list(range(HOLD_BUCKETS))
    rows = nodes.select(node_bucket(F.col("node")).alias("b")).distinct().collect()
    return sorted(r["b"] for r in rows)


def met_snapshots(commits: list[Commit]) -> dict[str, str | None]:
    """Per load the snapshot that its waiting rows have met last: that of the latest
    hold run that knew the load, else its own."""
    holds = [c for c in commits if c.kind == "hold" and c.masters]
    out = {}
    for c in commits:
        later = [h for h in holds if h.version > c.version and h.seen >= c.version]
        out[c.load_id] = (later[-1] if later else c).masters
    return out
