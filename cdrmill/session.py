"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a job of this engine expects; none of them is required for
# correctness.  AQE coalesces the small shuffles of tiny loads and splits
# skewed partitions of a big one.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "cdrmill",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    A session without one gets a private folder only when it runs in local
    mode (tests); on a cluster a machine-local folder would be wrong, so that
    case is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        sc = None
    d = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master if sc else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="cdrmill-ckpt-")
        if sc is None:
            try:
                spark.conf.set("spark.checkpoint.dir", d)
            except Exception:  # noqa: BLE001 - a core config may be read-only
                pass
    if sc is not None:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder (never reused)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/cdrmill-scratch/{name}-{uuid.uuid4().hex[:12]}"


def parallelism(spark: SparkSession) -> int:
    """Default task parallelism of the session (also under Spark Connect)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.default.parallelism",
                                  spark.conf.get("spark.sql.shuffle.partitions", "200")))


def partitions_for(input_bytes: int, shuffle_ratio: float = 0.5,
                   target_bytes: int = 256 << 20) -> int:
    """Shuffle partitions for ``shuffle_ratio`` of the input at ``target_bytes`` each."""
    return -(-int(input_bytes * shuffle_ratio) // target_bytes)


@contextmanager
def sized_shuffle(spark: SparkSession, input_bytes: int, on: bool = True,
                  shuffle_ratio: float = 0.5, target_bytes: int = 256 << 20,
                  exactly: int | None = None):
    """While a job runs, enough shuffle partitions for ``shuffle_ratio`` of its
    input at ``target_bytes`` each (never fewer than set), or ``exactly`` so many (to
    meet a bucketed table); yields their number and puts the session's setting back."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    want = max(int(before), partitions_for(input_bytes, shuffle_ratio, target_bytes)) if on \
        else int(before)
    want = exactly or want
    spark.conf.set(key, str(want))
    try:
        yield want
    finally:
        spark.conf.set(key, before)


@contextmanager
def setting(spark: SparkSession, key: str, value):
    """While a job runs, the session's ``key`` is ``value``; then it is put back."""
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def in_bytes(size: str) -> int:
    """A size setting (``134217728b``, ``16m``) in bytes."""
    n, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", size.strip().lower()).groups()
    return int(n) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


OPEN_FILES = 8  # partitions that a writing task keeps open


def unsorted_write(spark: SparkSession):
    """While a partitioned write runs, a task that meets few partitions keeps a file of each
    open and need not sort its rows by them, which spills where tasks are large.  Rows of
    further partitions are sorted by Spark as ever."""
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)
