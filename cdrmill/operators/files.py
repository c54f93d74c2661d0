"""Input-file level duplicate check: skip files already in the log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrmill.operators.lookup import broadcast_limit, measure


def new_files(lines: DataFrame, log: DataFrame, name_col: str = "file_name",
              log_col: str = "filename") -> DataFrame:
    """Rows of ``lines`` whose file is not in ``log``.

    A left anti-join (a NULL name is kept, unlike ``~isin``).  When the log
    is small it is broadcast.  A big log is first cut down to the names of
    this batch (distinct names are a partial aggregate, one row per file and
    map task), and that list, bounded by the batch's file count, is broadcast
    to the lines, which are not shuffled.  Only when even this batch's
    names exceed the limit do the lines shuffle by name; AQE's skew-join
    handling then splits a huge file's partition over several tasks.
    """
    seen = log.select(F.col(log_col).alias("_seen")).where(F.col("_seen").isNotNull())
    limit = broadcast_limit(lines.sparkSession)
    if measure(seen)[1] > limit:
        batch = lines.select(F.col(name_col).alias("_seen")).distinct()
        seen = batch.join(seen, "_seen", "left_semi")
        if measure(seen)[1] > limit:
            return lines.join(seen, F.col(name_col) == F.col("_seen"), "left_anti")
    return lines.join(F.broadcast(seen.distinct()), F.col(name_col) == F.col("_seen"),
                      "left_anti")
