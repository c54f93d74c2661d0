"""Record-level duplicate check with a deterministic winner.

A window ``row_number() over (partition by keys ...)`` would put every row of
a key into one task and sort it there; one hot key (say all records whose
keys are NULL) would then be a single straggler holding a third of the data.
We use an aggregate instead: the winner is the ``min`` of a struct whose
leading fields are the ordering columns.  Spark plans it as a partial
aggregate before the shuffle (map-side combine), so a hot key is already one
row per map task when it crosses the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys`` group: the smallest by ``order``, then by the
    remaining columns (so ties resolve the same way on every run).

    NULL keys form one group.  Within the ordering NULL sorts first.
    Output keeps the column order of ``df``.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in order if c in rest] + [c for c in rest if c not in order]
    winner = F.min(F.struct(*[F.col(c) for c in ordered])).alias("_winner")
    agg = df.groupBy(*keys).agg(winner)
    return agg.select(*[F.col(c) if c in keys else F.col("_winner")[c].alias(c)
                        for c in df.columns])


# Rows that must stay out of the check are put into it under a key of their own, in
# place of the first key column; no call's number begins like this.
OWN_KEY = "\x01own:"
FILE_LINES, FILE_BLANKS = "file_lines", "file_blank_keys"


def own_key(mark) -> Column:
    return F.concat(F.lit(OWN_KEY), mark)


def keep_first_counted(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                       name_col: str = "file_name") -> DataFrame:
    """``keep_first`` that also counts its input in the same pass: one more row per
    input file, with ``FILE_LINES`` (its rows) and ``FILE_BLANKS`` (those with a blank
    key part) set and all else but ``name_col`` NULL.  Both are NULL on other rows.

    The counts are rows, not accumulators: a task that runs again after an executor is
    lost is not counted twice.  Each row goes into the aggregate twice, once under its
    key and once, without its content, under its file; the latter are one row a file
    and task before the shuffle.
    """
    first, *others = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in order if c in rest] + [c for c in rest if c not in order]
    blank = F.lit(False)
    for k in keys:
        blank = blank | (F.coalesce(F.col(k), F.lit("")) == "")
    blank = blank & ~F.coalesce(F.startswith(F.col(first), F.lit(OWN_KEY)), F.lit(False))
    call = ~F.col("_counts")
    both = df.withColumn("_is_blank", blank).withColumn(
        "_counts", F.explode(F.array(F.lit(False), F.lit(True))))
    # the content is left out before the sort into groups, not in the aggregate
    slim = both.select(
        F.when(call, F.col(first)).otherwise(own_key(F.col(name_col))).alias(first),
        *[F.when(call, F.col(k)).alias(k) for k in others],
        *[c if c == name_col else F.when(call, F.col(c)).alias(c) for c in rest],
        "_counts", "_is_blank")
    agg = slim.groupBy(*keys).agg(
        F.min(F.when(call, F.struct(*[F.col(c) for c in ordered]))).alias("_winner"),
        F.max("_counts").alias("_counts"), F.max(F.when(~call, F.col(name_col))).alias("_file"),
        F.count(F.lit(1)).alias("_n"), F.count_if("_is_blank").alias("_blank"))
    counts = F.col("_counts")
    out = []
    for c in df.columns:
        if c in keys:
            out.append(F.when(~counts, F.col(c)).alias(c))
        elif c == name_col:
            out.append(F.coalesce("_file", F.col("_winner")[c]).alias(c))
        else:
            out.append(F.col("_winner")[c].alias(c))
    return agg.select(*out, F.when(counts, F.col("_n")).alias(FILE_LINES),
                      F.when(counts, F.col("_blank")).alias(FILE_BLANKS))


def without_counts(df: DataFrame) -> DataFrame:
    """The rows that are no file's counts."""
    return df.where(F.col(FILE_LINES).isNull()).drop(FILE_LINES, FILE_BLANKS) \
        if FILE_LINES in df.columns else df
