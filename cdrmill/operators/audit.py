"""Per-file input log counts and load totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrmill.operators.dedup import FILE_BLANKS, FILE_LINES


def file_audit(legs: DataFrame, keys: Sequence[str], name_col: str = "file_name",
               reason_col: str = "hold_reason", index_col: str = "leg_index",
               unchecked: Sequence[str] = ("ragged", "bad_header")) -> DataFrame:
    """One row per input file with records: records read, duplicates dropped, how many
    of those were merged under a key with a blank part, leg rows matched and held.

    ``legs`` come from a duplicate check that counted its input (``keep_first_counted``),
    so they carry a row of counts per file and one grouping is enough: the input is not
    read again.  Kept records are the leg rows with index 0 and the no-leg rows; those
    held for an ``unchecked`` reason never were in the check.
    """
    idx, reason, call = F.col(index_col), F.col(reason_col), F.col(FILE_LINES).isNull()
    kept = call & (idx.isNull() | (idx == 0))
    blank = F.lit(False)
    for k in keys:
        blank = blank | F.col(k).isNull()
    blank = blank & ~F.coalesce(reason.isin(list(unchecked)), F.lit(False))
    n = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = legs.groupBy(F.col(name_col).alias("filename")).agg(
        n(FILE_LINES).alias("n_records"), n(FILE_BLANKS).alias("blanks"),
        F.count_if(kept).alias("kept"), F.count_if(kept & blank).alias("blanks_kept"),
        F.count_if(call & reason.isNull()).alias("n_matched"),
        F.count_if(call & reason.isNotNull()).alias("n_held"))
    return out.select(
        "filename", "n_records", (F.col("n_records") - F.col("kept")).alias("n_duplicates"),
        (F.col("blanks") - F.col("blanks_kept")).alias("n_blank_merges"), "n_matched", "n_held")


def load_totals(audit: DataFrame) -> DataFrame:
    """One row of totals over a file audit."""
    return audit.agg(
        F.count(F.lit(1)).alias("n_files"),
        *[F.sum(c).alias(c) for c in ("n_records", "n_duplicates", "n_blank_merges", "n_matched",
                                      "n_held")])
