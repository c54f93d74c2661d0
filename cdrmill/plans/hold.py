"""Reprocessing of held rows once newer master data has arrived.

Held rows keep their original ``processing_date`` (back-dated loading: they
land in the partition of the day they first came in).  Rows that still miss
are held again under a new version; the folder being read is never
overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrmill.operators.lookup import Masters
from cdrmill.operators.mapping import Clock, map_med
from cdrmill.operators.matching import split_matched
from cdrmill.plans.ict import lookup_ict
from cdrmill.plans.med import MED_HOLD_COLUMNS, lookup_legs
from cdrmill.schema import ENRICHED_COLUMNS


def reprocess_med_hold(held: DataFrame, masters: Masters, clock: Clock = Clock(),
                       spread: bool = False) -> tuple[DataFrame, DataFrame]:
    """(enriched rows now complete, rows still held with a fresh reason).  ``spread``: the
    complete rows are rebalanced by date, before they become 42 columns."""
    base = held.select(*[c for c in MED_HOLD_COLUMNS if c != "hold_reason"])
    matched, still = split_matched(lookup_legs(base, masters))
    if spread:
        matched = matched.hint("rebalance", "original_date")
    return map_med(matched, clock), still.select(*MED_HOLD_COLUMNS)


def reprocess_ict_hold(held: DataFrame, masters: Masters,
                       clock: Clock = Clock()) -> tuple[DataFrame, DataFrame]:
    base = held.select(*ENRICHED_COLUMNS, F.col("INPUTFILENAME").alias("file_name"),
                       "original_date", "processing_date", "leg")
    matched, still = split_matched(lookup_ict(base, masters, clock))
    return matched, still
