"""ICT source: pre-mapped 42-column CSV records -> enriched and held rows.

Same shape as MED: duplicate check before the split, one trunk lookup per
leg row (broadcast, size checked), ids recomputed on the row's own leg.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrmill.functions.parse import hhmiss
from cdrmill.operators.dedup import (FILE_BLANKS, FILE_LINES, keep_first, keep_first_counted,
                                     own_key, without_counts)
from cdrmill.operators.lookup import Masters, lookup_trunk
from cdrmill.operators.mapping import Clock, map_ict
from cdrmill.operators.matching import ict_hold_reason, split_matched
from cdrmill.operators.split import ICT_INCOMING, ICT_OUTGOING, split_transit
from cdrmill.plans.med import drop_loaded, filled_keys, original_date
from cdrmill.sources.envelope import parse_csv_records
from cdrmill.schema import ENRICHED_COLUMNS, ICT_DEDUP_KEYS

# Winner of a duplicate group: lowest file name, then the raw record line.
ICT_DEDUP_ORDER = ["file_name", "value"]


def prepare_records(records: DataFrame, *extra: str) -> DataFrame:
    """Cleaned records (42 columns + ``file_name``) with the start time cut
    to HHMISS, which is also the form the duplicate check compares."""
    return records.select(*ENRICHED_COLUMNS, "file_name", *extra).withColumn(
        "EVENT_START_TIME", hhmiss(F.col("EVENT_START_TIME")))


def dedup_ict(records: DataFrame, counted: bool = False,
              loaded_keys: DataFrame | None = None) -> DataFrame:
    """Duplicate check on parsed envelope records (``value`` = the raw CSV
    line).  Only the four keys, the file name and the raw line cross the
    shuffle (Catalyst prunes the CSV parse to the keys before it); the
    winner's line is parsed again afterwards.

    Records with a ``line_problem`` go through it under a key of their own, as their
    keys may be in the wrong place.  ``counted`` adds a row of counts per file;
    ``loaded_keys`` drops calls that an earlier load kept."""
    sound = F.col("line_problem").isNull()
    first, *others = ICT_DEDUP_KEYS
    slim = records.withColumn("EVENT_START_TIME", hhmiss(F.col("EVENT_START_TIME"))).select(
        "value", "file_name", "line_problem",
        F.when(sound, F.col(first)).otherwise(own_key(F.concat_ws(":", "file_path", "line_id")))
        .alias(first), *[F.when(sound, F.col(k)).alias(k) for k in others])
    keep = keep_first_counted if counted else keep_first
    if loaded_keys is None:
        kept = keep(slim, ICT_DEDUP_KEYS, ICT_DEDUP_ORDER)
    else:
        kept = drop_loaded(keep(filled_keys(slim, ICT_DEDUP_KEYS), ICT_DEDUP_KEYS, ICT_DEDUP_ORDER),
                           loaded_keys, ICT_DEDUP_KEYS)
    extra = ["line_problem", *([FILE_LINES, FILE_BLANKS] if counted else [])]
    return prepare_records(parse_csv_records(kept.select("value", "file_name", *extra)), *extra)


def lookup_ict(legs: DataFrame, masters: Masters, clock: Clock,
               keep: Sequence[str] = ()) -> DataFrame:
    sound = F.col("line_problem").isNull() if "line_problem" in legs.columns else F.lit(True)
    looked = lookup_trunk(legs, masters.trunk,
                          F.when(sound, F.coalesce(F.col("INCOMING_PATH"), F.col("OUTGOING_PATH"))),
                          F.coalesce(F.col("INCOMING_NODE"), F.col("OUTGOING_NODE")),
                          flag=None)
    mapped = map_ict(looked, clock, keep)
    return mapped.withColumn("hold_reason", ict_hold_reason())


@dataclass
class IctOutput:
    legs: DataFrame      # every leg row with hold_reason and leg_index
    enriched: DataFrame  # matched rows, 42 columns + extras
    held: DataFrame      # held rows with hold_reason


def ict_legs(records: DataFrame, masters: Masters, clock: Clock = Clock(),
             date_mode: str = "regex", loaded_keys: DataFrame | None = None,
             counted: bool = False) -> DataFrame:
    """Every leg row with ``hold_reason`` and ``leg_index``.  Records with a
    ``line_problem`` take the same way as the others (one branch, so the extracts are
    read once), but neither the duplicate check nor the split touches them, and they
    are held with it as the reason.  ``counted`` carries a row of counts per file."""
    kept = dedup_ict(records, counted, loaded_keys).withColumns({
        "original_date": original_date("file_name", date_mode), "processing_date": clock.date()})
    legs = split_transit(kept, ICT_INCOMING, ICT_OUTGOING, index="leg_index", whole="line_problem")
    counts = [c for c in (FILE_LINES, FILE_BLANKS) if c in legs.columns]
    out = lookup_ict(legs, masters, clock, ["line_problem", *counts])
    return out.withColumn("hold_reason", F.coalesce("line_problem", "hold_reason")).drop("line_problem")


def finish_ict(legs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matched rows, held rows) of reasoned leg rows."""
    matched, held = split_matched(without_counts(legs))
    return matched.drop("leg_index"), held.drop("leg_index")


def enrich_ict(records: DataFrame, masters: Masters, clock: Clock = Clock(),
               date_mode: str = "regex", counted: bool = False) -> IctOutput:
    legs = ict_legs(records, masters, clock, date_mode, counted=counted)
    return IctOutput(legs, *finish_ict(legs))
