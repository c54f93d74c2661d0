"""MED source: fixed-width call records -> enriched leg rows and held rows.

Plan shape (one lazy plan): text scan -> anti-join with the processed-file
log (broadcast) -> fixed-width projection of the 13 used fields -> duplicate
check (one shuffle, partial aggregate first) -> transit split (explode, no
second scan) -> trunk lookup + node lookup (broadcast hash joins, sizes
checked) -> hold reason -> 42-column projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrmill.functions.parse import date_from_name, parse_fixed_width, parse_yyyymmdd
from cdrmill.operators.dedup import keep_first, keep_first_counted, without_counts
from cdrmill.operators.lookup import Masters, lookup_node, lookup_trunk
from cdrmill.operators.mapping import Clock, map_med
from cdrmill.operators.matching import med_hold_reason, split_matched
from cdrmill.operators.split import split_transit
from cdrmill.schema import CDR_USED, MED_DEDUP_KEYS

# Winner of a duplicate group: lowest file name, then sequence number; the
# remaining fields break any tie, so the choice never depends on row order.
MED_DEDUP_ORDER = ["file_name", "record_sequence_number"]

# Columns a held MED row keeps, enough to enrich it again later.
MED_HOLD_COLUMNS = CDR_USED + ["file_name", "original_date", "leg", "processing_date",
                               "hold_reason"]


def parse_records(lines: DataFrame) -> DataFrame:
    """``value, file_name`` lines -> the used fields + ``file_name``."""
    return parse_fixed_width(lines.select("value", "file_name"), keep=CDR_USED)


def dedup_records(records: DataFrame, counted: bool = False) -> DataFrame:
    """One record per call; ``counted`` adds a row of counts per input file."""
    keep = keep_first_counted if counted else keep_first
    return keep(records, MED_DEDUP_KEYS, MED_DEDUP_ORDER)


def original_date(name_col: str = "file_name", mode: str = "regex"):
    """Date from the file name, kept only when it is a real calendar date."""
    d = date_from_name(F.col(name_col), mode)
    return F.when(parse_yyyymmdd(d).isNotNull(), d)


def effective(a: str, b: str):
    return F.coalesce(F.col(a), F.col(b))


def lookup_legs(legs: DataFrame, masters: Masters) -> DataFrame:
    """Trunk and node lookups on each leg row's own side, plus the reason
    the row must be held (NULL when complete)."""
    looked = lookup_trunk(legs, masters.trunk, effective("incoming_path", "outgoing_path"),
                          effective("incoming_node", "outgoing_node"))
    looked = lookup_node(looked, masters.node, effective("incoming_node", "outgoing_node"))
    return looked.withColumn("hold_reason", med_hold_reason())


def drop_loaded(kept: DataFrame, loaded_keys: DataFrame,
                keys: Sequence[str] = MED_DEDUP_KEYS) -> DataFrame:
    """Remove calls whose duplicate-check key an earlier load already kept.

    A plain equi-join on the four key columns, in which blank parts are empty
    text (the store holds them so): ``kept`` is already hash partitioned on exactly
    those columns by the duplicate check, and the store is bucketed by them, so
    neither side is shuffled again where both have the same number of partitions.
    The rule is the one inside a load: blank key parts are equal, here as there."""
    return kept.join(loaded_keys.toDF(*keys), list(keys), "left_anti")


def filled_keys(df: DataFrame, keys: Sequence[str] = MED_DEDUP_KEYS) -> DataFrame:
    """Blank duplicate-check key parts as empty text (so that they compare equal)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in keys})


def blanked_keys(df: DataFrame, keys: Sequence[str] = MED_DEDUP_KEYS) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in keys})


def med_legs(records: DataFrame, masters: Masters, clock: Clock = Clock(),
             date_mode: str = "regex", loaded_keys: DataFrame | None = None,
             counted: bool = False) -> DataFrame:
    """De-duplicated, split, looked-up leg rows with ``hold_reason`` and
    ``leg_index`` (0 on the first leg row of each kept record).  With
    ``loaded_keys``, calls kept by an earlier load are dropped too.  ``counted``
    carries a row of counts per input file along (see ``file_audit``)."""
    if loaded_keys is None:
        kept = dedup_records(records, counted)
    else:
        kept = blanked_keys(drop_loaded(dedup_records(filled_keys(records), counted), loaded_keys))
    dated = kept.withColumns({"original_date": original_date("file_name", date_mode),
                              "processing_date": clock.date()})
    return lookup_legs(split_transit(dated, index="leg_index"), masters)


@dataclass
class MedOutput:
    records: DataFrame   # parsed records before the duplicate check
    legs: DataFrame      # every leg row with lookups and hold_reason
    enriched: DataFrame  # matched rows, 42 columns + extras
    held: DataFrame      # held rows, MED_HOLD_COLUMNS


def finish_med(legs: DataFrame, clock: Clock = Clock()) -> tuple[DataFrame, DataFrame]:
    """(enriched matched rows, held rows) of reasoned leg rows."""
    matched, held = split_matched(without_counts(legs))
    return map_med(matched, clock), held.select(*MED_HOLD_COLUMNS)


def enrich_med(lines: DataFrame, masters: Masters, clock: Clock = Clock(),
               date_mode: str = "regex", counted: bool = False) -> MedOutput:
    records = parse_records(lines)
    legs = med_legs(records, masters, clock, date_mode, counted=counted)
    enriched, held = finish_med(legs, clock)
    return MedOutput(records, legs, enriched, held)
