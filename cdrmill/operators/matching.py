"""Matched / held partition of leg rows, with the reason a row is held."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def med_hold_reason(leg: str = "leg", trunk_hit: str = "trunk_hit",
                    node_hit: str = "node_hit", date: str = "original_date") -> Column:
    """NULL for a complete MED row, else ``+``-joined reasons:
    ``no_leg``, ``trunk``, ``node``, ``no_date`` (in that order)."""
    has_leg = F.col(leg).isNotNull()
    parts = [
        F.when(~has_leg, F.lit("no_leg")),
        F.when(has_leg & ~F.col(trunk_hit), F.lit("trunk")),
        F.when(has_leg & ~F.col(node_hit), F.lit("node")),
        F.when(F.col(date).isNull(), F.lit("no_date")),
    ]
    return F.nullif(F.concat_ws("+", *parts), F.lit(""))


def ict_hold_reason(leg: str = "leg", poi: str = "poi_id",
                    operator: str = "network_operator_id", date: str = "original_date") -> Column:
    """ICT rows match when the looked-up POI and OPERATOR are both present and
    the file name has a date."""
    has_leg = F.col(leg).isNotNull()
    parts = [
        F.when(~has_leg, F.lit("no_leg")),
        F.when(has_leg & (F.col(poi).isNull() | F.col(operator).isNull()), F.lit("trunk")),
        F.when(F.col(date).isNull(), F.lit("no_date")),
    ]
    return F.nullif(F.concat_ws("+", *parts), F.lit(""))


def split_matched(df: DataFrame, reason: str = "hold_reason") -> tuple[DataFrame, DataFrame]:
    """(matched rows without the reason column, held rows with it)."""
    matched = df.where(F.col(reason).isNull()).drop(reason)
    held = df.where(F.col(reason).isNotNull())
    return matched, held
