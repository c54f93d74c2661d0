"""Transit split: one billing leg per side of a call.

A call seen on both an incoming and an outgoing trunk becomes two rows, an
``I`` leg and an ``O`` leg; on each leg row the other side's node, path and
product are NULL.  A call with one side stays one row; a call with no side
stays one row with ``leg`` NULL (it goes to hold later, nothing is lost).
Done with ``explode_outer`` over a two-element array, so the input is scanned
once (a union of two filtered copies would scan it twice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MED_INCOMING = ("incoming_node", "incoming_path", "incoming_product")
MED_OUTGOING = ("outgoing_node", "outgoing_path", "outgoing_product")
ICT_INCOMING = ("INCOMING_NODE", "INCOMING_PATH", "INCOMING_PRODUCT")
ICT_OUTGOING = ("OUTGOING_NODE", "OUTGOING_PATH", "OUTGOING_PRODUCT")


def side_present(node: str, path: str) -> Column:
    """A side exists when its node or its path is given."""
    return F.col(node).isNotNull() | F.col(path).isNotNull()


def split_transit(df: DataFrame, incoming: Sequence[str] = MED_INCOMING,
                  outgoing: Sequence[str] = MED_OUTGOING, leg: str = "leg",
                  index: str | None = None, whole: str | None = None) -> DataFrame:
    """``index`` (optional) numbers the leg rows of one record 0, 1 (NULL
    for the no-leg row), so a record can be counted once after the split.  Records
    with the column ``whole`` set are not split: one row without a leg."""
    apart = F.lit(True) if whole is None else F.col(whole).isNull()
    in_p = side_present(incoming[0], incoming[1]) & apart
    out_p = side_present(outgoing[0], outgoing[1]) & apart
    legs = F.filter(F.array(F.when(in_p, F.lit("I")), F.when(out_p, F.lit("O"))),
                    lambda x: x.isNotNull())
    if index:
        exploded = df.select("*", F.posexplode_outer(legs).alias(index, leg))
    else:
        exploded = df.withColumn(leg, F.explode_outer(legs))
    nulled = {c: F.when(F.col(leg) == "I", F.lit(None).cast("string")).otherwise(F.col(c))
              for c in outgoing}
    nulled.update({c: F.when(F.col(leg) == "O", F.lit(None).cast("string")).otherwise(F.col(c))
                   for c in incoming})
    return exploded.withColumns(nulled)
