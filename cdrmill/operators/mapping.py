"""The 42-column billing-ready mapping, one ``select`` per source type."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdrmill import schema as S
from cdrmill.functions.parse import duration_seconds, hhmiss


@dataclass(frozen=True)
class Clock:
    """Processing time and run date.  ``None`` means the session clock;
    tests and oracles pass fixed values so results hash the same each run."""
    processed_time: str | None = None   # 'yyyy-MM-dd HH:mm:ss'
    processing_date: str | None = None  # 'yyyy-MM-dd'

    def time(self) -> Column:
        if self.processed_time is None:
            return F.current_timestamp()
        return F.to_timestamp(F.lit(self.processed_time))

    def date(self) -> Column:
        if self.processing_date is None:
            return F.current_date()
        return F.to_date(F.lit(self.processing_date))

    def resolved(self, spark) -> Clock:
        """Fix an open clock to 'now' in the session time zone, once, so
        every output of one load (and any retry of its stages) carries the
        same processing time and date."""
        if self.processed_time is not None and self.processing_date is not None:
            return self
        from datetime import datetime
        from zoneinfo import ZoneInfo
        tz = spark.conf.get("spark.sql.session.timeZone", "UTC")
        now = datetime.now(ZoneInfo(tz))
        return Clock(self.processed_time or now.strftime("%Y-%m-%d %H:%M:%S"),
                     self.processing_date or now.strftime("%Y-%m-%d"))


FIXED_CLOCK = Clock("2024-07-02 10:00:00", "2024-07-02")


def _direction(in_path: Column, out_path: Column, transit_first: bool) -> Column:
    """First match in the order I, O.  With ``transit_first`` a row that
    still carries both paths (not split) is ``T``."""
    d = F.when(in_path.isNotNull(), F.lit("I")).when(out_path.isNotNull(), F.lit("O"))
    if transit_first:
        d = F.when(in_path.isNotNull() & out_path.isNotNull(), F.lit("T")).otherwise(d)
    return d


def map_med(df: DataFrame, clock: Clock = Clock(), transit_first: bool = False) -> DataFrame:
    """Parsed leg rows with lookup results -> 42 MED columns + extras.

    Expects the parsed fields (lower case), ``file_name``, ``original_date``,
    ``leg``, ``t_poi``/``t_operator`` (trunk lookup of the row's own leg) and
    ``n_franchise`` (node lookup of the effective node).
    """
    c = F.col
    in_path, out_path = c("incoming_path"), c("outgoing_path")
    in_poi = F.when(c("leg") == "I", c("t_poi"))
    out_poi = F.when(c("leg") == "O", c("t_poi"))
    in_op = F.when(c("leg") == "I", c("t_operator"))
    out_op = F.when(c("leg") == "O", c("t_operator"))
    usage = duration_seconds(c("event_duration"))
    direction = _direction(in_path, out_path, transit_first)
    one, zero = F.lit(1), F.lit(0)
    cols = {
        "INCOMING_NODE": c("incoming_node"),
        "OUTGOING_NODE": c("outgoing_node"),
        "EVENT_START_DATE": c("event_start_date"),
        "EVENT_START_TIME": hhmiss(c("event_start_time")),
        "EVENT_DURATION": usage,
        "ANUM": c("anum"),
        "BNUM": c("bnum"),
        "INCOMING_PATH": in_path,
        "OUTGOING_PATH": out_path,
        "INCOMING_PRODUCT": c("incoming_product"),
        "OUTGOING_PRODUCT": c("outgoing_product"),
        "EVENT_DIRECTION": direction,
        "INCOMING_POI": in_poi,
        "OUTGOING_POI": out_poi,
        "INCOMING_OPERATOR": in_op,
        "OUTGOING_OPERATOR": out_op,
        "FRANCHISE": c("n_franchise"),
        "BILLING_OPERATOR": F.when(in_path.isNotNull(), in_op).otherwise(out_op),
        "BILLED_PRODUCT": F.coalesce(c("incoming_product"), c("outgoing_product")),
        "CALL_COUNT": one,
        "RATING_COMPONENT": F.lit(S.RATING_COMPONENT),
        "TIER": F.lit(S.TIER),
        "CURRENCY": F.lit(S.CURRENCY),
        "CASH_FLOW": F.when(in_path.isNotNull(), F.lit("R")).otherwise(F.lit("E")),
        "ACTUAL_USAGE": usage,
        "CHARGED_USAGE": usage,
        "CHARGED_UNITS": zero,
        "UNIT_COST_USED": zero,
        "AMOUNT": zero,
        "COMPONENT_DIRECTION": direction,
        "FLAT_RATE_CHARGE": zero,
        "PRODUCT_GROUP": F.lit(S.PRODUCT_GROUP),
        "START_CALL_COUNT": one,
        "service_type": F.lit(S.SERVICE_TYPE),
        "switch_id": F.coalesce(c("incoming_node"), c("outgoing_node")),
        "trunk_group_id": F.coalesce(in_path, out_path),
        "poi_id": F.when(in_path.isNotNull(), in_poi).otherwise(out_poi),
        "product_id": F.coalesce(c("incoming_product"), c("outgoing_product")),
        "network_operator_id": F.when(in_path.isNotNull(), in_op).otherwise(out_op),
        "INPUTFILENAME": c("file_name"),
        "PROCESSEDTIME": clock.time(),
        "SOURCETYPE": F.lit(S.SOURCE_MED),
    }
    extras = [c("original_date"),
              (c("processing_date") if "processing_date" in df.columns
               else clock.date()).alias("processing_date"),
              c("leg")]
    return df.select(*[v.alias(k) for k, v in cols.items()], *extras)


def map_ict(df: DataFrame, clock: Clock = Clock(), keep: Sequence[str] = ()) -> DataFrame:
    """Cleaned ICT leg rows (42 upper-case input columns, ``file_name``,
    ``leg``, ``t_poi``/``t_operator``) -> 42 ICT columns + extras.

    Most columns pass through; counts and usages become int; start time is
    cut to HHMISS; the ids are recomputed on the row's own leg.  Columns named in
    ``keep`` pass through as well.
    """
    c = F.col
    out: dict[str, Column] = {}
    for name in S.ENRICHED_COLUMNS:
        v = c(name)
        if name in S.INT_COLUMNS:
            v = v.try_cast("int")
        out[name] = v
    out.update({
        "EVENT_START_TIME": hhmiss(c("EVENT_START_TIME")),
        "service_type": F.lit(S.SERVICE_TYPE),
        "switch_id": F.coalesce(c("INCOMING_NODE"), c("OUTGOING_NODE")),
        "trunk_group_id": F.coalesce(c("INCOMING_PATH"), c("OUTGOING_PATH")),
        "poi_id": c("t_poi"),
        "product_id": F.coalesce(c("INCOMING_PRODUCT"), c("OUTGOING_PRODUCT")),
        "network_operator_id": c("t_operator"),
        "INPUTFILENAME": c("file_name"),
        "PROCESSEDTIME": clock.time(),
        "SOURCETYPE": F.lit(S.SOURCE_ICT),
    })
    extras = [c("original_date"),
              (c("processing_date") if "processing_date" in df.columns
               else clock.date()).alias("processing_date"),
              c("leg")]
    if "leg_index" in df.columns:
        extras.append(c("leg_index"))
    return df.select(*[v.alias(k) for k, v in out.items()], *extras, *keep)
