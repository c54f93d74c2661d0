"""Record layouts, column lists and Spark schemas of the mediation engine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    start: int  # 1-based, as Spark's substring expects
    width: int


def _layout(names_widths: list[tuple[str, int]]) -> tuple[Field, ...]:
    out, pos = [], 1
    for name, width in names_widths:
        out.append(Field(name, pos, width))
        pos += width
    return tuple(out)


# --- fixed values: call record line, field names and widths in file order ---
# (21 fields, 418 characters; these must equal the switch output format)
CDR_FIELDS_AND_WIDTHS = [
    ("incoming_node", 20),
    ("outgoing_node", 20),
    ("event_start_date", 8),
    ("event_start_time", 8),
    ("event_duration", 10),
    ("anum", 28),
    ("bnum", 28),
    ("incoming_path", 20),
    ("outgoing_path", 20),
    ("incoming_product", 14),
    ("outgoing_product", 14),
    ("event_direction", 1),
    ("discrete_rating_parameter_1", 15),
    ("data_unit", 8),
    ("record_sequence_number", 40),
    ("record_type", 2),
    ("user_summarisation", 20),
    ("user_data", 30),
    ("user_data_2", 30),
    ("link_field", 2),
    ("user_data_3", 80),
]
# --- end of fixed values ---

CDR_LAYOUT: tuple[Field, ...] = _layout(CDR_FIELDS_AND_WIDTHS)
CDR_LINE_WIDTH = sum(w for _, w in CDR_FIELDS_AND_WIDTHS)
CDR_COLUMNS = [f.name for f in CDR_LAYOUT]

# The nine trailing fields no output column uses (pruned after parsing).
CDR_UNUSED = CDR_COLUMNS[12:]
CDR_USED = CDR_COLUMNS[:12] + ["record_sequence_number"]

# Record-level duplicate check keys (same call seen twice).
MED_DEDUP_KEYS = ["anum", "bnum", "event_start_date", "event_start_time"]
ICT_DEDUP_KEYS = ["ANUM", "BNUM", "EVENT_START_DATE", "EVENT_START_TIME"]

# --- fixed values: master file headers ---
TRUNK_COLUMNS = ["ID", "NAME", "FK_NNOD", "OPERATOR", "POI"]
NODE_COLUMNS = ["ID", "NAME", "FK_ORGA_FRAN"]
# --- end of fixed values ---

TRUNK_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in TRUNK_COLUMNS])
NODE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in NODE_COLUMNS])

# --- fixed values: the 42 billing-ready output columns, in output order ---
ENRICHED_COLUMNS = [
    "INCOMING_NODE", "OUTGOING_NODE", "EVENT_START_DATE", "EVENT_START_TIME",
    "EVENT_DURATION", "ANUM", "BNUM", "INCOMING_PATH", "OUTGOING_PATH",
    "INCOMING_PRODUCT", "OUTGOING_PRODUCT", "EVENT_DIRECTION", "INCOMING_POI",
    "OUTGOING_POI", "INCOMING_OPERATOR", "OUTGOING_OPERATOR", "FRANCHISE",
    "BILLING_OPERATOR", "BILLED_PRODUCT", "CALL_COUNT", "RATING_COMPONENT", "TIER",
    "CURRENCY", "CASH_FLOW", "ACTUAL_USAGE", "CHARGED_USAGE", "CHARGED_UNITS",
    "UNIT_COST_USED", "AMOUNT", "COMPONENT_DIRECTION", "FLAT_RATE_CHARGE",
    "PRODUCT_GROUP", "START_CALL_COUNT", "service_type", "switch_id",
    "trunk_group_id", "poi_id", "product_id", "network_operator_id",
    "INPUTFILENAME", "PROCESSEDTIME", "SOURCETYPE",
]

# Constant output values of the MED mapping.
RATING_COMPONENT = "TC"
TIER = "INTRA"
CURRENCY = "INR"
PRODUCT_GROUP = "TELE"
SERVICE_TYPE = "Access-Voice"
SOURCE_MED = "MED"
SOURCE_ICT = "ICT"
# --- end of fixed values ---

# Output columns held as int in memory (text only at a CSV sink).
INT_COLUMNS = [
    "CALL_COUNT", "ACTUAL_USAGE", "CHARGED_USAGE", "CHARGED_UNITS", "UNIT_COST_USED",
    "AMOUNT", "FLAT_RATE_CHARGE", "START_CALL_COUNT",
]

LOG_SCHEMA = T.StructType([
    T.StructField("filename", T.StringType(), True),
    T.StructField("original_date", T.StringType(), True),
    T.StructField("processing_date", T.DateType(), True),
    T.StructField("path", T.StringType(), True),      # full path, the file's identity
    T.StructField("load_id", T.StringType(), True),   # counts once this load is committed
])


def enriched_schema(source_type: str) -> T.StructType:
    """In-memory schema of the 42 enriched columns for MED or ICT."""
    fields = []
    for c in ENRICHED_COLUMNS:
        if c in INT_COLUMNS or (c == "EVENT_DURATION" and source_type == SOURCE_MED):
            t: T.DataType = T.IntegerType()
        elif c == "PROCESSEDTIME":
            t = T.TimestampType()
        else:
            t = T.StringType()
        fields.append(T.StructField(c, t, True))
    return T.StructType(fields)
