"""Independent DuckDB SQL for every registered query.

Each statement rebuilds the stand-in input of ``cdrmill.fixtures`` from the
pre-registered views (``lineitem``, ``supplier``, ``nation``) and then states
the operator's rule in plain SQL: ``row_number`` for the duplicate check,
``UNION ALL`` for the transit split, ``LEFT JOIN`` for lookups, ``CASE`` for
the mapping.  Dates and timestamps are rendered as text on both sides.
"""

from __future__ import annotations

from cdrmill.schema import CDR_FIELDS_AND_WIDTHS, CDR_LAYOUT, CDR_USED, ENRICHED_COLUMNS

FIXED_TIME = "2024-07-02 10:00:00"
FIXED_DATE = "2024-07-02"


def _v(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _lp(x: str, n: int) -> str:
    return f"lpad({_v(x)}, {n}, '0')"


# ---------------------------------------------------------------- fixture
BASE = """
base0 AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
         l.l_returnflag, l.l_linestatus, l.l_shipdate, s.s_nationkey
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
),
base AS (
  SELECT *, 0 AS dup FROM base0
  UNION ALL
  SELECT *, 1 AS dup FROM base0 WHERE l_partkey % 7 = 0
),
fx AS (
  SELECT *,
    (l_linenumber % 3) <> 0 AS hi,
    (l_linenumber % 2) = 0 AS ho,
    CASE WHEN l_partkey % 10 = 0 THEN 'ND99' ELSE 'ND' || {nd} END AS nd,
    CASE WHEN l_partkey % 11 = 0 THEN 'TG999999' ELSE 'TG' || {tg} END AS tg,
    l_orderkey + dup AS k
  FROM base
),
fields AS (
  SELECT *,
    CASE WHEN hi THEN nd ELSE '' END AS f_incoming_node,
    CASE WHEN ho THEN nd ELSE '' END AS f_outgoing_node,
    strftime(l_shipdate, '%Y%m%d') AS f_event_start_date,
    {t1} || {t2} || {t3} || '00' AS f_event_start_time,
    '0000' || {d1} || {d2} AS f_event_duration,
    '91' || {an} AS f_anum,
    '92' || {bn} AS f_bnum,
    CASE WHEN hi THEN tg ELSE '' END AS f_incoming_path,
    CASE WHEN ho THEN tg ELSE '' END AS f_outgoing_path,
    CASE WHEN hi THEN 'MM' || l_returnflag ELSE '' END AS f_incoming_product,
    CASE WHEN ho THEN 'MM' || l_linestatus ELSE '' END AS f_outgoing_product,
    {ok} || '-' || {ln} || CASE WHEN dup = 1 THEN '-D' ELSE '' END AS f_record_sequence_number
  FROM fx
)""".format(
    nd=_lp("s_nationkey", 2), tg=_lp("l_suppkey", 6),
    t1=_lp("l_orderkey % 24", 2), t2=_lp("l_partkey % 60", 2), t3=_lp("l_suppkey % 60", 2),
    d1=_lp("CAST(l_quantity AS BIGINT) % 60", 2), d2=_lp("l_orderkey % 60", 2),
    an=_lp("l_orderkey", 10), bn=_lp("l_partkey", 10),
    ok=_v("l_orderkey"), ln=_v("l_linenumber"))

_HAS = {"incoming_node", "outgoing_node", "event_start_date", "event_start_time",
        "event_duration", "anum", "bnum", "incoming_path", "outgoing_path",
        "incoming_product", "outgoing_product", "record_sequence_number"}
_LINE = " || ".join(
    f"rpad({'f_' + n if n in _HAS else chr(39) * 2}, {w}, ' ')" for n, w in CDR_FIELDS_AND_WIDTHS)

LINES = BASE + f""",
cdr_lines AS (
  SELECT {_LINE} AS value,
         'MED' || {_v('k % 4')} || '.2024070' || {_v('1 + k % 4')} || '155048.cdr' AS file_name
  FROM fields
)"""


def _parse(cols) -> str:
    return ",\n    ".join(f"nullif(trim(substr(value, {f.start}, {f.width})), '') AS {f.name}"
                           for f in CDR_LAYOUT if f.name in cols)


ALL_FIELDS = [f.name for f in CDR_LAYOUT]
USED_FIELDS = [f.name for f in CDR_LAYOUT if f.name in CDR_USED]

LOG = """
log_names AS (
  SELECT DISTINCT 'MED' || CAST(l_orderkey % 4 AS VARCHAR) || '.2024070'
         || CAST(1 + l_orderkey % 4 AS VARCHAR) || '155048.cdr' AS filename
  FROM lineitem WHERE l_orderkey % 4 = 0
)"""


def _trunk_rows(where: str = "", poi_suffix: str = "", operator: str | None = None) -> str:
    op = operator or f"'OP' || {_v('s_suppkey % 5')}"
    return (f"SELECT 'TG' || {_lp('s_suppkey', 6)} AS ID, s_name AS NAME, "
            f"'ND' || {_lp('s_nationkey', 2)} AS FK_NNOD, {op} AS OPERATOR, "
            f"'POI' || {_v('s_nationkey')} || '{poi_suffix}' AS POI FROM supplier {where}")


TRUNK_RAW = f"""
trunk_raw AS (
  {_trunk_rows()}
  UNION ALL
  {_trunk_rows('WHERE s_suppkey % 4 = 0', 'B')}
)"""

NODE_RAW = f"""
node_raw AS (
  SELECT 'ND' || {_lp('n_nationkey', 2)} AS ID, n_name AS NAME,
         'FR' || {_v('n_regionkey')} AS FK_ORGA_FRAN
  FROM nation WHERE n_nationkey <> 15
)"""

TRUNK_FIXED_RAW = f"""
trunk_fixed_raw AS (
  SELECT * FROM trunk_raw
  UNION ALL
  SELECT 'TG999999', 'FIXED', 'ND' || {_lp('n_nationkey', 2)}, 'OPFIX', 'POIFIX' FROM nation
  UNION ALL
  SELECT 'TG' || {_lp('s_suppkey', 6)}, s_name, 'ND99', 'OP' || {_v('s_suppkey % 5')}, 'POI99'
  FROM supplier
  UNION ALL
  SELECT 'TG999999', 'FIXED', 'ND99', 'OPFIX', 'POIFIX' FROM nation WHERE n_nationkey = 0
)"""

NODE_FIXED_RAW = f"""
node_fixed_raw AS (
  SELECT 'ND' || {_lp('n_nationkey', 2)} AS ID, n_name AS NAME,
         'FR' || {_v('n_regionkey')} AS FK_ORGA_FRAN FROM nation
  UNION ALL
  SELECT 'ND99', 'UNKNOWN', 'FR9' FROM nation WHERE n_nationkey = 0
)"""


def _unique_trunk(name: str, raw: str) -> str:
    return f"""
{name} AS (
  SELECT ID, NAME, FK_NNOD, OPERATOR, POI FROM (
    SELECT *, row_number() OVER (PARTITION BY ID, FK_NNOD
             ORDER BY NAME NULLS FIRST, OPERATOR NULLS FIRST, POI NULLS FIRST) AS rn
    FROM (SELECT nullif(trim(ID), '') AS ID, nullif(trim(NAME), '') AS NAME,
                 nullif(trim(FK_NNOD), '') AS FK_NNOD, nullif(trim(OPERATOR), '') AS OPERATOR,
                 nullif(trim(POI), '') AS POI FROM {raw})
    WHERE ID IS NOT NULL AND FK_NNOD IS NOT NULL
  ) WHERE rn = 1
)"""


def _unique_node(name: str, raw: str) -> str:
    return f"""
{name} AS (
  SELECT ID, NAME, FK_ORGA_FRAN FROM (
    SELECT *, row_number() OVER (PARTITION BY ID
             ORDER BY NAME NULLS FIRST, FK_ORGA_FRAN NULLS FIRST) AS rn
    FROM (SELECT nullif(trim(ID), '') AS ID, nullif(trim(NAME), '') AS NAME,
                 nullif(trim(FK_ORGA_FRAN), '') AS FK_ORGA_FRAN FROM {raw})
    WHERE ID IS NOT NULL
  ) WHERE rn = 1
)"""


MASTERS = ",".join([TRUNK_RAW, NODE_RAW, _unique_trunk("trunk_u", "trunk_raw"),
                    _unique_node("node_u", "node_raw")])
FIXED_MASTERS = ",".join([TRUNK_FIXED_RAW, NODE_FIXED_RAW,
                          _unique_trunk("trunk_fix_u", "trunk_fixed_raw"),
                          _unique_node("node_fix_u", "node_fixed_raw")])

# MED dedup tie-break: file name, sequence number, then the other used fields
_KEYS = ["anum", "bnum", "event_start_date", "event_start_time"]
_DEDUP_ORDER = ["file_name", "record_sequence_number"] + [
    c for c in USED_FIELDS if c not in _KEYS and c != "record_sequence_number"]


def _order(cols) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


_OTHERS = [c for c in USED_FIELDS if c not in
           ("incoming_node", "incoming_path", "incoming_product",
            "outgoing_node", "outgoing_path", "outgoing_product")]


def _legs(src: str, extra: str) -> str:
    """UNION ALL form of the transit split over ``src``."""
    o = ", ".join(_OTHERS)
    nul = "CAST(NULL AS VARCHAR)"
    in_p = "(incoming_node IS NOT NULL OR incoming_path IS NOT NULL)"
    out_p = "(outgoing_node IS NOT NULL OR outgoing_path IS NOT NULL)"
    return f"""
  SELECT 'I' AS leg, incoming_node, {nul} AS outgoing_node, incoming_path, {nul} AS outgoing_path,
         incoming_product, {nul} AS outgoing_product, {o}, {extra} FROM {src} WHERE {in_p}
  UNION ALL
  SELECT 'O', {nul}, outgoing_node, {nul}, outgoing_path, {nul}, outgoing_product, {o}, {extra}
  FROM {src} WHERE {out_p}
  UNION ALL
  SELECT {nul}, incoming_node, outgoing_node, incoming_path, outgoing_path, incoming_product,
         outgoing_product, {o}, {extra} FROM {src} WHERE NOT {in_p} AND NOT {out_p}"""


ORIGINAL_DATE = ("CASE WHEN try_strptime(nullif(regexp_extract(file_name, '\\d{8}', 0), ''), "
                 "'%Y%m%d') IS NOT NULL THEN regexp_extract(file_name, '\\d{8}', 0) END")

DURATION = ("TRY_CAST(substr(event_duration, 1, 4) AS INTEGER) * 3600 + "
            "TRY_CAST(substr(event_duration, 5, 2) AS INTEGER) * 60 + "
            "TRY_CAST(substr(event_duration, 7, 2) AS INTEGER)")


def _lookups(src: str, trunk: str, node: str) -> str:
    return f"""
  SELECT g.*, t.POI AS t_poi, t.OPERATOR AS t_operator, t.ID IS NOT NULL AS trunk_hit,
         n.FK_ORGA_FRAN AS n_franchise, n.ID IS NOT NULL AS node_hit
  FROM {src} g
  LEFT JOIN {trunk} t ON t.ID = coalesce(g.incoming_path, g.outgoing_path)
                     AND t.FK_NNOD = coalesce(g.incoming_node, g.outgoing_node)
  LEFT JOIN {node} n ON n.ID = coalesce(g.incoming_node, g.outgoing_node)"""


REASON = ("nullif(concat_ws('+', CASE WHEN leg IS NULL THEN 'no_leg' END, "
          "CASE WHEN leg IS NOT NULL AND NOT trunk_hit THEN 'trunk' END, "
          "CASE WHEN leg IS NOT NULL AND NOT node_hit THEN 'node' END, "
          "CASE WHEN original_date IS NULL THEN 'no_date' END), '')")


def med_map_select(time_sql: str = f"'{FIXED_TIME}'") -> str:
    """The 42 MED columns + extras over a frame of reasoned leg rows."""
    in_poi = "CASE WHEN leg = 'I' THEN t_poi END"
    out_poi = "CASE WHEN leg = 'O' THEN t_poi END"
    in_op = "CASE WHEN leg = 'I' THEN t_operator END"
    out_op = "CASE WHEN leg = 'O' THEN t_operator END"
    direction = ("CASE WHEN incoming_path IS NOT NULL THEN 'I' "
                 "WHEN outgoing_path IS NOT NULL THEN 'O' END")
    by_in = "CASE WHEN incoming_path IS NOT NULL THEN {a} ELSE {b} END"
    cols = {
        "INCOMING_NODE": "incoming_node", "OUTGOING_NODE": "outgoing_node",
        "EVENT_START_DATE": "event_start_date",
        "EVENT_START_TIME": "substr(event_start_time, 1, 6)",
        "EVENT_DURATION": DURATION, "ANUM": "anum", "BNUM": "bnum",
        "INCOMING_PATH": "incoming_path", "OUTGOING_PATH": "outgoing_path",
        "INCOMING_PRODUCT": "incoming_product", "OUTGOING_PRODUCT": "outgoing_product",
        "EVENT_DIRECTION": direction,
        "INCOMING_POI": in_poi, "OUTGOING_POI": out_poi,
        "INCOMING_OPERATOR": in_op, "OUTGOING_OPERATOR": out_op,
        "FRANCHISE": "n_franchise",
        "BILLING_OPERATOR": by_in.format(a=in_op, b=out_op),
        "BILLED_PRODUCT": "coalesce(incoming_product, outgoing_product)",
        "CALL_COUNT": "CAST(1 AS INTEGER)", "RATING_COMPONENT": "'TC'", "TIER": "'INTRA'",
        "CURRENCY": "'INR'",
        "CASH_FLOW": "CASE WHEN incoming_path IS NOT NULL THEN 'R' ELSE 'E' END",
        "ACTUAL_USAGE": DURATION, "CHARGED_USAGE": DURATION,
        "CHARGED_UNITS": "CAST(0 AS INTEGER)", "UNIT_COST_USED": "CAST(0 AS INTEGER)",
        "AMOUNT": "CAST(0 AS INTEGER)", "COMPONENT_DIRECTION": direction,
        "FLAT_RATE_CHARGE": "CAST(0 AS INTEGER)", "PRODUCT_GROUP": "'TELE'",
        "START_CALL_COUNT": "CAST(1 AS INTEGER)", "service_type": "'Access-Voice'",
        "switch_id": "coalesce(incoming_node, outgoing_node)",
        "trunk_group_id": "coalesce(incoming_path, outgoing_path)",
        "poi_id": by_in.format(a=in_poi, b=out_poi),
        "product_id": "coalesce(incoming_product, outgoing_product)",
        "network_operator_id": by_in.format(a=in_op, b=out_op),
        "INPUTFILENAME": "file_name", "PROCESSEDTIME": time_sql, "SOURCETYPE": "'MED'",
        "original_date": "original_date", "processing_date": "processing_date", "leg": "leg",
    }
    return ",\n    ".join(f"{v} AS {k}" for k, v in cols.items())


def med_chain(use_log: bool = True) -> str:
    """CTEs from the fixture to ``med_reasoned`` (every leg row, with
    lookups and ``hold_reason``)."""
    new = ("SELECT * FROM cdr_lines c WHERE NOT EXISTS "
           "(SELECT 1 FROM log_names g WHERE g.filename = c.file_name)") if use_log else \
        "SELECT * FROM cdr_lines"
    return LINES + "," + LOG + "," + MASTERS + f""",
med_new AS ({new}),
med_parsed AS (SELECT file_name,
    {_parse(USED_FIELDS)}
  FROM med_new),
med_kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {', '.join(_KEYS)}
                                 ORDER BY {_order(_DEDUP_ORDER)}) AS rn
    FROM med_parsed) WHERE rn = 1),
med_dated AS (SELECT *, {ORIGINAL_DATE} AS original_date,
                     '{FIXED_DATE}' AS processing_date FROM med_kept),
med_legs AS ({_legs('med_dated', 'file_name, original_date, processing_date')}),
med_looked AS ({_lookups('med_legs', 'trunk_u', 'node_u')}),
med_reasoned AS (SELECT *, {REASON} AS hold_reason FROM med_looked)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


HOLD_COLS = USED_FIELDS + ["file_name", "original_date", "leg", "processing_date",
                           "hold_reason"]


def q_fixed_width_parse() -> str:
    return _with(LINES, f"SELECT file_name,\n    {_parse(ALL_FIELDS)}\nFROM cdr_lines")


def _parsed_all() -> str:
    return LINES + f""",
parsed AS (SELECT file_name,
    {_parse(USED_FIELDS)}
  FROM cdr_lines)"""


def q_event_fields() -> str:
    return _with(_parsed_all(), f"""
SELECT file_name, record_sequence_number, event_start_date AS EVENT_START_DATE,
       CAST(CAST(try_strptime(event_start_date, '%Y%m%d') AS DATE) AS VARCHAR) AS event_date,
       substr(event_start_time, 1, 6) AS EVENT_START_TIME,
       {DURATION} AS EVENT_DURATION
FROM parsed""")


def q_usage_seconds() -> str:
    return _with(_parsed_all(), f"""
SELECT file_name, record_sequence_number, event_duration,
       {DURATION} AS ACTUAL_USAGE, {DURATION} AS CHARGED_USAGE
FROM parsed""")


def q_original_date() -> str:
    return _with(LINES, f"""
SELECT file_name, {ORIGINAL_DATE} AS original_date
FROM (SELECT DISTINCT file_name FROM cdr_lines)""")


def q_new_files_only() -> str:
    return _with(LINES + "," + LOG, """
SELECT value, file_name FROM cdr_lines c
WHERE NOT EXISTS (SELECT 1 FROM log_names g WHERE g.filename = c.file_name)""")


def q_record_dedup() -> str:
    return _with(_parsed_all(), f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(_KEYS)}
                               ORDER BY {_order(_DEDUP_ORDER)}) AS rn
  FROM parsed) WHERE rn = 1""")


def q_transit_split() -> str:
    return _with(_parsed_all() + f""",
legs AS ({_legs('parsed', 'file_name')})""", """
SELECT * EXCLUDE (event_direction),
       CASE WHEN incoming_path IS NOT NULL THEN 'I'
            WHEN outgoing_path IS NOT NULL THEN 'O' END AS EVENT_DIRECTION
FROM legs""")


def _q_trunk_side(side: str) -> str:
    up = side.upper()
    return _with(_parsed_all() + "," + MASTERS, f"""
SELECT p.file_name, p.record_sequence_number, p.{side}_path, p.{side}_node,
       t.POI AS {up}_POI, t.OPERATOR AS {up}_OPERATOR, t.ID IS NOT NULL AS trunk_hit
FROM parsed p LEFT JOIN trunk_u t ON t.ID = p.{side}_path AND t.FK_NNOD = p.{side}_node""")


def q_trunk_lookup_incoming() -> str:
    return _q_trunk_side("incoming")


def q_trunk_lookup_outgoing() -> str:
    return _q_trunk_side("outgoing")


def q_franchise_lookup() -> str:
    return _with(_parsed_all() + "," + MASTERS, """
SELECT p.file_name, p.record_sequence_number, p.incoming_node, p.outgoing_node,
       n.FK_ORGA_FRAN AS FRANCHISE, n.ID IS NOT NULL AS node_hit
FROM parsed p LEFT JOIN node_u n ON n.ID = coalesce(p.incoming_node, p.outgoing_node)""")


def q_unique_master() -> str:
    return _with(MASTERS, "SELECT ID, NAME, FK_NNOD, OPERATOR, POI FROM trunk_u")


def q_latest_master() -> str:
    snaps = f"""
snaps AS (
  {_trunk_rows()}
  UNION ALL
  {_trunk_rows(operator="'OLD'")}
)"""
    # the newer snapshot (20240410) carries the generated operators
    return _with(snaps, """
SELECT * FROM (
  SELECT ID, NAME, FK_NNOD, OPERATOR, POI,
         CASE WHEN OPERATOR = 'OLD' THEN '20240401' ELSE '20240410' END AS snapshot
  FROM snaps)
WHERE snapshot = (SELECT max(s) FROM (VALUES ('20240401'), ('20240410')) v(s))""")


def _all_legs_mapped() -> str:
    return _with(med_chain(), f"SELECT {med_map_select()} FROM med_reasoned")


def q_direction_and_cash_flow() -> str:
    return _with(med_chain(), f"""
SELECT INPUTFILENAME, ANUM, BNUM, EVENT_START_DATE, EVENT_START_TIME, leg,
       EVENT_DIRECTION, CASH_FLOW, COMPONENT_DIRECTION
FROM (SELECT {med_map_select()} FROM med_reasoned)""")


def q_effective_ids() -> str:
    return _with(med_chain(), f"""
SELECT INPUTFILENAME, ANUM, BNUM, EVENT_START_DATE, EVENT_START_TIME, leg,
       BILLING_OPERATOR, BILLED_PRODUCT, switch_id, trunk_group_id, poi_id, product_id,
       network_operator_id
FROM (SELECT {med_map_select()} FROM med_reasoned)""")


def q_med_enriched() -> str:
    return _with(med_chain(), f"""
SELECT {med_map_select()} FROM med_reasoned WHERE hold_reason IS NULL""")


def q_med_held() -> str:
    return _with(med_chain(), f"""
SELECT {', '.join(HOLD_COLS)} FROM med_reasoned WHERE hold_reason IS NOT NULL""")


def _reprocessed() -> str:
    base = ", ".join(c for c in HOLD_COLS if c != "hold_reason")
    return med_chain() + "," + FIXED_MASTERS + f""",
held AS (SELECT {base} FROM med_reasoned WHERE hold_reason IS NOT NULL),
re_looked AS ({_lookups('held', 'trunk_fix_u', 'node_fix_u')}),
re_reasoned AS (SELECT *, {REASON} AS hold_reason FROM re_looked)"""


REPROCESS_TIME = "2024-07-03 09:00:00"


def q_hold_reprocess() -> str:
    return _with(_reprocessed(), f"""
SELECT {med_map_select(f"'{REPROCESS_TIME}'")} FROM re_reasoned WHERE hold_reason IS NULL""")




BLANK_KEY = " OR ".join(f"{c} IS NULL" for c in _KEYS)


def audit_ctes(chain: str | None = None) -> str:
    return (chain or med_chain()) + f""",
n_in AS (SELECT file_name, count(*) AS n_records, count(*) FILTER (WHERE {BLANK_KEY}) AS b
         FROM med_parsed GROUP BY file_name),
n_kept AS (SELECT file_name, count(*) AS n_kept, count(*) FILTER (WHERE {BLANK_KEY}) AS b
           FROM med_kept GROUP BY file_name),
n_legs AS (SELECT file_name, count(*) FILTER (WHERE hold_reason IS NULL) AS n_matched,
                  count(*) FILTER (WHERE hold_reason IS NOT NULL) AS n_held
           FROM med_reasoned GROUP BY file_name),
audit AS (
  SELECT i.file_name AS filename, i.n_records,
         i.n_records - coalesce(k.n_kept, 0) AS n_duplicates,
         i.b - coalesce(k.b, 0) AS n_blank_merges,
         coalesce(l.n_matched, 0) AS n_matched, coalesce(l.n_held, 0) AS n_held
  FROM n_in i LEFT JOIN n_kept k USING (file_name) LEFT JOIN n_legs l USING (file_name))"""


def q_file_audit() -> str:
    return _with(audit_ctes(), "SELECT * FROM audit")


def q_load_metrics() -> str:
    return _with(audit_ctes(), """
SELECT count(*) AS n_files, CAST(sum(n_records) AS BIGINT) AS n_records,
       CAST(sum(n_duplicates) AS BIGINT) AS n_duplicates,
       CAST(sum(n_blank_merges) AS BIGINT) AS n_blank_merges,
       CAST(sum(n_matched) AS BIGINT) AS n_matched, CAST(sum(n_held) AS BIGINT) AS n_held
FROM audit""")


def q_backdated_partitions() -> str:
    return _with(_reprocessed(), """
SELECT original_date, processing_date, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT load_id) AS BIGINT) AS n_loads
FROM (SELECT original_date, processing_date, 'first' AS load_id
      FROM med_reasoned WHERE hold_reason IS NULL
      UNION ALL
      SELECT original_date, processing_date, 'reprocess' AS load_id
      FROM re_reasoned WHERE hold_reason IS NULL)
GROUP BY original_date, processing_date""")


def q_processed_log_append() -> str:
    return _with(LINES + "," + LOG, f"""
SELECT filename, {ORIGINAL_DATE.replace('file_name', 'filename')} AS original_date,
       '2024-07-01' AS processing_date FROM log_names
UNION ALL
SELECT file_name, {ORIGINAL_DATE}, '{FIXED_DATE}'
FROM (SELECT DISTINCT file_name FROM cdr_lines c
      WHERE NOT EXISTS (SELECT 1 FROM log_names g WHERE g.filename = c.file_name))""")


def q_export_round_trip() -> str:
    cols = [c for c in ENRICHED_COLUMNS] + ["original_date", "leg"]
    sel = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NA') AS {c}" for c in cols)
    return _with(med_chain(), f"""
SELECT {sel}, processing_date
FROM (SELECT {med_map_select()} FROM med_reasoned WHERE hold_reason IS NULL)""")


def q_pipe_to_comma() -> str:
    return _with(TRUNK_RAW, "SELECT ID, NAME, FK_NNOD, OPERATOR, POI FROM trunk_raw")


def q_incremental_load() -> str:
    return q_med_enriched()


# ---------------------------------------------------------------- ICT
def _ict_src_cols() -> dict[str, str]:
    op = f"'OP' || {_v('l_suppkey % 5')}"
    direction = "CASE WHEN hi THEN 'I' WHEN ho THEN 'O' ELSE '' END"
    usage = _v("CAST(l_quantity AS BIGINT) * 60")
    return {
        "INCOMING_NODE": "f_incoming_node", "OUTGOING_NODE": "f_outgoing_node",
        "EVENT_START_DATE": "f_event_start_date", "EVENT_START_TIME": "f_event_start_time",
        "EVENT_DURATION": "f_event_duration", "ANUM": "f_anum", "BNUM": "f_bnum",
        "INCOMING_PATH": "f_incoming_path", "OUTGOING_PATH": "f_outgoing_path",
        "INCOMING_PRODUCT": "f_incoming_product", "OUTGOING_PRODUCT": "f_outgoing_product",
        "EVENT_DIRECTION": direction,
        "INCOMING_POI": f"CASE WHEN hi THEN 'P' || {_v('s_nationkey')} ELSE '' END",
        "OUTGOING_POI": f"CASE WHEN ho THEN 'P' || {_v('s_nationkey')} ELSE '' END",
        "INCOMING_OPERATOR": f"CASE WHEN hi THEN {op} ELSE '' END",
        "OUTGOING_OPERATOR": f"CASE WHEN ho THEN {op} ELSE '' END",
        "FRANCHISE": f"'FR' || {_v('s_nationkey % 5')}",
        "BILLING_OPERATOR": op, "BILLED_PRODUCT": "'MM' || l_returnflag",
        "CALL_COUNT": "'1'", "RATING_COMPONENT": "'TC'", "TIER": "'INTRA'", "CURRENCY": "'INR'",
        "CASH_FLOW": "CASE WHEN hi THEN 'R' ELSE 'E' END",
        "ACTUAL_USAGE": usage, "CHARGED_USAGE": usage, "CHARGED_UNITS": "'0'",
        "UNIT_COST_USED": "'0'", "AMOUNT": "'0'", "COMPONENT_DIRECTION": direction,
        "FLAT_RATE_CHARGE": "'0'", "PRODUCT_GROUP": "'TELE'", "START_CALL_COUNT": "'1'",
        "SOURCETYPE": "'ICT'",
    }


_ICT_KEYS = ["ANUM", "BNUM", "EVENT_START_DATE", "EVENT_START_TIME"]
_ICT_IN = ["INCOMING_NODE", "INCOMING_PATH", "INCOMING_PRODUCT"]
_ICT_OUT = ["OUTGOING_NODE", "OUTGOING_PATH", "OUTGOING_PRODUCT"]
_INT_COLS = ["CALL_COUNT", "ACTUAL_USAGE", "CHARGED_USAGE", "CHARGED_UNITS", "UNIT_COST_USED",
             "AMOUNT", "FLAT_RATE_CHARGE", "START_CALL_COUNT"]


def ict_records_cte() -> str:
    src = _ict_src_cols()
    cols = ", ".join(f"{src.get(c, chr(39) * 2)} AS {c}" for c in ENRICHED_COLUMNS)
    clean = ", ".join(f"nullif(trim({c}), '') AS {c}" for c in ENRICHED_COLUMNS)
    source = (f"'ICT' || {_v('k % 8')} || '_2024070' || {_v('1 + k % 8')} || '.csv'")
    return BASE + f""",
ict_src AS (SELECT {cols}, {source} AS source FROM fields),
ict_clean AS (SELECT {clean}, source AS file_name,
                     concat_ws(',', {', '.join(ENRICHED_COLUMNS)}) AS value FROM ict_src)"""


def ict_chain() -> str:
    order = ["file_name", "value"]
    nul = "CAST(NULL AS VARCHAR)"
    others = [c for c in ENRICHED_COLUMNS if c not in _ICT_IN + _ICT_OUT]
    o = ", ".join(others)
    in_p = "(INCOMING_NODE IS NOT NULL OR INCOMING_PATH IS NOT NULL)"
    out_p = "(OUTGOING_NODE IS NOT NULL OR OUTGOING_PATH IS NOT NULL)"
    tail = "file_name, original_date, processing_date"
    mapped = []
    for c in ENRICHED_COLUMNS:
        v = {"EVENT_START_TIME": "substr(EVENT_START_TIME, 1, 6)",
             "service_type": "'Access-Voice'",
             "switch_id": "coalesce(INCOMING_NODE, OUTGOING_NODE)",
             "trunk_group_id": "coalesce(INCOMING_PATH, OUTGOING_PATH)",
             "poi_id": "t_poi",
             "product_id": "coalesce(INCOMING_PRODUCT, OUTGOING_PRODUCT)",
             "network_operator_id": "t_operator", "INPUTFILENAME": "file_name",
             "PROCESSEDTIME": f"'{FIXED_TIME}'", "SOURCETYPE": "'ICT'"}.get(c, c)
        if c in _INT_COLS:
            v = f"TRY_CAST({c} AS INTEGER)"
        mapped.append(f"{v} AS {c}")
    return ict_records_cte() + f""",
ict_prep AS (SELECT * REPLACE (substr(EVENT_START_TIME, 1, 6) AS EVENT_START_TIME) FROM ict_clean),
ict_kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {', '.join(_ICT_KEYS)}
                                 ORDER BY {_order(order)}) AS rn
    FROM ict_prep) WHERE rn = 1),
ict_dated AS (SELECT * EXCLUDE (value), {ORIGINAL_DATE} AS original_date,
                     '{FIXED_DATE}' AS processing_date FROM ict_kept),
ict_legs AS (
  SELECT 'I' AS leg, INCOMING_NODE, {nul} AS OUTGOING_NODE, INCOMING_PATH, {nul} AS OUTGOING_PATH,
         INCOMING_PRODUCT, {nul} AS OUTGOING_PRODUCT, {o}, {tail} FROM ict_dated WHERE {in_p}
  UNION ALL
  SELECT 'O', {nul}, OUTGOING_NODE, {nul}, OUTGOING_PATH, {nul}, OUTGOING_PRODUCT, {o}, {tail}
  FROM ict_dated WHERE {out_p}
  UNION ALL
  SELECT {nul}, INCOMING_NODE, OUTGOING_NODE, INCOMING_PATH, OUTGOING_PATH, INCOMING_PRODUCT,
         OUTGOING_PRODUCT, {o}, {tail} FROM ict_dated WHERE NOT {in_p} AND NOT {out_p}),
""" + MASTERS + f""",
ict_looked AS (
  SELECT g.*, t.POI AS t_poi, t.OPERATOR AS t_operator
  FROM ict_legs g LEFT JOIN trunk_u t
    ON t.ID = coalesce(g.INCOMING_PATH, g.OUTGOING_PATH)
   AND t.FK_NNOD = coalesce(g.INCOMING_NODE, g.OUTGOING_NODE)),
ict_mapped AS (SELECT {', '.join(mapped)}, original_date, processing_date, leg FROM ict_looked),
ict_reasoned AS (
  SELECT *, CASE WHEN leg IS NULL THEN 'no_leg'
                 WHEN poi_id IS NULL OR network_operator_id IS NULL THEN 'trunk' END AS hold_reason
  FROM ict_mapped)"""


def q_ict_enriched() -> str:
    return _with(ict_chain(), "SELECT * EXCLUDE (hold_reason) FROM ict_reasoned "
                              "WHERE hold_reason IS NULL")


def q_ict_held() -> str:
    return _with(ict_chain(), "SELECT * FROM ict_reasoned WHERE hold_reason IS NOT NULL")


def q_envelope_csv() -> str:
    return _with(ict_records_cte(), f"SELECT file_name, {', '.join(ENRICHED_COLUMNS)} "
                                    "FROM ict_clean")


def q_ict_hold_reprocess() -> str:
    nul_keep = [c for c in ENRICHED_COLUMNS if c not in
                ("poi_id", "network_operator_id", "PROCESSEDTIME")]
    keep = ", ".join(f"h.{c}" for c in nul_keep)
    return _with(ict_chain() + "," + FIXED_MASTERS + f""",
ict_re AS (
  SELECT {keep}, t.POI AS poi_id, t.OPERATOR AS network_operator_id,
         '{REPROCESS_TIME}' AS PROCESSEDTIME, h.original_date, h.processing_date, h.leg
  FROM (SELECT * FROM ict_reasoned WHERE hold_reason IS NOT NULL) h
  LEFT JOIN trunk_fix_u t ON t.ID = coalesce(h.INCOMING_PATH, h.OUTGOING_PATH)
                         AND t.FK_NNOD = coalesce(h.INCOMING_NODE, h.OUTGOING_NODE))""",
                 f"""
SELECT {', '.join(ENRICHED_COLUMNS)}, original_date, processing_date, leg FROM ict_re
WHERE leg IS NOT NULL AND poi_id IS NOT NULL AND network_operator_id IS NOT NULL""")


def q_ict_file_audit() -> str:
    return _with(ict_chain() + f""",
n_in AS (SELECT file_name, count(*) AS n_records, count(*) FILTER (WHERE {BLANK_KEY}) AS b
         FROM ict_clean GROUP BY file_name),
n_kept AS (SELECT file_name, count(*) AS n_kept, count(*) FILTER (WHERE {BLANK_KEY}) AS b
           FROM ict_kept GROUP BY file_name),
n_legs AS (SELECT INPUTFILENAME AS file_name,
                  count(*) FILTER (WHERE hold_reason IS NULL) AS n_matched,
                  count(*) FILTER (WHERE hold_reason IS NOT NULL) AS n_held
           FROM ict_reasoned GROUP BY INPUTFILENAME)""", """
SELECT i.file_name AS filename, i.n_records,
       i.n_records - coalesce(k.n_kept, 0) AS n_duplicates,
       i.b - coalesce(k.b, 0) AS n_blank_merges,
       coalesce(l.n_matched, 0) AS n_matched, coalesce(l.n_held, 0) AS n_held
FROM n_in i LEFT JOIN n_kept k USING (file_name) LEFT JOIN n_legs l USING (file_name)""")


ORACLES = {
    "fixed_width_parse": q_fixed_width_parse,
    "event_fields": q_event_fields,
    "usage_seconds": q_usage_seconds,
    "original_date": q_original_date,
    "new_files_only": q_new_files_only,
    "record_dedup": q_record_dedup,
    "transit_split": q_transit_split,
    "trunk_lookup_incoming": q_trunk_lookup_incoming,
    "trunk_lookup_outgoing": q_trunk_lookup_outgoing,
    "trunk_lookup_sql": q_trunk_lookup_incoming,
    "franchise_lookup": q_franchise_lookup,
    "unique_master": q_unique_master,
    "latest_master": q_latest_master,
    "direction_and_cash_flow": q_direction_and_cash_flow,
    "effective_ids": q_effective_ids,
    "med_enriched": q_med_enriched,
    "med_held": q_med_held,
    "hold_reprocess": q_hold_reprocess,
    "file_audit": q_file_audit,
    "load_metrics": q_load_metrics,
    "backdated_partitions": q_backdated_partitions,
    "processed_log_append": q_processed_log_append,
    "export_round_trip": q_export_round_trip,
    "pipe_to_comma": q_pipe_to_comma,
    "incremental_load": q_incremental_load,
    "ict_enriched": q_ict_enriched,
    "ict_held": q_ict_held,
    "envelope_csv": q_envelope_csv,
    "ict_hold_reprocess": q_ict_hold_reprocess,
    "ict_file_audit": q_ict_file_audit,
}
