"""DuckDB SQL for the queries that run the jobs over files.

Field offsets are written out here (1-based start and width in the 418-character
line), not taken from the parser's layout, so a wrong width can't cancel out.
"""

from __future__ import annotations

from cdrmill import oracle as O
from cdrmill.schema import ENRICHED_COLUMNS

# --- fixed values: start and width of the record line's fields ---
OFFSETS = {
    "incoming_node": (1, 20), "outgoing_node": (21, 20), "event_start_date": (41, 8),
    "event_start_time": (49, 8), "event_duration": (57, 10), "anum": (67, 28), "bnum": (95, 28),
    "incoming_path": (123, 20), "outgoing_path": (143, 20), "incoming_product": (163, 14),
    "outgoing_product": (177, 14), "event_direction": (191, 1),
    "discrete_rating_parameter_1": (192, 15), "data_unit": (207, 8),
    "record_sequence_number": (215, 40), "record_type": (255, 2), "user_summarisation": (257, 20),
    "user_data": (277, 30), "user_data_2": (307, 30), "link_field": (337, 2),
    "user_data_3": (339, 80),
}
# --- end of fixed values ---

BY_FILE = "CASE WHEN substr(file_name, 4, 1) IN ('0', '1') THEN 1 ELSE 2 END"
BY_CALLER = "CASE WHEN CAST(substr(value, 78, 1) AS INTEGER) % 2 = 0 THEN 1 ELSE 2 END"


def _field(name: str) -> str:
    start, width = OFFSETS[name]
    return f"nullif(trim(substr(value, {start}, {width})), '') AS {name}"


def _edited(value: str) -> str:
    """The line CTEs with another text for each line."""
    return O.LINES.replace("cdr_lines AS (", "plain_lines AS (") + f""",
cdr_lines AS (SELECT {value} AS value, file_name FROM plain_lines)"""


def _chain(load: str = "1", across: bool = False, date: str = O.ORIGINAL_DATE,
           name: str = "file_name", lines: str = O.LINES) -> str:
    """Call records to reasoned legs, with ``load_no`` per record.  The duplicate
    check is per load, or (``across``) the earlier load's copy wins."""
    keys = ", ".join(O._KEYS)
    part, order = (keys, "load_no, ") if across else (f"load_no, {keys}", "")
    fields = ",\n    ".join(map(_field, O.USED_FIELDS))
    return lines + "," + O.MASTERS + f""",
med_parsed AS (SELECT {name} AS file_name, {load} AS load_no,
    {fields}
  FROM cdr_lines),
med_kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {part}
                                 ORDER BY {order}{O._order(O._DEDUP_ORDER)}) AS rn
    FROM med_parsed) WHERE rn = 1),
med_dated AS (SELECT *, {date} AS original_date, '{O.FIXED_DATE}' AS processing_date FROM med_kept),
med_legs AS ({O._legs('med_dated', 'file_name, original_date, processing_date')}),
med_looked AS ({O._lookups('med_legs', 'trunk_u', 'node_u')}),
med_reasoned AS (SELECT *, {O.REASON} AS hold_reason FROM med_looked)"""


def _calls(src: str) -> str:
    return f"""
SELECT anum AS ANUM, bnum AS BNUM, event_start_date AS EVENT_START_DATE,
       substr(event_start_time, 1, 6) AS EVENT_START_TIME, leg, file_name,
       coalesce(hold_reason, 'matched') AS state FROM {src}"""


def _again(load: str = "1", masters: str = O.FIXED_MASTERS, trunk: str = "trunk_fix_u",
           node: str = "node_fix_u") -> str:
    base = ", ".join(c for c in O.HOLD_COLS if c != "hold_reason")
    return _chain(load) + "," + masters + f""",
held AS (SELECT {base} FROM med_reasoned WHERE hold_reason IS NOT NULL),
re_looked AS ({O._lookups('held', trunk, node)}),
re_reasoned AS (SELECT *, {O.REASON} AS hold_reason FROM re_looked)"""


def q_med_two_loads_same_day() -> str:
    return O._with(_chain(BY_FILE), _calls("med_reasoned"))


def q_same_name_two_hours() -> str:
    return O._with(_chain(BY_CALLER), _calls("med_reasoned"))


def q_cross_load_dedup() -> str:
    return O._with(_chain(BY_FILE, across=True), _calls("med_reasoned"))


def q_file_log_all_repeats() -> str:
    return O._with(_chain(), """
SELECT f.file_name AS filename, CAST(2 AS BIGINT) AS n_runs, l.n_legs
FROM (SELECT DISTINCT file_name FROM med_parsed) f
LEFT JOIN (SELECT file_name, count(*) AS n_legs FROM med_reasoned GROUP BY file_name) l
  USING (file_name)""")


def _calls_again(chain: str) -> str:
    return O._with(chain, _calls("(SELECT * FROM med_reasoned WHERE hold_reason IS NULL)")
                   + "\nUNION ALL" + _calls("re_reasoned"))


def q_overlapping_hold_runs() -> str:
    return _calls_again(_again())


def q_hold_reprocess_twice_same_day() -> str:
    base = ", ".join(c for c in O.HOLD_COLS if c != "hold_reason")
    chain = _chain() + "," + O.FIXED_MASTERS + f""",
held AS (SELECT {base} FROM med_reasoned WHERE hold_reason IS NOT NULL),
old_looked AS ({O._lookups('held', 'trunk_u', 'node_u')}),
old_reasoned AS (SELECT *, {O.REASON} AS hold_reason FROM old_looked),
still AS (SELECT {base} FROM old_reasoned WHERE hold_reason IS NOT NULL),
re_looked AS ({O._lookups('still', 'trunk_fix_u', 'node_fix_u')}),
re_reasoned AS (SELECT *, {O.REASON} AS hold_reason FROM re_looked)"""
    return (_calls_again(chain) + "\nUNION ALL"
            + _calls("(SELECT * FROM old_reasoned WHERE hold_reason IS NULL)"))


def q_compacted_stores() -> str:
    return _calls_again(_again(BY_FILE))


def q_hold_master_difference() -> str:
    part = f"""
trunk_part_raw AS (
  SELECT * FROM trunk_raw
  UNION ALL
  SELECT 'TG999999', 'FIXED', 'ND' || {O._lp('n_nationkey', 2)}, 'OPFIX', 'POIFIX' FROM nation
  WHERE n_nationkey < 5),""" + O._unique_trunk("trunk_part_u", "trunk_part_raw").lstrip()
    return _calls_again(_again("1", part, "trunk_part_u", "node_u"))


def q_odd_lines_audit() -> str:
    value = ("CASE substr(value, 106, 1) WHEN '3' THEN substr(value, 1, 66) || repeat(' ', 56) || "
             "substr(value, 123) WHEN '5' THEN rtrim(substr(value, 1, 122)) ELSE value END")
    return O._with(O.audit_ctes(_chain(lines=_edited(value))), "SELECT * FROM audit")


_STEP = ("CASE substr(file_name, 4, 1) WHEN '0' THEN 1 WHEN '1' THEN 1 WHEN '2' THEN 2 ELSE 3 END")


def q_stream_late_repeats() -> str:
    old = "substr(value, 78, 1) = '9'"
    value = (f"substr(value, 1, 40) || CASE WHEN {old} THEN '19990101' ELSE '20000101' END || "
             "substr(value, 49, 58) || substr(value, 41, 8) || substr(value, 115)")
    chain = _chain(f"CASE WHEN {old} THEN {_STEP} ELSE 0 END", lines=_edited(value))
    return O._with(chain, "SELECT * EXCLUDE (EVENT_START_DATE, file_name) FROM ("
                   + _calls("med_reasoned") + ")")


def q_stream_batch_metrics() -> str:
    return O._with(_chain(_STEP), f"""
SELECT CAST(p.batch_no AS BIGINT) AS batch_no, p.records, l.leg_rows, l.matched, l.held
FROM (SELECT {_STEP} AS batch_no, count(*) AS records FROM med_parsed GROUP BY 1) p
JOIN (SELECT {_STEP} AS batch_no, count(*) AS leg_rows,
             count(*) FILTER (WHERE hold_reason IS NULL) AS matched,
             count(*) FILTER (WHERE hold_reason IS NOT NULL) AS held
      FROM med_reasoned GROUP BY 1) l USING (batch_no)""")


def q_master_rejects() -> str:
    plain = ["ID", "NAME", "FK_NNOD", "OPERATOR", "POI"]
    d = "substr(ID, length(ID), 1)"
    field = lambda c: (f"CASE WHEN {d} = '1' AND '{c}' = 'ID' THEN ' ' "  # noqa: E731
                       f"WHEN {d} = '2' THEN '  ' || {c} || '   ' ELSE {c} END")
    line = " || '|' || ".join(field(c) for c in plain)
    used = " || '|' || ".join(plain)
    sound = "(SELECT * FROM trunk_raw WHERE substr(ID, length(ID), 1) NOT IN ('1', '3', '4'))"
    return O._with(O.TRUNK_RAW + "," + O._unique_trunk("sound_u", sound), f"""
SELECT CASE WHEN {d} = '1' THEN 'blank_key' ELSE 'ragged' END AS state,
       CASE {d} WHEN '3' THEN ID || '|' || NAME WHEN '4' THEN {line} || '|x' ELSE {line} END AS line
FROM trunk_raw WHERE {d} IN ('1', '3', '4')
UNION ALL
SELECT 'used', {used} FROM sound_u""")


def q_table_replace() -> str:
    return O._with(_chain(BY_FILE), f"""
SELECT file_name AS INPUTFILENAME, leg, count(*) AS n_rows,
       CAST(sum({O.DURATION}) AS BIGINT) AS usage
FROM med_reasoned WHERE hold_reason IS NULL AND {BY_FILE} = 2 GROUP BY 1, 2""")


def q_plain_csv_export() -> str:
    cols = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in
                     [*ENRICHED_COLUMNS, "original_date", "processing_date", "leg"])
    return O._with(_chain(), f"SELECT {cols} FROM (SELECT {O.med_map_select()} FROM med_reasoned "
                   "WHERE hold_reason IS NULL)")


def q_named_files_open_clock() -> str:
    chain = _chain().replace(O.MASTERS, ",".join([
        f"""
trunk_raw AS ({O._trunk_rows()})""", O.NODE_RAW, O._unique_trunk("trunk_u", "trunk_raw"),
        O._unique_node("node_u", "node_raw")]))
    return O._with(chain, """
SELECT anum AS ANUM, bnum AS BNUM, event_start_date AS EVENT_START_DATE,
       substr(event_start_time, 1, 6) AS EVENT_START_TIME, leg, t_operator AS network_operator_id,
       file_name, true AS time_of_run, true AS date_of_run
FROM med_reasoned WHERE hold_reason IS NULL""")


def q_table_append_repeat() -> str:
    def part(src: str, kind: str) -> str:
        return (f"SELECT original_date, processing_date, '{kind}' AS kind, "
                f"count(*) AS n_rows, CAST(sum({O.DURATION}) AS BIGINT) AS usage "
                f"FROM {src} WHERE hold_reason IS NULL GROUP BY 1, 2")
    return O._with(_again(), part("med_reasoned", "med") + "\nUNION ALL\n"
                   + part("re_reasoned", "hold"))


def q_med_job_files() -> str:
    name = "substr(file_name, 1, 4) || '_' || substr(file_name, 6, 8) || '_x.cdr'"
    date = ("CASE WHEN try_strptime(split_part(file_name, '_', 2), '%Y%m%d') IS NOT NULL "
            "THEN split_part(file_name, '_', 2) END")
    cols = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in
                     [*ENRICHED_COLUMNS, "original_date", "processing_date", "leg"])
    mapped = O.med_map_select("'02/07/2024 10:00'")
    return O._with(_chain(date=date, name=name),
                   f"SELECT {cols} FROM (SELECT {mapped} FROM med_reasoned "
                   "WHERE hold_reason IS NULL)")


def q_per_file_export() -> str:
    return O._with(_chain(), f"""
SELECT file_name AS INPUTFILENAME, original_date, processing_date, count(*) AS n_rows,
       CAST(sum({O.DURATION}) AS BIGINT) AS usage
FROM med_reasoned WHERE hold_reason IS NULL GROUP BY 1, 2, 3""")


def q_parsed_csv_export() -> str:
    return O._with(O.LINES, f"SELECT {', '.join(map(_field, OFFSETS))} FROM cdr_lines")


_NO = "substr(source, 4, 1)"


def _odd_ict() -> str:
    """The odd extracts' records with their problem, then legs of the others."""
    broken = ("CASE WHEN substr(file_name, 4, 1) = '1' THEN 'bad_header' "
              "WHEN substr(file_name, 4, 1) = '2' AND ANUM LIKE '%7' THEN 'ragged' END")
    chain = O.ict_chain()
    chain = chain.replace("source AS file_name,", "CASE WHEN substr(source, 4, 1) = '3' "
                          "THEN 'ICT3_undated.csv' ELSE source END AS file_name,")
    chain = chain.replace("    FROM ict_prep) WHERE rn = 1",
                          f"    FROM ict_prep WHERE {broken} IS NULL) WHERE rn = 1")
    reason = ("nullif(concat_ws('+', CASE WHEN leg IS NULL THEN 'no_leg' END, CASE WHEN leg IS NOT "
              "NULL AND (poi_id IS NULL OR network_operator_id IS NULL) THEN 'trunk' END, "
              "CASE WHEN original_date IS NULL THEN 'no_date' END), '')")
    start = chain.index("  SELECT *, CASE WHEN leg IS NULL THEN 'no_leg'\n")
    return chain[:start] + f"  SELECT *, {reason} AS hold_reason FROM ict_mapped),\n" + f"""
odd AS (SELECT file_name, {broken} AS problem FROM ict_clean)"""


def q_envelope_reordered_header() -> str:
    """File 1 has no BNUM, so its lines' fields stand one column early; in file 2 the lines
    of some callers end after 40 fields."""
    no = "substr(file_name, 4, 1)"
    short = f"{no} = '2' AND ANUM LIKE '%7'"
    at = ENRICHED_COLUMNS.index("BNUM")
    cols = []
    for i, c in enumerate(ENRICHED_COLUMNS):
        early = "NULL" if i + 1 == len(ENRICHED_COLUMNS) else ENRICHED_COLUMNS[i + 1]
        v = f"WHEN {no} = '1' THEN {early} " if i >= at else ""
        v += f"WHEN {short} THEN NULL " if i >= 40 else ""
        cols.append(f"CASE {v}ELSE {c} END AS {c}" if v else c)
    return O._with(O.ict_records_cte(), f"""
SELECT CASE WHEN {no} = '3' THEN 'ICT3_undated.csv' ELSE file_name END AS file_name,
       CASE WHEN {no} = '1' THEN 'bad_header' WHEN {short} THEN 'ragged' END AS line_problem,
       {', '.join(cols)} FROM ict_clean""")


def q_ict_bad_records_held() -> str:
    return O._with(_odd_ict(), """
SELECT file_name, state, count(*) AS n_rows FROM (
  SELECT INPUTFILENAME AS file_name, coalesce(hold_reason, 'matched') AS state FROM ict_reasoned
  UNION ALL SELECT file_name, problem FROM odd WHERE problem IS NOT NULL)
GROUP BY 1, 2""")


def q_ict_two_loads_same_day() -> str:
    chain = O.ict_chain().replace(
        f"PARTITION BY {', '.join(O._ICT_KEYS)}",
        f"PARTITION BY substr(file_name, 4, 1) < '4', {', '.join(O._ICT_KEYS)}")
    return O._with(chain, """
SELECT INPUTFILENAME AS file_name, coalesce(hold_reason, 'matched') AS state,
       count(*) AS n_rows FROM ict_reasoned GROUP BY 1, 2""")


def q_ict_cross_load_dedup() -> str:
    # the earlier load has the smaller file names, which win in a single load, too
    return O._with(O.ict_chain(), """
SELECT INPUTFILENAME AS file_name, coalesce(hold_reason, 'matched') AS state,
       count(*) AS n_rows FROM ict_reasoned GROUP BY 1, 2""")


def q_ict_hold_job() -> str:
    return O._with(O.ict_chain() + "," + O.FIXED_MASTERS + """,
again AS (
  SELECT h.INPUTFILENAME AS file_name, h.processing_date,
         CASE WHEN h.leg IS NULL THEN 'no_leg'
              WHEN t.POI IS NULL OR t.OPERATOR IS NULL THEN 'trunk' END AS reason
  FROM (SELECT * FROM ict_reasoned WHERE hold_reason IS NOT NULL) h
  LEFT JOIN trunk_fix_u t ON t.ID = coalesce(h.INCOMING_PATH, h.OUTGOING_PATH)
                         AND t.FK_NNOD = coalesce(h.INCOMING_NODE, h.OUTGOING_NODE))""", """
SELECT file_name, state, processing_date, count(*) AS n_rows FROM (
  SELECT INPUTFILENAME AS file_name, 'matched' AS state, processing_date FROM ict_reasoned
  WHERE hold_reason IS NULL
  UNION ALL SELECT file_name, coalesce(reason, 'matched'), processing_date FROM again)
GROUP BY 1, 2, 3""")


JOB_ORACLES = {
    "med_two_loads_same_day": q_med_two_loads_same_day,
    "same_name_two_hours": q_same_name_two_hours,
    "cross_load_dedup": q_cross_load_dedup,
    "file_log_all_repeats": q_file_log_all_repeats,
    "stream_then_batch": q_same_name_two_hours,
    "hold_reprocess_twice_same_day": q_hold_reprocess_twice_same_day,
    "table_append_repeat": q_table_append_repeat,
    "med_job_files": q_med_job_files,
    "per_file_export": q_per_file_export,
    "parsed_csv_export": q_parsed_csv_export,
    "envelope_reordered_header": q_envelope_reordered_header,
    "ict_bad_records_held": q_ict_bad_records_held,
    "ict_two_loads_same_day": q_ict_two_loads_same_day,
    "overlapping_runs": q_med_two_loads_same_day,
    "overlapping_runs_keys": q_cross_load_dedup,
    "overlapping_hold_runs": q_overlapping_hold_runs,
    "hold_master_difference": q_hold_master_difference,
    "ict_hold_job": q_ict_hold_job,
    "odd_lines_audit": q_odd_lines_audit,
    "stream_late_repeats": q_stream_late_repeats,
    "stream_batch_metrics": q_stream_batch_metrics,
    "ict_stream": q_ict_two_loads_same_day,
    "ict_cross_load_dedup": q_ict_cross_load_dedup,
    "compacted_stores": q_compacted_stores,
    "master_rejects": q_master_rejects,
    "table_replace": q_table_replace,
    "plain_csv_export": q_plain_csv_export,
    "named_files_open_clock": q_named_files_open_clock,
}
