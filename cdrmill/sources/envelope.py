"""Envelope CSV extracts: a metadata line and a header line before the
records, two trailer lines after them, in every file.

Line order inside a file is only known on the scan itself: each split of a
file is read in order, so (``_blk`` split start, ``_pos`` increasing id) is a
position.  Rather than sorting whole files (one task per file; a file may be
huge), each split is summarised to its first and last positions by a partial
aggregate; the envelope lines of a file are among the first ``head`` and
last ``tail`` lines of its splits, so ranking those few candidates per file
finds them.  The lines are then tagged with their envelope rank by a
broadcast join (its size bounded by the file listing; a shuffle join beyond
the limit) and the records are the untagged lines.

Columns are taken by the names in each file's header line, which the position
pass finds along the way.  Files with the expected header are parsed as they are;
the lines of others are first put in the expected order.  A line with another
number of fields than its header is marked ``ragged``, every line of a file
whose header lacks a column ``bad_header``: such records are held, not guessed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdrmill.functions.parse import blank_to_null
from cdrmill.operators.lookup import broadcast_limit, sized_broadcast
from cdrmill.schema import ENRICHED_COLUMNS
from cdrmill.sources.text import read_lines_with_position, spread_if_unsplittable

POSITION = ["file_path", "_blk", "_pos"]
HEADER_MARKS = ("ANUM", "BNUM", "EVENT_START_DATE")
HEADER_BYTES = 4096  # allowed for a header line in the size bound
# a comma outside quotes (only files with another header than expected are split so)
FIELD_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def envelope_positions(lines: DataFrame, head: int = 2, tail: int = 2) -> DataFrame:
    """(file_path, _blk, _pos, _env, header) of the first ``head`` lines (``_env`` =
    1, 2, ...) and the last ``tail`` lines (``_env`` = -1, -2, ... from the
    end) of every file; ``header`` is the line itself where it looks like a
    header (it names the duplicate-check columns)."""
    looks = F.upper("value")
    like_header = reduce(lambda a, b: a & b, [looks.contains(k) for k in HEADER_MARKS])
    # other lines' text is left out before the sort into splits, not in the aggregate
    marked = lines.select(*POSITION, F.when(like_header, F.struct("_pos", "value")).alias("_h"))
    splits = marked.groupBy("file_path", "_blk").agg(
        F.min("_pos").alias("lo"), F.max("_pos").alias("hi"), F.min("_h").alias("h"))
    lo, hi = F.col("lo"), F.col("hi")
    picks = ([F.when(lo + i <= hi, lo + i) for i in range(head)]
             + [F.when(hi - i >= lo, hi - i) for i in range(tail)])
    cand = (splits.select("file_path", "_blk", "h", F.explode(F.array_distinct(F.array(*picks)))
                          .alias("_pos"))
            .where(F.col("_pos").isNotNull())
            .withColumn("header", F.when(F.col("h._pos") == F.col("_pos"), F.col("h.value"))))
    asc = Window.partitionBy("file_path").orderBy("_blk", "_pos")
    desc = Window.partitionBy("file_path").orderBy(F.desc("_blk"), F.desc("_pos"))
    ranked = cand.select(*POSITION, "header", F.row_number().over(asc).alias("_a"),
                         F.row_number().over(desc).alias("_d"))
    env = F.when(F.col("_a") <= head, F.col("_a")).otherwise(-F.col("_d"))
    return ranked.where((F.col("_a") <= head) | (F.col("_d") <= tail)).select(
        *POSITION, env.cast("int").alias("_env"), "header")


def positions_bound(lines: DataFrame, head: int, tail: int) -> int | None:
    """Upper bound in bytes of ``envelope_positions``: at most ``head + tail``
    rows per input file, each a path, two longs and an int.  Taken from the
    scan's file listing (driver metadata), so no job reads the data for it."""
    try:
        files = lines.inputFiles()
    except Exception:  # noqa: BLE001 - not a plain file scan
        return None
    if not files:
        return 0
    return len(files) * ((head + tail) * (max(len(f) for f in files) + 40) + HEADER_BYTES)


def tag_envelope(lines: DataFrame, head: int = 2, tail: int = 2) -> DataFrame:
    """Every line with ``_env``: its rank in the file head (1, 2, ...), from
    the end (-1, -2, ...), or NULL for a record line."""
    positions = envelope_positions(lines, head, tail)
    return lines.join(_small(positions.drop("header"), lines, head, tail), POSITION, "left")


def _small(df: DataFrame, lines: DataFrame, head: int, tail: int) -> DataFrame:
    """``df`` (a few rows per input file) for broadcasting, if it is small."""
    bound = positions_bound(lines, head, tail)
    if bound is not None and bound <= broadcast_limit(lines.sparkSession):
        return F.broadcast(df)
    return sized_broadcast(df)[0]


def file_heads(positions: DataFrame, columns: Sequence[str], header_line: int = 2,
               sep: str = ",") -> DataFrame:
    """One row per file: ``_envelope`` (positions of its envelope lines) and, where the
    header is another than ``columns``, ``_other`` with the header's number of
    fields (``_width``) and the place (1, ...) of each expected column in it, 0 for
    a missing one (``_order``; NULL where no header was found)."""
    per_file = positions.groupBy("file_path").agg(
        F.collect_list("_pos").alias("_envelope"),
        F.max(F.when(F.col("_env") == header_line, F.col("header"))).alias("header"),
        F.count_if(F.col("_env") == header_line).alias("n"))
    names = F.transform(F.split(F.upper("header"), sep), lambda x: F.trim(F.translate(x, '"', "")))
    other = (F.col("n") > 0) & (F.col("header").isNull()
                                | (F.trim("header") != F.lit(sep.join(columns))))
    order = F.array(*[F.array_position(names, F.lit(c.upper())).cast("int") for c in columns])
    return per_file.select(
        "file_path", "_envelope", other.alias("_other"), F.size(names).alias("_width"),
        F.when(other & F.col("header").isNotNull(), order).alias("_order"))


def strip_envelope(lines: DataFrame, head: int = 2, tail: int = 2) -> DataFrame:
    """The lines that are neither envelope head nor trailer."""
    return tag_envelope(lines, head, tail).where(F.col("_env").isNull()).drop("_env")


def split_fields(line: Column, sep: str = ",") -> Column:
    """The fields of a line.  Commas within quotes divide no fields; the pattern for them
    looks at the rest of the line from every comma, so only lines with quotes take it."""
    if sep != ",":
        return F.split(line, re.escape(sep), -1)
    return F.when(line.contains('"'), F.split(line, FIELD_COMMA, -1)).otherwise(
        F.split(line, ",", -1))


def parse_csv_records(lines: DataFrame, columns: Sequence[str] = ENRICHED_COLUMNS,
                      sep: str = ",", broken: str | None = None) -> DataFrame:
    """CSV text of each record line -> the named string columns, blanks to
    NULL.  ``value`` (the raw record) and provenance columns pass through.
    ``broken`` names a column that tells lines with another number of fields."""
    ddl = ", ".join(f"`{c}` STRING" for c in columns)
    options = {"sep": sep, "mode": "PERMISSIVE"}
    if broken is not None:
        ddl += ", `_broken` STRING"
        options["columnNameOfCorruptRecord"] = "_broken"
    rec = F.from_csv(F.col("value"), ddl, options)
    keep = [c for c in lines.columns if not c.startswith("_")]
    told = [] if broken is None else [F.col("_r")["_broken"].isNotNull().alias(broken)]
    return lines.select(*keep, rec.alias("_r")).select(
        *keep, *[blank_to_null(F.col("_r")[c]).alias(c) for c in columns], *told)


def read_envelope_csv(spark: SparkSession, paths: str | list[str],
                      columns: Sequence[str] = ENRICHED_COLUMNS,
                      source_col: str | None = None, base_path: str | None = None,
                      head: int = 2, tail: int = 2, spread: bool | None = None) -> DataFrame:
    """Records of envelope CSV files: ``value, file_path, file_name``, the named
    columns and ``line_problem``."""
    lines = read_lines_with_position(spark, paths, source_col, base_path)
    return envelope_records(lines, columns, head, tail, spread=spread)


def envelope_records(lines: DataFrame, columns: Sequence[str] = ENRICHED_COLUMNS,
                     head: int = 2, tail: int = 2, header_line: int = 2,
                     sep: str = ",", spread: bool | None = None) -> DataFrame:
    """Positioned lines (``read_lines_with_position``) -> parsed records.

    ``value`` is the record line in the order of ``columns``, ``line_id`` tells lines
    of one read apart.  ``line_problem`` is
    NULL, ``ragged`` (another number of fields than the header) or ``bad_header``
    (the file has no header line, or not all columns in it).  ``spread`` tells whether the
    rows are spread after the scan (None: if a file cannot be split).
    """
    # the few envelope lines and the header come per file in one join: two scans in all
    heads = file_heads(envelope_positions(lines, head, tail), columns, header_line, sep)
    tagged = lines.join(_small(heads, lines, head, tail), "file_path", "left")
    body = tagged.where(~F.coalesce(F.array_contains("_envelope", F.col("_pos")), F.lit(False)))
    if spread is None:
        body = spread_if_unsplittable(body, lines)
    elif spread:
        body = body.hint("rebalance")
    other = F.coalesce("_other", F.lit(False))
    # a column of its own: within the lambda below each field would split the line anew
    body = body.withColumn("_fields", F.when(other, split_fields(F.col("value"), sep)))
    fields = F.col("_fields")
    lacking = F.col("_order").isNull() | F.array_contains("_order", 0)
    ordered = F.concat_ws(sep, F.transform("_order", lambda i: F.when(
        i > 0, F.coalesce(F.get(fields, i - 1), F.lit(""))).otherwise("")))
    body = body.select(
        F.when(other & F.col("_order").isNotNull(), ordered).otherwise(F.col("value")).alias("value"),
        "file_path", "file_name", F.col("_pos").alias("line_id"),
        F.when(other & lacking, "bad_header")
        .when(other & (F.size(fields) != F.col("_width")), "ragged").alias("line_problem"))
    parsed = parse_csv_records(body, columns, sep, broken="broken")
    return parsed.withColumn("line_problem", F.coalesce(
        "line_problem", F.when(F.col("broken"), "ragged"))).drop("broken")
