"""Column expressions that parse and clean call-record fields.

Everything here returns a ``Column`` built from Spark's own functions, so it
runs inside whole-stage codegen; no Python touches a row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdrmill.schema import CDR_LAYOUT, Field


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Absent value: an empty or all-space field becomes SQL NULL.

    Padded values are trimmed first, so ``'AB   '`` and ``'AB'`` compare
    equal in joins and duplicate checks.
    """
    return F.nullif(F.trim(_c(c)), F.lit(""))


def slice_field(value: Column | str, start: int, width: int) -> Column:
    """One fixed-width field (1-based start); short or empty lines give NULL."""
    return blank_to_null(F.substring(_c(value), start, width))


def parse_fixed_width(df: DataFrame, layout: Sequence[Field] = CDR_LAYOUT,
                      value_col: str = "value", keep: Iterable[str] | None = None,
                      drop_value: bool = True) -> DataFrame:
    """Split ``value`` into the layout's fields in one projection.

    ``keep`` restricts the output to those field names (column pruning);
    other columns of ``df`` (file name, provenance) pass through.
    """
    wanted = set(keep) if keep is not None else None
    passthrough = [c for c in df.columns if c != value_col or not drop_value]
    # characters are found by walking a line from its start, once a field; where every
    # character is a byte, fields are cut from the bytes
    line, plain = F.col(value_col), F.col("_bytes_only")
    cut = lambda f: blank_to_null(F.when(plain, F.substring(
        line.cast("binary"), f.start, f.width).cast("string")).otherwise(
        F.substring(line, f.start, f.width)))
    fields = [cut(f).alias(f.name) for f in layout if wanted is None or f.name in wanted]
    marked = df.withColumn("_bytes_only", F.octet_length(line) == F.char_length(line))
    return marked.select(*[F.col(c) for c in passthrough], *fields)


def sentinel(c: Column | str, token: str = "NA") -> Column:
    """Render NULL as a sentinel token (sink option only)."""
    return F.coalesce(_c(c), F.lit(token))


def hhmiss(c: Column | str) -> Column:
    """Start time cut to HHMISS (first six characters)."""
    return F.substring(_c(c), 1, 6)


def parse_yyyymmdd(c: Column | str) -> Column:
    """``yyyyMMdd`` text to a date; malformed text gives NULL, never an error."""
    return F.try_to_date(_c(c), "yyyyMMdd")


def duration_seconds(c: Column | str) -> Column:
    """``HHHHMMSS`` duration to seconds; a malformed part gives NULL."""
    c = _c(c)
    hours = F.substring(c, 1, 4).try_cast("int")
    minutes = F.substring(c, 5, 2).try_cast("int")
    seconds = F.substring(c, 7, 2).try_cast("int")
    return hours * F.lit(3600) + minutes * F.lit(60) + seconds


DATE_IN_NAME = r"\d{8}"


def date_from_name(name: Column | str, mode: str = "regex") -> Column:
    """The original date carried by a file name.

    ``regex``: first run of eight digits; ``split``: the second ``_`` field.
    Either gives NULL when the name has none.
    """
    name = _c(name)
    if mode == "regex":
        return F.nullif(F.regexp_extract(name, DATE_IN_NAME, 0), F.lit(""))
    if mode == "split":
        return F.nullif(F.get(F.split(name, "_"), 1), F.lit(""))
    raise ValueError(f"unknown mode {mode!r}")


def base_name(path: Column | str) -> Column:
    """Last component of a path or URI."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def parent_name(path: Column | str) -> Column:
    """Name of the folder that holds a file."""
    return F.regexp_extract(_c(path), r"([^/]+)/[^/]*$", 1)

