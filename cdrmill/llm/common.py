"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrmill.session import scratch_path, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, so a lost
    executor costs a re-read and the lineage stays short."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and reread: like
    :func:`checkpointed`, but columns can be pruned from later reads."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(text: Column | str) -> Column:
    """UTF-8 length of a text; a NULL text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """128-bit identity of a text (equal texts, equal keys)."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def write_binary_rows(df: DataFrame, path: str, column: str, by: list[str] | None = None) -> None:
    """Write the binary ``column`` of ``df`` as raw files, one per partition (and
    folder, with ``by``), through Spark's own committed writer (any Hadoop store, safe against lost
    executors and speculative tasks).

    Spark's text writer puts a separator after each row.  The separator here is
    one zero byte and each value must end with a zero byte, which is left to the
    separator, so the files hold exactly the values one after another.
    """
    raw = F.col(column)
    body = raw.substr(F.lit(1), F.length(raw) - 1).cast("string")
    by = by or []
    df.select(*by, F.when(raw.substr(F.length(raw), F.lit(1)) == F.lit(bytearray(b"\0")), body)
              .otherwise(F.raise_error(F.lit("a record must end with a zero byte")))
              .alias("value")).write.option("lineSep", "\0").partitionBy(*by).text(path)
