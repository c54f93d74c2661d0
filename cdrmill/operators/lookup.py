"""Master-data lookups: left outer equi-joins against small dimension tables.

Masters are de-duplicated on their key first, so a lookup never changes the
number of call rows.  The master side is broadcast only after its size has
been measured against a limit; a bigger master falls back to a shuffle join,
where AQE's skew handling splits a hot trunk's partition.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdrmill.functions.parse import blank_to_null
from cdrmill.operators.dedup import keep_first

DEFAULT_BROADCAST_BYTES = 64 << 20
_ids = itertools.count()


def clean_master(master: DataFrame) -> DataFrame:
    """Trim every field and turn blanks into NULL (keys compare trimmed)."""
    return master.select(*[blank_to_null(F.col(c)).alias(c) for c in master.columns])


def unique_master(master: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the row smallest in file column order wins.

    Rows with a NULL key part can never match a lookup and are dropped.
    """
    keyed = master.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    rest = [c for c in master.columns if c not in keys]
    return keep_first(keyed, keys, rest)


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, payload bytes) of a frame, in one aggregate job."""
    size = reduce(lambda a, b: a + b,
                  [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + F.lit(8)
                   for c in df.columns])
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


BROADCAST_CONF = "spark.cdrmill.broadcast.maxBytes"  # spark.* so spark-submit --conf passes it


def broadcast_limit(spark) -> int:
    v = spark.conf.get(BROADCAST_CONF, None) or spark.conf.get("cdrmill.broadcast.maxBytes", None)
    return int(v) if v else DEFAULT_BROADCAST_BYTES


def sized_broadcast(df: DataFrame, limit: int | None = None) -> tuple[DataFrame, bool]:
    """Broadcast hint only when the measured size is within ``limit``."""
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    _, nbytes = measure(df)
    if nbytes <= limit:
        return F.broadcast(df), True
    return df, False


def master_stats(clean: DataFrame, keys: Sequence[str]) -> tuple[int, int, int]:
    """(rows, distinct complete keys, payload bytes) of a cleaned master in
    one aggregate job.  Rows minus keys is what de-duplication drops (repeated
    keys and rows with a missing key part); the bytes bound the de-duplicated
    master from above, so they can decide the broadcast."""
    size = reduce(lambda a, b: a + b,
                  [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) + F.lit(8)
                   for c in clean.columns])
    row = clean.agg(F.count(F.lit(1)).alias("n"),
                    F.count_distinct(*[F.col(k) for k in keys]).alias("k"),
                    F.sum(size).alias("b")).first()
    return int(row["n"]), int(row["k"]), int(row["b"] or 0)


@dataclass
class Masters:
    """De-duplicated trunk group and network node masters, ready to join."""
    trunk: DataFrame
    node: DataFrame
    trunk_broadcast: bool = False
    node_broadcast: bool = False
    trunk_dropped: int = 0   # master rows removed by key de-duplication
    node_dropped: int = 0

    @classmethod
    def build(cls, trunk_raw: DataFrame, node_raw: DataFrame,
              limit: int | None = None) -> Masters:
        limit = broadcast_limit(trunk_raw.sparkSession) if limit is None else limit
        out = {}
        for name, raw, cols, keys in (
                ("trunk", trunk_raw, ["ID", "NAME", "FK_NNOD", "OPERATOR", "POI"], ["ID", "FK_NNOD"]),
                ("node", node_raw, ["ID", "NAME", "FK_ORGA_FRAN"], ["ID"])):
            clean = clean_master(raw.select(*cols))
            rows, nkeys, nbytes = master_stats(clean, keys)
            unique = unique_master(clean, keys)
            small = nbytes <= limit
            out[name] = F.broadcast(unique) if small else unique
            out[f"{name}_broadcast"] = small
            out[f"{name}_dropped"] = rows - nkeys
        return cls(**out)


def lookup(df: DataFrame, master: DataFrame, on: Sequence[tuple[Column, str]],
           take: dict[str, str], flag: str | None = None) -> DataFrame:
    """Left join ``df`` to ``master`` where each ``(expr, master_col)`` pair
    is equal; add ``take`` (master column -> output name) and, if asked, a
    boolean ``flag`` telling whether the lookup hit.
    """
    p = f"_m{next(_ids)}_"
    cols = {c for _, c in on} | set(take)
    m = master.select(*[F.col(c).alias(p + c) for c in sorted(cols)])
    cond = reduce(lambda a, b: a & b, [expr == F.col(p + c) for expr, c in on])
    j = df.join(m, cond, "left")
    out = [F.col(c) for c in df.columns]
    out += [F.col(p + src).alias(dst) for src, dst in take.items()]
    if flag:
        out.append(F.col(p + on[0][1]).isNotNull().alias(flag))
    return j.select(*out)


def lookup_trunk(df: DataFrame, trunk: DataFrame, path: Column, node: Column,
                 poi_as: str = "t_poi", operator_as: str = "t_operator",
                 flag: str | None = "trunk_hit") -> DataFrame:
    """Trunk group master by the composite key (path = ID, node = FK_NNOD)."""
    return lookup(df, trunk, [(path, "ID"), (node, "FK_NNOD")],
                  {"POI": poi_as, "OPERATOR": operator_as}, flag)


def lookup_node(df: DataFrame, node_master: DataFrame, node: Column,
                franchise_as: str = "n_franchise", flag: str | None = "node_hit") -> DataFrame:
    """Network node master by node = ID, giving the franchise."""
    return lookup(df, node_master, [(node, "ID")], {"FK_ORGA_FRAN": franchise_as}, flag)


def sql_trunk_lookup(records: DataFrame, trunk: DataFrame, side: str = "incoming",
                     broadcast: bool = True) -> DataFrame:
    """The single-side trunk lookup written as Spark SQL over temp views
    (same plan as ``lookup_trunk``; Catalyst optimises either form)."""
    spark = records.sparkSession
    n = next(_ids)
    rv, tv = f"cdr_records_{n}", f"trunk_master_{n}"
    records.createOrReplaceTempView(rv)
    trunk.createOrReplaceTempView(tv)
    hint = "/*+ BROADCAST(t) */ " if broadcast else ""
    up = side.upper()
    return spark.sql(f"""
        SELECT {hint}r.*, t.POI AS {up}_POI, t.OPERATOR AS {up}_OPERATOR,
               t.ID IS NOT NULL AS trunk_hit
        FROM {rv} r
        LEFT JOIN {tv} t ON t.ID = r.{side}_path AND t.FK_NNOD = r.{side}_node""")
