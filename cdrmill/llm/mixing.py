"""Mixing sources to target weights by iterative proportional fitting.

Token counts per (source, language, topic) cell are raked until the cell
weights have the target marginals in all three dimensions.  A cell can't give
more tokens than it has, so the mix is as large as the scarcest cell allows:
the targets are met, and that cell is taken whole.  (A larger mix can be asked
for; it meets the targets only as far as the cells go.)  Documents are then
sampled with their cell's calibrated probability, by a hash of the row, so a
rerun draws the same rows.

The corpus is aggregated once (map-side combined, so a hot source is a few
partial sums).  The raking runs on the cell table only (its size is the product
of the dimensions' values), as windowed marginal sums with a checkpoint after
each sweep: in one task as long as the cells are few, shuffled beyond.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdrmill.llm.common import checkpointed, fresh, stored, table
from cdrmill.operators.lookup import sized_broadcast

DIMS = ("source", "lang", "topic")
NO_VALUE = "(none)"
ALPHA = 0.95        # default targets: token shares to this power
TOLERANCE = 1e-6
MAX_SWEEPS = 40
SEED = 17
CELLS_PER_TASK = 100_000
BROADCAST_BYTES = 32 << 20


def token_count(text: Column) -> Column:
    """Whitespace-separated tokens; NULL and blank texts have none."""
    trimmed = F.trim(F.coalesce(text, F.lit("")))
    return F.when(F.length(trimmed) == 0, 0).otherwise(
        F.size(F.split(trimmed, r"\s+"))).cast("long")


def surface_topic(text: Column) -> Column:
    """A coarse topic from the text's own form, first match of: ``legal``
    (licence and copyright wording), ``contact`` (addresses and links), ``table``
    (over 2 % table and code signs), ``figures`` (over 5 % digits), ``prose``."""
    text = F.coalesce(text, F.lit(""))
    low = F.lower(text)
    share = lambda chars: F.regexp_count(text, F.lit(f"[{chars}]")) \
        / F.greatest(F.length(text), F.lit(1))
    has = lambda *words: reduce(lambda a, b: a | b, [low.contains(w) for w in words])
    return (F.when(has("copyright", "license", "licence", "warranty"), "legal")
            .when(has("@", "http://", "https://", "www."), "contact")
            .when(share("|{}<>=;") > 0.02, "table")
            .when(share("0123456789") > 0.05, "figures")
            .otherwise("prose"))


def _keyed(docs: DataFrame, topic: Column | None) -> dict[str, Column]:
    """Cell keys, token count and sampling position of each row."""
    value = lambda c: F.coalesce(c.cast("string"), F.lit(NO_VALUE))
    text = F.col("text")
    return {
        "source": value(F.col("source")), "lang": value(F.col("lang")),
        "topic": value(surface_topic(text) if topic is None else topic),
        "tokens": token_count(text),
        "u": F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", text), 11) / float(1 << 53),
    }


def tempered_targets(cells: DataFrame, alpha: float = ALPHA) -> dict[str, DataFrame]:
    """Target share per value of each dimension: its token share to the power
    ``alpha``, normalised (below 1, small groups gain and large ones lose)."""
    out = {}
    for d in DIMS:
        power = cells.groupBy(d).agg(F.pow(F.sum("tokens").cast("double"), F.lit(alpha)).alias("p"))
        total = power.agg(F.sum("p")).first()[0] or 1.0
        out[d] = power.select(d, (F.col("p") / total).alias("target"))
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], keep: float | None = None,
         tolerance: float = TOLERANCE, max_sweeps: int = MAX_SWEEPS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``share``, the part of the mix
    a cell shall have, ``probability``, with which its documents are drawn, and
    ``converged``: whether the last sweep moved no share by more than ``tolerance``.

    Each sweep scales the shares to the targets of one dimension after the
    other.  Without ``keep``, the mix is as large as the cells allow: the share
    of all tokens at which the first cell gives all it has.  With ``keep``, the
    mix shall hold that share, and each sweep cuts a cell at what it holds;
    targets that can't all be met then leave the nearest shares of the last
    sweep (:func:`marginals` shows how near).  Values without a target, and cells
    without tokens, get share 0 and probability 0, except that documents without
    tokens are always drawn.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return cells.withColumns({"share": F.lit(0.0), "probability": F.lit(1.0),
                                  "converged": F.lit(True)})
    part = F.col("tokens") / float(total)
    state = cells.withColumn("share", part)
    for d in DIMS:
        state = state.join(targets[d].withColumnRenamed("target", f"{d}_target"), d, "left")
    state = checkpointed(state)
    # few cells: one task, in which the marginal sums need no shuffle
    small = state.count() <= CELLS_PER_TASK
    converged = False
    for _ in range(max_sweeps):
        new = (state.coalesce(1) if small else state).withColumn("before", F.col("share"))
        for d in DIMS:
            margin = F.sum("share").over(Window.partitionBy(d))
            new = new.withColumn("share", F.when(
                margin > 0, F.col("share") * F.coalesce(f"{d}_target", F.lit(0.0)) / margin)
                .otherwise(0.0))
        if keep:
            new = new.withColumn("share", F.least(F.col("share"), part / keep))
        new = checkpointed(new)
        moved = new.agg(F.max(F.abs(F.col("share") - F.col("before")))).first()[0]
        state = new.drop("before")
        if converged := moved <= tolerance:
            break
    state = state.drop(*[f"{d}_target" for d in DIMS])
    if not keep:
        keep = state.where("share > 0").agg(F.min(part / F.col("share"))).first()[0] or 1.0
    return state.withColumn("probability", F.when(F.col("tokens") > 0, F.least(
        F.lit(1.0), F.col("share") * keep / part)).otherwise(1.0)).withColumn(
        "converged", F.lit(converged))


def marginals(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Target and expected share of the drawn tokens (``dimension, value, target,
    achieved``) for the raked ``cells``; a value on one side only has 0 on the other."""
    drawn = cells.withColumn("drawn", F.col("tokens") * F.col("probability"))
    whole = drawn.agg(F.sum("drawn")).first()[0] or 1.0
    return reduce(DataFrame.unionByName, [
        drawn.groupBy(d).agg((F.sum("drawn") / whole).alias("achieved"))
        .join(targets[d], d, "full")
        .select(F.lit(d).alias("dimension"), F.col(d).alias("value"),
                *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("target", "achieved")])
        for d in DIMS])


def _cell_table(rows: DataFrame) -> DataFrame:
    return checkpointed(rows.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")))


def calibrated(docs: DataFrame, targets: dict[str, DataFrame] | None = None,
               keep: float | None = None, topic: Column | None = None) -> DataFrame:
    """All rows as ``doc_id, source, lang, topic, tokens, share, probability,
    converged, drawn``.  NULL sources, languages and topics form a value of their own;
    rows without tokens are drawn; repeated rows (same id and text) are drawn
    together; very long texts count with all their tokens; an empty table gives an
    empty result."""
    rows = stored(docs.select("doc_id", *[c.alias(n) for n, c in _keyed(docs, topic).items()]),
                  "mixing")
    cells = _cell_table(rows)
    cells = rake(cells, targets or tempered_targets(cells), keep).drop("tokens")
    cells, _ = sized_broadcast(checkpointed(cells), BROADCAST_BYTES)
    return (rows.join(cells, list(DIMS))
            .select("doc_id", *DIMS, "tokens", "share", "probability", "converged",
                    ((F.col("u") < F.col("probability")) | (F.col("tokens") == 0)).alias("drawn")))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None,
        keep: float | None = None, topic: Column | None = None) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns."""
    keys = _keyed(docs, topic)
    names = {n: fresh(docs, f"mix_{n}") for n in keys}
    rows = docs.select("*", *[c.alias(names[n]) for n, c in keys.items()])
    cells = _cell_table(rows.select(*[F.col(names[n]).alias(n) for n in (*DIMS, "tokens")]))
    cells = rake(cells, targets or tempered_targets(cells), keep)
    p = fresh(docs, "mix_probability")
    cells = cells.select(*[F.col(d).alias(names[d]) for d in DIMS], F.col("probability").alias(p))
    cells, _ = sized_broadcast(checkpointed(cells), BROADCAST_BYTES)
    drawn = (F.col(names["u"]) < F.col(p)) | (F.col(names["tokens"]) == 0)
    return rows.join(cells, [names[d] for d in DIMS]).where(drawn).select(*docs.columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn for the mix, with their cell and probability."""
    return (calibrated(table(spark, sf_dir, "documents")).where("drawn").drop("drawn"))
