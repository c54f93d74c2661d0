"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a 63-bit ring.  A row's key (``doc_id``,
text checksum, size) hashes to a ring position and belongs to the next point
clockwise.  A shard holds at most its capacity; what comes beyond continues
clockwise to the next point whose shard still has room.

The walk runs over *arcs*, not rows: keys are ranked inside their arc, and whole
rank intervals move.  So the table that is walked has ``shards x vnodes``
rows whatever the corpus size, and the corpus itself is scanned once, shuffled
once (narrow columns, by arc) and joined once to the broadcast intervals, whose
number the ring's size bounds (at most four per point).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdrmill.llm.common import checkpointed, table, text_bytes

SHARDS = 40
VNODES = 128
SLICE_BITS = 12
RING_BITS = 63


def ring_position(*cols: Column) -> Column:
    """Position on the ring: 63 bits of the 64-bit hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 64 - RING_BITS)


def ring(spark: SparkSession, shards: int, vnodes: int) -> DataFrame:
    """(arc, shard, lo, hi): the points clockwise; arc ``a`` covers positions
    ``lo <= p < hi`` before point ``a``.  The stretch after the last point
    belongs to arc 0, which therefore has two rows."""
    points = (spark.range(shards * vnodes)
              .select((F.col("id") % shards).cast("int").alias("shard"),
                      ring_position(F.lit("vnode"), F.col("id") % shards,
                                    F.floor(F.col("id") / shards)).alias("hi")))
    w = Window.orderBy("hi", "shard")
    arcs = points.select((F.row_number().over(w) - 1).alias("arc"), "shard",
                         F.coalesce(F.lag("hi").over(w), F.lit(0)).alias("lo"), "hi")
    tail = (points.groupBy().agg(F.max("hi").alias("lo"), F.min(F.struct("hi", "shard")).alias("f"))
            .select(F.lit(0).alias("arc"), F.col("f.shard").alias("shard"), "lo",
                    F.lit((1 << RING_BITS) - 1).alias("hi")))
    return arcs.unionByName(tail)


def _ranked(docs: DataFrame, arcs: DataFrame) -> DataFrame:
    """Rows with their arc and their rank (from 0) inside it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", (text_bytes("text") + 16).alias("size"),
                        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    keyed = keyed.withColumn("pos", ring_position(F.col("doc_id"), F.col("text_crc32"),
                                                  F.col("size")))
    shift = RING_BITS - SLICE_BITS
    sliced = arcs.select("arc", "lo", "hi", F.explode(F.sequence(
        F.shiftright("lo", shift), F.shiftright("hi", shift))).alias("slice"))
    homes = (keyed.withColumn("slice", F.shiftright("pos", shift))
             .join(F.broadcast(sliced), "slice")  # at most arcs + 2^SLICE_BITS rows
             .where((F.col("pos") >= F.col("lo")) &
                    ((F.col("pos") < F.col("hi")) |
                     (F.col("hi") == F.lit((1 << RING_BITS) - 1)))))
    w = Window.partitionBy("arc").orderBy("pos", "doc_id", "text_crc32", "size")
    return homes.select("doc_id", "size", "text_crc32", "arc",
                        (F.row_number().over(w) - 1).cast("long").alias("rank"))


def place(ranked: DataFrame, arcs: DataFrame, shards: int, slack: float) -> DataFrame:
    """Intervals (arc, from, upto, shard, base): ranks ``from <= r < upto`` of an
    arc go to ``shard``, where they take the slots from ``base`` on.

    A shard above its capacity gives up keys evenly over its arcs (the highest
    ranks of each); a shard below it offers its room in equal parts at its
    points.  Keys given up queue clockwise and each point takes the longest
    waiting ones.  Seen from the point after which nothing waits, the queue
    after each point is the running sum of (given up - offered) above its running
    minimum, so prefix sums over the ring replace the walk.
    """
    ring_order = Window.orderBy("arc")  # one row per point: the ring's size, not the corpus's
    upto_here = ring_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_shard = Window.partitionBy("shard")
    in_shard = by_shard.orderBy("arc").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("n").over(Window.partitionBy())
    even = F.floor(total / shards) + (F.col("shard") < total % shards).cast("long")
    cap = even if slack == 0 else F.ceil(total * (1 + slack) / shards)

    def share(amount, whole, part, so_far):
        """``amount`` split over rows in proportion to ``part`` (whole numbers)."""
        return (F.floor(amount * so_far / whole)
                - F.floor(amount * (so_far - part) / whole)).cast("long")

    points = (arcs.groupBy("arc").agg(F.first("shard").alias("shard"))
              .join(ranked.groupBy("arc").agg(F.count(F.lit(1)).alias("n")), "arc", "left")
              .withColumn("n", F.coalesce("n", F.lit(0)))
              .withColumn("cap", cap.cast("long"))
              .withColumn("home", F.sum("n").over(by_shard))
              .withColumn("points", F.count(F.lit(1)).over(by_shard))
              .withColumn("nth", F.row_number().over(by_shard.orderBy("arc")))
              .withColumn("n_sofar", F.sum("n").over(in_shard)))
    over, spare = F.col("home") - F.col("cap"), F.col("cap") - F.col("home")
    points = checkpointed(
        points.withColumn("out", F.when(over > 0, share(
            over, F.col("home"), F.col("n"), F.col("n_sofar"))).otherwise(0))
        .withColumn("room", F.when(spare > 0, share(
            spare, F.col("points"), F.lit(1), F.col("nth"))).otherwise(0))
        .withColumn("flow", F.sum(F.col("out") - F.col("room")).over(upto_here))
        .withColumn("start", F.min_by("arc", F.struct("flow", "arc")).over(Window.partitionBy()))
        .select("arc", "shard", "n", "out", "room",
                (F.col("arc") <= F.col("start")).cast("int").alias("lap")))

    walk = Window.orderBy("lap", "arc").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = (points.withColumn("arrived", F.sum("out").over(walk))
              .withColumn("net", F.sum(F.col("out") - F.col("room")).over(walk))
              .withColumn("waiting", F.col("net") - F.least(F.lit(0), F.min("net").over(walk)))
              .withColumn("served", F.col("arrived") - F.col("waiting"))
              .withColumn("took", F.col("served") - F.coalesce(
                  F.lag("served").over(Window.orderBy("lap", "arc")), F.lit(0))))
    # queue numbers cut where an arc's keys begin and where a point's share begins
    begins = (queued.where("out > 0")
              .select((F.col("arrived") - F.col("out")).alias("q"),
                      F.struct("arc", (F.col("n") - F.col("out")).alias("kept"),
                               (F.col("arrived") - F.col("out")).alias("q")).alias("a"),
                      F.lit(None).cast("int").alias("s"))
              .unionByName(queued.where("took > 0").select(
                  (F.col("served") - F.col("took")).alias("q"),
                  F.lit(None).cast("struct<arc:int,kept:long,q:long>").alias("a"),
                  F.col("shard").cast("int").alias("s"))))
    end = points.agg(F.sum("out").alias("q"), F.first(F.lit(None).cast(
        "struct<arc:int,kept:long,q:long>")).alias("a"),
        F.first(F.lit(None).cast("int")).alias("s"))  # one row: where the queue ends
    cuts = begins.unionByName(end).groupBy("q").agg(F.max("a").alias("a"), F.max("s").alias("s"))
    by_q = Window.orderBy("q").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    moved = (cuts.select("q", F.last("a", ignorenulls=True).over(by_q).alias("a"),
                         F.last("s", ignorenulls=True).over(by_q).alias("shard"),
                         F.lead("q").over(Window.orderBy("q")).alias("q2"))
             .where("q2 is not null")
             .withColumn("from", F.col("a.kept") + F.col("q") - F.col("a.q"))
             .withColumn("take", F.col("q2") - F.col("q"))
             .select(F.col("a.arc").alias("arc"), "from", "take", "shard", F.lit(1).alias("turn")))
    stay = points.select("arc", F.lit(0).cast("long").alias("from"),
                         (F.col("n") - F.col("out")).alias("take"),
                         F.col("shard").cast("int").alias("shard"), F.lit(0).alias("turn"))
    earlier = (Window.partitionBy("shard").orderBy("turn", "arc", "from")
               .rowsBetween(Window.unboundedPreceding, -1))
    return (stay.unionByName(moved).where("take > 0")
            .select("arc", "from", (F.col("from") + F.col("take")).alias("upto"), "shard",
                    F.coalesce(F.sum("take").over(earlier), F.lit(0)).alias("base")))


def assign_shards(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES,
                  slack: float = 0.0) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``; other columns are ignored)
    with its shard and its gapless slot inside the shard.

    ``slack`` 0 fills all shards evenly (row counts at most one apart); with
    ``slack`` e no shard exceeds ``ceil((1 + e) * rows / shards)`` rows and fewer
    rows leave their home shard.  A row stays at home unless its shard is full.

    NULL and empty texts count 16 bytes and checksum 0; a NULL ``doc_id`` is a
    key like any other; repeated rows are placed one by one; an empty table
    gives an empty result.
    """
    arcs = checkpointed(ring(docs.sparkSession, shards, vnodes))
    ranked = checkpointed(_ranked(docs, arcs))
    parts = place(ranked, arcs, shards, slack)
    placed = (ranked.join(F.broadcast(parts), "arc")  # bounded by the ring, not the corpus
              .where((F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("upto"))))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"),
        (F.col("base") + F.col("rank") - F.col("from")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a ring of 40 shards, law ``rows``."""
    return assign_shards(table(spark, sf_dir, "documents"))
