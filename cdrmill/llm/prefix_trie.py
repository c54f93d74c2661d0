"""Prefix trie of conversations from vertical bitmaps.

Conversations are rebuilt first: each begins with some turns of the first one of its
group.  Conversations are then dealt to shards (ranges of ``SHARD_CONVS`` ids that
exist) and their turns to bands of ``BAND_TURNS`` positions, so neither a copied nor a
very long conversation makes a large group.  In a shard and band, an index maps
(position, turn) to the bitset of conversations that have it there.  Depth first, a
node's bitset is intersected with the postings of the next position: each
intersection is a child, its popcount the members, and the members with no further
turn are the node's end list.

A node's key is the exclusive or of hashes of (position, turn) along its path, so
the same node has the same key in every shard, and a band goes on where the one
before it ended.  Shards' nodes are merged by key: least member, popcounts, and the
end lists in shard order, which is id order.

Subtree sums are sums over members.  Each node is owned by its least member, and a
conversation owns its path from some depth on.  Per node, leaves are the members
that own a childless node; saved tokens are the words that members do not own from
this depth on.  Both come from the bitsets in a second descent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdrmill.llm.common import stored, table
from cdrmill.operators.lookup import sized_broadcast

GROUP = 20            # conversation c begins like conversation c - c % GROUP ...
MOST_SHARED = 4       # ... with crc32(c) % MOST_SHARED of its turns
SHARD_CONVS = 1024
BAND_TURNS = 256
END_IDS = 512         # ids of an end list in one row
SALTS = 32
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "k1", "k2"]


def _base(conv: Column) -> Column:
    return conv - conv % F.lit(GROUP)


def _shared(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % F.lit(MOST_SHARED)).cast("long")


def ranked(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns in order without a window over a conversation: a range sort numbers the
    rows of each partition, and per conversation and partition the number of rows
    before it is kept.  Returns the rows (conv, pid, seq, turn digest, words) and the
    spans (conv, pid, lo, n, before)."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn_no"),
        role.alias("role_text"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
                      .cast("binary"))).alias("turn"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("at")).where(F.col("conv").isNotNull())
    order = ["conv", F.asc_nulls_first("turn_no"), "role_text", "turn", "at"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(rows.select("conv", F.spark_partition_id().alias("pid"),
                              F.monotonically_increasing_id().alias("seq"), "turn", "words"),
                  "trie-turns")
    before = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = (rows.groupBy("conv", "pid").agg(F.min("seq").alias("lo"), F.count(F.lit(1)).alias("n"))
             .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    return rows, stored(spans, "trie-spans")


def rebuilt(conversations: DataFrame, shard_convs: int = SHARD_CONVS,
            band_turns: int = BAND_TURNS) -> tuple[DataFrame, DataFrame]:
    """Members (conv, shard, length) and their turns (shard, band, conv, pos, k1, k2,
    words), where pos counts from 1."""
    rows, spans = ranked(conversations)
    convs = spans.groupBy("conv").agg(F.sum("n").alias("own"))
    bases = convs.where(F.col("conv") % GROUP == 0).select(
        F.col("conv").alias("base"), F.col("own").alias("base_own"))
    members = (convs.withColumn("base", _base(F.col("conv"))).join(bases, "base", "left")
               .withColumn("h", _shared(F.col("conv")))
               .withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0)))))
    # ranges of ids that exist, shard_convs at most in each, ascending
    members = members.repartitionByRange("conv").sortWithinPartitions("conv").select(
        "conv", "base", "h", "taken", "own",
        (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"),
        F.expr(f"monotonically_increasing_id() div {shard_convs}").alias("shard"))
    members = stored(members, "trie-members")

    placed = spans.select("conv", "pid", "lo", "before")
    own = (rows.join(placed.join(members, "conv"), ["conv", "pid"])
           .withColumn("at", F.col("seq") - F.col("lo") + F.col("before") + 1)
           .where(F.col("at") > F.col("h"))
           .withColumn("pos", F.col("at") - F.col("h") + F.col("taken")))
    heads = (rows.where(F.col("conv") % GROUP == 0).join(placed, ["conv", "pid"])
             .withColumn("pos", F.col("seq") - F.col("lo") + F.col("before") + 1)
             .where(F.col("pos") < MOST_SHARED)
             .select(F.col("conv").alias("base"), "pos", "turn", "words"))
    shared = members.join(heads, "base").where(F.col("pos") <= F.col("h"))
    out = ["shard", "conv", "length", "pos", "turn", "words"]
    turns = own.select(*out).unionByName(shared.select(*out))
    half = lambda n: F.xxhash64(F.col("pos"), F.substring("turn", n, 8))
    turns = turns.select(
        "shard", F.expr(f"(pos - 1) div {band_turns}").alias("band"), "conv", "length", "pos",
        half(1).alias("k1"), half(9).alias("k2"), "words")
    return members, stored(turns, "trie-index")


def band_starts(members: DataFrame, turns: DataFrame, band_turns: int = BAND_TURNS) -> DataFrame:
    """Where each conversation enters each band: the key and the words of its path so
    far.  Conversations longer than a band give one row for ``band_turns`` turns."""
    whole_bands = (turns.where(F.col("length") > band_turns)
                   .groupBy("shard", "conv", "length", "band")
                   .agg(F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"),
                        F.sum("words").alias("w")))
    so_far = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    later = whole_bands.select(
        "shard", "band", "conv", "length", F.bit_xor("x1").over(so_far).alias("k1"),
        F.bit_xor("x2").over(so_far).alias("k2"), F.sum("w").over(so_far).alias("words"))
    zero = F.lit(0).cast("long")
    first = members.select("shard", zero.alias("band"), "conv", "length", zero.alias("k1"),
                           zero.alias("k2"), zero.alias("words"))
    return first.unionByName(later.where(F.col("band") > 0))


class Shard:
    """The index of one shard and band: bitsets (whole numbers, bit i for the i-th
    conversation by id) of (position, turn)."""

    def __init__(self, depth: int, starts: dict, turns: dict):
        order = np.argsort(starts["conv"], kind="stable")
        pick = lambda c: np.asarray(starts[c])[order].tolist()
        self.convs, self.length = pick("conv"), pick("length")
        self.depth = depth  # of the starts
        at = {c: i for i, c in enumerate(self.convs)}
        self.path: list[list] = [[] for _ in self.convs]   # turns of each conversation
        self.postings: dict[tuple, int] = {}
        self.open: list[int] = []                          # per position: who has a turn there
        for i, (conv, pos, k1, k2, words) in sorted(
                (at[c], t) for c, t in zip(turns["conv"], zip(*turns.values()))):
            self.path[i].append((k1, k2, words))
            bit = 1 << i
            key = (pos, k1, k2)
            self.postings[key] = self.postings.get(key, 0) | bit
            n = pos - self.depth
            while len(self.open) < n:
                self.open.append(0)
            self.open[n - 1] |= bit
        self.open.append(0)
        self.ends: dict[int, int] = {}
        for i, n in enumerate(self.length):
            self.ends[n] = self.ends.get(n, 0) | 1 << i
        self.start: dict[tuple, int] = {}
        for i, k in enumerate(zip(pick("k1"), pick("k2"), pick("words"))):
            self.start[k] = self.start.get(k, 0) | 1 << i

    def nodes(self) -> Iterator[tuple]:
        """Depth first: depth, key, parent's key, bitset, words of the last turn and of
        the whole path.  The start of a later band belongs to the band before it."""
        stack = []
        for (k1, k2, words), members in self.start.items():
            if not self.depth:
                yield 0, k1, k2, None, None, members, 0, 0
            stack.append((self.depth, k1, k2, members, words))
        while stack:
            depth, k1, k2, members, so_far = stack.pop()
            n = depth - self.depth
            rest = members & self.open[n]
            while rest:
                first = (rest & -rest).bit_length() - 1
                t1, t2, words = self.path[first][n]
                child = members & self.postings[depth + 1, t1, t2]
                rest &= ~child
                c1, c2, total = k1 ^ t1, k2 ^ t2, so_far + words
                yield depth + 1, c1, c2, k1, k2, child, words, total
                if n + 2 < len(self.open):
                    stack.append((depth + 1, c1, c2, child, total))

    def members(self, bits: int) -> list[int]:
        """Positions of the set bits, ascending."""
        out = []
        while bits:
            low = bits & -bits
            out.append(low.bit_length() - 1)
            bits ^= low
        return out


def _shard_of(group: pa.Table, band_turns: int) -> Shard:
    cols = {c: group[c].to_pylist() for c in ("conv", "length", "pos", "k1", "k2", "words")}
    start = [i for i, p in enumerate(cols["pos"]) if p is None]
    turn = [i for i, p in enumerate(cols["pos"]) if p is not None]
    return Shard(group["band"][0].as_py() * band_turns,
                 {c: [v[i] for i in start] for c, v in cols.items()},
                 {c: [cols[c][i] for i in turn] for c in ("conv", "pos", "k1", "k2", "words")})


SHARD_NODES = ("depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, "
               "words long, path_words long, shard long, piece int, n_ends long, ends string")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _shard_nodes(band_turns: int):
    def run(group: pa.Table) -> pa.Table:
        s, shard, rows = _shard_of(group, band_turns), group["shard"][0].as_py(), []
        for depth, k1, k2, p1, p2, bits, words, total in s.nodes():
            ids = [s.convs[i] for i in s.members(bits & s.ends.get(depth, 0))]
            least = s.convs[(bits & -bits).bit_length() - 1]
            rows.append((depth, k1, k2, p1, p2, least, bits.bit_count(), words, total, shard, 0,
                         len(ids), ",".join(map(str, ids[:END_IDS])) if ids else None))
            for piece, i in enumerate(range(END_IDS, len(ids), END_IDS), 1):
                rows.append((depth, k1, k2, p1, p2, least, 0, words, total, shard, piece, 0,
                             ",".join(map(str, ids[i:i + END_IDS]))))
        return _columns(rows, _arrow(SHARD_NODES))
    return run


MERGED = ("depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, "
          "n_ends long, words long, path_words long, ends_sha256 string")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of all shards, sorted by key, shard and piece, to one row a node; end
    lists run through the digest piece by piece."""
    schema = _arrow(MERGED)
    key, node, digest, listed = None, None, None, False

    def done() -> tuple:
        return (*node, digest.hexdigest())

    for batch in batches:
        out = []
        for (depth, k1, k2, p1, p2, conv, n, words, total, _, _, n_ends, ends) in zip(
                *(c.to_pylist() for c in batch.columns)):
            if (depth, k1, k2) != key:
                if node:
                    out.append(done())
                key = (depth, k1, k2)
                node = [depth, k1, k2, p1, p2, conv, 0, 0, words, total]
                digest, listed = hashlib.sha256(), False
            node[5] = min(node[5], conv)
            node[6] += n
            node[7] += n_ends
            if ends is not None:
                digest.update((("," if listed else "") + ends).encode())
                listed = True
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    if node:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(done(), schema)], schema=schema)


SUMS = "depth long, k1 long, k2 long, n_leaves long, saved_tokens long, top long"


def _subtree_sums(band_turns: int):
    """Second descent.  Start rows carry, per conversation, from which depth it owns
    its path (``owns``), the words before that (``unowned``) and whether it owns a
    childless node (``leaf``).  ``top`` is 1 where the owner's part begins; only the
    owner's shard can say so, as others' members begin deeper."""
    def run(group: pa.Table) -> pa.Table:
        s, rows = _shard_of(group, band_turns), []
        at = {c: i for i, c in enumerate(s.convs)}
        owns, unowned = [0] * len(at), [0] * len(at)
        leaves, later = 0, {}
        for conv, o, u, leaf in zip(*(group[c].to_pylist()
                                      for c in ("conv", "owns", "unowned", "leaf"))):
            if o is not None:
                i = at[conv]
                owns[i], unowned[i] = o, u
                leaves |= leaf << i
        for depth, k1, k2, _, _, bits, words, total in s.nodes():
            if depth not in later:
                later[depth] = sum(1 << i for i, o in enumerate(owns) if o > depth)
            others = bits & later[depth]
            saved = (sum(unowned[i] for i in s.members(others))
                     - others.bit_count() * (total - words))
            least = (bits & -bits).bit_length() - 1
            rows.append((depth, k1, k2, (bits & leaves).bit_count(), saved,
                         int(owns[least] == depth)))
        return _columns(rows, _arrow(SUMS))
    return run


def prefix_trie(conversations: DataFrame, shard_convs: int = SHARD_CONVS,
                band_turns: int = BAND_TURNS) -> DataFrame:
    """One row per node of the trie of rebuilt ``conversations`` (conv_id, turn, role,
    text; other columns are ignored): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are in order of ``turn``, NULL first, equal ones by role and then by the
    digest of role and text; repeated rows are turns of their own.  NULL role or
    text counts as empty, rows without a conv_id take no part.  ``c % 20`` has the
    sign of ``c``, as in SQL.  Texts of any length count whole and are not kept.  An
    empty table has no node, not even a root."""
    members, turns = rebuilt(conversations, shard_convs, band_turns)
    starts = band_starts(members, turns, band_turns)
    none = F.lit(None).cast("long")
    rows = turns.select("shard", "band", "conv", "length", "pos", "k1", "k2", "words")
    gate = ["shard", "band", "conv", "length", "pos", "k1", "k2", "words"]
    entry = starts.withColumn("pos", none)
    found = (rows.unionByName(entry.select(gate)).groupBy("shard", "band")
             .applyInArrow(_shard_nodes(band_turns), SHARD_NODES))
    by_key = [*NODE, "shard", "piece"]
    nodes = stored(found.repartition(*NODE).sortWithinPartitions(*by_key)
                   .mapInArrow(_merge, MERGED), "trie-nodes")

    # per conversation: from where it owns its path, and what it does not own
    owned = nodes.groupBy(F.col("conv_id").alias("conv")).agg(
        F.min(F.struct("depth", (F.col("path_words") - F.col("words")).alias("unowned"))).alias("top"),
        F.max((F.col("n_convs") == F.col("n_ends")).cast("long")).alias("leaf"))
    words = turns.groupBy("conv").agg(F.sum("words").alias("all_words"))
    flags = (members.select("conv", "length").join(words, "conv", "left").join(owned, "conv", "left")
             .select("conv", F.coalesce("top.depth", F.col("length") + 1).alias("owns"),
                     F.coalesce("top.unowned", "all_words", F.lit(0)).alias("unowned"),
                     F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf")))
    extra = [none.alias(c) for c in ("owns", "unowned", "leaf")]
    entry = entry.join(flags, "conv").select(*gate, "owns", "unowned", "leaf")
    sums = (rows.select(*gate, *extra).unionByName(entry).groupBy("shard", "band")
            .applyInArrow(_subtree_sums(band_turns), SUMS))

    # one grouping brings a node's own row, its children and its sums together
    children = nodes.where(F.col("depth") > 0).groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    own = ["conv_id", "p1", "p2", "n_convs", "ends_sha256"]
    added = ["n_children", "n_leaves", "saved_tokens", "top"]
    full = stored(
        nodes.select(*NODE, *own).unionByName(children, True)
        .unionByName(sums, True).groupBy(*NODE).agg(
            *[F.max(c).alias(c) for c in own],
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in added]), "trie-full")

    # Below the first node that a conversation owns the parent is its own, too.  Only
    # the first one looks its parent up, among nodes with several members, salted:
    # very many conversations may leave the path at one node.
    inner = full.where(F.col("top") == 0).withColumn("parent_conv_id", F.col("conv_id"))
    salt = F.pmod(F.xxhash64("conv_id"), F.lit(SALTS))
    shared, _ = sized_broadcast(
        full.where((F.col("n_convs") > 1) & (F.col("n_children") > 0)).select(
            (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
            F.col("conv_id").alias("parent_conv_id"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")))
    outer = (full.where(F.col("top") > 0).withColumn("salt", salt)
             .join(shared, ["depth", "p1", "p2", "salt"], "left"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256"]
    return inner.select(*out).unionByName(outer.select(*out))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))
