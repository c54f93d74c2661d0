"""Exact top-k by inner product over a bit-sliced index.

Each component of a vector is an integer attribute.  A block of rows stores, per
attribute, its least value and the bits of (value - least) as slices: bitmaps with
one bit a row.  The score of all rows of a block is a sum of slices, weighted with
the bits of the query, and that sum is formed in bitmap arithmetic by full adders;
its result is again a stack of slices.  The best rows are picked from the most
significant slice downward; what is left at the boundary has one equal score and is
resolved by the smaller id.

Queries meet blocks in tiles: a block and a group of at most ``TILE_QUERIES``
queries.  A tile answers with its best rows only, never with pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdrmill.llm.common import stored, table

SCALE = 64
BLOCK_ROWS = 8192       # rows of a block (on average: rows are dealt by hash)
TILE_QUERIES = 512
EVERY = 20              # ids divisible by it are the registered query's queries
TOP = 20
LARGEST = 1 << 53       # components beyond it count as it
LONG = 1 << 63
LOW_BITS = 62           # scores go as two longs: floor(score / 2**62) and the rest
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` of doubles as longs, within +-``LARGEST``."""
    with np.errstate(over="ignore"):
        x = np.floor(values * float(scale))
    return np.clip(x, -float(LARGEST), float(LARGEST)).astype(np.int64)


def padded(vectors: list[list[float]]) -> np.ndarray:
    """Vectors as rows of one matrix; shorter ones go on with zeros."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


@dataclass
class Block:
    """Slices of one block: ``slices[start[d]:start[d + 1]]`` are those of attribute
    ``d``, least significant first; bit ``r`` of a slice belongs to ``ids[r]``
    (ids ascend)."""

    ids: np.ndarray
    least: list[int]
    start: np.ndarray
    slices: np.ndarray


def slice_block(ids: np.ndarray, x: np.ndarray) -> Block:
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    words = -(-len(ids) // 64)
    least = x.min(axis=0)
    # the difference of two longs may need 64 bits: unsigned
    up = x.astype(np.uint64) - least.astype(np.uint64)
    bits = [int(v).bit_length() for v in up.max(axis=0)]
    start = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)]).astype(np.int64)
    slices = np.zeros((int(start[-1]), words), np.uint64)
    full = np.zeros(words * 64, np.uint8)
    for d, n in enumerate(bits):
        for j in range(n):
            full[:len(ids)] = (up[:, d] >> np.uint64(j)) & np.uint64(1)
            slices[start[d] + j] = np.packbits(full, bitorder="little").view(np.uint64)
    return Block(ids, [int(v) for v in least], start, slices)


def add_slices(columns: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Sum of slices by weight: ``columns[w]`` holds matrices whose rows weigh
    ``2 ** w``.  Full adders turn three rows of one weight into a sum row and a
    carry row of the next weight until one row a weight is left."""
    out, w = [], 0
    while columns:
        rows = columns.pop(w, [])
        x = np.concatenate(rows) if len(rows) > 1 else rows[0] if rows else None
        while x is not None and len(x) > 1:
            t = len(x) // 3
            if t:
                a, b, c = x[:t], x[t:2 * t], x[2 * t:3 * t]
                odd = a ^ b
                carry = (a & b) | (c & odd)
                x = np.concatenate([odd ^ c, x[3 * t:]])
            else:
                carry = x[:1] & x[1:2]
                x = x[:1] ^ x[1:2]
            columns.setdefault(w + 1, []).append(carry)
        out.append(None if x is None else x[0])
        w += 1
    return out


def score_slices(block: Block, query: list[int]) -> tuple[list[np.ndarray], int]:
    """Slices of ``score - offset`` (never negative) for every row, and the offset.

    A negative weight takes the complement of the attribute's bits instead:
    ``-n * u = n * (most - u) - n * most``."""
    offset, picks = 0, {}
    for d, q in enumerate(query[:len(block.least)]):
        if not q:
            continue
        lo, hi, n = int(block.start[d]), int(block.start[d + 1]), abs(q)
        offset += q * block.least[d]
        if q < 0:
            offset -= n * ((1 << (hi - lo)) - 1)
        for k in range(n.bit_length()):
            if n >> k & 1:
                for s in range(lo, hi):
                    picks.setdefault(k + s - lo, ([], []))[q < 0].append(s)
    columns = {}
    for w, (plain, turned) in picks.items():
        columns[w] = ([block.slices[plain]] if plain else []) + \
            ([~block.slices[turned]] if turned else [])
    return add_slices(columns), offset


def _set_rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def best_rows(sums: list[np.ndarray], among: np.ndarray, top: int) -> np.ndarray:
    """Rows (ascending) of the ``top`` largest sums among the rows of a bitmap;
    equal sums at the boundary go to the lower rows."""
    count = lambda b: int(np.bitwise_count(b).sum())
    sure, tied = np.zeros_like(among), among
    if count(among) > top:
        for s in reversed(sums):
            if s is None:
                continue
            high = tied & s
            n = count(sure) + count(high)
            if n > top:
                tied = high
            else:
                sure, tied = sure | high, tied & ~s
                if n == top:
                    return _set_rows(sure)
    return np.sort(np.concatenate([_set_rows(sure), _set_rows(tied)[:top - count(sure)]]))


def search_block(block: Block, own: int, query: list[int], top: int) -> tuple[np.ndarray, list[int]]:
    """Ids and exact scores of the best rows of a block, without the query's own id."""
    sums, offset = score_slices(block, query)
    among = np.zeros(block.slices.shape[1] if len(block.slices) else -(-len(block.ids) // 64),
                     np.uint64)
    among[:len(block.ids) // 64] = ALL
    if len(block.ids) % 64:
        among[len(block.ids) // 64] = np.uint64((1 << len(block.ids) % 64) - 1)
    at = int(np.searchsorted(block.ids, own))
    if at < len(block.ids) and block.ids[at] == own:
        among[at // 64] &= ~np.uint64(1 << at % 64)
    rows = best_rows(sums, among, top)
    wide = len(sums) > 62 or abs(offset) >= 1 << 62
    values = np.zeros(len(rows), object if wide else np.int64)
    for w, s in enumerate(sums):
        if s is not None:
            bit = (s[rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
            values += (bit.astype(object) if wide else bit.astype(np.int64)) * (1 << w)
    return block.ids[rows], [int(v) + offset for v in values]


def _usable(vector) -> F.Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def _pack(scale: int):
    """One row a block: its ids and its slices, as the index stores them."""
    def run(group: pa.Table) -> pa.Table:
        x = quantised(padded(group["v"].to_pylist()), scale)
        b = slice_block(np.asarray(group["vec_id"].to_pylist(), np.int64), x)
        return pa.table({"block": group["block"][:1], "ids": [b.ids.tobytes()],
                         "least": [b.least], "start": [b.start.tolist()],
                         "slices": [b.slices.tobytes()]}, schema=pa.schema(
            [("block", pa.int64()), ("ids", pa.binary()), ("least", pa.list_(pa.int64())),
             ("start", pa.list_(pa.int64())), ("slices", pa.binary())]))
    return run


class SlicedIndex:
    """``blocks``: one row a block (ids, least values, slices); ``vectors``: the rows
    they were made from (vec_id, v); ``count``: how many blocks."""

    def __init__(self, blocks: DataFrame, vectors: DataFrame, count: int, scale: int):
        self.blocks, self.vectors, self.count, self.scale = blocks, vectors, count, scale


def build_index(vectors: DataFrame, scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> SlicedIndex:
    """Bit-sliced index of ``vectors`` (``vec_id`` integer, ``embedding`` array of
    numbers; other columns are ignored).

    Rows with a NULL id or vector, or a NULL or non-finite component, take no part;
    zero and empty vectors do.  Shorter vectors go on with zeros, so vectors of any
    length meet.  Where an id repeats, its smallest vector (in array order) stands
    for it.  An empty table gives an index without blocks."""
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & _usable(F.col("v")))
            .groupBy("vec_id").agg(F.min("v").alias("v")))
    rows = stored(rows, "sliced-rows")
    count = max(1, math.ceil(rows.count() / block_rows))
    blocks = (rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("long"))
              .groupBy("block").applyInArrow(
                  _pack(scale), "block long, ids binary, least array<long>, start array<long>, "
                                "slices binary"))
    return SlicedIndex(stored(blocks, "sliced-index"), rows, count, scale)


def _tile(scale: int, top: int):
    out = pa.schema([(c, pa.int64()) for c in ("query_id", "vec_id", "high", "low")])

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        found: tuple[list, list, list, list] = ([], [], [], [])
        if index.num_rows and queries.num_rows:
            ids = np.frombuffer(index["ids"][0].as_py(), np.int64)
            words = -(-len(ids) // 64)
            block = Block(ids, index["least"][0].as_py(), np.asarray(index["start"][0].as_py()),
                          np.frombuffer(index["slices"][0].as_py(), np.uint64).reshape(-1, words))
            for own, v in zip(queries["vec_id"].to_pylist(), queries["v"].to_pylist()):
                near, scores = search_block(block, own, quantised(np.asarray(v, np.float64),
                                                                  scale).tolist(), top)
                found[0].extend([own] * len(near))
                found[1].extend(near.tolist())
                found[2].extend(s >> LOW_BITS for s in scores)
                found[3].extend(s & ((1 << LOW_BITS) - 1) for s in scores)
        return pa.table(dict(zip(out.names, found)), schema=out)
    return run


def search(index: SlicedIndex, queries: DataFrame, top: int = TOP,
           tile_queries: int = TILE_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each of ``queries`` (vec_id, v as in
    ``index.vectors``, ids distinct) the ``top`` rows of the index with the highest
    inner product of the quantised vectors, ties to the smaller id, the query's own
    id left out; fewer candidates give fewer rows.  Scores are ranked exactly; one beyond
    a long's range is given as the nearest long."""
    groups = max(1, math.ceil(queries.count() / tile_queries))
    blocks = index.blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = (queries.select("vec_id", "v",
                            F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("part"))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"),
                                                       F.lit(index.count - 1).cast("long")))))
    best = blocks.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(
        _tile(index.scale, top), "query_id long, vec_id long, high long, low long")
    order = Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    score = (F.when(F.col("high") > 1, F.lit(LONG - 1)).when(F.col("high") < -2, F.lit(-LONG))
             .otherwise(F.col("high") * F.lit(1 << LOW_BITS) + F.col("low")))
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", score.alias("score")))


def highest_products(vectors: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """:func:`search` over all ``vectors`` with the rows whose id is divisible by
    ``every`` as queries."""
    index = build_index(vectors)
    return search(index, index.vectors.where(F.col("vec_id") % every == 0), top)


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty highest integer inner products of every twentieth vector."""
    return highest_products(table(spark, sf_dir, "embeddings"))
