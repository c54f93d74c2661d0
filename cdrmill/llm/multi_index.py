"""Nearest neighbours with an inverted multi-index.

The two halves of the vectors are quantised separately, so ``K`` centroids per
half make ``K * K`` cells.  A query walks pairs of centroids in order of their
summed distance, with a heap, until the cells met hold enough vectors; all
vectors of those cells are then ranked by their exact distance.

The walk's outcome is short: per first-half centroid one bit mask of the
second-half centroids.  Vectors are grouped by first centroid and block (at most
``BLOCK_ROWS`` each, so a hot centroid is split), a block is held as one matrix
and the queries that ask for it stream by.  Each block answers with its nearest
few, never with pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdrmill.llm.common import stored, table

K = 64                   # centroids per half; a mask of them fits a long
SAMPLE_ROWS = 20_000     # the centroids are fitted on the first rows by hash
LLOYD_ROUNDS = 12
BLOCK_ROWS = 2048
TOP = 10
# Share of all vectors a query ranks.  The vectors here are nearly isotropic in 64
# dimensions, where no index can look at much less for a recall of 0.9.
SHARE = 0.45


def usable(vector: Column) -> Column:
    """Vectors that take part: no NULL or non-finite component, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(raw: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), dim)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2.0 * x @ c.T


def fit_half(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """At most ``k`` centroids of a bounded sample (Lloyd's rounds)."""
    distinct = np.unique(x, axis=0)
    c = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(LLOYD_ROUNDS):
        near = _squared(x, c).argmin(1)
        sums, n = np.zeros_like(c), np.bincount(near, minlength=len(c))
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def as_doubles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [np.asarray(v, np.float64).tobytes() for v in batch.column("v").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(raw, pa.binary())],
                                         ["vec_id", "v"])


class MultiIndex:
    """A fitted index: ``rows`` (vec_id, v as doubles, c1, c2, block), the
    centroids of both halves and the number of vectors in each cell."""

    def __init__(self, rows: DataFrame, halves: list[np.ndarray], cells: np.ndarray, dim: int,
                 blocks: dict[int, int]):
        self.rows, self.halves, self.cells, self.dim, self.blocks = rows, halves, cells, dim, blocks

    @property
    def size(self) -> int:
        return int(self.cells.sum())


def build_index(vectors: DataFrame) -> MultiIndex | None:
    """Index the usable rows of ``vectors`` (``vec_id`` integer, ``embedding``
    array of numbers).  Rows with a NULL id, an unusable vector, or another length
    than most vectors take no part.  None if no row is left."""
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & usable(F.col("v"))))
    common = (rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.desc("dim")).first())
    if common is None:
        return None
    dim, half = common["dim"], common["dim"] // 2
    rows = rows.where(F.size("v") == dim).mapInArrow(as_doubles, "vec_id long, v binary")
    sample = _matrix([bytes(r["v"]) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v")
                      .limit(SAMPLE_ROWS).select("v").collect()], dim)  # bounded
    rng = np.random.default_rng(11)
    halves = [fit_half(sample[:, :half], K, rng), fit_half(sample[:, half:], K, rng)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix([v.as_py() for v in batch.column("v")], dim)
            c1 = _squared(x[:, :half], halves[0]).argmin(1)
            c2 = _squared(x[:, half:], halves[1]).argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(c1, pa.int32()), pa.array(c2, pa.int32())],
                ["vec_id", "v", "c1", "c2"])

    rows = stored(rows.mapInArrow(assign, "vec_id long, v binary, c1 int, c2 int"), "multi-index")
    cells = np.zeros((K, K), np.int64)
    for r in rows.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).collect():  # K x K at most
        cells[r["c1"], r["c2"]] = r["n"]
    blocks = {i: max(1, -(-int(n) // BLOCK_ROWS)) for i, n in enumerate(cells.sum(1))}
    return MultiIndex(rows, halves, cells, dim, blocks)


def walk(d1: np.ndarray, d2: np.ndarray, cells: np.ndarray, enough: int) -> dict[int, int]:
    """Cells in order of ``d1[i] + d2[j]`` until they hold ``enough`` vectors, as a
    mask of ``j`` for each ``i``."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    a, b, n = d1[o1].tolist(), d2[o2].tolist(), cells[np.ix_(o1, o2)].tolist()
    o1, o2 = o1.tolist(), o2.tolist()
    heap, next_j, met, masks = [(a[0] + b[0], 0, 0)], [0] * len(a), 0, {}
    while heap and met < enough:
        _, i, j = heapq.heappop(heap)
        next_j[i] = j + 1
        if n[i][j]:
            met += n[i][j]
            masks[o1[i]] = masks.get(o1[i], 0) | 1 << o2[j]
        # a pair enters once both pairs before it (less i, less j) are out
        if i + 1 < len(a) and next_j[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or next_j[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
    return masks


def _probe(index: MultiIndex, enough: int):
    halves, cells, half, blocks = index.halves, index.cells, index.dim // 2, index.blocks
    cells = cells[:len(halves[0]), :len(halves[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, c1s, parts, masks, vs = [], [], [], [], []
            for q, raw in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.frombuffer(raw, np.float64)[None]
                found = walk(_squared(x[:, :half], halves[0])[0],
                             _squared(x[:, half:], halves[1])[0], cells, enough)
                for c1, mask in found.items():
                    mask -= (mask >> 63) << 64  # as a signed long
                    for block in range(blocks[c1]):
                        ids.append(q)
                        c1s.append(c1)
                        parts.append(block)
                        masks.append(mask)
                        vs.append(raw)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c1s, pa.int32()), pa.array(parts, pa.int32()),
                 pa.array([1] * len(ids), pa.int32()), pa.array(ids, pa.int64()),
                 pa.array(masks, pa.int64()), pa.array(vs, pa.binary())],
                ["c1", "block", "role", "id", "mask", "v"])
    return run


def _rank(dim: int, top: int):
    out_names = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, c2s, raw, matrix = None, [], [], [], None
        for batch in batches:
            found: tuple[list, list, list] = ([], [], [])
            for c1, block, role, vid, mask, v in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (c1, block):
                    at, ids, c2s, raw, matrix = (c1, block), [], [], [], None
                if role == 0:  # a vector of the block; its second centroid stands in mask
                    ids.append(vid)
                    c2s.append(mask)
                    raw.append(v)
                    continue
                if matrix is None:
                    if not ids:
                        continue
                    matrix = _matrix(raw, dim), np.array(ids), np.array(c2s, np.int64)
                    raw = []
                x, n, c2 = matrix
                asked = np.flatnonzero(((mask >> c2) & 1).astype(bool) & (n != vid))
                d = x[asked] - np.frombuffer(v, np.float64)
                d = np.sqrt((d * d).sum(1))
                best = np.lexsort((n[asked], d))
                kept, seen = [], set()
                for k in best:  # repeated ids count once
                    if (i := int(n[asked[k]])) not in seen:
                        seen.add(i)
                        kept.append(k)
                        if len(kept) == top:
                            break
                found[0].extend([vid] * len(kept))
                found[1].extend(n[asked[kept]].tolist())
                found[2].extend(d[kept].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()),
                 pa.array(found[2], pa.float64())], out_names)
    return run


def search(index: MultiIndex, queries: DataFrame, top: int = TOP,
           share: float = SHARE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` nearest vectors found for each
    of ``queries`` (rows of the index: vec_id, v), nearest first, ties to the
    smaller id; ``score`` is the Euclidean distance in double precision.  A
    query is no candidate of its own; fewer candidates give fewer rows.  Repeated
    ids are one candidate (the nearest) and one query."""
    enough = max(top + 1, int(np.ceil(share * index.size)))
    probes = queries.dropDuplicates(["vec_id"]).select("vec_id", "v").mapInArrow(
        _probe(index, enough), "c1 int, block int, role int, id long, mask long, v binary")
    per_c1 = F.element_at(F.array(*[F.lit(index.blocks[i]) for i in range(K)]), F.col("c1") + 1)
    held = index.rows.select(
        "c1", F.pmod(F.xxhash64("vec_id", "v"), per_c1).cast("int").alias("block"),
        F.lit(0).alias("role"), F.col("vec_id").alias("id"), F.col("c2").cast("long").alias("mask"),
        "v")
    near = (held.unionByName(probes).repartition("c1", "block")
            .sortWithinPartitions("c1", "block", "role")
            .mapInArrow(_rank(index.dim, top), "query_id long, vec_id long, score double"))
    best = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(vectors: DataFrame, every: int = 100, top: int = TOP) -> DataFrame:
    """``search`` with the rows whose id is divisible by ``every`` as queries."""
    index = build_index(vectors)
    if index is None:
        return vectors.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double")
    return search(index, index.rows.where(F.col("vec_id") % every == 0), top)


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest neighbours of every hundredth vector."""
    return nearest(table(spark, sf_dir, "embeddings"))
