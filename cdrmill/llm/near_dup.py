"""Near-duplicate documents by improved consistent weighted sampling (ICWS).

A text is the weighted set of its shingles of five lower-cased words, with
weight ``tf * (1 + idf)``; ``idf`` in (0, 1] comes from document frequencies
counted exactly over all documents: blocks of documents send their distinct
shingles, packed, to ranges of the hash space and get back their frequencies in
the same order.  The inverse frequency is
damped so that a group of thousands of copies does not make its own text
worthless against the few words edited in it.

ICWS draws per hash function one (shingle, level) sample; two texts draw the
same with probability equal to their weighted Jaccard similarity.  Bands of
samples make candidates, each compared on the whole texts:

* every bucket's members against its most central member (the one whose buckets
  are fullest: the original rather than an edit), one text stream per
  representative, split over tasks where it has many members;
* then, where a bucket still holds several connected classes, the members of
  different classes against one another.  In a crowded bucket most of these
  pairs can't reach the threshold, and an exact filter keeps them from being
  made: two texts that do must share a shingle among their rarest ones, up to a
  fifth of their weight, and have enough weight from the first such one on.

None is tested inside a class that is connected already, so ``links`` counts the
links tested, not all there are.  One filter of the second round is not exact:
pairs whose 36 samples agree in fewer than half (``AGREE``) are not compared.  It
loses a pair at 0.8 that shares a band with a probability of 2.3e-6, beside the
1.8e-4 of sharing no band at all.  No other link between bucket members is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrmill.llm.common import checkpointed, fresh, stored, table, text_key
from cdrmill.operators.lookup import sized_broadcast

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 3           # a pair at 0.8 shares a bucket with probability 0.9998
HASHES = BANDS * ROWS
DF_BITS = 20
DF_BLOCK = 1 << 14
BLOCK_JOBS = 8                # parts in which the driver fetches a table of frequencies
RARITY_ROWS = 3               # tables that must all have met a shingle again in a crowd
AGREE = 0.5                   # share of samples that a later-round candidate must agree on
MEMBERS_PER_TASK_SLICE = 256
CROWD = 64                    # from so many members on a bucket's pairs are filtered first
PAIRS_SLICE = 512             # rows of one key that a task pairs with the others at a time
COLUMNS_AT_ONCE = 4096
BLOCKS, BLOCK_BYTES = 512, 8 << 20  # blocks of documents: at least, and text for one
PARTS, PART_BYTES = 64, 24 << 20    # ranges of the hash space: at least, and text for one
SORTED_AT_ONCE = 1 << 18            # shingles of one sort within such a range
BROADCAST_BYTES = 32 << 20

_U = np.uint64
_PRIME = 0x9E3779B97F4A7C15
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_MULT = _rng.integers(1, 1 << 63, SHINGLE, dtype=_U) * _U(2) + _U(1)
_SEED = _rng.integers(1, 1 << 63, (2, HASHES, 1), dtype=_U) * _U(2) + _U(1)
_powers = [np.ones(1, _U), np.ones(1, _U)]  # of _PRIME and of its inverse, modulo 2^64


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_PRIME, pow(_PRIME, -1, 1 << 64))):
            t = np.full(size, base, _U)
            t[0] = 1
            _powers[k] = np.multiply.accumulate(t)
    return _powers


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (sorted) and how often each occurs.  A text of
    fewer than five words is one shingle; a text without words has none."""
    data = np.frombuffer(" ".join(text.lower().split()).encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.empty(0, _U), np.empty(0, np.int64)
    power, inverse = _power_tables(len(data) + 1)
    total = np.concatenate((np.zeros(1, _U), np.cumsum(_BYTE[data] * power[:len(data)], dtype=_U)))
    gaps = np.flatnonzero(data == 32)
    first, end = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(data)]))
    words = _mixed((total[end] - total[first]) * inverse[first])  # the same wherever a word stands
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, _U)
    for k in range(width):
        out += words[k:k + n] * _MULT[k]
    return np.unique(_mixed(out), return_counts=True)


def weights(keys: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return tf * (1.0 + idf[places(keys, 0)])


def exact_weights(tf: np.ndarray, df: np.ndarray, n: int) -> np.ndarray:
    """Weights by the shingles' frequencies in ``n`` documents."""
    return tf * (1.0 + np.log((1.0 + n) / df) / np.log(1.0 + n))


def packed(counts: np.ndarray) -> bytes:
    """Counts as bytes, behind the width of one in bytes."""
    most = int(counts.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as their gaps, high bytes apart from low ones, so that they compress."""
    return np.diff(keys, prepend=_U(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked_keys(raw: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8")
    return np.cumsum(gaps.ravel(), dtype=_U)


def icws(keys: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The ``HASHES`` samples of a weighted set, each a 32-bit hash of the drawn
    shingle and its level."""
    best = np.full(HASHES, np.inf)
    drawn = np.zeros(HASHES, _U)
    rows = np.arange(HASHES)
    for at in range(0, len(keys), COLUMNS_AT_ONCE):
        k, log_w = keys[None, at:at + COLUMNS_AT_ONCE], np.log(weight[at:at + COLUMNS_AT_ONCE])
        a, b = _mixed(k * _SEED[0]), _mixed(k ^ _SEED[1])
        # r and c: Gamma(2, 1) as minus the log of two uniforms' product; beta: uniform
        r = -np.log(((a >> _U(32)).astype(np.float64) + 0.5)
                    * ((a & _U(0xFFFFFFFF)).astype(np.float64) + 0.5) * 2.0 ** -64)
        low21 = _U((1 << 21) - 1)
        c = -np.log(((b >> _U(43)).astype(np.float64) + 0.5)
                    * (((b >> _U(22)) & low21).astype(np.float64) + 0.5) * 2.0 ** -42)
        beta = ((b & low21).astype(np.float64) + 0.5) * 2.0 ** -21
        level = np.floor(log_w / r + beta)
        cost = np.log(c) - r * (level - beta + 1.0)
        least = cost.argmin(axis=1)
        now = cost[rows, least]
        better = now < best
        best[better] = now[better]
        sample = _mixed(k[0, least] ^ (level[rows, least].astype(np.int64).astype(_U) * _U(_PRIME)))
        drawn[better] = sample[better]
    return (drawn >> _U(32)).astype(np.uint32).view(np.int32)


def weighted_jaccard(a: tuple, b: tuple) -> float:
    """Of two (keys, weights) with sorted distinct keys."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    x, y = a[1][i], b[1][j]
    both = np.minimum(x, y).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


# -- document frequencies ---------------------------------------------------

def places(keys: np.ndarray, row: int) -> np.ndarray:
    """Where shingles count in a row of a table (each row uses other hash bits)."""
    return ((keys >> _U(DF_BITS * row)) & _U((1 << DF_BITS) - 1)).astype(np.int64) \
        + (row << DF_BITS)


def _count_partition(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, docs = np.zeros(rows << DF_BITS, np.int64), 0
        for batch in batches:
            found, held = [], 0
            for text in batch.column(0):
                if (t := text.as_py()) is None:
                    continue
                docs += 1
                keys = shingles(t)[0]
                found += [places(keys, r) for r in range(rows)]
                held += rows * len(keys)
                if held > 1 << 19:
                    counts += np.bincount(np.concatenate(found), minlength=len(counts))
                    found, held = [], 0
            if found:
                counts += np.bincount(np.concatenate(found), minlength=len(counts))
        if docs:
            blocks = [counts[i:i + DF_BLOCK] for i in range(0, len(counts), DF_BLOCK)]
            blocks.append(np.array([docs], np.int64))
            for i, b in enumerate(blocks):
                yield pa.RecordBatch.from_pydict({"block": pa.array([i], pa.int32()),
                                                  "counts": pa.array([b.tobytes()], pa.binary())})
    return run


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}  # a fixed number of fixed-size blocks
    for batch in batches:
        for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            block = np.frombuffer(raw, np.int64)
            sums[i] = sums[i] + block if i in sums else block
    for i, b in sums.items():
        yield pa.RecordBatch.from_pydict({"block": pa.array([i], pa.int32()),
                                          "counts": pa.array([b.tobytes()], pa.binary())})


def _damped(n: int):
    """Damped inverse frequencies in ``n`` documents of summed blocks, as float32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                df = np.frombuffer(raw.as_buffer(), np.int64)
                idf = np.log((1.0 + n) / np.minimum(np.maximum(df, 1), n)) / np.log(1.0 + n)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([i], pa.int32()),
                    "idf": pa.array([idf.astype(np.float32).tobytes()], pa.binary())})
    return run


def idf_table(docs: DataFrame, rows: int = 1) -> np.ndarray:
    """Damped inverse document frequency per hash bucket, in (0, 1]: 1 for a
    bucket seen once, near 0 for one in every document.  ``rows`` tables of other
    hash bits stand one after another; a shingle is at least as rare as the rarest
    of its buckets says.  Partitions count into arrays that are added up block by
    block; 4 MB a row reach the driver, a few blocks at a time."""
    schema = "block int, counts binary"
    n_blocks = (rows << DF_BITS) // DF_BLOCK
    sums = checkpointed(docs.select("text").mapInArrow(_count_partition(rows), schema)
                        .repartition(64, "block").mapInArrow(_add_blocks, schema))
    counted = sums.where(F.col("block") == n_blocks).first()
    out = np.ones(rows << DF_BITS, np.float32)
    if counted is None:
        return out
    n = int(np.frombuffer(bytes(counted["counts"]), np.int64)[0])
    idf = (sums.where(F.col("block") < n_blocks).coalesce(BLOCK_JOBS)
           .mapInArrow(_damped(n), "block int, idf binary"))
    for r in idf.toLocalIterator():
        out[r["block"] * DF_BLOCK:(r["block"] + 1) * DF_BLOCK] = np.frombuffer(r["idf"], np.float32)
    return out


def _distinct(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([np.empty(0, _U), *sets]), return_counts=True)


def _pieces(parts: int):
    """(block, part, keys, df): the distinct shingles of a block of documents in one
    range of the hash space, and how many of those documents have each.  The rows of
    a block come one after another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece(block: int, found: list[np.ndarray]) -> pa.RecordBatch:
            keys, counts = _distinct(found)
            part = ((keys >> _U(32)) * _U(parts)) >> _U(32)
            first = np.flatnonzero(np.diff(part, prepend=_U(parts)))
            ends = np.append(first[1:], len(keys))
            return pa.RecordBatch.from_arrays(
                [pa.array([block] * len(first), pa.int64()), pa.array(part[first], pa.int32()),
                 pa.array([packed_keys(keys[i:j]) for i, j in zip(first, ends)], pa.binary()),
                 pa.array([packed(counts[i:j]) for i, j in zip(first, ends)], pa.binary())],
                ["block", "part", "keys", "df"])

        at, found = None, []
        for batch in batches:
            for block, text in zip(batch.column("block").to_pylist(), batch.column("text")):
                if block != at and found:
                    yield piece(at, found)
                    found = []
                at = block
                if (t := text.as_py()) is not None:
                    found.append(shingles(t)[0])
        if found:
            yield piece(at, found)
    return run


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    """For each piece (sorted keys and their counts) the sums over all pieces, in the
    order of its keys.  Keys are compared a stretch at a time, so what is sorted
    at once stays small beside the pieces."""
    out = [np.zeros(len(k), np.int64) for k in keys]
    n = max(1, sum(map(len, keys)) // SORTED_AT_ONCE)
    low = min((k[0] for k in keys if len(k)), default=_U(0))
    high = max((k[-1] for k in keys if len(k)), default=_U(0))
    cuts = np.array([int(low) + (int(high) - int(low)) * i // n for i in range(1, n)], _U)
    at = [np.concatenate([[0], np.searchsorted(k, cuts), [len(k)]]) for k in keys]
    for i in range(n):
        part = [k[a[i]:a[i + 1]] for k, a in zip(keys, at)]
        _, where = np.unique(np.concatenate(part), return_inverse=True)
        sums = np.bincount(where, np.concatenate([c[a[i]:a[i + 1]] for c, a in zip(counts, at)]))
        ends = np.cumsum([len(p) for p in part])[:-1]
        for o, a, found in zip(out, at, np.split(sums[where], ends)):
            o[a[i]:a[i + 1]] = found
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each piece the frequency of its shingles in all documents, in their order.
    One range of the hash space is held at a time."""
    def counted(part: int, pieces: list[tuple]) -> pa.RecordBatch:
        df = _summed([p[1] for p in pieces], [p[2] for p in pieces])
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pieces], pa.int64()),
             pa.array([part] * len(pieces), pa.int32()),
             pa.array([packed(d) for d in df], pa.binary())],
            ["block", "part", "df"])

    at, pieces = None, []
    for batch in batches:
        for block, part, keys, counts in zip(*batch.columns):
            part = part.as_py()
            if part != at and pieces:
                yield counted(at, pieces)
                pieces = []
            at = part
            raw = counts.as_py()
            pieces.append((block.as_py(), unpacked_keys(keys.as_buffer()),
                           np.frombuffer(raw, f"<u{raw[0]}", offset=1)))
    if pieces:
        yield counted(at, pieces)


def document_frequencies(blocks: DataFrame, parts: int) -> DataFrame:
    """(block, part, df): the exact document frequencies of the distinct shingles of
    each block, sorted, by ranges of the hash space.  ``blocks`` (block, text, ...)
    is partitioned by block."""
    return (blocks.sortWithinPartitions("block")
            .mapInArrow(_pieces(parts), "block long, part int, keys binary, df binary")
            .repartition("part").sortWithinPartitions("part")
            .mapInArrow(_counted, "block long, part int, df binary"))


# -- samples, candidates, verification --------------------------------------

def _sampler(n: int):
    """Total weight, samples and document frequencies of the texts of a block, from
    its rows and its shingles' frequencies."""
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        texts = docs.column("text").to_pylist()
        sets = [shingles(t) if t is not None else (np.empty(0, _U), None) for t in texts]
        block_keys = _distinct([k for k, _ in sets])[0]
        pieces = sorted(zip(found.column("part").to_pylist(), found.column("df").to_pylist()))
        freq = np.concatenate([np.empty(0, np.int64), *(unpacked(df) for _, df in pieces)])
        if len(freq) != len(block_keys):
            raise ValueError(f"{len(block_keys)} shingles have {len(freq)} frequencies")
        totals, samples, dfs = [], [], []
        for keys, tf in sets:
            if len(keys):
                df = freq[np.searchsorted(block_keys, keys)]
                w = exact_weights(tf, df, n)
                totals.append(float(w.sum()))
                samples.append(icws(keys, w).tobytes())
                dfs.append(packed(df))
            else:
                totals.append(0.0)
                samples.append(None)
                dfs.append(None)
        return pa.table({"doc_id": docs.column("doc_id"), "text_key": docs.column("text_key"),
                         "total": pa.array(totals, pa.float64()),
                         "samples": pa.array(samples, pa.binary()),
                         "df": pa.array(dfs, pa.binary())})
    return run


def _comparer(n: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, one = None, None  # the representative that streams by, and its weighted set
        for batch in batches:
            links = []
            for a, part, role, key, text, df in zip(*(c.to_pylist() for c in batch.columns)):
                keys, tf = shingles(text)
                this = keys, exact_weights(tf, unpacked(df), n)
                if role == 0:
                    at, one = (a, part), this
                elif at == (a, part):
                    if (s := weighted_jaccard(one, this)) >= threshold:
                        links.append((a, key, s))
            yield pa.RecordBatch.from_pydict({
                "a": pa.array([x[0] for x in links], pa.binary()),
                "b": pa.array([x[1] for x in links], pa.binary()),
                "similarity": pa.array([x[2] for x in links], pa.float64())})
    return run


def _verified(pairs: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """The ``pairs`` (a, b) of text keys at or above the threshold.  Each ``a``
    is held once per slice of its partners; a slice's partners stream by."""
    hot = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_PER_TASK_SLICE)
                                 .cast("int").alias("parts"))
    members = pairs.join(hot, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"),
        F.lit(1).alias("role"), F.col("b").alias("text_key"))
    heads = hot.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                       F.lit(0).alias("role"), F.col("a").alias("text_key"))
    work = (members.unionByName(heads).join(texts, "text_key")
            .select("a", "part", "role", "text_key", "text", "df")
            .repartition("a", "part").sortWithinPartitions("a", "part", "role"))
    return work.mapInArrow(_comparer(n, threshold), "a binary, b binary, similarity double")


def _rarest(idf, rarity, threshold: float):
    """Per text its rarest shingles, up to the weight that a text at the threshold
    may lack, without those that no other text has.  ``rest`` is the weight from a
    shingle on, in the order from rare to frequent: if it is the first that two
    texts have in common, their overlap is at most that.  Rows are (text_key, root,
    text, df) and ``idf`` the number of documents; without ``df``, ``idf`` is a
    broadcast table for the weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for key, root, text, *df in zip(*(c.to_pylist() for c in batch.columns)):
                keys, tf = shingles(text)
                w = (exact_weights(tf, unpacked(df[0]), idf) if df
                     else weights(keys, tf, idf.value))
                rare = np.max([rarity.value[places(keys, r)] for r in range(RARITY_ROWS)], axis=0)
                order = np.lexsort((keys, -rare))
                total = float(w.sum())
                rest = total - np.cumsum(w[order]) + w[order]
                first = (rest * (1 + 1e-9) >= threshold * total) & (rare[order] < 1)
                out[0].extend(keys[order][first].view(np.int64).tolist())
                for column, value in zip(out[1:4], (key, root, total)):
                    column.extend([value] * int(first.sum()))
                out[4].extend(rest[first].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.binary(), pa.binary(),
                                                      pa.float64(), pa.float64()))],
                ["shingle", "text_key", "root", "total", "rest"])
    return run


def _across(rows: DataFrame, on: str, possible: Column) -> DataFrame:
    """Pairs (a, b) of ``rows`` (on, text_key, root, ...) that agree in ``on`` and
    differ in root, where ``possible`` holds (of columns ``a_...``, ``b_...``).  It is
    part of the join, so only pairs that pass are made.  A key that many rows have is cut
    into slices: each row meets all others of its key, a slice at a time."""
    keys = (rows.groupBy(on).agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("x"),
                                 F.max("root").alias("y")).where("x < y")
            .select(on, F.ceil(F.col("n") / PAIRS_SLICE).cast("int").alias("slices")))
    rest = [c for c in rows.columns if c != on]
    held = rows.join(keys, on)
    side = lambda s, cut: held.select(
        F.col(on).alias(f"{s}_on"), cut.alias(f"{s}_slice"), *[F.col(c).alias(f"{s}_{c}") for c in rest])
    a = side("a", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    b = side("b", F.pmod(F.xxhash64("text_key"), F.col("slices")).cast("int"))
    return (a.join(b, (F.col("a_on") == F.col("b_on")) & (F.col("a_slice") == F.col("b_slice"))
                   & (F.col("a_root") < F.col("b_root")) & possible)
            .select(F.least("a_text_key", "b_text_key").alias("a"),
                    F.greatest("a_text_key", "b_text_key").alias("b")).distinct())


def agreement(a: Column, b: Column) -> Column:
    """Share of equal samples of two sample strings (4 bytes each)."""
    same = F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.when(
        F.substring(a, i * 4 + 1, F.lit(4)) == F.substring(b, i * 4 + 1, F.lit(4)), 1).otherwise(0))
    return F.aggregate(same, F.lit(0), lambda x, y: x + y) / HASHES


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected class of ``links``
    (a, b), by label passing with pointer jumping; one checkpoint per round."""
    both = checkpointed(links.select("a", "b").union(links.select("b", "a")).distinct())
    roots = checkpointed(both.groupBy(F.col("a").alias("node"))
                         .agg(F.min(F.least("a", "b")).alias("root")))
    while True:
        heard = (both.join(roots, F.col("b") == F.col("node"))
                 .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("heard")))
        new = (roots.join(heard, "node")
               .select("node", "root", F.least("root", "heard").alias("r")))
        jump = new.select(F.col("node").alias("r"), F.col("r").alias("further"))
        new = checkpointed(new.join(jump, "r").select(
            "node", F.least("r", "further").alias("new"), "root"))
        moved = new.where(F.col("new") < F.col("root")).limit(1).count()
        roots = new.select("node", F.col("new").alias("root"))
        if not moved:
            return roots


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, class_id, class_key,
    class_docs, links, keeper``.

    A class is a set of texts connected by links of weighted Jaccard similarity
    ``threshold`` or more, with all their copies.  Its id is the smallest
    ``doc_id`` in it, ``class_key`` the text key of that document (tells classes
    apart where ids repeat), ``class_docs`` its number of rows and ``links`` the
    links of this text among the pairs tested (no degree: members of one class are
    not all compared).  ``keeper`` marks rows of the class's first
    document (smallest id, then text key; ids that are NULL come last).

    Equal texts are one class whatever their length; texts without words only
    match equal ones.  A NULL text is a class of its own per row
    (``text_key`` NULL, always a keeper).  Repeated rows give repeated rows.
    """
    spark = docs.sparkSession
    n, nbytes = docs.agg(F.count("text"), F.sum(F.octet_length("text"))).first()
    rows = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    # both uses read one shuffle, so they keep the same columns
    blocks = rows.withColumn("block", F.pmod(
        F.xxhash64("doc_id", "text_key"), F.lit(max(BLOCKS, (nbytes or 0) // BLOCK_BYTES + 1)))
        .cast("long")).repartition("block")
    found = document_frequencies(blocks, max(PARTS, (nbytes or 0) // PART_BYTES + 1))
    sampled = stored(
        blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
            _sampler(n), rows.select("doc_id", "text_key").schema
            .add("total", "double").add("samples", "binary").add("df", "binary")),
        "near-samples")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id")
    texts = stored(
        sampled.where("text_key is not null").groupBy("text_key")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"),
             F.first("total").alias("total"), F.first("samples").alias("samples"),
             F.first("df").alias("df")), "near-texts")

    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.xxhash64(
        j, F.substring("samples", j * (4 * ROWS) + 1, F.lit(4 * ROWS))))).alias("bucket")
    member = (texts.where("samples is not null")
              .select("text_key", "total", "first", band))
    full = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    member = stored(member.join(full, "bucket"), "near-members")
    central = member.groupBy("text_key").agg((-F.sum("n")).alias("rank"))
    heads = (member.join(central, "text_key").groupBy("bucket")
             .agg(F.min(F.struct("rank", "first", F.col("text_key").alias("a"),
                                 F.col("total").alias("a_total"))).alias("h"))
             .select("bucket", "h.a", "h.a_total"))
    buckets = stored(member.drop("first").join(heads, "bucket"), "near-buckets")
    alike = F.least("total", "a_total") >= threshold * F.greatest("total", "a_total")
    star = checkpointed(buckets.where(alike & (F.col("a") != F.col("text_key")))
                        .select("a", F.col("text_key").alias("b")).distinct())

    whole = rows.where("text_key is not null").withColumn("late", F.col("doc_id").isNull())
    owner = texts.select("text_key", "first.late", "first.doc_id", "df")

    def texts_of(keys: DataFrame) -> DataFrame:
        """(text_key, ..., text) for rows with distinct text keys."""
        used, _ = sized_broadcast(checkpointed(keys.join(owner, "text_key")), BROADCAST_BYTES)
        extra = [c for c in keys.columns if c != "text_key"]
        return (whole.alias("w").join(used.alias("u"), (
            (F.col("w.text_key") == F.col("u.text_key"))
            & F.col("w.doc_id").eqNullSafe(F.col("u.doc_id"))))
            .select(F.col("w.text_key").alias("text_key"), *[f"u.{c}" for c in extra], "w.text", "u.df"))

    def compared(pairs: DataFrame) -> DataFrame:
        source = texts_of(pairs.select(F.col("a").alias("text_key")).union(pairs.select("b"))
                          .distinct())
        return stored(_verified(pairs, source, n, threshold).distinct(), "near-links")

    links = compared(star)
    roots = components(links)

    # buckets that still hold several classes: members of different classes
    classed = (buckets.join(roots.withColumnRenamed("node", "text_key"), "text_key", "left")
               .withColumn("root", F.coalesce("root", "text_key")))
    several = (classed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"))
               .where("x < y").select("bucket"))
    mixed = checkpointed(classed.join(several, "bucket")
                         .select("bucket", "text_key", "root", "total", "n"))
    near_size = (F.least("a_total", "b_total") >= threshold * F.greatest("a_total", "b_total"))
    cross = _across(mixed.where(F.col("n") <= CROWD).drop("n"), "bucket", near_size)
    crowd = mixed.where(F.col("n") > CROWD).select("text_key", "root").distinct()
    if crowd.limit(1).count():
        crowd = texts_of(crowd)
        rarity = spark.sparkContext.broadcast(idf_table(crowd, RARITY_ROWS))  # 12 MB, fixed
        rare = stored(crowd.mapInArrow(
            _rarest(n, rarity, threshold),
            "shingle long, text_key binary, root binary, total double, rest double"), "near-rare")
        rarity.destroy()  # what it was for is stored
        # similarity t needs an overlap of t / (1 + t) of both weights together
        enough = (F.least("a_rest", "b_rest") * (1 + 1e-9)
                  >= threshold / (1 + threshold) * (F.col("a_total") + F.col("b_total")))
        cross = cross.unionByName(_across(rare, "shingle", near_size & enough)).distinct()
    tested = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    drawn = texts.select("text_key", "samples")
    cross = (cross.join(tested, ["a", "b"], "left_anti")
             .join(drawn.toDF("a", "a_samples"), "a").join(drawn.toDF("b", "b_samples"), "b")
             .where(agreement(F.col("a_samples"), F.col("b_samples")) >= AGREE)
             .select("a", "b"))
    cross = checkpointed(cross)
    if cross.limit(1).count():
        links = links.unionByName(compared(cross))
        roots = components(links)

    degree = (links.select(F.col("a").alias("text_key")).union(links.select("b"))
              .groupBy("text_key").agg(F.count(F.lit(1)).alias("links")))
    named = (texts.select("text_key", "first", "copies")
             .join(roots.withColumnRenamed("node", "text_key"), "text_key", "left")
             .join(degree, "text_key", "left")
             .withColumn("root", F.coalesce("root", "text_key")))
    classes = named.groupBy("root").agg(
        F.min(F.struct("first", "text_key")).alias("k"), F.sum("copies").alias("class_docs"))
    named = checkpointed(named.join(classes, "root").select(
        "text_key", F.col("k.first.doc_id").alias("class_id"),
        F.col("k.text_key").alias("class_key"), "class_docs",
        F.coalesce("links", F.lit(0)).alias("links")))
    found = sampled.select("doc_id", "text_key").join(named, "text_key", "left")
    return found.select(
        "doc_id", "text_key", F.when(F.col("text_key").isNull(), F.col("doc_id"))
        .otherwise(F.col("class_id")).alias("class_id"), "class_key",
        F.coalesce("class_docs", F.lit(1)).alias("class_docs"),
        F.coalesce("links", F.lit(0)).alias("links"),
        (F.col("text_key").isNull() | ((F.col("class_key") == F.col("text_key"))
                                       & F.col("doc_id").eqNullSafe(F.col("class_id"))))
        .alias("keeper"))


def one_per_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each near-duplicate class, all columns kept.

    Rows repeated whole (same id and text) are copies: one stays.  Rows with a
    NULL text all stay.
    """
    found = near_classes(docs, threshold).where("keeper and text_key is not null")
    kept = checkpointed(found.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")))
    key = fresh(docs, "text_key")
    rows = docs.withColumn(key, text_key(F.col("text")))
    kept_id, kept_key = fresh(rows, "_kept_id"), fresh(rows, "_kept_key")

    def chosen(which: DataFrame) -> DataFrame:
        which, _ = sized_broadcast(which.select(F.col("doc_id").alias(kept_id),
                                                F.col("text_key").alias(kept_key)),
                                   BROADCAST_BYTES)
        return rows.join(which, (rows[key] == F.col(kept_key))
                         & rows["doc_id"].eqNullSafe(F.col(kept_id)), "left_semi")

    out = rows.where(F.col(key).isNull()).unionByName(chosen(kept.where("n = 1")))
    if kept.where("n > 1").limit(1).count():
        out = out.unionByName(chosen(kept.where("n > 1")).dropDuplicates(["doc_id", key]))
    return out.drop(key)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class."""
    return near_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "class_docs", "links", "keeper")
