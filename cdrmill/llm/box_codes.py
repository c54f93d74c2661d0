"""Vector codes of four bytes from codebooks refined by exact integer rounds.

Vectors become integers and are cut into ``PARTS`` equal parts; each part position
has a codebook of up to 256 entries.  A round assigns every part to the nearest
entry of its codebook and replaces each entry by the mean of its parts.

The parts of a position are sorted along a Hilbert curve and cut into flat blocks,
which store the least and greatest value of each component (a box) and the sums.  In
a round, the box's least and greatest distance to each entry leave the block a
short list: an entry goes when another one is nearer to every point of the box.  A
list of one takes the whole block by its stored sums; otherwise a small integer
kernel compares the block's parts with the list.  The kernel computes in doubles
while every intermediate fits their 53 bits, else in longs, else in whole numbers
of any size, so it is exact at any magnitude.

Only codebooks (a fixed number of entries) and their sums pass the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrmill.llm.common import stored, table
from cdrmill.operators.lookup import sized_broadcast

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
BLOCK_ROWS = 256
LARGEST = 1 << 53        # components beyond it count as it
LONG_MAX = (1 << 63) - 1
CURVE_BITS = 64          # of a position on the curve


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as longs, within +-``LARGEST``."""
    with np.errstate(over="ignore"):
        x = np.floor(values * float(scale))
    return np.clip(x, -float(LARGEST), float(LARGEST)).astype(np.int64)


def curve_position(x: np.ndarray, low: int, high: int) -> np.ndarray:
    """Position on a Hilbert curve of the rows of ``x``, components scaled from
    ``low .. high`` to a grid; with more components than bits the first ones count."""
    n = min(x.shape[1], CURVE_BITS)
    bits = min(CURVE_BITS // n, 16) if n else 0
    span = max(1.0, float(high) - float(low) + 1.0)
    cell = ((x[:, :n].astype(np.float64) - float(low)) / span * (1 << bits)).astype(np.int64)
    axes = np.clip(cell, 0, (1 << bits) - 1).astype(np.uint64).T.copy()
    # Gray-code walk from axes to the transposed curve index
    q = 1 << (bits - 1) if bits else 0
    while q > 1:
        below = np.uint64(q - 1)
        for i in range(n):
            on = (axes[i] & np.uint64(q)) != 0
            swap = np.where(on, np.uint64(0), (axes[0] ^ axes[i]) & below)
            axes[0] ^= np.where(on, below, swap)
            axes[i] ^= swap
        q >>= 1
    for i in range(1, n):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(len(x), np.uint64)
    q = 1 << (bits - 1) if bits else 0
    while q > 1:
        turn ^= np.where((axes[n - 1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    axes ^= turn
    out = np.zeros(len(x), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << np.uint64(1)) | ((axes[i] >> np.uint64(bit)) & np.uint64(1))
    return (out ^ np.uint64(1 << 63)).view(np.int64)  # order kept as a signed long


def exact_kind(most: int, width: int):
    """The cheapest number type that holds every squared distance (and its terms)
    of ``width`` components within +-``most``."""
    bound = 4 * most * most * max(1, width)
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object


def short_list(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entries (ascending) that can be nearest to a point of the box; equal
    distances stay, so ties are decided by the kernel."""
    under, over = low - book, book - high
    out = np.maximum(np.maximum(under, over), 0)
    far = np.maximum(abs(under), abs(over))
    least, most = (out * out).sum(1), (far * far).sum(1)
    return np.flatnonzero(least <= most.min())


def nearest_entry(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest row of ``book`` (ties to the first) and squared distance, exactly."""
    if book.dtype == object:
        d = np.array([[sum((a - b) ** 2 for a, b in zip(p, e)) for e in book] for p in x], object)
    else:
        d = (x * x).sum(1)[:, None] + (book * book).sum(1)[None] - 2 * (x @ book.T)
    near = d.argmin(1)
    return near, d[np.arange(len(x)), near]


class Blocks:
    """What a task does with stored blocks and the codebooks of a round."""

    def __init__(self, books: list[list[list[int]]], width: int):
        self.books = [np.array(b, np.int64).reshape(len(b), width) for b in books]
        self.width = width
        self.most = max([0, *(int(abs(b).max()) for b in self.books if b.size)])

    def assigned(self, batch: pa.RecordBatch):
        """For each block: its row number in the batch, its part position and parts, the
        number type to compute in, the codebook in it and the short list."""
        cols = {c: batch.column(c) for c in ("part", "values", "low", "high")}
        for k in range(batch.num_rows):
            part = cols["part"][k].as_py()
            low, high = (np.array(cols[c][k].as_py(), np.int64) for c in ("low", "high"))
            x = np.frombuffer(cols["values"][k].as_py(), np.int64).reshape(-1, self.width)
            most = max([self.most, *(abs(int(v)) for v in low), *(abs(int(v)) for v in high)])
            kind = exact_kind(most, self.width)
            book = self.books[part].astype(kind)
            yield k, part, x, kind, book, short_list(low.astype(kind), high.astype(kind), book)

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per task and used entry the count and the exact sums of its parts."""
        total: dict[tuple[int, int], list] = {}

        def add(part: int, entry: int, n: int, sums: list[int]) -> None:
            have = total.get((part, entry))
            if have is None:
                total[part, entry] = [n, sums]
            else:
                have[0] += n
                have[1] = [a + b for a, b in zip(have[1], sums)]

        for batch in batches:
            held = batch.column("sums")
            for k, part, x, kind, book, few in self.assigned(batch):
                if len(few) == 1:
                    add(part, int(few[0]), len(x), [int(v) for v in held[k].as_py()])
                    continue
                near, _ = nearest_entry(x.astype(kind), book[few])
                wide = kind is object
                for e in np.unique(near):
                    own = x[near == e]
                    s = own.astype(object).sum(0) if wide else own.sum(0)
                    add(part, int(few[e]), len(own), [int(v) for v in s])
        exact = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in total], pa.int32()), pa.array([e for _, e in total], pa.int32()),
             pa.array([v[0] for v in total.values()], pa.int64()),
             pa.array([[Decimal(s) for s in v[1]] for v in total.values()], pa.list_(exact))],
            ["part", "entry", "n", "sums"])

    def codes(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each part's entry and squared distance (a decimal)."""
        for batch in batches:
            rows, parts, entries, errors = [], [], [], []
            for k, part, x, kind, book, few in self.assigned(batch):
                near, d = nearest_entry(x.astype(kind), book[few])
                rows.append(np.frombuffer(batch.column("rows")[k].as_py(), np.int64))
                parts.append(np.full(len(x), part))
                entries.append(few[near])
                errors.extend(Decimal(int(v)) for v in d)
            flat = lambda a: np.concatenate(a) if a else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat(rows), pa.int64()), pa.array(flat(parts).astype(np.int32)),
                 pa.array(flat(entries).astype(np.int32)),
                 pa.array(errors, pa.decimal128(38, 0))], ["row", "part", "entry", "d"])


def _cut(width: int, parts: int, low: int, high: int, scale: int):
    """Vectors to parts: position on the curve and values as longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros((batch.num_rows, width * parts))
            for row, v in zip(x, batch.column("v").to_pylist()):
                row[:len(v)] = v
            x = whole(x, scale)
            for p in range(parts):
                own = np.ascontiguousarray(x[:, p * width:(p + 1) * width])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), p, np.int32)),
                     pa.array(curve_position(own, low, high)), batch.column("row"),
                     pa.array([r.tobytes() for r in own], pa.binary())],
                    ["part", "curve", "row", "value"])
    return run


def _block(width: int, block_rows: int):
    """Sorted parts to flat blocks with box and sums."""
    names = ["part", "rows", "values", "low", "high", "sums"]

    def flush(part: int, rows: list, values: list) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(values), np.int64).reshape(len(rows), width)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([np.array(rows, np.int64).tobytes()], pa.binary()),
             pa.array([x.tobytes()], pa.binary()),
             pa.array([x.min(0).tolist()], pa.list_(pa.int64())),
             pa.array([x.max(0).tolist()], pa.list_(pa.int64())),
             pa.array([x.sum(0).tolist()], pa.list_(pa.int64()))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, values = None, [], []
        for batch in batches:
            for part, row, value in zip(*(batch.column(c).to_pylist()
                                          for c in ("part", "row", "value"))):
                if rows and (part != at or len(rows) == block_rows):
                    yield flush(at, rows, values)
                    rows, values = [], []
                at = part
                rows.append(row)
                values.append(value)
        if rows:
            yield flush(at, rows, values)
    return run


def book_digest(books: list[list[list[int]]]) -> str:
    """SHA-256 of all components by part, entry and position, as decimals."""
    return hashlib.sha256(",".join(str(v) for b in books for e in b for v in e)
                          .encode()).hexdigest()


class Coded:
    """Vectors with their final codes: ``rows`` (row, vec_id, label), ``codes`` (row,
    part, entry, d), ``books`` (entries by part)."""

    def __init__(self, rows: DataFrame, codes: DataFrame | None, books: list):
        self.rows, self.codes, self.books = rows, codes, books


def fit_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
              rounds: int = ROUNDS, scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> Coded:
    """Codebooks and codes of ``vectors`` (``vec_id`` integer, ``embedding`` array of
    numbers, ``label``; other columns are ignored).

    Rows whose vector is NULL or holds a NULL or non-finite component are left out;
    all others are coded, also repeated ones, zero vectors and those without an id or
    label.  The first codebooks are the parts of the ``entries`` smallest ids, fewer if
    there are fewer rows; equal ids are taken in array order of their vectors, rows
    without an id last.  Vectors of different lengths, or of a length that ``parts``
    does not divide, go on with zeros up to the same one, which changes no distance.
    An empty table has empty codebooks and no codes."""
    usable = F.coalesce(F.col("v").isNotNull() & ~F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    rows = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                                 F.col("embedding").cast("array<double>").alias("v"))
                  .where(usable).withColumn("row", F.monotonically_increasing_id()), "codes-rows")
    shape = rows.agg(F.max(F.size("v")).alias("dim"), F.min(F.array_min("v")).alias("low"),
                     F.max(F.array_max("v")).alias("high")).first()
    if not shape["dim"]:  # no rows, or empty vectors only: nothing to learn
        n = min(entries, rows.limit(entries).count())
        codes = rows.select("row", F.explode(F.array(*[F.lit(p) for p in range(parts)])).alias("part"),
                            F.lit(0).alias("entry"), F.lit(0).cast("decimal(38,0)").alias("d"))
        return Coded(rows, codes, [[[] for _ in range(n)] for _ in range(parts)])
    width = -(-shape["dim"] // parts)
    low, high = (int(whole(np.array([shape[c]]), scale)[0]) for c in ("low", "high"))
    low, high = min(low, 0), max(high, 0)  # the zeros of short vectors
    first = (rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect())
    seeds = np.zeros((len(first), width * parts))
    for row, r in zip(seeds, first):
        row[:len(r["v"])] = r["v"]
    seeds = whole(seeds, scale)
    books = [seeds[:, p * width:(p + 1) * width].tolist() for p in range(parts)]

    pieces = stored(rows.select("row", "v").mapInArrow(
        _cut(width, parts, low, high, scale), "part int, curve long, row long, value binary"),
        "codes-parts")
    blocks = stored(
        pieces.repartitionByRange("part", "curve", "row")
        .sortWithinPartitions("part", "curve", "row")
        .mapInArrow(_block(width, block_rows),
                    "part int, rows binary, values binary, low array<long>, high array<long>, "
                    "sums array<long>"), "codes-blocks")
    for _ in range(rounds):
        task = blocks.drop("rows").mapInArrow(
            Blocks(books, width).sums, "part int, entry int, n long, sums array<decimal(38,0)>")
        total = task.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
        for r in total.collect():  # one row an entry at most
            books[r["part"]][r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    codes = blocks.select("part", "rows", "values", "low", "high").mapInArrow(
        Blocks(books, width).codes, "row long, part int, entry int, d decimal(38,0)")
    return Coded(rows, codes, books)


def vector_codes(vectors: DataFrame, **how) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every coded row of
    ``vectors`` (see :func:`fit_codes`): two hex digits a part, the squared distance
    to the entries, and its sum over the rows of equal label (NULL labels together).
    Errors beyond a long's range are given as its largest value."""
    coded = fit_codes(vectors, **how)
    most = F.lit(LONG_MAX).cast("decimal(38,0)")
    parts = how.get("parts", PARTS)
    digit = lambda p: F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == p, F.col("entry"))))), 2, "0")
    codes = coded.codes.groupBy("row").agg(
        F.concat(*[digit(p) for p in range(parts)]).alias("code"), F.sum("d").alias("d"))
    rows = stored(coded.rows.select("row", "vec_id", "label").join(codes, "row"), "codes")
    by_label, _ = sized_broadcast(
        rows.groupBy("label").agg(F.sum("d").alias("label_d")).withColumnRenamed("label", "of_label"))
    return (rows.join(by_label, F.col("label").eqNullSafe(F.col("of_label")), "left")
            .select("vec_id", "code", F.least("d", most).cast("long").alias("error"),
                    F.least("label_d", most).cast("long").alias("label_error"),
                    F.lit(book_digest(coded.books)).alias("codebooks_sha256")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of four bytes for all vectors, with the codebooks of four rounds."""
    return vector_codes(table(spark, sf_dir, "embeddings"))
