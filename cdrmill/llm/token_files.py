"""Token sequences written in training order as fixed-stride binary shards.

Documents are tokenized, ended by the end token and cut into sequences of
``length`` tokens.  How many there are is known only once all texts are
tokenized, but a text of n bytes has at most n tokens, so the table has at most
M places for sequences.  A document's sequences take consecutive places (modulo
M) from a hash of its id and text, and a keyed Feistel permutation of 0 .. M-1,
walked along its cycles until it falls below M, gives each place its position: a
shuffle of the whole corpus without sorting by random keys, the same on every
run however the input is partitioned.  Positions are dealt to shards by range.
A sequence's global slot, 0 .. N-1 without gaps, is its rank by position (then
by content, where places coincide): the sequences of all shards before its own,
plus its place in its shard.  Record ``i`` of a shard begins at byte
``i * stride``, so a reader can start at any slot, by the sizes of the files.
Each text is tokenized once.

A record is: ``length`` tokens (u16, little-endian, padded with the end token),
the document id (i64, big-endian), the number of the sequence in its document
(u32, big-endian), its real tokens (u32, big-endian), eight zero bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdrmill.llm.common import checkpointed, table, text_bytes, write_binary_rows
from cdrmill.operators.lookup import sized_broadcast
from cdrmill.session import scratch_path

VOCABULARY = "byte_bpe_50k.tiktoken"
END_TOKEN = 50256
LENGTH = 512
SHARD_PLACES = 8192         # least places of a shard
MOST_SHARD_PLACES = 65536   # a shard file is read as one value: 69 MB at most
SHARDS = 4096               # shards grow once there are so many
KEY = 0x5EED
ROUNDS = 6
NO_ID = -(1 << 63)
BROADCAST_BYTES = 32 << 20
TAIL = ">qIIQ"
TAIL_BYTES = struct.calcsize(TAIL)

_U = np.uint64


# -- permutation ----------------------------------------------------------------

def feistel(x: np.ndarray, bits: int, key: int) -> np.ndarray:
    """A permutation of 0 .. 2^(2*bits) - 1: balanced Feistel network."""
    mask = _U((1 << bits) - 1)
    left, right = x >> _U(bits), x & mask
    for r in range(ROUNDS):
        f = right * _U(0x9E3779B97F4A7C15) + _U((key * 0x2545F4914F6CDD1D + r * 0xD1342543DE82EF95)
                                                % (1 << 64))
        f = (f ^ (f >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        f = (f ^ (f >> _U(27))) * _U(0x94D049BB133111EB)
        left, right = right, left ^ ((f ^ (f >> _U(31))) & mask)
    return (left << _U(bits)) | right


def positions(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Position of each place below ``n``: the permutation of the next even
    power of two, applied again to whatever falls outside."""
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    out = feistel(index.astype(_U), bits, key)
    while (outside := out >= n).any():
        out[outside] = feistel(out[outside], bits, key)
    return out.astype(np.int64)


# -- tokens ---------------------------------------------------------------------

class Tokens:
    """A vocabulary of ranks; texts become token ids as u16 bytes.  Special strings
    in a text are ordinary text."""

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers as P
        import tiktoken
        with open(P.path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("ranks", pat_str=P.PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u2").tobytes()


@lru_cache(maxsize=2)
def tokens(vocabulary: str) -> Tokens:
    return Tokens(vocabulary)


def _sequences(vocabulary: str, length: int, places: int, key: int):
    end = struct.pack("<H", END_TOKEN)
    names = ["position", "ids", "tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens(vocabulary)
        at, ids, tails = [], [], []

        def batch() -> pa.RecordBatch:
            where = positions(np.array(at, np.int64) % places, places, key)
            out = pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(tails, pa.binary())], names)
            for full in (at, ids, tails):
                full.clear()
            return out

        for rows in batches:
            for doc_id, text, first in zip(rows.column("doc_id").to_pylist(), rows.column("text"),
                                           rows.column("first").to_pylist()):
                whole = encode(text.as_py() or "") + end
                for no, i in enumerate(range(0, len(whole), 2 * length)):
                    part = whole[i:i + 2 * length]
                    at.append(first + no)
                    ids.append(part)
                    tails.append(struct.pack(TAIL, NO_ID if doc_id is None else doc_id, no,
                                             len(part) // 2, 0))
                    if len(ids) == 2048:
                        yield batch()
        if ids:
            yield batch()
    return run


def stride_of(length: int) -> int:
    return 2 * length + TAIL_BYTES


def write_shards(docs: DataFrame, path: str, length: int = LENGTH,
                 shard_places: int | None = None, key: int = KEY,
                 vocabulary: str = VOCABULARY) -> int:
    """Write ``docs`` (``doc_id`` integer, ``text``) as shards below ``path``
    (``shard=<number>/``) of the sequences of ``shard_places`` places each (by
    default more for larger tables); returns the number of shards.

    Every document gives at least one sequence: NULL and empty texts one with the
    end token only; a very long text gives as many as it takes, and is held whole
    while it is tokenized.  A NULL id is stored as -2^63.  Repeated rows are written
    repeatedly; other columns are ignored; an empty table writes no shard, and a
    shard none of whose places is taken has no file.
    """
    text_places = F.floor(text_bytes("text") / length) + 1
    places = docs.agg(F.sum(text_places)).first()[0] or 0
    if not places:
        return 0
    per = shard_places or min(max(SHARD_PLACES, places // SHARDS), MOST_SHARD_PLACES)
    shards = -(-places // per)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    placed = rows.withColumn("first", F.pmod(F.xxhash64("doc_id", "text"), F.lit(places))) \
        .mapInArrow(_sequences(vocabulary, length, places, key),
                    "position long, ids binary, tail binary")
    shard = F.floor(F.col("position") / per).cast("int")
    padded = F.rpad("ids", 2 * length, F.lit(struct.pack("<H", END_TOKEN)))
    dealt = (placed.withColumn("shard", shard).repartitionById(shards, F.col("shard"))
             .sortWithinPartitions("shard", "position", "tail", "ids")
             .select("shard", F.concat(padded, "tail").alias("record")))
    write_binary_rows(dealt, path, "record", by=["shard"])
    return shards


def _read(length: int, start: int, upto: int):
    stride = stride_of(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                        batch.column(2)):
                data = memoryview(raw.as_buffer())
                if len(data) % stride:
                    raise ValueError(f"shard {shard} is cut off")
                lo, hi = max(start - base, 0), min(upto - base, len(data) // stride)
                found = []
                for i in range(lo, hi):
                    record = data[i * stride:(i + 1) * stride]
                    doc_id, no, n, _ = struct.unpack(TAIL, record[-TAIL_BYTES:])
                    found.append((base + i, shard, i * stride, None if doc_id == NO_ID else doc_id,
                                  no, n, zlib.crc32(record[:-TAIL_BYTES]), bytes(record[:2 * n])))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                         pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)],
                    ["slot", "shard", "offset", "doc_id", "seq_no", "n_tokens", "crc32", "tokens"])
    return run


def shard_slots(spark: SparkSession, path: str, length: int = LENGTH) -> DataFrame:
    """``shard, base, n``: first slot and number of records of each shard, from the
    sizes of the files alone (one narrow row a file)."""
    n = F.floor(F.sum("length") / stride_of(length))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
            .groupBy(F.col("shard").cast("int").alias("shard")).agg(n.alias("n"))
            .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .select("shard", "base", "n"))


def read_shards(spark: SparkSession, path: str, length: int = LENGTH, start: int = 0,
                upto: int = 1 << 62) -> DataFrame:
    """Records of slots ``start <= slot < upto``, from the shards that hold them:
    ``slot, shard, offset, doc_id, seq_no, n_tokens, crc32`` (of the padded
    tokens) and ``tokens`` (the real ones, u16 bytes)."""
    slots = checkpointed(shard_slots(spark, path, length)
                         .where((F.col("base") < upto) & (F.col("base") + F.col("n") > start)))
    low, high = slots.agg(F.min("shard"), F.max("shard")).first()
    if low is None:
        low, high = 0, -1
    slots, _ = sized_broadcast(slots.drop("n"), BROADCAST_BYTES)
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
            .where((F.col("shard") >= low) & (F.col("shard") <= high))
            .select(F.col("shard").cast("int").alias("shard"), "content")
            .join(slots, "shard").select("shard", "base", "content")
            .mapInArrow(_read(length, start, upto),
                        "slot long, shard int, offset long, doc_id long, seq_no long, "
                        "n_tokens long, crc32 long, tokens binary"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written in training order; one row per record read back."""
    path = scratch_path(spark, "tokens")
    write_shards(table(spark, sf_dir, "documents"), path)
    return read_shards(spark, path).drop("tokens")
