import hashlib

import numpy as np
import pytest

from cdrmill.llm.box_codes import (curve_position, exact_kind, nearest_entry, short_list, vector_codes,
                                   whole)
from .conftest import SMALL

VECS = "vec_id long, embedding array<double>, label int, part int, row long, code string, d double, " \
       "error long, label_d long, of_label int"
REST = (1, 2, "c", 0.5, 3, 4, 5)


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Plain rounds in whole numbers; rows of (vec_id, vector, label)."""
    rows = [(i, [int(c) for c in whole(np.asarray(v, float), scale)], l) for i, v, l in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = -(-max((len(v) for _, v, _ in rows), default=0) // parts)
    cut = [(v + [0] * (width * parts - len(v))) for _, v, _ in rows]
    piece = lambda v, p: v[p * width:(p + 1) * width]
    first = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))
    books = [[piece(cut[k], p) for k in first[:entries]] for p in range(parts)]

    def near(v, book):
        d = [sum((a - b) ** 2 for a, b in zip(v, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for v in cut:
                members[near(piece(v, p), books[p])[0]].append(piece(v, p))
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else e
                        for m, e in zip(members, books[p])]
    found = [[near(piece(v, p), books[p]) for p in range(parts)] for v in cut]
    error = [sum(d for _, d in f) for f in found]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    most = 2**63 - 1
    return sorted([(r[0], "".join(f"{e:02x}" for e, _ in f), min(own, most),
                    min(most, sum(o for o, s in zip(error, rows) if s[2] == r[2])), sha)
                   for r, f, own in zip(rows, found, error)], key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet").limit(400)
    df = spark.createDataFrame(df.collect(), df.schema)
    want = brute([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()], entries=20, rounds=2)
    assert rows_of(vector_codes(df, entries=20, rounds=2, block_rows=16)) == want


def test_more_entries_than_rows_and_one_block(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist(), i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert rows_of(vector_codes(df)) == brute(rows)
    few = rows_of(vector_codes(df, entries=5, rounds=3))
    assert few == brute(rows, entries=5, rounds=3)
    assert any(r[2] for r in few)


def test_odd_vectors(spark):
    """NULL and non-finite vectors go; repeated rows, ties, rows without an id or label,
    zero, empty, short and huge vectors stay; extra columns with inner names."""
    rows = [(5, [0.1, 0.2, -0.3, 0.4, 0.5], 1), (5, [0.1, 0.2, -0.3, 0.4, 0.5], 1),
            (5, [0.0, 0.2, -0.3, 0.4, 0.5], None), (None, [0.9, 0.9, 0.9, 0.9, 0.9], None),
            (6, [0.0] * 5, 2), (7, [], 2), (8, [0.3], 2), (9, [1e300, -1e300, 1.0], 3),
            (10, [3e6, -3e9, 1.0], 3), (11, None, 1), (12, [0.1, None], 1),
            (13, [float("nan")], 1), (14, [float("-inf")], None), (-4, [0.2, 0.2], 1)]
    df = spark.createDataFrame([(*r, *REST) for r in rows], VECS)
    assert rows_of(vector_codes(df, entries=3)) == brute(rows, entries=3)


def test_no_rows_and_empty_vectors(spark):
    assert vector_codes(spark.createDataFrame([], VECS)).columns == [
        "vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes(spark.createDataFrame([], VECS)).count() == 0
    df = spark.createDataFrame([(1, [], 0), (2, [], 0)], "vec_id long, embedding array<double>, label int")
    empty = hashlib.sha256(b"").hexdigest()
    assert rows_of(vector_codes(df)) == [(1, "00000000", 0, 0, empty), (2, "00000000", 0, 0, empty)]


@pytest.mark.parametrize("most", [100, 1 << 28, 1 << 40])
def test_kernel_is_exact_at_any_magnitude(most):
    rng = np.random.default_rng(most % 97)
    x = rng.integers(-most, most, (30, 6))
    book = rng.integers(-most, most, (9, 6))
    kind = exact_kind(most, 6)
    assert kind is {100: np.float64, 1 << 28: np.int64, 1 << 40: object}[most]
    near, d = nearest_entry(x.astype(kind), book.astype(kind))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e)) for e in book] for p in x]
    assert near.tolist() == [w.index(min(w)) for w in want]
    assert [int(v) for v in d] == [min(w) for w in want]


def test_short_list_keeps_every_possible_winner_and_ties():
    rng = np.random.default_rng(8)
    book = rng.integers(-50, 50, (40, 3)).astype(float)
    book[7] = book[3]
    dropped = 0
    for _ in range(50):
        x = rng.integers(-50, 50, 3) + rng.integers(-6, 6, (20, 3)).astype(float)
        few = short_list(x.min(0), x.max(0), book)
        near, _ = nearest_entry(x, book)
        assert set(near) <= set(few.tolist())
        assert (few[nearest_entry(x, book[few])[0]] == near).all()
        dropped += len(book) - len(few)
    assert dropped > 0
    assert short_list(np.full(3, book[3]), np.full(3, book[3]), book).tolist() == [3, 7]


def test_curve_visits_neighbours():
    """All cells of a small grid once, each a neighbour of the one before."""
    grid = np.array([(a, b) for a in range(16) for b in range(16)])
    full = curve_position(grid * 4096, 0, 16 * 4096 - 1)
    order = np.argsort(full)
    assert len(set(full.tolist())) == 256
    assert (np.abs(np.diff(grid[order], axis=0)).sum(1) == 1).all()
