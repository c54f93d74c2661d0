import numpy as np
import pytest

from cdrmill.llm.sliced_topk import (add_slices, best_rows, build_index, highest_products, quantised,
                                     search, search_block, slice_block)
from .conftest import SMALL

VECS = "vec_id long, embedding array<double>, label int, block long, part int, v string, score long, " \
       "rank int, query_id long"
REST = (1, 2, "v", 4, 5, 6)


def brute(vectors, every=20, top=20):
    """Top of plain integer products over {id: vector}."""
    best = []
    whole = {i: [int(v) for v in quantised(np.asarray(x, float))] for i, x in vectors.items()}
    for q in whole:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], x)), i)
                            for i, x in whole.items() if i != q)
            best += [(q, n, i, min(max(-s, -2**63), 2**63 - 1))
                     for n, (s, i) in enumerate(scores[:top], 1)]
    return sorted(best)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_whole_table(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    want = brute({r["vec_id"]: r["embedding"] for r in df.collect()})
    assert rows_of(highest_products(df)) == want


def test_many_blocks_and_tiles(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    index = build_index(df, block_rows=37)
    assert index.count == -(-df.count() // 37) > 10
    got = search(index, index.vectors.where("vec_id % 20 = 0"), tile_queries=4)
    assert rows_of(got) == brute({r["vec_id"]: r["embedding"] for r in df.collect()})


def test_odd_vectors(spark):
    """NULL, non-finite, empty, zero, short and huge vectors; ties, repeated ids and
    rows, ids below zero, extra columns with the operator's own names."""
    same = [0.3, -0.4, 0.5]
    good = {0: [0.1, 0.2, 0.3], 20: [-0.5, 0.0, 0.9], 21: same, 22: same, 23: same, 40: [],
            41: [0.0, 0.0, 0.0], 42: [0.7], 60: [1e300, -1e300, 1.0], 61: [-1e300, 1e300, 5.0],
            -20: [0.015625, -0.015625, 1.0], 80: [1.0, 2.0, 3.0, 4.0, 5.0]}
    rows = [(i, v, 1) for i, v in good.items()]
    rows += [(21, same, 1), (22, [9.0, 9.0, 9.0], 1)]  # the smaller vector stands for 22
    rows += [(90, None, 1), (91, [0.1, None, 0.2], 1), (92, [float("nan"), 1.0, 1.0], 1),
             (100, [float("inf"), 1.0, 1.0], None), (None, same, None)]
    df = spark.createDataFrame([(*r, *REST) for r in rows], VECS)
    got = rows_of(highest_products(df))
    assert got == brute(good)
    ties = [r for r in rows_of(highest_products(df, top=3)) if r[0] == 0]
    assert [r[1] for r in ties] == [1, 2, 3]


@pytest.mark.parametrize("kind", ["int", "smallint", "bigint"])
def test_integer_ids_of_any_type(spark, kind):
    df = spark.createDataFrame([(i, [i / 10, 1.0]) for i in range(25)],
                               f"vec_id {kind}, embedding array<float>")
    got = highest_products(df, top=2)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint",
                                "score": "bigint"}
    # float components become doubles first
    want = brute({i: [float(np.float32(i / 10)), 1.0] for i in range(25)}, top=2)
    assert rows_of(got) == want


def test_one_row_and_no_rows(spark):
    assert highest_products(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>")
                            ).count() == 0
    assert highest_products(spark.createDataFrame([], VECS)).count() == 0


def test_adders_equal_plain_sums():
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 2, (23, 128)).astype(np.uint8)
    weights = rng.integers(0, 4, 23)
    packed = np.packbits(rows, axis=1, bitorder="little").view(np.uint64)
    sums = add_slices({int(w): [packed[weights == w]] for w in np.unique(weights)})
    got = sum((np.unpackbits(s.view(np.uint8), bitorder="little").astype(int) << w)
              for w, s in enumerate(sums) if s is not None)
    assert (got == (rows.astype(int) << weights[:, None]).sum(0)).all()


def test_pick_from_the_top_slice_down():
    values = np.array([5, 9, 9, 1, 9, 7, 0, 3] + [2] * 56)
    bits = [np.packbits((values >> w & 1).astype(np.uint8), bitorder="little").view(np.uint64)
            for w in range(4)]
    among = np.array([2**64 - 1], np.uint64)
    assert best_rows(bits, among, 2).tolist() == [1, 2]        # three rows hold 9: the lower ids
    assert best_rows(bits, among, 5).tolist() == [0, 1, 2, 4, 5]
    assert best_rows(bits, among, 8).tolist() == [0, 1, 2, 4, 5, 7, 8, 9]
    assert len(best_rows(bits, among, 100)) == 64


def test_random_blocks_against_products():
    rng = np.random.default_rng(9)
    for rows in (1, 63, 64, 65, 300):
        x = rng.integers(-40, 40, (rows, 9))
        ids = rng.permutation(rows * 3)[:rows].astype(np.int64)
        block = slice_block(ids, x)
        for q in rng.integers(-70, 70, (6, 9)):
            own = int(ids[0])
            want = sorted((-int(a), int(i)) for a, i in zip(x @ q, ids) if i != own)[:5]
            got, scores = search_block(block, own, q.tolist(), 5)
            assert sorted(zip((-s for s in scores), got.tolist())) == want
