import math

import numpy as np
import pytest

from cdrmill.llm import multi_index as M
from .conftest import SMALL


def brute(vectors, queries, top):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], float)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        order = [k for k in np.lexsort((ids, d)) if ids[k] != q][:top]
        out[q] = [(int(ids[k]), float(d[k])) for k in order]
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_and_exact_scores(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    vectors = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = brute(vectors, [i for i, _ in vectors if i % 100 == 0], 10)
    got = {}
    for r in M.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    assert set(got) == set(want)
    hits = 0
    of = {i: np.array(v, float) for i, v in vectors}
    for q, found in got.items():
        assert [r for *_, r in found] == list(range(1, 11)) and q not in [i for i, *_ in found]
        assert [(s, i) for i, s, _ in found] == sorted((s, i) for i, s, _ in found)
        assert all(math.isclose(s, np.linalg.norm(of[q] - of[i]), rel_tol=1e-12)
                   for i, s, _ in found)
        hits += len({i for i, *_ in found} & {i for i, _ in want[q]})
    assert hits / (10 * len(want)) >= 0.9


@pytest.mark.parametrize("rows", [2000, 12_000])
def test_recall_on_larger_tables(spark, rows):
    """The larger table is drawn with the mean and covariance of the smaller one."""
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    index = M.build_index(vectors)
    x = {r["vec_id"]: np.frombuffer(bytes(r["v"])) for r in index.rows.collect()}
    if rows > len(x):
        known = np.array(list(x.values()))
        more = np.random.default_rng(6).multivariate_normal(
            known.mean(0), np.cov(known.T), rows).tolist()
        index = M.build_index(spark.createDataFrame(
            list(enumerate(more)), "vec_id long, embedding array<double>"))
        x = {r["vec_id"]: np.frombuffer(bytes(r["v"])) for r in index.rows.collect()}
    assert len(x) == rows
    ids = np.array(sorted(x))
    every = rows // 200
    found = {}
    queries = index.rows.where(f"vec_id % {every} = 0")
    for r in M.search(index, queries).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    matrix = np.array([x[i] for i in ids])
    hit = total = 0
    for q in ids[ids % every == 0]:
        d = ((matrix - x[q]) ** 2).sum(1)
        d[ids == q] = np.inf
        want = set(ids[np.argsort(d, kind="stable")[:M.TOP]].tolist())
        hit, total = hit + len(want & found[q]), total + len(want)
    assert total > 1500
    assert 0.9 <= hit / total


def test_walk_meets_cells_in_order_of_distance():
    rng = np.random.default_rng(4)
    for _ in range(50):
        d1, d2 = rng.integers(0, 9, 7).astype(float), rng.integers(0, 9, 5).astype(float)
        cells = rng.integers(0, 4, (7, 5))
        enough = int(rng.integers(1, cells.sum() + 5))
        masks = M.walk(d1, d2, cells, enough)
        met = {(i, j) for i, m in masks.items() for j in range(5) if m >> j & 1}
        assert sum(cells[c] for c in met) >= min(enough, cells.sum())
        worst = max(d1[i] + d2[j] for i, j in met)
        missed = [d1[i] + d2[j] for i in range(7) for j in range(5)
                  if cells[i, j] and (i, j) not in met]
        assert all(s >= worst for s in missed)


def test_odd_vectors(spark):
    bad = [(200, None), (300, [0.0, 0.0, 0.0]), (400, [1.0, None, 0.0]),
           (500, [1.0, float("nan"), 0.0]), (600, [float("inf"), 1.0, 1.0]), (None, [1.0, 2.0, 3.0]),
           (700, [1.0, 2.0]), (800, [])]
    good = [(0, [1.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0]), (100, [0.0, 1.0, 0.0]),
            (100, [0.0, 1.0, 0.0]), (7, [0.5, 0.5, 0.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in bad + good],
                               "vec_id long, embedding array<double>, rank int, c1 int")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in M.nearest(df).collect()}
    assert got == {(0, 1): 3, (0, 2): 5, (0, 3): 7, (0, 4): 100,
                   (100, 1): 7, (100, 2): 0, (100, 3): 3, (100, 4): 5}
    assert M.nearest(df.where("false")).count() == 0
    assert M.nearest(df.where("vec_id = 300")).count() == 0
    assert M.nearest(df.where("vec_id = 0")).count() == 0
    assert M.nearest(df.selectExpr("vec_id", "slice(embedding, 1, 1) as embedding")
                     .where("vec_id in (0, 5, 7)")).count() == 2


def test_a_hot_centroid_is_split(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 100)
    df = spark.range(1500).selectExpr(
        "id as vec_id", "if(id % 3 = 0, array(1d, 1d), array(cast(id as double), 1d)) as embedding")
    index = M.build_index(df)
    assert max(index.blocks.values()) >= 5
    got = M.search(index, index.rows.where("vec_id = 300"), 3, share=1.0).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [
        (0, 0.0), (1, 0.0), (3, 0.0)]


def test_all_rows_are_indexed(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    assert M.build_index(df).size == df.count()


@pytest.mark.parametrize("kind", ["smallint", "int", "bigint"])
def test_ids_of_every_integer_type(spark, kind):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)],
                               f"vec_id {kind}, embedding array<float>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in M.nearest(df, every=10).collect()}
    assert got[10, 1] == (9, 1.0) and got[10, 2] == (11, 1.0) and got[0, 1] == (1, 1.0)
