import zlib
from collections import Counter

import pytest

from cdrmill.llm import shard_ring as S


def placed(docs, *a, **k):
    return S.assign_shards(docs, *a, **k).toPandas()


def check_slots(out):
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))


def test_rows_law_and_slots(small_docs, small_texts):
    out = placed(small_docs)
    assert len(out) == len(small_texts) and set(out["doc_id"]) == set(small_texts)
    n = Counter(out["shard"])
    assert set(n) == set(range(40)) and max(n.values()) - min(n.values()) <= 1
    check_slots(out)
    for r in out.itertuples():
        raw = small_texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "rows")
    assert out["grown_shard"].isna().all()


def ring_by_hand(spark, docs, shards, vnodes, slack):
    """Home shards, capacities and a queue that is walked point by point."""
    arcs = S.ring(spark, shards, vnodes).collect()
    rows = docs.select("doc_id", S.ring_position(
        S.F.col("doc_id"), S.F.crc32(S.F.encode("text", "UTF-8")),
        S.text_bytes("text") + 16).alias("p")).collect()
    owner = {a["arc"]: a["shard"] for a in arcs}
    points = sorted((a["hi"], a["arc"]) for a in arcs if a["arc"] or a["lo"] == 0)
    home = {}
    for r in rows:
        arc = next((arc for hi, arc in points if r["p"] < hi), points[0][1])
        home[r["doc_id"]] = owner[arc]
    return home


@pytest.mark.parametrize("slack", [0.0, 0.1, 0.5])
def test_home_unless_full(spark, small_docs, slack):
    shards, vnodes = 7, 16
    home = ring_by_hand(spark, small_docs, shards, vnodes, slack)
    out = placed(small_docs, shards, vnodes, slack)
    check_slots(out)
    n = len(home)
    got = dict(zip(out["doc_id"], out["shard"]))
    assert set(got) == set(home)
    load, at_home = Counter(got.values()), Counter(home.values())
    for s in range(shards):
        cap = n // shards + (s < n % shards) if slack == 0 else -(-n * (1 + slack) // shards)
        assert load[s] <= cap
        stayed = sum(home[d] == s and got[d] == s for d in home)
        assert stayed == min(at_home[s], cap)  # only a full shard's rows move on


def test_a_new_shard_moves_few_rows(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "cast(id as string) as text")
    a, b = placed(docs, 20, 128, 0.1), placed(docs, 21, 128, 0.1)
    m = a.merge(b, on="doc_id")
    assert (m["shard_x"] != m["shard_y"]).mean() < 0.2  # 1/21 must move


def test_overflow_continues_clockwise(spark):
    """With one point per shard, rows beyond a full shard are on the next ones."""
    docs = spark.range(3000).selectExpr("id as doc_id", "'x' as text")
    arcs = sorted({(r["arc"], r["shard"]) for r in S.ring(spark, 5, 1).collect()})
    order = [s for _, s in arcs]
    home = ring_by_hand(spark, docs, 5, 1, 0)
    out = placed(docs, 5, 1, 0.0)
    at, full = Counter(home.values()), 600
    waiting, got = 0, Counter()
    for s in order * 2:  # twice round empties the queue
        have = at.pop(s, 0)
        waiting += have
        take = min(waiting, full - got[s])
        got[s] += take
        waiting -= take
    assert dict(Counter(out["shard"])) == dict(got)


def test_odd_rows(odd_docs, no_docs):
    out = placed(odd_docs, 4, 8)
    assert len(out) == odd_docs.count()
    check_slots(out)
    assert out[out["doc_id"] == 1][["size", "text_crc32"]].values.tolist() == [[16, 0]]
    assert S.assign_shards(no_docs).count() == 0
