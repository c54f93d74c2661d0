import random
from collections import Counter

import numpy as np
import pytest

from cdrmill.llm import near_dup as N
from .conftest import DOCS, doc_rows

WORDS = [f"w{i}" for i in range(3000)]


def text(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def edited(rng, words, k):
    out = list(words)
    for i in rng.sample(range(len(out)), k):
        out[i] = f"e{rng.random():.9f}"
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    texts = [text(rng, rng.randint(3, 400)) for _ in range(150)]
    for base in texts[:25]:  # chains and groups of edits, light and heavy
        for _ in range(rng.randint(1, 8)):
            texts.append(edited(rng, rng.choice([base, texts[-1]]), max(1, len(base) // 60)))
    texts += [edited(rng, b, len(b) // 6) for b in texts[:25]]
    shared = text(rng, 80)
    texts += [shared + text(rng, rng.randint(60, 90)) for _ in range(40)]
    big = text(rng, 250)
    texts += [edited(rng, big, 2) for _ in range(60)] + [big] * 10
    wide = text(rng, 200)  # a group of edits from light to heavy, in the same buckets
    texts += [edited(rng, wide, rng.randint(1, 14)) for _ in range(90)] + [wide]
    rng.shuffle(texts)
    return [" ".join(t) for t in texts]


def brute(texts, idf):
    sets = [(k, N.weights(k, tf, idf)) for k, tf in map(N.shingles, texts)]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    near = 0
    for i in range(len(texts)):
        for j in range(i):
            s = N.weighted_jaccard(sets[i], sets[j])
            near += abs(s - 0.8) < 0.01 and texts[i] != texts[j]
            if s >= N.THRESHOLD:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("crowd", [N.CROWD, 3])
def test_classes_equal_brute_force(spark, corpus, monkeypatch, crowd):
    monkeypatch.setattr(N, "CROWD", crowd)
    docs = spark.createDataFrame(doc_rows(list(enumerate(corpus))), DOCS).repartition(5)
    out = {r["doc_id"]: r for r in N.near_classes(docs).collect()}
    want = brute(corpus, N.idf_table(docs))
    assert [out[i]["class_id"] for i in range(len(corpus))] == want
    size = Counter(want)
    assert all(out[i]["class_docs"] == size[want[i]] for i in out)
    assert all(out[i]["keeper"] == (want[i] == i) for i in out)
    kept = N.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


@pytest.mark.parametrize("parts", [1, 7, N.PARTS])
def test_document_frequencies_are_exact(spark, corpus, parts):
    df = Counter(k for t in corpus for k in N.shingles(t)[0].tolist())
    # shingles that share one of 2^20 buckets with others have their own frequency
    assert sum(Counter(k % (1 << N.DF_BITS) for k in df).values()) > len(
        {k % (1 << N.DF_BITS) for k in df}) + 100
    blocks = spark.createDataFrame([(i // 40, t) for i, t in enumerate(corpus)]
                                   + [(0, None), (99, ""), (99, None)], "block long, text string")
    got = {}
    for r in N.document_frequencies(blocks.repartition("block"), parts).collect():
        got[r["block"], r["part"]] = N.unpacked(bytes(r["df"])).tolist()
    for block in range(0, len(corpus), 40):
        keys = sorted({k for t in corpus[block:block + 40] for k in N.shingles(t)[0].tolist()})
        found = [n for p in range(parts) for n in got.get((block // 40, p), [])]
        assert found == [df[k] for k in keys]


def test_weights_use_exact_frequencies(spark, corpus, monkeypatch):
    """Texts' total weights, as the classes use them."""
    kept = {}

    def stored(df, name):
        kept[name] = out = N.checkpointed(df)
        return out

    monkeypatch.setattr(N, "stored", stored)
    monkeypatch.setattr(N, "BLOCKS", 20)
    texts = [*corpus, "", "  "]
    docs = spark.createDataFrame(doc_rows([*enumerate(texts), (None, None)]), DOCS).repartition(5)
    N.near_classes(docs)
    sets = [N.shingles(t) for t in texts]
    df = Counter(k for keys, _ in sets for k in keys.tolist())
    total = {r["doc_id"]: r["total"] for r in kept["near-samples"].collect()}
    for i, (keys, tf) in enumerate(sets):
        idf = [np.log((1 + len(texts)) / df[k]) / np.log(1 + len(texts)) for k in keys.tolist()]
        assert total[i] == pytest.approx(sum(tf * (1 + np.array(idf))), rel=1e-12)
    assert total[None] == 0


def test_packed_counts():
    for most in (1, 255, 256, 70_000, 1 << 40):
        assert N.unpacked(N.packed(np.array([1, most, 7]))).tolist() == [1, most, 7]
    assert N.unpacked(N.packed(np.empty(0, np.int64))).tolist() == []
    keys = np.array([0, 5, 1 << 40, (1 << 64) - 1], np.uint64)
    assert N.unpacked_keys(N.packed_keys(keys)).tolist() == keys.tolist()


def test_shingles_are_exact():
    words = "A b  c\td e f g a b c d e".lower().split()
    keys, n = N.shingles(" A b  c\td e f g a b c d E ")
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    assert sorted(n) == sorted(grams.values()) and len(keys) == len(grams)
    assert len(N.shingles("  ")[0]) == 0 and len(N.shingles("x y")[0]) == 1
    assert N.shingles("x y")[0] != N.shingles("y x")[0]
    tail = N.shingles("zz zz zz " + "q r s t u")[0]
    assert set(N.shingles("q r s t u")[0]) <= set(tail)


def test_rarest_shingles_meet_wherever_texts_are_alike(corpus):
    """The filter for crowded buckets is exact: each pair at the threshold shares a
    rare shingle with enough weight from there on."""
    class Table:
        def __init__(self, value):
            self.value = value

    sets = [N.shingles(t) for t in corpus]
    df = np.zeros(N.RARITY_ROWS << N.DF_BITS)
    for k, _ in sets:
        for r in range(N.RARITY_ROWS):
            np.add.at(df, N.places(k, r), 1)
    rarity = Table((np.log((1 + len(sets)) / np.maximum(df, 1)) / np.log(1 + len(sets))))
    idf = Table(np.ones(1 << N.DF_BITS, np.float32))
    batch = N.pa.RecordBatch.from_pydict({
        "k": N.pa.array([str(i).encode() for i in range(len(sets))], N.pa.binary()),
        "r": N.pa.array([b"x"] * len(sets), N.pa.binary()), "t": corpus})
    (out,) = N._rarest(idf, rarity, 0.8)(iter([batch]))
    rare, size = {}, {}
    for s, k, _, total, rest in zip(*(c.to_pylist() for c in out.columns)):
        rare.setdefault(int(k), {})[s] = rest
        size[int(k)] = total
    weighted = [(k, N.weights(k, tf, idf.value)) for k, tf in sets]
    met = 0
    for i in range(len(sets)):
        for j in range(i):
            if N.weighted_jaccard(weighted[i], weighted[j]) >= 0.8:
                met += 1
                assert any(min(rare[i][s], rare[j][s]) * (1 + 1e-9) >= 0.8 / 1.8 * (
                    size[i] + size[j]) for s in rare[i].keys() & rare[j].keys())
    assert met > 100


def test_sample_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    got, want = [], []
    for _ in range(300):
        keys = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
        cut = rng.integers(50, 150)
        w = rng.uniform(0.5, 4, len(keys))
        a, b = (keys[cut:], w[cut:]), (keys[:-cut], w[:-cut] * rng.uniform(0.8, 1.2, len(w) - cut))
        got.append(np.mean(N.icws(*a) == N.icws(*b)))
        want.append(N.weighted_jaccard(a, b))
    assert abs(np.mean(got) - np.mean(want)) < 0.02


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    links += [(i, i + 1) for i in range(500, 560)]  # a long chain
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    as_key = lambda i: i.to_bytes(4, "big")
    df = spark.createDataFrame([(bytearray(as_key(a)), bytearray(as_key(b))) for a, b in links],
                               "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["root"]) for r in N.components(df).collect()}
    assert got == {as_key(i): as_key(find(i)) for i in root}


def test_odd_rows(odd_docs, no_docs):
    out = N.near_classes(odd_docs).toPandas()
    assert len(out) == odd_docs.count()
    five = out[out["doc_id"].isin([5, 6])]
    assert set(five["class_id"]) == {5} and set(five["class_docs"]) == {3}
    assert set(out[out["doc_id"].isin([7, 8])]["class_id"]) == {7}
    assert out[out["doc_id"] == 1]["class_id"].tolist() == [1]
    kept = N.one_per_class(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # NULL texts stay, repeated rows and copies don't; blank and empty texts differ
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 7, 9, 10]
    assert ids.count(None) == 2
    assert N.near_classes(no_docs).count() == 0 and N.one_per_class(no_docs).count() == 0
