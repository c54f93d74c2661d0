import random
from itertools import combinations

import pytest

from cdrmill.llm import decontam as D
from .conftest import DOCS, doc_rows

MASKS = [[i for i, b in enumerate(m) if b == "1"] for m in D.MASKS]


def brute(doc, item):
    """Best verified overlap of two word lists, by the definition."""
    def run(pairs):
        score = best = words = same = n = s = 0
        for e in pairs:
            if score < best - D.GIVE_UP:
                break
            score += 1 if e else D.REPLACED
            n, s = n + 1, s + e
            if score > best:
                best, words, same = score, n, s
        return words, same

    found = []
    for p in range(len(doc) - D.SPAN + 1):
        for q in range(len(item) - D.SPAN + 1):
            eq = [doc[p + k] == item[q + k] for k in range(D.SPAN)]
            if any(all(eq[k] for k in m) for m in MASKS):
                lw, ls = run(doc[p - k] == item[q - k] for k in range(1, min(p, q) + 1))
                rw, rs = run(a == b for a, b in zip(doc[p + D.SPAN:], item[q + D.SPAN:]))
                n, s = lw + rw + D.SPAN, ls + rs + sum(eq)
                if n >= D.MIN_WORDS and s >= D.MIN_EQUAL * n:
                    found.append((s, n, -(p - lw)))
    return max(found, default=None)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(9)
    word = lambda: f"v{rng.randrange(400)}"
    items = [[word() for _ in range(rng.randint(5, 45))] for _ in range(25)]
    items.append(items[0])
    docs = []
    for k in range(120):
        doc = [word() for _ in range(rng.randint(0, 120))]
        if k % 2:
            part = list(rng.choice(items))
            lo = rng.randrange(len(part))
            part = part[lo // 2:]
            for i in range(len(part)):
                if rng.random() < (0, .08, .2, .4)[k % 4]:
                    part[i] = word()
            at = rng.randint(0, len(doc))
            doc[at:at] = part
        docs.append(doc)
    return docs, items


@pytest.mark.parametrize("limit", [D.BROADCAST_BYTES, 0])
def test_equals_brute_force(spark, case, limit):
    docs, items = case
    want = {(i, j): b for i, d in enumerate(docs) for j, t in enumerate(items)
            if (b := brute(d, t))}
    assert len(want) > 20
    df = spark.createDataFrame(doc_rows([(i, ", ".join(d).upper()) for i, d in enumerate(docs)]),
                               DOCS)
    bench = spark.createDataFrame([(j, " ".join(t), "x") for j, t in enumerate(items)],
                                  "item_id long, text string, w string")
    got = {(r["doc_id"], r["item_id"]): (r["n_equal"], r["n_words"], -r["first_word"])
           for r in D.contaminated(df, bench, limit).collect()}
    assert got == want
    clean = D.decontaminate(df, bench)
    assert clean.columns == df.columns
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(docs))) - {i for i, _ in want}


def test_every_pair_of_close_replacements_is_tolerated():
    for gap in range(1, 7):
        assert any(m[i] == m[i + gap] == "0" for m in D.MASKS for i in range(D.SPAN - gap))


def overlap(doc, item):
    """Whether two word lists overlap by the definition, without seeds."""
    for shift in range(-len(item) + 1, len(doc)):
        p = max(shift, 0)
        sums = [0]
        for a, b in zip(doc[p:], item[p - shift:]):
            sums.append(sums[-1] + (a == b))
        if any(sums[j] - sums[i] >= D.MIN_EQUAL * (j - i)
               for i in range(len(sums)) for j in range(i + D.MIN_WORDS, len(sums))):
            return True
    return False


def test_every_placement_of_replaced_words_is_hit():
    for n, k in ((12, 2), (15, 3), (20, 4)):
        for lost in combinations(range(n), k):
            assert any(all(at + i not in lost for i in m)
                       for at in range(n - D.SPAN + 1) for m in MASKS), (n, lost)


@pytest.mark.parametrize("limit", [D.BROADCAST_BYTES, 0])
def test_equals_definition_without_seeds(spark, limit):
    """Short items with a fifth or a little more of the words replaced, also in
    longer items and at the ends, against all alignments of all pairs."""
    rng = random.Random(4)
    word = lambda: f"v{rng.randrange(3000)}"
    items = [[word() for _ in range(n)] for n in (12, 12, 13, 15, 15, 16, 20, 25, 30, 45)]
    docs = []
    for k in range(400):
        part = list(items[k % len(items)])
        lo = rng.randrange(len(part) - 11)
        part = part[lo:lo + rng.randint(12, len(part))]
        for i in rng.sample(range(len(part)), int(len(part) * .2) + (k % 4 == 0)):
            part[i] = word()
        docs.append([word() for _ in range(rng.randint(0, 30))] + part
                    + [word() for _ in range(rng.randint(0, 30))])
    want = {(i, j) for i, d in enumerate(docs) for j, t in enumerate(items) if overlap(d, t)}
    assert len(want) > 300
    df = spark.createDataFrame(doc_rows([(i, " ".join(d)) for i, d in enumerate(docs)]), DOCS)
    bench = spark.createDataFrame([(j, " ".join(t)) for j, t in enumerate(items)],
                                  "item_id long, text string")
    out = D.contaminated(df, bench, limit).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == want
    for r in out:
        part = docs[r["doc_id"]][r["first_word"]:r["first_word"] + r["n_words"]]
        item = items[r["item_id"]]
        assert len(part) == r["n_words"] >= D.MIN_WORDS
        assert r["n_equal"] >= D.MIN_EQUAL * r["n_words"]
        assert any(sum(a == b for a, b in zip(part, item[q:])) == r["n_equal"]
                   for q in range(len(item) - len(part) + 1))


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(
        [(1, None), (None, ""), (3, "short one"), (None, " ".join(f"word{i * 7919 % 1009}"
                                                                for i in range(300, 340)))],
        "item_id long, text string")
    out = D.contaminated(odd_docs, bench).collect()
    assert {r["doc_id"] for r in out} == {7, 8} and {r["item_id"] for r in out} == {None}
    assert D.decontaminate(odd_docs, bench).count() == odd_docs.count() - 2
    assert D.decontaminate(no_docs, bench).count() == 0
    assert D.decontaminate(odd_docs, bench.where("false")).count() == odd_docs.count()


def test_plan_has_no_python(small_docs, spark):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = D.contaminated(small_docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
