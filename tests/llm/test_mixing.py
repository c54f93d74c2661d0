import numpy as np
import pytest

from cdrmill.llm import mixing as M
from .conftest import DOCS


def rake_by_hand(cells, targets, keep):
    """Plain raking over a dict of cells."""
    total = sum(cells.values())
    most = {c: t / total / keep for c, t in cells.items()}
    share = {c: t / total for c, t in cells.items()}
    for _ in range(M.MAX_SWEEPS):
        before = dict(share)
        for d in range(3):
            margin = {}
            for c, s in share.items():
                margin[c[d]] = margin.get(c[d], 0) + s
            share = {c: s * targets[d].get(c[d], 0) / margin[c[d]] if margin[c[d]] else 0
                     for c, s in share.items()}
        share = {c: min(s, most[c]) for c, s in share.items()}
        if max(abs(share[c] - before[c]) for c in share) <= M.TOLERANCE:
            break
    return {c: min(1.0, share[c] / most[c]) for c in share}


@pytest.fixture(scope="module")
def cells():
    rng = np.random.default_rng(6)
    return {(s, la, t): int(rng.integers(1, 2000) * (9 if s == "s0" else 1))
            for s in ("s0", "s1", "s2", "s3") for la in ("en", "de", "fr") for t in "xyz"
            if rng.random() < 0.8}


def frame(spark, cells):
    return spark.createDataFrame([(*c, n) for c, n in cells.items()],
                                 "source string, lang string, topic string, tokens long")


@pytest.mark.parametrize("keep", [0.3, 0.85])
def test_equals_plain_raking(spark, cells, keep):
    df = frame(spark, cells)
    targets = M.tempered_targets(df)
    plain = [{r[0]: r[1] for r in targets[d].collect()} for d in M.DIMS]
    for t in plain:
        assert abs(sum(t.values()) - 1) < 1e-9
    want = rake_by_hand(cells, plain, keep)
    got = {(r["source"], r["lang"], r["topic"]): r["probability"]
           for r in M.rake(df, targets, keep).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_marginals_are_met(spark, cells):
    """Far from the limits, all three marginals of the expected mix are the targets."""
    df = frame(spark, cells)
    targets = M.tempered_targets(df, alpha=0.9)
    out = M.rake(df, targets, keep=0.2).toPandas()
    expected = out["tokens"] * out["probability"]
    assert expected.sum() == pytest.approx(0.2 * out["tokens"].sum(), rel=1e-3)
    for d in M.DIMS:
        want = {r[0]: r[1] for r in targets[d].collect()}
        got = (expected.groupby(out[d]).sum() / expected.sum()).to_dict()
        assert got == pytest.approx(want, abs=1e-4)


def test_drawn_rows_follow_the_probabilities(spark):
    docs = spark.range(6000).selectExpr(
        "id as doc_id", "repeat('w ', int(1 + id % 7)) as text", "if(id % 3 = 0, 'en', 'de') as lang",
        "if(id % 10 < 7, 'hot', 'cold') as source")
    out = M.calibrated(docs).toPandas()
    assert len(out) == 6000 and out["probability"].between(0, 1).all()
    for _, g in out.groupby(["source", "lang", "topic"]):
        p = g["probability"].iloc[0]
        assert abs(g["drawn"].mean() - p) < 5 * (p * (1 - p) / len(g)) ** 0.5 + 1e-9
    kept = M.mix(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(out[out["drawn"]]["doc_id"])


def test_given_targets(spark):
    docs = spark.range(900).selectExpr("id as doc_id", "'a b c' as text", "'en' as lang",
                                       "concat('s', id % 3) as source")
    t = lambda d, rows: spark.createDataFrame(rows, f"{d} string, target double")
    targets = {"source": t("source", [("s0", 0.5), ("s1", 0.5)]), "lang": t("lang", [("en", 1.0)]),
               "topic": t("topic", [("prose", 1.0)])}
    out = M.calibrated(docs, targets, keep=0.4).toPandas()
    p = out.groupby("source")["probability"].first()
    assert p.to_dict() == pytest.approx({"s0": 0.6, "s1": 0.6, "s2": 0.0})


def test_odd_rows(spark, odd_docs, no_docs):
    out = M.calibrated(odd_docs).toPandas()
    assert len(out) == odd_docs.count()
    assert out[out["tokens"] == 0]["drawn"].all() and (out["tokens"] == 0).sum() == 4
    assert "(none)" in set(out["source"])
    assert M.mix(odd_docs).columns == odd_docs.columns
    assert M.calibrated(no_docs).count() == 0 and M.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, *[None] * DOCS.count(","))], DOCS)
    assert M.mix(blank).count() == 1


def test_no_python_in_the_plan(small_docs):
    plan = M.mix(small_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_targets_are_met_at_production_parameters(small_docs):
    """The mix of the query meets its own targets, taking the scarcest cell whole."""
    rows = small_docs.select(*[c.alias(n) for n, c in M._keyed(small_docs, None).items()])
    cells = M._cell_table(rows)
    targets = M.tempered_targets(cells)
    out = M.rake(cells, targets)
    got = out.toPandas()
    assert got["converged"].all()
    assert got[got["tokens"] > 0]["probability"].max() == pytest.approx(1.0)
    for r in M.marginals(out, targets).collect():
        assert r["achieved"] == pytest.approx(r["target"], abs=1e-5), r
    # plain raking, without limits
    plain = [{r[0]: r[1] for r in targets[d].collect()} for d in M.DIMS]
    at = {tuple(c): n for *c, n in cells.select(*M.DIMS, "tokens").collect() if n}
    total = sum(at.values())
    free = rake_by_hand(at, plain, 1e-9)       # no limit is met
    free = {c: p * at[c] / total for c, p in free.items()}
    most = max(free[c] / at[c] for c in at)
    want = {c: free[c] / at[c] / most for c in at}
    have = {(r.source, r.lang, r.topic): r.probability for r in got.itertuples() if r.tokens}
    assert have == pytest.approx(want, abs=1e-4)


def test_an_unfinished_raking_says_so(spark, cells):
    df = frame(spark, cells)
    targets = M.tempered_targets(df, alpha=0.3)
    assert not M.rake(df, targets, max_sweeps=1).first()["converged"]
    assert M.rake(df, targets).first()["converged"]


def test_marginals_show_what_is_missed(spark):
    df = frame(spark, {("a", "en", "x"): 90, ("b", "en", "x"): 10})
    t = lambda d, rows: spark.createDataFrame(rows, f"{d} string, target double")
    targets = {"source": t("source", [("a", 0.5), ("b", 0.5)]), "lang": t("lang", [("en", 1.0)]),
               "topic": t("topic", [("x", 1.0)])}
    share = lambda keep: {r["value"]: r["achieved"] for r in M.marginals(
        M.rake(df, targets, keep), targets).where("dimension = 'source'").collect()}
    assert share(None) == pytest.approx({"a": 0.5, "b": 0.5})
    assert share(0.5)["b"] < 0.3  # half of all tokens can't hold so many of b
