"""Toxicity scores: gradient-boosted trees over dense features, calibrated.

1. A lexicon is mined from labelled training texts: words, and word beginnings
   of four to six letters, that occur in far more toxic than clean texts, beside
   a fixed list of insults.  Training rows see a lexicon mined without their own
   fold.
2. Every text becomes a short dense vector: lexicon densities, hits near second
   person words, capitals, punctuation and obfuscation rates.
3. Boosted trees are fitted on three training folds, an isotonic curve on the
   fourth maps their probability to a calibrated score.

Only fitting looks at labels, and at no more than ``MAX_LABELLED`` of them (the
first by hash); every text is scored whole.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrmill.llm.common import checkpointed, fresh, stored, table, text_key

# Documented bounds of the fit; what is scored has none.
MAX_LABELLED = 20_000
HELD_TERMS = 50_000    # counts that a task holds before it hands them on
FOLDS = 5              # fold 0 is held out
LEXICON_FOLDS = (1, 2, 3, 4)
TREE_FOLDS, CURVE_FOLD = (1, 2, 3), 4
MIN_TOXIC_TEXTS = 3
MIN_LOG_ODDS = 2.5
PREFIXES = (4, 5, 6)
NEAR = 5               # words between a hit and a second person word

INSULTS = frozenset("""
    arse arsehole ass asshole bastard bitch bollocks brainless bullshit clown coward crap cretin
    creep cunt dick dickhead disgusting dumb dumbass dunce filth filthy fool freak fuck fucker
    fucking garbage idiot idiotic imbecile jerk liar loser lowlife moron moronic nitwit parasite
    pathetic pig pussy rat retard scum scumbag shit shithead shut slut stupid suck trash twat ugly
    useless vermin vile wanker weak whore worthless
    abschaum arschloch depp dreck dumm dummkopf fotze hure idiotin miststueck schlampe schwein
    trottel versager wichser
    abruti bouffon connard connasse cretin debile encule imbecile merde minable ordure pute salaud
    salope stupide
    basura cabron estupido gilipollas imbecil inutil maricon mierda pendejo perra puta tonto zorra
""".split())
SECOND_PERSON = frozenset("""
    you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie ihnen
    tu toi te ton ta tes vous votre vos usted ustedes ti contigo vosotros tus tuyo
""".split())
LEET = str.maketrans("013457@$!", "oieastasi")
WORD = re.compile(r"\w+")
# letters with digits or signs put between them: id1ot, tr@sh, m*ron
DISGUISED = re.compile(r"\b[^\W\d_]+[0-9@$*!#]+[^\W\d_][\w@$*#]*")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
SPACED = re.compile(r"\b(?:[^\W\d_][ .\-_]){3,}[^\W\d_]\b")
RUN_OF_MARKS = re.compile(r"[!?]{2,}")
FEATURES = ("insult_density", "term_density", "terms", "distinct_terms", "term_weight",
            "strongest_term", "near_you_density", "near_you_share", "you_density", "capitals",
            "shouted_words", "exclamations", "mark_runs", "punctuation", "disguised",
            "disguised_insults", "stretched", "spaced", "log_words")


def terms_of(word: str) -> list[str]:
    """The lexicon entries a word can match: itself and its beginnings."""
    return [word, *(f"^{word[:k]}" for k in PREFIXES if len(word) > k)]


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The dense vector ``FEATURES`` of a text; zeros for NULL or empty texts."""
    if not text:
        return [0.0] * len(FEATURES)
    words = WORD.findall(text)
    low = [w.lower() for w in words]
    n, chars = max(len(words), 1), len(text)
    weight: dict[str, float] = {}
    insults, hits, distinct, total, top = 0, [], set(), 0.0, 0.0
    you = [i for i, w in enumerate(low) if w in SECOND_PERSON]
    for i, w in enumerate(low):
        if (x := weight.get(w)) is None:
            x = max(lexicon.get(t, 0.0) for t in terms_of(w))
            weight[w] = x = max(x, 3.0) if w in INSULTS else x
        if x:
            insults += w in INSULTS
            hits.append(i)
            distinct.add(w)
            total += x
            top = max(top, x)
    near, k = 0, 0
    for i in hits:
        while k < len(you) and you[k] < i - NEAR:
            k += 1
        near += k < len(you) and you[k] <= i + NEAR
    letters = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text))
    shouted = sum(len(w) > 2 and w.isupper() for w in words)
    disguised = DISGUISED.findall(text)
    plain = [d.lower().translate(LEET).replace("*", "").replace("#", "") for d in disguised]
    return [
        insults / n, len(hits) / n, math.log1p(len(hits)), math.log1p(len(distinct)), total / n,
        top, near / n, near / max(len(hits), 1), len(you) / n, upper / max(letters, 1),
        shouted / n, text.count("!") / chars, len(RUN_OF_MARKS.findall(text)) / n,
        sum(text.count(c) for c in ".,;:?!") / chars, len(disguised) / n,
        float(sum(p in INSULTS or any(t in lexicon for t in terms_of(p)) for p in plain)),
        len(STRETCHED.findall(text)) / n, len(SPACED.findall(text)) / n, math.log1p(len(words))]


def feature_column(text: Column, fold: Column, lexicons: dict[int, dict[str, float]]) -> Column:
    """``features`` of a text with the lexicon for its fold (0: the whole one)."""
    @F.arrow_udf("array<double>")
    def run(texts: pa.Array, folds: pa.Array) -> pa.Array:
        flat = array("d")  # one text at a time, no list of all texts beside the batch
        for t, f in zip(texts, folds):
            flat.extend(features(t.as_py(), lexicons[f.as_py()]))
        n = len(FEATURES)
        return pa.ListArray.from_arrays(pa.array(range(0, len(flat) + 1, n), pa.int32()),
                                        pa.array(np.frombuffer(flat, np.float64)))
    return run(text, fold)


def fold_of(doc_id: Column | str) -> Column:
    """``crc32`` of the id as text, modulo ``FOLDS``; 0 (held out) is never learnt
    from.  A NULL id is in fold 0 here, but not reported as held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce((F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS).cast("int"),
                      F.lit(0))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, fold) of at most ``MAX_LABELLED`` labelled rows outside fold
    0, equal texts once.  An id with several labels counts as toxic if one is."""
    chosen = (labels.where("doc_id is not null and toxic is not null")
              .where(fold_of("doc_id") != 0)
              .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED))
    rows = (docs.select("doc_id", "text").where("text is not null")
            .join(F.broadcast(chosen), "doc_id")  # at most MAX_LABELLED rows
            .select("text", "toxic", fold_of("doc_id").alias("fold"),
                    text_key(F.col("text")).alias("k")))
    best = rows.groupBy("k").agg(F.max(F.struct("toxic", "fold", "text")).alias("r"))
    return stored(best.select("r.*"), "toxic-training")


def _term_counts(rows: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """(term, fold, toxic, texts): in how many texts a term occurs.  Tasks count as
    they go and hand on their counts whenever ``HELD_TERMS`` are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed() -> pa.RecordBatch:
            keys = list(held)
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()),
                 pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([k[2] for k in keys], pa.int32()),
                 pa.array(held.values(), pa.int64())], ["term", "fold", "toxic", "texts"])
            held.clear()
            return out

        for batch in batches:
            for text, toxic, fold in zip(*(batch.column(c) for c in ("text", "toxic", "fold"))):
                toxic, fold = toxic.as_py(), fold.as_py()
                terms = {t for w in set(WORD.findall(text.as_py().lower())) for t in terms_of(w)}
                held.update((t, fold, toxic) for t in (terms if wanted is None else terms & wanted))
                if len(held) >= HELD_TERMS:
                    yield handed()
        if held:
            yield handed()

    return (rows.select("text", "toxic", "fold")
            .mapInArrow(run, "term string, fold int, toxic int, texts long")
            .groupBy("term", "fold", "toxic").agg(F.sum("texts").alias("texts")))


def mine_lexicons(rows: DataFrame) -> dict[int, dict[str, float]]:
    """Term weights (log odds of being in a toxic rather than a clean text), once
    from all training folds (key 0) and once without each.  Terms are sought in
    toxic texts, then counted in all.  What reaches the driver is bounded by the
    training rows: terms that ``MIN_TOXIC_TEXTS`` of them share, and the weights of
    those that pass."""
    totals = {(r["fold"], r["toxic"]): r["n"] for r in
              rows.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    often = (_term_counts(rows.where("toxic = 1"), None).groupBy("term")
             .agg(F.sum("texts").alias("n")).where(F.col("n") >= MIN_TOXIC_TEXTS))
    wanted = frozenset(r["term"] for r in often.select("term").toLocalIterator())
    met = lambda f, c: (F.col("fold") == f) & (F.col("toxic") == c)
    counts = _term_counts(rows, wanted).groupBy("term").agg(
        *[F.coalesce(F.sum(F.when(met(f, c), F.col("texts"))), F.lit(0)).alias(f"n{f}_{c}")
          for f in LEXICON_FOLDS for c in (0, 1)])
    left_outs = (0, *LEXICON_FOLDS)
    weights = []
    for left_out in left_outs:
        folds = [f for f in LEXICON_FOLDS if f != left_out]
        in_all = [sum(totals.get((f, c), 0) for f in folds) for c in (0, 1)]
        clean, toxic = (reduce(add, [F.col(f"n{f}_{c}") for f in folds]) for c in (0, 1))
        odds = F.log((toxic + 0.5) / (in_all[1] + 1)) - F.log((clean + 0.5) / (in_all[0] + 1))
        weights.append(F.when((toxic >= MIN_TOXIC_TEXTS) & (odds >= MIN_LOG_ODDS),
                              F.least(odds, F.lit(8.0))).alias(f"w{left_out}"))
    passed = counts.select("term", *weights).where(
        F.coalesce(*[F.col(f"w{i}") for i in left_outs]).isNotNull())
    out: dict[int, dict[str, float]] = {i: {} for i in left_outs}
    for r in passed.toLocalIterator():
        for i in left_outs:
            if r[f"w{i}"] is not None:
                out[i][r["term"]] = r[f"w{i}"]
    return out


class ToxicityModel:
    """A fitted lexicon, trees and calibration curve.  Where the training rows
    hold one class only (or none), every text scores that class's label (0.0)."""

    def __init__(self, lexicons, trees, curve, constant: float = 0.0):
        self.lexicons, self.trees, self.curve, self.constant = lexicons, trees, curve, constant

    def scored(self, docs: DataFrame, score: str) -> DataFrame:
        """``docs`` with the column ``score`` (0 to 1) added."""
        if self.trees is None:
            return docs.withColumn(score, F.lit(self.constant))
        vector, chance = fresh(docs, "toxic_features"), fresh(docs, "toxic_chance")
        out = docs.withColumn(vector, array_to_vector(feature_column(
            F.col("text"), F.lit(0), {0: self.lexicons[0]})))
        out = _raw(self.trees, out, vector, chance)
        if self.curve is None:
            return out.withColumnRenamed(chance, score)
        self.curve.setFeaturesCol(chance).setPredictionCol(score)
        out = self.curve.transform(out).drop(chance)
        return out.withColumn(score, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(score))))


def _raw(trees, rows: DataFrame, vector: str, chance: str) -> DataFrame:
    """The trees' probability of label 1, as a plain column."""
    both = fresh(rows, "toxic_both")
    trees.setFeaturesCol(vector).setProbabilityCol(both).setRawPredictionCol("").setPredictionCol("")
    return (trees.transform(rows).withColumn(chance, vector_to_array(both)[1])
            .drop(both, vector))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from ``labels`` (``doc_id, toxic``; NULLs are skipped) and the texts
    of ``docs`` outside fold 0."""
    rows = training_rows(docs, labels)
    classes = {(r["curve"], r["toxic"]) for r in rows.select(
        (F.col("fold") == CURVE_FOLD).alias("curve"), "toxic").distinct().collect()}
    if not {(False, 0), (False, 1)} <= classes:
        return ToxicityModel(None, None, None, float((False, 1) in classes))
    lexicons = mine_lexicons(rows)
    rows = checkpointed(rows.select(
        F.col("toxic").cast("double").alias("label"), "fold",
        array_to_vector(feature_column(F.col("text"), F.col("fold"), lexicons)).alias("vector")))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=20, maxDepth=3,
                          stepSize=0.2, maxBins=64, seed=7, checkpointInterval=-1).fit(
        rows.where(F.col("fold").isin(*TREE_FOLDS)).coalesce(6))
    curve = None
    if {(True, 0), (True, 1)} <= classes:
        fitted = _raw(trees, rows.where(F.col("fold") == CURVE_FOLD), "vector", "chance")
        curve = IsotonicRegression(featuresCol="chance", labelCol="label").fit(fitted.coalesce(1))
    return ToxicityModel(lexicons, trees, curve)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    NULL and empty texts are scored like texts without words.  Repeated rows give
    repeated rows.  Other columns, and language, source, id or label, never
    enter a score.
    """
    model = fit_toxicity(docs, labels)
    rows = docs.select("doc_id", "text", F.coalesce(
        (fold_of("doc_id") == 0) & F.col("doc_id").isNotNull(), F.lit(False)).alias("held_out"))
    return model.scored(rows, "score").select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay."""
    score = fresh(docs, "toxic_score")
    return (fit_toxicity(docs, labels).scored(docs, score)
            .where(F.col(score) < 0.5).drop(score))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels outside fold 0."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
