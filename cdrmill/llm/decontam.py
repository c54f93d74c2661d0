"""Benchmark decontamination by spaced-seed hashing.

A seed of ten word positions ignores four of them, so it still hits where a
copied passage had words replaced.  The four seeds together hit every passage of
12 words or more with up to a fifth of them replaced, wherever those stand (it is
enough to hit 2 replaced of 12, 3 of 15 and 4 of 20: a longer passage, cut in two,
has a part with no larger share).  The seeds of the benchmark items are joined to
those of the documents, and around every hit the aligned words are compared:
every window of 12 words around the hit (the masks) is extended to both sides while equal words outweigh replaced ones.
Where that ends in a run too short or too unequal, the best run of the whole
alignment counts, so an overlap that meets the definition is never lost.

Only built-in expressions are used.  Seeds are made after the positions are
exploded, inside one code-generated stage with the join, so a document's words
are referenced, not copied, until a seed hits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrmill.llm.common import checkpointed, fresh, table, text_key
from cdrmill.operators.lookup import sized_broadcast

SEEDS = ("1100110101", "1010001111", "1111100100", "0111001011")
MIN_WORDS = 12
SHIFTS = MIN_WORDS - len(SEEDS[0])  # a seed's places in a window
MASKS = tuple("0" * i + s + "0" * (SHIFTS - i) for s in SEEDS for i in range(SHIFTS + 1))
SPAN = len(MASKS[0])
MIN_EQUAL = 0.8
REPLACED = -2   # score of a replaced word; an equal one counts 1
GIVE_UP = 8     # stop extending this far below the best score
PAID_BY = 4     # equal words that make up for a replaced one at MIN_EQUAL
BROADCAST_BYTES = 32 << 20


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits of a text."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, pos: str, keep: list[str]) -> DataFrame:
    """One row per seed of the word list ``w``: its hash and its position."""
    at = rows.withColumn(pos, F.explode(F.when(
        F.size("w") >= SPAN, F.sequence(F.lit(0), F.size("w") - len(SEEDS[0])))))

    def seed(no: int, mask: str) -> Column:
        used = [F.get("w", F.col(pos) + i) for i, bit in enumerate(mask) if bit == "1"]
        return F.xxhash64(F.lit(no), *used)

    return at.select(*keep, pos, F.explode(F.array(
        *[seed(no, mask) for no, mask in enumerate(SEEDS)])).alias("seed"))


def _extended(equal: Column) -> Column:
    """How far an overlap reaches along ``equal`` (array of booleans, read away
    from the hit): struct(words, same) at the best running score."""
    start = F.struct(F.lit(0).alias("score"), F.lit(0).alias("best"), F.lit(0).alias("seen"),
                     F.lit(0).alias("seen_same"), F.lit(0).alias("words"), F.lit(0).alias("same"))

    def step(s: Column, e: Column) -> Column:
        given_up = s["score"] < s["best"] - GIVE_UP
        score = s["score"] + F.when(given_up, 0).when(e, 1).otherwise(REPLACED)
        seen, seen_same = s["seen"] + 1, s["seen_same"] + e.cast("int")
        better = ~given_up & (score > s["best"])
        return F.struct(
            score.alias("score"), F.when(better, score).otherwise(s["best"]).alias("best"),
            seen.alias("seen"), seen_same.alias("seen_same"),
            F.when(better, seen).otherwise(s["words"]).alias("words"),
            F.when(better, seen_same).otherwise(s["same"]).alias("same"))

    return F.aggregate(equal, start, step,
                       lambda s: F.struct(s["words"].alias("words"), s["same"].alias("same")))


def _best_run(equal: Column) -> Column:
    """The run of ``MIN_WORDS`` or more in ``equal`` (array of booleans) with the best
    score (1 an equal word, ``-PAID_BY`` a replaced one), the first of those:
    struct(score, words, same, first).  A run is equal enough if its score is not
    negative, so there is one exactly if the best run's is not."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(equal) - 1), lambda i: F.struct(
        i.alias("i"), F.get(equal, i).cast("int").alias("new"),
        F.coalesce(F.get(equal, i - MIN_WORDS).cast("int"), F.lit(0)).alias("old")))
    none = F.lit(-(1 << 30))
    start = F.struct(F.lit(0).alias("last"), none.alias("score"), F.lit(0).alias("words"),
                     F.lit(0).alias("same"), F.struct(
                         none.alias("score"), F.lit(0).alias("words"), F.lit(0).alias("same"),
                         F.lit(0).alias("first")).alias("best"))

    def step(s: Column, e: Column) -> Column:
        last = s["last"] + e["new"] - e["old"]  # equal ones of the last MIN_WORDS
        fresh_score = last - PAID_BY * (F.lit(MIN_WORDS) - last)
        longer = s["score"] + F.when(e["new"] == 1, 1).otherwise(-PAID_BY)
        enough, go_on = e["i"] >= MIN_WORDS - 1, longer >= fresh_score
        score = F.when(~enough, none).when(go_on, longer).otherwise(fresh_score)
        words = F.when(go_on, s["words"] + 1).otherwise(MIN_WORDS)
        same = F.when(go_on, s["same"] + e["new"]).otherwise(last)
        run = F.struct(score.alias("score"), words.alias("words"), same.alias("same"),
                       (e["i"] + 1 - words).alias("first"))
        return F.struct(last.alias("last"), score.alias("score"), words.alias("words"),
                        same.alias("same"), F.when(enough & (score > s["best"]["score"]), run)
                        .otherwise(s["best"]).alias("best"))

    return F.aggregate(pairs, start, step, lambda s: s["best"])


def _verified(hits: DataFrame) -> DataFrame:
    """Overlaps in the hit alignments that are long and equal enough.  A hit has the
    item words ``iw``, the document words ``w`` beside them, the places ``at`` in the
    document and ``iat`` in the item where the alignment begins, and the ``places``
    of the hits from there on."""
    same = lambda a, b: F.zip_with(a, b, lambda x, y: x == y)
    cut = lambda c, start, n: F.slice(c, start + 1, n)
    pos, size = F.col("pos"), F.size("e")
    length = F.least(F.size("w"), F.size("iw") - F.col("iat"))
    hits = (hits.withColumn("e", same(cut("w", F.lit(0), length),
                                      cut("iw", F.col("iat"), length)))
            .withColumn("all", F.size(F.filter("e", lambda e: e)))
            .where((size >= MIN_WORDS) & (F.col("all") >= math.ceil(MIN_EQUAL * MIN_WORDS)))
            .withColumn("run", _best_run(F.col("e"))).where("run.score >= 0"))
    windows = F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(0), F.lit(SHIFTS)),
        lambda i: F.transform("places", lambda p: p - i))))
    windows = F.filter(windows, lambda p: (p >= 0) & (p + SPAN <= size))
    # from each window of equal alignments the extension reaches both ends
    windows = F.when(F.col("all") == size, F.slice(windows, 1, 1)).otherwise(windows)
    hits = hits.withColumn("pos", F.explode(windows))
    hits = (hits
            .withColumn("l", _extended(F.reverse(cut("e", F.lit(0), pos))))
            .withColumn("r", _extended(cut("e", pos + SPAN, size)))
            .withColumn("mid", F.size(F.filter(cut("e", pos, F.lit(SPAN)), lambda e: e))))
    hits = (hits.withColumn("n_words", F.col("l.words") + F.col("r.words") + SPAN)
            .withColumn("n_equal", F.col("l.same") + F.col("r.same") + F.col("mid"))
            .withColumn("first_word", F.col("at") + pos - F.col("l.words"))
            .withColumn("extended", (F.col("n_words") >= MIN_WORDS)
                        & (F.col("n_equal") >= MIN_EQUAL * F.col("n_words"))))
    or_run = lambda c, run: F.when(F.col("extended"), F.col(c)).otherwise(run).alias(c)
    return hits.select(
        "doc_id", "text_key", "item_id", "extended", or_run("n_words", F.col("run.words")),
        or_run("n_equal", F.col("run.same")),
        or_run("first_word", F.col("at") + F.col("run.first")))


def contaminated(docs: DataFrame, benchmark: DataFrame,
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document text and benchmark item that overlap: ``doc_id,
    text_key, item_id, first_word, n_words, n_equal, similarity`` (of the
    overlap with most equal words; then the longest, then the first; an extended
    hit goes before a best run).

    An overlap has ``MIN_WORDS`` words or more, ``MIN_EQUAL`` of them equal at
    equal places.  Texts or items that are NULL, empty or shorter than
    ``MIN_WORDS`` take no part: an item below 12 words is not searched, so not even
    an exact copy of it is found.  Repeated rows give one result row; rows of one
    ``doc_id`` with different texts are kept apart by ``text_key``.  Columns
    other than ``doc_id, text`` and ``item_id, text`` are ignored.

    The item seeds are broadcast if their measured size is within
    ``broadcast_bytes``; beyond it both sides shuffle by seed, and the few
    documents that hit are joined to their words again.
    """
    words = docs.select("doc_id", text_key(F.col("text")).alias("text_key"),
                        word_hashes(F.col("text")).alias("w")).where(F.size("w") >= SPAN)
    items = checkpointed(
        benchmark.select("item_id", text_key(F.col("text")).alias("ikey"),
                         word_hashes(F.col("text")).alias("w")).where(F.size("w") >= SPAN)
        .dropDuplicates(["item_id", "ikey"]))
    seeds = _seeds(items.dropDuplicates(["ikey"]).withColumn("n", F.size("w")), "ipos",
                   ["ikey", "n"])
    item_words = items.select("item_id", "ikey", F.col("w").alias("iw"))
    seeds, small = sized_broadcast(checkpointed(seeds), broadcast_bytes)
    item_words, small_items = sized_broadcast(item_words, broadcast_bytes)
    # only the words beside the item go on, however long the document, and an
    # alignment goes on once, however many seeds hit in it
    ahead = (F.col("pos") - F.col("ipos")).alias("ahead")
    at = F.greatest("ahead", F.lit(0))
    beside = F.slice("w", at + 1, F.col("n")).alias("w")
    places = F.collect_set("pos").alias("places")
    if small:
        hits = (_seeds(words, "pos", ["doc_id", "text_key", "w"]).join(seeds, "seed")
                .select("*", ahead).select("doc_id", "text_key", "ikey", "ahead", "pos", beside)
                .groupBy("doc_id", "text_key", "ikey", "ahead").agg(places, F.first("w").alias("w")))
    else:
        hits = (_seeds(words, "pos", ["text_key"]).join(seeds, "seed").select("*", ahead)
                .groupBy("text_key", "ikey", "ahead", "n").agg(places).join(words, "text_key")
                .select("doc_id", "text_key", "ikey", "ahead", "places", beside))
    hits = hits.select("doc_id", "text_key", "ikey", at.alias("at"),
                       (at - F.col("ahead")).alias("iat"), "w",
                       F.transform("places", lambda p: p - at).alias("places"))
    found = _verified(hits.join(item_words, "ikey"))
    best = F.max(F.struct("extended", "n_equal", "n_words", (-F.col("first_word")).alias("back")))
    return (found.groupBy("doc_id", "text_key", "item_id").agg(best.alias("b"))
            .select("doc_id", "text_key", "item_id", (-F.col("b.back")).alias("first_word"),
                    "b.n_words", "b.n_equal",
                    (F.col("b.n_equal") / F.col("b.n_words")).alias("similarity")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text overlaps a benchmark item; all
    columns stay, and rows with a NULL text stay."""
    bad = checkpointed(contaminated(docs, benchmark).select("text_key").distinct())
    bad, _ = sized_broadcast(bad, BROADCAST_BYTES)
    key = fresh(docs, "text_key")
    bad = bad.withColumnRenamed("text_key", key)
    return (docs.withColumn(key, text_key(F.col("text"))).join(bad, key, "left_anti").drop(key))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and benchmark items that share a passage."""
    return contaminated(table(spark, sf_dir, "documents"),
                        table(spark, sf_dir, "benchmark")).drop("text_key")
