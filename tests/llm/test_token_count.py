import random

import pytest
from tokenizers import Tokenizer

from cdrmill.llm import token_count as C

ODD = ["", "  ", "Hello World's it'S don't I'LL <|endoftext|> x<|startoftext|>y", "naïve café 中文 あ",
       "İstanbul K ſ 123 ½ ² Ⅷ ǅ", "a​b   tab\tnl\n", "''''s ''re", "😀😀 ok",
       "<|ENDOFTEXT|> <|endoftext <|endoftext|><|endoftext|>", "ß ẞ ŉ ǰ Σας ΟΔΟΣ don’t",
       "\x00\x01 \x85 \x1c a\x1cb", "É È\xa0ñ ª º µ × ÷", "é É", "x" * 3000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(C.vocabulary_path())


def n_tokens(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library(spark, small_docs, small_texts, library):
    out = C.token_counts(small_docs).collect()
    assert len(out) == len(small_texts)
    for r in out:
        t = small_texts[r["doc_id"]]
        n = n_tokens(library, t)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 2048)


def test_odd_texts(library):
    counter = C.prefix_counter(C.vocabulary_path())
    for t in ODD:
        assert counter.count(t) == n_tokens(library, t), t


def test_every_prefix(library, small_texts):
    """The table answers every cut of a text without encoding it again."""
    counter = C.PrefixCounter(C.vocabulary_path())
    rng = random.Random(2)
    texts = [t[:120] for t in rng.sample(sorted(small_texts.values()), 25) if t.isascii()]
    texts += ["nasty tests' it's 12 ab!?!", "unbelievably"]
    for t in texts:
        counts = counter.prefix_counts(t)
        words = counter.split(t)
        assert [len(c) for c in counts] == [len(w) + 1 for w in words]
        for k, w in enumerate(words):
            before = " ".join(words[:k])
            for i in range(1, len(w) + 1):
                # a space between words changes no count: words are encoded one by one
                whole = n_tokens(library, w[:i]) if len(counter.split(w[:i])) == 1 else None
                if whole is not None:
                    assert counts[k][i] == counts[k][0] + whole, (before, w[:i])


def test_cut_is_the_longest_that_fits(library, small_texts):
    counter = C.prefix_counter(C.vocabulary_path())
    for t in [t for t in small_texts.values() if t.isascii()][:40]:
        for limit in (1, 7, 50):
            total, word, byte = counter.count_and_cut(t, limit)
            words = counter.split(t)
            if total <= limit:
                assert word is None
                continue
            kept = sum(n_tokens(library, w) for w in words[:word])
            part = counter.table(words[word])
            assert kept + part[byte] <= limit < kept + part[-1]
            assert all(kept + c > limit for c in part[byte + 1:])


def test_full_tables_are_rebuilt(library, small_texts, monkeypatch):
    for name in ("WORDS_KEPT", "PREFIXES_KEPT", "PAIRS_KEPT"):
        monkeypatch.setattr(C, name, 50)
    counter = C.PrefixCounter(C.vocabulary_path())
    for t in list(small_texts.values())[:10]:
        assert counter.count(t) == n_tokens(library, t)


def test_stored_table_answers_budgets(spark, small_docs):
    stored = C.prefix_table(small_docs)
    a = stored.where(C.fits(C.F.col("prefix_counts"), 500)).select("doc_id").collect()
    b = C.token_counts(small_docs).where("n_tokens <= 500").select("doc_id").collect()
    assert sorted(a) == sorted(b) and 0 < len(a) < small_docs.count()


def test_odd_rows(odd_docs, no_docs, library):
    out = C.token_counts(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert [(r["n_bytes"], r["n_tokens"]) for r in out if r["doc_id"] in (1, 2)] == [(0, 0)] * 2
    assert [r["over_limit"] for r in out if r["doc_id"] == 7] == [True]
    assert C.token_counts(no_docs).count() == 0
    assert C.prefix_table(odd_docs).where(C.fits(C.F.col("prefix_counts"), 0)).count() >= 3


def test_one_very_long_word_in_bounded_memory(library):
    """One word of 200,000 letters takes less than 500 MB; long words are exact."""
    import resource
    word = "".join(chr(97 + i * i * 7 % 26) for i in range(200_000))
    counter = C.PrefixCounter(C.vocabulary_path())
    for n in (C.LONG_WORD, C.LONG_WORD + 1, 3000):
        assert counter.count(word[:n]) == n_tokens(library, word[:n])
        assert counter.table(word[:300]) == [0, *(n_tokens(library, word[:i]) for i in range(1, 301))]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert counter.count(word) > 10_000
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 500


def test_long_words_by_position_equal_the_kept_prefixes(monkeypatch):
    counter = C.PrefixCounter(C.vocabulary_path())
    words = ["abcabcabd" * 20, "\u4e2d\u6587" * 30, "x" * 200]
    kept = [(counter.total(w), counter.table(counter.as_symbols(w))) for w in words]
    monkeypatch.setattr(C, "LONG_WORD", 8)
    assert [(counter.total(w), counter.table(counter.as_symbols(w))) for w in words] == kept
