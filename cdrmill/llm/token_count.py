"""Exact token counts at every prefix of a text, by dynamic programming.

In a byte-pair vocabulary a sequence of tokens is an encoding exactly when each
two neighbours are the encoding of their joined text.  So for every prefix of a
word one last token suffices: the longest token that ends there and fits the last
token of the prefix before it.  A table of last tokens and counts follows from
left to right, once per distinct word, and holds the exact count of every
prefix.  Texts add up the counts of their words; where a text is cut (at a token
limit, or at a given length) the cut word's table has the answer and nothing is
encoded again.

The vocabulary here marks word ends (``</w>``), so a prefix has two tables: as
the start of a longer word, and as a word that ends there.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from unicodedata import normalize

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrmill.llm.common import table

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
# table entries kept per Python worker; a full table is emptied and filled anew
LONG_WORD = 256  # symbols; longer words keep no prefixes, whose memory grows with the square
WORDS_KEPT, PREFIXES_KEPT, PAIRS_KEPT = 400_000, 800_000, 400_000
END = "</w>"
# White space as the vocabulary's pattern means it, written out inside brackets:
# unlike Python's it leaves out the separators 0x1c to 0x1f.
SPACE_IN_CLASS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Texts of these characters need no normalisation, and their letters are LATIN.
LATIN = "a-zß-öø-ÿ"
IS_LATIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*").fullmatch


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the rest for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    symbol = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [symbol[b] for b in range(256)]


class PrefixCounter:
    """Prefix tables of one vocabulary file (``tokenizers`` JSON, BPE with word
    ends, NFC, white space folded, lower case).

    ``_open`` holds, per prefix met so far, the last token and the token count of
    that prefix as the start of a longer word; words share it like a trie.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        self.symbols = byte_symbols()
        self.tokens = frozenset(a + b for a, b in merges).union(
            self.symbols, (s + END for s in self.symbols))
        self.longest = max(len(t.removesuffix(END)) for t in self.tokens)
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", SPACE_IN_CLASS)).findall
        self.latin_words = re.compile(pattern.replace(r"[\p{L}]", f"[{LATIN}]").replace(
            r"\p{L}\p{N}", f"{LATIN}0-9").replace(r"[\p{N}]", "[0-9]").replace(
            r"\s", SPACE_IN_CLASS)).findall
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials)))
        self._fits: dict[tuple[str, str], bool] = {}
        self._open: dict[str, tuple[str, int]] = {"": ("", 0)}
        self._totals = _Totals(self)

    def _encoded(self, symbols: list[str]) -> list[str]:
        """Merge neighbours in rank order (only ever run on two tokens' text)."""
        while len(symbols) > 1:
            rank, i = min((self.rank.get(p, 1 << 30), i)
                          for i, p in enumerate(zip(symbols, symbols[1:])))
            if rank == 1 << 30:
                break
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def _pair_fits(self, left: str, right: str) -> bool:
        tail = list(right.removesuffix(END))
        if right.endswith(END):
            tail[-1] += END
        fits = self._encoded(list(left) + tail) == [left, right]
        if len(self._fits) >= PAIRS_KEPT:
            self._fits.clear()
        self._fits[left, right] = fits
        return fits

    def _step(self, prefix: str, suffix: str, by_place: list | None = None,
              n: int | None = None) -> tuple[str, int]:
        """Last token and count of ``prefix`` + ``suffix`` from the table before:
        of prefixes, or ``by_place`` (then of the first ``n`` symbols of ``prefix``)."""
        tokens, opened, fits = self.tokens, self._open, self._fits
        n = len(prefix) if n is None else n
        for j in range(max(0, n - self.longest), n):
            t = prefix[j:n] + suffix
            if t in tokens:
                before, count = opened[prefix[:j]] if by_place is None else by_place[j]
                if not j:
                    return t, 1
                ok = fits.get((before, t))
                if ok is None:
                    ok = self._pair_fits(before, t)
                if ok:
                    return t, count + 1
        raise ValueError(f"no encoding for {prefix[:n]!r}")

    def _opened(self, prefix: str) -> None:
        """Fill the table for all prefixes of ``prefix``."""
        opened, n = self._open, len(prefix)
        if len(opened) >= PREFIXES_KEPT:
            opened.clear()
            opened[""] = "", 0
        known = n
        while prefix[:known] not in opened:
            known -= 1
        # every shorter prefix is there too: prefixes enter from left to right
        for i in range(known + 1, n + 1):
            opened[prefix[:i]] = self._step(prefix[:i], "")

    def _places(self, word: str) -> list[tuple[str, int]]:
        """The table of a long word by position: one entry a symbol, kept nowhere."""
        out = [("", 0)]
        for n in range(1, len(word) + 1):
            out.append(self._step(word, "", out, n))
        return out

    def table(self, word: str) -> list[int]:
        """Token counts of every byte prefix of ``word`` (byte symbols) as a word
        that ends there, from 0 bytes on."""
        if len(word) > LONG_WORD:
            places = self._places(word)
            return [0, *(self._step(word, END, places, n)[1] for n in range(1, len(word) + 1))]
        self._opened(word)
        return [0, *(self._step(word[:i], END)[1] for i in range(1, len(word) + 1))]

    def as_symbols(self, word: str) -> str:
        return word if word.isascii() and word.isprintable() else "".join(
            map(self.symbols.__getitem__, word.encode("utf-8", "surrogatepass")))

    def total(self, word: str) -> int:
        """Tokens of a whole word: the last entry of its table."""
        word = self.as_symbols(word)
        if len(word) > LONG_WORD:
            return self._step(word, END, self._places(word[:-1]), len(word))[1]
        self._opened(word[:-1])
        return self._step(word, END)[1]

    def split(self, text: str) -> list[str | None]:
        """The words of ``text``, folded and lower-cased; None for a special token."""
        if "<|" in text and self.special.search(text):
            out, at = [], 0
            for m in self.special.finditer(text):
                out += [*self.split(text[at:m.start()]), None]
                at = m.end()
            return out + self.split(text[at:])
        if IS_LATIN(text):
            return self.latin_words(text.lower())
        return self.words(normalize("NFC", text).lower())

    def count_and_cut(self, text: str, limit: int | None) -> tuple[int, int | None, int | None]:
        """(tokens of the text; if over ``limit``: the number of whole words that
        fit, and how many bytes of the next word still fit, ended there)."""
        words = self.split(text)
        counts = list(map(self._totals.__getitem__, words))
        total = sum(counts)
        if limit is None or total <= limit:
            return total, None, None
        running = list(accumulate(counts))
        cut = bisect_right(running, limit)
        left = limit - (running[cut - 1] if cut else 0)
        ended = [0, 1] if words[cut] is None else self.table(self.as_symbols(words[cut]))
        return total, cut, max(i for i, c in enumerate(ended) if c <= left)

    def count(self, text: str) -> int:
        return self.count_and_cut(text, None)[0]

    def prefix_counts(self, text: str) -> list[list[int]]:
        """Per word the running token count of the text at each byte of the word,
        the text ending there (its first entry is the count before the word)."""
        out, total = [], 0
        for w in self.split(text):
            ended = [0, 1] if w is None else self.table(self.as_symbols(w))
            out.append([total + c for c in ended])
            total += ended[-1]
        return out


class _Totals(dict):
    """Word -> tokens, filled as words are met; emptied when full."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str | None) -> int:
        n = 1 if word is None else self.counter.total(word)
        if word is not None and len(word) > LONG_WORD:
            return n
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = n
        return n


@lru_cache(maxsize=4)
def prefix_counter(path: str) -> PrefixCounter:
    """One counter per worker process: its word tables serve every later task."""
    return PrefixCounter(path)


def _counting(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(path)
        for batch in batches:
            found = [counter.count_and_cut(t.as_py() or "", limit) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"),
                 pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "cut_word", "cut_byte"])
    return run


def token_counts(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, cut_word, cut_byte`` of each row.

    Texts and words of any length count whole, a word in memory in proportion to its
    length.  ``cut_word`` and ``cut_byte`` say where a text over ``limit`` tokens is to be
    cut: after so many whole words and so many bytes (of the folded, lower-cased
    form) of the next one; both NULL for texts within the limit.  NULL texts
    count as empty (0 bytes, 0 tokens); repeated rows give repeated rows; other
    columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
                       .alias("n_bytes"), "text")
    out = rows.drop("text").schema.add("n_tokens", "long").add("cut_word", "long") \
        .add("cut_byte", "long")
    return (rows.mapInArrow(_counting(path or vocabulary_path(), limit), out)
            .select("doc_id", "n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit"), "cut_word", "cut_byte"))


def prefix_table(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The stored form: per row ``doc_id`` and ``prefix_counts``, an array per
    word of the exact token counts of the text cut at each byte of that word."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([counter.prefix_counts(t.as_py() or "") for t in batch.column("text")],
                          pa.list_(pa.list_(pa.int32())))], ["doc_id", "prefix_counts"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, rows.drop("text").schema.add(
        "prefix_counts", T.ArrayType(T.ArrayType(T.IntegerType()))))


def fits(prefix_counts: Column, budget: Column | int) -> Column:
    """From the stored table: whether a text's tokens are within ``budget``."""
    total = F.when(F.size(prefix_counts) > 0, F.element_at(F.element_at(prefix_counts, -1), -1))
    return F.coalesce(total, F.lit(0)) <= budget


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document in the 49k word-end vocabulary."""
    return token_counts(table(spark, sf_dir, "documents"))
