"""Secret scan: keyword automaton, anchored patterns near its hits, checksums.

One Aho-Corasick pass over the lower-cased text finds the keywords all at once.
A pattern is only tried where one of its keywords begins, anchored there; taking
the hits from left to right and skipping those inside an earlier match gives
exactly the leftmost non-overlapping matches of a full scan.  Runs of hex digits
have no keyword and are found by a plain run scan.  Token formats that embed a
checksum are reported only if it holds.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cdrmill.llm.common import table

KINDS = ("assign", "access", "hex", "github", "npm", "xprv")
BASE = KINDS[:3]
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

# fixed patterns: kind, keywords (lower case), pattern anchored where a keyword begins
PATTERNS = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII)),
    "access": (("akia",), re.compile(r"AKIA[A-Z0-9]+")),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36}")),
    "npm": (("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}")),
    "xprv": (("xprv",), re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}")),
}
HEX_RUN = re.compile(r"[0-9a-f]{24,}")
LOWER_ASCII = re.compile(r"[A-Z]+")


def crc32_base62(body: str) -> str:
    """CRC-32 of ``body`` as six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


def base58check(text: str) -> bool:
    """Whether base-58 text ends with the first four bytes of the double SHA-256
    of what is before them."""
    n = 0
    for c in text:
        n = n * 58 + BASE58.index(c)
    raw = n.to_bytes((n.bit_length() + 7) // 8, "big")
    raw = b"\0" * (len(text) - len(text.lstrip("1"))) + raw
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def valid(kind: str, m: re.Match) -> bool:
    """The length or checksum rule of a kind."""
    if kind == "assign":
        return len(m[2]) >= 6
    if kind == "access":
        return len(m[0]) >= 20
    if kind == "xprv":
        return base58check(m[0])
    return crc32_base62(m[0][4:34]) == m[0][34:]


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, (words, _) in PATTERNS.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def lower_ascii(text: str) -> str:
    """Lower case of the same length, so that places agree with the text."""
    if len(low := text.lower()) == len(text):
        return low
    return LOWER_ASCII.sub(lambda m: m[0].lower(), text)


def find_secrets(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all valid secrets, by start, then kind; ends are
    exclusive and places count code points."""
    hits: dict[str, list[int]] = {}
    for end, (kind, n) in automaton().iter(lower_ascii(text)):
        hits.setdefault(kind, []).append(end - n + 1)
    found = [(m.start(), m.end(), "hex") for m in HEX_RUN.finditer(text)]
    for kind, starts in hits.items():
        pattern, free = PATTERNS[kind][1], 0
        for at in sorted(starts):
            if at >= free and (m := pattern.match(text, at)):
                free = m.end()
                if valid(kind, m):
                    found.append((at, free, kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [find_secrets(t.as_py() or "") for t in batch.column("text")]
        written = [[f"{k}:{s}:{e}" for s, e, k in f] for f in found]
        base = [",".join(w for w, x in zip(ws, f) if x[2] in BASE)
                for ws, f in zip(written, found)]
        count = lambda kind: pa.array([sum(x[2] == kind for x in f) for f in found],
                                      pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *map(count, KINDS),
             pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
             pa.array([",".join(w) for w in written], pa.string())],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, a count per kind, ``base_sha256`` (of the spans of the
    first three kinds, written ``kind:start:end`` and joined by commas) and
    ``spans`` (of all kinds).  NULL texts count as empty: no spans.  Repeated rows
    give repeated rows; other columns are ignored."""
    rows = docs.select("doc_id", "text")
    out = rows.drop("text").schema
    for k in KINDS:
        out = out.add(f"n_{k}", "long")
    return rows.mapInArrow(_scan, out.add("base_sha256", "string").add("spans", "string"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return scan_secrets(table(spark, sf_dir, "documents"))
