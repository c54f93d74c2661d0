import hashlib
import math
import re
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

from cdrmill.llm.prefix_trie import Shard, prefix_trie
from .conftest import SMALL

# columns of the operator's own tables as extra ones
CONVS = "conv_id long, turn long, role string, text string, conv long, shard long, band long, " \
        "pos long, k1 long, words long, depth long, pid int"


def brute(rows):
    """Nodes by walking every rebuilt conversation through a dictionary of paths."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), role, digest, (role, text)))
    own = {c: [v[3] for v in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + (len(members[node]) - 1) * words
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None,
                    len(members[node]), len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()))
    return sorted(out, key=str)


def trie(df, **how):
    return sorted((tuple(r) for r in prefix_trie(df, **how).collect()), key=str)


def test_real_conversations(spark):
    t = pq.read_table(f"{SMALL}/conversations.parquet")
    want = brute(zip(*(t[c].to_pylist() for c in ("conv_id", "turn", "role", "text"))))
    assert trie(spark.read.parquet(f"{SMALL}/conversations.parquet")) == want


@pytest.mark.parametrize("shard_convs,band_turns", [(1024, 256), (3, 4), (1, 1)])
def test_odd_conversations(spark, shard_convs, band_turns):
    """NULLs, copies, repeated rows, ties, long ones, absent bases, turnless ones, ids
    below zero; also over many small shards and bands."""
    rows = [(c, t, "user", f"text {t}") for c in range(0, 44) for t in range(c % 5)]
    rows += [(c, t, "user", f"turn {t % 3}  of\tmany") for c in (60, 61, 62)
             for t in range(17 + c % 3)]
    rows += [(c, 0, "user", "hello") for c in range(100, 120)]
    rows += [(c, 0, "user", "alone") for c in range(121, 140)]       # their base is absent
    rows += [(200, None, None, None), (200, None, "user", "b"), (200, 0, "user", None),
             (200, 0, "user", None), (200, 0, "", ""), (None, 1, "user", "no id"),
             (-25, 1, "user", "minus"), (-20, 1, "user", "its base"), (201, 5, "a", " \n "),
             (202, 1, None, "word " * 50_000)]
    assert any(zlib.crc32(str(c).encode()) % 4 for c in range(121, 140))  # some are turnless
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7, 8) for r in rows], CONVS).repartition(3)
    assert trie(df, shard_convs=shard_convs, band_turns=band_turns) == brute(rows)


def test_long_end_list_is_one_digest(spark):
    """More conversations that end at one node than a row of an end list holds."""
    rows = [(c, 0, "user", "same") for c in range(3000)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7, 8) for r in rows], CONVS)
    assert trie(df) == brute(rows)


def test_no_conversations(spark):
    out = prefix_trie(spark.createDataFrame([], CONVS))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                           "saved_tokens", "ends_sha256"]
    assert out.count() == 0


def test_bitsets_of_a_shard():
    """(position, turn) postings, popcounts and ends of three conversations."""
    starts = {"conv": [7, 3, 5], "length": [2, 2, 1], "k1": [0] * 3, "k2": [0] * 3, "words": [0] * 3}
    turns = {"conv": [3, 3, 5, 7, 7], "pos": [1, 2, 1, 1, 2], "k1": [1, 2, 1, 1, 3],
             "k2": [1, 2, 1, 1, 3], "words": [4, 5, 4, 4, 6]}
    s = Shard(0, starts, turns)
    assert s.convs == [3, 5, 7]
    assert s.postings == {(1, 1, 1): 0b111, (2, 2, 2): 0b001, (2, 3, 3): 0b100}
    assert s.ends == {2: 0b101, 1: 0b010}
    assert sorted((d, bits) for d, _, _, _, _, bits, _, _ in s.nodes()) == [
        (0, 0b111), (1, 0b111), (2, 0b001), (2, 0b100)]
