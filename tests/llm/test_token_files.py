import base64
import glob
import os

import numpy as np
import pytest

from cdrmill.llm import token_files as W


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import tiktoken
    with open(P.path(W.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_the_permutation_is_one():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        for key in (1, 99):
            assert sorted(W.positions(np.arange(n), n, key)) == list(range(n))
    a = W.positions(np.arange(5000), 5000, 1)
    assert (a != W.positions(np.arange(5000), 5000, 2)).mean() > 0.99
    assert abs(np.corrcoef(a, np.arange(5000))[0, 1]) < 0.1  # order is gone


def test_tokens_equal_the_library(small_texts, library):
    encode = W.tokens(W.VOCABULARY)
    odd = ["", " ", "a  b   c \n\n x", "it's I'LL", "naïve ½ Ⅷ 中文 é\x1c\x1d x", " \x85\xa0　y",
           "😀😀  ", "ª º µ", "tab\t\t x", "<|endoftext|>", "__a_b__ 12ab"]
    for t in [*odd, *small_texts.values()]:
        assert np.frombuffer(encode(t), "<u2").tolist() == library.encode_ordinary(t), t


def test_round_trip(spark, small_docs, small_texts, library, tmp_path):
    path, length, per = f"{tmp_path}/t", 64, 500
    shards = W.write_shards(small_docs, path, length, per)
    rows = W.read_shards(spark, path, length).orderBy("slot").collect()
    assert [r["slot"] for r in rows] == list(range(len(rows)))  # gapless
    assert sum(-(-r["n_tokens"] // length) for r in rows) == len(rows)
    docs, of_shard = {}, {}
    for r in rows:
        assert 0 <= r["shard"] < shards
        assert r["offset"] == of_shard.get(r["shard"], 0) * W.stride_of(length)
        of_shard[r["shard"]] = of_shard.get(r["shard"], 0) + 1
        ids = np.frombuffer(r["tokens"], "<u2").tolist()
        assert len(ids) == r["n_tokens"] <= length
        docs.setdefault(r["doc_id"], {})[r["seq_no"]] = ids
    assert [r["shard"] for r in rows] == sorted(r["shard"] for r in rows)
    assert max(of_shard.values()) <= per * 1.2  # places coincide evenly
    assert set(docs) == set(small_texts)
    for i, parts in docs.items():
        assert sorted(parts) == list(range(len(parts)))
        ids = sum((parts[k] for k in sorted(parts)), [])
        assert ids[-1] == W.END_TOKEN and library.decode(ids[:-1]) == small_texts[i]
    # raw files: one per shard, fixed stride, record i at i * stride
    for s, n in of_shard.items():
        (f,) = glob.glob(f"{path}/shard={s}/part-*")
        assert os.path.getsize(f) == W.stride_of(length) * n
    # what lies near in a document is far apart in training order
    at = {(r["doc_id"], r["seq_no"]): r["slot"] for r in rows}
    steps = [abs(at[i, k] - at[i, k + 1]) for i, k in at if (i, k + 1) in at]
    assert np.mean(steps) == pytest.approx(len(rows) / 3, rel=0.15)


def test_reading_resumes_at_any_slot(spark, small_docs, tmp_path):
    path = f"{tmp_path}/t"
    W.write_shards(small_docs, path, 64, 300)
    every = W.read_shards(spark, path, 64).orderBy("slot").collect()
    rest = W.read_shards(spark, path, 64, start=700, upto=1100)
    assert rest.orderBy("slot").collect() == every[700:1100]
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan  # other shards are not opened
    assert W.read_shards(spark, path, 64, start=len(every)).count() == 0


def test_order_depends_on_rows_and_key_only(spark, small_docs, tmp_path):
    read = lambda p: [(r["slot"], r["doc_id"], r["crc32"]) for r in W.read_shards(
        spark, p, 64).orderBy("slot").collect()]
    otherwise = small_docs.repartition(5, "n_chars")
    for name, docs, key in (("a", small_docs, 1), ("b", otherwise, 1), ("c", small_docs, 2)):
        W.write_shards(docs, f"{tmp_path}/{name}", 64, 500, key)
    assert read(f"{tmp_path}/a") == read(f"{tmp_path}/b") != read(f"{tmp_path}/c")


def test_a_text_never_has_more_sequences_than_places(small_texts, library):
    """The vocabulary is one of bytes: every token covers one at least."""
    for t in [*small_texts.values(), "", "\u4e2d" * 99, "\U0001f600\u0301" * 70, "\x00\x01" * 50]:
        assert len(library.encode_ordinary(t)) <= len(t.encode())


def test_a_cut_file_is_noticed(spark, small_docs, tmp_path):
    W.write_shards(small_docs, f"{tmp_path}/t", 64, 500)
    f = glob.glob(f"{tmp_path}/t/shard=0/part-*")[0]
    data = open(f, "rb").read()
    for crc in glob.glob(f"{tmp_path}/t/shard=0/.*.crc"):
        os.remove(crc)
    with open(f, "wb") as out:
        out.write(data[:-3])
    with pytest.raises(Exception, match="cut off"):
        W.read_shards(spark, f"{tmp_path}/t", 64).collect()


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    W.write_shards(odd_docs, f"{tmp_path}/t", 64, 500)
    rows = W.read_shards(spark, f"{tmp_path}/t", 64).collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    first = [r for r in rows if r["seq_no"] == 0]
    assert len(first) == odd_docs.count() and sum(r["doc_id"] is None for r in first) == 3
    assert [r["n_tokens"] for r in first if r["doc_id"] in (1, 2)] == [1, 1]
    assert W.write_shards(no_docs, f"{tmp_path}/none", 64, 500) == 0
