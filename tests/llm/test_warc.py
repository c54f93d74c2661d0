import glob
import gzip
import hashlib
import zlib

import pytest

from cdrmill.llm import warc as W
from .conftest import SMALL


def expected(pages):
    first = {}
    for i, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        head = first.get(raw)
        again = head is not None and i != head
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(),
                    "revisit" if again else "response", head if again else None))
    return sorted(out, key=str)


def written_and_read(spark, rows, path, n=3):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "page_id long, url string, html string, size long, digest string")
    W.write_archives(df.repartition(n), path)
    return W.read_archives(spark, path).collect()


def digest_rows(rows):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"],
                    r["refers_to"]) for r in rows), key=str)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet")
            .select("page_id", "url", "html").collect()]
    rows += [(i + 1000, "u", rows[i % 7][2]) for i in range(30)]  # many revisits of few pages
    rows += [(2000, "http://x/a b\r\nEvil: 1", "short"), (2001, None, "short"), (2002, "é", None),
             (2003, "", ""), (None, "n", "z" * 200), (2004, "n", "z" * 200),
             (2005, "n", "é" * 50), (1999, "n", "é" * 50), (2006, "n", "q" * 99),
             (2007, "n", "q" * 99), (-5, "neg", rows[3][2]), (2008, "h", "\r\n\r\nWARC/1.1\r\n" * 20)]
    return rows


def test_round_trip(spark, pages, tmp_path):
    rows = written_and_read(spark, pages, f"{tmp_path}/w")
    assert digest_rows(rows) == expected(pages)
    assert all(r["problem"] is None for r in rows)
    html = {i: (h or "").encode() for i, _, h in pages}
    assert all(bytes(r["html"]) == html[r["page_id"]] for r in rows
               if r["record_type"] == "response")


def test_archives_are_plain_gzip(spark, pages, tmp_path, monkeypatch):
    written_and_read(spark, pages, f"{tmp_path}/w")
    files = glob.glob(f"{tmp_path}/w/part-*")
    data = [gzip.decompress(open(f, "rb").read()) for f in files]
    assert sum(d.count(b"WARC/1.1\r\nWARC-Type") for d in data) == len(pages)


def test_large_record_and_small_archives(spark, tmp_path, monkeypatch):
    big = "0123456789" * 1_800_000  # beyond 16 MB a gzip member no longer ends in zero
    rows = written_and_read(spark, [(1, "a", big), (2, "b", "x"), (3, "c", big)],
                            f"{tmp_path}/w", 1)
    assert digest_rows(rows) == expected([(1, "a", big), (2, "b", "x"), (3, "c", big)])


def test_member_ends():
    for n in (0, 1, 1 << 20, (1 << 24) + 5):
        raw = W.ending_in_zero(W.gzip_member(b"x" * n))
        assert raw.endswith(b"\0") and gzip.decompress(raw) == b"x" * n


def archive(*records):
    return b"".join(map(W.gzip_member, records))


def test_reader_checks_framing_and_digests():
    body = b"<p>" + b"a" * 300
    good = W.page_record(1, "u", body, len(body), hashlib.sha256(body).hexdigest(), None)
    read = lambda raw, n: list(W.read_records(raw[i:i + n] for i in range(0, len(raw), n)))
    for n in (1, 7, 100, 1 << 20):
        (a, b) = read(archive(good, good), n)
        assert a.problem is b.problem is None and a.http_payload()[1] == body
    assert read(archive(good[:-4]), 50)[0].problem == "length"
    assert read(archive(good + b"x"), 50)[0].problem == "length"
    assert read(archive(good.replace(b"aaa<", b"aab<").replace(b"<p>a", b"<p>b")), 50)[0].problem \
        == "block digest"
    assert read(archive(b"nonsense"), 50)[0].problem == "header"
    wrong = W.page_record(1, "u", body, len(body), "0" * 64, None)
    assert read(archive(wrong), 50)[0].problem == "payload digest"
    with pytest.raises(ValueError, match="inside a gzip member"):
        read(archive(good)[:-9], 50)
    with pytest.raises(zlib.error):
        read(archive(good)[:40] + b"\xff" * 40, 50)


def test_setting_is_restored_and_empty_table(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    assert written_and_read(spark, [], f"{tmp_path}/w") == []
    assert spark.conf.get("spark.sql.files.maxRecordsPerFile") == before
