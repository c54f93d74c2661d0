import os
import sys

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"

# names that the operators use inside: extra columns must not clash with them
EXTRA = "_kept_id long, _kept_key string, shard int, slot long, score double, text_key string, tokens long, topic string, " \
        "probability double, class_id long, bucket long, total double, toxic_score double, w string"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def doc_rows(texts, first=0):
    """Rows of the documents schema with filled extra columns."""
    return [(None if i is None else i + first, t, "en", f"s{n % 3}", len(t or ""),
             8, "kk", 1, 2, 0.5, "k", 3, "t", 0.1, 4, 5, 0.2, 0.3, "w")
            for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_texts():
    t = pq.read_table(f"{SMALL}/documents.parquet")
    return dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty, blank and very long texts, ties, repeated rows."""
    long = " ".join(f"word{i * 7919 % 1009}" for i in range(60_000))
    rows = doc_rows([(1, None), (2, ""), (3, "   "), (4, "one"), (5, "a b c d e f g h"),
                     (5, "a b c d e f g h"), (6, "a b c d e f g h"), (None, "no id here"),
                     (None, "no id here"), (None, None), (7, long), (8, long), (9, "çá 中文 İ")])
    rows.append((10, "all else is null", *[None] * 17))
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
