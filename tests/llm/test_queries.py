import duckdb
import pytest

from cdrmill.llm.queries import LLM_ORACLES, LLM_QUERIES
from .conftest import SMALL


def test_names():
    assert [n for n in LLM_QUERIES if n != "pipeline"] == sorted(
        (n for n in LLM_QUERIES if n != "pipeline"), key=lambda n: int(n[2:].split("_")[0]))
    assert len(LLM_QUERIES) == 14 and set(LLM_ORACLES) <= set(LLM_QUERIES)


def test_warc_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    want = con.execute(LLM_ORACLES["op10_warc"]).fetchall()
    got = LLM_QUERIES["op10_warc"](spark, SMALL)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type",
                           "refers_to", "problem"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_top_k"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(LLM_ORACLES[name])
    columns = [c[0] for c in want.description]
    got = LLM_QUERIES[name](spark, SMALL)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)
