"""The corpus operators' registered queries and their DuckDB statements."""

import corpus_pipeline
from cdrmill.llm.box_codes import op13_vector_codes
from cdrmill.llm.decontam import op4_decontamination
from cdrmill.llm.mixing import op7_mixing
from cdrmill.llm.multi_index import op6_nearest_neighbours
from cdrmill.llm.near_dup import op3_near_duplicates
from cdrmill.llm.prefix_trie import op11_prefix_trie
from cdrmill.llm.secrets import op9_secrets
from cdrmill.llm.shard_ring import op1_sharding
from cdrmill.llm.sliced_topk import op12_top_k
from cdrmill.llm.token_count import op5_token_counts
from cdrmill.llm.token_files import op8_token_files
from cdrmill.llm.toxicity import op2_toxicity
from cdrmill.llm.warc import op10_warc

LLM_QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_toxicity": op2_toxicity,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_decontamination": op4_decontamination,
    "op5_token_counts": op5_token_counts,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_mixing": op7_mixing,
    "op8_token_files": op8_token_files,
    "op9_secrets": op9_secrets,
    "op10_warc": op10_warc,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_top_k": op12_top_k,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": corpus_pipeline.run,
}

# The other operators' results depend on hashes, models or searches that SQL has not;
# tests/llm holds them against brute force.
LLM_ORACLES = {
    "op10_warc": """
        WITH d AS (
          SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                 sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT payload_digest, min(page_id) AS first FROM d
              WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to,
               CAST(NULL AS VARCHAR) AS problem
        FROM d LEFT JOIN f USING (payload_digest)""",
    "op11_prefix_trie": """
        WITH RECURSIVE t AS (
          SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role) AS p
          FROM conversations WHERE conv_id IS NOT NULL),
        h AS (  -- CRC-32 of the decimal id, bit by bit
          SELECT c, xor(4294967295, list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(
                     string_split(CAST(c AS VARCHAR), ''), lambda s: ord(s)::BIGINT)),
                   lambda crc, b: list_reduce(
                     list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                     lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) % 4 AS h
          FROM (SELECT DISTINCT c FROM t)),
        b AS (
          SELECT h.c, r, x, p FROM h JOIN t ON t.c = h.c - h.c % 20 AND p <= h
          UNION ALL
          SELECT c, r, x, p FROM t JOIN h USING (c) WHERE p > h),
        q AS (
          SELECT c, row_number() OVER w AS d, md5(r || chr(0) || x) AS m,
                 len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words
          FROM b WINDOW w AS (PARTITION BY c ORDER BY p)),
        path AS (
          SELECT c, d, words, string_agg(m, '') OVER (PARTITION BY c ORDER BY d) AS k FROM q
          UNION ALL
          SELECT c, 0, 0, '' FROM h),
        final AS (SELECT c, max(d) AS d FROM path GROUP BY c),
        node AS (
          SELECT k, path.d AS d, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                 sha256(coalesce(string_agg(CASE WHEN final.d = path.d THEN CAST(c AS VARCHAR) END,
                                            ',' ORDER BY c), '')) AS ends_sha256
          FROM path JOIN final USING (c) GROUP BY k, path.d),
        up AS (SELECT k, d, left(k, 32 * (d - 1)::INT) AS parent FROM node WHERE d > 0),
        kids AS (SELECT parent AS k, count(*) AS n FROM up GROUP BY parent),
        under AS (SELECT k AS top, k, d FROM node
                  UNION ALL
                  SELECT under.top, up.k, up.d FROM under JOIN up ON up.parent = under.k),
        sums AS (
          SELECT top AS k, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens,
                 count(*) FILTER (WHERE kids.n IS NULL) AS n_leaves
          FROM under JOIN node ON node.k = under.k LEFT JOIN kids ON kids.k = under.k GROUP BY top)
        SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id,
               node.n_convs, coalesce(kids.n, 0) AS n_children, n_leaves, saved_tokens,
               node.ends_sha256
        FROM node JOIN sums USING (k) LEFT JOIN kids ON kids.k = node.k
        LEFT JOIN up ON up.k = node.k LEFT JOIN node parent ON parent.k = up.parent""",
    "op12_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
          FROM embeddings
          WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
        r AS (
          SELECT query_id, CAST(row_number() OVER (
                   PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                 vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
