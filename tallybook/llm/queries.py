"""Queries that apply each operator to its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm import (
    ngram_join, packing, prefix_trie, quality, sentencepiece_fst, spotsigs, suffix_dedup, token_counts, topk_search,
    toxicity, turn_repair, url_filters, warc,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard_join(spark, d):
    return ngram_join.ngram_components(_table(spark, d, "documents"))


OP1_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN array_to_string(words, ' ')
        ELSE array_to_string(words[i:i + 3], ' ') END AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y USING (shingle)
        WHERE x.doc_id <> y.doc_id GROUP BY ALL)
    JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
    WHERE 100 * common >= 85 * (p.n + q.n - common)),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)"""


def op2_toxicity(spark, d):
    return toxicity.score(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op3_url_filters(spark, d):
    return url_filters.judge_urls(_table(spark, d, "pages"), url_filters.query_rules(spark))


OP3_SQL = r"""
WITH p AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
h AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM p),
rules(rule_host, rule_path, verdict) AS (VALUES
    ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
    SELECT page_id, max_by(struct_pack(rule := rule_host || rule_path, verdict := verdict),
        length(rule_host || rule_path)) AS best
    FROM h JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM h LEFT JOIN fits USING (page_id)"""


def op4_quality_classifier(spark, d):
    return quality.score(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op5_exact_top_k_search(spark, d):
    return topk_search.top_k(_table(spark, d, "embeddings"))


OP5_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 5"""


def op6_sentencepiece(spark, d):
    return sentencepiece_fst.round_trip(_table(spark, d, "documents"))


def op7_packing(spark, d):
    return packing.pack(_table(spark, d, "documents"))


def op8_document_fingerprints(spark, d):
    return spotsigs.edit_report(_table(spark, d, "documents"))


def op9_warc(spark, d):
    return warc.archive_pages(_table(spark, d, "pages"))


OP9_SQL = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM m"""


def op10_suffix_array_dedup(spark, d):
    return suffix_dedup.removal_digest(suffix_dedup.remove_repeats(_table(spark, d, "documents")))


def op11_conversation_repair(spark, d):
    return turn_repair.repair_report(_table(spark, d, "conversations"))


def op12_token_counts(spark, d):
    return token_counts.token_counts(_table(spark, d, "documents"))


def op13_conversation_prefix_trie(spark, d):
    return prefix_trie.rebuilt_trie(_table(spark, d, "conversations"))


# CRC-32 by its table of 256 steps, for texts of ASCII characters.
_CRC_TABLE = """crc AS MATERIALIZED (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)
                ORDER BY i) AS steps
    FROM range(256) r(i))"""


def _crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)"
    folded = f"list_reduce({codes}, lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1]), 4294967295::BIGINT)"
    return f"xor({folded}, 4294967295::BIGINT)"


OP11_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
b AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k
    FROM conversations, crc),
x AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM b WHERE k <> 0),
n AS (
    SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || ':' || text), copy) AS i
    FROM x),
f AS (
    SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
               WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
    FROM n),
stats AS (
    SELECT conv_id, count(*) AS n_rows, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
           count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE fault = 'truncated') AS truncated,
           count(*) FILTER (WHERE earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM f GROUP BY conv_id),
added(q, p, letters, price, lines) AS (VALUES
    ('', '', '', 0, []::VARCHAR[]), ('', 'u', 'I', 3, ['user:']), ('', 'a', 'II', 6, ['user:', 'assistant:']),
    ('s', 's', '', 0, []), ('s', 'u', 'I', 3, ['user:']), ('s', 'a', 'II', 6, ['user:', 'assistant:']),
    ('u', 'u', '', 0, []), ('u', 'a', 'I', 3, ['assistant:']), ('a', 'a', '', 0, []), ('a', 'u', 'I', 3, ['user:'])),
edits(p, edit, t, price, role) AS (VALUES
    ('', 'D', '', 4, ''), ('s', 'D', 's', 4, ''), ('u', 'D', 'u', 4, ''), ('a', 'D', 'a', 4, ''),
    ('', 'K', 's', 0, ''), ('', 'K', 'u', 0, ''), ('s', 'K', 'u', 0, ''), ('a', 'K', 'u', 0, ''), ('u', 'K', 'a', 0, ''),
    ('', 'R', 'u', 3, 'user'), ('s', 'R', 'u', 3, 'user'), ('a', 'R', 'u', 3, 'user'), ('u', 'R', 'a', 3, 'assistant')),
moves AS (
    SELECT q, edit, t, role, letters || edit AS letters, added.price + edits.price AS price, lines FROM added JOIN edits USING (p)),
walk AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS q, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS best
    FROM conversations
    UNION ALL
    SELECT w.conv_id, w.i + 1, t, min({{
        'cost': (best.cost + price + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 3 ELSE 0 END)::BIGINT,
        'audit': best.audit || letters,
        'lines': best.lines || m.lines || CASE edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [f.role || ':' || f.text]
                                                ELSE [m.role || ':' || f.text] END}})
    FROM walk w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    JOIN moves m ON m.q = w.q AND (edit = 'D' OR fault NOT IN ('blank', 'duplicate') AND (edit = 'R' OR initial = t))
    GROUP BY w.conv_id, w.i, t),
done AS (
    SELECT w.conv_id, min({{'cost': (best.cost + price)::BIGINT, 'audit': best.audit || letters, 'lines': best.lines || a.lines}}) AS best
    FROM walk w LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM w.conv_id
    JOIN added a ON a.q = w.q AND a.p IN ('', 'a')
    WHERE w.i = coalesce(n_rows, 0) GROUP BY w.conv_id)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, best.cost AS cost, best.audit AS audit,
       sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM done d LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM d.conv_id"""


OP13_SQL = rf"""
WITH {_CRC_TABLE},
o AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS n,
           {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_crc32('conv_id::VARCHAR')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM o), crc),
r AS (
    SELECT c.conv_id, n, t FROM c JOIN o ON o.conv_id = c.conv_id WHERE n > h
    UNION ALL SELECT c.conv_id, n, t FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 WHERE n <= h),
s AS (
    SELECT c.conv_id, coalesce(max(x), []) AS turns
    FROM c LEFT JOIN (SELECT conv_id, list(t ORDER BY n) AS x FROM r GROUP BY conv_id) USING (conv_id) GROUP BY c.conv_id),
p AS (
    SELECT conv_id, d, turns[:d] AS path, len(turns) = d AS ends
    FROM s, unnest(range(0, len(turns) + 1)) u(d)),
nodes AS (
    SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * CASE WHEN d > 0 THEN len(regexp_extract_all(path[d].text, '[^ 	-
]+')) ELSE 0 END AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM p GROUP BY path, d),
kids AS (SELECT path[:d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)),
under AS (
    SELECT a.path, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum(b.saved) AS saved_tokens
    FROM (SELECT path[:k] AS path, known.n_children, saved FROM known, unnest(range(0, d + 1)) u(k)) b
    JOIN known a USING (path) GROUP BY a.path)
SELECT k.conv_id, k.d::BIGINT AS depth, q.conv_id AS parent_conv_id, k.n_convs::BIGINT AS n_convs,
       k.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM known k JOIN under u ON u.path = k.path LEFT JOIN nodes q ON k.d > 0 AND q.path = k.path[:k.d - 1]"""


def queries():
    found = [
        op1_ngram_jaccard_join, op2_toxicity, op3_url_filters, op4_quality_classifier, op5_exact_top_k_search,
        op6_sentencepiece, op7_packing, op8_document_fingerprints, op9_warc, op10_suffix_array_dedup,
        op11_conversation_repair, op12_token_counts, op13_conversation_prefix_trie,
    ]
    return {query.__name__: query for query in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    found = {
        "op1_ngram_jaccard_join": OP1_SQL, "op3_url_filters": OP3_SQL, "op5_exact_top_k_search": OP5_SQL, "op9_warc": OP9_SQL,
        "op11_conversation_repair": OP11_SQL, "op13_conversation_prefix_trie": OP13_SQL,
    }
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
