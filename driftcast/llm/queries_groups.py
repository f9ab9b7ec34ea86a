"""Registered queries of the operators on vectors, conversations and words
(11 to 13): {name: (query, SQL)}. Each runs over its whole table.

The SQL goes other ways than the operators: all pairs of vectors, a forward
recursion over (cost, edit letters) per state, wildcard and deletion keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftcast.llm import conversations, multi_index, spelling

# crc32 of a string of code points below U+0800, over a table made by rule.
_CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                          lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END) AS c
    FROM range(256) t(i)))"""


def _crc(text: str) -> str:
    points = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    octets = (f"flatten(list_transform({points}, lambda p: CASE WHEN p < 128 THEN [p] "
              "ELSE [192::BIGINT | (p >> 6), 128::BIGINT | (p & 63)] END))")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), "
            "lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)")


def op11_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
reach AS (SELECT vec_id AS v, vec_id AS r FROM embeddings
          UNION SELECT reach.v, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, least AS component_id, vec_id = least AS kept
FROM (SELECT v AS vec_id, min(r) AS least FROM reach GROUP BY v)
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audits(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP12_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations, crc_table),
rows_after AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) copies(c) WHERE kind <> 0 AND (c = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
                               sha256(strlen(role)::VARCHAR || ':' || role || text)) AS i,
         right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM rows_after),
coded AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN last = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS pair
  FROM placed),
due(st, nx) AS (VALUES ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
inserts(st, n, to_st) AS (
  SELECT st, 0, st FROM due UNION ALL SELECT st, 1, nx FROM due
  UNION ALL SELECT d.st, 2, e.nx FROM due d JOIN due e ON d.nx = e.st),
best AS (
  SELECT c.conv_id, 0::BIGINT AS i, to_st AS st, {{'cost': 5 * n, 'audit': repeat('I', n)}} AS b
  FROM (SELECT DISTINCT conv_id FROM coded) c, inserts WHERE st = ''
  UNION ALL
  SELECT conv_id, i, to_st, min({{'cost': (b.cost + 5 * n), 'audit': b.audit || repeat('I', n)}})
  FROM (
    SELECT p.conv_id, c.i, unnest([
        {{'st': p.st, 'b': {{'cost': p.b.cost + 2, 'audit': p.b.audit || 'D'}}}},
        CASE WHEN fault NOT IN ('blank', 'duplicate') THEN
          {{'st': d.nx, 'b': {{'cost': p.b.cost + 1 + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'audit': p.b.audit || 'R'}}}} END,
        CASE WHEN fault NOT IN ('blank', 'duplicate') AND (initial = d.nx OR (p.st = '' AND initial = 's')) THEN
          {{'st': initial, 'b': {{'cost': p.b.cost + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'audit': p.b.audit || 'K'}}}} END
      ], recursive := false) AS o
    FROM best p JOIN coded c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.i = p.i + 1 JOIN due d ON d.st = p.st) u,
  LATERAL (SELECT o.st AS from_st, o.b AS b) w JOIN inserts ON inserts.st = w.from_st
  WHERE o IS NOT NULL
  GROUP BY conv_id, i, to_st),
done AS (
  SELECT conv_id, min(b) AS b FROM (
    SELECT *, max(i) OVER (PARTITION BY conv_id) AS last_i FROM best) WHERE i = last_i AND st IN ('', 'a') GROUP BY conv_id),
letters AS (
  SELECT conv_id, b.audit AS audit, unnest(range(1, len(b.audit) + 1)) AS p FROM done),
emitted AS (
  SELECT conv_id, p, audit[p] AS letter, len(replace(audit[:p], 'I', '')) AS i, len(replace(audit[:p], 'D', '')) AS e
  FROM letters WHERE audit[p] <> 'D'),
spoken AS (
  SELECT m.conv_id, m.p, m.letter, c.role, c.text,
         m.e - CASE WHEN bool_or(m.e = 1 AND m.letter = 'K' AND c.initial = 's') OVER (PARTITION BY m.conv_id) THEN 1 ELSE 0 END AS e
  FROM emitted m LEFT JOIN coded c ON m.letter <> 'I' AND c.conv_id IS NOT DISTINCT FROM m.conv_id AND c.i = m.i),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN e % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                             || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS said
  FROM spoken GROUP BY conv_id),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM coded GROUP BY conv_id)
SELECT k.conv_id, coalesce(f.gaps, 0)::BIGINT AS gaps, coalesce(f.blank, 0)::BIGINT AS blank,
       coalesce(f.duplicate, 0)::BIGINT AS duplicate, coalesce(f.truncated, 0)::BIGINT AS truncated,
       coalesce(f.illegal, 0)::BIGINT AS illegal, coalesce(d.b.cost, 0)::BIGINT AS cost, coalesce(d.b.audit, '') AS audit,
       sha256(coalesce(r.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM kinds) k
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM k.conv_id
"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents) WHERE len(run) >= 5 GROUP BY ALL),
hashed AS (SELECT *, {_crc("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs, crc_table),
words AS (
  SELECT w, sum(times)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % len(run))::BIGINT) || substr(run, (h % len(run))::BIGINT + 2) ELSE run END AS w, times
    FROM hashed) WHERE len(w) >= 5 GROUP BY w HAVING sum(times) >= 3),
cuts AS (SELECT w, n, k, left(w, k - 1) AS head, substr(w, k + 1) AS tail
         FROM (SELECT w, n, unnest(range(1, len(w) + 1)) AS k FROM words)),
near AS (
  SELECT a.w AS a, b.w AS b FROM cuts a JOIN cuts b ON a.head = b.head AND a.tail = b.tail AND a.w <> b.w
  UNION SELECT c.w, s.w FROM cuts c JOIN words s ON s.w = c.head || c.tail
  UNION SELECT s.w, c.w FROM cuts c JOIN words s ON s.w = c.head || c.tail),
best AS (
  SELECT a AS w, count(*) AS n_near, min({{'less': -words.n, 'form': b}}) AS f FROM near JOIN words ON words.w = near.b GROUP BY a),
formed AS (
  SELECT words.w, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN -f.less >= 2 * n THEN f.form END AS form,
         CASE WHEN -f.less >= 2 * n THEN -f.less END AS form_n
  FROM words LEFT JOIN best USING (w)),
chain AS (
  SELECT w, w AS root, form FROM formed
  UNION ALL SELECT chain.w, formed.w, formed.form FROM chain JOIN formed ON formed.w = chain.form)
SELECT formed.w AS word, formed.form, root, n, n_near, form_n::BIGINT AS form_n
FROM formed JOIN chain ON chain.w = formed.w AND chain.form IS NULL
"""


QUERIES = {
    "op11_multi_index": (op11_multi_index, OP11_SQL),
    "op12_conversation_repair": (op12_conversation_repair, OP12_SQL),
    "op13_spelling_variants": (op13_spelling_variants, OP13_SQL),
}
