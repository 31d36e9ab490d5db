"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"

SUBSTRING = f"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
      win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS k
              FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
      rep AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
      gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM rep),
      placed AS (SELECT doc_id, p, ws[p] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w)),
      kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words
               FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(words, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)"""

CHAT = r"""
    WITH rows AS (SELECT conv_id, turn, role, text, len(string_split_regex(text, '\s+')) AS words FROM conversations),
      asked AS (SELECT conv_id, turn, min(to_json(text)) AS first FROM rows WHERE role = 'user' GROUP BY ALL),
      replies AS (SELECT DISTINCT conv_id, turn - 1 AS turn, TRUE AS answered FROM rows WHERE role = 'assistant')
    SELECT conv_id, turn AS step, CAST(0 AS INTEGER) AS place, turn, 'call' AS kind, 'call-' || turn AS id,
           CASE WHEN to_json(text) <> first THEN 'duplicate_call' WHEN answered IS NULL THEN 'unanswered' ELSE 'ok' END AS status,
           '' AS problems,
           '{"arguments":{"text":' || to_json(text) || ',"turn":' || turn || ',"words":' || words ||
             '},"id":"call-' || turn || '","name":"reply","role":"assistant"}' AS json
    FROM rows JOIN asked USING (conv_id, turn) LEFT JOIN replies USING (conv_id, turn) WHERE role = 'user'
    UNION ALL
    SELECT r.conv_id, r.turn, 1, r.turn, 'result', 'call-' || (r.turn - 1),
           CASE WHEN a.turn IS NULL THEN 'orphan_result' ELSE 'ok' END, '',
           '{"content":' || to_json(text) || ',"role":"tool","tool_call_id":"call-' || (r.turn - 1) || '"}'
    FROM rows r LEFT JOIN asked a ON a.conv_id = r.conv_id AND a.turn = r.turn - 1 WHERE role = 'assistant'
    UNION ALL
    SELECT conv_id, turn, 0, turn, 'message', NULL, 'ok', '', '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}'
    FROM rows WHERE role NOT IN ('user', 'assistant')"""

JACCARD = f"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS ws FROM documents),
      s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS g
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
      n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
      common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id
                 GROUP BY ALL),
      links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
                WHERE 100 * c >= 85 * (p.n + q.n - c)),
      ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
      reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM reach r JOIN ways l ON l.a = r.b)
    SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(least_id, w.doc_id) AS component_id
    FROM w LEFT JOIN n USING (doc_id)
    LEFT JOIN (SELECT a AS doc_id, min(b) AS least_id FROM reach GROUP BY a) USING (doc_id)"""

NEAREST = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
      s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM s QUALIFY rank <= 10"""

LEXICAL = r"""
    WITH words AS (SELECT 'doc' AS kind, doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL
                   UNION ALL SELECT 'item', item_id, text FROM benchmark WHERE item_id IS NOT NULL),
      split AS (SELECT kind, id, row_number() OVER () AS row, regexp_extract_all(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM words),
      docs AS (SELECT row, id, CAST(len(ts) AS BIGINT) AS n FROM split WHERE kind = 'doc' AND len(ts) > 0),
      totals AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM docs),
      tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ts) AS term FROM split WHERE kind = 'doc') GROUP BY ALL),
      df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
      asked AS (SELECT DISTINCT id AS item_id, unnest(ts) AS term FROM split WHERE kind = 'item'),
      weights AS (SELECT item_id, term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) AS w
                  FROM asked JOIN df USING (term), totals),
      parts AS (SELECT item_id, row, id, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))) AS part
                FROM weights JOIN tf USING (term) JOIN docs USING (row), totals),
      scores AS (SELECT item_id, row, id AS doc_id, CAST(sum(part) AS BIGINT) AS score FROM parts GROUP BY ALL)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 10"""

#: CRC-32 of a number's decimal digits: each byte is added and then shifted out bit by bit.
_CRC = """xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
             lambda x: [CAST(ord(x) AS BIGINT)] || [-1, -1, -1, -1, -1, -1, -1, -1])),
             lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""

PREFIXES = f"""
    WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
                 PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
               FROM conversations WHERE conv_id IS NOT NULL),
      ids AS (SELECT c, c - c % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
      sizes AS (SELECT c AS base, count(*) AS held FROM t GROUP BY c),
      turns AS (SELECT ids.c, p AS d, r, x FROM ids JOIN t ON t.c = base AND p <= h
                UNION ALL SELECT c, least(h, coalesce(held, 0)) + p - h, r, x
                FROM t JOIN ids USING (c) LEFT JOIN sizes USING (base) WHERE p > h),
      paths AS (SELECT c, d, length(x) AS chars, string_agg(md5(r) || md5(x), '') OVER (PARTITION BY c ORDER BY d) AS path FROM turns
                UNION ALL SELECT c, 0, 0, '' FROM ids),
      nodes AS (SELECT path, d, min(c) AS conv_id, count(*) AS n, any_value(chars) AS chars FROM paths GROUP BY path, d),
      kids AS (SELECT left(path, length(path) - 64) AS path, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1),
      known AS (SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN kids USING (path)),
      subtrees AS (SELECT left(path, 64 * up) AS path, sum((n - 1) * chars) AS saved, count(*) FILTER (k = 0) AS leaves
                   FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM known) GROUP BY 1),
      ends AS (SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS e
               FROM (SELECT c, max_by(path, d) AS path FROM paths GROUP BY c) GROUP BY path)
    SELECT known.conv_id, CAST(known.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(known.n AS BIGINT) AS n_convs,
           CAST(known.k AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
           coalesce(e, sha256('')) AS ends_sha256
    FROM known JOIN subtrees USING (path) LEFT JOIN ends USING (path)
    LEFT JOIN nodes up ON known.d > 0 AND up.path = left(known.path, length(known.path) - 64)"""
