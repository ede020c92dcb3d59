"""DuckDB SQL that gives the same rows as the queries."""

from __future__ import annotations

#: The table of the CRC-32 of the byte k, from its polynomial; and the macro's text for the bytes of a string.
_CRC_TABLE = "SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k) ORDER BY k) AS t FROM range(256) r(k)"


def _crc32(text: str, table: str = "t") -> str:
    """CRC-32 of the UTF-8 bytes of an SQL expression, with the table in scope."""
    octets = f"list_transform(string_split_regex(rtrim(regexp_replace(hex(encode({text})), '(..)', '\\1 ', 'g')), ' '), lambda x: CAST('0x' || x AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, b: xor({table}[xor(c, b) % 256 + 1], c // 256), 4294967295::BIGINT), 4294967295::BIGINT)"


ORACLES: dict[str, str] = {
    "op11_exact_dedup": """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""",
    "op12_turn_trie": f"""
WITH crc AS ({_CRC_TABLE}),
s AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (SELECT conv_id, turns, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM s, crc),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) AS turns
  FROM h LEFT JOIN s b ON b.conv_id = h.conv_id - h.conv_id % 100
), p AS (SELECT conv_id, d AS depth, turns[1:d] AS path, len(turns) = d AS ended FROM r, unnest(range(len(turns) + 1)) u(d)),
n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM p GROUP BY path, depth
), k AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.path[depth].text) END AS own
  FROM n LEFT JOIN k ON n.path = k.path
), up AS (SELECT path[1:d] AS path, sum(own) AS saved_tokens, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves FROM v, unnest(range(depth + 1)) u(d) GROUP BY ALL)
SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(up.n_leaves AS BIGINT) AS n_leaves, CAST(up.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN up ON v.path = up.path LEFT JOIN n q ON v.depth > 0 AND q.path = v.path[1:v.depth - 1]""",
    "op13_spelling": f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents
), c AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL),
x AS (SELECT run, n, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM c, crc),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM x GROUP BY 1 HAVING sum(n) >= 3 AND length(word) >= 5
), less AS (SELECT DISTINCT word, left(word, p) || substr(word, p + 2) AS shorter FROM w, unnest(range(length(word))) u(p)),
gaps AS (SELECT word, left(word, p) || '*' || substr(word, p + 2) AS gap FROM w, unnest(range(length(word))) u(p)),
pairs AS (
  SELECT less.word AS a, w.word AS b FROM less JOIN w ON less.shorter = w.word
  UNION ALL SELECT w.word, less.word FROM less JOIN w ON less.shorter = w.word
  UNION ALL SELECT x.word, y.word FROM gaps x JOIN gaps y ON x.gap = y.gap AND x.word <> y.word
), best AS (
  SELECT a, count(*) AS n_near, arg_max(b, place) AS b, max(m) AS m
  FROM (SELECT a, b, w.n AS m, row_number() OVER (ORDER BY w.n, encode(b) DESC) AS place FROM pairs JOIN w ON w.word = b) GROUP BY a
), f AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN b END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n FROM w LEFT JOIN best ON word = a
), way AS (
  SELECT word, word AS at, form AS next FROM f
  UNION ALL SELECT way.word, f.word, f.form FROM way JOIN f ON f.word = way.next
)
SELECT f.word, f.form, way.at AS root, f.n, f.n_near, f.form_n FROM f JOIN way ON way.word = f.word AND way.next IS NULL""",
    "op10_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5""",
}
