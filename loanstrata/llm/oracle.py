"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations



def _clustering_sql(rounds: int) -> str:
    """Rounds of assignment and moving, one pair of tables each. Sums are exact: integers far under 2 ** 53."""
    nearest = """
assigned{r} AS (
  SELECT id, v, min({{'d': vv - 2 * list_inner_product(v, c) + list_inner_product(c, c), 'c': number}}) AS best
  FROM kept CROSS JOIN centroids{r} GROUP BY id, v
)"""
    move = """,
sums{r} AS (
  SELECT best.c AS number, i, sum(v[i])::BIGINT AS s, count(*) AS n
  FROM assigned{r}, range(1, 65) AS dims(i) GROUP BY ALL
), moved{r} AS (
  SELECT number, list(floor(s / n) ORDER BY i) AS c FROM sums{r} GROUP BY number
), centroids{next} AS (
  SELECT number, coalesce(m.c, o.c) AS c FROM centroids{r} o LEFT JOIN moved{r} m USING (number)
)"""
    steps = "".join("," + nearest.format(r=r) + move.format(r=r, next=r + 1) for r in range(rounds))
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS id, vec_id, v, list_inner_product(v, v) AS vv
  FROM (SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
        WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)
), centroids0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS number, v AS c
  FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT 40)
){steps},{nearest.format(r=rounds)}, rows AS (
  SELECT vec_id, best.c AS cluster, best.d::BIGINT AS distance FROM assigned{rounds} JOIN kept USING (id)
)
SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string([x::BIGINT FOR x IN c], ',')) AS centroid_sha256
FROM rows JOIN centroids{rounds} ON number = cluster
"""


LLM_ORACLE = {
    "op1_url_filters": """
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0
                       THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
)
SELECT page_id, host, path,
       CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
            THEN 'www.example.com/en/'
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/')
            THEN 'example.com/en/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
            WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
       END AS rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM parts
""",
    "op4_line_dedup": r"""
WITH texts AS (
  SELECT text, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY text
), split_lines AS (
  SELECT text, first_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM texts
), lines AS (
  SELECT first_id, line_no, tokens, words, len(tokens) AS n, tokens[1:3] AS lead
  FROM (
    SELECT first_id, line_no,
           [t FOR t IN string_split_regex(line, '[ \t\r\f\v]+') IF t <> ''] AS words,
           [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END FOR t IN words] AS tokens
    FROM split_lines
  ) WHERE len(tokens) > 0
), patterns AS (
  SELECT n, lead, tokens, count(DISTINCT first_id) AS c FROM lines GROUP BY ALL
), places AS (
  SELECT n, lead, tokens, c, unnest(tokens[4:]) AS token, generate_subscripts(tokens[4:], 1) AS place FROM patterns
), constants AS (
  SELECT n, lead, place, token FROM places GROUP BY ALL HAVING sum(c) >= 10
), templates AS (
  SELECT p.n, p.lead, p.tokens,
         list(CASE WHEN k.token IS NULL THEN NULL ELSE p.token END ORDER BY p.place) AS template,
         count(k.token) AS fixed
  FROM places p LEFT JOIN constants k USING (n, lead, place, token) GROUP BY ALL
  UNION ALL
  SELECT n, lead, tokens, NULL, 0 FROM patterns WHERE n <= 3
), carried AS (
  SELECT l.first_id, l.line_no, l.n, l.lead, t.template
  FROM lines l JOIN templates t ON l.tokens = t.tokens
  WHERE t.fixed + 3 >= 0.7 * greatest(l.n, 3)
), recurring AS (
  SELECT n, lead, template, min(first_id) AS keeper FROM carried GROUP BY ALL HAVING count(DISTINCT first_id) >= 10
), verbatim AS (
  SELECT words, min(first_id) AS keeper FROM lines WHERE n >= 8 GROUP BY words HAVING count(DISTINCT first_id) >= 2
), gone AS (
  SELECT c.first_id, c.line_no
  FROM carried c JOIN recurring r
    ON c.n = r.n AND c.lead = r.lead AND c.template IS NOT DISTINCT FROM r.template AND c.first_id <> r.keeper
  UNION
  SELECT l.first_id, l.line_no FROM lines l JOIN verbatim v ON l.words = v.words AND l.first_id <> v.keeper
), kept AS (
  SELECT s.text, string_agg(CASE WHEN g.line_no IS NULL THEN s.line END, chr(10) ORDER BY s.line_no) AS kept_text,
         count(g.line_no) AS n_dropped
  FROM split_lines s LEFT JOIN gone g USING (first_id, line_no) GROUP BY s.text
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept_text, '') END AS text,
       CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::INT AS n_lines,
       coalesce(k.n_dropped, 0)::INT AS n_dropped
FROM documents d LEFT JOIN kept k USING (text)
""",
    "op11_chat_formatting": r"""
WITH events AS (
  SELECT conv_id, turn, role AS given_role, text AS given_text,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, t, r, x, r, x
  FROM (VALUES (0, 'user', '\### Assistant: </turn> ok'), (1, 'assistant', '\### Assistant: </turn> ok')) AS v(t, r, x)
), measured AS (
  SELECT *,
         length(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'))
           + length(role) - length(replace(role, chr(10), '')) AS role_chars,
         length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')) AS text_chars
  FROM events
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
                         ORDER BY turn NULLS FIRST, given_role NULLS FIRST, given_text NULLS FIRST)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, given_text NULLS FIRST)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(4 + role_chars + 1 + text_chars + 8)::BIGINT AS formatted_chars
FROM measured GROUP BY conv_id
""",
    "op12_fill_in_middle": r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), numbered AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM hashed
), cut AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbered
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix,
         array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix
  FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
    "op13_centroid_clustering": _clustering_sql(rounds=5),
}
