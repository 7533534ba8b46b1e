"""The registered queries of this package that SQL can express, as SQL."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op1_substring_dedup": r"""
      WITH d AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents),
      w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM d),
      windows AS (
        SELECT doc_id, first, array_to_string(words[first : first + 12], ' ') AS said
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS first FROM d)),
      earliest AS (SELECT said, min(doc_id) AS least FROM windows GROUP BY said),
      gone AS (
        SELECT DISTINCT doc_id, first + unnest(range(0, 13)) AS place
        FROM windows JOIN earliest USING (said) WHERE least < doc_id),
      kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS said, count(*) AS n
        FROM w ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
      SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
             sha256(coalesce(said, '')) AS kept_sha256
      FROM d LEFT JOIN kept USING (doc_id)""",
    "op6_exact_topk": """
      WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      scored AS (
        SELECT q.vec_id AS query_id, d.vec_id,
               cast(list_inner_product(q.v, d.v) AS BIGINT) AS score
        FROM v q JOIN v d ON q.vec_id % 100 = 0 AND d.vec_id <> q.vec_id)
      SELECT query_id, cast(place AS INTEGER) AS rank, vec_id, score
      FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                        AS place FROM scored) WHERE place <= 10""",
    "op11_chat_format": r"""
      WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
      named AS (
        SELECT *, role IN ('user', 'system', 'assistant') AS known,
               regexp_matches(role || ' ' || text, '\[\\*/?(INST|SYS|ROLE|TEXT)\]|<\\*/?s>') AS clash
        FROM t),
      sized AS (
        SELECT *, length(role || text) + len(regexp_extract_all(CASE WHEN known THEN '' ELSE role END || ' ' || text,
                            '\[\\*/?(?:INST|SYS|ROLE|TEXT)\]|<\\*/?s>')) AS content
        FROM named)
      SELECT conv_id, count(*) AS n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
             cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
             sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                               ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
             cast(sum(content - CASE WHEN known THEN length(role) ELSE 0 END
                      + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 7 ELSE 26 END) AS BIGINT)
               AS formatted_chars
      FROM sized GROUP BY conv_id""",
    "op12_prefix_trie": """
      WITH t AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS place
        FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
                     sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS key
              FROM conversations WHERE conv_id IS NOT NULL)),
      sizes AS (SELECT conv_id, count(*) AS n FROM t GROUP BY 1),
      plan AS (
        SELECT a.conv_id, a.first, h, least(h, coalesce(b.n, 0)) AS taken
        FROM (SELECT conv_id, conv_id - conv_id % 100 AS first,
                     xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                           lambda acc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(acc, b)),
                           4294967295::BIGINT), 4294967295) % 6 AS h FROM sizes) a
        LEFT JOIN sizes b ON b.conv_id = a.first),
      turns AS (
        SELECT plan.conv_id, place, key, chars FROM plan JOIN t ON t.conv_id = plan.first AND place <= taken
        UNION ALL
        SELECT conv_id, place - h + taken, key, chars FROM t JOIN plan USING (conv_id) WHERE place > h),
      paths AS (
        SELECT conv_id, place AS depth, chars,
               string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY place) AS path FROM turns
        UNION ALL SELECT conv_id, 0, 0, '' FROM sizes),
      nodes AS (
        SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars
        FROM paths GROUP BY 1),
      children AS (
        SELECT substr(path, 1, length(path) - 64) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
      ends AS (
        SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
        FROM (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY 1) GROUP BY 1),
      below AS (
        SELECT up.path, cast(sum(cast(c.path IS NULL AS INT)) AS BIGINT) AS n_leaves,
               cast(sum((n.n_convs - 1) * n.chars) AS BIGINT) AS saved_tokens
        FROM nodes n LEFT JOIN children c USING (path)
        JOIN paths up ON up.conv_id = n.conv_id AND up.depth <= n.depth GROUP BY 1)
      SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
             coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved_tokens,
             coalesce(ends_sha256, sha256('')) AS ends_sha256
      FROM nodes n JOIN below USING (path) LEFT JOIN children USING (path) LEFT JOIN ends USING (path)
      LEFT JOIN nodes p ON n.depth > 0 AND p.path = substr(n.path, 1, length(n.path) - 64)""",
    "op13_hard_negatives": """
      WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      scored AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same,
               cast(list_inner_product(a.v, d.v) AS BIGINT) AS score
        FROM v a JOIN v d ON a.vec_id % 50 = 0 AND d.vec_id <> a.vec_id),
      positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score
        FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
              FROM scored WHERE same) WHERE place <= 5),
      negatives AS (
        SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS place
        FROM positives p JOIN scored n USING (anchor_id)
        WHERE NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score)
      SELECT anchor_id, positive_id, cast(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
      FROM negatives WHERE place <= 3""",
}
