"""The registered queries as SQL over the same tables."""

from __future__ import annotations

from ledgerloom.functions.scripts import CLOSES, ENDS, WIDE

SILVER = """
  SELECT o.o_orderkey AS order_id,
         cast(o.o_orderdate + INTERVAL 336 MONTH AS DATE) AS order_date,
         o.o_orderpriority AS order_priority,
         cast(o.o_totalprice AS DECIMAL(18,2)) AS order_amount,
         c.c_name AS customer_name, c.c_mktsegment AS market_segment, n.n_name AS nation
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE cast(o.o_orderdate + INTERVAL 336 MONTH AS DATE)
        BETWEEN DATE '2020-01-01' AND DATE '2026-05-31'"""

GOLD = f"""
  SELECT cast(date_trunc('month', order_date) AS TIMESTAMP) AS order_month, market_segment,
         count(*) AS n_orders,
         cast(round(sum(order_amount), 0) AS BIGINT) AS total_sales,
         cast(round(avg(order_amount), 0) AS BIGINT) AS avg_order_value
  FROM ({SILVER}) GROUP BY 1, 2"""

SILVER_FLAT = f"SELECT * REPLACE (cast(order_amount AS DOUBLE) AS order_amount) FROM ({SILVER})"


def squeezed(text: str) -> str:
    return rf"trim(regexp_replace({text}, '[ \t\n\r]+', ' ', 'g'))"


STRIPPED = r"""regexp_replace(regexp_replace(html,
  '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"""
TITLE = r"regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"

DOCUMENTS = f"""
  SELECT 'doc-' || doc_id AS doc_id, {squeezed("split_part(text, chr(10), 1)")} AS title, text
  FROM documents
  UNION ALL
  SELECT 'page-' || page_id, {squeezed(TITLE)}, {squeezed(STRIPPED)} FROM pages"""

def chunks_of(documents: str) -> str:
    return rf"""
  SELECT doc_id, cast(start // 100 AS INTEGER) AS chunk_no,
         doc_id || '#' || (start // 100) AS chunk_id,
         array_to_string(words[start + 1 : start + 120], ' ') AS text
  FROM (SELECT doc_id, words,
               unnest(generate_series(0, greatest(len(words) - 21, 0), 100)) AS start
        FROM (SELECT doc_id, list_filter(regexp_split_to_array(trim(text), '[ \t\n\r]+'),
                                         lambda w: w <> '') AS words
              FROM ({documents}))
        WHERE len(words) > 0)"""


CHUNKS = chunks_of(DOCUMENTS)

SCRIPTS = [
    r"\p{Han}", r"\p{Hiragana}", r"\p{Katakana}ーｰ", r"\p{Thai}", r"\p{Lao}", r"\p{Khmer}", r"\p{Myanmar}",
]
ALL_SCRIPTS = "".join(SCRIPTS)
UNIT = (
    rf"[^ \t\n\r{ALL_SCRIPTS}{WIDE}{ENDS}{CLOSES}]*[{ALL_SCRIPTS}{WIDE}]{{0,3}}"
    rf"[{ENDS}]*[{CLOSES}]*[ \t\n\r]*"
)


def without_blanks(text: str) -> str:
    return (
        rf"translate(regexp_replace(lower({text}), '[ \t\n\r]+', '', 'g'), "
        "'abcdefghijklmnopqrstuvwxyz.,', 'あいうえおかきくけこアイウエオカキクケコ注文返品規則。、')"
    )


# Words, or three characters; each piece goes to the last end of a sentence in the second half
# of a hundred, or to the hundredth.
STOP = """coalesce(list_max(list_filter(range({0} + 50, least({0} + 99, len(units)) + 1), lambda i: ends[i])),
                   least({0} + 99, len(units)))"""

SPACELESS_CHUNKS = rf"""
  WITH RECURSIVE texts AS (SELECT doc_id, {without_blanks("text")} AS text FROM documents),
  cut AS MATERIALIZED (
    SELECT doc_id, units, list_transform(units, lambda u: regexp_matches(u, '[{ENDS}]')) AS ends
    FROM (SELECT doc_id, list_filter(regexp_extract_all(regexp_replace(text, '^[ \t\n\r]+', ''), '{UNIT}'),
                                     lambda u: u <> '') AS units FROM texts)),
  pieces AS (
    SELECT doc_id, 0 AS chunk_no, 1::BIGINT AS start, {STOP.format("1")} AS stop FROM cut WHERE len(units) > 0
    UNION ALL
    SELECT doc_id, chunk_no + 1, stop + 1, {STOP.format("(stop + 1)")}
    FROM pieces JOIN cut USING (doc_id) WHERE stop < len(units))
  SELECT doc_id, cast(chunk_no AS INTEGER) AS chunk_no, doc_id || '#' || chunk_no AS chunk_id,
         {squeezed("array_to_string(units[start : stop + 20], '')")} AS text
  FROM pieces JOIN cut USING (doc_id) WHERE start = 1 OR len(units) - start + 1 > 20"""


def pair_list(text: str) -> str:
    """Terms of a text that may hold scripts without blanks."""
    runs = "|".join(f"[{s}]+" for s in SCRIPTS)
    apart = rf"regexp_replace(lower({text}), '({runs})', ' \1 ', 'g')"
    return rf"""flatten(list_transform(
      list_filter(regexp_split_to_array({apart}, '[^\p{{L}}\p{{N}}{ALL_SCRIPTS}]+'), lambda t: t <> ''),
      lambda t: CASE WHEN regexp_matches(t, '^(?:{runs})$') AND length(t) > 1
                     THEN list_transform(range(1, length(t)), lambda i: substr(t, i, 2)) ELSE [t] END))"""


def term_list(text: str) -> str:
    return (
        rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), "
        "lambda t: t <> '')"
    )


def index_ctes(chunks: str, listed=term_list) -> str:
    return f"""
  passages AS MATERIALIZED (
    SELECT *, {listed("text")} AS terms, len({listed("text")}) AS n_terms
    FROM ({chunks})),
  postings AS MATERIALIZED (
    SELECT term, chunk_id, cast(count(*) AS INTEGER) AS tf,
           cast(any_value(n_terms) AS INTEGER) AS n_terms
    FROM (SELECT chunk_id, n_terms, unnest(terms) AS term FROM passages) GROUP BY 1, 2),
  vocabulary AS MATERIALIZED (SELECT term, count(*) AS df FROM postings GROUP BY 1),
  corpus AS MATERIALIZED (SELECT count(*) AS n_passages, avg(n_terms) AS mean_terms FROM passages)
"""


INDEX_CTES = index_ctes(CHUNKS)

QUESTIONS = """
  SELECT conv_id || '-' || turn AS question_id,
         text || CASE WHEN turn % 2 = 0 THEN ' ORD-' || (conv_id * 37 + turn * 11) ELSE '' END
           AS text
  FROM conversations WHERE role = 'user'"""

PARSED = rf"""
  SELECT question_id, text,
         try_cast(nullif(regexp_extract(text, '(?:^|[^0-9A-Za-z])ORD-([0-9]+)', 1), '') AS BIGINT)
           AS order_id
  FROM ({QUESTIONS})"""


# What is left after additions, removals and a replacement.
GROWN = """
  SELECT doc_id, CASE WHEN doc_id % 16 = 0 THEN text || ' amended' ELSE text END AS text
  FROM documents WHERE doc_id % 4 IN (0, 2) OR doc_id % 8 = 3"""


def search_ctes(questions: str, k: int, chunks: str = CHUNKS, listed=term_list) -> str:
    """CTEs up to ``hits(question_id, rank, chunk_id, score)``."""
    return f"""{index_ctes(chunks, listed)},
  asked AS (SELECT DISTINCT question_id, term
            FROM (SELECT question_id, unnest({listed("text")}) AS term FROM ({questions}))),
  scored AS (
    SELECT question_id, chunk_id,
           sum(cast(floor((floor(
                 ln(1 + (n_passages - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))
                 * (tf * 2.2::DOUBLE
                    / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n_terms / mean_terms)))
                 * 1e12::DOUBLE + 0.5::DOUBLE) + 5e5::DOUBLE) / 1e6::DOUBLE) AS BIGINT))
             / 1e6::DOUBLE AS score
    FROM asked JOIN vocabulary USING (term) JOIN postings USING (term) CROSS JOIN corpus
    GROUP BY 1, 2),
  hits AS (
    SELECT question_id, cast(rank AS INTEGER) AS rank, chunk_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id)
                      AS rank FROM scored)
    WHERE rank <= {k})"""


ANSWERS = f"""WITH {search_ctes(QUESTIONS, 3)},
  cited AS (
    SELECT question_id, string_agg(chunk_id, ' ' ORDER BY rank) AS cited,
           string_agg(p.text, chr(10) ORDER BY rank) AS passages
    FROM hits JOIN passages p USING (chunk_id) GROUP BY 1),
  answers AS (
    SELECT q.question_id, q.order_id, s.order_date, s.order_priority, s.order_amount,
           s.customer_name, s.market_segment, s.nation,
           s.order_id IS NOT NULL AS order_found, c.question_id IS NOT NULL AS rules_found,
           coalesce(c.cited, '') AS cited, coalesce(c.passages, '') AS passages
    FROM ({PARSED}) q
    LEFT JOIN ({SILVER_FLAT}) s ON s.order_id = q.order_id
    LEFT JOIN cited c ON c.question_id = q.question_id)"""

GUESSES = """
  SELECT doc_id AS case_id, lang, n_chars, quality
  FROM labels JOIN documents USING (doc_id)"""

DELTA = f"""
      WITH a AS (SELECT case_id, cast((n_chars >= 400) = (quality = 1) AS INT)::DOUBLE AS score_a
                 FROM ({GUESSES})),
           b AS (SELECT case_id, cast((n_chars >= 1500) = (quality = 1) AS INT)::DOUBLE AS score_b
                 FROM ({GUESSES}))
      SELECT case_id, score_a, score_b,
             CASE WHEN score_a IS NULL THEN 'added' WHEN score_b IS NULL THEN 'removed'
                  WHEN score_b > score_a THEN 'improved' WHEN score_b < score_a THEN 'regressed'
                  ELSE 'same' END AS change
      FROM a FULL JOIN b USING (case_id)"""

# Poisson weights of mean 1 from 8 digits of a digest, by the distribution function.
WEIGHT = """list_sum(list_transform(range(12), lambda k: CASE WHEN
  ('0x' || substr(md5('1:' || case_id || ':' || (r // 4)), (r % 4) * 8 + 1, 8))::BIGINT >= cdf[k + 1]
  THEN 1 ELSE 0 END))"""


def resampled(scored: str, sums: list[str], measures: dict[str, str], by: str = "") -> str:
    """Rows (by, measure, value, low, high) of 100 resamples; ``by`` is a column or nothing."""
    group = f"{by}, " if by else ""
    totals = ", ".join(f"sum(w * {c}) AS {c}" for c in sums)
    told = " UNION ALL ".join(
        f"SELECT {group}r, '{m}' AS measure, {e} AS value FROM totals" for m, e in measures.items()
    )
    return f"""
      WITH scored AS ({scored}),
      steps AS (SELECT list(floor(f * 4294967296)::BIGINT ORDER BY k) AS cdf FROM (
                  SELECT k, sum(exp(-1) / factorial(k::INT)) OVER (ORDER BY k) AS f FROM range(12) t(k))),
      weighted AS (SELECT s.*, r, {WEIGHT} AS w FROM scored s, range(100) t(r), steps
                   UNION ALL SELECT *, -1, 1 FROM scored),
      totals AS (SELECT {group}r, {totals} FROM weighted GROUP BY {group}r),
      told AS ({told})
      SELECT {group}measure, round(max(value) FILTER (r < 0), 6) AS value,
             round(quantile_cont(value, 0.025) FILTER (r >= 0), 6) AS low,
             round(quantile_cont(value, 0.975) FILTER (r >= 0), 6) AS high
      FROM told GROUP BY {group}measure"""


def outcome_sql(least: int, end: str = "") -> str:
    return f"""1 AS n_cases{end}, (n_chars >= {least} AND quality = 1)::INT AS tp{end},
      (n_chars >= {least} AND quality <> 1)::INT AS fp{end},
      (n_chars < {least} AND quality = 1)::INT AS fn{end},
      ((n_chars >= {least}) = (quality = 1))::INT AS hit{end}"""


COUNTS = ["n_cases", "tp", "fp", "fn", "hit"]


def ratio_sql(end: str = "") -> dict[str, str]:
    n, tp, fp, fn, hit = (c + end for c in COUNTS)
    return {
        "precision": f"{tp} / nullif(({tp} + {fp})::DOUBLE, 0)",
        "recall": f"{tp} / nullif(({tp} + {fn})::DOUBLE, 0)",
        "f1": f"2 * {tp} / nullif((2 * {tp} + {fp} + {fn})::DOUBLE, 0)",
        "hit_rate": f"{hit} / nullif({n}::DOUBLE, 0)",
    }


INTERVALS = resampled(f"SELECT case_id, lang, {outcome_sql(400)} FROM ({GUESSES})", COUNTS, ratio_sql(), "lang")
DIFFERENCES = resampled(
    f"SELECT case_id, {outcome_sql(400, '_a')}, {outcome_sql(1500, '_b')} FROM ({GUESSES})",
    [c + end for end in ("_a", "_b") for c in COUNTS],
    {m: f"({ratio_sql('_b')[m]}) - ({a})" for m, a in ratio_sql("_a").items()},
)

ORACLE: dict[str, str] = {
    "scan_orders": """
      SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_totalprice FROM orders""",
    "bronze_orders": "SELECT *, 'orders.parquet' AS source_file FROM orders",
    "bronze_stream_events": """
      SELECT *, CASE WHEN event_id % 4 = 3 THEN event_type || '!' END AS note,
             true AS has_source FROM events""",
    "bronze_evolving_events": """
      SELECT *, CASE WHEN event_id % 4 >= 2 THEN event_type || '!' END AS note,
             true AS has_source FROM events""",
    "session_scalars": """
      SELECT o_orderstatus, count(*) AS n_orders, true AS user_known,
             true AS user_is_session_user, true AS catalog_is_current
      FROM orders GROUP BY 1""",
    "landing_files": "SELECT item_id, cast(strlen(text) + 1 AS BIGINT) AS n_bytes FROM benchmark",
    "documents_from_files": f"""
      SELECT item_id, {squeezed("split_part(text, chr(10), 1)")} AS title, text,
             'plain' AS format FROM benchmark""",
    "rules_documents": DOCUMENTS,
    "user_slug": """
      SELECT c_custkey,
             'handson_' || lower(regexp_replace(
               split_part(c_name || '.' || c_mktsegment || '@desk.example', '@', 1),
               '[^0-9a-zA-Z]', '_', 'g')) AS schema_name
      FROM customer""",
    "namespace_setup": f"""
      SELECT *, true AS is_slug_of_user, true AS is_fallback_catalog, true AS is_current FROM (
        SELECT 'orders_silver' AS table_name, count(*) AS n_rows FROM ({SILVER})
        UNION ALL SELECT 'sales_monthly_gold', count(*) FROM ({GOLD}))""",
    "ctas_idempotent": SILVER_FLAT,
    "overwrite_table": GOLD,
    "publish_table": GOLD,
    "sales_gold_rolling": GOLD,
    "evaluate_intervals": INTERVALS,
    "difference_intervals": f"SELECT *, low > 0 OR high < 0 AS is_real FROM ({DIFFERENCES})",
    "record_request": f"""
      SELECT question_id AS request_id, order_id, text AS request_text FROM ({PARSED})""",
    "orders_silver": SILVER_FLAT,
    "sales_monthly_gold": GOLD,
    "dash_monthly_sales": f"""
      SELECT order_month, cast(sum(n_orders) AS BIGINT) AS n_orders,
             cast(sum(total_sales) AS BIGINT) AS total_sales
      FROM ({GOLD}) GROUP BY 1""",
    "dash_segment_share": f"""
      SELECT order_month, market_segment, total_sales,
             round(cast(total_sales AS DOUBLE)
                   / nullif(cast(sum(total_sales) OVER (PARTITION BY order_month) AS DOUBLE), 0)
                   * 100, 2) AS share_pct
      FROM ({GOLD})""",
    "dash_top_nations": f"""
      SELECT nation, count(*) AS n_orders, cast(sum(order_amount) AS DOUBLE) AS total_sales
      FROM ({SILVER}) GROUP BY 1 ORDER BY sum(order_amount) DESC NULLS LAST, nation LIMIT 10""",
    "dash_month_over_month": f"""
      SELECT market_segment, order_month, total_sales, previous_sales,
             total_sales - previous_sales AS change,
             round(cast(total_sales - previous_sales AS DOUBLE)
                   / nullif(cast(previous_sales AS DOUBLE), 0) * 100, 2) AS change_pct
      FROM (SELECT a.*, b.total_sales AS previous_sales FROM ({GOLD}) a
            LEFT JOIN ({GOLD}) b ON b.market_segment = a.market_segment
                                AND b.order_month = a.order_month - INTERVAL 1 MONTH)""",
    "rules_chunks": CHUNKS,
    "rules_index": f"WITH {INDEX_CTES} SELECT term, chunk_id, tf, n_terms FROM postings",
    "rules_vocabulary": f"WITH {INDEX_CTES} SELECT term, df FROM vocabulary",
    "index_report": f"""WITH {INDEX_CTES},
      copies AS (SELECT count(*) AS n_texts, max(n) AS most_copies
                 FROM (SELECT count(*) AS n FROM passages GROUP BY text))
      SELECT count(*) AS n_passages, count(*) FILTER (n_terms = 0) AS n_empty,
             cast(sum(n_terms) AS BIGINT) AS n_occurrences,
             count(DISTINCT doc_id) AS n_documents,
             count(*) - count(DISTINCT chunk_id) AS n_repeated_ids,
             any_value(n_texts) AS n_texts, any_value(most_copies) AS most_copies,
             (SELECT count(*) FROM postings) AS n_postings,
             (SELECT cast(sum(tf) AS BIGINT) FROM postings) AS n_listed_occurrences,
             (SELECT count(*) FROM vocabulary) AS n_vocabulary,
             count(*) - any_value(n_texts) AS n_repeated_texts,
             sum(n_terms) = (SELECT sum(tf) FROM postings) AS complete
      FROM passages CROSS JOIN copies""",
    "search_rules": f"""
      WITH {search_ctes("SELECT item_id AS question_id, text FROM benchmark", 5)}
      SELECT question_id, rank, chunk_id, score FROM hits""",
    "search_rules_by_postings": f"""
      WITH {search_ctes("SELECT item_id AS question_id, text FROM benchmark", 5)}
      SELECT question_id, rank, chunk_id, score FROM hits""",
    "spaceless_chunks": SPACELESS_CHUNKS,
    "search_grown_index": f"""
      WITH {search_ctes("SELECT item_id AS question_id, text FROM benchmark", 5, chunks_of(GROWN))}
      SELECT question_id, rank, chunk_id, score FROM hits""",
    "search_spaceless": f"""
      WITH {search_ctes(f"SELECT item_id AS question_id, {without_blanks('text')} AS text FROM benchmark", 5,
                        SPACELESS_CHUNKS, pair_list)}
      SELECT question_id, rank, chunk_id, score FROM hits""",
    "search_rules_sql": f"""
      WITH {search_ctes("SELECT 0 AS question_id, min(text) AS text FROM benchmark", 5)}
      SELECT rank, chunk_id, score, p.text FROM hits JOIN passages p USING (chunk_id)""",
    "search_order_info_sql": f"""
      SELECT q.question_id, s.*
      FROM ({PARSED}) q JOIN ({SILVER_FLAT}) s ON s.order_id = q.order_id""",
    "search_vectors": """
      WITH cells AS (
        SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding) AS x
        FROM embeddings),
      queries AS (
        SELECT label AS query_id, list(mean ORDER BY pos) AS centre
        FROM (SELECT label, pos, avg(cast(x AS DOUBLE)) AS mean FROM cells GROUP BY 1, 2)
        GROUP BY 1),
      scored AS (
        SELECT query_id, vec_id,
               floor((floor(list_cosine_similarity(centre, cast(embedding AS DOUBLE[]))
                            * 1e12::DOUBLE + 0.5::DOUBLE) + 5e5::DOUBLE) / 1e6::DOUBLE)
                 / 1e6::DOUBLE AS score
        FROM queries CROSS JOIN embeddings)
      SELECT cast(query_id AS BIGINT) AS query_id, cast(rank AS INTEGER) AS rank, vec_id, score
      FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                        AS rank FROM scored) WHERE rank <= 10""",
    "parse_order_id": f"SELECT question_id, order_id FROM ({PARSED})",
    "search_order_info": f"""
      SELECT q.question_id, q.order_id, s.* EXCLUDE (order_id), s.order_id IS NOT NULL AS found
      FROM ({PARSED}) q LEFT JOIN ({SILVER_FLAT}) s ON s.order_id = q.order_id""",
    "supervisor_answers": f"{ANSWERS} SELECT * FROM answers",
    "compare_routes": f"""{ANSWERS},
      routes AS (
        SELECT *, CASE WHEN order_found
                       THEN order_id || ' ' || order_date || ' ' || order_priority
                       ELSE '' END AS facts FROM answers)
      SELECT question_id, order_found AS data_only_found, facts AS data_only,
             rules_found AS rules_only_found, cited AS rules_only,
             order_found OR rules_found AS combined_found,
             trim(facts || ' ' || cited) AS combined,
             CASE WHEN order_found AND rules_found THEN 'both' WHEN order_found THEN 'data'
                  WHEN rules_found THEN 'rules' ELSE 'none' END AS support
      FROM routes""",
    "prompt_table": f"""
      SELECT doc_id, 'Summarise this document.' || chr(10) || chr(10)
             || {squeezed("split_part(text, chr(10), 1)")} || chr(10) || chr(10) || text AS prompt
      FROM documents""",
    "apply_model": """
      SELECT doc_id,
             CASE WHEN contains(text, '!! ') THEN NULL
                  WHEN length('Is this document long?' || chr(10) || chr(10) || text) >= 1000
                  THEN 'long' ELSE 'short' END AS answer,
             CASE WHEN contains(text, '!! ') THEN 'ValueError: shouting' END AS answer_error
      FROM documents""",
    "evaluate_answers": f"""
      WITH counts AS (
        SELECT lang, count(*) AS n_cases,
               count(*) FILTER (n_chars >= 400 AND quality = 1) AS tp,
               count(*) FILTER (n_chars >= 400 AND quality <> 1) AS fp,
               count(*) FILTER (n_chars < 400 AND quality = 1) AS fn,
               count(*) FILTER ((n_chars >= 400) = (quality = 1)) AS hit
        FROM ({GUESSES}) GROUP BY 1)
      SELECT lang, n_cases, tp, fp, fn,
             round(tp / nullif(cast(tp + fp AS DOUBLE), 0), 6) AS "precision",
             round(tp / nullif(cast(tp + fn AS DOUBLE), 0), 6) AS recall,
             round(2 * tp / nullif(cast(2 * tp + fp + fn AS DOUBLE), 0), 6) AS f1,
             round(hit / nullif(cast(n_cases AS DOUBLE), 0), 6) AS hit_rate
      FROM counts""",
    "evaluate_delta": DELTA,
    "delta_summary": f"SELECT change, count(*) AS n_cases FROM ({DELTA}) GROUP BY 1",
    "score_cases": f"""
      SELECT case_id, quality, cast(n_chars >= 400 AS INT) AS guess,
             abs(cast(n_chars >= 400 AS INT) - quality) AS off_by,
             cast(n_chars >= 400 AS INT) = quality AS "right"
      FROM ({GUESSES})""",
}
ORACLE["apply_model_once"] = ORACLE["apply_model"]
