"""DuckDB SQL equivalents of the registered queries (same keys, same column
names). Tables are the pre-registered views of the data directory.

Scores are computed in DOUBLE, rounded to 6 places and ranked on the rounded
value with ``id`` as the tie-break, exactly like the Spark side. The SQL is
deliberately brute force (all pairs, naive joins): it is the reference the
distributed plans are checked against.
"""

from __future__ import annotations

from vecdex.functions.text import (JAVA_WHITESPACE, JS_TRIM_CHARS, MSG_BLANK, MSG_LIMIT,
                                   MSG_TOO_LONG)

SQL: dict[str, str] = {}

DIM = 64
POSTER_BASE = "https://posters.example.org/w500"


def _cos(a: str, b: str) -> str:
    return f"round(list_cosine_similarity({a}::DOUBLE[], {b}::DOUBLE[]), 6)"


def _topk(qid: str, cid: str, qsrc: str, csrc: str, score: str, k: int) -> str:
    return f"""
SELECT qid, CAST(rank AS INTEGER) AS rank, id, score FROM (
  SELECT {qid} AS qid, {cid} AS id, {score} AS score,
         row_number() OVER (PARTITION BY {qid} ORDER BY {score} DESC, {cid}) AS rank
  FROM {qsrc}, {csrc})
WHERE rank <= {k}"""


# -- text helpers (same fixed character classes as the Spark side) ----------
def _len16(x: str) -> str:
    return f"(length({x}) + length(regexp_replace({x}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"


def _blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_full_match({x}, '[{JAVA_WHITESPACE}]*'))"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '\\A[{JS_TRIM_CHARS}]+|[{JS_TRIM_CHARS}]+\\z', '', 'g')"


def _error(q: str, lim: str) -> str:
    return (f"CASE WHEN {_blank(q)} THEN '{_sq(MSG_BLANK)}' "
            f"WHEN {_len16(q)} > 500 THEN '{_sq(MSG_TOO_LONG)}' "
            f"WHEN coalesce({lim}, 10) < 1 THEN '{_sq(MSG_LIMIT)}' END")


def _sq(s: str) -> str:
    return s.replace("'", "''")


_CQ = """cq AS (SELECT conv_id * 100 + turn AS qid, text AS query,
                  CAST(CASE WHEN role = 'system' THEN NULL ELSE turn * 13 - 20 END AS INTEGER) AS lim
           FROM conversations)"""


def _u5(name: str, src: str, key: str, text: str) -> str:
    """CTEs <name>_sp (k, b, v) and <name>_d (k, vec, n) for the hashing embedder."""
    return f"""
{name}_tok AS (SELECT {key} AS k, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS t
               FROM {src}),
{name}_sp AS (SELECT k, ('0x' || substr(md5(t), 1, 8))::BIGINT % {DIM} AS b,
                     sum(CASE WHEN ('0x' || substr(md5(t), 9, 1))::INTEGER < 8 THEN 1 ELSE -1 END)::DOUBLE AS v
              FROM {name}_tok WHERE t <> '' GROUP BY 1, 2),
{name}_d AS (SELECT keys.k, list(coalesce(sp.v, 0.0) ORDER BY r.pos) AS vec
             FROM (SELECT DISTINCT {key} AS k FROM {src}) keys CROSS JOIN range({DIM}) r(pos)
             LEFT JOIN {name}_sp sp ON sp.k = keys.k AND sp.b = r.pos GROUP BY keys.k),
{name}_n AS (SELECT k, vec, greatest(sqrt(list_dot_product(vec, vec)), 1e-9) AS n FROM {name}_d)"""


def _text_search(valid_cte: str, src: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """Hits (qid, rank, id, score) of the ``v`` CTE (qid, query, k) against the
    hashed texts of ``src``; helper CTEs only."""
    return f"""{valid_cte},
{_u5('q', 'v', 'qid', 'query')},
{_u5('d', src, key, text)},
sc AS (SELECT q.k AS qid, d.k AS id, round(list_dot_product(q.vec, d.vec) / (q.n * d.n), 6) AS score
       FROM q_n q, d_n d),
rk AS (SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM sc),
hits AS (SELECT rk.qid, CAST(rk.rank AS INTEGER) AS rank, rk.id, rk.score
         FROM rk JOIN v USING (qid) WHERE rk.rank <= v.k)"""


_VALID = f"""v AS (SELECT qid, query, least(coalesce(lim, 10), 50) AS k FROM cq
          WHERE ({_error('query', 'lim')}) IS NULL)"""

# ---------------------------------------------------------------------------
# K: search
# ---------------------------------------------------------------------------

SQL["k2_topk"] = _topk("q.vec_id", "c.vec_id", "embeddings q", "embeddings c",
                       _cos("q.embedding", "c.embedding"), 10)

SQL["k1_topk_single"] = f"""
WITH c AS (SELECT list(v ORDER BY pos) AS cen FROM (
             SELECT pos, avg(x) AS v FROM (
               SELECT unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS pos
               FROM embeddings) GROUP BY pos)),
s AS (SELECT vec_id AS id, {_cos('embedding', 'c.cen')} AS score FROM embeddings, c)
SELECT CAST(rank AS INTEGER) AS rank, id, score FROM (
  SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM s)
WHERE rank <= 10"""

SQL["f5_filtered_topk"] = _topk(
    "q.vec_id", "c.vec_id", "embeddings q",
    "(SELECT * FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents WHERE lang = 'en')) c",
    _cos("q.embedding", "c.embedding"), 10)

SQL["u2_stub_search"] = _topk(
    "b.item_id", "c.vec_id",
    "benchmark b, (SELECT list_transform(range(64), lambda i: CASE WHEN i % 2 = 0 THEN 0.1 ELSE -0.1 END) AS sv) s",
    "embeddings c", _cos("s.sv", "c.embedding"), 10)

SQL["u5_hash_embed"] = f"""
WITH {_u5('d', 'documents', 'doc_id', 'text')}
SELECT k AS doc_id, CAST(b AS INTEGER) AS pos, v AS value FROM d_sp WHERE v <> 0"""

SQL["u3_search"] = f"""
WITH {_CQ}, {_text_search(_VALID)}
SELECT h.qid, h.rank, h.id, h.score, d.lang, d.source
FROM hits h JOIN documents d ON d.doc_id = h.id"""

SQL["a1_counts"] = f"""
WITH {_CQ}, {_text_search(_VALID)},
cnt AS (SELECT qid, count(*) AS n FROM hits GROUP BY qid)
SELECT cq.qid, CAST(least(coalesce(cq.lim, 10), 50) AS INTEGER) AS requested_limit,
       CAST(coalesce(cnt.n, 0) AS INTEGER) AS count, {_error('cq.query', 'cq.lim')} AS error
FROM cq LEFT JOIN cnt USING (qid)"""

SQL["k3_suggest"] = f"""
WITH {_CQ},
sq AS (SELECT qid, {_trim('query')} AS query FROM cq
       WHERE coalesce({_len16(_trim('query'))} >= 2, false)),
{_text_search(f"v AS (SELECT qid, query, 3 AS k FROM sq WHERE ({_error('query', '3')}) IS NULL)")}
SELECT qid, rank, id, score FROM hits"""

# ---------------------------------------------------------------------------
# P / F: scalar rules
# ---------------------------------------------------------------------------

_FULL = "regexp_full_match(raw, '[0-9]{4}-[0-9]{2}-[0-9]{2}')"
SQL["p1_year"] = f"""
WITH v AS (SELECT o_orderkey, CASE o_orderkey % 7
             WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
             WHEN 1 THEN strftime(o_orderdate, '%Y')
             WHEN 2 THEN strftime(o_orderdate, '%Y-%m')
             WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') || chr(10)
             WHEN 4 THEN ''
             WHEN 5 THEN strftime(o_orderdate, '%Y') || '-99-99'
             ELSE 'n/a' END AS raw FROM orders)
SELECT o_orderkey, raw,
       CASE WHEN {_FULL} THEN CAST(substr(raw, 1, 4) AS INTEGER) END AS release_year,
       CASE WHEN {_FULL} OR regexp_full_match(raw, '[0-9]{{4}}')
            THEN CAST(substr(raw, 1, 4) AS INTEGER) END AS release_year_doc
FROM v"""

SQL["p2_json_values"] = """
SELECT event_id,
       array_to_string(list_transform(json_keys(props),
                       lambda k: json_extract_string(props, '$."' || k || '"')), '|') AS genres,
       CAST(len(json_keys(props)) AS INTEGER) AS n_values
FROM events"""

SQL["p3_snippet"] = """
SELECT doc_id, left(text, 300) AS snippet, left(text, 50) AS preview FROM documents"""

SQL["p4_display"] = """
SELECT doc_id, left(coalesce(text, ''), 200) AS display FROM documents"""

SQL["p8_escape"] = """
SELECT page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'),
                                '>', '&gt;'), '"', '&quot;') AS escaped FROM pages"""

SQL["p14_trim"] = f"""
WITH {_CQ}
SELECT qid, {_trim('query')} AS trimmed, coalesce({_len16(_trim('query'))} >= 2, false) AS suggest
FROM cq"""

SQL["f1_validate"] = f"""
WITH {_CQ}
SELECT qid, {_error('query', 'lim')} AS error,
       CAST(least(coalesce(lim, 10), 50) AS INTEGER) AS effective_limit,
       CAST({_len16('query')} AS INTEGER) AS len16
FROM cq"""

# ---------------------------------------------------------------------------
# J / A
# ---------------------------------------------------------------------------

SQL["j1_join"] = """
SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
FROM documents d JOIN labels l ON l.doc_id = d.doc_id"""

SQL["j2_unmatched"] = """
SELECT DISTINCT doc_id AS movie_id, 'no_summary' AS reason FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL
SELECT DISTINCT doc_id AS movie_id, 'no_metadata' AS reason FROM labels
WHERE doc_id NOT IN (SELECT doc_id FROM documents)"""

_ORD = "{'ts': ts, 'e': event_id}"
SQL["a3_last_wins"] = f"""
SELECT user_id, arg_max(event_id, {_ORD}) AS event_id, arg_max(event_type, {_ORD}) AS event_type,
       arg_max(value, {_ORD}) AS value, min(event_id) AS first_event_id
FROM events GROUP BY user_id"""

SQL["a5_mean_pool"] = """
SELECT label, CAST(pos AS INTEGER) AS pos, round(avg(x), 6) AS value FROM (
  SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS pos
  FROM embeddings)
GROUP BY label, pos"""

SQL["p10_masked_pool"] = f"""
WITH c AS (SELECT conv_id, conv_id * 100 + turn AS k, role, text FROM conversations),
{_u5('t', 'c', 'k', 'text')}
SELECT c.conv_id, CAST(r.pos AS INTEGER) AS pos, round(avg(coalesce(sp.v, 0.0)), 6) AS value
FROM c CROSS JOIN range({DIM}) r(pos)
LEFT JOIN t_sp sp ON sp.k = c.k AND sp.b = r.pos
WHERE c.role = 'user'
GROUP BY c.conv_id, r.pos"""

# ---------------------------------------------------------------------------
# vectors / index health
# ---------------------------------------------------------------------------

SQL["p9_norm"] = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
u AS (SELECT vec_id, v, list_transform(v, lambda x: (x / greatest(sqrt(list_dot_product(v, v)), 1e-9))::FLOAT::DOUBLE) AS u
      FROM e)
SELECT vec_id AS id, round(sqrt(list_dot_product(v, v)), 6) AS norm,
       round(sqrt(list_dot_product(u, u)), 6) AS unit_norm, round(u[1], 6) AS u0
FROM u"""

SQL["p13_cosine"] = """
SELECT vec_id AS id, round(list_cosine_similarity(embedding::DOUBLE[], s.sv), 6) AS score
FROM embeddings, (SELECT list_transform(range(64), lambda i: CASE WHEN i % 2 = 0 THEN 0.1 ELSE -0.1 END) AS sv) s"""

SQL["a4_health"] = f"""
SELECT count(*) AS points_count,
       CAST(sum(CASE WHEN embedding IS NULL OR len(embedding) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS missing_vectors,
       CAST(sum(CASE WHEN coalesce(len(embedding) <> {DIM}, true) THEN 1 ELSE 0 END) AS BIGINT) AS bad_dim,
       0 AS enriched,
       round(min(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 6) AS min_norm,
       round(max(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 6) AS max_norm
FROM embeddings"""

# ---------------------------------------------------------------------------
# S: index maintenance
# ---------------------------------------------------------------------------

SQL["s6_ids"] = """
SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS id FROM documents"""

_DELTA = """delta AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice + 100 AS p_retailprice
  FROM part WHERE p_size > 45
  UNION ALL
  SELECT p_partkey + 1000000, p_name, p_brand, p_type, p_size, p_retailprice
  FROM part WHERE p_size = 50)"""

SQL["s8_upsert"] = f"""
WITH {_DELTA}
SELECT * FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM delta)
UNION ALL SELECT * FROM delta"""

SQL["s10_set_payload"] = """
SELECT p.p_partkey, p.p_name, coalesce(u.p_brand, p.p_brand) AS p_brand, p.p_type,
       p.p_size, p.p_retailprice
FROM part p LEFT JOIN (SELECT p_partkey, p_brand || '-new' AS p_brand FROM part
                       WHERE p_size % 10 = 0) u ON u.p_partkey = p.p_partkey"""

SQL["s7_index_create"] = """
SELECT row_number() OVER (ORDER BY d.doc_id) - 1 AS id, d.doc_id, d.lang,
       CAST(NULL AS VARCHAR) AS thumbnail_url, 64 AS dim, 'cosine' AS metric
FROM documents d WHERE d.doc_id IN (SELECT vec_id FROM embeddings)"""

SQL["s9_scroll"] = """
SELECT doc_id AS id, lang, source FROM documents WHERE lang = 'de' ORDER BY doc_id LIMIT 100"""

SQL["s9_pages"] = """
SELECT doc_id AS id, lang, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS page
FROM documents WHERE lang = 'en'"""

_LINES = ("(length(text) - length(replace(text, chr(10), ''))"
          " + CASE WHEN length(text) > 0 AND NOT ends_with(text, chr(10)) THEN 1 ELSE 0 END)")
SQL["s4_count"] = f"""
SELECT CAST(sum({_LINES}) AS BIGINT) AS n_lines,
       format('{{:,}}', CAST(sum({_LINES}) AS BIGINT)) AS label
FROM documents"""

# ---------------------------------------------------------------------------
# enrichment
# ---------------------------------------------------------------------------

_LOOKUP = """pts AS (SELECT p_partkey AS id, p_name AS title,
                    CASE WHEN p_size % 3 = 0 THEN NULL ELSE 1990 + p_size % 20 END AS year
             FROM part),
cat AS (SELECT p_name AS title, 1990 + p_partkey % 20 AS year,
               row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rank,
               CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN ''
                    ELSE '/' || p_brand || '/' || CAST(p_partkey AS VARCHAR) || '.jpg' END AS poster_path
        FROM part),
m AS (SELECT p.id, c.poster_path, row_number() OVER (PARTITION BY p.id ORDER BY c.rank) AS rn
      FROM pts p LEFT JOIN cat c ON c.title = p.title AND (p.year IS NULL OR c.year = p.year)),
found AS (SELECT id, nullif(poster_path, '') AS poster_path FROM m WHERE rn = 1)"""

SQL["j5_lookup"] = f"""
WITH {_LOOKUP}
SELECT id, poster_path, '{POSTER_BASE}' || poster_path AS poster_url FROM found"""

SQL["f4_enriched"] = f"""
WITH {_LOOKUP}
SELECT count(*) AS points_count, coalesce(bool_or(poster_path IS NOT NULL), false) AS any_enriched,
       CAST(sum(CASE WHEN poster_path IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS still_null
FROM found"""

# ---------------------------------------------------------------------------
# corpus files, streaming
# ---------------------------------------------------------------------------

_MDATE = ("CASE WHEN n_chars % 4 = 0 THEN '' WHEN n_chars % 4 = 1 THEN CAST(1900 + n_chars % 120 AS VARCHAR) "
          "ELSE printf('%04d-%02d-%02d', 1900 + n_chars % 120, 1 + n_chars % 12, 1 + n_chars % 28) END")
SQL["s1_corpus_build"] = f"""
WITH m AS (SELECT doc_id, source, lang, {_MDATE} AS raw FROM documents)
SELECT CAST(m.doc_id AS VARCHAR) AS movie_id, m.source || ' #' || CAST(m.doc_id AS VARCHAR) AS title,
       CASE WHEN regexp_full_match(raw, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
            THEN CAST(substr(raw, 1, 4) AS INTEGER) END AS release_year,
       upper(m.lang) || '|' || m.source AS genres,
       left(regexp_replace(d.text, '[\\r\\n]+', ' ', 'g'), 300) AS summary_snippet
FROM m JOIN documents d ON d.doc_id = m.doc_id
WHERE m.doc_id IN (SELECT doc_id FROM labels)"""

_RECORDS = SQL["s1_corpus_build"].removeprefix("\nWITH ").replace(
    "SELECT CAST(m.doc_id AS VARCHAR) AS movie_id", "SELECT m.doc_id, CAST(m.doc_id AS VARCHAR) AS movie_id")
_M, _SELECT = _RECORDS.split("FROM documents)\n", 1)
SQL["p7_movie_search"] = f"""
WITH {_CQ}, {_M}FROM documents),
rec AS ({_SELECT}),
f AS (SELECT * FROM rec WHERE release_year >= 1950 AND list_contains(string_split(genres, '|'), 'EN')),
{_text_search(_VALID, "f", "doc_id", "summary_snippet")}
SELECT h.qid, h.rank, f.title, f.release_year AS year, f.genres, h.score, f.summary_snippet,
       CAST(NULL AS VARCHAR) AS thumbnail_url
FROM hits h JOIN f ON f.doc_id = h.id"""

SQL["st1_stream_search"] = SQL["u3_search"]

SQL["st2_ingest"] = f"""
WITH {_u5('d', 'documents', 'doc_id', 'text')}
SELECT doc.doc_id AS id, doc.lang,
       CAST(coalesce((SELECT count(*) FROM d_sp WHERE d_sp.k = doc.doc_id AND d_sp.v <> 0), 0) AS INTEGER) AS nonzero
FROM documents doc"""

SQL["st3_debounce"] = """
SELECT event_id, user_id, event_type FROM (
  SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nts FROM events)
WHERE nts IS NULL OR nts >= ts + INTERVAL 1 HOUR"""

SQL["st4_rate"] = """
SELECT event_id, user_id, n_window, n_window > 2 AS over_limit FROM (
  SELECT event_id, user_id,
         count(*) OVER (PARTITION BY user_id ORDER BY ts
                        RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n_window
  FROM events)"""

# Append-mode session windows over one input file: the batch debounce rows
# whose session (last event + gap) has closed under the final watermark
# (max event time - 10 minutes). Open sessions are withheld by the stream.
SQL["st3_debounce_stream"] = """
SELECT event_id, user_id, event_type FROM (
  SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nts FROM events)
WHERE (nts IS NULL OR nts >= ts + INTERVAL 1 HOUR)
  AND ts + INTERVAL 1 HOUR < (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""


def _replay_sql(m: int, window: float) -> str:
    """Start times per user as a recursive CTE in integer microseconds: the
    latest of the arrival, the start before, and the start m calls before plus
    the window."""
    w = round(window * 1_000_000)
    start = f"greatest(e.us, coalesce(r.last[{m}], e.us), coalesce(r.last[1] + {w}, e.us))"
    return f"""
WITH RECURSIVE ev AS (
  SELECT event_id, user_id, epoch_us(ts) AS us,
         row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) AS i
  FROM events),
r(user_id, i, event_id, us, start, last) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
         CAST(NULL AS BIGINT), CAST([{', '.join(['NULL'] * m)}] AS BIGINT[]) FROM ev
  UNION ALL
  SELECT e.user_id, e.i, e.event_id, e.us, {start}, list_append(r.last[2:], {start})
  FROM r JOIN ev e ON e.user_id = r.user_id AND e.i = r.i + 1)
SELECT event_id, user_id, us / 1e6 AS arrival, start / 1e6 AS admitted, (start - us) / 1e6 AS delay
FROM r WHERE i > 0"""


SQL["st4_replay_stream"] = _replay_sql(2, 3600.0)

# every list probed is the exact search
SQL["k4_ivf_full"] = SQL["k2_topk"]
SQL["k2_pruned_topk"] = SQL["k2_topk"]

# brute force: every point against every catalogue row
SQL["j5_fuzzy_lookup"] = """
WITH p AS (SELECT *, p_name || ' ' || p_type || ' ' || p_size AS t, 1 + p_partkey % length(p_name || ' ' || p_type || ' ' || p_size) AS pos FROM part),
c AS (SELECT lower(t) AS t, 1990 + p_partkey % 20 AS year, row_number() OVER (PARTITION BY t ORDER BY p_partkey) AS rank,
             CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN '' ELSE '/' || p_partkey || '.jpg' END AS path FROM p),
q AS (SELECT p_partkey AS id, CASE WHEN p_size % 3 <> 0 THEN 1990 + p_partkey % 20 END AS year,
             lower(trim(CASE p_partkey % 4 WHEN 0 THEN t WHEN 1 THEN left(t, pos - 1) || substr(t, pos + 1)
                   WHEN 2 THEN left(t, pos - 1) || 'x' || substr(t, pos) ELSE left(t, pos - 1) || 'q' || substr(t, pos + 1) END)) AS t FROM p),
m AS (SELECT q.id, c.t AS match_title, levenshtein(q.t, c.t) AS edits, path,
             row_number() OVER (PARTITION BY q.id ORDER BY levenshtein(q.t, c.t), c.rank, c.t) AS k
      FROM q JOIN c ON levenshtein(q.t, c.t) <= 2 AND (q.year IS NULL OR q.year = c.year))
SELECT q.id, match_title, CAST(edits AS INTEGER) AS edits, nullif(path, '') AS poster_path
FROM q LEFT JOIN m ON m.id = q.id AND m.k = 1"""

# streams that decide what waits at the end equal the batch forms
SQL["st3_timer_stream"] = SQL["st3_debounce"]
SQL["st4_timer_audit"] = SQL["st4_rate"]

# a masked mean over no rows is null, and has no rows once unrolled
SQL["p10_token_pool"] = SQL["p10_masked_pool"]

SQL["p11_float32"] = """
SELECT p_partkey, CAST(pos AS INTEGER) AS pos, CAST(CAST(CASE pos WHEN 0 THEN p_retailprice / 3 ELSE p_retailprice * 7 END AS FLOAT) AS DOUBLE) AS value
FROM part, range(2) r(pos)"""

SQL["p12_dimensions"] = """
SELECT vec_id AS id, label % 5 = 0 OR label % 3 <> 0 AS bad FROM embeddings"""

SQL["a2_response_rows"] = f"""
WITH {_CQ}, {_text_search(_VALID)},
n AS (SELECT qid, count(*) AS count FROM hits GROUP BY qid)
SELECT h.qid, CAST(v.k AS INTEGER) AS requested_limit, CAST(n.count AS INTEGER) AS count, h.rank, h.id, h.score, d.lang, d.source
FROM hits h JOIN v USING (qid) JOIN n USING (qid) JOIN documents d ON d.doc_id = h.id"""

SQL["k5_result_cap"] = f"""
WITH c AS (SELECT list(v ORDER BY pos) AS cen FROM (
             SELECT pos, avg(x) AS v FROM (
               SELECT unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS pos
               FROM embeddings) GROUP BY pos)),
s AS (SELECT vec_id AS id, {_cos('embedding', 'cen')} AS score FROM embeddings, c WHERE label = 0)
SELECT CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS rank, id, score FROM s"""

SQL["s5_artifacts"] = """
SELECT d.doc_id, d.lang, d.source, len(e.embedding) AS dim,
       round(sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])), 6) AS norm
FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id"""

SQL["s12_guard"] = """
WITH a AS (SELECT count(*) AS n, count(*) FILTER (label = 0) AS m FROM embeddings)
SELECT 0 AS step, n AS points_count, n > 0 AS loaded, TRUE AS wrote FROM a
UNION ALL SELECT 1, n, n > 0, FALSE FROM a UNION ALL SELECT 2, m, m > 0, TRUE FROM a"""

SQL["s9_scrollable"] = """
SELECT doc_id AS id, lang, source FROM documents
WHERE lang = 'en' AND doc_id > (SELECT floor((min(doc_id) + max(doc_id)) / 2) FROM documents) ORDER BY doc_id LIMIT 100"""

SQL["f6_rows"] = f"""
WITH m AS (SELECT doc_id, source, lang, {_MDATE} AS raw FROM documents),""" + """
l AS (SELECT doc_id, length(concat_ws(chr(9), doc_id, 'w' || doc_id, source || ' #' || doc_id, raw, '', '', lang, '',
             '{"a": "' || lang || '", "b": "' || source || '", "a": "' || upper(lang) || '"}')) % 4 AS cut FROM m)
SELECT doc_id, CAST(CASE WHEN cut > 1 THEN 9 - cut ELSE 9 END AS INTEGER) AS n_columns, cut <= 1 AS kept FROM l"""
