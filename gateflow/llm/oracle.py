"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from gateflow.llm.quality import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in sorted({s for v in STOP_WORDS.values() for s in v.split()}))
_LANGS = ", ".join(f"'{x}'" for x in STOP_WORDS)

OP9 = f"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\x09-\\x0D]')) AS l
  FROM documents),
g AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
p AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, lang, len(w) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS BIGINT) AS n_marks,
         len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words,
         CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN p ON d.doc_id = p.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND word_chars / n_words BETWEEN 2.0 AND 14.0
       AND n_symbols / n_words <= 0.2 AND n_marks / n_words <= 0.5
       AND (lang IS NULL OR lang NOT IN ({_LANGS}) OR n_stop_words / n_words >= 0.02)
       AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.5) AS kept
FROM m
"""

# Formatted: <|im_start|>role\\n before and \\n<|im_end|>\\n behind each run of one role,
# \\n<|im_sep|>\\n between its texts, a backslash before each control string in a text.
OP7 = r"""
WITH s AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, row_number() OVER w AS k, coalesce(lag(role) OVER w = role, false) AS same,
         length(text) + len(regexp_extract_all(text,
           '<\|im_(start|sep|end)\|>|</?s>|\[/?INST\]|<</?SYS>>')) AS n
  FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n + CASE WHEN same THEN 12 ELSE 13 + length(url_encode(role)) + 12 END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP8 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
FROM p
"""

_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

OP11 = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_all FROM t WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
f AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM t)
  WHERE term IN (SELECT term FROM q) GROUP BY r, term),
g AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM f GROUP BY term), c),
m AS (SELECT r, doc_id, 100 - 90 + ((90 * len(w) * n_docs) // n_all) AS m FROM t, c WHERE len(w) > 0),
s AS (
  SELECT item_id, m.r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM f JOIN m ON f.r = m.r JOIN g ON f.term = g.term JOIN q ON f.term = q.term GROUP BY item_id, m.r, doc_id),
k AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""

OP12 = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
           FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, CAST('0x' || h[1:8] AS BIGINT) AS h1,
         CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3,
         CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM h),
c AS (
  SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT doc_id, t, form, CAST(len(u) AS BIGINT) AS n, array_to_string(list_slice(u, 1, a), '') AS p,
         array_to_string(list_slice(u, a + 1, b), '') AS m, array_to_string(list_slice(u, b + 1, len(u)), '') AS s
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

# The level is the words per weight at which the targets below their ceilings stand: with the first k - 1
# sources, by ceiling over weight, at their ceilings, the first one that leaves the next below its own.
OP13 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r
  FROM d GROUP BY source),
w AS (SELECT *, CASE r % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM s),
k AS (SELECT *, row_number() OVER (ORDER BY cap / weight, r) AS k FROM w),
l AS (
  SELECT k, weight, cap,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM k),
x AS (SELECT level FROM l WHERE level * weight <= cap ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_size, CAST(CASE WHEN level * weight > cap THEN cap ELSE level * weight END AS DOUBLE) AS target,
         CAST('0x' || substr(sha256('1' || coalesce('=' || source, '')), 1, 10) AS BIGINT) AS u
  FROM w, x),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 1099511627776.0) AS BIGINT) ELSE 0 END AS step
  FROM t),
n AS (
  SELECT doc_id, d.source, size, source_size, target, step, u,
         row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS FIRST) - 1 AS i
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
e AS (
  SELECT *, CAST((CAST((CAST(step AS HUGEINT) * i + u) % 1099511627776 AS BIGINT) + step) // 1099511627776 AS BIGINT) AS copies
  FROM n)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, source, copies FROM e
"""

SQL = {"op11_ranked_search": OP11, "op12_fim": OP12, "op13_mixing": OP13, "op7_chat": OP7, "op8_warc": OP8, "op9_quality": OP9}
