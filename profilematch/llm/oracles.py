"""DuckDB SQL for the queries of this subpackage that SQL can express, written apart from the Spark code."""

from __future__ import annotations

ORACLES = {}

ORACLES["op7_chat_formatting"] = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), each AS (
  SELECT *,
    length(text) + length(regexp_replace(text, '[^][<~]', '', 'g')) AS escaped,
    CASE role WHEN 'system' THEN length('[SYS][/SYS]') WHEN 'user' THEN length('[INST][/INST]')
      WHEN 'assistant' THEN length('[OUT]</s>')
      ELSE length('[ROLE=][/ROLE]') + length(role) + length(regexp_replace(role, '[^][<~]', '', 'g')) END AS marks,
    CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END AS letter
  FROM turns
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS lines,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS under,
    3 + sum(escaped + marks) AS formatted_chars,
    string_agg(letter, '' ORDER BY turn NULLS FIRST, role, text) AS letters
  FROM each GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(under) AS loss_chars, sha256(under) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars, regexp_full_match(letters, 's?(ua)+') AS valid
FROM whole
"""

ORACLES["op8_quality_rules"] = r"""
WITH texts AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(generate_series(1, len(words) - 2)) AS i FROM split WHERE len(words) >= 3)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM windows) WHERE c > 1
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), counts AS (
  SELECT s.r, doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
  FROM split s LEFT JOIN repeated ON s.r = repeated.r
), metrics AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbols,
    CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats,
    CASE WHEN word_chars > 0 THEN 1000 * n_upper // word_chars ELSE 0 END AS upper,
    CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS length
  FROM counts
), long AS (
  UNPIVOT (SELECT r, lang, source, base_failed, symbols, dup_lines, repeats, upper, length, n_symbols, n_dup_lines,
    n_repeat_words, n_upper, word_chars FROM metrics)
  ON (symbols, n_symbols) AS 'symbols', (dup_lines, n_dup_lines) AS 'dup_lines', (repeats, n_repeat_words) AS 'repeats',
    (upper, n_upper) AS 'upper', (length, word_chars) AS 'length' INTO NAME metric VALUE v, units
), low AS (
  SELECT *, CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END AS low FROM long
), levels AS (
  SELECT 1 AS level, lang, source, metric, low FROM low WHERE NOT base_failed
  UNION ALL SELECT 2, lang, NULL, metric, low FROM low WHERE NOT base_failed
  UNION ALL SELECT 3, NULL, NULL, metric, low FROM low WHERE NOT base_failed
), run AS (
  SELECT level, lang, source, metric, low, sum(n) OVER (PARTITION BY level, lang, source, metric ORDER BY low) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, metric) AS total
  FROM (SELECT level, lang, source, metric, low, count(*) AS n FROM levels GROUP BY ALL)
), quantiles AS (
  SELECT level, lang, source, metric, max(total) AS total, min(low) FILTER (10 * upto >= total) AS q10,
    min(low) FILTER (10 * upto >= 5 * total) AS q50, min(low) FILTER (10 * upto >= 9 * total) AS q90
  FROM run GROUP BY ALL
), fences AS (
  SELECT o.lang, o.source, o.metric,
    CASE WHEN o.total >= 200 THEN o.q10 WHEN l.total >= 200 THEN l.q10 ELSE g.q10 END AS q10,
    CASE WHEN o.total >= 200 THEN o.q50 WHEN l.total >= 200 THEN l.q50 ELSE g.q50 END AS q50,
    CASE WHEN o.total >= 200 THEN o.q90 WHEN l.total >= 200 THEN l.q90 ELSE g.q90 END AS q90
  FROM quantiles o JOIN quantiles l ON l.level = 2 AND o.lang IS NOT DISTINCT FROM l.lang AND o.metric = l.metric
    JOIN quantiles g ON g.level = 3 AND o.metric = g.metric
  WHERE o.level = 1
), outside AS (
  SELECT DISTINCT r FROM low JOIN fences f ON low.lang IS NOT DISTINCT FROM f.lang
    AND low.source IS NOT DISTINCT FROM f.source AND low.metric = f.metric
  WHERE (low > q90 + 6 * (q90 - q50) AND units > 3) OR (low.metric = 'length' AND low < q10 - 6 * (q50 - q10))
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND o.r IS NULL AS kept
FROM metrics m LEFT JOIN outside o ON m.r = o.r
"""

ORACLES["op11_lexical_search"] = r"""
WITH terms AS (
  SELECT r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
), sizes AS (
  SELECT r, count(*) AS n FROM terms GROUP BY r
), corpus AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes
), postings AS (
  SELECT r, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term, docs
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, p.r, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings p USING (term) JOIN sizes USING (r), corpus
  GROUP BY item_id, p.r, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
"""

ORACLES["op13_warc"] = """
WITH bodies AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, coalesce(html, '') AS html FROM pages
), chosen AS (
  SELECT html, max(page_id) AS best FROM bodies WHERE size >= 1000 GROUP BY html
)
SELECT page_id, size AS payload_bytes, sha1(b.html) AS payload_digest,
  CASE WHEN best <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN best <> page_id THEN best END AS refers_to
FROM bodies b LEFT JOIN chosen c ON b.html = c.html
"""
