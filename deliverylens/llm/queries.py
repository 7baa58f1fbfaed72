"""The registered queries of this package and their DuckDB SQL.

``queries()`` maps a name to a function of (spark, sf_dir); ``oracle_sql()``
holds the SQL of those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deliverylens.llm import (
    chat_format,
    decontaminate,
    html_extract,
    importance,
    jaccard_join,
    line_dedup,
    lm_scoring,
    packing,
    quality_rules,
    repair,
    suffix_dedup,
    toxicity,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_url_filter": url_filter.query,
        "op2_suffix_dedup": suffix_dedup.query,
        "op3_lm_scoring": lm_scoring.query,
        "op4_decontaminate": decontaminate.query,
        "op5_jaccard_join": jaccard_join.query,
        "op6_packing": packing.query,
        "op7_line_dedup": line_dedup.query,
        "op8_toxicity": toxicity.query,
        "op9_html_extract": html_extract.query,
        "op10_quality_rules": quality_rules.query,
        "op11_importance": importance.query,
        "op12_chat_format": chat_format.query,
        "op13_conversation_repair": repair.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": URL_FILTER,
        "op7_line_dedup": LINE_DEDUP,
        "op10_quality_rules": QUALITY_RULES,
        "op11_importance": IMPORTANCE,
        "op12_chat_format": CHAT_FORMAT,
    }


#: Three levels, from the suffix down; k: the strength of a level's differences.
URL_FILTER = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), worst AS (
  SELECT doc_id AS page_id, max(1 - quality) AS bad FROM labels GROUP BY doc_id
), h AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
         string_split(host, '.') AS parts,
         CASE WHEN regexp_matches(host, '(^|[.])example[.](com|net|org)$') THEN 2 ELSE 1 END AS cut
  FROM u LEFT JOIN worst USING (page_id) GROUP BY host
), hosts AS (
  SELECT host, n, bad, array_to_string(parts[-cut:], '.') AS suffix,
         array_to_string(parts[-cut - 1:], '.') AS domain FROM h
), total AS (
  SELECT sum(bad) + coalesce(sum(bad) / nullif(sum(n), 0), 0.0) AS num, sum(n) + 1.0 AS size FROM hosts
), s0 AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(total.num) AS num, any_value(total.size) AS size
  FROM hosts, total GROUP BY suffix
), s1 AS (
  SELECT suffix, n, bad, size - n AS psize, (num - bad) / (size - n) AS mean FROM s0
), sk AS (
  SELECT CASE WHEN (off - chance) / nullif(w - chance, 0) > 0
           THEN least(greatest((1 - (off - chance) / (w - chance)) / ((off - chance) / (w - chance)), 1.0), 10000.0)
           ELSE 10000.0 END AS k FROM (
    SELECT sum(n * (bad / n - mean) ** 2) AS off, sum(mean * (1 - mean)) AS chance,
           sum(n * mean * (1 - mean)) AS w FROM s1 WHERE n > 0)
), s2 AS (
  SELECT suffix, n, bad + e * mean AS num, n + e AS size
  FROM (SELECT *, 1 / (1 / k + 1 / psize) AS e FROM s1, sk)
), d0 AS (
  SELECT suffix, domain, sum(h.n) AS n, sum(h.bad) AS bad, any_value(s2.num) AS num, any_value(s2.size) AS size
  FROM hosts h JOIN s2 USING (suffix) GROUP BY suffix, domain
), d1 AS (
  SELECT suffix, domain, n, bad, size - n AS psize, (num - bad) / (size - n) AS mean FROM d0
), dk AS (
  SELECT CASE WHEN (off - chance) / nullif(w - chance, 0) > 0
           THEN least(greatest((1 - (off - chance) / (w - chance)) / ((off - chance) / (w - chance)), 1.0), 10000.0)
           ELSE 10000.0 END AS k FROM (
    SELECT sum(n * (bad / n - mean) ** 2) AS off, sum(mean * (1 - mean)) AS chance,
           sum(n * mean * (1 - mean)) AS w FROM d1 WHERE n > 0)
), d2 AS (
  SELECT suffix, domain, n, bad + e * mean AS num, n + e AS size
  FROM (SELECT *, 1 / (1 / k + 1 / psize) AS e FROM d1, dk)
), h0 AS (
  SELECT host, h.n, h.bad, d2.num, d2.size FROM hosts h JOIN d2 USING (suffix, domain)
), h1 AS (
  SELECT host, n, bad, size - n AS psize, (num - bad) / (size - n) AS mean FROM h0
), hk AS (
  SELECT CASE WHEN (off - chance) / nullif(w - chance, 0) > 0
           THEN least(greatest((1 - (off - chance) / (w - chance)) / ((off - chance) / (w - chance)), 1.0), 10000.0)
           ELSE 10000.0 END AS k FROM (
    SELECT sum(n * (bad / n - mean) ** 2) AS off, sum(mean * (1 - mean)) AS chance,
           sum(n * mean * (1 - mean)) AS w FROM h1 WHERE n > 0)
), h2 AS (
  SELECT host, n, bad + e * mean AS num, n + e AS size
  FROM (SELECT *, 1 / (1 / k + 1 / psize) AS e FROM h1, hk)
), fitted AS (
  SELECT u.*, r.rule, r.verdict,
         row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.rule) DESC, r.rule) AS place
  FROM u LEFT JOIN (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
                           ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow'))
       AS r(name, start, rule, verdict)
    ON (u.host = r.name OR ends_with(u.host, '.' || r.name)) AND starts_with(u.path, r.start)
), share AS (
  SELECT host, n, size, num / size AS mean FROM h2
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN mean - 2 * sqrt(mean * (1 - mean) / (size + 1)) > 0.5
                              THEN 'block' ELSE 'allow' END) AS verdict,
       n AS n_labelled
FROM fitted JOIN share USING (host) WHERE place = 1
"""

#: Exact distinct sites instead of sketches: those of all texts with the line, but
#: texts on several sites count for one each.
LINE_DEDUP = r"""
WITH raw AS (
  SELECT doc_id, coalesce(source, '') AS site, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
), bare AS (
  SELECT doc_id, site, text, pos, line, trim(line, ' ' || chr(9) || chr(13)) AS k FROM raw
), texts AS (
  SELECT k, text, CASE WHEN min(site) = max(site) THEN min(site) END AS own FROM bare WHERE k <> '' GROUP BY k, text
), bad AS (
  SELECT k FROM (SELECT k, count(DISTINCT own) + count_if(own IS NULL) AS alone FROM texts GROUP BY k)
  JOIN (SELECT k, count(DISTINCT site) AS every FROM bare GROUP BY k) USING (k)
  WHERE least(every, alone) >= 10
), cleaned AS (
  SELECT doc_id, count(*) FILTER (WHERE k <> '') AS n_lines,
         count(*) FILTER (WHERE k IN (SELECT k FROM bad)) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE k NOT IN (SELECT k FROM bad)), '') AS text
  FROM bare GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, c.text
FROM documents d LEFT JOIN cleaned c USING (doc_id)
"""


#: n_repeat_words: a window is the text of eight words joined by one blank.
QUALITY_RULES = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), windows AS (
  SELECT doc_id, pos, array_to_string(ws[pos:pos + 7], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS pos FROM w WHERE len(ws) >= 8)
), again AS (
  SELECT doc_id, win FROM windows GROUP BY doc_id, win HAVING count(*) >= 2
), covered AS (
  SELECT doc_id, count(DISTINCT word) AS n FROM (
    SELECT doc_id, unnest(range(pos, pos + 8)) AS word
    FROM windows SEMI JOIN again USING (doc_id, win))
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, sum(copies - 1) AS again, sum(copies) AS n FROM (
    SELECT doc_id, line, count(*) AS copies
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    GROUP BY doc_id, line)
  GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(ws) AS n_words,
         len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         CAST(coalesce(lines.again, 0) AS BIGINT) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_lines
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), b AS (
  SELECT *, CAST((n_words < 20) AS BIGINT) AS r0,
         CAST((100 * n_repeat_words > 30 * n_words) AS BIGINT) AS r1,
         CAST((100 * n_symbols > 20 * n_words) AS BIGINT) AS r2,
         CAST((100 * n_dup_lines > 50 * n_lines) AS BIGINT) AS r3,
         CAST((word_chars < 2 * n_words OR word_chars > 20 * n_words) AS BIGINT) AS r4
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       r0 + r1 > 0 AS base_failed, r0 + r1 + r2 + r3 + r4 = 0 AS kept,
       r0 + 2 * r1 + 4 * r2 + 8 * r3 + 16 * r4 AS failed
FROM b
"""


#: crc: the CRC32 of each distinct word, byte by byte over its table of 256 entries.
IMPORTANCE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), dw AS (
  SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS word FROM w) GROUP BY doc_id, word
), words AS (
  SELECT word, sum(s) AS s, sum(t) AS t FROM (
    SELECT word, sum(n) AS s, 0 AS t FROM dw GROUP BY word
    UNION ALL SELECT unnest(ws), 0, 1 FROM b)
  GROUP BY word
), steps AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM range(256) AS r(i)
), coded AS (
  SELECT word, s, t, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(hex(word)), 2),
           lambda i: ('0x' || substr(hex(word), i, 2))::BIGINT)),
           lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket
  FROM words, steps
), total AS (
  SELECT sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM words
), gain AS (
  SELECT bucket, floor(1000 * ln((sum(c.t) + 1.0::DOUBLE) * (any_value(total.s) + 10000)
           / ((sum(c.s) + 1.0::DOUBLE) * (any_value(total.t) + 10000))))::BIGINT AS gain
  FROM coded c, total GROUP BY bucket
), weight AS (
  SELECT doc_id, sum(n * gain) AS weight FROM dw JOIN coded USING (word) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(ws) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN weight USING (doc_id)
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""


#: A control string in a text, escaped already or not, takes one character more.
CHAT_FORMAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, md5(role || ':' || text) AS tie,
         len(text) + len(regexp_extract_all(text, '<\\*(/s>|\|endoftext\|>)|\[\\*(/?INST\]|/?ROLE\])')) AS text_chars,
         len(role) + len(regexp_extract_all(role, '<\\*(/s>|\|endoftext\|>)|\[\\*(/?INST\]|/?ROLE\])')) AS role_chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, tie)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, tie) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(text_chars + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 ELSE 17 + role_chars END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
