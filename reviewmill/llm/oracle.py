"""The queries of the training-data operators that SQL can express, for DuckDB."""

from __future__ import annotations

from reviewmill.llm.quality_rules import STOP_WORDS

SQL: dict[str, str] = {}

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

SQL["op2_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
),
twice AS (SELECT doc_id, win FROM windows GROUP BY doc_id, win HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows JOIN twice USING (doc_id, win))
  GROUP BY doc_id
),
counts AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS stops, len(lines) AS n_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\t]*[-*•]'))) AS bullets,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\t\r]*$'))) AS cuts
  FROM w LEFT JOIN covered USING (doc_id)
),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS word_length,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_rate,
    CASE WHEN n_words > 0 THEN stops / n_words ELSE 0 END AS stop_rate,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS repeat_rate,
    CASE WHEN n_lines > 0 THEN bullets / n_lines ELSE 0 END AS bullet_rate,
    CASE WHEN n_lines > 0 THEN cuts / n_lines ELSE 0 END AS cut_rate
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_length BETWEEN 2 AND 16 AND symbol_rate <= 0.25 AND stop_rate >= 0.02
    AND repeat_rate <= 0.5 AND bullet_rate <= 0.9 AND cut_rate <= 0.3 AS kept
FROM judged
"""

SQL["op7_exact_dedup"] = r"""
WITH spaced AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, text_sha256
FROM spaced WINDOW same AS (PARTITION BY text_sha256)
"""

_RECORD = (
    "'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) "
    "|| 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) "
    "|| chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10)"
)

SQL["op8_merkle_fixity"] = f"""
WITH records AS (SELECT page_id, page_id // 4096 AS file, page_id % 4096 AS "at", {_RECORD} AS record FROM pages),
held AS (
  SELECT page_id, file, "at", sha256(record) AS hash, strlen(record)::BIGINT AS n_bytes,
    coalesce(sum(strlen(record)) OVER (PARTITION BY file ORDER BY "at" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM records
),
turned AS (SELECT *, page_id // 50 % 3 AS turn FROM pages WHERE page_id % 50 = 0),
other AS (
  SELECT page_id, sha256({_RECORD}) AS hash_other FROM (
    SELECT page_id, url, CASE turn WHEN 0 THEN '~' || substr(html, 2) ELSE substr(html, 1, length(html) - 1) END AS html FROM turned WHERE turn <> 2)
)
SELECT file, "at", held.page_id, CASE WHEN turn = 2 THEN 'missing' ELSE 'damaged' END AS status, "offset", n_bytes, hash, hash_other
FROM held JOIN turned USING (page_id) LEFT JOIN other USING (page_id)
"""

SQL["op11_url_rules"] = r"""
WITH rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
a AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
)
SELECT page_id, host, path,
  (SELECT arg_max(h || p, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
  coalesce((SELECT arg_max(v, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)), 'allow') AS verdict
FROM a
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL["op12_lexical_search"] = f"""
WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS length FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, big_n),
gains AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // length))) AS gain
  FROM tf JOIN weights USING (term) JOIN sizes USING (doc_id), total),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id, sum(gain)::BIGINT AS score FROM asked JOIN gains USING (term) GROUP BY item_id, doc_id HAVING score > 0)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored QUALIFY rank <= 10
"""

SQL["op13_collocations"] = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {_LOWER}) AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) s(size) WHERE len(words) >= size)
),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL HAVING f >= 30),
cuts AS (
  SELECT lang, size, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1)
),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.size, a, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score, k
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, f, array_to_string(string_split(phrase, ' ')[i:i + wide - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, size - wide + 2)) AS i FROM f, (VALUES (2), (3)) s(wide) WHERE wide < size)
),
longer AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY lang, phrase),
free AS (SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE longer.f IS NULL OR 100::HUGEINT * longer.f < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM free JOIN totals USING (lang) QUALIFY rank <= 2000
"""
