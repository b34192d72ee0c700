"""SQL that checks the queries which SQL can express.

No SQL for personal data (keyed digests of characters), chats, packing and token counts (token ids),
SimHash (XXH64) and the pipeline: tests hold these against brute force. Nor for sharding, language-model
scores and periodic runs, whose checksum (CRC-32) SQL lacks.
"""

from __future__ import annotations

from backframe.llm.quality import BOILERPLATE, LineRules

RULES = LineRules()
GAP = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '{WORD}') AS words FROM d),
windows AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice CROSS JOIN (SELECT unnest(range(8)) AS k) GROUP BY r),
line AS (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d),
judged AS (SELECT r, l, regexp_matches(l, '[^\x20\x09-\x0D]') AS has_word,
    len(regexp_extract_all(l, '{WORD}')) AS n,
    len(list_filter(regexp_extract_all(l, '{WORD}'), lambda x: regexp_matches(x, '^[|»›·•→>]+$'))) AS menu,
    len(list_filter(regexp_extract_all(l, '{WORD}'), lambda x: regexp_matches(x, '([#*$%&~^_=+]{{2,}}|!!|\?\?)$'))) AS odd
  FROM line),
told AS (SELECT r, l, has_word,
    regexp_matches(l, '[|»›·•→>]') AND menu >= {RULES.menu_share} * n
    OR regexp_matches(l, '[#*$%&~^_=+!?]{{2}}') AND odd >= {RULES.odd_share} * n
    OR NOT regexp_matches(l, '[.!?:;…。！？]["''”’»)\]]*\s*$') AND n < {RULES.open_line_words}
    OR length(l) < {RULES.boilerplate_chars} AND regexp_matches(lower(l), '{"|".join(BOILERPLATE)}') AS broken
  FROM judged),
lines AS (SELECT r, count(*) FILTER (has_word) AS n_lines,
    count(*) FILTER (has_word) - count(DISTINCT l) FILTER (has_word) AS n_dup_lines,
    count(*) FILTER (has_word AND broken) AS n_failed_lines,
    coalesce(sum(length(regexp_replace(l, '{GAP}+', '', 'g'))) FILTER (has_word AND NOT broken), 0)::BIGINT AS kept_chars
  FROM told GROUP BY r),
base AS (SELECT r, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND kept_chars >= {1 - RULES.most_lost} * word_chars AS kept, n_lines, n_failed_lines, kept_chars
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base JOIN lines USING (r))
"""

DECONTAMINATION = r"""
WITH fold AS (SELECT * FROM (SELECT row_number() OVER () AS r, doc_id AS id, true AS doc,
      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
    UNION ALL SELECT 0, item_id, false,
      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark)),
pattern AS (SELECT DISTINCT id AS item, least(len(words), 13) AS size, array_to_string(words[i:i + 12], ' ') AS w
  FROM (SELECT id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM fold
        WHERE NOT doc AND len(words) > 0)),
place AS (SELECT r, i, size, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT r, size, words, unnest(range(1, len(words) - size + 2)) AS i
        FROM (SELECT r, words FROM fold WHERE doc) CROSS JOIN (SELECT DISTINCT size FROM pattern)
        WHERE len(words) >= size)),
found AS (SELECT r, i, size, item FROM place JOIN pattern USING (size, w)),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS place FROM found) GROUP BY r),
own AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item::VARCHAR AS item FROM found) GROUP BY r)
SELECT id AS doc_id, coalesce(len(words), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(words), 0) AS contaminated
FROM fold LEFT JOIN hit USING (r) LEFT JOIN own USING (r) WHERE doc
"""

SUFFIXES = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
  FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
first AS (SELECT w, min(doc_id) AS least FROM w GROUP BY w HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, i FROM w JOIN first USING (w) WHERE least < doc_id),
gap AS (SELECT doc_id, i, i > 50 + lag(i, 1, -99) OVER (PARTITION BY doc_id ORDER BY i) AS fresh FROM gone),
run AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b
  FROM (SELECT doc_id, i, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM gap) GROUP BY doc_id, g),
told AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS starts,
    list(b ORDER BY a) AS ends FROM run GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN starts IS NULL THEN h ELSE array_to_string(list_transform(range(1, len(starts) + 2),
    lambda k: substr(h, 2 * (CASE WHEN k = 1 THEN 0 ELSE ends[k - 1] END) + 1,
                2 * (CASE WHEN k > len(starts) THEN length(h) // 2 ELSE starts[k] END
                     - CASE WHEN k = 1 THEN 0 ELSE ends[k - 1] END))), '') END)) AS kept_sha256
FROM d LEFT JOIN told USING (doc_id)
"""

SUBSTRINGS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
w AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20)),
gone AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
removed AS (SELECT doc_id, list(DISTINCT i + k) AS places FROM gone CROSS JOIN (SELECT unnest(range(20)) AS k)
  GROUP BY doc_id),
marked AS (SELECT doc_id, pos, words[pos] AS word,
    places IS NOT NULL AND list_contains(places, pos) AS away
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM d) LEFT JOIN removed USING (doc_id)),
kept AS (SELECT doc_id, count(*) FILTER (away) AS n_removed,
    string_agg(word, ' ' ORDER BY pos) FILTER (NOT away) AS text FROM marked GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

PHRASES = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
piece AS (SELECT row_number() OVER () AS r, lang, regexp_extract_all(p, '[^\x20\x09]+') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d WHERE t IS NOT NULL)),
total AS (SELECT lang, sum(len(words))::BIGINT AS n FROM piece GROUP BY lang),
place AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM piece),
f AS (SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS w, count(*) AS f
  FROM place CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS size) WHERE i + size - 1 <= len(words)
  GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, size, w AS phrase, f AS a, string_split(w, ' ') AS ws FROM f WHERE size > 1),
cut AS (SELECT lang, phrase, size, a, ws, unnest(range(1, size)) AS k FROM c),
scored AS (SELECT cut.lang, phrase, cut.size, a, k, x.f AS l, y.f AS r,
    (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.w = array_to_string(ws[:k], ' ')
  JOIN f y ON y.lang = cut.lang AND y.w = array_to_string(ws[k + 1:], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
part AS (SELECT lang, a, array_to_string(ws[i:i + n - 1], ' ') AS phrase
  FROM c CROSS JOIN (SELECT unnest([1, 2, 3]) AS i) CROSS JOIN (SELECT unnest([2, 3]) AS n)
  WHERE n < size AND i + n - 1 <= size),
around AS (SELECT lang, phrase, max(a) AS most FROM part GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
  phrase, a, l, r, total.n, score
FROM weakest LEFT JOIN around USING (lang, phrase) JOIN total USING (lang)
WHERE most IS NULL OR 100 * most < 80 * a
QUALIFY rank <= 2000
"""

CHECK_SQL: dict[str, str] = {
    "op1_quality_rules": QUALITY,
    "op2_decontamination": DECONTAMINATION,
    "op6_suffix_array_dedup": SUFFIXES,
    "op10_substring_dedup": SUBSTRINGS,
    "op13_phrase_collocations": PHRASES,
}
