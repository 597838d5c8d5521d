"""SQL that gives the rows of the queries, in DuckDB's dialect."""

from __future__ import annotations

#: Words cut at blanks, unchanged; and of lower-cased text cut at anything but letters, digits and non-ASCII.
_BLANK = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8 = rf"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, len(w) AS n FROM (SELECT item_id, {_ALNUM} AS w FROM benchmark) WHERE len(w) > 0),
lens AS (SELECT DISTINCT least(n, 13) AS k FROM b),
bw AS (SELECT DISTINCT item, least(n, 13) AS k, list_slice(w, s + 1, s + least(n, 13)) AS win
       FROM (SELECT item, w, n, unnest(range(n - least(n, 13) + 1)) AS s FROM b)),
dw AS (SELECT doc_id, s, k, list_slice(w, s + 1, s + k) AS win
       FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS s FROM d, lens WHERE len(w) >= k)),
hits AS (SELECT DISTINCT doc_id, s, dw.k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP2 = rf"""
WITH d AS (SELECT doc_id, {_BLANK} AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(list_slice(w, s + 1, s + 50), ' ') AS t FROM (SELECT doc_id, w, unnest(range(len(w) - 49)) AS s FROM d WHERE len(w) >= 50)),
firsts AS (SELECT t, min(doc_id) AS m FROM win GROUP BY t HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM win JOIN firsts USING (t) WHERE doc_id > m),
gone AS (SELECT doc_id, list(p) AS ps FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_transform(list_filter(range(len(w)), lambda i: NOT list_contains(ps, i)), lambda i: w[i + 1]) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

OP3 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, s + 1, s + least(len(w), 5)), ' ') AS t
       FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * i >= 80 * (na.n + nb.n - i)),
sym AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, b.y FROM reach r JOIN sym b ON r.y = b.x),
roots AS (SELECT x AS doc_id, min(y) AS root FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(root, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN roots USING (doc_id)
"""

#: CRC-32 of a text's bytes: the table by its rule, then a byte at a time.
_HEX = "hex(encode(coalesce(text, '')))"
_CRC = f"""list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(octet_length(encode(coalesce(text, '')))), lambda i: CAST(('0x' || substr({_HEX}, CAST(2 * i + 1 AS INTEGER), 2)) AS BIGINT))),
  lambda acc, b: xor(acc >> 8, t[CAST(xor(acc & 255, b) AS INTEGER) + 1]))"""
OP10 = rf"""
WITH RECURSIVE step AS (SELECT i, i AS c, 0 AS k FROM range(256) x(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
d AS (SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 8 AS size, xor({_CRC}, 4294967295) AS text_crc32 FROM documents, crc),
r AS (SELECT *, CAST('0x' || substr(sha256('mixture-1:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || text_crc32 || ':' || size), 1, 15) AS BIGINT) AS r FROM d),
f AS (SELECT *, CAST(2 * (row_number() OVER (PARTITION BY source ORDER BY r, doc_id NULLS FIRST, text_crc32, size) - 1) + 1 AS DOUBLE) / CAST(2 * count(*) OVER (PARTITION BY source) AS DOUBLE) AS f FROM r),
p AS (SELECT *, row_number() OVER (ORDER BY f, source NULLS FIRST, r, doc_id NULLS FIRST, text_crc32, size) - 1 AS position, count(*) OVER () AS n FROM f),
s AS (SELECT *, position * 24 // n AS shard FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard, CAST(position - (shard * n + 23) // 24 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""

#: Slots of the 4-grams, the log ratio in steps of 2**-26, and the verdict.
_BYTE = [f"CAST('0x' || substr(g, {2 * k + 1}, 2) AS BIGINT)" for k in range(4)]
_P_RAW = "((raw + 1::DOUBLE) / (n + 65536::DOUBLE))"
OP4 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_BLANK} AS w FROM documents),
n AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, s, list_slice(w, s + 1, s + 5) AS g FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS s FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(s, s + 5)) AS p FROM twice) GROUP BY doc_id),
gr AS (SELECT doc_id, substr(h, CAST(2 * k + 1 AS INTEGER), 8) AS g FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 3)) AS k FROM (SELECT doc_id, {_HEX} AS h FROM d) WHERE length(h) >= 8)),
pc AS (SELECT doc_id, g, count(*) AS c FROM gr GROUP BY ALL),
slots AS (SELECT g, (({_BYTE[0]} + 2533 * {_BYTE[1]} + 246515 * {_BYTE[2]} + 32773589 * {_BYTE[3]}) * 2654435761::HUGEINT % 4294967296)::BIGINT >> 16 AS slot FROM (SELECT DISTINCT g FROM pc)),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
cnt AS (SELECT slot, CAST(sum(c) AS DOUBLE) AS raw, CAST(coalesce(sum(c) FILTER (WHERE doc_id IN (SELECT doc_id FROM good)), 0) AS DOUBLE) AS target FROM pc JOIN slots USING (g) GROUP BY slot),
tot AS (SELECT sum(raw) AS n, sum(target) AS m FROM cnt),
ratio AS (SELECT slot, CASE WHEN m = 0 THEN 0 ELSE CAST(round((ln((target + 65536::DOUBLE * {_P_RAW}) / (m + 65536::DOUBLE)) - ln({_P_RAW})) * 67108864) AS BIGINT) END AS x FROM cnt, tot),
llr AS (SELECT doc_id, CAST(sum(c * x) AS DOUBLE) / sum(c) / 67108864 AS llr FROM pc JOIN slots USING (g) JOIN ratio USING (slot) GROUP BY doc_id),
a AS (SELECT n.doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(llr, 0) AS llr
  FROM n LEFT JOIN rep USING (doc_id) LEFT JOIN llr USING (doc_id))
SELECT * EXCLUDE (llr), n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND llr >= -0.4 AS kept FROM a
"""

#: For pages whose article is one `article` element of headings, paragraphs, bold text and line breaks, as the tables' are.
_ARTICLE = r"regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(p|br|h1)>', ' ', 'g'), '<[^>]*>', '', 'g')"
for _entity, _char in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#39;", "chr(39)"), ("&#x27;", "chr(39)"), ("&amp;", "'&'")):
    _ARTICLE = f"replace({_ARTICLE}, '{_entity}', {_char})"
OP9 = rf"SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM (SELECT page_id, url, trim(regexp_replace({_ARTICLE}, '[\x20\x09-\x0D]+', ' ', 'g')) AS text FROM pages)"

ORACLES: dict[str, str] = {"op2_substring_dedup": OP2, "op3_ngram_jaccard_join": OP3, "op4_quality_rules": OP4, "op8_benchmark_decontamination": OP8, "op9_html_extraction": OP9, "op10_sharding": OP10}
