"""SQL of the operators that SQL can express, for DuckDB."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Exact windows by string equality, without hashes, winnowing or blocks.
DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS k, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i + 1:i + k], ' ') AS s FROM (SELECT item_id, k, w, unnest(range(len(w) - k + 1)) AS i FROM bw)),
dw AS (SELECT rid, k, i, array_to_string(w[i + 1:i + k], ' ') AS s FROM (SELECT rid, k, w, unnest(range(len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hit AS (SELECT dw.rid, dw.k, dw.i, win.item_id FROM dw JOIN win ON win.s = dw.s AND win.k = dw.k),
cov AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT rid, i, k FROM hit)) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item_id) AS n_items, list(DISTINCT CAST(item_id AS VARCHAR) ORDER BY CAST(item_id AS VARCHAR)) AS l FROM hit WHERE item_id IS NOT NULL GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(cov.n_hit, 0) AS n_hit, coalesce(its.n_items, 0) AS n_items, sha256(array_to_string(coalesce(its.l, []), ',')) AS items_sha256,
  coalesce(cov.n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN cov ON cov.rid = d.rid LEFT JOIN its ON its.rid = d.rid
"""

#: Every window of 400 bytes by its digest. Texts are hexadecimal, cut into blocks
#: of 400 window starts so that a long text is not walked through for each window.
REPEATS = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT rid, k, substring(h, k * 800 + 1, 1598) AS s FROM (SELECT rid, h, unnest(range((length(h) // 2 + 399) // 400)) AS k FROM d)),
w AS (SELECT rid, k * 400 + j AS p, md5(substring(s, 2 * j + 1, 800)) AS m FROM (SELECT rid, k, s, unnest(range(400)) AS j FROM c) WHERE 2 * j + 800 <= length(s)),
twice AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
hit AS (SELECT rid, p, lag(p) OVER (PARTITION BY rid ORDER BY p) AS prev FROM w JOIN twice USING (m)),
run AS (SELECT rid, p, sum(CASE WHEN p <= prev + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY p) AS g FROM hit),
gone AS (SELECT rid, g, min(p) AS a, max(p) + 400 AS b FROM run GROUP BY rid, g),
left_ AS (SELECT rid, g, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS f, a AS t FROM gone UNION ALL SELECT rid, max(g) + 1, max(b), NULL FROM gone GROUP BY rid),
kept AS (SELECT rid, string_agg(substring(h, 2 * f + 1, CASE WHEN t IS NULL THEN length(h) ELSE 2 * (t - f) END), '' ORDER BY g) AS k FROM left_ JOIN d USING (rid) GROUP BY rid),
sums AS (SELECT rid, sum(b - a) AS n, count(*) AS s FROM gone GROUP BY rid)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(s, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (rid) LEFT JOIN sums USING (rid)
"""

#: Lists of lines in place of checkpoints.
INFILL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS h FROM d),
c AS (SELECT doc_id, t, u, h, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, t, len(u) AS n, form, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form != 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form != 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""

_CRC_TABLE = "(SELECT list(list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, byte) ORDER BY byte) FROM range(256) r(byte))"

#: Counts of words by equality, each distinct word's CRC-32 from the table of its polynomial.
RESAMPLING = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
dw AS MATERIALIZED (SELECT rid, unnest(w) AS word FROM d), bw AS MATERIALIZED (SELECT unnest({_WORDS}) AS word FROM benchmark),
k AS MATERIALIZED (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
c AS MATERIALIZED (SELECT {_CRC_TABLE} AS tab),
b AS MATERIALIZED (SELECT word, xor(list_reduce(list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)), lambda v, y: xor(v >> 8, tab[(xor(v, y) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM k, c),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN b USING (word) GROUP BY bucket), t AS (SELECT bucket, count(*) AS n FROM bw JOIN b USING (word) GROUP BY bucket),
z AS (SELECT (SELECT count(*) FROM dw) AS sn, (SELECT count(*) FROM bw) AS tn),
g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * (sn + 10000) / ((s.n + 1.0::DOUBLE) * (tn + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), z),
m AS (SELECT rid, sum(gain) AS weight FROM dw JOIN b USING (word) JOIN g USING (bucket) GROUP BY rid),
e AS (SELECT rid, doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN m USING (rid)),
f AS (SELECT rid, doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM e),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) OVER () AS n FROM f WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM f LEFT JOIN r USING (rid)
"""

STATISTICS = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, i, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY rid),
l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
a AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words FROM d JOIN l USING (rid) LEFT JOIN c USING (rid))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a
"""

PHRASES = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, list_filter(range(1, len(w)), lambda i: w[i] = 'cc' AND w[i + 1] = 'by') AS a, list_filter(range(1, len(w) - 1), lambda i: w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS b,
  list_filter(range(1, len(w) - 1), lambda i: w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved') AS c FROM d)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(a) + len(b) + len(c) AS BIGINT) AS n_base, list_min(list_concat(a, b, c)) - 1 AS first_word, list_max(list_concat(a, b, c)) - 1 AS last_word,
  array_to_string(list_filter([CASE WHEN len(a) > 0 THEN 'cc-by' END, CASE WHEN len(b) > 0 THEN 'gpl' END, CASE WHEN len(c) > 0 THEN 'reserved' END], lambda x: x IS NOT NULL), ',') AS base_labels FROM p
"""

FIXED_RULES = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
f(h, p) AS (VALUES ('com', '/'), ('example.com', '/en/'), ('www.example.com', '/en/'), ('net', '/es/'), ('net', '/fr/'))
SELECT page_id, host, path, (SELECT arg_max(f.h || f.p, length(f.h || f.p)) FROM f WHERE (host = f.h OR ends_with(host, '.' || f.h)) AND starts_with(path, f.p)) AS rule FROM p
"""

#: Sources in the order in which they reach their bound; the first that does not tells the words a weight.
TARGETS = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1.0::DOUBLE AS w FROM d GROUP BY source),
o AS (SELECT *, 3 * source_size / w AS r, (SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
  sum(w) OVER (ORDER BY 3 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM s),
n AS (SELECT coalesce((SELECT words / rest FROM o WHERE words / rest <= r ORDER BY r, source LIMIT 1), 1e300) AS unit)
SELECT doc_id, size, source_size, round(least(3.0::DOUBLE * source_size, w * unit), 3) AS target FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source, n
"""
