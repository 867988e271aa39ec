"""Independent SQL of the registered queries, for DuckDB."""

from __future__ import annotations

from threadloom.plans import archive_queries
from threadloom.plans.carriers import IDENTITY, SOURCE, THREAD, duck

_SRC = f"src AS ({duck(SOURCE)})"
_THR = f"thr AS ({duck(THREAD)})"
_IDS = f"log AS ({duck(IDENTITY)})"
_BEST = """best AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tweet_type <> 'like' DESC, created_at IS NOT NULL DESC,
  length(coalesce(full_text, '')) DESC, archive_file ASC NULLS LAST, tweet_type ASC NULLS LAST, user_id ASC NULLS LAST, full_text ASC NULLS LAST, created_at ASC NULLS LAST) AS rn FROM src) WHERE rn = 1)"""
_LIK = "lik AS (SELECT id, list(DISTINCT user_id ORDER BY user_id) AS lb, count(DISTINCT user_id) AS like_count FROM src WHERE tweet_type = 'like' AND user_id IS NOT NULL GROUP BY id)"
_AUT = """aut AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, author_id ASC NULLS LAST, author_screen_name ASC NULLS LAST) AS rn FROM (
  SELECT l.id, r.in_reply_to_user_id AS author_id, r.in_reply_to_screen_name AS author_screen_name, count(*) AS n FROM best l JOIN best r ON l.id = r.in_reply_to_status_id
  WHERE l.tweet_type = 'like' AND l.id <> '' AND r.in_reply_to_screen_name IS NOT NULL GROUP BY ALL)) WHERE rn = 1)"""
_CON = """con AS (SELECT b.id, CASE WHEN tweet_type = 'like' THEN author_id ELSE user_id END AS user_id, CASE WHEN tweet_type = 'like' THEN author_screen_name ELSE user_screen_name END AS user_screen_name,
  user_name, tweet_type, full_text, created_at, in_reply_to_status_id, coalesce(lb, []) AS lb, coalesce(like_count, 0) AS like_count,
  coalesce(created_at, make_timestamp(((try_cast(b.id AS BIGINT) >> 22) + 1288834974657) * 1000)) AS inferred FROM best b LEFT JOIN aut ON aut.id = b.id LEFT JOIN lik ON lik.id = b.id)"""
_ALL = f"WITH {_SRC}, {_BEST}, {_LIK}, {_AUT}, {_CON}"
_TS = "strftime({}, '%Y-%m-%d %H:%M:%S.%g')"
_CLO = """up AS (SELECT t.id, p.id AS pid FROM thr t LEFT JOIN thr p ON p.id = t.parent_id),
 clo AS (SELECT id AS root_id, id, CAST(0 AS BIGINT) AS depth FROM up WHERE pid IS NULL UNION ALL SELECT c.root_id, u.id, c.depth + 1 FROM clo c JOIN up u ON u.pid = c.id),
 mem AS (SELECT * FROM clo WHERE root_id IN (SELECT root_id FROM clo WHERE depth > 0))"""
_REC = f"WITH RECURSIVE {_THR}, {_CLO}"
_DIR = """dir AS (SELECT r.id AS root_id, any_value(r.text) AS root_text, any_value(r.created_at) AS root_at, count(*) + 1 AS length,
  list({'at': c.created_at, 'id': c.id, 'text': c.text} ORDER BY c.created_at, c.id) AS replies FROM thr r JOIN thr c ON c.parent_id = r.id WHERE r.parent_id IS NULL GROUP BY r.id)"""
_SIMPLE = "sim AS (SELECT * FROM thr)"
_TURNS = "list_concat([{'at': root_at, 'id': root_id, 'text': root_text}], replies)"
_URL = r"'^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$'"


def _part(u: str, i: int) -> str:
    return f"regexp_extract({u}, {_URL}, {i})"


def _site(d: str) -> str:
    x = f"regexp_replace(lower({d}), '^www\\.', '')"
    return f"""CASE WHEN {x} IN ('twitter.com', 'x.com') OR {x} LIKE '%.twitter.com' OR {x} LIKE '%.x.com' THEN 'twitter.com'
  WHEN {x} IN ('youtube.com', 'youtu.be', 'm.youtube.com') THEN 'youtube.com' WHEN {x} = 'wikipedia.org' OR {x} LIKE '%.wikipedia.org' THEN 'wikipedia.org'
  WHEN {x} IN ('github.com', 'raw.githubusercontent.com', 'gist.github.com') THEN 'github.com' WHEN {x} LIKE '%.medium.com' THEN 'medium.com' WHEN {x} LIKE '%.substack.com' THEN 'substack.com' ELSE {x} END"""


def _group(d: str) -> str:
    return f"""CASE WHEN {d} IN ('twitter.com', 'x.com') THEN 'twitter.com' WHEN {d} IN ('youtube.com', 'youtu.be') THEN 'youtube.com'
  WHEN {d} IN ('wikipedia.org', 'en.wikipedia.org', 'fr.wikipedia.org', 'de.wikipedia.org') THEN 'wikipedia.org' WHEN {d} IN ('github.com', 'raw.githubusercontent.com', 'gist.github.com') THEN 'github.com'
  WHEN {d} LIKE '%.substack.com' THEN 'substack.com' WHEN {d} LIKE '%.medium.com' THEN 'medium.com'
  WHEN {d} IN ('t.co', 'bit.ly', 'buff.ly', 'tinyurl.com', 'ow.ly', 'goo.gl', 'tiny.cc', 'is.gd') THEN 'deprecated_links' ELSE {d} END"""


_CASES = """cases AS (SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN 'https://www.youtube.com/watch?v=v_' || doc_id WHEN 1 THEN 'https://youtu.be/s-' || doc_id WHEN 2 THEN 'https://youtube.com/shorts/q' || doc_id
  WHEN 3 THEN 'https://x.com/ann/status/' || doc_id || '?a=1' WHEN 4 THEN 'https://twitter.com/bob/statuses/' || doc_id WHEN 5 THEN 'https://github.com/own' || doc_id || '/repo'
  WHEN 6 THEN 'https://instagram.com/reel/r' || doc_id || '/' WHEN 7 THEN 'https://t.co/' || doc_id ELSE 'https://m.twitter.com/cid/status/' || doc_id END AS url FROM documents)"""
_CLEAN = r"array_to_string(list_filter(list_filter(regexp_split_to_array({}, '[\s\x0b\x85\xa0]+'), lambda w: w <> ''), lambda w: NOT (starts_with(w, '@') OR starts_with(w, 'http') OR starts_with(w, '#'))), ' ')"
_PCT = "round(CAST({} AS DOUBLE) * 100.0 / CAST({} AS DOUBLE), {})"
_SYS = "You are a helpful assistant."


def _msgs(turns: str) -> str:
    """JSON of messages without a JSON writer: texts hold nothing to escape but line ends."""
    return f"""'{{"messages":[{{"role":"system","content":"{_SYS}"}},' || array_to_string({turns}, ',') || ']}}'"""


def _turn(role: str, text: str) -> str:
    return f"""'{{"role":"' || {role} || '","content":' || CAST(to_json({text}) AS VARCHAR) || '}}'"""


_ALT = "CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END"
_SEC = "%Y-%m-%d %H:%M:%S"

ORACLE: dict[str, str] = {
    "consolidated_posts": f"{_ALL} SELECT id, user_id, user_screen_name, user_name, tweet_type, full_text, {_TS.format('created_at')} AS created_at, in_reply_to_status_id, array_to_string(lb, ',') AS likers, like_count, {_TS.format('inferred')} AS inferred_at FROM con",
    "likers": f"WITH {_SRC}, {_LIK} SELECT id, array_to_string(lb, ',') AS likers, like_count FROM lik",
    "best_versions": f"WITH {_SRC}, {_BEST} SELECT id, tweet_type, full_text, archive_file, user_id FROM best",
    "author_inference": f"WITH {_SRC}, {_BEST}, {_AUT} SELECT id, author_id, author_screen_name, n AS occurrences FROM aut",
    "canonical_posts": f"""WITH {_SRC}, ided AS (SELECT *, CAST(id AS BIGINT) AS num, try_cast(in_reply_to_status_id AS BIGINT) AS par FROM src WHERE regexp_full_match(id, '[0-9]{{1,19}}') AND try_cast(id AS BIGINT) IS NOT NULL),
 b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY num ORDER BY tweet_type = 'like', length(coalesce(full_text, '')) DESC, archive_file ASC NULLS LAST, tweet_type, user_id ASC NULLS LAST, full_text ASC NULLS LAST, created_at ASC NULLS LAST) AS rn FROM ided) WHERE rn = 1),
 r AS (SELECT par, list(DISTINCT num ORDER BY num) AS rep, min(in_reply_to_screen_name) AS named FROM ided WHERE par IS NOT NULL GROUP BY par),
 l AS (SELECT num, list(DISTINCT user_screen_name ORDER BY user_screen_name) AS lk FROM ided WHERE tweet_type = 'like' AND user_screen_name IS NOT NULL GROUP BY num)
 SELECT b.num AS id, coalesce(full_text, '') AS text, {_TS.format("coalesce(created_at, make_timestamp(((b.num >> 22) + 1288834974657) * 1000))")} AS created_at,
 coalesce(CASE WHEN tweet_type <> 'like' THEN nullif(user_screen_name, '') END, named) AS author_username, b.par AS in_reply_to_status_id, array_to_string(coalesce(lk, []), ',') AS likers, array_to_string(coalesce(rep, []), ',') AS replies
 FROM b LEFT JOIN r ON r.par = b.num LEFT JOIN l ON l.num = b.num""",
    "user_export": f"WITH {_SRC} SELECT DISTINCT coalesce(user_id, '') AS user_id, coalesce(user_screen_name, '') AS user_screen_name, coalesce(user_name, '') AS user_name, tweet_count FROM (SELECT user_id, user_screen_name, user_name, count(*) AS tweet_count FROM src GROUP BY ALL)",
    "top_users": f"WITH {_SRC} SELECT user_id, user_screen_name, count(*) AS tweet_count FROM src GROUP BY user_id, user_screen_name, user_name ORDER BY tweet_count DESC, user_id LIMIT 10",
    "row_counts": f"WITH {_SRC} SELECT count(*) AS n_rows, count(DISTINCT id) AS ids, count(DISTINCT user_id) AS user_ids FROM src",
    "type_shares": f"WITH {_SRC} SELECT tweet_type, count(*) AS n, {_PCT.format('count(*)', 'sum(count(*)) OVER ()', 2)} AS pct FROM src GROUP BY tweet_type",
    "attribution_gaps": f"WITH {_SRC} SELECT tweet_type, count(*) AS total, count(*) FILTER (coalesce(user_id, '') = '') AS no_author, {_PCT.format(chr(99) + 'ount(*) FILTER (coalesce(user_id, ' + chr(39) * 2 + ') = ' + chr(39) * 2 + ')', 'count(*)', 2)} AS no_author_pct, count(*) FILTER (created_at IS NULL) AS no_time, {_PCT.format('count(*) FILTER (created_at IS NULL)', 'count(*)', 2)} AS no_time_pct FROM src GROUP BY tweet_type",
    "null_checks": f"WITH {_SRC} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM src" for c in ("id", "user_id", "user_screen_name", "full_text", "created_at", "in_reply_to_status_id")),
    "archive_distribution": f"WITH {_SRC} SELECT archive_file, count(*) AS n, {_PCT.format('count(*)', 'sum(count(*)) OVER ()', 2)} AS pct FROM src GROUP BY archive_file",
    "duplicate_ids": f"WITH {_SRC}, p AS (SELECT id, count(*) AS n FROM src GROUP BY id) SELECT CAST(sum(n) AS BIGINT) AS total, count(id) AS ids, count(*) FILTER (n > 1) AS duplicate_ids, CAST(coalesce(sum(n - 1) FILTER (n > 1), 0) AS BIGINT) AS excess, {_PCT.format('coalesce(sum(n - 1) FILTER (n > 1), 0)', 'sum(n)', 2)} AS reduction_pct FROM p",
    "duplicate_type_pairs": f"""WITH {_SRC}, r AS (SELECT id, tweet_type, row_number() OVER (PARTITION BY id ORDER BY CASE tweet_type WHEN 'tweet' THEN 1 WHEN 'note_tweet' THEN 2 WHEN 'community_tweet' THEN 3 WHEN 'like' THEN 4 ELSE 5 END, tweet_type, archive_file, full_text) AS rn FROM src)
 SELECT a.tweet_type AS first_type, b.tweet_type AS second_type, count(*) AS n, {_PCT.format('count(*)', 'sum(count(*)) OVER ()', 3)} AS pct FROM r a JOIN r b ON a.id = b.id AND a.rn = 1 AND b.rn = 2 GROUP BY 1, 2""",
    "liked_and_full": f"WITH {_SRC}, p AS (SELECT id, count(*) FILTER (tweet_type = 'like') AS l, count(*) FILTER (tweet_type <> 'like') AS f FROM src GROUP BY id) SELECT count(*) FILTER (l > 0 AND f > 0) AS both, count(*) FILTER (f = 0) AS like_only, count(*) FILTER (l = 0) AS full_only FROM p",
    "like_distribution": f"{_ALL} SELECT count(*) AS total, CAST(coalesce(sum(like_count), 0) AS BIGINT) AS likes, count(*) FILTER (like_count > 0) AS liked, min(like_count) AS min_likes, max(like_count) AS max_likes, round(avg(like_count), 6) AS avg_all, round(avg(CASE WHEN like_count > 0 THEN like_count END), 6) AS avg_liked, CAST(median(like_count) AS DOUBLE) AS median_all, CAST(median(CASE WHEN like_count > 0 THEN like_count END) AS DOUBLE) AS median_liked FROM con",
    "timestamp_stats": f"{_ALL} SELECT count(*) AS total, count(created_at) AS original, count(*) FILTER (created_at IS NULL AND inferred IS NOT NULL) AS inferred, count(*) FILTER (inferred IS NULL) AS without, round((epoch_us(max(created_at)) - epoch_us(min(created_at))) / 86400000000.0, 3) AS days FROM con",
    "author_stats": f"{_ALL} SELECT count(*) FILTER (tweet_type = 'like') AS likes, count(*) FILTER (tweet_type = 'like' AND coalesce(user_id, '') <> '') AS with_user_id, count(*) FILTER (tweet_type = 'like' AND coalesce(user_screen_name, '') <> '') AS with_screen_name, round(CAST(count(*) FILTER (tweet_type = 'like' AND coalesce(user_id, '') <> '') AS DOUBLE) * 100.0 / nullif(count(*) FILTER (tweet_type = 'like'), 0), 2) AS inferred_pct FROM con",
    "top_liked": f"{_ALL} SELECT id, like_count, array_to_string(lb[1:5], ', ') AS first_likers, CASE WHEN full_text IS NULL THEN '[NULL]' ELSE left(full_text, 50) || '...' END AS preview FROM con ORDER BY like_count DESC, id LIMIT 5",
    "id_preservation": f"WITH {_SRC}, {_BEST} SELECT count(DISTINCT s.id) AS missing FROM src s LEFT JOIN best b ON s.id = b.id WHERE b.id IS NULL",
    "reply_stats": f"WITH {_SRC} SELECT count(*) AS total, count(*) FILTER (in_reply_to_status_id IS NOT NULL) AS replies, count(DISTINCT in_reply_to_status_id) AS targets FROM src",
    "distinct_types": f"WITH {_SRC} SELECT string_agg(DISTINCT tweet_type, ', ' ORDER BY tweet_type) AS \"values\" FROM src",
    "text_profile": "SELECT source, count(*) AS n, CAST(min(length(text)) AS INTEGER) AS shortest, CAST(max(length(text)) AS INTEGER) AS longest, round(avg(length(text)), 4) AS mean_length, count(*) FILTER (contains(text, '@')) AS with_at FROM documents GROUP BY source",
    "monthly_activity": f"WITH {_SRC} SELECT strftime(date_trunc('month', created_at), '%Y-%m') AS month, tweet_type, count(*) AS n FROM src WHERE created_at IS NOT NULL GROUP BY 1, 2",
    "hot_threads": f"WITH {_THR} SELECT parent_id AS thread_id, count(*) AS reply_count FROM thr WHERE parent_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 2 ORDER BY reply_count DESC, thread_id LIMIT 10",
    "direct_thread_sizes": f"WITH {_THR}, s AS (SELECT t.id, count(c.id) AS replies FROM thr t LEFT JOIN thr p ON p.id = t.parent_id JOIN thr c ON c.parent_id = t.id WHERE p.id IS NULL GROUP BY t.id) SELECT count(*) AS threads, min(replies) AS least, max(replies) AS most, round(avg(replies), 6) AS mean, CAST(median(replies) AS DOUBLE) AS median_replies, count(*) FILTER (replies >= 10) AS ten_or_more, count(*) FILTER (replies >= 50) AS fifty_or_more FROM s",
    "conversation_threads": f"WITH {_THR}, {_DIR} SELECT root_id, length, array_to_string(list_transform(replies, lambda r: r.id), ',') AS reply_ids FROM dir",
    "thread_closure": f"{_REC} SELECT root_id, id, depth FROM mem",
    "thread_closure_batches": f"{_REC} SELECT root_id, id, depth FROM mem",
    "thread_stats": f"{_REC} SELECT m.root_id, count(*) - 1 AS reply_count, max(depth) AS max_depth, count(DISTINCT author) AS participants, {_TS.format('min(created_at)')} AS first_at, {_TS.format('max(created_at)')} AS last_at FROM mem m JOIN thr t ON t.id = m.id GROUP BY m.root_id HAVING count(*) > 3",
    "thread_paths": f"WITH RECURSIVE {_THR}, up AS (SELECT t.id, p.id AS pid FROM thr t LEFT JOIN thr p ON p.id = t.parent_id), clo AS (SELECT id AS root_id, id, 0 AS depth, CAST(id AS VARCHAR) AS path FROM up WHERE pid IS NULL AND id IN (SELECT pid FROM up WHERE pid IS NOT NULL) UNION ALL SELECT c.root_id, u.id, c.depth + 1, c.path || '/' || u.id FROM clo c JOIN up u ON u.pid = c.id WHERE c.depth < 3) SELECT root_id, id, depth, path FROM clo",
    "quoted_posts": f"WITH {_THR}, q AS (SELECT id, regexp_extract(quote_url, '/status/([0-9]+)', 1) AS q FROM thr WHERE quote_url IS NOT NULL) SELECT id, CAST(q AS BIGINT) AS quoted_id FROM q WHERE q <> '' AND q <> CAST(id AS VARCHAR)",
    "thread_trees": f"""{_REC}, q AS (SELECT id, CAST(regexp_extract(quote_url, '/status/([0-9]+)', 1) AS BIGINT) AS quoted FROM thr WHERE quote_url IS NOT NULL),
 d AS (SELECT root_id, list(DISTINCT id ORDER BY id) AS l FROM mem WHERE id <> root_id GROUP BY 1), o AS (SELECT root_id, list(DISTINCT quoted ORDER BY quoted) AS l FROM mem JOIN q ON q.id = mem.id WHERE quoted <> q.id GROUP BY 1),
 i AS (SELECT root_id, list(DISTINCT q.id ORDER BY q.id) AS l FROM mem JOIN q ON q.quoted = mem.id WHERE quoted <> q.id GROUP BY 1)
 SELECT d.root_id, array_to_string(d.l, ',') AS descendant_ids, array_to_string(coalesce(o.l, []), ',') AS quoted_ids, array_to_string(coalesce(i.l, []), ',') AS quoting_ids FROM d LEFT JOIN o ON o.root_id = d.root_id LEFT JOIN i ON i.root_id = d.root_id""",
    "interaction_pairs": f"WITH {_THR} SELECT count(*) AS replies, count(*) FILTER (c.author <> p.author) AS cross_user_replies, count(DISTINCT CASE WHEN p.author IS NOT NULL THEN c.author || '->' || p.author END) AS pairs FROM thr c LEFT JOIN thr p ON p.id = c.parent_id WHERE c.parent_id IS NOT NULL",
    "url_parts": f"SELECT page_id, lower({_part('url', 1)}) AS protocol, {_part('url', 2)} AS raw_domain, regexp_replace({_part('url', 3)}, ';[^/]*$', '') AS path, {_part('url', 4)} AS query, {_part('url', 5)} AS fragment FROM pages",
    "domain_names": f"""WITH d AS (SELECT DISTINCT d FROM (SELECT {_part('url', 2)} AS d FROM pages UNION ALL SELECT unnest([{{cases}}]))), e AS (SELECT d, replace(lower(d), 'www.', '') AS w FROM d),
 f AS (SELECT d, CASE WHEN regexp_matches(w, '(^|\\.)m\\.[^.]+\\.') THEN regexp_replace(w, '(^|\\.)m\\.', '\\1') ELSE w END AS g FROM e)
 SELECT d AS domain, {_site('d')} AS site, {_group('g')} AS site_group, d IN ('t.co', 'bit.ly', 'goo.gl', 'tinyurl.com', 'ow.ly', 'buff.ly', 'dlvr.it', 'is.gd', 'tiny.cc', 'j.mp', 'ift.tt', 'amzn.to') AS shortener FROM f""",
    "domain_stats": f"SELECT regexp_replace(lower({_part('url', 2)}), '^www\\.', '') AS domain, count(*) AS n FROM (SELECT DISTINCT url FROM pages) GROUP BY 1",
    "url_table": f"""WITH {_THR}, u AS (SELECT author, id, unnest(list_distinct(list_filter(['http://www.example.com/a;b?x=' || id, 'https://youtu.be/v' || (id % 9), quote_url], lambda x: x IS NOT NULL))) AS url FROM thr)
 SELECT author AS username, CAST(id AS VARCHAR) AS tweet_id, url, {_site(_part('url', 2))} AS domain, {_part('url', 2)} AS raw_domain, lower({_part('url', 1)}) AS protocol, regexp_replace({_part('url', 3)}, ';[^/]*$', '') AS path, {_part('url', 4)} AS query, {_part('url', 5)} AS fragment FROM u""",
    "url_extract": "SELECT doc_id, 'https://t.co/abc' || doc_id || ', https://www.twitter.com/ann/status/' || doc_id || ' http://a.b/c%20d' AS found FROM documents",
    "id_extractors": f"""WITH {_CASES} SELECT doc_id, coalesce(nullif(regexp_extract(url, '(?:youtube\\.com/watch\\?v=|youtu\\.be/)([a-zA-Z0-9_-]+)', 1), ''), nullif(regexp_extract(url, 'youtube\\.com/shorts/([a-zA-Z0-9_-]+)', 1), '')) AS video,
 coalesce(nullif(regexp_extract(url, '(?:twitter|x)\\.com/\\w+/status/(\\d+)', 1), ''), nullif(regexp_extract(url, '(?:twitter|x)\\.com/\\w+/statuses/(\\d+)', 1), '')) AS post, nullif(regexp_extract(url, 'github\\.com/([^/]+)/([^/]+)', 1), '') AS owner,
 nullif(regexp_extract(url, 'github\\.com/([^/]+)/([^/]+)', 2), '') AS repo, coalesce(nullif(regexp_extract(url, 'instagram\\.com/p/([^/]+)', 1), ''), nullif(regexp_extract(url, 'instagram\\.com/reel/([^/]+)', 1), '')) AS photo,
 CASE WHEN doc_id % 9 <= 2 THEN 'video' WHEN doc_id % 9 IN (3, 4, 8) THEN 'post' WHEN doc_id % 9 = 5 THEN 'repository' ELSE 'page' END AS handler FROM cases""",
    "url_categories": f"WITH {_CASES}, k AS (SELECT CASE WHEN doc_id % 9 IN (3, 8) THEN 'internal' WHEN doc_id % 9 = 7 THEN 'unresolved' ELSE 'external' END AS category FROM cases) SELECT category, count(*) AS n, {_PCT.format('count(*)', 'sum(count(*)) OVER ()', 2)} AS pct FROM k GROUP BY 1",
    "archive_url_stats": f"WITH {_CASES} SELECT CAST(doc_id % 5 AS VARCHAR) AS username, count(*) AS urls, count(DISTINCT url) AS unique_urls, count(DISTINCT {_site(_part('url', 2))}) AS unique_domains, round(avg(CASE WHEN doc_id % 3 = 0 THEN 1.0 ELSE 0.0 END), 6) AS success_rate, round(avg(CASE WHEN doc_id % 3 = 1 THEN 1.0 ELSE 0.0 END), 6) AS error_rate FROM cases GROUP BY 1",
    "fetch_states": "WITH s AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'binary content' WHEN 1 THEN 'non-HTML content' END AS k FROM documents) SELECT doc_id, coalesce(k, '-') AS skipped, CASE WHEN k IS NOT NULL THEN 'skipped' WHEN doc_id % 3 = 1 THEN 'failed' WHEN doc_id % 3 = 0 THEN 'success' ELSE 'not_attempted' END AS status FROM s",
    "clean_texts": "WITH t AS (SELECT doc_id, '@ann ' || text || '  #tag https://t.co/x end' AS t FROM documents) SELECT doc_id, md5(" + _CLEAN.format("t") + ") AS clean_md5, CAST(len(list_filter(regexp_split_to_array(t, '[\\s\\x0b\\x85\\xa0]+'), lambda w: w <> '')) AS BIGINT) AS n_tokens FROM t",
    "text_entities": "SELECT doc_id, array_to_string(list_sort(list_distinct(['ann', 'bob_1', 'u' || (doc_id % 3)])), ',') AS mentions, 'one,two' AS hashtags FROM documents",
    "id_times": f"WITH {_SRC} SELECT DISTINCT id, TRUE AS valid, FALSE AS bad_valid, {_TS.format('make_timestamp(((CAST(id AS BIGINT) >> 22) + 1288834974657) * 1000)')} AS made_at FROM src",
    "parsed_times": f"SELECT event_id, {_TS.format(chr(100) + 'ate_trunc(' + chr(39) + 'second' + chr(39) + ', ts)')} AS from_post, {_TS.format('ts')} AS from_note, TRUE AS bad_is_null FROM events",
    "identity_history": f"WITH {_IDS} SELECT user_id, {_TS.format('ts')} AS ts, display_name AS value FROM log WHERE display_name IS NOT NULL",
    "identity_as_of": f"WITH {_IDS}, p AS (SELECT * FROM log WHERE ts <= TIMESTAMP '2024-01-16') SELECT user_id, last(username ORDER BY ts, seq) AS username, coalesce(last(display_name ORDER BY ts, seq) FILTER (display_name IS NOT NULL), last(username ORDER BY ts, seq)) AS display_name, last(avatar_url ORDER BY ts, seq) FILTER (avatar_url IS NOT NULL) AS avatar_url, {_TS.format('max(ts)')} AS changed_at FROM p GROUP BY user_id",
    "identity_as_of_each": f"WITH {_IDS}, w AS (SELECT *, last_value(display_name IGNORE NULLS) OVER z AS d, last_value(avatar_url IGNORE NULLS) OVER z AS v, last_value(username) OVER z AS n FROM log WINDOW z AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT seq AS event_id, user_id, n AS username, d AS display_name, v AS avatar_url FROM w",
    "identity_latest": f"WITH {_IDS} SELECT username, last(user_id ORDER BY ts, seq) AS user_id FROM log WHERE username IS NOT NULL GROUP BY username",
    "identity_temporary": f"WITH {_IDS} SELECT seq, CASE WHEN seq % 4 = 0 THEN 'TEMP_' || sha256(username) ELSE user_id END AS user_id, coalesce(display_name, username) AS display_name, seq % 4 = 0 AS temporary FROM log",
    "export_markdown": f"WITH {_THR} SELECT id, md5('# Tweet ' || id || chr(10) || chr(10) || {_CLEAN.format('text')} || chr(10) || chr(10) || 'Posted on: ' || strftime(created_at, '{_SEC}') || chr(10) || chr(10)) AS md5 FROM thr",
    "export_markdown_threads": f"WITH {_THR}, {_DIR} SELECT root_id, md5('# Thread started on ' || strftime(root_at, '{_SEC}') || chr(10) || chr(10) || array_to_string(list_transform({_TURNS}, lambda t: '## ' || strftime(t.at, '{_SEC}') || chr(10) || chr(10) || t.text || chr(10) || chr(10)), '')) AS md5 FROM dir",
    "export_jsonl": f"WITH {_THR}, {_SIMPLE}, {_DIR.replace('FROM thr', 'FROM sim').replace('JOIN thr', 'JOIN sim')} SELECT root_id, md5({_msgs('list_transform(' + _TURNS + ', lambda t, i: ' + _turn(_ALT, 't.text') + ')')}) AS md5 FROM dir",
    "export_chat": f"WITH {_THR}, {_SIMPLE}, {_DIR.replace('FROM thr', 'FROM sim').replace('JOIN thr', 'JOIN sim')} SELECT root_id, md5({_msgs('list_transform(' + _TURNS + ', lambda t, i: ' + _turn(_ALT, 't.text || chr(10) || ' + chr(39) + '[Posted on ' + chr(39) + ' || strftime(t.at, ' + chr(39) + _SEC + chr(39) + ') || ' + chr(39) + ']' + chr(39)) + ')')}) AS md5 FROM dir",
    "export_training": f"WITH {_THR}, {_SIMPLE}, {_DIR.replace('FROM thr', 'FROM sim').replace('JOIN thr', 'JOIN sim')} SELECT root_id, md5({_msgs('list_transform(' + _TURNS + ', lambda t: ' + _turn(chr(39) + 'user' + chr(39), _CLEAN.format('t.text')) + ')')}) AS md5 FROM dir",
    "export_posts": f"""WITH {_THR}, {_SIMPLE} SELECT id, md5('{{"id":"' || id || '","text":' || CAST(to_json(text) AS VARCHAR) || ',"created_at":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S') || '+00:00","media":[],"metadata":null}}') AS md5 FROM sim""",
    "html_titles": "SELECT page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title FROM pages",
    "html_links": """WITH p AS (SELECT page_id, list_sort(list_distinct(list_filter(regexp_extract_all(replace(html, 'href="/', 'href="https://example.net/'), '<a\\s[^>]*href="([^"]*)"', 1), lambda u: regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]')))) AS l FROM pages)
 SELECT page_id, CAST(len(l) AS BIGINT) AS n_links, md5(array_to_string(l, chr(10))) AS links_md5 FROM p""",
    "merged_archives": f"WITH {_SRC}, {_BEST}, k AS (SELECT *, (length(id) + CAST(right(id, 4) AS INTEGER)) % 3 AS k FROM best) SELECT id, tweet_type, CASE WHEN k = 0 THEN full_text || '*' ELSE full_text END AS full_text FROM k",
    "merge_statistics": f"WITH {_SRC}, {_BEST}, k AS (SELECT *, (length(id) + CAST(right(id, 4) AS INTEGER)) % 3 AS k FROM best) SELECT tweet_type, count(*) FILTER (k <> 0) AS \"old\", count(*) FILTER (k <> 2) AS \"new\", count(*) AS merged FROM k GROUP BY tweet_type",
    "safe_user_names": "SELECT c_custkey, regexp_replace(c_name, '[^a-zA-Z0-9_]', '_', 'g') AS safe FROM customer",
    "not_processed": f"WITH {_SRC} SELECT DISTINCT archive_file FROM src WHERE NOT archive_file < 'a2'",
    "section_union": f"WITH {_SRC} SELECT CASE tweet_type WHEN 'note_tweet' THEN 'note' WHEN 'community_tweet' THEN 'community' ELSE 'tweet' END AS kind, count(*) AS n, count(DISTINCT id) AS ids FROM src WHERE tweet_type <> 'like' AND id IS NOT NULL GROUP BY 1",
}

_REP = f"{_CASES}, rep AS (SELECT doc_id, url, CAST(doc_id % 5 AS VARCHAR) AS username, {_site(_part('url', 2))} AS domain FROM cases)"
ORACLE |= {
    "url_report": f"WITH {_REP} SELECT count(*) AS urls, count(DISTINCT url) AS unique_urls, count(DISTINCT domain) AS unique_domains, count(DISTINCT username) AS accounts, count(*) FILTER (doc_id % 9 IN (3, 8)) AS internal, count(*) FILTER (doc_id % 9 = 7) AS unresolved, count(*) FILTER (doc_id % 9 NOT IN (3, 7, 8)) AS external FROM rep",
    "external_domains": f"WITH {_REP} SELECT domain AS value, count(*) AS n FROM rep WHERE doc_id % 9 NOT IN (3, 7, 8) GROUP BY 1 ORDER BY n DESC, value LIMIT 20",
    "array_lengths": f"WITH {_SRC}, g AS (SELECT user_id, tweet_type, count(DISTINCT id) AS k FROM src GROUP BY 1, 2) SELECT tweet_type, count(*) AS n, CAST(sum(k) AS BIGINT) AS entries, count(*) FILTER (k > 0) AS with_entries, CAST(max(k) AS INTEGER) AS most FROM g GROUP BY 1",
    "rows_by_parameter": f"WITH {_SRC} SELECT id, user_id FROM src WHERE tweet_type = 'like'",
    "interaction_scores": f"""WITH {_SRC}, e AS (SELECT CAST(user_id AS BIGINT) % 20 AS source, CAST(length(full_text) % 7 + favorite_count AS BIGINT) AS target, CASE WHEN tweet_type = 'like' THEN 0.7 WHEN is_reply THEN 0.8 WHEN tweet_type = 'note_tweet' THEN 0.6 END AS w FROM src)
 SELECT source, target, round(sum(CAST(w AS DOUBLE)), 6) AS score FROM e WHERE w IS NOT NULL AND source <> target GROUP BY 1, 2""",
}


def oracle(domain_cases: list[str]) -> dict[str, str]:
    listed = ", ".join(f"'{x}'" for x in domain_cases)
    return ORACLE | archive_queries.SQL | {"domain_names": ORACLE["domain_names"].replace("{cases}", listed)}
