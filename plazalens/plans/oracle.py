"""The same queries as SQL over the driver's tables, written for another engine.

The SQL says what the results are, in its own way: lists and regular joins where the Spark
side uses one regex or one pass.
"""

from __future__ import annotations

import math

from ..functions.fixed_values import (
    HISTOGRAM_BINS,
    NEGATIVE,
    NEUTRAL,
    POSITIVE,
    SEPARATORS,
    STOPWORDS,
    TOP_VERTICES,
    TOP_WORDS,
)
from . import tables


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(row) + ")" for row in rows)


# --- posts -------------------------------------------------------------------

_POSTS = """posts AS (
  SELECT doc_id AS id, text, source AS author, lang AS zone, n_chars AS retweet_count,
    CASE WHEN doc_id % 5 = 0 THEN []::VARCHAR[]
         ELSE regexp_extract_all(lower(text), '[a-z]{9,}') END AS tags,
    CASE WHEN doc_id % 9 IN (0, 2, 4, 6) THEN 'src' || (doc_id * 7 % 20) END AS rt_author,
    CASE WHEN doc_id % 9 = 1 THEN 'src' || (doc_id * 3 % 20) END AS reply_to,
    CASE WHEN doc_id % 9 IN (0, 2, 4, 6)
         THEN regexp_extract_all(lower(text), '[a-z]{11,}') END AS src_tags,
    CASE WHEN doc_id % 9 IN (0, 2, 4, 6) AND doc_id % 4 = 0
         THEN 'src' || (doc_id * 3 % 20) END AS src_reply_to
  FROM documents)"""

_KINDS = """count(*) AS total, count(rt_author) AS reshares, count(reply_to) AS replies,
  count(*) FILTER (rt_author IS NULL AND reply_to IS NULL) AS neither,
  count(rt_author) + count(reply_to)
    + count(*) FILTER (rt_author IS NULL AND reply_to IS NULL) = count(*) AS partitions"""


def _mentions(tags: str, topic: str) -> str:
    tests = " OR ".join(f"contains(tag, {_text(n)})" for n in tables.TOPICS[topic])
    return f"coalesce(len(list_filter({tags}, lambda tag: {tests})) > 0, false)"


def _topic(tags: str) -> str:
    a, b = _mentions(tags, "a"), _mentions(tags, "b")
    return f"CASE WHEN {a} AND NOT {b} THEN 'a' WHEN {b} AND NOT {a} THEN 'b' END"


_TOPICS = f"""{_POSTS}, topical AS (
  SELECT *, {_topic("tags")} AS topic, {_topic("src_tags")} AS src_topic FROM posts)"""

_TOPIC_REPORT = f"""WITH {_TOPICS}, own AS (
  SELECT topic, {_KINDS} FROM topical WHERE topic IS NOT NULL GROUP BY topic), source AS (
  SELECT src_topic AS topic, count(*) AS source_posts,
    sum(retweet_count)::BIGINT AS source_reshare_count
  FROM topical WHERE src_topic IS NOT NULL GROUP BY src_topic)
SELECT topic, total, reshares, replies, neither, partitions, source_posts, source_reshare_count
FROM own JOIN source USING (topic)"""

# --- text --------------------------------------------------------------------

_BLANKS = r"[\t-\r\x1c- \x85\p{Z}]+"
_LINKS = r"https?:(//|\\)+([\p{L}\p{N}_:#@%/;$()~?+-=\\.&](#!)?)*"


def _clean(text: str) -> str:
    no_links = f"regexp_replace(lower({text}), {_text(_LINKS)}, ', ', 'g')"
    spaced = f"translate({no_links}, {_text(SEPARATORS)}, {_text(' ' * len(SEPARATORS))})"
    words = f"regexp_split_to_array({spaced}, {_text(_BLANKS)})"
    kept = f"list_filter({words}, lambda w: w <> '' AND w[1] <> '@' AND w[1] <> '#')"
    return f"coalesce(array_to_string({kept}, ' '), '')"


_CLEANED = f"""{_POSTS}, cleaned AS (SELECT *, {_clean("text")} AS text_cln FROM posts)"""

_SMALL_LEXICON = "lexicon(word, polarity) AS (VALUES {})".format(
    _values(
        [(_text(w), "1") for w in tables.POSITIVE_WORDS]
        + [(_text(w), "-1") for w in tables.NEGATIVE_WORDS]
    )
)
_ROLE_LEXICON = """lexicon AS (
  SELECT DISTINCT word, CASE WHEN role = 'user' THEN 1 ELSE -1 END AS polarity
  FROM (SELECT role, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word
        FROM conversations) WHERE word <> '')"""


def _labelled(lexicon: str) -> str:
    return f"""{_CLEANED}, {lexicon}, scores AS (
  SELECT id, sum(polarity) AS score
  FROM (SELECT id, unnest(string_split(text_cln, ' ')) AS word FROM cleaned)
  JOIN lexicon USING (word) GROUP BY id), labelled AS (
  SELECT cleaned.*, {_topic("tags")} AS topic,
    CASE WHEN score > 0 THEN '{POSITIVE}' WHEN score < 0 THEN '{NEGATIVE}'
         ELSE '{NEUTRAL}' END AS sentiment
  FROM cleaned LEFT JOIN scores USING (id))"""


_LABELLED = _labelled(_SMALL_LEXICON)

# --- words -------------------------------------------------------------------

_STOP = "stop(word) AS (VALUES {})".format(_values([(_text(w),) for w in STOPWORDS]))
_STOP_TABLE = """stop AS (
  SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM benchmark)"""


def _counts(cte: str, source: str, column: str, stop: str = _STOP) -> str:
    return rf"""{cte}, {stop}, counts AS (
  SELECT word, count(*) AS count
  FROM (SELECT unnest(regexp_split_to_array(lower({column}), '[\t-\r ]+')) AS word FROM {source})
  WHERE word <> '' AND word NOT IN (SELECT word FROM stop) GROUP BY word)"""


_WORDS = _counts(_POSTS, "posts", "text")
_TOP = f"top AS (SELECT word, count FROM counts ORDER BY count DESC, word LIMIT {TOP_WORDS})"


def _segments(where: str = "true") -> str:
    return rf"""{_LABELLED}, {_STOP}, forms AS (
  SELECT topic || ' raw' AS segment, text AS form FROM labelled
    WHERE topic IS NOT NULL AND {where}
  UNION ALL SELECT topic || ' clean', text_cln FROM labelled
    WHERE topic IS NOT NULL AND {where}
  UNION ALL SELECT topic || ' positive', text_cln FROM labelled
    WHERE topic IS NOT NULL AND sentiment = '{POSITIVE}' AND {where}
  UNION ALL SELECT topic || ' negative', text_cln FROM labelled
    WHERE topic IS NOT NULL AND sentiment = '{NEGATIVE}' AND {where}), counts AS (
  SELECT segment, word, count(*) AS count
  FROM (SELECT segment, unnest(regexp_split_to_array(lower(form), '[\t-\r ]+')) AS word
        FROM forms)
  WHERE word <> '' AND word NOT IN (SELECT word FROM stop) GROUP BY segment, word), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY segment ORDER BY count DESC, word)::INTEGER AS rank
  FROM counts)"""


_KEYWORDS = f"SELECT segment, word, count, rank FROM ranked WHERE rank <= {TOP_WORDS}"

# --- times -------------------------------------------------------------------

_CREATED = """created AS (
  SELECT event_id, strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
    floor(epoch(ts))::BIGINT AS epoch
  FROM events)"""

# --- graph -------------------------------------------------------------------

_EVENT_LINKS = """links AS (
  SELECT user_id AS src, json_extract_string(props, '$.k')::BIGINT AS dst FROM events)"""
_SUPPLY_LINKS = """links AS (
  SELECT l_partkey::BIGINT AS src, l_suppkey::BIGINT AS dst FROM lineitem)"""
_POST_LINKS = f"""{_POSTS}, links AS (
  SELECT author AS src, rt_author AS dst FROM posts
  WHERE author IS NOT NULL AND rt_author IS NOT NULL)"""
_DEGREES = """degrees AS (
  SELECT id, count(*) AS degree
  FROM (SELECT src AS id FROM links UNION ALL SELECT dst FROM links) GROUP BY id)"""
# Half up on the decimal digits of the double, as the share is defined; rounding the double
# itself puts values like 1.035 on either side.
_SHARE = """round((degree / (SELECT count(*) FROM links) * 100)::VARCHAR::DECIMAL(30, 18), 2)::DOUBLE
  AS fract_degree"""
_TOP_IDS = f"""{_DEGREES}, landmarks AS (
  SELECT id FROM degrees ORDER BY degree DESC, id LIMIT {TOP_VERTICES})"""
_ALL_IDS = """landmarks AS (
  SELECT author AS id FROM posts UNION SELECT rt_author FROM posts WHERE rt_author IS NOT NULL)"""
# Walks are cut at this length, well above the diameter of these graphs.
_WALK = 12


def _distances(links: str, landmarks: str, directed: bool = True) -> str:
    pairs = "SELECT DISTINCT src, dst FROM links"
    if not directed:
        pairs += " UNION SELECT dst, src FROM links"
    return f"""{links}, {landmarks}, pairs AS ({pairs}), walks AS (
  SELECT id AS landmark, id, 0 AS distance FROM landmarks
  UNION
  SELECT landmark, src, distance + 1 FROM walks JOIN pairs ON dst = id
  WHERE distance < {_WALK}), distances AS (
  SELECT landmark, id, CASE WHEN min(distance) < {_WALK} THEN min(distance)::INTEGER
    ELSE error('a path is as long as the walks') END AS distance FROM walks GROUP BY landmark, id)"""


_SELECT_DISTANCES = "SELECT landmark, id, distance FROM distances"
_CLOSENESS = """SELECT landmark, CASE WHEN count(*) > 1 AND sum(distance) > 0
    THEN (count(*) - 1) / sum(distance)::DOUBLE ELSE 0.0 END AS closeness
FROM distances GROUP BY landmark"""

_PATHS = " UNION ALL ".join(
    f"SELECT '{path}', '{kind}', {count} FROM posts"
    for path, kind, count in (
        ("$", "OBJECT", "count(*)"), ("id", "NUMBER", "count(id)"), ("text", "STRING", "count(text)"),
        ("retweet_count", "NUMBER", "count(retweet_count)"), ("user", "OBJECT", "count(*)"),
        ("user.name", "STRING", "count(author)"), ("user.time_zone", "STRING", "count(zone)"),
        ("in_reply_to_screen_name", "STRING", "count(reply_to)"), ("entities", "OBJECT", "count(*)"),
        ("entities.hashtags", "ARRAY", "count(tags)"), ("entities.hashtags[]", "OBJECT", "sum(len(tags))"),
        ("entities.hashtags[].text", "STRING", "sum(len(tags))"), ("retweeted_status", "OBJECT", "count(rt_author)"),
        ("retweeted_status.user", "OBJECT", "count(rt_author)"), ("retweeted_status.user.name", "STRING", "count(rt_author)"),
        ("retweeted_status.in_reply_to_screen_name", "STRING", "count(src_reply_to)"),
        ("retweeted_status.entities", "OBJECT", "count(rt_author)"),
        ("retweeted_status.entities.hashtags", "ARRAY", "count(src_tags)"),
        ("retweeted_status.entities.hashtags[]", "OBJECT", "sum(len(src_tags))"),
        ("retweeted_status.entities.hashtags[].text", "STRING", "sum(len(src_tags))"),
    )
)
_PIVOTS, _SPREAD = 12, math.log(4 / (1 - 0.95)) / 2
_SAMPLED = f"""pivots AS (SELECT id FROM landmarks ORDER BY md5(id), id LIMIT {_PIVOTS}), n AS (
  SELECT count(*) - 1 AS others, (SELECT max(distance) FROM distances) AS longest FROM landmarks), s AS (
  SELECT l.id AS landmark, least({_PIVOTS}, others + 1) - (l.id IN (SELECT id FROM pivots))::INTEGER AS pivots,
    count(d.id) AS reaching, coalesce(sum(d.distance), 0)::DOUBLE AS total, others, longest
  FROM landmarks l CROSS JOIN n LEFT JOIN distances d ON d.landmark = l.id AND d.distance > 0
    AND d.id IN (SELECT id FROM pivots) GROUP BY l.id, others, longest), e AS (
  SELECT *, reaching / pivots AS share, total / pivots AS mean,
    CASE WHEN pivots >= others THEN 0.0 ELSE sqrt({_SPREAD!r} / pivots * (1 - (pivots - 1) / others::DOUBLE)) END AS error FROM s)
SELECT landmark, round(CASE WHEN total > 0 THEN share / mean ELSE 0.0 END, 9) AS closeness,
  round(CASE WHEN share > error THEN (share - error) / (mean + error * longest) ELSE 0.0 END, 9) AS low,
  round(CASE WHEN mean - error * longest > 0 THEN least(1.0, (share + error) / (mean - error * longest))
    WHEN share + error > 0 THEN 1.0 ELSE 0.0 END, 9) AS high, pivots::BIGINT AS pivots, reaching, true AS holds FROM e"""

ORACLE: dict[str, str] = {
    "dedup_rows": "SELECT DISTINCT user_id, event_type, props FROM events",
    "dedup_keys": """SELECT event_id, user_id, event_type, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY props, event_id) = 1""",
    "dedup_summary": """WITH kept AS (
  SELECT count(*) AS deduped, count(text) AS deduped_with_text
  FROM (SELECT DISTINCT text, lang FROM documents)), everything AS (
  SELECT count(*) AS raw FROM documents)
SELECT raw, deduped, deduped_with_text, raw <> deduped_with_text AS removed
FROM kept, everything""",
    "dedup_flat_posts": f"""WITH {_POSTS} SELECT DISTINCT id, text, author, zone, reply_to,
  rt_author AS source_author, coalesce(array_to_string(tags, '|'), '') AS tags,
  coalesce(array_to_string(src_tags, '|'), '') AS source_tags
FROM (FROM posts UNION ALL FROM posts)""",
    "parse_lines": """SELECT CASE WHEN doc_id % 7 <> 0 THEN doc_id END AS id,
  CASE WHEN doc_id % 7 <> 0 THEN text END AS text, doc_id % 7 = 0 AS malformed FROM documents""",
    "parse_report": """SELECT 2 * count(*) AS raw, count(*) AS deduped,
  count(*) FILTER (doc_id % 7 <> 0) AS deduped_with_text, true AS removed,
  2 * count(*) FILTER (doc_id % 7 = 0) AS malformed FROM documents""",
    "null_profile": f"""WITH {_POSTS} SELECT count(*) AS rows, count(author) AS author,
  count(zone) AS zone, count(tags) AS tags, count(rt_author) AS rt_author,
  count(reply_to) AS reply_to, count(src_tags) AS src_tags, count(src_reply_to) AS src_reply_to
FROM posts""",
    "inferred_schema": """SELECT count(*) AS lines, count(*) FILTER (doc_id % 7 = 0) AS malformed,
  'OBJECT<id: BIGINT, text: STRING>' AS schema FROM documents""",
    "path_profile": f"""WITH {_POSTS}, counted(path, type, "values") AS ({_PATHS})
SELECT path, type, "values"::BIGINT AS "values" FROM counted WHERE "values" > 0""",
    "kind_breakdown": f"WITH {_POSTS} SELECT {_KINDS} FROM posts",
    "kind_breakdown_by_zone": f"WITH {_POSTS} SELECT zone, {_KINDS} FROM posts GROUP BY zone",
    "mean_text_length": """SELECT count(*) AS rows, sum(length(text))::BIGINT AS characters,
  round_even(sum(length(text)) / count(*), 0) AS mean_length FROM documents""",
    "text_completeness": """SELECT count(*) AS rows, count(text) AS with_text,
  count(*) = count(text) AS complete FROM documents""",
    "text_length_histogram": f"""WITH span AS (
  SELECT min(length(text))::DOUBLE AS low, max(length(text))::DOUBLE AS high FROM documents),
edges AS (
  SELECT i AS bin, low + i * ((high - low) / {HISTOGRAM_BINS}) AS lower,
    CASE WHEN i = {HISTOGRAM_BINS - 1} THEN high + 1
         ELSE low + (i + 1) * ((high - low) / {HISTOGRAM_BINS}) END AS upper
  FROM span, generate_series(0, {HISTOGRAM_BINS - 1}) AS bins(i))
SELECT bin::BIGINT AS bin, count(doc_id) AS count
FROM edges LEFT JOIN documents ON length(text) >= lower AND length(text) < upper GROUP BY bin""",
    "created_at_order": f"""WITH {_CREATED} SELECT event_id, created_at, epoch,
  row_number() OVER (ORDER BY epoch, event_id) AS place FROM created""",
    "period": f"""WITH {_CREATED}
SELECT min(epoch) AS min_epoch, max(epoch) AS max_epoch FROM created""",
    "zone_report": f"""WITH {_POSTS} SELECT {_KINDS},
  round_even(sum(length(text)) / count(*), 0) AS mean_length,
  count(*) FILTER (len(tags) > 0) AS with_tags, count(text) AS with_text,
  count(*) = count(text) AS complete
FROM posts WHERE zone LIKE '{tables.ZONE_PATTERN}'""",
    "posts_with_tags": f"WITH {_POSTS} SELECT id FROM posts WHERE len(tags) > 0",
    "topic_posts": f"WITH {_TOPICS} SELECT id, topic FROM topical WHERE topic IS NOT NULL",
    "one_topic_posts": f"""WITH {_TOPICS}
SELECT id, author, rt_author FROM topical WHERE topic = 'a'""",
    "exact_topic_posts": f"""WITH {_POSTS}, needles AS (
  SELECT DISTINCT role AS topic,
    unnest(regexp_extract_all(lower(text), '[a-z]{{9,}}')) AS needle FROM conversations),
on_topics AS (
  SELECT id, count(DISTINCT needles.topic) AS n, any_value(needles.topic) AS topic
  FROM (SELECT id, unnest(tags) AS needle FROM posts) JOIN needles USING (needle) GROUP BY id)
SELECT posts.id, CASE WHEN n = 1 THEN on_topics.topic END AS topic
FROM posts LEFT JOIN on_topics USING (id)""",
    "source_topic_sum": f"""WITH {_TOPICS} SELECT src_topic AS topic, count(*) AS posts,
  sum(retweet_count)::BIGINT AS reshare_count
FROM topical WHERE src_topic IS NOT NULL GROUP BY src_topic""",
    "topic_report": _TOPIC_REPORT,
    "topic_report_nested": _TOPIC_REPORT,
    "clean_text": f"""SELECT doc_id,
  {_clean("text || " + _text(tables.LINKS_AND_ENTITIES))} AS text_cln FROM documents""",
    "clean_pages": f"""SELECT page_id, {_clean("url || ' ' || html")} AS text_cln FROM pages""",
    "sentiment_counts": f"""WITH {_LABELLED}
SELECT sentiment, count(*) AS count FROM labelled GROUP BY sentiment""",
    "sentiment_table_lexicon": f"""WITH {_labelled(_ROLE_LEXICON)}
SELECT id, sentiment FROM labelled""",
    "sentiment_joined_lexicon": f"""WITH {_labelled(_ROLE_LEXICON)}
SELECT id, sentiment FROM labelled""",
    "sentiment_by_topic": f"""WITH {_LABELLED} SELECT topic, sentiment, count(*) AS count
FROM labelled WHERE topic IS NOT NULL GROUP BY topic, sentiment""",
    "sentiment_kinds": f"""WITH {_LABELLED} SELECT topic, sentiment, count(*) AS posts,
  count(rt_author) AS reshares,
  count(*) FILTER (rt_author IS NOT NULL AND src_reply_to IS NOT NULL) AS reshares_of_replies
FROM labelled WHERE topic IS NOT NULL GROUP BY topic, sentiment""",
    "positive_posts": f"""WITH {_LABELLED}
SELECT id, topic FROM labelled WHERE topic IS NOT NULL AND sentiment = '{POSITIVE}'""",
    "word_counts": f"WITH {_WORDS} SELECT word, count FROM counts",
    "word_counts_clean": f"""WITH {_counts(_CLEANED, "cleaned", "text_cln")}
SELECT word, count FROM counts""",
    "word_counts_stop_table": f"""WITH {_counts(_POSTS, "posts", "text", _STOP_TABLE)}
SELECT word, count FROM counts""",
    "vocabulary_size": f"WITH {_WORDS} SELECT count(*) AS words FROM counts",
    "top_words": f"WITH {_WORDS}, {_TOP} SELECT word, count FROM top",
    "top_total": f"WITH {_WORDS}, {_TOP} SELECT sum(count)::BIGINT AS total FROM top",
    "segment_counts": f"WITH {_segments()} SELECT segment, word, count FROM counts",
    "keyword_report": f"WITH {_segments()} {_KEYWORDS}",
    "keyword_report_zone": f"""WITH {_segments(f"zone LIKE '{tables.ZONE_PATTERN}'")}
{_KEYWORDS}""",
    "keyword_totals": f"""WITH {_segments()} SELECT segment, count(*) AS words,
  (sum(count) FILTER (rank <= {TOP_WORDS}))::BIGINT AS total FROM ranked GROUP BY segment""",
    "vertices": f"""WITH {_POSTS}
SELECT author AS id FROM posts UNION SELECT rt_author FROM posts WHERE rt_author IS NOT NULL""",
    "vertices_with_null": f"""WITH {_POSTS}
SELECT author AS id FROM posts UNION SELECT rt_author FROM posts""",
    "edges": f"WITH {_POST_LINKS} SELECT src, dst FROM links",
    "network_size": f"""WITH {_POST_LINKS}, users AS (
  SELECT author AS id FROM posts UNION SELECT rt_author FROM posts), counted AS (
  SELECT count(id) AS users, count(*) AS users_with_null FROM users)
SELECT users, users_with_null, (SELECT count(*) FROM links) AS edges FROM counted""",
    "degrees": f"WITH {_EVENT_LINKS}, {_DEGREES} SELECT id, degree FROM degrees",
    "degree_share": f"""WITH {_EVENT_LINKS}, {_DEGREES}
SELECT id, degree, {_SHARE} FROM degrees""",
    "top_degrees": f"""WITH {_EVENT_LINKS}, {_DEGREES} SELECT id, degree, {_SHARE}
FROM degrees ORDER BY degree DESC, id LIMIT {TOP_VERTICES}""",
    "hop_distances": f"WITH RECURSIVE {_distances(_EVENT_LINKS, _TOP_IDS)} {_SELECT_DISTANCES}",
    "hop_distances_supply": f"""WITH RECURSIVE {_distances(_SUPPLY_LINKS, _TOP_IDS)}
{_SELECT_DISTANCES}""",
    "hop_distances_undirected": f"""WITH RECURSIVE
{_distances(_SUPPLY_LINKS, _TOP_IDS, directed=False)} {_SELECT_DISTANCES}""",
    "closeness": f"WITH RECURSIVE {_distances(_EVENT_LINKS, _TOP_IDS)} {_CLOSENESS}",
    "closeness_sketch": f"""WITH RECURSIVE {_distances(_POST_LINKS, _ALL_IDS)}
SELECT *, true AS within FROM ({_CLOSENESS}) JOIN (
  SELECT landmark, max(distance) AS rounds FROM distances GROUP BY landmark) USING (landmark)""",
    "closeness_sample": f"WITH RECURSIVE {_distances(_POST_LINKS, _ALL_IDS)}, {_SAMPLED}",
    "closeness_all": f"WITH RECURSIVE {_distances(_POST_LINKS, _ALL_IDS)} {_CLOSENESS}",
}
