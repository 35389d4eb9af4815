"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .quality import ALPHA, DELTA, RULES, STEPS

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BLANKS = r"[\x20\x09-\x0D]"


def _steps() -> str:
    """The steps tried, as rows (rule, i, cutoff)."""
    return ", ".join(f"('{rule}', {i}, {cutoff})" for i, (rule, cutoff) in enumerate(STEPS))


def _rejected() -> str:
    return " OR ".join(
        f"coalesce(1000 * {numerator} > max_{rule} * {denominator}, false)"
        for rule, (numerator, denominator, _) in RULES.items()
    )


def _above_step() -> str:
    return " OR ".join(
        f"rule = '{rule}' AND 1000 * {numerator} > cutoff * {denominator}"
        for rule, (numerator, denominator, _) in RULES.items()
    )


_QUALITY = rf"""
    WITH w AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
    win AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) > 8),
    win2 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) AS n FROM win),
    rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM
        (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win2 WHERE n > 1) GROUP BY doc_id),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines
        WHERE regexp_matches(line, '[^ 	-
]') GROUP BY doc_id),
    f AS (SELECT doc_id, stratum, len(w) AS n_words,
        length(regexp_replace(text, '{_BLANKS}', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
        FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)),
    b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
    held AS (SELECT * FROM b WHERE NOT base_failed
        AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
    tried(rule, i, cutoff) AS (VALUES {_steps()}),
    first AS (SELECT stratum, doc_id, min(i) FILTER ({_above_step()}) AS first
        FROM held CROSS JOIN tried GROUP BY stratum, doc_id),
    cells AS (SELECT stratum, rule, i, cutoff, count(*) AS n, count(*) FILTER (first <= i) AS k
        FROM first CROSS JOIN tried GROUP BY ALL),
    tail AS (SELECT *, CASE WHEN k >= n * {ALPHA!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
        lambda x: exp(lgamma(n + 1.0) - lgamma(x + 1.0) - lgamma(n - x + 1.0)
            + x * ln({ALPHA!r}) + (n - x) * ln(1 - {ALPHA!r})))) END AS p FROM cells),
    passed AS (SELECT *, bool_and(p <= {DELTA!r} / (SELECT count(*) FROM (SELECT DISTINCT stratum FROM held)))
        OVER (PARTITION BY stratum ORDER BY i) AS ok FROM tail),
    best AS (SELECT stratum, {", ".join(f"min(cutoff) FILTER (rule = '{rule}') AS max_{rule}" for rule in RULES)}
        FROM passed WHERE ok GROUP BY stratum)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND NOT ({_rejected()}) AS kept,
        {", ".join(f"max_{rule}" for rule in RULES)}
    FROM b LEFT JOIN best ON b.stratum IS NOT DISTINCT FROM best.stratum"""

_MIXING = rf"""
    WITH RECURSIVE d AS (SELECT doc_id, source, len({_WORDS}) AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size,
        (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
    level(l, round) AS (SELECT 0.0::DOUBLE, 0 UNION ALL
        SELECT ((SELECT sum(source_size) FROM s)
            - (SELECT coalesce(sum(3 * source_size) FILTER (weight * l > 3 * source_size), 0) FROM s))::DOUBLE
            / (SELECT sum(weight) FILTER (NOT weight * l > 3 * source_size) FROM s), round + 1
        FROM level WHERE round < 50 AND EXISTS (SELECT 1 FROM s WHERE NOT weight * l > 3 * source_size)),
    t AS (SELECT *, least(weight * (SELECT max(l) FROM level), (3 * source_size)::DOUBLE) AS target FROM s),
    e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS times FROM t),
    g AS (SELECT source, source_size, target, times, floor(target)::BIGINT - times * source_size AS rest FROM e),
    c AS (SELECT doc_id, size, source_size, target, times, rest, h,
        sum(size) OVER (PARTITION BY d.source ORDER BY h) AS reached,
        sum(size) OVER (PARTITION BY d.source, h) AS held
        FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, size, source_size, target, (times * size + CASE WHEN reached <= rest THEN size
        WHEN reached - held < rest THEN (rest - reached + held) * size // held ELSE 0 END)::BIGINT AS taken
    FROM c"""

_TOOL_CALLS = r"""
    WITH RECURSIVE t AS (SELECT *, length(coalesce(text, '')) AS n, coalesce(role = 'assistant', false) AS said,
        'call_' || conv_id || '_' || turn AS id, 'call_' || conv_id || '_' || (turn - 1) AS before,
        'call_' || conv_id || '_' || (turn - 2) AS two FROM conversations),
    c AS (SELECT conv_id, turn, id, ['search', 'read', 'count', 'search', 'read', 'search', 'draw'][n % 7 + 1] AS name,
        n % 13 <> 0 AS parsed, n % 11 <> 0 AS has_query, n % 5 <> 0 AS number, n, text,
        CASE WHEN n % 2 = 0 THEN two END AS needs FROM t WHERE said),
    p AS (SELECT c.*, o.id AS up FROM c LEFT JOIN c o ON c.needs = o.id),
    l AS (SELECT id, 0 AS level FROM p WHERE up IS NULL
        UNION ALL SELECT p.id, l.level + 1 FROM l JOIN p ON p.up = l.id),
    r AS (SELECT before AS id, conv_id, turn, text FROM t WHERE NOT said),
    e AS (SELECT p.*, level, CASE
        WHEN NOT parsed THEN 'not an object'
        WHEN name = 'draw' THEN 'unknown tool'
        ELSE array_to_string(list_filter([
            CASE WHEN NOT number THEN 'type of limit' END,
            CASE WHEN name <> 'count' AND NOT has_query THEN 'missing query' END,
            CASE WHEN name = 'count' AND has_query THEN 'unknown query' END], lambda x: x IS NOT NULL), '; ') END AS errors,
        CASE WHEN parsed THEN '{"chars":' || n || ',"limit":' || CASE WHEN number THEN turn::VARCHAR ELSE '"' || turn || '"' END
            || CASE WHEN has_query THEN ',"query":' || to_json(coalesce(text, ''))::VARCHAR ELSE '' END || '}' END AS arguments
        FROM p JOIN l ON p.id = l.id),
    b AS (SELECT coalesce(e.conv_id, r.conv_id) AS conv_id, coalesce(e.id, r.id) AS call_id, name, level, needs,
        coalesce(e.turn, r.turn) AS position, errors, arguments, r.text AS content, e.id IS NULL AS orphan,
        CASE WHEN e.id IS NULL THEN 'orphan' WHEN r.id IS NULL THEN 'pending' ELSE 'linked' END AS status
        FROM e FULL JOIN r ON e.id = r.id)
    SELECT conv_id, call_id, name, level,
        row_number() OVER (PARTITION BY conv_id ORDER BY orphan, level, position, call_id) AS place, status, errors,
        '{"arguments":' || coalesce(arguments, 'null') || ',"errors":' || coalesce(to_json(errors)::VARCHAR, 'null')
        || ',"id":' || to_json(call_id)::VARCHAR || ',"name":' || coalesce(to_json(name)::VARCHAR, 'null')
        || ',"needs":' || coalesce(to_json(needs)::VARCHAR, 'null') || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null')
        || ',"status":' || to_json(status)::VARCHAR || '}' AS message
    FROM b"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_DECONTAMINATION = rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    bk AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
    bw AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2),
        lambda i: array_to_string(w[i:i + k - 1], ' '))) AS win FROM bk),
    ks AS (SELECT DISTINCT k FROM bw),
    p AS (SELECT r, k, unnest(list_transform(range(1, len(w) - k + 2),
        lambda i: {{'i': i, 'win': array_to_string(w[i:i + k - 1], ' ')}})) AS s FROM d, ks WHERE len(w) >= k),
    h AS (SELECT r, s.i AS i, p.k, item_id FROM p JOIN bw ON p.k = bw.k AND s.win = bw.win),
    c AS (SELECT r, count(DISTINCT hit) AS n FROM (SELECT r, unnest(range(i, i + k)) AS hit FROM h) GROUP BY r),
    t AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM h GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
        sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)"""

_REPAIR = r"""
    WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
    k AS (SELECT coalesce('=' || conv_id, '-') AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS named FROM conversations),
    g AS (SELECT key, turn, role, text, xor(list_reduce(
        list_concat([4294967295], list_transform(string_split(named, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) % 20 AS kind FROM k, tab),
    d AS (SELECT key, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM g),
    o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text) AS place FROM d),
    f AS (SELECT key, place, turn, role, text, left(role, 1) AS initial, CASE
        WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
        WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY place) > 1 THEN 'd'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '-' END AS fault FROM o),
    ins(q, to_q, cost, edits, lines) AS (VALUES (0, 0, 0, '', ''), (0, 2, 3, 'I', E'\nuser:'), (0, 3, 6, 'II', E'\nuser:\nassistant:'),
        (1, 1, 0, '', ''), (1, 2, 3, 'I', E'\nuser:'), (1, 3, 6, 'II', E'\nuser:\nassistant:'),
        (2, 2, 0, '', ''), (2, 3, 3, 'I', E'\nassistant:'), (3, 3, 0, '', ''), (3, 2, 3, 'I', E'\nuser:')),
    edit(q, edit, initial, to_q, cost, role) AS (VALUES (0, 'D', NULL, 0, 4, ''), (1, 'D', NULL, 1, 4, ''), (2, 'D', NULL, 2, 4, ''),
        (3, 'D', NULL, 3, 4, ''), (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL),
        (3, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL), (0, 'R', NULL, 2, 3, 'user'), (1, 'R', NULL, 2, 3, 'user'),
        (3, 'R', NULL, 2, 3, 'user'), (2, 'R', NULL, 3, 3, 'assistant')),
    st AS (SELECT key, 0::BIGINT AS place, 0 AS q, {'cost': 0, 'audit': '', 'lines': ''} AS best FROM (SELECT DISTINCT key FROM f)
        UNION ALL
        SELECT st.key, f.place, edit.to_q, min({
            'cost': st.best.cost + ins.cost + edit.cost + CASE WHEN edit.edit <> 'D' AND f.fault = 't' THEN 3 ELSE 0 END,
            'audit': st.best.audit || ins.edits || edit.edit,
            'lines': st.best.lines || ins.lines || CASE WHEN edit.edit = 'D' THEN '' ELSE E'\n' || coalesce(edit.role, f.role) || ':' || f.text END})
        FROM st JOIN f ON f.key = st.key AND f.place = st.place + 1 JOIN ins ON ins.q = st.q JOIN edit ON edit.q = ins.to_q
        WHERE (edit.edit = 'D' OR f.fault NOT IN ('b', 'd')) AND (edit.initial IS NULL OR edit.initial = f.initial)
        GROUP BY st.key, f.place, edit.to_q),
    n AS (SELECT key, max(place) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
        count(*) FILTER (fault = 't') AS truncated FROM f GROUP BY key),
    ill AS (SELECT a.key, count(*) AS n FROM f a JOIN f b ON a.key = b.key AND b.place = a.place + 1
        WHERE a.initial || b.initial NOT IN ('su', 'ua', 'au') GROUP BY a.key),
    e AS (SELECT st.key, min({'cost': best.cost + ins.cost, 'audit': best.audit || ins.edits, 'lines': best.lines || ins.lines}) AS best
        FROM st JOIN n ON n.key = st.key AND st.place = n.n JOIN ins ON ins.q = st.q WHERE ins.to_q IN (0, 3) GROUP BY st.key)
    SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
        coalesce(truncated, 0)::BIGINT AS truncated, coalesce(ill.n, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
        coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.lines, 2), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '-') AS key FROM conversations) c
    LEFT JOIN n ON n.key = c.key LEFT JOIN ill ON ill.key = c.key LEFT JOIN e ON e.key = c.key"""

ORACLE: dict[str, str] = {
    "op11_decontamination": _DECONTAMINATION,
    "op12_conversation_repair": _REPAIR,
    "op8_tool_calls": _TOOL_CALLS,
    "op4_quality_rules": _QUALITY,
    "op5_mixing": _MIXING,
    "op7_exact_dedup": rf"""
        WITH n AS (SELECT doc_id, {_NORMAL} AS body FROM documents)
        SELECT doc_id,
            min(doc_id) OVER (PARTITION BY body) AS keep_id,
            count(*) OVER (PARTITION BY body) AS group_size,
            doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
            sha256(body) AS text_sha256
        FROM n""",
    "op9_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        s AS (
            SELECT doc_id, unnest(CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                END) AS s
            FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
            FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
        l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * i >= 80 * (x.n + y.n - i)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
        c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d JOIN c ON c.a = d.doc_id LEFT JOIN n USING (doc_id)""",
}
