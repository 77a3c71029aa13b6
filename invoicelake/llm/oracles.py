"""The results of the registered queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

MIX = rf"""
keyed AS (
    SELECT doc_id, text, source, coalesce(len({WORDS}), 0) AS size,
           md5(concat_ws('/', '42', doc_id, text)) AS k
    FROM docs
),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
weighted AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]
              ::BIGINT AS weight,
           3 * source_size AS cap
    FROM sources
),
ordered AS (
    SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS rank FROM weighted
),
summed AS (
    SELECT *,
           (SELECT sum(source_size) FROM ordered)
               - coalesce((SELECT sum(cap) FROM ordered AS b WHERE b.rank < a.rank), 0) AS words_left,
           (SELECT sum(weight) FROM ordered AS b WHERE b.rank >= a.rank) AS weight_left
    FROM ordered AS a
),
flagged AS (SELECT *, cap * weight_left < words_left * weight AS capped FROM summed),
first_free AS (SELECT * FROM flagged WHERE NOT capped ORDER BY rank LIMIT 1),
targets AS (
    SELECT source, source_size,
           CASE WHEN capped THEN cap::DOUBLE
                ELSE ((SELECT words_left FROM first_free) * weight)::DOUBLE
                     / (SELECT weight_left FROM first_free)::DOUBLE END AS target
    FROM flagged
),
placed AS (
    SELECT k.*, t.source_size, t.target,
           sum(size) OVER (PARTITION BY k.source ORDER BY k, doc_id NULLS LAST, size
                           ROWS UNBOUNDED PRECEDING) - size AS start,
           CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) ELSE 0 END::BIGINT
               AS epochs
    FROM keyed AS k JOIN targets AS t ON k.source IS NOT DISTINCT FROM t.source
),
mixed AS (
    SELECT *, greatest(0, least(size, floor(target) - epochs * source_size - start))::BIGINT AS part
    FROM placed
)
"""

OP4 = f"""
WITH docs AS (SELECT * FROM documents), {MIX}
SELECT doc_id, size, source_size, target, epochs * size + part AS taken FROM mixed
"""

OP7 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, source,
           {WORDS.replace("text", "coalesce(text, '')")} AS ws,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM documents
),
windows AS (
    SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
    FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM docs)
),
counted AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM windows),
covered AS (
    SELECT rid, sum(least(3, coalesce(i - before, 3)))::BIGINT AS n
    FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before
          FROM counted WHERE n > 1)
    GROUP BY rid
),
line_rows AS (
    SELECT rid, doc_id, source, text, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
           trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
    FROM (SELECT rid, doc_id, source, text, unnest(ls) AS l FROM docs)
),
hosts AS (SELECT source, count(DISTINCT text) AS texts FROM docs GROUP BY source),
frequent AS (
    SELECT source, line FROM line_rows JOIN hosts USING (source)
    GROUP BY source, line
    HAVING count(DISTINCT text) >= 20
        OR (count(DISTINCT text) >= 5 AND count(DISTINCT text) > any_value(texts) * 0.2::DOUBLE)
),
removed AS (
    SELECT rid, sum(n)::BIGINT AS n FROM line_rows JOIN frequent USING (source, line) GROUP BY rid
),
stats AS (
    SELECT d.rid, doc_id, len(ws)::BIGINT AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
           (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
           coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(r.n, 0) AS gone
    FROM docs AS d LEFT JOIN covered AS c USING (rid) LEFT JOIN removed AS r USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
           AND n_words - gone >= n_words * 0.5::DOUBLE AS kept
FROM stats
"""

_LOWERED = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

HITS = rf"""
doc_words AS (SELECT row_number() OVER () AS rid, *, {_LOWERED} AS ws FROM docs),
item_words AS (
    SELECT item_id::VARCHAR AS item, {_LOWERED} AS ws FROM benchmark
),
phrases AS (
    SELECT item, array_to_string(ws[i:i + 9], ' ') AS phrase, len(ws[i:i + 9]) AS n
    FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i
          FROM item_words WHERE len(ws) > 0)
),
lengths AS (SELECT DISTINCT n FROM phrases),
doc_phrases AS (
    SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS phrase
    FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM doc_words, lengths)
),
found AS (
    SELECT DISTINCT rid, i, d.n, item FROM doc_phrases AS d JOIN phrases AS p
    ON d.phrase = p.phrase AND d.n = p.n
),
hit AS (
    SELECT rid, count(DISTINCT place) AS n_hit
    FROM (SELECT rid, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT rid, i, n FROM found))
    GROUP BY rid
),
items_hit AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT rid, item FROM found WHERE item IS NOT NULL) GROUP BY rid
)
"""

OP8 = f"""
WITH docs AS (SELECT * FROM documents), {HITS}
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN hit USING (rid) LEFT JOIN items_hit USING (rid)
"""


def _number(text: str, most: int) -> str:
    return f"(('0x' || substr(md5({text}), 1, 6))::INT % {most})"


OP6 = rf"""
WITH hosted AS (
    SELECT row_number() OVER () AS rid, page_id, url,
           DATE '2024-01-01' + {_number("'fetch ' || page_id", 366)} AS fetched,
           nullif(lower(rtrim(regexp_extract(url,
               '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.')), '') AS host
    FROM pages
),
asked AS (
    SELECT rid, array_to_string(parts[i:], '.') AS domain
    FROM (SELECT rid, string_split(host, '.') AS parts,
                 unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM hosted)
),
turns AS (
    SELECT domain, unnest(range(0, 4)) AS turn FROM (SELECT DISTINCT domain FROM asked)
),
entries AS (
    SELECT DISTINCT domain, turn % 2 = 0 AS listed,
           DATE '2024-01-01' + {_number("domain || ' ' || turn", 366)} AS dated,
           'list' || {_number("'why ' || domain || ' ' || turn", 3)} AS reason
    FROM turns WHERE {_number("'has ' || domain || ' ' || turn", 3)} = 0
),
spans AS (
    SELECT *, lead(dated) OVER (PARTITION BY domain, reason ORDER BY dated, listed) AS valid_to
    FROM entries
),
hits AS (
    SELECT a.rid, a.domain, s.reason,
           row_number() OVER (PARTITION BY a.rid
                              ORDER BY length(a.domain) DESC, dated DESC, reason DESC) AS place,
           count(*) OVER (PARTITION BY a.rid) AS n_active
    FROM asked AS a JOIN hosted AS h USING (rid) JOIN spans AS s ON a.domain = s.domain
    WHERE listed AND fetched >= dated AND (valid_to IS NULL OR fetched < valid_to)
)
SELECT page_id, url, host, fetched, coalesce(n_active, 0)::BIGINT AS n_active, domain, reason,
       n_active IS NOT NULL AS blocked
FROM hosted LEFT JOIN (SELECT * FROM hits WHERE place = 1) USING (rid)
"""

# The states of a fold over a conversation's rows: the least cost (10 digits), audit and repaired lines with
# nothing yet, a system turn, a user turn and a whole pair before. Control characters separate the parts.
_ADD = "printf('%010d', substr({x}, 1, 10)::BIGINT + {cost}) || substr({x}, 11, instr({x}, chr(1)) - 11) || '{edit}' || substr({x}, instr({x}, chr(1)))"


def _add(x: str, cost: str, edit: str, line: str | None = None) -> str:
    added = _ADD.format(x=x, cost=cost, edit=edit)
    return added if line is None else f"{added} || chr(2) || {line}"


def _turn(x: str, role: str) -> str:
    """Keep or rerole row `r` to a role after state `x`."""
    word = {"u": "user", "a": "assistant"}[role]
    kept = _add(x, "r.extra", "K", "r.role || ':' || r.text")
    changed = _add(x, "r.extra + 1", "R", f"'{word}:' || r.text")
    return f"CASE WHEN r.must_go THEN NULL ELSE least(CASE WHEN r.initial = '{role}' THEN {kept} END, {changed}) END"


_FIRST = _add("s.p0", "r.extra", "K", "r.role || ':' || r.text")
_READ = f"""{{
    'p0': {_add('s.p0', '2', 'D')},
    'p1': least({_add('s.p1', '2', 'D')},
                CASE WHEN NOT r.must_go AND r.initial = 's' THEN {_FIRST} END),
    'p2': least({_add('s.p2', '2', 'D')}, {', '.join(_turn(f's.{p}', 'u') for p in ('p0', 'p1', 'p3'))}),
    'p3': least({_add('s.p3', '2', 'D')}, {_turn('s.p2', 'a')})
}}"""


def _inserted(p: str) -> str:
    return _add(f"x.{p}", "5", "I", "'user:'")


# crc32 of ASCII text, by its table of 256 numbers.
CRC_TABLE = """
crc_table AS (
    SELECT list(list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT)
                                              ELSE c >> 1 END) ORDER BY n) AS tab
    FROM range(256) AS t(n)
)
"""


def crc(text: str) -> str:
    return f"""xor(4294967295::BIGINT, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"""


_ROW_ID = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"

OP11 = f"""
WITH RECURSIVE {CRC_TABLE.strip()},
damaged AS (
    SELECT conv_id, turn, crc % 20 AS damage,
           CASE WHEN crc % 20 = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
           CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '')
                ELSE coalesce(text, ' ') END AS text
    FROM (SELECT *, {crc(_ROW_ID)} AS crc FROM conversations, crc_table)
),
kept AS (
    SELECT conv_id, turn, role, text FROM damaged WHERE damage <> 0
    UNION ALL SELECT conv_id, turn, role, text FROM damaged WHERE damage = 3
),
ordered AS (
    SELECT *, row_number() OVER w AS n, left(role, 1) AS initial,
           lag(left(role, 1)) OVER w || left(role, 1) AS pair,
           NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS is_blank,
           NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut
    FROM kept WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))
),
placed AS (
    SELECT *, n > min(n) OVER (PARTITION BY conv_id, role, text) AS again FROM ordered
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (is_blank) AS blank, count(*) FILTER (again AND NOT is_blank) AS duplicate,
           count(*) FILTER (cut AND NOT again AND NOT is_blank) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows
    FROM placed GROUP BY conv_id
),
steps AS (
    SELECT conv_id, 0::BIGINT AS n,
           {{'p0': '0000000000' || chr(1), 'p1': NULL::VARCHAR,
             'p2': '0000000005I' || chr(1) || chr(2) || 'user:',
             'p3': '0000000010II' || chr(1) || chr(2) || 'user:' || chr(2) || 'assistant:'}} AS s
    FROM counts
    UNION ALL
    SELECT conv_id, n, {{'p0': p0, 'p1': p1, 'p2': p2, 'p3': least(p3, {_add('p2', '5', 'I', "'assistant:'")})}}
    FROM (SELECT conv_id, n, x.p0 AS p0, x.p1 AS p1, x.p3 AS p3,
                 least(x.p2, {_inserted('p0')}, {_inserted('p1')}, {_inserted('p3')}) AS p2
          FROM (SELECT b.conv_id, r.n, {_READ} AS x
                FROM steps AS b JOIN (
                    SELECT *, is_blank OR again AS must_go, CASE WHEN cut THEN 5 ELSE 0 END AS extra
                    FROM placed) AS r
                ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.n = b.n + 1))
),
done AS (
    SELECT c.*, least(s.p0, s.p3) AS best
    FROM steps AS t JOIN counts AS c
    ON t.conv_id IS NOT DISTINCT FROM c.conv_id AND t.n = c.n_rows
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(substr(best, 1, 10)::BIGINT, 0) AS cost,
       coalesce(substr(best, 11, instr(best, chr(1)) - 11), '') AS audit,
       sha256(coalesce(replace(substr(best, instr(best, chr(1)) + 2), chr(2), chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS a
LEFT JOIN done AS b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
"""

OP12 = r"""
WITH keyed AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(body) AS text_sha256
FROM keyed WINDOW w AS (PARTITION BY body ORDER BY doc_id NULLS LAST)
"""

OP13 = f"""
WITH {CRC_TABLE.strip()},
own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
    FROM conversations WHERE conv_id IS NOT NULL
),
members AS (
    SELECT a.conv_id, head, first, least(head, coalesce(b.length, 0)) AS taken
    FROM (SELECT conv_id, conv_id - conv_id % 100 AS first, {crc("conv_id::VARCHAR")} % 6 AS head
          FROM (SELECT DISTINCT conv_id FROM own), crc_table) AS a
    LEFT JOIN (SELECT conv_id, count(*) AS length FROM own GROUP BY conv_id) AS b ON a.first = b.conv_id
),
rebuilt AS (
    SELECT m.conv_id, n AS depth, role, text FROM members AS m JOIN own AS o
    ON o.conv_id = m.first AND n <= head
    UNION ALL
    SELECT m.conv_id, n - head + taken, role, text FROM members AS m JOIN own AS o
    ON o.conv_id = m.conv_id AND n > head
),
walked AS (
    SELECT conv_id, depth, length(text) AS chars,
           string_agg(md5(length(role) || ':' || role || text), '') OVER (
               PARTITION BY conv_id ORDER BY depth) AS path
    FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM members
),
lasts AS (SELECT conv_id, max(path) AS path FROM walked GROUP BY conv_id),
nodes AS (
    SELECT path, max(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars
    FROM walked GROUP BY path
),
children AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
above AS (
    SELECT left(path, 32 * unnest(range(depth + 1))) AS path, n_children = 0 AS leaf,
           (n_convs - 1) * chars AS saved FROM counted
),
totals AS (
    SELECT path, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM above GROUP BY path
),
ends AS (
    SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
    FROM lasts GROUP BY path
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM counted AS c JOIN totals USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes AS p ON c.depth > 0 AND p.path = left(c.path, length(c.path) - 32)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_mixing": OP4,
        "op6_url_filter": OP6,
        "op7_quality_rules": OP7,
        "op8_decontamination": OP8,
        "op11_conversation_repair": OP11,
        "op12_exact_dedup": OP12,
        "op13_prefix_trie": OP13,
    }
