"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

import string

from orderflow.llm import secrets, sharding
from orderflow.llm.licenses import BLOCK_WORDS, PHRASES, SPREAD, TEMPLATES

_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"


def _words(text: str, pattern: str = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+") -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {_LOWER}), '{pattern}')"


OP2 = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_words('text')} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l,
         unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
                               lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS g
  FROM b WHERE len(w) > 0),
grams AS (
  SELECT doc_id, l, unnest(list_transform(range(1, len(w) - l + 2), lambda i:
           {{'p': i, 'g': array_to_string(w[i:i + l - 1], ' ')}})) AS s
  FROM d, (SELECT DISTINCT l FROM win) WHERE len(w) >= l),
occ AS (SELECT doc_id, s.p AS p, grams.l AS l, item_id FROM grams
        JOIN win ON grams.l = win.l AND grams.s.g = win.g),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM occ) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
          FROM occ GROUP BY doc_id),
terms AS (SELECT item_id, l, string_split(g, ' ') AS t FROM win),
around AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) + 1), lambda i:
           {{'first': w[i], 'near': list_concat(CASE WHEN i = 1 THEN [''] ELSE [] END,
                                              w[greatest(i - 1, 1):i + 11])}})) AS c
  FROM d WHERE len(w) > 0),
near AS (SELECT DISTINCT doc_id, item_id FROM around JOIN terms ON c.first = t[1]
         WHERE len(list_filter(range(1, l), lambda k:
                     NOT list_contains(c.near[k:k + 4], t[k + 1]))) = 0),
nearly AS (SELECT doc_id, count(*) AS n_near FROM near ANTI JOIN occ USING (doc_id, item_id)
           GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near_items
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
LEFT JOIN nearly USING (doc_id)
"""

OP4 = fr"""
WITH RECURSIVE d AS (SELECT doc_id, {_words('text', r'[^\x20\x09-\x0D]+')} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1),
        lambda i: array_to_string(w[i:i + 3], ' '))) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b USING (g)
          WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * i >= 85 * (x.n + y.n - i)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d
                UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id
FROM d JOIN reach ON reach.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP5 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\<]', '', 'g')) AS shown,
             length(role) + length(regexp_replace(role, '[^\\<>\n]', '', 'g')) AS role_shown
      FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(length('<turn ') + role_shown + length('>') + 1 + shown + 1 + length('</turn>') + 1)
    AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def _texts(values: dict[str, str]) -> str:
    return ", ".join("('{}', '{}')".format(k.replace("'", "''"), v) for k, v in values.items())


OP6 = fr"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_words('text')} AS w FROM documents),
p AS (SELECT string_split(phrase, ' ') AS p, label FROM (VALUES {_texts(PHRASES)}) v(phrase, label)),
base AS (SELECT doc_id, label, unnest(list_filter(range(1, len(w) + 1),
           lambda i: w[i:i + len(p) - 1] = p)) - 1 AS place FROM d, p),
places AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
                  list_sort(list(DISTINCT label)) AS own FROM base GROUP BY doc_id),
lines AS (SELECT doc_id, {_words('line')} AS w FROM
            (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
blocks AS (
  SELECT DISTINCT doc_id, list_distinct(w) AS w FROM lines WHERE len(w) BETWEEN 1 AND {BLOCK_WORDS}
  UNION SELECT DISTINCT doc_id, list_distinct(w[i + 1:i + {BLOCK_WORDS}]) FROM (
    SELECT doc_id, w, unnest(range(0, len(w) - {BLOCK_WORDS // 2}, {BLOCK_WORDS // 2})) AS i
    FROM lines WHERE len(w) > {BLOCK_WORDS})),
t AS (SELECT list_distinct({_words('template')}) AS t, label,
             {SPREAD} * len({_words('template')}) AS spread
      FROM (VALUES {_texts(TEMPLATES)}) v(template, label)),
stretches AS (
  SELECT doc_id, t, label, unnest(list_transform(range(1, len(w) + 1), lambda i:
           CASE WHEN list_contains(t, w[i]) THEN len(list_intersect(w[i:i + spread - 1], t)) END)) AS n
  FROM d, t WHERE len(list_intersect(w, t)) >= ceil(0.8 * len(t) - 1e-9)),
found AS (SELECT doc_id, label, len(list_intersect(w, t)) / len(t) AS part FROM blocks, t
          WHERE len(list_intersect(w, t)) >= ceil(0.8 * len(t) - 1e-9)
          UNION ALL SELECT doc_id, label, n / len(t) FROM stretches
          WHERE n >= ceil(0.8 * len(t) - 1e-9)),
more AS (SELECT doc_id, list(DISTINCT label) AS labels, max(part) AS score FROM found
         GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word,
  last_word, coalesce(array_to_string(own, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []),
    coalesce(labels, [])))), ','), '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN more USING (doc_id)
"""

OP8 = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
           FROM documents),
r AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id
      FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
"""


def _spans(number: int, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, owner, text, {number} AS kind, m[i] AS match,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT doc_id, owner, text, gaps, m, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT doc_id, owner, text, string_split_regex(text, '{quoted}') AS gaps,
           regexp_extract_all(text, '{quoted}') AS m
    FROM d WHERE regexp_matches(text, '{quoted}')))"""


_KINDS = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
_ASSIGN = secrets.ASSIGN.replace("'", "''")
_N = len(secrets.BASE)
OP9 = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS text
           FROM documents),
raw AS ({" UNION ALL ".join(_spans(i, p) for i, p in enumerate(secrets.PATTERNS.values()))}),
cut AS (SELECT *, start + length(match) AS stop,
               CASE WHEN kind = 0 THEN regexp_extract(match, '{_ASSIGN}', 2) ELSE match END AS value
        FROM raw),
c AS (SELECT * FROM cut WHERE kind <> 0 OR length(value) >= 8),
o AS (SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT text) AS texts
      FROM c GROUP BY value),
c2 AS (SELECT c.*, texts > {secrets.MOST_TEXTS}
              OR (owners > {secrets.MOST_OWNERS} AND texts >= {secrets.LEAST_TEXTS}) AS example
       FROM c JOIN o USING (value)),
live AS (SELECT DISTINCT doc_id, {secrets.KINDS.index('live')} AS kind,
                stop - length(value) AS start, stop, example
         FROM c2 WHERE NOT example AND regexp_matches(value, '[0-9]')
           AND regexp_matches(value, '[A-Za-z]')
           AND len(list_distinct(string_split(value, ''))) >= 8),
every AS (SELECT doc_id, kind, start, stop, example FROM c2
          UNION ALL SELECT doc_id, kind, start, stop, example FROM live),
named AS (SELECT *, {_KINDS}[kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT)
            AS span FROM every),
g AS (SELECT doc_id, string_agg(span, ',' ORDER BY start, kind) AS spans,
             string_agg(span, ',' ORDER BY start, kind) FILTER (kind < {_N}) AS base,
             {", ".join(f"count(*) FILTER (kind = {i}) AS n_{k}"
                        for i, k in enumerate(secrets.KINDS))},
             count(*) FILTER (example) AS n_example FROM named GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.KINDS[:_N])},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.KINDS[_N:])},
       coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN g USING (doc_id)
"""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_LETTERS}', (((CAST('0x' || substr(h, {1 + 5 * i}, 5) AS BIGINT) >> {shift}) & 31) "
    f"+ 1)::BIGINT, 1)" for i in range(8) for shift in (15, 10, 5, 0))
OP10 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top,
                  trim(regexp_replace(coalesce(url, ''), '[\\r\\n]', '', 'g')) AS url
           FROM pages),
k AS (SELECT *, split_part(CASE WHEN regexp_matches(url, '://.') THEN substr(url, strpos(url, '://') + 3)
                           ELSE url END, '#', 1) AS rest FROM p),
u AS (SELECT *, split_part(regexp_replace(lower(regexp_replace(split_part(rest, '/', 1), '^.*@', '')),
                                          '^www\\.', ''), ':', 1) AS host,
             regexp_extract(rest, '/.*$', 0, 's') AS path,
             strftime(make_timestamp((coalesce(page_id, 0) % 1000000000 + 1000000000) * 1000000),
                      '%Y-%m-%dT%H:%M:%SZ') AS captured FROM k),
n AS (SELECT *, array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || lower(path)
                  AS url_key FROM u)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to, url_key, captured,
       row_number() OVER (ORDER BY url_key, captured, page_id NULLS FIRST) - 1 AS rank
FROM n
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes."""
    octets = (f"list_transform(regexp_extract_all(hex(encode({text})), '..'), "
              f"lambda h: CAST('0x' || h AS BIGINT))")
    return (f"xor(list_reduce(list_concat([4294967295], {octets}), lambda c, b: "
            f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], "
            f"lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)")


_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP11 = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")}
           % 20 AS kind
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END
           AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM k WHERE kind <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1
           AS seen, rtrim(text, {_TRIM}) AS shown, left(role, 1) AS r FROM d),
f AS MATERIALIZED (
  SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS last,
         CASE WHEN shown = '' THEN 'blank' WHEN seen THEN 'duplicate'
              WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM o),
moves(a, r, b) AS (VALUES ('empty', 's', 'system'), ('empty', 'u', 'user'), ('system', 'u', 'user'),
                          ('pairs', 'u', 'user'), ('user', 'a', 'pairs')),
ins(a, n, b) AS (
  SELECT a, 0, a FROM (VALUES ('empty'), ('system'), ('pairs'), ('user')) v(a)
  UNION ALL SELECT a, 1, b FROM moves WHERE r <> 's'
  UNION ALL SELECT x.a, 2, y.b FROM moves x JOIN moves y ON x.b = y.a WHERE 's' NOT IN (x.r, y.r)
  UNION ALL SELECT x.a, 3, z.b FROM moves x JOIN moves y ON x.b = y.a JOIN moves z ON y.b = z.a
            WHERE 's' NOT IN (x.r, y.r, z.r)),
edits(action, r, cost) AS (VALUES ('R', 'u', 1), ('R', 'a', 1), ('K', 's', 0), ('K', 'u', 0),
                                  ('K', 'a', 0)),
t(conv_id, i, state, best) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 'empty', {{'cost': CAST(0 AS BIGINT), 'audit': ''}}
  FROM f
  UNION ALL
  SELECT conv_id, i, state, min(best) FROM (
    SELECT t.conv_id, f.i, u.state,
           {{'cost': t.best.cost + 5 * ins.n + u.cost,
             'audit': t.best.audit || repeat('I', ins.n) || u.action}} AS best
    FROM t JOIN f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.i = t.i + 1
    JOIN ins ON ins.a = t.state,
    LATERAL (SELECT 'D' AS action, ins.b AS state, 2 AS cost
             UNION ALL SELECT e.action, m.b, e.cost + CASE f.fault WHEN 'truncated' THEN 5 ELSE 0 END
             FROM edits e JOIN moves m ON m.a = ins.b AND m.r = e.r
             WHERE f.fault NOT IN ('blank', 'duplicate') AND (e.action = 'R' OR e.r = f.r)) u)
  GROUP BY conv_id, i, state),
ends AS (
  SELECT t.conv_id, min({{'cost': t.best.cost + 5 * ins.n,
                          'audit': t.best.audit || repeat('I', ins.n)}}) AS best
  FROM t JOIN (SELECT conv_id, max(i) AS n FROM f GROUP BY conv_id) l
    ON l.conv_id IS NOT DISTINCT FROM t.conv_id AND l.n = t.i
  JOIN ins ON ins.a = t.state AND ins.b IN ('empty', 'pairs') GROUP BY t.conv_id),
steps AS (SELECT conv_id, place, best.audit[place] AS action,
                 length(replace(left(best.audit, place), 'I', '')) AS i,
                 length(replace(left(best.audit, place), 'D', '')) AS j
          FROM (SELECT conv_id, best, unnest(range(1, length(best.audit) + 1)) AS place FROM ends)),
joined AS (SELECT s.conv_id, s.place, s.action, s.j, f.role, f.text, f.r FROM steps s
           LEFT JOIN f ON s.action <> 'I' AND f.conv_id IS NOT DISTINCT FROM s.conv_id
             AND f.i = s.i
           WHERE s.action <> 'D'),
shifted AS (SELECT *, bool_or(j = 1 AND action = 'K' AND r = 's') OVER (PARTITION BY conv_id) AS sys
            FROM joined),
repaired AS (
  SELECT conv_id, sha256(string_agg(
    CASE WHEN action = 'K' THEN role WHEN (j + CAST(sys AS INT)) % 2 = 1 THEN 'user'
         ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY place)) AS digest
  FROM shifted GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (last || r NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM a.conv_id
"""


def _mixed(column: str, out: str, source: str, kept: str) -> str:
    """A statement that adds ``out``, the mixed bits of an unsigned 64-bit column."""
    def step(x: str, shift: int, factor: int) -> str:
        return (f"CAST((CAST(xor({x}, {x} >> {shift}) AS UHUGEINT) * CAST({factor} AS UHUGEINT)) "
                f"% CAST(18446744073709551616 AS UHUGEINT) AS UBIGINT)")
    (s1, f1), (s2, f2) = [(s, int(f)) for s, f in sharding._MIX]
    return f"""SELECT {kept}, xor(m2, m2 >> 31) AS {out} FROM (
      SELECT {kept}, {step('m1', s2, f2)} AS m2 FROM (
        SELECT {kept}, {step(column, s1, f1)} AS m1 FROM ({source})))"""


_PLACES = sharding.ROOM[0] * sharding.ROOM[1] * sharding.ROOM[2]
_NODES = 1 + sharding.ROOM[0] + sharding.ROOM[0] * sharding.ROOM[1] + _PLACES
#: Draws of rows that are still turned away after so many are not in the statement.
_ATTEMPTS = 64


def _first_node(level: int) -> int:
    sizes = [1, sharding.ROOM[0], sharding.ROOM[0] * sharding.ROOM[1]]
    return sum(sizes[:level])


def _level(name: str, before: str, level: int) -> str:
    """The child of each (id, attempt) that draws the smallest number."""
    width = sharding.ROOM[level - 1]
    child = (f"{_first_node(level)} + (node - {_first_node(level - 1)}) * {width} + j")
    return f"""{name} AS MATERIALIZED (
  SELECT id, attempt, bits, arg_min(child, draw) AS node FROM (
    SELECT id, attempt, bits, child, -ln((CAST(h >> 11 AS DOUBLE) + 1) / 9007199254740992) AS draw
    FROM ({_mixed('x', 'h', f"""
      SELECT id, attempt, bits, child, CAST((CAST(bits AS UHUGEINT)
               + CAST(child + attempt * {2 * _NODES} AS UHUGEINT) * CAST({int(sharding._GOLDEN)} AS UHUGEINT))
               % CAST(18446744073709551616 AS UHUGEINT) AS UBIGINT) AS x
      FROM (SELECT id, attempt, bits, {child} AS child
            FROM {before}, (SELECT unnest(range({width})) AS j))""", "id, attempt, bits, child")}))
  GROUP BY id, attempt, bits)"""


OP12 = f"""
WITH ids AS MATERIALIZED (
  {_mixed('x', 'bits', """SELECT DISTINCT coalesce(doc_id, -1) AS id,
    CAST(CASE WHEN coalesce(doc_id, -1) < 0
              THEN CAST(18446744073709551616 AS HUGEINT) + coalesce(doc_id, -1)
              ELSE coalesce(doc_id, -1) END AS UBIGINT) AS x FROM documents""", "id")}),
l0 AS (SELECT id, attempt, bits, 0 AS node FROM ids, (SELECT unnest(range({_ATTEMPTS})) AS attempt)),
{_level('l1', 'l0', 1)},
{_level('l2', 'l1', 2)},
{_level('l3', 'l2', 3)},
of_count AS (
  SELECT id, n, arg_min(node, attempt) - {_NODES - _PLACES} AS shard
  FROM l3, (VALUES (16), (17)) v(n) WHERE node - {_NODES - _PLACES} < n GROUP BY id, n)
SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, crc AS text_crc32,
       'key' AS law, CAST(a.shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY a.shard ORDER BY doc_id NULLS FIRST, crc) - 1 AS slot,
       CAST(b.shard AS INTEGER) AS grown_shard
FROM (SELECT doc_id, text, {_crc32("coalesce(text, '')")} AS crc FROM documents) d
JOIN of_count a ON a.id = coalesce(doc_id, -1) AND a.n = 16
JOIN of_count b ON b.id = coalesce(doc_id, -1) AND b.n = 17
"""


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(
        f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields) + ")"


def _level_up(nodes: str) -> str:
    return (f"list_transform(range(0, (len({nodes}) + 2) // 3), "
            f"lambda i: sha256(array_to_string({nodes}[3 * i + 1:3 * i + 3], '')))")


OP13 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0
              THEN {_leaf("replace(text, chr(10), '')")} END AS changed
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         row_number() OVER () AS doc
  FROM d),
levels(source, k, nodes) AS (
  SELECT source, 0, list(leaf ORDER BY i) FROM leaves GROUP BY source
  UNION ALL SELECT source, k + 1, {_level_up('nodes')} FROM levels WHERE len(nodes) > 1),
subroots AS MATERIALIZED (
  SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
         k AS height FROM levels WHERE len(nodes) = 1),
tops(k, nodes) AS (
  SELECT 0, list(subroot ORDER BY place) FROM subroots
  UNION ALL SELECT k + 1, {_level_up('nodes')} FROM tops WHERE len(nodes) > 1),
climb(doc, source, k, i, above, siblings, h) AS (
  SELECT doc, source, 0, i, false, '', coalesce(changed, leaf) FROM leaves
  UNION ALL
  SELECT doc, source, CASE WHEN up THEN 0 ELSE k + 1 END,
         CASE WHEN up THEN place ELSE i // 3 END, above OR up,
         CASE WHEN up THEN siblings ELSE siblings || before || after END,
         CASE WHEN up THEN h ELSE sha256(before || h || after) END
  FROM (
    SELECT c.*, s.place, NOT above AND k = s.height AS up,
           array_to_string(n[i - i % 3 + 1:i], '') AS before,
           array_to_string(n[i + 2:i - i % 3 + 3], '') AS after
    FROM (SELECT c.*, CASE WHEN above THEN t.nodes ELSE l.nodes END AS n
          FROM climb c LEFT JOIN levels l ON NOT above AND l.source IS NOT DISTINCT FROM c.source
                                             AND l.k = c.k
          LEFT JOIN tops t ON above AND t.k = c.k) c
    JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source
    WHERE NOT (above AND len(n) = 1))),
done AS (SELECT doc, arg_max(siblings, length(siblings)) AS siblings,
                arg_max(h, CASE WHEN above THEN 1000 ELSE 0 END + k) AS h FROM climb GROUP BY doc)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, h AS folded_root,
       h = root AS verified
FROM leaves c JOIN done USING (doc) JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source
JOIN (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1) ON true
"""

ORACLES = {
    "op2_decontamination": OP2, "op4_jaccard_join": OP4, "op5_chat_format": OP5,
    "op6_license_scan": OP6, "op8_exact_dedup": OP8, "op9_secret_scan": OP9, "op10_warc": OP10,
    "op11_conversation_repair": OP11, "op12_sharding": OP12, "op13_merkle_manifest": OP13,
}
