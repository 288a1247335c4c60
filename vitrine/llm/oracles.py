"""DuckDB SQL of the contracts that SQL can express (columns as the queries')."""

from __future__ import annotations

import string

from vitrine.llm import license, sharding

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP1 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
flat AS (SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM d WHERE len(ws) >= 5),
sh AS (SELECT doc_id, concat_ws(' ', word, lead(word, 1) OVER p, lead(word, 2) OVER p, lead(word, 3) OVER p, lead(word, 4) OVER p) AS s,
    lead(word, 4) OVER p AS final FROM flat WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
sets AS (SELECT DISTINCT doc_id, s FROM sh WHERE final IS NOT NULL
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS to_id FROM d UNION SELECT r.doc_id, b.b FROM reach r JOIN sides b ON b.a = r.to_id),
comp AS (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, comp.component_id, d.doc_id = comp.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)"""

OP4 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM benchmark),
phrases AS (SELECT DISTINCT item_id, least(10, len(ws)) AS size, array_to_string(list_slice(ws, k, k + least(10, len(ws)) - 1), ' ') AS s
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS k FROM i WHERE len(ws) > 0)),
flat AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS k FROM d),
grams AS (SELECT doc_id, k, size, array_to_string(list_slice(ws, k, k + size - 1), ' ') AS s
  FROM flat, (SELECT DISTINCT size FROM phrases) WHERE k + size - 1 <= len(ws)),
found AS (SELECT g.doc_id, g.k, g.size, p.item_id FROM grams g JOIN phrases p ON p.size = g.size AND p.s = g.s),
hits AS (SELECT doc_id, count(DISTINCT k + o) AS n_hit FROM (SELECT DISTINCT doc_id, k, size FROM found), (SELECT unnest(range(10)) AS o) WHERE o < size GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP6 = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM p),
b AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first_id FROM h),
t AS (SELECT *, array_to_string(list_transform(range(32), lambda g: list_aggregate(list_transform(range(5), lambda k:
    ((CAST('0x' || substr(hex, CAST((5 * g + k) // 4 AS BIGINT) + 1, 1) AS INTEGER) >> CAST(3 - (5 * g + k) % 4 AS INTEGER)) & 1) << CAST(4 - k AS INTEGER)), 'sum')), ' ') AS codes FROM b)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(string_split(codes, ' '), lambda c: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(c AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM t"""

OP7 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
flat AS (SELECT rid, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM w),
win AS (SELECT rid, pos, concat_ws(' ', word, lead(word, 1) OVER p, lead(word, 2) OVER p, lead(word, 3) OVER p, lead(word, 4) OVER p,
    lead(word, 5) OVER p, lead(word, 6) OVER p, lead(word, 7) OVER p) AS s, lead(word, 7) OVER p AS final
  FROM flat WINDOW p AS (PARTITION BY rid ORDER BY pos)),
often AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, s) AS n FROM win WHERE final IS NOT NULL),
hit AS (SELECT DISTINCT rid, pos + k AS pos FROM often, (SELECT unnest(range(8)) AS k) WHERE n > 1),
rep AS (SELECT rid, count(*) AS n FROM hit GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
per_line AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
s AS (SELECT d.rid, d.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(l.n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(l.n_lines, 0) AS n_lines
  FROM d JOIN w USING (rid) LEFT JOIN per_line l USING (rid) LEFT JOIN rep USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 2 * n_words > word_chars OR word_chars > 20 * n_words
    OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines) AS kept
FROM s"""

#: Conversations as lists of turns; a node is named by its list.  Turns with
#: equal numbers are ordered by content, as the given tables hold none.
OP12 = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
o AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
c AS (SELECT conv_id, ts, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(CAST(conv_id AS VARCHAR))), '..'), lambda y: CAST('0x' || y AS BIGINT)),
      lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), 4294967295), 4294967295) % 6 AS h FROM o, crc),
r AS (SELECT c.conv_id, list_concat(coalesce(list_slice(b.ts, 1, c.h), []), list_slice(c.ts, c.h + 1, len(c.ts))) AS ts
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, len(ts) AS n, d, list_slice(ts, 1, d) AS pre FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM r)),
nodes AS (SELECT pre, d, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d) AS ends FROM p GROUP BY pre, d),
up AS (SELECT a.pre, a.d, a.conv_id, a.n_convs, a.ends, b.conv_id AS parent_conv_id, b.pre AS parent_pre
  FROM nodes a LEFT JOIN nodes b ON b.d = a.d - 1 AND b.pre = list_slice(a.pre, 1, a.d - 1)),
kids AS (SELECT parent_pre AS pre, count(*) AS n FROM up WHERE d > 0 GROUP BY 1),
own AS (SELECT u.pre, u.d, (u.n_convs - 1) * coalesce(length(u.pre[len(u.pre)].text), 0) AS saved, CAST(k.n IS NULL AS BIGINT) AS leaf
  FROM up u LEFT JOIN kids k ON k.pre = u.pre),
sub AS (SELECT list_slice(pre, 1, a) AS pre, sum(saved) AS saved, sum(leaf) AS leaves FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own) GROUP BY 1)
SELECT u.conv_id, CAST(u.d AS BIGINT) AS depth, u.parent_conv_id, u.n_convs, coalesce(k.n, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(u.ends, '')) AS ends_sha256
FROM up u JOIN sub s ON s.pre = u.pre LEFT JOIN kids k ON k.pre = u.pre"""


def op3() -> str:
    def java_to_re2(pattern: str, to: str) -> tuple[str, str]:
        return pattern.replace("'", "''"), to.replace("$", "\\")

    def canonical(col: str) -> str:
        out = f"translate({col}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
        out = f"regexp_replace({out}, '{license.COPYRIGHT_LINE}', '', 'g')"
        for pattern, to in (java_to_re2(*x) for x in license.EQUIVALENT):
            out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
        out = f"regexp_replace({out}, '[^a-z0-9\\n\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')"
        out = f"regexp_replace({out}, ' *\\n[ \\n]*', chr(10), 'g')"
        return f"trim(regexp_replace({out}, '^\\n|\\n$', '', 'g'), ' ')"

    def whole(body: str) -> str:
        out = f"regexp_replace({body}, '\\bcopyright\\n(?:owner|holder)(s?)\\b', 'copyright holder\\1', 'g')"
        out = f"regexp_replace({out}, '\\b(?:version|ver|v)\\n([0-9])', 'version \\1', 'g')"
        return f"replace({out}, chr(10), ' ')"

    known = ", ".join("('{}', '{}')".format(i, body.replace("'", "''")) for i, body in [*license.KNOWN, *license.complete_texts()])
    return f"""
WITH known AS (SELECT min(license_id) AS license_id, body
  FROM (SELECT license_id, {whole(canonical('body'))} AS body FROM (VALUES {known}) AS v(license_id, body)) GROUP BY 2),
c AS (SELECT doc_id, {canonical("coalesce(text, '')")} AS body FROM documents),
units AS (SELECT doc_id, 'text' AS scope, {whole('body')} AS body FROM c WHERE body <> ''
  UNION ALL SELECT doc_id, 'line', trim(unnest(string_split(body, chr(10))), ' ') FROM c WHERE body <> '')
SELECT doc_id, license_id, scope, count(*) AS n FROM units JOIN known USING (body) GROUP BY ALL"""


def op8(n_shards: int = 40, seed: int = 1) -> str:
    """The permutation written out; walking steps as a recursive query."""
    rounds = sharding.round_keys(seed)
    m = sharding.PRIME

    def scramble(v: str, k: tuple[int, int, int]) -> str:
        t = f"(({v} * {k[0]} + {k[1]}) % {m})"
        return f"(({t} * {t} + {k[2]}) % {m})"

    step = "SELECT rid, x // b AS l, x % b AS r, a, b, n FROM {src}"
    steps = []
    for i in range(sharding.ROUNDS):
        step = f"SELECT rid, (l + {scramble('r', rounds[2 * i])}) % a AS l, r, a, b, n FROM ({step})"
        step = f"SELECT rid, l, (r + {scramble('l', rounds[2 * i + 1])}) % b AS r, a, b, n FROM ({step})"
    steps = f"SELECT rid, l * b + r AS x, a, b, n FROM ({step})"
    return f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
raw AS (SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents),
d AS (SELECT doc_id, CAST(octet_length(body) + 16 AS BIGINT) AS size,
    CASE WHEN octet_length(body) = 0 THEN 0 ELSE xor(list_reduce(list_transform(regexp_extract_all(hex(body), '..'), lambda y: CAST('0x' || y AS BIGINT)),
      lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), 4294967295), 4294967295) END AS text_crc32 FROM raw, crc),
num AS (SELECT *, row_number() OVER (ORDER BY doc_id, text_crc32, size) - 1 AS rid, count(*) OVER () AS n FROM d),
dom AS (SELECT rid, n, rid AS x, greatest(1, CAST(floor(sqrt(n - 1)) AS BIGINT) + 1) AS a FROM num),
first AS (SELECT rid, x, a, greatest(1, (n + a - 1) // a) AS b, n FROM dom),
walk AS ({steps.format(src="first")} UNION ALL {steps.format(src="walk WHERE x >= n")})
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(x % {n_shards} AS INTEGER) AS shard, CAST(x // {n_shards} AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM num JOIN (SELECT rid, x FROM walk WHERE x < n) USING (rid)"""


OP3 = op3()
OP8 = op8()
