"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = "list_filter(string_split_regex({t}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_PLACE = "turn NULLS FIRST, role NULLS FIRST, {t} NULLS FIRST"


def _rendered(text: str) -> str:
    return f"'<|' || coalesce(role, '') || '|>' || chr(10) || coalesce({text}, '') || chr(10) || '<|end|>' || chr(10)"


def _mask(side: str, text: str) -> str:
    span = f"({side}_end - length(coalesce({text}, '')) - 9)::BIGINT || ':' || {side}_end::BIGINT"
    return f"coalesce(string_agg({span}, ',' ORDER BY i) FILTER (NOT same AND {side}_role = 'assistant'), '') AS {'chosen' if side == 'good' else 'rejected'}_mask"


#: Each side stands in its own order, which differs where turns of one number and role get another text.
OP1 = f"""
WITH turns AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, text DESC NULLS LAST) AS k FROM turns WHERE role = 'assistant') WHERE k = 1),
pairs AS (SELECT a.conv_id, a.turn AS last_turn, coalesce(b.text, '') AS other FROM last a LEFT JOIN last b ON xor(b.conv_id, 1) = a.conv_id),
kept AS (SELECT t.*, CASE WHEN turn = last_turn AND role = 'assistant' THEN other ELSE text END AS alt FROM turns t LEFT JOIN pairs USING (conv_id)),
good AS (SELECT conv_id, role AS good_role, text, {_rendered("text")} AS good, row_number() OVER (PARTITION BY conv_id ORDER BY {_PLACE.format(t="text")}) AS i FROM kept),
bad AS (SELECT conv_id, role AS bad_role, alt, {_rendered("alt")} AS bad, row_number() OVER (PARTITION BY conv_id ORDER BY {_PLACE.format(t="alt")}) AS i FROM kept),
marked AS (SELECT *, bool_and(good_role IS NOT DISTINCT FROM bad_role AND text IS NOT DISTINCT FROM alt) OVER (PARTITION BY conv_id ORDER BY i) AS same FROM good JOIN bad USING (conv_id, i)),
ends AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE length(good) END) OVER w AS good_end, sum(CASE WHEN same THEN 0 ELSE length(bad) END) OVER w AS bad_end FROM marked WINDOW w AS (PARTITION BY conv_id ORDER BY i))
SELECT conv_id AS pair_id, CAST(count(*) FILTER (same) AS INTEGER) AS prefix_turns,
  coalesce(string_agg(good, '' ORDER BY i) FILTER (same), '') AS prompt,
  coalesce(string_agg(good, '' ORDER BY i) FILTER (NOT same), '') AS chosen,
  coalesce(string_agg(bad, '' ORDER BY i) FILTER (NOT same), '') AS rejected,
  {_mask("good", "text")}, {_mask("bad", "alt")}
FROM ends GROUP BY conv_id
"""

OP3 = """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, sqrt(n::DOUBLE) / sum(sqrt(n::DOUBLE)) OVER () * sum(n) OVER () / n AS rate FROM n),
ks AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 10 * sqrt(rate) + 31) AS BIGINT))) AS k FROM r),
terms AS (SELECT source, rate, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p FROM ks),
below AS (SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS s FROM terms),
named AS (SELECT *, row_number() OVER () AS _row, coalesce(doc_id::VARCHAR, 'null') AS _name FROM documents),
drawn AS (SELECT _row, source, ('0x' || substr(md5('mix-1|' || _name), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM named),
n_copies AS (SELECT _row, any_value(b.rate) AS rate, count(*) FILTER (b.s <= d.u) AS c FROM drawn d JOIN below b ON d.source IS NOT DISTINCT FROM b.source GROUP BY _row),
copies AS (SELECT _row, rate, unnest(range(0, c)) AS copy FROM n_copies)
SELECT d.* EXCLUDE (_row, _name), round(rate, 9) AS rate, copy::INTEGER AS copy, md5('mix-1-order|' || _name || '|' || copy) AS order_key FROM copies JOIN named d USING (_row)
"""

#: Rows of one doc_id and different texts stand in the order of their texts here, by a hash of the texts in the operator.
OP5 = f"""
WITH w AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text NULLS FIRST) AS r, doc_id, {_WORDS.format(t="coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM w),
runs AS (SELECT r, i, n, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS run FROM p),
later AS (SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY run ORDER BY r, i) AS k FROM runs WHERE i + 19 <= n) WHERE k > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS i FROM later),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM p ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)
"""

OP6 = f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(t=_LOWER)} AS ws FROM documents),
s AS (SELECT DISTINCT r, doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
             ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM w),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
shared AS (SELECT a.r AS ra, b.r AS rb, any_value(a.doc_id) AS a, any_value(b.doc_id) AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT DISTINCT a, b FROM shared JOIN n x ON x.r = ra JOIN n y ON y.r = rb WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS node, a AS seen FROM both_ways UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON l.a = r.seen)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.c, w.doc_id) AS component_id, coalesce(coalesce(c.c, w.doc_id) = w.doc_id, true) AS kept
FROM w LEFT JOIN n USING (r) LEFT JOIN (SELECT node AS doc_id, min(seen) AS c FROM reach GROUP BY 1) c ON c.doc_id = w.doc_id
"""

_BENCH = "list_filter(string_split_regex({t}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
OP10 = f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, {_BENCH.format(t=_LOWER)} AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {_BENCH.format(t=_LOWER)} AS ws FROM benchmark),
runs AS (SELECT item_id, 10 AS k, unnest(list_transform(range(1, len(ws) - 8), lambda i: array_to_string(ws[i:i + 9], ' '))) AS run FROM b WHERE len(ws) >= 10
         UNION ALL SELECT item_id, len(ws), array_to_string(ws, ' ') FROM b WHERE len(ws) BETWEEN 1 AND 9),
sizes AS (SELECT DISTINCT k FROM runs),
grams AS (SELECT r, k, unnest(range(1, len(ws) - k + 2)) AS i, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS run FROM w, sizes WHERE len(ws) >= k),
hits AS (SELECT g.r, g.k, i, item_id FROM grams g JOIN runs x ON x.run = g.run AND x.k = g.k),
n_hit AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS t FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items, sha256(coalesce(m.t, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM w LEFT JOIN n_hit h USING (r) LEFT JOIN items m USING (r)
"""

_DIGITS = "('0x' || substr(sha1(coalesce(html, '')), 1 + 5 * g, 5))::BIGINT"
OP11 = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((list_transform(range(0, 8), lambda g: {_DIGITS})[1 + i // 4] >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS digest FROM pages),
k AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first, row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST, url NULLS FIRST) AS k FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN k = 1 OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN first END AS refers_to
FROM k
"""


def _way(state: str, cost: str, letter: str, text: str) -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {text}}} END"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


_USER, _ASSISTANT, _LATE = "chr(10) || 'user:'", "chr(10) || 'assistant:'", "CASE WHEN fault = 't' THEN 3 ELSE 0 END"
_X2 = _least("s2", *(_way(s, "3", "I", _USER) for s in ("s0", "s1", "s3")))
#: Closed under inserts: x2 and x3; then the turn: y0 to y3.
_KEPT = "chr(10) || role || ':' || text"


def _stay(states: tuple[str, ...], initial: str, name: str) -> list[str]:
    keep = [f"CASE WHEN fault IN ('', 't') AND r = '{initial}' THEN {_way(s, _LATE, 'K', _KEPT)} END" for s in states]
    return keep if initial == "s" else keep + [f"CASE WHEN fault IN ('', 't') THEN {_way(s, f'3 + {_LATE}', 'R', name + ' || text')} END" for s in states]


OP12 = f"""
WITH RECURSIVE named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
drawn AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(name, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, op: CASE WHEN op >= 0 THEN xor(c, op) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) % 20 AS fault FROM named),
damaged AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(0, CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM drawn WHERE fault <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body FROM damaged),
rows_of AS (SELECT conv_id, turn, i, role, text, left(role, 1) AS r, CASE WHEN body = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
  count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows_of GROUP BY conv_id),
scan AS (SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': ''}} AS s0, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS s1, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS s2, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS s3 FROM counts
  UNION ALL
  SELECT conv_id, i + 1, {_way("s0", "4", "D", "''")}, {_least(_way("s1", "4", "D", "''"), *_stay(("s0",), "s", ""))},
    {_least(_way("x2", "4", "D", "''"), *_stay(("s0", "s1", "x3"), "u", _USER))}, {_least(_way("x3", "4", "D", "''"), *_stay(("x2",), "a", _ASSISTANT))}
  FROM (SELECT *, {_least("s3", _way("x2", "3", "I", _ASSISTANT))} AS x3 FROM (
    SELECT c.*, w.role, w.text, w.r, w.fault, {_X2} AS x2 FROM scan c JOIN rows_of w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.i + 1))),
ends AS (SELECT conv_id, i, s0, {_least("s3", _way(_X2, "3", "I", _ASSISTANT))} AS x3 FROM scan),
best AS (SELECT c.*, {_least("s0", "x3")} AS way FROM counts c JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.i = c.n)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.c, 0)::BIGINT AS cost, coalesce(way.a, '') AS audit, sha256(coalesce(substr(way.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLES = {"op1_chat_format": OP1, "op3_mixing": OP3, "op5_substring_dedup": OP5, "op6_minhash": OP6, "op10_winnowing": OP10, "op11_warc": OP11, "op12_repair": OP12}
