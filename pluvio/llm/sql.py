"""DuckDB statements with the rows of the corpus queries."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


NEAR_DEDUP = f"""
WITH RECURSIVE w AS (SELECT doc_id, {words_of("text")} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 5 * c >= 4 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, links.b FROM r JOIN links ON r.b = links.a)
SELECT w.doc_id,
  CASE WHEN len(ws) > 0 THEN min(w.doc_id) OVER (PARTITION BY ws) ELSE w.doc_id END AS copy_of,
  k.class_id
FROM w JOIN (SELECT a, min(b) AS class_id FROM r GROUP BY a) k ON k.a = w.doc_id
"""

DECONTAMINATE = f"""
WITH w AS (SELECT doc_id, {words_of("text")} AS ws FROM documents),
b AS (SELECT item_id, {words_of("text")} AS ws FROM benchmark),
b1 AS (SELECT item_id, ws, least(13, len(ws)) AS n FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) AS g FROM b1),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, lens WHERE len(ws) >= n),
hit AS (SELECT doc_id, i, pos.n, item_id FROM pos JOIN win ON win.n = pos.n AND win.g = array_to_string(ws[i:i + pos.n - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def licenses() -> str:
    from . import licenses as lic

    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({q(s)}, {q(i)})" for s, i in sorted(lic.known_sentences().items()))
    rules = ", ".join(f"{{'licence': {q(a)}, 'ids': {q(b)}}}" for a, b in lic.all_rules())
    joined = "".join(f"UNION ALL SELECT doc_id, i, {k} AS k, array_to_string(p[i:i + {k - 1}], ' ') AS s FROM spot WHERE len(p) >= i + {k - 1}\n" for k in range(1, lic.WRAP + 1))
    return f"""
WITH RECURSIVE known(s, id) AS (VALUES {known}),
rules AS (SELECT unnest([{rules}]) AS r, generate_subscripts([{rules}], 1) AS nr),
t AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
  '[.!?;:]+([\\t\\n\\v\\f\\r ]|$)', chr(10), 'g'), '[^a-z0-9.+/\\n-]+', ' ', 'g'), '([0-9])\\.([0-9])', '\\1_\\2', 'g') AS t FROM documents),
p AS (SELECT doc_id, list_filter(list_transform(string_split(replace(translate(t, '.', ''), '_', '.'), chr(10)), lambda p: trim(p, ' +/-')), lambda p: p <> '') AS p FROM t),
spot AS (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM p),
c AS ({joined.removeprefix("UNION ALL ")}),
hit AS (SELECT doc_id, i, arg_max(id, k) AS id FROM c JOIN known USING (s) GROUP BY doc_id, i),
s AS (SELECT doc_id, string_agg('<' || id || '>', '' ORDER BY i) AS ids FROM hit GROUP BY doc_id),
run AS (
  SELECT doc_id, ids AS rest, CAST([] AS VARCHAR[]) AS got, 0 AS nr FROM s
  UNION ALL
  SELECT doc_id, replace(rest, r.ids, '|'), CASE WHEN contains(rest, r.ids) AND NOT list_contains(got, r.licence) THEN list_append(got, r.licence) ELSE got END, rules.nr
  FROM run JOIN rules ON rules.nr = run.nr + 1)
SELECT documents.doc_id, coalesce(s.ids, '') AS sentence_ids, coalesce(array_to_string(got, ','), '') AS licences, coalesce(rest, '') AS unmatched
FROM documents LEFT JOIN s USING (doc_id) LEFT JOIN (SELECT * FROM run WHERE nr = (SELECT max(nr) FROM rules)) USING (doc_id)
"""


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.v, x.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5
"""


VECTOR_DEDUP = """
WITH RECURSIVE x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
v AS (
  SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS length FROM x
  WHERE x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_inner_product(a.x, b.x) / (a.length * b.length) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM x UNION SELECT r.a, links.b FROM r JOIN links ON r.b = links.a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a) LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INTEGER) AS rank,
  s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""


def url_filter(rules: list[tuple[str, str, str]]) -> str:
    """Rules and aliases; the pages' canonical links and refresh redirects connect addresses."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    after = lambda u: f"CASE WHEN contains({u}, '://') THEN substr({u}, strpos({u}, '://') + 3) ELSE '' END"
    host = lambda u: f"translate(regexp_extract({after(u)}, '^[^/?#]*'), '{UPPER}', '{LOWER}')"
    path = lambda u: f"regexp_extract({after(u)}, '^[^/?#]*([^?#]*)', 1)"
    address = lambda u: f"CASE WHEN contains({u}, '://') THEN {host(u)} || regexp_extract({after(u)}, '^[^/?#]*([^#]*)', 1) END"
    fits = "(host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)"
    return f"""
WITH RECURSIVE rules(h, p, v) AS (VALUES {values}),
u AS (SELECT page_id, coalesce(url, '') AS url, html FROM pages),
d AS (SELECT page_id, {host("url")} AS host, {path("url")} AS path, {address("url")} AS address, url, html FROM u),
t AS (SELECT address AS source, url, unnest([
  regexp_extract(regexp_extract(html, '(?i)<link\\b[^>]*?\\brel\\s*=\\s*["'']?canonical\\b[^>]*>'), '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1),
  regexp_extract(regexp_extract(html, '(?i)<meta\\b[^>]*?\\bhttp-equiv\\s*=\\s*["'']?refresh\\b[^>]*>'), '(?i)\\burl\\s*=\\s*["'']?([^"''\\s>;]+)', 1)]) AS t
  FROM d WHERE address IS NOT NULL),
whole AS (SELECT source, regexp_extract(url, '^[^:/?#]*://[^/?#]*') AS origin, regexp_extract(url, '^[^:/?#]*:') AS scheme, {path("url")} AS page,
  regexp_replace(replace(t, '&amp;', '&'), '#.*$', '') AS t FROM t WHERE t <> ''),
absolute AS (SELECT source, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN scheme || t WHEN starts_with(t, '/') THEN origin || t
  WHEN starts_with(t, '?') THEN origin || page || t
  WHEN t <> '' THEN origin || CASE WHEN contains(page, '/') THEN regexp_extract(page, '^.*/') ELSE '/' END || t END AS url FROM whole),
e AS (SELECT DISTINCT source, {address("url")} AS target FROM absolute),
both_ways AS (SELECT source AS a, target AS b FROM e WHERE source <> target UNION SELECT target, source FROM e WHERE source <> target),
r AS (SELECT a, a AS b FROM both_ways UNION SELECT r.a, both_ways.b FROM r JOIN both_ways ON r.b = both_ways.a),
named AS (SELECT DISTINCT b AS address, {host("'x://' || b")} AS host, {path("'x://' || b")} AS path FROM r),
own AS (SELECT address, arg_max(v, (length(h || p), v = 'allow')) AS v FROM named JOIN rules ON {fits} GROUP BY address),
alias AS (SELECT r.a AS address, CASE WHEN bool_or(own.v = 'allow') THEN 'allow' ELSE 'block' END AS v FROM r JOIN own ON own.address = r.b GROUP BY r.a),
best AS (SELECT page_id, host AS h0, path AS p0, arg_max(h || p, (length(h || p), v = 'allow')) AS rule, arg_max(v, (length(h || p), v = 'allow')) AS v
  FROM d JOIN rules ON {fits} GROUP BY ALL)
SELECT d.page_id, d.host, d.path, best.rule, coalesce(best.v, alias.v, 'allow') AS verdict
FROM d LEFT JOIN best ON d.page_id = best.page_id AND d.host = best.h0 AND d.path = best.p0 LEFT JOIN alias USING (address)
"""


_COUNTED = "etaonirshdu"
LINE_DEDUP = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, n - 1 AS n, trim(line, ' ') AS line FROM (SELECT doc_id, generate_subscripts(p, 1) AS n, unnest(p) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents))),
d AS (SELECT line, min((doc_id, n)) AS first, length(line) AS size, {", ".join(f"length(line) - length(replace(line, '{c}', '')) AS n{i}" for i, c in enumerate(_COUNTED))}
  FROM l WHERE length(line) >= 20 GROUP BY line),
links AS (SELECT a.line AS a, b.line AS b FROM d a JOIN d b ON b.size BETWEEN a.size - 2 AND a.size + 2 AND a.line <> b.line
  WHERE {" + ".join(f"abs(a.n{i} - b.n{i})" for i in range(len(_COUNTED)))} <= 4 AND levenshtein(a.line, b.line) <= 2),
r AS (SELECT a, a AS b FROM links UNION SELECT r.a, links.b FROM r JOIN links ON r.b = links.a),
c AS (SELECT r.a AS line, min(d.first) AS class_first FROM r JOIN d ON d.line = r.b GROUP BY r.a),
k AS (SELECT l.doc_id, l.n, d.line IS NULL OR (l.doc_id, l.n) = coalesce(c.class_first, d.first) AS kept
  FROM l LEFT JOIN d USING (line) LEFT JOIN c USING (line))
SELECT documents.doc_id, CAST(count(*) AS BIGINT) AS n_lines, coalesce(string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) FILTER (WHERE NOT kept), '') AS dropped_lines,
  CASE WHEN bool_and(kept) THEN any_value(text) ELSE coalesce(string_agg(string_split(text, chr(10))[n + 1], chr(10) ORDER BY n) FILTER (WHERE kept), '') END AS kept_text
FROM documents JOIN k USING (doc_id) GROUP BY documents.doc_id
"""

#: With short lines: from 9 characters on by their distance, shorter ones exactly.
LINE_DEDUP_ALL = LINE_DEDUP.replace("length(line) >= 20", "length(line) >= 1").replace("a.line <> b.line", "a.line <> b.line AND a.size >= 9 AND b.size >= 9")
