"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate({text}, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, coalesce({_words("text")}, []) AS w FROM documents),
b AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
place AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, item_id, i, size FROM place JOIN win USING (size, phrase)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES = {
    "op9_decontaminate": DECONTAMINATE,
}


def _packing(max_len: int = 4096, n_buckets: int = 8, budget: int = 65536, seed: str = "pack-1") -> str:
    """Least padding with exactly b buckets, b = 1, 2, ...; fewer never help."""
    steps = ["b1 AS MATERIALIZED (SELECT j, size, rows_upto, size * rows_upto AS best, 0 AS came FROM h)"]
    for b in range(2, n_buckets + 1):
        steps.append(f"""b{b} AS MATERIALIZED (
  SELECT j, any_value(size) AS size, any_value(rows_upto) AS rows_upto, min(cost) AS best, arg_min(i, (cost, i)) AS came
  FROM (SELECT h.j, h.size, h.rows_upto, p.j AS i, p.best + h.size * (h.rows_upto - p.rows_upto) AS cost
        FROM h JOIN (SELECT j, rows_upto, best FROM b{b - 1} UNION ALL SELECT 0, 0, 0) p ON p.j < h.j)
  GROUP BY j)""")
    walk = [f"w{n_buckets} AS (SELECT max(j) AS j FROM h)"]
    for b in range(n_buckets, 1, -1):
        walk.append(f"w{b - 1} AS (SELECT came AS j FROM b{b} JOIN w{b} USING (j))")
    ends = " UNION ALL ".join(f"SELECT j FROM w{b}" for b in range(1, n_buckets + 1))
    return f"""
WITH n AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS n FROM documents),
pieces AS (
  SELECT doc_id, piece, piece * {max_len} AS start, least({max_len}, n - piece * {max_len}) AS n_tokens
  FROM (SELECT doc_id, n, unnest(range(0, (n + {max_len} - 1) // {max_len})) AS piece FROM n)),
g AS (SELECT n_tokens AS size, count(*) AS c FROM pieces GROUP BY 1),
h AS MATERIALIZED (SELECT row_number() OVER (ORDER BY size) AS j, size, (sum(c) OVER (ORDER BY size))::BIGINT AS rows_upto FROM g),
{", ".join(steps)},
{", ".join(walk)},
ends AS (SELECT size, row_number() OVER (ORDER BY size) - 1 AS bucket FROM h WHERE j IN ({ends})),
placed AS (
  SELECT p.*, (SELECT min(size) FROM ends WHERE size >= n_tokens) AS bucket_len,
    md5('{seed}-' || doc_id || '-' || piece) AS ord
  FROM pieces p),
ranked AS (SELECT *, row_number() OVER (PARTITION BY bucket_len ORDER BY ord, doc_id, piece) - 1 AS place FROM placed)
SELECT doc_id, piece::BIGINT AS piece, start::BIGINT AS start, n_tokens::BIGINT AS n_tokens, bucket::BIGINT AS bucket, bucket_len::BIGINT AS bucket_len,
  (place // greatest(1, {budget} // bucket_len))::BIGINT AS batch, (place % greatest(1, {budget} // bucket_len))::BIGINT AS slot
FROM ranked JOIN ends ON ends.size = bucket_len
"""


ORACLES["op1_packing"] = _packing()

ORACLES["op8_chat"] = """
WITH t AS (
  SELECT conv_id, turn, CASE WHEN coalesce(role, '') IN ('', 'system') THEN 'system' ELSE role END AS role,
    replace(coalesce(text, ''), '<|', '< |') AS body, text, 0::BIGINT AS part
  FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS assistant, regexp_replace(role, '[\\s<>|#]+', '_', 'g') AS plain FROM t WHERE role <> 'system'),
q AS (SELECT conv_id, assistant AS role, plain || CASE WHEN k > 1 THEN '#' || k ELSE '' END AS name
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, plain ORDER BY assistant) AS k FROM p)),
s AS (
  SELECT t.conv_id, assistant, part, turn, t.role, text, body, t.role = assistant AS mine,
    CASE WHEN t.role = 'system' THEN '<|im_start|>system' WHEN t.role = assistant THEN '<|im_start|>assistant'
      ELSE '<|im_start|>user name=' || name END || chr(10) AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id LEFT JOIN q ON t.conv_id IS NOT DISTINCT FROM q.conv_id AND t.role = q.role),
o AS (
  SELECT *, row_number() OVER w AS n,
    sum(length(head) + length(body) + length('<|im_end|>') + 1) OVER w - length(body) - length('<|im_end|>') - 1 AS at_body
  FROM s WINDOW w AS (PARTITION BY conv_id, assistant, part ORDER BY turn NULLS FIRST, role, text NULLS FIRST ROWS UNBOUNDED PRECEDING))
SELECT conv_id, assistant, part, count(*) AS n_turns, count(*) FILTER (WHERE mine) AS n_trained,
  string_agg(head || body || '<|im_end|>' || chr(10), '' ORDER BY n) AS rendered,
  string_agg(mine::INT::VARCHAR, '' ORDER BY n) AS mask,
  coalesce(string_agg(at_body::BIGINT || '-' || (at_body + length(body))::BIGINT, ',' ORDER BY n) FILTER (WHERE mine), '') AS spans
FROM o GROUP BY conv_id, assistant, part
"""


def _split(text: str, pattern: str, kind: str) -> str:
    return f"[ '{kind}:' || regexp_replace(w, '[0-9]+', '#', 'g') FOR w IN string_split_regex({text}, '{pattern}') IF w <> '']"


def _url_rules(min_support: float = 0.005, min_pages: int = 5, min_confidence: float = 0.6) -> str:
    rest = "regexp_extract(lower(url), '(?s)^.*?://[^/?#]*(.*)$', 1)"
    return f"""
WITH RECURSIVE p AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
t AS (
  SELECT url, list_sort(list_distinct(flatten([
    {_split("regexp_extract(lower(url), '(?s)^(.*?)://', 1)", "://", "scheme")},
    {_split("host", "[.]", "host")},
    {_split(f"regexp_extract({rest}, '(?s)^([^?#]*)', 1)", "[/.]+", "path")},
    {_split(f"regexp_extract({rest}, '(?s)^[^?#]*[?]([^#]*)', 1)", "&", "query")},
    {_split(f"regexp_extract({rest}, '(?s)#(.*)$', 1)", "#", "part")}]))) AS tokens
  FROM (SELECT DISTINCT url, host FROM p WHERE url LIKE '%://%')),
marked AS (SELECT doc_id AS page_id, max(coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0) AS blocked FROM labels GROUP BY 1),
baskets AS (SELECT row_number() OVER () AS n, tokens, blocked FROM p JOIN t USING (url) JOIN marked USING (page_id) WHERE len(tokens) > 0),
least_count AS (SELECT greatest(ceil({min_support} * count(*)), {min_pages}) AS least FROM baskets),
e AS (SELECT n, blocked, unnest(tokens) AS a FROM baskets),
sets AS (
  SELECT n, blocked, [a] AS tokens, a AS last FROM e
  WHERE a IN (SELECT a FROM e GROUP BY a HAVING count(*) FILTER (WHERE blocked) >= (SELECT least FROM least_count))
  UNION ALL
  SELECT n, blocked, tokens, last FROM (
    SELECT s.n, s.blocked, list_append(s.tokens, e.a) AS tokens, e.a AS last,
      count(*) FILTER (WHERE s.blocked) OVER (PARTITION BY list_append(s.tokens, e.a)) AS c
    FROM sets s JOIN e ON s.n = e.n AND e.a > s.last)
  WHERE c >= (SELECT least FROM least_count)),
rules AS (
  SELECT tokens, count(*) FILTER (WHERE blocked) AS support, count(*) FILTER (WHERE blocked)::DOUBLE / count(*) AS confidence
  FROM sets GROUP BY tokens HAVING count(*) FILTER (WHERE blocked)::DOUBLE / count(*) >= {min_confidence}),
best AS (
  SELECT url, array_to_string(r.tokens, ' ') AS learnt, confidence,
    row_number() OVER (PARTITION BY url ORDER BY confidence DESC, support DESC, len(r.tokens), array_to_string(r.tokens, ' ')) AS n
  FROM t JOIN rules r ON list_has_all(t.tokens, r.tokens)),
fit AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN learnt IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  learnt, confidence
FROM fit LEFT JOIN (SELECT * FROM best WHERE n = 1) b USING (url)
"""


ORACLES["op5_urlrules"] = _url_rules()


def _licenses(threshold: float = 0.8) -> str:
    from .licenses import TEMPLATES

    rows = ", ".join(f"({n}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for n, (name, text) in enumerate(TEMPLATES))
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH tpl AS MATERIALIZED (SELECT n, name, {grams} AS g FROM (SELECT n, name, {_words("text")} AS w FROM (VALUES {rows}) v(n, name, text))),
par AS (SELECT doc_id, text, string_split_regex(text, '\\n[ \\t\\r]*\\n\\s*') AS parts FROM documents),
unit AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS u FROM documents
  UNION ALL SELECT doc_id, u FROM (SELECT doc_id, unnest(parts) AS u FROM par) WHERE contains(u, chr(10))
  UNION ALL SELECT doc_id, text FROM par WHERE len(parts) > 1),
numbered AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, {grams} AS g FROM (SELECT doc_id, {_words("u")} AS w FROM unit) WHERE len(w) > 1),
ug AS (SELECT k, unnest(g) AS x FROM numbered),
tg AS (SELECT n, unnest(g) AS x FROM tpl),
shared AS (SELECT k, n, count(*) AS c FROM ug JOIN tg USING (x) GROUP BY k, n),
scored AS (
  SELECT k, doc_id, name, (2 * c)::DOUBLE / (len(numbered.g) + len(tpl.g)) AS dice
  FROM shared JOIN numbered USING (k) JOIN tpl USING (n)),
hit AS (
  SELECT k, doc_id, name, dice, row_number() OVER (PARTITION BY k ORDER BY dice DESC, name) AS r
  FROM scored WHERE dice >= {threshold}),
best AS (
  SELECT doc_id, arg_min(name, (-dice, name)) AS licence, max(dice) AS dice, count(*) AS n_units, array_to_string(list_sort(list(DISTINCT name)), ',') AS licences
  FROM hit WHERE r = 1 GROUP BY doc_id)
SELECT doc_id, licence, dice, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(licences, '') AS licences FROM documents LEFT JOIN best USING (doc_id)
"""


ORACLES["op10_licenses"] = _licenses()


def _vector_codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Lloyd's rounds written out; entries as lists by part and index."""
    near = """{name} AS MATERIALIZED (
  SELECT vec_id, any_value(label) AS label, p, any_value(x.v) AS v, arg_min(k, (d, k)) AS k, min(d) AS d
  FROM (SELECT x.id, x.vec_id, x.label, x.p, x.v, b.k, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM x JOIN {book} b ON x.p = b.p) x GROUP BY id, vec_id, p)"""
    steps = []
    for r in range(rounds):
        steps.append(near.format(name=f"a{r}", book=f"b{r}"))
        steps.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT p, k, coalesce(n.v, o.v) AS v FROM b{r} o LEFT JOIN (
    SELECT p, k, list(floor_mean ORDER BY i) AS v FROM (
      SELECT p, k, i, (sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean
      FROM (SELECT p, k, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS c FROM a{r}) GROUP BY p, k, i) GROUP BY p, k) n USING (p, k))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (
  SELECT id, vec_id, label, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS v
  FROM (SELECT *, unnest(range(0, {parts})) AS p FROM kept)),
b0 AS (SELECT p, id - 1 AS k, v FROM x WHERE id <= {entries}),
{", ".join(steps)},
{near.format(name="final", book=f"b{rounds}").replace("SELECT vec_id,", "SELECT id, vec_id,", 1)},
digest AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, k, i)) AS h FROM (SELECT p, k, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS c FROM b{rounds})),
coded AS (SELECT id, vec_id, any_value(label) AS label, string_agg(printf('%02x', k), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM final GROUP BY id, vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT h FROM digest) AS codebooks_sha256 FROM coded
"""


ORACLES["op11_vectorcodes"] = _vector_codes()

ORACLES["op12_suffixdedup"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, doc_id, i, array_slice(b, i + 1, i + 50) AS s FROM (SELECT r, doc_id, b, unnest(range(0, octet_length(b) - 49)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT r, i FROM w JOIN f USING (s) WHERE doc_id > least),
run AS (SELECT r, i, i - lag(i, 1, -100) OVER (PARTITION BY r ORDER BY i) > 50 AS new FROM hit),
span AS (SELECT r, min(i) AS a, max(i) + 50 AS z FROM (SELECT r, i, sum(new::INT) OVER (PARTITION BY r ORDER BY i) AS g FROM run) GROUP BY r, g),
gap AS (
  SELECT r, a, z, lag(z, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM span
  UNION ALL SELECT r, octet_length(b), NULL, coalesce(m, 0) FROM d LEFT JOIN (SELECT r, max(z) AS m FROM span GROUP BY r) USING (r)),
part AS (SELECT r, string_agg(hex(array_slice(b, before + 1, a)), '' ORDER BY a, z NULLS LAST) AS kept FROM gap JOIN d USING (r) GROUP BY r),
n AS (SELECT r, count(*) AS n_spans FROM span GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, (octet_length(b) - length(kept) // 2)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(kept)) AS kept_sha256
FROM d JOIN part USING (r) LEFT JOIN n USING (r)
"""
