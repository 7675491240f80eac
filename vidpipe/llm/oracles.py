"""DuckDB SQL that gives the rows of some registered queries by plain means."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _numbered(table: str, key: str, text: str, pattern: str) -> str:
    """A query for (key, i, word), i from 1."""
    return f"""SELECT {key}, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT {key}, regexp_extract_all({text}, '{pattern}') AS w FROM {table})"""


_SPACED = r"[^\x20\x09-\x0D]+"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

DECONTAMINATION = f"""
WITH d AS ({_numbered('documents', 'doc_id', _FOLDED, _PLAIN)}),
b AS ({_numbered('benchmark', 'item_id', _FOLDED, _PLAIN)}),
bn AS (SELECT item_id, i, list(word) OVER (PARTITION BY item_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l, count(*) OVER (PARTITION BY item_id) AS n FROM b),
win AS (SELECT DISTINCT item_id, array_to_string(l, ' ') AS g, len(l) AS n FROM bn WHERE len(l) = 10 OR (i = 1 AND n < 10)),
sizes AS (SELECT DISTINCT n FROM win),
dn AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM d),
hits AS (SELECT doc_id, i, win.n, item_id FROM (SELECT doc_id, i, n, array_to_string(list_slice(l, 1, n), ' ') AS g FROM dn, sizes WHERE len(l) >= n) x JOIN win USING (g)),
covered AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id),
sized AS (SELECT doc_id, count(*) AS n_words FROM d GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents LEFT JOIN sized USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

_ESCAPED = r"length(regexp_replace({}, '[\\\[\]<]', 'xx', 'g'))"

CHAT = f"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
s AS (SELECT *, 5 + 2 * {_ESCAPED.format('role')} + {_ESCAPED.format('text')} + CASE WHEN role = 'assistant' THEN 4 ELSE 0 END AS size FROM c),
f AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS upto, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS last FROM s)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR last THEN upto END) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id"""

NEAR_DEDUP = f"""
WITH d AS ({_numbered('documents', 'doc_id', _FOLDED, _SPACED)}),
l AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS l FROM d),
g AS (SELECT DISTINCT doc_id, array_to_string(l, ' ') AS g FROM l WHERE len(l) = 4 OR i = 1),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (WITH RECURSIVE r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, w.b FROM r JOIN both_ways w ON r.b = w.a) SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM documents JOIN r USING (doc_id) LEFT JOIN n USING (doc_id)"""

SUBSTRING_DEDUP = f"""
WITH d AS ({_numbered('documents', 'doc_id', "coalesce(text, '')", _SPACED)}),
l AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS l FROM d),
w AS (SELECT doc_id, i, array_to_string(l, ' ') AS g FROM l WHERE len(l) = 13),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM w) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i, true AS gone FROM f),
k AS (SELECT doc_id, count(*) AS n_words, count(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone IS NULL) AS kept FROM d LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN k USING (doc_id)"""

URL_FILTER = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT page_id, host, path, h || r.p AS rule, coalesce(v, 'allow') AS verdict
FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r.p)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || r.p) DESC) = 1"""


EMBEDDINGS = """
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b USING (label) WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (WITH RECURSIVE r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN r USING (vec_id) LEFT JOIN n USING (vec_id)"""
