"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from moodloom.llm.queries import SHARDS, TABLE_SIZE

URL_FILTER = r"""
WITH p AS (
  SELECT page_id, url,
    CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, url,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
c AS (
  SELECT *,
    regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
      || regexp_replace(regexp_replace(path, '\.html?$', ''), '/+$', '') AS stem,
    list_sort(list_filter(string_split(coalesce(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), ''), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))) AS kept
  FROM h),
k AS (
  SELECT page_id, host, path,
    CASE WHEN host <> '' THEN stem || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS key
  FROM c),
listed AS (
  SELECT DISTINCT key FROM k
  WHERE key IS NOT NULL AND page_id IN (SELECT doc_id FROM labels WHERE toxic = 1)),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM k),
l AS (SELECT r.*, rule IS NULL AND listed.key IS NOT NULL AS listed FROM r LEFT JOIN listed USING (key))
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM l
"""

_NAMES = ", ".join(f"({i}, '{name}')" for i, name in enumerate(SHARDS))


def _hash(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


SHARDING = f"""
WITH RECURSIVE names(i, name) AS (VALUES {_NAMES}),
orders AS (
  SELECT i, {_hash("'offset:' || name")} % {TABLE_SIZE} AS first, {_hash("'skip:' || name")} % ({TABLE_SIZE} - 1) + 1 AS skip
  FROM names),
prefs AS (SELECT i, list_transform(range({TABLE_SIZE}), lambda j: (first + j * skip) % {TABLE_SIZE}) AS pref FROM orders),
turns(n, slot, shard, taken) AS (
  SELECT 0, CAST(-1 AS BIGINT), -1, CAST(repeat('0', {TABLE_SIZE}) AS BIT)
  UNION ALL
  SELECT n + 1, s, i, set_bit(taken, CAST(s AS INTEGER), 1) FROM (
    SELECT n, i, taken, list_filter(pref, lambda x: get_bit(taken, CAST(x AS INTEGER)) = 0)[1] AS s
    FROM turns JOIN prefs ON i = n % {len(SHARDS)} WHERE n < {TABLE_SIZE}))
SELECT doc_id, CAST(t.slot AS INTEGER) AS slot, name AS shard
FROM documents
JOIN turns t ON t.slot = {_hash("coalesce(CAST(doc_id AS VARCHAR), '')")} % {TABLE_SIZE} AND t.n > 0
JOIN names ON names.i = t.shard
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM grams JOIN windows USING (n, gram)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

JACCARD = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM o JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * o >= 80 * (na.n + nb.n - o)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY 1) USING (doc_id)
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1),
m AS (SELECT a AS vec_id, min(b) AS m FROM reach GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
  vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN m USING (vec_id)
"""

# crc32 is not among DuckDB's functions: the usual table of 256 steps, and a fold over the bytes.
_CRC_STEPS = """
steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8)"""


def _crc32(text: str) -> str:
    """Of the UTF-8 bytes; t is the table of steps."""
    hexes = f"hex(encode({text}))"
    byte = f"CAST('0x' || substr({hexes}, 2 * j + 1, 2) AS BIGINT)"
    bytes_ = f"list_transform(range(CAST(length({hexes}) // 2 AS BIGINT)), lambda j: {byte})"
    fold = f"list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), lambda a, b: xor(a >> 8, t[xor(a, b) & 255 + 1]))"
    return f"xor({fold}, CAST(4294967295 AS BIGINT))".replace("& 255 + 1", "% 256 + 1")


RESAMPLING = f"""
WITH RECURSIVE {_CRC_STEPS},
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, unnest(w) AS w FROM d),
bw AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
buckets AS (
  SELECT w, {_crc32("w")} % 10000 AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN buckets USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN buckets USING (w) GROUP BY 1),
totals AS (SELECT (SELECT count(*) FROM dw) AS all_s, (SELECT count(*) FROM bw) AS all_t),
gains AS (
  SELECT w, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (all_s + 10000)
    / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM buckets LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), totals),
weights AS (SELECT doc_id, sum(gain) AS weight FROM dw JOIN gains USING (w) GROUP BY 1),
scored AS (
  SELECT doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN weights USING (doc_id)),
final AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM final WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM final LEFT JOIN ranked USING (doc_id)
"""

_RUNS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[A-Za-z\u00C0-\u00FF]+')"
)
SPELLING_VARIANTS = f"""
WITH RECURSIVE {_CRC_STEPS},
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest({_RUNS}) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32("doc_id || ':' || run")} AS h FROM runs, crc WHERE length(run) >= 6),
noisy AS (
  SELECT CASE WHEN h % 199 = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM noisy WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
gaps AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT x.word AS a, y.word AS b, y.n AS n_b FROM gaps x JOIN gaps y USING (i, head, tail) WHERE x.word <> y.word
  UNION
  SELECT x.word, y.word, y.n FROM gaps x JOIN words y ON x.head || x.tail = y.word
  UNION
  SELECT y.word, x.word, x.n FROM gaps x JOIN words y ON x.head || x.tail = y.word),
best AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY n_b DESC, encode(b)) AS b, max(n_b) AS n_b FROM pairs GROUP BY 1),
v AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN n_b >= 5 * n THEN b END AS form,
    CASE WHEN n_b >= 5 * n THEN n_b END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root, form AS next FROM v
  UNION ALL
  SELECT walk.word, v.word, v.form FROM walk JOIN v ON walk.next = v.word)
SELECT word, form, root, n, n_near, form_n FROM v JOIN (SELECT word, root FROM walk WHERE next IS NULL) USING (word)
"""

ORACLES = {
    "op4_url_filter": URL_FILTER,
    "op5_sharding": SHARDING,
    "op6_jaccard_join": JACCARD,
    "op7_embedding_dedup": EMBEDDINGS,
    "op8_decontaminate": DECONTAMINATE,
    "op11_importance_resampling": RESAMPLING,
    "op13_spelling_variants": SPELLING_VARIANTS,
}
