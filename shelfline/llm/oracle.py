"""DuckDB SQL of the training-data queries that SQL can express.

Each statement works over the whole tables by a plain path of its own: all pairs where
the operator prunes, one window where it numbers runs, shared shingles where it meets
bands.  The scans and classifiers (2, 3, 7, 9, 10) and so the pipeline have none: message
passing, decompression and compressed sizes are beyond SQL.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

#: Words between blanks, and the first 52 bits of MD5 as a number.
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_HASH = "('0x' || substr(md5({key}), 1, 13))::BIGINT"
_DRAW = "((" + _HASH + " + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"

#: Smallest node reachable over links (a, b) listed both ways; a path from the smallest node
#: of a component only meets larger ones, so smaller ends need no following.
_REACH = """
reach AS (
    SELECT a AS node, a AS root FROM links
    UNION
    SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node WHERE l.b > r.root),
component AS (SELECT node, min(root) AS root FROM reach GROUP BY node)"""

ORACLE["op1_embedding_near_dedup"] = f"""
WITH RECURSIVE vectors AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
good AS (
    SELECT vec_id, v FROM vectors
    WHERE vec_id IS NOT NULL AND len(v) > 0
      AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
degree AS (SELECT a, count(DISTINCT b) AS n FROM links GROUP BY a),{_REACH}
SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, coalesce(c.root, v.vec_id) AS component_id,
       v.vec_id = coalesce(c.root, v.vec_id) AS kept
FROM vectors v LEFT JOIN degree d ON d.a = v.vec_id LEFT JOIN component c ON c.node = v.vec_id
"""

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op8_b_bit_minhash"] = f"""
WITH RECURSIVE worded AS (SELECT doc_id, coalesce({_WORDS.format(text=_LOWERED)}, []) AS w FROM documents),
listed AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
    FROM worded),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM listed WHERE doc_id IS NOT NULL),
pairs AS (
    SELECT x.doc_id AS p, y.doc_id AS q FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
    GROUP BY x.doc_id, y.doc_id
    HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
links AS (SELECT p AS a, q AS b FROM pairs UNION ALL SELECT q, p FROM pairs),{_REACH}
SELECT t.doc_id, len(t.s)::BIGINT AS n_shingles, coalesce(c.root, t.doc_id) AS component_id,
       coalesce(t.doc_id = coalesce(c.root, t.doc_id), true) AS kept
FROM listed t LEFT JOIN component c ON c.node = t.doc_id
"""

ORACLE["op5_systematic_mix"] = f"""
WITH sized AS (
    SELECT doc_id, source, coalesce('=' || source, 'null') AS src, coalesce(len({_WORDS.format(text="text")}), 0) AS size,
           {_HASH.format(key="'mix|' || coalesce(doc_id::VARCHAR, 'null')")} AS h FROM documents),
fine AS (SELECT 64 * pow(2, greatest(0, ceil(log2(greatest(count(*), 1) / 128000000))))::BIGINT AS cells FROM sized),
placed AS (
    SELECT *, length(bin(size)) * 8 + ((size >> greatest(length(bin(size)) - 4, 0)) & 7) AS band, h % cells AS cell
    FROM sized, fine),
ranked AS (
    SELECT doc_id, src, size,
           row_number() OVER (PARTITION BY src ORDER BY band, cell, size, doc_id NULLS LAST) - 1 AS k FROM placed),
sources AS (SELECT source, src, sum(size)::DOUBLE AS total FROM sized GROUP BY source, src),
weighed AS (
    SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM sources),
steps AS (
    SELECT *, 2 * total / weight AS stop,
           (1.5::DOUBLE * sum(total) OVER () - coalesce(sum(2 * total) OVER earlier, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
    FROM weighed WINDOW earlier AS (ORDER BY 2 * total / weight, source NULLS LAST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT arg_min(level, stop) AS level FROM steps WHERE stop >= level),
targets AS (
    SELECT src, total, least(2 * total, weight * final.level) AS target,
           {_DRAW.format(key="'mix|offset|' || src")} AS start FROM steps, final),
rated AS (SELECT *, CASE WHEN total > 0 THEN target / total ELSE 0 END AS rate FROM targets)
SELECT r.doc_id, r.size::BIGINT AS size, t.total::BIGINT AS source_size, t.target,
       ((floor(start + rate * (k + 1)) - floor(start + rate * k)) * r.size)::BIGINT AS taken
FROM ranked r JOIN rated t ON t.src = r.src
"""

#: The tree of ``sharding.fleet``: regions of four racks of two shards, an added shard alone.
ORACLE["op4_hash_tree_shards"] = f"""
WITH RECURSIVE bits AS (
    SELECT i, i AS c, 0 AS step FROM range(256) t(i)
    UNION ALL
    SELECT i, xor(c >> 1, (c & 1) * 3988292384), step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
docs AS (
    SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS key, coalesce(strlen(text), 0) + 8 AS size,
           xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                          lambda x: ('0x' || x)::BIGINT),
                           lambda a, x: xor(a >> 8, crc.t[(xor(a, x) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
    FROM documents, crc),
leaves AS (
    SELECT s, CASE WHEN s < 24 THEN '/r' || (s // 8 * 8) ELSE '/r' || s END AS region,
           CASE WHEN s < 24 THEN '/k' || (s % 8 // 2 * 2) ELSE '/k0' END AS rack FROM range(25) t(s)),
keys AS (SELECT DISTINCT key, fleet FROM docs, (VALUES (24), (25)) f(fleet)),
regions AS (
    SELECT key, fleet, arg_min(region, -ln({_DRAW.format(key="region || '|' || key")}) / weight) AS region
    FROM keys JOIN (SELECT region, count(*)::DOUBLE AS weight, min(s) AS least FROM leaves GROUP BY region) ON least < fleet
    GROUP BY key, fleet),
racks AS (
    SELECT key, fleet, region, arg_min(rack, -ln({_DRAW.format(key="region || rack || '|' || key")}) / weight) AS rack
    FROM regions JOIN (SELECT region, rack, count(*)::DOUBLE AS weight FROM leaves GROUP BY region, rack) USING (region)
    GROUP BY key, fleet, region),
homes AS (
    SELECT key, fleet, arg_min(s, -ln({_DRAW.format(key="region || rack || '/s' || s || '|' || key")})) AS s
    FROM racks JOIN leaves USING (region, rack) GROUP BY key, fleet),
placed AS (
    SELECT d.*, a.s AS shard, b.s AS grown, {_HASH.format(key="'slot|' || d.key")} AS h,
           4 * pow(2, greatest(0, ceil(log2((SELECT greatest(count(*), 1) FROM docs) / 307200000))))::BIGINT AS cells
    FROM docs d JOIN homes a ON a.key = d.key AND a.fleet = 24 JOIN homes b ON b.key = d.key AND b.fleet = 25)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY h % 16, h // 16 % cells, doc_id NULLS LAST, text_crc32, size) - 1 AS slot,
       grown::INTEGER AS grown_shard
FROM placed
"""

_TOKENS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[\x09-\x0D\x20[:punct:]]+'), lambda x: x <> '')"


def _seed(tokens: str, at: str, mask: str) -> str:
    """The six tokens that a mask reads from the window at a 0-based place, joined."""
    masks = "[[0, 1, 3, 4, 7, 9], [0, 2, 4, 5, 8, 9], [0, 1, 2, 5, 7, 9]]"
    return f"{mask} || array_to_string(list_transform({masks}[{mask} + 1], lambda o: {tokens}[{at} + o + 1]), ' ')"


ORACLE["op6_spaced_seed_decontamination"] = f"""
WITH docs AS (SELECT doc_id, {_TOKENS} AS d FROM documents),
items AS (SELECT row_number() OVER () AS item_key, item_id, {_TOKENS} AS i FROM benchmark),
doc_places AS (SELECT doc_id, d, unnest(range(0, len(d) - 9)) AS p FROM docs),
item_places AS (SELECT item_key, i, unnest(range(0, len(i) - 9)) AS q FROM items),
hits AS (
    SELECT DISTINCT x.doc_id, y.item_key, x.p, y.q
    FROM (SELECT doc_id, p, {_seed("d", "p", "(p % 3)")} AS seed FROM doc_places) x
    JOIN (SELECT item_key, q, {_seed("i", "q", "m")} AS seed FROM item_places, range(3) t(m)) y USING (seed)),
beside AS (
    SELECT h.doc_id, item_id, p, p - q AS shift, d, i, least(16, len(i)) AS w,
           greatest(0, q - p, q + 10 - least(16, len(i))) AS lo,
           least(q, len(i) - least(16, len(i)), len(d) - (p - q) - least(16, len(i))) AS hi
    FROM hits h JOIN docs ON docs.doc_id IS NOT DISTINCT FROM h.doc_id JOIN items USING (item_key)),
scored AS (
    SELECT doc_id, item_id, p, w, list_max(list_transform(range(lo, hi + 1), lambda s:
        len(list_filter(range(s, s + w), lambda k: d[k + shift + 1] = i[k + 1])))) AS agree
    FROM beside WHERE lo <= hi)
SELECT doc_id, item_id, count(*) AS n_hits, max(agree)::INTEGER AS agree, max(w)::INTEGER AS span, min(p)::INTEGER AS doc_token
FROM scored WHERE agree >= ceil(w * 0.75) GROUP BY doc_id, item_id
"""

ORACLE["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
f1 AS (SELECT lang, w[i] AS a, count(*) AS f FROM places GROUP BY ALL),
f2 AS (SELECT lang, w[i] AS a, w[i + 1] AS b, count(*) AS f FROM places WHERE i < len(w) GROUP BY ALL),
f3 AS (SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, count(*) AS f FROM places WHERE i + 1 < len(w)
       GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
longer AS (SELECT lang, a, b, max(f) AS f
           FROM (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY lang, a, b),
cuts AS (
    SELECT p.lang, p.a || ' ' || p.b AS phrase, p.f AS a, 1 AS k, x.f AS l, y.f AS r
    FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.a = p.a JOIN f1 y ON y.lang = p.lang AND y.a = p.b
    LEFT JOIN longer g ON g.lang = p.lang AND g.a = p.a AND g.b = p.b
    WHERE p.f >= 10 AND (g.f IS NULL OR 100 * g.f < 50 * p.f)
    UNION ALL
    SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, 1, x.f, y.f
    FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.a = t.a JOIN f2 y ON y.lang = t.lang AND y.a = t.b AND y.b = t.c
    UNION ALL
    SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, 2, x.f, y.f
    FROM f3 t JOIN f2 x ON x.lang = t.lang AND x.a = t.a AND x.b = t.b JOIN f1 y ON y.lang = t.lang AND y.a = t.c),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
