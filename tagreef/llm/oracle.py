"""SQL twins of the operators that SQL can express, for DuckDB."""

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# What a word is, in the two senses of the contracts.
PLAIN = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
ALNUM = r"regexp_extract_all(coalesce({}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SUBSTRING_DEDUP = f"""WITH docs AS MATERIALIZED (SELECT doc_id, {PLAIN.format('text')} AS words FROM documents),
 starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM docs WHERE len(words) >= 20),
 later AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(words[i:i+19], ' ') ORDER BY doc_id, i) > 1 AS gone
     FROM starts),
 places AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
 marked AS (SELECT p.doc_id, p.i, word, coalesce(max(CASE WHEN gone THEN p.i END) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) > 0 AS removed
     FROM places AS p LEFT JOIN later AS l ON p.doc_id = l.doc_id AND p.i = l.i),
 kept AS (SELECT doc_id, count(*) FILTER (removed) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS t FROM marked GROUP BY doc_id)
 SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
 FROM docs AS d LEFT JOIN kept AS k ON d.doc_id = k.doc_id"""

NEAR_DUPLICATES = f"""WITH RECURSIVE docs AS MATERIALIZED (SELECT doc_id, {PLAIN.format(LOWERED.format('text'))} AS words FROM documents),
 sets AS MATERIALIZED (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(words) - 1, 2)), lambda k: array_to_string(words[k:k+2], ' '))) AS s
     FROM docs WHERE len(words) > 0),
 shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
 links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM shingles AS a JOIN shingles AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
     GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
 reach(doc_id, other) AS (SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, l.b FROM reach AS r JOIN links AS l ON r.other = l.a),
 least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
 SELECT d.doc_id, CAST(coalesce(len(s), 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
 FROM docs AS d JOIN least AS c ON d.doc_id = c.doc_id LEFT JOIN sets AS s ON d.doc_id = s.doc_id"""

DECONTAMINATION = f"""WITH docs AS MATERIALIZED (SELECT doc_id, {ALNUM.format(LOWERED.format('text'))} AS words FROM documents),
 items AS (SELECT item_id, {ALNUM.format(LOWERED.format('text'))} AS words FROM benchmark),
 grams AS MATERIALIZED (SELECT item_id, n, unnest(list_transform(range(1, len(words) - n + 2), lambda k: array_to_string(words[k:k + n - 1], ' '))) AS gram
     FROM (SELECT item_id, words, least(13, len(words)) AS n FROM items WHERE len(words) > 0) AS i),
 lengths AS (SELECT DISTINCT n FROM grams),
 starts AS (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, lengths WHERE len(words) >= n),
 hits AS MATERIALIZED (SELECT doc_id, i, s.n, item_id FROM starts AS s JOIN grams AS g ON s.n = g.n AND array_to_string(words[i:i + s.n - 1], ' ') = gram),
 hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) AS h GROUP BY doc_id),
 named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) AS h GROUP BY doc_id)
 SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
   sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
 FROM docs AS d LEFT JOIN hit AS h ON d.doc_id = h.doc_id LEFT JOIN named AS n ON d.doc_id = n.doc_id"""

NEAR_VECTORS = """WITH RECURSIVE vectors AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
 good AS MATERIALIZED (SELECT * FROM vectors WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
     AND len(list_filter(v, lambda x: x <> 0)) > 0),
 links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM good AS a JOIN good AS b ON a.label = b.label AND a.vec_id <> b.vec_id
     WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
 reach(vec_id, other) AS (SELECT vec_id, vec_id FROM vectors UNION SELECT r.vec_id, l.b FROM reach AS r JOIN links AS l ON r.other = l.a),
 least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
 SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM least"""

#: CRC-32 of a text's bytes, by its defining shifts.
CRC32 = """xor(list_reduce(list_concat([4294967295], list_transform(range(1, len({0}) + 1), lambda k: CAST(ascii(substr({0}, k, 1)) AS BIGINT))),
     lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
     lambda c, step: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


def _field(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf(*columns: str) -> str:
    return f"sha256({' || '.join(map(_field, columns))})"


MANIFEST = f"""WITH RECURSIVE leaves AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS name,
     {_leaf('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf,
     CASE WHEN {CRC32.format('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf('doc_id', 'source', 'lang', '(n_chars + 1)', 'text')} END AS changed FROM documents),
 placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id, leaf) - 1 AS spot, count(*) OVER (PARTITION BY name) AS n FROM leaves),
 nodes(name, level, spot, n, digest) AS (SELECT name, 0, spot, n, leaf FROM placed
     UNION ALL SELECT name, level + 1, spot // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY spot)) FROM nodes WHERE n > 1
     GROUP BY name, level, spot // 2, (n + 1) // 2),
 subroots AS MATERIALIZED (SELECT name, digest, row_number() OVER (ORDER BY encode(name)) - 1 AS spot, count(*) OVER () AS n FROM nodes WHERE n = 1),
 crown(level, spot, n, digest) AS (SELECT 0, spot, n, digest FROM subroots
     UNION ALL SELECT level + 1, spot // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY spot)) FROM crown WHERE n > 1
     GROUP BY level, spot // 2, (n + 1) // 2),
 low AS MATERIALIZED (SELECT * FROM nodes), high AS MATERIALIZED (SELECT * FROM crown),
 climbs(doc_id, name, leaf, level, spot, n, digest, proof) AS (SELECT doc_id, name, leaf, 0, spot, n, coalesce(changed, leaf), '' FROM placed
     UNION ALL SELECT c.doc_id, c.name, c.leaf, c.level + 1, c.spot // 2, (c.n + 1) // 2,
       sha256(CASE WHEN c.spot % 2 = 1 THEN coalesce(o.digest, '') || c.digest ELSE c.digest || coalesce(o.digest, '') END), c.proof || coalesce(o.digest, '')
     FROM climbs AS c LEFT JOIN low AS o ON o.name = c.name AND o.level = c.level AND o.spot = xor(c.spot, 1) WHERE c.n > 1),
 ends(doc_id, leaf, subroot, level, spot, n, digest, proof) AS (SELECT doc_id, leaf, s.digest, 0, s.spot, s.n, c.digest, proof FROM climbs AS c JOIN subroots AS s ON c.name = s.name WHERE c.n = 1
     UNION ALL SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.spot // 2, (c.n + 1) // 2,
       sha256(CASE WHEN c.spot % 2 = 1 THEN coalesce(o.digest, '') || c.digest ELSE c.digest || coalesce(o.digest, '') END), c.proof || coalesce(o.digest, '')
     FROM ends AS c LEFT JOIN high AS o ON o.level = c.level AND o.spot = xor(c.spot, 1) WHERE c.n > 1)
 SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, e.digest AS folded_root, e.digest = r.digest AS verified
 FROM ends AS e, (SELECT digest FROM crown WHERE n = 1) AS r WHERE e.n = 1"""

HARD_NEGATIVES = """WITH valid AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
     list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
     WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 scored AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
     FROM valid AS a JOIN valid AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
 positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
     row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same),
 ranked AS (SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
     vec_id AS negative_id, positive_score, score AS negative_score
     FROM positives AS p JOIN scored AS s ON p.anchor_id = s.anchor_id AND NOT same AND place <= 5
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
 SELECT * FROM ranked WHERE rank <= 3"""
