"""DuckDB SQL of the operators that SQL can express, written independently of the Spark code."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

#: Components of a links(a, b) table: the smallest id each id reaches.
_REACH = """
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""

NGRAM_JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM words),
tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
both_have AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM tokens x JOIN tokens y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT c.a, c.b FROM both_have c JOIN sets x ON x.doc_id = c.a JOIN sets y ON y.doc_id = c.b
          WHERE 100 * c.n >= 75 * (len(x.s) + len(y.s) - c.n)),{_REACH}
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.b, s.doc_id)) AS component_id
FROM sets s LEFT JOIN low l ON l.a = s.doc_id"""

EARLIER_WORDS = f"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
low AS (SELECT t, min(doc_id) AS d FROM windows GROUP BY t HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM (SELECT x.doc_id, x.i FROM windows x JOIN low ON low.t = x.t AND low.d < x.doc_id)),
places AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (SELECT q.doc_id, string_agg(q.x, ' ' ORDER BY q.p) AS s, count(*) AS n
         FROM places q ANTI JOIN gone g ON g.doc_id = q.doc_id AND g.p = q.p GROUP BY q.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.s, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id"""

EMBEDDINGS = f"""
WITH RECURSIVE ok AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
          WHERE list_cosine_similarity(a.v, b.v) >= 0.93),{_REACH},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
found AS (SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id
          FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN low l ON l.a = e.vec_id)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM found"""

#: Base32 of a SHA-1: five hexadecimal digits make four characters.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(h, 1 + 5 * CAST(k // 4 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p"""


#: The 256 steps of CRC-32 (polynomial 0xEDB88320, reflected).
_CRC_TABLE = """tab AS (SELECT list_transform(range(256), lambda v: list_reduce(list_prepend(v, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc32(text: str) -> str:
    """CRC-32 of a text column's UTF-8 bytes, with the step table ``tab`` in scope."""
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen({text})), lambda i: CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT))), "
            "lambda c, b: xor(c >> 8, tab.t[(xor(c, b) & 255) + 1])), 4294967295)")


#: Two words are near if one is the other less a code point, or both are equal less the same place.
SPELLING = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents),
counted AS (SELECT w, d || ':' || w AS k, count(*) AS n FROM runs WHERE length(w) >= 6 GROUP BY d, w),
hashed AS (SELECT w, n, {_crc32('k')} AS h FROM counted, tab),
slips AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slips WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, n, p, substr(word, 1, CAST(p AS INTEGER)) || substr(word, CAST(p AS INTEGER) + 2) AS v FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
near AS (SELECT DISTINCT x.word, x.n, y.word AS other, y.n AS other_n FROM less x JOIN less y ON x.v = y.v AND x.p = y.p AND x.word <> y.word),
ins AS (SELECT DISTINCT x.word, x.n, w.word AS other, w.n AS other_n FROM less x JOIN words w ON w.word = x.v),
pairs AS (SELECT * FROM near UNION SELECT * FROM ins UNION SELECT other, other_n, word, n FROM ins),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS f, max(other_n) AS fn FROM pairs GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.fn >= 5 * w.n THEN b.f END AS form, CASE WHEN b.fn >= 5 * w.n THEN b.fn END AS form_n
          FROM words w LEFT JOIN best b ON b.word = w.word),
steps(word, up) AS (SELECT word, word FROM forms UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.up WHERE f.form IS NOT NULL),
ends AS (SELECT s.word, s.up AS root FROM steps s JOIN forms f ON f.word = s.up WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM forms f JOIN ends e ON e.word = f.word"""

#: A node is the text of all its turns' MD5s; subtree totals go from every node up its smallest member's way.
PREFIX_TRIE = f"""
WITH {_CRC_TABLE},
turns AS (SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t, length(coalesce(text, '')) AS chars
          FROM conversations WHERE conv_id IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS r FROM turns),
ids AS (SELECT conv_id, conv_id - conv_id % 100 AS base, CAST(conv_id AS VARCHAR) AS k FROM (SELECT DISTINCT conv_id FROM turns)),
convs AS (SELECT conv_id, base, CASE WHEN conv_id = base THEN 0 ELSE {_crc32('k')} % 6 END AS h FROM ids, tab),
rows AS (SELECT c.conv_id, 0 AS part, r.r, r.t, r.chars FROM convs c JOIN ranked r ON r.conv_id = c.base AND r.r <= c.h
         UNION ALL SELECT c.conv_id, 1, r.r, r.t, r.chars FROM convs c JOIN ranked r ON r.conv_id = c.conv_id AND r.r > c.h),
placed AS (SELECT conv_id, t, chars, row_number() OVER (PARTITION BY conv_id ORDER BY part, r) AS depth FROM rows),
ways AS (SELECT conv_id, depth, chars, string_agg(t, ' ') OVER (PARTITION BY conv_id ORDER BY depth) AS node FROM placed
         UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lasts AS (SELECT conv_id, max(depth) AS depth FROM ways GROUP BY conv_id),
nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars FROM ways GROUP BY node, depth),
above AS (SELECT n.node, n.conv_id, n.depth, p.node AS parent FROM nodes n LEFT JOIN ways p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT parent AS node, count(*) AS n FROM above WHERE parent IS NOT NULL GROUP BY parent),
valued AS (SELECT n.*, coalesce(c.n, 0) AS n_children, (n.n_convs - 1) * n.chars AS saved FROM nodes n LEFT JOIN children c ON c.node = n.node),
sums AS (SELECT w.node, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(v.saved) AS saved_tokens
         FROM valued v JOIN ways w ON w.conv_id = v.conv_id AND w.depth <= v.depth GROUP BY w.node),
ends AS (SELECT w.node, string_agg(CAST(w.conv_id AS VARCHAR), ',' ORDER BY w.conv_id) AS ids FROM ways w JOIN lasts l ON l.conv_id = w.conv_id AND l.depth = w.depth GROUP BY w.node)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(v.n_convs AS BIGINT) AS n_convs, CAST(v.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM valued v JOIN above a ON a.node = v.node JOIN sums s ON s.node = v.node LEFT JOIN nodes p ON p.node = a.parent LEFT JOIN ends e ON e.node = v.node"""

#: The level of the targets, and the scale of the inclusion probabilities, by their breakpoints.
MIXING = f"""
WITH docs AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
                (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE AS luck FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (SELECT source, source_size, [3::DOUBLE, 1::DOUBLE, 2::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 2::DOUBLE * source_size AS cap FROM sums),
breaks AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
found AS (SELECT first(level ORDER BY cap / w, source) AS level FROM breaks WHERE level < cap / w),
goals AS (SELECT source, source_size, least(cap, coalesce(level, 0) * w) AS target FROM weighed, found),
whole AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM goals),
missing AS (SELECT *, target - copies * source_size AS miss FROM whole),
same AS (SELECT d.source, d.size, m.miss, CAST(sum(d.size) AS DOUBLE) AS words, sum(sqrt(d.size::DOUBLE) * d.size) AS roots FROM docs d JOIN missing m ON m.source IS NOT DISTINCT FROM d.source
         WHERE d.size > 0 AND m.miss > 0 GROUP BY ALL),
tries AS (SELECT source, size, (miss - coalesce(sum(words) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(roots) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale FROM same),
scales AS (SELECT source, first(scale ORDER BY size DESC) AS scale FROM tries WHERE scale * sqrt(size::DOUBLE) < 1 GROUP BY source),
chances AS (SELECT d.*, m.source_size, m.target, m.copies, m.miss, CASE WHEN d.size > 0 AND m.miss > 0 THEN least(coalesce(s.scale, 1) * sqrt(d.size::DOUBLE), 1) ELSE 0 END AS chance
            FROM docs d JOIN missing m ON m.source IS NOT DISTINCT FROM d.source LEFT JOIN scales s ON s.source IS NOT DISTINCT FROM d.source),
ranked AS (SELECT *, CASE WHEN chance >= 1 THEN -1 WHEN chance > 0 THEN luck * (1 - chance) / ((1 - luck) * chance) ELSE 'inf'::DOUBLE END AS rank FROM chances),
placed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, size, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM ranked)
SELECT doc_id, size, source_size, target, CAST((copies + CASE WHEN size > 0 AND miss > 0 AND (chance >= 1 OR 2 * upto - size <= 2 * miss) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM placed"""


#: Every window of 400 bytes by its MD5; removed runs are windows that touch; what is left as hexadecimal digits.
REPEATED_BYTES = """
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
windows AS (SELECT rid, i, md5(b[i : i + 399]) AS h FROM (SELECT rid, b, unnest(range(1, octet_length(b) - 398)) AS i FROM docs)),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
hits AS (SELECT rid, i FROM windows WHERE h IN (SELECT h FROM twice)),
marked AS (SELECT rid, i, CASE WHEN i > lag(i, 1, -1000) OVER (PARTITION BY rid ORDER BY i) + 400 THEN 1 ELSE 0 END AS new FROM hits),
numbered AS (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS run FROM marked),
runs AS (SELECT rid, min(i) AS s, max(i) + 399 AS e FROM numbered GROUP BY rid, run),
edges AS (SELECT rid, s, e FROM runs UNION ALL SELECT rid, octet_length(b) + 1, NULL FROM docs),
gaps AS (SELECT rid, coalesce(lag(e) OVER w, 0) + 1 AS a, s - 1 AS z FROM edges WINDOW w AS (PARTITION BY rid ORDER BY s)),
kept AS (SELECT g.rid, string_agg(hex(d.b[g.a : g.z]), '' ORDER BY g.a) AS x FROM gaps g JOIN docs d ON d.rid = g.rid WHERE g.z >= g.a GROUP BY g.rid),
sums AS (SELECT rid, sum(e - s + 1) AS n, count(*) AS k FROM runs GROUP BY rid)
SELECT d.doc_id, CAST(octet_length(d.b) AS BIGINT) AS n_bytes, CAST(coalesce(s.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(s.k, 0) AS BIGINT) AS n_spans,
       sha256(coalesce(from_hex(k.x), ''::BLOB)) AS kept_sha256
FROM docs d LEFT JOIN sums s ON s.rid = d.rid LEFT JOIN kept k ON k.rid = d.rid"""
