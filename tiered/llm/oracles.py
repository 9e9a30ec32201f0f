"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

LOWER = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id,
    regexp_extract_all(coalesce({LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id,
    regexp_extract_all(coalesce({LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k : k + n - 1], ' ') AS gram
  FROM (SELECT *, least(10, len(w)) AS n FROM i WHERE len(w) > 0) AS s,
    LATERAL unnest(range(1, len(w) - n + 2)) AS u(k)),
sizes AS (SELECT DISTINCT n FROM item_windows),
found AS (
  SELECT doc_id, k, s.n, item_id
  FROM (SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS gram
        FROM d, sizes, LATERAL unnest(range(1, len(w) - n + 2)) AS u(k)) AS s
  JOIN item_windows USING (n, gram)),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM found, LATERAL unnest(range(k, k + n)) AS u(place) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items,
    sha256(string_agg(name, ',' ORDER BY name)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

EMBEDDINGS = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e AS a JOIN e AS b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least ON least.a = vec_id
"""

JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS g
  FROM d, LATERAL unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) AS c
  JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b
  WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON a = d.doc_id
"""

ARCHIVES = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""

# crc32 over the hexadecimal bytes of a text; the table of 256 remainders comes from its rule.
_STEP = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
SHARDS = f"""
WITH RECURSIVE t(k, b, c) AS (
  SELECT 0, n, CAST(n AS BIGINT) FROM range(256) AS r(n)
  UNION ALL SELECT k + 1, b, {_STEP} FROM t WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM t WHERE k = 8),
d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
c AS (
  SELECT doc_id, size, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(1, size),
      lambda i: CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT))),
    lambda a, b: xor(a >> 8, crc_table.t[1 + (xor(a, b) & 255)])), 4294967295) AS text_crc32
  FROM d, crc_table),
p AS (
  SELECT *, CAST(sum(size) OVER (ORDER BY doc_id) AS BIGINT) - size AS start,
    CAST(sum(size) OVER () AS BIGINT) AS total FROM c),
s AS (
  SELECT *, CAST(((2 * start + size) * 16) // (2 * total) AS INT) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
  CAST(NULL AS INT) AS grown_shard
FROM s
"""



def _crc(text: str) -> str:
    """crc32 of a number's decimal text; needs crc_table of CRC_TABLE."""
    return f"""xor(list_reduce(list_prepend(4294967295,
      list_transform(range(1, len({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))),
      lambda a, b: xor(a >> 8, crc_table.t[1 + (xor(a, b) & 255)])), 4294967295)"""


CRC_TABLE = f"""t(k, b, c) AS (
  SELECT 0, n, CAST(n AS BIGINT) FROM range(256) AS r(n)
  UNION ALL SELECT k + 1, b, {_STEP} FROM t WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM t WHERE k = 8)"""

TRIE = rf"""
WITH RECURSIVE {CRC_TABLE},
rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, key, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) - 1 AS place
  FROM (SELECT conv_id, turn, sha256(concat(strlen(role), ':', role, text)) AS key,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM rows) AS k),
sizes AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS name, count(*) AS n FROM turns GROUP BY conv_id),
convs AS (SELECT conv_id, n, {_crc("name")} % 4 AS h FROM sizes, crc_table),
made AS (
  SELECT c.conv_id, b.place, b.key, b.words FROM convs AS c
  JOIN turns AS b ON b.conv_id = c.conv_id - c.conv_id % 20 AND b.place < c.h
  UNION ALL
  SELECT c.conv_id, o.place - c.h + least(c.h, coalesce(b.n, 0)), o.key, o.words
  FROM convs AS c JOIN turns AS o ON o.conv_id = c.conv_id AND o.place >= c.h
  LEFT JOIN convs AS b ON b.conv_id = c.conv_id - c.conv_id % 20),
lists AS (
  SELECT conv_id, list(key ORDER BY place) FILTER (key IS NOT NULL) AS keys,
    list(words ORDER BY place) FILTER (key IS NOT NULL) AS words
  FROM convs LEFT JOIN made USING (conv_id) GROUP BY conv_id),
paths AS (
  SELECT conv_id, d, array_to_string(keys[1 : d], ',') AS node,
    CASE WHEN d > 0 THEN array_to_string(keys[1 : d - 1], ',') END AS parent,
    coalesce(words[d], 0) AS words, d = coalesce(len(keys), 0) AS last
  FROM lists, LATERAL unnest(range(0, coalesce(len(keys), 0) + 1)) AS u(d)),
nodes AS (
  SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(d) AS depth,
    count(*) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '') AS ends
  FROM paths GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
under AS (SELECT DISTINCT a.node, b.node AS low FROM paths AS a JOIN paths AS b ON a.conv_id = b.conv_id AND a.d <= b.d),
sums AS (
  SELECT under.node, count(*) FILTER (kids.node IS NULL) AS n_leaves,
    CAST(sum((n.n_convs - 1) * n.words) AS BIGINT) AS saved_tokens
  FROM under JOIN nodes AS n ON n.node = low LEFT JOIN kids ON kids.node = low GROUP BY under.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
  coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes AS n LEFT JOIN nodes AS p ON p.node = n.parent
LEFT JOIN kids ON kids.node = n.node JOIN sums ON sums.node = n.node
"""


def _leaf(*columns: str) -> str:
    written = ", ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END"
        for c in columns
    )
    return f"sha256(concat({written}))"


MERKLE = f"""
WITH RECURSIVE {CRC_TABLE},
named AS (SELECT *, coalesce('=' || lang, '') AS grp, CAST(doc_id AS VARCHAR) AS name FROM documents),
leaves AS (
  SELECT doc_id, grp, {_leaf("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
    CASE WHEN name IS NOT NULL AND {_crc("name")} % 7 = 0
      THEN {_leaf("doc_id", "source", "lang", "(n_chars + 1)", "text")}
      ELSE {_leaf("doc_id", "source", "lang", "n_chars", "text")} END AS changed
  FROM named, crc_table),
feet AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY grp) AS n FROM leaves),
tree(grp, level, place, digest, n) AS (
  SELECT grp, 0, place, leaf, n FROM feet
  UNION ALL
  SELECT grp, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (n + 1) // 2
  FROM tree WHERE n > 1 GROUP BY grp, level, place // 2, n),
subs AS (
  SELECT grp, digest AS subroot, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS n
  FROM tree WHERE n = 1),
crown(level, place, digest, n) AS (
  SELECT 0, place, subroot, n FROM subs
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (n + 1) // 2
  FROM crown WHERE n > 1 GROUP BY level, place // 2, n),
fold(doc_id, grp, tie, level, place, digest, n, proof) AS (
  SELECT doc_id, grp, place, 0, place, changed, n, '' FROM feet
  UNION ALL
  SELECT f.doc_id, f.grp, f.tie, f.level + 1, f.place // 2,
    sha256(CASE WHEN f.place % 2 = 1 THEN concat(t.digest, f.digest) ELSE concat(f.digest, t.digest) END),
    (f.n + 1) // 2, concat(f.proof, t.digest)
  FROM fold AS f LEFT JOIN tree AS t ON t.grp = f.grp AND t.level = f.level AND t.place = xor(f.place, 1)
  WHERE f.n > 1),
fold_up(doc_id, grp, tie, level, place, digest, n, proof) AS (
  SELECT f.doc_id, f.grp, f.tie, 0, s.place, f.digest, s.n, f.proof
  FROM fold AS f JOIN subs AS s USING (grp) WHERE f.n = 1
  UNION ALL
  SELECT f.doc_id, f.grp, f.tie, f.level + 1, f.place // 2,
    sha256(CASE WHEN f.place % 2 = 1 THEN concat(t.digest, f.digest) ELSE concat(f.digest, t.digest) END),
    (f.n + 1) // 2, concat(f.proof, t.digest)
  FROM fold_up AS f LEFT JOIN crown AS t ON t.level = f.level AND t.place = xor(f.place, 1)
  WHERE f.n > 1)
SELECT feet.doc_id, leaf, subroot, c.digest AS root, sha256(u.proof) AS proof_sha256,
  u.digest AS folded_root, u.digest = c.digest AS verified
FROM feet JOIN subs USING (grp) JOIN fold_up AS u ON u.grp = feet.grp AND u.tie = feet.place AND u.n = 1,
  (SELECT digest FROM crown WHERE n = 1) AS c
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": DECONTAMINATION,
    "op2_embedding_links": EMBEDDINGS,
    "op3_jaccard_join": JACCARD,
    "op8_archives": ARCHIVES,
    "op9_byte_shards": SHARDS,
    "op11_prefix_trie": TRIE,
    "op12_merkle_manifest": MERKLE,
}
