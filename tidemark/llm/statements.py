"""DuckDB statements of the shards, the manifest, the quality rules and the divergence audit."""

from __future__ import annotations


def _field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR) END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: CRC-32 of the decimal doc_id, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda k: (ascii(c)::BIGINT >> k::BIGINT) & 1)))),
    lambda c, b: xor(c >> 1, CASE WHEN (xor(c, b) & 1) = 1 THEN 3988292384 ELSE 0 END)))"""

MANIFEST = f"""WITH RECURSIVE d AS (
  SELECT doc_id, COALESCE('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS claimed FROM documents),
leaves AS (SELECT *, row_number() OVER (ORDER BY tree) AS rid, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, COUNT(*) OVER (PARTITION BY tree) AS n FROM d),
nodes AS (
  SELECT tree, 0 AS lvl, pos, leaf AS node, n FROM leaves
  UNION ALL SELECT tree, lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 2, n),
subroots AS (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS pos, COUNT(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, node, n FROM subroots
  UNION ALL SELECT lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY lvl, pos // 2, n),
up AS (
  SELECT rid, tree, 0 AS lvl, pos, n, claimed AS node, '' AS proof FROM leaves
  UNION ALL SELECT u.rid, u.tree, u.lvl + 1, u.pos // 2, (u.n + 1) // 2, sha256(CASE WHEN u.pos % 2 = 0 THEN u.node || COALESCE(s.node, '') ELSE s.node || u.node END), u.proof || COALESCE(s.node, '')
  FROM up u LEFT JOIN nodes s ON s.tree = u.tree AND s.lvl = u.lvl AND s.pos = xor(u.pos, 1) WHERE u.n > 1),
over_ AS (
  SELECT u.rid, 0 AS lvl, s.pos, s.n, u.node, u.proof FROM up u JOIN subroots s USING (tree) WHERE u.n = 1
  UNION ALL SELECT u.rid, u.lvl + 1, u.pos // 2, (u.n + 1) // 2, sha256(CASE WHEN u.pos % 2 = 0 THEN u.node || COALESCE(s.node, '') ELSE s.node || u.node END), u.proof || COALESCE(s.node, '')
  FROM over_ u LEFT JOIN tops s ON s.lvl = u.lvl AND s.pos = xor(u.pos, 1) WHERE u.n > 1)
SELECT l.doc_id, l.leaf, s.node AS subroot, t.node AS root, sha256(o.proof) AS proof_sha256, o.node AS folded_root, o.node = t.node AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN over_ o ON o.rid = l.rid AND o.n = 1 CROSS JOIN (SELECT node FROM tops WHERE n = 1) t"""

QUALITY = r"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, COALESCE(text, '') AS text FROM documents),
w AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d)),
grams AS (SELECT rid, i, word, lead(word) OVER p AS b, lead(word, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, i FROM (SELECT rid, i, COUNT(*) OVER (PARTITION BY rid, word, b, c) AS n FROM grams WHERE c IS NOT NULL) WHERE n > 1),
covered AS (SELECT rid, COUNT(*) AS n_repeat_words FROM (SELECT rid, i FROM twice UNION SELECT rid, i + 1 FROM twice UNION SELECT rid, i + 2 FROM twice) GROUP BY rid),
words AS (SELECT rid, COUNT(*) AS n_words, SUM(length(word)) AS word_chars FROM w GROUP BY rid),
lines AS (SELECT rid, COUNT(*) AS n_lines, COUNT(*) - COUNT(DISTINCT line) AS n_dup_lines FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
f AS (SELECT d.doc_id, COALESCE(n_words, 0) AS n_words, CAST(COALESCE(word_chars, 0) AS BIGINT) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    COALESCE(n_dup_lines, 0) AS n_dup_lines, COALESCE(n_repeat_words, 0) AS n_repeat_words, COALESCE(n_lines, 0) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
  FROM d LEFT JOIN words USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN lines USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 100 * n_dup_lines > 60 * n_lines OR 100 * n_upper > 50 * word_chars) AS kept
FROM f"""

#: Every term against every group: the plain form, without an index.
DIVERGENCE = r"""WITH d AS (SELECT row_number() OVER () AS rid, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source, COALESCE(text, '') AS text FROM documents),
t AS (SELECT rid, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, COUNT(*) AS lang_n FROM t GROUP BY 1, 2 HAVING COUNT(DISTINCT rid) >= 3),
n AS (SELECT lang, source, term, COUNT(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT lang, COUNT(*) AS v, SUM(lang_n) AS total FROM kept GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, COALESCE(SUM(n), 0) AS total FROM g LEFT JOIN n USING (lang, source) GROUP BY 1, 2),
p AS (SELECT gn.lang, gn.source, kept.term, COALESCE(n.n, 0) AS n, 1 + (1000000000::HUGEINT * (COALESCE(n.n, 0) + 1)) // (gn.total + v.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (kept.lang_n + 1)) // (v.total + v.v)::HUGEINT AS lang_p
  FROM gn JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN n ON n.lang = gn.lang AND n.source = gn.source AND n.term = kept.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, SUM((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
every_pair AS (SELECT a.lang, a.source, b.source AS item, COALESCE(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - lang_p) * (p - lang_p) // lang_p AS value FROM p WHERE n > 0 AND p > lang_p),
ranked AS (SELECT *, 'pair' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM every_pair
  UNION ALL SELECT *, 'term', row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200"""


def _crc_step(x: int) -> int:
    """What the low byte x adds to the rest of a CRC-32 register."""
    for _ in range(8):
        x = x >> 1 ^ (3988292384 if x & 1 else 0)
    return x


#: A register's low byte is the exclusive or of its bits' steps, as the step is linear.
_LOW = "0::BIGINT"
for _k in range(8):
    _LOW = f"xor({_LOW}, ((xor(c, b) >> {_k}) & 1) * {_crc_step(1 << _k)})"
_TEXT_CRC = f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda c, b: xor(c >> 8, {_LOW})))"""

SHARDING = f"""WITH d AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, COALESCE(text, '') AS text FROM documents),
r AS (SELECT doc_id, strlen(text) + 1 AS size, {_TEXT_CRC} AS text_crc32, md5(text) AS key FROM d),
t AS (SELECT key, COUNT(*) * ANY_VALUE(size) AS bytes FROM r GROUP BY key),
p AS (SELECT key, bytes, CAST(SUM(bytes) OVER (ORDER BY key) AS BIGINT) - bytes AS begins, CAST(SUM(bytes) OVER () AS BIGINT) AS total FROM t),
n AS (SELECT r.*, bytes, begins, total, row_number() OVER w AS overall, row_number() OVER (PARTITION BY key ORDER BY md5(CAST(doc_id AS VARCHAR)) NULLS LAST, doc_id) - 1 AS i
  FROM r JOIN p USING (key) WINDOW w AS (ORDER BY key, md5(CAST(doc_id AS VARCHAR)) NULLS LAST, doc_id)),
s AS (SELECT *, CAST(((2 * begins + CASE WHEN bytes * 16 <= total THEN bytes ELSE (2 * i + 1) * size END) * 16) // (2 * total) AS INTEGER) AS shard FROM n)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY overall) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s"""
