"""DuckDB SQL of the registered queries that SQL can express.

``op5`` and ``op8`` are trained models and ``op6`` parses HTML; those are
tested on held-out accuracy and against a brute-force version.
"""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LOWER_WORDS = rf"regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+')"
ALNUM_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _lague(source: str, group: str, key: str, votes: str, seats: str, columns: str) -> str:
    """Quota by highest quotients: every seat's quotient is ranked."""
    return f"""(
  SELECT {columns}, coalesce(won, 0) AS quota FROM {source} LEFT JOIN (
    SELECT {group} AS g, {key} AS k, count(*) AS won FROM (
      SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {votes} / (2 * seat - 1) DESC, {key}) AS place
      FROM (SELECT *, unnest(range(1, CAST({seats} AS BIGINT) + 1)) AS seat FROM {source} WHERE {votes} > 0)
    ) WHERE place <= {seats} GROUP BY ALL
  ) ON {source}.{group} = g AND {source}.{key} = k)"""


OP1 = rf"""
WITH sized AS MATERIALIZED (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM sized GROUP BY source),
w AS (SELECT *, [1, 2, 3][(no - 1) % 3 + 1] AS weight, 3 * source_size AS cap, 0 AS whole FROM src),
c AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
  coalesce(sum(cap) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
  coalesce(sum(weight) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before FROM w),
f AS (SELECT *, cap * (weights - weight_before) <= weight * (total - cap_before) AS is_full FROM c),
t AS MATERIALIZED (SELECT *, CASE WHEN is_full THEN cap::DOUBLE ELSE (weight * (total - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ()))::DOUBLE
    / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () END AS target, total AS seats FROM f),
q AS MATERIALIZED {_lague("t", "whole", "no", "target", "seats", "no, source, source_size, target")},
placed AS MATERIALIZED (
  SELECT doc_id, s.source, size, no, shard, sum(size) OVER (PARTITION BY no, shard
    ORDER BY md5('8|' || coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM (SELECT z.*, q.no, ('0x' || substr(md5('7|' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
      % greatest(ceil(source_size / 4194304.0)::BIGINT, 1) AS shard FROM sized z JOIN q ON z.source IS NOT DISTINCT FROM q.source) s),
sh AS MATERIALIZED (SELECT no, shard, sum(size)::BIGINT AS length, q.quota AS seats FROM placed JOIN q USING (no) GROUP BY no, shard, q.quota),
d AS MATERIALIZED (SELECT *, tokens // length AS epochs, tokens % length AS rest FROM (
  SELECT *, least(quota, 3 * length) AS tokens FROM {_lague("sh", "no", "shard", "length", "seats", "no, shard, length")} WHERE length > 0)),
b AS (SELECT *, least(128, length - block * 128) AS n FROM (SELECT *, unnest(range(0, (length + 127) // 128)) AS block FROM d WHERE rest > 0)),
u AS (SELECT *, sum(n) OVER (PARTITION BY no, shard ORDER BY md5('9|' || no || '|' || shard || '|' || block), block ROWS UNBOUNDED PRECEDING) AS upto FROM b),
chosen AS MATERIALIZED (SELECT no, shard, block, least(n, rest - (upto - n)) AS part FROM u WHERE upto - n < rest),
parts AS (SELECT no, shard, start, sum(greatest(least(start + size, block * 128 + part) - greatest(start, block * 128), 0)) AS part
  FROM (SELECT no, shard, start, size, unnest(range((start // 128)::BIGINT, ((start + size - 1) // 128 + 1)::BIGINT)) AS block FROM placed WHERE size > 0)
  JOIN chosen USING (no, shard, block) GROUP BY ALL)
SELECT doc_id, size, source_size, target, source, quota::BIGINT AS quota,
  (CASE WHEN size > 0 THEN size * coalesce(epochs, 0) + coalesce(part, 0) ELSE 0 END)::BIGINT AS taken
FROM (SELECT p.*, q.source_size, q.target, q.quota, d.epochs FROM placed p JOIN q USING (no) LEFT JOIN d USING (no, shard)) x
LEFT JOIN parts USING (no, shard, start)
"""

OP2 = """
WITH v AS (SELECT vec_id, list_transform(min(embedding), lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

OP3 = rf"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {LOWER_WORDS} AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT w.doc_id, count(gram) AS n FROM w LEFT JOIN g USING (doc_id) GROUP BY w.doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.y FROM r JOIN e ON e.x = r.b)
SELECT a AS doc_id, n AS n_shingles, min(b) AS component_id FROM r JOIN n ON n.doc_id = a GROUP BY a, n
"""

OP4 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL SELECT -1, i, ['user', 'assistant'][i + 1], '<|im_end|><|im_start|>assistant ok', ['user', 'assistant'][i + 1],
    '<|im_end|><|im_start|>assistant ok' FROM range(2) x(i)),
e AS (SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS written,
  replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS role_written FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, r NULLS LAST, t NULLS LAST)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS LAST, r NULLS LAST, t NULLS LAST), '')) AS loss_sha256,
  sum(12 + length(role_written) + 1 + length(written) + 11)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP7 = rf"""
WITH w AS MATERIALIZED (SELECT doc_id, {WORDS} AS w FROM documents),
win AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM win) WHERE doc_id > first),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM late),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

OP9 = rf"""
WITH items AS (SELECT item_id, {ALNUM_WORDS} AS w FROM benchmark),
win AS MATERIALIZED (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS h FROM (
  SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(10, len(w)) AS k FROM items WHERE len(w) > 0))),
d AS MATERIALIZED (SELECT doc_id, {ALNUM_WORDS} AS w FROM documents),
spot AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
hit AS MATERIALIZED (SELECT doc_id, i, spot.k, item_id FROM spot JOIN win ON win.k = spot.k AND win.h = array_to_string(spot.w[i : i + spot.k - 1], ' ')),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, octet_length(encode(body))::BIGINT AS n, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS last FROM p)
SELECT page_id, n AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM h
"""

OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
w AS MATERIALIZED (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
grid AS MATERIALIZED (SELECT g.lang, g.source, term, total, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0) + 1)
    // (sum(coalesce(n, 0)) OVER (PARTITION BY g.lang, g.source) + count(*) OVER (PARTITION BY g.lang, g.source)) AS p
  FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
l AS (SELECT lang, term, 1 + 1000000000 * (total + 1) // (sum(total) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q FROM kept),
pairs AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value
  FROM (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source)
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) USING (lang, source, item)),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM grid JOIN l USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200
"""

# CRC-32 byte by byte; T is the table of its 256 one-byte remainders.
CRC_TABLE = """tab AS MATERIALIZED (SELECT list(v ORDER BY i) AS T FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::BIGINT)),
  lambda c, b: xor(c >> 8, T[(xor(c, b) & 255) + 1])), 4294967295)"""


OP12 = rf"""
WITH RECURSIVE {CRC_TABLE},
d AS MATERIALIZED (SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 8)::BIGINT AS size, {_crc32("coalesce(text, '')")} AS crc FROM documents, tab),
k AS (SELECT *, md5(coalesce(doc_id::VARCHAR, '') || '|' || size || '|' || crc || '|' || row_number() OVER (PARTITION BY doc_id, size, crc)) AS key FROM d),
r AS MATERIALIZED (SELECT *, ('0x' || substr(key, 1, 8))::BIGINT % 4096 AS home FROM k),
m AS (SELECT home, home % 24 AS shard, coalesce(bytes, 0) AS bytes FROM range(4096) h(home) LEFT JOIN (SELECT home, sum(size) AS bytes FROM r GROUP BY home) USING (home)),
j AS MATERIALIZED (SELECT *, sum(bytes) OVER (PARTITION BY shard ORDER BY bytes DESC, home ROWS UNBOUNDED PRECEDING) * 24 > sum(bytes) OVER ()
    AND row_number() OVER (PARTITION BY shard ORDER BY bytes DESC, home) > 1 AND bytes > 0 AS freed FROM m),
f AS MATERIALIZED (SELECT home, bytes, row_number() OVER (ORDER BY bytes DESC, home) AS nth FROM j WHERE freed),
deal(nth, loads, home, shard) AS (
  SELECT 0::BIGINT, list(b ORDER BY shard), NULL::BIGINT, NULL::BIGINT FROM (SELECT shard, sum(CASE WHEN freed THEN 0 ELSE bytes END) AS b FROM j GROUP BY shard)
  UNION ALL SELECT f.nth, list_transform(loads, lambda x, i: CASE WHEN i = list_position(loads, list_min(loads)) THEN x + bytes ELSE x END),
    f.home, list_position(loads, list_min(loads)) - 1 FROM deal JOIN f ON f.nth = deal.nth + 1),
s AS MATERIALIZED (SELECT j.home, coalesce(deal.shard, j.shard)::INT AS shard FROM j LEFT JOIN deal USING (home))
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY home, substr(key, 9), doc_id NULLS FIRST, size, crc) - 1 AS slot,
  NULL::INT AS grown_shard, home
FROM r JOIN s USING (home)
"""

_FIELDS = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c} END" for c in ("doc_id", "source", "lang", "n_chars", "text")
)


def _levels(leaves: str) -> str:
    """All nodes (level, tree, pos, n nodes of that level, value); a level of one node is the last."""
    return f"""SELECT 0 AS level, tree, pos, n, value FROM {leaves} UNION ALL SELECT level + 1, tree, pos // 16, (n + 15) // 16, sha256(string_agg(value, '' ORDER BY pos))
  FROM {{}} WHERE n > 1 GROUP BY level, tree, pos // 16, n"""


def _paths(leaves: str, nodes: str) -> str:
    """Left and right siblings of every leaf, level by level."""
    return f"""SELECT tree, pos, list({{'l': l, 'r': r, 'v': ''}} ORDER BY level) AS path FROM (
    SELECT a.tree, a.pos, b.level, coalesce(string_agg(CASE WHEN b.pos < a.pos // (16 ** b.level)::BIGINT THEN b.value END, '' ORDER BY b.pos), '') AS l,
      coalesce(string_agg(CASE WHEN b.pos > a.pos // (16 ** b.level)::BIGINT THEN b.value END, '' ORDER BY b.pos), '') AS r
    FROM {leaves} a JOIN {nodes} b ON a.tree = b.tree AND b.n > 1 AND b.pos // 16 = a.pos // (16 ** (b.level + 1))::BIGINT GROUP BY ALL) GROUP BY tree, pos"""


OP13 = rf"""
WITH RECURSIVE {CRC_TABLE},
o AS MATERIALIZED (SELECT *, sha256({_FIELDS}) AS value, CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM documents, tab),
x AS (SELECT doc_id, source, value, (SELECT sha256({_FIELDS}) FROM (SELECT o.doc_id, o.source, o.lang, o.n_chars, o.changed AS text)) AS other FROM o),
leaf AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, value) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS n FROM x),
node AS ({_levels("leaf").format("node")}),
sub AS MATERIALIZED (SELECT 0 AS tree, tree AS pos, count(*) OVER () AS n, value FROM node WHERE n = 1),
top AS ({_levels("sub").format("top")}),
own AS MATERIALIZED ({_paths("leaf", "node")}),
up AS MATERIALIZED ({_paths("sub", "top")}),
p AS MATERIALIZED (SELECT leaf.*, sub.value AS subroot, (SELECT value FROM top WHERE n = 1) AS root, coalesce(own.path, []) || coalesce(up.path, []) AS path
  FROM leaf JOIN sub ON sub.pos = leaf.tree LEFT JOIN own ON own.tree = leaf.tree AND own.pos = leaf.pos LEFT JOIN up ON up.pos = leaf.tree),
q AS (SELECT *, list_reduce(list_prepend({{'l': '', 'r': '', 'v': other}}, path), lambda a, b: {{'l': '', 'r': '', 'v': sha256(b.l || a.v || b.r)}}).v AS folded_root FROM p)
SELECT doc_id, value AS leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256, folded_root,
  folded_root = root AS verified FROM q
"""

STATEMENTS: dict[str, str] = {
    "op1_source_mix": OP1,
    "op2_topk_search": OP2,
    "op3_ngram_jaccard": OP3,
    "op4_chat_format": OP4,
    "op7_substring_dedup": OP7,
    "op9_decontamination": OP9,
    "op10_warc_zip": OP10,
    "op11_source_divergence": OP11,
    "op12_sharding": OP12,
    "op13_merkle_manifest": OP13,
}
