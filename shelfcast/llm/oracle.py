"""DuckDB SQL for the training-data queries that SQL can express, over whole tables."""

from __future__ import annotations

# distinct two-word shingles, all pairs that share one, links, and the least id reachable
NEAR_DEDUP = r"""
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a, b FROM both_ways
  UNION
  SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
least_of AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       coalesce(c, w.doc_id)::BIGINT AS component_id,
       w.doc_id = coalesce(c, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON least_of.a = w.doc_id
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM p)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 5
"""

# the level of the targets: the highest over "just the sources before this one are full"
SOURCE_MIX = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::DOUBLE AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER (ORDER BY 2 * source_size / w, source ASC NULLS LAST) AS n FROM s),
l AS (
  SELECT max(((SELECT sum(source_size) * 1.5 FROM s)
    - coalesce((SELECT sum(2 * source_size) FROM o b WHERE b.n < o.n), 0))
    / (SELECT sum(w) FROM o b WHERE b.n >= o.n)) AS level FROM o),
t AS (
  SELECT source, source_size, least(2.0 * source_size, level * w)::DOUBLE AS target FROM o, l),
b AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT b.doc_id, size, source_size, target,
       (greatest(0, least(size, floor(target) - before))
        + greatest(0, least(size, floor(target) - before - source_size)))::BIGINT AS taken
FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source
"""

_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE\]|/TURN\])"

CHAT = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g')) AS n,
         length(regexp_replace(role, '{_CONTROL}', '\1\\\2\3', 'g')) AS m FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
         FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
           ELSE m + 20 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""



def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8, by the reflected polynomial 0xEDB88320."""
    eight = "lambda c, i: xor(c >> 1, (c & 1) * 3988292384)"
    byte = f"lambda c, b: list_reduce(range(8), {eight}, xor(c, b))"
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    codes = f"list_transform({pairs}, lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce({codes}, {byte}, 4294967295::BIGINT), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    fields = map(_field, ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({' || '.join(fields)})"


_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _tree(nodes: str, base: str) -> str:
    """Recursive table of a forest's nodes: every 8 of a level make one of the next."""
    return f"""
{nodes} AS (
  SELECT 0 AS level, tree, pos, n, digest FROM {base}
  UNION ALL
  SELECT level + 1, tree, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {nodes} WHERE n > 1 GROUP BY level, tree, pos // 8, n)"""


# every node's siblings by a join on its run, and the fold up a path of ancestors
MERKLE = f"""
WITH RECURSIVE
l AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(_LOW)}
              ELSE {_leaf("text")} END AS claimed FROM documents),
g AS (SELECT lang, row_number() OVER (ORDER BY lang ASC NULLS FIRST) - 1 AS tree, count(*) AS n
      FROM l GROUP BY lang),
b AS (
  SELECT doc_id, leaf, claimed, leaf AS digest, tree, n,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id ASC NULLS FIRST, leaf) - 1 AS pos
  FROM l JOIN g ON l.lang IS NOT DISTINCT FROM g.lang),
{_tree("inner_nodes", "b")},
s AS (SELECT -1 AS tree, tree AS pos, (SELECT count(*) FROM g) AS n, digest
      FROM inner_nodes WHERE n = 1),
{_tree("top_nodes", "s")},
heights AS (SELECT tree, max(level) AS height FROM inner_nodes GROUP BY tree),
runs AS (
  SELECT x.level, x.tree, x.pos,
         coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS before,
         coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS after
  FROM (SELECT * FROM inner_nodes UNION ALL SELECT * FROM top_nodes) x
  JOIN (SELECT * FROM inner_nodes UNION ALL SELECT * FROM top_nodes) y
    ON x.level = y.level AND x.tree = y.tree AND x.pos // 8 = y.pos // 8
  WHERE x.n > 1 GROUP BY x.level, x.tree, x.pos),
fold AS (
  SELECT doc_id, leaf, claimed, tree AS own, 0 AS step, tree, 0 AS level, pos,
         claimed AS digest, '' AS proof
  FROM b
  UNION ALL
  SELECT doc_id, leaf, claimed, own, step + 1,
         CASE WHEN f.level < coalesce(h.height, 99) THEN f.tree ELSE -1 END,
         CASE WHEN f.level < coalesce(h.height, 99) THEN f.level + 1 ELSE 0 END,
         CASE WHEN f.level < coalesce(h.height, 99) THEN f.pos // 8 ELSE f.own END,
         CASE WHEN f.level < coalesce(h.height, 99)
              THEN sha256(r.before || f.digest || r.after) ELSE f.digest END,
         CASE WHEN f.level < coalesce(h.height, 99)
              THEN f.proof || r.before || r.after ELSE f.proof END
  FROM fold f LEFT JOIN heights h ON h.tree = f.tree
  LEFT JOIN runs r ON r.tree = f.tree AND r.level = f.level AND r.pos = f.pos
  WHERE h.tree IS NOT NULL OR r.tree IS NOT NULL),
ends AS (
  SELECT * FROM fold f WHERE tree = -1
    AND level = (SELECT max(level) FROM top_nodes)),
r AS (SELECT digest AS root FROM top_nodes WHERE n = 1)
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(proof) AS proof_sha256,
       e.digest AS folded_root, e.digest = root AS verified
FROM ends e JOIN s ON s.pos = e.own, r
"""


def _place(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


# rows in the order of the ring, one after the other: each to the first shard clockwise with room
RING = f"""
WITH RECURSIVE
v AS (
  SELECT s, row_number() OVER (ORDER BY {_place("'ring-1:shard ' || s || ' node ' || n")}, s) - 1 AS i,
         {_place("'ring-1:shard ' || s || ' node ' || n")} AS place
  FROM range(8) a(s), range(256) b(n)),
arcs AS (SELECT arc, s, min((i - arc + 4096) % 2048) AS far
         FROM range(2049) a(arc), v GROUP BY arc, s),
prefs AS (SELECT arc, list(s ORDER BY far) AS shards FROM arcs GROUP BY arc),
d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size,
         {_crc32("coalesce(text, '')")}::BIGINT AS text_crc32,
         {_place("'ring-1:key:' || coalesce(doc_id::VARCHAR, '')")} AS place
  FROM documents),
a AS (
  SELECT d.*, coalesce(i, 2048) AS arc
  FROM d ASOF LEFT JOIN v ON d.place <= v.place),
k AS (
  SELECT a.*, shards,
         row_number() OVER (ORDER BY a.place, doc_id NULLS FIRST, size, text_crc32) AS k
  FROM a JOIN prefs USING (arc)),
caps AS (SELECT list(n // 8 + (s < n % 8)::BIGINT ORDER BY s) AS caps
         FROM (SELECT count(*) AS n FROM d), range(8) r(s)),
t AS (
  SELECT 0::BIGINT AS k, NULL::BIGINT AS shard, NULL::BIGINT AS slot,
         [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[] AS held
  UNION ALL
  SELECT k, shard, held[shard + 1],
         list_transform(held, lambda x, i: x + (i - 1 = shard)::BIGINT)
  FROM (SELECT k.k, held,
               list_filter(shards, lambda s: held[s + 1] < caps[s + 1])[1] AS shard
        FROM t JOIN k ON k.k = t.k + 1, caps))
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard, slot,
       NULL::INTEGER AS grown_shard
FROM k JOIN t USING (k)
"""


_SAID = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
_BEST = "row_number() OVER (PARTITION BY conv_id, {} ORDER BY cost, audit)"

# the best edits for each state of the grammar, row by row; up to three inserts before a row
TURNS = rf"""
WITH RECURSIVE
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32(_SAID)} % 20 AS k FROM conversations),
d AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                ELSE text END AS text,
         unnest(CASE k WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM k WHERE k <> 0),
o AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         NOT regexp_matches(text, '[^ 	-]') AS blank
  FROM d),
p AS (
  SELECT *, NOT blank AND row_number() OVER (
    PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM o),
r AS (
  SELECT *, blank OR again AS gone, substr(role, 1, 1) AS initial,
         NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?][ 	-]*$') AS short,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS last
  FROM p),
c AS (
  SELECT conv_id, max(i) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
         count(*) FILTER (short) AS truncated,
         count(*) FILTER (i > 1 AND last || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id),
ins(p, q, said) AS (VALUES
  (0, 0, []::VARCHAR[]), (1, 1, []), (2, 2, []), (3, 3, []),
  (0, 2, ['user:']), (1, 2, ['user:']), (2, 3, ['assistant:']), (3, 2, ['user:']),
  (0, 3, ['user:', 'assistant:']), (1, 3, ['user:', 'assistant:']),
  (2, 2, ['assistant:', 'user:']), (3, 3, ['user:', 'assistant:']),
  (0, 2, ['user:', 'assistant:', 'user:']), (1, 2, ['user:', 'assistant:', 'user:']),
  (2, 3, ['assistant:', 'user:', 'assistant:']), (3, 2, ['user:', 'assistant:', 'user:'])),
t AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS said
  FROM c
  UNION ALL
  SELECT conv_id, i, state, cost, audit, said FROM (
    SELECT *, {_BEST.format("state")} AS best FROM (
      SELECT t.conv_id, r.i,
             CASE e WHEN 'D' THEN q
                    WHEN 'R' THEN CASE q WHEN 2 THEN 3 ELSE 2 END
                    ELSE CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS state,
             t.cost + 2 * len(ins.said) + CASE e WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
               + CASE WHEN e <> 'D' AND short THEN 1 ELSE 0 END AS cost,
             t.audit || repeat('I', len(ins.said)) || e AS audit,
             t.said || ins.said || CASE e
               WHEN 'D' THEN []::VARCHAR[]
               WHEN 'K' THEN [role || ':' || text]
               ELSE [CASE q WHEN 2 THEN 'assistant' ELSE 'user' END || ':' || text] END AS said
      FROM t JOIN r ON t.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = t.i + 1
      JOIN ins ON ins.p = t.state, (VALUES ('D'), ('K'), ('R')) edits(e)
      WHERE e = 'D' OR NOT gone AND (e = 'R'
        OR initial = 's' AND q = 0 OR initial = 'u' AND q <> 2 OR initial = 'a' AND q = 2)))
  WHERE best = 1),
ends AS (
  SELECT t.conv_id, t.cost + 2 * len(ins.said) AS cost,
         t.audit || repeat('I', len(ins.said)) AS audit, t.said || ins.said AS said
  FROM t JOIN c ON t.conv_id IS NOT DISTINCT FROM c.conv_id AND t.i = c.n
  JOIN ins ON ins.p = t.state WHERE q IN (0, 3)),
b AS (SELECT * FROM (SELECT *, {_BEST.format("1")} AS best FROM ends) WHERE best = 1)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit,
       sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
"""

ORACLE_SQL: dict[str, str] = {
    "op1_near_dedup": NEAR_DEDUP,
    "op5_chat_format": CHAT,
    "op8_exact_top_k": TOP_K,
    "op9_source_mix": SOURCE_MIX,
    "op11_merkle_manifest": MERKLE,
    "op12_ring_shards": RING,
    "op13_turn_repair": TURNS,
}
