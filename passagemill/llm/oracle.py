"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from .decontaminate import WINDOW_WORDS
from .mixing import SEED, TOTAL

_OP1 = rf"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
pattern AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, list_slice(w, i, i + {WINDOW_WORDS - 1}) AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW_WORDS - 2}, 2))) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
lengths AS (SELECT DISTINCT len(words) AS k FROM pattern),
gram AS (
  SELECT r, i, k, list_slice(w, i, i + k - 1) AS words
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, lengths WHERE len(w) >= k)),
hit AS (SELECT r, i, k, item FROM gram JOIN pattern USING (words)),
marked AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hit)) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""

_OP6 = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    coalesce(CAST(doc_id AS VARCHAR), 'text|' || md5(coalesce(text, ''))) AS key FROM documents),
src AS (
  SELECT source, source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM doc GROUP BY source)),
level(round, height) AS (
  SELECT 0, 0.0::DOUBLE
  UNION ALL
  SELECT l.round + 1, ({TOTAL}::DOUBLE * (SELECT sum(source_size)::DOUBLE FROM src)
      - (SELECT coalesce(sum(2.0::DOUBLE * source_size), 0.0) FROM src WHERE 2.0::DOUBLE * source_size <= weight * l.height))
    / (SELECT sum(weight) FROM src WHERE 2.0::DOUBLE * source_size > weight * l.height)
  FROM level l WHERE l.round < 40 AND (SELECT count(*) FROM src WHERE 2.0::DOUBLE * source_size > weight * l.height) > 0),
target AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * (SELECT max(height) FROM level)) AS target FROM src),
taken AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size = 0 THEN 0.0::DOUBLE ELSE t.target / t.source_size END AS rate,
    CAST(('0x' || substr(md5('{SEED}|' || d.key), 1, 13)) AS BIGINT)::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM doc d JOIN target t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM taken
"""

_OP12 = """
WITH doc AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
same AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM doc GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM doc JOIN same USING (t)
"""


def _level(name: str, leaves: str) -> str:
    """Nodes (lvl, t, i, n, digest) of every level over ``leaves`` (t, i, n, digest)."""
    return f"""
{name}(lvl, t, i, n, digest) AS (
  SELECT 0, t, i, n, digest FROM {leaves}
  UNION ALL
  SELECT max(lvl) + 1, t, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY t, i // 16, n)"""


_OP11 = f"""
WITH RECURSIVE raw AS (
  SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
  FROM documents),
parts AS (
  SELECT doc_id, source, text, low, xor(crc, 4294967295) AS crc,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM raw),
doc AS (
  SELECT doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS digest,
    CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS tampered,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n
  FROM parts),
{_level("lower_nodes", "doc")},
heads AS (SELECT 0 AS t, t AS i, count(*) OVER () AS n, digest FROM lower_nodes WHERE n = 1),
{_level("upper_nodes", "heads")},
node AS (SELECT 0 AS upper, * FROM lower_nodes WHERE n > 1 UNION ALL SELECT 1, * FROM upper_nodes WHERE n > 1),
place AS (SELECT doc_id, 0 AS upper, t, i FROM doc UNION ALL SELECT doc_id, 1, 0, t FROM doc),
step AS (
  SELECT p.doc_id, p.upper, s.lvl,
    coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i < p.i // (16 ** s.lvl)::BIGINT), '') AS left_part,
    coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i > p.i // (16 ** s.lvl)::BIGINT), '') AS right_part
  FROM place p JOIN node s ON s.upper = p.upper AND s.t = p.t AND s.i // 16 = p.i // (16 ** (s.lvl + 1))::BIGINT GROUP BY p.doc_id, p.upper, p.i, s.lvl),
proof AS (
  SELECT doc_id, list(left_part || '|' || right_part ORDER BY upper, lvl) AS steps, string_agg(left_part || right_part, '' ORDER BY upper, lvl) AS beside
  FROM step GROUP BY doc_id),
folded AS (
  SELECT d.doc_id, d.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(p.beside, '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(d.tampered, d.digest), coalesce(p.steps, [])),
      lambda a, b: sha256(split_part(b, '|', 1) || a || split_part(b, '|', 2))) AS folded_root
  FROM doc d JOIN lower_nodes s ON s.n = 1 AND s.t = d.t JOIN upper_nodes r ON r.n = 1 LEFT JOIN proof p USING (doc_id))
SELECT *, folded_root = root AS verified FROM folded
"""

_OP13 = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
size AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM doc WHERE len(w) > 0),
post AS (SELECT doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM doc) GROUP BY ALL),
term AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM post, size GROUP BY t, n_docs),
item AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM item JOIN term USING (t) JOIN post USING (t), size GROUP BY item_id, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
"""

ORACLE = {"op1_decontamination": _OP1, "op6_mixing": _OP6, "op11_merkle_manifest": _OP11, "op12_exact_dedup": _OP12, "op13_lexical_search": _OP13}
