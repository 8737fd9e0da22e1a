"""SQL for the queries of :mod:`.retrieval`."""

from __future__ import annotations

from ..config import EMBEDDING_DIM, TOP_K
from ..operators.dialogue import BACK, DECAY, STRIDE
from ..operators.sparse import DIMS, SCALE
from .oracle import CELLS, GREEDY, PAGE_UNITS, QUESTIONS, WINDOWS, _with, hashed, lloyd, nearest, words
from .retrieval import CHUNK_ROUNDS

_CHUNKS = WINDOWS + ",\nchunks_v AS (SELECT doc_id AS source_file, chunk_index, text FROM win)"


def _terms(name: str, table: str, keys: str, text: str) -> str:
    return f"""{name} AS (
  SELECT {keys}, dim, count(*) AS n FROM (
    SELECT {keys}, cast('0x' || substr(md5(unnest({words(f'lower({text})')})), 1, 8) AS bigint) % {DIMS} AS dim FROM {table})
  GROUP BY ALL)"""


def _sparse(asked: str) -> str:
    """CTEs up to ``sparse (qid, rk, source_file, chunk_index, score)``, from ``asked``, which gives ``qt (qid, dim, n)``."""
    return f"""{_terms('ct', 'chunks_v', 'source_file, chunk_index', 'text')},
{asked},
idf AS (
  SELECT dim, cast(floor({SCALE} * ln(cast((SELECT count(*) FROM (SELECT DISTINCT source_file, chunk_index FROM ct)) AS double) / count(*))) AS bigint) AS i
  FROM ct GROUP BY dim),
cw AS (SELECT source_file, chunk_index, dim, n * i AS w FROM ct JOIN idf USING (dim)),
qw AS (SELECT qid, dim, n * i AS w FROM qt JOIN idf USING (dim)),
cs AS (SELECT source_file, chunk_index, cast(sum(w * w) AS double) AS ss FROM cw GROUP BY ALL),
qs AS (SELECT qid, cast(sum(w * w) AS double) AS ss FROM qw GROUP BY ALL),
sdots AS (SELECT qid, source_file, chunk_index, sum(c.w * q.w) AS dp FROM cw c JOIN qw q USING (dim) WHERE c.w <> 0 AND q.w <> 0 GROUP BY ALL),
sparse AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, source_file, chunk_index) AS rk FROM (
      SELECT d.qid, d.source_file, d.chunk_index, cast(d.dp AS double) / (sqrt(cs.ss) * sqrt(qs.ss)) AS score
      FROM sdots d JOIN cs USING (source_file, chunk_index) JOIN qs USING (qid)))
  WHERE rk <= {TOP_K})"""


SPARSE = _sparse(_terms("qt", "questions", "qid", "question"))

_DIALOGUE = f"""turns AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
final AS (SELECT conv_id, max(turn) AS turn FROM turns GROUP BY conv_id),
held AS (
  SELECT f.conv_id, t.turn, {DECAY} ** cast(({BACK} - (f.turn - t.turn)) // {STRIDE} AS int) AS weight, t.text
  FROM final f JOIN turns t ON t.conv_id = f.conv_id AND t.turn <= f.turn AND t.turn >= f.turn - {BACK}),
{_terms("ht", "held", "conv_id, turn, weight", "text")},
qt AS (SELECT conv_id AS qid, dim, cast(sum(n * weight) AS bigint) AS n FROM ht GROUP BY ALL)"""

TRUTH = f"""truth AS (
  SELECT DISTINCT q.qid, d.doc_id FROM (SELECT qid, ' ' || array_to_string({words('lower(question)')}, ' ') || ' ' AS t FROM questions) q
  JOIN (SELECT doc_id, ' ' || array_to_string({words('lower(text)')}, ' ') || ' ' AS t FROM documents) d ON contains(d.t, q.t)
  WHERE trim(q.t) <> '')"""


def _lists(name: str, table: str, keys: str) -> str:
    on = " AND ".join(f"t.{k} = k.{k}" for k in keys.split(", "))
    named = ", ".join(f"k.{k}" for k in keys.split(", "))
    return f"""{name} AS (
  SELECT {named}, list(coalesce(t.v, 0)::double ORDER BY r.d) AS vec
  FROM (SELECT DISTINCT {keys} FROM {table}) k CROSS JOIN (SELECT unnest(range({EMBEDDING_DIM})) AS d) r LEFT JOIN {table} t ON {on} AND t.dim = r.d
  GROUP BY {named})"""


def _quality(name: str, hits: str) -> str:
    return f"""SELECT '{name}' AS method, count(*) AS questions, round(avg(CASE WHEN best IS NULL THEN 0.0 ELSE 1.0 END), 6) AS hit_rate,
  round(avg(coalesce(1.0::double / best, 0.0)), 6) AS reciprocal_rank, round(avg(coalesce(gain, 0.0) / ideal), 6) AS ndcg
FROM (SELECT qid, list_sum(list_transform(range(1, least(count(*), {TOP_K}) + 1), lambda r: 1.0::double / log2(r + 1))) AS ideal FROM truth GROUP BY qid)
LEFT JOIN (
  SELECT qid, min(rk) AS best, sum(1.0::double / log2(rk + 1)) AS gain FROM (
    SELECT h.qid, h.source_file, min(h.rk) AS rk FROM {hits} h JOIN truth t ON t.qid = h.qid AND t.doc_id = h.source_file WHERE h.rk <= {TOP_K} GROUP BY ALL)
  GROUP BY qid) USING (qid)"""


_DENSE = f"""{hashed('cv', 'chunks_v', 'source_file, chunk_index', 'text')},
{hashed('qv', 'questions', 'qid', 'question')},
dots AS (
  SELECT q.qid, c.source_file, c.chunk_index, sum(q.v * c.v) AS dp FROM qv q JOIN cv c ON c.dim = q.dim GROUP BY ALL),
scored AS (
  SELECT s.qid, s.source_file, s.chunk_index, s.dp / sqrt(cast(c.ss * q.ss AS double)) AS score
  FROM dots s JOIN cv_ss c USING (source_file, chunk_index) JOIN qv_ss q USING (qid)),
exact AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, source_file, chunk_index) AS rk FROM scored) WHERE rk <= {TOP_K}),
{_lists('cl', 'cv', 'source_file, chunk_index')},
{_lists('ql', 'qv', 'qid')},
points AS (SELECT source_file || '-' || chunk_index AS key, source_file, chunk_index, vec FROM cl),
{lloyd('points', 'SELECT cast(floor(sqrt(count(*))) AS bigint) AS n FROM chunks_v', CHUNK_ROUNDS)},
asked AS (
  SELECT qid, cell_id FROM (
    SELECT q.qid, c.cell_id, row_number() OVER (PARTITION BY q.qid ORDER BY list_cosine_similarity(q.vec, c.vec) DESC, c.cell_id) AS place
    FROM ql q CROSS JOIN c{CHUNK_ROUNDS} c) WHERE place <= greatest(1, (SELECT n FROM nl) // 4)),
probed AS (
  SELECT * FROM (
    SELECT s.*, row_number() OVER (PARTITION BY s.qid ORDER BY score DESC, s.source_file, s.chunk_index) AS rk
    FROM scored s JOIN points p USING (source_file, chunk_index) JOIN assigned a USING (key) JOIN asked k ON k.qid = s.qid AND k.cell_id = a.cell_id)
  WHERE rk <= {TOP_K})"""

_SECTIONS = """heads AS (
  SELECT page_id, sec_no, text, CASE WHEN kind = 'title' THEN 0 ELSE cast(substr(kind, 2, 1) AS int) END AS level
  FROM parts WHERE piece_no = 0 AND sec_no > 0),
path AS (
  SELECT s.page_id, s.sec_no, string_agg(h.text, ' > ' ORDER BY h.sec_no) AS path
  FROM heads s JOIN heads h ON h.page_id = s.page_id AND h.sec_no <= s.sec_no AND h.text <> ''
  WHERE NOT EXISTS (SELECT 1 FROM heads k WHERE k.page_id = h.page_id AND k.sec_no > h.sec_no AND k.sec_no <= s.sec_no AND k.level <= h.level)
  GROUP BY s.page_id, s.sec_no),
sec_ord AS (
  SELECT page_id, sec_no, row_number() OVER (PARTITION BY page_id ORDER BY sec_no) AS ord
  FROM (SELECT DISTINCT page_id, sec_no FROM headed WHERE text <> '' AND sec_no > 0)),
ran AS (SELECT doc, pos, sum(CASE WHEN brk THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY pos) AS ord FROM numbered),
first_of AS (SELECT f.doc, f.chunk, min(r.ord) AS ord FROM fold f JOIN ran r ON r.doc = f.doc AND r.pos = f.pos GROUP BY f.doc, f.chunk)"""

ORACLE = {
    "ivf_pruned_topk": nearest(),
    "ivf_upkeep_topk": nearest(),
    "ivf_cell_sizes": _with(
        CELLS,
        select="""SELECT a.cell_id, count(*) AS n, round(min(list_cosine_similarity(p.vec, c.vec)), 6) AS reach
FROM assigned a JOIN points p USING (key) JOIN c3 c ON c.cell_id = a.cell_id GROUP BY a.cell_id""",
    ),
    "section_path_chunks": _with(
        PAGE_UNITS, GREEDY, _SECTIONS, recursive=True,
        select="""SELECT g.doc AS page_id, g.chunk_index, coalesce(p.path, '') AS section_path, g.text
FROM greedy g JOIN first_of f ON f.doc = g.doc AND f.chunk = g.chunk_index
LEFT JOIN sec_ord o ON o.page_id = g.doc AND o.ord = f.ord LEFT JOIN path p ON p.page_id = o.page_id AND p.sec_no = o.sec_no""",
    ),
    "sparse_topk": _with(_CHUNKS, QUESTIONS, SPARSE, select="SELECT qid, rk, source_file, chunk_index, round(score, 6) AS score FROM sparse"),
    "dialogue_topk": _with(
        _CHUNKS, _sparse(_DIALOGUE), select="SELECT qid, rk, source_file, chunk_index, round(score, 6) AS score FROM sparse"
    ),
    "containment_truth": _with(QUESTIONS, TRUTH, select="SELECT qid, doc_id FROM truth"),
    "retrieval_quality": _with(
        _CHUNKS, QUESTIONS, SPARSE, TRUTH, _DENSE,
        select="\nUNION ALL\n".join(_quality(n, n) for n in ("exact", "probed", "sparse")),
    ),
}
