"""The same queries as SQL for an independent engine, for checking results."""

from __future__ import annotations

from ..config import CHUNK_TOKENS, EMBEDDING_DIM, TOP_K
from ..operators.generation import NOT_IN_CONTEXT
from ..operators.packing import FILE_BYTES, LARGE_PARTS
from ..operators.prompting import (
    ANSWER_HEADER,
    CONTEXT_HEADER,
    CONTEXT_SEPARATOR,
    QUESTION_HEADER,
    SYSTEM_SENTENCES,
)
from ..operators.reports import THRESHOLDS
from .catalogue import MEASURED_QUERIES, TARGET_RECALL

CAP = CHUNK_TOKENS


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def words(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')"


def _with(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + select


LINES = r"""lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents)"""

DOC_UNITS = rf"""units AS (
  SELECT doc_id AS doc, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS unit_no,
         false AS brk, 'line' AS kind, '' AS heading, {collapse('line')} AS text
  FROM lines WHERE regexp_matches(line, '\S'))"""


# Written on its own, and not taken from the operator: marks for the start of a
# section, of a unit, and the end of a tag's name; then the steps from markup to marks.
SECTION, NAME_END, UNIT_START = "\x01", "\x02", "\x03"
_OPENERS = "p|li|tr|pre|blockquote|caption|dt|dd"
_BOXES = "title|h1|h2|h3|h4|h5|h6|" + _OPENERS + (
    "|div|nav|ul|ol|dl|table|thead|tbody|article|section|header|footer|main|aside|form|figure|head|body|html"
)
_HTML_STEPS = [
    (f"[{SECTION}{NAME_END}{UNIT_START}]", ""),
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script\s*>", ""),
    (r"(?is)<style\b.*?</style\s*>", ""),
    (r"(?i)<(title|h[1-6])(?:\s[^>]*)?>", f"{SECTION}\\1{NAME_END}"),
    (rf"(?i)<({_OPENERS})(?:\s[^>]*)?>", f"{UNIT_START}\\1{NAME_END}"),
    (rf"(?i)</?(?:{_BOXES})(?:\s[^>]*)?>", f"{UNIT_START}{NAME_END}"),
    (r"(?i)<br\s*/?>", " "),
    (r"(?i)</?t[dh](?:\s[^>]*)?>", " "),
    (r"<[a-zA-Z/!][^>]*(?:>|$)", ""),
]
# the references that the given pages hold, and the common ones beside; the ampersand's comes last
_REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "#39": "'", "apos": "'", "nbsp": " ", "copy": "©", "middot": "·", "amp": "&"}


def _marked_html() -> str:
    x = "html"
    for pattern, replacement in _HTML_STEPS:
        x = f"regexp_replace({x}, {lit(pattern)}, {lit(replacement)}, 'g')"
    return f"{lit(NAME_END)} || {x}"


def _clean(x: str) -> str:
    for name, char in _REFERENCES.items():
        x = f"replace({x}, {lit('&' + name + ';')}, {lit(char)})"
    return collapse(x)


PAGE_UNITS = rf"""sections AS (
  SELECT page_id, unnest(string_split(m, {lit(SECTION)})) AS section,
         generate_subscripts(string_split(m, {lit(SECTION)}), 1) - 1 AS sec_no
  FROM (SELECT page_id, {_marked_html()} AS m FROM pages)),
pieces0 AS (
  SELECT page_id, sec_no, unnest(string_split(section, {lit(UNIT_START)})) AS piece,
         generate_subscripts(string_split(section, {lit(UNIT_START)}), 1) - 1 AS piece_no
  FROM sections),
parts AS (
  SELECT page_id, sec_no, piece_no,
         lower(string_split(piece, {lit(NAME_END)})[1]) AS kind,
         {_clean(f"string_split(piece, {lit(NAME_END)})[2]")} AS text
  FROM pieces0),
headed AS (
  SELECT p.page_id, p.sec_no, p.piece_no, p.kind, p.text,
         CASE WHEN p.sec_no > 0 THEN h.text ELSE '' END AS heading
  FROM parts p JOIN parts h ON h.page_id = p.page_id AND h.sec_no = p.sec_no AND h.piece_no = 0),
units AS (
  SELECT page_id AS doc,
         row_number() OVER (PARTITION BY page_id ORDER BY sec_no, piece_no) - 1 AS unit_no,
         sec_no > 0 AND row_number() OVER (PARTITION BY page_id, sec_no ORDER BY piece_no) = 1 AS brk,
         CASE WHEN kind = '' THEN 'text' ELSE kind END AS kind, heading, text
  FROM headed WHERE text <> '')"""

def greedy(tokens: str, glue: str) -> str:
    """Needs a CTE ``units``; yields ``greedy (doc, chunk_index, text)``."""

    def part(i: str) -> str:
        return f"list_slice(w, {i} * {CAP} + 1, {i} * {CAP} + {CAP})"

    return rf"""counted AS (
  SELECT doc, unit_no, brk, text, {tokens} AS w FROM units),
cut AS (
  SELECT doc, unit_no, 0 AS part, brk, len(w) AS n, text FROM counted WHERE len(w) <= {CAP}
  UNION ALL
  SELECT doc, unit_no, i, brk AND i = 0, len({part('i')}), trim(array_to_string({part('i')}, '{glue}'))
  FROM (SELECT doc, unit_no, brk, w, unnest(range(0, (len(w) - 1) // {CAP} + 1)) AS i
        FROM counted WHERE len(w) > {CAP})),
numbered AS (
  SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY unit_no, part) - 1 AS pos, brk, n, text FROM cut),
fold AS (
  SELECT doc, pos, 0 AS chunk, n AS held FROM numbered WHERE pos = 0
  UNION ALL
  SELECT p.doc, p.pos,
         CASE WHEN p.brk OR f.held + p.n > {CAP} THEN f.chunk + 1 ELSE f.chunk END,
         CASE WHEN p.brk OR f.held + p.n > {CAP} THEN p.n ELSE f.held + p.n END
  FROM fold f JOIN numbered p ON p.doc = f.doc AND p.pos = f.pos + 1),
greedy AS (
  SELECT f.doc, cast(f.chunk AS bigint) AS chunk_index, string_agg(p.text, chr(10) ORDER BY p.pos) AS text
  FROM fold f JOIN numbered p ON p.doc = f.doc AND p.pos = f.pos
  GROUP BY f.doc, f.chunk)"""


GREEDY = greedy(words("text"), " ")
# pieces of up to four characters, each with the space behind it
GREEDY_FOUR = greedy("regexp_extract_all(text, '[^ ]{1,4} ?')", "")

WINDOWS = rf"""win AS (
  SELECT doc_id, source, i AS chunk_index, array_to_string(list_slice(w, i * {CAP} + 1, i * {CAP} + {CAP}), ' ') AS text
  FROM (SELECT doc_id, source, w, unnest(range(0, (len(w) - 1) // {CAP} + 1)) AS i
        FROM (SELECT doc_id, source, {words('text')} AS w FROM documents) WHERE len(w) > 0))"""


def hashed(name: str, table: str, keys: str, text: str, d: int = EMBEDDING_DIM) -> str:
    """Sparse vectors ``name (keys, dim, v)`` and their squared norms ``name_ss``."""
    return rf"""{name}_tok AS (
  SELECT {keys}, cast('0x' || substr(md5(t), 1, 8) AS bigint) AS h
  FROM (SELECT {keys}, unnest({words(f'lower({text})')}) AS t FROM {table})),
{name} AS (
  SELECT {keys}, h % {d} AS dim, cast(sum(CASE WHEN (h // {d}) % 2 = 0 THEN 1 ELSE -1 END) AS bigint) AS v
  FROM {name}_tok GROUP BY {keys}, h % {d}
  HAVING sum(CASE WHEN (h // {d}) % 2 = 0 THEN 1 ELSE -1 END) <> 0),
{name}_ss AS (SELECT {keys}, cast(sum(v * v) AS bigint) AS ss FROM {name} GROUP BY {keys})"""


QUESTIONS = "questions AS (SELECT item_id AS qid, text AS question FROM benchmark)"


def hits(chunks: str) -> str:
    """Ranked hits with texts over a CTE ``chunks_v (source_file, chunk_index, text)``."""
    return f"""{chunks},
{QUESTIONS},
{hashed('cv', 'chunks_v', 'source_file, chunk_index', 'text')},
{hashed('qv', 'questions', 'qid', 'question')},
scored AS (
  SELECT q.qid, c.source_file, c.chunk_index, sum(q.v * c.v) AS dp
  FROM qv q JOIN cv c ON c.dim = q.dim GROUP BY q.qid, c.source_file, c.chunk_index),
ranked AS (
  SELECT s.qid, s.source_file, s.chunk_index, s.dp / sqrt(cast(c.ss * q.ss AS double)) AS score
  FROM scored s JOIN cv_ss c ON c.source_file = s.source_file AND c.chunk_index = s.chunk_index
  JOIN qv_ss q ON q.qid = s.qid),
hits AS (
  SELECT r.qid, r.rk, r.source_file, r.chunk_index, r.score, t.text
  FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, source_file, chunk_index) AS rk
        FROM ranked) r
  JOIN chunks_v t ON t.source_file = r.source_file AND t.chunk_index = r.chunk_index
  WHERE r.rk <= {TOP_K})"""


WINDOW_HITS = hits(WINDOWS + ",\nchunks_v AS (SELECT doc_id AS source_file, chunk_index, text FROM win)")
GREEDY_HITS = hits(
    ",\n".join([LINES, DOC_UNITS, GREEDY])
    + ",\nchunks_v AS (SELECT doc AS source_file, chunk_index, text FROM greedy)"
)

PROMPTS = f"""blocks AS (
  SELECT qid, count(*) AS n_sources,
         string_agg('[Source: ' || source_file || ', chunk ' || chunk_index || ', score: '
                    || printf('%.3f', score) || ']' || chr(10) || text, {lit(CONTEXT_SEPARATOR)} ORDER BY rk) AS context,
         max(CASE WHEN rk = 1 THEN string_split(text, chr(10))[1] END) AS answer
  FROM hits GROUP BY qid),
prompts AS (
  SELECT q.qid, q.question, coalesce(b.n_sources, 0) AS n_sources, coalesce(b.context, '') AS context,
         coalesce(b.answer, {lit(NOT_IN_CONTEXT)}) AS answer,
         {lit(SYSTEM_SENTENCES)} || chr(10) || chr(10) || {lit(CONTEXT_HEADER)} || chr(10) || chr(10)
         || coalesce(b.context, '') || chr(10) || chr(10) || {lit(QUESTION_HEADER)} || chr(10) || chr(10)
         || q.question || chr(10) || chr(10) || {lit(ANSWER_HEADER)} || chr(10) || chr(10) AS prompt
  FROM questions q LEFT JOIN blocks b ON b.qid = q.qid)"""

RUN_LOG = r"""run_log0 AS (
  SELECT event_id, ts, user_id, value,
         CASE WHEN event_type = 'error' AND value >= 100 THEN 'timeout' WHEN event_type = 'error' THEN 'error'
              WHEN event_type = 'signup' THEN 'empty' ELSE 'success' END AS status,
         cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS bigint) AS k
  FROM events),
run_log AS (
  SELECT 'doc-' || event_id || '.pdf' AS source_file, status,
         CASE WHEN status IN ('success', 'empty') THEN k ELSE 0 END AS page_count,
         CASE WHEN status = 'success' THEN k ELSE 0 END AS chunk_count,
         CASE status WHEN 'timeout' THEN 'Timed out after 600s' WHEN 'error' THEN 'bad event ' || event_id
              WHEN 'empty' THEN 'No chunks produced' ELSE '' END AS error,
         value AS duration_s, 'host-' || (user_id % 8) AS actor_host, ts AS finished_at
  FROM run_log0)"""

WALL = "(epoch_us(max(finished_at)) / 1e6 - epoch_us(min(finished_at)) / 1e6)"

_COS = "list_cosine_similarity(cast(q.embedding AS double[]), cast(v.embedding AS double[]))"


def nearest(vectors: str = "embeddings") -> str:
    return f"""SELECT qid, rk, vec_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rk FROM (
    SELECT q.vec_id AS qid, v.vec_id AS vec_id, {_COS} AS score FROM embeddings q CROSS JOIN {vectors} v))
WHERE rk <= {TOP_K}"""


def lloyd(points: str, nlist: str, iterations: int = 3) -> str:
    """Cells of ``points (key, vec double[])``: CTEs up to ``centroids (cell_id, vec)``, ``close (key, cell_id, place)`` and ``assigned``."""
    out = [
        f"""nl AS ({nlist}),
c0 AS (
  SELECT cell_id, vec FROM (SELECT row_number() OVER (ORDER BY md5(key)) - 1 AS cell_id, vec FROM {points})
  WHERE cell_id < (SELECT n FROM nl))"""
    ]
    for i in range(iterations):
        out.append(f"""a{i} AS (
  SELECT key, vec, cell_id FROM (
    SELECT p.key, p.vec, c.cell_id, row_number() OVER (PARTITION BY p.key ORDER BY list_cosine_similarity(p.vec, c.vec) DESC, c.cell_id) AS place
    FROM {points} p CROSS JOIN c{i} c) WHERE place = 1),
m{i} AS (
  SELECT cell_id, list(x ORDER BY dim) AS vec FROM (
    SELECT cell_id, dim, round(sum(x) / count(*), 6) AS x FROM (
      SELECT cell_id, unnest(vec) / sqrt(list_inner_product(vec, vec)) AS x, generate_subscripts(vec, 1) AS dim FROM a{i})
    GROUP BY cell_id, dim) GROUP BY cell_id),
c{i + 1} AS (SELECT c.cell_id, coalesce(m.vec, c.vec) AS vec FROM c{i} c LEFT JOIN m{i} m ON m.cell_id = c.cell_id)""")
    out.append(f"""close AS (
  SELECT p.key, c.cell_id, row_number() OVER (PARTITION BY p.key ORDER BY list_cosine_similarity(p.vec, c.vec) DESC, c.cell_id) AS place
  FROM {points} p CROSS JOIN c{iterations} c),
assigned AS (SELECT key, cell_id FROM close WHERE place = 1)""")
    return ",\n".join(out)


#: Trained cells over the embeddings, and as many of them probed as it takes.
CELLS = f"""points AS (SELECT CAST(vec_id AS VARCHAR) AS key, vec_id, CAST(embedding AS double[]) AS vec FROM embeddings),
{lloyd("points", "SELECT CAST(floor(sqrt(count(*))) AS bigint) AS n FROM embeddings")},
exact AS ({nearest()}),
places AS (
  SELECT c.place FROM exact e JOIN assigned a ON a.key = CAST(e.vec_id AS VARCHAR)
  JOIN close c ON c.key = CAST(e.qid AS VARCHAR) AND c.cell_id = a.cell_id
  WHERE e.qid % greatest(1, (SELECT count(*) FROM embeddings) // {MEASURED_QUERIES}) = 0),
np AS (
  SELECT min(place) AS n FROM (SELECT place, sum(count(*)) OVER (ORDER BY place) AS seen, sum(count(*)) OVER () AS every FROM places GROUP BY place)
  WHERE seen >= {TARGET_RECALL} * every),
near AS (
  SELECT qid, vec_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rk FROM (
    SELECT q.vec_id AS qid, v.vec_id, {_COS} AS score
    FROM close c JOIN assigned a ON a.cell_id = c.cell_id
    JOIN embeddings v ON CAST(v.vec_id AS VARCHAR) = a.key JOIN embeddings q ON CAST(q.vec_id AS VARCHAR) = c.key
    WHERE c.place <= (SELECT n FROM np))),
ivf AS (SELECT qid, rk, vec_id, round(score, 6) AS score FROM near WHERE rk <= {TOP_K})"""


_RECALL = _with(
    CELLS,
    select="""SELECT count(*) AS expected, count(i.vec_id) AS found,
  round(count(i.vec_id) / cast(count(*) AS double), 6) AS recall
FROM exact e LEFT JOIN ivf i ON i.qid = e.qid AND i.vec_id = e.vec_id""",
)


def _health() -> str:
    rows = []
    for metric, direction, warn, alert in THRESHOLDS:
        op = ">" if direction == "above" else "<"
        rows.append(
            f"SELECT '{metric}' AS metric, round({metric}, 6) AS value, "
            f"CASE WHEN {metric} {op} {alert} THEN 'alert' WHEN {metric} {op} {warn} THEN 'warn' ELSE 'ok' END AS level FROM m"
        )
    return _with(
        RUN_LOG,
        f"""m AS (
  SELECT count(*) FILTER (WHERE status = 'success') / {WALL} AS files_per_second,
         sum(chunk_count) / {WALL} AS chunks_per_second,
         count(*) FILTER (WHERE status = 'timeout') / cast(count(*) AS double) AS timeout_rate,
         count(*) FILTER (WHERE status = 'error') / cast(count(*) AS double) AS error_rate,
         avg(duration_s) AS avg_duration_s
  FROM run_log)""",
        select="\nUNION ALL\n".join(rows),
    )



PACKED_TASKS = 24
_PACKED = f"""cost AS (SELECT doc_id, cast(coalesce(strlen(text), 0) AS double) + {FILE_BYTES} AS cost FROM documents),
mean AS (SELECT sum(cost) / {PACKED_TASKS} AS mean FROM cost),
large AS (
  SELECT doc_id, cost, CASE WHEN (pos // {PACKED_TASKS}) % 2 = 0 THEN pos % {PACKED_TASKS} ELSE {PACKED_TASKS - 1} - pos % {PACKED_TASKS} END AS task
  FROM (SELECT doc_id, cost, row_number() OVER (ORDER BY cost DESC, doc_id) - 1 AS pos FROM cost, mean WHERE cost * {LARGE_PARTS} > mean)),
small AS (
  SELECT doc_id, cost, sum(cost) OVER (ORDER BY cost DESC, doc_id ROWS UNBOUNDED PRECEDING) - cost / 2 AS middle, sum(cost) OVER () AS whole
  FROM cost, mean WHERE NOT cost * {LARGE_PARTS} > mean),
room AS (
  SELECT task, greatest(mean - coalesce((SELECT sum(cost) FROM large l WHERE l.task = t.task), 0), 0) AS room
  FROM (SELECT unnest(range({PACKED_TASKS})) AS task) t, mean),
piece AS (SELECT task, room, sum(room) OVER (ORDER BY task) - room AS before, sum(room) OVER () AS rooms FROM room),
packed AS (
  SELECT doc_id, cost, task FROM large
  UNION ALL
  SELECT doc_id, cost, (SELECT max(task) FROM piece WHERE room > 0 AND before * (whole / rooms) <= middle) FROM small)"""


def _of_model(model: str, dim: int) -> str:
    """CTEs up to ``<model>_hits``: every question against all chunks, under vectors of ``dim`` components."""
    c, q = f"{model}_c", f"{model}_q"
    return f"""{hashed(c, 'chunks_v', 'source_file, chunk_index', 'text', dim)},
{hashed(q, 'questions', 'qid', 'question', dim)},
{model}_dots AS (
  SELECT q.qid, c.source_file, c.chunk_index, sum(q.v * c.v) AS dp FROM {q} q JOIN {c} c ON c.dim = q.dim GROUP BY ALL),
{model}_all AS (
  SELECT q.qid, c.source_file, c.chunk_index, coalesce(s.dp, 0) / sqrt(cast(c.ss * q.ss AS double)) AS score
  FROM {q}_ss q CROSS JOIN {c}_ss c LEFT JOIN {model}_dots s ON s.qid = q.qid AND s.source_file = c.source_file AND s.chunk_index = c.chunk_index),
{model}_hits AS (
  SELECT '{model}-' || qid AS qid, rk, source_file, chunk_index, round(score, 6) AS score
  FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, source_file, chunk_index) AS rk FROM {model}_all) WHERE rk <= {TOP_K})"""


ORACLE = {
    "rag_end_to_end": _with(
        GREEDY_HITS, PROMPTS, select="SELECT qid, question, answer, n_sources, prompt FROM prompts", recursive=True
    ),
    "nonblank_lines": _with(
        LINES, select=r"SELECT doc_id, line_no, line FROM lines WHERE regexp_matches(line, '\S')"
    ),
    "doc_units": _with(LINES, DOC_UNITS, select="SELECT doc AS doc_id, unit_no, kind, heading, text FROM units"),
    "page_units": _with(PAGE_UNITS, select="SELECT doc AS page_id, unit_no, kind, heading, text FROM units"),
    "page_chunks": _with(
        PAGE_UNITS, GREEDY, select="SELECT doc AS page_id, chunk_index, text FROM greedy", recursive=True
    ),
    "token_counts": f"SELECT doc_id, len({words('text')}) AS n_tokens FROM documents",
    "tokenizer_counts": r"SELECT doc_id, len(regexp_extract_all(text, '[^\s]{1,4}')) AS n_tokens FROM documents",
    "tokenizer_chunks": _with(
        LINES, DOC_UNITS, GREEDY_FOUR, select="SELECT doc AS doc_id, chunk_index, text FROM greedy", recursive=True
    ),
    "token_windows": _with(WINDOWS, select="SELECT doc_id, chunk_index, text FROM win"),
    "greedy_chunks": _with(
        LINES, DOC_UNITS, GREEDY, select="SELECT doc AS doc_id, chunk_index, text FROM greedy", recursive=True
    ),
    "chunk_index_modes": _with(
        LINES,
        select=r"""SELECT doc_id, line_no AS position_index,
  row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS dense_index, line AS text
FROM lines WHERE regexp_matches(line, '\S')""",
    ),
    "chunks_per_doc": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True,
        select="""SELECT d.doc_id, count(g.chunk_index) AS n_chunks
FROM documents d LEFT JOIN greedy g ON g.doc = d.doc_id GROUP BY d.doc_id""",
    ),
    "corpus_size": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True,
        select="""SELECT documents, chunks, text_bytes, round(chunks / cast(documents AS double), 6) AS chunks_per_document,
  round(text_bytes / cast(chunks AS double), 6) AS bytes_per_chunk
FROM (SELECT (SELECT count(*) FROM documents) AS documents, count(*) AS chunks,
             cast(sum(strlen(text)) AS bigint) AS text_bytes FROM greedy)""",
    ),
    "hashed_embedding": _with(QUESTIONS, hashed("qv", "questions", "qid", "question"), select="SELECT qid, dim, v FROM qv"),
    "chunk_embedding": _with(
        WINDOWS, hashed("cv", "win", "doc_id, chunk_index", "text"),
        select="""SELECT w.doc_id, w.chunk_index, count(cv.dim) AS nonzero,
  cast(coalesce(sum(cv.v * cv.v), 0) AS bigint) AS energy,
  cast(coalesce(sum(cv.v * (cv.dim + 1)), 0) AS bigint) AS weighted
FROM win w LEFT JOIN cv ON cv.doc_id = w.doc_id AND cv.chunk_index = w.chunk_index
GROUP BY w.doc_id, w.chunk_index""",
    ),
    "l2_normalize": """SELECT vec_id, pos, round(CASE WHEN norm > 0 THEN x / norm ELSE x END, 6) AS x FROM (
  SELECT vec_id, cast(unnest(embedding) AS double) AS x, generate_subscripts(embedding, 1) - 1 AS pos,
         sqrt(list_sum(list_transform(cast(embedding AS double[]), lambda e: e * e))) AS norm
  FROM embeddings)""",
    "dim_validation": "SELECT len(embedding) = 64 AS valid, count(*) AS vectors FROM embeddings GROUP BY 1",
    "response_reorder": """SELECT vec_id, cast(0 AS bigint) AS index, round(cast(embedding[1] AS double), 6) AS first,
  round(cast(embedding[len(embedding)] AS double), 6) AS last FROM embeddings
UNION ALL
SELECT vec_id, 1, round(cast(embedding[len(embedding)] AS double), 6), round(cast(embedding[1] AS double), 6) FROM embeddings""",
    "topk_single": f"""SELECT v.vec_id, round({_COS}, 6) AS score
FROM (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q CROSS JOIN embeddings v
ORDER BY {_COS} DESC, v.vec_id LIMIT {TOP_K}""",
    "topk_batch": nearest(),
    "topk_blocks": nearest(),
    "topk_filtered": nearest("(SELECT * FROM embeddings WHERE label >= 5)"),
    "nlist_rule": "SELECT cast(floor(sqrt(count(*))) AS bigint) AS nlist FROM embeddings",
    "ivf_assign": _with(CELLS, select="SELECT CAST(key AS BIGINT) AS vec_id, cell_id FROM assigned"),
    "ivf_topk": _with(CELLS, select="SELECT qid, rk, vec_id, score FROM ivf"),
    "ivf_blocks": _with(CELLS, select="SELECT qid, rk, vec_id, score FROM ivf"),
    "ivf_recall": _RECALL,
    "ivf_trained_full_probe": nearest(),
    "context_block": _with(WINDOW_HITS, PROMPTS, select="SELECT qid, context FROM prompts"),
    "build_prompt": _with(WINDOW_HITS, PROMPTS, select="SELECT qid, prompt FROM prompts"),
    "prompt_length": _with(WINDOW_HITS, PROMPTS, select="SELECT qid, length(prompt) AS prompt_length FROM prompts"),
    "extractive_answer": _with(WINDOW_HITS, PROMPTS, select="SELECT qid, answer FROM prompts"),
    "rag_sources": _with(WINDOW_HITS, select="SELECT qid, rk, source_file, chunk_index, score FROM hits"),
    "rag_retrieval": _with(
        WINDOW_HITS,
        select="SELECT qid, rk, source_file, chunk_index, score, substr(text, 1, 500) || '...' AS preview FROM hits",
    ),
    "rag_vs_direct": _with(
        WINDOW_HITS, PROMPTS,
        select="""SELECT qid, question, answer AS rag_answer, string_split(question, chr(10))[1] AS direct_answer
FROM prompts""",
    ),
    "generated_answers": "SELECT item_id AS qid, string_split(text, chr(10))[1] AS answer FROM benchmark",
    "clean_questions": r"""SELECT conv_id, turn, question FROM (
  SELECT conv_id, turn, regexp_replace(text, '^\s+|\s+$', '', 'g') AS question FROM conversations WHERE role = 'user')
WHERE question <> '' AND lower(question) NOT IN ('quit', 'exit', 'q')""",
    "doc_status": _with(
        RUN_LOG, select="SELECT source_file, status, page_count, chunk_count, substr(error, 1, 200) AS error FROM run_log"
    ),
    "run_report": _with(
        RUN_LOG,
        select="""SELECT count(*) AS total_files, count(*) FILTER (WHERE status = 'success') AS success,
  count(*) FILTER (WHERE status = 'empty') AS empty, count(*) FILTER (WHERE status = 'error') AS errors,
  count(*) FILTER (WHERE status = 'timeout') AS timeouts, cast(sum(page_count) AS bigint) AS total_pages,
  cast(sum(chunk_count) AS bigint) AS total_chunks, round(avg(duration_s), 3) AS avg_duration_s
FROM run_log""",
    ),
    "worker_distribution": _with(
        RUN_LOG,
        select="""SELECT actor_host, count(*) AS files, round(count(*) / cast((SELECT count(*) FROM run_log) AS double) * 100, 1) AS pct
FROM run_log GROUP BY actor_host""",
    ),
    "source_distribution": """SELECT source, count(*) AS files,
  round(count(*) / cast((SELECT count(*) FROM documents) AS double) * 100, 1) AS pct FROM documents GROUP BY source""",
    "first_errors": _with(
        RUN_LOG,
        select="""SELECT source_file, substr(error, 1, 80) AS error FROM run_log
WHERE status IN ('error', 'timeout') ORDER BY source_file LIMIT 10""",
    ),
    "throughput": _with(
        RUN_LOG,
        select=f"""SELECT round({WALL}, 3) AS wall_clock_s,
  round(count(*) FILTER (WHERE status = 'success') / {WALL}, 6) AS files_per_second,
  round(cast(sum(chunk_count) AS bigint) / {WALL}, 6) AS chunks_per_second FROM run_log""",
    ),
    "progress_eta": _with(
        RUN_LOG,
        "ticks AS (SELECT epoch_us(finished_at) // 30000000 AS tick, count(*) AS n FROM run_log GROUP BY 1)",
        """steps AS (
  SELECT cast(sum(n) OVER (ORDER BY tick) AS bigint) AS processed, cast(sum(n) OVER () AS bigint) AS total,
         (tick - min(tick) OVER () + 1) * 30 AS elapsed_s FROM ticks)""",
        select="""SELECT elapsed_s, processed, round(processed * 100 / cast(total AS double), 6) AS pct,
  round(processed / cast(elapsed_s AS double), 6) AS rate,
  round((total - processed) / (processed / cast(elapsed_s AS double)) / 60, 3) AS eta_min FROM steps""",
    ),
    "output_objects": _with(
        RUN_LOG, select="SELECT count(DISTINCT source_file) AS objects FROM run_log WHERE chunk_count > 0"
    ),
    "reconcile": _with(
        LINES, DOC_UNITS, GREEDY, WINDOWS, recursive=True,
        select="""SELECT d.doc_id, coalesce(g.n, 0) AS expected, coalesce(w.n, 0) AS stored,
  coalesce(g.n, 0) = coalesce(w.n, 0) AS matches
FROM documents d LEFT JOIN (SELECT doc, count(*) AS n FROM greedy GROUP BY doc) g ON g.doc = d.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS n FROM win GROUP BY doc_id) w ON w.doc_id = d.doc_id""",
    ),
    "health_alerts": _health(),
    "error_capture": r"""SELECT event_id, CASE WHEN k < 50 THEN 'success' ELSE 'error' END AS status,
  CASE WHEN k < 50 THEN k END AS value, CASE WHEN k < 50 THEN '' ELSE 'not a number: k' || k END AS error
FROM (SELECT event_id, cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS bigint) AS k FROM events)""",
    "scan_first_n": "SELECT url AS path, page_id FROM pages ORDER BY url, page_id LIMIT 25",
    "empty_source_status": """SELECT doc_id, strlen(text) AS length, CASE WHEN strlen(text) = 0 THEN 'error' ELSE 'success' END AS status,
  CASE WHEN strlen(text) = 0 THEN 'File empty' ELSE '' END AS error FROM documents""",
    "jsonl_roundtrip": _with(
        WINDOWS, select="SELECT cast(doc_id AS varchar) AS source_file, chunk_index, text FROM win"
    ),
    "collection_count": "SELECT count(*) AS row_count FROM embeddings",
    "filtered_sample": "SELECT vec_id, cast(label AS bigint) AS label FROM embeddings WHERE label >= 5 ORDER BY vec_id LIMIT 5",
    "length_quarantine": """SELECT doc_id, CASE WHEN strlen(text) > 8192 THEN 'text too long' ELSE '' END AS problem
FROM documents""",
    "url_basename_stem": r"""SELECT page_id, name, regexp_extract(name, '(?s)^(.+?)(\.[^.]*)?$', 1) AS stem
FROM (SELECT page_id, string_split(url, '/')[-1] AS name FROM pages)""",
    "text_preview": "SELECT doc_id, substr(text, 1, 200) || '...' AS preview FROM documents",
    "safe_name": """SELECT doc_id, translate(lower(string_split(m, '/')[-1]), '_.', '--') AS service, replace(m, '/', '--') AS cache
FROM (SELECT doc_id, source || '/' || lang || '_v0.3' AS m FROM documents)""",
    "incremental_new": "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "retry_failed": _with(
        RUN_LOG,
        select="SELECT source_file, duration_s, cast(2 AS bigint) AS attempt FROM run_log WHERE status IN ('error', 'timeout')",
    ),
    "stream_ingest": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True,
        select=f"SELECT cast(doc AS varchar) AS source_file, chunk_index, text, cast({EMBEDDING_DIM} AS bigint) AS dim FROM greedy",
    ),
}


# ---- whole pipelines and collections ---------------------------------------------------------

_CHUNKS = _with(LINES, DOC_UNITS, GREEDY, select="SELECT doc AS doc_id, chunk_index, text FROM greedy", recursive=True)
_LETTERS = " || ',' || ".join(f"(length(lower(text)) - length(replace(lower(text), '{c}', '')))" for c in "etaoinsh")

ORACLE |= {
    "two_step_collection": _CHUNKS,
    "one_step_collection": _CHUNKS,
    "append_incremental": _CHUNKS,
    "stream_two_versions": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True,
        select="""SELECT doc AS doc_id, chunk_index, text FROM greedy WHERE doc % 10 >= 2
UNION ALL SELECT doc_id, 0, 'second version' FROM documents WHERE doc_id % 10 = 0""",
    ),
    "stream_compacted": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True,
        select="""SELECT doc AS doc_id, chunk_index, text FROM greedy WHERE doc % 10 >= 2
UNION ALL SELECT doc_id, 0, 'second version' FROM documents WHERE doc_id % 10 = 0""",
    ),
    "stream_compaction_report": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True,
        select="""SELECT (SELECT count(*) FROM greedy WHERE doc % 10 >= 2) + count(*) FILTER (WHERE doc_id % 10 = 0) AS live_rows,
  count(*) AS documents, count(*) FILTER (WHERE doc_id % 10 = 1) + count(*) FILTER (WHERE doc_id % 10 >= 2 AND NOT regexp_matches(text, '\\S')) AS tombstones,
  (SELECT count(*) FROM greedy) + count(*) FILTER (WHERE doc_id % 10 = 0) AS streamed_rows FROM documents""",
    ),
    "retry_until_done": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True,
        select="""SELECT d.doc_id, least(d.doc_id % 5 + 1, 3) AS attempt,
  CASE WHEN d.doc_id % 5 >= 3 THEN 'error' WHEN count(g.chunk_index) > 0 THEN 'success' ELSE 'empty' END AS status,
  CASE WHEN d.doc_id % 5 >= 3 THEN 0 ELSE count(g.chunk_index) END AS chunk_count,
  CASE WHEN d.doc_id % 5 >= 3 THEN 'not before attempt ' || (d.doc_id % 5 + 1) WHEN count(g.chunk_index) > 0 THEN '' ELSE 'No chunks produced' END AS error,
  d.doc_id % 5 >= 3 AS quarantine
FROM documents d LEFT JOIN greedy g ON g.doc = d.doc_id GROUP BY d.doc_id""",
    ),
    "retry_chunks": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True, select="SELECT doc AS doc_id, chunk_index, text FROM greedy WHERE doc % 5 < 3"
    ),
    "observed_run": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True,
        select="""SELECT count(*) AS total_files, count(*) FILTER (WHERE n > 0) AS success, count(*) FILTER (WHERE n = 0) AS empty,
  0 AS errors, 0 AS timeouts, count(*) AS total_pages, cast(sum(n) AS bigint) AS total_chunks, 0.0::double AS avg_duration_s
FROM (SELECT d.doc_id, count(g.chunk_index) AS n FROM documents d LEFT JOIN greedy g ON g.doc = d.doc_id GROUP BY d.doc_id)""",
    ),
    "pipeline_log": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True,
        select="""SELECT d.doc_id, CASE WHEN count(g.chunk_index) > 0 THEN 'success' ELSE 'empty' END AS status,
  count(g.chunk_index) AS chunk_count, count(g.chunk_index) AS chunks_inserted
FROM documents d LEFT JOIN greedy g ON g.doc = d.doc_id GROUP BY d.doc_id""",
    ),
    "collection_label": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True, select="SELECT 'labelled:' || count(*) AS label FROM greedy"
    ),
    "parse_outcomes": """
SELECT doc_id,
  CASE WHEN doc_id = 5 THEN 'timeout' WHEN doc_id % 7 = 1 THEN 'error' WHEN doc_id % 7 = 2 THEN 'empty' ELSE 'success' END AS status,
  CASE WHEN doc_id = 5 OR doc_id % 7 = 1 THEN 0 ELSE 2 END AS page_count,
  CASE WHEN doc_id = 5 THEN 'Timed out after 2s' WHEN doc_id % 7 = 1 THEN 'cannot read this file'
       WHEN doc_id % 7 = 2 THEN 'No chunks produced' ELSE '' END AS error,
  true AS has_host, doc_id = 5 AS slow
FROM documents""",
    "collection_lifecycle": _with(
        LINES, DOC_UNITS, GREEDY, "n AS (SELECT CAST(count(*) AS VARCHAR) AS n FROM greedy)", recursive=True,
        select="""SELECT 'exists before' AS fact, 'false' AS value UNION ALL SELECT 'exists', 'true' UNION ALL SELECT 'listed', 'true'
UNION ALL SELECT 'found in', 'default' UNION ALL SELECT 'rows', n FROM n
UNION ALL SELECT 'columns', 'id,source_file,chunk_index,text,embedding,source_key'
UNION ALL SELECT 'loaded rows', n FROM n UNION ALL SELECT 'exists after', 'false'""",
    ),
    "ivf_stored_recall": _RECALL,
    "embedder_modes": f"SELECT item_id, {_LETTERS} AS local, {_LETTERS} AS remote FROM benchmark",
    "several_models": "SELECT item_id, 'second' AS model FROM benchmark",
    "generator_per_query": """
SELECT item_id, model, CASE WHEN model <> 'unknown' THEN model || ': ' || length(text) END AS answer
FROM (SELECT *, ['small', 'large', 'unknown'][item_id % 3 + 1] AS model FROM benchmark)""",
    "endpoint_pipelined": f"""SELECT item_id, CASE WHEN length(text) % 7 <> 0 THEN {_LETTERS} END AS vector,
  CASE WHEN length(text) % 7 = 0 THEN 'Refused: refused' END AS error FROM benchmark""",
    "packed_tasks": f"WITH {_PACKED} SELECT doc_id, task FROM packed",
    "packed_balance": f"""WITH {_PACKED}
SELECT count(*) AS tasks, cast(sum(files) AS bigint) AS files, round(max(cost) / (sum(cost) / {PACKED_TASKS}), 6) AS greatest_to_mean
FROM (SELECT task, sum(cost) AS cost, count(*) AS files FROM packed GROUP BY task)""",
    "chunk_lines_account": _with(
        LINES, DOC_UNITS, GREEDY, recursive=True,
        select="""SELECT 'run-' || (doc % 2) AS run_id, count(*) AS lines, doc % 10 NOT IN (3, 4) AS readable
FROM greedy GROUP BY ALL""",
    ),
    "models_keyed_topk": _with(
        LINES, DOC_UNITS, GREEDY, "chunks_v AS (SELECT doc AS source_file, chunk_index, text FROM greedy)", QUESTIONS,
        _of_model("short", 64), _of_model("long", 384), recursive=True,
        select="SELECT * FROM short_hits UNION ALL SELECT * FROM long_hits",
    ),
}
