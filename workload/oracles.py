"""Oracle SQL: the same results computed independently, over the same tables."""

from __future__ import annotations

from chunkwright.functions.text import BLANK_CHARS
from chunkwright.functions.tokens import TOKEN_PATTERN
from chunkwright.operators import permutation, prompts
from chunkwright.schemas import CHECK_NAMES
from workload import fixtures as fx

SPACE = rf"[\n{BLANK_CHARS}]"
WORD = rf"[^\n{BLANK_CHARS}]+"


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def uuid_of(text: str) -> str:
    h = f"sha256({text})"
    variant = f"substr('89ab', ((strpos('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4) + 1, 1)"
    return (
        f"concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-4', substr({h}, 14, 3), '-', {variant}, "
        f"substr({h}, 18, 3), '-', substr({h}, 21, 12))"
    )


MD = (
    "md AS (SELECT doc_id, "
    + ", ".join(f"{sql} AS {name}" for name, sql in fx.DOCUMENT.items() if name != "text")
    + f", {fx.MARKDOWN} AS text FROM documents)"
)
LINES = f"""
cut AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        unnest(range(len(string_split(text, chr(10))))) AS i FROM md),
placed AS (SELECT doc_id, i, line, regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g') AS st,
        coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM cut),
marked AS (SELECT *, lag(pos) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM placed),
breaks AS (SELECT DISTINCT doc_id, CAST(off AS INTEGER) AS off FROM (
   SELECT doc_id, CASE WHEN st LIKE '#%' THEN pos
     WHEN i > 0 AND regexp_full_match(st, '=+|-+') THEN prev
     WHEN st = '' AND pos > 0 THEN pos END AS off FROM marked) WHERE off IS NOT NULL)"""


def chunk_ctes(max_tokens: int, overlap: int, tolerance: int, semantic: bool = True) -> str:
    def end(s: str) -> str:
        target = f"({s} + {max_tokens})"
        if not semantic:
            return f"least({target}, d.n)"
        near = f"""list_sort(list_transform(list_filter(d.br, lambda b:
           b.off >= d.ce[greatest(0, {target} - {tolerance}) + 1] AND b.off <= d.ce[least(d.n, {target} + {tolerance}) + 1]),
           lambda b: struct_pack(dist := abs(b.off - d.ce[{target} + 1]), off := b.off, tok := b.tok)))[1].tok"""
        return f"CASE WHEN {target} >= d.n THEN d.n ELSE coalesce({near}, {target}) END"

    return f"""{MD}, {LINES},
toks AS (SELECT doc_id, unnest(regexp_extract_all(text, '{TOKEN_PATTERN}')) AS tok,
   unnest(range(len(regexp_extract_all(text, '{TOKEN_PATTERN}')))) AS t FROM md),
ends AS (SELECT doc_id, t, sum(length(tok)) OVER (PARTITION BY doc_id ORDER BY t) AS ce FROM toks),
lists AS (SELECT doc_id, count(*) AS n, list_prepend(0, list(CAST(ce AS BIGINT) ORDER BY t)) AS ce FROM ends GROUP BY doc_id),
brl AS (SELECT doc_id, list(struct_pack(off := off, tok := len(regexp_extract_all(text[:off], '{TOKEN_PATTERN}'))) ORDER BY off) AS br
   FROM breaks JOIN md USING (doc_id) GROUP BY doc_id),
d AS (SELECT lists.*, coalesce(brl.br, []) AS br FROM lists LEFT JOIN brl USING (doc_id)),
walk AS (SELECT d.doc_id, 0 AS i, CAST(0 AS BIGINT) AS s, CAST({end('0')} AS BIGINT) AS e FROM d
  UNION ALL SELECT d.doc_id, walk.i + 1, walk.e - {overlap}, CAST({end(f'(walk.e - {overlap})')} AS BIGINT)
  FROM walk JOIN d ON walk.doc_id = d.doc_id WHERE walk.e < d.n),
chunks AS (SELECT doc_id, concat('sha256:', sha256(concat(project, '|', file_path, '|', CAST(i AS VARCHAR), '|', sha1(md.text)))) AS chunk_id,
  project, file_path, file_name, CAST(i AS INTEGER) AS chunk_index,
  CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS total_chunks,
  CAST(s AS INTEGER) AS token_start, CAST(e AS INTEGER) AS token_end,
  substr(md.text, CAST(d.ce[s + 1] + 1 AS BIGINT), CAST(d.ce[e + 1] - d.ce[s + 1] AS BIGINT)) AS text, sha1(md.text) AS file_sha1
  FROM walk JOIN d USING (doc_id) JOIN md USING (doc_id))"""


CHUNKS = "WITH RECURSIVE " + chunk_ctes(64, 8, 6)
REPLIES = f"""{CHUNKS},
parts AS (SELECT *, {fx.CASE_OF_CHUNK} AS k, {", ".join(f"{sql} AS {name}" for name, sql in fx.REPLY_PARTS.items())} FROM chunks),
bodies AS (SELECT *, {fx.REPLY_BODY} AS body FROM parts),
replies AS (SELECT *, {fx.REPLY} AS content FROM bodies)"""
ELEMENTS = f"""{REPLIES},
elements AS (
  SELECT chunk_id, doc_id, project, file_path, file_name, chunk_index, 0 AS position,
    CASE WHEN k IN (4, 5) THEN {fx.ESCAPED_PROBLEM} WHEN k = 11 THEN '7' ELSE {fx.PROBLEM_1} END AS problem,
    {fx.SOLUTION_1} AS solution, k <> 11 AS problem_is_text FROM replies WHERE k NOT IN (8, 9, 10)
  UNION ALL SELECT chunk_id, doc_id, project, file_path, file_name, chunk_index, 1,
    {fx.PROBLEM_2}, {fx.SOLUTION_2}, true FROM replies WHERE k IN (0, 1, 2, 3, 4, 5, 11)),
items AS (SELECT {uuid_of("concat(chunk_id, '|', CAST(position AS VARCHAR))")} AS id, chunk_id, doc_id, project, file_path, file_name,
    chunk_index, position, CASE WHEN problem_is_text THEN problem END AS problem, solution FROM elements)"""


def _at(tag: str) -> str:
    return f"strpos(solution, '{tag}')"


_TB, _TE = _at(prompts.THOUGHT_BEGIN), _at(prompts.THOUGHT_END)
_SB, _SE = _at(prompts.SOLUTION_BEGIN), _at(prompts.SOLUTION_END)
_CHECKS = {
    "json_schema_valid": "problem IS NOT NULL",
    "messages_shape_valid": "true",
    "has_thought_begin_token": f"{_TB} > 0",
    "has_thought_end_token": f"{_TE} > 0",
    "thought_tags_properly_paired": f"({_TB} > 0) = ({_TE} > 0)",
    "has_solution_begin_token": f"{_SB} > 0",
    "has_solution_end_token": f"{_SE} > 0",
    "solution_tags_properly_paired": f"({_SB} > 0) = ({_SE} > 0)",
    "tags_in_correct_order": f"{_TB} > 0 AND {_SB} > 0 AND {_TB} < {_SB}",
    "thought_tags_properly_nested": f"CASE WHEN {_TB} > 0 AND {_TE} > 0 THEN {_TB} < {_TE} ELSE ({_TB} > 0) = ({_TE} > 0) END",
    "solution_tags_properly_nested": f"CASE WHEN {_SB} > 0 AND {_SE} > 0 THEN {_SB} < {_SE} ELSE ({_SB} > 0) = ({_SE} > 0) END",
    "final_answer_boxed_if_required": "true",
}
CHECKED = f"""{ELEMENTS},
checked AS (SELECT *, {", ".join(f"{sql} AS {name}" for name, sql in _CHECKS.items())} FROM items),
erred AS (SELECT *, concat_ws(',', {", ".join(f"CASE WHEN NOT {n} THEN '{n}' END" for n in CHECK_NAMES)}) AS local_errors FROM checked)"""
REPORTED = f"""{CHECKED},
reported AS (SELECT erred.*,
  CASE WHEN local_errors <> '' THEN false WHEN quality IS NULL OR toxic = 1 THEN true ELSE quality = 1 END AS passed,
  CASE WHEN local_errors <> '' THEN local_errors
   WHEN quality IS NULL THEN 'Model verification error: no reply'
   WHEN toxic = 1 THEN 'Verifier JSON parse error'
   WHEN quality = 0 THEN 'low quality'
   WHEN doc_id % 5 = 0 THEN 'Model verification error: reply is no object'
   WHEN doc_id % 5 = 1 THEN 'Model verification error: errors is no list'
   ELSE '' END AS errors
  FROM erred LEFT JOIN labels USING (doc_id))"""
STATS = f"""{REPORTED},
stats AS (SELECT chunk_id, count(id) AS generated_count, count(*) FILTER (WHERE passed) AS verified_count,
  count(*) FILTER (WHERE NOT passed) AS rejected_count FROM chunks LEFT JOIN reported USING (chunk_id) GROUP BY chunk_id)"""
def _fill(template: str, values: dict[str, str]) -> str:
    """Fill the slots by nested replaces; the last value may hold anything."""
    out = literal(template)
    for slot, sql in values.items():
        out = f"replace({out}, '{{{{ {slot} }}}}', {sql})"
    return out


_USER = _fill(
    prompts.GENERATION_USER,
    {
        "n": "'2'",
        "project": "project",
        "file_name": "file_name",
        "chunk_index": "CAST(chunk_index AS VARCHAR)",
        "chunk_id": "chunk_id",
        "chunk_text": "text",
    },
)


def _words(expr: str) -> str:
    return f"len(regexp_extract_all({expr}, '{WORD}'))"


def _estimate(system: str, user: str, limit: int) -> str:
    return f"CAST(floor({_words(system)} * 1.3::DOUBLE + {_words(user)} * 1.3::DOUBLE + {limit}) AS BIGINT)"


def _item_json(item: str, chunk: str) -> str:
    j = fx.json_text
    system = j(literal(prompts.GENERATION_SYSTEM))
    problem, solution = j(f"{item}.problem"), j(f"{item}.solution")
    return f"""concat('{{"id":"', {item}.id, '","system_prompt":', {system},
      ',"metadata":{{"source":"synthetic","difficulty":"medium","subject":"general","tags":[],"project":"', {chunk}.project,
      '","file_path":"', {chunk}.file_path, '","file_name":"', {chunk}.file_name, '","chunk_index":', CAST({chunk}.chunk_index AS VARCHAR),
      ',"chunk_id":"', {chunk}.chunk_id, '"}},"messages":[{{"role":"user","content":', {problem},
      '}},{{"role":"assistant","content":', {solution}, '}}],"problem":', {problem}, ',"solution":', {solution},
      ',"created_at":"{fx.STAMP}"}}')"""


_PAIRS = f"""pairs AS (SELECT u.conv_id, u.turn, u.text AS problem,
  concat('{prompts.THOUGHT_BEGIN}', u.text, '{prompts.THOUGHT_END}{prompts.SOLUTION_BEGIN}', a.text, '{prompts.SOLUTION_END}') AS solution,
  {uuid_of("concat(CAST(u.conv_id AS VARCHAR), '|', CAST(u.turn AS VARCHAR))")} AS id
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
CHUNK_ID = "^sha256:[a-f0-9]{64}$"
_FAULT_MESSAGE = f"""CASE fault WHEN 2 THEN 'chunk_id: does not match {CHUNK_ID}'
  WHEN 3 THEN 'root: extra is unexpected' WHEN 4 THEN 'chunk_index: not of type integer'
  WHEN 5 THEN 'metadata.source_format: not one of markdown' ELSE 'JSON parse error' END"""
AUDITED = f"""{CHUNKS},
audited AS (SELECT concat(project, '/', file_path, '.chunks.jsonl') AS file, project, chunk_index + 1 AS line, {fx.LINE_FAULT} AS fault,
  NOT ({fx.LINE_FAULT} = 1 AND chunk_index = 0) AS parsed,
  NOT ({fx.LINE_FAULT} IN (2, 3, 4, 5) OR ({fx.LINE_FAULT} = 1 AND chunk_index = 0)) AS valid FROM chunks)"""


def ranked(seed: int, ratios: list[tuple[str, float]], size: int) -> str:
    total = sum(r for _, r in ratios)
    scaled = [(n, r if 0.99 <= total <= 1.01 else r / total) for n, r in ratios]
    lows, low = [], "0"
    for _, r in scaled:
        lows.append(low)
        low = f"({low} + CAST(floor(total * {r!r}::DOUBLE) AS BIGINT))"
    split = "CASE " + " ".join(
        f"WHEN rank >= {lows[i]} THEN '{scaled[i][0]}'" for i in range(len(scaled) - 1, -1, -1)
    ) + " END"
    low_of = "CASE " + " ".join(f"WHEN rank >= {lows[i]} THEN {lows[i]}" for i in range(len(scaled) - 1, -1, -1)) + " END"
    return f"""{CHUNKS},
ranks AS (SELECT chunk_id, row_number() OVER (ORDER BY sha256(concat('{seed}|', chunk_id)), chunk_id) - 1 AS rank,
  count(*) OVER () AS total FROM chunks),
splits AS (SELECT *, {split} AS split, rank - {low_of} AS rank_in_split FROM ranks),
shards AS (SELECT *, CAST(floor(rank_in_split / {size}) AS INTEGER) AS shard FROM splits),
named AS (SELECT *, concat(split, '-', lpad(CAST(shard AS VARCHAR), 5, '0'), '.jsonl') AS file FROM shards)"""


THREE = [("train", 0.8), ("val", 0.1), ("test", 0.1)]
UNSCALED = [("a", 2.0), ("b", 1.0), ("c", 1.0)]
SHIPPED_RATIOS = [("train", 0.98), ("test", 0.02)]


def permuted_documents(seed: int) -> str:
    """Documents numbered in their stored order, each number sent through the rounds until it is below the total."""
    prime = permutation._PRIME
    rounds = "SELECT doc_id, pass, a, b, v // b AS x, v % b AS y FROM walk, p WHERE pass = 0 OR v >= n"
    for r, (times, plus) in enumerate(permutation._keys(seed)):
        spread = f"SELECT *, (y * {times} + {plus}) % {prime} AS t FROM ({rounds})"
        rounds = f"SELECT doc_id, pass, a, b, y AS x, (x + ((t * t) % {prime} * t + {plus}) % {prime}) % {'ab'[r % 2]} AS y FROM ({spread})"
    return f"""WITH RECURSIVE s AS (SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS a FROM documents),
      p AS (SELECT n, a, (n + a - 1) // a AS b FROM s),
      walk AS (SELECT doc_id, 0 AS pass, row_number() OVER (ORDER BY doc_id) - 1 AS v FROM documents
        UNION ALL SELECT doc_id, pass + 1, x * b + y FROM ({rounds}))
      SELECT doc_id, v AS rank, n AS total FROM walk, p WHERE pass > 0 AND v < n"""


def build() -> dict[str, str]:
    """Oracle per query name."""
    shape = "chunk_id, project, file_path, file_name, chunk_index, total_chunks, token_start, token_end, text, file_sha1"
    out: dict[str, str] = {}
    markdown = f"{MD}, files AS (SELECT *, concat(text, chr(10)) AS content FROM md WHERE doc_id % 13 <> 0)"
    out["discovered_projects"] = f"WITH {markdown} SELECT DISTINCT project FROM files"
    out["found_files"] = f"""WITH {markdown} SELECT concat(project, '/', file_path) AS relpath, CAST(strlen(content) AS BIGINT) AS length,
      CAST(strlen(content) AS BIGINT) AS read FROM files"""
    out["markdown_documents"] = f"""WITH {markdown} SELECT project, file_path, file_name, concat('sha256:', sha256(content)) AS text_hash,
      sha1(content) AS file_sha1 FROM files"""
    out["chunk_files"] = f"{CHUNKS} SELECT {shape} FROM chunks"
    out["chunk_lines_read"] = f"""{CHUNKS}, l AS (SELECT token_end, doc_id % 9 = 4 OR (doc_id % 9 = 1 AND chunk_index = 0) AS malformed FROM chunks)
      SELECT malformed, count(*) AS lines, CAST(sum(token_end) AS BIGINT) AS token_ends FROM l GROUP BY malformed"""
    out["line_counts"] = f"{CHUNKS} SELECT doc_id, count(*) AS lines FROM chunks GROUP BY doc_id"
    out["named_files"] = f"""{ranked(fx.SEED, THREE, 50)} SELECT file, CAST(rank_in_split - 50 * shard + 1 AS BIGINT) AS line, chunk_id FROM named"""
    out["ids_hashes"] = f"""WITH {MD}, h AS (SELECT *, sha1(text) AS s FROM md)
      SELECT doc_id, concat('sha256:', sha256(text)) AS text_hash, s AS file_sha1,
      concat('sha256:', sha256(concat(project, '|', file_path, '|0|', s))) AS chunk_id,
      {uuid_of("concat(file_path, '|0')")} AS item_id, true AS item_id_ok, false AS hash_is_id,
      strftime(make_timestamp((1700000000 + doc_id * 3607) * 1000000), 'run_%Y%m%d_%H%M%S') AS run_id, true AS run_id_ok FROM h"""
    out["token_counts"] = f"""SELECT doc_id, CAST(len(regexp_extract_all(text, '{TOKEN_PATTERN}')) AS INTEGER) AS tokens FROM documents"""
    out["token_roundtrip"] = f"""WITH {MD}, t AS (SELECT doc_id, text, regexp_extract_all(text, '{TOKEN_PATTERN}') AS tk FROM md)
      SELECT doc_id, array_to_string(tk, '') = text AS same, array_to_string(tk[4:10], '') AS part FROM t"""
    out["semantic_breaks"] = f"WITH {MD}, {LINES} SELECT doc_id, off AS break_at FROM breaks"
    out["chunks"] = f"{CHUNKS} SELECT {shape} FROM chunks"
    out["chunks_shipped_size"] = f"WITH RECURSIVE {chunk_ctes(4096, 128, 409)} SELECT {shape} FROM chunks"
    out["chunks_without_breaks"] = f"WITH RECURSIVE {chunk_ctes(64, 8, 0, False)} SELECT {shape} FROM chunks"
    out["chunks_in_blocks"] = f"{CHUNKS} SELECT {shape} FROM chunks"
    out["chunk_overlap"] = f"""{CHUNKS} SELECT a.chunk_id, b.chunk_id AS next_id, a.token_end - b.token_start AS overlap_tokens,
      ends_with(a.text, array_to_string(regexp_extract_all(b.text, '{TOKEN_PATTERN}')[1:8], '')) AS same_text
      FROM chunks a JOIN chunks b ON a.doc_id = b.doc_id AND b.chunk_index = a.chunk_index + 1"""
    out["chunk_stats"] = f"""{CHUNKS}, f AS (SELECT project, count(*) AS files FROM md GROUP BY project),
      c AS (SELECT project, count(*) AS chunks FROM chunks GROUP BY project)
      SELECT project, files, coalesce(chunks, 0) AS chunks FROM f LEFT JOIN c USING (project)"""
    out["corpus_totals"] = f"""{CHUNKS}, f AS (SELECT project, count(*) AS files FROM md GROUP BY project),
      c AS (SELECT project, count(*) AS chunks FROM chunks GROUP BY project)
      SELECT project, count(*) AS projects, CAST(sum(files) AS BIGINT) AS files, CAST(sum(coalesce(chunks, 0)) AS BIGINT) AS chunks
      FROM f LEFT JOIN c USING (project) GROUP BY ROLLUP (project)"""
    out["chunk_validation"] = f"""{CHUNKS} SELECT file_path, chunk_index, CASE doc_id % 7
      WHEN 1 THEN 'chunk_id: does not match {CHUNK_ID}' WHEN 2 THEN 'project: shorter than 1'
      WHEN 3 THEN 'chunk_index: less than the minimum of 0' WHEN 4 THEN 'metadata.source_format: not one of markdown'
      WHEN 5 THEN 'metadata.file_sha1: does not match ^[a-f0-9]{{40}}$' WHEN 6 THEN 'root: text is a required property'
      ELSE '' END AS errors, doc_id % 7 = 0 AS valid FROM chunks"""
    out["gen_requests"] = f"""{CHUNKS} SELECT chunk_id AS request_id, {literal(prompts.GENERATION_SYSTEM)} AS system_content,
      {_USER} AS user_content FROM chunks"""
    meta = _fill(
        prompts.VERIFICATION_USER,
        {
            "chunk_meta.project": "c.project",
            "chunk_meta.file_name": "c.file_name",
            "chunk_meta.chunk_index": "CAST(c.chunk_index AS VARCHAR)",
            "chunk_meta.chunk_id": "c.chunk_id",
            "candidate_json": _item_json("i", "c"),
            "chunk_text": "c.text",
        },
    )
    out["verify_requests"] = f"""{CHECKED} SELECT i.id AS request_id, {meta} AS user_content
      FROM erred i JOIN chunks c USING (chunk_id) WHERE i.local_errors = ''"""
    out["request_token_estimate"] = f"""{CHUNKS} SELECT chunk_id AS request_id,
      {_estimate(literal(prompts.GENERATION_SYSTEM), _USER, 4096)} AS estimate FROM chunks"""
    plan = f"""e AS (SELECT CAST(doc_id AS VARCHAR) AS request_id, source AS lane, {_estimate("'Answer the text'", 'text', 256)} AS estimate FROM documents),
      c AS (SELECT *, estimate > 3000 AS rejected,
        sum(CASE WHEN estimate > 3000 THEN 0 ELSE 1 END) OVER w AS req, sum(CASE WHEN estimate > 3000 THEN 0 ELSE estimate END) OVER w AS tok
        FROM e WINDOW w AS (PARTITION BY lane ORDER BY sha256(request_id), request_id))"""
    out["request_plan"] = f"""WITH {plan} SELECT request_id, lane, estimate, rejected, CASE WHEN NOT rejected THEN
      CAST(greatest(floor((req - 1) / 5), floor((tok - 1) / 3000)) AS BIGINT) END AS minute FROM c"""
    out["request_schedule"] = f"""WITH RECURSIVE {plan},
      o AS (SELECT lane, request_id, estimate, row_number() OVER (PARTITION BY lane ORDER BY sha256(request_id)) AS i FROM e WHERE estimate <= 3000),
      walk AS (SELECT DISTINCT lane, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS t, CAST(-15000 AS BIGINT) AS u, CAST(-15000 AS BIGINT) AS v FROM o
        UNION ALL SELECT lane, i, t, greatest(t - 15000, u) + estimate * 5, greatest(t - 15000, v) + 3000
        FROM (SELECT o.lane, o.i, o.estimate, walk.u, walk.v, greatest(walk.t, walk.u + o.estimate * 5, walk.v + 3000) AS t
          FROM walk JOIN o ON o.lane = walk.lane AND o.i = walk.i + 1))
      SELECT e.request_id, e.lane, e.estimate, e.estimate > 3000 AS rejected, t AS start_units,
        CAST(t * 60 AS DOUBLE) / CAST(15000 AS DOUBLE) AS start_seconds, t // 15000 AS minute
      FROM e LEFT JOIN o ON o.lane = e.lane AND o.request_id = e.request_id LEFT JOIN walk ON walk.lane = o.lane AND walk.i = o.i"""
    out["completions"] = f"""WITH r AS (SELECT doc_id, length(text) % 4 + 1 AS need, length(text) % 13 = 0 AS fails, length(text) AS n FROM documents)
      SELECT CAST(doc_id AS VARCHAR) AS request_id, CAST(CASE WHEN fails THEN 1 ELSE least(need, 3) END AS INTEGER) AS attempt,
      CASE WHEN fails THEN 'failed' WHEN need > 3 THEN 'empty' ELSE 'ok' END AS status,
      CASE WHEN fails THEN NULL WHEN need > 3 THEN ' ' ELSE concat('length ', CAST(n AS VARCHAR)) END AS content,
      CASE WHEN fails THEN 'ValueError: no answer' WHEN need > 3 THEN 'empty reply after 3 attempts' END AS error FROM r"""
    out["pending_chunks"] = f"""{REPORTED} SELECT chunk_id, file_path, chunk_index FROM chunks
      WHERE chunk_id NOT IN (SELECT chunk_id FROM reported WHERE passed)"""
    out["extract_fence"] = f"{REPLIES} SELECT chunk_id, regexp_replace(body, '^\\s+|\\s+$', '', 'g') AS extracted FROM replies"
    q = "concat(chr(92), 'q')"
    out["sanitize_escapes"] = f"{REPLIES} SELECT chunk_id, CASE WHEN k IN (4, 5) THEN replace(content, {q}, concat(chr(92), {q})) ELSE content END AS sanitized FROM replies"
    out["strip_commas"] = f"""{REPLIES} SELECT chunk_id, CASE k WHEN 3 THEN replace(content, concat(',', chr(10), ']'), concat(chr(10), ']'))
      WHEN 5 THEN replace(content, ', ]', ' ]') ELSE content END AS stripped FROM replies"""
    out["json_validity"] = f"""{REPLIES} SELECT chunk_id, CASE WHEN k = 9 THEN 'EMPTY' WHEN k IN (0, 6, 7, 10, 11) THEN NULL ELSE 'INVALID' END AS problem FROM replies"""
    out["json_faults"] = f"""{REPLIES} SELECT chunk_id,
      CASE k WHEN 3 THEN 'Illegal trailing comma before end of array' WHEN 4 THEN concat('Invalid ', chr(92), 'escape') ELSE 'Expecting value' END AS message,
      CAST(CASE k WHEN 9 THEN 2 ELSE 1 END AS INTEGER) AS line,
      CAST(CASE k WHEN 3 THEN length(concat('[', first_item, ', ', second_item)) + 1 WHEN 4 THEN strpos(content, concat(chr(92), 'q '))
        WHEN 8 THEN length(content) + 1 WHEN 9 THEN 2 ELSE 1 END AS INTEGER) AS "column"
      FROM replies WHERE k NOT IN (0, 6, 7, 10, 11)"""
    out["parse_robust"] = f"{ELEMENTS} SELECT chunk_id, position, problem, solution, problem_is_text FROM elements"
    out["parse_stage_stats"] = f"""{REPLIES} SELECT CASE WHEN k IN (8, 9) THEN 0 WHEN k = 3 THEN 3 WHEN k = 4 THEN 2 WHEN k = 5 THEN 4 ELSE 1 END AS stage,
      count(*) AS replies FROM replies GROUP BY 1"""
    out["failed_replies"] = f"""{REPLIES} SELECT chunk_id, CASE k WHEN 8 THEN 'no JSON' WHEN 9 THEN 'empty reply' ELSE 'element is no object' END AS failure,
      content AS raw, trim(body) AS extracted, trim(body) AS sanitized, CASE k WHEN 8 THEN 'INVALID' WHEN 9 THEN 'EMPTY' ELSE 'VALID' END AS json,
      CAST(length(content) AS INTEGER) AS content_length FROM replies WHERE k IN (8, 9, 10)"""
    out["failed_chunks"] = f"""{REPLIES} SELECT chunk_id, project, file_path, chunk_index, text,
      CASE k WHEN 9 THEN 'empty' ELSE 'unreadable' END AS error_type,
      CASE k WHEN 8 THEN 'no JSON' WHEN 9 THEN 'empty reply after 3 attempts' ELSE 'element is no object' END AS error_message
      FROM replies WHERE k IN (8, 9, 10)"""
    out["items"] = f"""{ELEMENTS} SELECT id, chunk_id, project, file_path, file_name, chunk_index, problem, solution,
      problem AS user_content, solution AS assistant_content, {literal(prompts.GENERATION_SYSTEM)} AS system_prompt,
      'synthetic' AS source, 'medium' AS difficulty, 'general' AS subject, 0 AS tags FROM items"""
    out["local_checks"] = f"{CHECKED} SELECT id, {', '.join(CHECK_NAMES)} FROM checked"
    out["check_errors"] = f"{CHECKED} SELECT id, local_errors AS errors FROM erred"
    out["verdict_merge"] = f"{REPORTED} SELECT id, chunk_id, passed, errors FROM reported"
    out["verified_items"] = f"{REPORTED} SELECT id, chunk_id, problem, solution FROM reported WHERE passed"
    out["rejected_items"] = f"{REPORTED} SELECT id, chunk_id, problem, solution, errors FROM reported WHERE NOT passed"
    out["chunk_item_stats"] = f"{STATS} SELECT * FROM stats"
    out["run_totals"] = f"""{STATS} SELECT count(*) AS total_chunks, CAST(sum(generated_count) AS BIGINT) AS total_generated,
      CAST(sum(verified_count) AS BIGINT) AS total_verified, CAST(sum(rejected_count) AS BIGINT) AS total_rejected,
      count(*) FILTER (WHERE generated_count = 0) AS failed_chunks,
      CAST(sum(verified_count) AS DOUBLE) * 100.0::DOUBLE / CAST(sum(generated_count) AS DOUBLE) AS verification_rate FROM stats"""
    out["first_failed_chunks"] = f"{STATS} SELECT chunk_id FROM stats WHERE generated_count = 0 ORDER BY chunk_id LIMIT 5"
    out["error_histogram"] = f"""{REPORTED} SELECT error, count(*) AS items FROM (SELECT unnest(string_split(errors, ',')) AS error FROM reported WHERE errors <> '') GROUP BY error"""
    out["report_validation"] = f"""{REPORTED} SELECT id, CASE doc_id % 4 WHEN 0 THEN 'input_item_id: does not match {UUID}'
      WHEN 1 THEN concat('errors.', CAST(CASE WHEN errors = '' THEN 0 ELSE len(string_split(errors, ',')) END AS VARCHAR), ': shorter than 1')
      WHEN 2 THEN 'root: passed is a required property' ELSE '' END AS errors, doc_id % 4 = 3 AS valid FROM reported"""
    out["item_validation"] = f"""WITH {_PAIRS} SELECT conv_id, turn, CASE conv_id % 8
      WHEN 1 THEN 'id: does not match {UUID}' WHEN 2 THEN 'problem: shorter than 1'
      WHEN 3 THEN 'messages.1.role: not one of system, user, assistant' WHEN 4 THEN 'metadata.tags.1: shorter than 1'
      WHEN 5 THEN 'messages: fewer than 2 items' WHEN 6 THEN 'root: solution is a required property' ELSE '' END AS errors,
      conv_id % 8 IN (0, 7) AS valid FROM pairs"""
    out["collected_items"] = f"""WITH {_PAIRS}, judged AS ({out["item_validation"].removeprefix(f"WITH {_PAIRS} ")})
      SELECT errors, valid, count(*) AS items, count(DISTINCT CASE WHEN conv_id % 8 = 1 THEN 'no-uuid' ELSE id END) AS ids
      FROM judged JOIN pairs USING (conv_id, turn) GROUP BY errors, valid"""
    out["conversation_items"] = f"WITH {_PAIRS} SELECT conv_id, turn, id, problem, solution FROM pairs"
    out["chunk_audit_by_file"] = f"""{AUDITED} SELECT file, count(*) FILTER (WHERE parsed) AS total, count(*) FILTER (WHERE valid) AS valid,
      count(*) FILTER (WHERE NOT valid) AS invalid FROM audited GROUP BY file"""
    out["chunk_audit_by_project"] = f"""{AUDITED} SELECT project, count(*) AS chunks, count(DISTINCT regexp_extract(file, '[^/]*$')) AS files
      FROM audited WHERE valid GROUP BY project"""
    out["chunk_readiness"] = f"""{AUDITED} SELECT count(DISTINCT file) AS total_files, count(*) FILTER (WHERE parsed) AS total_chunks,
      count(*) FILTER (WHERE valid) AS valid_chunks, count(*) FILTER (WHERE NOT valid) AS invalid_chunks, bool_and(valid) AS ready FROM audited"""
    out["first_errors"] = f"""{AUDITED} SELECT file, line, {_FAULT_MESSAGE} AS error FROM audited WHERE NOT valid ORDER BY file, line LIMIT 10"""
    out["file_report"] = f"""{AUDITED} SELECT file, count(*) FILTER (WHERE valid) AS valid, count(*) FILTER (WHERE NOT valid) AS invalid
      FROM audited GROUP BY file"""
    wrong = _FAULT_MESSAGE.replace("JSON parse error", "Invalid JSON")
    out["file_errors"] = f"""{AUDITED} SELECT file, line, concat('Line ', CAST(line AS VARCHAR), ': ', {wrong}) AS error FROM audited WHERE NOT valid"""
    out["sample_chunk"] = f"{CHUNKS} SELECT {shape} FROM chunks ORDER BY project, file_path, chunk_index LIMIT 1"
    out["shuffle_rank"] = f"{ranked(fx.SEED, THREE, 50)} SELECT chunk_id, rank, total FROM ranks"
    out["split_assign"] = f"{ranked(fx.SEED, THREE, 50)} SELECT chunk_id, split, rank_in_split FROM splits"
    out["split_assign_unscaled"] = f"{ranked(7, UNSCALED, 50)} SELECT chunk_id, split, rank_in_split FROM splits"
    out["split_counts"] = f"""{ranked(fx.SEED, SHIPPED_RATIOS, 5000)} SELECT split, count(*) AS num_items FROM splits GROUP BY split
      UNION ALL SELECT * FROM (VALUES ('train', 0), ('test', 0)) v(split, num_items) WHERE (SELECT count(*) FROM splits) = 0"""
    out["streamed_progress"] = """WITH d AS (SELECT doc_id, doc_id % 4 AS n, range(doc_id % 4) AS items FROM documents),
      c AS (SELECT doc_id, n, len(list_filter(items, lambda i: (doc_id + i) % 7 = 0)) AS missing,
        len(list_filter(items, lambda i: (doc_id + i) % 7 > 0 AND (doc_id + i) % 3 = 0)) AS rejected FROM d)
      SELECT concat('d', CAST(doc_id AS VARCHAR)) AS chunk_id, CAST(1 + doc_id % 3 AS INTEGER) AS attempt,
        CASE WHEN n = 0 THEN 'failed' WHEN missing > 0 THEN 'open' ELSE 'done' END AS status, CAST(n AS INTEGER) AS generated,
        CAST(n - rejected AS INTEGER) AS verified, CAST(rejected AS INTEGER) AS rejected, CAST(missing AS INTEGER) AS missing FROM c"""
    out["permuted_rank"] = permuted_documents(fx.SEED)
    out["shard_assign"] = f"{ranked(fx.SEED, THREE, 50)} SELECT chunk_id, split, shard, file, rank_in_split FROM named"
    out["shard_counts"] = f"{ranked(fx.SEED, THREE, 50)} SELECT split, shard, file, count(*) AS num_items FROM named GROUP BY ALL"
    out["manifest"] = f"""{ranked(fx.SEED, THREE, 50)}, f AS (SELECT split, file, count(*) AS shard_items, total FROM named GROUP BY ALL)
      SELECT '{fx.RUN_ID}' AS run_id, total AS total_items, CAST({fx.SEED} AS BIGINT) AS shuffle_seed, split,
      CAST(sum(shard_items) OVER (PARTITION BY split) AS BIGINT) AS num_items, file, shard_items FROM f"""
    out["dataset_info"] = f"""{ranked(fx.SEED, THREE, 50)} SELECT '{fx.RUN_ID}' AS run_id, max(total) AS total_items, CAST({fx.SEED} AS BIGINT) AS shuffle_seed, split,
      count(*) AS num_items, count(DISTINCT shard) AS num_shards FROM named GROUP BY split"""
    out["manifest_validation"] = f"""{CHUNKS} SELECT count(*) AS total_items, false AS valid,
      'splits.none.shards: fewer than 1 items; root: shuffle_seed is unexpected' AS errors FROM chunks"""
    return out
