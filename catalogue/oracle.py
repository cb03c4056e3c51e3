"""The same results in SQL, for comparison on the same tables."""

from __future__ import annotations

TOKENS = r"regexp_extract_all({0}, '[^ \t\r\n]+')"
TERMS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


def tokens(text: str) -> str:
    return TOKENS.format(text)


def terms(text: str) -> str:
    return TERMS.format(text)


def window_ctes(source: str, key: str) -> str:
    """CTE ``chunks(key, chunk_no, content, n_tokens)`` of 500 tokens with 50 overlap."""
    return f"""
w_tok AS (SELECT {key}, {tokens('text')} AS tok FROM {source}),
w_no AS (SELECT {key}, tok, len(tok) AS n,
           unnest(range(0, greatest(1, ceil((len(tok) - 50) / 450.0))::BIGINT)) AS chunk_no
         FROM w_tok WHERE len(tok) > 0),
chunks AS (SELECT {key}, chunk_no,
             array_to_string(tok[chunk_no * 450 + 1 : chunk_no * 450 + 500], ' ') AS content,
             least(500, n - chunk_no * 450) AS n_tokens FROM w_no)"""


def sentence_ctes(source: str, key: str) -> str:
    """The same for whole sentences: at most 450 new tokens, at most 50 repeated."""
    return f"""
s_tok AS (SELECT {key}, {tokens('text')} AS tok FROM {source}),
s_end AS (SELECT {key}, tok, len(tok) AS n,
            list_filter(range(1, len(tok) + 1), lambda i: i = len(tok) OR right(tok[i], 1) IN ('.', '!', '?')) AS ends
          FROM s_tok WHERE len(tok) > 0),
s_unit AS (SELECT {key}, tok, n, flatten(list_transform(range(1, len(ends) + 1), lambda j:
             list_append(range(coalesce(ends[j - 1], 0) + 450, ends[j], 450), ends[j]))) AS units FROM s_end),
s_cut AS (SELECT {key}, tok, n, units, list_reduce(units, lambda a, x:
            CASE WHEN x - a.cuts[-1] > 450 AND a.last > a.cuts[-1]
                 THEN {{'cuts': list_append(a.cuts, a.last), 'last': x}}
                 ELSE {{'cuts': a.cuts, 'last': x}} END,
            {{'cuts': [0::BIGINT], 'last': 0::BIGINT}}).cuts AS cuts FROM s_unit),
s_no AS (SELECT {key}, tok, n, units, cuts, unnest(range(1, len(cuts) + 1)) AS k FROM s_cut),
s_from AS (SELECT {key}, tok, k, coalesce(cuts[k + 1], n) AS body_end,
             coalesce(list_min(list_filter(list_prepend(0::BIGINT, units), lambda s:
               k > 1 AND s >= cuts[k - 1] AND s >= cuts[k] - 50 AND s <= cuts[k])), 0) AS b FROM s_no),
chunks AS (SELECT {key}, k - 1 AS chunk_no, array_to_string(tok[b + 1 : body_end], ' ') AS content,
             body_end - b AS n_tokens FROM s_from)"""


def stats_ctes(source: str, text: str) -> str:
    """CTEs ``totals(n_docs, mean_length)`` and ``vocab(term, df, idf)``."""
    return f"""
c_term AS (SELECT row_number() OVER () AS r, {terms(text)} AS t FROM {source}),
totals AS (SELECT count(*) AS n_docs, sum(len(t)) / count(*) AS mean_length FROM c_term),
c_tf AS (SELECT DISTINCT r, term FROM (SELECT r, unnest(t) AS term FROM c_term)),
vocab AS (SELECT term, df, ln(1 + (n_docs - df + 0.5) / (df + 0.5)) AS idf
          FROM (SELECT term, count(*) AS df FROM c_tf GROUP BY term), totals)"""


def cells_ctes(name: str, source: str, key: str, text: str, dim: int, fitted: bool = True) -> str:
    """CTE ``name(key, slot, v)``: non-zero cells of the unit vectors, in single precision."""
    value = "(1 + ln(tf)) * idf" if fitted else "tf"
    join = "JOIN vocab USING (term)" if fitted else ""
    return f"""
{name}_tf AS (SELECT {key}, term, count(*) AS tf
              FROM (SELECT {key}, unnest({terms(text)}) AS term FROM {source}) GROUP BY {key}, term),
{name}_raw AS (SELECT {key}, (('0x' || substr(md5(term), 1, 8))::UBIGINT % {dim})::BIGINT AS slot,
                 sum(CASE WHEN substr(md5(term), 9, 1) < '8' THEN 1 ELSE -1 END * {value}) AS w
               FROM {name}_tf {join} GROUP BY {key}, slot),
{name}_norm AS (SELECT {key}, sqrt(sum(w * w)) AS norm FROM {name}_raw GROUP BY {key}),
{name} AS (SELECT {key}, slot, (w / norm)::FLOAT::DOUBLE AS v FROM {name}_raw JOIN {name}_norm USING ({key}) WHERE norm > 0)"""


def chunk_cells(key: str) -> str:
    """Key, number, content and non-zero cells of the plain vectors of ``chunks``."""
    return f"""items AS (SELECT {key} * 100000 + chunk_no AS id, {key}, chunk_no, content FROM chunks),
{cells_ctes('cells', 'items', 'id', 'content', 256, fitted=False)},
chunk_cells AS (SELECT {key}, chunk_no, md5(content) AS content_md5, slot, round(v, 5) AS value
FROM cells JOIN items USING (id) WHERE abs(round(v, 5)) > 0.000005)"""


def hits_ctes(k: int) -> str:
    """CTE ``hits(query_id, rank, id, score)`` from ``qcells(query_id, …)`` and ``cells(id, …)``."""
    return f"""
q_len AS (SELECT query_id, sqrt(sum(v * v)) AS n FROM qcells GROUP BY query_id),
i_len AS (SELECT id, sqrt(sum(v * v)) AS n FROM cells GROUP BY id),
dots AS (SELECT query_id, id, sum(qcells.v * cells.v) AS dot FROM qcells JOIN cells USING (slot) GROUP BY query_id, id),
cosines AS (SELECT query_id, id, round(dot / (q_len.n * i_len.n), 6) AS score
            FROM dots JOIN q_len USING (query_id) JOIN i_len USING (id)),
placed AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score FROM cosines),
hits AS (SELECT * FROM placed WHERE rank <= {k})"""


def bm25_ctes() -> str:
    """CTE ``scored(query_id, id, first_rank, score)`` over ``hits`` with ``content``."""
    return f"""
b_q AS (SELECT DISTINCT query_id, term FROM (SELECT query_id, unnest({terms('question')}) AS term FROM questions)),
b_len AS (SELECT id, len({terms('content')}) AS dl FROM items),
b_tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({terms('content')}) AS term
           FROM items WHERE id IN (SELECT id FROM hits)) GROUP BY id, term),
b_sum AS (SELECT query_id, hits.id, sum(idf * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / mean_length))) AS s
          FROM hits JOIN b_q USING (query_id) JOIN b_tf ON b_tf.id = hits.id AND b_tf.term = b_q.term
          JOIN vocab ON vocab.term = b_q.term JOIN b_len ON b_len.id = hits.id, totals GROUP BY query_id, hits.id),
scored AS (SELECT query_id, id, hits.rank AS first_rank, round(coalesce(s, 0), 6) AS score
           FROM hits LEFT JOIN b_sum USING (query_id, id)),
reranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored)"""


BENCHMARK_QUESTIONS = "questions AS (SELECT item_id AS query_id, text AS question FROM benchmark)"
CHAT_QUESTIONS = (
    "questions AS (SELECT conv_id * 1000 + turn AS query_id, text AS question FROM conversations WHERE role = 'user')"
)
DOCUMENT_ITEMS = "items AS (SELECT doc_id AS id, text AS content FROM documents)"
CHUNK_ITEMS = """
items AS (SELECT row_number() OVER (ORDER BY doc_id, chunk_no) AS id, 'doc-' || doc_id AS pdf_name, content FROM chunks)"""


def retrieval(items: list[str], questions: str, dim: int, k: int) -> str:
    return ",".join([
        *items,
        questions,
        stats_ctes("items", "content"),
        cells_ctes("cells", "items", "id", "content", dim),
        cells_ctes("qcells", "questions", "query_id", "question", dim),
        hits_ctes(k),
    ])


CHUNKED = [sentence_ctes("documents", "doc_id"), CHUNK_ITEMS]

VECTORS = """
v AS (SELECT vec_id AS id, label,
        list_transform(embedding, lambda x: (x * (1 + vec_id % 7))::FLOAT)::DOUBLE[] AS e FROM embeddings)"""


def topk(function: str, order: str, k: int = 5, where: str = "true", extra: str = "") -> str:
    return f"""WITH {VECTORS},
p AS (SELECT q.id AS query_id, i.id, round({function}(q.e, i.e), 6) AS score, i.label FROM v q, v i WHERE {where}),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, id) AS rank, id, score, label FROM p)
SELECT query_id, rank, id, score{extra} FROM r WHERE rank <= {k}"""


def html_text() -> str:
    out = "html"
    for pattern, by in (
        (r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>", "' '"),
        (r"(?i)</?(p|br|div|li|ul|ol|tr|table|h[1-6]|article|section|nav|header|footer|title)\b[^>]*>", "chr(10)"),
        (r"<[^>]*>", "' '"),
    ):
        out = f"regexp_replace({out}, '{pattern}', {by}, 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    for pattern, by in ((r"[ \t\r]+", "' '"), (r" ?\n[ \n]*", "chr(10)"), (r"^\n|\n$", "''")):
        out = f"regexp_replace({out}, '{pattern}', {by}, 'g')"
    return f"trim({out})"


CLEAN = r"""
WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '\r?\n')) AS line, generate_subscripts(string_split_regex(text, '\r?\n'), 1) AS i FROM documents),
t AS (SELECT doc_id, trim(line) AS line, min(i) AS i FROM l GROUP BY doc_id, trim(line)),
k AS (SELECT *, length(regexp_replace(line, '[\s\v]', '', 'g')) AS n, length(regexp_replace(line, '[^\p{L}]', '', 'g')) AS letters FROM t)
SELECT d.doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE n > 0 AND letters >= n * 0.5), '') AS text
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id GROUP BY d.doc_id"""

VERSIONS = """
old AS (SELECT doc_id, text, lang, source FROM documents WHERE lang <> 'es'),
new AS (SELECT doc_id, CASE WHEN lang <> 'fr' THEN text WHEN length(text) > 300 THEN text || ' Revu.' END AS text, lang, source
        FROM documents WHERE lang <> 'de')"""

CELLS_OUT = "SELECT doc_id, slot, round(v, 5) AS value FROM cells WHERE abs(round(v, 5)) > 0.000005"

SQL = {
    "retrieve_flagship": f"""WITH {retrieval(CHUNKED, BENCHMARK_QUESTIONS, 1024, 5)}
SELECT query_id, rank, id, score, pdf_name FROM hits JOIN items USING (id)""",
    "chunk_window": f"WITH {window_ctes('documents', 'doc_id')} SELECT * FROM chunks",
    "chunk_sentence": f"WITH {sentence_ctes('documents', 'doc_id')} SELECT * FROM chunks",
    "extract_html": f"SELECT page_id, {html_text()} AS text FROM pages",
    "extract_pages": """SELECT doc_id, CASE WHEN NOT starts_with(text, 'That') THEN text END AS text,
CASE WHEN starts_with(text, 'That') THEN 'ValueError: unreadable' END AS error FROM documents""",
    "join_pages": "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
    "project_rename": "SELECT source || '/' || doc_id AS pdf_name, text AS content, length(text) AS n_chars FROM documents",
    "clean_lines": CLEAN,
    "assign_ids": """WITH g AS (SELECT doc_id, CASE WHEN lang = 'de' THEN doc_id + 1000000 END AS id FROM documents)
SELECT doc_id, id FROM g WHERE id IS NOT NULL UNION ALL
SELECT doc_id, (SELECT max(id) FROM g) + row_number() OVER (ORDER BY doc_id) FROM g WHERE id IS NULL""",
    "corpus_terms": f"WITH {stats_ctes('documents', 'text')} SELECT term, df, round(idf, 6) AS idf FROM vocab",
    "embed_hash": f"""WITH {stats_ctes('documents', 'text')}, {cells_ctes('cells', 'documents', 'doc_id', 'text', 1024)} {CELLS_OUT}""",
    "embed_hash_by_join": f"""WITH {stats_ctes('documents', 'text')}, {cells_ctes('cells', 'documents', 'doc_id', 'text', 256)} {CELLS_OUT}""",
    "embed_plain": f"""WITH {cells_ctes('cells', 'documents', 'doc_id', 'text', 256, fitted=False)} {CELLS_OUT}""",
    "embed_batched": "SELECT doc_id, length(text) AS n_chars, length(text) - length(replace(text, ' ', '')) AS n_blanks FROM documents",
    "embed_query_parity": "SELECT item_id, 256::BIGINT AS dim, true AS same FROM benchmark",
    "validate_vectors": """SELECT vec_id, CASE label WHEN 0 THEN 'missing' WHEN 1 THEN 'wrong length'
WHEN 2 THEN 'all zero' WHEN 3 THEN 'not finite' END AS reason FROM embeddings""",
    "similarity_topk_cosine": topk("list_cosine_similarity", "DESC", extra=", label"),
    "similarity_topk_dot": topk("list_inner_product", "DESC", extra=", label"),
    "similarity_topk_l2": topk("list_distance", "ASC", extra=", label"),
    "similarity_filtered": topk("list_distance", "ASC", where="i.label = 3"),
    "similarity_access": topk(
        "list_cosine_similarity", "DESC", where="i.label = q.label OR i.label = (q.label + 1) % 10", extra=", label"
    ),
    "similarity_cells": topk("list_cosine_similarity", "DESC", extra=", label"),
    "similarity_extremes": """WITH v AS (SELECT vec_id AS id, list_transform(embedding::DOUBLE[], lambda x: (x * [1e-25, 1.0, 1e25][label % 3 + 1])::FLOAT::DOUBLE) AS e FROM embeddings),
s AS (SELECT q.id AS query_id, i.id, round(list_inner_product(q.e, i.e) / (sqrt(list_inner_product(q.e, q.e)) * sqrt(list_inner_product(i.e, i.e))), 6) AS score FROM v q, v i),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
SELECT query_id, rank, id, score FROM r WHERE rank <= 5""",
    "similarity_ann": f"""WITH {VECTORS},
near AS (SELECT v.id, c.id AS list_id, row_number() OVER (PARTITION BY v.id
           ORDER BY round(list_cosine_similarity(v.e::DOUBLE[], c.e::DOUBLE[]), 6) DESC, c.id) AS place FROM v, v c WHERE c.id < 16),
hits AS (SELECT q.id AS query_id, i.id, i.label, round(list_cosine_similarity(q.e::DOUBLE[], i.e::DOUBLE[]), 6) AS score
         FROM v q JOIN near p ON p.id = q.id AND p.place <= 12 JOIN near a ON a.list_id = p.list_id AND a.place = 1 JOIN v i ON i.id = a.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM hits)
SELECT query_id, rank, id, label, score FROM r WHERE rank <= 5""",
    "similarity_pq": f"""WITH {VECTORS},
u AS (SELECT id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS u FROM v),
near AS (SELECT v.id, c.id AS list_id, row_number() OVER (PARTITION BY v.id
           ORDER BY round(list_cosine_similarity(v.e::DOUBLE[], c.e::DOUBLE[]), 6) DESC, c.id) AS place FROM v, v c WHERE c.id < 16),
gaps AS (SELECT n.id, n.list_id, n.place, s.s, list_transform(range(4 * s.s + 1, 4 * s.s + 5), lambda j: a.u[j] - c.u[j]) AS g
         FROM near n JOIN u a ON a.id = n.id JOIN u c ON c.id = n.list_id, range(16) s(s)),
words AS (SELECT s.s, id - 16 AS code, u[4 * s.s + 1 : 4 * s.s + 4] AS w FROM u, range(16) s(s) WHERE id BETWEEN 16 AND 79),
far AS (SELECT g.id, g.list_id, g.place, g.s, w.code, list_distance(g.g, w.w) ** 2 AS d FROM gaps g JOIN words w USING (s) WHERE g.place <= 14),
codes AS (SELECT id, list_id, s, arg_min(code, (d, code)) AS code FROM far WHERE place = 1 GROUP BY ALL),
summed AS (SELECT f.id AS query_id, c.id, round(sum(f.d), 6) AS d FROM far f JOIN codes c USING (list_id, s, code) GROUP BY ALL),
short AS (SELECT query_id, id FROM summed QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d, id) <= 100),
hits AS (SELECT query_id, s.id, i.label, round(list_cosine_similarity(q.e::DOUBLE[], i.e::DOUBLE[]), 6) AS score
         FROM short s JOIN v q ON q.id = s.query_id JOIN v i ON i.id = s.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM hits)
SELECT query_id, rank, id, label, score FROM r WHERE rank <= 5""",
    "similarity_ann_all_lists": topk("list_cosine_similarity", "DESC", extra=", label"),
    "rerank_bm25": f"""WITH {retrieval([DOCUMENT_ITEMS], BENCHMARK_QUESTIONS, 256, 20)}, {bm25_ctes()}
SELECT query_id, rank, id, score, first_rank FROM reranked""",
    "rerank_model": f"""WITH {retrieval([DOCUMENT_ITEMS], BENCHMARK_QUESTIONS, 256, 5)},
pq AS (SELECT query_id, id, {tokens('question')} AS q, {tokens('content')} AS tok
       FROM hits JOIN questions USING (query_id) JOIN items USING (id)),
room AS (SELECT query_id, id, q, tok, greatest(1, 128 - len(q)) AS room FROM pq),
part AS (SELECT query_id, id, q, tok, room, unnest(range(0, greatest(1, ceil(len(tok) / room))::BIGINT)) AS p FROM room),
best AS (SELECT query_id, id, max(len(list_intersect(list_distinct(q), list_distinct(tok[p * room + 1 : (p + 1) * room]))))::DOUBLE AS score
         FROM part GROUP BY query_id, id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score FROM best""",
    "pair_windows": f"""WITH d AS (SELECT doc_id AS id, {tokens('text')} AS tok, 512 - len({tokens("'about ' || lang || ' ' || source")}) AS room FROM documents),
p AS (SELECT id, tok, room, unnest(range(0, greatest(1, ceil(len(tok) / room))::BIGINT)) AS part_no FROM d)
SELECT id, part_no, array_to_string(tok[part_no * room + 1 : (part_no + 1) * room], ' ') AS part,
least(room, len(tok) - part_no * room) AS n_tokens FROM p""",
    "retrieve_two_stage": f"""WITH {retrieval(CHUNKED, BENCHMARK_QUESTIONS, 1024, 5)}, {bm25_ctes()}
SELECT query_id, rank, id, pdf_name, score FROM reranked JOIN items USING (id) WHERE rank <= 3""",
    "to_passages": f"""WITH h AS ({topk('list_distance', 'ASC', 3, 'i.label = 3', ', label')})
SELECT query_id, rank - 1 AS pos, 'file-' || id AS file, 'label ' || label AS text FROM h""",
    "build_prompts": f"""WITH {retrieval(CHUNKED, CHAT_QUESTIONS, 1024, 3)},
ctx AS (SELECT query_id, string_agg(content, chr(10) || chr(10) ORDER BY rank) AS context FROM hits JOIN items USING (id) GROUP BY query_id)
SELECT query_id, 'Answer in one sentence, from the context alone.' AS system, md5(question || coalesce(chr(10) || chr(10) || '**Context:** "' || context || '"', '')) AS prompt_md5,
context IS NOT NULL AS has_context FROM questions LEFT JOIN ctx USING (query_id)""",
    "eval_hit_at_k": f"""WITH {retrieval([DOCUMENT_ITEMS], BENCHMARK_QUESTIONS, 256, 5)},
q AS (SELECT query_id, CASE WHEN length(question) < 200 THEN 'short' ELSE 'long' END AS evolution_type,
        list_distinct({terms('question')}) AS truth, ' ' || array_to_string({terms('question')}, ' ') || ' ' AS flat FROM questions),
t AS (SELECT query_id, rank, truth, list_intersect(truth, list_distinct({terms('content')})) AS shared,
        contains(' ' || array_to_string({terms('content')}, ' ') || ' ', flat) AS relevant
      FROM q LEFT JOIN hits USING (query_id) LEFT JOIN items USING (id)),
j AS (SELECT query_id, min(rank) FILTER (WHERE relevant) AS first_hit,
        coalesce(len(list_distinct(flatten(list(shared)))), 0) / max(len(truth)) AS recall FROM t GROUP BY query_id)
SELECT evolution_type, count(*) AS n_questions, round(avg((first_hit IS NOT NULL)::INT), 6) AS hit_at_k,
round(avg(coalesce(1 / first_hit, 0)), 6) AS mrr, round(avg(recall), 6) AS recall FROM q JOIN j USING (query_id) GROUP BY evolution_type""",
    "count_rows": "SELECT count(*) AS n_rows FROM documents",
    "scan_files": "SELECT item_id, strlen(text) + 1 AS length, text || chr(10) AS text FROM benchmark",
    "ingest_files": f"""WITH {sentence_ctes('benchmark', 'item_id')},
items AS (SELECT item_id * 100000 + chunk_no AS id, item_id, chunk_no, content FROM chunks),
{cells_ctes('cells', 'items', 'id', 'content', 256, fitted=False)}
SELECT item_id, chunk_no, md5(content) AS content_md5, slot, round(v, 5) AS value FROM cells JOIN items USING (id) WHERE abs(round(v, 5)) > 0.000005""",
    "ingest_stream": f"""WITH {sentence_ctes('benchmark', 'item_id')}, {chunk_cells('item_id')}
SELECT item_id, chunk_no, content_md5, slot, value, 0::BIGINT AS second_run FROM chunk_cells""",
    "ingest_updates": f"""WITH files AS (SELECT doc_id, CASE lang WHEN 'fr' THEN 'Revu. ' || text WHEN 'de' THEN ' ' ELSE text END AS text
FROM documents WHERE lang <> 'es'), {sentence_ctes('files', 'doc_id')}, {chunk_cells('doc_id')}
SELECT * FROM chunk_cells""",
    "scan_by_path": "SELECT item_id, text || chr(10) AS text FROM benchmark WHERE item_id % 2 = 0",
    "embed_with_failures": "SELECT doc_id, CASE WHEN length(text) % 7 <> 0 THEN length(text) ELSE -1 END AS n_chars FROM documents",
    "append_embeddings": f"""WITH {sentence_ctes('documents', 'doc_id')}, {chunk_cells('doc_id')},
n AS (SELECT 2 * count(*) AS n FROM chunks)
SELECT chunk_cells.*, 2::BIGINT AS n_copies, n AS n_rows, n AS n_ids, 1::BIGINT AS first_id, n AS last_id FROM chunk_cells, n""",
    "upsert_embeddings": f"""WITH second AS (SELECT doc_id, CASE lang WHEN 'fr' THEN 'Neu. ' || text
WHEN 'de' THEN array_to_string(string_split(text, '.')[1:2], '.') ELSE text END AS text FROM documents), {sentence_ctes('second', 'doc_id')}, {chunk_cells('doc_id')}
SELECT * FROM chunk_cells""",
    "diff_snapshots": f"""WITH {VERSIONS}
SELECT coalesce(n.doc_id, o.doc_id) AS doc_id,
CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete' ELSE 'update' END AS change,
md5(n.text) AS text_md5, n.lang AS lang, n.source AS source
FROM old o FULL OUTER JOIN new n ON o.doc_id = n.doc_id
WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.text IS DISTINCT FROM n.text""",
    "apply_changes": f"WITH {VERSIONS} SELECT doc_id, md5(text) AS text_md5, lang, source FROM new",
    "create_or_sync_index": f"""WITH {VECTORS}
SELECT id, label, unnest(range(0, 64)) AS slot, round(unnest(e)::DOUBLE, 6) AS value, (SELECT count(*) FROM v WHERE label = 9) AS n_insert,
(SELECT count(*) FROM v WHERE label = 3) AS n_update, (SELECT count(*) FROM v WHERE label = 0) AS n_delete, 0::BIGINT AS n_third
FROM v WHERE label <> 0""",
    "sync_text_index": f"""WITH {VERSIONS}, items AS (SELECT doc_id AS id, text AS content FROM new),
{cells_ctes('cells', 'items', 'id', 'content', 256, fitted=False)}
SELECT id, slot, round(v, 5) AS value FROM cells WHERE abs(round(v, 5)) > 0.000005""",
    "direct_index": f"""WITH {VECTORS}
SELECT id, CASE WHEN label >= 4 THEN label + 100 ELSE label END AS label, unnest(range(0, 64)) AS slot, round(unnest(e)::DOUBLE, 6) AS value FROM v WHERE label <> 7""",
    "sync_triggered": f"""WITH {VECTORS}
SELECT id, CASE WHEN label >= 4 THEN label + 100 ELSE label END AS label, unnest(range(0, 64)) AS slot, round(unnest(e)::DOUBLE, 6) AS value,
0::BIGINT AS third_run FROM v WHERE label <> 2""",
    "sync_versions": f"""WITH {VECTORS}
SELECT id, CASE label WHEN 3 THEN 203 ELSE label END AS label, unnest(range(0, 64)) AS slot, round(unnest(e)::DOUBLE, 6) AS value
FROM v WHERE label IN (0, 1, 3, 4, 5, 8)""",
}
