"""SQL counterparts of the gallery."""

from __future__ import annotations

from .problems import _canon


def _date(c: str) -> str:
    return (
        rf"coalesce(CAST(try_strptime(regexp_extract(trim({c}), '^([0-9]{{4}}-[0-9]+-[0-9]+)', 1), '%Y-%m-%d') AS DATE), "
        rf"CAST(try_strptime(regexp_extract(trim({c}), '^([0-9]{{8}})$', 1), '%Y%m%d') AS DATE), "
        rf"CAST(try_strptime(regexp_extract(trim({c}), '^([0-9]+/[0-9]+/[0-9]{{4}})$', 1), '%d/%m/%Y') AS DATE))"
    )


def _last(name: str, table: str, key: str, columns: str, order: str) -> str:
    return f"{name} AS (SELECT * FROM (SELECT {columns}, row_number() OVER (PARTITION BY {key} ORDER BY {order} DESC NULLS LAST, row_id DESC) AS r FROM {table} WHERE {key} IS NOT NULL) z WHERE r = 1)"


ACT = _last("act", "legislation", _canon("uri"), f"{_canon('uri')} AS uri, row_id, title, description, category, status, enactment_date, modified_date, coming_into_force, {_canon('supersedes')} AS supersedes", "loaded_at")
SEC = _last("sec", "section", "id", f"id, {_canon('legis_uri')} AS legis_uri, part_number, chapter_id, chapter_number, sec_number, title, order_no, text, restrict_start_date", "loaded_at")
PAR = _last("par", "paragraph", "id", f"id, section_id, par_number, {_date('restrict_start_date')} AS start_date, {_date('restrict_end_date')} AS end_date, status, text, order_no", "loaded_at")
CIT = _last("cit", "citation", "id", f"id, {_canon('legis_uri')} AS legis_uri, {_canon('uri')} AS uri, origin", "recorded_at")
NOTE = f"note AS (SELECT * FROM (SELECT id, {_canon('legis_uri')} AS legis_uri, text, row_number() OVER (PARTITION BY id ORDER BY row_id DESC) AS r FROM notes_paragraph WHERE id IS NOT NULL) z WHERE r = 1)"
LNK = "lnk AS (SELECT legis_uri AS src, uri AS dst, count(*) AS weight FROM cit WHERE legis_uri <> uri AND legis_uri IN (SELECT uri FROM act) AND uri IN (SELECT uri FROM act) GROUP BY legis_uri, uri)"
SUP = "sup AS (SELECT uri AS src, supersedes AS dst, 'SUPERSEDES' AS type FROM act WHERE supersedes IS NOT NULL)"
HIER = """h AS (SELECT s.legis_uri, a.title AS act_title, s.legis_uri || '#part_' || coalesce(s.part_number, 'none') AS part_id, s.part_number, s.chapter_id, s.chapter_number, s.id AS section_id,
 s.sec_number, s.title AS section_title, p.id AS paragraph_id, p.par_number, p.start_date, p.end_date, p.status AS paragraph_status, p.text
 FROM par p JOIN sec s ON p.section_id = s.id JOIN act a ON a.uri = s.legis_uri)"""
CTX = f"""ctx AS (SELECT paragraph_id AS node_id, legis_uri, part_id, part_number, chapter_id, chapter_number, section_id, sec_number, paragraph_id, par_number FROM h
 UNION ALL SELECT DISTINCT id, {_canon("legis_uri")}, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM notes_paragraph WHERE id IS NOT NULL)"""
_FINE = "len(text_embedding) = 128 AND NOT list_contains(list_transform(text_embedding, lambda x: coalesce(isfinite(x), false)), false)"
HITS = f"""qv AS (SELECT text_embedding AS q FROM text_node WHERE {_FINE} ORDER BY vec_id LIMIT 1),
hits AS (SELECT node_id, list_cosine_similarity(CAST(text_embedding AS DOUBLE[]), CAST(q AS DOUBLE[])) AS score FROM text_node, qv WHERE {_FINE} AND list_contains(list_transform(text_embedding, lambda x: x <> 0), true) ORDER BY score DESC, node_id LIMIT 100)"""
_Q64 = "qv AS (SELECT embedding AS q FROM embeddings ORDER BY vec_id LIMIT 1)"
_COS64 = "list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(q AS DOUBLE[]))"

_FROM, _TO = "DATE '1990-01-01'", "DATE '2015-12-31'"
_ACTIVE = lambda d: f"(coalesce(start_date, DATE '0001-01-01') <= {d} AND (end_date IS NULL OR end_date >= {d}))"
_BETWEEN = lambda c: f"coalesce({c} > {_FROM} AND {c} <= {_TO}, false)"
DIFF = f"""diff AS (SELECT * FROM (SELECT *, CASE WHEN NOT {_ACTIVE(_FROM)} AND {_ACTIVE(_TO)} THEN 'Added' WHEN {_ACTIVE(_FROM)} AND NOT {_ACTIVE(_TO)} THEN 'Removed'
 WHEN {_BETWEEN("start_date")} AND {_BETWEEN("end_date")} THEN 'Restricted' END AS change_type FROM h) x WHERE change_type IS NOT NULL)"""
TIMED = "legis_uri, act_title, part_number, sec_number, section_title, par_number, paragraph_id, paragraph_status, start_date, end_date"


def _norm(c: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]+', ' ', 'g'))"


_YEAR = lambda c: rf"list_filter(list_transform(regexp_extract_all(coalesce({c}, ''), '\b\d\d\d\d\b'), lambda w: CAST(w AS INTEGER)), lambda n: n BETWEEN 1600 AND 2100)[1]"
_WORDS = lambda c: f"list_filter(string_split({_norm(c)}, ' '), lambda t: length(t) > 2)"
_FETCH = lambda c: f"CASE WHEN {c} IS NULL OR {c} = '' THEN NULL WHEN rtrim(replace({c}, '/id/', '/'), '/') LIKE '%data.xml' THEN rtrim(replace({c}, '/id/', '/'), '/') ELSE rtrim(replace({c}, '/id/', '/'), '/') || '/data.xml' END"
_TITLE = "pensions consolidation act 1962"
_CAND = f"""cand AS (SELECT uri, title, enactment_date FROM act WHERE contains(lower(coalesce(title, '')), '{_TITLE}') OR contains(lower(coalesce(uri, '')), '{_TITLE}')
 OR {" OR ".join(f"contains(lower(coalesce(title, '')), '{t}') OR contains(lower(coalesce(uri, '')), '{t}')" for t in _TITLE.split())})"""
_SHARED = "(" + " + ".join(f"CAST(list_contains({_WORDS('title')}, '{t}') AS INTEGER)" for t in _TITLE.split()) + ") / 4.0"
_STEP = lambda a, b: f"""SELECT c.uri, c.title, e.{b} AS next_uri, n.title AS next_title FROM act c LEFT JOIN sup e ON e.{a} = c.uri LEFT JOIN act n ON n.uri = e.{b}
 WHERE contains(lower(coalesce(c.title, '')), 'pensions') OR contains(lower(coalesce(c.uri, '')), 'pensions') ORDER BY c.uri, next_uri NULLS LAST LIMIT 20"""  # noqa: E731
_TEXTS = ("MATCH (n) RETURN n", "match (n) SET n.x = 1", "CREATED by [:A|:B]", "drop index x", "RETURN offset")


_COUNTS = lambda c: f"list_transform(range(26), lambda i: CAST(length({c}) - length(replace(lower({c}), chr(CAST(97 + i AS INTEGER)), '')) AS DOUBLE))"
_LETTERS = _last("para", "paragraph", "id", "id, row_id, text", "loaded_at") + f""",
letters AS (SELECT *, sqrt(list_sum(list_transform(n, lambda x: x * x))) AS size FROM (SELECT id, row_id, text, {_COUNTS("coalesce(text, '')")} AS n FROM para) z)"""
_FIRST = lambda a, b: f"coalesce((SELECT string_agg(title, '; ' ORDER BY title) FROM (SELECT DISTINCT a.title FROM lnk JOIN act a ON a.uri = lnk.{b} WHERE lnk.{a} = s.uri AND a.title IS NOT NULL ORDER BY a.title LIMIT 5) t), '')"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# distances level by level, then only the steps that get farther from the start
_PATHS = _with(ACT, CIT, LNK, SUP).replace("WITH ", "WITH RECURSIVE ", 1) + """, ends AS (SELECT min(src) AS a, max(src) AS b FROM sup),
both_ways AS (SELECT src, dst FROM lnk UNION SELECT dst, src FROM lnk UNION SELECT src, dst FROM sup UNION SELECT dst, src FROM sup),
e AS (SELECT src, dst FROM both_ways WHERE ({inner}) OR dst = (SELECT b FROM ends)),
reach AS (SELECT a AS id, 0 AS d FROM ends UNION SELECT e.dst, d + 1 FROM reach JOIN e ON e.src = reach.id WHERE d < {last}),
dist AS (SELECT id, min(d) AS d FROM reach GROUP BY id),
walk AS (SELECT [a] AS path, a AS id, 0 AS d FROM ends
  UNION ALL SELECT list_append(path, e.dst), e.dst, walk.d + 1 FROM walk JOIN e ON e.src = walk.id JOIN dist ON dist.id = e.dst AND dist.d = walk.d + 1 WHERE walk.d < (SELECT d FROM dist WHERE id = (SELECT b FROM ends)))"""

_VEC = _with(ACT, SEC, PAR, HIER, CTX, HITS)
_TOP = "SELECT c.legis_uri AS uri, max(score) AS vector_score FROM hits JOIN ctx c ON c.node_id = hits.node_id GROUP BY c.legis_uri"

SQL = {
    "linked_to_star": """SELECT concat('n', c_nationkey) AS src, concat('n', s_nationkey) AS dst, count(*) AS weight FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
 JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey WHERE c_nationkey <> s_nationkey GROUP BY c_nationkey, s_nationkey""",
    "citation_weights": _with(ACT, CIT, LNK) + "SELECT src, dst, weight FROM lnk",
    "citation_table": _with(ACT, CIT, LNK) + "SELECT src, dst, weight, a.title AS src_title, b.title AS dst_title FROM lnk JOIN act a ON a.uri = src JOIN act b ON b.uri = dst",
    "linked_network": _with(ACT, CIT, LNK) + "SELECT src, dst, weight FROM lnk ORDER BY src, dst LIMIT 100",
    "citation_degrees": _with(ACT, CIT, LNK)
    + """, o AS (SELECT src, count(DISTINCT dst) AS n FROM lnk GROUP BY src), i AS (SELECT dst, count(DISTINCT src) AS n FROM lnk GROUP BY dst),
ot AS (SELECT src, string_agg(title, '; ' ORDER BY title) AS t FROM (SELECT src, title, row_number() OVER (PARTITION BY src ORDER BY title) AS r FROM (SELECT DISTINCT src, title FROM lnk JOIN act ON uri = dst WHERE title IS NOT NULL) x) y WHERE r <= 5 GROUP BY src),
it AS (SELECT dst, string_agg(title, '; ' ORDER BY title) AS t FROM (SELECT dst, title, row_number() OVER (PARTITION BY dst ORDER BY title) AS r FROM (SELECT DISTINCT dst, title FROM lnk JOIN act ON uri = src WHERE title IS NOT NULL) x) y WHERE r <= 5 GROUP BY dst)
SELECT a.uri, a.title, coalesce(o.n, 0) AS outgoing_count, coalesce(i.n, 0) AS incoming_count, coalesce(ot.t, '') AS top_outgoing_titles, coalesce(it.t, '') AS top_incoming_titles
FROM act a LEFT JOIN o ON o.src = a.uri LEFT JOIN i ON i.dst = a.uri LEFT JOIN ot ON ot.src = a.uri LEFT JOIN it ON it.dst = a.uri""",
    "hierarchy_paths": _with(ACT, SEC, PAR, HIER) + "SELECT legis_uri, part_id, chapter_id, section_id, paragraph_id FROM h",
    "one_part": _with(ACT, SEC, PAR, HIER) + "SELECT legis_uri, part_id, section_id, sec_number, paragraph_id, par_number FROM h WHERE part_number = 'Part 1'",
    "citing_upward": _with(ACT, CIT)
    + "SELECT c.id AS citation_id, c.legis_uri AS citing_uri, c.uri AS cited_uri, a.title AS citing_title FROM cit c JOIN act a ON a.uri = c.legis_uri WHERE c.uri IN (SELECT uri FROM act)",
    "notes_with_citations": _with(ACT, CIT)
    + f"""SELECT a.uri, n.note_id, c.id AS citation_id FROM act a LEFT JOIN (SELECT DISTINCT {_canon("legis_uri")} AS uri, id AS note_id FROM notes_paragraph) n ON n.uri = a.uri
LEFT JOIN (SELECT id, legis_uri FROM cit WHERE origin = 'notes') c ON c.legis_uri = a.uri""",
    "supersede_network": _with(ACT, SUP) + "SELECT src, dst, type FROM sup UNION ALL SELECT dst, src, type FROM sup",
    "supersedes_chain": _with(ACT, SUP) + _STEP("src", "dst"),
    "superseded_chain": _with(ACT, SUP) + _STEP("dst", "src"),
    "as_of_snapshot": _with(ACT, SEC, PAR, HIER) + f"SELECT legis_uri, paragraph_id, start_date, end_date FROM h WHERE {_ACTIVE(chr(68) + 'ATE ' + repr('2005-06-01'))}",
    "visible_after": _with(ACT, SEC, PAR, HIER) + "SELECT legis_uri, paragraph_id, start_date, end_date FROM h WHERE coalesce(end_date, DATE '9999-12-31') >= DATE '2005-06-01'",
    "altered_ids": _with(ACT, SEC, PAR, HIER)
    + """SELECT DISTINCT paragraph_id FROM h WHERE coalesce(end_date, DATE '9999-12-31') >= DATE '2005-06-01'
AND ((start_date > DATE '2005-06-01' AND start_date <= DATE '2025-01-01') OR (end_date > DATE '2005-06-01' AND end_date <= DATE '2025-01-01'))""",
    "point_in_time": _with(ACT, SEC, PAR, HIER) + "SELECT legis_uri, paragraph_id, start_date FROM h WHERE start_date >= DATE '2005-06-01' OR start_date IS NULL",
    "temporal_diff": _with(ACT, SEC, PAR, HIER, DIFF) + f"SELECT {TIMED}, change_type FROM diff ORDER BY change_type NULLS LAST, part_number NULLS LAST, sec_number NULLS LAST, par_number NULLS LAST, paragraph_id LIMIT 500",
    "temporal_diff_all": _with(ACT, SEC, PAR, HIER, DIFF) + "SELECT change_type, paragraph_id, start_date, end_date FROM diff",
    "change_counts": _with(ACT, SEC, PAR, HIER, DIFF)
    + "SELECT count(CASE WHEN change_type = 'Added' THEN 1 END) AS added, count(CASE WHEN change_type = 'Removed' THEN 1 END) AS removed, count(CASE WHEN change_type = 'Restricted' THEN 1 END) AS restricted FROM diff",
    "amendment_timeline": _with(ACT, SEC, PAR, HIER, DIFF)
    + """SELECT CAST(date_trunc('year', d) AS DATE) AS year, event, count(*) AS n_events FROM (
SELECT start_date AS d, 'Added' AS event FROM diff WHERE change_type = 'Added' UNION ALL SELECT end_date, 'Removed' FROM diff WHERE change_type = 'Removed'
UNION ALL SELECT start_date, 'Restricted (start)' FROM diff WHERE change_type = 'Restricted' UNION ALL SELECT end_date, 'Restricted (end)' FROM diff WHERE change_type = 'Restricted') e
WHERE d IS NOT NULL GROUP BY 1, 2""",
    "yearly_enactments": _with(ACT) + "SELECT strftime(enactment_date, '%Y') AS year, count(*) AS n_rows FROM act WHERE enactment_date IS NOT NULL GROUP BY 1",
    "dashboard_metrics": _with(ACT, SEC, PAR, CIT, LNK)
    + """SELECT count(*) AS n_acts, min(enactment_date) AS first_enacted, max(enactment_date) AS last_enacted, (SELECT count(*) FROM sec) AS n_sections, (SELECT count(*) FROM par) AS n_paragraphs,
(SELECT count(*) FROM lnk) AS n_links, strftime(min(enactment_date), '%Y') || ' - ' || strftime(max(enactment_date), '%Y') AS years FROM act""",
    "acts_per_category": _with(ACT) + "SELECT lower(trim(category)) AS category, lower(trim(status)) AS status, count(*) AS n_acts FROM act GROUP BY 1, 2",
    "corpus_table": _with(ACT) + "SELECT title, uri, category, status, enactment_date, coming_into_force FROM act",
    "topic_network": _with(ACT, SEC, CIT, LNK)
    + """, t AS (SELECT uri FROM act WHERE contains(lower(coalesce(title, '')), 'pension') UNION SELECT legis_uri FROM sec WHERE contains(lower(coalesce(title, '')), 'pension'))
SELECT src, dst, weight FROM lnk WHERE src IN (SELECT uri FROM t WHERE uri IS NOT NULL) AND dst IN (SELECT uri FROM t WHERE uri IS NOT NULL)""",
    "act_full_text": _with(ACT, SEC, PAR, NOTE)
    + """, n AS (SELECT uri AS legis_uri, 0 AS place, NULL AS section_no, NULL AS section_id, NULL AS number, NULL AS node_id, coalesce(title, description) AS content FROM act
UNION ALL SELECT legis_uri, 1, order_no, id, NULL, NULL, coalesce(text, title) FROM sec UNION ALL SELECT s.legis_uri, 1, s.order_no, s.id, p.order_no, p.id, p.text FROM par p JOIN sec s ON s.id = p.section_id
UNION ALL SELECT legis_uri, 2, NULL, NULL, NULL, id, text FROM note)
SELECT legis_uri, string_agg(content, chr(10) || chr(10) ORDER BY place, section_no NULLS FIRST, section_id NULLS FIRST, number NULLS FIRST, node_id NULLS FIRST, content) AS content
FROM n WHERE content IS NOT NULL AND legis_uri IN (SELECT uri FROM act) GROUP BY legis_uri""",
    "shortest_path": _PATHS.format(last="10", inner="true") + " SELECT array_to_string(path, ' > ') AS path, d AS hops FROM walk WHERE id = (SELECT b FROM ends) ORDER BY walk.path LIMIT 1",
    "shortest_paths_through_old_acts": _PATHS.format(last="5", inner="dst IN (SELECT uri FROM act WHERE year(enactment_date) <= 1990)") + " SELECT array_to_string(path, ' > ') AS path, d AS hops FROM walk WHERE id = (SELECT b FROM ends)",
    "crawled_acts": _with(ACT, CIT)
    + f""", first AS (SELECT uri, {_FETCH("uri")} AS url, title, supersedes FROM act),
links AS (SELECT DISTINCT f.url AS page, c.uri AS link, 1 AS depth FROM first f JOIN cit c ON c.legis_uri = f.uri WHERE c.uri <> '' UNION SELECT url, supersedes, 0 FROM first WHERE supersedes <> '')
SELECT url, 0 AS depth, 0 AS wave, nullif(trim(coalesce(title, '~')), '~') AS title, CAST((SELECT count(*) FROM links WHERE page = first.url) AS INTEGER) AS n_links, false AS failed FROM first
UNION ALL SELECT {_FETCH("link")}, min(depth), 1, NULL, 0, true FROM links WHERE {_FETCH("link")} NOT IN (SELECT url FROM first) GROUP BY 1""",
    "parsed_sections": _with(ACT, SEC, PAR)
    + f"""SELECT {_FETCH("legis_uri")} AS url, trim(part_number) AS part_number, chapter_id, id AS section_id, restrict_start_date AS start_date, CAST((SELECT count(*) FROM par p WHERE p.section_id = sec.id) AS INTEGER) AS n_paragraphs, 0 AS n_commentaries
FROM sec WHERE part_number IS NOT NULL AND legis_uri IN (SELECT uri FROM act)""",
    "parsed_paragraphs": _with(ACT, SEC, PAR)
    + f"""SELECT {_FETCH("s.legis_uri")} AS url, CASE WHEN s.part_number IS NULL THEN 'schedule' ELSE 'section' END AS held_by, s.id AS holder, p.id AS paragraph_id, md5(regexp_replace(coalesce(p.text, ''), '\\s+', '', 'g')) AS letters
FROM par p JOIN sec s ON s.id = p.section_id WHERE s.legis_uri IN (SELECT uri FROM act)""",
    "parsed_acts": _with(ACT, SEC, CIT, NOTE)
    + f"""SELECT {_FETCH("uri")} AS url, supersedes, CAST(enactment_date AS VARCHAR) AS enactment_date, CAST(year(enactment_date) AS VARCHAR) AS year,
CAST((SELECT count(DISTINCT part_number) FROM sec WHERE legis_uri = act.uri) AS INTEGER) AS n_parts, CAST((SELECT count(*) FROM sec WHERE legis_uri = act.uri AND part_number IS NULL) AS INTEGER) AS n_schedule_paragraphs,
CAST((SELECT count(*) FROM note WHERE legis_uri = act.uri) AS INTEGER) AS n_notes, CAST((SELECT count(DISTINCT c.uri) FROM cit c WHERE c.legis_uri = act.uri AND c.uri <> '') + CAST(coalesce(supersedes, '') <> '' AS INTEGER) AS INTEGER) AS n_links FROM act""",
    "descendants": _with(ACT, SEC, PAR)
    + """, e AS (SELECT DISTINCT legis_uri AS src, chapter_id AS dst FROM sec UNION ALL SELECT chapter_id, id FROM sec UNION ALL SELECT section_id, id FROM par),
l1 AS (SELECT uri AS root, dst AS id FROM act JOIN e ON src = uri WHERE dst IS NOT NULL), l2 AS (SELECT root, dst AS id FROM l1 JOIN e ON src = id WHERE dst IS NOT NULL), l3 AS (SELECT root, dst AS id FROM l2 JOIN e ON src = id WHERE dst IS NOT NULL)
SELECT root, id, 1 AS depth FROM l1 UNION ALL SELECT root, id, 2 FROM l2 UNION ALL SELECT root, id, 3 FROM l3""",
    "upserted_acts": _with(ACT) + "SELECT uri, row_id, title, status, modified_date FROM act",
    "duplicate_acts": f"SELECT {_canon('uri')} AS uri, count(*) AS n_rows FROM legislation WHERE uri IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "upserted_edges": f"SELECT DISTINCT {_canon('legis_uri')} AS src, 'CITES' AS type, {_canon('uri')} AS dst FROM citation WHERE uri IS NOT NULL AND legis_uri IS NOT NULL",
    "union_missing_columns": "SELECT row_id, id, title, status, NULL AS par_number FROM section UNION ALL SELECT row_id, id, NULL, status, par_number FROM paragraph",
    "subref_parents": _with(ACT, CIT)
    + """, s AS (SELECT id, legis_uri, legis_uri || '#c' || right(regexp_replace(list_extract(string_split(id, '#'), -1), '^en', ''), 6) AS c FROM cit WHERE origin = 'notes')
SELECT CASE WHEN t.id IS NOT NULL THEN s.c ELSE s.legis_uri END AS src, s.id AS dst, 'HAS_SUBREF' AS type FROM s LEFT JOIN (SELECT id FROM cit WHERE origin = 'commentary') t ON t.id = s.c WHERE s.legis_uri IN (SELECT uri FROM act)""",
    "frontier_wave": _with(ACT)
    + f"""SELECT url, min(depth) AS depth FROM (SELECT {_FETCH("uri")} AS url, CAST(year(recorded_at) AS INTEGER) AS depth FROM citation) f WHERE url IS NOT NULL
AND url NOT IN (SELECT {_FETCH("uri")} FROM act WHERE year(enactment_date) > 1990 AND uri IS NOT NULL) GROUP BY url""",
    "vector_hits": f"WITH {_Q64} SELECT vec_id, round({_COS64}, 5) AS score FROM embeddings, qv ORDER BY {_COS64} DESC, vec_id LIMIT 25",
    "best_per_label": f"WITH {_Q64} SELECT label, round(max({_COS64}), 5) AS best, count(*) AS n FROM embeddings, qv GROUP BY label",
    "acts_by_vector": _VEC
    + "SELECT uri, title, enactment_date, round(score, 5) AS vector_score FROM (SELECT DISTINCT a.uri, a.title, a.enactment_date, hits.score FROM hits JOIN ctx c ON c.node_id = hits.node_id JOIN act a ON a.uri = c.legis_uri) x ORDER BY score DESC, enactment_date DESC NULLS FIRST, uri LIMIT 25",
    "best_acts_by_vector": _VEC + f"SELECT a.uri, a.title, a.enactment_date, round(b.vector_score, 5) AS vector_score FROM act a JOIN ({_TOP}) b ON b.uri = a.uri ORDER BY b.vector_score DESC, enactment_date DESC NULLS FIRST, a.uri LIMIT 150",
    "act_summary": _VEC
    + f""", b AS ({_TOP}), n AS (SELECT legis_uri, count(DISTINCT part_id) AS part_count, count(DISTINCT chapter_id) AS chapter_count, count(DISTINCT section_id) AS section_count, count(DISTINCT paragraph_id) AS paragraph_count FROM ctx GROUP BY legis_uri)
SELECT a.uri, a.title, round(b.vector_score, 5) AS vector_score, part_count, chapter_count, section_count, paragraph_count FROM act a JOIN b ON b.uri = a.uri JOIN n ON n.legis_uri = a.uri
ORDER BY b.vector_score DESC, paragraph_count DESC, a.uri LIMIT 5""",
    "hit_context": _VEC
    + """SELECT legis_uri, node_id, round(score, 5) AS score, part_id, part_number, chapter_id, chapter_number, section_id, sec_number, paragraph_id, par_number, legislation_title, legislation_category, legislation_status, legislation_enactment_date FROM (
SELECT DISTINCT c.*, hits.score, a.title AS legislation_title, a.category AS legislation_category, a.status AS legislation_status, a.enactment_date AS legislation_enactment_date
FROM hits JOIN ctx c ON c.node_id = hits.node_id JOIN act a ON a.uri = c.legis_uri) x ORDER BY x.score DESC, node_id LIMIT 15""",
    "citation_reasoning": _with(ACT, SEC, PAR, HIER, CTX, HITS, CIT, LNK)
    + f"SELECT a.uri, a.title, l.dst AS cited_uri, n.title AS cited_title FROM act a JOIN ({_TOP}) b ON b.uri = a.uri LEFT JOIN lnk l ON l.src = a.uri LEFT JOIN act n ON n.uri = l.dst ORDER BY a.uri, cited_uri NULLS LAST LIMIT 20",
    "title_candidates": _with(ACT, _CAND) + "SELECT uri, title, enactment_date FROM cand",
    "title_score_terms": _with(ACT, _CAND)
    + f"""SELECT uri, title, round(s, 6) AS lexical_score FROM (SELECT uri, title, enactment_date,
CASE WHEN {_norm("title")} = '{_TITLE}' THEN 1.0 ELSE 0.0 END + CASE WHEN contains({_norm("title")}, '{_TITLE}') THEN 0.6 ELSE 0.0 END + CASE WHEN {_norm("title")} <> '' AND contains('{_TITLE}', {_norm("title")}) THEN 0.35 ELSE 0.0 END
 + CASE WHEN contains({_norm("uri")}, '{_TITLE}') THEN 0.25 ELSE 0.0 END + 0.55 * {_SHARED} + CASE WHEN contains({_norm("title")}, '1962') THEN 0.25 ELSE 0.0 END + CASE WHEN list_contains({_WORDS("title")}, 'act') THEN 0.1 ELSE 0.0 END AS s FROM cand) x
ORDER BY round(s, 6) DESC, coalesce(enactment_date, DATE '0001-01-01') DESC, uri LIMIT 25""",
    "uri_missing": "SELECT 'uri is required' AS error",
    "citation_counts": _with(ACT, CIT, LNK)
    + f""", chosen AS (SELECT uri, title FROM act WHERE contains(uri, '/xpga/19') ORDER BY uri LIMIT 20)
SELECT s.uri, s.title, (SELECT count(*) FROM lnk WHERE src = s.uri) AS outgoing_count, (SELECT count(*) FROM lnk WHERE dst = s.uri) AS incoming_count, {_FIRST("src", "dst")} AS top_outgoing_titles, {_FIRST("dst", "src")} AS top_incoming_titles FROM chosen s""",
    "embedded_nodes": _with(_LETTERS)
    + "SELECT id, row_id % 2 = 0 OR text IS NOT NULL AND trim(text) <> '' AS is_text, CASE WHEN row_id % 2 = 0 THEN CAST(0.2 AS FLOAT) WHEN trim(text) <> '' THEN round(CAST(CASE WHEN size > 0 THEN n[1] / size ELSE 0 END AS FLOAT), 4) END AS a, "
    "CASE WHEN row_id % 2 = 0 THEN CAST(0.2 AS FLOAT) WHEN trim(text) <> '' THEN round(CAST(CASE WHEN size > 0 THEN n[5] / size ELSE 0 END AS FLOAT), 4) END AS e FROM letters",
    "semantic_hits": _with(_LETTERS)
    + f"""SELECT id AS node_id, round(list_cosine_similarity(list_transform(n, lambda x: CAST(x AS DOUBLE)), q), 5) AS score FROM letters, (SELECT {_COUNTS("'pension scheme of the registrar'")} AS q) y WHERE row_id % 2 = 1 AND size > 0
ORDER BY list_cosine_similarity(list_transform(n, lambda x: CAST(x AS DOUBLE)), q) DESC, id LIMIT 20""",
    "blank_question": "SELECT '' AS node_id, CAST(0 AS DOUBLE) AS score WHERE false",
    "upsert_counts": f"""WITH r AS (SELECT DISTINCT {_canon("uri")} AS uri, loaded_at < TIMESTAMP '2015-01-01' AS early FROM legislation WHERE uri IS NOT NULL)
SELECT count(CASE WHEN e.uri IS NULL THEN 1 END) AS n_created, count(e.uri) AS n_updated FROM (SELECT uri FROM r WHERE NOT early) n LEFT JOIN (SELECT uri FROM r WHERE early) e ON e.uri = n.uri""",
    "merged_tools": "SELECT event_id, CASE WHEN event_id % 2 = 1 THEN 'later' ELSE event_type END AS k, CAST(user_id AS VARCHAR) AS n, CASE WHEN event_id % 2 = 1 THEN 'new' END AS m FROM events",
    "acts_by_uri": _with(ACT) + "SELECT uri, title, enactment_date FROM act WHERE contains(uri, '/xpga/') ORDER BY enactment_date DESC NULLS FIRST, uri LIMIT 5",
    "resolved_paths": _with(ACT, SEC, PAR, HIER, CTX) + "SELECT c.*, a.title AS legislation_title FROM ctx c LEFT JOIN act a ON a.uri = c.legis_uri WHERE contains(c.node_id, '/section/1/') ORDER BY c.node_id LIMIT 10",
    "grounded_evidence": "SELECT legis_uri AS uri, node_label AS node_id, source AS title, CAST(arg_min(n_chars, doc_id) AS DOUBLE) AS score, min(doc_id) AS doc_id FROM documents GROUP BY 1, 2, 3",
    "url_forms": f"""SELECT row_id, {_FETCH("uri")} AS fetch, rtrim(replace(uri, '/id/', '/'), '/') AS plain, replace(replace(list_extract(string_split(uri, '://'), -1), 'acts.example/', ''), '/', '_') AS file,
regexp_replace(uri || '/section/5', '^(https?://[^/]+)/id/([^/]+/[0-9]+/[0-9]+).*$', '\\1/\\2') AS act FROM citation""",
    "text_forms": rf"""SELECT row_id, {_norm("title")} AS normal, {_YEAR("title")} AS year, coalesce(array_to_string({_WORDS("title")}, '|'), '') AS words,
nullif(regexp_replace(coalesce(title || chr(10), '') || coalesce(description || chr(10), ''), '^\s+|\s+$', '', 'g'), '') AS combined,
CASE WHEN length(description) > 60 THEN substr(description, 1, 60) || '...' ELSE description END AS preview,
round(len(list_intersect(list_distinct({_WORDS("title")}), ['pensions', 'order', '1960'])) / CAST(greatest(len(list_distinct({_WORDS("title")})), 1) AS DOUBLE), 6) AS shared FROM legislation""",
    "payloads": """SELECT event_id, CASE WHEN event_id % 3 <> 0 AND event_id % 7 <> 0 THEN json_extract_string(props, '$.k') END AS k, CASE WHEN event_id % 3 = 0 THEN event_type END AS q,
CASE WHEN event_id % 3 <> 0 AND event_id % 7 = 0 THEN 0 ELSE 1 END AS n FROM events""",
    "write_guard": "SELECT event_id, event_id % 5 IN (1, 3) AS writes, replace(CASE event_id % 5 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TEXTS)) + " END || ' -[:A|:B]-> ', '|:', '|') AS mended FROM events",
    "json_in_text": "SELECT event_id, props AS found, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS INTEGER) ELSE 5 END AS number FROM events",
    "trimmed_history": """SELECT conv_id, turn, role, text FROM (SELECT user_id AS conv_id, event_id AS turn, CASE WHEN event_type IN ('click', 'view') THEN 'user' WHEN event_type = 'purchase' THEN 'assistant' ELSE 'system' END AS role,
CASE WHEN event_id % 11 = 0 THEN ' ' ELSE props END AS text, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) x WHERE r <= 20 AND role IN ('user', 'assistant') AND trim(coalesce(text, '')) <> ''""",
    "tool_durations": """WITH n AS (SELECT user_id, event_type, ts, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events WHERE event_type IN ('view', 'click'))
SELECT a.user_id, a.n, round((epoch_us(b.ts) - epoch_us(a.ts)) / 1000000.0, 3) AS seconds FROM n a JOIN n b ON a.user_id = b.user_id AND a.n = b.n WHERE a.event_type = 'view' AND b.event_type = 'click'""",
    "read_only_sql": _with(ACT) + "SELECT category, count(*) AS n FROM act WHERE title LIKE '%Act%' GROUP BY category",
}
