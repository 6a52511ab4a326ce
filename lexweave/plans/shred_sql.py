"""SQL counterparts of the queries over shredded records: the records' JSON walked level by level."""

from __future__ import annotations

from ..operators.shred import DIGESTED
from ..sources.schema import CITING, LABELS, TO_CITATION
from .problems import _AS_LIST


_LABELS = {"part": "Part", "chap": "Chapter", "sec": "Section", "para": "Paragraph", "sched": "Schedule", "spara": "ScheduleParagraph", "ssub": "ScheduleSubparagraph"}


def _level(name: str, above: str, array: str, rank: int, tag: str | None = None, number: str = "") -> str:
    """Elements of an array as rows. ``place`` orders them within the record: rank of the array among its parent's, then position."""
    listed = f"SELECT *, {_AS_LIST} AS l FROM (SELECT *, json_extract(v, '$.{array}') AS x FROM {above}) a"
    rows = f"SELECT raw_id, act, ver, id AS up, list_concat(place, [{rank}, i]) AS place, l[i] AS v FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM ({listed}) b) c WHERE json_type(l[i]) = 'OBJECT'"
    fields = DIGESTED.get(_LABELS.get(name, ""), ())
    digest = f"md5(concat_ws('|', {', '.join(f"coalesce(v ->> '$.{f}', '')" for f in fields)}))"
    made = f"up || '#{tag}_' || coalesce(v ->> '$.{number}', {digest})"
    own = "NULL" if tag is None else made if tag == "part" else f"coalesce(v ->> '$.uri', {made})"
    return f"{name} AS (SELECT *, {own} AS id FROM ({rows}) d)"


def _local(name: str, above: str, field: str) -> str:
    return f"{name} AS (SELECT * EXCLUDE (id), act || '#' || (v ->> '$.{field}') AS id FROM {above})"


_PLAIN_URL = lambda f: f"rtrim(replace(v ->> '$.super.{f}', '/id/', '/'), '/')"
_DAY = lambda f: f"CAST(try_strptime(v ->> '$.{f}', '%Y-%m-%d') AS DATE)"
#: Where commentaries hang: CTE, the array's rank, whether the section's are linked.
_HOLDERS = (("sec", False), ("para", True), ("spara", True), ("ssub", True))


def _comments() -> list[str]:
    out = []
    for holder, _ in _HOLDERS:
        out += [_level(f"{holder}_c0", holder, "commentaries", 0), _local(f"{holder}_c", f"{holder}_c0", "ref_id")]
    out.append("com AS (" + " UNION ALL ".join(f"SELECT *, {str(linked).lower()} AS linked FROM {holder}_c" for holder, linked in _HOLDERS) + ")")
    out += [_level("cit0", "com", "citations", 0), _local("cit1", "cit0", "id"), _level("sub0", "com", "citation_subrefs", 1), _local("sub", "sub0", "id")]
    return out


_PARTS = [
    """doc AS (SELECT raw_id, v, act, row_number() OVER (ORDER BY coalesce(epoch_us(fetched_at), 0), raw_id) AS ver, CAST([] AS BIGINT[]) AS place, act AS id
  FROM (SELECT raw_id, fetched_at, v, v ->> '$.legislation_url' AS act FROM (
    SELECT raw_id, fetched_at, CAST(doc_json AS JSON) AS v FROM raw_acts WHERE CASE WHEN json_valid(doc_json) THEN json_type(doc_json) = 'OBJECT' ELSE false END) x) y WHERE act <> '')""",
    _level("part", "doc", "parts", 3, "part", "part_number"), _level("chap", "part", "chapters", 1, "chapter", "chapter_number"), _level("sec", "chap", "sections", 1, "sec", "section_number"),
    _level("para", "sec", "paragraphs", 1, "para", "paragraph_number"), _level("sched", "doc", "schedules", 4, "sched", "schedule_number"), _level("spara", "sched", "paragraphs", 1, "spara", "paragraph_number"),
    _level("ssub", "spara", "subparagraphs", 1, "ssub", "subparagraph_number"), *_comments(),
    "note AS (SELECT raw_id, act, ver, act AS up, list_concat(place, [5, 1]) AS place, json_extract(v, '$.explanatory_notes') AS v, coalesce(v ->> '$.explanatory_notes.uri', act || '#en') AS id FROM doc WHERE json_type(v, '$.explanatory_notes') = 'OBJECT')",
    _level("enp0", "note", "paragraphs", 1), "enp AS (SELECT * EXCLUDE (id), up || '#enp_' || md5(v ->> '$.text') AS id FROM enp0 WHERE v ->> '$.text' IS NOT NULL)",
    _level("ncit0", "enp", "citations", 1), _local("ncit1", "ncit0", "id"),
    "ncit AS (SELECT * FROM ncit1 WHERE v ->> '$.uri' IS NOT NULL AND id IS NOT NULL)", "cit AS (SELECT * FROM cit1 WHERE v ->> '$.uri' IS NOT NULL AND id IS NOT NULL)",
    "subs AS (SELECT * FROM sub WHERE v ->> '$.uri' IS NOT NULL AND id IS NOT NULL)",
]

_TIES = [("SUPERSEDES", "supersedes", 1), ("SUPERSEDED_BY", "superseded_by", 2)]
_LEG = f"""leg AS (SELECT act AS id, 1 AS known, {_DAY("identifier.modified")} AS m, {_DAY("identifier.valid_date")} AS d, ver, CAST([0] AS BIGINT[]) AS place, v ->> '$.identifier.title' AS title FROM doc
 {" ".join(f"UNION ALL SELECT {_PLAIN_URL(f)}, 0, NULL, NULL, ver, CAST([{n}] AS BIGINT[]), NULL FROM doc WHERE {_PLAIN_URL(f)} IS NOT NULL" for _, f, n in _TIES)})"""

#: CTE, label, title, number, uri, text.
_NODES = (
    ("part", "Part", "title", "part_number", "uri", None), ("chap", "Chapter", "title", "chapter_number", "uri", None), ("sec", "Section", "title", "section_number", "uri", None),
    ("para", "Paragraph", None, "paragraph_number", "uri", "text"), ("sched", "Schedule", "title", "schedule_number", "uri", None), ("spara", "ScheduleParagraph", None, "paragraph_number", "uri", "text"),
    ("ssub", "ScheduleSubparagraph", None, "subparagraph_number", "uri", "text"), ("(SELECT * FROM com WHERE linked)", "Commentary", None, None, None, "text"), ("cit", "Citation", "title", None, "uri", "text"),
    ("ncit", "Citation", "title", None, "uri", "text"), ("subs", "CitationSubRef", None, None, "uri", "text"), ("note", "ExplanatoryNotes", None, None, "uri", None), ("enp", "ExplanatoryNotesParagraph", None, None, None, "text"),
)
_F = lambda f: "NULL" if f is None else f"v ->> '$.{f}'"
_ALL = "allnodes AS (SELECT id, 'Legislation' AS label, title, NULL AS number, id AS uri, NULL AS text, known, m, d, ver, place FROM leg " + " ".join(
    f"UNION ALL SELECT id, '{label}', {_F(t)}, {_F(n)}, {_F(u)}, {_F(x)}, 1, NULL, NULL, ver, place FROM {cte} z" for cte, label, t, n, u, x in _NODES
) + ")"
_BEST = """nodes AS (SELECT id, label, title, number, uri, text FROM (SELECT *, row_number() OVER (PARTITION BY label, id
 ORDER BY known DESC, m DESC NULLS LAST, d DESC NULLS LAST, ver DESC, place DESC) AS r FROM allnodes WHERE id IS NOT NULL) x WHERE r = 1)"""

_SURE = [("part", "HAS_PART"), ("chap", "HAS_CHAPTER"), ("sec", "HAS_SECTION"), ("para", "HAS_PARAGRAPH"), ("sched", "HAS_SCHEDULE"), ("spara", "HAS_PARAGRAPH"), ("ssub", "HAS_SUBPARAGRAPH"),
         ("(SELECT * FROM com WHERE linked)", "HAS_COMMENTARY"), ("note", "HAS_EXPLANATORY_NOTES"), ("enp", "HAS_PARAGRAPH"), ("ncit", "HAS_CITATION")]
_HAS = lambda label, key: f"{key} IN (SELECT id FROM nodes WHERE label = '{label}')"
_CITED = "replace(v ->> '$.uri', '/id/', '/')"
_REFERS = r"regexp_replace(v ->> '$.uri', '^(https?://[^/]+)/id/([^/]+/[0-9]+/[0-9]+).*$', '\1/\2')"
_NAMED = "act || '#' || (v ->> '$.citation_ref')"
_EDGES = "edges AS (SELECT DISTINCT src, type, dst FROM (" + " UNION ALL ".join(
    [f"SELECT up AS src, '{kind}' AS type, id AS dst FROM {cte} z" for cte, kind in _SURE]
    + [f"SELECT act, '{kind}', {_PLAIN_URL(f)} FROM doc" for kind, f, _ in _TIES]
    + [f"SELECT id, 'CITES', {_CITED} FROM {cte} WHERE {_HAS('Legislation', _CITED)}" for cte in ("cit", "ncit")]
    + [f"SELECT id, 'REFERENCES', {_REFERS} FROM subs WHERE {_HAS('Legislation', _REFERS)}", f"SELECT up, 'HAS_CITATION', id FROM cit WHERE {_HAS('Commentary', 'up')}",
       f"SELECT CASE WHEN {_HAS('Citation', _NAMED)} THEN {_NAMED} ELSE up END, 'HAS_SUBREF', id FROM subs WHERE {_HAS('Commentary', 'up')}"]
) + ") e WHERE src IS NOT NULL AND dst IS NOT NULL)"
_LIST = lambda names: ", ".join(f"'{n}'" for n in names)
_GRAPH = "WITH RECURSIVE " + ",\n".join([*_PARTS, _LEG, _ALL, _BEST, _EDGES])

SQL = {
    "shredded_nodes": _GRAPH + " SELECT id, label, title, number, uri, text FROM nodes",
    "shredded_edges": _GRAPH + " SELECT src, type, dst FROM edges",
    "schema_graph": _GRAPH + " SELECT DISTINCT a.label AS src_label, type, b.label AS dst_label FROM edges JOIN nodes a ON a.id = src JOIN nodes b ON b.id = dst",
    "linked_to_weights": _GRAPH
    + f""", walk AS (SELECT id AS root, id AS node, 0 AS depth FROM nodes WHERE label = 'Legislation'
 UNION ALL SELECT root, dst, depth + 1 FROM walk JOIN edges ON src = node WHERE type IN ({_LIST(TO_CITATION)}) AND depth < 10)
SELECT root AS src, dst, count(*) AS weight FROM walk JOIN edges ON src = node WHERE depth > 0 AND type IN ({_LIST(CITING)}) AND root <> dst GROUP BY root, dst""",
    "schedules_with_citations": _GRAPH
    + """ SELECT a.src AS act, a.dst AS schedule, p.dst AS paragraph, c.dst AS commentary, t.dst AS citation, r.dst AS subref
FROM (SELECT * FROM edges WHERE type = 'HAS_SCHEDULE') a JOIN (SELECT * FROM edges WHERE type = 'HAS_PARAGRAPH') p ON p.src = a.dst LEFT JOIN (SELECT * FROM edges WHERE type = 'HAS_COMMENTARY') c ON c.src = p.dst
LEFT JOIN (SELECT * FROM edges WHERE type = 'HAS_CITATION') t ON t.src = c.dst LEFT JOIN (SELECT * FROM edges WHERE type = 'HAS_SUBREF') r ON r.src = t.dst""",
    "unique_nodes": _GRAPH + " SELECT l.label, count(id) AS n_nodes, CAST(0 AS BIGINT) AS n_shared FROM (VALUES " + ", ".join(f"('{x}')" for x in LABELS) + ") l(label) LEFT JOIN nodes n ON n.label = l.label GROUP BY l.label",
}
