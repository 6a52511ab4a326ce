"""Nested act records as typed node tables and one edge table.

A record is walked once, in one expression, which yields all its nodes and edges as the elements of one array; one explode makes them
rows. Written once by kind, these rows serve every node table and the edges, each reading its own part only. Nodes are last-write-wins
by key, edges unique by (src, type, dst), so loading a record twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import act_of_section_uri
from ..session import cut_lineage
from .graph import upsert_edges, upsert_nodes

_DATES = ("restrict_start_date", "restrict_end_date")
#: Node label -> its properties.
PROPERTIES = {
    "Legislation": ("uri", "title", "description", "modified_date", "valid_date", "enactment_date", "status", "category", "coming_into_force"),
    "Part": ("number", "order", "title", "uri", "status", "restrict_extent", *_DATES),
    "Chapter": ("number", "order", "title", "uri", "status", "restrict_extent", *_DATES),
    "Section": ("number", "order", "title", "uri", "status", "restrict_extent", *_DATES, "text"),
    "Paragraph": ("number", "order", "text", "uri", "status", "restrict_extent", *_DATES),
    "Schedule": ("number", "order", "title", "reference", "uri"),
    "ScheduleParagraph": ("number", "order", "crossheading", "text", "uri"),
    "ScheduleSubparagraph": ("number", "order", "text", "uri"),
    "Commentary": ("type", "text"),
    "Citation": ("uri", "title", "year", "class", "text"),
    "CitationSubRef": ("uri", "section_ref", "text"),
    "ExplanatoryNotes": ("uri",),
    "ExplanatoryNotesParagraph": ("text", "uri"),
}
#: Label -> the fields whose digest stands for a missing number.
DIGESTED = {
    "Part": ("order", "title", "status", *_DATES),
    "Chapter": ("order", "title", "status", *_DATES),
    "Section": ("order", "title", "status", "restrict_extent", *_DATES, "text"),
    "Paragraph": ("order", "text", "status", "restrict_extent", *_DATES),
    "Schedule": ("order", "title", "reference"),
    "ScheduleParagraph": ("order", "crossheading", "text"),
    "ScheduleSubparagraph": ("order", "text"),
}
EDGE, OPEN = "edge", "open_edge"
#: The columns of an item: its kind (a label, or one of the two above), its ends, and all properties any label has.
_ENDS = ("what", "id", "dst", "named")
_PROPERTIES = tuple(dict.fromkeys(p for props in PROPERTIES.values() for p in props))
_KINDS = {"order": "int", "modified_date": "date", "valid_date": "date", "enactment_date": "date", "coming_into_force": "date", "restrict_start_date": "date", "restrict_end_date": "date"}


@dataclass
class ActGraph:
    """``nodes``: label to table with ``id`` and properties; ``edges``: ``src, dst, type``. These are the ``certain`` edges, which the
    records hold by themselves, and those of ``open_edges`` (``src, dst, type, named``) whose ends are among the nodes; see ``resolve``."""

    nodes: dict[str, DataFrame]
    edges: DataFrame
    certain: DataFrame
    open_edges: DataFrame
    items: DataFrame

    def all_nodes(self) -> DataFrame:
        """One frame ``id, label, title, number, uri, text`` over all labels; absent properties are null."""
        of = self.items.where(F.col("what").isin(*PROPERTIES))
        best = upsert_nodes(of.select(F.struct("what", "id").alias("key"), "title", "number", "uri", "text", *_order(of)), "key", _order(of))
        return best.where(F.col("key.id").isNotNull()).select("key.id", F.col("key.what").alias("label"), "title", "number", "uri", "text")


def _order(items: DataFrame) -> list[str]:
    """Later rows win: acts over stubs, then by modification, delivery, and place in the record."""
    return [c for c in ("known", "modified_date", "valid_date", "version", "place") if c in items.columns]


# The walk is SQL text: the record holds over a hundred fields, and building as many expressions one by one takes longer than the query.


def _day(c: str) -> str:
    return f"CAST(try_to_timestamp({c}, 'yyyy-MM-dd') AS date)"


def _item(what: str, own: str, known: int = 1, **columns: str) -> str:
    """One element of the array; columns that aren't named are null."""
    values = {"what": f"'{what}'", "id": own, **columns}
    typed = [f"'{c}', CAST({values.get(c, 'NULL')} AS {_KINDS.get(c, 'string')})" for c in (*_ENDS, *_PROPERTIES)]
    return f"named_struct({', '.join(typed)}, 'known', {known})"


def _edge(src: str, kind: str, dst: str, what: str = EDGE, named: str = "NULL") -> str:
    return _item(what, src, dst=dst, type=f"'{kind}'", named=named)


_NOTHING = f"filter(array({_item('', 'NULL')}), y -> false)"


def digest(x: str, fields: tuple[str, ...]) -> str:
    """A digest of an element's own plain fields. Its order among its siblings is one of them, so it tells siblings apart."""
    return f"md5(concat_ws('|', {', '.join(f"coalesce(CAST({x}.`{f}` AS string), '')" for f in fields)}))"


def _key(own: str | None, parent: str, tag: str, mark: str) -> str:
    """The uri if there is one, else parent, tag and mark."""
    made = f"concat({parent}, '#{tag}_', {mark})"
    return made if own is None else f"coalesce({own}, {made})"


def _all(*arrays: str) -> str:
    return f"concat({', '.join(arrays)})"


def _if(test: str, *items: str) -> str:
    return f"CASE WHEN {test} THEN array({', '.join(items)}) ELSE {_NOTHING} END"


class _Walk:
    """The expressions of a record's nodes and edges. Every lambda variable has a name of its own."""

    act = "legislation_url"

    def __init__(self, section_text: bool, section_commentaries: bool):
        self.section_text, self.section_commentaries, self.n = section_text, section_commentaries, 0

    def name(self) -> str:
        self.n += 1
        return f"v{self.n}"

    def each(self, array: str, items_of: Callable[[str], str]) -> str:
        """The items of all elements of an array that aren't null, in order."""
        x = self.name()
        return f"coalesce(flatten(transform(filter({array}, {x} -> {x} IS NOT NULL), {x} -> {items_of(x)})), {_NOTHING})"

    def once(self, key: str, then: Callable[[str], str]) -> str:
        """``then`` of a key that is computed once however often it is used."""
        k = self.name()
        return f"flatten(transform(array({key}), {k} -> {then(k)}))"

    def local(self, c: str) -> str:
        return f"concat({self.act}, '#', {c})"

    def node(self, label: str, key: str, parent: str, edge: str, x: str, *props: str, **columns: str) -> str:
        """A node with properties of the same name in the record, further ones by expression, and the edge from its parent."""
        same = {p: _day(f"{x}.`{p}`") if p in _DATES else f"{x}.`{p}`" for p in props}
        return f"array({_item(label, key, **same, **columns)}, {_edge(parent, edge, key)})"

    def citation(self, c: str, parent: str, what: str) -> str:
        """A citation with the edge that leads to it and the act it cites; none without uri or id."""

        def made(key: str) -> str:
            own = _item("Citation", key, **{p: f"{c}.`{p}`" for p in PROPERTIES["Citation"]})
            cites = _edge(key, "CITES", f"replace({c}.uri, '/id/', '/')", OPEN)
            return _if(f"{c}.uri IS NOT NULL AND {key} IS NOT NULL", own, _edge(parent, "HAS_CITATION", key, what), cites)

        return self.once(self.local(f"{c}.id"), made)

    def subref(self, s: str, comment: str) -> str:
        def made(key: str) -> str:
            own = _item("CitationSubRef", key, **{p: f"{s}.`{p}`" for p in PROPERTIES["CitationSubRef"]})
            held = _edge(comment, "HAS_SUBREF", key, OPEN, named=self.local(f"{s}.citation_ref"))
            return _if(f"{s}.uri IS NOT NULL AND {key} IS NOT NULL", own, _edge(key, "REFERENCES", f"{s}.uri", OPEN), held)

        return self.once(self.local(f"{s}.id"), made)

    def comments(self, array: str, parent: str, linked: bool = True) -> str:
        def one(c: str) -> str:
            def made(key: str) -> str:
                below = [self.each(f"{c}.citations", lambda x: self.citation(x, key, OPEN)), self.each(f"{c}.citation_subrefs", lambda x: self.subref(x, key))]
                own = _if(f"{key} IS NOT NULL", _item("Commentary", key, type=f"{c}.type", text=f"{c}.text"), _edge(parent, "HAS_COMMENTARY", key))
                return _all(own, *below) if linked else _all(*below)

            return self.once(self.local(f"{c}.ref_id"), made)

        return self.each(array, one)

    def level(self, x: str, own: str | None, parent: str, tag: str, label: str, edge: str, props: tuple[str, ...], number: str, *below: Callable[[str], str], **columns: str) -> str:
        """A node of the hierarchy and all below it."""
        made = lambda key: _all(self.node(label, key, parent, edge, x, *props, number=f"{x}.{number}", **columns), *(b(key) for b in below))
        mark = f"coalesce({x}.{number}, {digest(x, DIGESTED[label])})"
        return self.once(_key(own, parent, tag, mark), made)

    def paragraph(self, p: str, parent: str) -> str:
        props = ("order", "text", "uri", "status", "restrict_extent", *_DATES)
        return self.level(p, f"{p}.uri", parent, "para", "Paragraph", "HAS_PARAGRAPH", props, "paragraph_number", lambda k: self.comments(f"{p}.commentaries", k))

    def section(self, s: str, parent: str) -> str:
        props = ("order", "title", "uri", "status", "restrict_extent", *_DATES, *(["text"] if self.section_text else []))
        below = (lambda k: self.comments(f"{s}.commentaries", k, self.section_commentaries), lambda k: self.each(f"{s}.paragraphs", lambda p: self.paragraph(p, k)))
        return self.level(s, f"{s}.uri", parent, "sec", "Section", "HAS_SECTION", props, "section_number", *below)

    def chapter(self, c: str, parent: str) -> str:
        props = ("order", "title", "uri", "status", *_DATES)
        return self.level(c, f"{c}.uri", parent, "chapter", "Chapter", "HAS_CHAPTER", props, "chapter_number", lambda k: self.each(f"{c}.sections", lambda s: self.section(s, k)))

    def part(self, p: str) -> str:
        props = ("order", "title", "uri", "status", *_DATES)
        return self.level(p, None, self.act, "part", "Part", "HAS_PART", props, "part_number", lambda k: self.each(f"{p}.chapters", lambda c: self.chapter(c, k)))

    def subparagraph(self, p: str, parent: str) -> str:
        props = ("order", "text", "uri")
        return self.level(p, f"{p}.uri", parent, "ssub", "ScheduleSubparagraph", "HAS_SUBPARAGRAPH", props, "subparagraph_number", lambda k: self.comments(f"{p}.commentaries", k))

    def schedule_paragraph(self, p: str, parent: str) -> str:
        props = ("order", "crossheading", "text", "uri")
        below = (lambda k: self.comments(f"{p}.commentaries", k), lambda k: self.each(f"{p}.subparagraphs", lambda q: self.subparagraph(q, k)))
        return self.level(p, f"{p}.uri", parent, "spara", "ScheduleParagraph", "HAS_PARAGRAPH", props, "paragraph_number", *below)

    def schedule(self, s: str) -> str:
        props = ("order", "title", "reference", "uri")
        return self.level(s, f"{s}.uri", self.act, "sched", "Schedule", "HAS_SCHEDULE", props, "schedule_number", lambda k: self.each(f"{s}.paragraphs", lambda p: self.schedule_paragraph(p, k)))

    def notes(self, n: str) -> str:
        def one(p: str, parent: str) -> str:
            def made(key: str) -> str:
                own = self.node("ExplanatoryNotesParagraph", key, parent, "HAS_PARAGRAPH", p, "text")
                return f"CASE WHEN {key} IS NOT NULL THEN {_all(own, self.each(f'{p}.citations', lambda c: self.citation(c, key, EDGE)))} ELSE {_NOTHING} END"

            return self.once(f"concat({parent}, '#enp_', md5({p}.text))", made)

        made = lambda key: _all(self.node("ExplanatoryNotes", key, self.act, "HAS_EXPLANATORY_NOTES", n, "uri"), self.each(f"{n}.paragraphs", lambda p: one(p, key)))
        return self.once(f"coalesce({n}.uri, concat({self.act}, '#en'))", made)

    def record(self) -> str:
        """All items of a record: the act, the acts it names (stubs: they hold nothing but their uri), parts, schedules and notes."""
        about = {"uri": self.act} | {p: f"identifier.{p}" for p in ("title", "description")} | {p: f"metadata.{p}" for p in ("status", "category")}
        about |= {"modified_date": _day("identifier.modified"), "valid_date": _day("identifier.valid_date")}
        about |= {"enactment_date": _day("metadata.enactment_date"), "coming_into_force": _day("metadata.coming_into_force")}
        ties = [(kind, f"rtrim('/', replace(super.{f}, '/id/', '/'))") for kind, f in (("SUPERSEDES", "supersedes"), ("SUPERSEDED_BY", "superseded_by"))]
        stubs = [self.once(to, lambda k, kind=kind: _if(f"{k} IS NOT NULL", _item("Legislation", k, 0, uri=k), _edge(self.act, kind, k))) for kind, to in ties]
        whole = [self.each("parts", self.part), self.each("schedules", self.schedule), self.each("array(explanatory_notes)", self.notes)]
        return _all(f"array({_item('Legislation', self.act, **about)})", *stubs, *whole)


def act_items(documents: DataFrame, section_text: bool = False, section_commentaries: bool = False) -> DataFrame:
    """All nodes and edges of the records as rows: ``what`` (a label, ``edge`` or ``open_edge``), ``id`` (of a node, or the start of an edge),
    ``dst, named``, the properties, ``known`` (0 for stubs), ``version`` (the record's ``_version``, if it has one) and ``place`` (its number in
    the record). One pass over the records, no shuffle. For the parameters see ``shred``."""
    version = F.col("_version") if "_version" in documents.columns else F.lit(None)
    walk = F.expr(_Walk(section_text, section_commentaries).record())
    docs = documents.where(F.col("legislation_url").isNotNull()).select(version.cast("string").alias("version"), F.posexplode(walk).alias("place", "x"))
    # a section named by a sub-reference stands for its act
    refers = (F.col("what") == OPEN) & (F.col("type") == "REFERENCES")
    items = docs.select("x.*", "version", "place")
    return items.withColumn("dst", F.when(refers, act_of_section_uri("dst")).otherwise(F.col("dst")))


def graph_of(items: DataFrame) -> ActGraph:
    """The graph of items; they are read once for each table that is used, so write them first."""
    nodes = {}
    for label, props in PROPERTIES.items():
        own = items.where(F.col("what") == label)
        order = _order(own)
        kept = upsert_nodes(own.select("id", *props, *(F.col(c).alias(f"_{c}") for c in order)), "id", [f"_{c}" for c in order])
        nodes[label] = kept.select("id", *props)
    ends = [F.col("id").alias("src"), "dst", "type"]
    sure = items.where(F.col("what") == EDGE).select(*ends)
    unsure = items.where(F.col("what") == OPEN).select(*ends, "named")
    ids = items.where(F.col("what").isin("Legislation", "Commentary", "Citation") & F.col("id").isNotNull()).select("what", "id").distinct()
    of = lambda *labels: ids.where(F.col("what").isin(*labels))
    joined = sure.unionByName(_resolve(unsure, of("Legislation", "Commentary"), of("Citation")))
    return ActGraph(nodes, upsert_edges(joined), upsert_edges(sure), unsure, items)


def shred(documents: DataFrame, section_text: bool = False, section_commentaries: bool = False) -> ActGraph:
    """The graph of act records (the declared schema; see ``sources.schema``).

    Records without ``legislation_url`` should be filtered out before. Absent fields and empty or null arrays give no rows. The number
    of a level stands for its uri where there is none, and a digest of its own fields where there is neither. Notes without uri are those
    of their act. A column ``_version`` orders
    records that hold the same node: the last one wins.

    ``section_text`` keeps the text of sections without paragraphs (off: null, as paragraphs alone carry text).
    ``section_commentaries`` also links sections to their commentaries; off, these only contribute citations, whose commentary node
    may then be missing. Citations are linked by act and local id, so equal local ids in two acts don't mix.
    """
    return graph_of(cut_lineage(act_items(documents, section_text, section_commentaries), by=["what"]))


def _resolve(open_edges: DataFrame, needed: DataFrame, citations: DataFrame) -> DataFrame:
    """One semi-join of all open edges with the nodes they hang on (``what, id``), then the choice of parent for sub-references."""
    cites = F.col("type").isin("CITES", "REFERENCES")
    asks = open_edges.select("src", "dst", "type", "named", F.when(cites, "Legislation").otherwise("Commentary").alias("what"), F.when(cites, F.col("dst")).otherwise(F.col("src")).alias("id"))
    held = asks.join(needed, ["what", "id"], "left_semi")
    there = citations.select(F.col("id").alias("named"), F.lit(True).alias("_there"))
    held = held.withColumn("named", F.when(F.col("type") == "HAS_SUBREF", F.col("named"))).join(there, "named", "left")
    return held.select(F.when(F.col("_there"), F.col("named")).otherwise(F.col("src")).alias("src"), "dst", "type")


def resolve(open_edges: DataFrame, acts: DataFrame, commentaries: DataFrame, citations: DataFrame) -> DataFrame:
    """The edges (``src, dst, type``) of those open that the nodes (``id``) decide: CITES and REFERENCES of acts that are there, HAS_CITATION
    of commentaries that are there, HAS_SUBREF as in ``subref_parents`` (``named`` is the citation). Given the nodes of all batches, these are
    the edges of all records at once."""
    ids = lambda df, what: df.select(F.lit(what).alias("what"), "id").distinct()
    return _resolve(open_edges, ids(acts, "Legislation").unionByName(ids(commentaries, "Commentary")), ids(citations, "Citation"))


def subref_parents(subrefs: DataFrame, citations: DataFrame, commentaries: DataFrame) -> DataFrame:
    """HAS_SUBREF edges: from the citation a sub-reference (``id, comment, citation``) names, if that exists, else from its commentary.
    Only sub-references whose commentary exists are linked."""
    asks = subrefs.select(F.col("comment").alias("src"), F.col("id").alias("dst"), F.lit("HAS_SUBREF").alias("type"), F.col("citation").alias("named"))
    none = commentaries.select("id").limit(0)
    return resolve(asks, none, commentaries, citations)
