"""Acts in XML as nested records.

The tree is laid out once in document order, each element with its parent and the end of its subtree. Every question the extraction asks
(first descendant of a name, all descendants of some names, nearest ancestor of a name) is then a search in sorted positions.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .schema import document_schema

#: Names of elements and attributes in act documents, by the field they fill.
IDENTIFIER = {"title": "title", "description": "description", "publisher": "publisher", "modified": "modified", "uri": "identifier", "valid_date": "valid"}
METADATA_BLOCKS = ("PrimaryMetadata", "SecondaryMetadata", "EUMetadata")
METADATA = {"year": ("Year", "Value"), "number": ("Number", "Value"), "enactment_date": ("EnactmentDate", "Date"), "status": ("DocumentStatus", "Value"), "isbn": ("ISBN", "Value"), "category": ("DocumentCategory", "Value")}
EFFECT = {"effect_id": "EffectId", "type": "Type", "affected_provisions": "AffectedProvisions", "affecting_provisions": "AffectingProvisions", "notes": "Notes", "modified_date": "Modified"}
CITATION = {"id": "id", "uri": "URI", "title": "Title", "class": "Class", "year": "Year", "number": "Number"}
SUBREF = {"id": "id", "uri": "URI", "citation_ref": "CitationRef", "section_ref": "SectionRef"}
VALIDITY = {"restrict_start_date": "RestrictStartDate", "restrict_end_date": "RestrictEndDate", "status": "Status"}
EXTENT = VALIDITY | {"restrict_extent": "RestrictExtent"}
NESTED_PARAGRAPHS = ("P2", "P3", "P4")


class Tree:
    """Elements in document order."""

    def __init__(self, xml: str | bytes):
        self.elements: list[ElementTree.Element] = []
        self.parent: list[int] = []
        self.end: list[int] = []
        self.at: dict[str, list[int]] = defaultdict(list)
        stack = [(ElementTree.fromstring(xml), -1)]
        open_: list[int] = []
        while stack:
            element, parent = stack.pop()
            while open_ and open_[-1] != parent:
                self.end[open_.pop()] = len(self.elements)
            n = len(self.elements)
            self.elements.append(element)
            self.parent.append(parent)
            self.end.append(0)
            self.at[element.tag.rpartition("}")[2]].append(n)
            open_.append(n)
            stack += [(child, n) for child in reversed(element)]
        for n in open_:
            self.end[n] = len(self.elements)

    def inside(self, n: int, *names: str) -> list[int]:
        """Descendants of the names, in document order; n = -1 is the document."""
        stop = len(self.elements) if n < 0 else self.end[n]
        found = [p for name in names for p in self.at.get(name, ())[bisect_right(self.at.get(name, ()), n) : bisect_right(self.at.get(name, ()), stop - 1)]]
        return sorted(found) if len(names) > 1 else found

    def first(self, n: int | None, *names: str) -> int | None:
        return next(iter(self.inside(n, *names)), None) if n is not None else None

    def above(self, n: int, name: str) -> int | None:
        """The nearest ancestor of a name."""
        n = self.parent[n]
        while n >= 0:
            if self.elements[n].tag.rpartition("}")[2] == name:
                return n
            n = self.parent[n]
        return None

    def attribute(self, n: int | None, name: str) -> str | None:
        return None if n is None else self.elements[n].get(name)

    def attributes(self, n: int | None, names: dict[str, str]) -> dict[str, str | None]:
        return {field: self.attribute(n, name) for field, name in names.items()}

    def text(self, n: int | None) -> str | None:
        """All text of an element, stripped."""
        return None if n is None else "".join(self.elements[n].itertext()).strip()

    def words(self, n: int) -> str:
        """The stripped strings of an element, joined by blanks."""
        return " ".join(t for t in (s.strip() for s in self.elements[n].itertext()) if t)

    def texts(self, n: int) -> str:
        """The words of all Text descendants."""
        return " ".join(self.words(t) for t in self.inside(n, "Text"))

    def address(self, n: int) -> str | None:
        return self.attribute(n, "DocumentURI") or self.attribute(n, "id")


def _plain(url: str) -> str:
    return url.replace("/id/", "/").rstrip("/")


def identifier(t: Tree) -> dict:
    return {field: t.text(t.first(-1, name)) for field, name in IDENTIFIER.items()}


def superseding(t: Tree) -> dict:
    """Links to older and newer acts; a field is there only if its element is. An element without URI makes the document invalid."""
    out = {}
    for field, name in (("supersedes", "Supersedes"), ("superseded_by", "SupersededBy")):
        if (n := t.first(-1, name)) is not None:
            out[field] = _plain(t.elements[n].attrib["URI"])
    return out


def metadata(t: Tree) -> dict:
    block = t.first(-1, *METADATA_BLOCKS)
    if block is None:
        return {}
    out = {field: t.attribute(t.first(block, name), attr) for field, (name, attr) in METADATA.items()}
    if (force := t.first(block, "ComingIntoForce")) is not None:
        day = t.first(force, "DateTime")
        out["coming_into_force"] = None if day is None else t.elements[day].attrib["Date"].strip()
    out["unapplied_effects"] = [effect(t, n) for n in t.inside(block, "UnappliedEffect")]
    return out


def effect(t: Tree, n: int) -> dict:
    force = t.first(n, "InForce")
    day = t.attribute(force, "Date") or ("Prospective" if t.attribute(force, "Prospective") == "true" else None)
    return t.attributes(n, EFFECT) | {
        "requires_applied": t.attribute(n, "RequiresApplied") == "true", "affecting_title": t.text(t.first(n, "AffectingTitle")), "in_force_date": day,
        "in_force_qualification": t.attribute(force, "Qualification") or t.attribute(force, "OtherQualification"),
    }


def citations(t: Tree, n: int) -> list[dict]:
    return [t.attributes(c, CITATION) | {"text": t.text(c)} for c in t.inside(n, "Citation")]


def commentaries(t: Tree) -> dict[str, dict]:
    """Commentaries by id; those without id can't be referred to and are left out, of equal ids the last one holds."""
    out = {}
    for n in t.inside(-1, "Commentary"):
        if ref := t.attribute(n, "id"):
            subrefs = [t.attributes(s, SUBREF) | {"text": t.text(s)} for s in t.inside(n, "CitationSubRef")]
            out[ref] = {"ref_id": ref, "type": t.attribute(n, "Type"), "text": t.words(n), "citations": citations(t, n), "citation_subrefs": subrefs}
    return out


def referred(t: Tree, n: int, known: dict[str, dict], not_in: str | None = None) -> list[dict]:
    """Commentaries that an element refers to, in order and with repetitions; references that have an ancestor named ``not_in``, or that
    lead nowhere, are left out."""
    refs = (r for r in t.inside(n, "CommentaryRef") if not_in is None or t.above(r, not_in) is None)
    return [known[ref] for ref in (t.attribute(r, "Ref") for r in refs) if ref in known]


def body(t: Tree, known: dict[str, dict]) -> list[dict]:
    """Parts, chapters and sections outside the schedules. Parts are one where their number is; the first holds its attributes."""
    parts: dict[str | None, dict] = {}
    chapters: dict[tuple, dict] = {}
    order = 0
    for n in t.inside(-1, "P1"):
        if t.above(n, "Schedules") is not None:
            continue
        order += 1
        part, chapter, group = t.above(n, "Part"), t.above(n, "Chapter"), t.above(n, "P1group")
        number, chapter_number = t.text(t.first(part, "Number")), t.text(t.first(chapter, "Number"))
        if number not in parts:
            parts[number] = {"order": len(parts) + 1, "part_number": number, "uri": t.attribute(part, "DocumentURI"), **t.attributes(part, VALIDITY), "title": t.text(t.first(part, "Title")), "chapters": []}
        uri = t.attribute(chapter, "DocumentURI")
        slot = (number, uri or chapter_number or "")
        if slot not in chapters:
            siblings = parts[number]["chapters"]
            chapters[slot] = {"order": len(siblings) + 1, "chapter_number": chapter_number, "uri": uri, **t.attributes(chapter, VALIDITY), "title": t.text(t.first(chapter, "Title")), "sections": []}
            siblings.append(chapters[slot])
        section = {
            "order": order, "section_number": t.text(t.first(n, "Pnumber")), "title": t.text(t.first(group, "Title")), "uri": t.address(n), **t.attributes(group, EXTENT),
            "commentaries": referred(t, n, known, "P2"),
            "paragraphs": [
                {"order": i, "paragraph_number": t.text(t.first(p, "Pnumber")), "text": t.texts(p), "uri": t.address(p), **t.attributes(p, EXTENT), "commentaries": referred(t, p, known)}
                for i, p in enumerate(t.inside(n, *NESTED_PARAGRAPHS), 1)
            ],
        }
        if not section["paragraphs"]:
            section["text"] = t.texts(n)
        chapters[slot]["sections"].append(section)
    return list(parts.values())


def schedules(t: Tree, known: dict[str, dict]) -> list[dict]:
    root = t.first(-1, "Schedules")
    return [
        {
            "order": i, "schedule_number": t.text(t.first(s, "Number")), "title": t.text(t.first(s, "Title")), "reference": t.text(t.first(s, "Reference")), "uri": t.address(s),
            "paragraphs": [schedule_paragraph(t, k, p, known) for k, p in enumerate(t.inside(s, "P1"), 1)],
        }
        for i, s in enumerate(t.inside(root, "Schedule") if root is not None else (), 1)
    ]


def schedule_paragraph(t: Tree, order: int, n: int, known: dict[str, dict]) -> dict:
    block = t.above(n, "Pblock")
    out = {"order": order, "paragraph_number": t.text(t.first(n, "Pnumber")), "crossheading": t.text(t.first(block, "Title")), "uri": t.address(n), "commentaries": referred(t, n, known, "P2")}
    out["subparagraphs"] = [
        {"order": i, "subparagraph_number": t.text(t.first(p, "Pnumber")), "text": t.texts(p), "uri": t.address(p), "commentaries": referred(t, p, known)} for i, p in enumerate(t.inside(n, "P2"), 1)
    ]
    if not out["subparagraphs"]:
        out["text"] = t.texts(n)
    return out


def notes(t: Tree) -> dict | None:
    root = t.first(-1, "ExplanatoryNotes")
    if root is None:
        return None
    return {"uri": t.attribute(root, "DocumentURI") or t.attribute(root, "IdURI"), "paragraphs": [{"text": t.texts(p), "citations": citations(t, p)} for p in t.inside(root, "P")]}


def parse_act(xml: str | bytes, url: str, depth: int = 0, max_depth: int = 2) -> tuple[dict, list[tuple[str, int]]]:
    """The nested record, and the links found with the depth they lead to: cited acts one deeper, as long as ``depth`` is below
    ``max_depth``; superseding acts at the same depth."""
    t = Tree(xml)
    known, about = commentaries(t), superseding(t)
    record = {
        "legislation_url": url, "identifier": identifier(t), "super": about, "metadata": metadata(t),
        "parts": body(t, known), "schedules": schedules(t, known), "explanatory_notes": notes(t),
    }
    cited: Iterable[dict] = [c for k in known.values() for c in k["citations"]] + [c for p in (record["explanatory_notes"] or {}).get("paragraphs", []) for c in p["citations"]]
    links = {(c["uri"], depth + 1) for c in cited if c["uri"] and depth < max_depth} | {(u, depth) for u in about.values() if u}
    return record, sorted(links)


def element_schema(xml: str | bytes) -> set[tuple[str, str | None]]:
    """Paths of element names in a document, with each attribute (and once without any)."""
    t = Tree(xml)
    paths: list[str] = []
    out: set[tuple[str, str | None]] = set()
    for n, element in enumerate(t.elements):
        above = t.parent[n]
        paths.append((f"{paths[above]}/" if above >= 0 else "") + element.tag.rpartition("}")[2])
        out.add((paths[n], None))
        out |= {(paths[n], a.rpartition("}")[2]) for a in element.attrib}
    return out


def parse_pages(pages: DataFrame, max_depth: int = 2) -> DataFrame:
    """Pages (``url, depth, body``) as ``url, depth, document, links, error``. A page that can't be parsed, or has no body, has a null
    document, no links, and says why in ``error``; the others are not touched by it."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for url, depth, xml in zip(batch["url"], batch["depth"], batch["body"], strict=True):
                try:
                    if xml is None:
                        raise ValueError("no body")
                    record, links = parse_act(xml.encode() if isinstance(xml, str) else bytes(xml), url, int(depth), max_depth)
                    out.append((url, depth, json.dumps(record), json.dumps([{"url": u, "depth": d} for u, d in links]), None))
                except Exception as e:  # one bad page must not end the task
                    out.append((url, depth, None, "[]", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["url", "depth", "record", "links", "error"])

    raw = pages.select("url", "depth", "body").mapInPandas(parse, "url string, depth int, record string, links string, error string")
    return raw.select("url", "depth", F.from_json("record", document_schema()).alias("document"), F.from_json("links", "array<struct<url:string,depth:int>>").alias("links"), "error")


def page_schema(pages: DataFrame) -> DataFrame:
    """All element paths of all pages with their attributes: ``path, attribute, n_pages``; pages that can't be parsed add nothing."""

    def paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[str, str | None], int] = {}
        for batch in batches:
            for xml in batch["body"]:
                try:
                    for key in element_schema(xml.encode() if isinstance(xml, str) else bytes(xml)):
                        seen[key] = seen.get(key, 0) + 1
                except (ElementTree.ParseError, TypeError):
                    continue
        yield pd.DataFrame([(p, a, n) for (p, a), n in seen.items()], columns=["path", "attribute", "n"])

    return pages.select("body").mapInPandas(paths, "path string, attribute string, n long").groupBy("path", "attribute").agg(F.sum("n").alias("n_pages"))
