"""The nested record of one act, and the labels and edge types it is shredded into."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StructType, _parse_datatype_string

_VALID = "restrict_start_date:string, restrict_end_date:string"
_CITATION = "struct<id:string, uri:string, title:string, class:string, year:string, number:string, text:string>"
_SUBREF = "struct<id:string, uri:string, citation_ref:string, section_ref:string, text:string>"
_COMMENTARY = f"struct<ref_id:string, type:string, text:string, citations:array<{_CITATION}>, citation_subrefs:array<{_SUBREF}>>"
_PARAGRAPH = f"struct<order:int, paragraph_number:string, text:string, uri:string, {_VALID}, restrict_extent:string, status:string, commentaries:array<{_COMMENTARY}>>"
_SECTION = f"struct<order:int, section_number:string, title:string, uri:string, {_VALID}, restrict_extent:string, status:string, text:string, commentaries:array<{_COMMENTARY}>, paragraphs:array<{_PARAGRAPH}>>"
_CHAPTER = f"struct<order:int, chapter_number:string, uri:string, {_VALID}, status:string, title:string, sections:array<{_SECTION}>>"
_PART = f"struct<order:int, part_number:string, uri:string, {_VALID}, status:string, title:string, chapters:array<{_CHAPTER}>>"
_SUBPARAGRAPH = f"struct<order:int, subparagraph_number:string, text:string, uri:string, commentaries:array<{_COMMENTARY}>>"
_SCHEDULE_PARAGRAPH = f"struct<order:int, paragraph_number:string, crossheading:string, uri:string, text:string, commentaries:array<{_COMMENTARY}>, subparagraphs:array<{_SUBPARAGRAPH}>>"
_SCHEDULE = f"struct<order:int, schedule_number:string, title:string, reference:string, uri:string, paragraphs:array<{_SCHEDULE_PARAGRAPH}>>"
_EFFECT = "struct<effect_id:string, type:string, affected_provisions:string, affecting_provisions:string, requires_applied:boolean, notes:string, modified_date:string, affecting_title:string, in_force_date:string, in_force_qualification:string>"
_ROOT = (
    "legislation_url string, identifier struct<title:string, description:string, publisher:string, modified:string, uri:string, valid_date:string>, "
    "super struct<supersedes:string, superseded_by:string>, "
    f"metadata struct<year:string, number:string, enactment_date:string, status:string, isbn:string, category:string, coming_into_force:string, unapplied_effects:array<{_EFFECT}>>, "
    f"parts array<{_PART}>, schedules array<{_SCHEDULE}>, explanatory_notes struct<uri:string, paragraphs:array<struct<text:string, citations:array<{_CITATION}>>>>"
)

#: The node labels.
LABELS = (
    "Legislation", "Part", "Chapter", "Section", "Paragraph", "Schedule", "ScheduleParagraph", "ScheduleSubparagraph",
    "Commentary", "Citation", "CitationSubRef", "ExplanatoryNotes", "ExplanatoryNotesParagraph",
)
#: The edge types that make the structure of an act, and all types on the way to a citation.
STRUCTURE = ("HAS_PART", "HAS_CHAPTER", "HAS_SECTION", "HAS_PARAGRAPH", "HAS_SCHEDULE", "HAS_SUBPARAGRAPH", "HAS_EXPLANATORY_NOTES")
TO_CITATION = ("HAS_PART", "HAS_CHAPTER", "HAS_SECTION", "HAS_PARAGRAPH", "HAS_SCHEDULE", "HAS_SUBPARAGRAPH", "HAS_COMMENTARY", "HAS_CITATION", "HAS_SUBREF")
CITING = ("CITES", "REFERENCES")


def document_schema() -> StructType:
    """The record as declared: absent fields are null, so no operator has to ask whether a field exists."""
    return _parse_datatype_string(_ROOT)


def plain_fields(schema: StructType, level: str) -> list[str]:
    """The fields that the objects of a level (``parts.chapters``) are declared with and that aren't lists."""
    for name in level.split("."):
        schema = schema[name].dataType.elementType
    return [f.name for f in schema if not isinstance(f.dataType, ArrayType)]
