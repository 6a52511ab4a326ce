"""Queries for references (p1), packed values (p4), nested records (p5) and intervals (p6) over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import OPEN_END, OPEN_START, is_blank, parse_day
from ..functions.urls import canonical_uri
from ..operators.intervals import merge_intervals
from ..operators.nested import empty_level, flatten_nested, infer_schema, nested_levels, node_table
from ..operators.packed import unpack_values
from ..operators.references import orphan_references, orphan_report
from ..sources.schema import document_schema, plain_fields
from ..sources.tables import table


def act_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references to acts: from citations (one per citation id) and from acts that supersede another (one per act)."""
    acts = table(spark, sf_dir, "legislation")
    cited = table(spark, sf_dir, "citation")
    parents = acts.select(F.lit("legislation").alias("parent_table"), canonical_uri("uri").alias("parent_key"), "loaded_at", "deleted_at")

    def children(df: DataFrame, name: str, ref_id: Column, target: str, at: str) -> DataFrame:
        one = df.where(F.col(target).isNotNull()).groupBy(ref_id.alias("ref_id")).agg(F.min(at).alias("ref_at"), F.coalesce(F.min_by(canonical_uri(target), at), F.min(canonical_uri(target))).alias("parent_key"))
        return one.where(F.col("ref_id").isNotNull()).select(F.lit("legislation").alias("parent_table"), "parent_key", F.lit(name).alias("ref_table"), "ref_id", "ref_at")

    refs = children(cited, "citation", F.col("id"), "uri", "recorded_at").unionByName(children(acts, "legislation", canonical_uri("uri"), "supersedes", "loaded_at"))
    named = lambda df, target: df.select(F.lit("legislation").alias("parent_table"), canonical_uri(target).alias("parent_key"))
    return orphan_references(parents, refs, counted=named(cited, "uri").unionByName(named(acts, "supersedes")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return act_references(spark, sf_dir).select("ref_table", "ref_id", "reason", F.date_format("ref_at", "yyyy-MM").alias("ref_month"))


def p1_orphans_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_report(act_references(spark, sf_dir)).select("parent_table", "ref_table", F.col("period").alias("ref_month"), "reason", "n_refs")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = unpack_values(table(spark, sf_dir, "section"), "restrict_extent", ["row_id"], at_least=2)
    return parts.select("row_id", "pos", F.col("value").alias("extent_value"))


def p4_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of every section and paragraph, with the grammar alternative that read it and the error flag."""
    read = lambda name: unpack_values(table(spark, sf_dir, name), "restrict_extent", ["row_id"]).select(F.lit(name).alias("record_type"), "*")
    return read("section").unionByName(read("paragraph"))


def p4_bracketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a field in which a bracket holds together what its separators would part: place and number of a section, then its status."""
    packed = F.concat(F.lit("("), F.col("part_number"), F.lit(", "), F.col("sec_number"), F.lit("); "), F.col("status"))
    rows = table(spark, sf_dir, "section").select("row_id", packed.alias("packed"))
    return unpack_values(rows, "packed", ["row_id"], brackets=(("(", ")"),)).select("row_id", "pos", "value", "kind")


NODE_TYPES = {"chapters": "chapter", "sections": "section", "paragraphs": "paragraph", "commentaries": "commentary"}


def act_levels(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    return nested_levels(infer_schema(table(spark, sf_dir, "raw_acts"), "doc_json"), "parts", list(NODE_TYPES))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return node_table(table(spark, sf_dir, "raw_acts"), "raw_id", "doc_json", act_levels(spark, sf_dir), NODE_TYPES)


def p5_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat section table, linked to its chapter table by parent_id. Its columns are the plain fields that the record schema declares
    for a section, whether or not a record holds them; only where no record has any level are there none."""
    raw, levels = table(spark, sf_dir, "raw_acts"), act_levels(spark, sf_dir)
    if not levels:
        return empty_level(raw, "raw_id")
    declared = "parts.chapters.sections"
    fields = sorted(plain_fields(document_schema(), declared))
    own = [p for p in levels if p.endswith(".sections")] or [declared]
    tables = flatten_nested(raw, "raw_id", "doc_json", levels | dict.fromkeys(own, fields))
    return reduce(DataFrame.unionByName, (tables[p] for p in own))


def validity(df: DataFrame, record_type: str, status: Column) -> DataFrame:
    """Validity intervals in days since 1970; blank ends are open, unreadable ones leave the row out."""
    day = lambda c, blank: F.when(is_blank(c), F.unix_date(F.lit(blank).cast("date"))).otherwise(F.unix_date(parse_day(c)))
    return df.select(
        F.lit(record_type).alias("record_type"), F.col("id").alias("record_id"), status.alias("status"),
        day("restrict_start_date", OPEN_START).alias("start_day"), day("restrict_end_date", OPEN_END).alias("end_day"),
    )


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    section = table(spark, sf_dir, "section").where(F.col("status").isNotNull())
    rows = validity(table(spark, sf_dir, "paragraph"), "paragraph", F.lit("")).unionByName(validity(section, "section", F.lower(F.regexp_replace("status", r"^\s+|\s+$", ""))))
    return merge_intervals(rows, ["record_type", "record_id", "status"], "start_day", "end_day")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.date_format(F.date_from_unix_date(c), "yyyy-MM-dd")
    kept = coverage(spark, sf_dir).where((F.col("kind") == "gap") | (F.col("n_intervals") >= 2))
    kind = F.when(F.col("kind") == "gap", "gap").otherwise("period")
    return kept.select("record_type", "record_id", "status", kind.alias("kind"), text("start_day").alias("start_date"), text("end_day").alias("end_date"))


def p6_coverage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches, gaps and days without cover per record type and status."""
    gap = F.col("kind") == "gap"
    return coverage(spark, sf_dir).groupBy("record_type", "status").agg(
        F.count_if(~gap).alias("n_stretches"), F.count_if(gap).alias("n_gaps"),
        F.coalesce(F.sum(F.when(gap, F.col("end_day") - F.col("start_day") + 1)).cast("long"), F.lit(0).cast("long")).alias("gap_days"),
    )


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_orphans_by_month, p4_found, p4_values, p4_bracketed, p5_found, p5_sections, p6_found, p6_coverage_totals)}


def _canon(c: str) -> str:
    t = rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
    a = rf"regexp_extract({t}, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/]*)', 1)"
    return rf"regexp_replace(replace(regexp_replace(lower({a}), '^https://', 'http://') || substr({t}, length({a}) + 1), '/id/', '/'), '(/data\.xml)?/?$', '')"


_ORPHANS = f"""
WITH act AS (SELECT {_canon("uri")} AS k, loaded_at, deleted_at, supersedes FROM legislation),
ref AS (
  SELECT 'citation' AS ref_table, id AS ref_id, min({_canon("uri")}) AS k, min(recorded_at) AS t FROM citation WHERE uri IS NOT NULL AND id IS NOT NULL GROUP BY id
  UNION ALL
  SELECT 'legislation', k, min({_canon("supersedes")}), min(loaded_at) FROM act WHERE supersedes IS NOT NULL GROUP BY k),
judged AS (
  SELECT r.ref_table, r.ref_id, r.t, count(a.k) AS n, min(a.loaded_at) AS arrived,
         coalesce(max(CASE WHEN a.loaded_at <= r.t AND (a.deleted_at IS NULL OR a.deleted_at > r.t) THEN 1 ELSE 0 END), 0) AS live
  FROM ref r LEFT JOIN act a ON a.k = r.k GROUP BY r.ref_table, r.ref_id, r.t),
orphan AS (
  SELECT ref_table, ref_id, CASE WHEN n = 0 THEN 'missing' WHEN arrived > t THEN 'late' ELSE 'deleted' END AS reason, strftime(t AT TIME ZONE 'UTC', '%Y-%m') AS ref_month
  FROM judged WHERE live = 0)
"""

_DAY = lambda c, blank: (
    f"CASE WHEN trim(coalesce({c}, '')) = '' THEN DATE '{blank}' ELSE coalesce("
    rf"CAST(try_strptime(regexp_extract(trim({c}), '^([0-9]{{4}}-[0-9]+-[0-9]+)', 1), '%Y-%m-%d') AS DATE), "
    rf"CAST(try_strptime(regexp_extract(trim({c}), '^([0-9]{{8}})$', 1), '%Y%m%d') AS DATE), "
    rf"CAST(try_strptime(regexp_extract(trim({c}), '^([0-9]+/[0-9]+/[0-9]{{4}})$', 1), '%d/%m/%Y') AS DATE)) END"
)

_COVER = f"""
WITH iv AS (
  SELECT DISTINCT * FROM (
    SELECT 'paragraph' AS record_type, id AS record_id, '' AS status, {_DAY("restrict_start_date", "0001-01-01")} AS s, {_DAY("restrict_end_date", "9999-12-31")} AS e FROM paragraph
    UNION ALL
    SELECT 'section', id, lower(trim(status)), {_DAY("restrict_start_date", "0001-01-01")}, {_DAY("restrict_end_date", "9999-12-31")} FROM section WHERE status IS NOT NULL) x
  WHERE s <= e),
num AS (SELECT record_type, record_id, status, datediff('day', DATE '1970-01-01', s) AS s, datediff('day', DATE '1970-01-01', e) AS e FROM iv),
reach AS (SELECT *, max(e) OVER (PARTITION BY record_type, record_id, status ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM num),
isl AS (SELECT *, sum(CASE WHEN r IS NULL OR s > r + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY record_type, record_id, status ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS i FROM reach),
stretch AS (SELECT record_type, record_id, status, i, min(s) AS a, max(e) AS b, count(*) AS n FROM isl GROUP BY record_type, record_id, status, i),
nxt AS (SELECT *, lead(a) OVER (PARTITION BY record_type, record_id, status ORDER BY i) AS na FROM stretch)
"""
_ISO4 = lambda c: f"lpad(CAST(year(DATE '1970-01-01' + CAST({c} AS INTEGER)) AS VARCHAR), 4, '0') || strftime(DATE '1970-01-01' + CAST({c} AS INTEGER), '-%m-%d')"


_STOP = r"(?:[+,;/|&\n\r]|[ \t]and[ \t])"
_ITEM = rf"""[ \t]*(?:"(?:[^"]|"")*"|''[^'']*''|“[^”]*”)[ \t]*(?:{_STOP}|$)|[^+,;/|&\n\r]*?(?:{_STOP}|$)"""
_TRIM = rf"""regexp_replace(regexp_replace(x, '{_STOP}$', ''), '^\s+|\s+$', '', 'g')"""
_ITEMS = rf"""list_transform(regexp_extract_all(restrict_extent, '{_ITEM}'), lambda x: {_TRIM})"""
_DOUBLE, _OTHER = r"""'^"(?:[^"]|"")*"$'""", r"""'^(?:''[^'']*''|“[^”]*”)$'"""
_PLAIN = rf"""trim(CASE WHEN regexp_matches(v, {_DOUBLE}) THEN replace(substr(v, 2, length(v) - 2), '""', '"') WHEN regexp_matches(v, {_OTHER}) THEN substr(v, 2, length(v) - 2) ELSE v END)"""
_PACKED = rf"""
WITH item AS (SELECT row_id, {_ITEMS} AS xs FROM section WHERE restrict_extent IS NOT NULL),
val AS (SELECT row_id, list_filter(list_transform(xs, lambda v: {_PLAIN}), lambda v: v <> '') AS vs FROM item)
SELECT row_id, CAST(i AS INTEGER) AS pos, vs[i] AS extent_value FROM (SELECT row_id, vs, unnest(range(1, len(vs) + 1)) AS i FROM val WHERE len(vs) >= 2) n
"""
_SHUT = f"(regexp_matches(v, {_DOUBLE}) OR regexp_matches(v, {_OTHER}))"
_VALUES = f"""
WITH item AS (SELECT 'section' AS record_type, row_id, {_ITEMS} AS xs FROM section WHERE restrict_extent IS NOT NULL
  UNION ALL SELECT 'paragraph', row_id, {_ITEMS} FROM paragraph WHERE restrict_extent IS NOT NULL),
one AS (SELECT record_type, row_id, i, xs[i] AS v FROM (SELECT *, unnest(range(1, len(xs) + 1)) AS i FROM item) n),
val AS (SELECT record_type, row_id, i, {_PLAIN} AS value, CASE WHEN {_SHUT} THEN 'quoted' ELSE 'bare' END AS kind,
  CASE WHEN substr(v, 1, 1) IN ('"', chr(39), '“') AND NOT {_SHUT} THEN 'malformed_quote' END AS error FROM one)
SELECT record_type, row_id, CAST(row_number() OVER (PARTITION BY record_type, row_id ORDER BY i) AS INTEGER) AS pos, value, kind, error FROM val WHERE value <> ''
"""

_TEXT_LIST = "CASE WHEN json_valid(x ->> '$') THEN CASE WHEN json_type(x ->> '$') = 'ARRAY' THEN CAST(x ->> '$' AS JSON) END END"
_AS_LIST = f"CAST(CASE json_type(x) WHEN 'ARRAY' THEN x WHEN 'OBJECT' THEN json_array(x) WHEN 'VARCHAR' THEN {_TEXT_LIST} END AS JSON[])"
_NESTED = f"""
WITH RECURSIVE node AS (
  SELECT raw_id, '' AS kind, CAST(-1 AS BIGINT) AS ordinal, '' AS path, '' AS up, CAST(doc_json AS JSON) AS v FROM raw_acts
  WHERE CASE WHEN json_valid(doc_json) THEN json_type(doc_json) = 'OBJECT' ELSE false END
  UNION ALL
  SELECT raw_id, name, i, path || CASE WHEN path = '' THEN '' ELSE '/' END || name || '/' || i, path, l[i + 1] FROM (
    SELECT *, unnest(range(len(l))) AS i FROM (SELECT *, {_AS_LIST} AS l FROM (
      SELECT raw_id, kind, path, name, json_extract(v, '$.' || name) AS x FROM node, (VALUES ('parts'), ('chapters'), ('sections'), ('paragraphs'), ('commentaries')) f(name)
      WHERE (kind = '') = (name = 'parts')) a) b) c
  WHERE json_type(l[i + 1]) = 'OBJECT')
"""
_FOUND = """SELECT raw_id, CASE kind WHEN 'commentaries' THEN 'commentary' ELSE left(kind, length(kind) - 1) END AS node_type, up AS parent_path, path AS node_path
FROM node WHERE kind NOT IN ('', 'parts')"""
_SECTION_FIELDS = ("order", "restrict_end_date", "restrict_extent", "restrict_start_date", "section_number", "status", "text", "title", "uri")
_SECTIONS = f"""SELECT raw_id, md5(concat(raw_id, '|', path)) AS node_id, md5(concat(raw_id, '|', up)) AS parent_id, CAST(ordinal AS INTEGER) AS ordinal,
path AS node_path, up AS parent_path, {", ".join(f"v ->> '$.{f}' AS f_{f}" for f in _SECTION_FIELDS)} FROM node WHERE kind = 'sections'"""


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": _PACKED,
        "p4_values": _VALUES,
        "p4_bracketed": r"""SELECT row_id, 1 AS pos, '(' || part_number || ', ' || sec_number || ')' AS value, 'bracketed' AS kind FROM section WHERE part_number || sec_number || status IS NOT NULL
UNION ALL SELECT row_id, 2, regexp_replace(status, '^\s+|\s+$', '', 'g'), 'bare' FROM section WHERE part_number || sec_number || status IS NOT NULL AND trim(status) <> ''""",
        "p5_found": _NESTED + _FOUND,
        "p5_sections": _NESTED + _SECTIONS,
        "p1_found": _ORPHANS + "SELECT ref_table, ref_id, reason, ref_month FROM orphan",
        "p1_orphans_by_month": _ORPHANS + "SELECT 'legislation' AS parent_table, ref_table, ref_month, reason, count(*) AS n_refs FROM orphan GROUP BY ref_table, ref_month, reason",
        "p6_found": _COVER + f"""SELECT record_type, record_id, status, 'period' AS kind, {_ISO4("a")} AS start_date, {_ISO4("b")} AS end_date FROM nxt WHERE n >= 2
UNION ALL SELECT record_type, record_id, status, 'gap', {_ISO4("b + 1")}, {_ISO4("na - 1")} FROM nxt WHERE na IS NOT NULL""",
        "p6_coverage_totals": _COVER + """SELECT record_type, status, count(*) AS n_stretches, count(na) AS n_gaps, CAST(coalesce(sum(na - b - 1), 0) AS BIGINT) AS gap_days FROM nxt GROUP BY record_type, status""",
    }
