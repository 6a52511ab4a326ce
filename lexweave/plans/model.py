"""The test tables as the engine's model: acts, sections and paragraphs in their last version, citation links, ancestors, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_day
from ..functions.urls import canonical_uri
from ..operators.graph import upsert_nodes
from ..sources.tables import table


def _last(raw: DataFrame, key: str, at: str, columns: tuple[str, ...]) -> DataFrame:
    """The last delivery of each key. Only the columns asked for travel with it (all if none is named)."""
    kept = list(dict.fromkeys((key, *(columns or raw.columns))))
    order = raw.select(*kept, F.col(at).alias("_at"), F.col("row_id").alias("_row"))
    return upsert_nodes(order, key, ["_at", "_row"]).select(*kept)


def acts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per act: the last delivery, under its canonical uri."""
    raw = table(spark, sf_dir, "legislation").withColumns({"uri": canonical_uri("uri"), "supersedes": canonical_uri("supersedes")})
    return _last(raw, "uri", "loaded_at", columns)


def act_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uris of all acts; no row has to be chosen for that."""
    return table(spark, sf_dir, "legislation").select(canonical_uri("uri").alias("uri")).where(F.col("uri").isNotNull()).distinct()


def dated(df: DataFrame) -> DataFrame:
    return df.withColumns({"start_date": parse_day("restrict_start_date"), "end_date": parse_day("restrict_end_date")})


def sections(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    raw = dated(table(spark, sf_dir, "section")).withColumn("legis_uri", canonical_uri("legis_uri"))
    return _last(raw, "id", "loaded_at", columns)


def paragraphs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _last(dated(table(spark, sf_dir, "paragraph")), "id", "loaded_at", columns)


def citations(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per citation id, with canonical uris."""
    raw = table(spark, sf_dir, "citation").withColumns({"uri": canonical_uri("uri"), "legis_uri": canonical_uri("legis_uri")})
    return _last(raw, "id", "recorded_at", columns)


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts citing other acts, both known: ``src, dst, weight`` (number of citations)."""
    known = act_ids(spark, sf_dir)
    pairs = citations(spark, sf_dir, "legis_uri", "uri").select(F.col("legis_uri").alias("src"), F.col("uri").alias("dst")).where(F.col("src") != F.col("dst"))
    weights = pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))
    return weights.join(known.withColumnRenamed("uri", "src"), "src", "left_semi").join(known.withColumnRenamed("uri", "dst"), "dst", "left_semi")


def supersede_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acts(spark, sf_dir, "supersedes").where(F.col("supersedes").isNotNull()).select(F.col("uri").alias("src"), F.col("supersedes").alias("dst"), F.lit("SUPERSEDES").alias("type"))


def hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per paragraph whose section and act are known, with all its ancestors."""
    s = sections(spark, sf_dir, "legis_uri", "part_number", "chapter_id", "chapter_number", "sec_number", "title").select(
        F.col("id").alias("section_id"), "legis_uri", F.concat("legis_uri", F.lit("#part_"), F.coalesce("part_number", F.lit("none"))).alias("part_id"), "part_number", "chapter_id", "chapter_number",
        "sec_number", F.col("title").alias("section_title"),
    )
    p = paragraphs(spark, sf_dir, "section_id", "par_number", "start_date", "end_date", "status", "text").select(F.col("id").alias("paragraph_id"), "section_id", "par_number", "start_date", "end_date", F.col("status").alias("paragraph_status"), "text")
    a = acts(spark, sf_dir, "title").select(F.col("uri").alias("legis_uri"), F.col("title").alias("act_title"))
    return p.join(s, "section_id").join(a, "legis_uri")


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ancestors of every text node: paragraphs and paragraphs of notes."""
    own = hierarchy(spark, sf_dir).select(F.col("paragraph_id").alias("node_id"), "legis_uri", "part_id", "part_number", "chapter_id", "chapter_number", "section_id", "sec_number", "paragraph_id", "par_number")
    notes = table(spark, sf_dir, "notes_paragraph").where(F.col("id").isNotNull()).select(F.col("id").alias("node_id"), canonical_uri("legis_uri").alias("legis_uri")).distinct()
    return own.unionByName(notes, allowMissingColumns=True)


def query_vector(vectors: DataFrame, id_col: str, vec_col: str, dim: int) -> list[float]:
    """The vector of the least id that has all its numbers."""
    whole = (F.size(vec_col) == dim) & F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x))
    row = vectors.where(whole).orderBy(id_col).select(vec_col).first()
    return [float(x) for x in row[0]] if row else [0.0] * dim


def _xml(c: str) -> Column:
    text = F.coalesce(F.col(c).cast("string"), F.lit(""))
    for raw, mark in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(mark))
    return F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def _tag(name: str, *inside: Column | str, **attributes: str) -> Column:
    """An element; columns named as strings are its text, attributes name columns, and those that are null are left out."""
    held = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f' {a}="'), _xml(c), F.lit('"'))).otherwise("") for a, c in attributes.items()]
    return F.concat(F.lit(f"<{name}"), *held, F.lit(">"), *(_xml(i) if isinstance(i, str) else i for i in inside), F.lit(f"</{name}>"))


def _opt(name: str, c: str) -> Column:
    return F.when(F.col(c).isNotNull(), _tag(name, c)).otherwise("")


def _joined(rows: DataFrame, key: str, order: list[str], xml: Column, name: str) -> DataFrame:
    """The elements of each key in order, as one text: all of one page, which is a document of one act."""
    parts = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, xml.alias("_xml")))).alias("_parts"))
    return parts.select(key, F.array_join(F.transform("_parts", lambda p: p["_xml"]), "").alias(name))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An XML page per act (``url, body``): metadata, the act it supersedes, its sections with their paragraphs (those without part as paragraphs of
    a schedule), commentaries with the citations it makes, and its explanatory notes."""
    dates = {"RestrictStartDate": "restrict_start_date", "RestrictEndDate": "restrict_end_date", "RestrictExtent": "restrict_extent", "Status": "status"}
    par = paragraphs(spark, sf_dir, "section_id", "par_number", "order_no", "text", *dates.values())
    p2 = _tag("P2", _opt("Pnumber", "par_number"), _opt("Text", "text"), id="id", **dates)
    inner = _joined(par, "section_id", ["order_no", "id"], p2, "paragraphs").withColumnRenamed("section_id", "id")
    sec = sections(spark, sf_dir, "legis_uri", "part_number", "chapter_number", "chapter_id", "sec_number", "order_no", "title", "text", *dates.values())
    sec = sec.join(inner, "id", "left")
    p1 = _tag("P1", _opt("Pnumber", "sec_number"), F.coalesce("paragraphs", _opt("Text", "text")), id="id")
    group = _tag("P1group", _opt("Title", "title"), p1, **dates)
    whole = _tag("Part", _opt("Number", "part_number"), F.when(F.col("chapter_id").isNotNull(), _tag("Chapter", _opt("Number", "chapter_number"), group, DocumentURI="chapter_id")).otherwise(group))
    by = lambda df, xml, name: _joined(df, "legis_uri", ["order_no", "id"], xml, name)
    body = by(sec.where(F.col("part_number").isNotNull()), whole, "body")
    sched = by(sec.where(F.col("part_number").isNull()), F.concat(F.lit("<Pblock>"), _opt("Title", "title"), p1, F.lit("</Pblock>")), "schedule")
    cites = citations(spark, sf_dir, "legis_uri", "uri", "text").where(F.col("uri").isNotNull())
    comments = _joined(cites, "legis_uri", ["id"], _tag("Commentary", _tag("Citation", "text", id="id", URI="uri"), id="id"), "comments")
    note = table(spark, sf_dir, "notes_paragraph").withColumn("legis_uri", canonical_uri("legis_uri"))
    notes = _joined(_last(note, "id", "row_id", ("legis_uri", "text")), "legis_uri", ["id"], _tag("P", _opt("Text", "text")), "notes")
    act = acts(spark, sf_dir, "title", "description", "enactment_date", "supersedes", "status").withColumns({"legis_uri": F.col("uri"), "year": F.year("enactment_date")})
    for extra in (body, sched, comments, notes):
        act = act.join(extra, "legis_uri", "left")
    some = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"<{name}>"), F.col(c), F.lit(f"</{name}>"))).otherwise("")
    primary = F.concat(F.lit("<PrimaryMetadata>"), _tag("Year", Value="year"), _tag("EnactmentDate", Date="enactment_date"), _tag("DocumentStatus", Value="status"), F.lit("</PrimaryMetadata>"))
    ties = F.when(F.col("supersedes").isNotNull(), _tag("Supersedes", URI="supersedes")).otherwise("")
    xml = F.concat(
        F.lit("<Legislation><Metadata>"), _opt("title", "title"), _opt("description", "description"), _opt("identifier", "uri"), primary, ties, F.lit("</Metadata>"),
        some("Body", "body"), F.when(F.col("schedule").isNotNull(), F.concat(F.lit("<Schedules><Schedule><Number>S1</Number>"), F.col("schedule"), F.lit("</Schedule></Schedules>"))).otherwise(""),
        some("Commentaries", "comments"), some("ExplanatoryNotes", "notes"), F.lit("</Legislation>"),
    )
    return act.select(F.concat("uri", F.lit("/data.xml")).alias("url"), xml.alias("body"))
