"""The query gallery: hierarchy, citation, temporal, retrieval and utility queries over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.urls import act_of_section_uri, canonical_uri, fetch_url, file_name, plain_url
from ..operators import catalog, embed, graph, search, shred, temporal
from ..operators.crawl import crawl, next_wave
from ..session import cut_lineage
from ..sources.act_xml import page_schema, parse_pages
from ..sources.documents import documents_from_text
from ..sources.schema import CITING, LABELS, TO_CITATION
from ..sources.tables import table
from . import model


FROM_DAY, TO_DAY, TODAY = "1990-01-01", "2015-12-31", "2025-01-01"
TITLE = "Pensions (Consolidation) Act 1962"


def _under(c: str, part: str | None):
    """Uris that contain a text; all where none is given."""
    return F.lit(True) if part is None else F.col(c).contains(part)


def linked_to_star(s: SparkSession, d: str) -> DataFrame:
    """Links between nations through customers, orders and items to suppliers, weighted by the number of paths."""
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    edge = lambda t, a, b, kind: table(s, d, t).select(a.alias("src"), b.alias("dst"), F.lit(kind).alias("type"))
    edges = edge("customer", name("n", "c_nationkey"), name("c", "c_custkey"), "HAS_PART").unionByName(edge("orders", name("c", "o_custkey"), name("o", "o_orderkey"), "HAS_CHAPTER"))
    edges = edges.unionByName(edge("lineitem", name("o", "l_orderkey"), name("s", "l_suppkey"), "HAS_SECTION")).unionByName(edge("supplier", name("s", "s_suppkey"), name("n", "s_nationkey"), "CITES"))
    roots = table(s, d, "nation").select(name("n", "n_nationkey").alias("id"))
    return graph.trail_counts(edges, roots, list(CITING), list(TO_CITATION), 3)


def citation_weights(s, d):
    return model.links(s, d)


def citation_table(s, d):
    """Links with titles, heaviest first."""
    a = model.acts(s, d, "title")
    out = model.links(s, d).join(a.select(F.col("uri").alias("src"), F.col("title").alias("src_title")), "src").join(a.select(F.col("uri").alias("dst"), F.col("title").alias("dst_title")), "dst")
    return out.orderBy(F.desc("weight"), "src", "dst")


def linked_network(s, d):
    """The first 100 links in order of their ends."""
    return model.links(s, d).orderBy("src", "dst").limit(100)


def citation_degrees(s, d):
    out = graph.degree_counts(model.acts(s, d, "title"), model.links(s, d))
    return out.withColumns({c: F.array_join(c, "; ") for c in ("top_outgoing_titles", "top_incoming_titles")})


def hierarchy_paths(s, d, uri=None):
    h = model.hierarchy(s, d).where(_under("legis_uri", uri))
    return h.select("legis_uri", "part_id", "chapter_id", "section_id", "paragraph_id")


def one_part(s, d):
    """Everything below the parts numbered 1."""
    return model.hierarchy(s, d).where(F.col("part_number") == "Part 1").select("legis_uri", "part_id", "section_id", "sec_number", "paragraph_id", "par_number")


def citing_upward(s, d, uri=None):
    """Citations of all acts, or those whose uri contains a text, with the acts that make them."""
    a = model.acts(s, d, "title")
    c = model.citations(s, d, "legis_uri", "uri").where(_under("uri", uri)).select(F.col("id").alias("citation_id"), F.col("legis_uri").alias("citing_uri"), F.col("uri").alias("cited_uri"))
    return c.join(a.select(F.col("uri").alias("citing_uri"), F.col("title").alias("citing_title")), "citing_uri").join(a.select(F.col("uri").alias("cited_uri")), "cited_uri", "left_semi")


def notes_with_citations(s, d, uri=None):
    """All acts, or those whose uri contains a text, with their notes and, independently, the citations in them: every pair of both, or
    nulls where there is none."""
    a = model.act_ids(s, d).where(_under("uri", uri))
    notes = table(s, d, "notes_paragraph").select(canonical_uri("legis_uri").alias("uri"), F.col("id").alias("note_id")).distinct()
    cites = model.citations(s, d, "legis_uri", "origin").where(F.col("origin") == "notes").select(F.col("legis_uri").alias("uri"), F.col("id").alias("citation_id"))
    return a.join(notes, "uri", "left").join(cites, "uri", "left")


def supersede_network(s, d):
    return graph.supersede_network(model.supersede_edges(s, d))


def supersedes_chain(s, d):
    return search.supersede_step(model.acts(s, d, "title"), model.supersede_edges(s, d), "pensions")


def superseded_chain(s, d):
    back = model.supersede_edges(s, d).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return search.supersede_step(model.acts(s, d, "title"), back, "pensions")


def _timed(s, d):
    return model.hierarchy(s, d).select("legis_uri", "act_title", "part_number", "sec_number", "section_title", "par_number", "paragraph_id", "paragraph_status", "start_date", "end_date")


def as_of_snapshot(s, d):
    return temporal.as_of(_timed(s, d), "2005-06-01").select("legis_uri", "paragraph_id", "start_date", "end_date")


def visible_after(s, d):
    return temporal.visible_after(_timed(s, d), "2005-06-01").select("legis_uri", "paragraph_id", "start_date", "end_date")


def altered_ids(s, d):
    return temporal.altered(_timed(s, d), "2005-06-01", TODAY).select("paragraph_id").distinct()


def point_in_time(s, d):
    return temporal.starting_from(_timed(s, d), "2005-06-01").select("legis_uri", "paragraph_id", "start_date")


def _diff(s, d):
    return temporal.temporal_diff(_timed(s, d), FROM_DAY, TO_DAY)


def temporal_diff(s, d):
    """The first 500 changes in order of kind and numbers; numbers are text."""
    order = [F.asc_nulls_last(c) for c in ("change_type", "part_number", "sec_number", "par_number", "paragraph_id")]
    return _diff(s, d).orderBy(*order).limit(500)


def temporal_diff_all(s, d):
    return _diff(s, d).select("change_type", "paragraph_id", "start_date", "end_date")


def change_counts(s, d):
    return temporal.change_counts(_diff(s, d))


def amendment_timeline(s, d):
    return temporal.amendment_timeline(_diff(s, d))


def yearly_enactments(s, d):
    return temporal.yearly_series(model.acts(s, d, "enactment_date"), "enactment_date")


def _ids(s, d, name):
    return table(s, d, name).select("id").where(F.col("id").isNotNull()).distinct()


def dashboard_metrics(s, d):
    return catalog.metrics(model.acts(s, d, "enactment_date"), _ids(s, d, "section"), _ids(s, d, "paragraph"), model.links(s, d)).withColumn("years", T.year_range(F.col("first_enacted"), F.col("last_enacted")))


def acts_per_category(s, d):
    return model.acts(s, d, "category", "status").groupBy(F.lower(F.trim("category")).alias("category"), F.lower(F.trim("status")).alias("status")).agg(F.count(F.lit(1)).alias("n_acts"))


def corpus_table(s, d):
    return model.acts(s, d, "title", "category", "status", "enactment_date", "coming_into_force").select("title", "uri", "category", "status", "enactment_date", "coming_into_force").orderBy(F.asc_nulls_last("enactment_date"), "uri")


def topic_network(s, d):
    """Links among the acts on one topic: the word stands in the act's title or in a section title."""
    word = "pension"
    h = model.sections(s, d, "legis_uri", "title").where(T.contains_folded(F.col("title"), word)).select(F.col("legis_uri").alias("id"))
    a = model.acts(s, d, "title").where(T.contains_folded(F.col("title"), word)).select(F.col("uri").alias("id"))
    return graph.closed_network(model.links(s, d), a.unionByName(h))


def act_full_text(s, d, uri=None):
    """The readable text of all acts, or those whose uri contains a text: the first of text, title and description that each node has, in
    order of the document (the act, each section followed by its paragraphs, the notes), joined by blank lines."""
    a = model.acts(s, d).where(_under("uri", uri)).select(F.col("uri").alias("legis_uri"), F.coalesce("title", "description").alias("content"))
    sec = model.sections(s, d).select("legis_uri", F.col("id").alias("section_id"), F.col("order_no").alias("section_no"), F.coalesce("text", "title").alias("content"))
    par = model.paragraphs(s, d).select("section_id", F.col("id").alias("node_id"), F.col("order_no").alias("number"), F.col("text").alias("content"))
    notes = graph.upsert_nodes(table(s, d, "notes_paragraph"), "id", ["row_id"]).select(canonical_uri("legis_uri").alias("legis_uri"), F.col("id").alias("node_id"), F.col("text").alias("content"))
    par = par.join(sec.select("section_id", "section_no", "legis_uri"), "section_id")
    nodes = a.withColumn("place", F.lit(0)).unionByName(sec.withColumn("place", F.lit(1)), allowMissingColumns=True)
    nodes = nodes.unionByName(par.withColumn("place", F.lit(1)), allowMissingColumns=True).unionByName(notes.withColumn("place", F.lit(2)), allowMissingColumns=True)
    known = nodes.where(F.col("content").isNotNull()).join(a.select("legis_uri"), "legis_uri", "left_semi")
    # a section has no node_id and number; nulls come first, so it stands before its paragraphs
    order = ("place", "section_no", "section_id", "number", "node_id", "content")
    parts = known.groupBy("legis_uri").agg(F.sort_array(F.collect_list(F.struct(*order))).alias("parts"))
    return parts.select("legis_uri", F.array_join(F.transform("parts", lambda p: p["content"]), "\n\n").alias("content"))


def descendants(s, d, uri=None):
    """All structural descendants of all acts, or those whose uri contains a text, by bounded expansion, with their depth."""
    sec, par = model.sections(s, d, "legis_uri", "chapter_id"), model.paragraphs(s, d, "section_id")
    edges = sec.select(F.col("legis_uri").alias("src"), F.col("chapter_id").alias("dst"), F.lit("HAS_CHAPTER").alias("type")).distinct()
    edges = edges.unionByName(sec.select(F.col("chapter_id").alias("src"), F.col("id").alias("dst"), F.lit("HAS_SECTION").alias("type")))
    edges = edges.unionByName(par.select(F.col("section_id").alias("src"), F.col("id").alias("dst"), F.lit("HAS_PARAGRAPH").alias("type"))).where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    starts = model.act_ids(s, d).where(_under("uri", uri)).select(F.col("uri").alias("id"))
    return graph.expand(edges, starts, ["HAS_CHAPTER", "HAS_SECTION", "HAS_PARAGRAPH"], 1, 6).select("root", "id", "depth")


def _act_network(s, d):
    known = model.links(s, d).select("src", "dst", F.lit("LINKED_TO").alias("type"))
    return known.unionByName(model.supersede_edges(s, d))


def _ends(s, d):
    """Two acts of the network: the least, and the greatest within its reach of a few steps."""
    ends = model.supersede_edges(s, d).agg(F.min("src"), F.max("src")).first()
    return ends[0] or "", ends[1] or ""


def shortest_path(s, d):
    return graph.shortest_path(_act_network(s, d), *_ends(s, d)).select(F.array_join("path", " > ").alias("path"), "hops")


def shortest_paths_through_old_acts(s, d):
    """All shortest paths of up to five steps whose inner acts were enacted by 1990."""
    old = model.acts(s, d, "enactment_date").where(F.year("enactment_date") <= 1990).select(F.col("uri").alias("id"))
    return graph.all_shortest_paths(_act_network(s, d), *_ends(s, d), most=5, interior=old).select(F.array_join("path", " > ").alias("path"), "hops")


def _graph(s, d):
    """The graph of the raw acts; of records fetched again the last one holds."""
    raw = table(s, d, "raw_acts")
    fetched = F.concat_ws("#", F.lpad(F.coalesce(F.unix_micros("fetched_at"), F.lit(0)).cast("string"), 20, "0"), F.lpad(F.col("raw_id").cast("string"), 20, "0"))
    return shred.shred(documents_from_text(raw.withColumn("_fetched", fetched), "doc_json", mend=True, version="_fetched"))


def shredded_nodes(s, d):
    return _graph(s, d).all_nodes()


def shredded_edges(s, d):
    return _graph(s, d).edges


def schema_graph(s, d):
    g = _graph(s, d)
    return graph.schema_triples(g.all_nodes(), g.edges)


def schedules_with_citations(s, d):
    """Schedules of acts with their paragraphs and, where there are any, the commentaries on these, the citations in them and the
    sub-references of those; every combination is a row, as optional matches give it."""
    e = cut_lineage(_graph(s, d).edges)
    step = lambda kind, a, b: e.where(F.col("type") == kind).select(F.col("src").alias(a), F.col("dst").alias(b))
    own = step("HAS_SCHEDULE", "act", "schedule").join(step("HAS_PARAGRAPH", "schedule", "paragraph"), "schedule")
    for kind, a, b in (("HAS_COMMENTARY", "paragraph", "commentary"), ("HAS_CITATION", "commentary", "citation"), ("HAS_SUBREF", "citation", "subref")):
        own = own.join(step(kind, a, b), a, "left")
    return own.select("act", "schedule", "paragraph", "commentary", "citation", "subref")


def unique_nodes(s, d):
    """Nodes per label, and how many of them share their key: none, for all thirteen labels."""
    keys = _graph(s, d).all_nodes().groupBy("label", "id").agg(F.count(F.lit(1)).alias("n"))
    found = keys.groupBy("label").agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("n") > 1).alias("n_shared"))
    labels = s.createDataFrame([(label,) for label in LABELS], "label string")
    return labels.join(found, "label", "left").na.fill(0)


def linked_to_weights(s, d):
    """Links between acts by the number of paths through the shredded records."""
    g = _graph(s, d)
    return graph.trail_counts(g.edges, g.nodes["Legislation"].select("id"), list(CITING), list(TO_CITATION), 10)


def upserted_acts(s, d):
    return model.acts(s, d, "row_id", "title", "status", "modified_date").select("uri", "row_id", "title", "status", "modified_date")


def duplicate_acts(s, d):
    return graph.duplicate_keys(table(s, d, "legislation").select(canonical_uri("uri").alias("uri")), "uri")


def upserted_edges(s, d):
    c = table(s, d, "citation").select(canonical_uri("legis_uri").alias("src"), canonical_uri("uri").alias("dst"), F.lit("CITES").alias("type"))
    return graph.upsert_edges(c)


def union_missing_columns(s, d):
    a = table(s, d, "section").select("row_id", "id", "title", "status")
    return a.unionByName(table(s, d, "paragraph").select("row_id", "id", "status", "par_number"), allowMissingColumns=True)


def subref_parents(s, d):
    """Notes citations as sub-references of the act's commentary citation of the same local number, where there is one."""
    c = model.citations(s, d)
    local = F.regexp_replace(F.element_at(F.split("id", "#"), -1), "^en", "")
    subs = c.where(F.col("origin") == "notes").select("id", F.col("legis_uri").alias("comment"), F.concat("legis_uri", F.lit("#c"), F.right(local, F.lit(6))).alias("citation"))
    return shred.subref_parents(subs, c.where(F.col("origin") == "commentary").select("id"), model.acts(s, d).select(F.col("uri").alias("id")))


def crawled_acts(s, d, uri=None):
    """Acts reached from all acts, or those whose uri contains a text, over pages made from the tables, wave by wave."""
    seeds = model.act_ids(s, d).where(_under("uri", uri)).select(F.col("uri").alias("url"), F.lit(0).alias("depth"))
    out = crawl(seeds, model.pages(s, d))
    return out.select("url", "depth", "wave", F.col("document.identifier.title").alias("title"), F.size("links").alias("n_links"), F.col("error").isNotNull().alias("failed"))


def frontier_wave(s, d):
    found = table(s, d, "citation").select(F.col("uri").alias("url"), F.year("recorded_at").alias("depth"))
    return next_wave(found, model.acts(s, d).where(F.year("enactment_date") > 1990).select(fetch_url("uri").alias("url")))


def _parsed(s, d):
    return cut_lineage(parse_pages(model.pages(s, d).withColumn("depth", F.lit(0))))


def parsed_sections(s, d):
    """Sections as the XML parser reads them from the pages, with the part and chapter they stand in."""
    part = _parsed(s, d).select("url", F.explode("document.parts").alias("p")).select("url", "p.part_number", F.explode("p.chapters").alias("c"))
    sec = part.select("url", "part_number", F.col("c.uri").alias("chapter_id"), F.explode("c.sections").alias("x"))
    return sec.select("url", "part_number", "chapter_id", F.col("x.uri").alias("section_id"), F.col("x.restrict_start_date").alias("start_date"), F.size("x.paragraphs").alias("n_paragraphs"), F.size("x.commentaries").alias("n_commentaries"))


def parsed_paragraphs(s, d):
    """Paragraphs of sections and subparagraphs of schedules as the XML parser reads them."""
    doc = _parsed(s, d)
    par = doc.select("url", F.explode(F.flatten(F.flatten(F.transform("document.parts", lambda p: F.transform(p["chapters"], lambda c: c["sections"]))))).alias("x"))
    par = par.select("url", F.lit("section").alias("held_by"), F.col("x.uri").alias("holder"), F.explode("x.paragraphs").alias("p"))
    sub = doc.select("url", F.explode(F.flatten(F.transform("document.schedules", lambda x: x["paragraphs"]))).alias("x"))
    sub = sub.select("url", F.lit("schedule").alias("held_by"), F.col("x.uri").alias("holder"), F.explode("x.subparagraphs").alias("p"))
    short = lambda df: df.select("url", "held_by", "holder", F.col("p.uri").alias("paragraph_id"), F.regexp_replace(F.coalesce("p.text", F.lit("")), r"\s+", "").alias("letters"))
    return short(par).unionByName(short(sub)).withColumn("letters", F.md5("letters"))


def parsed_acts(s, d):
    """The head of every parsed page, and how many parts, schedule paragraphs and notes it holds."""
    doc = F.col("document")
    count = lambda c: F.coalesce(F.greatest(F.size(c), F.lit(0)), F.lit(0))
    return _parsed(s, d).select(
        "url", doc["super"]["supersedes"].alias("supersedes"), doc["metadata"]["enactment_date"].alias("enactment_date"), doc["metadata"]["year"].alias("year"), count(doc["parts"]).alias("n_parts"),
        count(F.flatten(F.transform(doc["schedules"], lambda x: x["paragraphs"]))).alias("n_schedule_paragraphs"), count(doc["explanatory_notes"]["paragraphs"]).alias("n_notes"), F.size("links").alias("n_links"),
    )


def page_elements(s, d):
    return page_schema(model.pages(s, d))


def _query(s, d):
    v = table(s, d, "text_node")
    return search.vector_hits(v.where(F.size("text_embedding") == 128), "node_id", "text_embedding", model.query_vector(v, "vec_id", "text_embedding", 128), 100)


def vector_hits(s, d):
    e = table(s, d, "embeddings")
    hits = search.vector_hits(e, "vec_id", "embedding", model.query_vector(e, "vec_id", "embedding", 64), 25)
    return hits.select(F.col("node_id").alias("vec_id"), F.round("score", 5).alias("score"))


def best_per_label(s, d):
    """The best score of the hits of each label."""
    e = table(s, d, "embeddings")
    q = model.query_vector(e, "vec_id", "embedding", 64)
    return e.groupBy("label").agg(F.round(F.max(T.cosine_to(F.col("embedding").cast("array<double>"), q)), 5).alias("best"), F.count(F.lit(1)).alias("n"))


def acts_by_vector(s, d):
    return search.find_acts_by_vector(_query(s, d), model.context(s, d), model.acts(s, d, "title", "enactment_date")).withColumn("vector_score", F.round("vector_score", 5))


def best_acts_by_vector(s, d):
    return search.vector_acts(_query(s, d), model.context(s, d), model.acts(s, d, "title", "enactment_date"), 150).select("uri", "title", "enactment_date", F.round("vector_score", 5).alias("vector_score"))


def act_summary(s, d):
    return search.act_summary(_query(s, d), model.context(s, d), model.acts(s, d, "title")).withColumn("vector_score", F.round("vector_score", 5))


def hit_context(s, d):
    a = model.acts(s, d, "title", "category", "status", "enactment_date")
    return search.hit_context(_query(s, d), model.context(s, d), a).withColumn("score", F.round("score", 5))


def citation_reasoning(s, d):
    hit = search.vector_acts(_query(s, d), model.context(s, d), model.acts(s, d, "title", "enactment_date"), 150)
    return search.citing(hit, model.links(s, d), model.acts(s, d))


def title_candidates(s, d):
    return search.title_candidates(model.acts(s, d, "title", "enactment_date"), TITLE).select("uri", "title", "enactment_date")


def title_scores(s, d):
    return search.rank_titles(search.title_candidates(model.acts(s, d, "title", "enactment_date"), TITLE), TITLE, 25).select("uri", "title", "lexical_score")


def title_score_terms(s, d):
    """The scores of ``title_scores`` without the similarity ratio, which SQL can't express."""
    found = search.title_candidates(model.acts(s, d, "title", "enactment_date"), TITLE)
    return search.rank_titles(found, TITLE, 25, with_ratio=False).select("uri", "title", "lexical_score")


def resolved_titles(s, d):
    return search.resolve_title(model.acts(s, d, "title", "enactment_date"), TITLE).select("uri", "title", "lexical_score", "match_method")


def hybrid_acts(s, d):
    return search.find_acts(model.acts(s, d, "title", "enactment_date"), _query(s, d), model.context(s, d), TITLE).withColumn("vector_score", F.round("vector_score", 5))


def acts_by_uri(s, d):
    return search.acts_by_uri(model.acts(s, d, "title", "enactment_date"), "/xpga/").select("uri", "title", "enactment_date")


def uri_missing(s, d):
    """What is answered to a question by uri that names none."""
    return search.acts_by_uri(model.acts(s, d, "title", "enactment_date"), " ")


def citation_counts(s, d):
    """Degrees of the acts whose uri contains a text."""
    out = search.citation_counts(model.acts(s, d, "title", "enactment_date"), model.links(s, d), uri="/xpga/19", limit=20)
    return out.withColumns({c: F.array_join(c, "; ") for c in ("top_outgoing_titles", "top_incoming_titles")})


def _embedded(s, d):
    """Paragraphs in their last version, of which those with an even number already have a vector."""
    own = model.paragraphs(s, d, "row_id", "text")
    ready = F.when(F.col("row_id") % 2 == 0, F.array([F.lit(0.2).cast("float")] * 25 + [F.lit(0.0).cast("float")]))
    return embed.embed_missing(own.withColumn("embedding", ready), embed.letter_encoder)


def embedded_nodes(s, d):
    return _embedded(s, d).select("id", "is_text", F.round(F.try_element_at("embedding", F.lit(1)), 4).alias("a"), F.round(F.try_element_at("embedding", F.lit(5)), 4).alias("e"))


def semantic_hits(s, d):
    """The paragraphs nearest to a question, by the vectors of an encoder."""
    return embed.text_hits(_embedded(s, d).where("row_id % 2 = 1"), embed.letter_encoder, "pension scheme of the registrar", 20).select("node_id", F.round("score", 5).alias("score"))


def blank_question(s, d):
    return embed.text_hits(_embedded(s, d), embed.letter_encoder, "  ", 20)


def upsert_counts(s, d):
    """Acts delivered from 2015 on, against those delivered before."""
    raw = table(s, d, "legislation").select(canonical_uri("uri").alias("uri"), (F.col("loaded_at") < F.lit("2015-01-01").cast("timestamp")).alias("early"))
    return graph.upsert_report(raw.where("early"), raw.where("NOT early"), "uri")


def merged_tools(s, d):
    """Tool maps of the odd events, overridden by their own entries."""
    own = F.create_map(F.lit("k"), F.col("event_type"), F.lit("n"), F.col("user_id").cast("string"))
    more = F.when(F.col("event_id") % 2 == 1, F.create_map(F.lit("k"), F.lit("later"), F.lit("m"), F.lit("new")))
    merged = T.merged_maps(own, more)
    return table(s, d, "events").select("event_id", *(F.try_element_at(merged, F.lit(k)).alias(k) for k in ("k", "n", "m")))


def resolved_paths(s, d):
    return search.resolve_path(model.context(s, d), model.acts(s, d), uri="/section/1/")


def grounded_evidence(s, d):
    e = table(s, d, "documents").select(F.col("legis_uri").alias("uri"), F.col("node_label").alias("node_id"), F.col("source").alias("title"), F.col("n_chars").cast("double").alias("score"), "doc_id")
    return search.ground(e, "doc_id").select("uri", "node_id", "title", "score", "doc_id")


def url_forms(s, d):
    u = F.col("uri")
    return table(s, d, "citation").select("row_id", fetch_url(u).alias("fetch"), plain_url(u).alias("plain"), file_name(u, "acts.example/").alias("file"), act_of_section_uri(F.concat(u, F.lit("/section/5"))).alias("act"))


def text_forms(s, d):
    t = F.col("title")
    return table(s, d, "legislation").select(
        "row_id", T.normalise(t).alias("normal"), T.year_in(t).alias("year"), F.array_join(T.tokens(T.normalise(t)), "|").alias("words"),
        T.combined_text(t, "description", F.lit(None).cast("string")).alias("combined"), T.preview("description", 60).alias("preview"), F.round(T.overlap(T.tokens(T.normalise(t)), T.tokens(F.lit("pensions order 1960"))), 6).alias("shared"),
    )


def payloads(s, d):
    """Tool payloads: the JSON of events, their type as plain text, and blanks."""
    p = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).when(F.col("event_id") % 7 == 0, F.lit("  ")).otherwise(F.col("props"))
    got = T.payload(p)
    return table(s, d, "events").select("event_id", F.element_at(got, "k").alias("k"), F.element_at(got, "q").alias("q"), F.size(got).alias("n"))


def write_guard(s, d):
    """Statements made of document words: which would write, and how alternatives are mended."""
    w = F.element_at(F.array(*(F.lit(x) for x in ("MATCH (n) RETURN n", "match (n) SET n.x = 1", "CREATED by [:A|:B]", "drop index x", "RETURN offset"))), (F.col("event_id") % 5 + 1).cast("int"))
    return table(s, d, "events").select("event_id", T.is_write(w).alias("writes"), T.plain_alternation(F.concat(w, F.lit(" -[:A|:B]-> "))).alias("mended"))


def json_in_text(s, d):
    t = F.concat(F.lit("answer: "), F.col("props"), F.lit(" done"))
    return table(s, d, "events").select("event_id", T.json_inside(t).alias("found"), T.int_or(F.when(F.col("event_id") % 2 == 0, F.col("user_id").cast("string")).otherwise(" "), 5).alias("number"))


def trimmed_history(s, d):
    """The last 20 events of each user as chat messages."""
    role = F.when(F.col("event_type").isin("click", "view"), "user").when(F.col("event_type") == "purchase", "assistant").otherwise("system")
    m = table(s, d, "events").select(F.col("user_id").alias("conv_id"), F.col("event_id").alias("turn"), role.alias("role"), F.when(F.col("event_id") % 11 == 0, " ").otherwise(F.col("props")).alias("text"))
    return catalog.trim_history(m, "conv_id", "turn", "role", "text")


def tool_durations(s, d):
    """Views and clicks of each user paired as starts and ends."""
    return catalog.tool_durations(table(s, d, "events"), ["user_id"], "event_type", "ts", "view", "click", "event_id").select("user_id", "n", "seconds")


def read_only_sql(s, d):
    catalog.register({"lexweave_acts": model.acts(s, d)})
    return catalog.read_only(s, "SELECT category, count(*) AS n FROM lexweave_acts WHERE title LIKE :t GROUP BY category", {"t": "%Act%"})


_QUERIES = (
    linked_to_star, citation_weights, citation_table, linked_network, citation_degrees, hierarchy_paths, one_part, citing_upward, notes_with_citations, supersede_network, supersedes_chain,
    superseded_chain, as_of_snapshot, visible_after, altered_ids, point_in_time, temporal_diff, temporal_diff_all, change_counts, amendment_timeline, yearly_enactments, dashboard_metrics,
    acts_per_category, corpus_table, topic_network, act_full_text, descendants, shortest_path, shortest_paths_through_old_acts, shredded_nodes, shredded_edges, schema_graph, linked_to_weights,
    upserted_acts, duplicate_acts, upserted_edges, union_missing_columns, subref_parents, crawled_acts, frontier_wave, page_elements, parsed_sections, parsed_paragraphs, parsed_acts, schedules_with_citations, unique_nodes, title_score_terms, uri_missing, citation_counts, embedded_nodes, semantic_hits, blank_question, upsert_counts, merged_tools, vector_hits, best_per_label, acts_by_vector,
    best_acts_by_vector, act_summary, hit_context, citation_reasoning, title_candidates, title_scores, resolved_titles, hybrid_acts, acts_by_uri, resolved_paths, grounded_evidence, url_forms,
    text_forms, payloads, write_guard, json_in_text, trimmed_history, tool_durations, read_only_sql,
)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    from . import gallery_sql, shred_sql

    return gallery_sql.SQL | shred_sql.SQL
