"""Lexical, vector and hybrid retrieval over acts and their texts.

``acts`` has ``uri, title`` and dates; ``hits`` has ``node_id, score``; ``context`` has one row per text node with its ancestors
(``node_id, legis_uri`` and so on). Wherever rows are cut to a number, their order is total: ties go to the least uri or id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .graph import degree_counts


def bounded(value: int, least: int, most: int) -> int:
    """The value, or an error if it lies outside."""
    if not least <= value <= most:
        raise ValueError(f"{value} is not within {least} and {most}")
    return value


def vector_hits(vectors: DataFrame, node: str, vec: str, query: list[float], k: int = 10) -> DataFrame:
    """The ``k`` nodes most similar to a query vector: ``node_id, score`` (cosine). Nodes whose vector is null, has null entries or
    another length, or is all zero have no score and are no hits. One pass; only each task's best ``k`` rows move."""
    bounded(k, 1, 100)
    scored = vectors.select(F.col(node).alias("node_id"), T.cosine_to(F.col(vec).cast("array<double>"), [float(x) for x in query]).alias("score"))
    return scored.where(F.col("score").isNotNull() & ~F.isnan("score")).orderBy(F.desc("score"), "node_id").limit(k)


def title_candidates(acts: DataFrame, query: str) -> DataFrame:
    """All acts whose title or uri contains the normalised query, or any of its words of three letters or more. A query without a letter
    or digit finds nothing. Nothing is cut here: a common word makes every act a candidate, and only ``rank_titles`` knows the best."""
    q = T.normalise(F.lit(query))
    lt, lu = F.lower(F.coalesce(F.col("title"), F.lit(""))), F.lower(F.coalesce(F.col("uri"), F.lit("")))
    some = F.exists(T.tokens(q), lambda t: (t != "") & (lt.contains(t) | lu.contains(t)))
    return acts.where((q != "") & (lt.contains(q) | lu.contains(q) | some))


def newest(day: str = "enactment_date") -> Column:
    """Latest first; acts without a day last."""
    return F.coalesce(F.col(day).cast("date"), F.lit("0001-01-01").cast("date")).desc()


def rank_titles(candidates: DataFrame, query: str, limit: int = 25, with_ratio: bool = True) -> DataFrame:
    """Candidates with ``lexical_score``, best first, later enactment before earlier."""
    scored = candidates.withColumn("lexical_score", T.lexical_score(F.lit(query), F.col("title"), F.col("uri"), with_ratio))
    return scored.orderBy(F.desc("lexical_score"), newest(), "uri").limit(limit)


def resolve_title(acts: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """The acts whose titles fit a query best, out of all candidates."""
    ranked = rank_titles(title_candidates(acts, query), query, bounded(limit, 1, 50))
    return ranked.withColumn("match_method", F.lit("title_resolver"))


def acts_of_hits(hits: DataFrame, context: DataFrame, acts: DataFrame) -> DataFrame:
    """Hits with the act they belong to (``node_id, score, uri, title`` and the act's other columns). Hits that belong to none go."""
    return hits.join(context.select("node_id", F.col("legis_uri").alias("uri")), "node_id").join(acts, "uri")


def vector_acts(hits: DataFrame, context: DataFrame, acts: DataFrame, limit: int = 150) -> DataFrame:
    """Acts with the best score among their hits, ``vector_score``; best first, acts without enactment date before others."""
    best = hits.join(context.select("node_id", F.col("legis_uri").alias("uri")), "node_id").groupBy("uri").agg(F.max("score").alias("vector_score"))
    return acts.join(best, "uri").orderBy(F.desc("vector_score"), F.desc_nulls_first("enactment_date"), "uri").limit(limit)


def fuse(titles: DataFrame, vectors: DataFrame, query: str, limit: int = 25) -> DataFrame:
    """Title matches (``uri, title, enactment_date, lexical_score``) and vector matches (``…, vector_score``) as one ranking.

    Joined on the lower-case trimmed uri; each score is divided by the best of its kind (0 if that isn't positive), weighted and added, with
    a bonus if the query's year stands in the title. ``match_method`` says which side found the act.
    """
    key = F.lower(F.trim(F.coalesce(F.col("uri"), F.lit(""))))
    side = lambda df, score, p: df.select(key.alias("key"), F.col("uri").alias(f"{p}_uri"), F.col("title").alias(f"{p}_title"), F.col("enactment_date").alias(f"{p}_date"), F.col(score).cast("double")).where(F.col("key") != "")
    both = side(titles, "lexical_score", "l").join(side(vectors, "vector_score", "v"), "key", "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    merged = both.select(
        F.coalesce("l_uri", "v_uri").alias("uri"), F.coalesce("l_title", "v_title").alias("title"), F.coalesce("l_date", "v_date").alias("enactment_date"),
        zero("lexical_score").alias("lexical_score"), zero("vector_score").alias("vector_score"),
    )
    everything = W.partitionBy(F.lit(1))  # at most the two cut lists
    normed = lambda c: F.when(F.max(c).over(everything) > 0, F.col(c) / F.max(c).over(everything)).otherwise(0.0)
    bonus = F.when(T.normalise("title").contains(T.year_in(F.lit(query)).cast("string")), T.YEAR_BONUS).otherwise(0.0)
    score = F.round(T.LEXICAL * normed("lexical_score") + T.VECTOR * normed("vector_score") + bonus, 6)
    method = F.when((F.col("lexical_score") > 0) & (F.col("vector_score") > 0), "hybrid_title_vector").when(F.col("lexical_score") > 0, "title_only").otherwise("vector_only")
    return merged.select("*", score.alias("hybrid_score"), method.alias("match_method")).orderBy(F.desc("hybrid_score"), newest(), "uri").limit(limit)


def find_acts(acts: DataFrame, hits: DataFrame, context: DataFrame, query: str, limit: int = 25) -> DataFrame:
    """Hybrid lookup: the best 150 of all title candidates with the best 150 acts of the vector hits."""
    titles = rank_titles(title_candidates(acts, query), query, 150)
    return fuse(titles, vector_acts(hits, context, acts, 150), query, bounded(limit, 1, 100))


def find_acts_by_vector(hits: DataFrame, context: DataFrame, acts: DataFrame, limit: int = 25) -> DataFrame:
    """Distinct (act, score) rows of the hits, best first, acts without enactment date before others."""
    rows = acts_of_hits(hits, context, acts).select("uri", "title", "enactment_date", F.col("score").alias("vector_score")).distinct()
    return rows.orderBy(F.desc("vector_score"), F.desc_nulls_first("enactment_date"), "uri").limit(limit)


def act_summary(hits: DataFrame, context: DataFrame, acts: DataFrame, limit: int = 5) -> DataFrame:
    """The best hit acts with how many parts, chapters, sections and paragraphs they have.

    ``context`` lists all text nodes of all acts; it is cut to the acts hit before anything is counted.
    """
    best = hits.join(context.select("node_id", F.col("legis_uri").alias("uri")), "node_id").groupBy("uri").agg(F.max("score").alias("vector_score"))
    levels = {f"{n}_count": f"{n}_id" for n in ("part", "chapter", "section", "paragraph")}
    counts = context.join(best.select(F.col("uri").alias("legis_uri")), "legis_uri", "left_semi").groupBy(F.col("legis_uri").alias("uri")).agg(*(F.count_distinct(c).alias(a) for a, c in levels.items()))
    out = acts.select("uri", "title").join(best, "uri").join(counts, "uri")
    return out.orderBy(F.desc("vector_score"), F.desc("paragraph_count"), "uri").limit(limit)


def hit_context(hits: DataFrame, context: DataFrame, acts: DataFrame, limit: int = 15) -> DataFrame:
    """Hits with all their ancestors and the act's own columns (``legislation_…``), best first. Hits outside any act go."""
    own = acts.select(F.col("uri").alias("legis_uri"), *(F.col(c).alias(f"legislation_{c}") for c in acts.columns if c != "uri"))
    return hits.join(context, "node_id").join(own, "legis_uri").distinct().orderBy(F.desc("score"), "node_id").limit(bounded(limit, 1, 100))


def citing(acts_hit: DataFrame, links: DataFrame, acts: DataFrame, limit: int = 20) -> DataFrame:
    """Acts with the acts they link to (``links``: ``src, dst``); acts without links stay, with null targets."""
    named = acts.select(F.col("uri").alias("cited_uri"), F.col("title").alias("cited_title"))
    out = acts_hit.select("uri", "title").distinct().join(links.select(F.col("src").alias("uri"), F.col("dst").alias("cited_uri")), "uri", "left").join(named, "cited_uri", "left")
    return out.select("uri", "title", "cited_uri", "cited_title").orderBy("uri", F.asc_nulls_last("cited_uri")).limit(limit)


def supersede_step(acts: DataFrame, edges: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """Acts whose title or uri contains a text, case ignored, each with the acts one step along ``edges`` (``src, dst``), if any."""
    chosen = acts.where(T.contains_folded(F.col("title"), query) | T.contains_folded(F.col("uri"), query)).select("uri", "title")
    named = acts.select(F.col("uri").alias("next_uri"), F.col("title").alias("next_title"))
    out = chosen.join(edges.select(F.col("src").alias("uri"), F.col("dst").alias("next_uri")), "uri", "left").join(named, "next_uri", "left")
    return out.select("uri", "title", "next_uri", "next_title").orderBy("uri", F.asc_nulls_last("next_uri")).limit(limit)


def missing_input(spark: SparkSession, what: str) -> DataFrame:
    """The answer to a question that lacks its input: one row, ``error``."""
    return spark.createDataFrame([(f"{what} is required",)], "error string")


def acts_by_uri(acts: DataFrame, uri: str | None, limit: int = 5) -> DataFrame:
    """Acts whose uri is, or contains, a text taken literally; newest first, acts without enactment date before others. Without a text, the
    answer is an error row."""
    if not (uri or "").strip():
        return missing_input(acts.sparkSession, "uri")
    return acts.where((F.col("uri") == uri) | F.col("uri").contains(uri)).orderBy(F.desc_nulls_first("enactment_date"), "uri").limit(limit)


def citation_counts(acts: DataFrame, links: DataFrame, q: str | None = None, uri: str | None = None, limit: int = 10) -> DataFrame:
    """Degrees of the acts that a uri names (exactly, or as a part of theirs) or, without one, whose titles fit a query best; see
    ``degree_counts``. Only the links of these acts are counted. Without uri and query, the answer is an error row."""
    if (uri or "").strip():
        chosen = acts.where((F.col("uri") == uri) | F.col("uri").contains(uri)).orderBy("uri").limit(limit)
    elif (q or "").strip():
        chosen = rank_titles(title_candidates(acts, q), q, limit)
    else:
        return missing_input(acts.sparkSession, "q or uri")
    own = chosen.select("uri")  # at most ``limit`` rows
    near = links.join(F.broadcast(own.withColumnRenamed("uri", "src")), "src", "left_semi").unionByName(links.join(F.broadcast(own.withColumnRenamed("uri", "dst")), "dst", "left_semi").select(*links.columns))
    return degree_counts(acts, near).join(F.broadcast(own), "uri", "left_semi")


def resolve_path(context: DataFrame, acts: DataFrame, node_id: str | None = None, uri: str | None = None, limit: int = 10) -> DataFrame:
    """A node, by id or by (part of) its uri, with its ancestors. Nodes outside any act stay, with null ancestors. Without id and uri, the
    answer is an error row."""
    if not node_id and not uri:
        return missing_input(acts.sparkSession, "node_id or uri")
    chosen = context.where(F.col("node_id") == node_id) if node_id else context.where((F.col("node_id") == uri) | F.col("node_id").contains(uri))
    named = acts.select(F.col("uri").alias("legis_uri"), F.col("title").alias("legislation_title"))
    return chosen.join(named, "legis_uri", "left").orderBy("node_id").limit(limit)


def ground(evidence: DataFrame, order: str, fallback: DataFrame | None = None, k: int = 8) -> DataFrame:
    """Evidence rows once per (uri, node_id, title), the first by ``order``; ``fallback`` rows, at most ``k``, where there is none."""
    first = lambda df: df.groupBy("uri", "node_id", "title").agg(F.min_by("score", order).alias("score"), F.min(order).alias(order))
    own = first(evidence)
    if fallback is None:
        return own
    spare = first(fallback).orderBy(order).limit(min(k, 8))
    nothing = own.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0)
    return own.unionByName(spare.join(F.broadcast(nothing), how="cross").drop("n"))
