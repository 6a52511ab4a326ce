"""Following links from act to act, wave by wave, over a table of stored pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import fetch_url
from ..session import cut_lineage
from ..sources.act_xml import parse_pages


def next_wave(found: DataFrame, visited: DataFrame) -> DataFrame:
    """The links of a wave (``url, depth``) that are to be fetched: normalised, each once at its least depth, without those in
    ``visited`` (``url``). Null and empty links are dropped."""
    links = found.select(fetch_url("url").alias("url"), "depth").where(F.col("url").isNotNull())
    return links.groupBy("url").agg(F.min("depth").alias("depth")).join(visited, "url", "left_anti")


def crawl(seeds: DataFrame, pages: DataFrame, max_depth: int = 2) -> DataFrame:
    """All acts reached from the seeds (``url, depth``): ``url, depth, wave, document, links, error``.

    ``pages`` has ``url, body``, and ``fetched_at`` if a page may be there in several versions: the last one holds (without it, the greatest).
    They are brought to one page per URL once, written sorted by URL, and every wave reads from there. Each wave parses what is there
    for its links and takes up the links found. A link counts as visited when it is first taken up, whether or not there is a page for it
    (then ``error`` says so); it isn't tried again. Waves end when no new link is left; every wave is written to the shared folder, so
    none is computed twice.
    """
    spark = seeds.sparkSession
    version = F.struct(F.col("fetched_at"), F.col("body")) if "fetched_at" in pages.columns else F.col("body")
    at = pages.select(fetch_url("url").alias("url"), "body", version.alias("version")).where(F.col("url").isNotNull())
    stored = cut_lineage(at.groupBy("url").agg(F.max_by("body", "version").alias("body")).sortWithinPartitions("url"))
    found, waves = seeds.select("url", "depth"), []
    while True:
        visited = reduce(DataFrame.unionByName, (w.select("url") for w in waves)) if waves else spark.createDataFrame([], "url string")
        wave = next_wave(found, visited)
        done = cut_lineage(parse_pages(wave.join(stored, "url", "left"), max_depth).withColumn("wave", F.lit(len(waves))))
        if done.isEmpty():
            break
        waves.append(done)
        found = done.select(F.inline("links"))
    columns = ["url", "depth", "wave", "document", "links", "error"]
    if not waves:
        empty = parse_pages(spark.createDataFrame([], "url string, depth int, body string")).withColumn("wave", F.lit(0))
        return empty.select(*columns)
    return reduce(DataFrame.unionByName, waves).select(*columns)
