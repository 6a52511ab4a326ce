"""Embedding, retrieval, fetching, layouts, shared folder and small operators on odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexweave import session
from lexweave.functions.text import cosine_to, merged_maps, year_in
from lexweave.operators import embed, graph, search
from lexweave.sources.fetch import choose_fetcher, fetch_many, fetch_pages, read_cache
from lexweave.sources.layout import layout_of, missing_layouts, write_graph, write_layout


def test_only_missing_vectors_are_made(spark):
    calls = spark.sparkContext.accumulator(0)

    def encoder(texts):
        calls.add(len(texts))
        return embed.letter_encoder(texts)

    rows = [(1, "Aa", None, None, [1.0]), (2, "abc", "d", "x", None), (3, None, None, None, None), (4, " ", "", None, []), (None, None, None, "zz", None), (2, "abc", "d", "x", None)]
    nodes = spark.createDataFrame(rows, "id long, title string, description string, _other string, embedding array<float>")
    out = embed.embed_missing(nodes, encoder, text=("title", "description", "_other"), batch=2)
    got = {r["id"]: r for r in out.collect()}
    assert calls.value == 3 and out.columns == ["id", "title", "description", "_other", "embedding", "is_text"] and out.count() == 6
    assert got[1]["embedding"] == [1.0] and [got[i]["is_text"] for i in (1, 2, 3, 4)] == [True, True, False, False]
    assert np.linalg.norm(got[2]["embedding"]) == pytest.approx(1) and got[None]["embedding"][25] == pytest.approx(1)
    assert embed.embedded_count(out) == 4
    assert embed.embed_missing(nodes.limit(0), encoder).count() == 0


def test_retrieval_by_text(spark):
    nodes = embed.embed_missing(spark.createDataFrame([(1, "aaab"), (2, "bbba"), (3, None), (4, "zz")], "id long, text string"), embed.letter_encoder)
    assert [r["node_id"] for r in embed.text_hits(nodes, embed.letter_encoder, "aab", 2).collect()] == [1, 2]
    assert embed.text_hits(nodes, embed.letter_encoder, "  ").count() == 0 and embed.text_hits(nodes, embed.letter_encoder, None).count() == 0
    assert [(r["node_id"], r["content"]) for r in embed.retrieve(nodes, embed.letter_encoder, "zzz", 1).collect()] == [(4, "zz")]


def test_pages_are_fetched_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def fetcher(url):
        calls.add(1)
        if "bad" in url:
            raise OSError("no answer")
        return None if "none" in url else f"<a>{url}</a>".encode()

    urls = spark.createDataFrame([("http://x/a",), ("http://x/id/a/",), ("http://x/bad",), ("http://x/none",), (None,), ("",)], "url string")
    got = {r["url"]: (r["body"], r["error"]) for r in fetch_many(urls, fetcher).collect()}
    assert got["http://x/a/data.xml"] == ("<a>http://x/a/data.xml</a>", None) and got["http://x/bad/data.xml"][1].startswith("OSError") and got["http://x/none/data.xml"] == (None, "no body")
    cache, before = str(tmp_path / "cache"), calls.value
    assert read_cache(spark, cache).count() == 0
    assert {r["url"] for r in fetch_pages(urls, cache, fetcher).collect()} == {"http://x/a/data.xml"} and calls.value == before + 3
    assert {r["url"] for r in fetch_pages(urls, cache, fetcher).collect()} == {"http://x/a/data.xml"} and calls.value == before + 5  # failures again, the page not


def test_choice_of_fetcher():
    class Answer:
        content = b"x"

        def raise_for_status(self):
            pass

    class Session:
        def get(self, url, timeout):
            return Answer()

    own = lambda url: b"own"
    assert choose_fetcher(own, Session()) is own and choose_fetcher(None, Session())("u") == b"x" and choose_fetcher().__name__ == "http_fetcher"


def test_layouts(spark, tmp_path):
    df = spark.range(0, 4000).select(F.pmod(F.col("id") * 7919, F.lit(4000)).alias("order"), F.col("id").cast("string").alias("uri"))
    write_layout(df, str(tmp_path / "t"), ["order"], ["uri"], files=4)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4000
    ranges = sorted((int(r["least"]), int(r["greatest"])) for r in layout_of(spark, str(tmp_path / "t"), ["order"]))
    assert len(ranges) == 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    made = write_graph({"Part": df, "Legislation": df}, str(tmp_path / "g"))
    assert made == ["Legislation.uri: lookup", "Legislation.uri: range", "Part.order: range"] and "Section.uri: lookup" in missing_layouts(made)


def test_missing_input_and_counts(spark):
    acts = spark.createDataFrame([("u/1", "Mills Act", None), ("u/2", "Fees Act", None), ("u/3", None, None)], "uri string, title string, enactment_date date")
    links = spark.createDataFrame([("u/1", "u/2"), ("u/2", "u/1"), ("u/3", "u/2"), ("u/3", "u/2")], "src string, dst string")
    for answer in (search.acts_by_uri(acts, None), search.acts_by_uri(acts, " "), search.citation_counts(acts, links), search.resolve_path(acts, acts)):
        assert answer.columns == ["error"] and answer.count() == 1
    got = search.citation_counts(acts, links, uri="u/2").first()
    assert (got["outgoing_count"], got["incoming_count"], got["top_incoming_titles"]) == (1, 2, ["Mills Act"])
    assert {r["uri"] for r in search.citation_counts(acts, links, q="mills").collect()} == {"u/1"}
    report = graph.upsert_report(acts, spark.createDataFrame([("u/1",), ("u/9",), ("u/9",), (None,)], "uri string"), "uri").first()
    assert tuple(report) == (1, 1)


def test_small_functions(spark):
    df = spark.createDataFrame([("in 1599 and 1600", [3.0, 4.0]), ("12345 2101", [0.0, 0.0]), (None, None), ("x2000 2000", [1.0])], "t string, v array<double>")
    assert [r[0] for r in df.select(year_in("t")).collect()] == [1600, None, None, 2000]
    assert [r[0] for r in df.select(cosine_to(F.col("v"), [2.0, 0.0])).collect()] == [pytest.approx(0.6), None, None, None]
    a, b = F.create_map(F.lit("k"), F.lit("1"), F.lit("m"), F.lit("2")), F.create_map(F.lit("k"), F.lit("3"))
    assert df.select(merged_maps(a, b)).first()[0] == {"k": "3", "m": "2"} and df.select(merged_maps(F.lit(None).cast("map<string,string>"), b)).first()[0] == {"k": "3"}


def test_shared_folder(spark, monkeypatch):
    kept = session.cut_lineage(spark.range(5).withColumn("part", F.col("id") % 2), by=["part"])
    assert kept.columns == ["id", "part"] and kept.count() == 5
    session.clear_shared(spark)

    class Conf:
        def get(self, name, default=None):
            return None

    class Sc:
        master = "spark://somewhere:7077"

        class _jsc:
            @staticmethod
            def sc():
                class Jvm:
                    def getCheckpointDir(self):
                        class Nothing:
                            def isEmpty(self):
                                return True

                        return Nothing()

                return Jvm()

    class Cluster:
        conf, sparkContext = Conf(), Sc()

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_dir(Cluster())
