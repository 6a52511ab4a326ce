"""Paths, networks, temporal operators, text functions and retrieval on small fixtures."""

import itertools
import random
from datetime import date, datetime
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from lexweave.functions import text as T
from lexweave.operators import catalog, graph, search, temporal

EDGES = "src string, dst string, type string"


def paths_of(links, a, b, most, inner=None):
    near = {}
    for s, d in links:
        near.setdefault(s, set()).add(d)
        near.setdefault(d, set()).add(s)
    level = [[a]]
    for _ in range(most + 1):
        if done := [p for p in level if p[-1] == b]:
            return sorted(done)
        level = [[*p, n] for p in level for n in near.get(p[-1], ()) if n not in p and (n == b or inner is None or n in inner)]
    return []


@pytest.mark.parametrize("seed", range(2))
def test_all_shortest_paths(spark, seed):
    rng = random.Random(seed)
    links = [(f"n{rng.randint(0, 11)}", f"n{rng.randint(0, 11)}") for _ in range(16)] + [("x", "y"), (None, "n1")]
    df = spark.createDataFrame([(*e, "T") for e in links], EDGES)
    inner = {f"n{i}" for i in range(0, 12, 2)}
    ids = spark.createDataFrame([(i,) for i in inner], "id string")
    real = [e for e in links if None not in e]
    for a, b in (("n0", "n5"), ("n3", "x")):
        assert sorted(r["path"] for r in graph.all_shortest_paths(df, a, b, 6).collect()) == paths_of(real, a, b, 6)
        assert sorted(r["path"] for r in graph.all_shortest_paths(df, a, b, 6, ids).collect()) == paths_of(real, a, b, 6, inner)
    assert graph.shortest_path(df, "n0", "n0").first()["hops"] == 0


def test_interior_predicate_finds_the_shortest_satisfying_path(spark):
    df = spark.createDataFrame([("a", "bad", "T"), ("bad", "z", "T"), ("a", "b", "T"), ("b", "c", "T"), ("c", "z", "T"), ("p", "q", "T")], EDGES)
    good = spark.createDataFrame([("b",), ("c",)], "id string")
    assert [r["path"] for r in graph.all_shortest_paths(df, "a", "z", 5, good).collect()] == [["a", "b", "c", "z"]]
    assert graph.all_shortest_paths(df, "a", "z", 2, good).count() == 0
    assert graph.all_shortest_paths(df, "p", "q", 5, good).first()["hops"] == 1  # no inner node at all


def test_expand_and_networks(spark):
    df = spark.createDataFrame([("a", "b", "T"), ("b", "c", "T"), ("c", "a", "T"), ("a", "d", "U")], EDGES)
    start = spark.createDataFrame([("a",)], "id string")
    got = sorted((r["id"], r["depth"]) for r in graph.expand(df, start, ["T"], 0, 5).collect())
    assert got == [("a", 0), ("b", 1), ("c", 2)]
    assert graph.closed_network(df, spark.createDataFrame([("a",), ("b",)], "id string")).count() == 1
    assert graph.both_directions(df).count() == 8
    nodes = spark.createDataFrame([("a", "X"), ("b", "X"), ("c", "Y")], "id string, label string")
    assert graph.schema_triples(nodes, df).count() == 3


def test_upserts_are_idempotent(spark):
    rows = [("k", 1, "old", None), ("k", 2, "new", 5), ("k", 2, "new", 5), ("j", None, "only", 1), (None, 9, "x", 1)]
    df = spark.createDataFrame(rows, "id string, version int, title string, size int")
    once = graph.upsert_nodes(df, "id", ["version"])
    assert sorted(map(tuple, once.collect())) == [("j", None, "only", 1), ("k", 2, "new", 5)] and once.columns == df.columns
    assert sorted(map(tuple, graph.upsert_nodes(once.unionByName(df), "id", ["version"]).collect())) == sorted(map(tuple, once.collect()))
    assert [tuple(r) for r in graph.duplicate_keys(df, "id").collect()] == [("k", 3)]
    edges = spark.createDataFrame([("a", "b", "T", 1), ("a", "b", "T", 4), ("a", None, "T", 1)], "src string, dst string, type string, weight int")
    assert [tuple(r) for r in graph.upsert_edges(edges).collect()] == [("a", "T", "b", 4)]


def test_trails_through_a_diamond(spark):
    df = spark.createDataFrame([("r", "x", "P"), ("r", "y", "P"), ("x", "c", "P"), ("y", "c", "P"), ("c", "goal", "CITES"), ("c", "r", "CITES")], EDGES)
    roots = spark.createDataFrame([("r",)], "id string")
    assert [tuple(r) for r in graph.trail_counts(df, roots, ["CITES"], ["P"], 10).collect()] == [("r", "goal", 2)]
    assert graph.trail_counts(df, roots.limit(0), ["CITES"], ["P"], 10).count() == 0


def d(text):
    return date.fromisoformat(text) if text else None


def test_temporal_against_brute_force(spark):
    days = [None, "1999-12-31", "2000-01-01", "2000-01-02", "2005-06-01", "2010-01-01", "2010-01-02"]
    rows = [(i, d(a), d(b)) for i, (a, b) in enumerate(itertools.product(days, days))]
    df = spark.createDataFrame(rows, "id int, start_date date, end_date date")
    lo, hi = d("2000-01-01"), d("2010-01-01")

    def active(s, e, day):
        return (s is None or s <= day) and (e is None or e >= day)

    def change(s, e):
        a, b = active(s, e, lo), active(s, e, hi)
        inside = lambda x: x is not None and lo < x <= hi
        return "Added" if b and not a else "Removed" if a and not b else "Restricted" if inside(s) and inside(e) else None

    assert {r["id"] for r in temporal.as_of(df, "2000-01-01").collect()} == {i for i, s, e in rows if active(s, e, lo)}
    diff = temporal.temporal_diff(df, "2000-01-01", "2010-01-01")
    want = {i: change(s, e) for i, s, e in rows if change(s, e)}
    assert {r["id"]: r["change_type"] for r in diff.collect()} == want
    counts = temporal.change_counts(diff).first()
    assert counts["added"] == list(want.values()).count("Added") and counts["restricted"] == list(want.values()).count("Restricted") > 0
    line = temporal.amendment_timeline(diff).collect()
    assert {r["event"] for r in line} == {"Added", "Removed", "Restricted (start)", "Restricted (end)"}
    assert temporal.visible_after(df, "2010-01-02").count() == 14
    assert {r["id"] for r in temporal.starting_from(df, "2010-01-01").collect()} == {i for i, s, _ in rows if s is None or s >= hi}
    alt = temporal.altered(df, "2000-01-01", "2010-01-01").collect()
    assert {r["id"] for r in alt} == {i for i, s, e in rows if (e is None or e >= lo) and any(x is not None and lo < x <= hi for x in (s, e))}


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).cast("string").alias(k) for k, v in values.items())) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def test_text_functions(spark):
    assert one(spark, T.normalise(F.lit(" The Act, (No. 2)  1999! "))) == "the act no 2 1999"
    assert [one(spark, T.year_in(F.lit(t))) for t in ("in 1599 and 1600", "x1999", "no", "2100", "2101")] == [1600, None, None, 2100, None]
    assert one(spark, T.combined_text(F.lit(" a"), F.lit(None).cast("string"), F.lit("b \n"))) == "a\nb" and one(spark, T.combined_text(F.lit(""), F.lit(" "), F.lit("\n"))) is None
    assert [one(spark, T.is_write(F.lit(t))) for t in ("match (n) SeT n.x", "offset", "RETURN 'delete me'", "created")] == [True, False, True, False]
    assert one(spark, T.payload(F.lit('{"q": "x", "k": 3}'))) == {"q": "x", "k": "3"} and one(spark, T.payload(F.lit("plain"))) == {"q": "plain"} and one(spark, T.payload(F.lit(" "))) == {}
    assert [one(spark, T.json_inside(F.lit(t))) for t in ('so {"a": 1} it is', "see [1, 2].", "none")] == ['{"a": 1}', "[1, 2]", "none"]
    assert one(spark, T.plain_alternation(F.lit("[:A|:B]"))) == "[:A|B]" and one(spark, T.preview(F.lit("abcdef"), 3)) == "abc..." and one(spark, T.int_or(F.lit(" "), 7)) == 7
    assert one(spark, T.contains_any(F.lit("The 100% Act"), F.array(F.lit(""), F.lit("0%")))) and not one(spark, T.contains_any(F.lit("x"), F.array(F.lit(""))))
    assert one(spark, T.cosine(F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(4.0), F.lit(3.0)))) == pytest.approx(0.96)


def test_similarity_ratio(spark):
    pairs = [("pensions act", "pension acts"), ("", "x"), (None, None), ("a" * 300, "a" * 250 + "b")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert [r[0] for r in df.select(T.similarity_ratio("a", "b")).collect()] == pytest.approx([SequenceMatcher(None, a or "", b or "").ratio() for a, b in pairs])


ACTS = "uri string, title string, enactment_date date"


@pytest.fixture(scope="module")
def acts(spark):
    return spark.createDataFrame([("u/1", "Pensions Act 1962", d("1962-01-01")), ("u/2", "Mines Act 1962", None), ("u/pensions/3", None, d("1999-01-01")), ("u/4", "Rates 100%", d("1990-01-01"))], ACTS)


def test_title_search(spark, acts):
    ranked = search.resolve_title(acts, "Pensions Act 1962").collect()
    assert [r["uri"] for r in ranked] == ["u/1", "u/2", "u/pensions/3"] and ranked[0]["lexical_score"] == pytest.approx(1 + 0.6 + 0.35 + 0.55 + 0.35 + 0.25 + 0.1)
    assert search.title_candidates(acts, " ,").count() == 0 and search.acts_by_uri(acts, "%").count() == 0
    assert [r["uri"] for r in search.acts_by_uri(acts, "u/").collect()][:2] == ["u/2", "u/pensions/3"]
    with pytest.raises(ValueError):
        search.resolve_title(acts, "x", 51)


def test_every_title_candidate_is_scored(spark):
    """The best act has the greatest uri, behind more candidates than were once kept."""
    many = spark.range(400).selectExpr("concat('u/', lpad(id, 3, '0')) AS uri", "'Mines Act 1950' AS title", "DATE '1950-01-01' AS enactment_date")
    many = many.unionByName(spark.createDataFrame([("u/z", "Pensions Act 1962", d("1962-01-01"))], ACTS))
    none = spark.createDataFrame([], "node_id string, score double"), spark.createDataFrame([], "node_id string, legis_uri string")
    assert search.title_candidates(many, "Pensions Act 1962").count() == 401
    assert [r["uri"] for r in search.resolve_title(many, "Pensions Act 1962", 2).collect()] == ["u/z", "u/000"]
    assert search.rank_titles(search.title_candidates(many, "Pensions Act 1962"), "Pensions Act 1962", 1, with_ratio=False).first()["uri"] == "u/z"
    assert search.find_acts(many, *none, "Pensions Act 1962", 1).first()["uri"] == "u/z"


def test_hybrid_fusion(spark, acts):
    hits = spark.createDataFrame([("n1", 0.9), ("n2", 0.6), ("n3", 0.8), ("nowhere", 1.0)], "node_id string, score double")
    ctx = spark.createDataFrame([("n1", "u/4", "p", "c", "s", "g"), ("n2", "u/1", "p", "c", "s", "g"), ("n3", "u/1", "p2", None, "s2", "g2")], "node_id string, legis_uri string, part_id string, chapter_id string, section_id string, paragraph_id string")
    got = {r["uri"]: r for r in search.find_acts(acts, hits, ctx, "Pensions Act 1962").collect()}
    assert got["u/1"]["match_method"] == "hybrid_title_vector" and got["u/4"]["match_method"] == "vector_only" and got["u/2"]["match_method"] == "title_only"
    assert got["u/1"]["hybrid_score"] == pytest.approx(0.65 + 0.30 * 0.8 / 0.9 + 0.1, abs=1e-6) and got["u/4"]["hybrid_score"] == 0.3
    summary = search.act_summary(hits, ctx, acts).collect()
    assert [(r["uri"], r["part_count"], r["chapter_count"]) for r in summary] == [("u/4", 1, 1), ("u/1", 2, 1)]
    assert [r["node_id"] for r in search.hit_context(hits, ctx, acts).collect()] == ["n1", "n3", "n2"]
    assert search.resolve_path(ctx, acts).columns == ["error"]


def test_vector_hits_skip_unusable_vectors(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0]), ("c", None), ("d", [0.0, 0.0]), ("e", [1.0, None]), ("f", [1.0, 0.0, 0.0])], "id string, v array<double>")
    assert [(r["node_id"], round(r["score"], 4)) for r in search.vector_hits(df, "id", "v", [1.0, 0.0], 10).collect()] == [("a", 1.0), ("b", 0.7071)]


def test_evidence_falls_back(spark):
    rows = [("u", "n", "t", 0.5, 2), ("u", "n", "t", 0.9, 1), (None, None, None, 0.1, 3)]
    df = spark.createDataFrame(rows, "uri string, node_id string, title string, score double, at int")
    assert sorted(map(tuple, search.ground(df, "at", df).collect()), key=str) == sorted([("u", "n", "t", 0.9, 1), (None, None, None, 0.1, 3)], key=str)
    assert search.ground(df.limit(0), "at", df, 1).count() == 1


def test_history_and_tool_events(spark):
    rows = [(1, t, r, x) for t, (r, x) in enumerate([("user", "a"), ("system", "s"), ("assistant", "b"), ("user", " "), ("user", None), ("user", "c")])]
    chat = spark.createDataFrame(rows, "conv int, turn int, role string, text string")
    assert sorted(r["turn"] for r in catalog.trim_history(chat, "conv", "turn", "role", "text", 5).collect()) == [2, 5]
    t = lambda s: datetime(2024, 1, 1, 0, 0, s)
    events = spark.createDataFrame([("x", "start", t(1), 1), ("x", "start", t(2), 2), ("x", "end", t(5), 3), ("x", "end", t(9), 4), ("y", "end", t(1), 5), ("x", "start", t(10), 6)], "tool string, kind string, at timestamp, id int")
    assert sorted((r["tool"], r["n"], r["seconds"]) for r in catalog.tool_durations(events, ["tool"], "kind", "at", "start", "end", "id").collect()) == [("x", 1, 4.0), ("x", 2, 7.0)]


def test_catalog(spark, acts):
    catalog.register({"acts_view": acts})
    assert catalog.verify(spark) and catalog.run_query_single(spark, "SELECT count(*) AS n FROM acts_view")["n"] == 4
    assert "error" in catalog.read_only(spark, "DROP VIEW acts_view").columns and catalog.read_only(spark, "SELECT uri FROM acts_view WHERE uri = :u", {"u": "u/1"}).count() == 1
    with pytest.raises(ValueError):
        catalog.run_query_single(spark, "SELECT * FROM acts_view")
    assert catalog.run_query_single(spark, "SELECT * FROM acts_view WHERE false") is None and len(catalog.run_query_df(spark, "SELECT * FROM acts_view")) == 4
    links = spark.createDataFrame([("u/1", "u/2", "L"), ("u/2", "u/4", "L")], EDGES)
    paths = graph.all_shortest_paths(links, "u/4", "u/1", 4)
    nodes, edges = catalog.graph_of_paths(paths, acts.withColumnRenamed("uri", "id"), links)
    assert nodes.count() == 3 and edges.count() == 2
    degrees = {r["uri"]: r for r in graph.degree_counts(acts, links.select("src", "dst")).collect()}
    assert degrees["u/2"]["incoming_count"] == 1 and degrees["u/2"]["top_incoming_titles"] == ["Pensions Act 1962"] and degrees["u/pensions/3"]["outgoing_count"] == 0
