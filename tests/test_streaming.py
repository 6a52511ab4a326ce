"""Loading a stream of records gives the same graph as loading them at once."""

import json

from lexweave.operators.shred import shred
from lexweave.sources.documents import documents_from_text
from lexweave.streaming.ingest import arrivals, current_edges, current_nodes, document_stream, load_batch, start_loading


def record(n, title, supersedes=None):
    section = {"section_number": "1", "uri": f"a/{n}/s1", "paragraphs": [{"paragraph_number": "1", "text": "x", "commentaries": [{"ref_id": "c", "citations": [{"id": "i", "uri": "a/0"}]}]}]}
    return {"legislation_url": f"a/{n}", "identifier": {"title": title}, "super": {"supersedes": supersedes}, "parts": [{"part_number": "1", "chapters": [{"chapter_number": "1", "sections": [section]}]}]}


def test_stream_equals_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    records = [record(0, "zero"), record(1, "one", "a/9"), record(2, "two", "a/0")]
    for wave in (records[:2], records[2:]):
        (source / f"{wave[0]['legislation_url'][-1]}.json").write_text("\n".join(map(json.dumps, wave)) + '\n{"legislation_url": ""}\n')
        start_loading(document_stream(spark, str(source)), out, str(tmp_path / "check"), availableNow=True).awaitTermination()
    whole = shred(documents_from_text(spark.createDataFrame([(json.dumps(r),) for r in records], "t string"), "t"))
    for label in ("Legislation", "Section", "Paragraph", "Citation"):
        assert {r["id"] for r in current_nodes(spark, out, label).collect()} == {r["id"] for r in whole.nodes[label].collect()}
    want = {tuple(r) for r in whole.edges.select("src", "type", "dst").collect()}
    got = {tuple(r) for r in current_edges(spark, out).select("src", "type", "dst").collect()}
    assert got <= want and {e for e in want if e[1] != "CITES"} <= got  # a batch links citations to the acts it knows
    again = documents_from_text(spark.createDataFrame([(json.dumps(records[2]),)], "t string"), "t")
    load_batch(again, 1, out)
    assert {tuple(r) for r in current_edges(spark, out).select("src", "type", "dst").collect()} == got


def test_links_across_batches_equal_one_load(spark, tmp_path):
    """Acts cite earlier and later batches and one that never comes; an act comes again with another commentary."""
    site = "http://acts.example"

    def citing(n, ref, *targets, of=None):
        cites = [{"id": f"i{t}", "uri": f"{site}/id/xpga/2000/{t}"} for t in targets]
        subs = [{"id": f"s{t}", "uri": f"{site}/id/xpga/2000/{t}/section/1", "citation_ref": of or f"i{t}"} for t in targets]
        section = {"section_number": "1", "uri": f"{n}/s1", "paragraphs": [{"paragraph_number": "1", "text": "x", "commentaries": [{"ref_id": ref, "citations": cites, "citation_subrefs": subs}]}]}
        return {"legislation_url": f"{site}/xpga/2000/{n}", "parts": [{"part_number": "1", "chapters": [{"chapter_number": "1", "sections": [section]}]}]}

    batches = [[citing(1, "c", 2, 3, 9)], [citing(2, "c", 1)], [citing(3, "c", 1, 2, 3)], [citing(1, "d", 2, of="i3")]]
    docs = lambda records: documents_from_text(spark.createDataFrame([(json.dumps(r),) for r in records], "t string"), "t")
    for n, batch in enumerate(batches):
        load_batch(docs(batch), n, str(tmp_path))
    edges = lambda df: {tuple(r) for r in df.select("src", "type", "dst").collect()}
    got = edges(current_edges(spark, str(tmp_path)))
    assert got == edges(shred(docs(sum(batches, []))).edges)
    for kind in ("CITES", "REFERENCES"):
        assert {(s.split("#")[0][-1], d[-1]) for s, t, d in got if t == kind} == {("1", "2"), ("1", "3"), ("2", "1"), ("3", "1"), ("3", "2"), ("3", "3")}
    load_batch(docs(batches[1]), 1, str(tmp_path))
    assert edges(current_edges(spark, str(tmp_path))) == got


def test_arrivals(spark, tmp_path):
    rows = [("2024-01-01 10:00:00", "a"), ("2024-01-01 11:00:00", "a"), ("2024-01-03 10:00:00", "b"), ("2024-01-09 10:00:00", "b")]
    spark.createDataFrame(rows, "at string, k string").selectExpr("cast(at as timestamp) at", "k").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("at timestamp, k string").parquet(str(tmp_path / "e"))
    q = arrivals(stream, "at", "k").writeStream.format("memory").queryName("arrivals").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    assert {(str(r["window_start"])[:10], r["k"], r["n_rows"]) for r in spark.table("arrivals").collect()} >= {("2024-01-01", "a", 2), ("2024-01-03", "b", 1)}
