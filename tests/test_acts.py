"""Act documents: XML extraction, crawling, shredding and the graph."""

import json

import pytest

from lexweave.functions.urls import act_of_section_uri, fetch_url, file_name, plain_url
from lexweave.operators import graph
from lexweave.operators.crawl import crawl, next_wave
from lexweave.operators.shred import shred
from lexweave.sources.act_xml import element_schema, page_schema, parse_act, parse_pages
from lexweave.sources.documents import documents_from_text, read_documents, read_pages, read_seeds, write_documents
from lexweave.sources.schema import CITING, LABELS, TO_CITATION

HOST = "http://acts.example"
XML = f"""<?xml version="1.0"?><Act xmlns:dc="urn:dc" xmlns:m="urn:m"><m:Metadata>
<dc:title> Mills Act </dc:title><dc:description>On mills.</dc:description><dc:publisher>P</dc:publisher><dc:modified>2020-02-03</dc:modified><dc:identifier>{HOST}/xpga/1999/1</dc:identifier><dc:valid>2019-01-01</dc:valid>
<m:SecondaryMetadata><m:Year Value="1999"/><m:Number Value="1"/><m:EnactmentDate Date="1999-05-06"/><m:DocumentStatus Value="final"/><m:ISBN Value="I"/><m:DocumentCategory Value="primary"/>
<m:ComingIntoForce><m:DateTime Date=" 2000-01-01 "/></m:ComingIntoForce>
<m:UnappliedEffect EffectId="e1" Type="t" RequiresApplied="true" Modified="2021-01-01"><m:AffectingTitle>X</m:AffectingTitle><m:InForce Prospective="true" OtherQualification="in part"/></m:UnappliedEffect></m:SecondaryMetadata>
<m:Supersedes URI="{HOST}/id/xpga/1950/2/"/></m:Metadata>
<Body>
<P1 id="loose"><Pnumber>0</Pnumber><P1para><Text>Alone <Emphasis>here</Emphasis></Text><CommentaryRef Ref="c1"/><CommentaryRef Ref="gone"/></P1para></P1>
<Part DocumentURI="{HOST}/xpga/1999/1/part/1" RestrictStartDate="2000-01-01" Status="final"><Number>Part 1</Number><Title>First</Title>
<Chapter DocumentURI="{HOST}/xpga/1999/1/part/1/chapter/1"><Number>Chapter 1</Number><Title>One</Title>
<P1group RestrictStartDate="2001-01-01" RestrictExtent="E+W" Status="revised"><Title>Heading</Title>
<P1 DocumentURI="{HOST}/xpga/1999/1/section/1"><Pnumber>1</Pnumber><CommentaryRef Ref="c2"/>
<P2 DocumentURI="{HOST}/xpga/1999/1/section/1/1" RestrictEndDate="2010-01-01"><Pnumber>(1)</Pnumber><Text>Second level</Text><CommentaryRef Ref="c1"/>
<P3 id="p3"><Pnumber>(a)</Pnumber><Text>third level</Text></P3></P2></P1></P1group></Chapter></Part>
<Part Status="other"><Number>Part 1</Number><Title>Again</Title><P1 id="s2"><Pnumber>2</Pnumber><Text>More</Text></P1></Part>
</Body>
<Schedules><Schedule id="sch1"><Number>S1</Number><Title>Sched</Title><Reference>s. 1</Reference><Pblock><Title>Cross</Title>
<P1 id="sp1"><Pnumber>1</Pnumber><P2 id="sp1a"><Pnumber>2</Pnumber><Text>sub</Text><CommentaryRef Ref="c2"/></P2></P1></Pblock><P1 id="sp2"><Text>plain</Text><CommentaryRef Ref="c1"/></P1></Schedule></Schedules>
<Commentaries><Commentary id="c1" Type="F"><Para><Text>Words</Text> <Text>inserted</Text></Para><Citation id="x1" URI="{HOST}/id/xpga/1950/2" Title="Old" Class="K" Year="1950" Number="2">1950 c. 2</Citation>
<CitationSubRef id="r1" URI="{HOST}/id/xpga/1950/2/section/5" CitationRef="x1" SectionRef="s5">s. 5</CitationSubRef><CitationSubRef id="r2" URI="{HOST}/id/xpga/1950/2/section/6" SectionRef="s6">s. 6</CitationSubRef></Commentary>
<Commentary id="c2" Type="C"><Para><Text>See</Text></Para><Citation id="x2" URI="{HOST}/id/xpga/1960/3">1960</Citation><CitationSubRef id="r3" URI="{HOST}/id/xpga/1960/3/section/1" CitationRef="nothere">s. 1</CitationSubRef></Commentary>
<Commentary Type="none"><Citation id="x9" URI="{HOST}/id/xpga/1970/9"/></Commentary></Commentaries>
<ExplanatoryNotes IdURI="{HOST}/id/xpga/1999/1/notes"><P><Text>Note one.</Text><Citation id="n1" URI="{HOST}/id/xpga/1950/2">cite</Citation></P></ExplanatoryNotes></Act>"""
URL = f"{HOST}/xpga/1999/1"


def test_parse_act():
    act, links = parse_act(XML, URL, depth=1, max_depth=2)
    assert act["identifier"] == {"title": "Mills Act", "description": "On mills.", "publisher": "P", "modified": "2020-02-03", "uri": URL, "valid_date": "2019-01-01"}
    meta = act["metadata"]
    assert (meta["year"], meta["enactment_date"], meta["coming_into_force"]) == ("1999", "1999-05-06", "2000-01-01")
    effect = meta["unapplied_effects"][0]
    assert (effect["requires_applied"], effect["in_force_date"], effect["in_force_qualification"], effect["affecting_title"]) == (True, "Prospective", "in part", "X")
    assert act["super"] == {"supersedes": f"{HOST}/xpga/1950/2"}
    none, first = act["parts"]
    assert none["part_number"] is None and none["chapters"][0]["sections"][0]["text"] == "Alone here"
    assert [c["ref_id"] for c in none["chapters"][0]["sections"][0]["commentaries"]] == ["c1"]
    assert (first["part_number"], first["title"], first["status"], first["order"]) == ("Part 1", "First", "final", 2)
    section = first["chapters"][0]["sections"][0]
    assert (section["order"], section["title"], section["restrict_extent"], section["status"]) == (2, "Heading", "E+W", "revised")
    assert [p["paragraph_number"] for p in section["paragraphs"]] == ["(1)", "(a)"] and section["paragraphs"][0]["text"] == "Second level third level"
    assert [c["ref_id"] for c in section["commentaries"]] == ["c2"] and [c["ref_id"] for c in section["paragraphs"][0]["commentaries"]] == ["c1"]
    assert first["chapters"][1]["sections"][0]["uri"] == "s2" and first["chapters"][1]["chapter_number"] is None
    sched = act["schedules"][0]
    assert (sched["reference"], sched["paragraphs"][0]["crossheading"], sched["paragraphs"][1]["crossheading"]) == ("s. 1", "Cross", None)
    assert sched["paragraphs"][0]["subparagraphs"][0]["text"] == "sub" and sched["paragraphs"][1]["text"] == "plain"
    c1 = sched["paragraphs"][1]["commentaries"][0]
    assert c1["text"].startswith("Words inserted") and c1["citations"][0]["class"] == "K" and c1["citation_subrefs"][0]["citation_ref"] == "x1"
    assert act["explanatory_notes"]["paragraphs"][0]["citations"][0]["id"] == "n1"
    assert links == [(f"{HOST}/id/xpga/1950/2", 2), (f"{HOST}/id/xpga/1960/3", 2), (f"{HOST}/xpga/1950/2", 1)]
    assert parse_act(XML, URL, depth=2, max_depth=2)[1] == [(f"{HOST}/xpga/1950/2", 2)]
    bare, links = parse_act("<Act/>", "u")
    assert bare["metadata"] == {} and bare["super"] == {} and bare["parts"] == [] and bare["explanatory_notes"] is None and not links


def test_element_schema(spark):
    paths = element_schema("<a x='1'><b/><b y='2'><c/></b></a>")
    assert paths == {("a", None), ("a", "x"), ("a/b", None), ("a/b", "y"), ("a/b/c", None)}
    df = spark.createDataFrame([("<a><b/></a>",), ("<a/>",), ("broken",), (None,)], "body string")
    assert {(r["path"], r["n_pages"]) for r in page_schema(df).collect()} == {("a", 2), ("a/b", 1)}


def test_one_bad_page_harms_no_other(spark):
    bad = "<Act><Supersedes/></Act>"
    df = spark.createDataFrame([("good", 0, XML), ("bad", 0, bad), ("cut", 0, XML[:500]), ("none", 0, None)], "url string, depth int, body string")
    got = {r["url"]: r for r in parse_pages(df).collect()}
    assert got["good"]["document"]["identifier"]["title"] == "Mills Act" and got["good"]["error"] is None
    assert all(got[u]["document"] is None and got[u]["error"] and got[u]["links"] == [] for u in ("bad", "cut", "none"))


def test_crawl(spark):
    page = lambda *to, sup=None: "<Act>" + (f'<Supersedes URI="{HOST}/id/{sup}"/>' if sup else "") + "".join(f'<Commentary id="c{i}"><Citation id="i{i}" URI="{HOST}/id/{t}"/></Commentary>' for i, t in enumerate(to)) + "</Act>"
    pages = [(f"{HOST}/a", page("b", "c", sup="s")), (f"{HOST}/b", page("d")), (f"{HOST}/c", "broken"), (f"{HOST}/d", page("e")), (f"{HOST}/s", page("a", sup="t")), (f"{HOST}/t", page())]
    df = spark.createDataFrame([(u + "/data.xml", b) for u, b in pages], "url string, body string")
    seeds = spark.createDataFrame([(f"{HOST}/a/", 0), (None, 0), (f"{HOST}/a", 3)], "url string, depth int")
    got = {r["url"].removeprefix(f"{HOST}/").removesuffix("/data.xml"): (r["depth"], r["wave"], r["error"] is None) for r in crawl(seeds, df, max_depth=2).collect()}
    assert got == {"a": (0, 0, True), "b": (1, 1, True), "c": (1, 1, False), "s": (0, 1, True), "d": (2, 2, True), "t": (0, 2, True)}
    assert crawl(spark.createDataFrame([], "url string, depth int"), df).count() == 0
    wave = next_wave(spark.createDataFrame([("x/id/y", 2), ("x/y/", 1), ("z", 1), ("", 0)], "url string, depth int"), spark.createDataFrame([("z/data.xml",)], "url string"))
    assert [tuple(r) for r in wave.collect()] == [("x/y/data.xml", 1)]


def test_url_functions(spark):
    cases = [f"{HOST}/id/xpga/1/2", f"{HOST}/xpga/1/2/", f"{HOST}/xpga/1/2/data.xml", "", None]
    df = spark.createDataFrame([(c,) for c in cases], "u string")
    full = f"{HOST}/xpga/1/2/data.xml"
    got = [tuple(r) for r in df.select(fetch_url("u"), plain_url("u"), file_name(fetch_url("u"), "acts.example/")).collect()]
    assert [g[0] for g in got] == [full, full, full, None, None] and got[0][1] == f"{HOST}/xpga/1/2" and got[0][2] == "xpga_1_2_data.xml"
    refs = spark.createDataFrame([(f"{HOST}/id/xpga/1950/2/section/5",), (f"{HOST}/xpga/1950/2/section/5",)], "u string")
    assert [r[0] for r in refs.select(act_of_section_uri("u")).collect()] == [f"{HOST}/xpga/1950/2", f"{HOST}/xpga/1950/2/section/5"]


@pytest.fixture(scope="module")
def act_graph(spark):
    act, _ = parse_act(XML, URL)
    cited = {"legislation_url": f"{HOST}/xpga/1950/2", "identifier": {"title": "Old", "modified": "bad date"}, "parts": None, "schedules": []}
    texts = [json.dumps(act), json.dumps(act), json.dumps(cited), '{"legislation_url": ""}', '{"legislation_url": "cut', None, json.dumps({"legislation_url": "u", "explanatory_notes": None})]
    return shred(documents_from_text(spark.createDataFrame([(t,) for t in texts], "doc string"), "doc"))


def test_shred(act_graph):
    assert set(act_graph.nodes) == set(LABELS)
    counts = {label: df.count() for label, df in act_graph.nodes.items()}
    assert counts == {
        "Legislation": 3, "Part": 2, "Chapter": 3, "Section": 3, "Paragraph": 2, "Schedule": 1, "ScheduleParagraph": 2, "ScheduleSubparagraph": 1, "Commentary": 2, "Citation": 3,
        "CitationSubRef": 3, "ExplanatoryNotes": 1, "ExplanatoryNotesParagraph": 1,
    }
    acts = {r["id"]: r for r in act_graph.nodes["Legislation"].collect()}
    assert acts[f"{HOST}/xpga/1950/2"]["title"] == "Old" and acts[f"{HOST}/xpga/1950/2"]["modified_date"] is None and str(acts[URL]["coming_into_force"]) == "2000-01-01"
    assert all(graph.duplicate_keys(df, "id").count() == 0 for df in act_graph.nodes.values())
    edges = {(r["src"].removeprefix(URL), r["type"], r["dst"].removeprefix(URL)) for r in act_graph.edges.collect()}
    old = f"{HOST}/xpga/1950/2"
    assert {("", "HAS_PART", "#part_Part 1"), ("", "SUPERSEDES", old), ("#c1", "HAS_CITATION", "#x1"), ("#x1", "CITES", old), ("#x1", "HAS_SUBREF", "#r1"), ("#c1", "HAS_SUBREF", "#r2"), ("#c2", "HAS_SUBREF", "#r3"), ("#r1", "REFERENCES", old)} <= edges
    assert not any(t == "CITES" and s == "#x2" for s, t, _ in edges) and ("sp1a", "HAS_COMMENTARY", "#c2") in edges
    assert not any(s.endswith("section/1") and t == "HAS_COMMENTARY" for s, t, _ in edges)


def test_weights_count_paths(act_graph):
    roots = act_graph.nodes["Legislation"].select("id")
    got = graph.trail_counts(act_graph.edges, roots, list(CITING), list(TO_CITATION), 10).collect()
    # c1 hangs on one paragraph and one schedule paragraph; from each: one citation and two sub-references, one of them behind the citation
    assert [(r["src"], r["dst"], r["weight"]) for r in got] == [(URL, f"{HOST}/xpga/1950/2", 6)]


def test_sources(spark, tmp_path):
    act, _ = parse_act(XML, URL)
    (tmp_path / "in/1999").mkdir(parents=True)
    (tmp_path / "in/1999/a.json").write_text(json.dumps(act, indent=4))
    (tmp_path / "in/b.json").write_text('{"legislation_url": "cut')
    (tmp_path / "in/c.json").write_text('{"legislation_url": "u", "parts": []}')
    docs = read_documents(spark, str(tmp_path / "in"))
    assert {r["legislation_url"] for r in docs.collect()} == {URL, "u"}
    write_documents(docs, str(tmp_path / "out"), "acts.example/")
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"year=1999", "year=unknown_year"}
    (tmp_path / "seeds.txt").write_text("xpga/1999/1\n\n  xsi/2000/2 \n")
    assert {r["url"] for r in read_seeds(spark, str(tmp_path / "seeds.txt"), HOST).collect()} == {f"{HOST}/xpga/1999/1", f"{HOST}/xsi/2000/2"}
    (tmp_path / "cache").mkdir()
    (tmp_path / "cache/x_data.xml").write_text("<a/>")
    assert [tuple(r) for r in read_pages(spark, str(tmp_path / "cache"), {"x_data.xml": "u"}).collect()] == [("u", "<a/>")]


def test_records_in_other_shapes_are_mended(spark):
    odd = {"legislation_url": "u", "metadata": {"year": 1999, "unapplied_effects": {"requires_applied": "true"}}, "parts": {"part_number": "1", "chapters": json.dumps([{"order": "2", "sections": [None, {"section_number": 3}]}])}, "schedules": "none", "extra": 1}
    df = spark.createDataFrame([(json.dumps(odd),), ("[1]",), ('{"legislation_url": "cut',), (None,)], "t string")
    rows = documents_from_text(df, "t", mend=True).collect()
    assert [r["legislation_url"] for r in rows] == ["u"]
    chapter = rows[0]["parts"][0]["chapters"][0]
    assert chapter["order"] == 2 and [s["section_number"] for s in chapter["sections"]] == ["3"] and rows[0]["metadata"]["unapplied_effects"][0]["requires_applied"] is True and rows[0]["schedules"] is None
