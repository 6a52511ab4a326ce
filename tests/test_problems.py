"""Orphan references, packed values, nested records and intervals against brute force and on odd rows."""

import json
import random
from datetime import datetime, timedelta

import pytest

from lexweave.functions.dates import parse_day
from lexweave.functions.urls import canonical_uri
from lexweave.operators.intervals import merge_intervals
from lexweave.operators.nested import flatten_nested, infer_schema, nested_levels, node_table
from lexweave.operators.packed import split_packed, unpack_values
from lexweave.operators.references import orphan_references, orphan_report
from lexweave.plans import problems

DAY = datetime(2020, 1, 1)
PARENT = "parent_table string, parent_key string, loaded_at timestamp, deleted_at timestamp, ref_id string"
CHILD = "parent_table string, parent_key string, ref_table string, ref_id string, ref_at timestamp, loaded_at string"


def at(n):
    return None if n is None else DAY + timedelta(days=n)


def judged(parents, t, key):
    own = [p for p in parents if p[1] == key]
    if any(p[2] is not None and t is not None and p[2] <= t and (p[3] is None or p[3] > t) for p in own):
        return None
    if not own:
        return "missing"
    first = min((p[2] for p in own if p[2] is not None), default=None)
    return "late" if first is not None and t is not None and first > t else "deleted"


@pytest.mark.parametrize("hot_rows", [200_000, 5])
def test_orphans_match_brute_force(spark, hot_rows):
    rng = random.Random(3)
    parents = [("act", f"k{rng.randint(0, 9)}", at(rng.choice([None, *range(20)])), at(rng.choice([None, None, *range(20)])), "clash") for _ in range(40)]
    # a third of all references go to one key
    children = [("act", rng.choice(["k0", f"k{rng.randint(0, 14)}", f"k{rng.randint(0, 14)}"]), "cite", f"r{n}", at(rng.choice([None, *range(20)])), "clash") for n in range(300)]
    children += [("act", None, "cite", "null key", at(1), "x"), children[0], ("act", "k99", "cite", None, at(1), "x")]
    got = orphan_references(spark.createDataFrame(parents, PARENT), spark.createDataFrame(children, CHILD), hot_rows=hot_rows)
    assert got.columns == ["ref_table", "ref_id", "parent_table", "parent_key", "ref_at", "reason"]
    want = [(c[2], c[3], c[0], c[1], c[4], judged(parents, c[4], c[1])) for c in children if c[1] is not None]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((w for w in want if w[-1]), key=repr)
    report = {(r["period"], r["reason"]): r["n_refs"] for r in orphan_report(got).collect()}
    assert sum(report.values()) == len([w for w in want if w[-1]])


def test_orphans_of_empty_tables(spark):
    none, refs = spark.createDataFrame([], PARENT), spark.createDataFrame([("act", "k", "cite", "r", at(1), "x")], CHILD)
    assert orphan_references(none, refs).first()["reason"] == "missing"
    assert orphan_references(none, spark.createDataFrame([], CHILD)).count() == 0


def test_canonical_uri(spark):
    forms = [" HTTPS://Acts.Example/id/xsi/1999/3/data.xml\n", "http://acts.example/xsi/1999/3/", "http://acts.example/xsi/1999/3", None, "  ", "no scheme/id/x/"]
    df = spark.createDataFrame([(f,) for f in forms], "u string")
    assert [r[0] for r in df.select(canonical_uri("u")).collect()] == ["http://acts.example/xsi/1999/3"] * 3 + [None, "", "no scheme/x"]


def test_parse_day(spark):
    forms = ["2001-02-03", " 2001-02-03 ", "03/02/2001", "2001-02-03T00:00:00", "20010203", "2001-13-40", "soon", "", None]
    df = spark.createDataFrame([(f,) for f in forms], "d string")
    assert [str(r[0]) if r[0] else None for r in df.select(parse_day("d")).collect()] == ["2001-02-03"] * 5 + [None] * 4


PACKED = [
    ("E+W", ["E", "W"]), ("E and W and S", ["E", "W", "S"]), ('"a,b",c', ["a,b", "c"]), ("“x;y”|z", ["x;y", "z"]), ("'p&q'/r", ["p&q", "r"]),
    ('"The ""Old"" One"+S', ['The "Old" One', "S"]), ("St Orran's Reach, E", ["St Orran's Reach", "E"]), ('E+"W', ["E", '"W']), ('"a" b, c', ['"a" b', "c"]),
    ("E\nW\r\nS", ["E", "W", "S"]), (" , ;", []), ("", []), ("   ", []), (None, None), ("E,E", ["E", "E"]), ('""', []), ("sand", ["sand"]), ("E and and W", ["E", "W"]),
]


def test_packed_values(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PACKED)], "i int, t string")
    got = {r["i"]: r["v"] for r in df.select("i", split_packed("t").alias("v")).collect()}
    assert {i: None if v is None else [x["value"] for x in v] for i, v in got.items()} == {i: w for i, (_, w) in enumerate(PACKED)}
    assert [x["pos"] for x in got[1]] == [1, 2, 3]
    assert got[2][0]["kind"] == "quoted" and got[7][1]["error"] == "malformed_quote" and got[8][0]["error"] == "malformed_quote"


def test_packed_brackets_and_long_text(spark):
    long = ",".join(['"' + '""' * 20_000 + 'x"', "y" * 50_000, '"' + "z" * 50_000])
    df = spark.createDataFrame([(1, "(a,b);c;(d", "pos"), (2, long, "pos")], "k int, t string, pos string")
    got = unpack_values(df, "t", ["k"], brackets=(("(", ")"),)).collect()
    assert [(r["value"], r["kind"], r["error"]) for r in got if r["k"] == 1] == [("(a,b)", "bracketed", None), ("c", "bare", None), ("(d", "bare", "malformed_bracket")]
    assert [len(r["value"]) for r in got if r["k"] == 2] == [20_001, 50_000, 50_001]


RECORDS = [
    {"parts": [{"n": 1, "chapters": [{"title": "a", "sections": [{"t": "s"}, None, {"t": "u", "commentaries": {"x": 1}}]}]}, None, 7]},
    {"parts": {"chapters": json.dumps([{"sections": {"t": "lone", "paragraphs": "[{\"p\": 1}, 3]"}}])}},
    {"parts": None}, {"parts": []}, {"parts": "not a list", "other": {"chapters": [{"a": 1}]}}, {},
]
NAMES = {"chapters": "chapter", "sections": "section", "paragraphs": "paragraph", "commentaries": "commentary"}


def test_nested_records(spark):
    texts = [json.dumps(r) for r in RECORDS] + ['{"parts": [{"chapters": [{"a": ', None, "", "[1]", '{"parts": [{"chapters": [{}]}]} trailing', '{"parts": [{"chapters": [{}]}]}']
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "k long, doc string, node_path string")
    schema = infer_schema(df, "doc")
    levels = nested_levels(schema, "parts", list(NAMES))
    tables = flatten_nested(df, "k", "doc", levels)
    got = sorted(map(tuple, node_table(df, "k", "doc", levels, NAMES).collect()))
    c0, s0 = "parts/0/chapters/0", "parts/0/chapters/0/sections"
    assert got == sorted([
        (0, "chapter", "parts/0", c0), (0, "section", c0, f"{s0}/0"), (0, "section", c0, f"{s0}/2"), (0, "commentary", f"{s0}/2", f"{s0}/2/commentaries/0"),
        (1, "chapter", "parts/0", c0), (1, "section", c0, f"{s0}/0"), (1, "paragraph", f"{s0}/0", f"{s0}/0/paragraphs/0"), (11, "chapter", "parts/0", c0),
    ])
    sections = tables["parts.chapters.sections"].collect()
    parents = {r["node_id"] for r in tables["parts.chapters"].collect()}
    assert {r["parent_id"] for r in sections} <= parents and {r["f_t"] for r in sections} == {"s", "u", "lone"}
    kept = flatten_nested(df, "k", "doc", levels, written=True)
    assert {p: sorted(map(tuple, t.collect())) for p, t in kept.items()} == {p: sorted(map(tuple, t.collect())) for p, t in tables.items()}
    kinds = {(r["path"], r["field"], r["kind"]) for r in schema.collect()}
    assert ("parts", "chapters", "packed") in kinds and ("", "parts", "object") in kinds


def test_nested_fields_with_odd_names_and_depth(spark):
    both = "a'b\"c"
    deep = '{"parts": [' + '{"parts": [' * 400 + "{}" + "]}" * 400 + "]}"
    df = spark.createDataFrame([(1, json.dumps({"parts": [{both: [{"x y": 5}], "it's": "v", "n": 1.5}]})), (2, deep)], "k long, doc string")
    levels = nested_levels(infer_schema(df.where("k = 1"), "doc"), "parts")
    tables = flatten_nested(df, "k", "doc", levels)
    assert [r["f_x y"] for r in tables[f"parts.{both}"].collect()] == ["5"]
    assert [(r["f_it's"], r["f_n"]) for r in tables["parts"].where("k = 1").collect()] == [("v", "1.5")]
    assert max(r["path"].count("parts") for r in infer_schema(df, "doc").collect()) == 400 and tables["parts"].where("k = 2").count() == 1


@pytest.mark.parametrize("texts", [[], [None, "", '{"parts": [{"chapters": [{"a": ']])
def test_nested_records_without_levels(spark, tmp_path, texts):
    spark.createDataFrame(list(enumerate(texts)), "raw_id long, doc_json string").write.parquet(str(tmp_path / "raw_acts.parquet"))
    found, sections = problems.p5_found(spark, str(tmp_path)), problems.p5_sections(spark, str(tmp_path))
    assert found.dtypes == [("raw_id", "bigint"), ("node_type", "string"), ("parent_path", "string"), ("node_path", "string")] and found.count() == 0
    assert sections.columns == ["raw_id", "node_id", "parent_id", "ordinal", "node_path", "parent_path"] and sections.count() == 0


SECTION_COLUMNS = ["raw_id", "node_id", "parent_id", "ordinal", "node_path", "parent_path"] + [
    f"f_{f}" for f in ("order", "restrict_end_date", "restrict_extent", "restrict_start_date", "section_number", "status", "text", "title", "uri")
]


def test_section_columns_are_the_declared_ones_whatever_the_records_hold(spark, tmp_path):
    def sections(name, *records):
        spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "raw_id long, doc_json string").write.parquet(str(tmp_path / name / "raw_acts.parquet"))
        got = problems.p5_sections(spark, str(tmp_path / name))
        assert got.columns == SECTION_COLUMNS
        return {r["node_path"]: {c[2:]: r[c] for c in SECTION_COLUMNS[6:] if r[c] is not None} for r in got.collect()}

    held = [{"order": 1, "title": "a", "commentaries": None, "extra": 1}, {"restrict_extent": "E+W", "text": None, "paragraphs": "none"}, {}]
    own = [{"order": "1", "title": "a"}, {"restrict_extent": "E+W"}, {}]
    path = "parts/0/chapters/0/sections"
    assert sections("few", {"parts": [{"chapters": [{"sections": held}]}]}) == {f"{path}/{i}": x for i, x in enumerate(own)}
    assert sections("two levels", {"parts": [{"sections": held[1]}]}, {"parts": [{"chapters": [{"sections": held[:1]}]}]}) == {"parts/0/sections/0": own[1], f"{path}/0": own[0]}
    assert sections("chapters only", {"parts": [{"chapters": [{"title": "c"}]}]}) == {}


def stretches(intervals):
    out = []
    for s, e in sorted(set(intervals)):
        if out and s <= out[-1][1] + 1:
            out[-1][1], out[-1][2] = max(out[-1][1], e), out[-1][2] + 1
        else:
            out.append([s, e, 1])
    return out


@pytest.mark.parametrize("hot_rows", [5, 100, 200_000])
def test_intervals_match_brute_force(spark, hot_rows):
    rng = random.Random(hot_rows)
    data = []
    for _ in range(600):
        # one entity holds a third of all rows; intervals cross several of the small shards below
        who = "hot" if rng.random() < 0.33 else f"e{rng.randint(0, 40)}"
        s = rng.randint(-2000, 2000) if who == "hot" else rng.randint(-120, 120)
        e = rng.choice([s + rng.randint(-3, 8), s + rng.randint(0, 90), 2_932_896 if rng.random() < 0.1 else s])
        data.append((who, rng.choice([s, s, s, -719_162 if rng.random() < 0.1 else s, None]), e, "clash"))
    data += data[:50]
    df = spark.createDataFrame(data, "kind string, s int, e int, start_day string")
    got = merge_intervals(df, ["kind"], "s", "e", hot_rows=hot_rows, shards=10)
    want = []
    for who in {d[0] for d in data}:
        own = stretches([(s, e) for w, s, e, _ in data if w == who and s is not None and s <= e])
        want += [(who, "stretch", a, b, n) for a, b, n in own]
        want += [(who, "gap", x[1] + 1, y[0] - 1, None) for x, y in zip(own, own[1:], strict=False)]
    got = [tuple(r) for r in got.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_a_huge_entity_inside_one_year_is_split(spark):
    rng = random.Random(7)
    data = [("hot", 18_000 + (s := rng.randint(0, 360)), 18_000 + s + rng.randint(0, 1)) for _ in range(150)] + [("hot", 18_100, 2_932_896)] * 2000 + [("cold", 1, 2)]
    got = merge_intervals(spark.createDataFrame(data, "id string, s int, e int"), ["id"], "s", "e", hot_rows=50, shards=16)
    own = stretches([d[1:] for d in data if d[0] == "hot"])
    want = [("hot", "stretch", *o) for o in own] + [("hot", "gap", x[1] + 1, y[0] - 1, None) for x, y in zip(own, own[1:], strict=False)] + [("cold", "stretch", 1, 2, 1)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_intervals_empty_and_null(spark):
    schema = "id string, s int, e int"
    assert merge_intervals(spark.createDataFrame([], schema), ["id"], "s", "e").count() == 0
    got = merge_intervals(spark.createDataFrame([(None, 1, 2), (None, 3, 3), ("a", None, 1), ("b", 2, 1)], schema), ["id"], "s", "e").collect()
    assert [tuple(r) for r in got] == [(None, "stretch", 1, 3, 2)]
