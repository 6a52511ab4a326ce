"""Registered queries over whole tables against their SQL."""

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lexweave.functions.urls import canonical_uri, fetch_url
from lexweave.plans import gallery, model

DATA = "/root/testdata/sf0.001"
TABLES = ("legislation", "section", "paragraph", "citation", "notes_paragraph")
#: Queries that can be held to a part of the acts, and the column that names the act.
PARTS = {"hierarchy_paths": ("legis_uri", "/xpga/19"), "notes_with_citations": ("uri", "/xpga/19"), "descendants": ("root", "/xpga/19"), "citing_upward": ("cited_uri", "/xpga/1960/")}


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")

    def run(q, columns):
        got = c.execute(f"SELECT {', '.join(columns)} FROM ({q})")
        return sorted(got.fetchall(), key=repr)

    return run


@pytest.mark.parametrize("name", PARTS)
def test_queries_take_all_acts(spark, sql, rows, name):
    column, part = PARTS[name]
    query = gallery.queries()[name]
    df = query(spark, DATA)
    whole = rows(df)
    assert whole == sql(gallery.oracle_sql()[name], df.columns)
    some = [r for r in whole if part in (r[df.columns.index(column)] or "")]
    assert rows(query(spark, DATA, part)) == some and len(whole) > len(some)


def test_crawl_starts_from_all_acts(spark):
    acts = {r[0] for r in model.acts(spark, DATA).select(fetch_url("uri")).collect()}
    got = gallery.crawled_acts(spark, DATA).collect()
    assert {r["url"] for r in got if r["wave"] == 0 and r["depth"] == 0 and not r["failed"]} == acts
    assert len({r["url"] for r in got}) == len(got)


def test_full_text_holds_every_node(spark):
    """Against a plain walk over the tables: act, sections each with their paragraphs, notes."""
    read = lambda t: pq.read_table(f"{DATA}/{t}.parquet").to_pylist()
    canon = {r["raw"]: r["uri"] for t in ("legislation", "section", "notes_paragraph") for r in _canonical(spark, t)}

    def last(name, key, at):
        best = {}
        for r in read(name):
            k = r[key] and canon.get(r[key], r[key])
            if k and (k not in best or (r[at] is not None, r[at], r["row_id"]) > (best[k][at] is not None, best[k][at], best[k]["row_id"])):
                best[k] = r
        return best

    first = lambda *texts: [next(t for t in texts if t is not None)] if any(t is not None for t in texts) else []
    acts, sections, paragraphs, notes = last("legislation", "uri", "loaded_at"), last("section", "id", "loaded_at"), last("paragraph", "id", "loaded_at"), last("notes_paragraph", "id", "row_id")
    want = {}
    for uri, act in acts.items():
        content = first(act["title"], act["description"])
        for sid, sec in sorted(sections.items(), key=lambda x: (x[1]["order_no"], x[0])):
            if canon[sec["legis_uri"]] == uri:
                content += first(sec["text"], sec["title"])
                content += [p["text"] for pid, p in sorted(paragraphs.items(), key=lambda x: (x[1]["order_no"], x[0])) if p["section_id"] == sid and p["text"] is not None]
        content += [n["text"] for _, n in sorted(notes.items()) if canon[n["legis_uri"]] == uri and n["text"] is not None]
        if content:
            want[uri] = "\n\n".join(content)
    assert {r["legis_uri"]: r["content"] for r in gallery.act_full_text(spark, DATA).collect()} == want
    assert any(r["text"] and r["text"] in want[canon[r["legis_uri"]]] for r in sections.values() if canon[r["legis_uri"]] in want)


def _canonical(spark, name):
    c = "uri" if name == "legislation" else "legis_uri"
    return spark.read.parquet(f"{DATA}/{name}.parquet").where(f"{c} IS NOT NULL").select(F.col(c).alias("raw"), canonical_uri(c).alias("uri")).distinct().collect()
