"""Steps whose cost must not be paid several times over: what several readers need is made once."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from compoundry.checks import catalog, entries_published
from compoundry.checks.fixtures import Tables
from compoundry.operators import fuzzy


@pytest.fixture(scope="module")
def own_tables(spark, tmp_path_factory):
    """Three orders of two lines, one without lines, and some parts."""
    root = tmp_path_factory.mktemp("own-tables")
    lines = [(o, k, 10 * o + k, o + k, float(5 * k)) for o in (4, 5, 6) for k in (1, 2)]
    parts = [(k, f"part {k}", f"Brand#{k}", "SMALL", 1 + k % 50) for k in range(100)]
    made = {
        "lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double"),
        "orders": ([(o, 1, "O", datetime.date(2024, 1, 1)) for o in (4, 5, 6, 7)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date"),
        "part": (parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_component_first_extracts_once(spark, own_tables):
    out = catalog.queries()["M13_component_first"](spark, own_tables)
    assert "Generate" not in plan(out)
    rows = {(r["doc_id"], r["name_key"].split(" ")[0], r["origin"]) for r in out.collect()}
    assert {r for r in rows if r[1] == "impurity"} == {(d, "impurity", "old") for d in (5, 6, 7)}
    assert {r for r in rows if r[1] != "impurity"} == {(d, "ingredient", "new") for d in (5, 6, 7)}


def test_summary_cuts_lines_once(spark, own_tables):
    out = catalog.queries()["A07_sds_summary"](spark, own_tables)
    assert "_segments" not in plan(out)  # no page is cut at its sections, and no reader does so again
    # two ingredients of each sheet, and one impurity: numbers with a wrong check digit are told apart by name only
    assert out.first()["docs"] == 3 and out.first()["components"] == 9


def test_pairs_extract_once(spark, own_tables):
    out = catalog.queries()["A08_distinct_doc_cas"](spark, own_tables)
    assert "Generate" not in plan(out)
    assert out.filter("product_id is null").count() == len({r["cas"] for r in out.collect()})


def test_unparsed_documents_need_no_sections(spark, own_tables):
    out = catalog.queries()["J14_unparsed_docs"](spark, own_tables)
    assert "Window" not in plan(out)
    assert [r["doc_id"] for r in out.collect()] == [8]


def test_arrivals_are_read_from_a_stored_table(spark, own_tables, monkeypatch):
    """Both parts read pages and documents several times; they are derived once."""
    seen = []
    monkeypatch.setattr(entries_published.flows, "sds_update", lambda store, docs, pages, *rest: seen.extend([plan(docs), plan(pages)]))
    monkeypatch.setattr(entries_published, "_RUNS", {})
    entries_published.published(Tables(spark, own_tables))
    assert len(seen) == 4 and not any("Aggregate" in p for p in seen)


def test_a_title_of_many_documents_is_cut_into_trigrams_once(spark, monkeypatch):
    kept = {}

    def durable(df, label, real=fuzzy.durable):
        kept.setdefault(label, real(df, label))
        return kept[label] if label not in ("fuzzy-index", "fuzzy-found") else real(df, label)

    monkeypatch.setattr(fuzzy, "durable", durable)
    docs = spark.range(50).select(
        F.col("id").alias("doc_id"), F.lit(None).cast("long").alias("product_id"), F.lit("Acetone drum").alias("title"),
        F.when(F.col("id") < 49, "acetone_drum.pdf").alias("filename"))
    items = spark.createDataFrame([(3, "acetone drum"), (2, "Acetone-Drum"), (9, None), (4, "--")], "source_item_id long, name string")
    got = {r["doc_id"]: (r["source_item_id"], r["sim"]) for r in fuzzy.fuzzy_best(docs, items).collect()}
    assert got == {k: (2, 1.0) for k in range(50)}
    assert kept["fuzzy-spelled"].count() == 2


def test_an_update_does_only_what_its_reader_asks_for(spark, own_tables, monkeypatch):
    """Documents need no mined lines or sections, entities no match of documents, pages neither."""
    done = []
    for module, name in ((entries_published.sheets, "mined_lines"), (entries_published.sheets, "section_pieces"), (fuzzy, "fuzzy_best")):
        monkeypatch.setattr(module, name, lambda *a, real=getattr(module, name), name=name, **k: done.append(name) or real(*a, **k))
    monkeypatch.setattr(entries_published, "_RUNS", {})
    rows = {}
    for name in ("documents", "entities", "pages"):
        rows[name] = catalog.queries()[f"L5_update_{name}"](spark, own_tables).collect()
        rows[name] = len(rows[name]), sorted(set(done))
        done.clear()
    assert rows == {"documents": (3, ["fuzzy_best"]), "entities": (14, ["mined_lines"]), "pages": (3, [])}


def test_trigrams_that_no_name_has_make_no_keys(spark):
    sets = spark.createDataFrame([(1, 0, [11, 12, 13, 14, 15])], "id long, item_id long, grams array<bigint>")
    common = spark.createDataFrame([(11, 3), (12, 1), (13, 2)], "gram long, n long")
    asked = fuzzy.measured(fuzzy._ranked(sets, common, whole=True))
    assert [asked.first()[c] for c in ("grams", "skip")] == [[14, 15, 12, 13, 11], 2]
    buckets = asked.groupBy("low", "next").agg(F.max("n").alias("most"))
    keys = fuzzy.index_rows(asked, buckets, 0.42, "l")  # a prefix of four: of its six pairs one has only trigrams of names
    every = fuzzy.index_rows(asked.drop("skip"), buckets, 0.42, "l")
    assert [r["l_place"] for r in keys.collect()] == [3] and every.count() > 1
    assert keys.join(every, ["key", "l_place"]).count() == 1


def test_cascade_asks_its_store_for_every_table_of_documents(spark, own_tables, monkeypatch):
    monkeypatch.setattr(entries_published, "_RUNS", {})
    out = catalog.queries()["C10_cascade_documents"](spark, own_tables).collect()
    left = {(r["tab"], r["doc_id"]): r["n"] for r in out}
    every = {"sds_document", "sds_page", "sds_entity", "sds_component", "sds_hazard", "sds_section"}
    assert {t for t, _ in left} == every and len(left) == len(out)
    assert {d for _, d in left} == {5, 6, 7}  # of the ids that remain none is 2 modulo 6
    assert all(left["sds_section", d] == 2 and left["sds_component", d] == 3 for d in (5, 6, 7))
