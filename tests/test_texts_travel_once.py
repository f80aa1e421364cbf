"""Texts are dealt, shuffled and kept no more often than they must be."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from compoundry.checks import catalog, fixtures
from compoundry.functions.text import strip_ws
from compoundry.operators import sheets
from compoundry.plans import flows
from compoundry.session import durable
from compoundry.sources.versions import Versions

DOCS = "doc_id long, product_id long, title string, filename string, file_sha256 string"
PAGES = "doc_id long, page_no int, has_text boolean, ocr_used boolean, ocr_conf double, text string"


def update(spark, store, texts):
    docs = spark.createDataFrame([(1, 7, "sheet", "sheet.pdf", "d1"), (2, 8, "other", "other.pdf", "d2")], DOCS)
    pages = spark.createDataFrame([(d, p, True, False, None, t) for (d, p), t in texts.items()], PAGES)
    items = spark.createDataFrame([(9, "acetone")], "source_item_id long, name string")
    return flows.sds_update(store, docs, pages, items, catalog.now())


TEXTS = {(1, 1): "SECTION 1: A\nEthanol 64-17-5 10 %", (1, 2): "Danger H225", (2, 1): "SECTION 2: B\nWARNING H300"}


def test_pages_of_sheets_are_dealt_once(spark, tmp_path):
    catalog.load()
    rows = [(o, k, 10 * o + k, o + k, float(5 * k)) for o in (4, 5, 5) for k in (1, 2, 4)] + [(None, 1, 2, 3, 4.0), (6, None, 2, 3, 4.0)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    pages = fixtures.Tables(spark, str(tmp_path)).fx_sds_pages
    assert pages._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted((r["doc_id"] or 0, r["page_no"] or 0) for r in pages.collect()) == [(0, 1), (5, 1), (5, 2), (6, 1), (6, 2), (7, 0)]


def test_scratch_and_published_tables_are_packed(spark, tmp_path):
    df = spark.createDataFrame([(1, "text " * 100)], "id long, text string")
    store = Versions(spark, str(tmp_path))
    for folder in (durable(df, "packed")._scratch, f"{tmp_path}/data/{store.write('t', df)['folders'][0]}"):
        parts = [n for n in os.listdir(folder) if n.startswith("part-")]
        assert parts and all(".zstd." in n for n in parts)


def test_a_first_run_compares_no_texts_and_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    plans, kept = [], []
    write = Versions.write
    monkeypatch.setattr(Versions, "write", lambda self, name, df: plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())) or write(self, name, df))
    monkeypatch.setattr(flows, "durable", lambda df, label: kept.append(durable(df, label)) or kept[-1])
    store = Versions(spark, str(tmp_path))
    assert update(spark, store, TEXTS) == 1
    assert [("Join" in p) for n, p in plans if n == "sds_page"] == [False]
    assert update(spark, store, TEXTS | {(1, 2): "Danger H226", (2, 2): "P301"}) == 2
    assert kept and not any(os.path.exists(f._scratch) for f in kept)
    assert {(r["doc_id"], r["code"], r["section"]) for r in store.table("sds_hazard").collect()} == {
        (1, "H226", "SECTION 1"), (2, "H300", "SECTION 2"), (2, "P301", "SECTION 2")}
    assert {(r["doc_id"], r["page_no"], r["run"]) for r in flows.current_pages(store, with_run=True).collect()} == {
        (1, 1, 1), (1, 2, 2), (2, 1, 1), (2, 2, 2)}


def test_pieces_that_end_on_their_page_are_not_gathered(spark):
    pages = spark.createDataFrame(
        [(1, 1, "SECTION 1: A\na\nSECTION 2: B\nb"), (1, 2, "more\nSECTION 3: C\nc"), (2, 1, "SECTION 1: X\nx\nSECTION 4: Y\ny"),
         (2, 1, "SECTION 1: X\nx\nSECTION 4: Y\ny"), (None, 1, "SECTION 5: N\nn\nSECTION 6: O\no")], "doc_id long, page_no int, text string")
    pieces = sheets.section_pieces(pages)
    assert "Union" in pieces._jdf.queryExecution().analyzed().toString().split("array_join")[0]
    got = {(r["doc_id"], r["section_no"], r["text"]) for r in pieces.collect()}
    assert got == {
        (1, 1, "SECTION 1: A\na"), (1, 2, "SECTION 2: B\nb\nmore"), (1, 3, "SECTION 3: C\nc"),
        (2, 1, "SECTION 1: X\nx\n\nSECTION 1: X\nx"), (2, 4, "SECTION 4: Y\ny\nSECTION 4: Y\ny"),  # a page that comes twice is gathered
        (None, 5, "SECTION 5: N\nn"), (None, 6, "SECTION 6: O\no")}


def test_blanks_inside_a_text_cost_nothing_to_strip(spark):
    texts = ["", " ", "a", " a b \n", " x\x1f ", "a" + " " * 300_000 + "b", "\n" * 300_000, None, "é 😀 "]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", strip_ws(F.col("t")).alias("s"))
    assert {r["i"]: r["s"] for r in rows.collect()} == {i: None if t is None else t.strip() for i, t in enumerate(texts)}
