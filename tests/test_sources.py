from pyspark.sql import functions as F

from compoundry import patterns as P
from compoundry import schemas, session
from compoundry.operators import dispatch, quality, seed
from compoundry.plans import flows
from compoundry.sources import documents, staging


def test_documents_by_content(spark, tmp_path):
    (tmp_path / "a.one.pdf").write_bytes(b"first page\fsecond")
    (tmp_path / "b.pdf").write_bytes(b"first page\fsecond")
    (tmp_path / "c.pdf").write_bytes(b"other")
    (tmp_path / "d.txt").write_bytes(b"ignored")
    docs = {r.title: r.filename for r in documents.load_documents(spark, str(tmp_path)).collect()}
    assert docs == {"b": "a.one.pdf", "c": "c.pdf"}
    pages = documents.extract_pages(spark, str(tmp_path))
    assert sorted((r.page_no, r.text) for r in pages.collect()) == [(1, "first page"), (1, "other"), (2, "second")]
    triaged = documents.page_triage(pages).collect()
    assert all(r.has_text and r.needs_ocr for r in triaged)


def test_stage_flow(spark, tmp_path):
    (tmp_path / "items.csv").write_text('ItemNo,ItemName,CAS,CAS No,Extra\nS1,Acetone,,67-64-1,"a,""b"\nS2,,,,\nS3,Ethanol,,,z\n')
    sheet = staging.read_text_table(spark, str(tmp_path / "items.csv"), [])
    sales = spark.createDataFrame([("C1", "5", "x")], "CustomerCode string, Qty string, Revenue string")
    ids = F.substring("ItemNo", 2, 9).cast("bigint")
    out = flows.stage(sheet, sales, sales, schemas.empty(spark, "item_master_query").drop("seq"), ids)
    items = {r.id: r for r in out["stg_item_master"].collect()}
    assert items[1].cas == "67-64-1" and items[1].brand is None and '"Extra":"a,\\"b"' in items[1].raw
    assert {tuple(r) for r in out["item_master_query"].collect()} == {(1, "67-64-1", "cas"), (3, "Ethanol", "name")}
    line = out["stg_sales_lines"].first()
    assert (line.qty, line.revenue, line.tx_date) == (5.0, None, None)


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ItemNo,ItemName\nS1,Acetone\n")
    (tmp_path / "b.csv").write_text("ItemName,ItemNo\nEthanol,S2\n")
    (tmp_path / "c.csv").write_text("ItemNo,Brand\nS3,x\n")
    df = staging.read_text_table(spark, str(tmp_path), ["ItemNo", "ItemName", "Brand"])
    assert sorted(map(tuple, df.collect())) == [("S1", "Acetone", None), ("S2", "Ethanol", None), ("S3", None, "x")]
    assert set(staging.read_text_table(spark, str(tmp_path), []).columns) == {"ItemNo", "ItemName", "Brand"}


def test_first_request_of_a_key_stays(spark):
    sent = spark.createDataFrame([("k", "b", 1), ("k", "a", 2), ("j", "c", 3)], "key string, value string, position int")
    assert sorted(r.value for r in dispatch.dedupe_requests(sent, "position").collect()) == ["b", "c"]
    assert sorted(r.value for r in dispatch.dedupe_requests(sent.drop("position")).collect()) == ["a", "c"]


def test_shared_folder(spark):
    class Context:
        applicationId = "app-1"

        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Session:
        def __init__(self, master, **conf):
            self.sparkContext, self.values, self.conf = Context(master), conf, self

        def get(self, key, default=None):
            return self.values.get(key, default)

    named = {"spark.sql.warehouse.dir": "hdfs:/warehouse/"}
    assert session.shared_dir(Session("yarn", **named, **{"spark.checkpoint.dir": "hdfs:/shared"})) == "hdfs:/shared"
    assert session.shared_dir(Session("yarn", **named)) == "hdfs:/warehouse/compoundry-scratch"
    assert session.shared_dir(Session("local-cluster[1,1,900]", **named)) == "hdfs:/warehouse/compoundry-scratch"
    assert session.shared_dir(Session("local[2]", **named)).endswith("compoundry-app-1")


def test_seed_with_a_long_alias_table(spark, monkeypatch):
    items = spark.createDataFrame([(1, "s", "Soda Ash", None, None), (2, "s", "x", "67-64-1", None)], "source_item_id long, sku string, name string, cas string, raw string")
    alias = spark.createDataFrame([r[:3] for r in P.ALIASES], "pattern string, replacement string, hint string")
    want = {tuple(r) for r in seed.build_seed(items).collect()}
    assert {tuple(r) for r in seed.build_seed(items, alias=alias).collect()} == want
    long = [(f"never {i}", "x", "name", -i) for i in range(450)] + [(*r[:3], i) for i, r in enumerate(P.ALIASES)]
    long = spark.createDataFrame(long, "pattern string, replacement string, hint string, position int")
    assert {tuple(r) for r in seed.build_seed(items, alias=long).collect()} == want
    none = {tuple(r) for r in seed.build_seed(items, alias=alias.limit(0)).collect()}
    assert none == {w for w in want if w[4] != seed.BRANCHES.index("alias") + 1} and none < want


def test_integrity_checks_use_three_valued_logic(spark):
    df = spark.createDataFrame([(1, "a"), (2, " "), (3, None)], "id int, name string")
    assert [r.id for r in quality.check_non_blank(df, "name").collect()] == [2]
    dup = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x")], "id int, k string")
    assert [r.id for r in quality.check_unique(dup, ["id", "k"]).collect()] == [2]


def test_values_with_line_breaks_are_one_value(spark, tmp_path):
    """Also in a header, and beside files that are read in parts."""
    (tmp_path / "a.csv").write_text('query_name,Synonyms,CID\nethanol,"a\nb ""c""\n\nd",702\nwater,"x, y",962\n')
    (tmp_path / "b.csv").write_text('query_name,Synonyms,CID\nacetone,z,180\npipe 5",q,1\n')
    (tmp_path / "c.csv").write_text('query_name,"Syn\nonyms",CID\nbenzene,w,241\n')
    got = {r.query_name: (r.Synonyms, r.CID) for r in staging.read_compound_results(spark, str(tmp_path)).collect()}
    assert got == {"ethanol": ('a\nb "c"\n\nd', "702"), "water": ("x, y", "962"), "acetone": ("z", "180"),
                   'pipe 5"': ("q", "1"), "benzene": (None, "241")}
