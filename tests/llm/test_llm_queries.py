"""Registered queries next to their SQL, and the pipeline next to a plain reading of the same documents."""

import collections
import os
import re

import duckdb
import pytest
from test_llm_operators import base_spans, check_packing, near_classes, prose, quality_of
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from compoundry.llm import queries, secrets

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
TABLES = ["documents", "conversations", "embeddings"]


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    cur = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    got = canonical(df.columns, df.collect())
    assert got == canonical(columns, cur.fetchall()) and got


def test_all_are_registered():
    found = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in found if re.match(r"op\d+_", k)}
    assert "pipeline" in found and set(queries.oracle_sql()) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", ["op1_sentencepiece", "op3_token_counts", "op6_minmax_dedup", "op7_secret_scans", "op8_fingerprints", "op11_language_model"])
def test_rows_of_queries_without_sql(spark, name):
    ids = [r.doc_id for r in queries.queries()[name](spark, SF).select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


def documents(spark):
    """Documents with planted copies, secrets, nulls, repeated rows and columns of unlucky names."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "n_chars").limit(120).collect()
    made = [(r.doc_id, r.text, r.n_chars) for r in rows]
    long = [m for m in made if quality_of(m[1])[-1]][:6]
    made += [(10_000 + k, t, n) for k, (_, t, n) in enumerate(long)]  # exact copies
    made += [(11_000 + k, t.replace(t.split()[5], "changed", 1), n) for k, (_, t, n) in enumerate(long)]  # near ones
    made += [(12_000, long[0][1] + ' token = "0123456789abcdef0123456789abcdef" ' + " ".join(f"w{k}x" for k in range(300)), 1)]
    made += [(13_000, None, 0), (13_001, "", 0), (None, "short", 5), long[1], long[1]]
    df = spark.createDataFrame(made, "doc_id long, text string, n_chars long")
    for c in ["kept", "_row", "_text", "set_key", "text_hash", "length", "_id"]:
        df = df.withColumn(c, F.lit("own"))
    return df, made


def test_pipeline_equals_a_plain_reading(spark):
    df, rows = documents(spark)
    stages = dict(corpus_pipeline.STAGES)
    one = stages["quality_rules"](spark, df, SF)
    kept = [r for r in rows if quality_of(r[1])[-1]]
    assert one.columns == df.columns
    assert collections.Counter((r.doc_id, r.text) for r in one.collect()) == collections.Counter(r[:2] for r in kept)
    two = stages["near_duplicates"](spark, one, SF)
    verdict = {d: keep for d, _, _, keep in near_classes([r[:2] for r in kept], corpus_pipeline.NEAR)}
    left = {r[:2] for r in kept if verdict[r[0]]}
    assert two.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in two.collect()) == sorted(left)
    assert {10_000 + k for k in range(6)} & {d for d, _ in left} == set()
    three = stages["secret_scans"](spark, two, SF)
    assert three.columns == df.columns and three.dtypes == df.dtypes
    masked = {r.doc_id: r for r in three.collect()}
    assert set(masked) == {d for d, _ in left}
    for d, t in left:
        if base_spans(t):
            assert secrets.MASK in masked[d].text and masked[d].n_chars == len(masked[d].text)
            assert not [s for s in base_spans(masked[d].text) if s[1] > 0]
        elif secrets.MASK not in masked[d].text:
            assert masked[d].text == t
    four = stages["best_fit_packing"](spark, three, SF)
    check_packing(four.collect(), [(d, r.text) for d, r in masked.items()], 2048)


def test_pipeline_drops_near_copies_from_80_hundredths(spark):
    docs = []
    for k in range(30):
        words = prose(120, 900 + k).split()
        changed = range(9, 9 + 20 * (k % 5 + 1), 20)  # each word changed leaves about 8 hundredths fewer in common
        docs += [(k, " ".join(words)), (100 + k, " ".join(f"edit{i}" if i in changed else w for i, w in enumerate(words)))]
    kept = [sorted(d for d, _, _, keep in near_classes(docs, percent) if keep) for percent in (80, 85)]
    assert len(kept[0]) < len(kept[1]) < len(docs)
    left = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, spark.createDataFrame(docs, "doc_id long, text string"), SF)
    assert sorted(r.doc_id for r in left.collect()) == kept[0]


def test_pipeline_keeps_one_of_near_copies_with_one_id_or_none(spark):
    def copies(seed, n):
        words = prose(150, seed).split()
        return [" ".join(words[: 20 + k] + ["edit"] + words[21 + k :]) for k in range(n)]

    one, none, mixed, far = copies(51, 4), copies(52, 3), copies(53, 3), prose(150, 54)
    docs = [(7, t) for t in one] + [(7, one[0]), (7, far)] + [(None, t) for t in none] + [(None, none[1])]
    docs += [(None, mixed[0]), (9, mixed[1]), (8, mixed[2]), (5, None), (5, None), (None, "")]
    left = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, spark.createDataFrame(docs, "doc_id long, text string"), SF)
    rows = [tuple(r) for r in left.collect()]
    assert len([t for d, t in rows if d == 7 and t in one]) == 1 and (7, far) in rows
    assert len([t for d, t in rows if d is None and t in none]) == 1
    assert [r for r in rows if r[1] in mixed] == [(8, mixed[2])]
    assert rows.count((5, None)) == 2 and rows.count((None, "")) == 1 and len(rows) == 7


def test_pipeline_stages_on_odd_documents(spark):
    df, _ = documents(spark)
    odd = df.filter("doc_id is null or doc_id >= 12000")
    for empty in (odd.limit(0), odd):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, empty, SF)
            n = out.count()
            if name == "near_duplicates" or name == "secret_scans":
                assert n == empty.count()
            if name == "best_fit_packing":
                assert n >= empty.count()


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {d for d, t in docs.items() if quality_of(t)[-1]}
    assert {r.doc_id for r in rows} <= good and len({r.doc_id for r in rows}) > 0.8 * len(good)
