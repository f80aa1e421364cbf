"""Skew handling, pattern blocks and carried values against plain forms."""

import random

import pytest
from pyspark.sql import functions as F

from compoundry.operators import compounds as comp
from compoundry.operators import matching, skew
from compoundry.operators.carry import carry
from compoundry.operators.skew import split_hot_join
from compoundry.session import durable


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_hot_join(spark, how):
    rnd = random.Random(7)
    left = [(rnd.choice(["hot", "hot", "a", "b", None]), 1) for _ in range(300)]  # many exact copies
    right = [(k, i) for i, k in enumerate(["hot", "a", "c", None] + (["hot"] * 40 if how == "inner" else []))]
    a = spark.createDataFrame(left, "k string, x int").repartition(6)
    b = spark.createDataFrame(right, "k string, y int")
    got = split_hot_join(a, b, ["k"], how, rows_per_split=10)
    assert rows(got) == rows(a.join(b, ["k"], how))


def test_split_hot_join_with_unique_right(spark):
    a = spark.createDataFrame([("hot", 1)] * 200 + [("b", 2), (None, 3)], "k string, x int").repartition(6)
    b = spark.createDataFrame([("hot", 1), ("b", 2), (None, 4)], "k string, y int")
    got = split_hot_join(a, b, ["k"], rows_per_split=10, unique_right=True, count_from=a.select("k"))
    assert rows(got) == rows(a.join(b, ["k"]))


def test_split_hot_join_spreads_the_hot_key(spark):
    a = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id")).repartition(8)
    b = spark.createDataFrame([("hot", 1)], "k string, y int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = split_hot_join(a, b, ["k"], "left", rows_per_split=100)
        assert got.select(F.spark_partition_id()).distinct().count() > 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_pattern_blocks_equal_literals(spark):
    words = [f"w{i}" for i in range(7)]
    pats = spark.createDataFrame([(f"^{w}|{w}$", w) for w in words], "pattern string, tag string")
    df = spark.createDataFrame([(i, f"w{i % 9} w{i % 4}") for i in range(60)] + [(99, None)], "id int, text string")
    literal = matching.match_patterns(df, "text", pats, ["tag"])
    old, matching.BLOCK = matching.BLOCK, 3
    try:
        blocks = matching.match_patterns(df, "text", pats, ["tag"])
    finally:
        matching.BLOCK = old
    assert rows(literal) == rows(blocks) and literal.count() > 0
    assert matching.match_patterns(df, "text", pats.limit(0), ["tag"]).count() == 0
    long = pats.union(spark.createDataFrame([(f"^never{i}$", "x") for i in range(450)], "pattern string, tag string"))
    assert rows(matching.match_patterns(df, "text", long, ["tag"])) == rows(literal)


FORMS = [
    "acid", "^acid$", r"\bace", "acet(yl|ate)", "(?:acet|form)ate", "acids?", "ac?id", "acid{0}e", "acid|ester", "acid|e", "a.id",
    "[ab]cid", r"a\.cid", r"acid\|ester", "(acid)?ester", "(a(b)?cid)+ ester", "(?i)ACID", r"\x61cid", "acid+e", "", "ester(?!s)", "AcId",
    r"\(acid\)", "(acid", "ac{1,2}id", "sodium acetate", r"(\w)\1", "est[^e]r", "ac?+id", "acid*?e",
]


@pytest.mark.parametrize("flags", ["", "(?i)"])
def test_large_pattern_tables_equal_blocks(spark, monkeypatch, flags):
    """Patterns of all forms give the same rows joined by literals as in the projection; repeated rows stay repeated."""
    rnd = random.Random(3)
    parts = ["acid", "Acid", "ester", "acetate", "formate", "a.cid", "acid|ester", "sodium", "(acid)", "aid", "accid", "esters", "İacid", ""]
    texts = [" ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 4))) for _ in range(80)] + [None, "acid", "acid", "x" * 5000 + "acid"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    forms = [f for f in FORMS if f != "(acid"]
    pats = spark.createDataFrame([(f, k) for k, f in enumerate([*forms, "acid"])], "pattern string, tag int")
    plain = rows(matching.match_patterns(df, "text", pats, ["tag", "pattern"], flags))
    monkeypatch.setattr(matching, "MOST_INLINE", 3)
    assert rows(matching.match_patterns(df, "text", pats, ["tag", "pattern"], flags)) == plain and len(plain) > 300
    assert matching.match_patterns(df, "text", pats.filter("pattern in ('acid', '^acid$', 'acids?', 'ester|acid')"), ["tag"]).count() > 0


def test_twenty_thousand_patterns_leave_the_plan_small(spark):
    pats = spark.range(20_000).selectExpr("concat('^item', id, '( |$)') pattern", "id tag")
    df = spark.range(500).selectExpr("id", "concat('item', id * 41, ' x') text")
    found = matching.match_patterns(df, "text", pats, ["tag"])
    assert sorted((r.id, r.tag) for r in found.collect()) == [(i, 41 * i) for i in range(500) if 41 * i < 20_000]
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 20_000


@pytest.mark.parametrize("backward", [False, True])
def test_carry(spark, backward):
    rnd = random.Random(3)
    data = [(g, o, rnd.choice([None, None, f"v{g}{o}"])) for g in range(4) for o in rnd.sample(range(50), 30)]
    got = carry(spark.createDataFrame(data, "g int, o int, v string"), "g", "o", "v", "c", backward, width=7)
    for g, o, v, c in got.select("g", "o", "v", "c").collect():
        side = [(x, y) for h, x, y in data if h == g and y is not None and (x > o if backward else x < o)]
        want = (min(side) if backward else max(side))[1] if side else None
        assert c == want
    assert got.count() == len(data)


def test_mapping_in_one_join_equals_the_three_ways(spark):
    """Numbers and texts share one join: neither meets the other, nulls meet nothing, repeated results stay."""
    asked = [None, "", "64-17-5", "Ethanol", "ethanol", "text:ethanol", "number:64-17-5", "64-17-5 "]
    results = spark.createDataFrame(
        [(p, q, k, "t", "i", "f", 1.0, "s", "n", "y") for k, q in enumerate(asked + asked[:4]) for p in (None, 7)],
        "source_item_id long, query_name string, cid int, title string, iupac string, mf string, mw double, smiles string, inchi string, inchikey string",
    ).withColumn("cid", F.col("cid").cast("string"))
    items = spark.createDataFrame([(1, "64-17-5"), (2, "64-17-5"), (3, "ethanol"), (4, None)], "source_item_id long, cas string")
    queries = spark.createDataFrame([(1, "ETHANOL"), (5, "64-17-5"), (6, ""), (8, None), (9, "text:ethanol")], "source_item_id long, query string")
    three = comp.map_explicit(results).unionByName(comp.map_by_cas(results, items)).unionByName(comp.map_by_query(results, queries))
    got = comp.map_compounds(results, items, queries)
    assert rows(got) == rows(three) and got.filter("product_id in (5, 4, 8)").count() == 0

    def reads(df):  # of any input, written or given
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        return sum("Relation" in line or "LogicalRDD" in line for line in lines)

    assert reads(got) < reads(three)


def test_matches_tell_what_the_staged_rows_tell(spark):
    """Registry, links and counts without a row for every result and product of a text."""
    columns = "query_name string, source_item_id long, cid string, title string, iupac string, mf string, mw decimal(18,6), smiles string, inchi string, inchikey string"
    rest = (None, None, None, None, None, None)
    results = spark.createDataFrame(
        [("Drum", None, str(i % 3) if i % 5 else None, f"t{i % 4}", *rest) for i in range(40)]
        + [("64-17-5", None, "9", "Ethanol", *rest), ("64-17-5", None, "9", "Ethanol", *rest), ("nobody", None, "8", "N", *rest),
           (None, None, "7", "no text", *rest), ("x", 5, "1", "own", *rest), ("x", 5, None, "own", *rest)], columns)
    items = spark.createDataFrame([(1, "64-17-5"), (2, "64-17-5"), (None, "64-17-5"), (3, "no"), (4, None)], "source_item_id long, cas string")
    queries = spark.createDataFrame([(i % 20, "drum") for i in range(30)] + [(None, "DRUM"), (7, "64-17-5"), (7, None)], "source_item_id long, query string")
    m = comp.match_compounds(results, items, queries)
    staged = comp.map_compounds(results, items, queries)
    assert staged.count() == 40 * 31 + 2 * 3 + 2

    assert rows(comp.best_compound_row(m.reached())) == rows(comp.best_compound_row(staged))
    assert rows(comp.xref_collapse(m.links())) == rows(comp.xref_collapse(staged))
    assert m.counts().first().asDict() == {"staged_rows": staged.count(), "ready_rows": comp.ready(staged).count()}
    assert m.reached().count() == 40 + 2 + 2
    none = comp.match_compounds(results.limit(0), items, queries)
    assert none.counts().first().asDict() == {"staged_rows": 0, "ready_rows": 0} and none.staged().count() == 0


def test_pair_join_deals_one_text_over_tasks(spark):
    left = spark.range(300).select(F.when(F.col("id") < 290, "hot").otherwise(F.lit("cold")).alias("k"), F.lit(1).alias("a"))
    right = spark.range(120).select(F.when(F.col("id") < 110, "hot").when(F.col("id") < 118, "cold").alias("k"), F.col("id").alias("b"))
    left, right = durable(left.coalesce(1), "left"), durable(right.coalesce(1), "right")
    got = skew.pair_join(left, right, "k", pairs_per_share=1000)
    want = left.join(right, "k")
    assert rows(got) == rows(want)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = got.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 290 * 110


def test_long_pattern_tables_match_texts_that_hold_all_literals(spark, monkeypatch):
    """texts that share only the longest literal with a pattern are not matched against it."""
    monkeypatch.setattr(matching, "MOST_INLINE", 10)
    texts = spark.createDataFrame([(i, f"LARGE RING Brand#{i % 7} size {i % 5}") for i in range(70)] + [(99, None), (98, "part 3")], "id long, t string")
    rows_ = [(i, f"^large ring +brand#{i % 7} size {i % 5}( |$)|^part {i}$") for i in range(35)] + [(77, "rin(?=g)"), (78, None)]
    table = spark.createDataFrame(rows_, "k long, pattern string")
    got = matching.match_patterns(texts, "t", table, ["k"], "(?i)")
    want = texts.join(table, F.expr("t rlike concat('(?i)', pattern)")).select("id", "t", "k")
    assert rows(got) == rows(want)
    asked = spark.createDataFrame([("^large ring +brand#3 size 4( |$)|^part 1$",)], "p string").select(matching.literal_runs(F.col("p")).alias("r")).first()["r"]
    assert asked == [["large ring ", "brand", "3 size 4"], ["part 1"]]
