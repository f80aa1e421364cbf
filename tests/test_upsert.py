import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compoundry.operators import upsert as up

SCHEMA = "k int, a string, b double, c array<string>, u string"
RULES = {"a": "coalesce_new", "b": "greatest", "c": "nonempty_array", "u": "now"}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def expected(target, source):
    out, src = [], {r[0]: r for r in source if r[0] is not None}
    for t in target:
        s = src.pop(t[0], None) if t[0] is not None else None
        if s is None:
            out.append(t)
        else:
            best = [x for x in (t[2], s[2]) if x is not None]
            out.append((t[0], s[1] if s[1] is not None else t[1], max(best) if best else None, s[3] if s[3] else t[3], "now"))
    new = list(src.values()) + [s for s in source if s[0] is None]
    return sorted([*out, *[(*s[:4], "now") for s in new]], key=repr)


cell = st.tuples(st.sampled_from([None, "x", "y"]), st.sampled_from([None, 0.5, 2.0]), st.sampled_from([[], ["p"]]))
table = st.dictionaries(st.integers(0, 6), cell, max_size=5)


@settings(max_examples=8, deadline=None)
@given(table, table)
def test_upsert_follows_the_rules(spark, t, s):
    target = [(k, *v, "old") for k, v in t.items()] + [(None, "n", None, [], "old")]
    source = [(k, *v, "in") for k, v in s.items()] + [(None, "m", None, [], "in")]
    a, b = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    want = expected(target, source)
    for delta in (False, True):
        once = up.upsert(a, b, ["k"], RULES, F.lit("now"), delta=delta)
        assert rows(once) == want


def test_upsert_is_idempotent(spark):
    a = spark.createDataFrame([(1, None, 1.0, [], "old"), (2, "x", None, ["p"], "old")], SCHEMA)
    b = spark.createDataFrame([(2, "y", 3.0, [], "in"), (3, "z", 1.0, ["q"], "in")], SCHEMA)
    once = up.upsert(a, b, ["k"], RULES, F.lit("now"))
    assert rows(up.upsert(once, b, ["k"], RULES, F.lit("now"))) == rows(once)


def test_insert_only_and_reducers(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, "z"), (None, "w")], "k int, v string")
    assert rows(up.insert_only(a, b, ["k"])) == [(1, "x"), (2, "z"), (None, "w")]
    c = spark.createDataFrame([(1, "a", 1), (1, None, 2)], "k int, v string, o int")
    assert rows(up.reduce_latest(c, ["k"], F.col("o"))) == [(1, None, 2)]
    assert rows(up.reduce_first(c, ["k"], F.col("o"))) == [(1, "a", 1)]


def test_unknown_rule(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(ValueError):
        up.upsert(a, a, ["k"], {"v": "nonsense"})
