"""Gates and deletes along references against plain readings."""

import graphlib
import random

import pytest

from compoundry import schemas
from compoundry.operators import families, integrity, seed
from compoundry.schemas import CONSTRAINTS, Constraints


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plain_gate(data, parents, stored):
    """Rows (k, a, p, o): k present, a below 50, p a known parent; then (k) and then (a, p or 0) only once, first by o."""
    found = {}
    for i, (k, a, p, _) in enumerate(data):
        found[i] = [n for n, bad in [("low", a is not None and a >= 50), ("named", k is None), ("p_known", p is not None and p not in parents)] if bad]
    for name, key in [("first", lambda r: (r[0],)), ("second", lambda r: (r[1], r[2] or 0))]:
        taken = {key(r) for r in stored}
        for i in sorted((i for i in found if not found[i] and None not in key(data[i])), key=lambda i: data[i][3]):
            if key(data[i]) in taken:
                found[i].append(name + "_unique")
            else:
                taken.add(key(data[i]))
    return [(r, found[i]) for i, r in enumerate(data)]


RULES = Constraints(
    {"named": "k is not null", "low": "a < 50"}, {"first": ["k"], "second": ["a", "coalesce(p, 0)"]}, {"p": ("parents", "id")})


@pytest.mark.parametrize("seed_", [1, 2])
def test_gate_equals_a_plain_reading(spark, seed_):
    rnd = random.Random(seed_)
    data = [(rnd.choice([None, "x", *"abcdefghijklmnop"]), rnd.choice([None, *range(60)]), rnd.choice([None, 1, 2, 3, 9]), o) for o in range(250)]
    stored = [("a", 1, 1, 0), (None, 2, None, 0), ("zz", 3, None, 0)]
    schema = "k string, a int, p int, o int"
    parents = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "id int")
    got = integrity.gate(
        spark.createDataFrame(data, schema).repartition(5), RULES, {"parents": parents}, spark.createDataFrame(stored, schema), ["o"])
    want = plain_gate(data, {1, 2, 3}, stored)
    assert rows(got[0]) == sorted([r for r, f in want if not f], key=repr)
    assert rows(got[1]) == sorted([(*r, sorted(f)) for r, f in want if f], key=repr)


def test_gate_of_copies_and_of_nothing(spark):
    copies = spark.createDataFrame([("a", 1, None, 0)] * 30 + [(None, None, None, 0)] * 3, "k string, a int, p int, o int").repartition(4)
    good, bad = integrity.gate(copies, RULES, order=["o"])
    assert rows(good) == [("a", 1, None, 0)]
    assert rows(bad) == [("a", 1, None, 0, ["first_unique"])] * 29 + [(None, None, None, 0, ["named"])] * 3
    assert [f.count() for f in integrity.gate(copies.limit(0), RULES)] == [0, 0]
    free, none = integrity.gate(copies, Constraints())
    assert free.count() == 33 and none.count() == 0


def test_conditions_fit_their_tables(spark):
    for table in CONSTRAINTS:
        good, bad = integrity.gate(schemas.empty(spark, table), CONSTRAINTS[table])
        assert good.columns == bad.columns[:-1] == schemas.empty(spark, table).columns


def test_cascade(spark):
    rules = {
        "a": Constraints(key="a"), "b": Constraints(references={"of": ("a", "a")}, key="b"),
        "c": Constraints(references={"one": ("b", "b"), "two": ("a", "a")}),
    }
    a = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    b = spark.createDataFrame([(10, 1), (20, 2), (30, None), (40, 77), (None, 1)], "b int, of int")
    c = spark.createDataFrame([(10, 3), (20, 1), (20, 3), (30, None), (None, 2), (20, 3), (None, None)], "one int, two int")
    left = integrity.cascade({"c": c, "b": b, "a": a}, {"a": a.filter("a = 1"), "b": b.filter("b = 30")}, rules)
    assert rows(left["a"]) == [(2,), (3,)]
    assert rows(left["b"]) == [(20, 2), (40, 77)]
    assert rows(left["c"]) == rows(spark.createDataFrame([(20, 3), (20, 3), (None, 2), (None, None)], "one int, two int"))
    same = integrity.cascade({"c": c, "a": a}, {}, rules)
    assert same["c"] is c and same["a"] is a
    assert rows(integrity.cascade({"c": c, "a": a}, {"a": a.limit(0)}, rules)["c"]) == rows(c)
    with pytest.raises(graphlib.CycleError):
        integrity.cascade({"a": a, "b": b}, {}, {"a": Constraints(references={"a": ("b", "b")}, key="a"), "b": Constraints(references={"of": ("a", "a")}, key="b")})


def test_pattern_tables_grow_once(spark):
    alias = schemas.empty(spark, "name_alias_map")
    first = seed.with_fixed_aliases(alias)
    assert first.count() == len(seed.ALIAS_ROWS) and rows(seed.with_fixed_aliases(first)) == rows(first)
    placed = spark.createDataFrame([("^own$", "x", "name", 5)], "pattern string, replacement string, hint string, position int")
    assert [r.pattern for r in seed.with_fixed_aliases(placed).orderBy("position").collect()] == ["^own$", *[r["pattern"] for r in seed.ALIAS_ROWS]]
    family = families.with_fixed_families(schemas.empty(spark, "chemical_family"))
    assert rows(family.select("family_id", "name")) == sorted((r["family_id"], r["name"]) for r in families.FAMILY_ROWS)
    assert rows(families.with_fixed_families(family)) == rows(family)
