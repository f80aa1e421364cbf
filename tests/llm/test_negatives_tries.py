"""Hard negatives and the conversation trie against plain readings."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from compoundry.llm import negatives, tries

# ---- hard negatives


def plain_negatives(rows, every, low=30, high=90):
    rows = [r for r in rows if None not in r and None not in r[1]]
    out = []

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    for a_id, a_vec, a_label in rows:
        if a_id % every:
            continue
        positives = sorted((-dot(a_vec, v), i) for i, v, label in rows if label == a_label and i != a_id)[:5]
        for p, p_id in positives:
            others = sorted((-dot(a_vec, v), i) for i, v, label in rows if label != a_label)
            fit = [(s, i) for s, i in others if low * -p <= 100 * -s <= high * -p][:10]
            out += [(a_id, p_id, k + 1, i, -p, -s) for k, (s, i) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(
        [(*r, 7) for r in rows], "vec_id long, vector array<bigint>, label int, row int").withColumn("score", F.lit("x"))
    return sorted(map(tuple, negatives.mine(df, **kw).collect()))


def test_negatives_equal_plain_ranking(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randint(-9, 9) for _ in range(6)], rng.randrange(3)) for i in range(150)]
    rows += [(200 + i, [5, 5, 5, 5, 5, 5], i % 3) for i in range(40)]  # ties
    rows += [rows[10], rows[11], (300, [0] * 6, 0), (310, [], 1), (None, [1] * 6, 0), (320, None, 0), (330, [1] * 6, None),
             (340, [1, None], 1), (350, [9, 9], 2), (360, [1] * 6, 77)]
    got = mined(spark, rows, every=10)
    assert got == plain_negatives(rows, 10) and len({r[0] for r in got}) > 10


def test_repeated_anchor_gives_its_rows_as_often(spark):
    rows = [(0, [4, 1], 0), (0, [4, 1], 0), (1, [3, 3], 0), (2, [2, 2], 1), (3, [2, 2], 1)]
    got = mined(spark, rows, every=10)
    assert got == plain_negatives(rows, 10)
    assert [r[3] for r in got if r[1] == 1] == [2, 2, 3, 3]


def test_no_rows_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1], 0), (2, [1], 1)]) == []


def test_walk_stops_early_and_misses_nothing(monkeypatch):
    monkeypatch.setattr(negatives, "STEP", 16)
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 40, (12, 16))
    x = np.floor(middles[np.arange(3000) % 12] + rng.normal(0, 4, (3000, 16)))
    ids, labels = np.arange(3000), np.arange(3000) % 12 % 4
    a = x[:120]
    clusters = np.concatenate([negatives.clustered(a)])
    clusters = labels[:120] * 1000 + clusters
    told = negatives.prepared(a, ids[:120], labels[:120], clusters)
    goal = negatives.Positives(told, 5)
    made = negatives.walk(told, goal, x, ids, labels)
    for k in range(120):
        s = x @ a[k]
        mine = [i for i in np.lexsort((ids, -s)) if labels[i] == labels[k] and i != k][:5]
        assert list(goal.best.id[k]) == mine
    assert made < 120 * 750 / 2  # of all scores with rows of the label


def test_large_numbers_are_multiplied_exactly():
    a, b = np.array([[2.0**28 + 1, 3]]), np.array([[2.0**28 - 1, 5]])
    assert negatives.scores(a, b)[0, 0] == (2**28 + 1) * (2**28 - 1) + 15


# ---- conversation trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_trie(turns, convs):
    """Nodes by their beginnings; ``turns``: {conv: [(role, text)]}."""
    members = {}
    for c in convs:
        said = turns.get(c, [])
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    total = {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        words = len(WORD.findall(p[-1][1])) if p else 0
        total[p] = (sum(total[k][0] for k in kids) or 1, (len(members[p]) - 1) * words + sum(total[k][1] for k in kids))
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(turns.get(c, [])) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *total[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, rows, extra=()):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, id int, depth int")
    ordered = tries.ordered(df)
    convs = ordered.select("conv_id").union(spark.createDataFrame([(c,) for c in extra], "conv_id long")).distinct()
    members = tries.grow(ordered, convs)
    nodes = tries.rollup(members).join(tries.list_digests(tries.ends(members)), "id", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.sha256 or empty)
                   for r in nodes.collect()), key=repr)


def by_conv(rows):
    out = {}
    for c, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def test_trie_equals_plain_nodes(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "a  c", "d"])) for c in range(-20, 60) for t in range(rng.randrange(7))]
    rows += [(7001, None, None, None), (7001, 3, "x", ""), (7002, None, "", ""), (None, 1, "user", "lost"), (7001, 1, "x", "y" * 100_000)]
    extra = [8000, 8001]
    turns = by_conv(rows)
    assert trie(spark, rows, extra) == plain_trie(turns, [*turns, *extra])


def test_trie_of_long_conversations(spark):
    """Deeper than a window, in four levels of bands; two share 1,500 turns."""
    rows = [(c, t, "user", f"w{t % 3} w" if t < 1500 or c == 5 else f"v{c}") for c, n in ((5, 2100), (6, 1600), (7, 1024), (9, 2))
            for t in range(n)]
    turns = by_conv(rows)
    assert trie(spark, rows) == plain_trie(turns, turns)


def test_trie_of_one_beginning_for_all(spark):
    rows = [(c * 3, t, "user", "same words") for c in range(6000) for t in range(2)]
    assert trie(spark, rows) == plain_trie(by_conv(rows), by_conv(rows))


def test_trie_without_rows(spark):
    assert trie(spark, []) == []


def test_repeated_turns_count_as_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a")]
    assert [r[:4] for r in trie(spark, rows)] == [(1, 0, None, 2), (1, 1, 1, 2), (1, 2, 1, 1)]


@pytest.mark.parametrize("n", [1, 4096, 9000])
def test_list_digests(spark, n):
    numbers = list(itertools.islice((k * 5 - 11 for k in itertools.count()), n))
    df = spark.createDataFrame([(bytearray(b"x"), k) for k in numbers], "id binary, conv_id long")
    want = hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
    assert [r.sha256 for r in tries.list_digests(df).collect()] == [want]
