"""The prefix-filtered match against all pairs."""

import random
import struct

from compoundry.operators import fuzzy


def grams(s):
    out, word = set(), ""
    for ch in (s or "").lower() + " ":
        if ch.isalnum():
            word += ch
        elif word:
            p = "  " + word + " "
            out |= {p[i : i + 3] for i in range(len(p) - 2)}
            word = ""
    return out


def single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def brute(docs, items, threshold=0.45):
    out = {}
    for doc, product, *texts in docs:
        best = None
        for item, name in items:
            if product is None and grams(name):
                for t in texts:
                    a, b = grams(t), grams(name)
                    sim = len(a & b) / len(a | b)
                    if single(sim) >= threshold and (best is None or (sim, -item) > best):
                        best = (sim, -item)
        if best:
            out[doc] = (-best[1], best[0])
    return out


def data(seed, n=60):
    rnd = random.Random(seed)
    words = ["acetone", "ethanol", "sodium", "hydroxide", "acid", "citric", "n-butyl", "acetate", "drum", "25", "x", "aaa", "aaaa", "Ünder"]

    def name():
        return " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4)))

    items = [(i + 1, rnd.choice([name(), name(), None, "", "acetone"])) for i in range(n)]
    docs = [(d, rnd.choice([None, None, None, 5]), rnd.choice([name(), None, ""]), name().replace(" ", "_") + ".pdf") for d in range(n)]
    return docs, items


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, product_id long, title string, filename string")
    i = spark.createDataFrame(items, "source_item_id long, name string")
    return {r.doc_id: (r.source_item_id, round(r.sim, 9)) for r in fuzzy.fuzzy_best(d, i).collect()}


def rounded(d):
    return {k: (i, round(s, 9)) for k, (i, s) in d.items()}


def test_equals_all_pairs(spark):
    docs, items = data(11)
    assert run(spark, docs, items) == rounded(brute(docs, items))


def test_equals_all_pairs_of_short_names(spark):
    rnd = random.Random(4)
    short = ["a", "b", "ab", "a b", "abc", "x1", "1", "aa a"]
    items = [(i + 1, rnd.choice(short)) for i in range(30)]
    docs = [(d, None, rnd.choice(short), rnd.choice(short)) for d in range(40)]
    assert run(spark, docs, items) == rounded(brute(docs, items))


def test_candidates_grow_with_the_names(spark):
    """Twice as many distinct names of the same make give at most 2.5 times as many candidates for the same texts each."""
    rnd = random.Random(6)
    syllables = [a + b for a in "bcdfglmnprst" for b in "aeiou"]
    makes = ["".join(rnd.choice(syllables) for _ in range(3)) for _ in range(40)]

    def sets(n, seed):
        r = random.Random(seed)
        rows = []
        for i in range(n):
            name = f"{''.join(r.choice(syllables) for _ in range(4))} {r.choice(makes)} {r.randint(1000, 9999)}"
            rows.append((i, i, sorted(hash_of(g) for g in grams(name))))
        return fuzzy.measured(spark.createDataFrame(rows, "id long, item_id long, grams array<bigint>"))

    def hash_of(g):
        return sum(ord(c) << (21 * k) for k, c in enumerate(g))

    few = fuzzy.candidates(sets(150, 1), sets(600, 2), 0.45).count()
    more = fuzzy.candidates(sets(150, 1), sets(1200, 3), 0.45).count()
    assert more <= 2.5 * max(few, 1) and more < 0.2 * 150 * 1200
    # sets that share a key by chance are no candidates: hardly any is left of pairs without a match
    assert more < 0.001 * 150 * 1200


def long_name(rnd, words, n):
    return " ".join(rnd.choice(words) for _ in range(n))


def test_equals_all_pairs_of_very_long_and_short_names(spark):
    """Sets of up to some hundred trigrams, whose prefixes are too long for pairs, beside short ones."""
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 9))) for _ in range(120)]
    items = [(i + 1, long_name(rnd, words, rnd.choice([1, 2, 5, 20, 60, 90]))) for i in range(40)]
    docs = []
    for d in range(60):
        kept = [w for w in rnd.choice(items)[1].split() if rnd.random() < 0.75]
        docs.append((d, None, " ".join(kept + [rnd.choice(words) for _ in range(rnd.randint(0, 6))]), None))
    expected = rounded(brute(docs, items))
    assert max(len(grams(n)) for _, n in items) > 300 and len(expected) > 30
    assert run(spark, docs, items) == expected


def test_candidates_hold_every_pair_above_the_threshold(spark):
    rnd = random.Random(12)
    rows = [(i, i, sorted(rnd.sample(range(60), rnd.choice([1, 2, 3, 5, 8, 13, 21])))) for i in range(240)]
    frame = fuzzy.measured(spark.createDataFrame(rows, "id long, item_id long, grams array<bigint>"))
    for threshold in (0.2, 0.45, 0.8, 1.0):
        found = {(r.l_id, r.r_id) for r in fuzzy.candidates(frame, frame, threshold).collect()}
        sets = [(i, set(g)) for i, _, g in rows]
        assert {(i, j) for i, a in sets for j, b in sets if len(a & b) >= threshold * len(a | b)} <= found


def test_threshold_is_in_single_precision(spark):
    # nine of twenty trigrams shared: 0.45 as a single is below 0.45
    a, b = "abcdefghijklm", "abcdefgh opqr"
    assert len(grams(a) | grams(b)) > 0
    docs = [(1, None, a, None)]
    items = [(1, b)]
    assert run(spark, docs, items) == rounded(brute(docs, items))
