"""The hidden Markov language model against enumeration of state paths and a plain forward recursion."""

import itertools
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from compoundry.llm import markov


def small_model(states=3, classes=5, seed=2):
    rng = np.random.default_rng(seed)
    emit = rng.random((classes, states))
    move = rng.random((states, states))
    return markov.Model(rng.dirichlet(np.ones(states)), move / move.sum(axis=1)[:, None], emit / emit.sum(axis=0), 0.01)


def paths(model, seen):
    """Probability of every state path (the state before the first token included)."""
    states = range(len(model.start))
    for path in itertools.product(states, repeat=len(seen) + 1):
        p = model.start[path[0]]
        for a, b, o in zip(path, path[1:], seen, strict=False):
            p *= model.move[a, b] * model.emit[o, b]
        yield path, p


def forward(model, seen):
    now, log = model.start, 0.0
    for o in seen:
        now = (now @ model.move) * model.emit[o]
        log, now = log + math.log(now.sum()), now / now.sum()
    return log


def test_likelihood_and_counts_equal_enumeration(monkeypatch):
    monkeypatch.setattr(markov, "PIECE", 2)
    monkeypatch.setattr(markov, "BLOCK", 2)
    model = small_model()
    texts = [[0, 1, 2, 5, 3], [4], [1, 1, 0, 2], [5, 5]]
    got = markov.log_likelihood(model, np.array(sum(texts, [])), np.array([len(t) for t in texts]))
    want = [math.log(sum(p for _, p in paths(model, t))) for t in texts]
    assert np.allclose(got, want, rtol=1e-12)
    expected = markov.Expected(model)
    expected.add(np.array(sum(texts, [])), np.array([len(t) for t in texts]))
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))
    for t, log in zip(texts, want, strict=True):
        for path, p in paths(model, t):
            p /= math.exp(log)
            start[path[0]] += p
            for a, b, o in zip(path, path[1:], t, strict=False):
                move[a, b] += p
                emit[o, b] += p
    for x, y in ((expected.start, start), (expected.move, move), (expected.emit, emit)):
        assert np.allclose(x, y, rtol=1e-9)
    assert math.isclose(expected.log, sum(want))


def test_long_text_is_one_sequence():
    model, rng = small_model(), random.Random(1)
    texts = [[rng.randrange(6) for _ in range(n)] for n in (5000, 1, 128, 129, 700)]
    got = markov.log_likelihood(model, np.array(sum(texts, [])), np.array([len(t) for t in texts]))
    assert np.allclose(got, [forward(model, t) for t in texts], rtol=1e-10)


def corpus():
    rng = random.Random(4)
    kinds = [["the cat", "a dog", "sat on", "of the"], ["der hund", "ein haus", "ist alt", "und die"]]
    rows = [(i, " ".join(rng.choice(kinds[i % 2]) for _ in range(rng.randrange(3, 400)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, " \n"), (None, "THE cat unseen"), (3, rows[3][1]), (503, "neverseen THE\x0bcat " * 9000)]


def scored(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, tile int")
    return df, markov.learn_and_score(df, F.col("doc_id") % 5 == 1, **kw)


def words(text):
    return [*(text or "").encode().lower().split(), markov.END]


def test_scores_equal_a_plain_recursion(spark):
    rows = corpus()
    df, out = scored(spark, rows, states=2, rounds=4)
    got = {(r.doc_id, r.n_tokens): r for r in out.collect()}
    assert out.count() == len(rows)
    held = F.coalesce(F.col("doc_id") % 5 == 1, F.lit(False))
    coded = markov.encode(df, held)
    totals = markov.Totals(markov.word_counts(coded))
    model, logs = markov.train(coded, totals, 2, 4)
    count = Counter(w for i, t in rows if i is None or i % 5 != 1 for w in words(t))
    n, v = sum(count.values()), len(count)
    classes = {w: markov.xxhash.xxh64_intdigest(w) % markov.CLASSES for w in count}
    weight = Counter()
    for w, c in count.items():
        weight[classes[w]] += c + 0.5
    assert (totals.n, totals.v) == (n, v) and all(math.isclose(totals.weight[k], w) for k, w in weight.items())
    assert all(b > a for a, b in zip(logs, logs[1:], strict=False))
    gained = 0
    for i, t in rows:
        ws = words(t)
        r = got[i, len(ws)]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        latent = forward(model, [classes.get(w, markov.CLASSES) for w in ws]) / math.log(10)
        want = latent + sum(math.log10((count[w] + 0.5) / weight[classes[w]]) for w in ws if w in count)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, want, rel_tol=1e-9)
        assert r.n_known == sum(w in count for w in ws) and r.train_tokens == n and r.held_out == (i is not None and i % 5 == 1)
        gained += (r.score - r.base_score) if r.held_out else 0
    assert gained > 0


def test_probabilities_add_up(spark):
    """Over all words that are known, and the unknown one, after any beginning."""
    df, _ = scored(spark, corpus())
    coded = markov.encode(df, F.lit(False))
    counts = markov.word_counts(coded)
    totals = markov.Totals(counts)
    model, _ = markov.train(coded, totals, 3, 2)
    for state in range(3):
        known = sum(model.emit[r["class"], state] * (r["c"] + 0.5) / totals.weight[r["class"]] for r in counts.collect())
        assert math.isclose(known + model.emit[markov.CLASSES, state], 1, rel_tol=1e-9)


def test_no_rows_and_nothing_to_learn(spark):
    _, none = scored(spark, [])
    assert none.collect() == []
    _, all_held = scored(spark, [(1, "a b"), (6, None)])
    assert sorted((r.doc_id, r.n_tokens, r.n_known, round(r.score, 9), round(r.base_score, 9)) for r in all_held.collect()) == [
        (1, 3, 0, 0, 0), (6, 1, 0, 0, 0)]
