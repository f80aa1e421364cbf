"""op11: the backward pass needs no sums of its own, because the scales of the forward pass hold there as well."""

import numpy as np

from compoundry.llm import markov


def test_scaled_weights_add_up_to_the_tokens():
    rng = np.random.default_rng(3)
    model = markov.first_model(np.full(50, 1 / 50), 1e-4, 4)
    lengths = np.array([1, 7, 600, 1300, 512, 30])
    observed = rng.integers(0, 51, lengths.sum())
    found = markov.Expected(model)
    found.add(observed, lengths)
    assert np.isclose(found.emit.sum(), lengths.sum(), rtol=1e-10)
    # a move before every token, the first of a text from the state before it
    assert np.isclose(found.move.sum(), lengths.sum(), rtol=1e-10)
    assert np.isclose(found.start.sum(), len(lengths), rtol=1e-10)
    assert np.isclose(found.log, markov.log_likelihood(model, observed, lengths).sum(), rtol=1e-12)
    pieces = markov.Pieces(observed[:8], np.array([1, 7]))
    obs, runs = pieces.at(slice(None))
    total, kept = markov.forward(model, obs, runs, np.full((2, 4), 0.25), keep=True)
    weights, emitted, scale = kept[0]
    assert weights.shape == emitted.shape == (2, 4) and np.allclose(weights.sum(axis=1), 1)
    assert np.isclose(sum(np.log(s).sum() for _, _, s in kept), total.sum())
