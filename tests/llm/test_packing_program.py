"""op4: the program places nearly all tokens, and parts of text are encoded together with the same ids."""

import numpy as np

from compoundry.llm import packing
from compoundry.llm.queries import tokenizer


def test_the_program_places_nearly_all_tokens():
    lengths, counts = np.unique(np.random.default_rng(5).integers(1, 2049, 40_000), return_counts=True)
    h = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    total = sum(x * n for x, n in h.items())
    taken = packing.fractional(h, 2048)
    used = {}
    for held, times in taken:
        for x, k in held.items():
            used[x] = used.get(x, 0) + k * times
    assert all(n <= h[x] for x, n in used.items())
    assert sum(x * n for x, n in used.items()) >= 0.9 * total
    assert packing.plan(h).n_sequences <= -(-total // 2048) * 1.004


def test_lengths_that_fill_no_sequence_are_placed_too():
    assert packing.plan({700: 1000}).n_sequences == 500
    assert sum(700 * 2 * times for _, times in packing.fractional({700: 1000}, 2048)) == 700_000


def test_parts_are_encoded_together_with_the_same_ids():
    ids = packing.Ids(tokenizer("byte_bpe_50k.json"))
    parts = [f" w{k}é{k * 7}" for k in range(1000)] + ["start", " ", "\n\n", "  two", "\n\nline", " 日本", "a​", " <|", " é"]
    asked = []
    plain = ids.library.encode_batch_fast

    class Counted:
        def __getattr__(self, name):
            return getattr(library, name)

        def encode_batch_fast(self, texts, **named):
            asked.extend(texts)
            return plain(texts, **named)

    library, ids.library = ids.library, Counted()
    made = ids.parts(parts)
    assert len(asked) < 20
    assert made == dict(zip(parts, ids.raw(parts), strict=True))
    assert ids.parts([]) == {} and ids.parts(["x"]) == {"x": ids.raw(["x"])[0]}
