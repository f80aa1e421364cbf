"""A hidden Markov language model, trained by Baum-Welch over all training tokens.

A latent state moves by a transition matrix before every token and emits the token's class; the class (a hash of the
word) emits the word. P(word | state) = (1 - u) * P(class | state) * (c + 0.5) / (sum of c + 0.5 over the class), and u for any
unknown word, where c is the word's count in training and u the share that additive smoothing leaves to one unknown
word. With a single state this is the smoothed unigram model. Word counts grow with the corpus and stay in Spark; the
latent part has CLASSES * STATES numbers at any size.

1. ``encode`` cuts texts into tokens once. Some texts of a task make a tile, with a list of its distinct words; texts
   become numbers of that list, and class numbers.
2. ``train`` holds expected counts of every task against the model of the round before, and adds them up in Spark.
3. ``score`` asks for the count of each word once for a tile, brings counts and texts of a tile together and runs the
   scaled forward recursion.

The recursion works on pieces of PIECE tokens side by side. The pieces of a long text are tied by their transfer
matrices, so a likelihood is that of the whole sequence, and a text of any length takes bounded memory a piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, strings

STATES, CLASSES, ROUNDS = 8, 8192, 5
#: Tokens of a piece; pieces that are worked on at a time: few enough for their products to be made by one thread.
PIECE, BLOCK = 512, 1024
#: Places after which transfer matrices are scaled again.
SCALE_EVERY = 8
#: A tile ends after the batch with which it reaches so many tokens, or distinct words.
TILE_TOKENS, TILE_WORDS = 6_000_000, 500_000
#: Shares of the class frequencies in every state's emissions, and of even moves in every state's transitions.
SMOOTH, MIX = 0.05, 0.001
END = b""


class Model:
    """``start`` (state before the first token), ``move`` [from, to], ``emit`` [class, state]; the last row of ``emit``
    is the unknown word, which every state emits alike."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, unknown: float):
        self.start, self.move = start, move
        self.emit = np.vstack((emit * (1 - unknown), np.full((1, len(start)), unknown)))


def first_model(frequency: np.ndarray, unknown: float, states: int = STATES) -> Model:
    """States that differ by chance from the class frequencies (the same in every run)."""
    chance = np.random.default_rng(7).uniform(0.5, 1.5, (len(frequency), states))
    emit = frequency[:, None] * chance
    total = emit.sum(axis=0)
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / np.where(total > 0, total, 1), unknown)


class Pieces:
    """The texts of a batch, cut into pieces; pieces are held by falling length, so that at any place those that still
    run are the first ones."""

    def __init__(self, observed: np.ndarray, lengths: np.ndarray):
        self.observed = observed
        n = -(-lengths // PIECE)
        self.text = np.repeat(np.arange(len(lengths)), n)
        self.number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)  # of the piece in its text
        begin = np.cumsum(lengths) - lengths
        self.begin = begin[self.text] + self.number * PIECE
        self.length = np.minimum(PIECE, np.repeat(lengths, n) - self.number * PIECE)
        order = np.argsort(-self.length, kind="stable")
        self.text, self.number, self.begin, self.length = (
            v[order] for v in (self.text, self.number, self.begin, self.length))
        self.pieces = n  # by text

    def at(self, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """Observations [place, piece] of some pieces, and how many of them run at each place."""
        begin, length = self.begin[part], self.length[part]
        wide = int(length[0])
        where = np.minimum(begin[None, :] + np.arange(wide)[:, None], len(self.observed) - 1)
        return self.observed[where], np.searchsorted(-length, -np.arange(wide), side="left")


def transfer(model: Model, obs: np.ndarray, runs: np.ndarray, n: int) -> np.ndarray:
    """For each piece a multiple of the matrix that takes state weights before it to those after it."""
    states = len(model.start)
    m = np.broadcast_to(np.eye(states), (n, states, states)).copy()
    spare = np.empty_like(m)
    for t, k in enumerate(runs):
        x = spare[:k]
        np.matmul(m[:k].reshape(-1, states), model.move, out=x.reshape(-1, states))
        np.multiply(x, model.emit[obs[t, :k]][:, None, :], out=m[:k])
        if t % SCALE_EVERY == 0:
            m[:k] /= np.einsum("nst->n", m[:k])[:, None, None]
    return m / m.sum(axis=(1, 2))[:, None, None]


def borders(model: Model, pieces: Pieces, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """State weights before each piece and, with ``both``, what follows it is worth to each state after it."""
    n, states = len(pieces.text), len(model.start)
    before, after = np.broadcast_to(model.start, (n, states)).copy(), np.ones((n, states))
    several = np.nonzero(pieces.pieces[pieces.text] > 1)[0]
    if not len(several):
        return before, after
    moves = np.zeros((len(several), states, states))
    for k in range(0, len(several), BLOCK):
        # these are in falling length as well
        some = several[k: k + BLOCK]
        part = Pieces.__new__(Pieces)
        part.observed, part.begin, part.length = pieces.observed, pieces.begin[some], pieces.length[some]
        obs, runs = part.at(slice(None))
        moves[k: k + BLOCK] = transfer(model, obs, runs, len(some))
    # place of every piece in (text, number) order
    order = several[np.lexsort((pieces.number[several], pieces.text[several]))]
    place = np.zeros(n, int)
    place[several] = np.arange(len(several))
    number, last = pieces.number[order], pieces.pieces[pieces.text[order]] - 1
    for k in range(1, int(number.max()) + 1):
        here = np.nonzero(number == k)[0]
        x = np.einsum("ns,nst->nt", before[order[here - 1]], moves[place[order[here - 1]]])
        before[order[here]] = x / x.sum(axis=1)[:, None]
    if both:
        for k in range(int(last.max()) - 1, -1, -1):
            here = np.nonzero((number == k) & (k < last))[0]
            x = np.einsum("nst,nt->ns", moves[place[order[here + 1]]], after[order[here + 1]])
            after[order[here]] = x / x.sum(axis=1)[:, None]
    return before, after


def forward(model: Model, obs: np.ndarray, runs: np.ndarray, before: np.ndarray, keep: bool) -> tuple[np.ndarray, list[tuple]]:
    """The log likelihood of each piece, and with ``keep`` for each place the state weights after it, the emissions and
    the scale (the probability of the observation there, given those before it)."""
    now, scales, kept = before.copy(), np.ones(obs.shape), []
    every = np.ones(len(model.start))
    for t, k in enumerate(runs):
        emitted = model.emit[obs[t, :k]]
        x = now[:k] @ model.move
        x *= emitted
        scale = np.matmul(x, every, out=scales[t, :k])
        x /= scale[:, None]
        now[:k] = x
        if keep:
            kept.append((x, emitted, scale))
    return np.log(scales).sum(axis=0), kept


def log_likelihood(model: Model, observed: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each text, whose observations (classes) follow one another."""
    pieces = Pieces(observed, lengths)
    before, _ = borders(model, pieces, both=False)
    out = np.zeros(len(lengths))
    for k in range(0, len(pieces.text), BLOCK):
        part = slice(k, k + BLOCK)
        obs, runs = pieces.at(part)
        total, _ = forward(model, obs, runs, before[part], keep=False)
        np.add.at(out, pieces.text[part], total)
    return out


class Expected:
    """Expected counts of a model's starts, moves and emissions, and the log likelihood, of the texts added."""

    def __init__(self, model: Model):
        self.model, states = model, len(model.start)
        self.start, self.move, self.emit = np.zeros(states), np.zeros((states, states)), np.zeros((len(model.emit), states))
        self.log = 0.0

    def add(self, observed: np.ndarray, lengths: np.ndarray) -> None:
        pieces = Pieces(observed, lengths)
        before, after = borders(self.model, pieces, both=True)
        for k in range(0, len(pieces.text), BLOCK):
            part = slice(k, k + BLOCK)
            self._part(pieces, part, before[part], after[part])

    def _part(self, pieces: Pieces, part: slice, before: np.ndarray, after: np.ndarray) -> None:
        model, states = self.model, len(self.model.start)
        obs, runs = pieces.at(part)
        total, kept = forward(model, obs, runs, before, keep=True)
        self.log += total.sum()
        # Scaled so that with the state weights of the last place it adds up to one; divided by the scales of the forward
        # pass it does so at every place, and no place needs a sum of its own.
        ends = np.empty_like(before)
        for t, k in enumerate(runs):
            stop = runs[t + 1] if t + 1 < len(runs) else 0
            ends[stop:k] = kept[t][0][stop:k]
        worth = after / (ends * after).sum(axis=1)[:, None]
        seen, weights, moved = [], [], np.zeros((states, states))
        for t in range(len(runs) - 1, -1, -1):
            k = runs[t]
            own, emitted, scale = kept[t]
            weights.append(own * worth[:k])
            seen.append(obs[t, :k])
            y = emitted
            y *= worth[:k]
            y /= scale[:, None]
            moved += (kept[t - 1][0] if t else before)[:k].T @ y
            np.matmul(y, model.move.T, out=worth[:k])
        self.move += model.move * moved
        first = pieces.number[part] == 0
        held = before[first] * worth[first]
        self.start += (held / held.sum(axis=1)[:, None]).sum(axis=0)
        seen, weights = np.concatenate(seen), np.concatenate(weights)
        for s, w in enumerate(np.ascontiguousarray(weights.T)):
            self.emit[:, s] += np.bincount(seen, weights=w, minlength=len(self.emit))


def better(start: np.ndarray, move: np.ndarray, emit: np.ndarray, frequency: np.ndarray, unknown: float) -> Model:
    """The model of expected counts, smoothed by class frequencies and even moves."""
    states = len(start)

    def shares(x: np.ndarray, axis: int, otherwise: np.ndarray) -> np.ndarray:
        total = x.sum(axis=axis, keepdims=True)
        return np.where(total > 0, x / np.where(total > 0, total, 1), otherwise)

    even = np.full(states, 1 / states)
    return Model(
        (1 - MIX) * shares(start, 0, even) + MIX * even,
        (1 - MIX) * shares(move, 1, even[None, :]) + MIX / states,
        (1 - SMOOTH) * shares(emit, 0, frequency[:, None]) + SMOOTH * frequency[:, None], unknown)


class Words(dict):
    """Numbers of words in the order of their first appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def packed(codes: np.ndarray) -> bytes:
    """Numbers below 2^32, byte plane by byte plane: the upper planes are mostly zero and cost little when stored."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the parts, and how many each has."""
    found = [np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(4, -1).T).view("<u4").ravel() for p in parts]
    return np.concatenate(found).astype(np.int64), np.array([len(f) for f in found])


def encode(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts (``codes`` not null) with ``doc_id``, ``held_out`` and, packed, the code of every token; and lists with
    ``word``, ``code`` and ``n`` (in training texts of the tile). Both have ``tile``. A code is the class of a word plus
    CLASSES times its place among the words of that class in its tile. A null text is empty. The result is written to the
    shared folder."""
    own = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    schema = f"tile long, doc_id {own}, held_out boolean, codes binary, word binary, code long, n long"
    names = [part.split(" ")[0] for part in schema.split(", ")]
    kinds: list[pa.DataType] = [pa.int64(), None, pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, words, tokens = TaskContext.get().partitionId() << 32, Words(), 0
        codes, count, used = np.zeros(0, np.int64), np.zeros(0, np.int64), [0] * CLASSES
        for batch in batches:
            of = [batch.schema.field("doc_id").type if k is None else k for k in kinds]

            def made(n: int, columns: dict, of: list = of, tile: int = tile) -> pa.RecordBatch:
                full = {"tile": np.full(n, tile)} | columns
                return pa.RecordBatch.from_arrays(
                    [pa.array(full[c], k) if c in full else pa.nulls(n, k) for c, k in zip(names, of, strict=True)], names=names)

            cut = [t.encode().lower().split() for t in strings(batch, "text")]
            ids = [np.fromiter(map(words.__getitem__, [*w, END]), np.int32, len(w) + 1) for w in cut]
            new = []
            for w in list(words)[len(codes):]:
                k = xxhash.xxh64_intdigest(w) % CLASSES
                new.append(k + CLASSES * used[k])
                used[k] += 1
            codes = np.concatenate((codes, np.array(new, np.int64)))
            held = batch.column(1).to_pylist()
            learnt = [np.zeros(0, np.int32), *[x for x, h in zip(ids, held, strict=True) if not h]]
            count = np.concatenate((count, np.zeros(len(new), np.int64))) + np.bincount(np.concatenate(learnt), minlength=len(codes))
            if ids:
                yield made(len(ids), {"doc_id": batch.column(0), "held_out": held, "codes": [packed(codes[x]) for x in ids]})
            tokens += sum(map(len, ids))
            if tokens >= TILE_TOKENS or len(words) >= TILE_WORDS:
                yield from listed(made, words, codes, count)
                tile, words, tokens = tile + 1, Words(), 0
                codes, count, used = np.zeros(0, np.int64), np.zeros(0, np.int64), [0] * CLASSES
        if words:
            yield from listed(made, words, codes, count)

    return durable(rows.mapInArrow(run, schema), "tokens")


def listed(made: Callable[[int, dict], pa.RecordBatch], words: Words, codes: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The list of a tile as rows."""
    order = list(words)
    for k in range(0, len(order), 50_000):
        part = order[k: k + 50_000]
        yield made(len(part), {"word": part, "code": codes[k: k + 50_000], "n": count[k: k + 50_000]})


def word_counts(coded: DataFrame) -> DataFrame:
    """``word``, ``class`` and ``c`` of every training word, written to the shared folder."""
    return durable(coded.filter("n > 0").groupBy("word").agg(
        F.sum("n").alias("c"), F.first(F.col("code") % CLASSES).cast("int").alias("class")), "counts")


class Totals:
    """Training tokens ``n``, distinct ones ``v``, and for each class the sum of c + 0.5 over its words."""

    def __init__(self, counts: DataFrame):
        rows = counts.groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
        self.n, self.v = sum(r["c"] for r in rows), sum(r["v"] for r in rows)
        self.weight = np.zeros(CLASSES)
        for r in rows:
            self.weight[r["class"]] = r["c"] + 0.5 * r["v"]
        self.unknown = 0.5 / (self.n + 0.5 * (self.v + 1))
        self.frequency = self.weight / max(self.weight.sum(), 1)


def train(coded: DataFrame, totals: Totals, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """The model after ``rounds`` rounds of Baum-Welch over all texts that are not held out, and the log likelihood of
    these (of classes) before each round. The driver gets the sums only: CLASSES + STATES + 2 rows."""
    texts = coded.filter("codes is not null and not held_out").select("codes")
    names = [f"s{k}" for k in range(states)]
    schema = "key int, " + ", ".join(f"{c} double" for c in names)
    model, logs = first_model(totals.frequency, totals.unknown, states), []
    for _ in range(rounds if totals.n else 0):
        now = model

        def run(batches: Iterator[pa.RecordBatch], now: Model = now) -> Iterator[pa.RecordBatch]:
            expected = Expected(now)
            for batch in batches:
                if batch.num_rows:
                    codes, lengths = unpacked(batch.column(0).to_pylist())
                    expected.add(codes % CLASSES, lengths)
            log = np.zeros((1, states))
            log[0, 0] = expected.log
            rows = np.vstack((expected.emit[:CLASSES], expected.move, expected.start[None, :], log))
            keys = np.nonzero(rows.any(axis=1))[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.astype(np.int32)), *[pa.array(rows[keys, k]) for k in range(states)]], names=["key", *names])

        sums = np.zeros((CLASSES + states + 2, states))
        for r in texts.mapInArrow(run, schema).groupBy("key").agg(*[F.sum(c).alias(c) for c in names]).collect():
            sums[r["key"]] = r[1:]
        logs.append(float(sums[-1, 0]))
        model = better(sums[-2], sums[CLASSES: CLASSES + states], sums[:CLASSES], totals.frequency, totals.unknown)
    return model, logs


def score(coded: DataFrame, counts: DataFrame, totals: Totals, model: Model) -> DataFrame:
    """For every text ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (tokens seen in training), ``base_score``
    (smoothed unigram) and ``score`` (this model's), both log10 probabilities of the whole text."""
    own = coded.schema["doc_id"].dataType.simpleString()
    inner = f"struct<doc_id: {own}, held_out: boolean, codes: binary>"
    lists = coded.filter("word is not null").select("tile", "code", "word").join(counts.select("word", "c"), "word").select(
        "tile", "code", "c", F.lit(None).cast(inner).alias("text"))
    texts = coded.filter("codes is not null").select(
        "tile", F.lit(None).cast("long").alias("code"), F.lit(None).cast("long").alias("c"),
        F.struct("doc_id", "held_out", "codes").alias("text"))
    dealt = lists.unionByName(texts).repartition("tile").sortWithinPartitions("tile", F.col("code").asc_nulls_last())
    schema = f"doc_id {own}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    names = [part.split(" ")[0] for part in schema.split(", ")]
    whole = np.log10(totals.n + 0.5 * (totals.v + 1))
    weight = np.log10(np.where(totals.weight > 0, totals.weight, 1))

    def scored(texts: pa.StructArray, c: np.ndarray) -> pa.RecordBatch:
        codes, lengths = unpacked(texts.field(2).to_pylist())
        begin = np.cumsum(lengths) - lengths
        if len(c) <= codes.max():  # codes of words without a training count
            c = np.concatenate((c, np.zeros(codes.max() + 1 - len(c))))
        of, known = codes % CLASSES, c[codes] > 0
        logs = np.log10(c[codes] + 0.5)
        base = np.add.reduceat(logs, begin) - lengths * whole
        inside = np.add.reduceat(np.where(known, logs - weight[of], 0), begin)
        latent = log_likelihood(model, np.where(known, of, CLASSES), lengths) / np.log(10)
        return pa.RecordBatch.from_arrays([
            texts.field(0), texts.field(1), pa.array(lengths), pa.array(np.add.reduceat(known.astype(np.int64), begin)),
            pa.array(base), pa.array(inside + latent)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, c = None, [], np.zeros(0)
        for batch in batches:
            tiles, is_text = batch.column(0).to_numpy(), batch.column(1).is_null().to_numpy(zero_copy_only=False)
            edges = np.nonzero((np.diff(tiles) != 0) | (np.diff(is_text.astype(np.int8)) != 0))[0] + 1
            for first, last in zip([0, *edges], [*edges, len(tiles)], strict=True):
                if first == last:
                    continue
                part = batch.slice(first, last - first)
                if tiles[first] != now:
                    now, held, c = tiles[first], [], np.zeros(0)
                if not is_text[first]:
                    held.append([part.column(k).to_numpy() for k in (1, 2)])
                    continue
                if held:
                    codes, n = (np.concatenate(v) for v in zip(*held, strict=True))
                    c, held = np.zeros(codes.max() + 1), []
                    c[codes] = n
                yield scored(part.column(3), c)

    return dealt.mapInArrow(run, schema)


def learn_and_score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text",
                    states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Learn from the rows that are not ``held_out`` and score all: the columns of ``score`` and ``train_tokens``.

    Tokens are the words of a text, A-Z lower-cased, and one end. A null or empty text is the end alone; a null
    ``held_out`` counts as false. Repeated rows count and are scored as often as they stand. Without training rows
    every token is unknown and has probability 1. An empty table gives no rows; other columns are not read.
    """
    coded = encode(docs, F.coalesce(held_out, F.lit(False)), doc_id, text)
    counts = word_counts(coded)
    totals = Totals(counts)
    model, _ = train(coded, totals, states, rounds)
    return score(coded, counts, totals, model).withColumn("train_tokens", F.lit(totals.n).cast("long"))
