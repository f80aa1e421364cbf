"""Best-fit packing of token pieces into sequences by a configuration linear program.

Only the histogram of piece lengths (at most one count for each length up to the sequence length) reaches the driver.
There a covering program over configurations (multisets of lengths that fit one sequence) is solved by
multiplicative weights: each length has a price, at first its share of a sequence; a knapsack dynamic program finds
the dearest configuration with each length that is still open; it is taken as often as a share of its scarcest length
allows, and prices of what it covers fall. The solution is rounded down, and what is left over goes, longest first, where it fits best:
into gaps of the rounded configurations, else into new ones. Everything is done on counts, so its cost does not
hang on the number of documents.

Pieces then get their places in Spark: a piece's rank among those of its length picks its slot in the plan.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, durable, strings

LENGTH = 2048
#: Rounds of the program at most; the share of a configuration's scarcest length that is taken at once; by what part the
#: price of a length falls until it is covered, and its factor where a configuration asks for more of it than is left.
ROUNDS, SHARE, STEP, SCARCE = 160, 0.25, 0.133, 0.9
#: By how much more a long length counts at first: less than one unused place of a sequence, so that it only decides ties.
TIE = 1e-4
#: Parts of text whose ids a Python worker remembers; at that number it forgets all of them.
MOST_PARTS = 600_000
#: Parts that are given to the library as one text.
TOGETHER = 256

# White space other than blanks and line ends; texts with it go to the library as they are.
_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_PART = re.compile(r"[ \n]*[^ \n]+|[ \n]+")


class Ids:
    """Token ids of whole texts by a byte-level tokenizer file; parts between blanks are encoded once each.

    A word never reaches from a visible character into the blank behind it, so a text is cut there. Special strings
    and unusual white space are left to the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        vocabulary = self.library.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, n in vocabulary.items():  # a character of a token stands for a byte
            self.n_bytes[n] = len(token)

    def raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def parts(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of each part. Those that begin with a blank are given to the library TOGETHER at a time, as a text of
        them would be cut there, and their ids are told apart by the bytes they stand for; where that does not come out
        even, and where a special string may arise, each is given alone."""
        follow, alone = [], []
        several = not any(c in s for s in self.special for c in " \n")
        for p in parts:
            (follow if several and p[0] in " \n" and p[-1] not in " \n" else alone).append(p)
        made = dict(zip(alone, self.raw(alone), strict=True))
        if not follow:
            return made
        texts = ["".join(follow[k: k + TOGETHER]) for k in range(0, len(follow), TOGETHER)]
        ids = np.concatenate([
            np.array(e.ids, "<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)])
        reached = np.cumsum(self.n_bytes[ids])
        wanted = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in follow], dtype=np.int64)
        ends = np.searchsorted(reached, wanted)
        if reached[-1] != wanted[-1] or (reached[ends] != wanted).any():
            return made | dict(zip(follow, self.raw(follow), strict=True))
        flat = ids.tobytes()
        made.update(zip(follow, [flat[a:b] for a, b in pairwise([0, *(4 * ends + 4).tolist()])], strict=True))
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        claim("packing", self.known.clear)
        if len(self.known) > MOST_PARTS:
            self.known.clear()
        cut = [None if _OTHER_SPACE.search(t) or any(s in t for s in self.special) else _PART.findall(t) for t in texts]
        known = self.known
        new = [p for p in set().union(*filter(None, cut)) if p not in known]
        known.update(self.parts(new))
        get = known.__getitem__
        return [self.raw([t])[0] if parts is None else b"".join(map(get, parts))
                for t, parts in zip(texts, cut, strict=True)]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Ids:
    return Ids(path)


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = 0, text: str = "text",
           doc_id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row for each piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``), with
    ``part`` and ``local``: the task and the rank there among pieces of that length.

    Documents longer than ``length`` are cut into pieces of it; the first takes the remainder. A null or empty text
    is one piece of the end id alone. Repeated rows are packed each.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, local long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows, made = [], []
            for i, raw in enumerate(tokenizer(path).encode(strings(batch, "text"))):
                raw += end
                n, a, k = len(raw) // 4, 0, 0
                while a < n:
                    b = a + ((n - 1) % length + 1 if k == 0 else length)
                    own = raw[4 * a: 4 * b]
                    rows.append((i, k, a, b - a, zlib.crc32(own), part, seen[b - a]))
                    if with_ids:
                        made.append(np.frombuffer(own, "<u4").astype(np.int64))
                    seen[b - a] += 1
                    a, k = b, k + 1
            if not rows:
                continue
            row, k, a, n, crc, p, rank = map(np.array, zip(*rows, strict=True))
            out = [batch.column(0).take(pa.array(row)), pa.array(k, pa.int32()), pa.array(a, pa.int64()),
                   pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(p, pa.int32()), pa.array(rank, pa.int64())]
            if with_ids:
                out.append(pa.array(made, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema += ", ids array<bigint>" if with_ids else ""
    names = [c.strip().split(" ")[0] for c in schema.split(", ")]
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def dearest(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """For each capacity up to this one the length that the dearest configuration takes last, or 0 where it leaves a
    place empty. ``lengths`` rise."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := fits[c]:
            with_one = best[c - lengths[:n]] + prices[:n]
            k = int(with_one.argmax())
            if with_one[k] > best[c] + 1e-12:
                best[c], last[c] = with_one[k], lengths[k]
    return last


def holding(last: np.ndarray, capacity: int) -> dict[int, int]:
    """How often the dearest configuration of this capacity holds each length."""
    found: dict[int, int] = {}
    c = capacity
    while c > 0:
        if last[c]:
            found[int(last[c])] = found.get(int(last[c]), 0) + 1
            c -= int(last[c])
        else:
            c -= 1
    return found


def knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of highest price: how often it holds each length. ``lengths`` rise."""
    return holding(dearest(prices, lengths, capacity), capacity)


def fractional(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often each is taken, covering at most the histogram, and nearly all of it.

    A round makes one table of dearest configurations and reads from it the dearest one with each of the longer half of
    the lengths not yet covered, the longest first, so that short ones are not used up among themselves. At first only full configurations are taken; a round that takes none allows more unused places.
    """
    lengths = np.array(sorted(histogram), np.int64)
    need = np.array([histogram[x] for x in lengths.tolist()], float)
    at = {int(x): k for k, x in enumerate(lengths)}
    covered, prices = np.zeros(len(lengths)), lengths / capacity * (1 + TIE * lengths / capacity)
    taken: list[tuple[dict[int, int], float]] = []
    unused = 0
    for _ in range(ROUNDS):
        open_ = covered < need
        if not open_.any():
            break
        last, before = dearest(prices[open_], lengths[open_], capacity), len(taken)
        some = lengths[open_][::-1]
        for x in some[: -(-len(some) // 2)].tolist():
            found = holding(last, capacity - x)
            found[x] = found.get(x, 0) + 1
            if sum(n * k for n, k in found.items()) < capacity - unused:
                continue
            where = np.array([at[n] for n in found])
            times = np.array(list(found.values()), float)
            room = need[where] - covered[where]
            # A share of the scarcest length, but its whole rest where little of it is there.
            step = min((room // times).min(), max(1.0, (SHARE * need[where] // times).min()))
            if step < 1:  # of some lengths too few are left: the next table takes them less often
                prices[where[room < times]] *= SCARCE
                continue
            taken.append((found, step))
            covered[where] += times * step
            prices[where] *= (1 - STEP) ** (times * step / need[where])
        if len(taken) == before:
            unused = max(1, 2 * unused)
    return taken


@dataclass
class Plan:
    """For each length, runs of slots: rank ``first`` of the length goes to ``sequence`` at ``offset``, and so on."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    n_sequences: int


def plan(histogram: dict[int, int], capacity: int = LENGTH) -> Plan:
    """The best of three ways to round: with all configurations of the program, its full ones only, or none."""
    found = fractional(histogram, capacity)
    full = [(held, times) for held, times in found if sum(x * k for x, k in held.items()) == capacity]
    plans = [rounded(histogram, some, capacity) for some in (found, full, [])]
    return min(plans, key=lambda p: p.n_sequences)


def rounded(histogram: dict[int, int], taken: list[tuple[dict[int, int], float]], capacity: int) -> Plan:
    """Round the program down and put what is left where it fits best."""
    left = dict(histogram)
    groups: list[tuple[list[int], int]] = []  # the lengths in a sequence, and how many such sequences
    for found, times in taken:
        n = min(int(times + 1e-9), *(left[x] // k for x, k in found.items()))
        if n > 0:
            groups.append(([x for x, k in sorted(found.items(), reverse=True) for _ in range(k)], n))
            for x, k in found.items():
                left[x] -= k * n
    gaps: dict[int, list[tuple[list[int], int]]] = {}
    for lengths, n in groups:
        gaps.setdefault(capacity - sum(lengths), []).append((lengths, n))
    for x in sorted((x for x in left if left[x]), reverse=True):
        n = left[x]
        while n:
            gap = next((g for g in range(x, capacity) if gaps.get(g)), None)
            if gap is None:
                many = capacity // x
                full, rest = divmod(n, many)
                for k, c in ((many, full), (rest, 1)):
                    if k and c:
                        gaps.setdefault(capacity - k * x, []).append(([x] * k, c))
                break
            lengths, c = gaps[gap].pop()
            used = min(c, n)
            gaps.setdefault(gap - x, []).append(([*lengths, x], used))
            if c > used:
                gaps[gap].append((lengths, c - used))
            n -= used
    rows, base, seen = [], 0, {}
    for lengths, n in (group for some in gaps.values() for group in some):
        offset = 0
        for x in lengths:
            rows.append((x, seen.get(x, 0), base, offset))
            seen[x] = seen.get(x, 0) + n
            offset += x
        base += n
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return Plan(*columns, base)


def placed(made: DataFrame, capacity: int = LENGTH) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``made`` must be a written table, as it is read three times.

    Ranks of a length over all tasks: counts by task are summed up before they are joined, so one length may hold
    any part of the rows. An empty table gives no rows.
    """
    from pyspark.sql import Window

    counts = made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    p = plan(histogram, capacity)
    key = (p.length << 44) + p.first
    ranked = made.join(base, ["length", "part"]).withColumn("rank", F.col("base") + F.col("local"))
    names = [c for c in made.columns if c not in ("part", "local")]
    kept = ", ".join(f"{c} {made.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c))
            length, rank = column("length").to_numpy(), column("rank").to_numpy()
            k = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*map(column, names), pa.array(p.sequence[k] + rank - p.first[k]), pa.array(p.offset[k])],
                names=[*names, "sequence_id", "offset"])

    return ranked.select(*names, "rank").mapInArrow(run, f"{kept}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = False, **named: str) -> DataFrame:
    """Cut, plan and place: the rows of ``pieces`` with ``sequence_id`` and ``offset`` (gapless from 0)."""
    return placed(durable(pieces(docs, path, length, with_ids=with_ids, **named), "pieces"), length)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` of each sequence, from pieces packed with ids; a sequence is bounded by its length."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
