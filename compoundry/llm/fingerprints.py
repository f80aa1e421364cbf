"""Document fingerprints by MinHash: universal hash permutations over word shingles, in vectorised numpy.

``in_order`` gives every document's fingerprint, and its likeness to the next document and to itself with its end
replaced by that document's beginning. ``classes`` finds near copies: signature bands are joined in Spark and links
are verified by the Jaccard similarity of full sets (see ``minmax`` for how hot buckets are dealt with). ``whole``
gives both, row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import minmax
from .common import flagged
from .shingles import U, constants, mix, word_hashes

SHINGLE = 5
PERMUTATIONS = 128
CHUNK = 8192
BLANK = " \t\n\x0b\x0c\r"
LEAST = -(2**63)
#: 25 bands of 5 values of the first 125: a similarity of 0.85 is missed by all with a chance of 1e-6, 0.80 of 5e-5.
BANDS, ROWS = 25, 5

_A = (constants(303, PERMUTATIONS) >> U(32)).astype(np.uint32) | np.uint32(1)
_B = (constants(404, PERMUTATIONS) >> U(32)).astype(np.uint32)
_C = constants(11, SHINGLE)


def shingle_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of a sequence of word hashes, repeated ones too; of a short one its whole sequence."""
    n = len(h)
    if n < SHINGLE:
        return mix(np.array([(h * _C[:n]).sum() + U(n)], U)) if n else h
    total = h[: n - SHINGLE + 1] * _C[0]
    for k in range(1, SHINGLE):
        total += h[k: n - SHINGLE + 1 + k] * _C[k]
    return mix(total)


def signature(h: np.ndarray) -> np.ndarray:
    """Least value of the shingle hashes under each permutation; all ones for none."""
    low = np.full(PERMUTATIONS, 2**32 - 1, np.uint32)
    h = (h >> U(32)).astype(np.uint32)
    for k in range(0, len(h), CHUNK):
        np.minimum(low, (h[None, k: k + CHUNK] * _A[:, None] + _B[:, None]).min(axis=1), out=low)
    return low


def digest(low: np.ndarray) -> np.ndarray:
    """16 bits of each least value."""
    return (mix(low.astype(U)) & U(0xFFFF)).astype(">u2")


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    return float((x == y).mean())


def head_and_tail(text: str, cut: int) -> tuple[list[bytes], str]:
    """The words that lie whole in the first ``cut`` characters, and the part of a word that the cut touches."""
    head = text[:cut]
    words = head.encode().lower().split()
    if not words or head[-1] in BLANK:
        return words, ""
    return words[:-1], words[-1].decode()


def compare(text: str, after: str) -> tuple[np.ndarray, np.ndarray, str]:
    """Signatures of a text and of its edited text, and the digest of the latter.

    The whole words before the cut are hashed once for both; only what follows differs.
    """
    n = len(text)
    cut = n - n // 3
    words, rest = head_and_tail(text, cut)
    shared = word_hashes(words)
    stem = shingle_hashes(shared) if len(shared) >= SHINGLE else shared[:0]
    low = signature(stem)

    def whole(tail: str) -> np.ndarray:
        more = word_hashes((rest + tail).encode().lower().split())
        if len(shared) + len(more) < SHINGLE:
            return signature(shingle_hashes(np.concatenate((shared, more))))
        if not len(more):
            return low
        h = np.concatenate((shared[-(SHINGLE - 1):], more))
        return np.minimum(low, signature(shingle_hashes(h)) if len(h) >= SHINGLE else low)

    edit = after[: n // 3]
    return whole(text[cut:]), whole(edit), hashlib.sha256((text[:cut] + edit).encode()).hexdigest()


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int | None = None,
             carried: tuple[str, ...] = ()) -> DataFrame:
    """For every row ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next``; the next document is the one of the next smaller id, after the last the first.

    Null texts count as empty; rows with a null id come last, rows of one id by text; a single row is its own next.
    Texts are dealt out once, by ranges of ids; the first row of a range goes to the range before it too. Only the
    bounds and the greatest id of each range reach the driver, as many as there are partitions. Columns ``carried`` stay
    with their row and come last.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.struct(*carried, F.lit(0).alias("_")).alias("carried"),
                       F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST)).alias("key"))
    bounds = sorted(set(map(int, rows.select("key").approxQuantile(
        "key", [k / parts for k in range(1, parts)], 0.2 / parts)))) if parts > 1 else []
    place = F.size(F.filter(F.expr(f"array({','.join(map(str, bounds))})").cast("array<bigint>"), lambda b: b < F.col("key"))) \
        if bounds else F.lit(0)
    rows = rows.withColumn("place", place)
    tops = sorted((r["place"], r["top"]) for r in rows.groupBy("place").agg(F.max("key").alias("top")).collect())
    # The first row of a range is a guest in the next higher range; that of the highest, in the lowest.
    guests = [(top, tops[(k + 1) % len(tops)][0]) for k, (_, top) in enumerate(tops)]
    hosts = F.broadcast(spark.createDataFrame(guests, "key long, host int"))
    visiting = rows.join(hosts, "key", "left")
    both = visiting.select("doc_id", "text", "carried", "key", F.explode(F.when(F.col("host").isNull(), F.array(
        F.struct(F.col("place").alias("place"), F.lit(0).alias("guest")))).otherwise(F.array(
            F.struct(F.col("place").alias("place"), F.lit(0).alias("guest")),
            F.struct(F.col("host").alias("place"), F.lit(1).alias("guest"))))).alias("at"))
    dealt = both.select("doc_id", "text", "carried", "key", "at.place", "at.guest").repartitionById(len(bounds) + 1, F.col("place"))
    ordered = dealt.sortWithinPartitions("place", "guest", F.desc("key"), "text").select(
        "doc_id", "text", "place", "guest", "carried")
    add = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    add += "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    names = ["doc_id", *[c.split(" ")[0].strip("`") for c in add.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: its id, text, place and what it carries

        last = None  # what was found of the row before it, still without its likeness to the held row

        for batch in batches:
            done = []
            for i, t, place, guest, own in zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True):
                if held is not None and held[2] == place:
                    low, edited, sha = compare(held[1], t)
                    x, y = digest(low), digest(edited)
                    if last is not None:
                        done.append((*last[0], likeness(last[1], x), *last[2]))
                    last = ((held[0], len(held[1]), sha, x.tobytes().hex(), y.tobytes().hex(), likeness(x, y)), x, [held[3][c] for c in carried])
                if guest and last is not None:  # the end of a range: its last row is followed by the first guest
                    done.append((*last[0], likeness(last[1], digest(compare(t, "")[0])), *last[2]))
                    last = None
                held = None if guest else (i, t, place, own)
            if done:
                columns = list(zip(*done, strict=True))
                types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                types += [batch.schema.field("carried").type.field(c).type for c in carried]
                yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(columns, types, strict=True)], names=names)

    return ordered.mapInArrow(run, f"doc_id {kind}, {add}")


def bands(h: np.ndarray) -> np.ndarray:
    """Band hashes of a set of shingle hashes."""
    rows = signature(h)[: BANDS * ROWS].reshape(BANDS, ROWS).astype("<u4")
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), seed=k) for k, r in enumerate(rows)], U).view(np.int64)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row: near copies at ``percent`` hundredths."""
    return minmax.linked(docs, doc_id, text, percent, bands).drop("text_hash", "n_class", "survivor")


def whole(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``in_order``, and for every row ``component_id`` and ``n_class``: the least id of its near copies at ``percent``
    hundredths, and how many rows they are (1: alone).

    Links are not counted: of two near copies that others have joined already the pair is not made.
    """
    # Classes come first, and travel with the texts: rows that are in none (most) are not shuffled to learn it.
    near = minmax.linked(docs, doc_id, text, percent, bands).filter("n_class > 1").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "component_id", "n_class").distinct()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    rows = flagged(rows, F.xxhash64("doc_id", "text_hash"), near, F.xxhash64("_id", "_hash"))
    alone = rows.filter("not _may").select("doc_id", "text", F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("n_class"))
    asked = rows.filter("_may").drop("_may")
    joined = asked.join(near, asked["doc_id"].eqNullSafe(near["_id"]) & (asked["text_hash"] == near["_hash"]), "left").select(
        "doc_id", "text", F.when(F.col("_hash").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_class", F.lit(1)).alias("n_class"))
    return in_order(alone.unionByName(joined), carried=("component_id", "n_class"))
