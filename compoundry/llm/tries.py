"""Conversation prefix trie with subtree totals, by depth bands.

Every distinct beginning of a conversation is a node. Its identifier is 128 bits: the exclusive or of one hash for
each (place, turn), so prefixes are running values that ranges of a conversation hand on, and no conversation is
gathered in one row. Subtree totals are rolled up in bands of HEIGHT depths:

1. a node's values go to its ancestors in its own band only (HEIGHT at most, itself included);
2. the tops of the bands form a trie of their own, HEIGHT times less deep, which is rolled up in the same way;
3. the completed total of a top goes to the HEIGHT ancestors in the band above it.

So a node is exploded to 2 * HEIGHT rows at most, and the rounds are the logarithm of the greatest depth to the base
HEIGHT. All counts are partial sums before any shuffle: a beginning that a third of all conversations share is one
row for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..operators.skew import split_hot_join
from .common import durable

HEIGHT = 8
#: Depths that one window holds; a multiple of HEIGHT.
WIDTH = 1024
#: Conversations whose identifiers agree above these bits are listed in one row before a list is digested.
LIST_BITS = 12

WORD = r"[^\x20\x09-\x0D]+"


def ordered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``said`` (a digest of role and text) and ``words`` of every turn.

    Turns are ordered by ``turn`` (null first), turns that tie by the digest. Null roles and texts are empty, repeated
    rows are turns of their own, rows with a null conversation are left out. Other columns are not read. The rows are
    dealt by ranges of conversation and turn and counted range by range, so a conversation may lie in many tasks;
    only rows that repeat whole stay together.
    """
    spark = turns.sparkSession
    said, by = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.length(said).cast("string"), F.lit(":"), said, by).cast("binary")).alias("said"),
        F.regexp_count(by, F.lit(WORD)).cast("long").alias("words"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "conv_id", F.col("turn").asc_nulls_first(), "said")
    dealt = durable(dealt.withColumn("block", F.spark_partition_id()), "turns")
    before = dealt.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "block", F.coalesce(F.sum("n").over(W.partitionBy("conv_id").orderBy("block").rowsBetween(
            W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    near = F.row_number().over(W.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "said"))
    return dealt.withColumn("near", near).join(before, ["conv_id", "block"]).select(
        "conv_id", (F.col("before") + F.col("near")).alias("place"), "said", "words")


def with_guests(rows: DataFrame) -> DataFrame:
    """Rows (``depth``) with ``block``; the first row of a block is the last of the block before it, too."""
    block = F.floor(F.col("depth") / WIDTH)
    first = (F.col("depth") > 0) & (F.col("depth") % WIDTH == 0)
    return rows.withColumn("block", F.explode(F.when(first, F.array(block, block - 1)).otherwise(F.array(block))))


def settled(rows: DataFrame) -> DataFrame:
    """Without the first rows of blocks that stand in the block before as well."""
    return rows.filter((F.col("depth") == 0) | (F.col("depth") != F.col("block") * WIDTH))


def in_block(first: int, last: int) -> WindowSpec:
    return W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(first, last)


def grow(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Members of every node: ``conv_id``, ``depth``, ``id``, ``words`` (of the last turn), ``last`` (all of it).

    ``turns`` has ``conv_id``, ``place``, ``said``, ``words``, the places of a conversation without gaps from 1;
    ``convs`` has every ``conv_id`` once, those without turns too. No conversations give no rows. The result is
    written to the shared folder.
    """
    rows = turns.select("conv_id", F.col("place").cast("long").alias("depth"), "words",
                        *[F.xxhash64(F.lit(k), "place", "said").alias(f"k{k}") for k in (1, 2)])
    roots = convs.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in ("depth", "words", "k1", "k2")])
    rows = rows.unionByName(roots)
    totals = rows.groupBy("conv_id", F.floor(F.col("depth") / WIDTH).alias("block")).agg(
        F.bit_xor("k1").alias("b1"), F.bit_xor("k2").alias("b2"), F.max("depth").alias("deepest"))
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select("conv_id", "block", F.max("deepest").over(W.partitionBy("conv_id")).alias("length"),
                            *[F.coalesce(F.bit_xor(f"b{k}").over(earlier), F.lit(0)).alias(f"c{k}") for k in (1, 2)])
    running = in_block(W.unboundedPreceding, 0)
    inside = with_guests(rows).select("*", *[F.bit_xor(f"k{k}").over(running).alias(f"r{k}") for k in (1, 2)])

    def half(k: int) -> Column:
        return F.lpad(F.hex(F.col(f"r{k}").bitwiseXOR(F.col(f"c{k}"))), 16, "0")

    return durable(settled(inside.join(carried, ["conv_id", "block"])).select(
        "conv_id", "depth", F.unhex(F.concat(half(1), half(2))).alias("id"), "words",
        (F.col("depth") == F.col("length")).alias("last")), "members")


def chained(members: DataFrame) -> DataFrame:
    """Members with ``parent``, ``up`` (the nodes of the band from its top down to this one) and, for the top of a
    band that has one above it, ``over`` (the nodes of that band)."""
    near = F.collect_list("id").over(in_block(-HEIGHT, 0))
    rows = settled(with_guests(members).withColumn("near", near))
    place = (F.col("depth") % HEIGHT).cast("int")
    return rows.select(
        *members.columns, F.when(F.size("near") > 1, F.element_at("near", -2)).alias("parent"),
        F.slice("near", -(place + 1), place + 1).alias("up"),
        F.when((place == 0) & (F.col("depth") > 0), F.slice("near", 1, HEIGHT)).alias("over"))


def rolled(members: DataFrame, values: DataFrame, sums: list[str]) -> DataFrame:
    """``id`` and the sums of the columns ``sums`` of ``values`` (``id`` once each) over each node's subtree.

    ``members`` has ``conv_id``, ``depth``, ``id``; nodes without values count nothing.
    """
    added = [F.sum(c).alias(c) for c in sums]
    nodes = durable(chained(members.select("conv_id", "depth", "id")).groupBy("id").agg(
        F.first("up").alias("up"), F.first("over").alias("over")), "bands")
    banded = durable(nodes.join(values, "id").select(F.explode("up").alias("id"), *sums).groupBy("id").agg(*added), "banded")
    tops = members.filter(F.col("depth") % HEIGHT == 0).select(
        "conv_id", (F.col("depth") / HEIGHT).cast("long").alias("depth"), "id")
    if tops.filter("depth > 0").isEmpty():
        return banded
    done = rolled(tops, banded, sums)
    handed = nodes.filter("over is not null").join(done, "id").select(F.explode("over").alias("id"), *sums)
    return banded.unionByName(handed).groupBy("id").agg(*added)


def rollup(members: DataFrame) -> DataFrame:
    """Every node: ``id``, ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves`` and ``saved_tokens`` (over its subtree, itself included: members but one times words of its turn)."""
    whole = durable(chained(members).groupBy("id").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        F.count(F.lit(1)).alias("n_convs"), F.first("words").alias("words")), "nodes")
    children = whole.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = durable(whole.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    values = nodes.select("id", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                          ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = rolled(members, values, ["n_leaves", "saved_tokens"])
    # Of a beginning with very many children these are spread, with a copy of their parent for each share.
    n = nodes.count()
    named = split_hot_join(
        nodes.filter("parent is not null").select("id", "parent"),
        nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id")),
        ["parent"], "left", rows_per_split=max(100, n // 1000), unique_right=True).select("id", "parent_conv_id")
    return nodes.select("id", "conv_id", "depth", "n_convs", "n_children").join(totals, "id").join(named, "id", "left")


def ends(members: DataFrame) -> DataFrame:
    """``id`` and ``conv_id`` of the conversations that end at a node."""
    return members.filter("last").select("id", "conv_id")


def list_digests(listed: DataFrame) -> DataFrame:
    """``id`` and ``sha256`` of the ascending, comma-joined numbers ``conv_id`` (each once) of every ``id``.

    Stretches of a list are joined in parallel, and a list of several is digested as a stream of these, so none is
    ever whole in memory.
    """
    stretch = F.shiftright(F.col("conv_id"), LIST_BITS)
    pieces = listed.groupBy("id", stretch.alias("stretch")).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("piece"))
    pieces = durable(pieces, "pieces")
    counted = pieces.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.first("piece").alias("piece"))
    short = counted.filter("n = 1").select("id", F.sha2("piece", 256).alias("sha256"))
    long = pieces.join(counted.filter("n > 1").select("id"), "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for own, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own == now:
                    digest.update(b",")
                else:
                    if now is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = own, hashlib.sha256()
                digest.update(piece.encode())
            if done:
                yield _rows(done)
        if now is not None:
            yield _rows([(now, digest.hexdigest())])

    streamed = long.repartition("id").sortWithinPartitions("id", "stretch").select("id", "piece").mapInArrow(
        run, "id binary, sha256 string")
    return short.unionByName(streamed)


def _rows(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    ids, digests = zip(*done, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(digests, pa.string())], names=["id", "sha256"])
