"""Hard negatives by anchor-clustered shared lists.

Anchors are clustered by direction, within their label. For a cluster, with the greatest angle b between its centre
and a member, a row at angle t from the centre has a score of at most |anchor| * |row| * cos(max(0, t - b)) with every
member. The rows are sorted by |row| * cos(max(0, t - b)) once for the cluster; every member walks that list from its top
and stops where the bound has fallen below what its last accepted score certifies, so no row that belongs in an answer
is left out, ties included.

Anchors are the queries and all rows the base: rows stay where they are and are read tile by tile; anchors come in
rounds of at most ROUND, whose vectors are broadcast (ROUND * dimensions numbers). Each task returns its own best
rows of each anchor, and these are ranked in Spark. The first walk finds positives, the second negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import durable

#: Anchors of a group that is clustered in one task; groups of a round.
GROUP, GROUPS = 4096, 8
ROUND = GROUP * GROUPS
#: Members of a cluster, on average, and rounds of clustering.
MEMBERS, TURNS = 64, 6
#: Rows that are held against all clusters at a time, and rows of a list that are scored at a time.
TILE, STEP = 32_768, 512
#: Angle and share by which bounds are widened, far beyond the rounding of their computation.
SLACK = 1e-6


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and directions of rows; rows of zeros have no direction and stay zeros."""
    n = np.sqrt((x * x).sum(axis=1))
    return n, x / np.where(n > 0, n, 1)[:, None]


def clustered(x: np.ndarray) -> np.ndarray:
    """The cluster (from 0) of every row, by rounds of spherical means that start from evenly spaced rows."""
    k = -(-len(x) // MEMBERS)
    _, u = unit(x)
    centres = u[np.linspace(0, len(u) - 1, k).astype(int)]
    own = np.zeros(len(u), int)
    for _ in range(TURNS):
        own = (u @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, u)
        n, c = unit(sums)
        centres = np.where(n[:, None] > 0, c, centres)
    return own


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of numbers; shorter ones are filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    n = np.diff(vectors.offsets.to_numpy())
    wide = int(n.max()) if len(n) else 0
    if len(n) and (n == wide).all():
        return flat.reshape(len(n), wide)
    out = np.zeros((len(n), wide))
    out[np.arange(wide)[None, :] < n[:, None]] = flat
    return out


def fitted(x: np.ndarray, wide: int) -> np.ndarray:
    """``x`` with ``wide`` columns: numbers that one side lacks add nothing to a score."""
    if x.shape[1] >= wide:
        return x[:, :wide]
    return np.pad(x, ((0, 0), (0, wide - x.shape[1])))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products: in floating point where no sum can leave the exact range, else in 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**52:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Best:
    """The ``k`` best (score, id) of each of ``n`` lists: higher scores first, ties by smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.n = k, np.zeros(n, int)
        self.score, self.id = np.full((n, k), np.iinfo(np.int64).min), np.zeros((n, k), np.int64)

    def least(self) -> np.ndarray:
        """For each list the score that a new entry has to reach: the least number while it isn't full."""
        return self.score[:, -1]

    def add(self, lists: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """New entries; ``lists`` names the list of each."""
        if not len(lists):
            return
        touched = np.unique(lists)
        there = (np.arange(self.k)[None, :] < self.n[touched][:, None]).ravel()
        r = np.concatenate((lists, np.repeat(touched, self.k)[there]))
        s = np.concatenate((score, self.score[touched].ravel()[there]))
        i = np.concatenate((ids, self.id[touched].ravel()[there]))
        order = np.lexsort((i, -s, r))
        r, s, i = r[order], s[order], i[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        r, s, i, place = (v[place < self.k] for v in (r, s, i, place))
        self.score[r, place], self.id[r, place] = s, i
        self.n[touched] = np.bincount(r, minlength=len(self.n))[touched]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, id and score of all entries."""
        there = np.arange(self.k)[None, :] < self.n[:, None]
        return np.nonzero(there)[0], self.id[there], self.score[there]


class Positives:
    """For each anchor the best other rows of its label."""

    def __init__(self, anchors: dict, k: int, positive: np.ndarray | None = None):
        self.own, self.best = anchors["id"], Best(len(anchors["id"]), k)

    @staticmethod
    def eligible(labels: np.ndarray, label: int) -> np.ndarray:
        return labels == label

    def need(self, members: np.ndarray) -> np.ndarray:
        return self.best.least()[members].astype(float)

    def visit(self, members: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        a, c = np.nonzero((found >= self.best.least()[members][:, None]) & (ids[None, :] != self.own[members][:, None]))
        self.best.add(members[a], found[a, c], ids[c])


class Negatives:
    """For each anchor and each of its positives the best rows of other labels whose score is within the window."""

    def __init__(self, anchors: dict, k: int, positive: np.ndarray):
        self.positive = positive  # by anchor, the score of each positive
        self.there = anchors["there"]  # if there is one
        self.low, self.high = anchors["window"]
        self.best = Best(positive.size, k)

    @staticmethod
    def eligible(labels: np.ndarray, label: int) -> np.ndarray:
        return labels != label

    def need(self, members: np.ndarray) -> np.ndarray:
        slots = self.positive.shape[1]
        least = self.best.least().reshape(-1, slots)[members].astype(float)
        p = self.positive[members]
        return np.where(self.there[members] & (p >= 0), np.maximum(least, p * (self.low / 100)), np.inf).min(axis=1)

    def visit(self, members: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        slots = self.positive.shape[1]
        for k in range(slots):
            lists = members * slots + k
            p = self.positive[members, k][:, None]
            fits = (100 * found >= self.low * p) & (100 * found <= self.high * p) & self.there[members, k][:, None]
            a, c = np.nonzero(fits & (found >= self.best.least()[lists][:, None]))
            self.best.add(lists[a], found[a, c], ids[c])


def walk(anchors: dict, goal: Positives | Negatives, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> int:
    """Hold the rows of a tile against all clusters of the anchors; returns the number of scores made."""
    wide = anchors["x"].shape[1]
    x = fitted(x, wide)
    n, u = unit(x)
    made = 0
    for cluster in anchors["clusters"]:
        rows = np.nonzero(goal.eligible(labels, cluster["label"]))[0]
        angle = np.arccos(np.clip(u[rows] @ cluster["centre"], -1, 1))
        bound = n[rows] * (np.cos(np.maximum(0, angle - cluster["angle"])) + SLACK)
        order = np.argsort(-bound, kind="stable")
        rows, bound = rows[order], bound[order]
        members = cluster["members"]
        for k in range(0, len(rows), STEP):
            members = members[anchors["n"][members] * bound[k] >= goal.need(members)]
            if not len(members):
                break
            here = rows[k: k + STEP]
            goal.visit(members, scores(anchors["x"][members], x[here]), ids[here])
            made += len(members) * len(here)
    return made


def prepared(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, clusters: np.ndarray) -> dict:
    """What every task needs of a round's anchors: their numbers, and for each cluster its label, centre, angle and members."""
    n, u = unit(x)
    out = {"x": x, "n": n, "id": ids, "clusters": []}
    order = np.argsort(clusters, kind="stable")
    for members in np.split(order, np.nonzero(np.diff(clusters[order]))[0] + 1):
        centre = unit(u[members].sum(axis=0)[None, :])[1][0]
        cos = (u[members] @ centre)[n[members] > 0]
        angle = float(np.arccos(np.clip(cos.min(), -1, 1))) if len(cos) else 0.0
        out["clusters"].append({"label": labels[members[0]], "centre": centre, "angle": angle, "members": members})
    return out


def mine(rows: DataFrame, vec_id: str = "vec_id", vector: str = "vector", label: str = "label", every: int = 100,
         positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90)) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``rows`` has integer vectors. Anchors are the rows whose id is divisible by ``every``; the positives of an anchor are
    its best rows with its label and another id, the negatives of a positive the best rows of other labels with a score
    from ``window[0]`` to ``window[1]`` hundredths of the positive's. Higher scores are better, ties go to the smaller id.
    Rows with a null id, label or vector, or with a null in the vector, take no part. A repeated row is as many rows: a
    repeated anchor gives its result as often, a repeated candidate takes as many ranks. A shorter vector is filled up
    with zeros, so an empty one scores 0. Scores must fit a signed 64-bit number a hundred times over. Other columns are
    not read; an empty table, or one without anchors, gives no rows.
    """
    spark = rows.sparkSession
    usable = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, F.isnull)
    base = durable(rows.filter(usable).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<bigint>").alias("vector")), "vectors")
    anchors = durable(base.filter(F.col("id") % every == 0).withColumn("row", F.monotonically_increasing_id()), "anchors")
    total = anchors.count()
    groups = max(1, -(-total // GROUP))
    schema = "group int, cluster int, row long, id long, label long, vector array<bigint>"

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        x = matrix(pa.array(group["vector"], pa.list_(pa.int64())))
        own, used = np.zeros(len(group), int), 0
        for value in np.unique(group["label"]):
            here = np.nonzero(group["label"].to_numpy() == value)[0]
            found = clustered(x[here]) + used
            own[here], used = found, found.max() + 1
        return group.assign(cluster=own)[["group", "cluster", "row", "id", "label", "vector"]]

    grouped = anchors.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
    grouped = durable(grouped.groupBy("group").applyInPandas(cluster, schema), "clusters")
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for first in range(0, groups if total else 0, GROUPS):
        of_round = grouped.filter(F.col("group").between(first, first + GROUPS - 1)).toArrow().sort_by([("row", "ascending")])
        row, ids, labels = (of_round.column(c).to_numpy() for c in ("row", "id", "label"))
        if not len(row):
            continue
        clusters = of_round.column("group").to_numpy() * (2 * ROUND) + of_round.column("cluster").to_numpy()
        told = prepared(matrix(of_round.column("vector")), ids, labels, clusters)
        best = walked(base, told, row, Positives, positives)
        picked = best.toArrow()
        slot = picked.column("rank").to_numpy() - 1
        place = np.searchsorted(row, picked.column("row").to_numpy())
        told["there"] = np.zeros((len(row), positives), bool)
        told["there"][place, slot] = True
        score = np.zeros((len(row), positives), np.int64)
        score[place, slot] = picked.column("score").to_numpy()
        told["window"] = window
        worst = walked(base, told, row, Negatives, negatives, score)
        owner = anchors.select("row", F.col("id").alias("anchor_id"))
        pairs = best.select("row", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        out = out.unionByName(worst.join(pairs, ["row", "slot"]).join(owner, "row").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    return out


def walked(base: DataFrame, anchors: dict, row: np.ndarray, goal: type, k: int, positive: np.ndarray | None = None) -> DataFrame:
    """The ``k`` best rows: ``row`` (of the anchor), ``slot`` (of the positive, from 1), ``id``, ``score``, ``rank``, written."""
    told = base.sparkSession.sparkContext.broadcast((anchors, row, positive))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, row, positive = told.value
        found = goal(anchors, k, positive)
        held, n = [], 0

        def tile() -> None:
            if n:
                t = pa.Table.from_batches(held)
                walk(anchors, found, matrix(t.column("vector")), t.column("id").to_numpy(), t.column("label").to_numpy())

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= TILE:
                tile()
                held, n = [], 0
        tile()
        lists, ids, score = found.best.entries()
        slots = len(found.best.n) // len(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[lists // slots]), pa.array((lists % slots + 1).astype(np.int32)), pa.array(ids), pa.array(score)],
            names=["row", "slot", "id", "score"])

    best = base.select("id", "label", "vector").mapInArrow(run, "row long, slot int, id long, score long")
    out = durable(ranked(best, k), goal.__name__.lower())
    told.destroy()
    return out


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all tasks, with ``rank`` from 1."""
    order = W.partitionBy("row", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
