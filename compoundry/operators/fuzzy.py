"""Best fuzzy match of documents to items: J12, W02.

The similarity is the Jaccard index of trigram sets, so a match above a threshold can be found through
the first trigrams of each set in a fixed global order (prefix filter). Two sets that must share at
least two trigrams share two within prefixes that are longer by one; pairs of trigrams are far rarer than
single ones, so the index is asked for pairs. Only where both sets are so short that one shared trigram
is enough, or so long that pairs would be too many, single trigrams are asked for. Trigrams that are rare in names come
first, which keeps the index lists short; those that no name has make no keys. Keys hold the buckets of both sizes, as sets of like size need
shorter prefixes than a short and a long one.

Sets that share a key by chance are told apart inside the join, by what can still be shared after the key
(positional filter) and by hashed bitmaps of both sets (a bit of only one set is a trigram the other lacks).

Only the best match of a document is wanted, so thresholds descend: equal sets first, then high
thresholds with short prefixes, then the wanted one. A document that finds a match leaves; what it found
is its best, because every pair above that threshold was seen. Nothing is cut off at any step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.trigram import packed_trigrams
from ..session import durable
from .skew import split_hot_join

#: Trigrams of names that are told apart by how frequent they are; the others count as rare. Only speed hangs on it.
RANKED_GRAMS = 1 << 16
#: Least sizes of the buckets of set sizes, each a quarter larger than the one before.
SIZES = [1]
while SIZES[-1] < 1 << 24:
    SIZES.append(max(SIZES[-1] + 1, SIZES[-1] * 5 // 4))
#: Words of a bitmap, and the longest prefix of which pairs are made.
WORDS, MOST_PREFIX = 4, 60
BITS = [f"b{k}" for k in range(WORDS)]
_EPS = 1e-6


def _ranked(sets: DataFrame, common: DataFrame, whole: bool = False) -> DataFrame:
    """Each set (``id``, ``item_id``, ``grams``) with its trigrams in global order: rare first, then by value.

    ``common`` lists the most frequent trigrams of names (bounded, so it may be broadcast); the others tie at 0.
    Any fixed order keeps the filter exact. Where the list is ``whole``, those at 0 are in no name: they stand first, and
    no key is made of these ``skip`` trigrams, as no name can share it.
    """
    grams = sets.select("id", "item_id", F.explode("grams").alias("gram")).join(F.broadcast(common), "gram", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")))
    ranked = grams.groupBy("id").agg(F.min("item_id").alias("item_id"), order.alias("o"))
    skip = F.size(F.filter("o", lambda x: x["n"] == 0)) if whole else F.lit(0)
    return ranked.select("id", "item_id", F.transform("o", lambda x: x["gram"]).alias("grams"), skip.alias("skip"))


def _needed(n: Column, m: Column, threshold: float) -> Column:
    """Trigrams that sets of ``n`` and ``m`` must share at least to reach the threshold."""
    return F.ceil(threshold / (1 + threshold) * (n + m) - _EPS).cast("int")


def bitmap(grams: Column) -> list[Column]:
    """A set of trigrams as words of a hashed bitmap; a bit only one of two sets has is a trigram they don't share."""
    bits = F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(64 * WORDS)).cast("int"))

    def word(k: int) -> Column:
        own = F.filter(bits, lambda b: F.shiftright(b, 6) == k)
        return F.reduce(own, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b % 64)))

    return [word(k) for k in range(WORDS)]


def index_rows(sets: DataFrame, buckets: DataFrame, threshold: float, side: str) -> DataFrame:
    """Keys of every ``measured`` set for each bucket of partners (``low``, ``next``, ``most``).

    A key is a pair of trigrams of the prefix, or one trigram where sets are so short that one may be enough, or so long
    that pairs would be too many. ``place`` is the position of the key's last trigram, ``width`` the trigrams in it.
    The first ``skip`` trigrams of a set, where it has that column, are known to be in no partner and make no key.
    """
    skip = F.col("skip") if "skip" in sets.columns else F.lit(0)
    n, low = F.col("n"), F.col("p_low")
    partners = buckets.select(*[F.col(c).alias("p_" + c) for c in buckets.columns])
    both = sets.join(F.broadcast(partners), (low * threshold - _EPS <= n) & (F.col("p_most") >= threshold * n - _EPS))
    # what both sides know of a pair decides how its keys are made
    common = _needed(F.col("low"), low, threshold)
    width = F.when((common >= 2) & (F.greatest("next", "p_next") - common <= MOST_PREFIX), 2).otherwise(1)
    least = F.greatest(low, F.ceil(threshold * n - _EPS).cast("int"))
    length = F.greatest(F.lit(0), F.least(n, n - _needed(n, least, threshold) + F.col("width")))
    rows = both.withColumn("width", width).withColumn("length", length)
    between = ["low", "p_low"] if side == "l" else ["p_low", "low"]
    prefix = F.slice("grams", skip + 1, F.greatest(F.lit(0), F.col("length") - skip))
    pairs = F.flatten(F.transform(prefix, lambda g, i: F.transform(
        F.slice("grams", skip + i + 2, F.col("length") - skip - i - 1),
        lambda h, j: F.struct(F.xxhash64(*between, g, h).alias("key"), (skip + i + j + 1).alias("place")))))
    single = F.transform(prefix, lambda g, i: F.struct(F.xxhash64(*between, g).alias("key"), (skip + i).alias("place")))
    made = rows.select("id", "n", "width", *BITS, F.explode(F.when(F.col("width") == 2, pairs).otherwise(single)).alias("k"))
    columns = [F.col(c).alias(f"{side}_{c}") for c in ("id", "n", *BITS)]
    return made.select(F.col("k.key").alias("key"), F.col("width").alias(side + "_width"), F.col("k.place").alias(side + "_place"), *columns)


def measured(sets: DataFrame) -> DataFrame:
    """Sets with their size ``n``, the least size of its bucket and of the next one, and the words of their bitmap.

    To be written before it is read by ``candidates``, so that this is done once.
    """
    words = [w.alias(c) for w, c in zip(bitmap(F.col("grams")), BITS, strict=True)]
    sizes, n = F.array(*map(F.lit, SIZES)), F.size("grams")
    low = F.array_max(F.filter(sizes, lambda x: x <= n)).alias("low")
    return sets.select("*", n.alias("n"), low, F.array_min(F.filter(sizes, lambda x: x > n)).alias("next"), *words)


def candidates(texts: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs of ids that may reach the threshold, of ``measured`` sets.

    Judged inside the join, so that sets that share a key by chance leave no row behind: by their sizes, by what can
    still be shared after the key, and by the bits only one of them has.
    """
    t = threshold - _EPS

    def buckets(sets: DataFrame) -> DataFrame:  # at most one row for each bucket of sizes
        return sets.groupBy("low", "next").agg(F.max("n").alias("most"))

    left, right = index_rows(texts, buckets(names), t, "l"), index_rows(names, buckets(texts), t, "r")
    need = t / (1 + t) * (F.col("l_n") + F.col("r_n")) - _EPS

    def alone(a: str, b: str) -> Column:
        return sum((F.bit_count(F.col(f"{a}_{c}").bitwiseAND(F.bitwise_not(f"{b}_{c}"))) for c in BITS), F.lit(0))

    after = F.least(F.col("l_n") - F.col("l_place"), F.col("r_n") - F.col("r_place")) - 1
    near = (
        (left["key"] == right["key"]) & (F.col("r_n") >= t * F.col("l_n")) & (F.col("r_n") * t <= F.col("l_n"))
        & (F.col("l_width") + after >= need)
        & (F.col("l_n") - alone("l", "r") >= need) & (F.col("r_n") - alone("r", "l") >= need)
    )
    return left.join(right, near).select("l_id", "r_id").distinct()


def _grams(texts: DataFrame, column: str) -> DataFrame:
    """Distinct texts with their trigrams ``grams``, those without any left out. Texts are few bytes and their trigrams
    much work, so they are dealt over all tasks; a text that many rows share costs that work once."""
    n = max(texts.sparkSession.sparkContext.defaultParallelism, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = texts.repartition(n, column)
    return dealt.select("*", packed_trigrams(F.col(column)).alias("grams")).filter(F.size("grams") > 0)


def _best_above(texts: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    """Per text the best name at or above the threshold: (text_id, best)."""
    left = texts.select(F.col("id").alias("l_id"), F.col("grams").alias("_l"))
    right = names.select(F.col("id").alias("r_id"), "item_id", F.col("grams").alias("_r"))
    shared = F.size(F.array_intersect("_l", "_r"))
    scored = candidates(texts, names, threshold).join(left, "l_id").join(right, "r_id").select(
        "l_id", "item_id", shared.alias("shared"), (F.size("_l") + F.size("_r")).alias("total")
    ).withColumn("sim", F.col("shared") / (F.col("total") - F.col("shared")))
    return (
        scored.filter(F.col("sim").cast("float").cast("double") >= threshold)
        .groupBy(F.col("l_id").alias("text_id"))
        .agg(F.max(F.struct("sim", (-F.col("item_id")).alias("neg"))).alias("best"))
    )


def fuzzy_best(
    docs: DataFrame, items: DataFrame, threshold: float = P.FUZZY_THRESHOLD, steps: tuple[float, ...] = (0.7,)
) -> DataFrame:
    """Per document without product, the most similar item by title or file name: (doc_id, source_item_id, sim).

    Similarity is compared in single precision, as it is stored. Ties go to the smallest item id. What a text costs is paid
    once for each distinct title, file name or name, not for each row.
    """
    called = items.filter("name is not null").groupBy("name").agg(F.min("source_item_id").alias("item_id"))
    names = _grams(called, "name").groupBy("grams").agg(F.min("item_id").alias("item_id"))
    names = durable(names.withColumn("id", F.monotonically_increasing_id()), "fuzzy-names")
    asked = docs.filter(F.col("product_id").isNull()).select(
        "doc_id", F.explode(F.array_distinct(F.array("title", "filename"))).alias("text")).filter("text is not null")
    asked = durable(asked, "fuzzy-asked")
    spelled = durable(_grams(asked.select("text").distinct(), "text"), "fuzzy-spelled")
    # ids are given to what the shared folder holds, so every reader sees the same ones
    texts = durable(spelled.select("grams").distinct().withColumn("id", F.monotonically_increasing_id()), "fuzzy-texts")
    numbered = durable(spelled.join(texts, "grams").select("text", F.col("id").alias("text_id")), "fuzzy-numbered")
    todo = durable(split_hot_join(asked, numbered, ["text"], unique_right=True).select("doc_id", "text_id"), "fuzzy-todo")
    common = (
        names.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "gram").limit(RANKED_GRAMS)
    )
    common = durable(common, "fuzzy-common")
    whole = common.count() < RANKED_GRAMS
    ranked_names = durable(measured(_ranked(names, common, whole)), "fuzzy-index")
    ranked = durable(measured(_ranked(texts.withColumn("item_id", F.lit(None).cast("long")), common, whole)), "fuzzy-index")

    def to_docs(best: DataFrame) -> DataFrame:
        return todo.join(best, "text_id").groupBy("doc_id").agg(F.max("best").alias("best"))

    equal = texts.join(names.select("grams", "item_id"), "grams").select(
        F.col("id").alias("text_id"), F.struct(F.lit(1.0).alias("sim"), (-F.col("item_id")).alias("neg")).alias("best")
    )
    found = durable(to_docs(equal), "fuzzy-found")
    for t in [s for s in steps if s > threshold] + [threshold]:
        open_texts = todo.join(found.select("doc_id"), "doc_id", "left_anti").select(F.col("text_id").alias("id")).distinct()
        left = ranked.join(open_texts, "id", "left_semi")
        more = to_docs(_best_above(left, ranked_names, t)).join(found.select("doc_id"), "doc_id", "left_anti")
        found = durable(found.unionByName(more), "fuzzy-found")
    return found.select("doc_id", (-F.col("best.neg")).alias("source_item_id"), F.col("best.sim").alias("sim"))


def attach_products(docs: DataFrame, best: DataFrame) -> DataFrame:
    """Give documents without product their best item."""
    return docs.join(best.select("doc_id", F.col("source_item_id").alias("_item")), "doc_id", "left").select(
        *[F.coalesce("product_id", "_item").alias("product_id") if c == "product_id" else F.col(c) for c in docs.columns]
    )
