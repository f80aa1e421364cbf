"""License scans by diagonal voting, in DataFrame functions.

Every text is cut into words, and a rolling hash of each word pair is joined with the places of that pair in the
templates. A hit at word p of the text and word q of a template votes for the diagonal p - q. A diagonal on which
every pair of a template votes is a place where its words stand consecutively; neighbouring diagonals are merged, so
that a notice with words put in or left out is found too. Spans are verified by the words themselves (hits compare
the pair, not only its hash) and by the share of the template that they cover.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before A-Z are lower-cased.
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Diagonals at most so far apart belong to one span.
GAP = 2
#: Hundredths of a template's pairs that a span must cover, and of its length that a span may have.
COVER, LENGTH = 60, 150


@dataclass(frozen=True)
class Template:
    """A phrase to be found word by word (``exact``), or a notice to be found roughly."""

    label: str
    words: str
    exact: bool = False


# Base phrases and their labels.
PHRASES = [
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
]
NOTICES = [
    Template("apache", "licensed under the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-by-notice", "licensed under the creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license"),
    Template("mit", "released under the mit license"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
]


def places(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """One row for each word pair of each template; as small as the templates are."""
    rows = []
    for t, template in enumerate(templates):
        words = template.words.split()
        rows += [(a + " " + b, t, q, len(words) - 1) for q, (a, b) in enumerate(zip(words, words[1:], strict=False))]
    made = spark.createDataFrame(rows, "pair string, template int, q int, pairs int")
    return made.withColumn("hash", F.xxhash64("pair"))


def spans(docs: DataFrame, templates: Sequence[Template], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Verified spans: ``doc_id``, ``text_hash``, ``template``, ``start``, ``end`` (words, end exclusive), ``cover``.

    ``cover`` is the share of the template's pairs found, 1 for exact phrases. Repeated rows give their spans once;
    null and empty texts give none.
    """
    words = F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(WORD), 0)
    df = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), words.alias("_w"))
    pairs = F.when(F.size("_w") >= 2, F.transform(
        F.sequence(F.lit(0), F.size("_w") - 2), lambda k: F.concat_ws(" ", F.get("_w", k), F.get("_w", k + 1))))
    each = df.select("doc_id", "text_hash", F.posexplode(pairs).alias("p", "pair")).withColumn("hash", F.xxhash64("pair"))
    small = F.broadcast(places(docs.sparkSession, templates).withColumnRenamed("pair", "own"))
    hits = each.join(small, "hash").filter("pair = own")
    key = ["doc_id", "text_hash", "template"]
    votes = hits.groupBy(*key, "pairs", (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.collect_set("q").alias("qs"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    # Every diagonal of an exact phrase is a run of its own; neighbouring ones of a notice are one run.
    exact = F.col("template") < sum(t.exact for t in templates)
    near = Window.partitionBy(*key).orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(near) > GAP, F.lit(True))
    runs = votes.withColumn("head", (exact | far).cast("int")).withColumn("run", F.sum("head").over(near))
    merged = runs.groupBy(*key, "pairs", "run").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("n"), F.min("lo").alias("start"),
        (F.max("hi") + 2).alias("end"))
    whole, n = F.col("pairs"), F.col("n")
    rough = (100 * n >= COVER * whole) & (100 * (F.col("end") - F.col("start")) <= LENGTH * (whole + 1))
    verified = merged.filter(F.when(exact, n == whole).otherwise(rough))
    return verified.select(*key, "start", "end", (n / whole).alias("cover"))


def scan(docs: DataFrame, phrases: Sequence[Template] = PHRASES, notices: Sequence[Template] = NOTICES,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``,
    ``score`` (the best cover, 0 without a span) and ``spans``.

    A null text counts as empty: no words, no spans, null first and last word. Rows with a null id stay; repeated
    rows get equal results; other columns are not read. The shuffles carry hits, and a few numbers for each row.
    """
    templates = [*phrases, *notices]
    names = F.array(*[F.lit(t.label) for t in templates])
    base = F.col("template") < len(phrases)
    found = spans(docs, templates, doc_id, text).withColumn("label", F.get(names, F.col("template")))
    by_doc = found.groupBy("doc_id", "text_hash").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
        F.array_sort(F.collect_list(F.struct("start", "end", "label", "cover"))).alias("spans"),
    ).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        F.coalesce(F.regexp_count(text, F.lit(ANY_CASE)), F.lit(0)).cast("long").alias("n_words"))
    out = rows.join(by_doc, rows["doc_id"].eqNullSafe(by_doc["_id"]) & (rows["text_hash"] == by_doc["_hash"]), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("spans", F.array()).alias("spans"))
