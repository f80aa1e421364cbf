"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule says which documents it rejects. On a sample the time of each rule and the share it rejects are measured;
rules then stand in one CASE expression by rejections per second, so a document meets the later and dearer rules only
if the earlier ones let it pass. The order never changes which documents are rejected.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of the sample, which pass through the driver, on which costs and selectivity are measured; only the order of the rules hangs on it.
SAMPLE_ROWS = 200
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """A name and the condition, over the measures and ``_text``, ``_words`` and ``_lines``, that rejects a document."""

    name: str
    rejects: Column


def base_rules() -> list[Rule]:
    return [
        Rule("short", F.col("n_words") < 50),
        Rule("repeated", 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    ]


def method_rules() -> list[Rule]:
    """Symbols, repeated lines, word length, words without letters, and capitals."""
    words, chars = F.col("n_words"), F.col("word_chars")
    letters = F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}")))
    return [
        Rule("symbols", 100 * F.col("n_symbols") > 20 * words),
        Rule("lines", 100 * F.col("n_dup_lines") > 40 * F.size("_lines")),
        Rule("word_length", (chars < 2 * words) | (chars > 15 * words)),
        Rule("no_letters", 100 * letters < 70 * words),
        Rule("capitals", 100 * F.regexp_count("_text", F.lit("[A-Z]")) > 60 * chars),
    ]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row`` (all columns of a document), ``_text``, ``_words``, ``_lines`` (with a word) and the MEASURES.

    Repeated words: hashes of the 3-word windows are sorted; only where two are equal are they sorted again with
    their places, so the cost is that of sorting, whatever a text repeats.
    """
    i = F.struct("*").alias("_row")
    df = docs.select(i, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    df = df.select("*", F.regexp_extract_all("_text", F.lit(WORD), 0).alias("_words"),
                   F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD)).alias("_lines"))
    window = F.when(F.size("_words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3),
        lambda k: F.xxhash64(F.get("_words", k), F.get("_words", k + 1), F.get("_words", k + 2)),
    )).otherwise(F.array().cast("array<bigint>"))
    df = df.select("*", window.alias("_windows"))
    df = df.select("*", F.sort_array("_windows").alias("_sorted"))
    df = df.select("*", F.exists(
        F.sequence(F.lit(1), F.greatest(F.size("_sorted") - 1, F.lit(1))),
        lambda k: F.get("_sorted", k) == F.get("_sorted", k - 1)).alias("_repeats"))
    placed = F.when(F.col("_repeats"), F.array_sort(F.transform(
        "_windows", lambda h, k: F.struct(h.alias("h"), k.alias("k")))))
    df = df.select(*[c for c in df.columns if c not in ("_windows", "_sorted", "_repeats")], placed.alias("_placed"))
    equal = F.filter(F.transform("_placed", lambda x, k: F.when(
        (x["h"] == F.get("_placed", k - 1)["h"]) | (x["h"] == F.get("_placed", k + 1)["h"]), x["k"])),
        lambda k: k.isNotNull())
    df = df.select(*[c for c in df.columns if c != "_placed"], F.sort_array(equal).alias("_at"))
    covered = F.aggregate(
        F.transform("_at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_at", k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    lines = F.size("_lines") - F.size(F.array_distinct("_lines"))
    return df.select(
        "_row", "_text", "_words", "_lines", F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.cast("long").alias("n_dup_lines"), F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def estimates(sample: DataFrame, rules: Sequence[Rule]) -> dict[str, tuple[float, float]]:
    """Seconds and rejected share of each rule on a sample; a rule's time is the lesser of two runs."""
    found = {}
    for rule in rules:
        best = float("inf")
        for _ in range(2):
            t = time.perf_counter()
            row = sample.agg(F.count(F.lit(1)), F.count_if(rule.rejects)).first()
            best = min(best, time.perf_counter() - t)
        found[rule.name] = (best, row[1] / max(1, row[0]))
    return found


def ordered(rules: Sequence[Rule], found: dict[str, tuple[float, float]]) -> list[Rule]:
    """Rules by rejections per second, the highest first; ties keep their order."""
    return sorted(rules, key=lambda r: -found[r.name][1] / max(found[r.name][0], 1e-9))


def cascade(rules: Sequence[Rule]) -> Column:
    """Name of the first rule, in the order given, that rejects the document; null if none does."""
    chain = F.lit(None).cast("string")
    for rule in reversed(rules):
        chain = F.when(rule.rejects, rule.name).otherwise(chain)
    return chain


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None, base: Sequence[Rule] | None = None,
          text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``_row`` (the whole document), the MEASURES, ``base_failed`` and ``kept``.

    A null text counts as having no words and fails the base; so does an empty one. Repeated rows are judged alike,
    an empty table gives none. All columns of a document stay in ``_row``, so their names clash with nothing. Work is
    within a row: no shuffle, no join; a long text costs n log n.
    """
    rules = method_rules() if rules is None else list(rules)
    base = base_rules() if base is None else list(base)
    # Measures that all rows need are there already when a rule is timed, as they are in the cascade.
    rows = docs.limit(sample_rows).collect()  # asks for as few partitions as hold them; a limit inside a job asks all
    sample = measured(docs.sparkSession.createDataFrame(rows, docs.schema), text).persist()
    try:
        found = estimates(sample, rules)
    finally:
        sample.unpersist()
    failed = F.lit(False)
    for rule in base:
        failed = failed | rule.rejects
    df = measured(docs, text).withColumn("base_failed", failed)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(ordered(rules, found)).isNull())
    return df.select("_row", *MEASURES, "base_failed", kept.alias("kept"))


def kept_rows(judged: DataFrame) -> DataFrame:
    """The documents that ``judge`` keeps, with their own columns.

    The running number keeps the optimizer from moving the filter below the measures, where each use of a measure
    would be worked out anew.
    """
    numbered = judged.select("_row", "kept", F.monotonically_increasing_id().alias("_number"))
    return numbered.filter(F.col("kept") & (F.col("_number") >= 0)).select("_row.*")
