"""Match text against a table of regular expressions.

Pattern tables become part of the projection, so a match costs no join at all and patterns are compiled
once. A longer table stands there in blocks. A table beyond ``MOST_INLINE`` rows stays a table: the literals that
every match of a pattern must hold are taken from the pattern, texts and literals are joined by the rarest of their
short stretches of characters, and only texts that hold all literals are matched. Plans then don't grow with the table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .skew import split_hot_join

BLOCK = 200
#: Pattern tables of more rows are joined by literals.
MOST_INLINE = 1000
#: Lengths of the stretches by which texts and literals are joined; a literal takes the greater one if it can.
STRETCHES = (6, 3)
# Stands for a part of a pattern that may match various texts.
_BREAK = "\x00"
# Forms in which characters don't stand for themselves in a way that is read here.
_UNREAD = r"\\[xupPcQEkN0]|\(\?(?!:|i\))|\[\^?\]|\[[^\]]*\[|&&|\x00"


def _any(patterns: list[str], flags: str) -> str | None:
    """One pattern that matches where any of them does, for lists of patterns that begin with an anchor.

    None where it would not pay (patterns that may match anywhere) or could change their meaning (references).
    """
    if not all(p.startswith("^") for p in patterns) or any(re.search(r"\\[1-9]|\(\?<[A-Za-z]|\\k<", p) for p in patterns):
        return None
    return flags + "|".join(f"(?:{p})" for p in patterns)


def _block(text: Column, rows: list[dict], fields: list[str], flags: str) -> Column:
    entries = [F.struct(*[F.lit(r[f]).alias(f) for f in fields]) for r in rows]
    hits = F.filter(
        F.array(*[F.when(text.rlike(flags + r["pattern"]), e) for r, e in zip(rows, entries)]), lambda x: x.isNotNull()
    )
    joint = _any([r["pattern"] for r in rows], flags)
    return hits if joint is None else F.when(text.rlike(joint), hits).otherwise(F.filter(F.array(entries[0]), lambda x: F.lit(False)))


def pattern_array(text: Column, rows: list[dict], fields: list[str], flags: str = "") -> Column:
    """The rows whose pattern is found in ``text``, in the order of the table, as an array of structs of ``fields``.

    Where patterns are whole-text forms most texts match none: one joint pattern of a block tells that first.
    """
    if not rows:
        return F.filter(F.array(F.struct(*[F.lit("").alias(f) for f in fields])), lambda x: F.lit(False))
    blocks = [_block(text, rows[i : i + BLOCK], fields, flags) for i in range(0, len(rows), BLOCK)]
    return blocks[0] if len(blocks) == 1 else F.concat(*blocks)


def pattern_rows(patterns: list[dict] | DataFrame, fields: list[str]) -> list[dict]:
    """A pattern table as a list in its order: by ``position`` if it has such a column, else by pattern and fields.

    Read whole by the driver: tables of at most ``MOST_INLINE`` rows, and of larger ones the patterns without a literal.
    """
    if not isinstance(patterns, DataFrame):
        return list(patterns)
    names = ["pattern", *[f for f in fields if f != "pattern"]]
    order = ["position", *names] if "position" in patterns.columns else names
    return [r.asDict() for r in patterns.orderBy(*order).select(*names).collect()]


def literal_runs(pattern: Column) -> Column:
    """For each alternative of a pattern the texts (lower case, ASCII letters, digits and blanks, three at least) that each
    of its matches holds, whatever its case.

    Null where an alternative has none, or the pattern has forms that are not read here.
    """
    plain = F.regexp_replace(pattern, r"\\.", _BREAK)
    plain = F.regexp_replace(plain, r"\[[^\]]*\]", _BREAK)
    for _ in range(4):  # groups from the inside out; deeper ones leave a parenthesis
        plain = F.regexp_replace(plain, r"\([^()]*\)", _BREAK)
    plain = F.regexp_replace(plain, r"(?s).(?:[?*]|\{[^}]*\})", _BREAK)

    def runs(part: Column) -> Column:
        return F.array_distinct(F.transform(F.regexp_extract_all(part, F.lit("[A-Za-z0-9 ]{3,}"), F.lit(0)), F.lower))

    found = F.transform(F.split(plain, r"\|"), runs)
    read = ~pattern.rlike(_UNREAD) & ~plain.rlike(r"[()\[\]]") & ~F.exists(found, lambda x: F.size(x) == 0)
    return F.when(read, F.array_distinct(found))


def _stretches(text: Column, size: int) -> Column:
    """The distinct stretches of ``size`` characters of a text."""
    last = F.length(text) - size + 1
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, size)))).otherwise(
        F.array().cast("array<string>"))


def _match_large(df: DataFrame, text: str, patterns: DataFrame, fields: list[str], flags: str) -> DataFrame:
    entry = F.struct(*fields).alias("_entry")
    table = durable(patterns.select(F.monotonically_increasing_id().alias("_id"), "pattern", entry, literal_runs(F.col("pattern")).alias("_all")), "patterns")
    each = table.filter("_all is not null").select("_id", F.explode("_all").alias("_runs"))
    long, short = STRETCHES
    texts = durable(df.select(F.col(text).alias("_text")).filter("_text is not null").distinct(), "pattern-texts")
    lower = F.lower("_text")
    keys = texts.select("_text", F.explode(F.concat(_stretches(lower, long), _stretches(lower, short))).alias("_key"))
    # Alternatives that ask for the same literals are looked up once, by that of their stretches which fewest texts hold;
    # where no text holds one of them, none matches.
    own = F.flatten(F.transform("_runs", lambda r: F.when(F.length(r) >= long, _stretches(r, long)).otherwise(_stretches(r, short))))
    wanted = each.select("_runs").distinct().select("_runs", F.explode(F.array_distinct(own)).alias("_key"))
    held = keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    rarest = wanted.join(held, "_key", "left").groupBy("_runs").agg(
        F.min_by("_key", F.struct("_n", "_key")).alias("_key"), F.count_if(F.col("_n").isNull()).alias("_missing"))
    asked = durable(rarest.filter("_missing = 0").select("_runs", "_key"), "pattern-keys")
    near = split_hot_join(keys, asked, ["_key"]).filter(F.forall("_runs", lambda r: lower.contains(r))).select("_text", "_runs")
    near = durable(near, "pattern-near")
    # a pattern of several alternatives may come more than once
    once = split_hot_join(near, each, ["_runs"]).select("_text", "_id").distinct().join(table.select("_id", "pattern", "_entry"), "_id")
    found = once.filter(F.expr(f"_text rlike concat('{flags}', pattern)")).select("_text", "_entry")
    rest = pattern_rows(table.filter("_all is null and pattern is not null").select("pattern", *[F.col("_entry")[f].alias(f) for f in fields if f != "pattern"]), fields)
    others = texts.select("_text", F.explode(pattern_array(F.col("_text"), rest, fields, flags)).alias("_entry"))
    kinds = table.schema["_entry"].dataType
    hits = found.unionByName(others.select("_text", F.col("_entry").cast(kinds))) if rest else found
    hits = hits.groupBy(F.col("_text").alias(text)).agg(F.collect_list("_entry").alias("_entries"))
    out = split_hot_join(df, hits, [text], unique_right=True).select(*df.columns, F.explode("_entries").alias("_m"))
    return out.select(*df.columns, *[F.col("_m")[f].alias(f) for f in fields])


def match_patterns(
    df: DataFrame, text: str, patterns: list[dict] | DataFrame, fields: list[str], flags: str = ""
) -> DataFrame:
    """Rows of ``df`` next to ``fields`` of every matching pattern; without patterns, no rows.

    A table of more than ``MOST_INLINE`` rows is joined by literals; only its patterns without one are read by the driver.
    """
    if isinstance(patterns, DataFrame) and patterns.limit(MOST_INLINE + 1).count() > MOST_INLINE:
        return _match_large(df, text, patterns, fields, flags)
    found = F.explode(pattern_array(F.col(text), pattern_rows(patterns, fields), fields, flags))
    return df.select("*", found.alias("_m")).select(*df.columns, *[F.col("_m")[f].alias(f) for f in fields])
