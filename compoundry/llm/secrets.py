"""Secret scans: three fixed patterns, and two character Markov models compared by their log-likelihood ratio.

A long run of letters and digits is a secret if a model of random strings explains it better, by a set margin for
each character, than one of ordinary identifiers. Both are first-order chains over 64 character classes, trained
from labelled samples; their ratio is a table of 4,096 whole numbers (thousandths of a nat) inside the plan. All work
is DataFrame functions within a row: no shuffle and no Python.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds and their patterns, in the order in which spans of one start stand.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "markov"]

#: A candidate of the method: a run of such characters, at least so long, with a letter and a digit. Dates and joined
#: names are left to the models.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: Ordinary: long words, and joined names, dates and times, of which each part is either letters or a few digits.
PART = "(?:[A-Za-z]++|[0-9]{1,2}T[0-9]{1,6}Z?|[0-9]{1,8}+Z?)"
ORDINARY = (r"(?<![A-Za-z0-9+/_=-])(?:[A-Za-z][A-Za-z_-]{7,}|(?=[A-Za-z0-9_-]{8})"
            + PART + "(?:[_-]++" + PART + r")+)(?![A-Za-z0-9+/_=-])")
CLASSES = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-+"
#: Thousandths of a nat for each pair of characters by which "random" must be the better explanation.
MARGIN = 700
#: Documents, as a mean, from which labelled samples are taken (chosen by a hash of their id and text).
SAMPLE_DOCS = 20_000
#: Prior pairs for each character: the random model leans towards all characters alike, the ordinary one towards how
#: often a character is seen at all, which is held to be at least FLOOR.
PRIOR = {True: 1280.0, False: 32.0}
FLOOR = 0.002
MASK = "[SECRET]"
BLOCK = 512


def classes(token: Column) -> Column:
    """The class of each character of an ASCII token, as an array of 0 to 63."""
    same = F.translate(token, "_/=", "-++")
    return F.transform(F.filter(F.split(same, "", -1), lambda c: c != ""), lambda c: F.instr(F.lit(CLASSES), c) - 1)


def train(samples: DataFrame) -> list[int]:
    """The ratio table from rows (``value`` string, ``random`` boolean); null and one-character values add nothing.

    Pairs are counted in Spark; at most 2 x 4,096 counts reach the driver. Without samples the random model is even.
    """
    c = samples.filter(F.col("value").rlike(r"^[A-Za-z0-9+/_=-]{2,}$")).select("random", classes(F.col("value")).alias("_c"))
    pairs = c.select("random", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("_c") - 1), lambda k: F.get("_c", k - 1) * 64 + F.get("_c", k))).alias("pair"))
    counts = {True: [0] * 4096, False: [0] * 4096}
    for random, pair, n in pairs.groupBy("random", "pair").count().collect():
        counts[bool(random)][pair] = n

    seen = [sum(counts[False][b::64]) for b in range(64)]
    even = 1 / 64
    usual = [even if not sum(seen) else max(n / sum(seen), FLOOR) for n in seen]

    def log(random: bool, a: int, b: int) -> float:
        own, prior = counts[random], PRIOR[random]
        return math.log((own[64 * a + b] + prior * (even if random else usual[b])) / (sum(own[64 * a: 64 * a + 64]) + prior))

    return [round(1000 * (log(True, p // 64, p % 64) - log(False, p // 64, p % 64))) for p in range(4096)]


def labelled(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Labelled samples of a corpus: values that the fixed patterns find are random; long words, joined names and
    dates are ordinary.

    They come from about ``sample_docs`` documents, chosen by hash; the same rows give the same sample.
    """
    share = min(1.0, sample_docs / max(1, docs.count()))
    chosen = docs.select(doc_id, text).filter(
        F.pmod(F.xxhash64(F.lit(7), doc_id, F.substring(text, 1, 200)), F.lit(1 << 20)) < share * (1 << 20))
    t = F.col(text)
    secret = F.concat(F.regexp_extract_all(t, F.lit(ASSIGN), 2), F.regexp_extract_all(t, F.lit(ACCESS), 0),
                      F.regexp_extract_all(t, F.lit(HEX), 0))
    ordinary = F.regexp_extract_all(t, F.lit(ORDINARY), 0)
    return chosen.select(F.explode(F.concat(
        F.transform(F.filter(secret, lambda v: F.length(v) >= 16), lambda v: F.struct(v.alias("value"), F.lit(True).alias("random"))),
        F.transform(ordinary, lambda v: F.struct(v.alias("value"), F.lit(False).alias("random"))),
    )).alias("s")).select("s.value", "s.random")


def running(df: DataFrame, lengths: str, into: str) -> DataFrame:
    """Add ``into``: for each length the sum of those before it. Sums run within blocks, then over blocks."""
    empty = F.struct(F.lit(0).alias("t"), F.array().cast("array<int>").alias("a"))

    def sums(values: Column) -> Column:
        return F.aggregate(values, empty, lambda s, x: F.struct(
            (s["t"] + x).alias("t"), F.concat(s["a"], F.array(s["t"])).alias("a")))

    blocks = F.when(F.size(lengths) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
        lambda b: sums(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))))
    df = df.select("*", blocks.alias("_blocks"))
    df = df.select("*", sums(F.transform("_blocks", lambda b: b["t"]))["a"].alias("_before"))
    total = F.flatten(F.transform("_blocks", lambda b, k: F.transform(b["a"], lambda x: x + F.get("_before", k))))
    return df.select(*[c for c in df.columns if c not in ("_blocks", "_before")],
                     F.coalesce(total, F.array().cast("array<int>")).alias(into))


def located(df: DataFrame, pattern: str, into: str, value_group: int = 0) -> DataFrame:
    """Add ``into``: array of (start, end, value) of the matches of ``pattern`` in ``_text``, in code points.

    Texts without a match are read once. Starts follow from the lengths of the matches and of what lies between.
    """
    pick = lambda g: F.regexp_extract_all("_text", F.lit(pattern), g)
    none = F.array().cast("array<string>")
    df = df.select("*", pick(0).alias("_m"))
    some = F.size("_m") > 0
    df = df.select("*", F.when(some, F.split("_text", pattern, -1)).otherwise(none).alias("_gaps"),
                   (F.when(some, pick(value_group)).otherwise(none) if value_group else F.col("_m")).alias("_v"))
    steps = F.transform("_m", lambda m, k: F.length(m) + F.length(F.get("_gaps", k)))
    df = running(df.select("*", steps.alias("_steps")), "_steps", "_sums")
    spans = F.transform("_m", lambda m, k: F.struct(
        (F.get("_sums", k) + F.length(F.get("_gaps", k))).alias("start"),
        (F.get("_sums", k) + F.length(F.get("_gaps", k)) + F.length(m)).alias("end"),
        F.get("_v", k).alias("value")))
    gone = {"_m", "_gaps", "_v", "_steps", "_sums"}
    return df.select(*[c for c in df.columns if c not in gone], spans.alias(into))


def scan(docs: DataFrame, table: Sequence[int], text: str = "text", margin: int = MARGIN) -> DataFrame:
    """``_row`` (the whole document), ``_text``, and ``secrets``: array of (start, kind, end, value), sorted.

    ``kind`` is a place in KINDS, starts and ends are code points (end exclusive). Spans of the fixed patterns all
    stay; those of the method are added where they touch none of them. A null text is an empty one and has none.
    Repeated rows are scanned alike; all columns stay in ``_row``, so their names clash with nothing.
    """
    df = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    df = located(df, ASSIGN, "_assign", 2)
    df = located(df, ACCESS, "_access")
    df = located(df, HEX, "_hex")

    def kind(name: str, number: int, keep) -> Column:
        return F.transform(F.filter(name, keep), lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))

    base = F.concat(kind("_assign", 0, lambda s: F.length(s["value"]) >= 8), kind("_access", 1, lambda s: F.lit(True)),
                    kind("_hex", 2, lambda s: F.lit(True)))
    df = df.select("_row", "_text", F.array_sort(base).alias("_base"))
    df = located(df, CANDIDATE, "_candidates")
    likely = F.filter("_candidates", lambda s: (
        s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")))
    df = df.select("_row", "_text", "_base", likely.alias("_likely"))
    df = df.select("*", F.transform("_likely", lambda s: classes(s["value"])).alias("_classes"))
    lookup = F.expr(f"array({','.join(map(str, table))})")

    def score(c: Column) -> Column:
        return F.aggregate(c, F.struct(F.lit(-1).alias("last"), F.lit(0).alias("sum")), lambda a, x: F.struct(
            x.alias("last"), (a["sum"] + F.when(a["last"] < 0, 0).otherwise(F.get(lookup, a["last"] * 64 + x))).alias("sum")),
        )["sum"]

    scored = F.transform("_classes", lambda c: score(c) >= margin * (F.size(c) - 1))
    df = df.select("_row", "_text", "_base", "_likely", scored.alias("_random"))
    random = F.filter("_likely", lambda s, k: F.get("_random", k) & ~F.exists(
        "_base", lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"])))
    found = F.concat("_base", F.transform(random, lambda s: F.struct(
        s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end"), s["value"].alias("value"))))
    return df.select("_row", "_text", F.array_sort(found).alias("secrets"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(scanned: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents of ``scan`` with MASK in place of each secret value, and ``length`` (if there) set anew.

    Documents without secrets stay as they are, a null text included. Values that overlap get one mask.
    """
    values = F.array_sort(F.transform("secrets", lambda s: F.struct(
        (s["end"] - F.length(s["value"])).alias("start"), s["end"].alias("end"))))
    df = scanned.select("_row", "_text", values.alias("_values"))
    joined = F.aggregate("_values", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
                         lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(
            F.substring(F.col("_text"), a["at"] + 1, s["start"] - a["at"]), F.lit(MASK)))).alias("out")))
    df = df.select("*", F.when(F.size("_values") > 0, joined).alias("_cut"))
    new = F.when(F.col("_cut").isNotNull(), F.concat(
        F.array_join("_cut.out", ""), F.expr("substring(_text, _cut.at + 1)"))).otherwise(F.col("_row")[text])
    df = df.select("_row", new.alias("_new"))
    columns = []
    for c in df.schema["_row"].dataType.names:
        value = F.col("_new") if c == text else F.col("_row")[c]
        if c == length:
            value = F.when(F.col("_new").isNull(), value).otherwise(F.length("_new")).cast(df.schema["_row"].dataType[c].dataType)
        columns.append(value.alias(c))
    return df.select(*columns)
