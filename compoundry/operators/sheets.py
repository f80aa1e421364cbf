"""Safety-sheet mining: X01-X05, W03, W04, A03, A11, A12, J14, J15.

Text is worked on inside its page row. What crosses a page border (the last section tag, the last
heading) travels as one small value per page (see ``carry``), so no document is gathered to be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.cas import cas_of_token, extract_cas_bounded
from ..functions.sheets import component_name, h_codes, p_codes, parse_concentration, section_tag, signal_words
from ..functions.text import strip_ws
from ..session import durable
from .carry import RANGE, carry
from .quality import check_range

# A line that names a section; the number stands on the same line. The plain pattern knows the line
# breaks of the regular expression engine; pages with rarer ones take the exact, slower pattern.
# The word's first edge is looked at where the word stands, not at every character.
_TAG_INLINE = r"SECTION(?<=\bSECTION)" + P.INLINE_WS + r"*[0-9]+\b"
_RARE_BREAKS = r"[\x0B\x0C\x1C-\x1E]"
_NOT_NEWLINE_BREAKS = r"[\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
_LINE_CHARS = "[^" + P.LINE_BREAK_CHARS + "]*"
_TAGGED_LINE = r"(?im)^(?=.*" + _TAG_INLINE + ")"
_TAGGED_LINE_EXACT = "(?im)(?:^|(?<=" + _RARE_BREAKS + "))(?=" + _LINE_CHARS + _TAG_INLINE + ")"
_LAST_TAG = "(?is)(?:.*[" + P.LINE_BREAK_CHARS + "]|^)" + _LINE_CHARS + "?(" + _TAG_INLINE + ")"
_NUMBER_HIT = r"[0-9]-[0-9]{2}-[0-9]"
_ANY_HIT = "(?=[0-9HPDWdw])(?:" + _NUMBER_HIT + r"|[HP](?<=\b[HP])[0-9]{3}|(?i:DANGER|WARNING))"

# A heading: keyword and number at the start of a line, then a title that may stand on a later line.
_GAP = P.WS + "*"
_NUMBERED = r"(?:SECTION|SEC\.)" + _GAP + r"([0-9]{1,2})(?![0-9])"
_HEAD = _NUMBERED + _GAP + r"[:.-]?" + _GAP
_INDENT = P.INLINE_WS + "*"
_HEADING_AHEAD = r"(?imd)^(?=" + _INDENT + _HEAD + r"[^\n" + P.WS[1:] + ")"
_HEADING_AT_START = r"(?i)\A" + _INDENT + _HEAD + r"[^\n" + P.WS[1:]
# A page that ends inside a heading: nothing visible follows its keyword, its number or its separator.
_OPEN_END = "(?imd)^" + _INDENT + r"(?:SECTION|SEC\.)" + _GAP + "(?:[0-9]{1,2}" + _GAP + r"[:.-]?)?" + _GAP + r"\z"
# A page that ends so has nothing else behind the last SEC of its text, which costs less to look at.
_MAY_BE_OPEN = r"\A(?:TION|\.)" + _GAP + "(?:[0-9]{1,2}" + _GAP + r"[:.-]?)?" + _GAP + r"\z"
_HEADING_PARTS = "(?i)^" + P.WS + "*" + _HEAD + r"([^\n]+?)" + P.WS + r"*(?:\n|\z)"
# What the next written pages must show of themselves: a number of two digits, what follows it, one separator and one
# visible character are within eight visible characters. With each run of white space as one blank, sixteen hold them.
_VISIBLE, _NEXT_CHARS = 8, 16
_BEGINNING = r"\A" + _GAP + "(?:[^" + P.WS[1:] + _GAP + "){0," + str(_NEXT_CHARS) + "}"
SECTION_RANGE = (1, 16)


def _lines(text: Column) -> Column:
    """Lines of a text; a text with line feeds only is split on one character, without a pattern."""
    return F.when(text.rlike(_NOT_NEWLINE_BREAKS), F.split(text, P.LINE_BREAK, -1)).otherwise(F.split(text, "\n", -1))


def _without_last_break(text: Column) -> Column:
    return F.regexp_replace(text, "(?:" + P.LINE_BREAK + r")\z", "")


def explode_lines(pages: DataFrame) -> DataFrame:
    """The lines of each page, numbered from 1; a final line break opens no further line."""
    text = _without_last_break(F.col("text"))
    return (
        pages.filter(F.col("text") != "")
        .select("doc_id", "page_no", text.alias("text"))
        .select("doc_id", "page_no", F.posexplode(_lines(F.col("text"))).alias("line_no", "line"))
        .withColumn("line_no", F.col("line_no") + 1)
    )


def _segments(text: Column) -> Column:
    """A page cut before every line that names a section."""
    return F.when(text.rlike(_RARE_BREAKS), F.split(text, _TAGGED_LINE_EXACT, -1)).otherwise(
        F.split(text, _TAGGED_LINE, -1)
    )


def with_section(pages: DataFrame, width: int | None = None) -> DataFrame:
    """W04 on pages: rows (doc, page, segment, text, section), the section carried across pages."""
    last_tag = F.upper(F.nullif(F.regexp_extract("text", _LAST_TAG, 1), F.lit("")))
    base = pages.filter(F.col("text") != "").select("doc_id", "page_no", "text", last_tag.alias("_last_tag"))
    carried = carry(base, "doc_id", "page_no", "_last_tag", "_carried", **({"width": width} if width else {}))
    return carried.select(
        "doc_id", "page_no", "_carried", F.posexplode(_segments(F.col("text"))).alias("segment", "text")
    ).select("doc_id", "page_no", "segment", "text", F.coalesce(_segment_tag(F.col("text")), "_carried").alias("section"))


def _segment_tag(segment: Column) -> Column:
    return F.upper(F.nullif(F.regexp_extract(segment, "(?i)" + _TAG_INLINE, 0), F.lit("")))


def carry_section(pages: DataFrame, width: int | None = None) -> DataFrame:
    """W04 on lines: every line with the section tag seen last, across the pages of a document."""
    s = with_section(pages, width).withColumn("text", _without_last_break(F.col("text")))
    return s.select("doc_id", "page_no", "segment", "section", F.posexplode(_lines(F.col("text"))).alias("n", "line"))


def mined_lines(pages: DataFrame, width: int | None = None, tagged: bool = True, numbers: bool = False) -> DataFrame:
    """Lines that may hold a number, a code or a signal word, with section and position; others are dropped early.

    Without ``tagged`` the section is NULL and nothing crosses pages, which is enough for components. With ``numbers`` as
    well only lines that may hold a number stay.
    Texts are read once: of each page the tags of its segments and the lines in question are written to the shared folder.
    What crosses pages is carried over these narrow rows and joined to the lines above the first tag of their page.
    ``session.settled`` writes the result and removes what was written for it.
    """
    if not tagged:
        lines = pages.filter(F.col("text") != "").select("doc_id", "page_no", F.posexplode(_lines(F.col("text"))).alias("n", "line"))
        hit = F.col("line").contains("-") & F.col("line").rlike(_NUMBER_HIT) if numbers else F.col("line").rlike(_ANY_HIT)
        return lines.filter(hit).select(
            "doc_id", "page_no", F.lit(None).cast("string").alias("section"), "line",
            F.struct("page_no", F.lit(0).alias("segment"), "n").alias("pos"))
    segments = F.transform(_segments(F.col("text")), lambda s, k: F.struct(
        k.alias("segment"), _segment_tag(s).alias("section"),
        F.filter(F.transform(_lines(s), lambda line, n: F.struct(n.alias("n"), line.alias("line"))),
                 lambda x: x["line"].rlike(_ANY_HIT)).alias("lines")))
    read = durable(pages.filter(F.col("text") != "").select("doc_id", "page_no", segments.alias("_segments")), "hits")
    hits = read.select("doc_id", "page_no", F.explode("_segments").alias("s")).select(
        "doc_id", "page_no", "s.segment", "s.section", F.explode("s.lines").alias("x")).select(
        "doc_id", "page_no", "section", "x.line", F.struct("page_no", "segment", "x.n").alias("pos"))
    first, last = F.element_at("_segments", 1), F.element_at("_segments", -1)
    tags = read.select("doc_id", "page_no", last["section"].alias("_tag"), (
        first["section"].isNull() & (F.size(first["lines"]) > 0)).alias("_wants"))
    carried = carry(tags, "doc_id", "page_no", "_tag", "_carried", **({"width": width} if width else {})).filter(
        "_wants and _carried is not null").select("doc_id", "page_no", "_carried")
    above = hits.filter("section is null").join(carried, ["doc_id", "page_no"], "left").withColumn("section", F.col("_carried"))
    out = hits.filter("section is not null").unionByName(above.drop("_carried"))
    out._made_from = [read]
    return out


def _hits(lines: DataFrame, found: Column, extra: list[str] | None = None) -> DataFrame:
    return lines.select(*lines.columns, F.posexplode(found).alias("_ord", "value")).withColumn(
        "pos", F.struct("pos.page_no", "pos.segment", "pos.n", "_ord")
    ).drop("_ord")


def extract_entities(lines: DataFrame) -> DataFrame:
    """X02 + M12: numbers and signal words; the first of each normal form per document.

    Numbers with a wrong check digit have no normal form and are all kept: their position makes the
    grouping key unique, so one pass and one shuffle serve both cases.
    """
    line = F.col("line")
    kind = F.when(F.col("value").rlike("^[0-9]"), "CAS").otherwise("SIGNAL")  # numbers begin with a digit, words don't
    hits = _hits(lines, F.concat(extract_cas_bounded(line), signal_words(line))).select(
        "doc_id", "page_no", "section", kind.alias("entity_type"), "value", "pos"
    )
    # what a branch holds is not shared: the check of the number comes first and is NULL for words
    normal = F.coalesce(cas_of_token(F.col("value")), F.when(F.col("entity_type") == "SIGNAL", F.col("value")))
    keyed = hits.withColumn("norm_value", normal).withColumn("_own", F.when(F.col("norm_value").isNull(), F.col("pos")))
    return (
        keyed.groupBy("doc_id", "entity_type", "norm_value", "_own")
        .agg(F.min(F.struct("pos", "section", "value")).alias("f"))
        .select("doc_id", "f.pos.page_no", "f.section", "entity_type", "f.value", "norm_value")
    )


def extract_components(lines: DataFrame) -> DataFrame:
    """X03 + M13: one row per number hit, with name and concentration; the first per (document, number, name)."""
    hits = _hits(lines, extract_cas_bounded(F.col("line"))).withColumn("_name", component_name(F.col("line"), F.col("value")))
    rows = hits.select(
        "doc_id", F.nullif("_name", F.lit("")).alias("name"), F.col("value").alias("cas"),
        F.coalesce(cas_of_token(F.col("value")), F.lit("")).alias("cas_norm"),
        F.lower("_name").alias("name_key"), parse_concentration(F.col("line")).alias("c"), "pos",
    )
    return (
        rows.groupBy("doc_id", "cas_norm", "name_key")
        .agg(F.min(F.struct("pos", "name", "cas", "c")).alias("f"))
        .select(
            "doc_id", "f.pos.page_no", "f.name", "f.cas", "cas_norm", "name_key",
            F.col("f.c.low").alias("conc_low"), F.col("f.c.high").alias("conc_high"), F.col("f.c.unit").alias("conc_units"),
        )
    )


def extract_hazards(lines: DataFrame) -> DataFrame:
    """X04 + M14: H and P codes per document; place of the first hit, statement of the last."""
    hits = _hits(lines, F.concat(h_codes(F.col("line")), p_codes(F.col("line"))))
    return (
        hits.groupBy("doc_id", F.col("value").alias("code"))
        .agg(F.min(F.struct("pos", "section")).alias("f"), F.max(F.struct("pos", "line")).alias("l"))
        .select("doc_id", "f.pos.page_no", "f.section", "code", strip_ws(F.col("l.line")).alias("statement"))
    )


def following(starts: DataFrame) -> DataFrame:
    """Of every page that ends inside a heading (``_open``), the start of what comes after it: (``doc_id``, ``page_no``,
    ``_next``). ``starts`` has ``doc_id``, ``page_no``, ``_range``, ``_start`` (not empty) and ``_open``.

    A short page shows little, so the starts of as many following written pages as may be needed are joined; each has
    one visible character at least. Starts travel inside the range of a page, and from the ranges after it as one
    value for each range.
    """
    inside = W.partitionBy("doc_id", "_range").orderBy("page_no").rowsBetween(1, _VISIBLE)
    heads = starts.groupBy("doc_id", "_range").agg(F.array_sort(F.collect_list(F.struct("page_no", "_start"))).alias("_all"))
    heads = heads.select("doc_id", "_range", F.array_join(F.transform(F.slice("_all", 1, _VISIBLE), lambda x: x["_start"]), " ").alias("_head"))
    later = W.partitionBy("doc_id").orderBy("_range").rowsBetween(1, _VISIBLE)
    heads = heads.select("doc_id", "_range", F.collect_list("_head").over(later).alias("_later"))
    near = starts.withColumn("_near", F.collect_list("_start").over(inside)).filter("_open")
    return near.join(heads, ["doc_id", "_range"]).select(
        "doc_id", "page_no", F.array_join(F.concat("_near", "_later"), " ").alias("_next"))


def section_pieces(pages: DataFrame, width: int | None = None) -> DataFrame:
    """Every heading with its body, in reading order: (doc, page, piece, section_no, title, text).

    A page is cut at its headings. Where it ends inside one, the first visible characters of the next written pages are
    in view while cutting, because number and title may stand there. The part of a page before its first heading goes
    on with the heading carried from earlier pages.

    Texts are read twice: once for their starts and ends, which are narrow, and once to be cut. The pieces are written
    to the shared folder; of these only the first ones of pages without a heading at their start are joined again.
    ``session.settled`` writes the result and removes what was written for it.
    """
    w = {"width": width} if width else {}
    rows = pages.select("doc_id", "page_no", F.coalesce("text", F.lit("")).alias("text"))
    # no more of a text is looked at than holds that many visible characters
    start = strip_ws(F.regexp_replace(F.regexp_extract("text", _BEGINNING, 0), P.WS + "+", " "))
    behind = F.call_function("substring_index", F.upper("text"), F.lit("SEC"), F.lit(-1))
    starts = rows.filter(F.col("text").rlike("[^" + P.WS[1:])).select(
        "doc_id", "page_no", F.floor(F.col("page_no") / (width or RANGE)).alias("_range"),
        F.substring(start, 1, _NEXT_CHARS).alias("_start"), F.when(behind.rlike(_MAY_BE_OPEN), F.col("text").rlike(_OPEN_END)).otherwise(False).alias("_open"))
    starts = durable(starts, "starts")
    # written, so that its size is known: few pages end so, and texts need no shuffle to meet them
    shown = durable(following(starts), "shown")
    ahead = rows.join(shown, ["doc_id", "page_no"], "left")
    # A line break stands between a page and what is shown of the next ones; a piece that begins there is theirs.
    joined = F.concat("text", F.lit("\n"), F.coalesce("_next", F.lit("")))
    size = F.length("text")
    cut = ahead.select(
        "doc_id", "page_no", size.alias("_size"), joined.rlike(_HEADING_AT_START).alias("_opens"),
        F.split(joined, _HEADING_AHEAD, -1).alias("_cut"))
    begins = F.concat(F.array(F.lit(0)), F.transform(F.sequence(F.lit(1), F.size("_cut")), lambda n: F.aggregate(
        F.slice("_cut", F.lit(1), n), F.lit(0), lambda total, p: total + F.length(p))))
    # every piece but the first starts at a heading, because the cut was made there
    pieces = cut.withColumn("_begins", begins).select(
        "doc_id", "page_no",
        F.filter(
            F.transform("_cut", lambda p, i: F.struct(
                i.alias("i"), F.get("_begins", i).alias("begin"), ((i > 0) | F.col("_opens")).alias("head"),
                F.substring(p, F.lit(1), F.col("_size") - F.get("_begins", i)).alias("body"))),
            lambda x: (x["i"] == 0) | (x["begin"] < F.col("_size"))).alias("_pieces"))
    pieces = durable(pieces, "pieces")
    last = F.element_at("_pieces", -1)
    tails = pieces.select("doc_id", "page_no", F.when(last["head"], F.struct(
        F.col("page_no").alias("p"), last["i"].alias("i"))).alias("_last"))
    carried = carry(tails, "doc_id", "page_no", "_last", "_carried", **w).filter("_carried is not null").select(
        "doc_id", "page_no", "_carried")
    # only the last piece of a page can go on, or one of a page that comes more than once; the others are whole
    pairs = pieces.groupBy("doc_id", "page_no").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = durable(pairs.select(F.col("doc_id").alias("_d"), F.col("page_no").alias("_p")), "repeated")
    twice = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("page_no").eqNullSafe(F.col("_p"))
    each = pieces.withColumn("_open", last["i"]).join(repeated.withColumn("_twice", F.lit(True)), twice, "left").select(
        "doc_id", "page_no", "_open", "_twice", F.explode("_pieces").alias("piece"))
    headed = each.filter("piece.head").select(
        "doc_id", "page_no", F.struct(F.col("page_no").alias("p"), F.col("piece.i").alias("i")).alias("home"),
        F.col("piece.body").alias("body"), ((F.col("piece.i") < F.col("_open")) & F.col("_twice").isNull()).alias("_whole"))
    whole = headed.filter("_whole").select("doc_id", "home", F.col("body").alias("text"))
    going_on = each.filter("not piece.head").select("doc_id", "page_no", F.col("piece.body").alias("body")).join(
        carried, ["doc_id", "page_no"]).select("doc_id", "page_no", F.col("_carried").alias("home"), "body")
    bodies = headed.filter("not _whole").drop("_whole").unionByName(going_on).groupBy("doc_id", "home").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("page_no", "body"))), lambda x: x["body"]), "\n"
        ).alias("text")
    )
    out = whole.unionByName(bodies).select(
        "doc_id",
        F.col("home.p").alias("page_no"),
        F.col("home.i").alias("piece"),
        F.regexp_extract("text", "(?i)^" + _INDENT + _NUMBERED, 1).try_cast("int").alias("section_no"),
        F.nullif(strip_ws(F.regexp_extract("text", _HEADING_PARTS, 2)), F.lit("")).alias("title"),
        strip_ws(F.col("text")).alias("text"),
    )
    out._made_from = [starts, shown, pieces, repeated]
    return out


def split_sections(pages: DataFrame, width: int | None = None) -> DataFrame:
    """X05 + M11: sections 1..16 of each document; of a repeated heading the last text and last title stay."""
    return sections_of(section_pieces(pages, width))


def sections_of(pieces: DataFrame) -> DataFrame:
    """X05 + M11 over ``section_pieces``."""
    pos = F.struct("page_no", "piece")
    return (
        pieces.filter(F.col("section_no").between(*SECTION_RANGE))
        .groupBy("doc_id", "section_no")
        .agg(
            F.max(F.when(F.col("title").isNotNull(), F.struct(pos.alias("p"), "title"))).alias("t"),
            F.max(F.struct(pos.alias("p"), "text")).alias("x"),
        )
        .select("doc_id", "section_no", "t.title", "x.text")
    )


def section_violations(pieces: DataFrame) -> DataFrame:
    """C04 on ``section_pieces``: headings with a number outside 1..16, every one of them with its text."""
    return check_range(pieces, "section_no", *SECTION_RANGE).select("doc_id", "page_no", "piece", "section_no", "title", "text")


def section_pivot(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """One column per section; documents without sections stay."""
    wide = sections.groupBy("doc_id").agg(
        *[F.max(F.when(F.col("section_no") == i + 1, F.col("text"))).alias(c) for i, c in enumerate(P.SECTION_COLUMNS)]
    )
    return docs.select("doc_id", "filename").join(wide, "doc_id", "left").select("doc_id", "filename", *P.SECTION_COLUMNS)


def page_count(pages: DataFrame) -> DataFrame:
    """A11."""
    return pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pages"))


def document_text(pages: DataFrame) -> DataFrame:
    """The pages of a document as one text. The result row is as large as the document."""
    ordered = F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("text"))))
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text"))


def unparsed_docs(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """Documents without any entity."""
    return docs.join(entities.select("doc_id").distinct(), "doc_id", "left_anti")


def main_component(components: DataFrame) -> DataFrame:
    """Per document the component with the highest share, then by name; an unknown share counts as 100."""
    pct = F.coalesce("conc_high", "conc_low", F.lit(100.0))
    name = F.lower("name")
    order = F.struct(-pct, name.isNull(), name, F.col("cas_norm"))
    return (
        components.filter(F.col("cas_norm") != "")
        .groupBy("doc_id")
        .agg(F.min_by(F.struct(F.col("cas_norm").alias("cas"), "name", pct.alias("pct")), order).alias("m"))
        .select("doc_id", "m.cas", "m.name", "m.pct")
    )


def backfill_cas(items: DataFrame, docs: DataFrame, main: DataFrame) -> DataFrame:
    """Give items without number the main number of their document (highest share, then lowest document)."""
    found = (
        docs.filter(F.col("product_id").isNotNull())
        .select("doc_id", F.col("product_id").alias("source_item_id"))
        .join(main.select("doc_id", "cas", "pct"), "doc_id")
        .groupBy("source_item_id")
        .agg(F.min_by("cas", F.struct(-F.col("pct"), F.col("doc_id"))).alias("_cas"))
    )
    return items.join(found, "source_item_id", "left").select(
        *[F.coalesce(F.nullif("cas", F.lit("")), "_cas", "cas").alias("cas") if c == "cas" else F.col(c) for c in items.columns]
    )
