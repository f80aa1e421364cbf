"""Sheet mining against a sequential reading of the same text."""

import random
import re

from compoundry.operators import sheets

CAS = re.compile(r"(?<![0-9])[0-9]{2,7}-[0-9]{2}-[0-9](?![0-9])")
HEADING = re.compile(r"(?:^|\n)[^\S\n]*(?:SECTION|SEC\.)\s*([0-9]{1,2})(?![0-9])\s*[:.-]?\s*(\S[^\n]*)", re.I)
LINES = [
    "SECTION {n}: Title {n}", "section {n} - lower", "SEC. {n}. Short", "  SECTION {n}", "see section 9 there", "Acetone 67-64-1 10-20 %",
    "Ethanol, 64-17-5 5 %", "Bad 67-64-2", "Acetone 67-64-1", "H225 H319 P303+P361+P353", "H225 again", "Danger", "warning text", "",
    "plain words", "SECTION 123 no heading", "two 67-64-1 and 64-17-5 1 to 2%", "tail\x0bSECTION 4 vt\x0cH300",
]


def valid(number):
    digits = number.replace("-", "")
    return sum((i + 1) * int(d) for i, d in enumerate(reversed(digits[:-1]))) % 10 == int(digits[-1])


def make(seed, docs=12):
    rnd = random.Random(seed)
    pages = []
    for d in range(docs):
        for no in range(1, rnd.randint(2, 7)):
            lines = [rnd.choice(LINES).format(n=rnd.randint(1, 18)) for _ in range(rnd.randint(0, 6))]
            pages.append((d, no, rnd.choice(["\n", "\n", "\r\n"]).join(lines).strip()))
    rnd.shuffle(pages)
    return pages


def read(pages):
    """Line by line, in order: (entities, components, hazards)."""
    entities, components, hazards = [], {}, {}
    seen, section, doc = set(), None, None
    for d, no, text in sorted(pages):
        if d != doc:
            doc, section = d, None
        for line in text.splitlines():
            tag = re.search(r"\bSECTION\s*[0-9]+\b", line, re.I)
            section = tag.group(0).upper() if tag else section
            for c in CAS.findall(line):
                norm = c if valid(c) else None
                if norm is None or (d, "CAS", norm) not in seen:
                    entities.append((d, no, section, "CAS", c, norm))
                    seen.add((d, "CAS", norm))
                name = line.split(c)[0].strip(" ,;:-")
                components.setdefault((d, norm or "", name.lower()), (no, name or None, c))
            codes = re.findall(r"\bH[0-9]{3}[A-Z]?\b", line) + re.findall(r"\bP[0-9]{3}[A-Z]?(?:\+P[0-9]{3}[A-Z]?)?\b", line)
            for code in codes:
                first = hazards.get((d, code), (no, section))[:2]
                hazards[d, code] = (*first, line.strip())
            for s in re.findall(r"\b(DANGER|WARNING)\b", line, re.I):
                if (d, "SIGNAL", s.upper()) not in seen:
                    entities.append((d, no, section, "SIGNAL", s.upper(), s.upper()))
                    seen.add((d, "SIGNAL", s.upper()))
    return entities, components, hazards


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_mining_equals_reading_in_order(spark):
    pages = make(1)
    df = spark.createDataFrame(pages, "doc_id long, page_no int, text string").repartition(5)
    entities, components, hazards = read(pages)
    for width in (2, 1024):
        lines = sheets.mined_lines(df, width)
        assert rows(sheets.extract_entities(lines)) == sorted(entities, key=repr)
        got = {(r.doc_id, r.cas_norm, r.name_key): (r.page_no, r.name, r.cas) for r in sheets.extract_components(lines).collect()}
        assert got == components
        got = {(r.doc_id, r.code): (r.page_no, r.section, r.statement) for r in sheets.extract_hazards(lines).collect()}
        assert got == hazards


def sections(pages):
    out = {}
    for d in sorted({p[0] for p in pages}):
        full = "\n".join(t for _, _, t in sorted(p for p in pages if p[0] == d))
        marks, at = [], 0
        while m := HEADING.search(full, at):
            marks.append((m.start(), int(m.group(1)), m.group(2).strip()))
            at = m.end(1)
        for i, (start, no, title) in enumerate(marks):
            body = full[start : marks[i + 1][0] if i + 1 < len(marks) else len(full)].strip()
            # an untitled heading right above another heading has no title of its own
            own = None if re.fullmatch(r"(?:SECTION|SEC\.)\s*[0-9]{1,2}", body, re.I) else title
            if 1 <= no <= 16:
                old = out.get((d, no), (None, None))
                out[d, no] = (own if own is not None else old[0], body)
    return out


def test_sections_equal_whole_text_split(spark):
    for seed in (2, 3, 4):
        pages = [(d, n, t.replace("\r\n", "\n")) for d, n, t in make(seed)]
        df = spark.createDataFrame(pages, "doc_id long, page_no int, text string").repartition(5)
        for width in (2, 1024):
            got = {(r.doc_id, r.section_no): (r.title, r.text) for r in sheets.split_sections(df, width).collect()}
            assert got == sections(pages)


def test_headings_over_several_pages(spark):
    parts = ["SECTION", "3", "Title x" + "y" * 90, "", "  ", "\n" * 70, "SECTION 4", ":", "-", "9", "text", "SEC.", "1", "2", "SECTION 5\nBody", "SECTION"]
    rnd = random.Random(8)
    for _ in range(6):
        pages = [(d, n, rnd.choice(parts)) for d in range(25) for n in range(1, 14)]
        pages += [(90, 1, "SECTION"), (90, 2, "3"), (90, 3, "Title x"), (91, 1, "SECTION"), (91, 2, "3" + "\n" * 70 + "Title x")]
        df = spark.createDataFrame(pages, "doc_id long, page_no int, text string")
        for width in (3, 1024):
            got = {(r.doc_id, r.section_no): r.text for r in sheets.split_sections(df, width).collect()}
            assert got == {k: v[1] for k, v in sections(pages).items()}
            assert (90, 3) in got and (91, 3) in got


def test_lines_follow_all_line_breaks(spark):
    text = "a\r\nb\x0bc\x0cd\re f\x85g\n\nh\n"
    df = spark.createDataFrame([(1, 1, text), (1, 2, ""), (1, 3, None), (2, 1, "x")], "doc_id long, page_no int, text string")
    got = [(r.line_no, r.line) for r in sheets.explode_lines(df).filter("doc_id=1").orderBy("line_no").collect()]
    assert got == list(enumerate(text.splitlines(), 1))


def test_control_characters_are_text_like_any_other(spark):
    pages = [(1, 1, "SECTION 1 Title\nabc\x01def\nSECTION 2 Foo\nbar"), (1, 2, "\x01\nSECTION"), (1, 3, "3 \x01x\n\x01SECTION 4 y"),
             (2, 1, "SECTION 1 a\x00b\x02\x01")]
    df = spark.createDataFrame(pages, "doc_id long, page_no int, text string")
    got = {(r.doc_id, r.section_no): (r.title, r.text) for r in sheets.split_sections(df).collect()}
    assert got == {
        (1, 1): ("Title", "SECTION 1 Title\nabc\x01def"), (1, 2): ("Foo", "SECTION 2 Foo\nbar\n\x01"),
        (1, 3): ("\x01x", "SECTION\n3 \x01x\n\x01SECTION 4 y"), (2, 1): ("a\x00b\x02\x01", "SECTION 1 a\x00b\x02\x01")}
    assert got == sections(pages)


def test_texts_are_scanned_once_for_lines_and_twice_for_sections(spark, tmp_path):
    """What follows the scans works on written, narrower rows."""
    spark.createDataFrame(make(5), "doc_id long, page_no int, text string").write.parquet(str(tmp_path / "pages"))
    df = spark.read.parquet(str(tmp_path / "pages"))
    for made in (sheets.extract_entities(sheets.mined_lines(df)), sheets.split_sections(df)):
        assert str(tmp_path / "pages") not in made._jdf.queryExecution().toString()


def test_mining_leaves_its_results_and_no_copies_of_texts(spark, tmp_path, monkeypatch):
    """of what is written on the way only the results stay in the shared folder."""
    import os

    from pyspark.sql import functions as F

    from compoundry import schemas, session
    from compoundry.plans import flows

    text = "SECTION 1: Start\nEthanol 64-17-5 10 %\nDanger H225\nSECTION 17: Extra"
    pages = spark.createDataFrame([(d, p, f"{text} {d}") for d in (1, 2) for p in (1, 2)], "doc_id long, page_no int, text string")
    docs = spark.createDataFrame([(1, 5, "a", "a.pdf"), (2, None, "b", "b.pdf")], "doc_id long, product_id long, title string, filename string")
    items = spark.createDataFrame([(5, "thing", None)], "source_item_id long, name string, cas string")
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    out = flows.sds_mine(docs, pages, items, schemas.empty(spark, "product_chem_xref"), schemas.empty(spark, "chemical_registry"),
                         F.current_timestamp())
    left = {n.rsplit("-", 1)[0] for n in os.listdir(tmp_path)}
    assert not left & {"hits", "lines", "starts", "pieces", "links"}
    assert {"entities", "components", "hazards", "sections", "violations", "xref"} <= left
    assert out["section_violation"].count() == 4 and out["sds_section"].count() == 2
    assert [r.external_id for r in out["product_chem_xref"].collect()] == ["64-17-5"]
    assert all(df.count() >= 0 for df in out.values())
