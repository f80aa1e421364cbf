"""Golden literals of the column functions."""

import pytest
from pyspark.sql import functions as F

from compoundry.functions import cas, jsons, sheets, text, trigram


def value(spark, function, s, t=None):
    """The result of a function of the columns (s, t)."""
    df = spark.createDataFrame([(s, t)], "s string, t string")
    return df.select(function(F.col("s"), F.col("t")).alias("v")).first()[0]


@pytest.mark.parametrize(
    "s, want",
    [("67-64-1", "67-64-1"), ("64-17-5", "64-17-5"), ("67-64-2", None), ("x 7732185", "7732-18-5"), ("12", None),
     ("", None), (None, None), ("12345678901", None)],
)
def test_cas_normalize(spark, s, want):
    assert value(spark, lambda S, T: cas.cas_normalize(S), s) == want
    assert value(spark, lambda S, T: cas.cas_is_valid(S), s) is (want is not None)


def test_cas_shapes(spark):
    assert value(spark, lambda S, T: cas.normalize_cas(S), "67-64-2") == "67-64-2"
    assert value(spark, lambda S, T: cas.is_cas_shaped(S), "67-64-1\n") is False
    assert value(spark, lambda S, T: cas.extract_cas_bounded(S), "a 67-64-1, 1234567890-12-3 x 99-67-64-1") == ["67-64-1", "67-64-1"]
    assert value(spark, lambda S, T: cas.extract_cas_loose(S), "a 67-64-1, 1234567890-12-3") == ["67-64-1", "4567890-12-3"]


@pytest.mark.parametrize(
    "s, want",
    [("Sodium Hydroxide 50% w/v Drum", "Sodium Hydroxide"), ("Acetone ACS 50% drum", "Acetone 50%"), ("", None), (None, None),
     ("Foo  bar ® ", "Foo bar"), ("kg", ""), ("Ammonia aq. solution", "Ammonia .")],
)
def test_normalize_name(spark, s, want):
    assert value(spark, lambda S, T: text.normalize_name(S), s) == want


@pytest.mark.parametrize(
    "s, want",
    [("10-20 %", (10, 20, "%")), ("≤ 5 %", (5, 5, "%")), ("1.5 to 2.5%", (1.5, 2.5, "%")), ("67-64-1 - 20%", (1, 20, "%")),
     ("none", (None, None, None)), ("5 – 7 %", (5, 7, "%")), (None, (None, None, None)), ("%", (None, None, None))],
)
def test_parse_concentration(spark, s, want):
    assert tuple(value(spark, lambda S, T: sheets.parse_concentration(S), s)) == want


def test_sheet_codes(spark):
    assert value(spark, lambda S, T: sheets.h_codes(S), "H300+H310 H360FD EUH066") == ["H300", "H310"]
    assert value(spark, lambda S, T: sheets.p_codes(S), "P303+P361+P353") == ["P303+P361", "P353"]
    assert value(spark, lambda S, T: sheets.signal_words(S), "Danger: warning DANGERS") == ["DANGER", "WARNING"]
    assert value(spark, lambda S, T: sheets.section_tag(S), "x section  3: foo") == "SECTION  3"
    assert value(spark, lambda S, T: sheets.section_tag(S), "SECTION 3A") is None
    assert value(spark, lambda S, T: sheets.component_name(S, T), " - Acetone , 67-64-1 5% 67-64-1", "67-64-1") == "Acetone"


def test_title_case(spark):
    assert value(spark, lambda S, T: text.title_case(S), "n-butyl ACETATE (tech)") == "N-Butyl Acetate (Tech)"


@pytest.mark.parametrize(
    "a, b, want",
    [("word", "two words", 0.363636), ("acetone", "acetone.pdf", 0.666667), ("", "a", 0.0), (None, "a", None), ("a b", "b a", 1.0),
     ("Ünder 𝐀b", "ünder 𝐀B", 1.0)],
)
def test_trigram_similarity(spark, a, b, want):
    for x, y in ((a, b), (b, a)):
        got = value(spark, lambda S, T: trigram.trigram_similarity(S, T), x, y)
        assert got is None if want is None else got == pytest.approx(want, abs=1e-6)


def test_request_key(spark):
    def key(S, T):
        return text.request_key(F.lit(None).cast("string"), F.lit(None).cast("bigint"), S)

    assert value(spark, key, " Acetone ") == "pubchem|name|None|acetone"


def test_json(spark):
    assert value(spark, lambda S, T: jsons.json_text(S, "CAS#"), '{"CAS#":"x"}') == "x"
    assert value(spark, lambda S, T: jsons.json_text(S, "w", "double"), '{"w":"n/a"}') is None
    assert value(spark, lambda S, T: jsons.json_text_array(S, "Synonyms"), '{"Synonyms":"x"}') == []
    for s, ok in [('{"a":1}', True), ("[1]", False), ("{bad", False), ("null", False), ('{"a":1} x', False), ("{}", True), (None, False)]:
        assert value(spark, lambda S, T: jsons.is_json_object(S), s) is ok
    assert value(spark, lambda S, T: jsons.first_property(S), '{"PropertyTable":{"Properties":[]}}') is None
    assert value(spark, lambda S, T: jsons.first_property(S), '{"PropertyTable":{"Properties":[{"CID":7}]}}')["CID"] == 7


def test_sanitize(spark):
    df = spark.sql(
        "select double('nan') a, array(double('infinity'), 1.5D) b, named_struct('d', date'2024-01-02') c, 1.50BD e, "
        "timestamp'2024-01-02 03:04:05.5' f, map(1, double('-infinity')) g"
    )
    js = df.select(jsons.row_json(df)).first()[0]
    assert js == (
        '{"a":null,"b":[null,1.5],"c":{"d":"2024-01-02"},"e":1.5,"f":"2024-01-02T03:04:05.500000+00:00","g":{"1":null}}'
    )
