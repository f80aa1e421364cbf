"""what costs less than a pattern tells lines and tokens apart, and nothing is lost by it."""

import random

from pyspark.sql import functions as F

from compoundry.functions import cas
from compoundry.functions.sheets import h_codes, p_codes, signal_words
from compoundry.operators import sheets


def test_components_need_only_lines_with_a_number(spark):
    text = "SECTION 1: A\nEthanol 64-17-5 10 %\nDanger H225 P301+P310\nno number 1-2-3\n\nWater 7732-18-5, 64-17-5 20 - 30 %\nbad 64-17-6"
    pages = spark.createDataFrame([(1, 1, text), (1, 2, "Ethanol 64-17-5 90 %\r\nWARNING"), (2, 1, ""), (2, 2, None), (None, 1, text)],
                                  "doc_id bigint, page_no int, text string")
    every, some = (sheets.mined_lines(pages, tagged=False, numbers=n) for n in (False, True))
    assert {r["line"] for r in some.collect()} == {"Ethanol 64-17-5 10 %", "Water 7732-18-5, 64-17-5 20 - 30 %", "bad 64-17-6", "Ethanol 64-17-5 90 %"}
    assert sorted(map(str, sheets.extract_components(some).collect())) == sorted(map(str, sheets.extract_components(every).collect()))


def test_tokens_and_guards_give_what_the_patterns_give(spark):
    rng = random.Random(4)
    parts = ["64-17-5", "7732-18-5", "1234567-89-0", "12-34-5", " ", "H225", "P301+P310", "h225", "danger", "WARNİNG", "Warning", "ſ", "-", "1", "K"]
    rows = [(k, "".join(rng.choices(parts, k=rng.randint(0, 6)))) for k in range(400)] + [(400, None), (401, "")]
    df = spark.createDataFrame(rows, "id int, line string").select("*", cas.extract_cas_bounded(F.col("line")).alias("found"))
    line = F.col("line")
    guarded = [F.col("found"), h_codes(line), p_codes(line), signal_words(line)]
    plain = [F.expr(f"regexp_extract_all(line, r'{p}', {g})") for p, g in (
        (cas.P.CAS_TOKEN_BOUNDED, 0), (cas.P.H_CODE, 0), (cas.P.P_CODE, 0), (cas.P.SIGNAL_WORD, 1))]
    plain[3] = F.transform(plain[3], F.upper)
    for a, b in zip(guarded, plain, strict=True):
        assert df.filter(~a.eqNullSafe(b)).count() == 0
    tokens = df.select(F.explode("found").alias("t")).select("t", cas.cas_of_token(F.col("t")).alias("a"), cas.cas_normalize(F.col("t")).alias("b"))
    assert tokens.filter("a is not null").count() > 0 and tokens.filter("a is null").count() > 0
    assert tokens.filter("not (a <=> b)").count() == 0
