import pytest
from pyspark.sql import functions as F

from riskloom.functions import demographics as D, parsing as P, scorecard as C, status as S
from riskloom.functions.probability import hard_predict, stable_sigmoid


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(expression(F.col("v")), "i").orderBy("i").collect()]


def test_integers_are_strict(spark):
    text = ["7", " 7", "+8", "9.0", "x1", "", None, "-3", "99999999999999999999", "7\n", "1_0"]
    got = column(spark, text, "string", lambda c: P.parse_number(c, "bigint"))
    assert got == [7, None, 8, None, None, None, None, -3, None, None, None]


def test_doubles_are_strict(spark):
    text = ["1.5", "1d", ".5", "5.", "1e3", "-2E-2", "n/a", "", " 1", "inf", "-Infinity", "1,0"]
    got = column(spark, text, "string", lambda c: P.parse_number(c, "double", 9.0))
    inf = float("inf")
    assert got == [1.5, 9.0, 0.5, 5.0, 1000.0, -0.02, 9.0, 9.0, 9.0, inf, -inf, 9.0]
    nan = column(spark, ["NaN", "-nan"], "string", lambda c: P.parse_number(c, "double", 9.0))
    assert all(v != v for v in nan)


def test_flags_and_blanks(spark):
    assert column(spark, ["Y", "y", " Y", None], "string", lambda c: P.flag(c, "Y")) == [True, False, False, False]
    assert column(spark, ["a ", "  ", "\t\n", "", None], "string", P.blank_to_null) == ["a ", None, None, None, None]


def test_status_codes(spark):
    text = [" 2 ", "?", "", None, "C", "X", "5", "6", "\t1"]
    assert column(spark, text, "string", S.parse_status) == ["2", "0", "0", "0", "C", "X", "5", "0", "1"]
    codes = ["C", "X", "0", "1", "2", "3", "4", "5"]
    assert column(spark, codes, "string", S.severity) == [0, 0, 1, 2, 3, 4, 5, 6]
    assert column(spark, codes, "string", S.is_severe) == [False] * 4 + [True] * 4
    raw = ["C", "?", "0 ", "7", None, "5"]
    assert column(spark, raw, "string", lambda c: S.severity(c, "mart")) == [0, 0, 1, 8, 0, 6]
    assert column(spark, raw, "string", lambda c: S.is_past_due(c, "mart")) == [False, False, False, False, False, True]


def test_recent_window(spark):
    assert column(spark, [-6, -5, 0, 3], "int", S.is_recent) == [False, True, True, True]


def test_demographics(spark):
    counts = [0.0, -1.0, float("nan"), 0.5, 3.0, None]
    assert column(spark, counts, "double", D.family_members) == [1.0, 1.0, 1.0, 0.5, 3.0, 1.0]
    assert column(spark, counts, "double", lambda c: D.family_members(c, "mart")) == [1.0, 1.0, 1.0, 1.0, 3.0, 1.0]
    days = [0, 365243, -1461]
    assert column(spark, days, "int", lambda c: D.employment(c)[0]) == [0.0, 0.0, 4.0]
    assert column(spark, days, "int", lambda c: D.employment(c)[1]) == [0.0, 1.0, 0.0]
    assert column(spark, [-12005], "int", D.age_years) == [12005 / 365.25]
    assert column(spark, [-12005], "int", lambda c: D.age_years(c, "mart")) == [32.87]


def test_scores_of_known_probabilities(spark):
    p = [0.0, 1e-4, 0.005, 0.08, 0.25, 0.85, 0.9999, 1.0, float("nan"), None, 0.001]
    assert column(spark, p, "double", C.pdo_score) == [850, 850, 730, 586, 518, 375, 300, 300, 300, None, 811]


def test_bands_and_decisions(spark):
    scores = [850, 800, 750, 749, 700, 670, 669, 620, 580, 579, 500, 900, None]
    bands = column(spark, scores, "int", C.risk_band)
    assert bands == ["Excellent"] * 3 + ["Good"] * 3 + ["Fair"] * 3 + ["Poor"] * 3 + [None]
    names = ["Excellent", "Good", "Fair", "Poor"]
    assert column(spark, names, "string", C.band_label) == ["Excelente", "Bueno", "Moderado", "Alto Riesgo"]
    assert column(spark, names, "string", lambda c: C.decision_label(C.decision(c))) == [
        "Aprobado", "Aprobado", "Revisión Manual", "Rechazado"]


def test_sigmoid_and_threshold(spark):
    z = [35.0, 40.0, -35.0, 0.0]
    assert column(spark, z, "double", stable_sigmoid) == [1.0, 1.0, 0.0, 0.5]
    p = [0.5, 0.49, float("nan"), None]
    assert column(spark, p, "double", hard_predict) == [1, 0, 0, 0]
    with pytest.raises(Exception):
        spark.sql("select 1/0").collect()  # ANSI mode is on: guards above must not rely on it being off


def test_ratios_are_rounded_as_doubles(spark):
    """Ties of a decimal that the double misses, and those it hits: 1/160, 3/160, 1/32."""
    from riskloom.functions.rounding import round_ratio

    pairs = [(k, n) for n in [*range(1, 90), 160, 320, 480, 800, 1600, 3200] for k in range(0, n + 1, 1 if n < 400 else 7)]
    df = spark.createDataFrame(pairs, "k long, n long")
    found = {(r.k, r.n): r.v for r in df.select("k", "n", round_ratio(F.col("k"), F.col("n")).alias("v")).collect()}
    assert found == {(k, n): round(k / n, 4) for k, n in pairs}
    assert found[1, 160] == 0.0063 and found[1, 32] == 0.0312
