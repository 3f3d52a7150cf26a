"""Edges of the column expressions."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from staylens.functions import clinical, numeric, text


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_text(spark):
    got = column(spark, [None, "", "   ", "\t", " a  b\n c ", "\tx", "space cap"], "string", text.clean_text)
    assert got == [None, None, None, " ", "a b c", " x", "space cap"]


def test_to_number(spark):
    got = column(spark, [" 7.5 ", "x", "", "nan", "inf", None, "-2"], "string", text.to_number)
    assert got == [7.5, None, None, None, None, None, -2.0]


def test_contains_any(spark):
    got = column(spark, ["Admitted", None, "home", "micu"], "string", lambda c: text.contains_any(c, ["ADMIT", "ICU"]))
    assert got == [True, False, False, True]


def test_range_guard_bounds(spark):
    values = [89.99, 90.0, 110.0, 110.01, None, float("nan")]
    assert column(spark, values, "double", lambda c: numeric.range_guard(c, 90, 110)) == [None, 90.0, 110.0, None, None, None]


def test_rescale(spark):
    values = [1234.0, 12080.0, 151103.0, 120.0, 40.0, None, float("inf"), 1.2e300]
    got = column(spark, values, "double", lambda c: numeric.rescale_until(c, 60, 300))
    assert got[:6] == [123.4, 120.8, 151.103, 120.0, None, None] and got[6] is None
    assert 60 <= got[7] <= 300
    steps = [(10000, None, 1000), (1000, 10000, 100), (200, 1000, 10)]
    assert column(spark, [74810.0, 7481.0, 748.0, 74.0, None], "double", lambda c: numeric.rescale_steps(c, steps)) == [
        74.81, 74.81, 74.8, 74.0, None,
    ]


def test_clip_keeps_null(spark):
    assert column(spark, [10.0, 400.0, None, 70.0], "double", lambda c: numeric.clip(c, 60.0, 300.0)) == [60.0, 300.0, None, 70.0]


def test_to_decimal_rounds_and_overflows(spark):
    got = column(
        spark, [Decimal("1.00005"), Decimal("-1.00005"), Decimal("12345.0")], "decimal(20,5)",
        lambda c: numeric.to_decimal(c, 8, 4),
    )
    assert got == [Decimal("1.0001"), Decimal("-1.0001"), None]


def test_binary_rounding_is_that_of_floats(spark):
    rnd = random.Random(1)
    values = [0.125, 0.145, 0.9005, 0.7005, 0.0005, 2.5, -0.001, 99.995, 0.0]
    values += [rnd.randrange(0, 20000) / 10000 for _ in range(2000)]
    values += [rnd.uniform(-300, 300) for _ in range(500)]
    for digits in (0, 1, 2, 3):
        got = column(spark, values, "double", lambda c: numeric.format_fixed(c, digits))
        assert got == [f"{v:.{digits}f}" for v in values]
    assert column(spark, values, "double", lambda c: numeric.round_binary(c, 3)) == [round(v, 3) for v in values]


def test_bands_and_display(spark):
    scores = [0.85, 0.70, 0.55, 0.40, 0.20, 0.19, 0.8499]
    got = column(spark, scores, "double", lambda c: clinical.severity(c)["severity_index"])
    assert got == [1, 2, 3, 4, 5, 6, 2]
    assert column(spark, [0.7, 0.69, 0.4, 0.39], "double", clinical.risk_label) == ["HIGH", "MODERATE", "MODERATE", "LOW"]
    assert column(spark, [0.989, 0.99, 0.82, 1.0], "double", clinical.display_prediction) == ["0.99", ">0.99", "0.82", ">0.99"]
    assert column(spark, [0.994, 0.995, 0.0494], "double", clinical.display_interpretation) == ["0.994", ">0.99", "0.049"]
    assert column(spark, [1.0, 0.5], "double", clinical.cap_score) == [0.999, 0.5]


def test_code_classes(spark):
    codes = ["I10", "4280", "J45", "486", "E119", "2500", "N17", "584", "Z99", None, "39"]
    got = {
        name: column(spark, codes, "string", lambda c, n=name: F.coalesce(clinical.code_classes(c)[n], F.lit(False)))
        for name in clinical.CODE_CLASSES
    }
    hits = {name: [c for c, h in zip(codes, hit) if h] for name, hit in got.items()}
    assert hits == {
        "cardiovascular": ["I10", "4280", "39"], "respiratory": ["J45", "486"],
        "endocrine": ["E119", "2500"], "renal": ["N17", "584"],
    }
