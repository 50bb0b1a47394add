"""Text and value expressions."""

from pyspark.sql import functions as F

from padronix.functions.text import shorten, squish, title_case
from padronix.functions.values import (
    finite_or,
    first_match,
    recode,
    safe_ratio,
    three_way,
    to_double,
    to_int,
)
from padronix.plans.registry import (
    EXPORT_CLASSES,
    GENDER_RULES,
    PROVINCE_RULES,
    SIZE_CLASSES,
    derive_establishment,
    region_of,
)


def values(spark, inputs, expr, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_squish_sees_no_break_spaces(spark):
    assert values(spark, ["  a   b\t\nc ", "", None], squish) == ["a b c", "", None]


def test_title_case(spark):
    assert values(spark, [" hOLA   mundo", "ÑANDÚ"], title_case) == ["Hola Mundo", "Ñandú"]


def test_shorten_counts_the_dots(spark):
    out = values(spark, ["x" * 33, "x" * 35, "x" * 36], lambda c: shorten(c, 35))
    assert out == ["x" * 33, "x" * 35, "x" * 32 + "..."]


def test_whole_numbers_drop_fractions_and_bad_text(spark):
    assert values(spark, ["12.7", "-12.7", "abc", " 5 ", "", None, "3000000000", "12d", "7f"], to_int) == [
        12, -12, None, 5, None, None, None, None, None,
    ]
    assert values(spark, ["1e3", "0.5", "x", "2D"], to_double) == [1000.0, 0.5, None, None]


def test_gender_cut_variants_differ_only_at_the_upper_edge(spark):
    labels = ("low", "mid", "high")
    shares = [0.29, 0.3, 0.5, 0.7, 0.71, None]
    open_cut = values(spark, shares, lambda c: three_way(c, 0.3, 0.7, labels, upper_closed=False), "double")
    closed_cut = values(spark, shares, lambda c: three_way(c, 0.3, 0.7, labels, upper_closed=True), "double")
    assert open_cut == ["low", "mid", "mid", "mid", "high", "mid"]
    assert closed_cut == ["low", "mid", "mid", "high", "high", "high"]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(4, 2), (4, 0), (4, None), (None, 2), (4, -1)], "n int, d int")
    assert [r[0] for r in df.select(safe_ratio(F.col("n"), F.col("d"))).collect()] == [2.0, 0.0, None, None, 0.0]


def test_nonfinite_values_are_replaced(spark):
    out = values(spark, [1.5, None, float("nan"), float("inf"), float("-inf")], finite_or, "double")
    assert out == [1.5, 0.0, 0.0, 0.0, 0.0]


def test_province_and_gender_spellings(spark):
    assert values(
        spark, ["Cordoba", "Capital Federal", "Buenos Aires", "Buenos Aires Norte", None],
        lambda c: first_match(c, PROVINCE_RULES),
    ) == ["Córdoba", "CABA", "Buenos Aires", "Buenos Aires Norte", None]
    genders = values(
        spark, ["VARONES", "hombres", "F", "Mujer", "otro"], lambda c: first_match(F.lower(c), GENDER_RULES, otherwise=c)
    )
    assert genders == ["Varones", "Varones", "Mujeres", "Mujer", "otro"]


def test_unlisted_values_take_the_default(spark):
    assert values(spark, ["c. 50-99", "c. 50-200", None], lambda c: recode(c, SIZE_CLASSES, "Desconocido")) == [
        "Mediana", "Desconocido", "Desconocido",
    ]
    assert values(spark, [0, 1, 3, 5, 9], lambda c: recode(c, EXPORT_CLASSES, "Desconocido"), "int") == [
        "No exporta", "Exportador bajo", "Exportador medio", "Exportador alto", "Desconocido",
    ]


def test_region_of_unknown_spelling(spark):
    assert values(spark, ["Córdoba", "CORDOBA", "Atlantida", None], region_of) == ["Centro", "Otras", "Otras", "Otras"]
    loose = values(spark, ["Córdoba", " CORDOBA ", "Atlantida"], lambda c: region_of(c, fold_accents=True))
    assert loose == ["Centro", "Centro", "Otras"]


def test_derived_columns(spark):
    df = spark.createDataFrame([("f. 500 y más", 4, 0.7), ("a. 1-9", 0, 0.1)], "size_label string, export_quintile int, share_women double")
    rows = derive_establishment(df).collect()
    assert [(r.size_mid, r.size_class, r.is_exporter, r.export_class, r.gender_class) for r in rows] == [
        (750.0, "Grande", True, "Exportador alto", "Composición mixta"),
        (5.0, "Micro", False, "No exporta", "Predominio masculino"),
    ]
