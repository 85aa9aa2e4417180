"""Keyword rules: order, borders and missing text."""

from pyspark.sql import functions as F

from tallystock.functions import rules

GRANULAR, GREENHOUSE = "Granular - Solubles", "Material para Invernaderos - Sustrato y Otros"


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_category(rows):
    df = rows([
        ("Urea Map", " granular - solubles "), ("solu map", GRANULAR), ("poema", GRANULAR), ("nada", GRANULAR),
        (None, GRANULAR), ("turba jiffy", GREENHOUSE), ("jiffy", GREENHOUSE), ("x", GREENHOUSE), ("urea", "Liquidos"),
        ("urea", None), ("MF", GRANULAR), ("mf 10", GRANULAR)], "n string, s string")
    assert values(df, rules.classify_category(F.col("n"), F.col("s"))) == [
        "Granular", "Soluble", "Otros", GRANULAR, GRANULAR, "Sustrato", "Material para Invernaderos", "Otros", "Liquidos",
        None, GRANULAR, "Granular"]


def test_review(rows):
    df = rows([("Soluble",), (" liquidos ",), (GRANULAR,), (None,)], "c string")
    assert values(df, rules.manual_review(F.col("c"))) == ["OK", "OK", "REVISAR", "REVISAR"]


def test_brand_order(rows):
    df = rows([
        ("abp1", "Brandt x"), ("1", " bio - x brandt"), ("1", "bio x"), ("1", "biox abp-3"), ("1", "yaramila poema"),
        ("1", "granupotase"), ("1", "monomeros"), ("1", None), (None, "quiver"), ("1", "mf x nutrimon")],
        "c string, n string")
    assert values(df, rules.classify_brand(F.col("c"), F.col("n"))) == [
        "ABP", "Biovenko", "Biovenko", "ABP", "Yara", "Haifa", "Monomeros", "Desconocido", "Quiver",
        "MF (Mosaic Fertilizantes)"]


def test_unit_order(rows):
    names = ["x 250 gramos", "x 500 g", "x 25kg", "x 2.5 gal", "x gal y", "xgal", "x 5 lt", "x sc18l", "jiffy cj28",
             "saran", "x", None]
    df = rows([(n,) for n in names], "n string")
    assert values(df, rules.classify_unit(F.col("n"))) == [
        "G", "G", "Kg", "Gal", "Gal", "Un", "Lt", "Lt", "CJ", "Ro", "Un", "Un"]


def test_presentation_keeps_ordered_alternation(rows):
    names = ["cj2816 50 kg", "x 250 gramos", "x 2.5 gal", "x 4,5m", "x 50 kgs", "x", None]
    df = rows([(n,) for n in names], "n string")
    assert values(df, rules.extract_presentation(F.col("n"))) == [
        "CJ2816", "250 G", "2.5 G", "4,5M", "50 KG", None, None]


def test_recode(rows):
    df = rows([("Soluble",), ("Sin Categoría",), ("Otra",), (None,)], "n string")
    made = rules.recode_category(F.col("n"))
    assert [tuple(r) for r in df.select(made["codigo_categoria"], made["tipo_producto"]).collect()] == [
        ("SO", "Solubles"), ("ND", "Categoría no definida o no identificada."), ("ND", ""), ("ND", "")]
