"""Cell functions on hand-made cells."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallystock.functions import cells


def apply(spark, function, values):
    data = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "i int, c string").select("i", function(F.col("c")).alias("x"))
    return [r.x for r in df.orderBy("i").collect()]


CASES = {
    "clean_cell": (cells.clean_cell, [
        ("  a b\t", "a b"), ("", None), ("  \n", None), (None, None), ("x　", "x")]),
    "clean_code": (cells.clean_code, [
        ("'4000100372", "4000100372"), ("''007", "007"), ("'", None), ("' 1 2 ", "1 2"), (None, None)]),
    "clean_code_view": (cells.clean_code_view, [("'12 ", "12 "), (None, ""), ("''7", "7"), ("a'b", "a'b")]),
    "clean_name": (cells.clean_name, [("  a   b ", "a b"), ("a\tb", "a\tb"), ("  ", None)]),
    "is_numeric": (cells.is_numeric, [
        ("1,234.56", True), ("-", False), ("(123)", False), ("nan", False), ("1_000", True), ("1__0", False),
        ("1.0d", False), (".5", True), ("5.", True), ("1e3", True), ("-1E-2", True), (None, False), ("", False),
        ("1 2", False), (", 5", True), ("0x1f", False)]),
    "is_date_parseable": (cells.is_date_parseable, [
        (None, True), ("", True), ("N/A", True), ("none", True), ("2026-05-01", True), ("2026-5-1", True),
        ("2026-05-01T10:00:00", True), ("15/8/2026", True), ("8/15/2026", True), ("15-08-2026", True),
        ("8-15-2026", False), ("30/02/2026", False), ("29/02/2024", True), ("29/02/2023", False), ("2026/08/15", False),
        ("5/1/2026 10", False), ("0000-01-01", False), ("45678", False), ("15/8/26", False)]),
    "normalize_lot_state": (cells.normalize_lot_state, [
        ("569.0", "569"), ("N/A", None), ("NA", None), ("", None), ("1,239", "1239"), ("1e3", "1000"), ("Cuarentena", "Cuarentena"),
        ("-2.9", "-2"), (None, None)]),
    "null_tokens": (cells.null_tokens, [("N/A", None), ("NA", None), ("", None), ("n/a", "n/a"), (None, None)]),
    "section_name": (cells.section_name, [
        (" GRANULAR - SOLUBLES ", "Granular - Solubles"), ("Líquidos", "Liquidos"), ("semillas", None), (None, None)]),
    "is_header_word": (cells.is_header_word, [("'Código ", True), ("TIPO", True), ("codigos", False), (None, False)]),
}


@pytest.mark.parametrize("name", CASES)
def test_function(spark, name):
    function, pairs = CASES[name]
    assert apply(spark, function, [p[0] for p in pairs]) == [p[1] for p in pairs]


def test_numbers_keep_null_for_bad_text(spark):
    got = apply(spark, lambda c: cells.text_to_number(c).cast("double"), ["1,234.56", "-", None, "1.239", "abc", "-7"])
    assert got == [1234.56, None, None, 1.24, None, -7.0]


def test_dates_day_first(spark):
    got = apply(spark, cells.text_to_date, ["5/1/2026", "05/01/2026", "31/2/2026", "2026-01-05", None])
    assert got == [datetime.date(2026, 1, 5)] * 2 + [None, None, None]


def test_dates_follow_the_calendar(spark):
    """A cell is a date if its numbers fit a calendar page in one of the accepted layouts."""
    days = {1: 31, 2: 28, 3: 31, 4: 30, 5: 31, 6: 30, 7: 31, 8: 31, 9: 30, 10: 31, 11: 30, 12: 31}

    def on_page(day, month, year):
        leap = month == 2 and (year % 4 == 0 and year % 100 != 0 or year % 400 == 0)
        return 1 <= month <= 12 and 1 <= day <= days[month] + leap

    cases = {}
    for year in (1900, 2000, 2023, 2024):
        for month in (0, 1, 2, 4, 12, 13):
            for day in (0, 1, 12, 13, 28, 29, 30, 31, 32):
                page, swapped = on_page(day, month, year), on_page(month, day, year)
                cases[f"{year}-{month:02}-{day:02}"] = page
                cases[f"{day:02}-{month:02}-{year}"] = page
                cases[f"{day}/{month}/{year}"] = page or swapped
    cases |= {"1/1/24": False, "1-1-2024-": True, "01-02-03": False, "123/1/2024": False, "2024/01/01": False}
    del cases["1-1-2024-"]
    assert apply(spark, cells.is_date_parseable, list(cases)) == list(cases.values())
