"""Column functions for raw sheet cells: text in, text, number, date or flag out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystock import fixed_values as V

# A decimal or scientific literal; single underscores between digits count as part of it.
_DIGITS = r"\d+(_\d+)*"
_BLANK = f"[{V.WHITESPACE}]*"
NUMERIC_PATTERN = rf"^{_BLANK}[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?{_BLANK}$"


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(c, F.lit(V.WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_cell(c: Column) -> Column:
    return blank_to_null(strip(c))


def date_cell(c: Column) -> Column:
    """A cell that holds a real date becomes ISO text."""
    return F.date_format(c, "yyyy-MM-dd")


def clean_code(c: Column) -> Column:
    """Drop every leading apostrophe, then surrounding blanks."""
    return blank_to_null(strip(F.ltrim(c, F.lit("'"))))


def clean_code_view(c: Column) -> Column:
    """As the staging views do: an empty code stays '', blanks are kept."""
    return F.ltrim(F.coalesce(c, F.lit("")), F.lit("'"))


def clean_name(c: Column) -> Column:
    return blank_to_null(F.regexp_replace(strip(c), " +", " "))


def is_numeric(c: Column) -> Column:
    """True where the comma-free text is a finite number; never null."""
    return F.coalesce(F.replace(c, F.lit(","), F.lit("")).rlike(NUMERIC_PATTERN), F.lit(False))


# Day-first, month-first and year-first shapes; the year 0 does not exist.
_YEAR = r"(?!0000)\d{4}"
_DAY_SLASH = rf"^\d{{1,2}}/\d{{1,2}}/{_YEAR}$"
_DAY_DASH = rf"^\d{{1,2}}-\d{{1,2}}-{_YEAR}$"
_YEAR_DASH = rf"^{_YEAR}-\d{{1,2}}-\d{{1,2}}$"


def _date(c: Column, separator: str, day_first: bool = True) -> Column:
    """Date from three numbers around a separator. The parts are put in year-month-day order
    and cast: a date parser would raise and catch an exception for every bad cell."""
    first = F.substring_index(c, separator, 1)
    second = F.substring_index(F.substring_index(c, separator, 2), separator, -1)
    day, month = (first, second) if day_first else (second, first)
    return F.concat_ws("-", F.substring_index(c, separator, -1), month, day).try_cast("date")


def is_date_parseable(c: Column) -> Column:
    """A missing date counts as parseable; otherwise the first ten characters must be a date."""
    head = F.substring(c, 1, 10)
    parsed = (
        F.when(head.rlike(_YEAR_DASH), head.try_cast("date"))
        .when(head.rlike(_DAY_SLASH), F.coalesce(_date(head, "/"), _date(head, "/", day_first=False)))
        .when(head.rlike(_DAY_DASH), _date(head, "-"))
    )
    absent = c.isNull() | (c == "") | F.upper(c).isin(V.DATE_NULL_TOKENS)
    return absent | parsed.isNotNull()


def normalize_lot_state(c: Column) -> Column:
    """N/A becomes null, ``569.0`` becomes ``569``; other text stays."""
    number = F.replace(F.replace(c, F.lit(","), F.lit("")), F.lit("_"), F.lit(""))
    whole = number.try_cast("double").try_cast("bigint").cast("string")
    return (
        F.when(c.isin(V.CELL_NULL_TOKENS), F.lit(None).cast("string"))
        .when(is_numeric(c), F.coalesce(whole, c))
        .otherwise(c)
    )


def null_tokens(c: Column) -> Column:
    return F.when(~c.isin(V.CELL_NULL_TOKENS), c)


def text_to_number(c: Column, type_: str = "decimal(12,2)") -> Column:
    """Comma-free number or null; the caller keeps the raw text next to it."""
    return F.replace(c, F.lit(","), F.lit("")).try_cast(type_)


def text_to_date(c: Column) -> Column:
    """Day/month/year text, with or without leading zeros; null if it is no date."""
    return F.when(c.rlike(_DAY_SLASH), _date(c, "/"))


def zero_fill(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("decimal(12,2)"))


def section_name(c: Column) -> Column:
    pairs = [F.lit(x) for pair in V.SECTION_NAMES.items() for x in pair]
    return F.create_map(*pairs)[F.lower(strip(c))]


def is_header_word(c: Column) -> Column:
    return F.coalesce(F.lower(clean_code(c)).isin(V.HEADER_WORDS), F.lit(False))


def all_empty(*cells: Column) -> Column:
    return F.coalesce(*[clean_cell(c) for c in cells]).isNull()
