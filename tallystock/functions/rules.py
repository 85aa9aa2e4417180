"""Keyword rules for category, brand, unit and presentation.

Each rule table becomes one ``when`` chain over the row, so a row is classified in the
scan stage without any join to a rule table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystock import fixed_values as V
from tallystock.functions.cells import strip


def _hit(tests: list[Column]) -> Column:
    """Any test true; a missing text hits nothing."""
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def _contains_any(text: Column, words: list[str]) -> Column:
    return _hit([F.contains(text, F.lit(w)) for w in words])


def _chain(cases: list[tuple[Column, Column]], default: Column) -> Column:
    (first, value), *rest = cases
    chain = F.when(first, value)
    for condition, result in rest:
        chain = chain.when(condition, result)
    return chain.otherwise(default)


def classify_category(name: Column, section: Column) -> Column:
    """Sub-category inside the two mixed sections; any other section is kept as it is."""
    text = F.upper(name)
    title = F.upper(strip(section))
    cases = []
    for wanted, (rules, default) in V.CATEGORY_RULES.items():
        inner = _chain([(_contains_any(text, words), F.lit(result)) for result, words in rules], F.lit(default))
        cases.append((title == wanted, inner))
    return _chain(cases, section)


def manual_review(category: Column) -> Column:
    return F.when(F.upper(strip(category)).isin(V.REVIEWED_CATEGORIES), "OK").otherwise("REVISAR")


def classify_brand(code: Column, name: Column) -> Column:
    text = F.upper(name)
    subject = {"code_starts": F.upper(strip(code)), "name_starts": F.upper(strip(name)), "contains": text}
    test = {"code_starts": F.startswith, "name_starts": F.startswith, "contains": F.contains}
    cases = [
        (_hit([test[kind](subject[kind], F.lit(w)) for w in words]), F.lit(brand))
        for brand, kind, words in V.BRAND_RULES
    ]
    return _chain(cases, F.lit(V.BRAND_DEFAULT))


def classify_unit(name: Column) -> Column:
    text = F.upper(name)
    return _chain([(_contains_any(text, words), F.lit(unit)) for unit, words in V.UNIT_RULES], F.lit(V.UNIT_DEFAULT))


def extract_presentation(name: Column) -> Column:
    text = F.upper(name)
    return F.coalesce(*[F.regexp_substr(text, F.lit(p)) for p in V.PRESENTATION_PATTERNS])


def recode_category(name: Column) -> dict[str, Column]:
    """Code, type and description of a category name; ND and empty text when unknown."""
    def pick(position: int, default: str, undefined: str | None) -> Column:
        cases = [(name == n, F.lit(values[position])) for n, values in V.CATEGORY_RECODE.items()]
        if undefined is not None:
            cases.append((name == V.UNDEFINED_CATEGORY, F.lit(undefined)))
        return _chain(cases, F.lit(default))

    return {
        "codigo_categoria": pick(0, V.UNKNOWN_CATEGORY, None),
        "tipo_producto": pick(1, "", V.UNDEFINED_CATEGORY_TEXT),
        "descripcion": pick(2, "", V.UNDEFINED_CATEGORY_TEXT),
    }
