"""Date columns: keys, labels in Spanish, differences and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystock import fixed_values as V


def _pick(names: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), index - 1)


def date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def month_name(d: Column) -> Column:
    return _pick(V.MONTH_NAMES, F.month(d))


def iso_weekday(d: Column) -> Column:
    return F.weekday(d) + 1


def weekday_name(d: Column) -> Column:
    return _pick(V.WEEKDAY_NAMES, iso_weekday(d))


def holiday_name(d: Column) -> Column:
    pairs = [F.lit(x) for pair in V.HOLIDAYS.items() for x in pair]
    return F.create_map(*pairs)[F.date_format(d, "MM-dd")]


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit("-"), F.date_format(d, "yyyy"))


def week_label(d: Column) -> Column:
    """ISO week number with the calendar year, so 2021-01-01 is S53-2021."""
    week = F.lpad(F.weekofyear(d).cast("string"), 2, "0")
    return F.concat(F.lit("S"), week, F.lit("-"), F.date_format(d, "yyyy"))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def days_to_months(days: Column) -> Column:
    return F.round(days.cast("decimal(12,0)") / F.lit(30), 1)


def epoch_duration(start: Column, end: Column) -> Column:
    """Seconds between two timestamps with millisecond scale."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.round(micros.cast("decimal(20,0)") / F.lit(1_000_000), 3).cast("decimal(16,3)")


def calendar_columns(d: Column) -> dict[str, Column]:
    """All attributes of the date dimension for a day column."""
    return {
        "sk_tiempo": date_key(d),
        "fecha_completa": d,
        "anio": F.year(d),
        "nombre_anio": F.date_format(d, "yyyy"),
        "trimestre": F.quarter(d),
        "nombre_trimestre": quarter_label(d),
        "mes": F.month(d),
        "nombre_mes": month_name(d),
        "anio_mes": F.date_format(d, "yyyy-MM"),
        "semana_anio": F.weekofyear(d),
        "nombre_semana": week_label(d),
        "dia_mes": F.dayofmonth(d),
        "dia_semana": iso_weekday(d),
        "nombre_dia": weekday_name(d),
        "es_fin_semana": iso_weekday(d).isin(6, 7),
        "es_feriado": holiday_name(d).isNotNull(),
        "nombre_feriado": holiday_name(d),
    }
