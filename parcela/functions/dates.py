"""Dates and months of Spanish reports, as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names, with the second spelling of the ninth.
MONTHS = {
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7,
    "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
}

#: A text's tokens: runs of figures, runs of letters, and any other character that is no white space.
_TOKEN = r"\p{Nd}+|\p{L}+|[^\s\p{Nd}\p{L}]"


def _months() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(MONTHS.items())])


def month_of_name(c: Column) -> Column:
    """1 to 12 for a month's name in any case; null for anything else, numerals included."""
    return F.try_element_at(_months(), F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")))


def month_of_number(c: Column) -> Column:
    return F.when(c.between(1, 12), c.cast("int"))


def _date(y: Column, m: Column, d: Column) -> Column:
    text = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def report_date(c: Column) -> Column:
    """The date that a text's first five tokens make: day, separator, month, separator, year.

    The separators are ``-`` or ``/`` with the month in figures, or ``de`` with its name. Blanks may stand between
    tokens or not, where letters or figures do not run together. A day has one or two figures, as has a month; a year is the first four of its
    figures. What follows is ignored. An impossible date is null, whatever else the text holds, as is a text that begins otherwise.
    """
    token = F.slice(F.regexp_extract_all(F.lower(c), F.lit(_TOKEN), F.lit(0)), 1, 5)
    day, one, month, two, year = (F.get(token, F.lit(i)) for i in range(5))

    def short(x: Column) -> Column:
        return F.when(F.length(x) <= 2, x.try_cast("int")).cast("string")

    dashed = one.isin("-", "/") & two.isin("-", "/")
    linked = (one == "de") & (two == "de")
    chosen = F.when(dashed, short(month)).when(linked, F.try_element_at(_months(), month).cast("string"))
    figures = F.when(F.length(year) >= 4, F.substring(year, 1, 4))
    whole = short(day).isNotNull() & chosen.isNotNull() & figures.try_cast("int").isNotNull()
    return F.when(whole, _date(figures, chosen, short(day)))


def iso(c: Column, kind: str) -> Column:
    """Dates and timestamps in ISO 8601, the fraction only where there is one; other kinds as they are."""
    if kind == "date":
        return F.date_format(c, "yyyy-MM-dd")
    if kind in ("timestamp", "timestamp_ntz"):
        whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        fraction = F.date_format(c, "SSSSSS")
        zone = F.lit("" if kind == "timestamp_ntz" else "+00:00")
        return F.concat(whole, F.when(fraction == "000000", "").otherwise(F.concat(F.lit("."), fraction)), zone)
    return c
