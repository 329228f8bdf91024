"""Numbers as reports write them, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

#: A text whose first line with a digit is a number in the usual form, dots before three digits and one comma: read in one go, as line by line takes longer.
_PLAIN = r"^(?:[^0-9]*\R)?\s*([+-]?[0-9]+(?:\.[0-9]{3})*(?:,[0-9]+)?)[ \t]*(?:\R|\z)"

#: The upper bounds of the grades, each inclusive, and the best grade above them.
GRADES = ((-0.35, "G"), (-0.1, "F"), (0.2, "E"), (0.4, "D"), (0.55, "C"), (0.7, "B"), (0.85, "A"))
BEST_GRADE = "A+"
#: A page in millimetres, and the range of plausible temperatures.
PAGE_MM = (215.9, 330.0)
PLAUSIBLE = (-20.0, 50.0)


def lines(c: Column) -> Column:
    """The lines of a text that are not blank, trimmed."""
    cut = F.transform(F.split(c, r"\R"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.filter(cut, lambda x: x != "")


def plain_number(c: Column) -> Column:
    """A double from plain decimal notation, else null."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def _one_locale_number(x: Column) -> Column:
    comma, dot = F.instr(x, ","), F.instr(x, ".")
    parts = F.split(x, r"\.")
    whole = F.replace(x, F.lit("."), F.lit(""))
    tail = F.slice(parts, F.lit(2), F.greatest(F.lit(1), F.size(parts)))
    grouped = F.when(F.forall(tail, lambda p: F.length(p) == 3), whole)
    form = (
        F.when((comma > 0) & (dot > 0) & (comma < dot), F.replace(x, F.lit(","), F.lit("")))
        .when((comma > 0) & (dot > 0), F.replace(whole, F.lit(","), F.lit(".")))
        .when(comma > 0, F.replace(x, F.lit(","), F.lit(".")))
        .when((dot > 0) & (F.size(parts) == 2) & (F.length(F.element_at(parts, -1)) != 3), x)
        .when(dot > 0, grouped)
        .otherwise(x)
    )
    return plain_number(form)


def locale_number(c: Column) -> Column:
    """The first line that is a number, whichever of comma and dot groups its thousands.

    With both, the one that comes first groups. A lone dot before exactly three digits groups as
    well; a comma alone is always decimal. Null if no line converts.
    """
    found = F.filter(F.transform(lines(c), _one_locale_number), lambda v: v.isNotNull())
    plain = F.translate(F.regexp_extract(c, _PLAIN, 1), ",.", ".").try_cast("double")
    return F.coalesce(plain, F.get(found, F.lit(0)))


def unit_number(c: Column, unit: str = "[W/m2K]") -> Column:
    """A number with a decimal comma after the literal ``unit`` is taken away."""
    bare = F.regexp_replace(F.replace(c, F.lit(unit), F.lit("")), r"^\s+|\s+$", "")
    return plain_number(F.replace(bare, F.lit(","), F.lit(".")))


def last_line_number(c: Column) -> Column:
    """The last line as a number with a decimal comma."""
    return plain_number(F.replace(F.get(F.reverse(lines(c)), F.lit(0)), F.lit(","), F.lit(".")))


def first_int_line(c: Column) -> Column:
    """The first line of digits and minus signs, as an integer; null also where it has minus signs inside."""
    cut = F.split(c, r"\R")
    digits = F.get(F.filter(cut, lambda x: x.rlike(r"^[-0-9]*[0-9][-0-9]*$")), F.lit(0))
    return digits.try_cast("bigint")


def percent(c: Column) -> Column:
    return c / F.lit(100.0)


def grade(share: Column) -> Column:
    """The letter of a saved share; bounds belong to the lower letter, null stays null."""
    out = F.when(share.isNull(), F.lit(None).cast("string"))
    for bound, letter in GRADES:
        out = out.when(share <= bound, letter)
    return out.otherwise(BEST_GRADE)


def dash_as_zero(c: Column) -> Column:
    return F.when(c == "-", F.lit(0.0)).otherwise(plain_number(F.replace(c, F.lit(","), F.lit("."))))


def result_count(c: Column) -> Column:
    """The number before the first word that begins with Vivienda, dots grouping its thousands; 0 if there is none.

    Of the word before it, a bracket or colon and what precedes it do not count.
    """
    words = F.filter(F.split(c, r"\s+"), lambda w: w != "")
    before = F.get(words, F.array_position(F.transform(words, lambda w: w.startswith("Vivienda")), True).cast("int") - 2)
    digits = F.replace(F.substring_index(F.translate(before, "(:[", ":::"), ":", -1), F.lit("."), F.lit(""))
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def page_count(n: Column, size: int = 10) -> Column:
    pages = F.greatest(F.lit(1), F.ceil(n / F.lit(size)))
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.lit(0)).otherwise(pages).cast("bigint")


def to_page(x: Column, y: Column, width: Column, height: Column) -> tuple[Column, Column]:
    """Millimetres as page units; (0, 0) on a page without extent."""
    flat = (width == 0) | (height == 0)
    return (
        F.when(flat, F.lit(0.0)).otherwise(x / PAGE_MM[0] * width),
        F.when(flat, F.lit(0.0)).otherwise(y / PAGE_MM[1] * height),
    )


def plausible(v: Column) -> Column:
    return v.between(*PLAUSIBLE)


def low_confidence(outer: Column, inner: Column, outer_score: Column, inner_score: Column, least: float = 0.45) -> Column:
    """A missing value, or a known score (0 or more) under ``least``."""
    weak = lambda s: (s >= 0) & (s < least)
    return outer.isNull() | inner.isNull() | F.coalesce(weak(outer_score), F.lit(False)) | F.coalesce(weak(inner_score), F.lit(False))


def ocr_number(c: Column) -> Column:
    """The first number of a text in which O stands for zero and blanks mean nothing."""
    fixed = F.translate(c, "Oo ", "00")
    return plain_number(F.replace(F.regexp_extract(fixed, r"-?\d+[.,]?\d*", 0), F.lit(","), F.lit(".")))


def comma_number(c: Column) -> Column:
    """The first number of a text with dots read as decimal commas."""
    found = F.regexp_extract(F.replace(c, F.lit("."), F.lit(",")), r"-?\d+(?:[.,]\d+)?", 0)
    return plain_number(F.replace(found, F.lit(","), F.lit(".")))


def backoff(attempt: Column, base: float, growth: str = "double") -> Column:
    """Seconds to wait before attempt 0, 1, ...: ``base`` doubled each time, or its multiples."""
    if growth == "double":
        return F.lit(base) * F.pow(F.lit(2.0), attempt)
    return F.lit(base) * (attempt + 1)
