"""Column functions against plain restatements of what they mean."""

import datetime
import html
import random
import re
import uuid

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcela.functions import dates, numbers, strings
from parcela.sources import files


def applied(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def grouped(whole, mark):
    """A whole number's figures in threes."""
    return f"{whole:,}".replace(",", mark)


@st.composite
def written_numbers(draw):
    """A value and a text that says it: a notation is drawn first, then figures that it can write."""
    notation = draw(st.sampled_from(["whole", "comma", "dot", "dots in threes", "dots, then a comma", "commas, then a dot", "words before"]))
    whole = draw(st.integers(0, 9_999_999))
    part = draw(st.integers(0, 99))
    sign, minus = draw(st.sampled_from([("", 1), ("-", -1)]))
    if notation == "whole":
        text, value = str(whole), whole
    elif notation == "comma":
        text, value = f"{whole},{part:02}", float(f"{whole}.{part:02}")
    elif notation == "dot":
        text, value = f"{whole}.{part:02}", float(f"{whole}.{part:02}")
    elif notation == "dots in threes":
        text, value = grouped(1000 + whole, "."), 1000 + whole
    elif notation == "dots, then a comma":
        text, value = f"{grouped(1000 + whole, '.')},{part:02}", float(f"{1000 + whole}.{part:02}")
    elif notation == "commas, then a dot":
        text, value = f"{grouped(1000 + whole, ',')}.{part:02}", float(f"{1000 + whole}.{part:02}")
    else:
        text, value, sign, minus = f"total kWh\n \n {whole}", whole, "", 1
    ends = draw(st.sampled_from(["", " ", "\n", "\nafter 5"]))
    return f"{draw(st.sampled_from(['', ' ', chr(10)]))}{sign}{text}{ends}", float(minus * value)


GOLDEN_NUMBERS = {
    "0.123": 123.0, "1.234": 1234.0, "1,234": 1.234, "1,234,567": None, ".123": 123.0, "1.000.": None, "1.234,5": 1234.5, "1,234.5": 1234.5,
    "": None, "x\n 7,5 \n8": 7.5, "12.5": 12.5, "1.234.567": 1234567.0, "-3,25": -3.25, "1e3": 1000.0, None: None,
}


def test_locale_number_golden(spark):
    assert applied(spark, numbers.locale_number, list(GOLDEN_NUMBERS)) == list(GOLDEN_NUMBERS.values())


@settings(max_examples=12, deadline=None)
@given(st.lists(written_numbers(), min_size=30, max_size=60))
def test_locale_number_reads_what_was_written(spark, pairs):
    assert applied(spark, numbers.locale_number, [t for t, _ in pairs]) == [v for _, v in pairs]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text("0123456789.,- \nx", max_size=12), min_size=30, max_size=60))
def test_locale_number_of_anything(spark, texts):
    """No text is an error, and a text without a figure no number."""
    found = applied(spark, numbers.locale_number, texts)
    assert all(v is None for t, v in zip(texts, found, strict=True) if not any(c.isdigit() for c in t))


def test_grades(spark):
    shares = [-0.5, -0.35, -0.12, -0.1, 0.2, 0.21, 0.4, 0.55, 0.7, 0.85, 0.86, 101.0, None]
    assert applied(spark, numbers.grade, shares, "double") == ["G", "G", "F", "F", "E", "D", "D", "C", "B", "A", "A+", "A+", None]


def test_small_numbers(spark):
    assert applied(spark, numbers.unit_number, ["0,84 [W/m2K]", "1.234,5", "n/a", None]) == [0.84, None, None, None]
    assert applied(spark, numbers.first_int_line, ["a\n-12\n5", "--5", " 7", None]) == [-12, None, None, None]
    assert applied(spark, numbers.result_count, ["Hay 4.079  Viviendas", "nada", None]) == [4079, 0, 0]
    assert applied(spark, numbers.page_count, [0, 1, 10, 11, None], "int") == [0, 1, 1, 2, 0]
    assert applied(spark, numbers.ocr_number, ["- 1O,5 C", "x"]) == [-10.5, None]
    assert applied(spark, numbers.comma_number, ["t 12.5", "7"]) == [12.5, 7.0]
    assert applied(spark, numbers.dash_as_zero, ["-", "12,9"]) == [0.0, 12.9]


FORMS = ("{d:02d}-{m:02d}-{y}", "{d}/{m}/{y}", " {d} - {m} / {y} a las 9", "{d} de {name} de {y}", "{d:02d}  de {NAME} de {y}, comuna")


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.dates(datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)), st.sampled_from(FORMS), st.sampled_from(["", "x ", "Talca, ", "el "])), min_size=20, max_size=40))
def test_dates_of_any_form(spark, cases):
    """A day written in each form is read; nothing is where another word comes first."""
    names = {m: n for n, m in dates.MONTHS.items() if n != "setiembre"}
    texts = [before + form.format(d=x.day, m=x.month, y=x.year, name=names[x.month], NAME=names[x.month].upper()) for x, form, before in cases]
    assert applied(spark, dates.report_date, texts) == [None if before else x for x, _, before in cases]


def test_dates_that_are_none(spark):
    odd = ["30-02-2021", "00/05/2021", "7 de brumario de 1799", "31 de abril de 2022", "5-13-2022, 4 de julio de 2022", "hoy", " ", None, "2021-05-06"]
    assert applied(spark, dates.report_date, odd) == [None] * len(odd)


def test_months(spark):
    shown = [f"{' ' * (k % 3)}{name.upper() if k % 2 else name}" for k, name in enumerate(dates.MONTHS)]
    assert applied(spark, dates.month_of_name, [*shown, "brumario", "11", "", None]) == [*dates.MONTHS.values(), None, None, None, None]
    assert applied(spark, dates.month_of_number, [-1, 0, 1, 12, 13, None], "int") == [None, None, 1, 12, None, None]


def test_iso(spark):
    moments = [datetime.datetime(2021, 3, 4, 5, 6, 7), datetime.datetime(2021, 3, 4, 5, 6, 7, 80), None]
    assert applied(spark, lambda c: dates.iso(c, "timestamp"), moments, "timestamp") == ["2021-03-04T05:06:07+00:00", "2021-03-04T05:06:07.000080+00:00", None]
    assert applied(spark, lambda c: dates.iso(c, "date"), [datetime.date(900, 1, 2), None], "date") == ["0900-01-02", None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_categories=["Cs", "Cc"]), min_size=1, max_size=20), min_size=10, max_size=30))
def test_uuid_of_name(spark, names):
    assert applied(spark, strings.name_uuid, names) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["%PDF", "%%EOF", "%", "F", "body ", "\n", "é", "PDF-"]), max_size=9).map("".join), min_size=20, max_size=40))
def test_carve_any_payload(spark, payloads):
    """From the first head to the end of the last end mark behind it, or to the end; the same for texts and bytes."""

    def cut(text):
        if "%PDF" not in text:
            return None
        rest = text[text.index("%PDF") :]
        return rest[: rest.rindex("%%EOF") + 5] if "%%EOF" in rest else rest

    want = [cut(p) for p in payloads]
    assert applied(spark, strings.carve, payloads) == want
    raw = applied(spark, lambda c: files.carved(F.encode(c, "UTF-8")), payloads)
    assert [None if x is None else bytes(x).decode() for x in raw] == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["&amp;", "&ntilde;", "&Aacute", "&#241;", "&#xF1;", "&notin;", "&;", "&#0;", "lt;", "a", " ", "\n"]), max_size=8).map("".join), min_size=20, max_size=40))
def test_character_references(spark, texts):
    assert applied(spark, strings.unescape, texts) == [html.unescape(re.sub(r"^\s+|\s+$", "", t)) for t in texts]


def test_texts(spark):
    assert applied(spark, strings.one_line, [" a\nb \t", None]) == ["a b", None]
    assert applied(spark, strings.unescape, [" a &amp;lt; b &lt;c&gt; ", None]) == ["a &lt; b <c>", None]
    assert applied(spark, strings.capitalised, ["eNERO", "ñandú", "", None]) == ["Enero", "Ñandú", "", None]
    assert applied(spark, strings.grade_of_image, ["x/LetraB.png", "LetraA+.png", "Letra--.png", "x"]) == ["B", "A+", None, None]
    assert applied(spark, lambda c: strings.composite_key(F.lit(1), c), ["x", None]) == ["1:x", "1:None"]
    assert applied(spark, lambda c: strings.shown(c, True), [True, False, None], "boolean") == ["True", "False", "null"]


def test_cut_character_references(spark, tmp_path, duck):
    """A title may end within a reference: the query leaves it as its SQL does; whole ones are decoded, unknown ones stay."""
    texts = ["a &amp", "&ampx; &amp;lt; &copy &#65; &#x42; &#65", " &ntilde;&nope; ", None]
    assert applied(spark, lambda c: strings.unescape(c, bare=False), texts) == ["a &amp", "&ampx; &lt; &copy A B &#65", "ñ&nope;", None]
    from parcela.queries import ORACLE_SQL, QUERIES

    rows = [(i, f"<html><title> {t}</title></html>") for i, t in enumerate(["Tea &amp", "A &am", "&quot;B&quot; &amp; &lt", "C &copy; &", "plain"])]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    sql = f"with pages as (select * from '{tmp_path}/pages.parquet/*.parquet') select * from ({ORACLE_SQL['html_unescape']})"
    assert sorted(map(tuple, QUERIES["html_unescape"](spark, str(tmp_path)).collect())) == sorted(duck.execute(sql).fetchall())


def test_plain_numbers_are_read_as_line_by_line(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(["1", "25", "000", "123", ",", ".", "-", "+", "e3", " ", "\t", "\n", "\r\n", "\u0085", "\x0b", "x", "total\n"], k=rng.randint(0, 7))) for _ in range(1500)]
    slowly = lambda c: F.get(F.filter(F.transform(numbers.lines(c), numbers._one_locale_number), lambda v: v.isNotNull()), F.lit(0))
    want = applied(spark, slowly, texts)
    assert applied(spark, numbers.locale_number, texts) == want and sum(w is not None for w in want) > 300
