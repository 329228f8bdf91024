"""A report's pages from box texts to typed rows, ready to be stored."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcela.functions import dates, numbers, strings
from parcela.operators import layout, nested, persist, work
from parcela.storage import stored

from . import catalogue

#: The orientations of the envelope page, in its order, and the letter's column of the first page.
ORIENTATIONS = ("Horiz", "N", "NE", "E", "SE", "S", "SO", "O", "NO", "Pisos")
LETTER = "letra_eficiencia_energetica_dem"
#: Spans so many millimetres apart are lines of their own.
LINE = 1.5


def _last_line(text: Column) -> Column:
    return F.element_at(F.split(strings.strip(text), r"\R"), -1)


#: Per kind the type of its values, and how they are read; null where a text can't be.
READERS = {
    "text": ("string", strings.strip),
    "line": ("string", strings.one_line),
    "number": ("double", numbers.locale_number),
    "last": ("double", lambda c: numbers.locale_number(_last_line(c))),
    "unit": ("double", numbers.unit_number),
    "integer": ("bigint", numbers.first_int_line),
    "date": ("date", lambda c: dates.report_date(_last_line(c))),
}


def single_page(texts: DataFrame, doc: str, page: int, blank: bool = False) -> DataFrame:
    """One row a document from (doc, field, text), with all fields of page 1, 2, 3 or 7; a text that can't be read is null in its column alone.

    Page 1 gets the letter that its saved share stands for. With ``blank`` a field without a row is an empty text. Texts are read
    by the kind of their field and gathered by document. Of a field's several values the greatest holds.
    """
    kinds = catalogue.single(page)
    values: dict[str, Column] = {}
    for kind in dict.fromkeys(kinds.values()):
        of, read = READERS[kind]
        mine = F.col("field").isin([c for c, k in kinds.items() if k == kind])
        values[of] = F.when(mine, read(F.col("text"))) if of not in values else values[of].when(mine, read(F.col("text")))
    found = _gathered(texts, doc, list(kinds), {f"as_{of}": v for of, v in values.items()})
    out = found.select(doc, *[F.col("m")[c][f"as_{READERS[k][0]}"].alias(c) for c, k in kinds.items()])
    out = out.fillna("", [c for c, k in kinds.items() if READERS[k][0] == "string"]) if blank else out
    return out.withColumn(LETTER, numbers.grade(numbers.percent(F.col("porcentaje_ahorro")))) if page == 1 else out


def _gathered(texts: DataFrame, doc: str, names: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """(doc, m): a document's ``values`` of the fields ``names``, as a map by field of structs; documents without such fields have an empty one.

    Values are read where the texts are, each field's by its own rule, and gathered by one shuffle.
    """
    long = texts.select(doc, "field", *[v.alias(n) for n, v in values.items()])
    pair = F.when(F.col("field").isin(list(names)), F.struct("field", F.struct(*values).alias("v")))
    gathered = long.groupBy(doc).agg(F.array_sort(F.collect_list(pair)).alias("p"))
    return gathered.select(doc, F.map_from_entries(_last_of("p")).alias("m"))


def _last_of(pairs: str) -> Column:
    """Of sorted (field, text) pairs the last of each field."""
    return F.filter(pairs, lambda x, i: ~F.get(pairs, i + 1)["field"].eqNullSafe(x["field"]))


def _code() -> Column:
    return F.first(F.when(F.col("field") == "codigo_evaluacion", strings.strip(F.col("text"))), ignorenulls=True).alias("codigo_evaluacion")


def monthly_page(texts: DataFrame, doc: str, metrics: Sequence[str] = layout.MONTHLY_METRICS) -> DataFrame:
    """Twelve rows a document, a column a metric, from fields ``<metric>_mes_<month>``; the report's code on each.

    Names are cut into metric and month where the texts are, so one shuffle by document is all.
    """
    cut = lambda k: F.regexp_extract("field", r"^(.*)_mes_(\d+)$", k)
    value = F.struct(cut(1).alias("metric"), cut(2).try_cast("int").alias("mes_id"), numbers.locale_number(F.col("text")).alias("value"))
    cells = F.collect_list(F.when(F.col("field").rlike(r"_mes_\d+$"), value)).alias("cells")
    each = texts.groupBy(doc).agg(_code(), cells).select(doc, "codigo_evaluacion", "cells", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mes_id"))
    mine = each.withColumn("cells", F.expr("filter(cells, c -> c.mes_id = mes_id)"))
    found = [F.expr(f"get(filter(cells, c -> c.metric = '{m}'), 0).value").alias(m) for m in metrics]
    return mine.select(doc, "codigo_evaluacion", "mes_id", *found)


def two_month_page(spans: DataFrame, doc: str) -> DataFrame:
    """A row a document and month, a column a parameter; missing ones at the end are null."""
    values = layout.two_month_values(spans, doc)
    vals = nested.pad(F.col("vals"), len(layout.TWO_MONTH_PARAMETERS), "double")
    return values.select(doc, dates.month_of_name(F.col("month")).alias("mes_id"), vals.alias("v")).select(doc, "mes_id", *[F.get("v", F.lit(i)).alias(f"{p}_kwh") for i, p in enumerate(layout.TWO_MONTH_PARAMETERS)])


def envelope_lists(texts: DataFrame, doc: str) -> DataFrame:
    """The lists that ``envelope_page`` takes, and the code, from the texts of the envelope's blocks and cells."""
    blocks = {"opaque": ("opacos_area", 10), "opaque_u": ("opacos_u", 10), "translucent": ("traslucidos_area", 9), "translucent_u": ("traslucidos_u", 9)}
    columns: dict[str, list[str]] = {}
    for f in catalogue.fields(3):
        if f.kind == "cell":
            columns.setdefault(f.name.rsplit("_", 1)[0], []).append(f.name)
    field, text = F.col("field"), F.col("text")
    number = F.when(field.isin(columns["ua_mas_phi_l"]), numbers.last_line_number(text)).when(field.isin([n for c in catalogue.BRIDGES for n in columns[c]]), numbers.locale_number(_last_line(text)))
    names = ["codigo_evaluacion", *[name for name, _ in blocks.values()], *[n for c in columns.values() for n in c]]
    found = _gathered(texts, doc, names, {"text": F.when(~field.isin([n for c in columns.values() for n in c]), text), "number": number})
    cell = lambda name, what: F.col("m")[name][what]
    lists = [F.array(*[cell(n, "number") for n in ns]).alias("totals" if c == "ua_mas_phi_l" else c) for c, ns in columns.items()]
    lines = lambda c: F.filter(F.split(strings.strip(c), r"\R"), lambda x: x != "")
    read = [F.transform(nested.last_n(lines(cell(name, "text")), n), numbers.locale_number).alias(k) for k, (name, n) in blocks.items()]
    return found.select(doc, strings.strip(cell("codigo_evaluacion", "text")).alias("codigo_evaluacion"), *read, *lists)


def envelope_page(lists: DataFrame, doc: str) -> DataFrame:
    """Ten rows a document, one an orientation, from its lists of numbers.

    ``opaque`` and ``translucent`` areas, their ``_u`` values, eight numbers of each bridge ``p01_w_k`` to ``p05_w_k``, and twelve
    ``totals``, of which the fifth and the eleventh are subtotals; those that ``lists`` lacks are left out, and the
    code, if there is one, is on each row. Bridges have neither a first nor a last orientation, translucent parts no last one.
    """
    ten = len(ORIENTATIONS)
    framed = lambda c, before: nested.pad(nested.framed(F.col(c), before, 1, "double"), ten, "double")
    parts = {
        "elementos_opacos_area_m2": ("opaque", lambda c: nested.pad(F.col(c), ten, "double")),
        "elementos_opacos_u_w_m2_k": ("opaque_u", lambda c: nested.pad(F.col(c), ten, "double")),
        "elementos_traslucidos_area_m2": ("translucent", lambda c: framed(c, 0)),
        "elementos_traslucidos_u_w_m2_k": ("translucent_u", lambda c: framed(c, 0)),
        **{b: (b, lambda c: framed(c, 1)) for b in catalogue.BRIDGES},
        "ua_mas_phi_l": ("totals", lambda c: nested.pad(nested.drop_places(F.col(c), (4, 10)), ten, "double")),
    }
    given = {n: make(c).alias(n) for n, (c, make) in parts.items() if c in lists.columns}
    code = [c for c in ("codigo_evaluacion",) if c in lists.columns]
    named = lists.select(doc, *code, F.array(*[F.lit(o) for o in ORIENTATIONS]).alias("orientacion_nombre"), *given.values())
    return nested.zip_rows(named, [doc, *code], ["orientacion_nombre", *given])


def hourly_page(cells: DataFrame, doc: str) -> DataFrame:
    """The hourly rows of (doc, month, outer, inner, outer_scores, inner_scores), with low confidence marked.

    Missing series are 24 nulls, missing scores -1.
    """
    score = lambda c: F.transform(nested.pad(F.col(c), 24, "double"), lambda x: F.coalesce(x, F.lit(-1.0)))
    zipped = F.arrays_zip(nested.pad(F.col("outer"), 24, "double").alias("o"), nested.pad(F.col("inner"), 24, "double").alias("i"), score("outer_scores").alias("so"), score("inner_scores").alias("si"))
    rows = cells.select(doc, dates.month_of_name(F.col("month")).alias("mes_id"), F.posexplode(zipped).alias("hora", "v"))
    low = numbers.low_confidence(F.col("v.o"), F.col("v.i"), F.col("v.so"), F.col("v.si"))
    return rows.select(doc, "mes_id", "hora", F.col("v.o").alias("temperatura_exterior"), F.col("v.i").alias("temperatura_interior"), low.alias("ocr_low_confidence"))


#: The tables of a report, and the rows that each has.
TABLES = {"pagina1": 1, "pagina2": 1, "pagina3_consumos": 1, "pagina3_envolvente": 10, "pagina4": 12, "pagina5": 2, "pagina6": 96, "pagina7": 1}


def box_texts(spans: DataFrame, doc: str) -> DataFrame:
    """(doc, page_no, field, text) of all boxes of all seven pages, in one pass over the spans.

    Each page that a document has, with text in a box or without, also has a row without a field.
    """
    found = layout.in_boxes(spans, catalogue.boxes(spans.sparkSession), doc, line=LINE)
    there = spans.where("page_no between 1 and 7").select(doc, "page_no").distinct().select("*", F.lit("").alias("field"), F.lit("").alias("text"))
    return found.unionByName(there)


def extract(spans: DataFrame, doc: str, cells: DataFrame | None = None) -> dict[str, DataFrame]:
    """The eight tables of reports from the spans of their pages, with the tables' own column names.

    ``cells`` are the hourly lists that ``hourly_page`` takes, read from the picture of page 6; without them its rows
    have no values. A page that a report lacks, or that can't be read, leaves its own table without rows or values. The
    spans are cut into boxes once; all tables but the two months' read the texts that were found, by page.
    """
    return tables_of(stored(box_texts(spans, doc), "texts"), spans, doc, cells)


def tables_of(every: DataFrame, spans: DataFrame, doc: str, cells: DataFrame | None = None) -> dict[str, DataFrame]:
    """The eight tables from ``box_texts`` and, for the two months' page, the spans."""

    def texts(page: int) -> DataFrame:
        return every.where(F.col("page_no") == page)

    third = texts(3)
    codes = texts(6).groupBy(doc).agg(_code())
    if cells is None:
        months = F.explode(F.array(*[F.lit(m) for m in nested.HOURLY_MONTHS])).alias("month")
        empty = [F.lit(None).cast("array<double>").alias(c) for c in ("outer", "inner", "outer_scores", "inner_scores")]
        cells = codes.select(doc, months, *empty)
    fifth = two_month_page(spans.where("page_no = 5"), doc)
    code5 = texts(5).groupBy(doc).agg(_code())
    pages = {
        "pagina1": single_page(texts(1), doc, 1, blank=True),
        "pagina2": single_page(texts(2), doc, 2, blank=True),
        "pagina3_consumos": single_page(third, doc, 3, blank=True),
        "pagina3_envolvente": envelope_page(envelope_lists(third, doc), doc).drop("pos"),
        "pagina4": monthly_page(texts(4), doc),
        "pagina5": code5.withColumn("mes_id", F.explode(F.array(F.lit(1), F.lit(7)))).join(fifth, [doc, "mes_id"], "left"),
        "pagina6": hourly_page(cells, doc).join(codes, doc, "left"),
        "pagina7": single_page(texts(7), doc, 7, blank=True),
    }
    return {name: df.withColumnsRenamed({c: persist.table_column(name, c) for c in df.columns if c != doc}) for name, df in pages.items()}


def page_rows(tables: dict[str, DataFrame], doc: str, ident: object = None) -> DataFrame:
    """How many rows each table has of each report, or of the report ``ident``; 0 where it has none."""
    one = [(df if ident is None else df.where(F.col(doc) == F.lit(ident))).select(doc, F.lit(name).alias("table_name")) for name, df in tables.items()]
    pairs = reduce(DataFrame.unionByName, one)
    counts = pairs.groupBy(doc).agg(*[F.count_if(F.col("table_name") == n).alias(n) for n in tables])
    return counts.select(doc, F.explode(F.array(*[F.struct(F.lit(n).alias("table_name"), F.col(n).alias("n_rows")) for n in tables])).alias("p")).select(doc, "p.*")


def validated(tables: dict[str, DataFrame], doc: str) -> DataFrame:
    """Per report: whether its first page has a code, its hourly rows and those that are filled or of low confidence, and ``ok``."""
    hours = tables["pagina6"].select(F.col(doc).alias("eval_id"), F.col("temperatura_exterior").alias("outer"), F.col("temperatura_interior").alias("inner"), F.col("ocr_low_confidence").alias("low_confidence"))
    codes = tables["pagina1"].select(F.col(doc).alias("eval_id"), F.col("codigo_evaluacion_energetica").alias("codigo"))
    return work.validation(hours.join(codes, "eval_id", "full_outer"))
