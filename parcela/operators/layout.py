"""Text of a page by the place it stands at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcela.functions.numbers import PAGE_MM, dash_as_zero

#: The rows of the monthly page, and the parameters of the two-month page in order.
MONTHLY_METRICS = (
    "demanda_calefaccion_viv_eval_kwh", "demanda_calefaccion_viv_ref_kwh", "demanda_enfriamiento_viv_eval_kwh", "demanda_enfriamiento_viv_ref_kwh",
    "sobrecalentamiento_viv_eval_hr", "sobrecalentamiento_viv_ref_hr", "sobreenfriamiento_viv_eval_hr", "sobreenfriamiento_viv_ref_hr",
)
TWO_MONTH_PARAMETERS = ("q_recuperado", "q_puentes_termicos", "q_contra_terreno", "q_piso_ventilado", "q_ventanas", "q_muros", "q_techo", "q_infiltraciones", "q_ventilacion", "q_sol")


def audited(boxes: DataFrame) -> DataFrame:
    """Boxes with ``ok``: they have an extent and lie on the page."""
    on_page = (F.col("x1") >= 0) & (F.col("y1") >= 0) & (F.col("x2") <= PAGE_MM[0]) & (F.col("y2") <= PAGE_MM[1])
    return boxes.withColumn("ok", F.coalesce((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")) & on_page, F.lit(False)))


def _few(rows: DataFrame, most: int = 10_000) -> DataFrame:
    """``rows`` marked for broadcast if they are at most ``most``."""
    return F.broadcast(rows) if len(rows.take(most + 1)) <= most else rows


def in_boxes(spans: DataFrame, boxes: DataFrame, doc: str = "doc_id", blank: bool = False, band: float = 10.0, line: float | None = None) -> DataFrame:
    """The text of each box of each page: spans whose centre lies inside, line by line and then by column.

    Boxes are a catalogue of a few hundred rows and go out to all tasks; a larger one is joined by a
    shuffle. They meet spans by page and by bands of ``band`` millimetres, so a span is tried against the boxes
    of its own band only. Spans whose heights overlap are a line (``lines``). With ``line`` lines stay lines of
    the text, and centres less than that many millimetres apart are of one line whatever their heights; without
    it the text is one line. With ``blank`` the boxes without text are rows too, on pages that have any span.
    """
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    mm = lambda c: c / F.col("page_h") * PAGE_MM[1]
    mx = (cx / F.col("page_w") * PAGE_MM[0]).alias("mx")
    placed = spans.select(doc, "page_no", mx, mm(cy).alias("my"), mm(F.col("y0")).alias("top"), mm(F.col("y1")).alias("bottom"), "text").withColumn("band", F.floor(F.col("my") / band))
    good = audited(boxes).where("ok").select("page_no", "field", *[F.col(c).alias(f"b_{c}") for c in ("x1", "y1", "x2", "y2")])
    banded = good.withColumn("band", F.explode(F.sequence(F.floor(F.col("b_y1") / band), F.floor(F.col("b_y2") / band))))
    hit = F.col("mx").between(F.col("b_x1"), F.col("b_x2")) & F.col("my").between(F.col("b_y1"), F.col("b_y2"))
    met = placed.join(_few(banded), ["page_no", "band"]).where(hit)
    words = met.groupBy(doc, "page_no", "field").agg(F.array_sort(F.collect_list(F.struct("my", "mx", "text", "top", "bottom"))).alias("w"))
    text = F.array_join(F.transform(lines("w", line or 0.0), lambda x: F.array_join(F.transform(x, lambda y: y["text"]), " ")), " " if line is None else "\n")
    out = words.select(doc, "page_no", "field", F.regexp_replace(text, r"^\s+|\s+$", "").alias("text"))
    if not blank:
        return out
    every = spans.select(doc, "page_no").distinct().join(_few(good.select("page_no", "field")), "page_no")
    return every.join(out, [doc, "page_no", "field"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def lines(words: str, apart: float = 0.0) -> Column:
    """The lines of ``words``, an array of (my, mx, text, top, bottom) sorted by its centres my: each an array of (mx, text) by column.

    A sweep from top to bottom: a span is of the line before if its centre lies above that line's lowest edge, or its
    upper edge lies above the centre of the line's first span, or their centres are less than ``apart`` apart; else it begins
    a line. So jitter of a scan and raised or lowered figures do not break a line or swap its words.
    """
    last = "element_at(acc, -1)"
    joins = f"size(acc) > 0 and (x.my <= {last}.bottom or x.top <= {last}.centre or x.my - {last}.centre < {apart}D)"
    word = "struct(x.mx as mx, x.text as text)"
    grown = f"struct({last}.centre as centre, greatest({last}.bottom, x.bottom) as bottom, concat({last}.w, array({word})) as w)"
    fresh = f"struct(x.my as centre, x.bottom as bottom, array({word}) as w)"
    kind = "array<struct<centre: double, bottom: double, w: array<struct<mx: double, text: string>>>>"
    swept = f"aggregate({words}, cast(array() as {kind}), (acc, x) -> if({joins}, concat(slice(acc, 1, size(acc) - 1), array({grown})), concat(acc, array({fresh}))))"
    return F.expr(f"transform({swept}, x -> array_sort(x.w))")


def ordered(c: Column, n: int) -> Column:
    """The first ``n`` of (y, value) structs by y, one without a value last of its row."""
    keyed = F.transform(c, lambda x: F.struct(x["y"].alias("y"), x["value"].isNull().alias("none"), x["value"].alias("value")))
    return F.transform(F.slice(F.array_sort(keyed), 1, n), lambda x: x["value"])


def two_month_values(spans: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Numeric spans of the two-month page by month: (doc, month, vals), ten at most from top to bottom."""
    mx, my = F.col("x0") / F.col("page_w") * PAGE_MM[0], F.col("y0") / F.col("page_h") * PAGE_MM[1]
    numeric = F.col("text").rlike(r"^-?\d+(?:,\d+)?$|^-$") & (F.col("font_size") >= 9)
    placed = spans.where(numeric).withColumns({"mx": mx, "my": my}).where("my > 187 and my < 246 and mx > 44 and mx < 95")
    month = F.when(F.col("mx") < 70, "Enero").otherwise("Julio")
    pairs = F.collect_list(F.struct(F.col("my").alias("y"), dash_as_zero(F.col("text")).alias("value")))
    return placed.groupBy(doc, month.alias("month")).agg(pairs.alias("p")).select(doc, "month", ordered(F.col("p"), len(TWO_MONTH_PARAMETERS)).alias("vals"))


def fields(texts: DataFrame, doc: str, names: Sequence[str]) -> DataFrame:
    """Box texts as one row a document, a column a field."""
    return texts.groupBy(doc).pivot("field", list(names)).agg(F.first("text"))
