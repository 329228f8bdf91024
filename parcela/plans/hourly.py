"""The hourly page from the pictures of its bands to the lists of its numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcela.operators import glyphs, grid, pictures
from parcela.storage import stored

#: Hours of a band, and its rows of numbers in order.
HOURS, SERIES = 24, ("outer", "inner")
#: Pixels below it are ink when rows of a band are told apart.
DARK = 128


def cells_of(bands: DataFrame, doc: str) -> DataFrame:
    """(doc, month, series, hour, px): the pictures of the 48 cells of each band (doc, month, pixels); a band without a grid has one row without them.

    Upright lines give the grid's columns, and the ink between the first and the last of them its rows. Both are found beside the
    picture, as arrays: it is in no shuffle and on neither side of a join, whose sizes Spark would guess from the few bytes that a band is drawn from.
    """
    by = [doc, "month"]
    lined = bands.select(*by, "pixels", pictures.lines_in(F.col("pixels")).alias("lines"))
    placed = lined.select(*by, "pixels", F.transform(grid.bounds_in("lines", HOURS), lambda b: F.round(b).cast("int")).alias("x"))
    left, wide = F.greatest(F.col("x")[0], F.lit(0)), F.col("x")[HOURS] - F.greatest(F.col("x")[0], F.lit(0))
    dark = F.transform("pixels", lambda row: F.size(F.filter(F.slice(row, left + 1, wide), lambda v: v < DARK)))
    inked = placed.select(*by, "pixels", "x", F.when(F.col("x").isNotNull(), dark).alias("ink"))
    banded = inked.select(*by, "pixels", "x", grid.bands_in("ink").alias("rows"))
    height, width = F.size("pixels"), F.size(F.col("pixels")[0])
    ready = banded.select(*by, "pixels", "x", grid.data_rows(F.col("rows"), F.lit(0), height).alias("rows"), height.alias("height"), width.alias("width"))

    def cell(i: Column) -> Column:
        series, hour = F.floor(i / HOURS).cast("int"), i % HOURS
        row = F.get("rows", series)
        part = grid.crop(F.get("x", hour), F.get("x", hour + 1), row["begin"], row["end"], F.col("width"), F.col("height"))
        name = F.element_at(F.array(*[F.lit(n) for n in SERIES]), series + 1)
        return F.struct(name.alias("series"), hour.alias("hour"), grid.cropped(F.col("pixels"), part).alias("px"))

    # Cells are cut before they become rows, so that no row holds a whole band's picture.
    cut = F.when(F.col("x").isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(2 * HOURS - 1)), cell))
    return ready.select(*by, F.explode_outer(cut).alias("c")).select(*by, "c.*")


def numbers_of(cells: DataFrame, templates: DataFrame, key: list[str]) -> DataFrame:
    """(key, value, confidence) of each cell: its glyphs by their best templates, and the least of their scores, -1 without any.

    A cell's patches and the glyphs that they make stay beside its picture until each glyph is cut out.
    """
    found = cells.select(*key, "px", pictures.blobs_in(F.col("px")).alias("blobs"))
    sized = found.select(*key, "px", "blobs", glyphs.digit_height_in("blobs").alias("digit_h"), F.size("px").alias("cell_h"))

    def told(b: Column) -> Column:
        kind = glyphs.blob_kind(b["w"], b["h"], b["area"], b["y"], F.col("cell_h"), F.col("digit_h"))
        return F.struct(*[b[c].alias(c) for c in ("x", "y", "w", "h")], (kind == "comma").alias("comma"), kind.alias("kind"))

    some = F.filter(F.transform("blobs", told), lambda b: F.col("digit_h").isNotNull() & b["kind"].isin("digit", "comma"))
    boxes = F.array_sort(F.transform(some, lambda b: F.struct(*[b[c].alias(c) for c in ("x", "y", "w", "h", "comma")])))
    joined = sized.select(*key, "px", boxes.alias("boxes")).select(*key, "px", glyphs.merged_boxes("boxes").alias("boxes"))

    def own(b: Column) -> Column:
        part = F.struct(b["x"].alias("x1"), (b["x"] + b["w"]).alias("x2"), b["y"].alias("y1"), (b["y"] + b["h"]).alias("y2"))
        return F.struct(b["comma"].alias("comma"), b["w"].alias("w"), b["h"].alias("h"), F.when(~b["comma"], grid.cropped(F.col("px"), part)).alias("px"))

    each = joined.select(*key, F.posexplode_outer(F.transform("boxes", own)).alias("ord", "g")).select(*key, "ord", "g.*", F.lit(0).alias("x"), F.lit(0).alias("y"))
    ident = [*key, "ord", "comma"]
    best = glyphs.classify(pictures.normalised(each, ident, "px").select(F.struct(*ident).alias("id"), "pixels"), templates, "id")
    digit = F.col("id.comma") == F.lit(False)
    read = best.select("id.*", F.when(digit, F.col("best")).when(F.col("id.comma"), ",").alias("ch"), F.when(digit, F.col("score")).alias("score"))
    sure = F.coalesce(F.min("score"), F.lit(-1.0)).alias("confidence")
    return glyphs.valued(read.groupBy(*key).agg(sure, glyphs.spelled().alias("text"))).select(*key, "confidence", "value")


def read_bands(bands: DataFrame, templates: DataFrame, doc: str) -> DataFrame:
    """(doc, month, outer, inner, outer_scores, inner_scores), as ``report.hourly_page`` takes them, of each band (doc, month, pixels).

    ``templates`` are (label, exemplar_no, exemplar). A band whose picture has no grid has null lists, which become
    24 rows without values and of score -1; a cell that can't be read is null in its place alone.
    """
    by = [doc, "month"]
    found = numbers_of(stored(cells_of(bands, doc), "cells"), templates, [*by, "series", "hour"])

    def in_order(series: str, what: str) -> Column:
        mine = F.collect_list(F.when(F.col("series") == series, F.struct("hour", what)))
        return F.when(F.count("series") > 0, F.transform(F.array_sort(mine), lambda x: x[what]))

    lists = [in_order(s, what).alias(name) for s in SERIES for what, name in (("value", s), ("confidence", f"{s}_scores"))]
    return found.groupBy(*by).agg(*lists)
