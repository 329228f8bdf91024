"""Bands of the hourly page, drawn with known numbers, come back as those; parts of it against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcela.operators import glyphs, grid, pictures
from parcela.plans import hourly, report
from parcela.queries import hourly as drawn


def test_local_ink_and_strokes_against_loops():
    rng = np.random.default_rng(2)
    for shape in ((20, 31), (7, 9), (1, 5)):
        grey = rng.integers(0, 256, shape)
        grey[:, 3] = rng.integers(0, 60, shape[0])
        wide = np.pad(grey, 7, mode="edge")
        plain = np.array([[grey[y, x] <= wide[y : y + 15, x : x + 15].mean() - 10 for x in range(shape[1])] for y in range(shape[0])])
        ink = pictures.local_ink(grey)
        assert (ink == plain).all()
        for n in (1, 2, 5):
            left = np.zeros(shape, bool)
            for x in range(shape[1]):
                for y in range(shape[0] - n + 1):
                    if ink[y : y + n, x].all():
                        left[y : y + n, x] = True
            assert (pictures.standing(ink, n) == left).all()


@pytest.fixture(scope="module")
def templates(spark):
    return drawn.templates(spark)


def numbers(k):
    return [round(k % 40 + h / 2, 1) for h in range(24)], [round((k * 7 + h) % 30 + 0.1, 1) for h in range(24)]


def test_bands(spark, templates):
    rows = [(f"d{k}", m, drawn.band(*numbers(k), noise=k)) for k in range(3) for m in ("enero", "julio")]
    blank = [[255] * 60] * 40
    rows += [("none", "enero", blank), ("null", "enero", None), ("ragged", "enero", [[1, 2], [3]])]
    bands = spark.createDataFrame(rows, "doc string, month string, pixels array<array<int>>")
    out = {(r.doc, r.month): r for r in hourly.read_bands(bands, templates, "doc").collect()}
    assert len(out) == len(rows)
    for k in range(3):
        for month in ("enero", "julio"):
            r = out[f"d{k}", month]
            assert (r.outer, r.inner) == numbers(k) and min(r.outer_scores + r.inner_scores) > 0.9
    assert all(out[d, "enero"].outer is None for d in ("none", "null", "ragged"))
    page = report.hourly_page(hourly.read_bands(bands.where("doc in ('d1', 'none')"), templates, "doc"), "doc")
    assert page.count() == 72 and page.where(F.col("doc") == "none").where("temperatura_exterior is null and ocr_low_confidence").count() == 24


def test_pictures_meet_no_join(spark, templates):
    """Spark takes drawn pictures for a few bytes, so a join would send them all through the driver."""
    bands = spark.createDataFrame([("d", "enero", drawn.band(*numbers(1)))], "doc string, month string, pixels array<array<int>>")
    cells = hourly.cells_of(bands, "doc")
    for df in (cells, hourly.numbers_of(cells, templates, ["doc", "month", "series", "hour"]), hourly.read_bands(bands, templates, "doc")):
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_arrays_beside_a_picture_are_the_operators_rows(spark):
    rng = np.random.default_rng(4)
    ink = [(k, y, float(v)) for k in range(40) for y, v in enumerate(rng.choice([0, 5, 19, 20, 60, 300 * (k % 2)], rng.integers(1, 70)))]
    rows = spark.createDataFrame(ink, "k int, y int, ink double")
    want = grid.merged(grid.ink_bands(rows, ["k"], "y", "ink"), ["k"]).collect()
    one = rows.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "ink"))), lambda x: x["ink"]).alias("v"))
    got = one.select("k", F.explode(grid.bands_in("v")).alias("b")).collect()
    assert got and sorted((r.k, r.b.begin, r.b.end) for r in got) == sorted((r.k, r.begin, r.end) for r in want)
    boxes = spark.createDataFrame([(k, int(h), int(a)) for k in range(30) for h, a in zip(rng.integers(5, 14, k % 5), rng.integers(4, 9, k % 5), strict=True)], "k int, h int, area int")
    high = boxes.groupBy("k").agg(F.collect_list(F.struct("h", "area")).alias("b")).select("k", glyphs.digit_height_in("b").alias("digit_h")).where("digit_h is not null")
    assert sorted(map(tuple, high.collect())) == sorted(map(tuple, glyphs.digit_height(boxes, ["k"]).collect()))
    lines = spark.createDataFrame([(k, 20 * i + int(rng.integers(0, 9))) for k in range(20) for i in range(k)], "d int, pos int")
    laid = lines.groupBy("d").agg(F.collect_list("pos").alias("p")).select("d", F.posexplode(grid.bounds_in("p")).alias("n", "bound"))
    assert sorted(map(tuple, laid.collect())) == sorted(map(tuple, grid.bounds(lines, ["d"], "pos").collect()))
