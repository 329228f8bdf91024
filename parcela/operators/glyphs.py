"""Glyphs read by their likeness to templates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcela.functions.numbers import plain_number
from parcela.storage import stored

#: Exemplars that go out with a task, 16 a label or so.
MOST_EXEMPLARS = 10_000


def template_mean(samples: DataFrame, label: str = "label", pixels: str = "pixels") -> DataFrame:
    """(label, pos, mean): the mean of each pixel over a label's samples."""
    one = samples.where(F.col(pixels).isNotNull()).select(label, F.posexplode(pixels).alias("pos", "v"))
    return one.groupBy(label, "pos").agg(F.avg(F.col("v").cast("double")).alias("mean"))


def templates_of(means: DataFrame, label: str = "label") -> DataFrame:
    """(label, exemplar): the means of each label as one array."""
    pairs = means.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("pos", "mean"))).alias("p"))
    return pairs.select(label, F.expr("transform(p, x -> x.mean)").alias("exemplar"))


def matching_cells(glyphs: DataFrame, truth: DataFrame, key: Sequence[str], order: str = "ord", kind: str = "kind", text: str = "text") -> DataFrame:
    """Glyphs of the cells whose digits are as many as those of their true ``text``, each with its ``label``; other cells teach nothing."""
    digits = F.split(F.regexp_replace(text, r"\D", ""), "")
    known = truth.select(*key, F.filter(digits, lambda d: d != "").alias("__digits"))
    cells = glyphs.where(F.col(kind) == "digit").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in glyphs.columns if c not in (*key, order, kind)]))).alias("__g"))
    both = cells.join(known, list(key)).where(F.size("__g") == F.size("__digits"))
    zipped = both.select(*key, F.explode(F.arrays_zip(F.col("__g").alias("g"), F.col("__digits").alias("label"))).alias("z"))
    return zipped.select(*key, "z.g.*", "z.label")


def stride_sample(samples: DataFrame, label: str, order: Sequence[str], k: int = 12) -> DataFrame:
    """Up to ``k`` samples of each label, evenly strided over its order, which must be total.

    Rows are numbered within ranges of label and order, and ranges by the counts of those before, so that a label
    with very many samples is no one task's.
    """
    n = max(1, int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Written, as the bounds of ranges are drawn anew by each evaluation.
    ranged = stored(samples.repartitionByRange(n, label, *order).withColumn("__part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy(label, "__part").agg(F.count("*").alias("__held"))
    each = Window.partitionBy(label)
    before = F.sum("__held").over(each.orderBy("__part")) - F.col("__held")
    parts = counts.select(label, "__part", before.alias("__before"), F.sum("__held").over(each).alias("__n"))
    inside = F.row_number().over(Window.partitionBy("__part", label).orderBy(*order)) - 1
    ranked = ranged.withColumn("__i", inside).join(parts, ["__part", label]).withColumn("__i", F.col("__i") + F.col("__before"))
    step = F.greatest(F.lit(1), F.floor(F.col("__n") / k))
    return ranked.where((F.col("__i") % step == 0) & (F.col("__i") < k * step)).select(*samples.columns)


def _centred(c: Column) -> Column:
    """An array less its mean."""
    d = F.transform(c, lambda x: x.cast("double"))
    mean = F.aggregate(d, F.lit(0.0), lambda a, x: a + x) / F.size(d)
    return F.transform(d, lambda x: x - mean)


def correlation(a: Column, b: Column) -> Column:
    """Pearson's correlation of two arrays; null where one is flat."""
    x, y = _centred(a), _centred(b)
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda u, v: u * v), F.lit(0.0), lambda s, t: s + t)
    norm = F.sqrt(dot(x, x) * dot(y, y))
    return F.when(norm > 0, dot(x, y) / norm)


def classify(glyphs: DataFrame, templates: DataFrame, key: str, pixels: str = "pixels", label: str = "label") -> DataFrame:
    """Each glyph's best label and score by correlation with all exemplars; of equals the first exemplar.

    ``templates`` (label, exemplar_no, exemplar) go out as one array with each task, so that glyphs are read once
    and nothing is shuffled or paired up; more than ``MOST_EXEMPLARS`` are an error. Glyphs that match nothing,
    or whose size is another, are ``?`` with score -1. A batch is scored by one product of matrices.
    """
    rows = templates.orderBy(label, "exemplar_no").limit(MOST_EXEMPLARS + 1).collect()
    if len(rows) > MOST_EXEMPLARS:
        raise ValueError(f"more than {MOST_EXEMPLARS} exemplars")
    names = np.array([str(r[label]) for r in rows] + ["?"], object)
    wall = np.array([r["exemplar"] for r in rows], np.float64)
    wall -= wall.mean(1, keepdims=True)
    norm = np.linalg.norm(wall, axis=1)
    kind = dict(glyphs.dtypes)[key]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 4096):
                b = whole.slice(i, 4096)
                pixels = b.column("pixels")
                fits = pc.fill_null(pc.equal(pc.list_value_length(pixels), wall.shape[1]), False)
                fits = pc.and_(fits, pc.equal(_nulls_in(pixels), 0))
                best, score = np.full(b.num_rows, len(names) - 1), np.full(b.num_rows, -1.0)
                some = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
                if len(some):
                    v = pixels.filter(fits).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(some), -1)
                    v = v - v.mean(1, keepdims=True)
                    length = np.linalg.norm(v, axis=1, keepdims=True)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        like = np.round(np.where((norm > 0) & (length > 0), v @ wall.T / (norm * length), -2.0), 12)
                    top = like.argmax(1)
                    most = like[np.arange(len(some)), top]
                    good = most > -1
                    best[some[good]], score[some[good]] = top[good], most[good]
                yield pa.RecordBatch.from_arrays([b.column(key), pa.array(names[best], pa.string()), pa.array(score)], [key, "best", "score"])

    return glyphs.select(key, F.col(pixels).alias("pixels")).mapInArrow(each, f"{key} {kind}, best string, score double")


def _nulls_in(lists: pa.Array) -> pa.Array:
    """How many values of each list are null; 0 for a null list."""
    counts = np.zeros(len(lists), np.int64)
    parents = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    np.add.at(counts, parents, pc.is_null(lists.flatten()).to_numpy(zero_copy_only=False).astype(np.int64))
    return pa.array(counts)


def read_cells(glyphs: DataFrame, key: Sequence[str], order: str = "ord", char: str = "ch") -> DataFrame:
    """The number that a cell's glyphs spell from left to right, a comma being decimal."""
    return valued(glyphs.groupBy(*key).agg(spelled(order, char).alias("text")))


def spelled(order: str = "ord", char: str = "ch") -> Column:
    """The characters of a group's glyphs in order, as an aggregate."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, char))), lambda x: x[char]), "")


def valued(cells: DataFrame) -> DataFrame:
    """``text`` with its ``value``, a comma being decimal."""
    return cells.withColumn("value", plain_number(F.replace("text", F.lit(","), F.lit("."))))


def cell_confidence(cells: DataFrame, glyphs: DataFrame, key: Sequence[str], score: str = "score") -> DataFrame:
    """The least score of a cell's glyphs, -1 where it has none."""
    least = glyphs.groupBy(*key).agg(F.min(score).alias("confidence"))
    return cells.select(*key).join(least, list(key), "left").withColumn("confidence", F.coalesce("confidence", F.lit(-1.0)))


def hourly_pages(cells: DataFrame, pages: DataFrame, doc: str, least: int = 6) -> DataFrame:
    """The cells of reports with ``least`` pages or more (``doc``, page_count); others have no hourly page to read."""
    return cells.join(pages.where(F.col("page_count") >= least).select(doc), doc, "left_semi")


def low_scores_out(cells: DataFrame, least: float = 0.55) -> DataFrame:
    """Cells that are sure and plausible enough to serve as further samples."""
    return cells.where((F.col("confidence") >= least) & F.col("value").between(-20.0, 50.0))


def digit_height(blobs: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, digit_h): the median height of a cell's boxes over 8 pixels high, else its highest; boxes of an area under 6 don't count."""
    tall = F.col("h") > 8
    found = blobs.where("area >= 6").groupBy(*key).agg(F.percentile(F.when(tall, F.col("h")), F.lit(0.5)).alias("__m"), F.max("h").alias("__x"))
    return found.select(*key, F.coalesce("__m", F.col("__x").cast("double")).alias("digit_h"))


def digit_height_in(boxes: str) -> Column:
    """The height of ``digit_height`` from an array of boxes; null without a box that counts."""
    tall = f"filter({boxes}, b -> b.area >= 6 and b.h > 8)"
    middle = f"element_at(transform(array(array_sort(transform({tall}, b -> b.h))), o -> if(size(o) = 0, null, (o[cast((size(o) - 1) div 2 as int)] + o[cast(size(o) div 2 as int)]) / 2D)), 1)"
    return F.expr(f"coalesce({middle}, cast(array_max(transform(filter({boxes}, b -> b.area >= 6), b -> b.h)) as double))")


def blob_kind(w: Column, h: Column, area: Column, y: Column, cell_h: Column, digit_h: Column) -> Column:
    """noise (tiny), grid (taller than digits and thin), comma (short and low) or digit."""
    return (
        F.when(area < 5, "noise")
        .when((h > 1.18 * digit_h) & (w <= 6), "grid")
        .when((h <= 0.45 * digit_h) & (y > 0.45 * cell_h), "comma")
        .otherwise("digit")
    )


def merge_blobs(blobs: DataFrame, key: Sequence[str], gap: int = 2, alike: float = 0.6, comma: str | None = None) -> DataFrame:
    """Neighbouring boxes (x, y, w, h) that belong to one glyph, joined from left to right; a row a glyph, in order.

    A box joins the one before when at most ``gap`` pixels part them and their heights differ by
    less than ``alike`` of the one before, unless one of both is a ``comma`` (a boolean column). What is merged grows, so the
    rows of a cell are folded in order; a cell has a few dozen at most.
    """
    flag = F.lit(False) if comma is None else F.coalesce(F.col(comma), F.lit(False))
    box = F.array_sort(F.collect_list(F.struct("x", "y", "w", "h", flag.alias("comma"))))
    out = blobs.groupBy(*key).agg(box.alias("boxes")).withColumn("boxes", merged_boxes("boxes", gap, alike)).select(*key, F.posexplode("boxes").alias("ord", "b")).select(*key, "ord", "b.*")
    return out.drop("comma") if comma is None else out.withColumnRenamed("comma", comma)


def merged_boxes(boxes: str, gap: int = 2, alike: float = 0.6) -> Column:
    """The glyphs that ``merge_blobs`` folds a sorted array of (x, y, w, h, comma) to, as one array."""
    return F.expr(f"""aggregate({boxes}, cast(array() as array<struct<x: int, y: int, w: int, h: int, comma: boolean>>), (acc, b) ->
        if(size(acc) > 0 and not b.comma and not acc[size(acc) - 1].comma and b.x <= acc[size(acc) - 1].x + acc[size(acc) - 1].w + {gap}
           and abs(b.h - acc[size(acc) - 1].h) < {alike} * acc[size(acc) - 1].h,
           concat(slice(acc, 1, size(acc) - 1), array(named_struct(
               'x', acc[size(acc) - 1].x, 'y', least(acc[size(acc) - 1].y, b.y),
               'w', greatest(acc[size(acc) - 1].x + acc[size(acc) - 1].w, b.x + b.w) - acc[size(acc) - 1].x,
               'h', greatest(acc[size(acc) - 1].y + acc[size(acc) - 1].h, b.y + b.h) - least(acc[size(acc) - 1].y, b.y), 'comma', false))),
           concat(acc, array(named_struct('x', b.x, 'y', b.y, 'w', b.w, 'h', b.h, 'comma', b.comma)))))""")
