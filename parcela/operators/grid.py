"""Lines and bands found in sums of ink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``; a projection may be evaluated at each use."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _median(values: str) -> str:
    n = f"size({values})"
    return _let("o", f"array_sort({values})", f"if({n} = 0, null, (o[cast(({n} - 1) div 2 as int)] + o[cast({n} div 2 as int)]) / 2D)")


#: Over ``places``, the sorted lines of a document: the gaps between them, and the median of those over half their median.
_GAPS = "if(size(places) < 2, cast(array() as array<double>), transform(sequence(1, size(places) - 1), i -> places[i] - places[i - 1]))"
_PITCH = _let("middle", _median("gaps"), _median("filter(gaps, g -> g > 0.5 * middle)"))


def _places(lines: DataFrame, by: Sequence[str], pos: str) -> DataFrame:
    """The sorted lines of a document, some hundreds, as one array: one shuffle."""
    return lines.where(F.col(pos).isNotNull()).groupBy(*by).agg(F.array_sort(F.collect_list(F.col(pos).cast("double"))).alias("places"))


def robust_pitch(lines: DataFrame, by: Sequence[str], pos: str) -> DataFrame:
    """The median gap over half the median gap."""
    pitch = F.expr(_let("gaps", _GAPS, _PITCH)).alias("pitch")
    return _places(lines, by, pos).select(*by, pitch).where("pitch is not null")


def _last_and_pitch(regular: int) -> str:
    """SQL over ``places``: the last line of the regular grid and its pitch, null with fewer than ``regular`` regular lines."""
    near = "coalesce(abs(get(gaps, {0}) - pitch) < 0.3 * pitch, false)"
    kept = f"filter(places, (p, i) -> {near.format('i - 1')} or {near.format('i')})"
    ends = _let("kept", kept, f"if(size(kept) >= {regular}, named_struct('last', element_at(kept, -1), 'pitch', pitch), null)")
    return _let("gaps", _GAPS, _let("pitch", _PITCH, ends))


def bounds_in(lines: str, cells: int = 24, least: int = 5, regular: int = 2) -> Column:
    """The bounds of ``bounds`` as one array from an array of lines beside a picture; null without a grid."""
    laid = f"if(g is null, null, transform(sequence(0, {cells}), k -> g.last - g.pitch * ({cells} - k)))"
    places = f"array_sort(transform(filter({lines}, p -> p is not null), p -> cast(p as double)))"
    return F.expr(_let("places", places, f"if(size(places) >= {least}, {_let('g', _last_and_pitch(regular), laid)}, null)"))


def bounds(lines: DataFrame, by: Sequence[str], pos: str, cells: int = 24, least: int = 5, regular: int = 2) -> DataFrame:
    """``cells + 1`` bounds laid leftward from the last line of the regular grid.

    A line is regular if a neighbour is a pitch away, give or take 30 per cent. With fewer than
    ``least`` lines, or ``regular`` ones among them, there is no grid.
    """
    found = F.expr(_last_and_pitch(regular)).alias("g")
    # The explosion keeps the expression from being evaluated for each bound.
    one = _places(lines, by, pos).where(F.size("places") >= least).select(*by, F.explode(F.array(found)).alias("g")).where("g is not null")
    last = one.select(*by, "g.*", F.explode(F.sequence(F.lit(0), F.lit(cells))).alias("k"))
    return last.select(*by, "k", (F.col("last") - F.col("pitch") * (cells - F.col("k"))).alias("bound"))


def _with_most(rows: DataFrame, by: Sequence[str], index: str, ink: str) -> DataFrame:
    """Rows with their picture's most ink, in the order that its runs are told by: one sort, and no join whose sides Spark would have to guess."""
    whole = Window.partitionBy(*by).orderBy(index).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select(*by, index, ink).dropna(subset=list(by)).withColumn("__most", F.max(ink).over(whole))


def lines_of(sums: DataFrame, by: Sequence[str], index: str, ink: str, share: float = 0.4) -> DataFrame:
    """The middles of the runs of columns whose ink reaches ``share`` of the most: the grid's vertical lines."""
    found = runs(_with_most(sums, by, index, ink), by, index, F.col(ink) >= F.col("__most") * share)
    return found.select(*by, F.floor((F.col("begin") + F.col("end")) / 2).cast("int").alias("pos"))


def crop(left: Column, right: Column, top: Column, bottom: Column, width: Column, height: Column, inset: float = 0.06, margin: int = 2) -> Column:
    """The part (x1, x2, y1, y2) of a picture that holds a cell: ``inset`` of its width off each side, ``margin`` pixels around its rows, within the picture."""
    off = (right - left) * inset
    x1, x2 = F.greatest(F.lit(0), F.floor(left + off)), F.least(width, F.floor(right - off))
    y1, y2 = F.greatest(F.lit(0), F.floor(top) - margin), F.least(height, F.floor(bottom) + margin)
    return F.struct(*[v.cast("int").alias(n) for n, v in (("x1", x1), ("x2", x2), ("y1", y1), ("y2", y2))])


def cropped(pixels: Column, part: Column) -> Column:
    """The pixels (rows of values) of a part; empty where it has no extent."""
    wide, high = F.greatest(F.lit(0), part["x2"] - part["x1"]), F.greatest(F.lit(0), part["y2"] - part["y1"])
    return F.transform(F.slice(pixels, part["y1"] + 1, high), lambda row: F.slice(row, part["x1"] + 1, wide))


def _stretches(rows: DataFrame, by: Sequence[str], begin: str, end: str, first: Column, last: Column) -> DataFrame:
    """(begin, end) from each row for which ``first`` holds to the next, itself included, for which ``last`` does, in the order of ``begin``.

    Such rows come in turns, so a window over them alone closes each stretch. In the order that the rows are already in, that is no second sort and no table of groups.
    """
    edges = rows.withColumn("__first", first).withColumn("__last", last).where("__first or __last")
    close = F.when(F.col("__last"), F.col(end)).otherwise(F.lead(end).over(Window.partitionBy(*by).orderBy(begin)))
    return edges.withColumn("__close", close).where("__first").select(*by, F.col(begin).alias("begin"), F.col("__close").alias("end"))


def runs(rows: DataFrame, by: Sequence[str], index: str, on: Column) -> DataFrame:
    """(begin, end) of each run of consecutive indexes for which ``on`` holds."""
    w = Window.partitionBy(*by).orderBy(index)
    apart = [F.coalesce(near.over(w) != F.col(index) + step, F.lit(True)) for near, step in ((F.lag(index), -1), (F.lead(index), 1))]
    return _stretches(rows.where(on), by, index, index, *apart)


def ink_bands(rows: DataFrame, by: Sequence[str], index: str, ink: str, share: float = 0.12, floor: float = 20.0) -> DataFrame:
    """Runs of rows whose ink reaches ``share`` of the most, ``floor`` at least."""
    least = F.greatest(F.col("__most") * share, F.lit(floor))
    return runs(_with_most(rows, by, index, ink), by, index, F.col(ink) >= least)


def merged(bands: DataFrame, by: Sequence[str], gap: int = 6, height: int = 6, margin: int = 3, limit: int | None = None) -> DataFrame:
    """Bands less than ``gap`` apart joined, those under ``height`` dropped, the rest widened by ``margin``."""
    w = Window.partitionBy(*by).orderBy("begin")
    before, reach = (F.max("end").over(w.rowsBetween(Window.unboundedPreceding, to)) for to in (-1, 0))
    first, last = (F.coalesce(x >= gap, F.lit(True)) for x in (F.col("begin") - before, F.lead("begin").over(w) - reach))
    joined = _stretches(bands.withColumn("__reach", reach), by, "begin", "__reach", first, last).where(F.col("end") - F.col("begin") >= height)
    low, high = F.greatest(F.lit(0), F.col("begin") - margin), F.col("end") + margin
    return joined.select(*by, low.alias("begin"), (high if limit is None else F.least(F.lit(limit), high)).alias("end"))


def bands_in(ink: str, share: float = 0.12, floor: float = 20.0, gap: int = 6, height: int = 6, margin: int = 3, limit: int | None = None) -> Column:
    """What ``merged`` makes of ``ink_bands`` as one array of (begin, end), from an array of the ink of a picture's rows beside it.

    A band begins with a row of enough ink that is ``gap`` or more after the one before, which joins runs as well. Runs themselves,
    as ``ink_bands`` has them, are those of a gap of 2 without height and margin. Nothing is sorted, so a task holds one picture at a time.
    """
    least = f"greatest(array_max(v) * {share}D, {floor}D)"
    begins = f"filter(rows, (y, i) -> i = 0 or y - rows[i - 1] >= {gap})"
    ends = f"filter(rows, (y, i) -> i = size(rows) - 1 or rows[i + 1] - y >= {gap})"
    pairs = f"filter(zip_with({begins}, {ends}, (b, e) -> named_struct('begin', b, 'end', e)), x -> x.end - x.begin >= {height})"
    high = f"x.end + {margin}" if limit is None else f"least({limit}, x.end + {margin})"
    wide = f"transform({pairs}, x -> named_struct('begin', cast(greatest(0, x.begin - {margin}) as double), 'end', cast({high} as double)))"
    rows = f"filter(transform(v, (n, y) -> if(n >= t, y, null)), y -> y is not null)"
    return F.expr(_let("v", ink, _let("t", least, _let("rows", rows, wide))))


def data_rows(bands: Column, top: Column, height: Column) -> Column:
    """The two data bands: the last two of three or more, both of two, else the lower thirds of the height in whole pixels."""
    edge = [(top + F.floor(height * k / 3)).cast("double") for k in (1, 2, 3)]
    thirds = F.array(*[F.struct(a.alias("begin"), b.alias("end")) for a, b in zip(edge, edge[1:], strict=False)])
    return F.when(F.size(bands) >= 2, F.slice(bands, -2, 2)).otherwise(thirds)
