"""Glyphs cut out of the grey pictures of cells."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows and columns of a glyph that is compared with templates.
GLYPH_SIZE = (32, 24)


def threshold(grey: np.ndarray) -> int:
    """The grey value that parts a picture's dark and light pixels best: the one of the most variance between both."""
    count = np.bincount(grey.ravel().astype(np.int64), minlength=256).astype(np.float64)
    below = np.cumsum(count)
    mass = np.cumsum(count * np.arange(len(count)))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = below * above * (mass / below - (mass[-1] - mass) / above) ** 2
    return int(np.nan_to_num(apart, nan=-1.0).argmax())


def components(ink: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(x, y, w, h, area) of each connected patch of ink, corners touching, by x, then y.

    Rows are read as runs of ink; a run that touches some of the row before is joined with them.
    """
    up: list[int] = []
    boxes: list[list[int]] = []

    def root(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    before: list[tuple[int, int, int]] = []
    for y, row in enumerate(ink):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], row.astype(np.int8), [0]))))
        now = []
        for begin, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            k = len(up)
            up.append(k)
            boxes.append([begin, y, end, y + 1, end - begin])
            for b, e, other in before:
                if b <= end and e >= begin:
                    i, j = sorted((root(k), root(other)))
                    if i != j:
                        up[j] = i
                        p, q = boxes[i], boxes[j]
                        boxes[i] = [min(p[0], q[0]), min(p[1], q[1]), max(p[2], q[2]), max(p[3], q[3]), p[4] + q[4]]
            now.append((begin, end, k))
        before = now
    found = [boxes[k] for k in range(len(up)) if up[k] == k]
    return sorted((x1, y1, x2 - x1, y2 - y1, area) for x1, y1, x2, y2, area in found)


def local_ink(grey: np.ndarray, side: int = 15, less: int = 10) -> np.ndarray:
    """Pixels darker by ``less`` than the mean of the square of ``side`` pixels around them; edges go on as they are.

    Sums of all rectangles from the corner give any square's in four lookups, so the time does not depend on ``side``.
    """
    reach = side // 2
    wide = np.pad(grey.astype(np.int64), reach, mode="edge")
    sums = np.pad(wide.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    square = sums[side:, side:] - sums[:-side, side:] - sums[side:, :-side] + sums[:-side, :-side]
    return grey * side * side <= square - less * side * side


def standing(ink: np.ndarray, least: int) -> np.ndarray:
    """The pixels of upright runs of ink of ``least`` pixels or more: what erosion and dilation by such a stroke leave."""
    edge = np.diff(np.pad(ink.astype(np.int8), ((1, 1), (0, 0))), axis=0).T
    column, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    long = end - begin >= least
    marks = np.zeros((ink.shape[0] + 1, ink.shape[1]), np.int64)
    np.add.at(marks, (begin[long], column[long]), 1)
    np.subtract.at(marks, (end[long], column[long]), 1)
    return marks.cumsum(0)[:-1] > 0


def upright_lines(grey: np.ndarray, share: float = 0.4) -> list[int]:
    """The middles of the runs of columns whose upright strokes, a third of the height at least, reach ``share`` of the most."""
    strokes = standing(local_ink(grey), max(5, grey.shape[0] // 3)).sum(0)
    if not strokes.any():
        return []
    on = np.diff(np.pad((strokes >= strokes.max() * share).astype(np.int8), 1))
    return [int((a + b - 1) / 2) for a, b in zip(np.flatnonzero(on == 1).tolist(), np.flatnonzero(on == -1).tolist(), strict=True)]


def lines(pictures: DataFrame, key: Sequence[str], pixels: str = "pixels") -> DataFrame:
    """(key, pos) of the upright lines of each picture; what is no picture has none."""
    kinds = dict(pictures.dtypes)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, x) for i, grey in enumerate(_pictures(b.column("__px"))) if grey is not None for x in upright_lines(grey)]
            at, pos = pa.array([i for i, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int32())
            yield pa.RecordBatch.from_arrays([*[b.column(k).take(at) for k in key], pos], [*key, "pos"])

    schema = ", ".join([f"`{k}` {kinds[k]}" for k in key] + ["pos int"])
    return pictures.select(*key, pictures[pixels].alias("__px")).mapInArrow(each, schema)


def lines_in(pixels: Column) -> Column:
    """The places of a picture's upright lines as an array, so that the picture meets them without a join; what is no picture has none."""

    @F.arrow_udf("array<int>")
    def each(column: pa.Array) -> pa.Array:
        return pa.array([[] if grey is None else upright_lines(grey) for grey in _pictures(column)], pa.list_(pa.int32()))

    return each(pixels)


@lru_cache(maxsize=512)
def _shares(n: int, m: int) -> np.ndarray:
    """How much of each of ``n`` old places lies in each of ``m`` new ones, each new one's parts adding up to 1."""
    edge = np.arange(m + 1) * (n / m)
    parts = np.minimum(edge[1:, None], np.arange(1, n + 1)) - np.maximum(edge[:-1, None], np.arange(n))
    return np.maximum(parts, 0.0) / (n / m)


def scaled(picture: np.ndarray, size: tuple[int, int] = GLYPH_SIZE) -> np.ndarray:
    """A picture in another size, each new pixel the mean of the area that it covers."""
    return _shares(picture.shape[0], size[0]) @ picture @ _shares(picture.shape[1], size[1]).T


def _pictures(column: pa.ListArray) -> Iterator[np.ndarray | None]:
    """Each value as a rectangle of 0 to 255, or None for what is no picture: cut out of the flat values by their offsets."""
    rows = column.values
    outer, inner = column.offsets.to_numpy(), rows.offsets.to_numpy()
    flat = rows.values.to_numpy(zero_copy_only=False)
    empty, gone = column.is_null().to_numpy(zero_copy_only=False), rows.is_null().to_numpy(zero_copy_only=False)
    holes = rows.values.is_null().to_numpy(zero_copy_only=False) if rows.values.null_count else None
    for i, (a, b) in enumerate(zip(outer[:-1].tolist(), outer[1:].tolist(), strict=True)):
        wide = np.diff(inner[a : b + 1])
        if empty[i] or a == b or wide[0] == 0 or (wide != wide[0]).any() or gone[a:b].any() or (holes is not None and holes[inner[a] : inner[b]].any()):
            yield None
        else:
            yield np.clip(flat[inner[a] : inner[b]].astype(np.int64).reshape(b - a, -1), 0, 255)


def _patches(grey: np.ndarray | None) -> list[tuple[int, int, int, int, int]]:
    return [] if grey is None or grey.min() == grey.max() else components(grey <= threshold(grey))


def blobs_in(pixels: Column) -> Column:
    """The boxes (x, y, w, h, area) of a cell's patches of dark pixels as an array; what is no picture has none."""
    names = ("x", "y", "w", "h", "area")

    @F.arrow_udf(f"array<struct<{', '.join(f'{n}: int' for n in names)}>>")
    def each(column: pa.Array) -> pa.Array:
        found = [_patches(grey) for grey in _pictures(column)]
        ends = np.cumsum([0] + [len(f) for f in found])
        flat = np.array([box for f in found for box in f], np.int32).reshape(-1, len(names))
        boxes = pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(len(names))], list(names))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), boxes)

    return each(pixels)


def blobs(cells: DataFrame, key: Sequence[str], pixels: str = "pixels") -> DataFrame:
    """(key, x, y, w, h, area, cell_h) of each patch of dark pixels of each cell; what is no picture has none.

    ``glyphs.digit_height``, ``glyphs.blob_kind`` and ``glyphs.merge_blobs`` say what they are.
    """
    names = ("x", "y", "w", "h", "area", "cell_h")
    kinds = dict(cells.dtypes)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at: list[int] = []
            out: list[tuple[int, ...]] = []
            for i, grey in enumerate(_pictures(b.column("__px"))):
                for box in _patches(grey):
                    at.append(i)
                    out.append((*box, len(grey)))
            columns = [b.column(k).take(pa.array(at, pa.int64())) for k in key]
            columns += [pa.array([o[j] for o in out], pa.int32()) for j in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, [*key, *names])

    schema = ", ".join([f"`{k}` {kinds[k]}" for k in key] + [f"{n} int" for n in names])
    return cells.select(*key, cells[pixels].alias("__px")).mapInArrow(each, schema)


def normalised(cells: DataFrame, key: Sequence[str], pixels: str = "pixels", box: Sequence[str] = ("x", "y", "w", "h")) -> DataFrame:
    """(key, pixels): the part ``box`` of each cell's picture in black and white, scaled to ``GLYPH_SIZE``, as one array; null without extent."""
    kinds = dict(cells.dtypes)

    def one(grey: np.ndarray | None, x: int, y: int, w: int, h: int) -> np.ndarray | None:
        part = None if grey is None or None in (x, y, w, h) else grey[max(0, y) : max(0, y + h), max(0, x) : max(0, x + w)]
        if part is None or not part.size:
            return None
        return scaled(np.where(part > threshold(part), 255.0, 0.0)).ravel()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            boxes = zip(*(b.column(c).to_pylist() for c in box), strict=True)
            found = [one(grey, *where) for grey, where in zip(_pictures(b.column("__px")), boxes, strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in key], pa.array(found, pa.list_(pa.float64()))], [*key, "pixels"])

    schema = ", ".join([f"`{k}` {kinds[k]}" for k in key] + ["pixels array<double>"])
    return cells.select(*dict.fromkeys([*key, *box]), cells[pixels].alias("__px")).mapInArrow(each, schema)
