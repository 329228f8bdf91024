"""Short codes of vectors: a codebook for each part of a vector, whose nearest entries are found by annular norm pruning."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import small, spare, stored

#: Scaled components below this size have squared distances that fit 64 bits, in parts of up to 8,192 components.
MOST = 2**24
#: Distinct labels whose sums are sent to all tasks; beyond, the sums are joined by shuffle.
_LABELS = 1_000_000


@dataclass(frozen=True)
class Codebooks:
    """Integer entries of each part position: a list of parts, each a list of entries of equal length."""

    books: tuple[tuple[tuple[int, ...], ...], ...]
    dim: int
    scale: int

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, as decimal numbers between commas."""
        return hashlib.sha256(",".join(str(x) for book in self.books for entry in book for x in entry).encode()).hexdigest()

    def vector(self, code: str) -> list[float]:
        """The vector that a code stands for."""
        chosen = bytes.fromhex(code)
        return [x / self.scale for book, e in zip(self.books, chosen, strict=True) for x in book[e]]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the nearest entry of ``book`` and the squared distance; of equal ones the lower index.

    By the triangle inequality an entry at distance r or less has a norm within r of the row's. Entries
    are sorted by norm; from the one of nearest norm a row goes outwards, as far as binary search places
    the annulus that its best distance so far allows, its edges included.
    """
    norms = (book * book).sum(1)
    order = np.lexsort((np.arange(len(book)), norms))
    ring, own = np.sqrt(norms[order].astype(float)), np.sqrt((x * x).sum(1).astype(float))
    # Roots are rounded; the annulus is wider by more than that.
    slack = 1e-9 * (1 + own + (ring[-1] if len(ring) else 0))

    def distance(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        d = x[rows] - book[entries]
        return (d * d).sum(1)

    def annulus(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        reach = np.sqrt(least[rows].astype(float)) + slack[rows]
        return np.searchsorted(ring, own[rows] - reach, "left"), np.searchsorted(ring, own[rows] + reach, "right")

    every = np.arange(len(x))
    right = np.minimum(np.searchsorted(ring, own), len(ring) - 1)
    left = np.maximum(right - 1, 0)
    start = np.where(own - ring[left] < ring[right] - own, left, right)
    best = order[start]
    least = distance(every, best)
    low, high = annulus(every)
    at = {-1: start - 1, 1: start + 1}
    while True:
        busy = False
        for step, place in at.items():
            rows = np.flatnonzero((place >= low) & (place < high))
            if not len(rows):
                continue
            busy = True
            entries = order[place[rows]]
            d = distance(rows, entries)
            won = (d < least[rows]) | ((d == least[rows]) & (entries < best[rows]))
            rows_won = rows[won]
            best[rows_won], least[rows_won] = entries[won], d[won]
            low[rows_won], high[rows_won] = annulus(rows_won)
            place[rows] += step
        if not busy:
            return best, least


def _cuts(dim: int, parts: int) -> list[tuple[int, int]]:
    """Where parts begin and end; where ``parts`` does not divide ``dim`` the first ones are longer by one."""
    ends = np.cumsum([0] + [dim // parts + (i < dim % parts) for i in range(parts)]).tolist()
    return list(zip(ends[:-1], ends[1:], strict=True))


def _integers(b: pa.RecordBatch, vec: str, dim: int, scale: int) -> np.ndarray:
    flat = b.column(vec).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).astype(np.int64).reshape(b.num_rows, dim)


def usable(vectors: DataFrame, vec: str = "embedding", scale: int = 4096) -> DataFrame:
    """``vectors`` without those that are null, that hold null or non-finite components, or one of ``MOST / scale`` or more."""
    name = f"`{vec}`"
    return vectors.where(f"{name} is not null and forall({name}, x -> x is not null and not isnan(x) and abs(x) < {MOST / scale}D)")


def _assigned(batches: Iterator[pa.RecordBatch], vec: str, books: Codebooks) -> Iterator[tuple[pa.RecordBatch, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
    """Each batch, and for each part its integers, its entries and their distances."""
    cuts = _cuts(books.dim, len(books.books))
    arrays = [np.array(book, np.int64).reshape(len(book), j - i) for (i, j), book in zip(cuts, books.books, strict=True)]
    for b in batches:
        if b.num_rows:
            x = _integers(b, vec, books.dim, books.scale)
            yield b, [(x[:, i:j], *nearest(x[:, i:j], book)) for (i, j), book in zip(cuts, arrays, strict=True)]


def learn(vectors: DataFrame, vec: str = "embedding", order: str = "vec_id", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> Codebooks:
    """Codebooks of ``vectors``, each component x counted as floor(scale * x).

    They start as the parts of the ``entries`` vectors that come first by ``order`` (null ones last, of
    equals the lesser vector). A round assigns all parts to their nearest entries and replaces each
    entry by the floor of its parts' mean; entries without parts stay. All arithmetic is on integers,
    so that neither partitions nor retries change a bit. Each round reads the vectors once, and sends
    a count and a sum for each component of each entry. Vectors that ``usable`` leaves out, or of
    another length than the first one's, are not read; an empty table gives empty codebooks.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: up to 256 entries")
    good = usable(vectors, vec, scale).select(F.col(f"`{order}`").alias("o"), F.col(f"`{vec}`").alias("v"))
    first = [r.v for r in good.orderBy(F.col("o").asc_nulls_last(), "v").limit(entries).collect()]
    dim = len(first[0]) if first else 0
    if any(len(v) != dim for v in first):
        good = good.where(F.size("v") == dim)
        first = [r.v for r in good.orderBy(F.col("o").asc_nulls_last(), "v").limit(entries).collect()]
    start = np.floor(np.array(first, np.float64).reshape(len(first), dim) * scale).astype(np.int64)
    cuts = _cuts(dim, parts)
    books = Codebooks(tuple(tuple(map(tuple, start[:, i:j].tolist())) for i, j in cuts), dim, scale)
    good = good.where(F.size("v") == dim).select("v")
    for _ in range(rounds if dim else 0):

        def sums(batches: Iterator[pa.RecordBatch], books: Codebooks = books) -> Iterator[pa.RecordBatch]:
            total: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for _, found in _assigned(batches, "v", books):
                for p, (x, best, _) in enumerate(found):
                    k = len(books.books[p])
                    count, sum_ = total.setdefault(p, (np.zeros(k, np.int64), np.zeros((k, x.shape[1]), np.int64)))
                    count += np.bincount(best, minlength=k)
                    np.add.at(sum_, best, x)
            for p, (count, sum_) in total.items():
                e, i = np.indices(sum_.shape).reshape(2, -1)
                columns = [np.full(len(e), p), e, i, np.repeat(count, sum_.shape[1]), sum_.ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["p", "e", "i", "n", "total"])

        parted = good.mapInArrow(sums, "p bigint, e bigint, i bigint, n bigint, total bigint")
        wide = parted.groupBy("p", "e", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        # As many rows as the codebooks have components.
        new = [[list(e) for e in book] for book in books.books]
        for r in wide.where("n > 0").collect():
            new[r.p][r.e][r.i] = int(r.total) // r.n
        books = Codebooks(tuple(tuple(map(tuple, book)) for book in new), dim, scale)
    return books


def encode(vectors: DataFrame, books: Codebooks, vec: str = "embedding") -> DataFrame:
    """The usable ``vectors`` with code (two hex digits a part) and error (squared distances summed over the parts).

    Vectors of another length than the codebooks' are left out. Columns of the same names are replaced.
    """
    keep = [c for c in vectors.columns if c.lower() not in ("code", "error")]
    good = usable(vectors, vec, books.scale).where(F.size(f"`{vec}`") == books.dim).select(*[F.col(f"`{c}`") for c in keep])
    parts = len(books.books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, found in _assigned(batches, vec, books):
            flat = np.stack([best for _, best, _ in found], 1).astype(np.uint8).tobytes().hex()
            codes = [flat[i : i + 2 * parts] for i in range(0, len(flat), 2 * parts)]
            errors = sum(d for _, _, d in found)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes, pa.string()), pa.array(errors, pa.int64())], [*b.schema.names, "code", "error"])

    return good.mapInArrow(coded, StructType([*good.schema.fields, StructField("code", StringType()), StructField("error", LongType())]))


def with_sums(coded: DataFrame, by: str = "label") -> DataFrame:
    """``coded`` with label_error, the errors of all rows of an equal label, null ones being equal.

    Sums are formed before the shuffle, so a label may have most of the rows; they come back by
    broadcast up to a number of labels that is counted, by a shuffle join beyond.
    """
    coded = stored(coded, "coded")
    other = spare(coded, "__label")
    sums = coded.groupBy(F.col(f"`{by}`").alias(other)).agg(F.sum("error").alias("label_error"))
    sums = small(stored(sums, "sums"), _LABELS)
    return coded.join(sums, F.col(f"`{by}`").eqNullSafe(F.col(other))).drop(other)
