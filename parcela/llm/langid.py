"""Language by rank-order profiles of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, stored

#: n-grams in a profile and of a document; documents of each language that its profile is learned from
#: (about so many; drawn by a hash of id and text, all of them where there are fewer); and languages at most.
TOP, LEARN, MOST_LANGS = 300, 5_000, 2_000

_GAP = 1  # what stands for a run of characters that are no letters


def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() if not 0xD800 <= i < 0xE000 else False for i in range(0x110000)], bool)


class Grams:
    """The 1- to 3-grams of a text's letters, packed in 64-bit numbers."""

    def __init__(self) -> None:
        self.letter = _letters()

    def __call__(self, text: str | None) -> np.ndarray:
        c = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
        is_letter = self.letter[c]
        if not is_letter.any():
            return np.empty(0, np.uint64)
        c = np.where(is_letter, c, _GAP).astype(np.uint64)
        c = np.concatenate(([np.uint64(_GAP)], c, [np.uint64(_GAP)]))
        c = c[np.concatenate(([True], (c[1:] != _GAP) | (c[:-1] != _GAP)))]
        shift = np.uint64(21)
        two = c[:-1] << shift | c[1:]
        three = two[:-1] << shift | c[2:]
        return np.concatenate((c[c != _GAP], two, three))


def ranked(keys: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent keys, of equals the smaller first."""
    found, count = np.unique(keys, return_counts=True)
    if len(found) > top:
        least = np.partition(count, len(count) - top)[len(count) - top]
        found, count = found[count >= least], count[count >= least]
    return found[np.lexsort((found, -count))][:top]


def learn(docs: DataFrame, top: int = TOP, most: int = LEARN) -> list[tuple[str, int, int]]:
    """(lang, gram, rank) of each language of ``docs`` (doc_id, text, lang); rows without text or lang are unread.

    Each language is learned from about ``most`` documents of its own, so that a rare one keeps all of its few.
    What comes to the driver is ``top`` rows for each distinct value of lang; more than ``MOST_LANGS``
    values are an error, as their profiles would not fit a task. Equal counts are ranked by the gram's code, so
    the result depends on the rows alone. Repeated rows are in or out together.
    """
    shared_dir(docs.sparkSession)
    known = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    counts = stored(known.groupBy("lang").agg(F.count("*").alias("n")), "langs")
    if counts.count() > MOST_LANGS:
        raise ValueError(f"lang has more than {MOST_LANGS} values")
    part = counts.select("lang", (F.lit(1_000_000.0) * most / F.col("n")).alias("part"))
    # At most ``MOST_LANGS`` rows.
    known = known.join(F.broadcast(part), "lang").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.col("part"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held, size = Grams(), {}, 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                key, count = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key.astype(np.int64)), pa.array(count, pa.int64())], ["lang", "gram", "n"])
            held.clear()

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                g = grams(text)
                held.setdefault(lang, []).append(g)
                size += len(g)
                if size > 5_000_000:
                    yield from out()
                    size = 0
        yield from out()

    sums = known.select("lang", "text").mapInArrow(counted, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = sums.withColumn("rank", F.expr("row_number() over (partition by lang order by n desc, gram) - 1")).where(f"rank < {top}")
    return [(r.lang, r.gram, r.rank) for r in best.select("lang", "gram", "rank").collect()]


class Profiles:
    """Out-of-place distance to each learned language.

    Each gram has the list of the languages that know it, and its rank there: 14 bytes for each row of the profiles,
    4 MB for a thousand languages. A document meets the lists of its own grams alone.
    """

    def __init__(self, rows: list[tuple[str, int, int]], top: int = TOP) -> None:
        self.top = top
        self.langs = sorted({r[0] for r in rows})
        number = {lang: i for i, lang in enumerate(self.langs)}
        gram = np.array([r[1] for r in rows], np.int64).view(np.uint64)
        order = np.argsort(gram, kind="stable")
        self.lang = np.array([number[r[0]] for r in rows], np.int32)[order]
        self.rank = np.array([r[2] for r in rows], np.int16)[order]
        self.keys, first = np.unique(gram[order], return_index=True)
        self.ends = np.append(first, len(rows)).astype(np.int32)

    def judge(self, keys: np.ndarray) -> tuple[str, float]:
        mine = ranked(keys, self.top)
        if not len(mine) or not self.langs:
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.keys, mine), len(self.keys) - 1)
        place = np.flatnonzero(self.keys[at] == mine)
        begin, size = self.ends[at[place]].astype(np.int64), np.diff(self.ends)[at[place]].astype(np.int64)
        # The numbers of all entries of these lists, list by list.
        entries = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
        near = self.top - np.abs(self.rank[entries] - np.repeat(place, size))
        apart = self.top * len(mine) - np.bincount(self.lang[entries], weights=near, minlength=len(self.langs)).astype(np.int64)
        best = int(apart.argmin())  # of equals the first by name
        return self.langs[best], 1.0 - float(apart[best]) / (self.top * len(mine))


def identify(docs: DataFrame, profiles: list[tuple[str, int, int]], top: int = TOP) -> DataFrame:
    """``doc_id`` with lang_pred and score: 1 less the distance, as a share of the largest possible.

    Whole texts are read. A text that is null or has no letter is ``und`` with score 0, as is every
    text if no language is known. Profiles go out with the tasks: 8 MB for the ``MOST_LANGS`` languages that ``learn`` gives at most.
    """
    kind = dict(docs.dtypes)["doc_id"]
    known = Profiles(profiles, top)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for b in batches:
            found = [known.judge(grams(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(each, f"doc_id {kind}, lang_pred string, score double")
