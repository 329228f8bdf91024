"""Passages that stand in more than one place, found by parsing documents relative to indexed reference blocks.

A document is factored greedily against reference text: from a place on, the longest run of words that the
reference has elsewhere is a factor, and the parse goes on behind it. Factors of a window's length or more
are duplicate spans, and windows that begin in a factor and reach over its end are looked up by themselves.

To parse every document against every block would take time with the square of the corpus. So places are
dealt to blocks by content. Of the ``SEED``-word runs in a window those of the least hash are its anchors: equal
windows have equal anchors. All places of an anchor meet in one block, each with the words around
it that a window with this anchor can reach, its context. A block that does not get a place has no
factor for it, so nothing is lost. Of equal contexts one stands for all: it is a factor as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, small, stored
from .shingles import Codes, mixed

#: Words of an anchor.
SEED = 12
#: Contexts of a block, about; and of one anchor in a block. Anchors with more are dealt to several.
BLOCK, CROWD = 10_000, 2_000
#: Texts, and words, that a Python worker takes at once.
_SLICE, _WORDS = 512, 300_000
#: Anchors that are sent to all tasks; beyond, they are joined by shuffle.
_NEAR = 400_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class _Runs:
    """Hashes of any run of words, from sums of codes times powers of an odd number, modulo 2^64."""

    def __init__(self, codes: np.ndarray) -> None:
        n = len(codes)
        powers = np.cumprod(np.full(n, _STEP, np.uint64))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(codes) * powers, dtype=np.uint64)))
        self.back = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, _BACK, np.uint64))))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the words from ``start`` up to ``end``."""
        return mixed((self.sums[end] - self.sums[start]) * self.back[start], 7) + (end - start).astype(np.uint64)


def _slid(x: np.ndarray, n: int, best: np.ufunc) -> np.ndarray:
    """``best`` of each ``n`` neighbours, by doubling."""
    out, have = None, 0
    wide, width = x, 1
    while n:
        if n & 1:
            out = wide if out is None else best(out[: len(out) - width], wide[have:])
            have += width
        n >>= 1
        if n:
            wide = best(wide[: max(0, len(wide) - width)], wide[width:])
            width *= 2
    return out


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of the batches and the words of each text; a slice has few words, or one text."""
    for b in batches:
        for i in range(0, b.num_rows, _SLICE):
            part = b.slice(i, _SLICE)
            found: list[list[bytes]] = []
            begin = size = 0
            for k, t in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                found.append((t or b"").split())
                size += len(found[-1])
                if size >= _WORDS:
                    yield part.slice(begin, k + 1 - begin), found
                    begin, found, size = k + 1, [], 0
            if found:
                yield part.slice(begin), found


def _coded(texts: list[list[bytes]], codes: Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The codes of all words, and where each text begins and ends."""
    ends = np.cumsum([len(t) for t in texts])
    flat = np.frombuffer(b"".join(codes[w] for t in texts for w in t), np.uint64)
    return flat, np.concatenate(([0], ends[:-1])).astype(np.int64), ends.astype(np.int64)


def _reach(window: int) -> tuple[int, int]:
    """Words before and from an anchor's first word that windows with this anchor can hold."""
    return window - SEED, window


def _anchors(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, place, key and ctx of each anchor: the hash of its own words, and that of its context."""
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    if len(flat) < window:
        return none
    runs, span = _Runs(flat), window - SEED + 1
    at = np.arange(len(flat) - SEED + 1)
    h = np.maximum(runs.hash(at, at + SEED), np.uint64(1))
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    least = _slid(h, span, np.minimum)
    least[owner[: len(least)] != owner[window - 1 :]] = 0  # a window of two texts is none
    edge = np.zeros(span - 1, np.uint64)
    most = _slid(np.concatenate((edge, least, edge)), span, np.maximum)
    found = np.flatnonzero(most == h)
    text = owner[found]
    before, behind = _reach(window)
    a, b = np.maximum(starts[text], found - before), np.minimum(ends[text], found + behind)
    ctx = runs.hash(a, b) + mixed((found - a).astype(np.uint64), 3)
    return text, found - starts[text], h[found], ctx


def _ids() -> list[Column]:
    """128 bits that name a text."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("i"), F.xxhash64(F.lit("again"), text).alias("j")]


def _places(docs: DataFrame, window: int) -> DataFrame:
    """i, j (the text), pos, key and ctx of all anchors of all documents."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for b, texts in _words(batches):
            text, pos, key, ctx = _anchors(*_coded(texts, codes), window)
            if len(text):
                ids = [b.column(c).to_numpy()[text] for c in ("i", "j")]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (*ids, pos, key, ctx)], ["i", "j", "pos", "key", "ctx"])

    return docs.select(*_ids(), "text").mapInArrow(each, "i bigint, j bigint, pos bigint, key bigint, ctx bigint")


def _contexts(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """key, ctx and words (codes, as bytes; none before the text's begin or behind its end) of ``wanted`` (i, j, pos, key, ctx)."""
    before, behind = _reach(window)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for b, texts in _words(batches):
            flat, starts, _ = _coded(texts, codes)
            rows = []
            for s, t, places in zip(starts.tolist(), texts, b.column("places").to_pylist(), strict=True):
                for p in places:
                    at = p["pos"]
                    a, e = max(0, at - before), min(len(t), at + behind)
                    rows.append((p["key"], p["ctx"], at - a, flat[s + a : s + e].tobytes()))
            key, ctx, left, words = zip(*rows, strict=True)
            arrays = [pa.array(key, pa.int64()), pa.array(ctx, pa.int64()), pa.array(left, pa.int32()), pa.array(words, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "ctx", "left", "words"])

    by_text = wanted.groupBy("i", "j").agg(F.collect_list(F.struct("pos", "key", "ctx")).alias("places"))
    texts = docs.select(*_ids(), "text").join(by_text, ["i", "j"]).select("text", "places")
    found = texts.mapInArrow(each, "key bigint, ctx bigint, left int, words binary")
    # Copies of a text give equal contexts.
    return found.groupBy("key", "ctx").agg(F.first("left").alias("left"), F.first("words").alias("words"))


def _laid(left: np.ndarray, words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts as rows with their anchors below one another, and which cells hold a word.

    Cells without a word hold numbers of their own, which agree with nothing.
    """
    before, behind = _reach(window)
    size = np.array([len(w) // 8 for w in words])
    column = np.arange(before + behind)
    full = (column >= (before - left)[:, None]) & (column < (before - left + size)[:, None])
    rows = mixed(np.arange(full.size, dtype=np.uint64), 11).reshape(full.shape)
    rows[full] = np.frombuffer(b"".join(words), np.uint64)
    return rows, full


def longest(keys: np.ndarray, rows: np.ndarray, at: int, among: np.ndarray) -> np.ndarray:
    """For each row ``among`` all the longest run of words from column ``at`` that another row of its key has there too.

    Sorted by key and words, a row's longest match is with the row before or behind it.
    """
    tail = np.ascontiguousarray(np.concatenate((keys[:, None], rows[:, at:]), 1))
    order = np.argsort(tail.view(f"S{tail.shape[1] * 8}").ravel(), kind="stable")
    lines = tail[order]
    same = lines[1:] == lines[:-1]
    run = np.where(same.all(1), same.shape[1], same.argmin(1))
    run = np.maximum(0, run - 1)  # without the key
    edge = np.zeros(1, run.dtype)
    both = np.maximum(np.concatenate((edge, run)), np.concatenate((run, edge)))
    out = np.empty(len(rows), np.int64)
    out[order] = both
    return out[among]


def factored(keys: np.ndarray, rows: np.ndarray, full: np.ndarray, window: int) -> np.ndarray:
    """For each context the starts of windows that stand elsewhere, as bits: its greedy parse against the block.

    A parse begins at the context's first word. A factor of ``window`` words or more makes duplicates of
    all windows in it, and goes on behind it, but for windows that begin in its last words and reach over its
    end: they are looked up each. A shorter factor is no span; the parse goes on at the next word.
    """
    span = window - SEED + 1
    out = np.zeros(len(rows), np.int64)
    inside = np.zeros(len(rows), np.int64)  # up to this start windows lie in the factor found last
    for at in range(span):
        ask = np.flatnonzero(full[:, at] & (inside <= at))
        if len(ask):
            length = longest(keys, rows, at, ask)
            inside[ask] = np.where(length >= window, at + length - window + 1, inside[ask])
        out[inside > at] |= 1 << at
    return out


def _verdicts(contexts: DataFrame, window: int) -> DataFrame:
    """key, ctx, starts (bits) of ``contexts`` (key, ctx, left, words), each parsed against its block.

    An anchor with a crowd of contexts is dealt to several blocks. Each of them then also tells the hashes of its
    different windows, and a window that is alone in its block stands elsewhere if another block has it too.
    """
    sizes = contexts.groupBy("key").count()
    crowds = stored(sizes.where(F.col("count") > CROWD).select("key", F.ceil(F.col("count") / CROWD).alias("deals")), "crowds")
    blocks = max(1, -(-contexts.count() // BLOCK))
    dealt = contexts.join(small(crowds, _NEAR), "key", "left")
    deal = F.coalesce(F.pmod(F.hash("ctx"), "deals"), F.lit(0))
    dealt = dealt.select("key", "ctx", "left", "words", F.col("deals").isNotNull().alias("crowd"), F.pmod(F.hash("key", deal), F.lit(blocks)).alias("block"))

    def parsed(table: pa.Table) -> pa.Table:
        key = table.column("key").to_numpy()
        rows, full = _laid(table.column("left").to_numpy(), table.column("words").to_pylist(), window)
        starts = factored(key.view(np.uint64), rows, full, window)
        crowd = np.flatnonzero(table.column("crowd").to_numpy(zero_copy_only=False))
        row, at, words = _told(key, rows, full, starts, crowd, window)
        none = pa.nulls(len(key), pa.int64())
        alone = pa.array(((starts[row] >> at) & 1) == 0)
        whole = pa.table({"key": table.column("key"), "ctx": table.column("ctx"), "starts": pa.array(starts), "at": none, "words": none, "alone": pa.nulls(len(key), pa.bool_())})
        told = pa.table({"key": pa.array(key[row]), "ctx": table.column("ctx").take(pa.array(row)), "starts": pa.nulls(len(row), pa.int64()), "at": pa.array(at), "words": pa.array(words.view(np.int64)), "alone": alone})
        return pa.concat_tables([whole, told])

    found = dealt.groupBy("block").applyInArrow(parsed, "key bigint, ctx bigint, starts bigint, at bigint, words bigint, alone boolean")
    if crowds.isEmpty():
        return found.select("key", "ctx", "starts")
    found = stored(found, "parsed")
    # As many rows as an anchor has blocks, at most, are of one window.
    met = found.where("at is not null").groupBy("key", "at", "words").agg(F.count("*").alias("n"), F.collect_list(F.when(F.col("alone"), F.col("ctx"))).alias("ctxs"))
    more = met.where("n > 1").select("key", F.explode("ctxs").alias("ctx"), F.expr("shiftleft(1L, cast(at as int))").alias("starts"))
    return found.where("at is null").select("key", "ctx", "starts").union(more).groupBy("key", "ctx").agg(F.bit_or("starts").alias("starts"))


def _told(key: np.ndarray, rows: np.ndarray, full: np.ndarray, starts: np.ndarray, crowd: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, start and hash of the different windows of the rows ``crowd``, those that stand alone and one of each other kind."""
    before, _ = _reach(window)
    some = full[crowd]
    row, at = np.nonzero(some[:, : before + 1] & some[:, window - 1 :])
    begin = row * rows.shape[1] + at
    row = crowd[row]
    words = _Runs(rows[crowd].ravel()).hash(begin, begin + window) if len(crowd) else np.empty(0, np.uint64)
    alone = ((starts[row] >> at) & 1) == 0
    order = np.lexsort((words, at, key[row]))
    same = np.zeros(len(row), bool)
    same[1:] = (key[row][order][1:] == key[row][order][:-1]) & (at[order][1:] == at[order][:-1]) & (words[order][1:] == words[order][:-1])
    keep = np.empty(len(row), bool)
    keep[order] = ~same
    keep |= alone
    return row[keep], at[keep].astype(np.int64), words[keep]


def _starts(docs: DataFrame, window: int) -> DataFrame:
    """i, j and found (pos and starts of each anchor with windows that stand elsewhere) of texts that have any."""
    places = stored(_places(docs, window), "places")
    keys = places.groupBy("key").agg(F.count("*").alias("n"), F.min("ctx").alias("low"), F.max("ctx").alias("high"))
    keys = stored(keys.where("n > 1").select("key", (F.col("low") != F.col("high")).alias("open")), "keys")
    met = stored(places.join(small(keys, _NEAR), "key"), "met")
    every = (1 << (window - SEED + 1)) - 1
    cases = met.where("open").groupBy("key", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("i", "j", "pos")).alias("first"))
    cases = stored(cases, "cases")
    contexts = stored(_contexts(docs, cases.select("first.*", "key", "ctx"), window), "contexts")
    parsed = _verdicts(contexts, window)
    verdicts = cases.join(parsed, ["key", "ctx"], "left").select("key", "ctx", F.when(F.col("n") > 1, every).otherwise(F.col("starts")).alias("starts"))
    verdicts = stored(verdicts.where("starts <> 0"), "verdicts")
    opened = met.where("open").join(verdicts, ["key", "ctx"]).select("i", "j", "pos", "starts")
    whole = met.where("not open").select("i", "j", "pos", F.lit(every).cast("bigint").alias("starts"))
    # Copies of a text say the same.
    return whole.union(opened).distinct().groupBy("i", "j").agg(F.collect_list(F.struct("pos", "starts")).alias("found"))


def _covered(n: int, found: list[dict[str, int]] | None, window: int) -> np.ndarray:
    """Which of ``n`` words a window covers that stands elsewhere."""
    before, _ = _reach(window)
    depth = np.zeros(n + 1, np.int64)
    if found:
        pos, starts = np.array([[f["pos"], f["starts"]] for f in found], np.int64).T
        row, at = np.nonzero((starts[:, None] >> np.arange(before + 1)) & 1)
        begin = np.unique(pos[row] - before + at)
        begin = begin[(begin >= 0) & (begin <= n - window)]
        depth[begin] += 1
        np.subtract.at(depth, begin + window, 1)
    return np.cumsum(depth)[:n] > 0


def cut(docs: DataFrame, window: int = 50) -> DataFrame:
    """A row per document: doc_id, n_words, n_removed, spans and kept, the text without passages that stand elsewhere too.

    Words are runs of anything but ASCII white space. A word is removed if one of the windows of ``window`` words
    around it has the same words as one that begins anywhere else, in the same document or another, judged on
    the input. spans are the runs of removed words (start, end, by number from 0, end exclusive); kept are the
    words left, joined by one space. Null and empty texts, and those of fewer words, lose nothing. Rows that agree in
    doc_id and text are two places. Documents are named by two 64-bit hashes of their text, words by one,
    and anchors and contexts by one each; other columns are unread.
    """
    if not SEED <= window <= SEED + 62:
        raise ValueError(f"a window has {SEED} to {SEED + 62} words")
    docs = docs.select("doc_id", "text")
    with arrow_rows(docs.sparkSession, _SLICE):
        starts = stored(_starts(docs, window), "starts")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in _words(batches):
            count, removed, spans, kept = [], [], [], []
            for words, found in zip(texts, b.column("found").to_pylist(), strict=True):
                gone = _covered(len(words), found, window)
                turns = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                count.append(len(words))
                removed.append(int(gone.sum()))
                spans.append([{"start": s, "end": e} for s, e in turns.reshape(-1, 2).tolist()])
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]) if removed[-1] else b" ".join(words))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [b.column("doc_id"), pa.array(count, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "spans", "kept"])

    every = docs.select("doc_id", "text", *_ids()).join(starts, ["i", "j"], "left").select("doc_id", "text", "found")
    return every.mapInArrow(each, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept string")
