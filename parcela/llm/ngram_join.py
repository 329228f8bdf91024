"""Near-duplicate join on word shingles with a token-group matrix.

Documents with one and the same shingle set form a class. Two sets of n tokens and similarity t or
more have a token in common among the first ``n - ceil(t n) + 1`` of each, in any order that all
sets share: the prefix. The order puts first the tokens that no other class has, so most prefixes
hold nothing else, and their classes, which link with nothing, leave early (``_shared``, first over
part of the tokens of all classes, then over all tokens of those that are left).

The classes left are brought into groups of similar ones (``_groups``). The token-group matrix has,
for each token, the groups with the token in the union of their prefixes. A class is a query to it:
a group is opened only if prefix places and set sizes leave room for enough overlap (``_opened``),
and the members of an opened group whose token histograms leave that room as well (``_possible``) are
compared with the query over whole sets (``_verified``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, components, rows_left, shared_dir, small, stored, text_mark
from .shingles import Codes, mixed, set_id, shingle_set

#: Of all classes, tokens below this 64-bit number are counted.
_POOL = int(0.25 * 2**64)
#: Tokens in a batch of the first pass, tokens that a counting task gets on average, the classes of
#: one batch from which on a token counts as very common, and the length of a class's sketch.
_BATCH, _TASK, _COMMON, _SKETCH, _BANDS = 800_000, 500_000, 32, 12, 4
#: Parts that a batch is dealt to at most, and partitions of a shuffle at most. Beyond them parts are
#: dealt again to finer ones, and a task takes several of those in turn.
_PARTS, _REDUCERS = 4_096, 20_000
_SLICE = 512  # rows that a Python worker holds as objects
_NEED = 2_000_000  # ids that may be broadcast

_ENTRY = np.dtype([("cls", "<i8"), ("token", "<u8"), ("level", "u1")])
_CLASS = np.dtype([("cls", "<i8"), ("n", "<u4"), ("pool", "<u4")])


def _texts(batches: Iterator[pa.RecordBatch], of: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of the batches with one column as bytes; no more than a slice is held as Python objects."""
    for b in batches:
        for i in range(0, b.num_rows, _SLICE):
            part = b.slice(i, _SLICE)
            yield part, part.column(of).cast(pa.binary()).to_pylist()


def _members(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, cls (null without words), other (a second number of the set) and n of each document."""
    kind = dict(docs.dtypes)["doc_id"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for b, texts in _texts(batches):
            sets = [shingle_set(t, k, codes) for t in texts]
            cls = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
            other = pa.array([set_id(s, again=1) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), cls, other, pa.array(map(len, sets), pa.int64())], ["doc_id", "cls", "other", "n"])

    return docs.select("doc_id", "text").mapInArrow(each, f"doc_id {kind}, cls bigint, other bigint, n bigint")


def _apart(members: DataFrame) -> tuple[DataFrame, frozenset[int]]:
    """``members`` with unlike sets in unlike classes, and the ids that unlike sets had in common.

    Sets whose first numbers are equal by chance, some hundreds in 10^11, go by their second ones.
    """
    pairs = members.where("cls is not null").groupBy("cls").agg(F.min("other").alias("low"), F.max("other").alias("high"))
    met = pairs.where("low <> high").select("cls").limit(_NEED + 1).collect()
    if len(met) > _NEED:
        raise RuntimeError("set ids collide more often than chance allows")
    shared = frozenset(r.cls for r in met)
    if shared:
        table = F.broadcast(members.sparkSession.createDataFrame([(c, True) for c in shared], "cls bigint, met boolean"))
        members = members.join(table, "cls", "left").withColumn("cls", F.when(F.col("met"), F.col("other")).otherwise(F.col("cls")))
    return members.select("doc_id", "cls", "n"), shared


def _dealt(values: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``values`` in the parts that ``keys`` say, without empty ones."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    if not len(keys):
        return
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(keys)], strict=True):
        yield int(keys[begin]), values[begin:end]


def _batch(rows: list[tuple[int, str, bytes]]) -> pa.RecordBatch:
    part, kind, blob = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(kind, pa.string()), pa.array(blob, pa.binary())], ["part", "kind", "blob"])


_BLOBS = "part bigint, kind string, blob binary"
_PAIR = np.dtype([("cls", "<i8"), ("token", "<u8")])


def _token_blob(cls: np.ndarray, token: np.ndarray) -> bytes:
    """Tokens and their classes, each class once."""
    used, at = np.unique(cls, return_inverse=True)
    return np.array([len(used), len(token)], "<u4").tobytes() + used.astype("<i8").tobytes() + token.astype("<u8").tobytes() + at.astype("<u4").tobytes()


def _of_token_blob(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    d, n = (int(x) for x in np.frombuffer(blob, "<u4", 2))
    ids, token = np.frombuffer(blob, "<i8", d, 8), np.frombuffer(blob, "<u8", n, 8 + 8 * d)
    return ids[np.frombuffer(blob, "<u4", n, 8 + 8 * d + 8 * n)], token


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, bytes]]:
    for b in batches:
        for i in range(0, b.num_rows, 256):
            piece = b.slice(i, 256)
            yield from zip(*(piece.column(c).to_pylist() for c in ("part", "kind", "blob")), strict=True)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, str, bytes]]]]:
    """The blobs of each part in turn; they come sorted by part."""
    return groupby(_blobs(batches), key=itemgetter(0))


def _common(token: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted tokens, those that occur ``least`` times or more, and where they are."""
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(token)), bool), token[1:] != token[:-1])))
    count = np.diff(np.append(first, len(token)))
    return token[first[count >= least]], np.repeat(count >= least, count)


def _parted(blobs: DataFrame, parts: int) -> DataFrame:
    """``blobs`` with each part in one task, part after part. ``parts`` above ``_PARTS`` are reached by dealing twice.

    A blob's first part is its key modulo the first dealing's count; the second dealing reads a first part's blobs by
    the batch, so that its tokens are dense there: a token that no single batch of the corpus has often enough to be
    sent as a mark is met here, and its entries leave the way of the counting tasks.
    """
    if parts > _PARTS:

        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[str, list[np.ndarray]] = {}
            size = 0

            def finer(x: np.ndarray) -> np.ndarray:
                return (x.astype(np.uint64) % np.uint64(parts)).astype(np.int64)

            def flush() -> Iterator[pa.RecordBatch]:
                out = []
                if "token" in held:
                    pairs = np.concatenate(held["token"])
                    pairs = pairs[np.argsort(pairs["token"])]
                    marks, often = _common(pairs["token"], _COMMON)
                    out += [(p, "mark", x.tobytes()) for p, x in _dealt(marks, finer(marks))]
                    if often.any():
                        past = np.zeros(int(often.sum()), _ENTRY)
                        past["cls"], past["token"], past["level"] = pairs["cls"][often], pairs["token"][often], 255
                        out.append((int(past["cls"][0]) % parts, "entry", past.tobytes()))
                    pairs = pairs[~often]
                    out += [(p, "token", _token_blob(x["cls"], x["token"])) for p, x in _dealt(pairs, finer(pairs["token"]))]
                for kind, of, field in (("mark", "<u8", None), ("class", _CLASS, "cls"), ("entry", _ENTRY, "cls")):
                    if kind in held:
                        x = np.concatenate(held[kind])
                        out += [(p, kind, y.tobytes()) for p, y in _dealt(x, finer(x if field is None else x[field]))]
                held.clear()
                for i in range(0, len(out), 4096):
                    yield _batch(out[i : i + 4096])

            for _, kind, blob in _blobs(batches):
                if kind == "token":
                    cls, token = _of_token_blob(blob)
                    x = np.zeros(len(cls), _PAIR)
                    x["cls"], x["token"] = cls, token
                else:
                    x = np.frombuffer(blob, {"mark": "<u8", "class": _CLASS, "entry": _ENTRY}[kind])
                held.setdefault(kind, []).append(x)
                size += len(x)
                if size >= 2 * _BATCH:
                    yield from flush()
                    size = 0
            yield from flush()

        blobs = blobs.repartition(_PARTS, "part").mapInArrow(again, _BLOBS)
    return blobs.repartition(min(parts, _REDUCERS), "part").sortWithinPartitions("part")


def _shared(rows: DataFrame, sets_of: Callable, percent: int, below: int, total: int, clash: frozenset[int] = frozenset()) -> DataFrame:
    """(cls, n, alone, tokens) of each class whose prefix has a token that other classes have too.

    ``sets_of`` makes sets from batches of ``rows``; about ``total`` tokens are expected. Those
    under ``below`` are counted. The order has first what one class alone has (``alone`` tokens),
    then the rarer, then what is not counted; ``tokens`` are those of the prefix after the first.

    Batches of classes send their tokens to counting parts by token, packed in blobs. A token that
    many classes of a batch have is sent as a mark only, its entries passing the counting by, so that
    no common token gathers anywhere: of any other a batch has fewer than ``_COMMON`` entries, and where
    batches are very many, so has a batch of the second dealing (``_parted``). What has one class alone ends there; the
    rest goes on to parts by class, which cut the prefixes. A part is what one task holds at once.
    """
    parts = max(1, total // _TASK + 1)
    deal = min(parts, _PARTS)
    pool_end = np.uint64(min(below, 2**64 - 1))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, int, np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            classes = np.zeros(len(seen), _CLASS)
            classes["cls"] = list(seen)
            classes["n"] = [n for n, _, _ in seen.values()]
            classes["pool"] = [c for _, c, _ in seen.values()]
            token = np.concatenate([t for _, _, t in seen.values()])
            cls = np.repeat(classes["cls"], [len(t) for _, _, t in seen.values()])
            seen.clear()
            order = np.argsort(token)
            token, cls = token[order], cls[order]
            marks, often = _common(token, _COMMON)
            # Any part will do, but not the same of all tasks.
            home = int(classes["cls"][0]) % deal
            out = [(home, "class", classes.tobytes())]
            out += [(p, "mark", x.tobytes()) for p, x in _dealt(marks, (marks % np.uint64(deal)).astype(np.int64))]
            if often.any():
                by = np.zeros(int(often.sum()), _ENTRY)
                by["cls"], by["token"], by["level"] = cls[often], token[often], 255
                out.append(((home * 7919 + 1) % deal, "entry", by.tobytes()))
            pairs = np.zeros(len(token) - int(often.sum()), _PAIR)
            pairs["cls"], pairs["token"] = cls[~often], token[~often]
            out += [(p, "token", _token_blob(x["cls"], x["token"])) for p, x in _dealt(pairs, (pairs["token"] % np.uint64(deal)).astype(np.int64))]
            yield _batch(out)

        held = 0
        for s in sets_of(batches):
            if not len(s) or (cls := set_id(s, clash)) in seen:
                continue
            pool = int(np.searchsorted(s, pool_end, "right"))
            mine = s[: max(pool, len(s) - -(-percent * len(s) // 100) + 1)]
            seen[cls] = (len(s), pool, mine.copy())
            held += len(mine)
            if held >= _BATCH:
                yield from flush()
                held = 0
        if seen:
            yield from flush()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, str, bytes]] = []

        def onward(kind: str, x: np.ndarray) -> None:
            out.extend((p, kind, y.tobytes()) for p, y in _dealt(x, (x["cls"].astype(np.uint64) % np.uint64(deal)).astype(np.int64)))

        for _, blobs in _by_part(batches):
            token, cls, marks = [], [], []
            for _, kind, blob in blobs:
                if kind == "class":
                    onward("class", np.frombuffer(blob, _CLASS))
                elif kind == "entry":
                    onward("entry", np.frombuffer(blob, _ENTRY))
                elif kind == "mark":
                    marks.append(np.frombuffer(blob, "<u8"))
                else:
                    c, t = _of_token_blob(blob)
                    token.append(t)
                    cls.append(c)
                if len(out) >= 4096:
                    yield _batch(out)
                    out.clear()
            if token:
                t, c = np.concatenate(token), np.concatenate(cls)
                token.clear()
                cls.clear()
                order = np.argsort(t)
                t, c = t[order], c[order]
                first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
                count = np.diff(np.append(first, len(t)))
                marked = np.isin(t[first], np.concatenate(marks)) if marks else np.zeros(len(first), bool)
                shared = marked | (np.minimum.reduceat(c, first) != np.maximum.reduceat(c, first))
                level = np.where(marked, 255, np.minimum(count, 254)).astype(np.uint8)
                some = np.repeat(shared, count)
                entries = np.zeros(int(some.sum()), _ENTRY)
                entries["cls"], entries["token"], entries["level"] = c[some], t[some], np.repeat(level, count)[some]
                onward("entry", entries)
        if out:
            yield _batch(out)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _by_part(batches):
            entries, classes = [], []
            for _, kind, blob in blobs:
                (classes if kind == "class" else entries).append(np.frombuffer(blob, _CLASS if kind == "class" else _ENTRY))
            if entries:
                yield _prefixes(np.unique(np.concatenate(classes)), np.concatenate(entries), percent, pool_end)

    first = _parted(rows.mapInArrow(sent, _BLOBS), parts)
    second = _parted(first.mapInArrow(counted, _BLOBS), parts)
    return second.mapInArrow(cut, "cls bigint, n bigint, alone bigint, tokens array<bigint>")


def _prefixes(c: np.ndarray, e: np.ndarray, percent: int, pool_end: np.uint64) -> pa.RecordBatch:
    """The rows of ``_shared`` for classes ``c`` with entries ``e``."""
    beyond = e["token"] > pool_end
    e = e[np.lexsort((e["token"], np.where(beyond, 0, e["level"]), beyond, e["cls"]))]
    e = e[np.concatenate(([True], (e["cls"][1:] != e["cls"][:-1]) | (e["token"][1:] != e["token"][:-1])))]
    first = np.flatnonzero(np.concatenate(([True], e["cls"][1:] != e["cls"][:-1])))
    count = np.diff(np.append(first, len(e)))
    own = c[np.searchsorted(c["cls"], e["cls"][first])]
    beyond = e["token"] > pool_end
    pooled = np.add.reduceat((~beyond).astype(np.int64), first)
    n = own["n"].astype(np.int64)
    prefix = n - -(-percent * n // 100) + 1
    alone = own["pool"].astype(np.int64) - pooled
    room = np.maximum(0, prefix - alone)
    place = np.arange(len(e)) - np.repeat(first, count)
    kept = beyond | (place < np.repeat(room, count))
    sizes = np.add.reduceat(kept.astype(np.int64), first)
    some = sizes > 0
    tokens = pa.array(e["token"][kept].astype(np.int64))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes[some]))).astype(np.int32)), tokens)
    return pa.RecordBatch.from_arrays([pa.array(own["cls"][some]), pa.array(n[some]), pa.array(alone[some]), lists], ["cls", "n", "alone", "tokens"])


def _histogram(s: np.ndarray) -> bytes:
    """How many tokens of a set have each prefix of bits, of some sixteen tokens each.

    The differences of two sets' numbers, without their signs, add up to no more than the tokens that one of the sets has alone.
    """
    bits = max(6, (len(s) // 16).bit_length())
    return np.minimum(np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 65535).astype("<u2").tobytes()


def _may_link(x: bytes, y: bytes, n: int, m: int, percent: int) -> bool:
    """Whether histograms of sets of ``n`` and ``m`` tokens leave room for enough overlap."""
    a, b = (np.frombuffer(h, "<u2").astype(np.int64) for h in (x, y))
    # Sizes are within a factor, so are histograms; the finer one's neighbours add up to the coarser one.
    if len(a) != len(b):
        a, b = (h.reshape(min(len(a), len(b)), -1).sum(1) for h in (a, b))
        if max(a.max(), b.max()) >= 65535:
            return True
    apart = int(np.abs(a - b).sum())
    # With d tokens apart the overlap is (n + m - d) / 2 and the union (n + m + d) / 2.
    return 100 * (n + m - apart) >= percent * (n + m + apart)


def _sets(docs: DataFrame, wanted: DataFrame, k: int, clash: frozenset[int]) -> DataFrame:
    """cls, n, tokens (the set, as bytes), sketch and histogram of each class of ``wanted`` (cls, rep), from the text of ``rep``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for b, texts in _texts(batches):
            rows = []
            for own, t in zip(b.column("cls").to_pylist(), texts, strict=True):
                s = shingle_set(t, k, codes)
                if len(s) and set_id(s, clash) == own:
                    rows.append((own, len(s), s.tobytes(), [int(mixed(s, 101 + i).min() & np.uint64(0x7FFFFFFF)) for i in range(_SKETCH)], _histogram(s)))
            if rows:
                cls, n, blob, sketch, histogram = zip(*rows, strict=True)
                arrays = [pa.array(cls, pa.int64()), pa.array(n, pa.int64()), pa.array(blob, pa.binary()), pa.array(sketch, pa.list_(pa.int32())), pa.array(histogram, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["cls", "n", "tokens", "sketch", "histogram"])

    texts = docs.join(small(wanted, _NEED), docs["doc_id"] == wanted["rep"]).select("cls", "text")
    return texts.mapInArrow(made, "cls bigint, n bigint, tokens binary, sketch array<int>, histogram binary")


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose histograms allow a link.

    Texts made of the same few passages in other choices share their commonest tokens, and meet in numbers that grow with
    the square; histograms are a sixtieth of the sets, and keep such pairs from having their whole sets compared.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, _SLICE):
                part = b.slice(i, _SLICE)
                mask = pa.array([_may_link(x, y, n, m, percent) for x, y, n, m in zip(*(part.column(c).to_pylist() for c in ("x", "y", "n", "m")), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a").filter(mask), part.column("b").filter(mask)], ["a", "b"])

    left = pairs.join(sets.select(F.col("cls").alias("a"), "n", F.col("histogram").alias("x")), "a")
    full = left.join(sets.select(F.col("cls").alias("b"), F.col("n").alias("m"), F.col("histogram").alias("y")), "b")
    return full.select("a", "b", "n", "m", "x", "y").mapInArrow(near, "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole sets are similar."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, left_sets in _texts(batches, "x"):
            keep = []
            for x, y in zip(left_sets, b.column("y").to_pylist(), strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate((s, t)))
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(s) + len(t) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(mask), b.column("b").filter(mask)], ["a", "b"])

    left = pairs.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x")), "a")
    full = left.join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInArrow(alike, "a bigint, b bigint")


def _groups(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a likely leader and a class, by equal least values; sketches sort out the unlikely.

    The leader is the class with the smallest share of tokens that it has alone: of a family of near
    copies the one next to their original, which links with all that can link with any.
    """
    share = F.floor(F.col("alone") * 100_000 / F.col("n")).alias("share")
    bands = sets.select("cls", "n", share, "sketch", F.explode(F.sequence(F.lit(0), F.lit(_BANDS - 1))).alias("band"))
    bands = bands.withColumn("least", F.expr("sketch[band]"))
    lead = bands.groupBy("band", "least").agg(F.min(F.struct("share", "cls", "n", "sketch")).alias("l"), F.count("*").alias("size")).where("size > 1")
    # Written, the leaders come to the join by a shuffle of their own, and a hot value can be split.
    met = bands.join(stored(lead, "leaders"), ["band", "least"]).where("cls <> l.cls")
    equal = "aggregate(zip_with(sketch, l.sketch, (x, y) -> if(x = y, 1, 0)), 0, (x, y) -> x + y)"
    close = f"100 * least(n, l.n) >= {percent} * greatest(n, l.n) and {equal} >= {_SKETCH // 2}"
    return met.where(close).select(F.least("l.cls", "cls").alias("a"), F.greatest("l.cls", "cls").alias("b")).distinct()


def _opened(rows: DataFrame, percent: int) -> DataFrame:
    """(cls, other): the groups to be opened for each class, from ``rows`` (cls, n, alone, tokens, grp).

    Of a pair the larger set is the query, the smaller one is in the matrix. Sets of n and m tokens
    need an overlap of ``a = ceil(t (n + m) / (1 + t))``, so the first token they share has at most
    ``n - a`` and ``m - a`` tokens before it. The smaller set's prefix is therefore shorter. Of a
    group the matrix keeps the sizes and the least place of the token, which bound all its members.
    """
    posted = rows.select("cls", "n", "grp", F.posexplode("tokens").alias("i", "token"), "alone").withColumn("place", F.col("i") + F.col("alone"))
    need = lambda a, b: f"cast(ceil({percent} * ({a} + {b}) / {100 + percent}D - 1e-9D) as bigint)"
    union = posted.where(f"place <= n - {need('n', 'n')}").groupBy("token", F.col("grp").alias("other"))
    matrix = union.agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("place").alias("least"))
    least = f"greatest(low, cast(ceil({percent} * n / 100D - 1e-9D) as bigint))"
    most = "least(high, n)"
    fits = f"{least} <= {most} and place <= n - {need('n', least)} and least <= {most} - {need('n', most)}"
    return posted.join(matrix, "token").where(f"grp <> other and {fits}").select("cls", "other").distinct()


def near(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """A row per document: doc_id, n_shingles and component_id.

    Two documents link when their shared shingles of ``k`` words are ``percent`` per cent of all they
    have, or more; component_id is the smallest doc_id that links lead to, the own one included. No
    text, or one without words, has no shingles and links with nothing. Copies are compared once.
    Rows with a null doc_id get no links of their own, those that agree in doc_id and text agree in the
    result, and an empty table gives none; other columns are unread. Shingles are compared as 64-bit
    fingerprints, sets by two of them.
    """
    with arrow_rows(docs.sparkSession, _SLICE):
        return _near(docs, k, percent)


def _near(docs: DataFrame, k: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    shared_dir(spark)
    docs = docs.select("doc_id", "text")
    members, clash = _apart(stored(_members(docs, k), "members"))
    classes = members.where("cls is not null and doc_id is not null").groupBy("cls")
    classes = stored(classes.agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n")), "classes")

    def of_text(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        codes = Codes()
        for _, texts in _texts(batches):
            for t in texts:
                yield shingle_set(t, k, codes)

    def of_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, blobs in _texts(batches, "tokens"):
            for x in blobs:
                yield np.frombuffer(x, np.uint64)

    total = classes.agg(F.sum("n")).first()[0] or 0
    left = stored(_shared(docs.select("text"), of_text, percent, _POOL, total // 4, clash).select("cls"), "left")
    sets = stored(_sets(docs, stored(classes.join(left, "cls").select("cls", "rep"), "wanted"), k, clash), "sets")

    total = sets.agg(F.sum("n")).first()[0] or 0
    prefixes = stored(_shared(sets.select("tokens"), of_bytes, percent, 2**64, total, clash), "prefixes")
    sketched = sets.select("cls", "sketch").join(prefixes.select("cls", "n", "alone"), "cls")
    likely = stored(_verified(_groups(sketched, percent), sets, percent), "likely")
    grouped = stored(components(likely), "groups").select(F.col("node").alias("cls"), F.col("root").alias("grp"))
    rows = prefixes.join(grouped, "cls", "left").withColumn("grp", F.coalesce("grp", "cls"))
    opened = stored(_opened(rows, percent), "opened")

    every = rows.select("cls", "n", "alone", "grp")
    query = opened.join(every.select("cls", "n", "alone"), "cls")
    inside = query.join(every.select(F.col("grp").alias("other"), F.col("cls").alias("b"), F.col("n").alias("m"), F.col("alone").alias("b_alone")), "other")
    # What one of them has alone is no overlap.
    room = f"{percent} * (n + m) <= {100 + percent} * least(n - alone, m - b_alone)"
    pairs = inside.where(room).select(F.least("cls", "b").alias("a"), F.greatest("cls", "b").alias("b")).distinct()
    more = stored(_verified(stored(_possible(stored(pairs, "met"), sets, percent), "pairs"), sets, percent), "links")

    roots = components(likely.union(more)).select(F.col("node").alias("cls"), "root")
    named = classes.join(roots, "cls").select("root", "rep").groupBy("root").agg(F.min("rep").alias("component"))
    linked = classes.join(roots, "cls", "left").join(named, "root", "left")
    some = linked.where("copies > 1 or root is not null").select("cls", F.coalesce("component", "rep").alias("component"))
    out = members.join(some, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep(docs: DataFrame, **options) -> DataFrame:
    """One row of each component, that of the smallest doc_id (null only where all are), with its own columns.

    Here each (doc_id, text) is a document of its own: texts of one id are judged apart, those of null
    ids link too, and of rows that agree in both one is left, also where the text has no words.
    """
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", text_mark().alias("mark"))
    found = near(docs.select(row.alias("doc_id"), "text"), **options)
    verdict = found.select("doc_id.doc_id", "doc_id.mark", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    counted = stored(verdict.groupBy("doc_id", "mark", "kept").count().where("not kept or count > 1"), "verdicts")
    pair = ("doc_id", "mark")
    return rows_left(docs, counted.where("not kept").select(*pair), counted.where("kept").select(*pair))
