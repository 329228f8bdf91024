"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_mark, words_sql

#: Production parameters: permitted lengths in tokens, what a sequence costs besides its tokens, and
#: the pieces that one packing task gets on average.
LENGTHS, OVERHEAD, SHARD = (256, 512, 1024, 2048, 4096), 16, 20_000

#: Attention makes a token dearer in a long sequence: its cost doubles after so many tokens.
DOUBLING = 16_384


def cost(length: int, overhead: int = OVERHEAD) -> float:
    return overhead + length * (1 + length / DOUBLING)


class _Stock:
    """The sizes still to be packed, as counts of each distinct size."""

    def __init__(self, sizes: Sequence[int]) -> None:
        self.count: dict[int, int] = {}
        for s in sizes:
            self.count[s] = self.count.get(s, 0) + 1
        self.sizes = sorted(self.count)

    def take(self, size: int) -> None:
        self.count[size] -= 1
        if not self.count[size]:
            del self.count[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def fill(self, room: int) -> int:
        """The tokens that largest-first filling would put into ``room``."""
        got, at = 0, bisect_right(self.sizes, room) - 1
        while at >= 0:
            size = self.sizes[at]
            n = min(self.count[size], (room - got) // size)
            got += n * size
            at = min(at - 1, bisect_right(self.sizes, room - got) - 1)
        return got


def pack_sizes(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD) -> list[tuple[int, int]]:
    """(bin, offset) of each size; sizes come largest first and fit the largest length.

    A size goes into the open bin that it fills best. Where none has room, all permitted lengths
    that hold it are tried against what is still to be packed, and that of the least cost a filled
    token is opened; of equals the shortest.
    """
    stock = _Stock(sizes)
    rooms: list[tuple[int, int]] = []  # (room left, bin), sorted
    used: list[int] = []
    placed = []
    for size in sizes:
        stock.take(size)
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            fits = [c for c in lengths if c >= size]
            room = min(fits, key=lambda c: (cost(c, overhead) / (size + stock.fill(c - size)), c))
            b = len(used)
            used.append(0)
        placed.append((b, used[b]))
        used[b] += size
        if room > size:
            insort(rooms, (room - size, b))
    return placed


def pieces(docs: DataFrame, most: int, tokens: str | None = None) -> DataFrame:
    """(doc_id, mark, n, copy, piece, start, n_tokens): each document cut where it is longer than ``most`` tokens.

    Tokens are words, or what the column ``tokens`` counts. A document without any has no pieces. ``mark`` stands for the text; rows that share doc_id and text
    are told apart by ``copy``, a count from 0.
    """
    sized = docs.select("doc_id", text_mark().alias("mark"), F.expr(f"cast(size({words_sql()}) as bigint)" if tokens is None else f"cast(`{tokens}` as bigint)").alias("n")).where("n > 0")
    # One row for each id and text keeps repeated rows whole without a window.
    counted = sized.groupBy("doc_id", "mark", "n").count().select("doc_id", "mark", "n", F.explode(F.expr("sequence(0L, count - 1)")).alias("copy"))
    cut = counted.select("doc_id", "mark", "n", "copy", F.explode(F.expr(f"sequence(0L, (n - 1) div {most})")).alias("piece"))
    return cut.select("doc_id", "mark", "n", "copy", "piece", F.expr(f"piece * {most}").alias("start"), F.expr(f"least({most}, n - piece * {most})").alias("n_tokens"))


def pack(docs: DataFrame, lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD, shard: int = SHARD, tokens: str | None = None) -> DataFrame:
    """A row per piece: doc_id, mark, copy, piece, start, n_tokens, bin_id, bin_length, bin_tokens, offset.

    Tokens are words, or the column ``tokens`` of ``docs`` says how many a document has (those of ``tokenfile.read``
    can be joined to it; a null count is as none). Pieces (tokens ``start`` to ``start + n_tokens`` of a document; only a document over the largest
    length has more than one) are dealt to shards by a hash of their own key, so no source or group
    of copies meets in one; ``shard`` bounds the mean. Each shard is packed by best fit, largest
    first, and at last each bin is cut down to the shortest permitted length that holds its pieces.
    The result depends on the rows alone, not on how they are partitioned. Null and blank texts have
    no row; ids stay as they are, of whatever type, and null ids are packed like others; an empty table
    gives none; other columns are unread.
    """
    lengths = sorted(set(lengths))
    if not lengths or lengths[0] < 1:
        raise ValueError("lengths must be positive")
    cut = pieces(docs, lengths[-1], tokens)
    # From row counts only: words per piece are bounded, and a document has one piece at least.
    n = max(1, -(-docs.count() // shard))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "mark", "n", "copy", "piece")
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
    names = ["doc_id", "mark", "copy", "piece", "start", "n_tokens"]
    order = [("n_tokens", "descending"), *[(c, "ascending") for c in ("doc_id", "mark", "n", "copy", "piece")]]

    def packed(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, sort_keys=order))
        sizes = rows.column("n_tokens").to_pylist()
        placed = pack_sizes(sizes, lengths, overhead)
        held: dict[int, int] = {}
        for (b, _), size in zip(placed, sizes, strict=True):
            held[b] = held.get(b, 0) + size
        home = rows.column("shard")[0].as_py()
        out = rows.select(names)
        out = out.append_column("bin_id", pa.array([f"{home}-{b}" for b, _ in placed], pa.string()))
        out = out.append_column("bin_length", pa.array([lengths[bisect_left(lengths, held[b])] for b, _ in placed], pa.int32()))
        out = out.append_column("bin_tokens", pa.array([held[b] for b, _ in placed], pa.int64()))
        return out.append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    kind = dict(cut.dtypes)["doc_id"]
    schema = f"doc_id {kind}, mark bigint, copy bigint, piece bigint, start bigint, n_tokens bigint, bin_id string, bin_length int, bin_tokens bigint, offset bigint"
    return dealt.groupBy("shard").applyInArrow(packed, schema)


def with_texts(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """``packed`` with ``text``, each piece's own part of its document: what a sequence is made of.

    The pieces of a document put together give its text, but for white space after its last word.
    Texts are shuffled once, by id and mark, each once however many rows repeat it.
    """
    once = docs.select(F.col("doc_id").alias("__id"), text_mark().alias("__mark"), "text")
    once = once.groupBy("__id", "__mark").agg(F.first("text").alias("text"))
    joined = packed.join(once, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")))
    blank = r"\\x20\\x09-\\x0D"
    words = f"slice(regexp_extract_all(text, '[{blank}]*[^{blank}]+', 0), cast(start as int) + 1, cast(n_tokens as int))"
    whole = f"if(size({words_sql()}) = n_tokens, text, array_join({words}, ''))"
    return joined.select(*packed.columns, F.expr(whole).alias("text"))


def sequences(packed: DataFrame, ids: DataFrame) -> DataFrame:
    """(bin_id, bin_length, ids, starts): the token ids of each bin in order, and where its pieces begin, for training.

    ``packed`` is by token counts, and ``ids`` has each document's token ids: (doc_id, ids), as ``tokenfile.documents``, or
    (doc_id, mark, ids) with the mark of its text (``common.text_mark``). Null ids are one id. Several rows of an id need the mark to be told
    apart; without it they are an error. A bin has at most the largest length's tokens, so neither its group nor its row grows with the data.
    """
    marked = "mark" in ids.columns
    by = ["doc_id", "mark"] if marked else ["doc_id"]
    once = ids.groupBy(*by).agg(F.count("*").alias("n"), F.first("ids").alias("ids"))
    if not marked and not (once := stored(once, "ids")).where("n > 1").isEmpty():
        raise ValueError("a doc_id has several token lists: give the mark of each text")
    part = F.expr("slice(ids, cast(start as int) + 1, cast(n_tokens as int))")
    same = F.col("doc_id").eqNullSafe(F.col("__id"))
    same = same & (F.col("mark") == F.col("__mark")) if marked else same
    joined = packed.select("bin_id", "bin_length", "doc_id", "mark", "offset", "start", "n_tokens").join(once.select(*[F.col(c).alias("__id" if c == "doc_id" else "__mark") for c in by], "ids"), same)
    cut = joined.select("bin_id", "bin_length", F.struct("offset", part.alias("ids")).alias("p"))
    held = cut.groupBy("bin_id", "bin_length").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return held.select("bin_id", "bin_length", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"), F.transform("p", lambda x: x["offset"]).alias("starts"))


def bins(packed: DataFrame) -> DataFrame:
    """A row per bin: bin_id, bin_length, bin_tokens and its pieces in order, with their texts if ``packed`` has them."""
    own = [c for c in ("text",) if c in packed.columns]
    piece = F.struct("offset", "doc_id", "mark", "copy", "piece", "start", "n_tokens", *own)
    return packed.groupBy("bin_id", "bin_length", "bin_tokens").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))

