"""Repair of conversations: what is wrong with their rows, the cheapest edits that mend it, and the mended rows.

A conversation is mended when its role initials read ``(s?(ua)+)?``: perhaps a system row, then users and
assistants in turn. Its rows become a signature, a letter each; conversations of equal signatures need
equal edits, so each distinct signature is solved once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from .common import stored

#: What the edits cost. Keep costs nothing; a truncated row that is not deleted adds UNENDED.
REROLE, DELETE, INSERT, UNENDED = 3, 4, 3, 3
#: ASCII white space, as for words.
_BLANK = "\t\n\x0b\f\r "
#: Rows of a conversation whose letters are joined at once, so that no group is larger.
_PIECE = 4096
#: Letters up to this length are solved as one piece that other signatures may share.
_SHARED = 64
#: Distinct signatures, and their letters, that are sent to all tasks with their edits; beyond, they are joined by shuffle.
_MOST, _MOST_LETTERS = 100_000, 5_000_000

# States: nothing yet, after a system row, after a user, after an assistant. Inserting and changing roles
# lead from a state to the only row that may follow and is no system row.
_NEXT = (2, 2, 3, 2)
_KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_FAR = 1 << 60


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) in order, with what is wrong with each.

    Returns conv_id, turn, role, text, pos (from 1, by turn with null first, then by role and text), fault
    (blank, duplicate, truncated or null, the first that holds), letter, illegal (whether it may not follow the
    row before) and fresh (whether its turn is a number that the row before has not). Blank is a text of
    ASCII white space; a duplicate has role and text of an earlier row; truncated is a text whose last
    character that is no white space is none of ``.!?``. A null role or text counts as one space; rows of a null conv_id are one
    conversation. Rows that agree in all four columns stay apart. Other columns are unread. Letters are x for
    a row that must go, else the role's initial if it is s, u or a, or o; in capitals where truncated.
    """
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    ordered = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    ended = F.rtrim("text", F.lit(_BLANK))
    first = F.substring("role", 1, 1)
    before, turn_before = F.lag(first).over(ordered), F.lag("turn").over(ordered)
    placed = rows.select(
        "*",
        F.row_number().over(ordered).cast("bigint").alias("pos"),
        (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.coalesce(~F.concat(before, first).isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
        F.coalesce(F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(turn_before), F.lit(False)).alias("fresh"),
        # Long texts are told apart by their hash.
        F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256).alias("mark"),
    )
    same = Window.partitionBy("conv_id", "mark").orderBy("pos")
    found = placed.withColumn("again", F.row_number().over(same) > 1)
    fault = F.when(F.col("blank"), "blank").when(F.col("again"), "duplicate").when(F.col("truncated"), "truncated")
    kind = F.when(first.isin("s", "u", "a"), first).otherwise("o")
    letter = F.when(F.col("blank") | F.col("again"), "x").when(F.col("truncated"), F.upper(kind)).otherwise(kind)
    return found.select("conv_id", "turn", "role", "text", "pos", fault.alias("fault"), letter.alias("letter"), "illegal", "fresh")


def signatures(found: DataFrame) -> DataFrame:
    """A row per conversation of ``faults``: conv_id, signature, and the counts gaps, blank, duplicate, truncated, illegal.

    gaps are the numbers between the least and the greatest turn that no row has; null turns do not count.
    Letters are joined in pieces, so a long conversation is no large group of rows.
    """

    def joined(by: str, what: str):
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, what))), lambda x: x[what]), "")

    def count(which):
        return F.count_if(which).alias

    piece = ((F.col("pos") - 1) / _PIECE).cast("bigint").alias("piece")
    parts = found.groupBy("conv_id", piece).agg(
        joined("pos", "letter").alias("letters"),
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        count(F.col("fresh"))("turns"),
        count(F.col("illegal"))("illegal"),
        *[count(F.col("fault") == k)(k) for k in ("blank", "duplicate", "truncated")],
    )
    whole = parts.groupBy("conv_id").agg(
        joined("piece", "letters").alias("signature"),
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).cast("bigint").alias("gaps"),
        *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated", "illegal")],
    )
    return whole


def _choices(letter: str, state: int) -> list[tuple[str, int, int, bool]]:
    """The edits that a row of this letter allows: letter, cost, next state, and whether the row is done; by ASCII."""
    out = [("D", DELETE, state, True), ("I", INSERT, _NEXT[state], False)]
    if letter != "x":
        more = UNENDED * letter.isupper()
        if letter.lower() in _KEEP[state]:
            out.append(("K", more, _KEEP[state][letter.lower()], True))
        out.append(("R", REROLE + more, _NEXT[state], True))
    return out


class Solver:
    """Cheapest edits of signatures, the ASCII-least of equals. What it has found for short pieces it remembers.

    A signature's halves are solved apart: first what it costs to get from each state to each, then, from the
    costs of all that follows, which edits to take. So recursion is as deep as the logarithm of the length.
    """

    def __init__(self, remember: int = 100_000) -> None:
        self._costs = lru_cache(remember)(self._costs_of)
        self._trace = lru_cache(remember)(self._trace_of)

    def costs(self, letters: str) -> tuple[tuple[int, ...], ...]:
        """The least cost from each state before ``letters`` to each state after them."""
        return self._costs(letters) if len(letters) <= _SHARED else self._costs_of(letters)

    def _costs_of(self, letters: str) -> tuple[tuple[int, ...], ...]:
        if len(letters) > 1:
            half = len(letters) // 2
            one, two = self.costs(letters[:half]), self.costs(letters[half:])
            return tuple(tuple(min(a[k] + two[k][j] for k in range(4)) for j in range(4)) for a in one)
        out = []
        for start in range(4):
            row, state = [_FAR] * 4, start
            # A third insertion would come back to the state after the first.
            for inserted in range(3):
                for _, cost, to, done in _choices(letters, state):
                    if done:
                        row[to] = min(row[to], inserted * INSERT + cost)
                state = _NEXT[state]
            out.append(tuple(row))
        return tuple(out)

    def trace(self, letters: str, state: int, after: tuple[int, ...]) -> tuple[str, int]:
        """The edits of ``letters`` from ``state``, if from the states after them it costs ``after`` to the end; and the state reached."""
        least = min(after)
        after = tuple(a - least for a in after)
        return self._trace(letters, state, after) if len(letters) <= _SHARED else self._trace_of(letters, state, after)

    def _trace_of(self, letters: str, state: int, after: tuple[int, ...]) -> tuple[str, int]:
        if len(letters) > 1:
            half = len(letters) // 2
            middle = tuple(min(c + a for c, a in zip(row, after, strict=True)) for row in self.costs(letters[half:]))
            one, state = self.trace(letters[:half], state, middle)
            two, state = self.trace(letters[half:], state, after)
            return one + two, state
        table = self.costs(letters)

        def left(at: int) -> int:
            return min(c + a for c, a in zip(table[at], after, strict=True))

        edits = ""
        while True:
            # The first of the cheapest, as choices are in ASCII order and lead to different letters.
            edit, _, state, done = next(c for c in _choices(letters, state) if c[1] + (after[c[2]] if c[3] else left(c[2])) == left(state))
            edits += edit
            if done:
                return edits, state

    def solve(self, signature: str) -> tuple[int, str]:
        """The least cost and its edits, a letter each: Delete, Insert, Keep, Rerole."""
        end = (0, 2 * INSERT, INSERT, 0)
        if not signature:
            return 0, ""
        cost = min(c + e for c, e in zip(self.costs(signature)[0], end, strict=True))
        edits, state = self.trace(signature, 0, end)
        return cost, edits + "I" * (end[state] // INSERT)


def solved(found: DataFrame) -> DataFrame:
    """signature, cost and audit of each distinct signature of ``found``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver()
        for b in batches:
            done = [solver.solve(s) for s in b.column("signature").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("signature"), pa.array([c for c, _ in done], pa.int64()), pa.array([a for _, a in done], pa.string())], ["signature", "cost", "audit"])

    return found.select("signature").distinct().mapInArrow(each, "signature string, cost bigint, audit string")


def audits(found: DataFrame) -> DataFrame:
    """A row per conversation of ``faults``: what ``signatures`` gives, with cost and audit (the edits' letters in order).

    Edits that cost equally much give the ASCII-least audit, which settles the mended conversation.
    """
    conversations = stored(signatures(found), "signatures")
    cases = stored(solved(conversations), "audits")
    n, letters = cases.agg(F.count("*"), F.sum(F.length("audit"))).first()
    if n <= _MOST and (letters or 0) <= _MOST_LETTERS:
        cases = F.broadcast(cases)
    return conversations.join(cases, "signature")


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Events of rows that come sorted by conversation and pos, its audit first (pos 0).

    (conv_id, None, None) where a conversation begins, then (conv_id, role, text) for each mended row.
    """
    audit, place, out, odd = "", 0, 0, 0

    def inserted(conv) -> Iterator[tuple]:
        nonlocal place, out
        while place < len(audit) and audit[place] == "I":
            yield conv, ("user", "assistant")[(out + odd) % 2], ""
            place, out = place + 1, out + 1

    for b in batches:
        for conv, pos, role, text, edits in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            if pos == 0:
                # An odd number of rows has a system row first.
                audit, place, out, odd = edits, 0, 0, (len(edits) - edits.count("D")) % 2
                yield conv, None, None
            else:
                edit, place = audit[place], place + 1
                if edit != "D":
                    yield conv, role if edit == "K" else ("user", "assistant")[(out + odd) % 2], text
                    out += 1
            yield from inserted(conv)


def _in_order(found: DataFrame, audited: DataFrame) -> DataFrame:
    """Audits and rows of each conversation in a task of its own order; none is held whole."""
    none = F.lit(None).cast("string")
    heads = audited.select("conv_id", F.lit(0).cast("bigint").alias("pos"), none.alias("role"), none.alias("text"), "audit")
    both = heads.unionByName(found.select("conv_id", "pos", "role", "text", none.alias("audit")))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "pos")


def repaired(found: DataFrame, audited: DataFrame) -> DataFrame:
    """The mended rows: conv_id, pos (from 1), role and text. A conversation whose rows are all deleted has none."""
    schema = _schema(found, pos=LongType(), role=StringType(), text=StringType())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        pos = 0
        for conv, role, text in _replay(batches):
            pos = 0 if role is None else pos + 1
            if role is not None:
                yield conv, pos, role, text

    return _in_order(found, audited).mapInArrow(_batched(rows, schema), schema)


def digests(found: DataFrame, audited: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256: the SHA-256 of the mended rows as ``role:text``, joined by line feeds.

    Rows are hashed as they pass, so a conversation of any length takes no more memory than a batch and its audit.
    """
    schema = _schema(found, repaired_sha256=StringType())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, digest, gap = (), hashlib.sha256(), ""
        for conv, role, text in _replay(batches):
            if role is None:
                if now:
                    yield *now, digest.hexdigest()
                now, digest, gap = (conv,), hashlib.sha256(), ""
            else:
                digest.update(f"{gap}{role}:{text}".encode())
                gap = "\n"
        if now:
            yield *now, digest.hexdigest()

    return _in_order(found, audited).mapInArrow(_batched(rows, schema), schema)


def _schema(found: DataFrame, **columns: DataType) -> StructType:
    return StructType([StructField("conv_id", found.schema["conv_id"].dataType), *(StructField(n, t) for n, t in columns.items())])


def _batched(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], schema: StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of batches from one that yields tuples of ``schema``."""
    kinds = to_arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = rows(batches)
        while some := list(islice(found, 2000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds.types, strict=True)], schema=kinds)

    return each


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with faults put in by the CRC-32 of ``conv_id:turn``, modulo 20: for trying repairs on whole tables.

    0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it a user's. Nulls
    count as one space there, and in role and text.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    what = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("what")).where("what <> 0")
    what = what.withColumn("text", F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    what = what.withColumn("role", F.when(F.col("what") == 4, "user").otherwise(F.col("role")))
    return what.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("what") == 3, 2).otherwise(1)))).select("conv_id", "turn", "role", "text")


def audit(rows: DataFrame, original: DataFrame) -> DataFrame:
    """A row per conv_id of ``original``: counts, cost and audit of its rows in ``rows``, and the digest of the mended ones.

    One without rows has zeros, an empty audit and the hash of nothing.
    """
    found = stored(faults(rows), "faults")
    audited = stored(audits(found), "audited")
    both = audited.withColumnRenamed("conv_id", "c").join(digests(found, audited).withColumnRenamed("conv_id", "d"), F.col("c").eqNullSafe(F.col("d")))
    every = original.select("conv_id").distinct().join(both, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(k, F.lit(0)).cast("bigint").alias(k) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
