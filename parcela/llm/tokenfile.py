"""Token ids in Re-Pair compressed blocks that can be decoded from any place."""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, shared_dir

#: A block: this mark, then six little-endian 32-bit numbers (documents, tokens, symbols, rules,
#: first nonterminal, bytes of a symbol), then the arrays that ``encode_block`` lists.
MAGIC = b"RPR1"
#: Stands for a null id in a block; such documents come first.
NO_ID = -(2**63)
#: A block is closed at so many tokens; a longer document has one of its own. A longer block has a
#: better grammar and needs more memory: README gives figures.
BLOCK = 1 << 19
#: Places and symbols that fit one sorted number; longer blocks are sorted by a slower way.
_PLACE, _SYMBOL = 20, 22


def _late_in_runs(s: np.ndarray) -> np.ndarray:
    """The places of pairs of equal symbols that overlap the pair before: every second one of a run."""
    run = np.flatnonzero(s[1:] == s[:-1])
    if not len(run):
        return run
    begins = np.concatenate(([True], run[1:] != run[:-1] + 1))
    start = np.maximum.accumulate(np.where(begins, run, 0))
    return run[(run - start) % 2 == 1]


def _sorted_pairs(s: np.ndarray, at: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The places ``at`` in the order of their pairs, then of their own, and the pairs in that order."""
    if len(s) <= 1 << _PLACE and symbols < 1 << _SYMBOL:
        z = s[at].astype(np.uint64) << np.uint64(_SYMBOL + _PLACE)
        z |= s[at + 1].astype(np.uint64) << np.uint64(_PLACE)
        z |= at.astype(np.uint64)
        z.sort()
        return (z & np.uint64((1 << _PLACE) - 1)).astype(np.int32), z >> np.uint64(_PLACE)
    key = s[at].astype(np.uint64) << np.uint64(32) | s[at + 1]
    order = np.argsort(key, kind="stable")
    return at[order], key[order]


def repair(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbols, rules, first nonterminal): nonterminal ``first + k`` stands for the two symbols of rule k.

    Pairs are replaced until none occurs twice without overlap. In each round a place is replaced if
    its pair is more frequent than those of both neighbouring places (of equal counts one goes first),
    so that the most frequent pair is always replaced everywhere, and with it all that do not touch a
    more frequent one. Counts are exact. A pair that is left with one place in a round waits for the next. Only pairs that
    occurred twice or touch a new symbol are counted again: no other can become frequent.
    """
    s = ids.astype(np.uint32)
    first = int(s.max()) + 1 if len(s) else 0
    rules, n_rules = [np.empty((0, 2), np.uint32)], 0
    at = np.arange(max(0, len(s) - 1), dtype=np.int32)
    while len(at):
        late = _late_in_runs(s)
        if len(late):
            early = np.ones(len(s), bool)
            early[late] = False
            at = at[early[at]]
        at, key = _sorted_pairs(s, at, first + n_rules)
        edge = np.ones(len(key) + 1, bool)
        np.not_equal(key[1:], key[:-1], out=edge[1:-1])
        count = np.diff(np.flatnonzero(edge))
        many = count > 1
        if not many.any():
            break
        at, count = at[np.repeat(many, count)], count[many]
        head = at[np.cumsum(count) - count]
        by_rank = np.argsort(count, kind="stable")
        rank = np.empty(len(count), np.int32)
        rank[by_rank] = np.arange(1, len(count) + 1, dtype=np.int32)
        # The rank of the pair at place i is weight[i + 1]; 0 where there is none to replace.
        weight = np.zeros(len(s) + 1, np.int32)
        weight[at + 1] = np.repeat(rank, count)
        here = weight[1:]
        best = here > weight[:-1]
        best[:-1] &= here[:-1] > here[1:]
        taken = np.flatnonzero(best)
        made = np.bincount(here[taken], minlength=len(count) + 1) > 1
        taken = taken[made[here[taken]]]
        number = (np.cumsum(made) - 1).astype(np.uint32)
        shown = head[by_rank[made[1:]]]
        rules.append(np.stack((s[shown], s[shown + 1]), 1))
        new = np.uint32(first + n_rules) + number[here[taken]]
        s[taken] = new
        n_rules += len(shown)
        # To be looked at again: frequent pairs that stay, those that overlap, and what touches a new symbol.
        open_places = here > 0
        for some in (late, taken, taken[taken > 0] - 1):
            open_places[some] = True
        keep = np.ones(len(s), bool)
        keep[taken + 1] = False
        s = s[keep]
        at = np.flatnonzero(open_places[keep][:-1])
    return s, np.concatenate(rules), first


def _lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each rule expands to; a rule uses only terminals and earlier rules."""
    out = np.ones(len(rules), np.int64)
    done = 0
    while done < len(rules):
        # The longest stretch of rules that use none of one another.
        inner = rules[done:].astype(np.int64).max(1) - first
        stop = np.flatnonzero(inner >= done)
        end = done + (int(stop[0]) if len(stop) else len(inner))
        part = rules[done:end].astype(np.int64) - first
        out[done:end] = np.where(part >= 0, out[np.maximum(part, 0)], 1).sum(1)
        done = end
    return out


def _sizes(lengths: np.ndarray, first: int) -> np.ndarray:
    """How many ids each symbol stands for, terminals first."""
    return np.concatenate((np.ones(first, np.int32), lengths.astype(np.int32)))


def expand(symbols: np.ndarray, rules: np.ndarray, first: int, lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids that ``symbols`` stand for. Each id is written once, to the place that the lengths give it."""
    sizes = _sizes(_lengths(rules, first) if lengths is None else lengths, first)
    size = sizes[symbols]
    ends = np.cumsum(size, dtype=np.int64)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    s, place = symbols, ends - size
    left, right = np.ascontiguousarray(rules[:, 0]), np.ascontiguousarray(rules[:, 1])
    while len(s):
        inner = np.flatnonzero(s >= first)
        # Nonterminals are written as well, and their first id over them later.
        out[place] = s
        rule, place = s[inner] - np.uint32(first), place[inner]
        a = left[rule]
        s = np.concatenate((a, right[rule]))
        place = np.concatenate((place, place + sizes[a]))
    return out


def encode_block(doc_ids: list[int], docs: list[np.ndarray]) -> bytes:
    """A block of whole documents.

    After the head: doc ids (64 bits), each document's token count, rule pairs, expansion lengths of
    the rules, all 32 bits, then the symbols in 2 or 4 bytes each.
    """
    ids = np.concatenate(docs) if docs else np.empty(0, np.uint32)
    symbols, rules, first = repair(ids)
    wide = 2 if first + len(rules) <= 1 << 16 else 4
    head = np.array([len(docs), len(ids), len(symbols), len(rules), first, wide], "<u4")
    counts = np.array([len(d) for d in docs], "<u4")
    parts = [np.array(doc_ids, "<i8"), counts, rules.astype("<u4"), _lengths(rules, first).astype("<u4"), symbols.astype(f"<u{wide}")]
    return MAGIC + head.tobytes() + b"".join(p.tobytes() for p in parts)


class Block:
    """A block as read back."""

    def __init__(self, blob: bytes) -> None:
        if blob[:4] != MAGIC:
            raise ValueError("not a token block")
        n, self.n_tokens, m, r, self.first, wide = (int(x) for x in np.frombuffer(blob, "<u4", 6, 4))
        at = 28
        self.doc_ids = np.frombuffer(blob, "<i8", n, at)
        self.counts = np.frombuffer(blob, "<u4", n, at := at + 8 * n)
        self.rules = np.frombuffer(blob, "<u4", 2 * r, at := at + 4 * n).reshape(r, 2)
        self.lengths = np.frombuffer(blob, "<u4", r, at := at + 8 * r)
        self.symbols = np.frombuffer(blob, f"<u{wide}", m, at + 4 * r).astype(np.uint32)

    def all(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.first, self.lengths)

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop``; only the symbols that cover them are expanded."""
        ends = np.cumsum(_sizes(self.lengths, self.first)[self.symbols], dtype=np.int64)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        begin = int(ends[a - 1]) if a else 0
        return expand(self.symbols[a:b], self.rules, self.first, self.lengths)[start - begin : stop - begin]

    def document(self, k: int) -> np.ndarray:
        """The ids of the block's ``k``-th document."""
        start = int(self.counts[:k].sum())
        return self.slice(start, start + int(self.counts[k]))


def _kept_in_worker(name: str, make):
    """What ``make`` gives, kept for the later tasks of the same Python worker."""
    state = sys.modules.setdefault("parcela_worker_state", types.ModuleType("parcela_worker_state"))
    if not hasattr(state, name):
        setattr(state, name, make())
    return getattr(state, name)


class _Pieces:
    """Pieces that were met before, with their ids, in a few flat arrays of bounded size."""

    #: At most so many pieces, of so many bytes each.
    MOST, LONGEST = 1_000_000, 32

    def __init__(self) -> None:
        self.text = pa.array([], pa.large_string())
        self.size = np.empty(0, np.int32)
        self.flat = np.empty(0, np.uint32)

    def add(self, text: pa.Array, size: np.ndarray, flat: np.ndarray) -> None:
        short = pc.less_equal(pc.binary_length(text), self.LONGEST).to_numpy(zero_copy_only=False)
        short &= np.cumsum(short) <= self.MOST - len(self.text)
        if short.any():
            self.text = pa.concat_arrays([self.text, text.filter(pa.array(short))])
            self.size = np.concatenate((self.size, size[short]))
            self.flat = np.concatenate((self.flat, flat[np.repeat(short, size)]))


#: Letters whose lower case is one letter, whatever stands around them; a dotted capital I is none.
_PLAIN = "^[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+$"


class Encoder:
    """A tokenizers file applied to whole texts, with the end id after each.

    Where the file lower-cases, drops white space and cuts at it, as ``word_bpe_49k.json`` does, blanks
    and line feeds never lie within a token, and a letter never joins with the comma or full stop after
    it. A text's ids are then those of its pieces in turn, each distinct piece goes through the library
    once, and frequent ones are remembered. With any other file, and for texts that hold one of the
    file's added tokens, the library gets whole texts.
    """

    def __init__(self, path: str, end: int) -> None:
        import tokenizers

        self.tokenizer = _kept_in_worker(f"tokenizer:{path}", lambda: tokenizers.Tokenizer.from_file(path))
        self.known: _Pieces = _kept_in_worker(f"pieces:{path}", _Pieces)
        self.end = end
        added = self.tokenizer.get_added_tokens_decoder()
        names = [t.content for t in added.values()]
        self.added = "(?i)" + "|".join(map(re.escape, names))
        self.hint = os.path.commonprefix([n.lower() for n in names] + [n.upper() for n in names])
        rules = json.loads(self.tokenizer.to_str())
        self.by_piece = bool(added) and _cuts_at_blanks(rules)
        if self.by_piece:
            # Stands between pieces where their number of words is unknown.
            self.between, self.gap = next((i, t.content) for i, t in added.items())
            ends = [i for word, i in self.tokenizer.get_vocab().items() if word.endswith("</w>")]
            self.last = np.zeros(max(ends) + 1 + len(added), bool)
            self.last[ends] = True
            # What is plain lower case already goes to the file's model without the file's patterns.
            self.words = tokenizers.Tokenizer(self.tokenizer.model)
            cuts = tokenizers.pre_tokenizers
            self.words.pre_tokenizer = cuts.Sequence([cuts.WhitespaceSplit(), cuts.ByteLevel(add_prefix_space=False, use_regex=False)])

    def _library(self, text: str, tokenizer=None) -> np.ndarray:
        return np.array((tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and ids of any pieces."""
        ids = self._library(self.gap.join(pieces))
        gaps = np.flatnonzero(ids == self.between)
        return np.diff(np.concatenate(([-1], gaps, [len(ids)]))) - 1, np.delete(ids, gaps)

    def _letters(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and ids of pieces of plain letters: each is one word, whose last token says so."""
        ids = self._library(" ".join(pieces), self.words)
        ends = np.flatnonzero(self.last[ids])
        if len(ends) != len(pieces):
            return self._apart(pieces)
        return np.diff(np.concatenate(([-1], ends))), ids

    def _new(self, pieces: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """The places of ``pieces``, those of plain letters first, and in this order the pieces, their token counts and ids."""
        plain = pc.match_substring_regex(pieces, _PLAIN)
        sizes, flats = [np.empty(0, np.int32)], [np.empty(0, np.uint32)]
        both = [(self._letters, pieces.filter(plain)), (self._apart, pieces.filter(pc.invert(plain)))]
        for way, some in ((self._letters, pc.utf8_lower(both[0][1])), both[1]):
            for i in range(0, len(some), 2048):
                size, flat = way(some.slice(i, 2048).to_pylist())
                sizes.append(size.astype(np.int32))
                flats.append(flat)
        letters = plain.to_numpy(zero_copy_only=False)
        order = np.concatenate((np.flatnonzero(letters), np.flatnonzero(~letters)))
        return order, pa.concat_arrays([x for _, x in both]), np.concatenate(sizes), np.concatenate(flats)

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, null counting as empty, with the end id."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pa.array([True] * len(texts), pa.bool_())
        if self.by_piece:
            whole = pc.match_substring(texts, self.hint)
            if pc.any(whole).as_py():
                whole = pc.match_substring_regex(texts, self.added)
        rows = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        found = self._by_piece(pc.if_else(whole, "", texts)) if self.by_piece else [np.empty(0, np.uint32)] * len(texts)
        for i in rows.tolist():
            found[i] = np.append(self._library(texts[i].as_py()), np.uint32(self.end))
        return found

    def _by_piece(self, texts: pa.Array) -> list[np.ndarray]:
        # In this order: ``ascii_lower`` needs an array that is no slice of another.
        clean = pc.ascii_lower(pc.replace_substring(texts, "\n", " "))
        cut = pc.split_pattern(pc.replace_substring_regex(clean, "([a-z])([,.]) ", r"\1 \2 "), " ")
        pieces = cut.flatten().dictionary_encode()
        known = self.known
        row = pc.index_in(pieces.dictionary, value_set=known.text)
        unknown = np.flatnonzero(row.is_null().to_numpy(zero_copy_only=False))
        order, new, new_size, new_flat = self._new(pieces.dictionary.take(pa.array(unknown)))
        size = np.concatenate((known.size, new_size, np.ones(1, np.int32)))
        flat = np.concatenate((known.flat, new_flat, np.array([self.end], np.uint32)))
        start = (np.cumsum(size, dtype=np.int64) - size).astype(np.int32)
        row = row.fill_null(0).to_numpy(zero_copy_only=False).copy()
        row[unknown[order]] = len(known.size) + np.arange(len(order))
        known.add(new, new_size, new_flat)

        # ``at`` has the row of each piece, and that of the end id after each text.
        ends = np.asarray(cut.offsets)[1:] - cut.offsets[0].as_py()
        at = np.insert(row[np.asarray(pieces.indices)], ends, len(size) - 1)
        n = size[at]
        upto = np.cumsum(n, dtype=np.int64)
        # Steps of 1 within a piece, and from the end of a piece to the start of the next.
        step = np.ones(int(upto[-1]) if len(upto) else 0, np.int32)
        some = n > 0
        begin, long = start[at[some]], n[some]
        step[(upto - n)[some]] = begin - np.concatenate(([0], (begin + long - 1)[:-1]))
        tokens = flat[np.cumsum(step, dtype=np.int32)]
        return np.split(tokens, upto[ends + np.arange(len(ends))][:-1]) if len(ends) else []


def _cuts_at_blanks(rules: dict) -> bool:
    """Whether a tokenizers file lower-cases, and cuts words from white space and from what is no letter."""
    normal = [r["type"] for r in (rules["normalizer"] or {}).get("normalizers", [])]
    cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    cut = cuts[0].get("pattern", {}).get("Regex", "")
    words = cut.split("|")[-3:] == [r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"] and cuts[0]["behavior"] == "Removed"
    return words and normal == ["NFC", "Replace", "Lowercase"] and rules["model"].get("end_of_word_suffix") == "</w>"


def _slices(batches: Iterator[pa.RecordBatch], most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of text, or of one row that is longer."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
        begin = 0
        while begin < b.num_rows:
            before = int(size[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, before + most, "right")))
            yield b.slice(begin, end - begin)
            begin = end


def write(docs: DataFrame, tokenizer_path: str, end: int = 2, path: str | None = None, block: int = BLOCK) -> str:
    """Encodes all texts and writes them as blocks in ascending doc_id order; returns the path.

    A file row: part (the range of doc_ids), block, part_start (tokens of the part before it),
    n_tokens, first_id and last_id (null for a null id), payload. Null texts are empty: they have the
    end id alone; null ids come first; rows of equal ids go by a hash of the text, so that many of them can
    lie in several ranges, then by the text. Documents are never cut. Ids must be whole numbers.
    Each task writes the blocks of one range through Spark's commit, so a lost executor's work is
    done again and never counted twice. An empty table has no block; other columns are unread.
    """
    if dict(docs.dtypes)["doc_id"] not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError("doc_id must be a whole number")
    spark = docs.sparkSession
    shared_dir(spark)
    path = path or scratch(spark, "tokens")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number, before = Encoder(tokenizer_path, end), 0, 0
        ids: list[int] = []
        held: list[np.ndarray] = []
        size, part = 0, None

        def close() -> pa.RecordBatch:
            nonlocal number, before, ids, held, size
            known = [None if x == NO_ID else x for x in (ids[0], ids[-1])]
            fields = [(part, pa.int32()), (number, pa.int32()), (before, pa.int64()), (size, pa.int64()), (known[0], pa.int64()), (known[1], pa.int64()), (encode_block(ids, held), pa.binary())]
            number, before, ids, held, size = number + 1, before + size, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in fields], ["part", "block", "part_start", "n_tokens", "first_id", "last_id", "payload"])

        for piece in _slices(batches):
            for p, doc, found in zip(piece.column("part").to_pylist(), piece.column("doc_id").to_pylist(), encoder(piece.column("text")), strict=True):
                if ids and (p != part or size + len(found) > block):
                    yield close()
                if p != part:
                    part, number, before = p, 0, 0
                ids.append(NO_ID if doc is None else doc)
                held.append(found)
                size += len(found)
        if ids:
            yield close()

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    ordered = keyed.repartitionByRange(n, "doc_id", "mark").sortWithinPartitions("doc_id", "mark", "text")
    placed = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))
    out = placed.mapInArrow(blocks, "part int, block int, part_start bigint, n_tokens bigint, first_id bigint, last_id bigint, payload binary")
    out.write.parquet(path)
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` adds the sums of the parts before (one number a part, so the table is small) to the
    part's own running sum. A document is decoded from its block's grammar.
    """
    files = spark.read.parquet(path)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).selectExpr("part", "sum(n) over (order by part) - n as part_base")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, blob in zip(b.column("start").to_pylist(), b.column("payload").to_pylist(), strict=True):
                block = Block(blob)
                ids, counts = block.all(), block.counts.astype(np.int64)
                ends = np.cumsum(counts)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                doc_ids = pa.array(block.doc_ids, mask=block.doc_ids == NO_ID)
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(start + ends - counts), pa.array(counts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = files.join(F.broadcast(sums), "part").select((F.col("part_base") + F.col("part_start")).alias("start"), "payload")
    return placed.mapInArrow(decoded, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids (with the end id) of every document of the files, decoded block by block."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob in b.column("payload").to_pylist():
                block = Block(blob)
                ends = np.concatenate(([0], np.cumsum(block.counts.astype(np.int64)))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(block.all().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(block.doc_ids, mask=block.doc_ids == NO_ID), lists], ["doc_id", "ids"])

    return spark.read.parquet(path).select("payload").mapInArrow(decoded, "doc_id bigint, ids array<int>")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """The ids of a few documents, each decoded alone.

    Only blocks whose range of ids has a wanted one are read; the scan's statistics skip the others.
    Of rows with equal ids one is given.
    """
    wanted = sorted(set(doc_ids))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = set(wanted)
        for b in batches:
            for blob in b.column("payload").to_pylist():
                block = Block(blob)
                hit = [k for k, d in enumerate(block.doc_ids.tolist()) if d in own]
                yield pa.RecordBatch.from_arrays([pa.array([int(block.doc_ids[k]) for k in hit], pa.int64()), pa.array([block.document(k).tolist() for k in hit], pa.list_(pa.int64()))], ["doc_id", "ids"])

    if not wanted:
        return {}
    # A block that begins with null ids may hold others.
    begins = F.col("first_id").isNull() | (F.col("first_id") <= F.lit(wanted[-1]))
    near = spark.read.parquet(path).where(begins & (F.col("last_id") >= wanted[0]))
    held = F.array(*[F.lit(x) for x in wanted])
    inside = F.exists(held, lambda x: x.between(F.coalesce("first_id", F.lit(NO_ID)), F.col("last_id")))
    rows = near.where(inside).select("payload").mapInArrow(some, "doc_id bigint, ids array<bigint>").collect()
    return {r.doc_id: r.ids for r in rows}
