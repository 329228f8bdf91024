import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcela.llm import tokenfile

PATH = public_tokenizers.path("word_bpe_49k.json")
ids = st.lists(st.integers(0, 6), max_size=400)


@settings(max_examples=150, deadline=None)
@given(ids)
def test_grammar_round_trip(values):
    raw = np.array(values, np.uint32)
    s, rules, first = tokenfile.repair(raw)
    assert tokenfile.expand(s, rules, first).tolist() == values
    sizes = tokenfile._lengths(rules, first)
    assert sizes.tolist() == [len(tokenfile.expand(np.array([first + k], np.uint32), rules, first)) for k in range(len(rules))]
    # No pair is left that occurs twice without overlap.
    met = {}
    for i, pair in enumerate(zip(s.tolist(), s[1:].tolist(), strict=False)):
        assert i - met.setdefault(pair, i) < 2


def test_long_blocks_have_the_same_grammar(monkeypatch):
    raw = np.random.default_rng(1).integers(0, 9, 5000).astype(np.uint32)
    fast = tokenfile.repair(raw)
    monkeypatch.setattr(tokenfile, "_PLACE", 3)
    slow = tokenfile.repair(raw)
    assert all((a == b).all() for a, b in zip(fast[:2], slow[:2], strict=True))


@settings(max_examples=40, deadline=None)
@given(st.lists(ids, max_size=8), st.integers(0, 2**31))
def test_block_round_trip_and_random_access(docs, seed):
    arrays = [np.array(d, np.uint32) for d in docs]
    block = tokenfile.Block(tokenfile.encode_block(list(range(len(docs))), arrays))
    assert block.all().tolist() == [x for d in docs for x in d]
    for k, d in enumerate(docs):
        assert block.document(k).tolist() == d
    total = sum(map(len, docs))
    a, b = sorted(np.random.default_rng(seed).integers(0, total + 1, 2))
    if a < b:
        assert block.slice(a, b).tolist() == block.all()[a:b].tolist()


def test_repeats_shrink():
    raw = np.tile(np.arange(50, dtype=np.uint32), 400)
    s, rules, first = tokenfile.repair(raw)
    assert len(s) + 2 * len(rules) < 200 and tokenfile.expand(s, rules, first).tolist() == raw.tolist()


def _same(encoder, library, texts):
    got = encoder(pa.array(texts, pa.string()))
    want = library.encode_batch(texts, add_special_tokens=False)
    return [t for t, a, e in zip(texts, got, want, strict=True) if a.tolist() != [*e.ids, 2]]


def test_ids_are_the_library_s_for_all_letters():
    """Every letter and mark of the first plane in words, alone, before a comma and a full stop, in both cases."""
    encoder, library = tokenfile.Encoder(PATH, 2), Tokenizer.from_file(PATH)
    odd = [chr(i) for i in range(33, 0x3200) if chr(i).isprintable()] + list("İıſKÅ\u0307\u0301ﬁßẞΣσς日本한\u1100\u1161𝐀😀")
    texts = [f"{c} a{c}b, {c}. A{c}. {c}{c}, x{c} {c}I\u0307." for c in odd]
    assert _same(encoder, library, texts) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("abzABZIİıßéÉïΣ\u0301\u0307.,'!#0<|> \n\t\r\u00a0\u2003s t") | st.characters(exclude_categories=["Cs"]), max_size=60), max_size=6))
def test_ids_are_the_library_s_for_any_text(texts):
    texts += ["<|endoftext|> a <|ENDOFTEXT|>.", "x<|startoftext|>y, It's I'LL"]
    assert _same(tokenfile.Encoder(PATH, 2), Tokenizer.from_file(PATH), texts) == []


def test_other_files_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = tokenfile.Encoder(path, 2)
    assert not encoder.by_piece and _same(encoder, Tokenizer.from_file(path), ["A b,  c.\n", "", " İ."]) == []


def test_equal_ids_have_one_order(spark):
    rows = [(7, t) for t in ("b", None, "a", "", "a", "c d")] + [(None, "z"), (None, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    runs = [sorted(map(tuple, tokenfile.read(spark, tokenfile.write(docs.repartition(n), PATH)).collect()), key=lambda r: r[1]) for n in (1, 3)]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)
    with pytest.raises(ValueError):
        tokenfile.write(docs.withColumn("doc_id", F.lit("x")), PATH)


def test_lookup_skips_blocks(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "concat('word ', id) as text")
    path = tokenfile.write(docs, PATH, block=50)
    blocks = spark.read.parquet(path).orderBy("first_id").collect()
    assert len(blocks) > 20 and all(a.last_id < b.first_id for a, b in zip(blocks, blocks[1:], strict=False))
    t = Tokenizer.from_file(PATH)
    assert tokenfile.lookup(spark, path, [3, 399, 1000]) == {k: [*t.encode(f"word {k}", add_special_tokens=False).ids, 2] for k in (3, 399)}
    assert tokenfile.lookup(spark, path, []) == {}


def test_files_match_the_tokenizer(spark, odd, none):
    rows = odd.select("doc_id", "text").collect()
    extra = spark.createDataFrame([(200, "x <|endoftext|> y don't  e\u0301\u00a0\u2003z\r\n\tÉ\u0301 İ"), (201, "x\u0301 \u0301y")], "doc_id bigint, text string")
    docs = odd.select("doc_id", "text").unionByName(extra)
    rows += extra.collect()
    path = tokenfile.write(docs, PATH, block=5000)
    out = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokenfile.read(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in out] == sorted((r.doc_id for r in rows), key=lambda i: -1 if i is None else i)
    assert len(out) == len(rows)
    t = Tokenizer.from_file(PATH)
    whole = {(r.doc_id, r.text): np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4") for r in rows}
    start = 0
    for doc, at, n, crc in out:
        assert at == start
        assert (n, crc) in {(len(x), zlib.crc32(x.tobytes())) for (d, _), x in whole.items() if d == doc}
        start += n
    assert start == sum(len(whole[r.doc_id, r.text]) for r in rows)
    assert tokenfile.lookup(spark, path, [5, 200]) == {k: whole[k, next(r.text for r in rows if r.doc_id == k)].tolist() for k in (5, 200)}
    assert spark.read.parquet(path).agg(F.max("block")).first()[0] > 0
    assert tokenfile.read(spark, tokenfile.write(none, PATH)).count() == 0
