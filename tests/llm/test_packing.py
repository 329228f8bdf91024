import random
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcela.llm import packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=120))
def test_bins_hold_what_they_get(sizes):
    sizes = sorted(sizes, reverse=True)
    held = defaultdict(int)
    for (b, offset), size in zip(packing.pack_sizes(sizes, (16, 32, 64)), sizes, strict=True):
        assert offset == held[b]
        held[b] += size
    assert max(held.values()) <= 64 and sum(held.values()) == sum(sizes)


def test_best_fit_and_least_cost():
    # 10 goes into the bin that it fills best; a lone small piece opens the shortest length.
    assert packing.pack_sizes([54, 50, 14, 10], (64,)) == [(0, 0), (1, 0), (1, 50), (0, 54)]
    assert packing._Stock([5, 5, 9, 2]).fill(17) == 16
    assert packing.pack_sizes([3], (4, 64)) == [(0, 0)]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_every_word_is_packed_once(odd, odd_rows):
    lengths = (64, 256, 1024)
    out = packing.pack(odd, lengths, shard=10).collect()
    assert sum(r.n_tokens for r in out) == sum(words(r[1]) for r in odd_rows)
    held = defaultdict(list)
    for r in out:
        held[r.bin_id].append(r)
    for rows in held.values():
        used = sum(r.n_tokens for r in rows)
        assert {r.bin_tokens for r in rows} == {used}
        assert {r.bin_length for r in rows} == {min(x for x in lengths if x >= used)}
        spans = sorted((r.offset, r.offset + r.n_tokens) for r in rows)
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    long = sorted((r.start, r.n_tokens) for r in out if r.doc_id == 5)
    assert sum(n for _, n in long) == 30_000 and all(n == 1024 for _, n in long[:-1])
    assert len([r for r in out if r.doc_id == 100]) == 3


def test_partitions_do_not_matter(odd, none):
    a = sorted(map(str, packing.pack(odd, shard=8).collect()))
    assert a == sorted(map(str, packing.pack(odd.repartition(9), shard=8).collect()))
    assert packing.pack(none).count() == 0
    assert packing.bins(packing.pack(odd)).agg({"bin_tokens": "sum"}).first()[0] > 0


def test_fill_beats_one_length():
    random.seed(1)
    sizes = sorted((min(4095, int(random.lognormvariate(5.5, 1))) + 1 for _ in range(3000)), reverse=True)
    used = defaultdict(int)
    for (b, _), s in zip(packing.pack_sizes(sizes), sizes, strict=True):
        used[b] += s
    cut = sum(min(x for x in packing.LENGTHS if x >= u) for u in used.values())
    assert sum(sizes) / cut > 0.97


def plain(sizes, lengths, overhead):
    """The same rule with lists and loops alone."""
    bins, out = [], []
    for i, size in enumerate(sizes):
        open_bins = [(cap - sum(held), b) for b, (cap, held) in enumerate(bins) if cap - sum(held) >= size]
        if open_bins:
            b = min(open_bins)[1]
        else:
            def price(c, size=size, rest=tuple(sizes[i + 1 :])):
                room = c - size
                for s in rest:  # largest first
                    if s <= room:
                        room -= s
                return (packing.cost(c, overhead) / (c - room), c)

            b = len(bins)
            bins.append((min((c for c in lengths if c >= size), key=price), []))
        out.append((b, sum(bins[b][1])))
        bins[b][1].append(size)
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60), st.sampled_from([(64,), (16, 64), (8, 16, 32, 64)]), st.sampled_from([0, 16]))
def test_against_brute_force(sizes, lengths, overhead):
    sizes = sorted(sizes, reverse=True)
    assert packing.pack_sizes(sizes, lengths, overhead) == plain(sizes, lengths, overhead)


def test_whole_result_against_brute_force(odd, odd_rows):
    """All rows in one shard: the sizes of pieces, bins and offsets are those of the plain rule."""
    lengths = (64, 256, 1024)
    sizes = sorted((n for r in odd_rows for k in [words(r[1])] for n in [*[1024] * (k // 1024), k % 1024] if n), reverse=True)
    placed = plain(sizes, lengths, packing.OVERHEAD)
    used = defaultdict(int)
    for (b, _), s in zip(placed, sizes, strict=True):
        used[b] += s
    want = sorted((s, f"0-{b}", o, used[b], min(x for x in lengths if x >= used[b])) for (b, o), s in zip(placed, sizes, strict=True))
    out = packing.pack(odd, lengths).collect()
    assert sorted((r.n_tokens, r.bin_id, r.offset, r.bin_tokens, r.bin_length) for r in out) == want


def test_ids_stay_as_they_are(spark):
    ids = [2**60 + 1, 2**60 + 3, None, -5]
    docs = spark.createDataFrame([(i, f"a b {i}") for i in ids], "doc_id bigint, text string")
    assert sorted((r.doc_id for r in packing.pack(docs).collect()), key=str) == sorted(ids, key=str)
    named = spark.createDataFrame([("x", "a b"), (None, "c")], "doc_id string, text string")
    assert {r.doc_id for r in packing.pack(named).collect()} == {"x", None}


def test_texts_of_pieces_make_the_documents(odd, odd_rows):
    docs = odd.select("doc_id", "text")
    out = packing.with_texts(packing.pack(docs, (64, 256, 1024), shard=10), docs)
    whole = defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: r.start):
        assert words(r.text) == r.n_tokens
        whole[r.doc_id, r.mark, r.copy].append(r.text)
    got = sorted((str(k[0]), "".join(v).rstrip("\x20\t\n\x0b\x0c\r")) for k, v in whole.items())
    assert got == sorted((str(r[0]), r[1].rstrip("\x20\t\n\x0b\x0c\r")) for r in odd_rows if words(r[1]))
    full = packing.bins(out).first()
    assert all(p.text for p in full.pieces) and full.bin_tokens == sum(p.n_tokens for p in full.pieces)


def test_sequences_of_token_ids(spark, odd):
    """The ids of all pieces of a document, put together, are those that the tokenizer gives its whole text."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from parcela.llm import tokenfile

    name = public_tokenizers.path("word_bpe_49k.json")
    docs = odd.where("doc_id is not null and doc_id <> 100").select("doc_id", "text")
    path = tokenfile.write(docs, name)
    counted = docs.join(tokenfile.read(spark, path).select("doc_id", F.col("n_tokens").alias("n")), "doc_id")
    packed = packing.pack(counted, (64, 1024), shard=8, tokens="n")
    where = {}
    for r in packed.collect():
        where.setdefault(r.doc_id, []).append((r.start, r.bin_id, r.offset, r.n_tokens))
    bins = {r.bin_id: r for r in packing.sequences(packed, tokenfile.documents(spark, path)).collect()}
    assert all(len(b.ids) <= b.bin_length and b.starts[0] == 0 for b in bins.values())
    t = Tokenizer.from_file(name)
    for r in docs.collect():
        got = [x for _, b, at, n in sorted(where[r.doc_id]) for x in bins[b].ids[at : at + n]]
        assert got == [*t.encode(r.text or "", add_special_tokens=False).ids, 2]
