"""Columns that clash, ids that are null or repeated, and the memory of many languages."""

import pickle
import random

import numpy as np
import pytest

from parcela.llm import langid, packing, secrets
from parcela.llm.common import text_mark


def test_learning_with_a_column_part(spark):
    rows = [(i, "ab cd ef" if i % 2 else "xy zz", "a" if i % 2 else "b", 1, 2) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, part int, n int")
    found = langid.identify(docs, langid.learn(docs))
    assert {(r.doc_id % 2, r.lang_pred) for r in found.collect()} == {(1, "a"), (0, "b")}


def dense(rows, keys, top):
    """Distances by a table of all grams and languages."""
    mine = langid.ranked(keys, top)
    langs = sorted({r[0] for r in rows})
    rank = {(lang, gram): r for lang, gram, r in rows}
    apart = [sum(abs(rank[lang, g] - i) if (lang, g) in rank else top for i, g in enumerate(mine.tolist())) for lang in langs]
    best = min(range(len(langs)), key=lambda k: (apart[k], k))
    return langs[best], 1.0 - apart[best] / (top * len(mine))


def test_postings_against_a_dense_table():
    rng = random.Random(4)
    rows = [(f"l{k}", g, r) for k in range(12) for r, g in enumerate(rng.sample(range(60), 30))]
    known = langid.Profiles(rows, 30)
    for _ in range(200):
        keys = np.array([rng.randrange(90) for _ in range(rng.randint(1, 80))], np.uint64)
        assert known.judge(keys) == dense(rows, keys, 30)


def test_memory_of_a_thousand_languages():
    rng = random.Random(5)
    rows = [(f"l{k:04}", rng.getrandbits(62), r) for k in range(1000) for r in range(300)]
    assert len(pickle.dumps(langid.Profiles(rows))) < 6_000_000


def test_findings_keep_columns_of_their_names(spark):
    docs = spark.createDataFrame([(1, "token = abcdefgh12", "mine", 7), (2, None, "too", 8)], "doc_id bigint, text string, found string, blob_id int")
    ledger, _ = secrets.scan(docs.select("doc_id", "text"))
    out = secrets.findings(docs, ledger)
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].found == "mine" and rows[1].blob_id == 7 and len(rows[1]._found) == 1 and rows[2]._found == [] and len(rows[1]._blob_id) == 64
    assert {r.doc_id: r.n_assign for r in secrets.report(out).collect()} == {1: 1, 2: 0}


def test_sequences_of_null_and_repeated_ids(spark):
    texts = [(None, " ".join(f"n{i}" for i in range(4))), (1, "a b c d e"), (1, "f g h i j"), (2, "k l m n o"), (2, "k l m n o")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    packed = packing.pack(docs, (8, 16))
    tokens = docs.distinct().select("doc_id", text_mark().alias("mark"), "text").rdd.map(lambda r: (r.doc_id, r.mark, [ord(w[-1]) for w in r.text.split()]))
    ids = spark.createDataFrame(tokens.collect(), "doc_id bigint, mark bigint, ids array<int>")
    out = packing.sequences(packed, ids).collect()
    held = sorted(tuple(r.ids[a:b]) for r in out for a, b in zip(r.starts, [*r.starts[1:], len(r.ids)], strict=True))
    assert held == sorted(tuple(ord(w[-1]) for w in t.split()) for _, t in texts)
    with pytest.raises(ValueError, match="mark"):
        packing.sequences(packed, ids.drop("mark"))
    unique = ids.where("doc_id is null or doc_id = 2").drop("mark")
    assert sorted(len(r.ids) for r in packing.sequences(packed.where("doc_id is null or doc_id = 2"), unique).collect())[-1] <= 16
