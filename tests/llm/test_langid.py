from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcela.llm import langid, queries


def plain_grams(text):
    out, c = Counter(), ["_"]
    for ch in (text or "").lower():
        if ch.isalpha():
            c.append(ch)
        elif c[-1] != "_":
            c.append("_")
    if c[-1] != "_":
        c.append("_")
    for n in (1, 2, 3):
        for i in range(len(c) - n + 1):
            if c[i : i + n] != ["_"]:
                out["".join(c[i : i + n])] += 1
    return out if any(x != "_" for x in c) else Counter()


@pytest.mark.parametrize("text", ["Hello, World!!  x", "ÉTÉ 12 a", "日本 語", "1 2 3", "", None, "\U0001f600a"])
def test_grams(text):
    def named(key):
        parts = []
        while key:
            parts.append("_" if key & 0x1FFFFF == 1 else chr(key & 0x1FFFFF))
            key >>= 21
        return "".join(reversed(parts))

    assert Counter(named(int(k)) for k in langid.Grams()(text)) == plain_grams(text)


def test_ranks_and_ties():
    assert langid.ranked(np.array([5, 5, 3, 3, 9, 1], np.uint64), 3).tolist() == [3, 5, 1]


def test_distance():
    p = langid.Profiles([("aa", 10, 0), ("aa", 20, 1), ("bb", 20, 0)], top=4)
    # Ranks of the text: 20 first, then 10.
    assert p.judge(np.array([20, 20, 10], np.uint64)) == ("aa", 1 - 2 / 8)
    assert p.judge(np.array([], np.uint64)) == ("und", 0.0)
    assert langid.Profiles([]).judge(np.array([1], np.uint64)) == ("und", 0.0)


def test_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("0.001", "0.01")
    truth = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "lang")
    out = queries.op7_rank_order_langid(spark, big).join(truth, "doc_id").where("held_out")
    right = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98
    assert out.where("score < 0 or score > 1").count() == 0


def test_odd_rows(odd, odd_rows, none):
    profiles = langid.learn(odd)
    out = langid.identify(odd, profiles).collect()
    assert len(out) == len(odd_rows)
    blank = {r[0] for r in odd_rows if not any(c.isalpha() for c in r[1] or "") and r[0] is not None}
    assert {r.doc_id for r in out if r.lang_pred == "und" and r.doc_id is not None} == blank
    assert langid.learn(none) == [] and langid.identify(none, profiles).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, []).collect()} == {"und"}


def test_rare_languages_are_learned(spark, monkeypatch):
    rows = [(i, f"the common tongue number {i}", "en") for i in range(3000)] + [(None, "ein seltener satz", "de"), (9001, "une phrase rare", "fr")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    profiles = langid.learn(docs, most=20)
    assert {p[0] for p in profiles} == {"en", "de", "fr"}
    assert {r.doc_id: r.lang_pred for r in langid.identify(docs.where("lang <> 'en'"), profiles).collect()} == {None: "de", 9001: "fr"}
    monkeypatch.setattr(langid, "MOST_LANGS", 2)
    with pytest.raises(ValueError):
        langid.learn(docs)


def test_against_brute_force(odd, odd_rows):
    """Profiles, distances and verdicts by counters and loops; equal counts go by the letters' codes."""
    top = 40

    def best(counts):
        def code(gram):
            return sum((1 if c == "_" else ord(c)) << 21 * k for k, c in enumerate(reversed(gram)))

        return sorted(counts, key=lambda g: (-counts[g], code(g)))[:top]

    sums = {}
    for _, text, lang, _ in odd_rows:
        if lang is not None and text is not None:
            sums.setdefault(lang, Counter()).update(plain_grams(text))
    known = {lang: {g: i for i, g in enumerate(best(c))} for lang, c in sums.items()}
    want = []
    for i, text, _, _ in odd_rows:
        mine = best(plain_grams(text))
        if not mine:
            want.append((i, "und", 0.0))
            continue
        apart = {lang: sum(abs(r - ranks[g]) if g in ranks else top for r, g in enumerate(mine)) for lang, ranks in known.items()}
        lang = min(sorted(apart), key=apart.get)
        want.append((i, lang, round(1 - apart[lang] / (top * len(mine)), 9)))
    out = langid.identify(odd, langid.learn(odd, top, most=10**9), top).collect()
    assert sorted(((r.doc_id, r.lang_pred, round(r.score, 9)) for r in out), key=str) == sorted(want, key=str)
