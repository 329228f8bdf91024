import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from parcela.llm import ngram_join
from parcela.llm.shingles import Codes, set_id, shingle_set


def brute(docs, k, percent):
    """doc_id: (shingles, component), by comparing every pair that shares a shingle."""

    def shingles(text):
        w = (text or "").encode().lower().split()
        if len(w) < k:
            return frozenset([tuple(w)] if w else [])
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))

    sets, up, where = {i: shingles(t) for i, t in docs}, {i: i for i, _ in docs}, defaultdict(list)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sorted(sets):
        for j, n in Counter(j for x in sets[i] for j in where[x]).items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
        for x in sets[i]:
            where[x].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def families(seed):
    """Families of near copies of all sizes, some sharing a passage, and odd texts."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [r.choice(words) for _ in range(30)]
    texts = [None, "  ", "A b", "a B", ""]
    for _ in range(25):
        base = [r.choice(words) for _ in range(r.choice([3, 8, 30, 60, 200]))]
        for _ in range(r.choice([1, 2, 5, 40])):
            t = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3, 6])):
                t[r.randrange(len(t))] = r.choice(words)
            if r.random() < 0.3:
                t = t[: -r.randint(1, 3)] or t
            if r.random() < 0.3:
                t = t + passage[: r.choice([5, 30])]
            texts.append(" ".join(t))
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("k", "percent", "seed"), [(4, 85, 1), (5, 80, 2), (2, 50, 3), (1, 60, 4)])
def test_against_brute_force(spark, k, percent, seed):
    docs = families(seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near(df, k, percent).collect()}
    assert got == brute(docs, k, percent)


def test_common_tokens_pass_by(spark, monkeypatch):
    """With every shared token common, and one batch a document, the result is the same."""
    docs = families(5)
    monkeypatch.setattr(ngram_join, "_COMMON", 2)
    monkeypatch.setattr(ngram_join, "_BATCH", 300)
    monkeypatch.setattr(ngram_join, "_TASK", 2000)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near(df, 4, 70).collect()}
    assert got == brute(docs, 4, 70)


@pytest.mark.parametrize("common", [2, 32])
def test_parts_dealt_twice(spark, monkeypatch, common):
    """Many more parts than a batch is dealt to, and several parts a task."""
    docs = families(6)
    for name, value in (("_COMMON", common), ("_BATCH", 400), ("_TASK", 100), ("_PARTS", 3), ("_REDUCERS", 4)):
        monkeypatch.setattr(ngram_join, name, value)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near(df, 4, 70).collect()}
    assert got == brute(docs, 4, 70)


def test_sets_whose_ids_collide(spark):
    a, b, c = (shingle_set(t, 4, Codes()) for t in (b"a b c d e", b"f g h i j", b"k l m n o"))
    ids, others = [set_id(x) for x in (a, b, c)], [set_id(x, again=1) for x in (a, b, c)]
    assert not set(ids) & set(others)
    # As if the first two had one id.
    rows = [(1, ids[0], others[0], 2), (2, ids[0], others[1], 2), (3, ids[2], others[2], 2), (4, ids[2], others[2], 2), (5, None, None, 0)]
    members, clash = ngram_join._apart(spark.createDataFrame(rows, "doc_id bigint, cls bigint, other bigint, n bigint"))
    assert clash == {ids[0]}
    assert {r.doc_id: r.cls for r in members.collect()} == {1: others[0], 2: others[1], 3: ids[2], 4: ids[2], 5: None}
    assert set_id(a, clash) == others[0] and set_id(c, clash) == ids[2]


def test_odd_rows(odd, odd_rows, none):
    out = ngram_join.near(odd, 4, 85).collect()
    assert len(out) == len(odd_rows)
    known = [(r[0], r[1]) for r in odd_rows if r[0] is not None and r[0] != 100]
    expected = brute(known, 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id in expected} == expected
    assert ngram_join.near(none).count() == 0
    kept = ngram_join.keep(odd.where("doc_id <> 100"), k=4, percent=85)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in expected.items() if i == c}


def test_keep_judges_rows(spark):
    """Null ids, repeated rows, and an id with two texts."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a), (2, a + " z"), (2, b), (3, c), (3, c), (3, c + " z"), (None, a + " y"), (None, d), (None, d), (None, d + " z"), (4, ""), (5, "")]
    kept = ngram_join.keep(spark.createDataFrame(rows, "doc_id bigint, text string"), k=4, percent=85).collect()
    got = sorted(((r.doc_id, r.text.split(" ")[0][:1]) for r in kept), key=str)
    assert got == sorted([(1, "a"), (2, "b"), (3, "c"), (None, "d"), (4, ""), (5, "")], key=str)
    assert [r.text for r in kept if r.doc_id == 3][0] in (c, c + " z")


def test_sets():
    codes = Codes(2)
    assert len(shingle_set(b"a b c d e", 4, codes)) == 2
    assert set_id(shingle_set(b"A  b\tC", 4, codes)) == set_id(shingle_set(b"a b c", 4, codes))
    assert set_id(shingle_set(b"a b c", 4, codes)) != set_id(shingle_set(b"a c b", 4, codes))
    assert len(shingle_set(None, 4, codes)) == len(shingle_set(b" \x0b", 4, codes)) == 0
    assert len(codes) == 2


def test_histograms_never_rule_out_a_link():
    rng = np.random.default_rng(3)
    for n in (1, 5, 90, 150, 900, 1500, 6000):
        for share in (0.0, 0.05, 0.1, 0.2, 0.3):
            s = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            keep = rng.random(len(s)) >= share
            t = np.unique(np.concatenate((s[keep], rng.integers(0, 2**63, int(n * share / 2)).astype(np.uint64) * np.uint64(2))))
            both = len(np.intersect1d(s, t))
            links = len(t) and 100 * both >= 80 * (len(s) + len(t) - both)
            if links:
                assert ngram_join._may_link(ngram_join._histogram(s), ngram_join._histogram(t), len(s), len(t), 80)
    other = np.unique(rng.integers(0, 2**63, 150).astype(np.uint64) * np.uint64(2))
    one = np.unique(rng.integers(0, 2**63, 150).astype(np.uint64) * np.uint64(2))
    assert not ngram_join._may_link(ngram_join._histogram(one), ngram_join._histogram(other), 150, 150, 80)


def test_templated_texts_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Texts of 8 of 30 passages share their commonest tokens with most others; few pairs have their whole sets compared."""
    rng = random.Random(11)
    passages = [" ".join(f"p{k}w{rng.randrange(10**6)}" for _ in range(20)) for k in range(30)]
    compared = []
    real = ngram_join._verified

    def counted(pairs, sets, percent):
        compared[-1] += pairs.count()
        return real(pairs, sets, percent)

    monkeypatch.setattr(ngram_join, "_verified", counted)
    for n in (250, 500):
        rows = [(i, " ".join(rng.sample(passages, 8))) for i in range(n)] + [(n, " ".join(passages[:8])), (n + 1, " ".join(passages[:8]) + " end")]
        compared.append(0)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
        out = {r.doc_id: r.component_id for r in ngram_join.near(docs, 5, 80).collect()}
        assert out == {i: c for i, (_, c) in brute(rows, 5, 80).items()} and out[n + 1] == n
    assert compared[0] <= 40 and compared[1] <= 80, compared
