"""Duplicate spans against a table of all windows, for texts with planted, broken, periodic and crowded passages."""

import random

import numpy as np
import pytest

from parcela.llm import substring


def plain(rows, window):
    """(doc_id, text) rows to (doc_id, words, removed, spans, kept)."""
    texts = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    seen = {}
    for _, w in texts:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for doc, w in texts:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        spans, kept = [], [x for i, x in enumerate(w) if i not in gone]
        for i in sorted(gone):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append((doc, len(w), len(gone), [tuple(s) for s in spans], " ".join(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, [(s.start, s.end) for s in r.spans], r.kept) for r in df.collect()), key=str)


def table(spark, rows, parts=3):
    extra = "i bigint, j string, pos int, key string, ctx int, found string, places string, spans int, kept int, n_words string"
    return spark.createDataFrame([(*r, *[None] * 10) for r in rows], f"doc_id bigint, text string, {extra}").repartition(parts)


def words(n, vocabulary=200):
    return [f"w{random.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def planted():
    random.seed(8)
    passages = [words(n) for n in (34, 35, 36, 50, 60, 120)]
    rows = []
    for i in range(80):
        w = words(random.choice([0, 3, 34, 35, 60, 200]))
        for _ in range(random.randrange(4)):
            p = random.choice(passages)
            a = random.randrange(len(p))
            w += random.choice([p, p[a:], p[:a], p[: a // 2] + p[a:]]) + words(random.choice([0, 1, 30]))
        rows.append((i, " ".join(w)))
    rows += [(100 + i, rows[i][1]) for i in range(5)]  # copies
    rows += [rows[7]] * 2 + [(None, rows[9][1]), (None, None), (201, ""), (202, " \n\t")]
    rows.append((300, " ".join(words(100) * 3)))  # one that repeats itself
    rows.append((301, " ".join(["same"] * 100)))
    rows.append((302, " ".join(["ab", "cd", "ef"] * 40)))
    rows.append((303, " ".join(words(30_000, 10**6))))
    rows.append((304, "\x0b".join(passages[5]) + " naïve one 日本語"))
    return rows


@pytest.mark.parametrize("window", [12, 35, 50])
def test_planted(spark, planted, window):
    assert found(substring.cut(table(spark, planted), window)) == plain(planted, window)


def test_crowds(spark, planted, monkeypatch):
    """Windows of anchors with many contexts are counted; small blocks and slices change nothing."""
    monkeypatch.setattr(substring, "CROWD", 2)
    monkeypatch.setattr(substring, "BLOCK", 10)
    monkeypatch.setattr(substring, "_NEAR", 0)
    random.seed(9)
    p = words(40)
    rows = planted + [(1000 + i, " ".join(words(random.randrange(40)) + p + words(random.randrange(40)))) for i in range(60)]
    assert found(substring.cut(table(spark, rows, 5), 35)) == plain(rows, 35)


def test_empty(spark, planted):
    assert substring.cut(table(spark, planted).limit(0), 35).collect() == []
    assert found(substring.cut(table(spark, [(1, "a b"), (2, None)]), 35)) == [(1, 2, 0, [], "a b"), (2, 0, 0, [], "")]


def test_longest():
    rows = np.array([[1, 2, 3, 4], [1, 2, 3, 5], [1, 2, 9, 9], [1, 2, 3, 4]], np.uint64)
    keys = np.array([5, 5, 5, 6], np.uint64)
    every = np.arange(4)
    assert substring.longest(keys, rows, 0, every).tolist() == [3, 3, 2, 0]
    assert substring.longest(keys, rows, 2, every).tolist() == [1, 1, 0, 0]


def test_runs_and_slides():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 5, 300).astype(np.uint64)
    runs = substring._Runs(x)
    seen = {}
    for n in (1, 2, 7, 35):
        at = np.arange(len(x) - n + 1)
        for i, h in zip(at, runs.hash(at, at + n), strict=True):
            assert seen.setdefault(tuple(x[i : i + n]), h) == h
    assert len(set(seen.values())) == len(seen)
    for n in (1, 2, 3, 24, 39):
        assert substring._slid(x, n, np.minimum).tolist() == [min(x[i : i + n]) for i in range(len(x) - n + 1)]
