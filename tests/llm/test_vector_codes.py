"""Vector codes against a plain double loop, and rows that hold anything."""

import hashlib
import math
import random

import numpy as np
import pytest

from parcela.llm import vector_codes


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """rows of (vec_id, vector, label): the codes, errors and codebooks by full search."""
    good = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    w = len(first[0][1]) // parts
    cut = [[v[p * w : p * w + w] for p in range(parts)] for _, v, _ in good]
    books = [[v[p * w : p * w + w] for _, v, _ in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            at = [near(v[p], book)[1] for v in cut]
            for k in range(len(book)):
                mine = [v[p] for v, a in zip(cut, at, strict=True) if a == k]
                if mine:
                    book[k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = []
    for (i, _, label), v in zip(good, cut, strict=True):
        found = [near(x, book) for x, book in zip(v, books, strict=True)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    sums = {}
    for _, _, e, label in out:
        sums[label] = sums.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, sums[label]) for i, c, e, label in out), key=str), digest


def rows_like(n, dim=16, seed=5):
    random.seed(seed)
    centres = [[random.gauss(0, 0.3) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [float(np.float32(c + random.gauss(0, 0.05))) for c in random.choice(centres)], random.choice([None, 1, 2, 2, 2])) for i in range(n)]
    random.shuffle(rows)
    return rows


def got(spark, rows, **options):
    table = spark.createDataFrame([(*r, "c", 1, 2) for r in rows], "vec_id bigint, embedding array<float>, label int, code string, __label int, o int").repartition(3)
    books = vector_codes.learn(table, **options)
    coded = vector_codes.with_sums(vector_codes.encode(table, books))
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()), key=str), books


def test_like_full_search(spark):
    rows = rows_like(120)
    rows += [(1000 + i, v, None) for i, (_, v, _) in enumerate(rows[:10])]  # copies and ties
    rows += [(3, rows[0][1], 7), (None, rows[1][1], 7)]  # an id again, and none
    rows += [(-1, None, 1), (-2, [0.1] * 15 + [None], 1), (-3, [math.nan] * 16, 1), (-4, [math.inf] * 16, 2), (-5, [-math.inf] + [0.0] * 15, 2)]
    found, books = got(spark, rows)
    expected, digest = plain(rows)
    assert found == expected
    assert books.digest() == digest


def test_few_vectors_and_none(spark):
    rows = rows_like(3)
    found, books = got(spark, rows)
    expected, digest = plain(rows)
    assert (found, books.digest()) == (expected, digest)
    found, books = got(spark, [(1, None, 1)])
    assert found == [] and books.books == ((),) * 8


def test_equal_vectors(spark):
    rows = [(i, [0.25] * 8, 1) for i in range(40)]
    found, books = got(spark, rows)
    assert {r[1] for r in found} == {"00" * 8} and {r[2] for r in found} == {0}
    assert books.vector("00" * 8) == [0.25] * 8


def test_lengths_that_differ(spark):
    """The first vector's length holds; parts of a length that eight does not divide are longer by one at first."""
    rows = [(i, [0.1 * i] * 10, 1) for i in range(20)] + [(99, [0.1] * 3, 1), (100, [], 1)]
    found, books = got(spark, rows, parts=8)
    assert [len(b[0]) for b in books.books] == [2, 2, 1, 1, 1, 1, 1, 1]
    assert {r[0] for r in found} == set(range(20))
    assert max(abs(a - b) for r in found for a, b in zip(books.vector(r[1]), [0.1 * r[0]] * 10, strict=True)) < 0.21


def test_large_components_are_left_out(spark):
    found, _ = got(spark, [(1, [1.0] * 8, 1), (2, [4096.0] * 8, 1), (3, [-1e30] * 8, 1), (4, [4095.9] * 8, 1)])
    assert [r[0] for r in found] == [1, 4]


@pytest.mark.parametrize("spread", [1, 40, 100_000])
def test_annulus(spread):
    rng = np.random.default_rng(spread)
    x = rng.integers(-spread, spread + 1, (500, 4))
    for k in (1, 2, 17, 200):
        book = rng.integers(-spread, spread + 1, (k, 4))
        full = ((x[:, None] - book[None]) ** 2).sum(2)
        best, least = vector_codes.nearest(x, book)
        assert (best == full.argmin(1)).all() and (least == full.min(1)).all()
