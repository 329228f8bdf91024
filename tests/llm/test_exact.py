import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from parcela.llm import exact


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for r in rows:
        ids = groups[r[1] or ""]
        known = [i for i in ids if i is not None]
        out.append((r[0], max(known) if known else r[0], len(ids), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("capacity", "bits"), [(50_000, 64), (2, 4), (1, 1), (3, 16)])
def test_groups(odd, odd_rows, capacity, bits):
    out = exact.exact(odd, capacity, bits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=str) == expected(odd_rows)
    assert all(r.kept == (r.doc_id is None and r.keep_id is None or r.doc_id == r.keep_id) for r in out)


def test_directory_splits_until_it_fits(spark):
    keys = spark.createDataFrame([(k, 0) for k in (0, 1, 8, 15)] + [(16 * 16 + k, 0) for k in range(6)], "key bigint, floor int")
    found = exact.directory(keys, 3, 10).collect()
    bits = found[0].bits
    assert {r.cell for r in found} == {k.key >> (10 - bits) for k in keys.collect()}
    held = defaultdict(set)
    for k in keys.collect():
        held[next(r.bucket for r in found if r.cell == k.key >> (10 - bits))].add(k.key)
    assert max(map(len, held.values())) <= 3
    for r in found:  # all cells of a bucket share its first bits, and a bucket one bit shorter would be overfull
        depth, prefix = map(int, r.bucket.split(":"))
        assert depth == r.depth and r.cell >> (bits - depth) == prefix
        assert not depth or sum(k.key >> (10 - depth + 1) == prefix >> 1 for k in keys.collect()) > 3


def test_directory_keeps_doubling(spark):
    """Keys that agree in their first 56 bits are told apart all the same."""
    found = exact.directory(spark.range(4).selectExpr("shiftleft(5L, 40) + id as key", "0 as floor"), 1, 60).collect()
    assert sorted((r.cell, r.depth) for r in found) == [((5 << 40) + k, 60) for k in range(4)]


def test_collisions_make_chains(spark, odd):
    index, _ = exact.build(odd, 2, 1)
    found = index.buckets(spark)
    assert found.agg(F.max("chain")).first()[0] > 0
    assert found.groupBy("key", "chain").count().where("count > 1").count() == 0


def test_a_wrong_directory_finds_nothing(spark, odd, monkeypatch):
    index, entries = exact.build(odd, 2, 8)
    assert exact.lookup(index, entries).where("keep_id is null and doc_id is not null").count() == 0
    true = exact.Index.cells
    monkeypatch.setattr(exact.Index, "cells", lambda self, spark: true(self, spark).withColumn("bucket", F.concat("bucket", F.lit("x"))))
    assert exact.lookup(index, entries).where("keep_id is not null").count() == 0


def test_copies_in_two_buckets_are_not_met(spark, monkeypatch):
    """Equality is decided by the owner of a bucket, so that a directory that parts copies keeps both."""
    docs = spark.createDataFrame([(i, "same") for i in range(6)], "doc_id bigint, text string")
    assert exact.exact(docs).where("kept").count() == 1
    placed = exact._placed
    apart = lambda rows, *a: placed(rows, *a).withColumn("bucket", F.concat("bucket", F.lit("/"), F.col("doc_id") % 2)) if "doc_id" in rows.columns else placed(rows, *a)
    monkeypatch.setattr(exact, "_placed", apart)
    owned = exact._owned(apart(docs.withColumn("key", F.lit(0).cast("bigint")), spark.createDataFrame([(0, "0:0")], "cell bigint, bucket string"), 64, 0))
    assert sorted((r.keep_id, r.group_size) for r in owned.collect()) == [(4, 3), (5, 3)]


@pytest.mark.parametrize(("capacity", "bits"), [(2, 10), (3, 4)])
def test_insert_equals_a_new_index(spark, odd, capacity, bits):
    first, second, third = (odd.where(f"pmod(hash(text, doc_id), 3) {x}") for x in ("= 0", "= 1", "= 2"))
    index, _ = exact.build(first, capacity, bits)
    index = exact.insert(exact.insert(index, first, second), first.union(second), third)
    whole, entries = exact.build(odd, capacity, bits)
    names = ("key", "chain", "text_sha256", "keep_id", "group_size")
    rows = lambda i: sorted(map(tuple, i.buckets(spark).select(*names).collect()), key=str)
    assert rows(index) == rows(whole) and index.generation == 2
    assert index.buckets(spark).groupBy("bucket").agg(F.countDistinct("key").alias("n")).where(f"n > {capacity}").where(f"substring_index(bucket, ':', 1) < {bits}").count() == 0
    found = exact.lookup(index, entries)
    assert found.where("group_size is null").count() == 0 and found.count() == entries.count()


def test_keep_and_empty(odd, odd_rows, none):
    kept = exact.keep(odd.where("doc_id is not null and doc_id <> 100"))
    texts = [r.text or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({r[1] or "" for r in odd_rows if r[0] not in (None, 100)})
    assert kept.columns == odd.columns
    assert exact.exact(none).count() == 0 and exact.keep(none).count() == 0


def test_keep_judges_rows(spark, odd, odd_rows):
    """All odd rows, null ids and repeated rows among them, and an id with two texts."""
    texts = [r.text or "" for r in exact.keep(odd).collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in odd_rows})
    rows = [(1, "A"), (1, "B"), (2, "A"), (3, "C"), (3, "C"), (None, "C"), (None, "D"), (None, "D"), (4, None), (5, "")]
    kept = exact.keep(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, "B"), (2, "A"), (3, "C"), (None, "D"), (5, "")], key=str)


def test_insert_of_nothing_and_into_nothing(spark, odd, none):
    whole, entries = exact.build(odd, 2, 10)
    names = ("key", "chain", "text_sha256", "keep_id", "group_size")
    rows = lambda i: sorted(map(tuple, i.buckets(spark).select(*names).collect()), key=str)
    assert rows(exact.insert(whole, odd, none)) == rows(whole)
    empty, _ = exact.build(none, 2, 10)
    assert rows(exact.insert(empty, none, odd)) == rows(whole)


def test_internal_names_stay(odd):
    kept = exact.keep(odd.withColumn("__mark", F.col("doc_id").cast("int")))
    assert kept.columns == odd.columns and kept.where("not doc_id <=> cast(__mark as bigint)").count() == 0
