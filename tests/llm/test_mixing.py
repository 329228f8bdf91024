import hashlib
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from parcela.llm import mixing


def fitted(cells, targets, sweeps, budget):
    """Scarce categories give all they have, found by dealing what they lack again and again."""
    tokens = []
    for axis, share in enumerate(targets):
        cap = defaultdict(int)
        for k, v in cells.items():
            cap[k[axis]] += v
        full = set()
        while True:
            left = budget - sum(cap[k] for k in full)
            rest = sum(share[k] for k in share if k not in full)
            more = {k for k in share if k not in full and share[k] / rest * left > cap[k]}
            if not more:
                break
            full |= more
        tokens.append({k: cap[k] if k in full else share[k] / rest * left for k in share})
    w = {k: float(v) for k, v in cells.items()}
    for _ in range(sweeps):
        for axis, target in enumerate(tokens):
            held = defaultdict(float)
            for k, v in w.items():
                held[k[axis]] += v
            w = {k: min(cells[k], v * target.get(k[axis], 0.0) / held[k[axis]]) if held[k[axis]] > 0 else 0.0 for k, v in w.items()}
    return w


def test_against_brute_force(odd, odd_rows):
    out = mixing.mix(odd).collect()
    assert len(out) == len(odd_rows)
    cells = defaultdict(int)
    for r in out:
        cells[r.source, r.lang, r.topic] += r.n_tokens
    targets = []
    for axis in range(3):
        mass = defaultdict(int)
        for k, v in cells.items():
            mass[k[axis]] += v
        powers = {k: v**mixing.TEMPER for k, v in mass.items()}
        targets.append({k: v / sum(powers.values()) for k, v in powers.items()})
    w = fitted(cells, targets, mixing.SWEEPS, sum(cells.values()) * mixing.KEEP)
    for r in out:
        cell = (r.source, r.lang, r.topic)
        p = min(1.0, round(w[cell] / cells[cell], 9))
        assert math.isclose(r.p, p, abs_tol=2e-9)
        name = "(none)" if r.doc_id is None else str(r.doc_id)
        draw = int(hashlib.md5(f"{name}:0".encode()).hexdigest()[:12], 16) / 16**12
        assert r.selected == (draw < r.p)
    tokens = sorted(max(1, len(re.findall(r"[^\x20\x09-\x0D]+", t[1] or ""))) for t in odd_rows)
    assert tokens == sorted(r.n_tokens for r in out)


def test_given_targets_are_met(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("concat('w', id % 7, ' x')").alias("text"), F.expr("if(id % 3 = 0, 'a', 'b')").alias("source"), F.expr("if(id % 5 < 3, 'en', 'fr')").alias("lang"))
    share = lambda n, m: spark.createDataFrame(list(m.items()), f"{n} string, share double")
    targets = {"source": share("source", {"a": 0.6, "b": 0.4}), "lang": share("lang", {"en": 0.5, "fr": 0.5}), "topic": share("topic", {"paragraph": 1.0})}
    out = mixing.mix(docs, targets, keep=0.4).collect()
    mass = sum(r.p * r.n_tokens for r in out)
    assert math.isclose(sum(r.p * r.n_tokens for r in out if r.source == "a") / mass, 0.6, abs_tol=1e-6)
    assert math.isclose(sum(r.p * r.n_tokens for r in out if r.lang == "en") / mass, 0.5, abs_tol=1e-6)
    drawn = sum(r.n_tokens for r in out if r.selected)
    assert abs(drawn / sum(r.n_tokens for r in out) - 0.4) < 0.05


def test_repeats_meet_targets_of_scarce_cells(spark):
    """A source with 5 % of the tokens is to have 40 %: drawn once at most it cannot."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("w x y").alias("text"), F.expr("if(id % 20 = 0, 'a', 'b')").alias("source"), F.expr("if(id % 3 = 0, 'en', 'fr')").alias("lang"))
    share = lambda n, m: spark.createDataFrame(list(m.items()), f"{n} string, share double")
    targets = {"source": share("source", {"a": 0.4, "b": 0.6}), "lang": share("lang", {"en": 0.5, "fr": 0.5}), "topic": share("topic", {"paragraph": 1.0})}
    out = mixing.mix(docs, targets, keep=0.5, repeats=True).collect()
    mass = sum(r.expected * r.n_tokens for r in out)
    assert math.isclose(mass / sum(r.n_tokens for r in out), 0.5, abs_tol=1e-6)
    assert math.isclose(sum(r.expected * r.n_tokens for r in out if r.source == "a") / mass, 0.4, abs_tol=1e-6)
    assert math.isclose(sum(r.expected * r.n_tokens for r in out if r.lang == "en") / mass, 0.5, abs_tol=1e-6)
    assert all(r.selected == (r.times > 0) and math.floor(r.expected) <= r.times <= math.ceil(r.expected) for r in out)
    rows = mixing.sample(docs, targets, keep=0.5, repeats=True).collect()
    assert len(rows) == sum(r.times for r in out)
    assert abs(len(rows) / 6000 - 0.5) < 0.02 and abs(sum(r.source == "a" for r in rows) / len(rows) - 0.4) < 0.02


def test_absent_target_gets_none(spark, none):
    docs = spark.createDataFrame([(i, "x y", s, "en") for i, s in enumerate("aabb")], "doc_id bigint, text string, source string, lang string")
    t = mixing.tempered(docs.groupBy("source", "lang").agg(F.lit("paragraph").alias("topic"), F.count("*").alias("tokens")), ("lang", "topic"), 1.0)
    t = {"source": spark.createDataFrame([("a", 1.0)], "source string, share double")} | t
    assert {r.source: r.p for r in mixing.mix(docs, t, keep=0.5).collect()} == {"a": 1.0, "b": 0.0}
    assert mixing.mix(none).count() == 0
    assert mixing.sample(none).columns == none.columns


def test_sample_keeps_columns(odd):
    want = {r.doc_id for r in mixing.mix(odd).collect() if r.selected}
    odd = odd.withColumn("__cell", F.col("doc_id").cast("int"))
    kept = mixing.sample(odd)
    assert kept.columns == odd.columns and kept.where("not doc_id <=> cast(__cell as bigint)").count() == 0
    assert {r.doc_id for r in kept.collect()} == want


@pytest.mark.parametrize("seed", [0, 1])
def test_draw_depends_on_seed_alone(odd, seed):
    a = sorted((str(r.doc_id), r.selected) for r in mixing.mix(odd, seed=seed).collect())
    assert a == sorted((str(r.doc_id), r.selected) for r in mixing.mix(odd.repartition(7), seed=seed).collect())


def test_scarce_sources_give_all_and_the_others_the_rest(spark):
    """20 documents against 980, half and half of 600: all 20, and 580."""
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("w").alias("text"), F.expr("if(id < 20, 'a', 'b')").alias("source"), F.lit("en").alias("lang"))
    share = lambda n, m: spark.createDataFrame(list(m.items()), f"{n} string, share double")
    targets = {"source": share("source", {"a": 0.5, "b": 0.5}), "lang": share("lang", {"en": 1.0}), "topic": share("topic", {"paragraph": 1.0})}
    out = mixing.mix(docs, targets, keep=0.6).collect()
    mass = {s: sum(r.p for r in out if r.source == s) for s in "ab"}
    assert math.isclose(mass["a"], 20, abs_tol=1e-6) and math.isclose(mass["b"], 580, abs_tol=1e-5)
    found = {(r.marginal, r.value): (r.target, r.expected) for r in mixing.balance(docs, targets, keep=0.6).collect()}
    assert all(math.isclose(t, e, rel_tol=1e-6) for t, e in found.values()) and math.isclose(found["source", "b"][0], 580, rel_tol=1e-9)


def test_more_cells_than_one_task_fits(odd, monkeypatch):
    few = sorted(map(str, mixing.mix(odd).collect()))
    monkeypatch.setattr(mixing, "_CELLS", -1)
    assert sorted(map(str, mixing.mix(odd).collect())) == few
