import re
from collections import Counter

from parcela.llm import quality


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {k + d for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts(odd, odd_rows):
    out = quality.quality(odd)
    assert set(out.columns) == set(odd.columns)
    got = sorted((str(r.doc_id), r.quality[:1] + r.quality[1:3] + r.quality[4:5] + r.quality[6:7]) for r in out.collect())
    assert got == sorted((str(r[0]), counts(r[1])) for r in odd_rows)


def test_colliding_hashes_count_right(spark, monkeypatch):
    """With a packing that leaves no bits for the hash, all windows collide and are told apart by words."""
    monkeypatch.setattr(quality, "_POS", 63)
    texts = ["a b c x a b c y q r s", "a b c d e f", "a a a a a", "p q r a b c p q r"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r.quality.n_repeat_words for r in quality.quality(df).orderBy("doc_id").collect()] == [counts(t)[4] for t in texts]


def test_verdicts(spark, none):
    clean = " ".join(["the house of a friend and the dog"] + [f"word{i} of x{i} the y{i}" for i in range(30)])
    junk = " ".join(f"w{i}### z{i}***" for i in range(60))
    df = spark.createDataFrame([(1, clean), (2, junk), (3, clean[:40]), (4, None)], "doc_id bigint, text string")
    assert [r.doc_id for r in quality.keep(df).collect()] == [1]
    assert quality.quality(df).where("doc_id = 2").first().quality.failed == ["symbols", "stop_words"]
    assert quality.keep(none).columns == none.columns
    assert quality.quality(none).count() == 0


def test_pipeline_keeps_a_quality_column(spark, none, sf_dir):
    import corpus_pipeline

    good = " ".join(["the house of a friend and the dog"] + [f"word{i} of x{i} the y{i}" for i in range(30)])
    df = spark.createDataFrame([(1, good, "high"), (2, "x", "low")], "doc_id bigint, text string, quality string")
    assert [tuple(r) for r in corpus_pipeline.good(spark, df, sf_dir).collect()] == [(1, good, "high")]
    assert corpus_pipeline.good(spark, none, sf_dir).columns == none.columns


def test_plan_has_no_shuffle_and_no_python(odd):
    plan = quality.quality(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
