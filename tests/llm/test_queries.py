"""Queries against their SQL, and the pipeline against its own operators on whole tables."""

import pytest

from parcela.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, same, name):
    same(QUERIES[name](spark, sf_dir), ORACLE_SQL[name])


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    from parcela.llm import mixing, quality

    from .test_ngram_join import brute

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = {r.doc_id: r.text for r in quality.keep(docs).collect()}
    last = {}
    for i in sorted(good):
        last[good[i]] = i
    texts = {i: t for t, i in last.items()}
    apart = {i for i, (_, c) in brute(sorted(texts.items()), 5, 80).items() if i == c}
    kept = docs.where(docs.doc_id.isin(sorted(apart)))
    drawn = {r.doc_id: r.n_tokens for r in mixing.mix(kept).collect() if r.selected}
    out = corpus_pipeline.run(spark, sf_dir).collect()
    packed = {}
    for r in out:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.n_tokens
    assert packed == drawn
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "n-gram Jaccard join", "mixing sources", "best-fit packing"]
