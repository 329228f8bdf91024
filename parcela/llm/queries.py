"""The queries of this subpackage, each an operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, exact, html_text, langid, mixing, ngram_join, packing, quality, secrets, substring, tokenfile, urls, vector_codes
from .queries_sql import ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger, _ = secrets.scan(docs)
    return secrets.report(secrets.findings(docs, ledger))


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.outcomes_of(pages, _table(spark, sf_dir, "labels")))


def op4_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokenfile.write(_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return tokenfile.read(spark, path)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near(_table(spark, sf_dir, "documents"), k=4, percent=85)


def op7_rank_order_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    profiles = langid.learn(docs.where(~held_out))
    return langid.identify(docs, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[f"quality.{n}" for n in names])


def op11_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.cut(_table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_annular_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.learn(vectors, parts=8, entries=16, rounds=6, scale=4096)
    coded = vector_codes.with_sums(vector_codes.encode(vectors, books))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op13_signature_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = _table(spark, sf_dir, "conversations")
    return conversations.audit(conversations.damaged(talks), talks)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_best_fit_packing,
        op2_secret_ledger,
        op3_url_reputation,
        op4_repair_tokens,
        op5_main_text,
        op6_ngram_jaccard,
        op7_rank_order_langid,
        op8_source_mixing,
        op9_exact_dedup,
        op10_quality_rules,
        op11_relative_lz,
        op12_annular_codes,
        op13_signature_repair,
    )
}
