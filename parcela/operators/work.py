"""The state machine of reports: pending, extracted, skipped_v1 or failed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcela.functions.strings import truncated

#: Pages of each version of a report, and what a report must hold.
PAGES_OF_VERSION = {7: 2, 4: 1}
HOURLY_ROWS = 96


def version_of(pages: Column) -> Column:
    """2, 1, or 0 for anything else, unreadable files included."""
    out = F.when(pages.isNull(), 0)
    for n, version in PAGES_OF_VERSION.items():
        out = out.when(pages == n, version)
    return out.otherwise(0)


def likely_first_version(size: Column, limit: int = 4_000_000) -> Column:
    return F.coalesce((size > 0) & (size < limit), F.lit(False))


def pending(work: DataFrame, region: DataFrame | None = None, limit: int | None = None, order: Sequence[Column | str] = ("eval_id",)) -> DataFrame:
    """Pending reports, of the communes in ``region`` if given; the first ``limit`` by ``order``, or all if 0 or none."""
    found = in_region(work.where("pdf_status = 'pending'"), region)
    return found.orderBy(*order).limit(limit) if limit else found


def in_region(work: DataFrame, region: DataFrame | None) -> DataFrame:
    """The reports of the communes in ``region``, or all."""
    return work if region is None else work.join(region.select("comuna_id"), "comuna_id", "left_semi")


def random_order(seed: int = 0) -> list[Column]:
    """What to sort reports by for a random order that is the same for the same seed."""
    return [F.xxhash64("eval_id", F.lit(seed)), F.col("eval_id")]


def shuffled(work: DataFrame, seed: int = 0) -> DataFrame:
    """A random order that is the same for the same seed."""
    return work.orderBy(*random_order(seed))


def retryable(work: DataFrame, cap: int) -> DataFrame:
    return work.where((F.col("pdf_status") == "failed") & (F.coalesce("retry_count", F.lit(0)) < cap))


def reactivated(work: DataFrame, cap: int) -> DataFrame:
    """Failed reports with fewer than ``cap`` retries are pending again."""
    again = (F.col("pdf_status") == "failed") & (F.coalesce("retry_count", F.lit(0)) < cap)
    return work.withColumn("pdf_status", F.when(again, "pending").otherwise(F.col("pdf_status")))


def transition(work: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The state of each report after its outcome (eval_id, page_count, extract_error, valid).

    Adds new_status, new_retry_count and new_error. Outcomes of unknown reports get new_status
    ``error``; reports without an outcome are absent.
    """
    version = version_of(F.col("page_count"))
    failed = (version != 2) | F.col("extract_error").isNotNull() | ~F.coalesce("valid", F.lit(False))
    status = F.when(F.col("pdf_status").isNull(), "error").when(version == 1, "skipped_v1").when(failed, "failed").otherwise("extracted")
    reason = (
        F.when(version == 1, F.lit(None))
        # A report that never came has no pages to tell a version by, but a reason.
        .when((version != 2) & (F.col("page_count").isNotNull() | F.col("extract_error").isNull()), F.lit("unknown version"))
        .when(F.col("extract_error").isNotNull(), truncated(F.col("extract_error")))
        .when(failed, F.lit("validation"))
    )
    retries = F.coalesce("retry_count", F.lit(0))
    joined = outcomes.join(work.select("eval_id", "pdf_status", "retry_count"), "eval_id", "left")
    return joined.select(
        "eval_id",
        status.alias("new_status"),
        F.when(status == "failed", retries + 1).otherwise(retries).cast("bigint").alias("new_retry_count"),
        F.when(status == "failed", reason).alias("new_error"),
    )


def drain_summary(outcomes: DataFrame, status: str = "new_status") -> DataFrame:
    """How many were selected, extracted and skipped; all others count as failed."""
    c = F.col(status)
    extracted, skipped = F.count_if(c == "extracted"), F.count_if(c == "skipped_v1")
    return outcomes.agg(F.count("*").alias("selected"), extracted.alias("extracted"), skipped.alias("skipped"), (F.count("*") - extracted - skipped).alias("failed"))


def validation(report_rows: DataFrame) -> DataFrame:
    """Per report: has_codigo, p6_rows, p6_filled, p6_low_confidence and ok.

    Takes hourly rows (eval_id, codigo, outer, inner, low_confidence).
    """
    v = report_rows.groupBy("eval_id").agg(
        (F.count_if(F.coalesce("codigo", F.lit("")) != "") > 0).alias("has_codigo"),
        F.count("*").alias("p6_rows"),
        F.count_if(F.col("outer").isNotNull() & F.col("inner").isNotNull()).alias("p6_filled"),
        F.count_if("low_confidence").alias("p6_low_confidence"),
    )
    return v.withColumn("ok", F.col("has_codigo") & (F.col("p6_rows") == HOURLY_ROWS))


def critical_nulls(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a null among ``columns``, and which ones, in the order given."""
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda x: x.isNotNull())
    return rows.withColumn("missing", F.array_join(missing, ",")).where("missing <> ''")
