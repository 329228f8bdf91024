"""Health and progress figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcela.functions.strings import shown


def histogram(rows: DataFrame, column: str, boolean: bool = False, drop_null: bool = False) -> DataFrame:
    """Rows by value: (grp, value, n), a null shown as ``null`` or dropped."""
    rows = rows.where(F.col(column).isNotNull()) if drop_null else rows
    return rows.groupBy(shown(F.col(column), boolean).alias("value")).agg(F.count("*").alias("n")).select(F.lit(column).alias("grp"), "value", "n")


def histograms(rows: DataFrame, columns: dict[str, bool]) -> DataFrame:
    """Several histograms in one pass: each row is expanded to one pair a column before it is counted."""
    pairs = F.array(*[F.struct(F.lit(c).alias("grp"), shown(F.col(c), b).alias("value")) for c, b in columns.items()])
    return rows.select(F.explode(pairs).alias("p")).groupBy("p.grp", "p.value").agg(F.count("*").alias("n"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    each = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, each)


def null_audit(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls of each column, counted in one pass."""
    return rows.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def backfill_status(work: DataFrame) -> DataFrame:
    status = F.col("pdf_status")
    return work.agg(
        F.count("*").alias("total"),
        F.count_if(status == "pending").alias("pending"),
        F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "extracted").alias("extracted"),
    )


def summary_json(row: DataFrame) -> DataFrame:
    """Each row as one JSON text."""
    return row.select(F.to_json(F.struct(*row.columns)).alias("summary"))
