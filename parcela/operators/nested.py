"""Lists of page values as rows, and rows as reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The months of the hourly page.
HOURLY_MONTHS = ("enero", "abril", "julio", "octubre")


def zip_rows(rows: DataFrame, key: Sequence[str], lists: Sequence[str]) -> DataFrame:
    """A row per place of the longest list, shorter ones ending in nulls; adds ``pos``."""
    zipped = F.arrays_zip(*[F.coalesce(F.col(c), F.array().cast(dict(rows.dtypes)[c])).alias(c) for c in lists])
    out = rows.select(*key, F.posexplode(zipped).alias("pos", "v"))
    return out.select(*key, "pos", *[F.col(f"v.{c}").alias(c) for c in lists])


def pad(c: Column, n: int, kind: str) -> Column:
    """Exactly ``n`` values: cut, or filled with nulls at the end."""
    empty = F.array_repeat(F.lit(None).cast(kind), n)
    return F.slice(F.concat(F.coalesce(c, F.expr(f"cast(array() as array<{kind}>)")), empty), 1, n)


def drop_places(c: Column, places: Sequence[int]) -> Column:
    """A list without the values at these places, counted from 0."""
    return F.filter(c, lambda x, i: ~i.isin(list(places)))


def framed(c: Column, before: int, after: int, kind: str) -> Column:
    """A list with nulls before and after it."""
    null = lambda n: F.array_repeat(F.lit(None).cast(kind), n)
    return F.concat(null(before), c, null(after))


def last_n(c: Column, n: int) -> Column:
    return F.when(F.size(c) < n, c).otherwise(F.slice(c, -n, n))


def hourly(rows: DataFrame, key: Sequence[str], outer: str, inner: str, hours: int = 24) -> DataFrame:
    """Two lists of hourly values as rows of hour 0 to 23; a missing list gives nulls."""
    lists = F.arrays_zip(pad(F.col(outer), hours, "double").alias("outer"), pad(F.col(inner), hours, "double").alias("inner"))
    return rows.select(*key, F.posexplode(lists).alias("hour", "v")).select(*key, "hour", F.col("v.outer").alias("outer"), F.col("v.inner").alias("inner"))


def wide_to_long(rows: DataFrame, key: Sequence[str], metrics: Sequence[str], periods: int, pattern: str = "{metric}_mes_{k}") -> DataFrame:
    """Columns of one metric and month each as a row a month, a column a metric. No shuffle is needed."""
    months = [F.struct(F.lit(k).alias("mes_id"), *[F.col(pattern.format(metric=m, k=k)).alias(m) for m in metrics]) for k in range(1, periods + 1)]
    return rows.select(*key, F.explode(F.array(*months)).alias("m")).select(*key, "m.*")


def two_periods(rows: DataFrame, key: Sequence[str], period: str, values: Sequence, names: Sequence[str], value: str) -> DataFrame:
    """One column a period; the periods are given, so that no pass is needed to find them."""
    out = rows.groupBy(*key).pivot(period, list(values)).agg(F.sum(value))
    return out.select(*key, *[F.col(f"`{v}`").alias(n) for v, n in zip(values, names, strict=True)])


def assembled(heads: DataFrame, details: DataFrame, key: str, order: Sequence[str], name: str = "rows") -> DataFrame:
    """Each head with its details as an ordered array of structs; empty if it has none."""
    rest = [c for c in details.columns if c != key and c not in order]
    lists = details.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name))
    out = heads.join(lists, key, "left")
    return out.withColumn(name, F.coalesce(name, F.array().cast(dict(lists.dtypes)[name])))
