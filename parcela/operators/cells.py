"""Quality of hourly cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcela.functions.numbers import plausible


def jumps(rows: DataFrame, series: Sequence[str], order: str, value: str, most: float = 8.0) -> DataFrame:
    """Adds ``jump``: the value differs by more than ``most`` from each neighbour that has a value.

    Neighbours are the rows just before and after in the series. Without any, or without a value,
    there is no jump.
    """
    w = Window.partitionBy(*series).orderBy(order)
    v, before, after = F.col(value), F.lag(value).over(w), F.lead(value).over(w)
    far = lambda n: n.isNull() | (F.abs(v - n) > most)
    some = before.isNotNull() | after.isNotNull()
    return rows.withColumn("jump", v.isNotNull() & some & far(before) & far(after))


def flag(value: Column, jump: Column) -> Column:
    """none before range before jump before ok."""
    return F.when(value.isNull(), "none").when(~plausible(value), "range").when(jump, "jump").otherwise("ok")


def quality(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cells, and per cent with a value, plausible and flagged."""
    n = F.count("*")
    share = lambda c: F.round(100.0 * F.count_if(c) / n, 4)
    f = F.col("flag")
    figures = (n.alias("cells"), share(f != "none").alias("filled_pct"), share(f == "ok").alias("plausible_pct"), share(f != "ok").alias("flagged_pct"))
    return flagged.groupBy(*by).agg(*figures) if by else flagged.agg(*figures)


def worst(flagged: DataFrame, by: str, k: int = 8) -> DataFrame:
    """The ``k`` documents with most flagged cells, ties by id."""
    return flagged.groupBy(by).agg(F.count_if(F.col("flag") != "ok").alias("flagged")).orderBy(F.desc("flagged"), by).limit(k)


def accuracy(rows: DataFrame, got: Column, truth: Column, within: float = 0.05) -> DataFrame:
    """How many cells have the true value; a missing one is a miss."""
    hit = F.coalesce(F.abs(got - truth) < within, F.lit(False))
    return rows.agg(F.count("*").alias("cells"), F.count_if(hit).alias("hits"), F.round(F.avg(hit.cast("double")), 6).alias("accuracy"))
