"""The directory of listed reports: what is new, refreshed, gone, or still to be crawled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def new_rows(found: DataFrame, known: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``found`` whose key is unknown."""
    return found.join(known.select(*key), list(key), "left_anti")


def placed(reports: DataFrame, communes: DataFrame, regions: DataFrame) -> DataFrame:
    """Reports with the names of their commune and region; unknown ones are null.

    The optimizer sees the sizes of both lookups and broadcasts them while they are small.
    """
    return reports.join(communes, "comuna_id", "left").join(regions, "region_id", "left")


def insert_absent(known: DataFrame, seed: DataFrame, key: Sequence[str]) -> DataFrame:
    """``known`` with those rows of ``seed`` that it lacks."""
    return known.unionByName(new_rows(seed, known, key))


def last_wins(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the last by ``order``, which must be total."""
    w = Window.partitionBy(*key).orderBy(*[c.desc() for c in order])
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def fresh_rows(found: DataFrame, known: DataFrame, key: Sequence[str], unit: Sequence[str]) -> DataFrame:
    """How many rows of ``found`` each unit had not listed before, as ``fresh``; a key that stands in several rows is one."""
    once = new_rows(found.select(*unit, *key).distinct(), known, key)
    return once.groupBy(*unit).agg(F.count("*").cast("int").alias("fresh"))


def upsert(known: DataFrame, found: DataFrame, key: str, summary: Sequence[str], state: Sequence[str], seen_at: Column) -> DataFrame:
    """``known`` merged with ``found``: summary columns refreshed, state columns kept, new rows pending.

    Adds ``change``: inserted, refreshed or kept. ``known`` must have the columns ``pdf_status``
    among ``state`` and ``last_seen_at``.
    """
    k = known.select(F.col(key), *[F.col(c).alias(f"k_{c}") for c in (*summary, *state, "last_seen_at")], F.lit(True).alias("__k"))
    f = found.select(F.col(key), *[F.col(c).alias(f"f_{c}") for c in summary], F.lit(True).alias("__f"))
    both = k.join(f, key, "full_outer")
    fresh, old = F.col("__f").isNotNull(), F.col("__k").isNotNull()
    out = [F.col(key)]
    out += [F.when(fresh, F.col(f"f_{c}")).otherwise(F.col(f"k_{c}")).alias(c) for c in summary]
    out += [F.when(old, F.col(f"k_{c}")).otherwise(F.lit("pending" if c == "pdf_status" else None)).alias(c) for c in state]
    out += [F.when(fresh, seen_at).otherwise(F.col("k_last_seen_at")).alias("last_seen_at")]
    out += [F.when(~old, "inserted").when(fresh, "refreshed").otherwise("kept").alias("change")]
    return both.select(*out)


def changed(known: DataFrame, found: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys of ``found`` that are new or differ in ``columns``, with ``change``."""
    k = known.select(F.col(key).alias("__key"), *[F.col(c).alias(f"k_{c}") for c in columns])
    both = found.join(k, F.col(key) == F.col("__key"), "left")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"k_{c}"))
    change = F.when(F.col("__key").isNull(), "inserted").when(~same, "updated")
    return both.select(key, *columns, change.alias("change")).where("change is not null")


def early_stop(pages: DataFrame, unit: Sequence[str], order: str, grace: int = 2, rows: str = "n_rows", new: str = "n_new", reverse: bool = False) -> DataFrame:
    """The pages of each unit that an incremental crawl visits before it stops early.

    It stops at the first page that ends ``grace`` consecutive ones with rows but nothing new. Pages
    without rows neither count nor interrupt. ``reverse`` visits the last page first, as new reports are on the last
    pages. Adds ``early_stopped`` to each page of a unit.
    """
    if reverse:
        back = pages.withColumn("__visit", -F.col(order))
        return early_stop(back, unit, "__visit", grace, rows, new).drop("__visit")
    by = Window.partitionBy(*unit).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = pages.where(F.col(rows) > 0).withColumn("__isle", F.sum((F.col(new) > 0).cast("int")).over(by))
    run = Window.partitionBy(*unit, "__isle").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    dry = filled.withColumn("__dry", F.sum((F.col(new) == 0).cast("int")).over(run))
    stop = dry.where(F.col("__dry") == grace).groupBy(*unit).agg(F.min(order).alias("__stop"))
    joined = pages.join(stop, list(unit), "left")
    return joined.where(F.col("__stop").isNull() | (F.col(order) <= F.col("__stop"))).withColumn("early_stopped", F.col("__stop").isNotNull()).drop("__stop")


def resume_plan(units: DataFrame, progress: DataFrame, key: Sequence[str], incremental: bool = False) -> DataFrame:
    """Units still to be crawled and the page to begin with; an incremental crawl visits all from page 1."""
    if incremental:
        return units.select(*key).withColumn("start_page", F.lit(1).cast("bigint"))
    joined = units.select(*key).join(progress.select(*key, "status", "pages_done"), list(key), "left")
    todo = joined.where(F.col("status").isNull() | (F.col("status") != "done"))
    return todo.select(*key, (F.coalesce("pages_done", F.lit(0)) + 1).cast("bigint").alias("start_page"))


def saved_progress(progress: DataFrame, units: DataFrame, key: Sequence[str], now: Column) -> DataFrame:
    """``progress`` with the rows of ``units`` in the place of those of the same unit, stamped ``now``.

    A unit that failed before it had a page keeps the pages that an earlier run had done. Units must be
    distinct; columns that ``units`` lacks are null in new rows and stay in others.
    """
    kept = [c for c in progress.columns if c not in (*key, "updated_at")]
    old = progress.select(*key, *[F.col(c).alias(f"o_{c}") for c in kept], F.col("updated_at").alias("o_updated_at"))
    new = units.select(*key, *[F.col(c).alias(f"n_{c}") for c in kept if c in units.columns], F.lit(True).alias("__new"))
    both = old.join(new, list(key), "full_outer")
    fresh = F.col("__new").isNotNull()

    def value(c: str) -> Column:
        if c not in units.columns:
            return F.col(f"o_{c}")
        found = F.col(f"n_{c}")
        if c in ("pages_done", "total_pages"):
            found = F.when(F.col("n_last_error").isNotNull(), F.greatest(found, F.col(f"o_{c}"))).otherwise(found)
        return F.when(fresh, found).otherwise(F.col(f"o_{c}"))

    stamp = F.when(fresh, now.cast(dict(progress.dtypes)["updated_at"])).otherwise(F.col("o_updated_at"))
    out = both.select(*key, *[value(c).alias(c) for c in kept], stamp.alias("updated_at"))
    return out.select(*progress.columns)


def rollup_discovery(units: DataFrame, by: str = "region_id") -> DataFrame:
    """New rows, failed units and units by region, and in all (null region)."""
    return units.rollup(by).agg(F.sum("rows_new").cast("bigint").alias("rows_new"), F.count_if(F.col("last_error").isNotNull()).alias("errors"), F.count("*").alias("units"))


def stale(directory: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows that the latest crawl of their unit did not see."""
    newest = directory.groupBy(*by).agg(F.max("last_seen_at").alias("newest"))
    return directory.join(newest, list(by)).where("last_seen_at < newest")


def orphans(files: DataFrame, now: Column, days: int) -> DataFrame:
    """Files that were last touched before ``days`` days ago; 0 means all before now."""
    return files.where(F.col("modified_at") < now - F.expr(f"make_dt_interval({days})"))


def freed_mb(files: DataFrame, size: str = "length") -> DataFrame:
    return files.agg(F.count("*").alias("removed"), F.round(F.coalesce(F.sum(size), F.lit(0)) / 1048576.0, 1).alias("freed_mb"))
