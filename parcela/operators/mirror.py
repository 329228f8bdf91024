"""Writing rows to a remote mirror that knows searches, creations and updates of single rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcela.functions.dates import iso


class Client(Protocol):
    """A mirror's calls; each raises where the mirror refuses."""

    def search(self, table: str, key: str, value: object) -> object | None:
        """The mirror's own id of the row with this key, or None."""

    def create(self, table: str, row: dict) -> None: ...

    def update(self, table: str, ident: object, row: dict) -> None: ...


def serialised(rows: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO texts, all else as it is, without the mirror's own ``id``."""
    return rows.select(*[iso(F.col(f"`{c}`"), t).alias(c) for c, t in rows.dtypes if c != "id"])


def write(rows: DataFrame, table: str, key: str, connect: Callable[[], Client], sessions: int = 8) -> dict:
    """Creates or updates each row by its key; returns created, updated, remaining and the first error.

    A first session searches one row's key alone: a table that is missing or refuses gets this one call, and all its
    rows remain. Rows of one key meet in one session, so that a repeated key is created once and updated then. A session stops at
    its first failure, and what it had left counts as remaining. ``sessions`` tasks write at once. A task that is run
    again after a lost executor finds what it created and updates it. Only counts come back.
    """

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for value in b.column(0).to_pylist():
                try:
                    connect().search(table, key, value)
                except Exception as e:  # noqa: BLE001  the caller gets it as the table's error
                    yield pa.RecordBatch.from_arrays([pa.array([str(e)[:150]])], ["error"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        created = updated = remaining = 0
        error = None
        client = None
        for b in batches:
            for row in b.to_pylist():
                if error is not None:
                    remaining += 1
                    continue
                try:
                    client = client or connect()
                    ident = None if row[key] is None else client.search(table, key, row[key])
                    if ident is None:
                        client.create(table, row)
                        created += 1
                    else:
                        client.update(table, ident, row)
                        updated += 1
                except Exception as e:  # noqa: BLE001  one table's failure must not end the others
                    error, remaining = str(e)[:150], remaining + 1
        yield pa.RecordBatch.from_pylist([{"created": created, "updated": updated, "remaining": remaining, "error": error}], schema=arrow)

    arrow = pa.schema([("created", pa.int64()), ("updated", pa.int64()), ("remaining", pa.int64()), ("error", pa.string())])
    refused = serialised(rows).where(F.col(key).isNotNull()).select(key).limit(1).mapInArrow(probed, "error string").first()
    if refused is not None:
        return {"created": 0, "updated": 0, "remaining": rows.count(), "error": refused.error}
    sent = serialised(rows).repartition(sessions, key).sortWithinPartitions(key)
    counts = sent.mapInArrow(each, "created bigint, updated bigint, remaining bigint, error string")
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("created", "updated", "remaining")], F.min("error").alias("error"))
    return total.first().asDict()


def stamped(work: DataFrame, sent: DataFrame, results: dict[str, dict], now: Column, key: str = "eval_id") -> DataFrame:
    """``work`` with ``synced_at`` set for the reports ``sent``, if no table failed; else as it was, for the next run."""
    if any(r["error"] is not None for r in results.values()):
        return work
    marks = sent.select(key).distinct().withColumn("__sent", F.lit(True))
    joined = work.join(marks, key, "left")
    return joined.withColumn("synced_at", F.when(F.col("__sent"), now.cast(dict(work.dtypes)["synced_at"])).otherwise(F.col("synced_at"))).select(*work.columns)


def sync(work: DataFrame, tables: dict[str, tuple[DataFrame, str]], sent: DataFrame, connect: Callable[[], Client], now: Column, key: str = "eval_id", sessions: int = 8) -> tuple[DataFrame, dict[str, dict]]:
    """Mirrors the rows of the reports ``sent`` in each of ``tables`` (rows and their mirror key); the work with its stamps, and figures."""
    ids = sent.select(key).distinct()
    results = {name: write(df.join(ids, key, "left_semi"), name, mirror_key, connect, sessions) for name, (df, mirror_key) in tables.items()}
    return stamped(work, sent, results, now, key), results
