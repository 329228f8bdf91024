"""Incremental ingest of listing pages into the directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcela.functions.strings import listing_id
from parcela.operators import directory

from .store import Store, Table, Version


class VersionedTable:
    """A table of its own store, in buckets of its key, of which a write replaces those that it touches.

    Each version notes the batch that made it. A batch that is run again after a failure writes
    again from the version that it was based on, so nothing is counted twice.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "eval_id", buckets: int = 32) -> None:
        self.store = Store(spark, path, {"rows": Table(schema, key, buckets)})
        self.schema = schema

    def bucket(self, column: str | None = None) -> Column:
        return self.store.bucket("rows", column)

    def read(self, only: set[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        return self.store.read("rows", only)

    @staticmethod
    def _batch(at: Version) -> int:
        return int(at.notes.get("batch", "-1"))

    def last_batch(self) -> int:
        return self._batch(self.store.version())

    def write(self, df: DataFrame, batch: int, touched: set[int] | None = None) -> None:
        """``df`` in the place of all rows, or of those of the buckets ``touched``."""
        at = self.store.version()
        self.store.commit(at, {"rows": self.store.aside("rows", df, touched)}, {"batch": str(batch)})

    def merge(self, batch: int, make: Callable[[Callable[[set[int]], DataFrame]], tuple[DataFrame, set[int]]]) -> None:
        """Replaces buckets by what ``make`` gives, once for each batch; ``make`` reads buckets of the version that it changes."""

        def changes(at: Version) -> tuple[dict, None]:
            if batch <= self._batch(at):
                return {}, None
            rows, touched = make(lambda only: self.store.read("rows", only, at))
            return {"rows": self.store.aside("rows", rows, touched)}, None

        self.store.change(changes, lambda at: {"batch": str(batch)})


SUMMARY = ("comuna_id", "tipo", "identificacion", "tipologia")
STATE = ("pdf_status", "retry_count", "synced_at")
DIRECTORY = "eval_id string, comuna_id int, tipo int, identificacion string, tipologia string, pdf_status string, retry_count bigint, synced_at timestamp, last_seen_at timestamp"


def keyed(rows: DataFrame) -> DataFrame:
    """Grid rows (comuna_id, region_id, tipo, identificacion, tipologia) with their lasting id."""
    return rows.withColumn("eval_id", listing_id(F.col("comuna_id"), F.col("region_id"), F.col("tipo"), F.col("identificacion")))


def merge_batch(table: VersionedTable, rows: DataFrame, batch: int, seen_at: str) -> None:
    """Upserts one batch of grid rows; a batch that was merged already is skipped."""

    def make(read: Callable[[set[int]], DataFrame]) -> tuple[DataFrame, set[int]]:
        one = directory.last_wins(keyed(rows), ["eval_id"], [F.col("page_no"), F.col("row_no")])
        touched = {r[0] for r in one.select(table.bucket()).distinct().collect()}  # as many as there are buckets, at most
        merged = directory.upsert(read(touched), one.select("eval_id", *SUMMARY), "eval_id", list(SUMMARY), list(STATE), F.lit(seen_at).cast("timestamp"))
        return merged.drop("change"), touched

    table.merge(batch, make)


def ingest(spark: SparkSession, folder: str, schema: str, table: VersionedTable, checkpoint: str, seen_at: str) -> StreamingQuery:
    """Merges all grid files that have arrived since the last run, then stops.

    The checkpoint remembers files, and the table its last batch, so that a run repeated after a
    failure neither misses nor doubles any.
    """
    stream = spark.readStream.schema(schema).parquet(folder)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(lambda df, n: merge_batch(table, df, n, seen_at)).start()
