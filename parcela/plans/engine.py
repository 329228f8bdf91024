"""The engine's own steps over its stored tables, for the daily and backfill chains."""

from __future__ import annotations

import random
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela import schemas
from parcela.operators import directory, mirror, persist, work
from parcela.sources import listing
from parcela.storage import stored
from parcela.streaming import ingest
from parcela.streaming.store import Change, Store, Table, Version

from . import report
from .daily import Settings, Steps

#: The directory with what its reports' states need.
DIRECTORY = (
    "eval_id string, comuna_id int, region_id int, tipo int, identificacion string, tipologia string, proyecto string, calificacion_energetica string, "
    "calificacion_equipos string, codigo_informe string, codigo_etiqueta string, pdf_status string, report_version int, retry_count bigint, last_error string, "
    "processed_at timestamp, synced_at timestamp, last_seen_at timestamp"
)
STATE = ("pdf_status", "report_version", "retry_count", "last_error", "processed_at", "synced_at")
SUMMARY = tuple(c for c in (x.split()[0] for x in DIRECTORY.split(", ")) if c not in (*STATE, "eval_id", "last_seen_at"))
PROGRESS = schemas.PROGRESS.replace("tipo_evaluacion_id", "tipo")
COMMUNES = "comuna_id int, comuna_nombre string, region_id int"
UNIT = ("comuna_id", "tipo")
KEY = "eval_id"


@dataclass
class Extraction:
    """What reading reports gave.

    ``outcomes`` has (eval_id, page_count, extract_error), ``spans`` the text of their pages as ``schemas.LAYOUT_SPANS`` with eval_id
    for doc_id, and ``cells`` the hourly lists that ``report.hourly_page`` takes.
    """

    outcomes: DataFrame
    spans: DataFrame
    cells: DataFrame | None = None


def tables(spark: SparkSession) -> dict[str, Table]:
    """The engine's stored tables: reports, progress, communes, and the eight of the reports' pages."""
    none = spark.createDataFrame([], schemas.LAYOUT_SPANS).withColumnRenamed("doc_id", KEY)
    pages = {name: Table(df.schema) for name, df in report.tables_of(report.box_texts(none, KEY), none, KEY).items()}
    return {"reports": Table(DIRECTORY), "progress": Table(PROGRESS, "comuna_id", 8), "communes": Table(COMMUNES, "comuna_id", 1), **pages}


@dataclass
class Engine:
    """The directory, the crawl's progress and the pages of reports as one store below ``path``, and steps over it.

    ``communes`` has (comuna_id, region_id), or those and comuna_nombre: what the store begins with; ``regions`` gives the page of a region, whose list
    of communes is then kept up to date. ``extract`` takes pending reports and gives an ``Extraction``, or just outcomes that say
    ``valid`` too; ``connect`` opens the mirror, which gets ``dimensions`` (rows and their key) as well; ``source`` holds the stored pages. Each step
    commits all tables that it changes as one version: a step that ends anywhere leaves them as they were or as
    they should be, and is run again.
    """

    spark: SparkSession
    path: str
    source: str
    communes: DataFrame
    extract: Callable[[DataFrame], DataFrame | Extraction]
    connect: Callable[[], mirror.Client]
    now: str
    settings: Settings = field(default_factory=Settings)
    files: Callable[[], DataFrame] | None = None
    remove: Callable[[DataFrame], None] | None = None
    regions: Callable[[int], str] | None = None
    dimensions: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        listing.register(self.spark)
        self.store = Store(self.spark, f"{self.path.rstrip('/')}/store", tables(self.spark))
        given = self.communes
        if "comuna_nombre" not in given.columns:
            given = given.withColumn("comuna_nombre", F.lit(None).cast("string"))
        seed = given.select("comuna_id", "comuna_nombre", "region_id")

        def begun(at: Version) -> tuple[dict[str, Change], None]:
            known = self.store.read("communes", at=at)
            if directory.new_rows(seed, known, ["comuna_id"]).isEmpty():
                return {}, None
            return {"communes": self.store.aside("communes", directory.insert_absent(known, seed, ["comuna_id"]))}, None

        self.store.change(begun)

    def read(self, table: str) -> DataFrame:
        """The last version of a stored table."""
        return self.store.read(table)

    def _stamp(self):
        return F.lit(self.now).cast("timestamp")

    def _region(self, region: int | None) -> DataFrame | None:
        return None if region is None else self.read("communes").where(F.col("region_id") == region)

    def sync_communes(self, region: int) -> int:
        """Takes new communes, and new names and regions of known ones, from the region's page; how many changed."""
        if self.regions is None:
            return 0
        # The list of a region has some tens of communes.
        found = self.spark.createDataFrame([(i, name, region) for i, name in listing.options(self.regions(region))], COMMUNES)

        def make(at: Version) -> tuple[dict[str, Change], int]:
            known = self.store.read("communes", at=at)
            changes = stored(directory.changed(known, found, "comuna_id", ["comuna_nombre", "region_id"]).drop("change"), "changes")
            n = changes.count()
            return ({"communes": self.store.aside("communes", persist.replace_by_key(known, changes, ["comuna_id"]))} if n else {}), n

        return self.store.change(make)

    def _merged(self, rows: DataFrame, at: Version) -> tuple[dict[str, Change], DataFrame]:
        """The reports with listed ``rows`` upserted, and how many of them each unit had not listed before."""
        one = stored(directory.last_wins(ingest.keyed(rows), [KEY], [F.col("page_no"), F.col("row_no")]), "listed")
        touched = self.store.buckets_of("reports", one)
        known = self.store.read("reports", touched, at)
        fresh = directory.fresh_rows(one, known, [KEY], UNIT)
        if not touched:
            return {}, fresh
        merged = directory.upsert(known, one.select(KEY, *SUMMARY), KEY, list(SUMMARY), list(STATE), self._stamp())
        return {"reports": self.store.aside("reports", merged.select(*known.columns), touched)}, fresh

    def discover(self, region: int, kinds: tuple[int, ...] = (1, 2), incremental: bool = True, resume: bool = False, most: int | None = None) -> dict:
        """Crawls a region's units, each in a task, and merges what they found; a failed unit keeps its error.

        An incremental crawl reads from the last page back and stops early; it takes all units, whatever ``resume`` says, as a finished unit
        may have new reports. A full one reads on from page 1, and its rows and progress are stored
        some pages at a time; with ``resume`` it leaves out finished units and goes on behind the last page that was done.
        """
        self.sync_communes(region)
        of_region = self._region(region).select("comuna_id", "region_id")
        units = of_region.select("comuna_id", "region_id", F.explode(F.array(*[F.lit(k) for k in kinds])).alias("tipo"))
        if incremental:
            done = self._crawl_back(units, most)
        else:
            plan = directory.resume_plan(units, self.read("progress"), list(UNIT)) if resume else directory.resume_plan(units, self.read("progress"), list(UNIT), True)
            done = self._crawl_on(units, plan, most)
        total = directory.rollup_discovery(done).where("region_id is null").first()
        if total is None:  # no units were left
            return {"rows_new": 0, "errors": 0, "units": 0}
        return {"rows_new": int(total.rows_new or 0), "errors": int(total.errors), "units": int(total.units)}

    def _crawl_back(self, units: DataFrame, most: int | None) -> DataFrame:
        known = self.read("reports").groupBy(*UNIT).agg(F.collect_set("identificacion").alias("known"))
        asked = units.join(known, list(UNIT), "left").select("*", F.lit(1).alias("first"), F.lit(True).alias("incremental"))
        seen = stored(listing.crawled(asked, self._transport(), self.settings.grace_pages, most), "crawl")
        rows = listing.found_rows(seen).join(units, list(UNIT))

        def make(at: Version) -> tuple[dict[str, Change], DataFrame]:
            changes, fresh = self._merged(rows, at)
            done = listing.progress_of(seen).join(units, list(UNIT)).join(fresh, list(UNIT), "left")
            done = done.withColumn("rows_new", F.coalesce("fresh", F.lit(0))).drop("fresh")
            saved = directory.saved_progress(self.store.read("progress", at=at), done, list(UNIT), self._stamp())
            return {**changes, "progress": self.store.aside("progress", saved)}, stored(done, "done")

        return self.store.change(make)

    def _transport(self) -> Callable[[], listing.Transport]:
        source = self.source
        return lambda: listing.StoredPages(source)

    def _crawl_on(self, units: DataFrame, plan: DataFrame, most: int | None) -> DataFrame:
        """A stream over the pages of ``plan``: each batch commits its rows and its units' progress together."""
        # A region has some hundred units at most.
        todo = [f"{r.comuna_id}:{r.tipo}:{r.start_page}" for r in plan.collect()]
        mine = stored(plan.join(units, list(UNIT)).withColumn("start_page", F.col("start_page").cast("int")), "plan")

        def begun(at: Version) -> tuple[dict[str, Change], None]:
            clear = mine.select(*UNIT, "region_id", F.lit("pending").alias("status"), (F.col("start_page") - 1).alias("pages_done"), F.lit(None).cast("int").alias("total_pages"), F.lit(0).alias("rows_new"), F.lit(0).alias("rows_seen"), F.lit(False).alias("early_stopped"), F.lit(None).cast("string").alias("last_error"))
            saved = directory.saved_progress(self.store.read("progress", at=at), clear, list(UNIT), self._stamp())
            return {"progress": self.store.aside("progress", saved)}, None

        if todo:
            self.store.change(begun)
            run = uuid.uuid4().hex
            stream = self.spark.readStream.format("listing").option("path", self.source).option("units", ",".join(todo)).option("pages", str(self.settings.pages_at_once))
            stream = stream.option("most", str(most)) if most else stream
            writer = stream.load().writeStream.option("checkpointLocation", f"{self.path.rstrip('/')}/crawls/{run}")
            query = writer.foreachBatch(lambda df, n: self._stored_pages(units, df, f"{run} {n}")).start()
            try:
                query.processAllAvailable()
            finally:
                query.stop()
        return self.read("progress").join(mine.select(*UNIT), list(UNIT), "left_semi")

    def _stored_pages(self, units: DataFrame, pages: DataFrame, batch: str) -> None:
        """Commits one batch of a crawl's pages, once. A unit's progress ends before the first page that failed."""
        seen = stored(pages, "pages")
        rows = listing.found_rows(seen).join(units, list(UNIT))

        def make(at: Version) -> tuple[dict[str, Change], None]:
            run, n = batch.split()
            noted = at.notes.get("crawl", "- -1").split()
            if noted[0] == run and int(n) <= int(noted[1]):
                return {}, None
            changes, fresh = self._merged(rows, at)
            before = self.store.read("progress", at=at)
            made = listing.progress_of(seen, "page_no").join(before.select(*UNIT, F.col("pages_done").alias("p_done"), F.col("rows_new").alias("p_new"), F.col("rows_seen").alias("p_seen")), list(UNIT))
            last = F.max_by(F.struct("status", "pages_done", "total_pages", "last_error"), "page_no")
            of_unit = made.groupBy(*UNIT, "p_done", "p_new", "p_seen").agg(F.min("page_no").alias("begin"), last.alias("last"), F.sum("rows_seen").alias("seen"))
            of_unit = of_unit.where("begin = p_done + 1").join(fresh, list(UNIT), "left")
            done = of_unit.select(*UNIT, "last.*", (F.coalesce("p_new", F.lit(0)) + F.coalesce("fresh", F.lit(0))).cast("int").alias("rows_new"), (F.coalesce("p_seen", F.lit(0)) + F.col("seen")).cast("int").alias("rows_seen"), F.lit(False).alias("early_stopped"))
            done = done.join(units, list(UNIT))
            return {**changes, "progress": self.store.aside("progress", directory.saved_progress(before, done, list(UNIT), self._stamp()))}, None

        self.store.change(make, lambda at: {"crawl": batch})

    def pending(self) -> int:
        return work.pending(self.read("reports")).count()

    def drain(self, limit: int | None = None, region: int | None = None) -> dict:
        """Extracts pending reports, of a region or all, drawn at random if there are more than ``limit``.

        The tables of their pages and their new states are one version. A report without an outcome stays pending.
        """
        seed = random.getrandbits(63) if self.settings.seed is None else self.settings.seed
        chosen = stored(work.pending(self.read("reports"), self._region(region), limit, work.random_order(seed)), "chosen")
        outcomes, pages = self._extracted(chosen)
        moved = stored(work.transition(chosen, outcomes), "moved")
        done = moved.where("new_status = 'extracted'").select(KEY)
        pages = {name: df.join(done, KEY, "left_semi") for name, df in pages.items()}

        def make(at: Version) -> tuple[dict[str, Change], None]:
            touched = self.store.buckets_of("reports", moved)
            if not touched:
                return {}, None
            left = self.store.read("reports", touched, at)
            both = left.join(moved, KEY, "left")
            # Another drain may have taken a report meanwhile.
            fresh = F.coalesce((F.col("pdf_status") == "pending") & (F.col("new_status") != "error"), F.lit(False))
            version = F.when(F.col("new_status") == "extracted", 2).when(F.col("new_status") == "skipped_v1", 1).otherwise(F.col("report_version"))
            at_end = F.when(F.col("new_status") == "failed", F.col("processed_at")).otherwise(self._stamp())
            now = {"pdf_status": F.col("new_status"), "report_version": version, "retry_count": F.col("new_retry_count"), "last_error": F.col("new_error"), "processed_at": at_end}
            after = both.select(*[F.when(fresh, now[c]).otherwise(F.col(c)).alias(c) if c in now else F.col(c) for c in left.columns])
            changes = {"reports": self.store.aside("reports", after, touched)}
            mine = self.store.buckets_of("reports", done)
            for name, df in pages.items():
                # All page tables have as many buckets as the reports, of the same key.
                if mine:
                    kept = self.store.read(name, mine, at)
                    changes[name] = self.store.aside(name, persist.replace_by_key(kept, df.select(*kept.columns), [KEY], done), mine)
            return changes, None

        self.store.change(make)
        return work.drain_summary(moved).first().asDict()

    def _extracted(self, chosen: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
        """Outcomes of ``chosen`` with ``valid``, and the tables of the pages of those that could be read."""
        got = self.extract(chosen)
        if isinstance(got, DataFrame):
            return stored(got, "outcomes"), {}
        outcomes = stored(got.outcomes, "outcomes")
        read = outcomes.where((work.version_of(F.col("page_count")) == 2) & F.col("extract_error").isNull()).select(KEY)
        cells = None if got.cells is None else got.cells.join(read, KEY, "left_semi")
        spans = stored(got.spans.join(read, KEY, "left_semi"), "spans")
        pages = {name: stored(df, name) for name, df in report.extract(spans, KEY, cells).items()}
        valid = report.validated(pages, KEY).select(KEY, F.col("ok").alias("valid"))
        return outcomes.join(valid, KEY, "left"), pages

    def retry(self, cap: int | None = None, region: int | None = None, limit: int | None = None) -> dict:
        """Makes failed reports with fewer than ``cap`` retries pending again, ``limit`` at most, and drains."""
        cap = self.settings.retry_cap if cap is None else cap

        def make(at: Version) -> tuple[dict[str, Change], int]:
            failed = work.in_region(work.retryable(self.store.read("reports", at=at), cap), self._region(region))
            again = stored((failed.orderBy(*work.random_order(0)).limit(limit) if limit else failed).select(KEY), "again")
            touched = self.store.buckets_of("reports", again)
            if not touched:
                return {}, 0
            left = self.store.read("reports", touched, at)
            after = left.join(again, KEY, "left_anti").unionByName(left.join(again, KEY, "left_semi").withColumn("pdf_status", F.lit("pending")))
            return {"reports": self.store.aside("reports", after, touched)}, again.count()

        n = self.store.change(make)
        return {"reactivated": n, "max_retries": cap, "drain": self.drain(limit, region)}

    def mirror(self, more: dict[str, tuple[DataFrame, str]] | None = None, limit: int | None = None, full: bool = False) -> dict:
        """Sends the dimensions whole; of reports and their pages those that were never mirrored, or processed since, or all.

        Reports are stamped if none of their tables failed, else they are sent again the next time.
        """
        results = {name: mirror.write(df, name, key, self.connect) for name, (df, key) in {"comunas": (self.read("communes"), "comuna_id"), **self.dimensions}.items()}
        at = self.store.version()
        every = self.store.read("reports", at=at)
        sent = stored(persist.mirror_delta(every, full, limit, refreshed=True), "sent")
        if sent.isEmpty():
            return results
        ids = sent.select(KEY)
        detail = {"evaluaciones": (sent, KEY)}
        for name, parts in persist.MIRROR_KEYS.items():
            rows = self.store.read(name, at=at).join(ids, KEY, "left_semi")
            detail[f"informe_v2_{name}"] = (rows, KEY) if parts == (KEY,) else (persist.with_mirror_key(rows, parts), "mirror_key")
        found = {name: mirror.write(df.join(ids, KEY, "left_semi"), name, key, self.connect) for name, (df, key) in {**detail, **(more or {})}.items()}

        def make(now: Version) -> tuple[dict[str, Change], None]:
            touched = self.store.buckets_of("reports", ids)
            part = self.store.read("reports", touched, now)
            after = mirror.stamped(part, ids, found, self._stamp())
            return ({} if after is part else {"reports": self.store.aside("reports", after, touched)}), None

        self.store.change(make)
        return {**results, **found}

    def cleanup(self) -> dict:
        """Removes files that are older than the settings say; the files and their removal are the user's."""
        if self.files is None or self.remove is None:
            return {}
        old = stored(directory.orphans(self.files(), self._stamp(), self.settings.temp_days), "old")
        found = directory.freed_mb(old).first().asDict()
        self.remove(old)
        return found

    def steps(self) -> Steps:
        return Steps(self.discover, self.pending, self.drain, self.mirror, self.cleanup)
