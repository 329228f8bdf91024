"""The engine's steps over its store: crawls, drains, retries, mirrors, and what a crash leaves of them."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parcela.plans import daily, engine, report
from parcela.sources import listing

from .test_sources import page

COMMUNES = [(5, 1), (6, 1), (7, 2)]


class Memory:
    """A mirror in files, as sessions are other processes; refuses the tables whose names are in its file ``refuse``."""

    def __init__(self, folder):
        self.folder = folder

    def search(self, table, key, value):
        refused = self.folder / "refuse"
        if refused.exists() and table in refused.read_text().split():
            raise RuntimeError("no such table")
        path = self.folder / f"{table}_{value}.json"
        return str(path) if path.exists() else None

    def create(self, table, row):
        key = row.get("mirror_key") or row.get("eval_id") or row.get("comuna_id")
        (self.folder / f"{table}_{key}.json").write_text(json.dumps(row))

    def update(self, table, ident, row):
        Path(ident).write_text(json.dumps(row | {"updated": True}))


class Site:
    def __init__(self, folder):
        self.folder = folder
        folder.mkdir()

    def put(self, comuna, tipo, number, ids, total):
        (self.folder / f"{comuna}_{tipo}_{number}.html").write_text(page(ids, total, tipo), encoding="utf-8")

    def fill(self, comuna, tipo, n):
        for k in range(0, n, 10):
            self.put(comuna, tipo, k // 10 + 1, [f"v{comuna}_{i}" for i in range(k, min(n, k + 10))], n)


def outcomes(chosen):
    """Outcomes alone, by the same names; they are much quicker than pages."""
    return extraction(chosen).outcomes.withColumn("valid", F.lit(True))


def extraction(chosen):
    """Reports read as their identification says: ``old``, ``odd`` and ``bad`` ones, and those with a code on seven pages."""
    ident = F.col("identificacion")
    pages = F.when(ident.contains("old"), 4).when(ident.contains("odd"), 9).otherwise(7)
    outcomes = chosen.select("eval_id", pages.alias("page_count"), F.when(ident.contains("bad"), "boom").alias("extract_error"))
    each = chosen.select("eval_id", "identificacion", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("page_no"))
    each = each.where(~(ident.contains("empty") & (F.col("page_no") == 1)))
    spans = each.selectExpr("eval_id", "page_no", "215.9D as page_w", "330.0D as page_h", "70.0D as x0", "if(page_no = 1, 21D, 32D) as y0", "80.0D as x1", "if(page_no = 1, 23D, 34D) as y1", "10.0D as font_size", "identificacion as text")
    return engine.Extraction(outcomes, spans)


@pytest.fixture()
def made(spark, tmp_path):
    site = Site(tmp_path / "site")
    (tmp_path / "mirror").mkdir()
    folder = tmp_path / "mirror"

    def make(extract=extraction, **options):
        settings = daily.Settings(regions=(1, 2), seed=3, pages_at_once=2)
        return engine.Engine(spark, str(tmp_path / "store"), str(site.folder), spark.createDataFrame(COMMUNES, "comuna_id int, region_id int"), extract, lambda: Memory(folder), "2024-01-01", settings, **options)

    return site, make


def states(e):
    return {r.identificacion: (r.pdf_status, r.report_version, r.retry_count, r.last_error, str(r.processed_at)[:10]) for r in e.read("reports").collect()}


def counts(e):
    return {name: e.read(name).count() for name in report.TABLES}


def whole(e):
    """All stored rows but for when they were stored."""
    return {name: sorted(map(str, e.read(name).collect())) for name in e.store.tables}


def test_two_days(made):
    """The second sees only what is new, a failed unit keeps its error, and the mirror's stamp waits for success."""
    site, make = made
    outcome = lambda df: df.select("eval_id", F.lit(7).alias("page_count"), F.when(F.col("identificacion") == "v5_3", "boom").alias("extract_error"), F.lit(True).alias("valid"))
    e = make(outcome)
    site.fill(5, 1, 12)
    (site.folder / "6_1_1.html").write_bytes(b"\xff\xfe broken")
    out = daily.daily(e.steps(), e.settings)
    assert out["discovery"]["regions"][1] == {"rows_new": 12, "errors": 1, "units": 4} and out["pending"] == 12
    assert out["drain"] == {"selected": 12, "extracted": 11, "skipped": 0, "failed": 1}
    assert out["mirror"]["evaluaciones"]["created"] == 12 and out["mirror"]["comunas"]["created"] == 3 and out["cleanup"] == {}
    assert [(r.comuna_id, r.tipo, r.status) for r in e.read("progress").where("last_error is not null").collect()] == [(6, 1, "pending")]
    site.fill(5, 1, 13)
    site.put(6, 1, 1, ["b1"], 1)
    e.now = "2024-01-02"
    out = daily.daily(e.steps(), e.settings)
    assert out["discovery"]["rows_new"] == 2 and out["pending"] == 2
    # What failed was not processed, so it is not sent again.
    assert out["mirror"]["evaluaciones"] == {"created": 2, "updated": 0, "remaining": 0, "error": None}
    assert e.read("reports").count() == 14 and e.read("progress").where("last_error is not null").count() == 0
    assert e.read("reports").where("synced_at is null").count() == 0


def test_a_drain_stores_the_pages(made):
    site, make = made
    e = make()
    site.put(5, 1, 1, ["one", "two", "old1", "odd1", "bad1", "empty1"], 6)
    e.discover(1)
    assert e.drain() == {"selected": 6, "extracted": 2, "skipped": 1, "failed": 3}
    assert counts(e) == {t: 2 * n for t, n in report.TABLES.items()}
    assert states(e) == {
        "one": ("extracted", 2, 0, None, "2024-01-01"), "two": ("extracted", 2, 0, None, "2024-01-01"), "old1": ("skipped_v1", 1, 0, None, "2024-01-01"),
        "odd1": ("failed", None, 1, "unknown version", "None"), "bad1": ("failed", None, 1, "boom", "None"), "empty1": ("failed", None, 1, "validation", "None"),
    }
    assert sorted(r.codigo_evaluacion_energetica for r in e.read("pagina1").collect()) == ["one", "two"]
    out = e.mirror()
    assert out["informe_v2_pagina6"]["created"] == 192 and out["informe_v2_pagina3_envolvente"]["created"] == 20 and out["evaluaciones"]["created"] == 6


def test_a_second_reading_replaces_the_first(made):
    site, make = made
    e = make()
    site.put(5, 1, 1, ["one", "two"], 2)
    e.discover(1)
    e.drain()
    first = whole(e)
    at = e.store.version()
    again = e.read("reports").withColumn("pdf_status", F.when(F.col("identificacion") == "one", "pending").otherwise(F.col("pdf_status")))
    e.store.commit(at, {"reports": e.store.aside("reports", again)})
    assert e.drain()["extracted"] == 1
    assert whole(e) == first


def test_a_drain_that_is_killed_changes_nothing(made, monkeypatch):
    """Nine tables are written aside and one manifest is renamed; whichever of them fails, all are as they were."""
    site, make = made
    e = make()
    site.put(5, 1, 1, ["one", "two", "old1", "bad1"], 4)
    e.discover(1)
    before = whole(e)
    # What is read is the same each time; here it is read once.
    got = e._extracted(e.read("reports"))
    real, calls = e.store.aside, []

    def aside(name, *args, **kwargs):
        calls.append(name)
        out = real(name, *args, **kwargs)
        if len(calls) == step:
            raise OSError("killed")
        return out

    def rename(*args):
        raise OSError("killed")

    monkeypatch.setattr(e, "_extracted", lambda chosen: got)
    for step in (1, 2, 9, 10):
        calls.clear()
        with monkeypatch.context() as m:
            m.setattr(e.store, "aside", aside) if step < 10 else m.setattr(e.store, "_rename", rename)
            with pytest.raises(OSError):
                e.drain()
        assert step == 10 or len(calls) == step
        assert e.store.version().number == e.store.version().last
    assert whole(e) == before
    assert e.drain() == {"selected": 4, "extracted": 2, "skipped": 1, "failed": 1}
    assert counts(e) == {t: 2 * n for t, n in report.TABLES.items()}


def test_a_limited_drain_draws_at_random(made):
    site, make = made
    e = make(outcomes)
    site.fill(5, 1, 30)
    site.fill(7, 2, 4)
    for region in (1, 2):
        e.discover(region)
    ids = {r.eval_id for r in e.read("reports").collect()}
    assert e.drain(limit=5)["selected"] == 5
    drawn = {r.eval_id for r in e.read("reports").where("pdf_status <> 'pending'").collect()}
    assert len(drawn) == 5 and drawn != set(sorted(ids)[:5])
    left = e.read("reports").where("region_id = 2 and pdf_status = 'pending'").count()
    assert e.drain(region=2)["selected"] == left
    assert e.read("reports").where("region_id = 1 and pdf_status <> 'pending'").count() <= 5


def test_retries(made):
    site, make = made
    e = make(outcomes)
    site.put(5, 1, 1, ["bad1", "bad2", "fine"], 3)
    site.put(7, 1, 1, ["bad3"], 1)
    for region in (1, 2):
        e.discover(region)
    assert e.drain()["failed"] == 3
    assert e.retry(cap=1) == {"reactivated": 0, "max_retries": 1, "drain": {"selected": 0, "extracted": 0, "skipped": 0, "failed": 0}}
    assert e.retry(region=2)["reactivated"] == 1 and e.retry(limit=1)["reactivated"] == 1
    assert {i: s[2] for i, s in states(e).items()}["bad3"] >= 2
    fixed = make(lambda chosen: outcomes(chosen.withColumn("identificacion", F.lit("well"))))
    out = fixed.retry(cap=9)
    assert out["reactivated"] == 3 and out["drain"]["extracted"] == 3 and fixed.read("reports").where("pdf_status = 'failed'").isEmpty()


def test_new_rows_are_counted_once(made):
    """A row that stands on two pages is one, and a rerun finds nothing new, back or on."""
    site, make = made
    e = make()
    site.put(5, 1, 1, ["a", "b"], 13)
    site.put(5, 1, 2, ["b", "c"], 13)
    assert e.discover(1, incremental=False) == {"rows_new": 3, "errors": 0, "units": 4}
    assert e.discover(1, incremental=False)["rows_new"] == 0 and e.discover(1)["rows_new"] == 0
    site.put(5, 1, 2, ["b", "c", "d"], 13)
    assert e.discover(1)["rows_new"] == 1 and e.read("reports").count() == 4


def test_backfill_reads_all_and_goes_on_where_it_ended(made):
    site, make = made
    e = make(outcomes)
    site.fill(5, 1, 75)
    broken = site.folder / "5_1_6.html"
    good = broken.read_bytes()
    broken.write_bytes(b"\xff")
    site.fill(6, 2, 12)
    out = daily.backfill([1], e.steps())
    assert out["regions"][1]["errors"] == 1
    row = e.read("progress").where("comuna_id = 5 and tipo = 1").first()
    assert (row.status, row.pages_done, row.total_pages) == ("pending", 5, 8) and row.last_error
    broken.write_bytes(good)
    (site.folder / "5_1_2.html").unlink()  # is not asked for again
    out = daily.backfill([1], e.steps(), resume=True)
    row = e.read("progress").where("comuna_id = 5 and tipo = 1").first()
    assert (row.status, row.pages_done, row.last_error, out["regions"][1]["units"]) == ("done", 8, None, 1)
    assert e.read("reports").count() == 87 and e.pending() == 0
    assert daily.backfill([1], e.steps(), with_drain=False, resume=True)["regions"][1] == {"rows_new": 0, "errors": 0, "units": 0}


def test_a_killed_crawl_keeps_its_pages(made, monkeypatch):
    """Two pages of a unit are stored at a time: killed at the third store, four are done, and the fifth is read next."""
    site, make = made
    e = make()
    site.fill(5, 1, 75)
    real, calls = e._stored_pages, []

    def stored_pages(units, df, batch):
        calls.append(batch)
        if len(calls) == 3:
            raise OSError("killed")
        real(units, df, batch)

    monkeypatch.setattr(e, "_stored_pages", stored_pages)
    with pytest.raises(Exception, match="killed"):
        e.discover(1, (1,), incremental=False)
    assert e.read("progress").where("comuna_id = 5").first().pages_done == 4 and e.read("reports").count() == 40
    for number in (2, 3, 4):
        (site.folder / f"5_1_{number}.html").write_bytes(b"\xff")
    assert make().discover(1, (1,), incremental=False, resume=True)["rows_new"] == 35
    row = e.read("progress").where("comuna_id = 5").first()
    assert (row.status, row.pages_done, row.rows_seen) == ("done", 8, 35) and e.read("reports").count() == 75


def test_communes_come_from_the_regions_page(made):
    site, make = made
    lists = {1: "<select id='x dbComuna'><option value='-1'>-</option><option value='5'>Five</option><option value=\"9\">N&ntilde;ne</option></select>"}
    e = make(regions=lambda r: lists[r].replace("'", '"'))
    assert e.sync_communes(1) == 2 and e.sync_communes(1) == 0
    assert sorted(map(tuple, e.read("communes").collect()), key=str) == [(5, "Five", 1), (6, None, 1), (7, None, 2), (9, "Nñne", 1)]
    site.put(9, 1, 1, ["new"], 1)
    assert e.discover(1) == {"rows_new": 1, "errors": 0, "units": 6}


def test_a_stream_of_pages(spark, tmp_path):
    """Batch by batch what a plain crawl reads; started anew, it goes on behind the last batch."""
    site = Site(tmp_path / "site")
    site.fill(5, 1, 45)
    site.fill(6, 2, 8)
    listing.register(spark)
    plain = spark.read.format("listing").options(path=str(site.folder), units="5:1,6:2").load()
    every = sorted(r.identificacion for r in listing.found_rows(plain).collect())
    batches = []

    def run(most):
        def take(df, n):
            rows = df.collect()
            batches.append((n, sorted(r.identificacion for r in rows if r.row_no >= 0), {(r.comuna_id, r.pages_done) for r in rows if r.row_no < 0}))
            if len(batches) == most:
                raise OSError("killed")

        stream = spark.readStream.format("listing").options(path=str(site.folder), units="5:1,6:2", pages="2", state=str(tmp_path / "state")).load()
        query = stream.writeStream.option("checkpointLocation", str(tmp_path / "mark")).foreachBatch(take).start()
        try:
            query.processAllAvailable()
        except Exception as e:  # noqa: BLE001
            assert "killed" in str(e)
        finally:
            query.stop()

    run(2)
    assert [n for n, _, _ in batches] == [0, 1]
    run(99)
    # The batch that was killed is read again, and those before it are not.
    assert [n for n, _, _ in batches] == [0, 1, 1, 2] and batches[1] == batches[2]
    assert sorted(i for n, rows, _ in (batches[0], *batches[2:]) for i in rows) == every
    assert batches[0][2] == {(5, 1), (5, 2), (6, 1)} and batches[3][2] == {(5, 5)}
    run(99)
    assert len(batches) == 4
