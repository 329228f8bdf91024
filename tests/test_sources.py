"""Listing pages, crawls, downloads, files and the streaming ingest."""

import json

import pytest
from pyspark.sql import functions as F

from parcela.sources import download, files, listing
from parcela.streaming import ingest, windows

ROW = (
    "<tr><td>{i}</td><td>Casa</td><td>C&amp;A</td><td>P</td><td class=x><div><img src='LetraB.png'></div></td><td class=x><div><img src='Letra--.png'></div></td>"
    "<td class=x><div class='BtVerEtiqueta'><div><input name='r{i}'></div></div><div class='BtVerMapa'><div><input name='e{i}'></div></div></td></tr>"
)


def page(ids, total=None, tipo=1):
    count = "" if total is None else f"<span id='{listing.COUNT_SPAN[tipo]}'><b>{total}</b>  Viviendas</span>"
    return f"<html><div>{count}</div><table id='{listing.GRID_TABLE[tipo]}'><tbody>{''.join(ROW.format(i=i) for i in ids)}</tbody></table></html>"


def test_grid_rows():
    html = page(["x1", ""]).replace("</tbody>", "<tr><td>x2</td></tr></tbody>")
    first, second = listing.grid_rows(html, 1)
    assert first == {"identificacion": "x1", "tipologia": "Casa", "comuna": "C&A", "proyecto": "P", "calificacion_energetica": "B", "calificacion_equipos": None, "codigo_informe": "rx1", "codigo_etiqueta": "ex1"}
    assert second["identificacion"] == "x2" and second["tipologia"] is None
    assert listing.grid_rows(None, 1) == [] and listing.grid_rows(html, 2) == []


def test_counts_and_options():
    html = page([], "4.079", 2) + page([], 3, 1)
    assert (listing.result_count(html, 2), listing.result_count(html, 1), listing.result_count(None, 1)) == (4079, 3, 0)
    assert [listing.page_total(n) for n in (0, 1, 10, 11)] == [0, 1, 1, 2]
    assert listing.options('<select id="dbComuna"><option value="-1">-</option><option value="5">A&amp;B </option></select><option value="9">no</option>') == [(5, "A&B")]


class Pages:
    """Pages from a list of lists of identifications; notes what is asked for."""

    def __init__(self, pages, broken=()):
        self.pages, self.broken, self.asked = pages, set(broken), []

    def page(self, unit, number):
        self.asked.append(number)
        if number in self.broken:
            raise OSError(f"page {number}")
        return page(self.pages[number - 1], 10 * len(self.pages))


def crawled(pages, known=None, first=1, broken=(), **options):
    site = Pages(pages, broken)
    out = list(listing.crawl(site, listing.Unit(1, 1, first), known, **options))
    return site.asked, [r[2]["identificacion"] for r in out[:-1]], out[-1][2]


def test_full_crawl_and_resume():
    asked, found, progress = crawled([["a", "b"], ["c"], ["d"]])
    assert asked == [1, 2, 3] and found == ["a", "b", "c", "d"]
    assert progress == {"status": "done", "pages_done": 3, "total_pages": 3, "rows_new": 4, "rows_seen": 4, "early_stopped": False, "last_error": None}
    assert crawled([["a"], ["c"], ["d"]], first=3)[1] == ["d"]
    assert crawled([["a"], ["c"], ["d"]], most=2)[1] == ["a", "c"]


def test_incremental_crawl_goes_back_and_stops():
    known = frozenset("abcdef")
    asked, found, progress = crawled([["a"], ["b"], ["c"], [], ["x"], ["d"], ["y"]], known)
    assert asked == [1, 7, 6, 5, 4, 3, 2] and found == ["y", "d", "x", "c", "b"]  # an empty page neither counts nor interrupts
    assert progress["early_stopped"] and progress["rows_new"] == 2 and progress["pages_done"] == 6 and progress["status"] == "done"
    assert not crawled([["a"], ["x"]], known)[2]["early_stopped"]
    assert crawled([["a"], ["b"], ["c"]], known, grace=1)[0] == [1, 3]


def test_a_failed_page_leaves_its_error_and_a_rerun_goes_on():
    asked, found, progress = crawled([["a"], ["b"], ["c"]], broken=[2])
    assert found == ["a"] and progress["status"] == "pending" and progress["pages_done"] == 1 and progress["last_error"] == "page 2"
    assert crawled([["a"], ["b"], ["c"]], first=progress["pages_done"] + 1)[1] == ["b", "c"]


def test_retries_wait_longer_each_time():
    class Flaky:
        def __init__(self, failures):
            self.left = failures

        def page(self, unit, number):
            self.left -= 1
            if self.left >= 0:
                raise OSError("busy")
            return "ok"

    waits = []
    assert listing.Retrying(Flaky(2), 3, 0.5, waits.append).page(None, 1) == "ok" and waits == [0.5, 1.0]
    with pytest.raises(OSError):
        listing.Retrying(Flaky(3), 3, 0.5, waits.append).page(None, 1)


def test_form_session_carries_its_state():
    sent = []

    def send(fields):
        sent.append(fields)
        return f'<input id="__VIEWSTATE" value="s{len(sent)}"/><input id="__EVENTVALIDATION" value="v"/>'

    session = listing.FormSession(send, lambda comuna: 13)
    unit = listing.Unit(5, 2)
    for number in (1, 2, 3):
        session.page(unit, number)
    assert [f.get("event") for f in sent] == [None, "region", "search", "page", "page"]
    assert [f.get("__VIEWSTATE") for f in sent] == [None, "s1", "s2", "s3", "s4"]
    assert sent[1]["region"] == "13" and sent[2] | {"comuna": "5", "tipo": "2"} == sent[2] and sent[4]["page"] == "3"


def test_listing_source(spark, tmp_path):
    for number, ids in ((1, range(10)), (2, range(10, 12))):
        (tmp_path / f"7_1_{number}.html").write_text(page([f"v{i}" for i in ids], 12), encoding="utf-8")
    listing.register(spark)
    reader = lambda **o: spark.read.format("listing").options(path=str(tmp_path), **o).load()
    df = reader(units="7:1,8:1")
    assert [r.identificacion for r in listing.found_rows(df).orderBy("page_no", "row_no").collect()] == [f"v{i}" for i in range(12)]
    assert sorted((r.comuna_id, r.status, r.total_pages) for r in listing.progress_of(df).collect()) == [(7, "done", 2), (8, "done", 0)]
    assert listing.found_rows(reader(units="7:1:2")).count() == 2
    known = str(tmp_path / "known")
    spark.createDataFrame([(7, 1, f"v{i}") for i in range(11)] + [(9, 1, "v11")], "comuna_id int, tipo int, identificacion string").write.parquet(known)
    again = reader(units="7:1", known=known, grace="1")
    assert [r.identificacion for r in listing.found_rows(again).where("is_new").collect()] == ["v11"]
    assert listing.progress_of(again).first().early_stopped
    uri = reader(units="7:1").select("identificacion").count()
    assert spark.read.format("listing").options(path=f"file://{tmp_path}", units="7:1").load().count() == uri


class Search:
    """Notes each search in a file, as it is made by other processes."""

    def __init__(self, log, place):
        with open(log, "a") as f:
            f.write(json.dumps(place) + "\n")

    def fetch(self, code):
        if code == "bad":
            raise OSError("broken")
        return (200, f"%PDF{code}".encode())


def test_downloads_of_a_unit_share_a_search(spark, tmp_path):
    log = str(tmp_path / "log")
    work = [(f"e{i}", 1, i % 2, 1, None if i == 4 else "bad" if i == 5 else f"c{i}") for i in range(20)] + [("z", 2, 9, 1, None)]
    df = spark.createDataFrame(work, "eval_id string, region_id int, comuna_id int, tipo int, codigo_informe string").repartition(4)
    out = {r.eval_id: r for r in download.downloads(df, lambda place: Search(log, place)).collect()}
    assert len(out) == 21 and bytes(out["e7"].payload) == b"%PDFc7" and out["e7"].status == 200
    assert out["e4"].status is None and out["e4"].error is None and out["e5"].error == "broken" and out["z"].status is None
    assert sorted(open(log).read().split("\n")) == ["", "[1, 0, 1]", "[1, 1, 1]"]
    many = download.downloads(df, lambda place: Search(str(tmp_path / "more"), place), most=3).count()
    assert many == 21 and len(open(tmp_path / "more").readlines()) > 2


def test_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"junk%PDF-1 \x00body%%EOF x")
    (tmp_path / "b.pdf").write_bytes(b"<html>")
    got = {r.path[-5:]: r.c for r in files.payloads(spark, str(tmp_path)).select("path", files.carved(F.col("content")).alias("c")).collect()}
    assert bytes(got["a.pdf"]) == b"%PDF-1 \x00body%%EOF" and got["b.pdf"] is None
    assert files.listing(spark, str(tmp_path)).count() == 2
    assert files.likely_reports(files.listing(spark, str(tmp_path))).count() == 0


def test_streaming_ingest_is_idempotent(spark, tmp_path):
    schema = "comuna_id int, region_id int, tipo int, identificacion string, tipologia string, page_no int, row_no int"
    grid, mark = str(tmp_path / "grid"), str(tmp_path / "mark")
    table = ingest.VersionedTable(spark, str(tmp_path / "table"), ingest.DIRECTORY)

    def run(rows, seen):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(grid)
        ingest.ingest(spark, grid, schema, table, mark, seen).awaitTermination()
        return sorted((r.identificacion, r.tipologia, r.pdf_status, str(r.last_seen_at)[:10]) for r in table.read().collect())

    one = run([(1, 1, 1, "a", "x", 1, 0), (1, 1, 1, "a", "y", 2, 0), (1, 1, 1, "b", "x", 1, 1)], "2024-01-01")
    assert one == [("a", "y", "pending", "2024-01-01"), ("b", "x", "pending", "2024-01-01")]
    two = run([(1, 1, 1, "b", "z", 1, 0)], "2024-01-02")
    assert two == [("a", "y", "pending", "2024-01-01"), ("b", "z", "pending", "2024-01-02")]
    again = spark.createDataFrame([(1, 1, 1, "c", "x", 1, 0)], schema)
    ingest.merge_batch(table, again, table.last_batch(), "2024-01-03")
    assert table.read().count() == 2


def test_event_windows(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    total = windows.activity(events.withColumn("ts", events.ts.cast("timestamp"))).groupBy().sum("n").first()[0]
    assert total == events.count()


def test_a_write_replaces_touched_buckets_alone(spark, tmp_path):
    table = ingest.VersionedTable(spark, str(tmp_path / "t"), "eval_id string, v int", buckets=4)
    assert table.read().count() == 0 and table.last_batch() == -1
    table.write(spark.createDataFrame([(f"k{i}", 0) for i in range(40)], table.schema), 0)
    held = lambda: table.store.version().held.get("rows", {})
    before = held()
    one = spark.createDataFrame([("k1", 1)], table.schema)
    touched = {r[0] for r in one.select(table.bucket()).collect()}
    rows = table.read(touched)
    assert 0 < rows.count() < 40
    table.write(rows.where("eval_id <> 'k1'").union(one), 1, touched)
    after = held()
    assert table.last_batch() == 1 and {b for b in after if after[b] != before[b]} == touched
    assert table.read().count() == 40 and table.read().where("v = 1").count() == 1
    table.write(table.read(touched).where("false"), 2, touched)
    assert touched.isdisjoint(held()) and table.read().where("v = 1").count() == 0
