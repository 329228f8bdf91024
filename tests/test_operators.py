"""Operators on small cases whose results are known."""

import datetime
import json
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcela.operators import cells, diagnostics, directory, glyphs, grid, layout, mirror, nested, persist, pictures, work
from parcela.plans import catalogue, daily, report


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize(
    ("new", "grace", "visited", "early"),
    [([10, 0, 0, 0, 0], 1, 2, True), ([5, 0, 3, 0], 2, 4, False), ([5, 0, 0, 1, 1], 2, 3, True), ([0, None, 0, 4], 2, 3, True)],
)
def test_early_stop(spark, new, grace, visited, early):
    pages = spark.createDataFrame([(1, i, 0 if n is None else 10, n or 0) for i, n in enumerate(new, 1)], "unit int, page int, n_rows int, n_new int")
    out = directory.early_stop(pages, ["unit"], "page", grace).collect()
    assert len(out) == visited
    assert {r.early_stopped for r in out} == {early}


def test_resume(spark):
    units = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "c int, t int")
    done = spark.createDataFrame([(1, 1, "done", 5), (2, 1, "pending", 2)], "c int, t int, status string, pages_done int")
    assert rows(directory.resume_plan(units, done, ["c", "t"]), "c", "start_page") == [(2, 3), (3, 1)]
    assert directory.resume_plan(units, done, ["c", "t"], incremental=True).count() == 3


def test_upsert_twice_is_once(spark):
    known = spark.createDataFrame([("a", "x", "failed", 2, "2020-01-01")], "eval_id string, tip string, pdf_status string, retry int, last_seen_at string")
    found = spark.createDataFrame([("a", "y"), ("b", "z")], "eval_id string, tip string")
    once = directory.upsert(known, found, "eval_id", ["tip"], ["pdf_status", "retry"], F.lit("2021-01-01"))
    assert rows(once, "eval_id", "tip", "pdf_status", "retry", "change") == [("a", "y", "failed", 2, "refreshed"), ("b", "z", "pending", None, "inserted")]
    twice = directory.upsert(once.drop("change"), found, "eval_id", ["tip"], ["pdf_status", "retry"], F.lit("2021-01-01"))
    assert rows(twice.drop("change"), *known.columns) == rows(once.drop("change"), *known.columns)


def test_transition_and_summary(spark):
    queue = spark.createDataFrame([(str(i), "pending", i) for i in range(1, 5)], "eval_id string, pdf_status string, retry_count int")
    outcomes = spark.createDataFrame([("1", 7, None, True), ("2", 4, None, None), ("3", 5, None, True), ("4", 7, "e" * 400, True), ("9", 7, None, True)], "eval_id string, page_count int, extract_error string, valid boolean")
    out = work.transition(queue, outcomes)
    assert rows(out, "eval_id", "new_status", "new_retry_count") == [("1", "extracted", 1), ("2", "skipped_v1", 2), ("3", "failed", 4), ("4", "failed", 5), ("9", "error", 0)]
    assert max(len(r.new_error or "") for r in out.collect()) == 300
    assert work.drain_summary(out).first().asDict() == {"selected": 5, "extracted": 1, "skipped": 1, "failed": 3}


def test_a_random_order_is_that_of_its_seed(spark):
    queue = spark.range(300).withColumnRenamed("id", "eval_id")
    order = lambda seed, n=3: [r.eval_id for r in work.shuffled(queue.repartition(n), seed).collect()]
    assert order(1) == order(1, 7) and sorted(order(1)) == list(range(300)) and order(1) != order(2) != sorted(order(2))


def test_small_numbers_and_scores(spark):
    """Rules that have no query of their own: data rows of a band list, sure cells, and the older number rule."""
    bands = spark.createDataFrame([(1, [(0.0, 2.0), (5.0, 8.0), (9.0, 12.0)]), (2, [(1.0, 3.0), (4.0, 6.0)]), (3, [(1.0, 3.0)])], "k int, b array<struct<begin: double, end: double>>")
    out = {r.k: [tuple(x) for x in r.d] for r in bands.select("k", grid.data_rows(F.col("b"), F.lit(10.0), F.lit(30.0)).alias("d")).collect()}
    assert out == {1: [(5, 8), (9, 12)], 2: [(1, 3), (4, 6)], 3: [(20, 30), (30, 40)]}
    sure = spark.createDataFrame([(1, 0.6, 20.0), (2, 0.5, 20.0), (3, 0.9, 60.0), (4, 0.55, -20.0)], "k int, confidence double, value double")
    assert rows(glyphs.low_scores_out(sure), "k") == [(1,), (4,)]


def test_validation(spark):
    hours = spark.createDataFrame([("a", "c", 1.0, 2.0, False)] * 96 + [("b", None, None, 2.0, True)] * 96, "eval_id string, codigo string, outer double, inner double, low_confidence boolean")
    assert rows(work.validation(hours), "eval_id", "has_codigo", "p6_filled", "p6_low_confidence", "ok") == [("a", True, 96, 0, True), ("b", False, 0, 96, False)]


def test_jumps_and_flags(spark):
    values = [10.0, 30.0, 11.0, None, 12.0, 80.0, None, 50.0]
    df = cells.jumps(spark.createDataFrame(list(enumerate(values)), "h int, v double").withColumn("s", F.lit(1)), ["s"], "h", "v")
    out = df.withColumn("f", cells.flag(F.col("v"), F.col("jump"))).orderBy("h").collect()
    assert [r.f for r in out] == ["jump", "jump", "jump", "none", "jump", "range", "none", "ok"]


def test_zip_and_pad(spark):
    df = spark.createDataFrame([("a", [1, 2], [5]), ("b", None, [6])], "k string, x array<int>, y array<int>")
    assert rows(nested.zip_rows(df, ["k"], ["x", "y"]).fillna(-1), "k", "pos", "x", "y") == [("a", 0, 1, 5), ("a", 1, 2, -1), ("b", 0, -1, 6)]
    r = df.select(nested.pad(F.col("x"), 3, "int").alias("p"), nested.drop_places(F.sequence(F.lit(0), F.lit(11)), (4, 10)).alias("d")).first()
    assert r.p == [1, 2, None]
    assert r.d == [0, 1, 2, 3, 5, 6, 7, 8, 9, 11]


def test_renames_reach_every_column():
    assert persist.renamed("calefaccion_kwh_per") == "calefaccion_porcentaje"
    assert persist.renamed("consumo_ep_iluminacion_kwh") == "consumo_energia_primaria_iluminacion_kwh"
    assert persist.renamed("calefaccion_consumo_proy_kwh") == "calefaccion_consumo_proyectado_kwh"
    assert persist.renamed("iluminacion_consumo_ref_kwh") == "iluminacion_consumo_referencia_kwh"
    assert persist.renamed("calefaccion_descripcion_proy") == "calefaccion_descripcion_proyectado"
    assert persist.renamed("calefaccion_consumo_ref_per") == "calefaccion_consumo_referencia_porcentaje"


def test_replace_twice_is_once(spark):
    table = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "k int, v string")
    new = spark.createDataFrame([(1, "z")], "k int, v string")
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    once = persist.replace_by_key(table, new, ["k"], keys)
    assert rows(once, "k", "v") == [(1, "z"), (3, "d")]
    assert rows(persist.replace_by_key(once, new, ["k"], keys), "k", "v") == rows(once, "k", "v")


def test_critical_nulls(spark):
    df = spark.createDataFrame([(1, None, 2), (2, 1, 2)], "k int, emitida_el int, letra int")
    assert rows(work.critical_nulls(df, ["emitida_el", "letra"]), "k", "missing") == [(1, "emitida_el")]


def test_histogram(spark):
    df = spark.createDataFrame([(True,), (None,), (True,)], "b boolean")
    assert rows(diagnostics.histogram(df, "b", boolean=True), "value", "n") == [("True", 2), ("null", 1)]


def test_merge_blobs(spark):
    boxes = [(1, 0, 0, 4, 10), (1, 5, 2, 3, 9), (1, 20, 0, 4, 10), (1, 25, 8, 2, 2)]
    out = glyphs.merge_blobs(spark.createDataFrame(boxes, "k int, x int, y int, w int, h int"), ["k"])
    assert rows(out, "ord", "x", "y", "w", "h") == [(0, 0, 0, 8, 11), (1, 20, 0, 4, 10), (2, 25, 8, 2, 2)]


def test_commas_are_not_merged(spark):
    boxes = [(1, 0, 0, 4, 10, False), (1, 5, 8, 2, 9, True), (1, 8, 0, 3, 9, False), (1, 12, 1, 3, 10, None)]
    out = glyphs.merge_blobs(spark.createDataFrame(boxes, "k int, x int, y int, w int, h int, low boolean"), ["k"], comma="low")
    assert rows(out, "ord", "x", "y", "w", "h", "low") == [(0, 0, 0, 4, 10, False), (1, 5, 8, 2, 9, True), (2, 8, 0, 7, 11, False)]


def test_components_against_a_flood():
    r = np.random.default_rng(3)
    for _ in range(60):
        ink = r.random((r.integers(1, 14), r.integers(1, 14))) < 0.35
        left, want = set(zip(*np.nonzero(ink), strict=True)), []
        while left:
            todo, part = [left.pop()], []
            while todo:
                y, x = todo.pop()
                part.append((y, x))
                near = {(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} & left
                left -= near
                todo += near
            ys, xs = zip(*part, strict=True)
            want.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, len(part)))
        assert pictures.components(ink) == sorted(want)


def test_threshold_and_scale():
    grey = np.array([[10, 12, 200], [11, 210, 205]])
    assert 12 <= pictures.threshold(grey) < 200
    even = np.arange(24.0).reshape(4, 6)
    assert np.allclose(pictures.scaled(even, (2, 3)), even.reshape(2, 2, 3, 2).mean((1, 3)))
    assert np.allclose(pictures.scaled(even, (8, 6)), np.repeat(even, 2, 0)) and np.isclose(pictures.scaled(even, (3, 4)).mean(), even.mean())


def test_what_is_no_picture(spark):
    data = [(1, None), (2, []), (3, [[1, 2], [3]]), (4, [[5, 5], [5, 5]]), (5, [[0, 255, 300], [255, 255, -4]])]
    df = spark.createDataFrame(data, "k int, pixels array<array<int>>")
    assert rows(pictures.blobs(df, ["k"]), "k", "x", "y", "w", "h", "area", "cell_h") == [(5, 0, 0, 1, 1, 1, 2), (5, 2, 1, 1, 1, 1, 2)]
    boxed = df.selectExpr("k", "pixels", "0 as x", "0 as y", "if(k = 4, 0, 2) as w", "2 as h")
    assert {r.k: r.pixels and len(r.pixels) for r in pictures.normalised(boxed, ["k"]).collect()} == {1: None, 2: None, 3: None, 4: None, 5: 768}


def test_classify_ties_and_flat(spark):
    t = spark.createDataFrame([("1", 0, [0.0, 1.0, 0.0]), ("2", 0, [0.0, 2.0, 0.0])], "label string, exemplar_no int, exemplar array<double>")
    g = spark.createDataFrame([(1, [0.0, 5.0, 0.0]), (2, [3.0, 3.0, 3.0]), (3, None)], "id int, pixels array<double>")
    assert rows(glyphs.classify(g, t, "id"), "id", "best", "score") == [(1, "1", 1.0), (2, "?", -1.0), (3, "?", -1.0)]


def test_bounds_need_a_grid(spark):
    lines = spark.createDataFrame([(1, 10 * i) for i in range(25)] + [(2, 10), (2, 20), (2, 30), (2, 40)] + [(3, i) for i in (0, 100, 205, 310, 1900)], "doc int, pos int")
    out = grid.bounds(lines, ["doc"], "pos")
    assert rows(out.where("doc = 1"), "doc", "bound") == [(1, 10.0 * i) for i in range(25)]
    # Five lines of which four are regular: the last of these is the grid's end.
    assert {r.doc for r in out.collect()} == {1, 3} and out.where("doc = 3 and k = 24").first().bound == 310


def test_boxes(spark):
    spans = spark.createDataFrame([("d", 1, 215.9, 330.0, 10.0, 10.0, 12.0, 12.0, 10.0, "b"), ("d", 1, 215.9, 330.0, 5.0, 10.0, 7.0, 12.0, 10.0, "a")], "doc_id string, page_no int, page_w double, page_h double, x0 double, y0 double, x1 double, y1 double, font_size double, text string")
    boxes = spark.createDataFrame([(1, "f", 0.0, 0.0, 20.0, 20.0), (1, "g", 100.0, 0.0, 120.0, 20.0), (1, "bad", 9.0, 0.0, 9.0, 20.0)], "page_no int, field string, x1 double, y1 double, x2 double, y2 double")
    assert rows(layout.in_boxes(spans, boxes, blank=True), "field", "text") == [("f", "a b"), ("g", "")]


class Memory:
    """A mirror in files, as sessions are other processes."""

    def __init__(self, folder, refuse=()):
        self.folder, self.refuse = folder, refuse

    def _path(self, table, value):
        return self.folder / f"{table}_{value}.json"

    def search(self, table, key, value):
        if value in self.refuse:
            raise RuntimeError("HTTP 500 " + "x" * 300)
        path = self._path(table, value)
        return str(path) if path.exists() else None

    def create(self, table, row):
        self._path(table, row["eval_id"]).write_text(json.dumps(row))

    def update(self, table, ident, row):
        Path(ident).write_text(json.dumps(row | {"updated": True}))


def test_mirror_writes_and_stamps(spark, tmp_path):
    schema = "eval_id string, day date, at timestamp, synced_at date, processed_at date, id int"
    rows_ = [(f"e{i}", datetime.date(2020, 1, 1), datetime.datetime(2020, 1, 1, 5), None, None, 9) for i in range(10)]
    work_ = spark.createDataFrame(rows_, schema)
    sent = persist.mirror_delta(work_)
    after, results = mirror.sync(work_, {"evaluaciones": (work_, "eval_id")}, sent, lambda: Memory(tmp_path), F.lit("2030-01-01"), sessions=3)
    assert results == {"evaluaciones": {"created": 10, "updated": 0, "remaining": 0, "error": None}}
    assert after.where("synced_at = date'2030-01-01'").count() == 10 and persist.mirror_delta(after).isEmpty()
    assert json.loads((tmp_path / "evaluaciones_e3.json").read_text()) == {"eval_id": "e3", "day": "2020-01-01", "at": "2020-01-01T05:00:00+00:00", "synced_at": None, "processed_at": None}
    again = mirror.write(work_.union(work_), "evaluaciones", "eval_id", lambda: Memory(tmp_path), 3)
    assert again == {"created": 0, "updated": 20, "remaining": 0, "error": None}
    fresh = mirror.write(work_.union(work_), "other", "eval_id", lambda: Memory(tmp_path), 3)
    assert (fresh["created"], fresh["updated"]) == (10, 10)


def test_a_failed_table_stops_and_stamps_nothing(spark, tmp_path):
    work_ = spark.createDataFrame([(f"e{i}", None) for i in range(10)], "eval_id string, synced_at date")
    detail = spark.createDataFrame([("e1", 1), ("e2", 2), ("q", 3)], "eval_id string, v int")
    tables = {"evaluaciones": (work_, "eval_id"), "pagina1": (detail, "eval_id")}
    after, results = mirror.sync(work_, tables, work_, lambda: Memory(tmp_path, ["e4"]), F.lit("2030-01-01"), sessions=1)
    one = results["evaluaciones"]
    assert one["created"] == 4 and one["remaining"] == 6 and len(one["error"]) == 150
    assert results["pagina1"] == {"created": 2, "updated": 0, "remaining": 0, "error": None}
    assert after.where("synced_at is not null").count() == 0


def test_table_names():
    assert persist.table_column("pagina1", "tipo_evaluacion") == "tipo_evaluacion_nombre"
    assert persist.table_column("pagina2", "zona_termica") == "zona_termica_nombre"
    assert persist.table_column("pagina3_consumos", "consumo_total_ep_obj_kwh") == "consumo_total_energia_primaria_objeto_kwh"
    assert persist.table_column("pagina4", "demanda_enfri_viv_ref_kwh") == "demanda_enfriamiento_viv_ref_kwh"
    assert {persist.table_column(t, "codigo_evaluacion") for t in report.TABLES} == {"codigo_evaluacion_energetica"}


def test_whole_report(spark):
    """A span in the middle of every box of a document comes out as that field's text; a second document has page 1 alone."""
    spans = []
    for f in (f for p in range(1, 8) for f in catalogue.fields(p) if f.kind not in ("block", "label")):
        x, y = (f.box[0] + f.box[2]) / 2, (f.box[1] + f.box[3]) / 2
        text = {"integer": "45", "date": "10 de mayo de 2017", "text": f"t {f.name}", "line": f"t {f.name}"}.get(f.kind, "1.234,5")
        for d in ("a", "b") if f.page == 1 else ("a",):
            spans.append((d, f.page, 431.8, 660.0, 2 * x - 1, 2 * y - 1, 2 * x + 1, 2 * y + 1, 12.0, text))
    df = spark.createDataFrame(spans, "doc_id string, page_no int, page_w double, page_h double, x0 double, y0 double, x1 double, y1 double, font_size double, text string")
    tables = report.extract(df, "doc_id")
    counts = {(r.doc_id, r.table_name): r.n_rows for r in report.page_rows(tables, "doc_id").collect()}
    assert {t: counts["a", t] for t in report.TABLES} == report.TABLES
    assert {t: counts["b", t] for t in report.TABLES} == {t: int(t == "pagina1") for t in report.TABLES}
    assert {r.table_name for r in report.page_rows(tables, "doc_id", "b").collect()} == set(report.TABLES)
    one = tables["pagina1"].where("doc_id = 'a'").first()
    assert (one.porcentaje_ahorro, one.letra_eficiencia_energetica_dem, one.emitida_el) == (45, "C", datetime.date(2017, 5, 10))
    assert one.comuna_nombre == "t comuna" and one.demanda_total_kwh_m2_ano == 1234.5
    third = tables["pagina3_consumos"].first()
    assert len(tables["pagina3_consumos"].columns) == 53 and third.agua_caliente_sanitaria_porcentaje == 1234.5 and third.coeficiente_energetico_c == 1234.5
    assert tables["pagina4"].where("sobrecalentamiento_viv_ref_hr = 1234.5 and codigo_evaluacion_energetica = 't codigo_evaluacion'").count() == 12
    checked = {r.eval_id: r for r in report.validated(tables, "doc_id").collect()}
    assert checked["a"].ok and checked["a"].p6_rows == 96 and checked["a"].p6_filled == 0 and not checked["b"].ok


def test_merge_blobs_against_a_loop(spark):
    r = random.Random(4)
    boxes = [(k, r.randint(0, 30), r.randint(0, 9), r.randint(1, 6), r.randint(1, 12)) for k in range(40) for _ in range(r.randint(0, 9))]
    want = []
    for k in range(40):
        folded = []
        for x, y, w, h in sorted(b[1:] for b in boxes if b[0] == k):
            if folded and x - folded[-1][0] - folded[-1][2] <= 2 and abs(h - folded[-1][3]) < 0.6 * folded[-1][3]:
                px, py, pw, ph = folded[-1]
                folded[-1] = (px, min(py, y), max(px + pw, x + w) - px, max(py + ph, y + h) - min(py, y))
            else:
                folded.append((x, y, w, h))
        want += [(k, i, *b) for i, b in enumerate(folded)]
    out = glyphs.merge_blobs(spark.createDataFrame(boxes, "k int, x int, y int, w int, h int"), ["k"])
    assert rows(out, "k", "ord", "x", "y", "w", "h") == sorted(want)


def test_classify_by_the_batch(spark):
    r = random.Random(2)
    wall = [(str(i % 3), i, [r.random() for _ in range(6)]) for i in range(9)]
    given = [(i, None if i % 11 == 0 else [1.0] * 6 if i % 13 == 0 else [0.5, None] * 3 if i % 17 == 0 else [r.random() for _ in range(5 if i % 7 == 0 else 6)]) for i in range(200)]

    def best(v):
        if v is None or len(v) != 6 or None in v or len(set(v)) == 1:
            return ("?", -1.0)
        found = []
        for label, n, t in sorted(wall, key=lambda x: x[:2]):
            a, b = [x - sum(v) / 6 for x in v], [x - sum(t) / 6 for x in t]
            like = sum(p * q for p, q in zip(a, b, strict=True)) / (sum(p * p for p in a) * sum(q * q for q in b)) ** 0.5
            found.append((round(like, 9), label))
        top = max(f[0] for f in found)
        return next((label, s) for s, label in found if s == top)

    g = spark.createDataFrame(given, "id int, pixels array<double>")
    t = spark.createDataFrame(wall, "label string, exemplar_no int, exemplar array<double>")
    out = {x.id: (x.best, round(x.score, 9)) for x in glyphs.classify(g, t, "id").collect()}
    assert out == {i: best(v) for i, v in given}


def test_stride_sample_of_a_hot_label(spark):
    data = [("hot", i) for i in range(500)] + [("few", i) for i in range(5)]
    out = glyphs.stride_sample(spark.createDataFrame(data, "label string, i int").repartition(7), "label", ["i"])
    assert rows(out, "label", "i") == sorted([("few", i) for i in range(5)] + [("hot", 41 * k) for k in range(12)])


def test_daily_survives_a_region():
    def discover(region):
        if region == 7:
            raise RuntimeError("boom")
        return {"rows_new": 2}

    steps = daily.Steps(discover, lambda: 3, lambda: {"selected": 3}, lambda: {}, lambda: {})
    out = daily.daily(steps)
    assert list(out) == ["discovery", "pending", "drain", "mirror", "cleanup"]
    assert out["discovery"]["rows_new"] == 30
    assert out["discovery"]["regions"][7] == {"error": "boom"}


def plain_lines(spans):
    """Spans (centre, x, text, top, bottom) in lines, as an eye takes them: from the top, each with what overlaps it."""
    out = []
    for my, mx, text, top, bottom in sorted(spans):
        if out and (my <= out[-1][1] or top <= out[-1][0]):
            out[-1][1] = max(out[-1][1], bottom)
            out[-1][2].append((mx, text))
        else:
            out.append([my, bottom, [(mx, text)]])
    return [[t for _, t in sorted(w)] for _, _, w in out]


def test_lines_of_a_box(spark):
    """Jitter, raised figures, rows apart, and boxes at random against a plain sweep."""
    r = random.Random(8)
    cases = [
        [(21.3, 74.0, "FIRST", 20.3, 22.3), (21.0, 81.0, "SECOND", 20.0, 22.0)],
        [(30.0, 10.0, "area", 28.5, 31.5), (28.9, 14.0, "2", 28.2, 29.6), (30.2, 18.0, "total", 28.7, 31.7)],
        [(10.0, 5.0, "a", 9.0, 11.0), (12.5, 1.0, "b", 11.5, 13.5), (12.4, 9.0, "c", 11.4, 13.4)],
    ]
    for _ in range(40):
        cases.append([(y, r.uniform(0, 50), f"w{k}", y - h, y + h) for k in range(r.randint(1, 9)) for y, h in [(r.uniform(0, 12), r.choice([0.0, 0.5, 1.0, 2.0]))]])
    df = spark.createDataFrame([(i, [tuple(x) for x in c]) for i, c in enumerate(cases)], "i int, w array<struct<my: double, mx: double, text: string, top: double, bottom: double>>")
    df = df.withColumn("w", F.array_sort("w"))
    out = {x.i: [[y.text for y in line] for line in x.o] for x in df.select("i", layout.lines("w").alias("o")).collect()}
    assert out == {i: plain_lines(c) for i, c in enumerate(cases)}
    assert out[0] == [["FIRST", "SECOND"]] and out[1] == [["area", "2", "total"]] and out[2] == [["a"], ["b", "c"]]


class Refusing:
    """Notes each call in a file and refuses it."""

    def __init__(self, log):
        self.log = log

    def search(self, table, key, value):
        with open(self.log, "a") as f:
            f.write("call\n")
        raise RuntimeError("no such table")


def test_a_table_that_refuses_is_called_once(spark, tmp_path):
    log = tmp_path / "log"
    rows_ = spark.createDataFrame([(f"e{i}",) for i in range(400)], "eval_id string").repartition(8)
    out = mirror.write(rows_, "missing", "eval_id", lambda: Refusing(log), 8)
    assert out == {"created": 0, "updated": 0, "remaining": 400, "error": "no such table"}
    assert len(log.read_text().split()) == 1
    assert mirror.write(rows_.limit(0), "missing", "eval_id", lambda: Refusing(log), 8)["error"] is None


def test_early_stop_over_a_stream(spark, tmp_path):
    """The verdicts of the batch rule, however the pages are cut into batches; repeated pages change nothing."""
    from parcela.streaming import early_stop

    r = random.Random(3)
    pages = [(u, p, r.choice([0, 10]), r.choice([0, 0, 2])) for u in range(12) for p in range(1, 15)]
    schema = "unit int, page int, n_rows int, n_new int"
    expected = rows(directory.early_stop(spark.createDataFrame(pages, schema), ["unit"], "page", 2), "unit", "page")
    given, out = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in (range(1, 4), range(4, 5), range(3, 11), range(11, 15)):
        some = [p for p in pages if p[1] in batch]
        r.shuffle(some)
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(given)
        seen = early_stop.visited(spark.readStream.schema(schema).parquet(given), ["unit"], "page", 2)
        seen.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(out)
    assert rows(found, "unit", "page") == expected
    last = {u: max(p for v, p in expected if v == u) for u in range(12)}
    assert all(last[x.unit] == x.page for x in found.where("stops").collect()) and found.where("stops").count() > 3


def test_bands_and_lines_of_rows_take_one_sort(spark):
    rows = spark.createDataFrame([(1, 0, 30.0)], "k int, y int, ink double")
    for found in (grid.merged(grid.ink_bands(rows, ["k"], "y", "ink"), ["k"]), grid.lines_of(rows, ["k"], "y", "ink")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1 and "Aggregate" not in plan


def test_runs_and_bands_against_loops(spark):
    rng = np.random.default_rng(8)
    ink = [(k, int(y), float(v)) for k in range(60) for y, v in enumerate(rng.choice([0, 19, 20, 45, 400 * (k % 2)], rng.integers(1, 60))) if k % 5 or y % 4]
    ink += [(90, 3, None), (91, 7, 20.0), (92, 119, 50.0)]
    rows = spark.createDataFrame(ink, "k int, y int, ink double")
    runs, bands = [], []
    for k in sorted({r[0] for r in ink}):
        of = {y: v for d, y, v in ink if d == k and v is not None}
        on = [y for y in sorted(of) if of[y] >= max(0.12 * max(of.values()), 20)]
        for gap, out in ((2, runs), (6, bands)):
            first = [y for i, y in enumerate(on) if i == 0 or y - on[i - 1] >= gap]
            last = [y for i, y in enumerate(on) if i == len(on) - 1 or on[i + 1] - y >= gap]
            out += [(k, b, e) for b, e in zip(first, last, strict=True)]
    found = grid.ink_bands(rows, ["k"], "y", "ink")
    assert sorted(map(tuple, found.collect())) == runs
    # Bands are less than 6 apart where the next begins less than 6 after the last row of ink.
    wide = [(k, max(0, b - 3), min(50, e + 3)) for k, b, e in bands if e - b >= 6]
    assert sorted(map(tuple, grid.merged(found, ["k"], limit=50).collect())) == wide
    whole = rows.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("y", "ink"))).alias("r")).where("k % 5 > 0 and k < 60").select("k", F.transform("r", lambda x: x["ink"]).alias("v"))
    for how, want in (({"limit": 50}, wide), ({"gap": 2, "height": 0, "margin": 0}, runs)):
        got = whole.select("k", F.explode(grid.bands_in("v", **how)).alias("b")).select("k", "b.*")
        assert sorted(map(tuple, got.collect())) == [x for x in want if x[0] % 5 and x[0] < 60]


def test_a_band_within_another_does_not_end_it(spark):
    bands = spark.createDataFrame([(1, 0, 100), (1, 10, 20), (1, 40, 50), (1, 103, 110), (1, 116, 130), (2, 5, 9)], "k int, begin int, end int")
    assert sorted(map(tuple, grid.merged(bands, ["k"]).collect())) == [(1, 0, 113), (1, 113, 133)]
