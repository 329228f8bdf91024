"""Listing pages: their fields, their rows, and a data source that crawls them."""

from __future__ import annotations

import json
import math
import re
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from html.parser import HTMLParser
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

PAGE_SIZE = 10
#: Ids of the elements that hold the count and the rows of each kind of report, the classes around
#: the inputs that name a report and its label, and the hidden fields that carry a session's state.
COUNT_SPAN = {1: "ContentPlaceHolder1_ResultadoGrillaPre", 2: "ContentPlaceHolder1_ResultadoGrillaCal"}
GRID_TABLE = {1: "ContentPlaceHolder1_grdViviendasPre", 2: "ContentPlaceHolder1_grdViviendasCal"}
REPORT_BOX, LABEL_BOX = "BtVerEtiqueta", "BtVerMapa"
HIDDEN = ("__VIEWSTATE", "__VIEWSTATEGENERATOR", "__EVENTVALIDATION")
ROW_SCHEMA = (
    "identificacion string, tipologia string, comuna string, proyecto string, calificacion_energetica string, "
    "calificacion_equipos string, codigo_informe string, codigo_etiqueta string"
)
_COLUMNS = [c.split()[0] for c in ROW_SCHEMA.split(", ")]


def page_fields(pages: DataFrame) -> DataFrame:
    """page_id, n_links, n_items and lang of raw pages, by patterns of their start tags: null html has none."""
    html = F.coalesce("html", F.lit(""))
    count = lambda tag: F.regexp_count(html, F.lit(rf"(?i)<{tag}(?=[\s/>])")).cast("bigint")
    lang = F.nullif(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([^"'\s>]*)""", 1), F.lit(""))
    return pages.select("page_id", count("a").alias("n_links"), count("li").alias("n_items"), lang.alias("lang"))


class _Cell:
    def __init__(self, plain: bool) -> None:
        self.plain, self.text = plain, ""
        self.images: list[str] = []
        self.inputs: dict[str, str] = {}


class _Page(HTMLParser):
    """The count and the grid rows of one kind of report; other tables of the page are passed over."""

    def __init__(self, tipo: int) -> None:
        super().__init__(convert_charrefs=True)
        self.span, self.grid = COUNT_SPAN[tipo], GRID_TABLE[tipo]
        self.count = ""
        self.rows: list[list[_Cell]] = []
        self.tables: list[bool] = []  # the open tables, and whether each is the grid
        self.spans: list[bool] = []
        self.boxes: list[str] = []  # the open boxes of the cell
        self.body = self.in_cell = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        if tag == "span":
            self.spans.append(a.get("id") == self.span)
        elif tag == "table":
            self.tables.append(a.get("id") == self.grid)
        if not (self.tables and self.tables[-1]):
            return
        if tag == "tbody":
            self.body = True
        elif self.body and tag == "tr":
            self.rows.append([])
            self.in_cell = False
        elif self.body and tag == "td" and self.rows:
            self.rows[-1].append(_Cell("class" not in a and "style" not in a))
            self.in_cell, self.boxes = True, []
        elif self.in_cell:
            cell = self.rows[-1][-1]
            if tag == "div":
                self.boxes.append(a.get("class") or "")
            elif tag == "img":
                cell.images.append(a.get("src") or "")
            elif tag == "input":
                box = next((b for b in reversed(self.boxes) if b in (REPORT_BOX, LABEL_BOX)), "")
                cell.inputs.setdefault(box, a.get("name") or "")

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("span", "table", "div"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "span" and self.spans:
            self.spans.pop()
        elif tag == "table" and self.tables:
            if self.tables.pop():
                self.body = self.in_cell = False
        elif tag in ("td", "tr", "tbody") and self.tables and self.tables[-1]:
            self.in_cell = False
            self.body = self.body and tag != "tbody"
        elif tag == "div" and self.in_cell and self.boxes:
            self.boxes.pop()

    def handle_data(self, data: str) -> None:
        if any(self.spans):
            self.count += data + " "
        if self.in_cell and self.tables and self.tables[-1] and not self.boxes:
            self.rows[-1][-1].text += data


def _grade(cells: list[_Cell], from_last: int) -> str | None:
    if len(cells) < from_last:
        return None
    for name in cells[-from_last].images:
        if m := re.search(r"Letra(.*?)\.png", name):
            return None if m[1] == "--" else m[1]
    return None


def _read(html: str | None, tipo: int) -> _Page:
    page = _Page(tipo)
    page.feed(html or "")
    page.close()
    return page


def grid_rows(html: str | None, tipo: int) -> list[dict]:
    """The rows of the kind's result grid, each read on its own: a missing cell is null in its row alone.

    The first four cells without class and style are texts, the two before the last have images of grades, and the
    last has the inputs of the report and the label. Rows without an identification are left out.
    """
    out = []
    for cells in _read(html, tipo).rows:
        text = [" ".join(c.text.split()) or None for c in cells if c.plain][:4]
        text += [None] * (4 - len(text))
        if text[0]:
            inputs = cells[-1].inputs
            out.append(dict(zip(_COLUMNS, (*text, _grade(cells, 3), _grade(cells, 2), inputs.get(REPORT_BOX), inputs.get(LABEL_BOX)), strict=True)))
    return out


def result_count(html: str | None, tipo: int) -> int:
    """The count of the kind's results, by the rule of ``numbers.result_count``; 0 if the page has none."""
    words = _read(html, tipo).count.split()
    at = next((i for i, w in enumerate(words) if w.startswith("Vivienda")), 0)
    digits = words[at - 1].translate(str.maketrans("([", "::")).split(":")[-1].replace(".", "") if at else ""
    return int(digits) if digits.isdecimal() else 0


def rows_of(pages: DataFrame) -> DataFrame:
    """The grid rows of stored pages (comuna_id, tipo, page_no, html), with their place on the page."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                for k, found in enumerate(grid_rows(row["html"], row["tipo"])):
                    out.append({"comuna_id": row["comuna_id"], "tipo": row["tipo"], "page_no": row["page_no"], "row_no": k} | found)
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    numbers = ("comuna_id", "tipo", "page_no", "row_no")
    arrow = pa.schema([*[(n, pa.int32()) for n in numbers], *[(c, pa.string()) for c in _COLUMNS]])
    return pages.select("comuna_id", "tipo", "page_no", "html").mapInArrow(each, ", ".join(f"{n} int" for n in numbers) + f", {ROW_SCHEMA}")


class _Options(HTMLParser):
    """Value and text of each option of the lists whose id or name ends with ``block``; attributes come in any order."""

    def __init__(self, block: str) -> None:
        super().__init__(convert_charrefs=True)
        self.block, self.inside, self.found = block, False, []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        if tag == "select":
            self.inside = any((a.get(k) or "").endswith(self.block) for k in ("id", "name"))
        elif tag == "option" and self.inside:
            self.found.append([a.get("value"), ""])

    def handle_endtag(self, tag: str) -> None:
        if tag == "select":
            self.inside = False

    def handle_data(self, data: str) -> None:
        if self.inside and self.found:
            self.found[-1][1] += data


def options(html: str | None, block: str = "dbComuna") -> list[tuple[int, str]]:
    """(id, name) of the options of a drop-down list; -1 is its prompt, and an option without a whole number or a name is none."""
    parser = _Options(block)
    parser.feed(html or "")
    parser.close()
    pairs = [(v.strip(), " ".join(n.split())) for v, n in parser.found if v is not None]
    return [(int(v), n) for v, n in pairs if v.removeprefix("-").isdecimal() and int(v) != -1 and n]


def options_of(html: Column, block: str = "dbComuna") -> Column:
    """``options`` of each page, as an array of (id, name)."""

    @F.pandas_udf("array<struct<id: int, name: string>>")
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: [{"id": i, "name": n} for i, n in options(h, block)])

    return read(html)


def page_total(n: int) -> int:
    return max(1, math.ceil(n / PAGE_SIZE)) if n else 0


class Unit(InputPartition):
    """One commune and kind of report: read in one task, page by page, as the site keeps a session's state."""

    def __init__(self, comuna_id: int, tipo: int, first: int = 1) -> None:
        self.comuna_id, self.tipo, self.first = comuna_id, tipo, first


class Transport(Protocol):
    """Gives the pages of a unit; None where there is none. Page 1 is the one that a search gives."""

    def page(self, unit: Unit, number: int) -> str | None: ...  # noqa: E704


class StoredPages:
    """Pages kept as files of any file system that pyarrow opens by its URI (or of a plain path)."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def page(self, unit: Unit, number: int) -> str | None:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder)
        try:
            with system.open_input_stream(f"{path}/{unit.comuna_id}_{unit.tipo}_{number}.html") as f:
                return f.read().decode("utf-8")
        except FileNotFoundError:
            return None


class Retrying:
    """Another transport, asked again after growing waits while it fails; the last failure is raised."""

    def __init__(self, inner: Transport, attempts: int = 3, base: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> None:
        self.inner, self.attempts, self.base, self.sleep = inner, attempts, base, sleep

    def page(self, unit: Unit, number: int) -> str | None:
        for k in range(self.attempts):
            try:
                return self.inner.page(unit, number)
            except Exception:
                if k + 1 == self.attempts:
                    raise
                self.sleep(self.base * 2**k)
        return None


class FormSession:
    """A site of forms: each answer's hidden fields go out with the next request.

    ``send(fields)`` posts and returns the page, ``send({})`` gets it. The region is chosen before the search, as a
    search without it finds nothing; a unit's session lasts while its pages are asked for in turn.
    """

    def __init__(self, send: Callable[[dict], str], region_of: Callable[[int], int]) -> None:
        self.send, self.region_of = send, region_of
        self.state: dict[str, str] = {}
        self.unit: tuple[int, int] | None = None

    def _post(self, **fields) -> str:
        html = self.send({**self.state, **{k: str(v) for k, v in fields.items()}} if fields else {})
        for name in HIDDEN:
            if m := re.search(rf'id="{name}"\s+value="([^"]*)"', html):
                self.state[name] = m[1]
        return html

    def page(self, unit: Unit, number: int) -> str | None:
        key = (unit.comuna_id, unit.tipo)
        if self.unit != key or number == 1:
            self.state = {}
            self._post()
            region = self.region_of(unit.comuna_id)
            self._post(event="region", region=region)
            first = self._post(event="search", region=region, comuna=unit.comuna_id, tipo=unit.tipo)
            self.unit = key
            if number == 1:
                return first
        return self._post(event="page", comuna=unit.comuna_id, tipo=unit.tipo, page=number)


def crawl(transport: Transport, unit: Unit, known: Iterable[str] | None = None, grace: int = 2, most: int | None = None, incremental: bool | None = None) -> Iterator[tuple]:
    """What a unit's pages have: (page, place, row, is_new) for each row, and at last (None, -1, progress, None).

    A row is new if its identification is neither among ``known`` nor on a row before it. A full crawl reads all pages from
    ``unit.first`` on. An incremental one (by default, where ``known`` is given) reads from the last page back, as the site lists the
    oldest first, until ``grace`` pages in a row have rows but nothing new; pages without rows neither count nor
    interrupt. An error ends the unit, not the read: it is kept in the progress, with the last page that was done.
    """
    seen = set(known or ())
    back = known is not None if incremental is None else incremental
    progress = {"status": "pending", "pages_done": 0 if back else unit.first - 1, "total_pages": None, "rows_new": 0, "rows_seen": 0, "early_stopped": False, "last_error": None}
    try:
        html = transport.page(unit, 1)
        total = page_total(result_count(html, unit.tipo))
        total = min(total, most) if most else total
        progress["total_pages"] = total
        dry = 0
        for done, number in enumerate(range(total, 0, -1) if back else range(unit.first, total + 1), 1):
            rows = grid_rows(html if number == 1 else transport.page(unit, number), unit.tipo)
            fresh = 0
            for k, row in enumerate(rows):
                new = row["identificacion"] not in seen
                seen.add(row["identificacion"])
                fresh += new
                yield number, k, row, new
            progress |= {"pages_done": done if back else number, "rows_new": progress["rows_new"] + fresh, "rows_seen": progress["rows_seen"] + len(rows)}
            if back and rows:
                dry = 0 if fresh else dry + 1
                if dry >= grace:
                    progress["early_stopped"] = True
                    break
        progress["status"] = "done"
    except Exception as e:  # noqa: BLE001  a unit's failure must not end the others
        progress["last_error"] = str(e)[:300]
    yield None, -1, progress, None


PROGRESS_SCHEMA = "status string, pages_done int, total_pages int, rows_new int, rows_seen int, early_stopped boolean, last_error string"
_PROGRESS = [c.split()[0] for c in PROGRESS_SCHEMA.split(", ")]


SCHEMA = f"comuna_id int, tipo int, page_no int, row_no int, {ROW_SCHEMA}, is_new boolean, {PROGRESS_SCHEMA}"


def _record(unit: Unit, page: int | None, place: int, found: dict, new: bool | None) -> tuple:
    """A row of ``SCHEMA``: one of the grid, or with ``place`` -1 a unit's progress."""
    row = [None] * len(_COLUMNS) if place < 0 else [found[c] for c in _COLUMNS]
    state = [found[c] for c in _PROGRESS] if place < 0 else [None] * len(_PROGRESS)
    return (unit.comuna_id, unit.tipo, page, place, *row, new, *state)


def crawled(units: DataFrame, connect: Callable[[], Transport], grace: int = 2, most: int | None = None) -> DataFrame:
    """Crawls of ``units`` (comuna_id, tipo, first, incremental, known), each in one task, in the source's schema.

    ``known`` are the identifications that the unit has already, as Spark joined them: no task opens a
    table of its own. Both kinds of crawl tell new rows by them.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for u in b.to_pylist():
                unit = Unit(u["comuna_id"], u["tipo"], u["first"])
                rows = [_record(unit, *found) for found in crawl(connect(), unit, u["known"] or (), grace, most, u["incremental"])]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)

    kinds = to_arrow_schema(units.sparkSession.createDataFrame([], SCHEMA).schema)
    every = units.select("comuna_id", "tipo", "first", "incremental", "known")
    n = max(1, int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return every.repartition(n, "comuna_id", "tipo").mapInArrow(each, SCHEMA)


class ListingReader(DataSourceReader):
    """A partition per unit. Subclasses give another transport."""

    def __init__(self, folder: str, units: list[tuple[int, int, int]], known: str | None, grace: int, most: int | None) -> None:
        self.folder, self.units, self.known, self.grace, self.most = folder, units, known, grace, most

    def partitions(self) -> list[Unit]:
        return [Unit(*u) for u in self.units]

    def transport(self) -> Transport:
        return StoredPages(self.folder)

    def known_of(self, unit: Unit) -> frozenset[str] | None:
        """The unit's identifications in the Parquet table ``known``, a path that pyarrow opens; its row groups of other units are skipped."""
        if self.known is None:
            return None
        import pyarrow.dataset as ds

        of_unit = (ds.field("comuna_id") == unit.comuna_id) & (ds.field("tipo") == unit.tipo)
        found = ds.dataset(self.known, format="parquet").to_table(columns=["identificacion"], filter=of_unit)
        return frozenset(found.column(0).to_pylist())

    def read(self, unit: Unit) -> Iterator[tuple]:
        for found in crawl(self.transport(), unit, self.known_of(unit), self.grace, self.most):
            yield _record(unit, *found)


class Pages(InputPartition):
    """Some pages of a unit, from ``first`` to ``last``, of ``total``."""

    def __init__(self, unit: tuple[int, int], first: int, last: int, total: int) -> None:
        self.unit, self.first, self.last, self.total = unit, first, last, total


class ListingStream(DataSourceStreamReader):
    """Full crawls as a stream, whose offsets are the pages done of each unit: a batch has up to ``pages`` more of each.

    A page's last row (``row_no`` -1) has the progress of its unit; a page that fails has its error there, and the unit's
    other pages of the batch are left out. How many pages a unit has is asked once, ``sessions`` units at a time. ``state`` is a folder
    that the driver's Python can write to (a path, or a URI that pyarrow knows): it keeps the last offset, which Spark does
    not tell a reader that it starts anew. Spark notes an offset before it asks for its partitions, so what is kept never runs ahead.
    """

    def __init__(self, folder: str, units: list[tuple[int, int, int]], pages: int, state: str | None, most: int | None, sessions: int = 8) -> None:
        self.folder, self.units, self.pages, self.state, self.most, self.sessions = folder, units, pages, state, most, sessions
        self.at: dict[str, int] | None = None
        self.totals: dict[str, int] = {}

    def transport(self) -> Transport:
        return StoredPages(self.folder)

    def initialOffset(self) -> dict:
        return {f"{c}:{t}": first - 1 for c, t, first in self.units}

    def _kept(self) -> dict[str, int] | None:
        if self.state is None:
            return None
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.state) if "://" in self.state else (fs.LocalFileSystem(), self.state)
        try:
            with system.open_input_stream(f"{path}/offset") as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def _keep(self, at: dict[str, int]) -> None:
        self.at = at
        if self.state is not None:
            from pyarrow import fs

            system, path = fs.FileSystem.from_uri(self.state) if "://" in self.state else (fs.LocalFileSystem(), self.state)
            system.create_dir(path)
            with system.open_output_stream(f"{path}/offset.new") as f:
                f.write(json.dumps(at).encode())
            system.move(f"{path}/offset.new", f"{path}/offset")

    def _total(self, key: str) -> int:
        unit = Unit(*map(int, key.split(":")))
        try:
            total = page_total(result_count(self.transport().page(unit, 1), unit.tipo))
        except Exception:  # noqa: BLE001  the task that reads the first page tells the error
            return 1
        return min(total, self.most) if self.most else total

    def latestOffset(self) -> dict:
        at = self.at or self._kept() or self.initialOffset()
        asked = [u for u in at if u not in self.totals]
        with ThreadPoolExecutor(self.sessions) as pool:
            self.totals |= dict(zip(asked, pool.map(self._total, asked), strict=True))
        # A unit without results has one page, that says so.
        return {u: max(done, min(max(1, self.totals[u]), done + self.pages)) for u, done in at.items()}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        self._keep(end)
        return [Pages(tuple(map(int, u.split(":"))), start.get(u, 0) + 1, last, self.totals.get(u, 0)) for u, last in end.items() if last > start.get(u, 0)]

    def read(self, part: Pages) -> Iterator[tuple]:
        transport, unit = self.transport(), Unit(*part.unit, part.first)
        number = part.first
        # A replayed batch comes from a reader that has not asked for totals.
        total = part.total or None
        try:
            if total is None:
                total = self._total(f"{unit.comuna_id}:{unit.tipo}")
            for number in range(part.first, part.last + 1):
                rows = grid_rows(transport.page(unit, number), unit.tipo)
                for k, row in enumerate(rows):
                    yield _record(unit, number, k, row, None)
                done = {"status": "done" if number >= total else "pending", "pages_done": min(number, total), "total_pages": total, "rows_new": None, "rows_seen": len(rows), "early_stopped": False, "last_error": None}
                yield _record(unit, number, -1, done, None)
        except Exception as e:  # noqa: BLE001  a unit's failure must not end the others
            failed = {"status": "pending", "pages_done": number - 1, "total_pages": total, "rows_new": None, "rows_seen": 0, "early_stopped": False, "last_error": str(e)[:300]}
            yield _record(unit, number, -1, failed, None)


class ListingSource(DataSource):
    """``spark.read.format("listing")``.

    Options: ``path``; ``units`` as ``comuna:tipo[:first page]``, comma-joined; for an incremental crawl ``known``, a Parquet
    table of (comuna_id, tipo, identificacion), and ``grace``; ``most`` pages of a unit. A unit's last row has its progress (``row_no`` -1).
    ``spark.readStream`` takes ``pages`` of each unit for a batch, and ``state`` (see ``ListingStream``).
    """

    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return SCHEMA

    def _units(self) -> list[tuple[int, int, int]]:
        units = [tuple(int(x) for x in u.split(":")) for u in self.options.get("units", "").split(",") if u]
        return [(*u, 1)[:3] for u in units]

    def _most(self) -> int | None:
        return int(self.options["most"]) if self.options.get("most") else None

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options["path"], self._units(), self.options.get("known"), int(self.options.get("grace", "2")), self._most())

    def streamReader(self, schema) -> ListingStream:
        return ListingStream(self.options["path"], self._units(), int(self.options.get("pages", "10")), self.options.get("state"), self._most())


def found_rows(read: DataFrame) -> DataFrame:
    """The rows of reports in what the source read."""
    return read.where("row_no >= 0").drop(*_PROGRESS)


def progress_of(read: DataFrame, *more: str) -> DataFrame:
    """The progress of each unit in what the source read; of a stream, that after each page."""
    return read.where("row_no < 0").select("comuna_id", "tipo", *more, *_PROGRESS)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ListingSource)
