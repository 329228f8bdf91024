"""Typed pages of reports."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.operators import persist
from parcela.plans import catalogue, report

from .registry import dealt, query


def _texts(rows: DataFrame, key: str, fields: dict) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), c.alias("text")) for n, c in fields.items()])
    return rows.select(F.col(key).alias("doc_id"), F.explode(pairs).alias("p")).select("doc_id", "p.*")


def _single(page: int) -> None:
    """Enters a query of all fields of a page: each kind has a text that only its own rule reads right."""
    kinds = catalogue.single(page)
    #: Per kind the text that a box has, and the value that is to come of it; ``#`` is the field's place.
    made = {
        "text": (r"concat(' V#\n', p_partkey, ' ')", "'V#' || chr(10) || p_partkey"),
        "line": (r"concat(' V#\n', p_partkey, ' ')", "'V# ' || p_partkey"),
        "number": (r"concat('total\n', p_size + #, ',5\n99')", "(p_size + # + 0.5)::double"),
        "last": (r"if(p_size % 9 = 0, 'x', concat('99,5\n1.', lpad(p_size + #, 3, '0'), ',25\n'))", "case when p_size % 9 > 0 then p_size + # + 1000.25 end::double"),
        "unit": (r"if(p_size % 3 = 0, 'sin dato', concat(p_size % 5, ',25 [W/m2K]'))", "case when p_size % 3 > 0 then p_size % 5 + 0.25 end::double"),
        "integer": (r"concat('Ahorro\n', p_partkey % 140 - 50, '\n7')", "p_partkey % 140 - 50"),
        "date": (r"concat('Emitida el\n', lpad(p_size % 28 + 1, 2, '0'), if(p_size % 2 = 0, '-03-2019', ' de marzo de 2019'))", "'2019-03-' || lpad((p_size % 28 + 1)::varchar, 2, '0')"),
    }
    sql = ", ".join(f"{made[k][1].replace('#', str(i))} as {c}" for i, (c, k) in enumerate(kinds.items()))
    if page == 1:
        tests = " ".join(f"when p_partkey % 140 - 50 <= {b} then '{g}'" for b, g in ((-35, "G"), (-10, "F"), (20, "E"), (40, "D"), (55, "C"), (70, "B"), (85, "A")))
        sql += f", case {tests} else 'A+' end as {report.LETTER}"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = {c: F.expr(made[k][0].replace("#", str(i))) for i, (c, k) in enumerate(kinds.items())}
        out = report.single_page(_texts(dealt(spark, sf_dir, "part", "p_partkey", "p_size"), "p_partkey", fields), "doc_id", page)
        return out.withColumn("emitida_el", F.col("emitida_el").cast("string")) if page == 1 else out

    run.__name__ = f"report_page_{page}"
    query(f"select p_partkey as doc_id, {sql} from part")(run)


for _page in (1, 2, 3, 7):
    _single(_page)


@query("""with s as (select p_partkey as doc_id, p_size from part), o as (select unnest(['Horiz', 'N', 'NE', 'E', 'SE', 'S', 'SO', 'O', 'NO', 'Pisos']) as orientacion_nombre, unnest(range(0, 10)) as i)
select doc_id, 'C' || doc_id as codigo_evaluacion_energetica, orientacion_nombre, (p_size + i + 0.5)::double as elementos_opacos_area_m2, (i + 0.25)::double as elementos_opacos_u_w_m2_k,
case when i < 9 then p_size * 1000 + i end::double as elementos_traslucidos_area_m2, case when i < 9 and i <> 4 then i + 0.75 end::double as elementos_traslucidos_u_w_m2_k,
case when i between 1 and 8 then i end::double as p01_w_k, case when i between 1 and 8 then i + 10 end::double as p02_w_k, case when i between 1 and 8 then i + 20 end::double as p03_w_k,
case when i between 1 and 8 then i + 30 end::double as p04_w_k, case when i between 1 and 8 then i + 40 end::double as p05_w_k,
case when i < 4 then i when i < 9 then i + 1 else 11 end + 0.5::double as ua_mas_phi_l from s, o""")
def report_envelope_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lambda n, x: f"array_join(transform(sequence(0, {n - 1}), i -> {x}), '\\n')"
    fields = {
        "codigo_evaluacion": "concat(' C', p_partkey)",
        "opacos_area": f"concat('Area\\n', {lines(10, "concat(p_size + i, ',5')")})",
        "opacos_u": lines(10, "concat(i, ',25')"),
        "traslucidos_area": lines(9, "concat(p_size, '.', lpad(i, 3, '0'))"),
        "traslucidos_u": f"concat('U\\n', {lines(9, "if(i = 4, '-', concat(i, ',75'))")})",
    }
    fields |= {f"p0{k}_w_k_{i}": f"'x\\n{i + 1 + 10 * (k - 1)}'" for k in range(1, 6) for i in range(8)}
    fields |= {f"ua_mas_phi_l_{i}": f"'{i},5'" for i in range(12)}
    texts = _texts(dealt(spark, sf_dir, "part", "p_partkey", "p_size"), "p_partkey", {k: F.expr(v) for k, v in fields.items()})
    page = report.envelope_page(report.envelope_lists(texts, "doc_id"), "doc_id").drop("pos")
    return page.withColumnsRenamed({c: persist.table_column("pagina3_envolvente", c) for c in page.columns if c != "doc_id"})


@query("""with d as (select p_partkey as doc_id, p_size from part),
t as (select unnest(['pagina1', 'pagina2', 'pagina3_consumos', 'pagina3_envolvente', 'pagina4', 'pagina5', 'pagina6', 'pagina7']) as table_name, unnest([1, 1, 1, 10, 12, 2, 96, 1]) as n, unnest([1, 2, 3, 3, 4, 5, 6, 7]) as page_no)
select doc_id, table_name, case when p_size % 7 + 1 = page_no then 0 else n end::bigint as n_rows from d, t""")
def report_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight tables from spans; each report lacks one page."""
    pages = dealt(spark, sf_dir, "part", "p_partkey", "p_size").selectExpr("p_partkey as doc_id", "p_size", "explode(sequence(1, 7)) as page_no").where("page_no <> p_size % 7 + 1")
    spans = pages.selectExpr("doc_id", "page_no", "215.9D as page_w", "330.0D as page_h", "70.0D as x0", "32.0D as y0", "80.0D as x1", "34.0D as y1", "10.0D as font_size", "concat('C', doc_id) as text")
    return report.page_rows(report.extract(spans, "doc_id"), "doc_id")


@query("select p_partkey as doc_id, 'C' || p_partkey as codigo_evaluacion, k::int as mes_id, (p_size + k + 0.5)::double as a, case when k <> 5 then p_size * 1000 + k end::double as b from part, range(1, 13) t(k)")
def report_monthly_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    fields = {f"a_mes_{k}": F.concat(size + k, F.lit(",5")) for k in range(1, 13)} | {f"b_mes_{k}": F.translate(F.format_number(size * 1000 + k, 1), ",.", ".,") for k in range(1, 13) if k != 5}
    fields["codigo_evaluacion"] = F.concat(F.lit("C"), F.col("p_partkey"), F.lit(" "))
    return report.monthly_page(_texts(dealt(spark, sf_dir, "part", "p_partkey", "p_size"), "p_partkey", fields), "doc_id", ["a", "b"])


@query("""select p_partkey as doc_id, o as orientacion_nombre, (i - 1)::int as pos, (p_size + i - 1)::double as elementos_opacos_area_m2,
case when i < 10 then p_size - i + 1 end::double as elementos_traslucidos_area_m2, case when i between 2 and 9 then i - 2 end::double as p01_w_k,
case when i <= 4 then i - 1 when i <= 9 then i else 11 end::double as ua_mas_phi_l
from part, (select unnest(['Horiz', 'N', 'NE', 'E', 'SE', 'S', 'SO', 'O', 'NO', 'Pisos']) as o, unnest(range(1, 11)) as i)""")
def report_envelope_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = lambda sql: f"transform({sql}, x -> cast(x as double))"
    lists = dealt(spark, sf_dir, "part", "p_partkey", "p_size").selectExpr(
        "p_partkey as doc_id",
        f"{series('sequence(p_size, p_size + 9)')} as opaque",
        f"{series('sequence(p_size, p_size - 8)')} as translucent",
        f"{series('sequence(0, 7)')} as p01_w_k",
        f"{series('sequence(0, 11)')} as totals",
    )
    return report.envelope_page(lists, "doc_id")


@query("""select p_partkey as doc_id, case p_size % 2 when 0 then 1 else 7 end::int as mes_id, h::int as hora, case when h < 20 then h + 0.5 end::double as temperatura_exterior,
(20 - h)::double as temperatura_interior, h >= 20 or (h < p_size % 24 and h % 5 = 0) as ocr_low_confidence from part, range(0, 24) t(h)""")
def report_hourly_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = dealt(spark, sf_dir, "part", "p_partkey", "p_size").selectExpr(
        "p_partkey as doc_id",
        "if(p_size % 2 = 0, 'enero', 'Julio') as month",
        "transform(sequence(0, 19), h -> cast(h + 0.5D as double)) as `outer`",
        "transform(sequence(0, 23), h -> cast(20 - h as double)) as `inner`",
        "transform(if(p_size % 24 = 0, array(), sequence(0, p_size % 24 - 1)), h -> if(h % 5 = 0, 0.4D, 0.9D)) as outer_scores",
        "cast(null as array<double>) as inner_scores",
    )
    return report.hourly_page(cells, "doc_id")
