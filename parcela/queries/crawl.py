"""Incremental crawls."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcela.functions import numbers
from parcela.operators import directory
from parcela.sources import listing
from parcela.storage import scratch
from parcela.streaming import early_stop

from .registry import dealt, query, reports, table

def _grid_page(tipo: str, ident: str, letter: str, inputs: str, n: str) -> str:
    """SQL for a page with a row in the grid of its kind, another in the other kind's grid, and both counts."""
    own, other = (f"if({tipo} = 2, '{a}', '{b}')" for a, b in (("Cal", "Pre"), ("Pre", "Cal")))
    row = (
        f"concat('<tr><td class=\"n\">1</td><td>', {ident}, '</td><td style=\"x\">no</td><td>Casa &amp; Patio</td><td> Centro </td><td></td>"
        f"<td><div><img src=\"i/Letra', {letter}, '.png\"></div></td><td><div><img src=\"i/Letra--.png\"></div></td><td>', {inputs}, '</td></tr>')"
    )
    span = "concat('<span id=\"ContentPlaceHolder1_ResultadoGrilla', {0}, '\">Hay <b>', {1}, '</b> Viviendas</span>')"
    grid = "concat('<table id=\"ContentPlaceHolder1_grdViviendas', {0}, '\"><tbody>', {1}, '</tbody></table>')"
    parts = [span.format(other, "7"), span.format(own, n), grid.format(other, "'<tr><td>wrong</td></tr>'"), grid.format(own, row)]
    return f"concat('<html><body><table><tbody><tr><td>layout', {', '.join(parts)}, '</td></tr></tbody></table>')"


_INPUTS = """concat('<div class="BtVerMapa"><div><input name="m', p_partkey, '"></div></div>', if(p_size % 3 = 0, '', concat('<div class="BtVerEtiqueta"><div><input name="r', p_partkey, '"></div></div>')))"""


@query("""select p_partkey::int as comuna_id, (p_size % 2 + 1)::int as tipo, 1 as page_no, 0 as row_no, 'v' || p_partkey as identificacion, 'Casa & Patio' as tipologia, 'Centro' as comuna,
null::varchar as proyecto, case p_size % 4 when 0 then 'A+' when 1 then 'B' when 2 then null else 'G' end as calificacion_energetica, null::varchar as calificacion_equipos,
case when p_size % 3 <> 0 then 'r' || p_partkey end as codigo_informe, 'm' || p_partkey as codigo_etiqueta from part where p_size % 5 <> 0""")
def listing_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the grid of a page's own kind; those without an identification are left out."""
    letter = "element_at(array('A+', 'B', '--', 'G'), p_size % 4 + 1)"
    html = _grid_page("(p_size % 2 + 1)", "if(p_size % 5 = 0, ' ', concat(' v', p_partkey, ' '))", letter, _INPUTS, "'1'")
    pages = dealt(spark, sf_dir, "part", "p_partkey", "p_size").selectExpr("cast(p_partkey as int) as comuna_id", "cast(p_size % 2 + 1 as int) as tipo", "1 as page_no", f"{html} as html")
    return listing.rows_of(pages)


@query("""select c_custkey, o.id::int as id, o.name from customer, (select unnest([1, 2]) as k) u,
(select 1) x, lateral (select case k when 1 then c_nationkey else c_nationkey + 100 end as id, case k when 1 then 'Ñuñoa ' || c_custkey else 'A&B' end as name) o""")
def listing_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = """concat('<select id="dbRegion"><option value="3">no</option></select><select id="dbComuna">\n<option selected value="-1">Elija</option>',
        '<option value="', c_nationkey, '"> Ñuñoa ', c_custkey, ' </option>\n<option class="x" value="', c_nationkey + 100, '">A&amp;B</option></select><option value="9">no</option>')"""
    found = dealt(spark, sf_dir, "customer", "c_custkey", "c_nationkey").select("c_custkey", F.explode(listing.options_of(F.expr(html))).alias("o"))
    return found.select("c_custkey", "o.*")


@query("""with p as (select n_nationkey::int as comuna_id, n_regionkey::int as region_id, case when n_nationkey % 2 = 0 then 'done' else 'pending' end as status, (n_nationkey % 6)::int as pages_done from nation where n_nationkey % 5 <> 0),
u as (select n_nationkey::int as comuna_id, case when n_nationkey % 4 = 0 then 'boom' end as last_error, (n_nationkey % 3)::int as pages_done, n_regionkey::int as region_id from nation where n_nationkey % 3 <> 0)
select coalesce(p.comuna_id, u.comuna_id) as comuna_id, case when u.comuna_id is null then p.status when u.last_error is null then 'done' else 'pending' end as status,
case when u.comuna_id is null then p.pages_done when u.last_error is not null then greatest(u.pages_done, coalesce(p.pages_done, u.pages_done)) else u.pages_done end as pages_done,
u.last_error, coalesce(u.region_id, p.region_id) as region_id, case when u.comuna_id is null then '2020-01-01' else '2030-01-01' end as updated_at from p full join u using (comuna_id)""")
def progress_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    known = n.where("n_nationkey % 5 <> 0").selectExpr(
        "cast(n_nationkey as int) as comuna_id", "cast(n_regionkey as int) as region_id", "if(n_nationkey % 2 = 0, 'done', 'pending') as status", "cast(n_nationkey % 6 as int) as pages_done", "cast(null as string) as last_error", "date'2020-01-01' as updated_at"
    )
    units = n.where("n_nationkey % 3 <> 0").selectExpr(
        "cast(n_nationkey as int) as comuna_id", "cast(n_regionkey as int) as region_id", "if(n_nationkey % 4 = 0, 'pending', 'done') as status", "cast(n_nationkey % 3 as int) as pages_done", "if(n_nationkey % 4 = 0, 'boom', null) as last_error"
    )
    out = directory.saved_progress(known, units, ["comuna_id"], F.lit("2030-01-01"))
    return out.withColumn("updated_at", F.col("updated_at").cast("string"))


@query("""with p as (select o_custkey as unit, row_number() over (partition by o_custkey order by o_orderkey) as page, (o_orderkey % 4) as n_rows, case when o_orderkey % 4 > 0 and o_orderkey % 5 = 0 then 1 else 0 end as n_new from orders),
f as (select *, sum((n_new > 0)::int) over (partition by unit order by page desc) as isle from p where n_rows > 0),
d as (select *, sum((n_new = 0)::int) over (partition by unit, isle order by page desc) as dry from f), s as (select unit, max(page) as stop from d where dry = 2 group by 1)
select p.unit, p.page::int as page, stop is not null as early_stopped from p left join s using (unit) where stop is null or page >= stop""")
def early_stop_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    pages = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("unit"), page.alias("page"), (F.col("o_orderkey") % 4).alias("n_rows"), F.expr("if(o_orderkey % 4 > 0 and o_orderkey % 5 = 0, 1, 0)").alias("n_new"))
    return directory.early_stop(pages, ["unit"], "page", 2, reverse=True).select("unit", "page", "early_stopped")


_UNITS = """u as (select n_nationkey as comuna_id, t as tipo, n_regionkey as region_id from nation, range(1, 3) r(t)),
p as (select *, case when (comuna_id + tipo) % 3 = 0 then 'done' else 'pending' end as status, comuna_id % 4 as pages_done from u where comuna_id % 5 <> 0)"""


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(F.col("n_nationkey").alias("comuna_id"), F.explode(F.expr("array(1L, 2L)")).alias("tipo"), F.col("n_regionkey").alias("region_id"))


def _progress(units: DataFrame) -> DataFrame:
    status = F.when((F.col("comuna_id") + F.col("tipo")) % 3 == 0, "done").otherwise("pending")
    return units.where("comuna_id % 5 <> 0").withColumns({"status": status, "pages_done": F.col("comuna_id") % 4})


_EARLY = """with r as (select *, (row_number() over (partition by user_id order by ts, event_id) - 1) // 3 + 1 as page from events),
p as (select user_id, page, count(*) filter (event_type <> 'signup') as n_rows, count(*) filter (event_type <> 'signup' and event_id % 7 = 0) as n_new from r group by all),
f as (select *, sum((n_new > 0)::int) over (partition by user_id order by page) as isle from p where n_rows > 0),
d as (select *, sum((n_new = 0)::int) over (partition by user_id, isle order by page) as dry from f),
s as (select user_id, min(page) as stop from d where dry = 2 group by 1)
select p.*, stop is not null as early_stopped from p left join s using (user_id) where stop is null or page <= stop"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as units, their events as rows of pages of three."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").withColumn("page", F.expr("1L") + F.floor((F.row_number().over(w) - 1) / 3))
    listed = F.col("event_type") != "signup"
    return rows.groupBy("user_id", "page").agg(F.count_if(listed).alias("n_rows"), F.count_if(listed & (F.col("event_id") % 7 == 0)).alias("n_new"))


@query(_EARLY)
def early_stop_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directory.early_stop(_pages(spark, sf_dir), ["user_id"], "page")


@query(_EARLY)
def early_stop_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same verdicts from a stream of the pages, whose state is a few numbers a unit."""
    given, mark, out = (scratch(spark, n) for n in ("pages", "mark", "visited"))
    pages = _pages(spark, sf_dir)
    pages.write.parquet(given)
    seen = early_stop.visited(spark.readStream.schema(pages.schema).parquet(given), ["user_id"], "page")
    seen.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    found = spark.read.schema(seen.schema).parquet(out)
    ended = found.groupBy("user_id").agg(F.bool_or("stops").alias("early_stopped"))
    return found.drop("stops").join(ended, "user_id")


@query(f"with {_UNITS} select u.comuna_id, u.tipo, (coalesce(pages_done, 0) + 1)::bigint as start_page from u left join p using (comuna_id, tipo) where status is null or status <> 'done'")
def resume_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _units(spark, sf_dir)
    return directory.resume_plan(units, _progress(units), ["comuna_id", "tipo"])


@query(f"with {_UNITS} select comuna_id, tipo, 1::bigint as start_page from u")
def incremental_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _units(spark, sf_dir)
    return directory.resume_plan(units, _progress(units), ["comuna_id", "tipo"], incremental=True)


@query(f"""with {_UNITS} select region_id, sum(pages_done)::bigint as rows_new, count(*) filter (status = 'done') as errors, count(*) as units
from p group by rollup (region_id)""")
def discovery_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _progress(_units(spark, sf_dir)).withColumns({"rows_new": F.col("pages_done"), "last_error": F.when(F.col("status") == "done", "e")})
    return directory.rollup_discovery(done)


@query("select n, case when coalesce(n, 0) = 0 then 0 else greatest(1, ceil(n / 10.0)) end::bigint as pages, count(*) as units from (select nullif(p_partkey % 137, 5) as n from part) group by n")
def page_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "part").select(F.expr("nullif(p_partkey % 137, 5)").alias("n"))
    return n.groupBy("n", numbers.page_count(F.col("n")).alias("pages")).agg(F.count("*").alias("units"))


@query("""select c_custkey, case when c_custkey % 10 = 3 then 0 else c_custkey * 1000 end as found from customer""")
def result_count_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    dotted = F.translate(F.format_number(c * 1000, 0), ",", ".")
    text = F.when(c % 10 == 3, "Sin resultados").otherwise(F.concat(F.lit("Se encontraron "), dotted, F.lit("  Viviendas")))
    return table(spark, sf_dir, "customer").select("c_custkey", numbers.result_count(text).alias("found"))


@query("""select o_orderkey as eval_id, (o_orderkey % 5)::bigint as attempt, 2.0 * pow(2, o_orderkey % 5) as database_s, 3.0::double * (o_orderkey % 5 + 1) as portal_s
from orders join customer on o_custkey = c_custkey where o_orderstatus = 'F'""")
def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long each failed report waits before its next attempt, by its retries."""
    k = F.col("retry_count")
    failed = reports(spark, sf_dir).where("pdf_status = 'failed'")
    return failed.select("eval_id", k.cast("bigint").alias("attempt"), numbers.backoff(k, 2.0).alias("database_s"), numbers.backoff(k, 3.0, "linear").alias("portal_s"))


@query("""with k as (select distinct l_suppkey, l_partkey from lineitem where l_returnflag = 'R')
select l_suppkey, count(distinct l_partkey)::int as fresh from lineitem where (l_suppkey, l_partkey) not in (select l_suppkey, l_partkey from k) group by 1""")
def discover_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a crawl counts as new: rows that the directory lacks, each once however many pages list it."""
    rows = table(spark, sf_dir, "lineitem")
    known = rows.where("l_returnflag = 'R'").select("l_suppkey", "l_partkey")
    key = F.concat_ws(":", "l_suppkey", "l_partkey")
    return directory.fresh_rows(rows.withColumn("key", key), known.withColumn("key", key), ["key"], ["l_suppkey"])
