"""Numbers, dates, texts and ids."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.functions import dates, numbers, strings
from parcela.sources import files

from .registry import query, table

_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"select {', '.join(_LINE)}, round(l_extendedprice, 2) as value from lineitem")
def locale_number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    us = F.format_number("l_extendedprice", 2)
    es = F.translate(us, ",.", ".,")
    text = F.when(F.col("l_linenumber") % 3 == 0, us).when(F.col("l_linenumber") % 3 == 1, es).otherwise(F.concat(F.lit(" total \n\n"), es, F.lit("\n7")))
    return table(spark, sf_dir, "lineitem").select(*_LINE, numbers.locale_number(text).alias("value"))


@query(f"select {', '.join(_LINE)}, case when l_linenumber = 2 then null else round(l_discount * 10, 3) end as value from lineitem")
def unit_number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("[W/m2K] "), F.translate(F.format_number(F.col("l_discount") * 10, 3), ".", ","))
    shown = F.when(F.col("l_linenumber") == 2, "n/a").otherwise(text)
    return table(spark, sf_dir, "lineitem").select(*_LINE, numbers.unit_number(shown).alias("value"))


@query("select p_partkey, p_size::double + 0.5 as value from part")
def last_line_number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("UA\n"), F.col("p_size"), F.lit(",5\n"))
    return table(spark, sf_dir, "part").select("p_partkey", numbers.last_line_number(text).alias("value"))


@query("select p_partkey, -(p_size + 100.5)::double as value from part")
def ocr_text_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("x - "), F.replace((F.col("p_size") + 100).cast("string"), F.lit("0"), F.lit("O")), F.lit(" ,5 C"))
    return table(spark, sf_dir, "part").select("p_partkey", numbers.ocr_number(text).alias("value"))


@query(f"""with s as (select {', '.join(_LINE)}, l_discount * 12 - 0.4 as share from lineitem)
select {', '.join(_LINE)}, case when share <= -0.35 then 'G' when share <= -0.1 then 'F' when share <= 0.2 then 'E' when share <= 0.4 then 'D'
when share <= 0.55 then 'C' when share <= 0.7 then 'B' when share <= 0.85 then 'A' else 'A+' end as grade from s""")
def grade_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*_LINE, numbers.grade(F.col("l_discount") * 12 - 0.4).alias("grade"))


@query("""select p_partkey, case when p_partkey % 50 = 0 then 0 else round(p_size * 4.0 / 215.9 * p_retailprice, 6) end as x,
case when p_partkey % 50 = 0 then 0 else round(p_size * 6.0 / 330.0 * (p_retailprice * 2), 6) end as y from part""")
def coord_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = F.when(F.col("p_partkey") % 50 == 0, F.lit(0.0)).otherwise(F.col("p_retailprice"))
    x, y = numbers.to_page(F.col("p_size") * 4.0, F.col("p_size") * 6.0, width, width * 2)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query("""select o_orderkey, case when o_orderkey % 10 = 7 or o_orderkey % 12 = 2 then null else o_orderdate::date::varchar end as parsed from orders""")
def locale_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    names = F.array(*[F.lit(n) for n, _ in sorted(((n, m) for n, m in dates.MONTHS.items() if n != "setiembre"), key=lambda x: x[1])])
    long = F.concat_ws(" de ", F.dayofmonth(d), F.initcap(F.element_at(names, F.month(d))), F.year(d))
    text = (
        F.when(k % 10 == 7, F.concat(F.lit("32-13-2020 o "), long))
        .when(k % 3 == 0, F.date_format(d, "dd-MM-yyyy"))
        .when(k % 3 == 1, F.concat(F.lit("  "), F.date_format(d, "d / M / yyyy"), F.lit(" 10:30")))
        .when(k % 12 == 2, F.concat(F.lit("Santiago, "), long))
        .otherwise(F.concat(long, F.lit(".")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.report_date(text).cast("string").alias("parsed"))


@query("""select o_orderkey, case when o_orderkey % 10 = 7 then null else month(o_orderdate)::int end as mes_id, case when o_orderkey % 20 between 1 and 12 then (o_orderkey % 20)::int end as given from orders""")
def month_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n, _ in sorted(((n, m) for n, m in dates.MONTHS.items() if n != "septiembre"), key=lambda x: x[1])])
    name = F.concat(F.lit(" "), F.upper(F.element_at(names, F.month("o_orderdate"))))
    shown = F.when(F.col("o_orderkey") % 10 == 7, F.month("o_orderdate").cast("string")).otherwise(name)
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.month_of_name(shown).alias("mes_id"), dates.month_of_number(F.col("o_orderkey") % 20).alias("given"))


@query("""with h as (select c_custkey, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(c_nationkey || '_5_1_' || c_name || 'ñ')) as h from customer)
select c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
|| substr('89ab', (('0x' || substr(h, 17, 1))::int & 3) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) as eval_id from h""")
def deterministic_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ident = F.concat("c_name", F.lit("ñ"))
    return table(spark, sf_dir, "customer").select("c_custkey", strings.listing_id(F.col("c_nationkey"), F.lit(5), F.lit(1), ident).alias("eval_id"))


@query(r"select doc_id, regexp_replace(replace(text, chr(10), ' '), '^\s+|\s+$', '', 'g') as description from documents")
def clean_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", strings.one_line(F.col("text")).alias("description"))


@query("select o_orderkey, case o_orderkey % 3 when 0 then -o_orderkey end as value from orders")
def first_int_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("code 4\n-"), k, F.lit("\n77"))).when(k % 3 == 1, F.concat(F.lit("--5\n"), k)).otherwise("none")
    return table(spark, sf_dir, "orders").select("o_orderkey", numbers.first_int_line(text).alias("value"))


@query("""select doc_id, case doc_id % 3 when 0 then '%PDF-1.4 ' || coalesce(text, '') || '%%EOF x %%EOF' when 1 then '%PDF' || coalesce(text, '') end as carved,
doc_id % 3 = 0 and octet_length(encode('%PDF-1.4 ' || coalesce(text, '') || '%%EOF x %%EOF')) > 1000 as accepted from documents""")
def carve_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as payloads, carved as bytes."""
    k, body = F.col("doc_id"), F.coalesce("text", F.lit(""))
    text = F.when(k % 3 == 0, F.concat(F.lit("junk%PDF-1.4 "), body, F.lit("%%EOF x %%EOF\r\n<html>"))).when(k % 3 == 1, F.concat(F.lit("%PDF"), body)).otherwise("<html>%%EOF")
    carved = files.carved(F.encode(text, "UTF-8"))
    status = F.when(k % 3 == 1, 500).otherwise(200)
    return table(spark, sf_dir, "documents").select("doc_id", F.decode(carved, "UTF-8").alias("carved"), strings.acceptable(status, carved).alias("accepted"))


@query("""select o_orderkey, o_orderdate::date::varchar as day, strftime(o_orderdate::timestamp, '%Y-%m-%dT%H:%M:%S')
|| case when o_orderkey % 2 = 0 then '' else '.250000' end || '+00:00' as moment, o_orderpriority[1] || lower(o_orderpriority[2:]) as name from orders""")
def iso_serialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.col("o_orderdate").cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, 0, (o_orderkey % 2) * 0.25)")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), moment.alias("moment"), "o_orderpriority")
    shown = [dates.iso(F.col(c), dict(rows.dtypes)[c]).alias(c) for c in ("o_orderkey", "day", "moment")]
    return rows.select(*shown, strings.capitalised(F.col("o_orderpriority")).alias("name"))


@query("select p_partkey, case p_size % 3 when 0 then 'A+' when 1 then null else 'C' end as letra, case when p_size % 2 = 0 then 'v' || p_size else '' end as viewstate from part")
def listing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    image = F.when(s % 3 == 0, "img/LetraA+.png").when(s % 3 == 1, "img/Letra--.png").otherwise("LetraC.png?LetraD.png")
    html = F.when(s % 2 == 0, F.concat(F.lit('<input id="__STATE" value="v'), s, F.lit('"/>'))).otherwise('<input id="x"/>')
    return table(spark, sf_dir, "part").select("p_partkey", strings.grade_of_image(image).alias("letra"), strings.hidden_field(html, "__STATE").alias("viewstate"))
