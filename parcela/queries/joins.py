"""Lookups, membership and repeated keys."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.functions.dates import MONTHS
from parcela.operators import directory, work

from .registry import EV, query, reports, table


@query(f"""with {EV} select eval_id, n_name as comuna, r_name as region from ev
left join nation on n_nationkey = comuna_id left join region on r_regionkey = n_regionkey and r_regionkey <> 2""")
def eval_region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    communes = table(spark, sf_dir, "nation").selectExpr("n_nationkey as comuna_id", "n_name as comuna", "n_regionkey as region_id")
    regions = table(spark, sf_dir, "region").where("r_regionkey <> 2").selectExpr("r_regionkey as region_id", "r_name as region")
    return directory.placed(reports(spark, sf_dir), communes, regions).select("eval_id", "comuna", "region")


@query(f"with {EV} select eval_id from ev where pdf_status = 'pending' and comuna_id in (select n_nationkey from nation where n_regionkey = 1)")
def region_scoped_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("comuna_id"))
    return work.pending(reports(spark, sf_dir), region).select("eval_id")


@query(f"with {EV} select eval_id from ev where pdf_status = 'pending' order by eval_id limit 25")
def pending_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work.pending(reports(spark, sf_dir), limit=25).select("eval_id")


@query(f"with {EV} select eval_id from ev where eval_id not in (select eval_id from ev where pdf_status = 'failed')")
def new_rows_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = reports(spark, sf_dir)
    return directory.new_rows(ev, ev.where("pdf_status = 'failed'"), ["eval_id"]).select("eval_id")


@query("select count(*) as n, sum(l_quantity)::bigint as quantity from lineitem where l_linenumber = 1")
def month_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = spark.createDataFrame([(k, n) for n, k in MONTHS.items() if n != "setiembre"], "mes_id int, mes_nombre string")
    rows = table(spark, sf_dir, "lineitem").join(F.broadcast(months), F.col("l_linenumber") == F.col("mes_id")).where("mes_nombre = 'enero'")
    return rows.agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")


@query(f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey from (select *, row_number() over (partition by l_orderkey, l_linenumber
order by {", ".join(c + " desc" for c in _ORDER)}) as rn from lineitem) where rn = 1""")
def dedup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = directory.last_wins(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c) for c in _ORDER])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("select l_orderkey, count(*) as n from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'F') group by 1")
def orphan_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").join(heads, "l_orderkey", "left_anti").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("select r_regionkey::bigint as region_id, r_name as region_nombre from region union all select v, 'R' || v from range(5, 17) t(v)")
def seed_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("region_id"), F.col("r_name").alias("region_nombre"))
    seed = spark.range(1, 17).select(F.col("id").alias("region_id"), F.concat(F.lit("R"), F.col("id")).alias("region_nombre"))
    return directory.insert_absent(known, seed, ["region_id"])
