"""Upserts, replacing by key, and the mirror."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.operators import directory, mirror, persist

from .registry import EV, query, reports, table


@query(f"""with {EV}, k as (select * from ev where eval_id % 4 <> 0),
f as (select eval_id, price + 1 as price, comuna_id from ev where eval_id % 4 in (0, 1))
select coalesce(k.eval_id, f.eval_id) as eval_id, round(coalesce(f.price, k.price), 2) as price, coalesce(f.comuna_id, k.comuna_id) as comuna_id,
case when k.eval_id is null then 'pending' else k.pdf_status end as pdf_status, k.retry_count,
case when f.eval_id is not null then '2030-01-01' else k.last_seen_at::varchar end as last_seen_at,
case when k.eval_id is null then 'inserted' when f.eval_id is not null then 'refreshed' else 'kept' end as change
from k full join f on k.eval_id = f.eval_id""")
def upsert_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = reports(spark, sf_dir)
    found = ev.where("eval_id % 4 in (0, 1)").select("eval_id", (F.col("price") + 1).alias("price"), "comuna_id")
    out = directory.upsert(ev.where("eval_id % 4 <> 0"), found, "eval_id", ["price", "comuna_id"], ["pdf_status", "retry_count"], F.lit("2030-01-01").cast("date"))
    return out.withColumns({"price": F.round("price", 2), "last_seen_at": F.col("last_seen_at").cast("string")})


@query("""with f as (select n_nationkey, case when n_nationkey % 5 = 0 then n_name || ' X' else n_name end as n_name, n_regionkey from nation
union all select n_nationkey + 100, n_name, n_regionkey from nation where n_nationkey < 3)
select f.*, case when k.n_nationkey is null then 'inserted' else 'updated' end as change from f left join nation k using (n_nationkey)
where k.n_nationkey is null or f.n_name is distinct from k.n_name or f.n_regionkey is distinct from k.n_regionkey""")
def dim_sync_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "nation")
    name = F.when(F.col("n_nationkey") % 5 == 0, F.concat("n_name", F.lit(" X"))).otherwise(F.col("n_name"))
    more = known.where("n_nationkey < 3").withColumn("n_nationkey", F.col("n_nationkey") + 100)
    return directory.changed(known, known.withColumn("n_name", name).unionByName(more), "n_nationkey", ["n_name", "n_regionkey"])


@query("""select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey % 10 not in (0, 1)
union all select l_orderkey, l_linenumber, l_quantity + 1 from lineitem where l_orderkey % 10 = 0""")
def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    processed = rows.where("l_orderkey % 10 in (0, 1)").select("l_orderkey")
    new = rows.where("l_orderkey % 10 = 0").withColumn("l_quantity", F.col("l_quantity") + 1)
    return persist.replace_by_key(rows, new, ["l_orderkey"], processed)


@query(f"with {EV} select eval_id from ev where synced_at is null or processed_at > synced_at")
def mirror_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persist.mirror_delta(reports(spark, sf_dir), refreshed=True).select("eval_id")


@query(f"""with {EV} select l_orderkey::varchar || ':' || l_linenumber as mirror_key, count(*) as n
from lineitem where l_orderkey in (select eval_id from ev where synced_at is null) group by 1""")
def mirror_detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    delta = persist.mirror_delta(reports(spark, sf_dir)).select(F.col("eval_id").alias("l_orderkey"))
    rows = table(spark, sf_dir, "lineitem").join(delta, "l_orderkey", "left_semi")
    return persist.with_mirror_key(rows, ["l_orderkey", "l_linenumber"]).groupBy("mirror_key").agg(F.count("*").alias("n"))


@query("""with r as (select l_orderkey || ':' || l_linenumber as k from lineitem),
m as (select distinct l_orderkey || ':' || l_linenumber as k from lineitem where l_returnflag = 'N')
select count(distinct k) filter (k not in (select k from m)) as created,
count(*) - count(distinct k) filter (k not in (select k from m)) as updated from r""")
def mirror_upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = persist.with_mirror_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return persist.upsert_counts(keyed, keyed.where("l_returnflag = 'N'"))


@query("""select distinct l_orderkey || ':' || coalesce(nullif(l_linenumber, 3)::varchar, 'None') || ':' || coalesce(nullif(l_returnflag, 'N'), 'None') as mirror_key from lineitem""")
def mirror_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.expr("nullif(l_linenumber, 3)").alias("mes"), F.expr("nullif(l_returnflag, 'N')").alias("hora"))
    return persist.with_mirror_key(rows, ["l_orderkey", "mes", "hora"]).select("mirror_key").distinct()


@query("""with v as (select l_orderkey as row_no, unnest(['id', 'a', 'b', 'c', 'd']) as name, unnest(['BIGINT', case when l_orderkey > 40 then 'DOUBLE' when l_orderkey > 20 then 'TEXT' end,
case when l_orderkey % 9 = 8 then 'TINYINT' when l_orderkey > 30 then 'BIGINT' else 'TEXT' end, case when l_orderkey % 2 = 0 then 'TEXT' end, null]) as t from (select distinct l_orderkey from lineitem))
select name, coalesce(arg_min(t, row_no) filter (t <> 'TEXT'), 'TEXT') as sql_type from v where name <> 'id' group by 1""")
def ddl_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types of values that change from row to row."""
    values = """explode(map('id', 'BIGINT', 'a', case when l_orderkey > 40 then 'DOUBLE' when l_orderkey > 20 then 'TEXT' end,
        'b', case when l_orderkey % 9 = 8 then 'TINYINT' when l_orderkey > 30 then 'BIGINT' else 'TEXT' end,
        'c', if(l_orderkey % 2 = 0, 'TEXT', null), 'd', null)) as (name, value_type)"""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct().selectExpr("l_orderkey as row_no", values)
    return persist.inferred_types(rows)


@query("""select 'CREATE TABLE IF NOT EXISTS `nation` (`id` BIGINT PRIMARY KEY, `mirror_key` TEXT, `n_nationkey` BIGINT, `n_name` TEXT, `n_regionkey` BIGINT)' as statement
union all select 'CREATE TABLE IF NOT EXISTS `supplier` (`id` BIGINT PRIMARY KEY, `mirror_key` TEXT, `s_suppkey` BIGINT, `s_name` TEXT, `s_nationkey` BIGINT, `s_acctbal` DOUBLE)'""")
def ddl_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(persist.ddl(t, table(spark, sf_dir, t).schema),) for t in ("nation", "supplier")], "statement string")


@query("select l_orderkey as eval_id, l_quantity as calefaccion_porcentaje, l_tax as iluminacion_consumo_referencia_kwh from lineitem")
def column_renames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("eval_id"), F.col("l_quantity").alias("calefaccion_kwh_per"), F.col("l_tax").alias("iluminacion_consumo_ref_kwh"), F.lit("x").alias("desconocida"))
    return persist.to_schema(rows, ["eval_id", "calefaccion_porcentaje", "iluminacion_consumo_referencia_kwh", "ausente"])


@query(f"""with {EV} select eval_id, case when synced_at is null or processed_at > synced_at then '2030-01-01' else synced_at::varchar end as synced_at from ev""")
def mirror_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was sent is stamped, as no table failed; with a failed one nothing is (a test)."""
    ev = reports(spark, sf_dir)
    fine = {"evaluaciones": {"created": 1, "updated": 0, "remaining": 0, "error": None}}
    out = mirror.stamped(ev, persist.mirror_delta(ev, refreshed=True), fine, F.lit("2030-01-01"))
    return out.select("eval_id", F.col("synced_at").cast("string").alias("synced_at"))
