"""Health figures."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.operators import diagnostics as op

from .registry import EV, query, reports, table


@query(f"""with {EV}
select 'pdf_status' as grp, coalesce(pdf_status, 'null') as value, count(*) as n from ev group by 2
union all select 'tipo', coalesce(tipo::varchar, 'null'), count(*) from ev group by 2
union all select 'is_synced', case when is_synced then 'True' when not is_synced then 'False' else 'null' end, count(*) from ev group by 2
union all select 'last_error', coalesce(last_error, 'null'), count(*) from ev group by 2""")
def status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.histograms(reports(spark, sf_dir), {"pdf_status": False, "tipo": False, "is_synced": True, "last_error": False})


@query(f"""with {EV} select 'last_error' as grp, last_error as value, count(*) as n from ev where last_error is not null group by 2""")
def error_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.histogram(reports(spark, sf_dir), "last_error", drop_null=True)


@query(f"""with {EV} select count(*) as n_rows, count(*) - count(synced_at) as null_synced_at,
count(*) - count(last_error) as null_last_error, count(*) - count(price) as null_price from ev""")
def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.null_audit(reports(spark, sf_dir), ["synced_at", "last_error", "price"])


_DETAIL = ("lineitem", "orders", "part", "supplier", "customer", "events", "documents", "pages")


@query(" union all ".join(f"select '{t}' as table_name, count(*) as n from {t}" for t in _DETAIL))
def detail_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.table_counts({t: table(spark, sf_dir, t) for t in _DETAIL})


@query(f"with {EV} select max(processed_at)::varchar as last_processed from ev")
def last_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).agg(F.max("processed_at").cast("string").alias("last_processed"))


@query(f"""with {EV} select count(*) as total, count(*) filter (pdf_status = 'pending') as pending,
count(*) filter (pdf_status = 'failed') as failed, count(*) filter (pdf_status = 'extracted') as extracted from ev""")
def backfill_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.backfill_status(reports(spark, sf_dir))


@query(f"with {EV} select count(*) as n from ev where pdf_status = 'pending'")
def pending_queue_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).where("pdf_status = 'pending'").agg(F.count("*").alias("n"))


@query(f"with {EV} select count(*) as n from ev where synced_at is null")
def unsynced_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).where("synced_at is null").agg(F.count("*").alias("n"))


@query(f"""with {EV}, s as (select count(*) as total, count(*) filter (pdf_status = 'pending') as pending,
count(*) filter (pdf_status = 'failed') as failed, count(*) filter (pdf_status = 'extracted') as extracted from ev)
select '{{"total":' || total || ',"pending":' || pending || ',"failed":' || failed || ',"extracted":' || extracted || '}}' as summary from s""")
def summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.summary_json(op.backfill_status(reports(spark, sf_dir)))
