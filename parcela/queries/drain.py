"""A drain of the engine, from pending reports to the stored tables of their pages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.plans import engine, report
from parcela.plans.daily import Settings
from parcela.storage import scratch

from .registry import query, table


def _extraction(chosen: DataFrame) -> engine.Extraction:
    """Each kind of report by its number: first versions, unknown ones, errors, and pages of which the first may lack its code."""
    k = F.col("eval_id").cast("int")
    outcomes = chosen.select("eval_id", F.when(k % 7 == 1, 4).when(k % 7 == 2, 9).otherwise(7).alias("page_count"), F.when(k % 7 == 3, F.concat(F.lit("boom "), k)).alias("extract_error"))
    pages = chosen.select("eval_id", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("page_no")).where((F.col("page_no") != 1) | (F.col("eval_id").cast("int") % 7 != 4))
    y = "if(page_no = 1, 21D, 32D)"
    spans = pages.selectExpr("eval_id", "page_no", "215.9D as page_w", "330.0D as page_h", "70.0D as x0", f"{y} as y0", "80.0D as x1", f"{y} + 2D as y1", "10.0D as font_size", "concat('C', eval_id) as text")
    return engine.Extraction(outcomes, spans)


_ROWS = ", ".join(f"case when pdf_status = 'extracted' then {n} else 0 end::bigint as {t}" for t, n in report.TABLES.items())


@query(f"""with r as (select s_suppkey, s_suppkey % 3 = 0 as done, s_suppkey % 7 as k from supplier),
s as (select s_suppkey::varchar as eval_id, case when done then 'extracted' when k = 1 then 'skipped_v1' when k in (2, 3, 4) then 'failed' else 'extracted' end as state,
case when done then null when k = 1 then 1 when k not in (2, 3, 4) then 2 end as version, case when done then null when k = 2 then 'unknown version' when k = 3 then 'boom ' || s_suppkey when k = 4 then 'validation' end as reason, done from r),
p as (select *, case when done then 'old' else state end as pdf_status from s)
select eval_id, state as pdf_status, version::int as report_version, reason as last_error, {_ROWS} from p""")
def drain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states of all reports and the rows that each has in the eight tables, after a drain of those that were pending."""
    communes = spark.createDataFrame([(1, 1)], "comuna_id int, region_id int")
    e = engine.Engine(spark, scratch(spark, "drain"), "", communes, _extraction, lambda: None, "2024-01-01", Settings(seed=1))
    state = F.when(F.col("s_suppkey") % 3 == 0, "extracted").otherwise("pending")
    given = {"eval_id": F.col("s_suppkey").cast("string"), "comuna_id": F.lit(1), "region_id": F.lit(1), "pdf_status": state, "retry_count": F.lit(0)}
    names = [c.split()[0:2] for c in engine.DIRECTORY.split(", ")]
    rows = table(spark, sf_dir, "supplier").select(*[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in names])
    e.store.commit(e.store.version(), {"reports": e.store.aside("reports", rows)})
    e.drain()
    counts = report.page_rows({t: e.read(t) for t in report.TABLES}, "eval_id").groupBy("eval_id").agg(*[F.sum(F.when(F.col("table_name") == t, F.col("n_rows"))).alias(t) for t in report.TABLES])
    joined = e.read("reports").join(counts, "eval_id", "left")
    return joined.select("eval_id", "pdf_status", "report_version", "last_error", *[F.coalesce(t, F.lit(0)).cast("bigint").alias(t) for t in report.TABLES])
