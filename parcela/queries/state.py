"""The work queue and what comes of its reports."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.functions.strings import truncated
from parcela.operators import directory, work

from .registry import EV, query, reports, table

_OUTCOMES = """oc as (select eval_id + case when eval_id % 13 = 0 then 1000000000 else 0 end as eval_id,
 case eval_id % 4 when 2 then 4 when 3 then 5 else 7 end as page_count,
 case when eval_id % 11 = 0 then 'boom ' || eval_id end as extract_error, eval_id % 7 <> 0 as valid from ev)"""

_TRANSITION = f"""{_OUTCOMES},
st as (select oc.*, ev.pdf_status, coalesce(ev.retry_count, 0) as r,
 case page_count when 7 then 2 when 4 then 1 else 0 end as v from oc left join ev using (eval_id)),
tr as (select *, case when pdf_status is null then 'error' when v = 1 then 'skipped_v1'
 when v <> 2 or extract_error is not null or not valid then 'failed' else 'extracted' end as new_status from st)"""


def _outcomes(ev: DataFrame) -> DataFrame:
    k = F.col("eval_id")
    return ev.select(
        (k + F.when(k % 13 == 0, 1_000_000_000).otherwise(0)).alias("eval_id"),
        F.when(k % 4 == 2, 4).when(k % 4 == 3, 5).otherwise(7).alias("page_count"),
        F.when(k % 11 == 0, F.concat(F.lit("boom "), k)).alias("extract_error"),
        (k % 7 != 0).alias("valid"),
    )


@query(f"""with {EV}, {_TRANSITION} select eval_id, new_status, r + (new_status = 'failed')::int as new_retry_count,
case when new_status = 'failed' then case when v <> 2 then 'unknown version' else coalesce(extract_error, 'validation') end end as new_error from tr""")
def process_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = reports(spark, sf_dir)
    return work.transition(ev, _outcomes(ev))


@query(f"""with {EV}, {_TRANSITION} select count(*) as selected, count(*) filter (new_status = 'extracted') as extracted,
count(*) filter (new_status = 'skipped_v1') as skipped, count(*) filter (new_status not in ('extracted', 'skipped_v1')) as failed from tr""")
def drain_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = reports(spark, sf_dir)
    return work.drain_summary(work.transition(ev, _outcomes(ev)))


@query(f"with {EV} select eval_id, retry_count from ev where pdf_status = 'failed' and retry_count < 3")
def retry_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work.retryable(reports(spark, sf_dir), 3).select("eval_id", "retry_count")


@query(f"""with {EV} select case when pdf_status = 'failed' and retry_count < 3 then 'pending' else pdf_status end as pdf_status, count(*) as n from ev group by 1""")
def reactivated_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work.reactivated(reports(spark, sf_dir), 3).groupBy("pdf_status").agg(F.count("*").alias("n"))


@query(f"with {EV} select eval_id from ev where pdf_status = 'pending'")
def random_drain_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order is random by design, and repeatable by its seed (a test); the rows are all that are pending."""
    return work.shuffled(work.pending(reports(spark, sf_dir))).select("eval_id")


@query(f"""with {EV}, p as (select eval_id from ev where pdf_status = 'pending') select least(200, count(*)) as drawn, 0::bigint as others, count(*) <= 200 as first_ones from p""")
def limited_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limited drain takes as many as it may, all pending, and not just the first by id."""
    ev = reports(spark, sf_dir)
    drawn = work.pending(ev, limit=200, order=work.random_order(7)).select("eval_id", F.col("pdf_status").alias("status"), F.lit(1).alias("mine"))
    first = work.pending(ev, limit=200).select("eval_id", F.lit(1).alias("head"))
    both = drawn.join(first, "eval_id", "left")
    return both.agg(F.count("*").alias("drawn"), F.count_if(F.col("status") != "pending").alias("others"), (F.count_if(F.col("head").isNotNull()) == F.count("*")).alias("first_ones"))


@query("""select user_id as eval_id, count(*) filter (event_type = 'purchase') > 0 as has_codigo, count(*) as p6_rows,
count(*) filter (event_type <> 'error') as p6_filled, count(*) filter (event_type = 'error' or value < 50) as p6_low_confidence,
count(*) filter (event_type = 'purchase') > 0 and count(*) = 96 as ok from events group by 1""")
def report_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    fine = F.col("event_type") != "error"
    rows = e.select(
        F.col("user_id").alias("eval_id"),
        F.when(F.col("event_type") == "purchase", "c").alias("codigo"),
        F.when(fine, F.col("value")).alias("outer"),
        F.col("value").alias("inner"),
        (~fine | (F.col("value") < 50)).alias("low_confidence"),
    )
    return work.validation(rows)


@query("""with r as (select o_orderkey, nullif(o_orderpriority, '1-URGENT') as a, nullif(o_orderstatus, 'P') as b, nullif(o_orderkey % 5, 0) as c from orders)
select o_orderkey, concat_ws(',', case when a is null then 'a' end, case when b is null then 'b' end, case when c is null then 'c' end) as missing
from r where a is null or b is null or c is null""")
def critical_null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "nullif(o_orderpriority, '1-URGENT') as a", "nullif(o_orderstatus, 'P') as b", "nullif(o_orderkey % 5, 0) as c")
    return work.critical_nulls(r, ["a", "b", "c"]).select("o_orderkey", "missing")


@query("select doc_id, substr(text, 1, 300) as reason from documents")
def error_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", truncated(F.col("text")).alias("reason"))


@query("""select case nullif(o_orderkey % 9, 0) when 7 then 2 when 4 then 1 else 0 end as version, count(*) as n from orders group by 1""")
def version_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = work.version_of(F.expr("nullif(o_orderkey % 9, 0)")).alias("version")
    return table(spark, sf_dir, "orders").groupBy(version).agg(F.count("*").alias("n"))


@query("""select coalesce(s > 0 and s < 4000000, false) as likely_v1, count(*) as n
from (select nullif((o_totalprice * 20)::bigint, 0) * (o_orderkey % 3) as s from (select o_orderkey, floor(o_totalprice) as o_totalprice from orders)) group by 1""")
def likely_small_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.expr("nullif(cast(floor(o_totalprice) * 20 as bigint), 0) * (o_orderkey % 3)")
    return table(spark, sf_dir, "orders").groupBy(work.likely_first_version(size).alias("likely_v1")).agg(F.count("*").alias("n"))


@query(f"""with {EV}, m as (select comuna_id, tipo, max(last_seen_at) as newest from ev group by all)
select eval_id from ev join m using (comuna_id, tipo) where last_seen_at < newest""")
def stale_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directory.stale(reports(spark, sf_dir), ["comuna_id", "tipo"]).select("eval_id")


@query("""select count(*) as removed, round(coalesce(sum(floor(o_totalprice) * 1000), 0) / 1048576.0, 1) as freed_mb
from orders where o_orderdate < timestamp '1999-01-01' - interval 365 day""")
def orphan_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("modified_at"), (F.floor("o_totalprice") * 1000).alias("length"))
    return directory.freed_mb(directory.orphans(files, F.expr("timestamp_ntz'1999-01-01'"), 365))
