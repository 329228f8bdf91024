"""Lists and rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.operators import nested as op

from .registry import query, table


@query("""with a as (select p_partkey, list_transform(range(0, p_size % 6), lambda x: x + p_size) as a, list_transform(range(0, p_size % 4), lambda x: p_brand) as b from part)
select p_partkey, i::int as pos, a[i + 1]::bigint as a, b[i + 1] as b from (select *, unnest(range(0, greatest(len(a), len(b)))) as i from a)""")
def zip_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    upto = lambda n: f"if({n} = 0, array(), sequence(0, {n} - 1))"
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", f"transform({upto('p_size % 6')}, x -> cast(x + p_size as bigint)) as a", f"transform({upto('p_size % 4')}, x -> p_brand) as b")
    return op.zip_rows(rows, ["p_partkey"], ["a", "b"])


@query("""select p_partkey, i::int as pos, case when i < p_size % 14 then i + p_size end::bigint as v from part, range(0, 10) t(i)""")
def pad_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.expr("transform(if(p_size % 14 = 0, array(), sequence(0, p_size % 14 - 1)), x -> cast(x + p_size as bigint))")
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(op.pad(values, 10, "bigint")).alias("pos", "v"))


@query("""select p_partkey, array_to_string(list_transform(list_filter(range(0, 12), lambda i: i not in (4, 10)), lambda i: i + p_size), ',') as kept from part""")
def drop_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = op.drop_places(F.expr("sequence(p_size, p_size + 11)"), (4, 10))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(kept, ",").alias("kept"))


@query("select p_partkey, '-,' || p_size || ',' || (p_size + 1) || ',-' as framed from part")
def frame_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = op.framed(F.array("p_size", F.col("p_size") + 1), 1, 1, "int")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(framed, ",", "-").alias("framed"))


@query("select p_partkey, array_to_string(list_transform(range(greatest(0, p_size % 15 - 10), p_size % 15), lambda i: i), ',') as tail from part")
def last_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.expr("if(p_size % 15 = 0, array(), sequence(0, p_size % 15 - 1))")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(op.last_n(values, 10), ",").alias("tail"))


@query("""select p_partkey, h::int as hour, case when h < p_size % 30 then h * 0.5 + p_size end::double as "outer",
case when p_size % 4 <> 0 then p_size - h end::double as "inner" from part, range(0, 24) t(h)""")
def hourly_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "transform(if(p_size % 30 = 0, array(), sequence(0, p_size % 30 - 1)), h -> cast(h * 0.5D + p_size as double)) as o",
        "if(p_size % 4 = 0, null, transform(sequence(0, 23), h -> cast(p_size - h as double))) as i",
    )
    return op.hourly(rows, ["p_partkey"], "o", "i")


@query("select p_partkey, k::int as mes_id, (p_size * k)::bigint as a, (p_size + k)::bigint as b from part, range(1, 13) t(k)")
def monthly_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "part").selectExpr("p_partkey", *[f"cast(p_size * {k} as bigint) as a_mes_{k}" for k in range(1, 13)], *[f"cast(p_size + {k} as bigint) as b_mes_{k}" for k in range(1, 13)])
    return op.wide_to_long(wide, ["p_partkey"], ["a", "b"], 12)


@query("""select l_orderkey, sum(l_quantity) filter (l_linenumber = 1)::bigint as enero, sum(l_quantity) filter (l_linenumber = 7)::bigint as julio from lineitem group by 1""")
def two_period_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("q"))
    return op.two_periods(rows, ["l_orderkey"], "l_linenumber", [1, 7], ["enero", "julio"], "q")


@query("""select o_orderkey, count(l_orderkey) as n_rows, min(l_linenumber) as first_line, coalesce(sum(l_quantity), 0)::bigint as quantity
from orders left join lineitem on o_orderkey = l_orderkey group by 1""")
def report_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = table(spark, sf_dir, "orders").select("o_orderkey")
    details = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint").alias("q"))
    whole = op.assembled(heads, details, "o_orderkey", ["l_linenumber", "l_partkey"])
    return whole.select("o_orderkey", F.size("rows").cast("bigint").alias("n_rows"), F.get("rows", F.lit(0))["l_linenumber"].alias("first_line"), F.expr("aggregate(rows, 0L, (a, x) -> a + x.q)").alias("quantity"))
