"""Glyphs, and the grid that holds them."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcela.operators import glyphs as op
from parcela.operators import grid, pictures

from .registry import dealt, query, table

_MEAN = "m as (select label, i as pos, avg(embedding[i]::double) as mean from (select label, embedding, unnest(range(1, 65)) as i from embeddings) group by all)"


@query(f"with {_MEAN} select label, (pos - 1)::int as pos, round(mean, 6) as mean from m")
def template_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.template_mean(table(spark, sf_dir, "embeddings"), pixels="embedding").withColumn("mean", F.round("mean", 6))


@query(f"""with {_MEAN}, t as (select label, list(round(mean, 6) order by pos) as e from m group by 1),
tc as (select label, list_transform(e, lambda x: x - list_avg(e)) as e from t),
g as (select vec_id, list_transform(embedding::double[], lambda x: x - list_avg(embedding::double[])) as v from embeddings),
s as (select vec_id, label, round(list_cosine_similarity(v, e), 12) as score from g, tc),
b as (select vec_id, label, score, row_number() over (partition by vec_id order by score desc, label) as rn from s)
select vec_id, label::varchar as best, round(score, 6) as score from b where rn = 1""")
def glyph_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    means = op.template_mean(vectors, pixels="embedding").withColumn("mean", F.round("mean", 6))
    templates = op.templates_of(means).withColumn("exemplar_no", F.lit(0))
    return op.classify(vectors, templates, "vec_id", "embedding").withColumn("score", F.round("score", 6))


@query("""with r as (select vec_id, label, row_number() over (partition by label order by vec_id) - 1 as i, count(*) over (partition by label) as n from embeddings)
select vec_id, label from r where i % greatest(1, n // 12) = 0 and i < 12 * greatest(1, n // 12)""")
def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.stride_sample(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "label", ["vec_id"])


@query("select p_partkey, case when p_size % 7 = 0 then '-' || p_size || ',,5' else '-' || p_size || ',5' end as text, case when p_size % 7 <> 0 then -(p_size + 0.5) end::double as value from part")
def glyph_to_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("-"), F.col("p_size"), F.when(F.col("p_size") % 7 == 0, ",,5").otherwise(",5"))
    glyphs = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split(text, "")).alias("ord", "ch"))
    return op.read_cells(glyphs, ["p_partkey"])


@query("select o_orderkey, coalesce(min(l_discount), -1) as confidence from orders left join lineitem on o_orderkey = l_orderkey and l_quantity > 10 group by 1")
def cell_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_discount").alias("score"))
    return op.cell_confidence(table(spark, sf_dir, "orders"), lines, ["o_orderkey"])


@query("""select p_partkey, case when p_size % 8 < 2 then 'noise' when p_size > 1.18 * (p_partkey % 30) and p_size % 9 + 1 <= 6 then 'grid'
when p_size <= 0.45 * (p_partkey % 30) and p_partkey % 40 > 0.45 * 40 then 'comma' else 'digit' end as kind from part""")
def blob_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = F.col("p_size"), F.col("p_partkey")
    kind = op.blob_kind(s % 9 + 1, s, (s % 8) * 3, k % 40, F.lit(40), k % 30)
    return table(spark, sf_dir, "part").select("p_partkey", kind.alias("kind"))


@query("""select l_orderkey, coalesce(median(l_quantity) filter (l_quantity > 8), max(l_quantity))::double as digit_h from lineitem where l_linenumber + 3 >= 6 group by 1""")
def digit_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_quantity").alias("h"), (F.col("l_linenumber") + 3).alias("area"))
    return op.digit_height(boxes, ["l_orderkey"])


@query("""select p_partkey, 'b' || i as what, x::int as x, y::int as y, w::int as w, h::int as h, (w * h)::int as area from part, lateral (select 1 as i, 2 as x, 1 as y, p_size % 5 + 1 as w, p_size % 7 + 1 as h
union all select 2, p_size % 5 + 5, p_size % 3 + 1, 3, 2 union all select 3, 20, 9, 1, 1) b""")
def cell_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three dark rectangles on each grey cell are found again; none touches another."""
    inside = lambda x, y, w, h: f"(x >= {x} and x < {x} + {w} and y >= {y} and y < {y} + {h})"
    dark = " or ".join([inside("2", "1", "(p_size % 5 + 1)", "(p_size % 7 + 1)"), inside("(p_size % 5 + 5)", "(p_size % 3 + 1)", "3", "2"), inside("20", "9", "1", "1")])
    picture = F.expr(f"transform(sequence(0, 11), y -> transform(sequence(0, 23), x -> cast(if({dark}, 20 + x % 3, 200 + y) as int)))")
    found = pictures.blobs(dealt(spark, sf_dir, "part", "p_partkey", "p_size").select("p_partkey", picture.alias("pixels")), ["p_partkey"])
    what = F.when(F.col("x") == 2, "b1").when(F.col("x") == 20, "b3").otherwise("b2")
    return found.select("p_partkey", what.alias("what"), "x", "y", "w", "h", "area")


@query("""select p_partkey, (i - 1)::int as pos, case when p_size % 4 = 0 then case when ((i - 1) % 24) // 6 < 2 then 255.0 else 0.0 end
when ((i - 1) % 24) // 6 < p_size % 4 then 0.0 else 255.0 end::double as value from part, range(1, 769) t(i)""")
def glyph_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of 8 by 4 pixels with some dark columns, black and white in 32 by 24; without dark ones its four greys are parted in the middle."""
    grey = "if(x >= 3 and y >= 2 and y < 10 and x - 3 < p_size % 4, 30 + y, 210 - x)"
    picture = F.expr(f"transform(sequence(0, 11), y -> transform(sequence(0, 9), x -> {grey}))")
    cells = dealt(spark, sf_dir, "part", "p_partkey", "p_size").select("p_partkey", picture.alias("pixels"), F.lit(3).alias("x"), F.lit(2).alias("y"), F.lit(4).alias("w"), F.lit(8).alias("h"))
    return pictures.normalised(cells, ["p_partkey"]).select("p_partkey", F.posexplode("pixels").alias("pos", "value"))


@query("""with recursive b as (select l_orderkey, l_quantity::int as x, 0 as y, 3 as w, (10 + l_linenumber)::int as h,
row_number() over (partition by l_orderkey order by l_quantity::int, l_linenumber) as rn from lineitem),
f as (select l_orderkey, rn, 0 as ord, x, y, w, h from b where rn = 1 union all
select b.l_orderkey, b.rn, f.ord + (not t.j)::int, case when t.j then f.x else b.x end, case when t.j then least(f.y, b.y) else b.y end,
case when t.j then greatest(f.x + f.w, b.x + b.w) - f.x else b.w end, case when t.j then greatest(f.y + f.h, b.y + b.h) - least(f.y, b.y) else b.h end
from f join b on b.l_orderkey = f.l_orderkey and b.rn = f.rn + 1, lateral (select b.x - (f.x + f.w) <= 2 and abs(b.h - f.h) < 0.6 * f.h as j) t)
select l_orderkey, ord::int as ord, arg_max(x, rn)::int as x, arg_max(y, rn)::int as y, arg_max(w, rn)::int as w, arg_max(h, rn)::int as h from f group by l_orderkey, ord""")
def blob_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "cast(l_quantity as int) as x", "0 as y", "3 as w", "cast(10 + l_linenumber as int) as h")
    return op.merge_blobs(boxes, ["l_orderkey"])


_LINES = "ln as (select distinct s_suppkey, (20 * k + (s_suppkey * k) % 5 + case when k % 11 = 3 then 9 else 0 end)::int as pos from supplier, range(0, 27) t(k) where (s_suppkey + k) % 6 <> 0)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = dealt(spark, sf_dir, "supplier", "s_suppkey").select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(26))).alias("k")).where("(s_suppkey + k) % 6 <> 0")
    pos = F.expr("cast(20 * k + (s_suppkey * k) % 5 + if(k % 11 = 3, 9, 0) as int)")
    return k.select("s_suppkey", pos.alias("pos")).distinct()


_PITCH = f"""{_LINES}, gp as (select *, pos - lag(pos) over w as gap, lead(pos) over w - pos as next_gap from ln window w as (partition by s_suppkey order by pos)),
md as (select s_suppkey, quantile_cont(gap, 0.5) as m from gp where gap is not null group by 1),
pt as (select s_suppkey, quantile_cont(gap, 0.5)::double as pitch from gp join md using (s_suppkey) where gap > 0.5 * m group by 1)"""


@query(f"with {_PITCH} select s_suppkey, pitch from pt")
def robust_pitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.robust_pitch(_lines(spark, sf_dir), ["s_suppkey"], "pos")


@query(f"""with {_PITCH}, rg as (select s_suppkey, max(pos) as last, min(pitch) as pitch, count(*) as n from gp join (select s_suppkey, count(*) as lines from gp group by 1) c using (s_suppkey) join pt using (s_suppkey)
where coalesce(abs(gap - pitch) < 0.3 * pitch, false) or coalesce(abs(next_gap - pitch) < 0.3 * pitch, false) group by 1, lines having lines >= 5)
select s_suppkey, k::int as k, (last - pitch * (24 - k))::double as bound from rg, range(0, 25) t(k) where n >= 2""")
def grid_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.bounds(_lines(spark, sf_dir), ["s_suppkey"], "pos")


_INK = """ik as (select s_suppkey, y::int as y, ((s_suppkey * 7 + y * y) % 160)::double as ink from supplier, range(0, 120) t(y)),
th as (select s_suppkey, greatest(max(ink) * 0.12, 20) as t from ik group by 1),
bd as (select s_suppkey, min(y) as b, max(y) as e from (select s_suppkey, y, y - row_number() over (partition by s_suppkey order by y) as g from ik join th using (s_suppkey) where ink >= t) group by s_suppkey, g)"""


def _bands(spark: SparkSession, sf_dir: str, **how: int) -> DataFrame:
    """A picture's ink is an array in the row that it is drawn from: as rows of their own all tasks would sort them, in memory that grows with the table."""
    ink = F.expr("transform(sequence(0, 119), y -> cast((s_suppkey * 7 + y * y) % 160 as double))")
    inked = dealt(spark, sf_dir, "supplier", "s_suppkey").select("s_suppkey", ink.alias("ink"))
    found = inked.select("s_suppkey", F.explode(grid.bands_in("ink", **how)).alias("b"))
    return found.select("s_suppkey", *[F.col(f"b.{c}").cast("int").alias(c) for c in ("begin", "end")])


@query(f'with {_INK} select s_suppkey, b as "begin", e as "end" from bd')
def ink_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bands(spark, sf_dir, gap=2, height=0, margin=0)


@query(f"""with {_INK}, nw as (select *, coalesce((b - lag(e) over (partition by s_suppkey order by b) >= 6)::int, 0) as n from bd),
gr as (select *, sum(n) over (partition by s_suppkey order by b) as g from nw)
select s_suppkey, greatest(0, min(b) - 3)::int as "begin", least(119, max(e) + 3)::int as "end" from gr group by s_suppkey, g having max(e) - min(b) >= 6""")
def band_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bands(spark, sf_dir, limit=119)


@query("""with g as (select l_orderkey as cell, l_linenumber as ord, l_partkey as pixel, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) as i,
count(*) over (partition by l_orderkey) as n from lineitem where l_returnflag <> 'R'), t as (select o_orderkey as cell, regexp_replace((o_orderkey * 37)::varchar, '0', '', 'g') as digits from orders)
select cell, i::int as ord, digits[i] as label from g join t using (cell) where n = length(digits)""")
def template_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells whose glyphs and true digits are as many teach their glyphs' labels."""
    lines = table(spark, sf_dir, "lineitem").withColumn("kind", F.when(F.col("l_returnflag") == "R", "comma").otherwise("digit"))
    order = F.row_number().over(Window.partitionBy("l_orderkey", "kind").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    glyphs = lines.select(F.col("l_orderkey").alias("cell"), order.alias("ord"), "kind")
    truth = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("cell"), F.replace(F.concat(F.lit("-"), F.col("o_orderkey") * 37, F.lit(" ,")), F.lit("0"), F.lit("")).alias("text"))
    return op.matching_cells(glyphs, truth, ["cell"]).select("cell", "ord", "label")


@query("""with c as (select p_partkey, p_size as l, p_size + p_partkey % 40 + 1 as r, p_size % 20 as t, p_size % 20 + 7 as b from part),
d as (select p_partkey, greatest(0, floor(l + (r - l) * 0.06))::int as x1, least(60, floor(r - (r - l) * 0.06))::int as x2, greatest(0, t - 2)::int as y1, least(25, b + 2)::int as y2 from c)
select *, (greatest(0, x2 - x1) * greatest(0, y2 - y1))::int as n_pixels from d""")
def cell_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, top = F.col("p_size"), F.col("p_size") % 20
    part = grid.crop(s, s + F.col("p_partkey") % 40 + 1, top, top + 7, F.lit(60), F.lit(25))
    picture = F.expr("transform(sequence(1, 25), y -> sequence(1, 60))")
    cut = dealt(spark, sf_dir, "part", "p_partkey", "p_size").select("p_partkey", part.alias("c"), grid.cropped(picture, part).alias("px"))
    return cut.select("p_partkey", "c.*", F.aggregate("px", F.lit(0), lambda a, row: a + F.size(row)).alias("n_pixels"))


@query("""with s as (select l_orderkey as doc, l_linenumber as x, sum(l_quantity) as ink from lineitem group by all), t as (select doc, max(ink) * 0.4 as least from s group by 1),
k as (select doc, x, x - row_number() over (partition by doc order by x) as g from s join t using (doc) where ink >= least) select doc, ((min(x) + max(x)) // 2)::int as pos from k group by doc, g""")
def ink_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("x")).agg(F.sum("l_quantity").alias("ink"))
    return grid.lines_of(sums, ["doc"], "x", "ink")


@query("select p_partkey, m::int as month from part, range(1, 5) t(m) where p_size % 9 >= 6")
def hourly_page_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of fewer than six pages have no hourly page."""
    parts = table(spark, sf_dir, "part")
    cells = parts.select("p_partkey", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("month"))
    return op.hourly_pages(cells, parts.select("p_partkey", (F.col("p_size") % 9).alias("page_count")), "p_partkey")
