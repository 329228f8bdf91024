"""Hourly series and their flags."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.functions import numbers
from parcela.operators import cells, pictures
from parcela.plans import hourly

from .registry import query, table

#: Mean value per user and hour, some missing, some out of range, in tenths of a degree.
_SERIES = """s as (select user_id, floor(epoch(ts) / 3600)::bigint as hour, sum(round(value * 100)::bigint)::bigint // 100 as total from events group by all),
c as (select user_id, hour, case when total % 11 <> 0 then total % 80 - 22.0 end as v from s),
j as (select *, lag(v) over w as b, lead(v) over w as a from c window w as (partition by user_id order by hour)),
g as (select user_id, hour, v, v is not null and (a is not null or b is not null) and (b is null or abs(v - b) > 8) and (a is null or abs(v - a) > 8) as jump from j),
f as (select *, case when v is null then 'none' when v < -20 or v > 50 then 'range' when jump then 'jump' else 'ok' end as flag from g)"""


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600).cast("bigint")
    sums = table(spark, sf_dir, "events").groupBy("user_id", hour.alias("hour")).agg(F.floor(F.sum(F.round(F.col("value") * 100).cast("bigint")) / 100).alias("total"))
    value = F.when(F.col("total") % 11 != 0, F.col("total") % 80 - F.lit(22.0))
    rows = cells.jumps(sums.select("user_id", "hour", value.alias("v")), ["user_id"], "hour", "v")
    return rows.withColumn("flag", cells.flag(F.col("v"), F.col("jump")))


@query(f"with {_SERIES} select user_id, hour, v::double as v, jump from f")
def jump_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).select("user_id", "hour", "v", "jump")


@query(f"with {_SERIES} select user_id, hour, flag from f")
def cell_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).select("user_id", "hour", "flag")


@query(f"""with {_SERIES} select count(*) as cells, round(100.0 * count(*) filter (flag <> 'none') / count(*), 4) as filled_pct,
round(100.0 * count(*) filter (flag = 'ok') / count(*), 4) as plausible_pct, round(100.0 * count(*) filter (flag <> 'ok') / count(*), 4) as flagged_pct from f""")
def cell_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.quality(_flagged(spark, sf_dir))


@query(f"with {_SERIES} select user_id, count(*) filter (flag <> 'ok') as flagged from f group by 1 order by 2 desc, 1 limit 8")
def worst_docs_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.worst(_flagged(spark, sf_dir), "user_id")


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag = 'R' or l_linestatus = 'O'
or (l_discount * 10 - 0.2 >= 0 and l_discount * 10 - 0.2 < 0.45) or (l_tax * 10 - 0.1 >= 0 and l_tax * 10 - 0.1 < 0.45) as low from lineitem""")
def low_confidence_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    outer, inner = F.expr("nullif(l_returnflag, 'R')"), F.expr("nullif(l_linestatus, 'O')")
    low = numbers.low_confidence(outer, inner, F.col("l_discount") * 10 - 0.2, F.col("l_tax") * 10 - 0.1)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", low.alias("low"))


@query("""with r as (select nullif(quality, toxic) as got, case when n_chars % 3 = 0 then quality + 0.01 else 0.3 + toxic end as truth from documents join labels using (doc_id))
select count(*) as cells, count(*) filter (abs(got - truth) < 0.05) as hits, round(count(*) filter (abs(got - truth) < 0.05) / count(*), 6) as accuracy from r""")
def gt_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    truth = F.when(F.col("n_chars") % 3 == 0, F.col("quality") + 0.01).otherwise(F.col("toxic") + 0.3)
    return cells.accuracy(rows, F.expr("nullif(quality, toxic)"), truth)


#: Figures to draw bands with, five columns and seven rows each.
_FIGURES = """
01110 10001 10011 10101 11001 10001 01110
00100 01100 00100 00100 00100 00100 01110
01110 10001 00001 00110 01000 10000 11111
11110 00001 00001 01110 00001 00001 11110
00010 00110 01010 10010 11111 00010 00010
11111 10000 11110 00001 00001 10001 01110
00110 01000 10000 11110 10001 10001 01110
11111 00001 00010 00100 01000 01000 01000
01110 10001 10001 01110 10001 10001 01110
01110 10001 10001 01111 00001 00010 01100
"""
_CELL, _LABEL, _HIGH = 32, 30, 60


def _figure(digit: int) -> np.ndarray:
    rows = _FIGURES.split()[7 * digit : 7 * digit + 7]
    small = np.array([[c == "1" for c in r] for r in rows])
    return np.repeat(small, [1, 2, 1, 2, 1, 2, 1], 0)


def _write(ink: np.ndarray, text: str, x: int, y: int) -> None:
    for c in text:
        if c == ",":
            ink[y + 8 : y + 12, x : x + 2] = True
            x += 5
        else:
            ink[y : y + 10, x : x + 5] |= _figure(int(c))
            x += 8


def band(outer: list[float], inner: list[float], noise: int = 0) -> list[list[int]]:
    """The grey picture of a band: 25 upright lines, the hours, and two rows of numbers with a decimal comma."""
    ink = np.zeros((_HIGH, _LABEL + 24 * _CELL + 4), bool)
    ink[:, [_LABEL + _CELL * k for k in range(25)]] = True
    for h in range(24):
        x = _LABEL + _CELL * h + 4
        for row, text in enumerate((str(h + 1), f"{outer[h]:.1f}", f"{inner[h]:.1f}")):
            _write(ink, text.replace(".", ","), x, 3 + 19 * row)
    dust = np.random.default_rng(noise).integers(0, 20, ink.shape)
    return np.where(ink, 20 + dust, 255 - dust).tolist()


def templates(spark: SparkSession) -> DataFrame:
    """An exemplar of each figure, as glyphs are scaled to be compared."""
    rows = []
    for d in range(10):
        ink = _figure(d)
        tight = ink[np.ix_(ink.any(1), ink.any(0))]
        rows.append((str(d), 0, pictures.scaled(np.where(tight, 0.0, 255.0)).ravel().tolist()))
    return spark.createDataFrame(rows, "label string, exemplar_no int, exemplar array<double>")


@query("""select s_suppkey as doc_id, h::int as hora, (s_suppkey % 40 + h / 2.0)::double as temperatura_exterior, ((s_suppkey * 7 + h) % 30 + 0.1)::double as temperatura_interior
from supplier, range(24) r(h)""")
def band_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A band is drawn for each supplier; what is read from the pictures are the numbers that were drawn."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in b.column(0).to_pylist():
                picture = band([k % 40 + h / 2 for h in range(24)], [(k * 7 + h) % 30 + 0.1 for h in range(24)], k)
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array(["enero"]), pa.array([picture], pa.list_(pa.list_(pa.int32())))], ["doc_id", "month", "pixels"])

    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey")
    bands = suppliers.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(draw, "doc_id bigint, month string, pixels array<array<int>>")
    found = hourly.read_bands(bands, templates(spark), "doc_id")
    hours = found.select("doc_id", F.posexplode(F.arrays_zip("outer", "inner")).alias("hora", "v"))
    return hours.select("doc_id", "hora", F.col("v.outer").alias("temperatura_exterior"), F.col("v.inner").alias("temperatura_interior"))
