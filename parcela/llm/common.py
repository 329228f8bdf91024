"""What the corpus operators share: the shared folder, words, and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.storage import scratch, shared_dir, stored  # noqa: F401

#: A word is a run of anything but ASCII white space.
WORD_GAP = r"[\\x20\\x09-\\x0D]+"


def let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def words_sql(text: str = "text") -> str:
    """SQL for the array of words; null and blank texts have none."""
    return f"array_remove(split(coalesce({text}, ''), '{WORD_GAP}'), '')"


def small(df: DataFrame, most: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.count() <= most else df


def spare(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def text_mark() -> Column:
    """64 bits of the text's SHA-256, which tell the texts of one doc_id apart; null counts as empty."""
    return F.xxhash64(F.sha2(F.coalesce("text", F.lit("")), 256))


def rows_left(docs: DataFrame, gone: DataFrame, tied: DataFrame) -> DataFrame:
    """``docs`` without the rows ``gone`` and with one row for each of ``tied``, with its own columns.

    Both have (doc_id, mark), the mark as ``text_mark`` gives it, each pair once; null ids are equal.
    Of tied rows that differ in other columns any one is left.
    """
    mark, ident, other = (spare(docs, n) for n in ("__mark", "__id", "__other"))
    rows = docs.withColumn(mark, text_mark())

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(F.col("doc_id").alias(ident), F.col("mark").alias(other))
        return left.join(right, F.col("doc_id").eqNullSafe(F.col(ident)) & (F.col(mark) == F.col(other)), how)

    out = joined(rows, small(gone, 1_000_000), "left_anti")
    if not tied.isEmpty():
        tied = small(tied, 1_000_000)
        one = joined(out, tied, "left_semi").dropDuplicates(["doc_id", mark])
        out = joined(out, tied, "left_anti").union(one)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Within it, Python workers get ``most`` rows at once; for rows that are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (a, b): rows (node, root), root the smallest node.

    Alternates large-star and small-star steps, each a grouped minimum and a join, until no edge
    changes; every step is stored, so a lost executor costs one step, and the join of a hub with many
    edges, being one of two plain shuffles, can be split. Nodes without links are absent. Nulls and
    loops are dropped.
    """
    edges = stored(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(most_rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large")
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        joined = large.join(low, "a")
        kept = joined.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = stored(kept.where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
