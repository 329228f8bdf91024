"""Exact duplicates through an extendible-hash index kept as shared files."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import rows_left, scratch, shared_dir, small, stored

#: Distinct keys that a bucket holds at most, and how many groups of map tasks bring their copies
#: of one text together before its bucket's owner compares them.
CAPACITY, MEETINGS = 20_000, 64
#: Directory cells for each bucket that is expected (as a power of two), so that most splits are found at once.
_SPARE = 4
_DIRECTORY = 1_000_000  # cells that may be broadcast


def _key(key_bits: int) -> Column:
    return F.expr(f"shiftrightunsigned(xxhash64(text), {64 - key_bits})")


def _prefix(key: str, bits: int, depth: str | int) -> str:
    """SQL for the first ``depth`` of a number's ``bits`` bits."""
    return f"if({depth} = 0, 0L, shiftrightunsigned({key}, {bits} - {depth}))"


def _bucket(cell: str, bits: int) -> Column:
    return F.concat_ws(":", "depth", F.expr(_prefix(cell, bits, "depth")))


def directory(keys: DataFrame, capacity: int, key_bits: int = 64, bits: int = 0) -> DataFrame:
    """(cell, depth, bucket, bits): the bucket of each first part of ``bits`` bits that a key has.

    ``keys`` has distinct keys and ``floor``, the least depth of their bucket (0 in a new index).
    While a bucket has more than ``capacity`` keys it is split by one further bit, which doubles the
    directory where its depth was the deepest; it ends at the last bit of the keys, as one key fits
    every bucket. Cells are as many as buckets, times 16 or so; nothing but their counts is shuffled.
    """
    n = keys.count()
    bits = min(key_bits, max(bits, ceil(log2(max(1, n / capacity))) + _SPARE))
    step = _SPARE
    while True:
        cell = F.expr(_prefix("key", key_bits, bits)).alias("cell")
        held = keys.groupBy(cell).agg(F.count("*").alias("n_keys"), F.max("floor").alias("floor"))
        cells = stored(held, "cells")
        climbed = cells.select("cell", "n_keys", F.explode(F.sequence("floor", F.lit(bits))).alias("depth"))
        climbed = climbed.withColumn("prefix", F.expr(_prefix("cell", bits, "depth")))
        full = climbed.groupBy("depth", "prefix").agg(F.sum("n_keys").alias("n_keys")).where(F.col("n_keys") > capacity).drop("n_keys")
        full = stored(full, "full")
        if bits == key_bits or full.where(F.col("depth") == bits).isEmpty():
            break
        bits, step = min(key_bits, bits + step), 2 * step
    fits = climbed.join(small(full, _DIRECTORY), ["depth", "prefix"], "left_anti").groupBy("cell").agg(F.min("depth").cast("int").alias("depth"))
    found = cells.select("cell").join(fits, "cell", "left").fillna(bits, ["depth"])
    return found.select("cell", "depth", _bucket("cell", bits).alias("bucket"), F.lit(bits).alias("bits"))


def _covered(cells: DataFrame, keys: DataFrame, key_bits: int, bits: int) -> DataFrame:
    """``cells`` (cell, depth, generation) and those of ``keys`` that it lacks: each in the widest bucket that no other lies in."""
    new = keys.select(F.expr(_prefix("key", key_bits, bits)).alias("cell")).distinct().join(cells, "cell", "left_anti")
    # All prefixes of buckets are inner nodes: at most ``bits`` a bucket.
    above = F.explode(F.sequence(F.lit(0), F.col("depth") - 1)).alias("level")
    inner = cells.where("depth > 0").select("cell", above).select(F.col("level").alias("depth"), F.expr(_prefix("cell", bits, "level")).alias("prefix")).distinct()
    climbed = new.select("cell", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth")).withColumn("prefix", F.expr(_prefix("cell", bits, "depth")))
    free = climbed.join(inner, ["depth", "prefix"], "left_anti").groupBy("cell").agg(F.min("depth").cast("int").alias("depth"))
    return cells.unionByName(free.withColumns({"bucket": _bucket("cell", bits), "bits": F.lit(bits), "generation": F.lit(0)}))


def _placed(rows: DataFrame, cells: DataFrame, key_bits: int, bits: int) -> DataFrame:
    """``rows`` with the bucket that the directory has for their key."""
    keyed = rows.withColumn("cell", F.expr(_prefix("key", key_bits, bits)))
    return keyed.join(small(cells.select("cell", "bucket"), _DIRECTORY), "cell").drop("cell")


def _owned(texts: DataFrame) -> DataFrame:
    """The chains of ``texts`` (doc_id, key, bucket, text): bucket, key, chain, text_sha256, keep_id, group_size.

    Copies within a map task, then within a group of tasks, become one row with a count, so a text that a
    third of all rows have reaches its owner as some rows only. A bucket's owner compares the
    texts of each key byte by byte: equal ones are one group, others links of the key's chain.
    """
    n = max(1, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sums = (F.max("keep_id").alias("keep_id"), F.sum("n").cast("bigint").alias("n"))
    each = texts.select("bucket", "key", "text", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("n"))
    met = each.withColumn("meeting", F.spark_partition_id() % MEETINGS).groupBy("meeting", "bucket", "key", "text").agg(*sums).drop("meeting")
    owned = met.repartition(n, "bucket").groupBy("bucket", "key", "text").agg(*sums)
    hashed = owned.select("bucket", "key", F.sha2("text", 256).alias("text_sha256"), "keep_id", F.col("n").alias("group_size"))
    return _chained(hashed)


def _chained(groups: DataFrame) -> DataFrame:
    chain = F.expr("row_number() over (partition by bucket, key order by text_sha256) - 1").alias("chain")
    return groups.select("bucket", "key", chain, "text_sha256", "keep_id", "group_size")


def _entries(docs: DataFrame, key_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, key), and (doc_id, key, text_sha256) as files."""
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", _key(key_bits))
    return keyed, stored(keyed.select("doc_id", "key", F.sha2("text", 256).alias("text_sha256")), "entries")


@dataclass(frozen=True)
class Index:
    """An index below ``path``: buckets in generations, and the directory that says which generation holds a bucket.

    A generation is written first, the directory that points to it last, so one that is not finished
    is never seen, and readers of an older directory keep what they see.
    """

    path: str
    generation: int
    key_bits: int
    bits: int
    capacity: int

    def cells(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/directory-{self.generation}")

    def buckets(self, spark: SparkSession) -> DataFrame:
        """bucket, key, chain, text_sha256, keep_id, group_size of all that the directory points to."""
        parts = [spark.read.parquet(f"{self.path}/buckets-{g}").withColumn("generation", F.lit(g)) for g in range(self.generation + 1)]
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        owned = self.cells(spark).select("bucket", "generation").distinct()
        return every.join(small(owned, _DIRECTORY), ["bucket", "generation"], "left_semi").drop("generation")


def build(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = 64, path: str | None = None) -> tuple[Index, DataFrame]:
    """A new index of ``docs``, and the entries (doc_id, key, text_sha256) of all rows.

    ``key_bits`` under 64 makes keys collide, for tests.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    path = path or scratch(spark, "index")
    keyed, entries = _entries(docs, key_bits)
    # A key that occurs once needs no comparison; its text goes nowhere.
    keys = entries.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"), F.max("text_sha256").alias("text_sha256"))
    keys = stored(keys, "keys")
    cells = stored(directory(keys.select("key", F.lit(0).alias("floor")), capacity, key_bits).withColumn("generation", F.lit(0)), "directory")
    bits = cells.agg(F.max("bits")).first()[0] or 0
    placed = _placed(keys, cells, key_bits, bits)
    again = placed.where("n > 1").select("key", "bucket")
    single = placed.where("n = 1").select("bucket", "key", F.lit(0).alias("chain"), "text_sha256", "keep_id", F.lit(1).cast("bigint").alias("group_size"))
    owned = _owned(keyed.join(small(again, 1_000_000), "key"))
    single.union(owned).write.parquet(f"{path}/buckets-0")
    cells.write.parquet(f"{path}/directory-0")
    return Index(path, 0, key_bits, bits, capacity), entries


def insert(index: Index, docs: DataFrame, new: DataFrame) -> Index:
    """The index of ``docs``, which ``index`` holds, and of the rows ``new``, as its next generation.

    Only buckets that get keys are written again; those that are overfull then are split. Texts of
    ``docs`` are compared where a key meets a new row's, and read no further.
    """
    spark = docs.sparkSession
    key_bits = index.key_bits
    keyed, entries = _entries(new, key_bits)
    buckets = index.buckets(spark)
    cells = stored(_covered(index.cells(spark), entries, key_bits, index.bits), "covered")
    fresh = stored(_placed(entries.select("key").distinct(), cells, key_bits, index.bits), "fresh")
    touched = small(fresh.select("bucket").distinct(), _DIRECTORY)
    before = stored(buckets.join(touched, "bucket", "left_semi"), "before")

    depth = F.substring_index("bucket", ":", 1).cast("int").alias("floor")
    keys = before.select("key", "bucket").union(fresh.select("key", "bucket")).distinct().select("key", depth)
    split = directory(keys, index.capacity, key_bits, index.bits)
    bits = split.agg(F.max("bits")).first()[0] or index.bits
    # Buckets that nothing came to keep depth and generation, in a directory that may have doubled.
    rest = cells.join(touched, "bucket", "left_anti")
    if bits > index.bits:
        wide = bits - index.bits
        within = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit((1 << wide) - 1))).alias("part")
        rest = rest.select("depth", "bucket", "generation", (F.expr(f"shiftleft(cell, {wide})").alias("first")), within)
        rest = rest.withColumn("cell", F.col("first") + F.col("part"))
    kept = rest.select("cell", "depth", "bucket", F.lit(bits).alias("bits"), "generation")
    after = stored(kept.unionByName(split.withColumn("generation", F.lit(index.generation + 1))), "directory")

    counts = before.groupBy("key").agg(F.sum("group_size").alias("n")).union(entries.groupBy("key").agg(F.count("*").alias("n")))
    met = entries.select("key").distinct().join(counts.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1"), "key", "left_semi")
    met = stored(met, "met")
    older = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", _key(key_bits))
    texts = keyed.unionByName(older).join(small(met, 1_000_000), "key")
    owned = _owned(_placed(texts, after, key_bits, bits))
    one = entries.join(met, "key", "left_anti").select("key", F.lit(0).alias("chain"), "text_sha256", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"))
    others = before.drop("bucket").join(met, "key", "left_anti").unionByName(one)
    _placed(others, after, key_bits, bits).unionByName(owned).write.parquet(f"{index.path}/buckets-{index.generation + 1}")
    after.write.parquet(f"{index.path}/directory-{index.generation + 1}")
    return Index(index.path, index.generation + 1, key_bits, bits, index.capacity)


def lookup(index: Index, entries: DataFrame) -> DataFrame:
    """``entries`` (doc_id, key, text_sha256) with bucket, chain, keep_id and group_size; null where the index has no such text."""
    spark = entries.sparkSession
    keyed = entries.withColumn("cell", F.expr(_prefix("key", index.key_bits, index.bits)))
    cells = small(index.cells(spark).select("cell", "bucket"), _DIRECTORY)
    return keyed.join(cells, "cell", "left").drop("cell").join(index.buckets(spark), ["bucket", "key", "text_sha256"], "left")


def exact(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = 64) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256, chain.

    Texts are equal if their bytes are; null counts as empty. The largest doc_id of a group stays.
    Rows that agree in doc_id and text count separately in group_size and are marked alike. Rows whose
    doc_id is null stay only where the whole group's ids are null. No other column is read; an empty
    table gives an empty result.
    """
    index, entries = build(docs, capacity, key_bits)
    spark = docs.sparkSession
    # What the index has as one document of one text needs no look at its bucket.
    groups = index.buckets(spark).where("group_size > 1 or chain > 0")
    placed = _placed(entries, index.cells(spark), key_bits, index.bits)
    joined = placed.join(groups, ["bucket", "key", "text_sha256"], "left")
    keep = F.coalesce("keep_id", "doc_id")
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
        F.coalesce("chain", F.lit(0)).alias("chain"),
    )


def keep(docs: DataFrame, **options) -> DataFrame:
    """One row of each group, of the largest doc_id (null only where all are), with its own columns.

    Null texts count as empty. Of rows that agree in doc_id and text one is left; rows of one id with
    unlike texts are judged apart. Extra columns, whatever their names, stay; an empty table stays empty.
    """
    rows = exact(docs, **options).where("group_size > 1").select("doc_id", F.xxhash64("text_sha256").alias("mark"), "kept")
    counted = stored(rows.groupBy("doc_id", "mark", "kept").count(), "verdicts")
    pair = ("doc_id", "mark")
    return rows_left(docs, counted.where("not kept").select(*pair), counted.where("kept and count > 1").select(*pair))
