"""Downloaded files and their payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """path, modified_at and length of the files of a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return found.select("path", F.col("modificationTime").alias("modified_at"), "length")


def payloads(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path and content of the files of a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")


def likely_reports(files: DataFrame, least: int = 4_000_000) -> DataFrame:
    """Files that are not known to be small; an unknown length counts as large enough."""
    small = (F.col("length") > 0) & (F.col("length") < least)
    return files.where(~F.coalesce(small, F.lit(False)))


def carved(content: Column) -> Column:
    """The report inside a binary payload: from the first head to the last end mark; null without a head."""
    h = F.hex(content)
    head = F.regexp_extract(h, "^((?:..)*?)25504446", 0)
    begin = F.length(head) - 7
    rest = F.substring(h, begin, F.length(h))
    body = F.regexp_extract(rest, "^((?:..)*)2525454F46", 0)
    return F.when(head != "", F.unhex(F.when(body != "", body).otherwise(rest)))
