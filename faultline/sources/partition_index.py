"""Index of downloadable partitions: pruning by year, size estimate, landing names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_INDEX = (
    "results struct<device: struct<event: struct<partitions: "
    "array<struct<file: string, display_name: string, size_mb: string>>>>>"
)


def read_partition_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, display_name, size_mb) of every partition in a download index."""
    index = spark.read.schema(_INDEX).json(path, multiLine=True)
    return index.select(F.inline("results.device.event.partitions"))


def partition_year(display_name: Column, file: Column) -> Column:
    """First four-digit year 2000-2030 among the words of the name, then the path segments."""
    words = F.split(F.coalesce(display_name, F.lit("")), r"(?U)\s+")
    segments = F.split(F.coalesce(file, F.lit("")), "/")
    bare = F.transform(F.concat(words, segments), lambda t: F.regexp_replace(t, r"^[-.()\[\]]+|[-.()\[\]]+$", ""))
    years = F.filter(bare, lambda t: t.rlike("^[0-9]{4}$") & t.between("2000", "2030"))
    return F.try_element_at(years, F.lit(1)).cast("int")


def prune_partitions(index: DataFrame, first: int, last: int) -> DataFrame:
    """Partitions of the year window; those without a recognisable year stay."""
    year = partition_year(F.col("display_name"), F.col("file"))
    return index.withColumn("year", year).filter(F.col("year").isNull() | F.col("year").between(first, last))


def landed_volume(index: DataFrame) -> DataFrame:
    """Partitions and their summed size in MB; a missing or unreadable size counts 0."""
    size = F.coalesce(F.expr("try_cast(size_mb AS double)"), F.lit(0.0))
    return index.agg(F.count("*").alias("partitions"), F.coalesce(F.sum(size), F.lit(0.0)).alias("size_mb"))


def landing_name(file: Column) -> Column:
    """Last two path segments joined by an underscore: the unique name of a landed file."""
    parts = F.split(F.regexp_replace(file, "/+$", ""), "/")
    return F.array_join(F.slice(parts, -F.least(F.size(parts), F.lit(2)), F.least(F.size(parts), F.lit(2))), "_")
