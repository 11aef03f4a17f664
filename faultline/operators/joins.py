"""Equi-joins with the null rules of the marts.

No side is hinted: Spark broadcasts a side only if its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive execution splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join of dimension columns. A null key matches a null dimension key, if there is one."""
    side = dim.select(F.col(key).alias("_dim_key"), *columns)
    return df.join(side, F.col(key).eqNullSafe(F.col("_dim_key")), "left").drop("_dim_key")


def fill_from_lookup(df: DataFrame, lookup: DataFrame | None, target: str, on: str, lookup_key: str, value: str) -> DataFrame:
    """Fill ``target`` only where it is null; without a lookup the data stay as they are."""
    if lookup is None:
        return df
    side = lookup.select(F.col(lookup_key).alias("_lookup_key"), F.col(value).alias("_lookup_value"))
    joined = df.join(side, F.col(on) == F.col("_lookup_key"), "left")
    return joined.withColumn(target, F.coalesce(target, "_lookup_value")).select(*df.columns)


def flag_members(df: DataFrame, column: str, values: DataFrame, value_column: str, flag: str) -> DataFrame:
    """Add a boolean: is the value among ``values``? Null is not a member."""
    known = values.select(F.col(value_column).alias("_member")).where(F.col("_member").isNotNull()).distinct()
    joined = df.join(known, F.col(column) == F.col("_member"), "left")
    return joined.withColumn(flag, F.col("_member").isNotNull()).drop("_member")


def fill_flags(df: DataFrame, flags: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join of boolean columns; rows without a match get false."""
    joined = df.join(flags.select(key, *columns), key, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(False)) for c in columns})


def stack_counts(parts: Sequence[DataFrame], key: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Union of tables with different counts; a count a table does not have is 0."""
    zero = F.lit(0).cast("bigint")
    aligned = [part.select(*key, *[F.col(c) if c in part.columns else zero.alias(c) for c in counts]) for part in parts]
    return reduce(DataFrame.unionByName, aligned)


def merge_counts(parts: Sequence[DataFrame], key: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Full outer join of the sums per ``key``, missing counts 0, nulls in the key equal.

    A union and one sum give the same rows as aggregates chained by outer joins, with a single shuffle behind
    map-side sums, and no null-safe join conditions. The parts may be rows to be summed or sums already.
    """
    stacked = stack_counts(parts, key, counts)
    return stacked.groupBy(*key).agg(*[F.sum(c).alias(c) for c in counts])
