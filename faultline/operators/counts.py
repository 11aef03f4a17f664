"""Grouped counts of events, recalls and clearances, and general profiles of a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_years(df: DataFrame, year: str, first: int | None, last: int | None) -> DataFrame:
    """Inclusive year window; rows without a year drop out. No bounds, no filter."""
    if first is None or last is None:
        return df
    return df.filter(F.col(year).between(first, last))


def recall_code() -> Column:
    """The mapped code wins over the reported one."""
    return F.coalesce("matched_product_code", "product_code")


def _one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("bigint")


def event_rows(events: DataFrame, key: Sequence[str | Column]) -> DataFrame:
    """Events with a year as rows to be summed. Only ``event_count_dedup`` is limited to latest versions."""
    return events.filter(F.col("event_year").isNotNull()).select(
        *key,
        F.col("event_year").cast("int").alias("year"),
        F.lit(1).cast("bigint").alias("event_count_raw"),
        _one_if(F.col("is_latest_version")).alias("event_count_dedup"),
        _one_if(F.col("has_death")).alias("death_related_reports"),
        _one_if(F.col("has_serious_injury")).alias("serious_injury_reports"),
        _one_if(F.col("has_malfunction")).alias("malfunction_reports"),
    )


def recall_rows(recalls: DataFrame, key: Sequence[str | Column]) -> DataFrame:
    """Recalls with a year that belong to the core dashboard, as rows to be summed."""
    return recalls.filter(F.col("include_in_core_dashboard") & F.col("recall_year").isNotNull()).select(
        *key,
        F.col("recall_year").cast("int").alias("year"),
        F.lit(1).cast("bigint").alias("recall_count"),
        _one_if(F.col("recall_class") == "I").alias("class_i_recall_count"),
        _one_if(F.col("recall_class") == "II").alias("class_ii_recall_count"),
        _one_if(F.col("recall_class") == "III").alias("class_iii_recall_count"),
    )


def clearance_rows(clearances: DataFrame, key: Sequence[str | Column]) -> DataFrame:
    return clearances.filter(F.col("decision_year").isNotNull()).select(
        *key, F.col("decision_year").cast("int").alias("year"), F.lit(1).cast("bigint").alias("clearance_count")
    )


_MEASURES = ("event_count_raw", "event_count_dedup", "death_related_reports", "serious_injury_reports",
             "malfunction_reports", "recall_count", "class_i_recall_count", "class_ii_recall_count",
             "class_iii_recall_count", "clearance_count")


def sum_counts(rows: DataFrame) -> DataFrame:
    """Sum the measures over everything else."""
    key = [c for c in rows.columns if c not in _MEASURES]
    return rows.groupBy(*key).agg(*[F.sum(c).alias(c) for c in rows.columns if c in _MEASURES])


def event_counts(events: DataFrame, key: Sequence[str | Column]) -> DataFrame:
    return sum_counts(event_rows(events, key))


def recall_counts(recalls: DataFrame, key: Sequence[str | Column]) -> DataFrame:
    return sum_counts(recall_rows(recalls, key))


def clearance_counts(clearances: DataFrame, key: Sequence[str | Column]) -> DataFrame:
    return sum_counts(clearance_rows(clearances, key))


def roll_up(counts: DataFrame, key: Sequence[str]) -> DataFrame:
    """Sum a count table to a coarser key; year stays."""
    return sum_counts(counts.select(*key, "year", *[c for c in counts.columns if c in _MEASURES]))


def to_panels(counts: DataFrame, dim: DataFrame) -> DataFrame:
    """Counts by (product_code, year) to (review_panel, year).

    The facts are reduced to codes and years first, so only small tables meet the dimension. Codes the
    dimension does not know, and codes without a panel, drop out.
    """
    panels = dim.select("product_code", "review_panel").where("review_panel IS NOT NULL")
    return roll_up(counts.join(panels, "product_code"), ["review_panel"])


def name_frequency(df: DataFrame, column: str) -> DataFrame:
    """Names by descending frequency, ties by name; nulls excluded."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )


def facet_counts(df: DataFrame, column: str, where: Column | None = None, limit: int = 1000) -> DataFrame:
    """The most frequent terms of a field with their counts."""
    base = df if where is None else df.where(where)
    return (
        base.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("term"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.asc("term"))
        .limit(limit)
    )


def filtered_count(df: DataFrame, where: Column | None = None) -> DataFrame:
    base = df if where is None else df.where(where)
    return base.agg(F.count("*").alias("total"))


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and share of every non-null value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n").cast("double") / total.cast("double"))


def top_totals(df: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """Totals of a measure per key, the ``n`` largest."""
    totals = df.groupBy(key).agg(F.sum(measure).alias(measure))
    return totals.orderBy(F.desc(measure), F.asc_nulls_last(key)).limit(n)


def rows_per_year(df: DataFrame, year: str) -> DataFrame:
    return df.where(F.col(year).isNotNull()).groupBy(year).agg(F.count("*").alias("n")).orderBy(year)


def alias_reduction(alias: DataFrame) -> DataFrame:
    """How many names the alias table merges away."""
    raw, standard = F.count_distinct("raw_name"), F.count_distinct("standardized_name")
    return alias.agg(
        raw.alias("raw_names"),
        standard.alias("standardized_names"),
        F.when(raw > 0, 1 - standard.cast("double") / raw.cast("double")).alias("reduction"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, and per column the distinct values and whether the column is unique.

    One grouped pass per column: a single aggregate with several distinct counts would multiply every row
    by the number of columns before its shuffle.
    """
    out = None
    for c in columns:
        per_value = df.groupBy(c).agg(F.count("*").alias("n"))
        row = per_value.agg(
            F.lit(c).alias("column_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.count(c).alias("distinct_values"),
            F.coalesce(F.max("n") <= 1, F.lit(True)).alias("is_unique"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def seriousness(df: DataFrame) -> DataFrame:
    """Totals and rates of the three seriousness flags over latest rows."""
    latest = df.where("is_latest_version")
    out = []
    for flag, name in (("has_death", "death"), ("has_serious_injury", "serious_injury"), ("has_malfunction", "malfunction")):
        out.append(F.count_if(F.col(flag)).alias(f"{name}_total"))
        out.append(F.avg(F.col(flag).cast("double")).alias(f"{name}_rate"))
    return latest.agg(*out)


def overlap(left: DataFrame, left_column: str, right: DataFrame, right_column: str) -> DataFrame:
    """Sizes of two value sets and of their intersection, nulls excluded."""
    a = left.select(F.col(left_column).alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b"))
    b = right.select(F.col(right_column).alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    per_value = a.unionByName(b).where("v IS NOT NULL").groupBy("v").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return per_value.agg(
        F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("left_values"),
        F.coalesce(F.sum("b"), F.lit(0)).cast("bigint").alias("right_values"),
        F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).cast("bigint").alias("shared_values"),
    )


def field_presence(df: DataFrame, record: str, fields: Sequence[str]) -> DataFrame:
    """Share of raw records that carry each required field, in one pass."""
    parsed = df.select(F.try_parse_json(record).alias("v"))
    has = [F.try_variant_get("v", f"$.{f}", "variant").isNotNull() for f in fields]
    rates = parsed.agg(*[F.avg(h.cast("double")).alias(f) for h, f in zip(has, fields)])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("present_rate")) for f in fields])
    return rates.select(F.inline(pairs))
