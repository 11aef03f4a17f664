"""Data-quality checks. Each is one aggregate that ends as one row of the result table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.rounding import count_text, percent_text, round_exact
from faultline.schemas import QA_RESULT


def _result(row: DataFrame, name: str, status: Column, metric: Column, threshold: float | None, details: Column) -> DataFrame:
    return row.select(
        F.lit(name).alias("check_name"),
        status.alias("status"),
        metric.cast("double").alias("metric_value"),
        F.lit(threshold).cast("double").alias("threshold"),
        details.alias("details"),
    )


def _grade(value: Column, limit: float, warn_limit: float) -> Column:
    return F.when(value <= limit, "pass").when(value <= warn_limit, "warn").otherwise("fail")


def failed(spark: SparkSession, name: str, details: str, threshold: float | None = None) -> DataFrame:
    """A failed check without a measurement, e.g. a missing table."""
    return spark.createDataFrame([(name, "fail", None, threshold, details)], QA_RESULT)


def _missing_column(df: DataFrame, check: str, column: str, threshold: float | None) -> DataFrame | None:
    if column in df.columns:
        return None
    return failed(df.sparkSession, f"{check}_{column}", f"Column '{column}' not found", threshold)


def _graded(name: str, status: Column, metric: Column, threshold: float | None, details: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"), status.alias("status"), metric.cast("double").alias("metric_value"),
        F.lit(threshold).cast("double").alias("threshold"), details.alias("details"),
    )


def _row_limit(name: str, rows: Column, max_rows: int) -> Column:
    details = F.concat(F.lit(f"{name}: "), count_text(rows), F.lit(f" rows (max {max_rows:,})"))
    return _graded(f"row_limit_{name}", F.when(rows <= max_rows, "pass").otherwise("fail"), rows, max_rows, details)


def _null_rate(column: str, nulls: Column, rows: Column, most: float) -> Column:
    rate = F.coalesce(F.try_divide(nulls.cast("double"), rows.cast("double")), F.lit(0.0))
    details = F.concat(F.lit(f"{column}: "), percent_text(rate), F.lit(f" null (max {most:.1%})"))
    return _graded(f"null_rate_{column}", _grade(rate, most, most * 2), round_exact(rate, 4), most, details)


def _unique(name: str, columns: Sequence[str], duplicates: Column, rows: Column) -> Column:
    details = F.when(rows == 0, F.lit(f"{name}: empty DataFrame")).otherwise(
        F.concat(F.lit(f"{name}: "), count_text(duplicates), F.lit(f" duplicates on {list(columns)}"))
    )
    return _graded(f"uniqueness_{name}", F.when(duplicates == 0, "pass").otherwise("fail"), duplicates, 0, details)


def table_checks(
    df: DataFrame,
    name: str,
    min_rows: int = 1,
    null_columns: Sequence[str] | Mapping[str, float] = (),
    max_null_rate: float = 0.05,
    *,
    key: Sequence[str] = (),
    key_name: str | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Row count and limit, null rates and uniqueness of one table, all from a single scan.

    With a key, counts are taken per key and then summed, so the pass that finds duplicates brings the others along.
    """
    rates = dict(null_columns) if isinstance(null_columns, Mapping) else dict.fromkeys(null_columns, max_null_rate)
    known = [c for c in rates if c in df.columns]
    counts = {"_rows": F.count("*")} | {f"_null_{c}": F.count_if(_is_missing(df, c)) for c in known}
    if key:
        per_key = df.groupBy(*[F.col(c).alias(f"_key_{c}") for c in key]).agg(*[v.alias(c) for c, v in counts.items()])
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]
        row = per_key.agg(*sums, F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("_duplicates"))
    else:
        row = df.agg(*[v.alias(c) for c, v in counts.items()])
    rows = F.col("_rows")
    enough = F.concat(F.lit(f"{name}: "), count_text(rows), F.lit(f" rows (min {min_rows:,})"))
    results = [_graded(f"row_count_{name}", F.when(rows >= min_rows, "pass").otherwise("fail"), rows, min_rows, enough)]
    results += [_null_rate(c, F.col(f"_null_{c}"), rows, rates[c]) for c in known]
    if max_rows is not None:
        results.append(_row_limit(name, rows, max_rows))
    if key:
        results.append(_unique(key_name or name, key, F.col("_duplicates"), rows))
    out = row.select(F.inline(F.array(*results)))
    for c in rates:
        absent = _missing_column(df, "null_rate", c, rates[c])
        out = out if absent is None else out.unionByName(absent)
    return out


def _is_missing(df: DataFrame, column: str) -> Column:
    numeric = df.schema[column].dataType.typeName() in ("double", "float")
    return F.col(column).isNull() | F.isnan(column) if numeric else F.col(column).isNull()


def check_row_count(df: DataFrame, name: str, min_rows: int = 1) -> DataFrame:
    return table_checks(df, name, min_rows)


def check_null_rate(df: DataFrame, column: str, max_rate: float = 0.05) -> DataFrame:
    """At most the rate passes, up to twice the rate warns."""
    return table_checks(df, "_", 0, [column], max_rate).where(F.col("check_name") == f"null_rate_{column}")


def check_row_limit(df: DataFrame, name: str, max_rows: int) -> DataFrame:
    return df.agg(F.count("*").alias("_rows")).select(F.inline(F.array(_row_limit(name, F.col("_rows"), max_rows))))


def check_uniqueness(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Rows beyond the first per key; nulls are equal to each other."""
    return table_checks(df, name, key=columns).where(F.col("check_name") == f"uniqueness_{name}")


def check_dedup_ratio(counts: DataFrame, raw: str, kept: str, name: str, max_ratio: float = 0.5) -> DataFrame:
    """``counts`` is one row with the row counts before and after deduplication."""
    ratio = F.try_divide((F.col(raw) - F.col(kept)).cast("double"), F.col(raw).cast("double"))
    known = F.coalesce(ratio, F.lit(0.0))
    details = F.when(F.col(raw) == 0, F.lit(f"{name}: no raw rows")).otherwise(
        F.concat(F.lit(f"{name}: "), percent_text(known), F.lit(" removed ("), count_text(F.col(raw)), F.lit(" -> "),
                 count_text(F.col(kept)), F.lit(")"))
    )
    return _result(counts, f"dedup_ratio_{name}", _grade(known, max_ratio, max_ratio + 0.1), round_exact(known, 4), max_ratio, details)


def check_coverage(df: DataFrame, column: str, reference: DataFrame | None = None, reference_column: str | None = None) -> DataFrame:
    """Without a reference the non-null share of rows; with one the share of its values that occur."""
    absent = _missing_column(df, "coverage", column, None)
    if absent is not None:
        return absent
    filled = df.agg(F.count(column).alias("_filled"), F.count("*").alias("_total"))
    rate = F.coalesce(F.try_divide(F.col("_filled").cast("double"), F.col("_total").cast("double")), F.lit(0.0))
    if reference is None:
        row, measured = filled, rate
        details = F.concat(F.lit(f"{column}: "), percent_text(rate), F.lit(" non-null ("), count_text(F.col("_filled")),
                           F.lit("/"), count_text(F.col("_total")), F.lit(")"))
    else:
        # One grouped pass gives both figures: rows and values of the column, marked by reference values.
        wanted = reference.select(F.col(reference_column or column).alias("v")).where("v IS NOT NULL").distinct()
        have = df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
        stacked = have.select("v", "n", F.lit(0).alias("ref")).unionByName(
            wanted.select("v", F.lit(0).cast("bigint").alias("n"), F.lit(1).alias("ref"))
        )
        per_value = stacked.groupBy("v").agg(F.sum("n").alias("n"), F.max("ref").alias("ref"))
        row = per_value.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("_total"),
            F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("_filled"),
            F.count_if(F.col("ref") == 1).alias("_wanted"),
            F.count_if((F.col("ref") == 1) & (F.col("n") > 0)).alias("_matched"),
        )
        measured = F.coalesce(F.try_divide(F.col("_matched").cast("double"), F.col("_wanted").cast("double")), F.lit(0.0))
        details = F.concat(
            F.lit(f"{column}: "), F.col("_matched").cast("string"), F.lit("/"), F.col("_wanted").cast("string"),
            F.lit(" ref values ("), percent_text(measured), F.lit("), row coverage "), percent_text(rate),
        )
    status = F.when(measured >= 0.7, "pass").when(measured >= 0.5, "warn").otherwise("fail")
    return _result(row, f"coverage_{column}", status, round_exact(measured, 4), 0.7, details)


def year_changes(df: DataFrame, year: str, count: str | None = None) -> DataFrame:
    """Relative change from each present year to the next present one; a previous 0 gives null.

    The years are compared as one array, which has one entry per calendar year, whatever the size of the table.
    """
    volume = F.sum(count) if count else F.count("*")
    yearly = df.where(F.col(year).isNotNull()).groupBy(F.col(year).alias("year")).agg(volume.alias("n"))
    packed = yearly.agg(F.sort_array(F.collect_list(F.struct("year", "n"))).alias("years"))
    pairs = packed.select("years", F.posexplode("years").alias("at", "now"))
    before = F.get("years", F.col("at") - 1)
    pairs = pairs.select("now.year", "now.n", before["year"].alias("prev_year"), before["n"].alias("prev_n"))
    change = F.when(F.col("prev_n") != 0, F.abs(F.col("n") - F.col("prev_n")).cast("double") / F.col("prev_n").cast("double"))
    return pairs.withColumn("change", change)


def check_volume_shift(df: DataFrame, year: str, count: str | None = None, max_change: float = 0.5) -> DataFrame:
    """Largest year-over-year change; of equal ones the earliest. Fewer than two years pass."""
    absent = _missing_column(df, "volume_shift", year, max_change)
    if absent is not None:
        return absent
    changes = year_changes(df, year, count)
    # A shrinking negative volume is no shift: changes count from zero up.
    changes = changes.withColumn("change", F.greatest("change", F.lit(0.0)))
    worst = F.max_by(F.struct("prev_year", "year", "change"), F.struct("change", -F.col("year"))).alias("w")
    row = changes.agg(F.count("*").alias("years"), worst).select("years", "w.*")
    shift = F.when(F.col("years") >= 2, F.coalesce("change", F.lit(0.0))).otherwise(0.0)
    pair = F.when(F.col("change") > 0, F.concat_ws("->", F.col("prev_year").cast("string"), F.col("year").cast("string"))).otherwise("")
    details = F.when(F.col("years") < 2, F.lit("Not enough years to compare")).otherwise(
        F.concat(F.lit("Max YoY change: "), percent_text(shift), F.lit(" ("), pair, F.lit(")"))
    )
    return _result(row, f"volume_shift_{year}", _grade(shift, max_change, max_change * 1.5), round_exact(shift, 4), max_change, details)


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """All results in one table."""
    return reduce(DataFrame.unionByName, checks)


def quality_gate(summary: DataFrame) -> DataFrame:
    """One row: passed unless a check failed; warnings and an empty table pass."""
    return summary.agg(
        (F.count_if(F.col("status") == "fail") == 0).alias("gate_passed"),
        F.count("*").alias("checks"),
        F.count_if(F.col("status") == "fail").alias("failed"),
        F.count_if(F.col("status") == "warn").alias("warned"),
    )


def evaluate_quality_gate(summary: DataFrame) -> bool:
    return quality_gate(summary).first()["gate_passed"]


def assert_grain(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """The table itself; raises if the columns are not a key."""
    duplicates = int(check_uniqueness(df, columns, name).first()["metric_value"])
    if duplicates:
        raise ValueError(f"{name} has {duplicates} duplicate keys on {list(columns)}")
    return df


def kpi_null_invariant(df: DataFrame, rules: Sequence[tuple[str, str, int]]) -> DataFrame:
    """Per (kpi, denominator, minimum): null KPIs, and those null although the minimum is met."""
    row = df.agg(
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k, _, _ in rules],
        *[F.count_if(F.col(k).isNull() & (F.col(d) >= m)).alias(f"bad_{k}") for k, d, m in rules],
    )
    items = [
        F.struct(F.lit(k).alias("kpi"), F.col(f"null_{k}").alias("null_rows"), F.col(f"bad_{k}").alias("violations"),
                 (F.col(f"bad_{k}") == 0).alias("holds"))
        for k, _, _ in rules
    ]
    return row.select(F.inline(F.array(*items)))
