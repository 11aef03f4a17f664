"""App tables: labelled, enriched, capped and ordered extracts of the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.config import DEFAULTS, Settings
from faultline.functions.rounding import round_exact
from faultline.functions.text import is_junk_code, label_or_unknown
from faultline.fixed_values import TIER_EXACT, TIER_HIGH, TIER_LOW, TIER_NONE
from faultline.operators.counts import overlap
from faultline.operators.joins import enrich
from faultline.sources.tables import write_csv


def top_by_volume(
    df: DataFrame, measure: str, order: list[Column], n: int, partition_by: str | None = None
) -> DataFrame:
    """The ``n`` rows with the largest measure, ties in the given order; all rows if there are no more.

    With ``partition_by`` the cap holds per group. Spark then keeps n rows per group and task before it
    shuffles, so a large group does not end in one task.
    """
    if partition_by is None:
        return df.orderBy(F.desc(measure), *order).limit(n)
    place = F.row_number().over(Window.partitionBy(partition_by).orderBy(F.desc(measure), *order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def app_overview(panel_year: DataFrame) -> DataFrame:
    labelled = panel_year.withColumn("review_panel", label_or_unknown(F.col("review_panel")))
    return labelled.orderBy("review_panel", "year")


def app_category_product(product_year: DataFrame, dim: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    order = [F.asc_nulls_last("product_code"), F.asc_nulls_last("year")]
    usable = product_year.filter(~is_junk_code(F.col("product_code")))
    columns = ["device_name", "review_panel", "device_class", "medical_specialty_description"]
    top = top_by_volume(enrich(usable, dim, "product_code", columns), "event_count_dedup", order, settings.category_rows)
    return top.orderBy(*order)


def app_manufacturer(
    firm_product_year: DataFrame, dim: DataFrame, settings: Settings = DEFAULTS, partition_by: str | None = None
) -> DataFrame:
    tail = [F.asc_nulls_last("product_code"), F.asc_nulls_last("year")]
    labelled = firm_product_year.withColumn("_reported", F.col("manufacturer"))
    labelled = labelled.withColumn("manufacturer", label_or_unknown(F.col("manufacturer")))
    enriched = enrich(labelled, dim, "product_code", ["device_name", "review_panel"])
    # Ties keep the order of the mart, which is that of the names as reported.
    top = top_by_volume(
        enriched, "event_count_dedup", [F.asc_nulls_last("_reported"), *tail], settings.manufacturer_rows, partition_by
    )
    return top.drop("_reported").orderBy("manufacturer", *tail)


def _percent(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal; 0.0 if there are no rows."""
    rate = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return F.coalesce(round_exact(rate, 1), F.lit(0.0))


def _metrics(row: DataFrame, source: str, names: list[str]) -> DataFrame:
    """One row of columns to (source, metric, value) rows; the value is text."""
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("string").alias("value")) for n in names])
    return row.select(F.lit(source).alias("source"), F.inline(pairs))


def _profile(date: str) -> list[Column]:
    day = F.col(date).cast("date")
    return [F.count("*").alias("row_count"), F.min(day).alias("date_min"), F.max(day).alias("date_max")]


_PROFILE = ["row_count", "date_min", "date_max"]


def source_profile(df: DataFrame, source: str, date: str) -> DataFrame:
    """row_count, and date_min and date_max unless there is no date."""
    return _metrics(df.agg(*_profile(date)), source, _PROFILE).where("value IS NOT NULL")


def code_coverage(events: DataFrame, dim: DataFrame) -> DataFrame:
    """Percent of the distinct event codes the dimension knows; no row without codes."""
    sizes = overlap(events, "product_code", dim, "product_code").where("left_values > 0")
    value = _percent(F.col("shared_values"), F.col("left_values"))
    return _metrics(
        sizes.select(value.alias("event_product_code_coverage_pct")), "mapping_coverage", ["event_product_code_coverage_pct"]
    )


def event_figures(events: DataFrame) -> DataFrame:
    """Profile and quality of the events, from one pass."""
    row = events.agg(
        *_profile("date_received"),
        F.count_if("is_latest_version").alias("dedup_count"),
        F.count("product_code").alias("coded"),
        F.count("manufacturer_d_name").alias("named"),
    )
    raw = F.col("row_count")
    # 1 - latest/raw, in this order: the rounded digit depends on it.
    kept = F.try_divide(F.col("dedup_count").cast("double"), raw.cast("double"))
    rated = row.select(
        *_PROFILE,
        raw.alias("raw_count"),
        "dedup_count",
        F.coalesce(round_exact((1 - kept) * 100, 1), F.lit(0.0)).alias("duplicate_rate_pct"),
        _percent(raw - F.col("coded"), raw).alias("missing_product_code_pct"),
        _percent(F.col("named"), raw).alias("manufacturer_fill_rate_pct"),
    )
    return _metrics(rated, "adverse_events", rated.columns).where("value IS NOT NULL")


def recall_figures(recalls: DataFrame) -> DataFrame:
    """Profile and mapping quality of the recalls, from one pass."""
    tiers = {
        "mapping_quality_exact": TIER_EXACT,
        "mapping_quality_high": TIER_HIGH,
        "mapping_quality_low": TIER_LOW,
        "mapping_quality_unmapped": TIER_NONE,
    }
    row = recalls.agg(
        *_profile("recall_initiation_date"),
        *[F.count_if(F.col("mapping_quality") == tier).alias(name) for name, tier in tiers.items()],
        F.count_if("include_in_core_dashboard").alias("core"),
    )
    share = _percent(F.col("core"), F.col("row_count")).alias("core_dashboard_coverage_pct")
    rated = row.select(*_PROFILE, *tiers, share)
    return _metrics(rated, "recalls", rated.columns).where("value IS NOT NULL")


def app_methodology(
    events: DataFrame, recalls: DataFrame, clearances: DataFrame, dim: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Transparency table: one (source, metric, value) row per figure."""
    spark = events.sparkSession
    window = spark.range(1).select(F.lit(settings.year_min).alias("year_min"), F.lit(settings.year_max).alias("year_max"))
    parts = [
        event_figures(events),
        recall_figures(recalls),
        source_profile(clearances, "clearances", "decision_date"),
        _metrics(dim.agg(F.count("*").alias("row_count")), "dim_product_code", ["row_count"]),
        code_coverage(events, dim),
        _metrics(window, "analysis_window", ["year_min", "year_max"]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def export_all(marts: dict[str, DataFrame], clean: dict[str, DataFrame], settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """The four app tables. ``clean`` holds events, recalls (mapped), clearances and dim."""
    dim = clean["dim"]
    return {
        "app_overview": app_overview(marts["mart_panel_year"]),
        "app_category_product": app_category_product(marts["mart_product_code_year"], dim, settings),
        "app_manufacturer": app_manufacturer(marts["mart_firm_product_year"], dim, settings),
        "app_methodology": app_methodology(clean["events"], clean["recalls"], clean["clearances"], dim, settings),
    }


def write_exports(apps: dict[str, DataFrame], folder: str) -> None:
    """CSV per app table. The capped tables and the methodology rows fit one file; the overview has no cap."""
    for name, df in apps.items():
        write_csv(df, f"{folder}/{name}.csv", capped=name != "app_overview")
