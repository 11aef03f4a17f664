"""The three marts, each one plan from fact tables to guarded KPIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.config import DEFAULTS, Settings
from faultline.functions import kpis
from faultline.operators.counts import (
    clearance_rows,
    event_rows,
    in_years,
    recall_code,
    recall_rows,
    roll_up,
    sum_counts,
    to_panels,
)
from faultline.operators.joins import enrich, merge_counts
from faultline.schemas import FIRM_COUNTS, PANEL_COUNTS, PRODUCT_COUNTS
from faultline.session import stored
from faultline.sources.tables import write_table

_CODE = ["product_code"]


def product_rows(events: DataFrame, recalls: DataFrame, clearances: DataFrame, settings: Settings = DEFAULTS) -> list[DataFrame]:
    """The facts by (product_code, year), to be summed: the base of the panel and product marts."""
    years = settings.year_min, settings.year_max
    return [
        event_rows(in_years(events, "event_year", *years), _CODE),
        recall_rows(in_years(recalls, "recall_year", *years), [recall_code().alias("product_code")]),
        clearance_rows(in_years(clearances, "decision_year", *years), _CODE),
    ]


def firm_event_rows(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Events by (manufacturer, product_code, year), to be summed; the manufacturer may be null."""
    key = [F.col("manufacturer_d_name").alias("manufacturer"), "product_code"]
    return event_rows(in_years(events, "event_year", settings.year_min, settings.year_max), key)


def firm_recall_rows(recalls: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Recalls by (manufacturer, product_code, year), to be summed; the manufacturer may be null."""
    key = [F.col("recalling_firm").alias("manufacturer"), recall_code().alias("product_code")]
    return recall_rows(in_years(recalls, "recall_year", settings.year_min, settings.year_max), key)


def firm_rows(events: DataFrame, recalls: DataFrame, settings: Settings = DEFAULTS) -> list[DataFrame]:
    return [firm_event_rows(events, settings), firm_recall_rows(recalls, settings)]


def firm_counts(events: DataFrame, recalls: DataFrame, settings: Settings = DEFAULTS) -> list[DataFrame]:
    return [sum_counts(rows) for rows in firm_rows(events, recalls, settings)]


def panel_year_from(counts: Sequence[DataFrame], dim: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    by_product = merge_counts(counts, ["product_code", "year"], PANEL_COUNTS)
    return to_panels(by_product, dim).select(
        "*",
        kpis.events_per_100_clearances(F.col("event_count_dedup"), F.col("clearance_count"), settings.min_clearances)
        .alias("events_per_100_clearances"),
        kpis.recalls_per_100_clearances(F.col("recall_count"), F.col("clearance_count"), settings.min_clearances)
        .alias("recalls_per_100_clearances"),
        kpis.severe_recall_share(F.col("class_i_recall_count"), F.col("recall_count"), settings.min_recalls)
        .alias("severe_recall_share"),
    ).orderBy(F.asc_nulls_last("review_panel"), "year")


def product_year_from(counts: Sequence[DataFrame], settings: Settings = DEFAULTS) -> DataFrame:
    merged = merge_counts(counts, ["product_code", "year"], PRODUCT_COUNTS)
    return merged.select(
        "*",
        kpis.events_per_100_clearances(F.col("event_count_dedup"), F.col("clearance_count"), settings.min_clearances)
        .alias("events_per_100_clearances"),
        kpis.recalls_per_100_clearances(F.col("recall_count"), F.col("clearance_count"), settings.min_clearances)
        .alias("recalls_per_100_clearances"),
        kpis.recall_to_event_ratio(F.col("recall_count"), F.col("event_count_dedup")).alias("recall_to_event_ratio"),
        kpis.severe_recall_share(F.col("class_i_recall_count"), F.col("recall_count"), settings.min_recalls)
        .alias("severe_recall_share"),
    ).orderBy(F.asc_nulls_last("product_code"), "year")


def share_of_total(df: DataFrame, group: str, measure: str, name: str) -> DataFrame:
    """Share of the measure within (group, year); null for a null group and for a total of 0.

    Totals are aggregated and joined back: a window would hold a whole group in one task.
    """
    totals = df.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("_group"), F.col("year").alias("_year"))
    totals = totals.agg(F.sum(measure).alias("_total"))
    joined = df.join(totals, (F.col(group) == F.col("_group")) & (F.col("year") == F.col("_year")), "left")
    return joined.withColumn(name, kpis.firm_share(F.col(measure), F.col("_total"))).drop("_group", "_year", "_total")


def firm_product_year_from(counts: Sequence[DataFrame], dim: DataFrame) -> DataFrame:
    named = [c.where("manufacturer IS NOT NULL").withColumnRenamed("class_i_recall_count", "severe_recall_count") for c in counts]
    # Used three times: for the rows and for both totals.
    merged = stored(merge_counts(named, ["manufacturer", "product_code", "year"], FIRM_COUNTS))
    shared = share_of_total(merged, "product_code", "event_count_dedup", "firm_share_within_product")
    paneled = enrich(shared, dim, "product_code", ["review_panel"])
    shared = share_of_total(paneled, "review_panel", "event_count_dedup", "firm_share_within_panel").drop("review_panel")
    return shared.orderBy(F.asc_nulls_last("manufacturer"), F.asc_nulls_last("product_code"), "year")


def mart_panel_year(events: DataFrame, recalls: DataFrame, clearances: DataFrame, dim: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """review_panel x year: ten counts and three KPIs."""
    return panel_year_from(product_rows(events, recalls, clearances, settings), dim, settings)


def mart_product_year(events: DataFrame, recalls: DataFrame, clearances: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """product_code x year: four counts and four KPIs. Rows without a code form a group of their own."""
    return product_year_from(product_rows(events, recalls, clearances, settings), settings)


def mart_firm_product_year(
    events: DataFrame, recalls: DataFrame, dim: DataFrame, settings: Settings = DEFAULTS, alias: DataFrame | None = None
) -> DataFrame:
    """manufacturer x product_code x year: three counts and the firm's shares.

    Names are taken as reported; with an alias table they are replaced by their standard name.
    """
    counts = firm_rows(events, recalls, settings)
    if alias is not None:
        counts = [_standard_names(c, alias) for c in counts]
    return firm_product_year_from(counts, dim)


def _standard_names(counts: DataFrame, alias: DataFrame) -> DataFrame:
    counts = sum_counts(counts)
    renamed = counts.join(alias.select("raw_name", "standardized_name"), F.col("manufacturer") == F.col("raw_name"), "left")
    renamed = renamed.withColumn("manufacturer", F.coalesce("standardized_name", "manufacturer")).select(*counts.columns)
    return roll_up(renamed, ["manufacturer", "product_code"])


def build_all_marts(
    events: DataFrame, recalls: DataFrame, clearances: DataFrame, dim: DataFrame, settings: Settings = DEFAULTS
) -> dict[str, DataFrame]:
    """All three marts by name. The firm counts are the finest grain, so the others are sums of them."""
    by_firm = [stored(c) for c in firm_counts(events, recalls, settings)]
    years = settings.year_min, settings.year_max
    clearances = clearance_rows(in_years(clearances, "decision_year", *years), _CODE)
    return marts_from(by_firm, clearances, dim, settings)


def marts_from(by_firm: Sequence[DataFrame], clearances: DataFrame, dim: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    every = list(dict.fromkeys([*PANEL_COUNTS, *PRODUCT_COUNTS]))
    # Stored: the panel and the product mart are sums of these, and whoever reads the marts reads them again.
    by_product = stored(merge_counts([*[roll_up(c, _CODE) for c in by_firm], clearances], [*_CODE, "year"], every))
    return {
        "mart_panel_year": panel_year_from([by_product], dim, settings),
        "mart_product_code_year": product_year_from([by_product], settings),
        "mart_firm_product_year": firm_product_year_from(by_firm, dim),
    }


def write_all_marts(
    spark: SparkSession, events: DataFrame, recalls: DataFrame, clearances: DataFrame, dim: DataFrame, folder: str,
    settings: Settings = DEFAULTS,
) -> dict[str, DataFrame]:
    """Write the marts below ``folder``. Each fact table is scanned once, for a stored table of firm counts."""
    years = settings.year_min, settings.year_max
    parts = dict(zip(("events", "recalls"), firm_counts(events, recalls, settings)))
    parts["clearances"] = sum_counts(clearance_rows(in_years(clearances, "decision_year", *years), _CODE))
    for name, df in parts.items():
        write_table(df, f"{folder}/counts_{name}")
    kept = {name: spark.read.parquet(f"{folder}/counts_{name}") for name in parts}
    marts = marts_from([kept["events"], kept["recalls"]], kept["clearances"], dim, settings)
    for name, df in marts.items():
        write_table(df, f"{folder}/{name}.parquet")
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in marts}
