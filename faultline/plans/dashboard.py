"""Dashboard queries over the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.kpis import firm_share
from faultline.operators.joins import enrich
from faultline.operators.ordered import running_by_range
from faultline.session import stored

CARDS = ["event_count_dedup", "recall_count", "class_i_recall_count", "death_related_reports", "serious_injury_reports"]


def kpi_cards(panel_year: DataFrame) -> DataFrame:
    return panel_year.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in CARDS])


def yearly_trend(panel_year: DataFrame, measures: Sequence[str] = (*CARDS, "clearance_count")) -> DataFrame:
    return panel_year.groupBy("year").agg(*[F.sum(c).alias(c) for c in measures]).orderBy("year")


def panel_ranking(panel_year: DataFrame, kpi: str = "events_per_100_clearances") -> DataFrame:
    """Dense rank of the panels per year. Rows below the KPI's threshold have no KPI and no rank.

    A window group is one year of the mart, that is one row per review panel.
    """
    by_year = Window.partitionBy("year").orderBy(F.desc(kpi))
    ranked = panel_year.where(F.col(kpi).isNotNull())
    return ranked.select("review_panel", "year", kpi, F.dense_rank().over(by_year).alias("rank"))


def latest_year(df: DataFrame, year: str = "year") -> DataFrame:
    return df.where(F.col(year) == df.agg(F.max(year)).scalar())


def product_scatter(product_year: DataFrame) -> DataFrame:
    """Clearances against events per product in the latest year."""
    return latest_year(product_year).select("product_code", "year", "clearance_count", "event_count_dedup")


def pareto_products(product_year: DataFrame, dim: DataFrame) -> DataFrame:
    """Products of each panel by descending volume with their cumulative share."""
    totals = product_year.groupBy("product_code").agg(F.sum("event_count_dedup").alias("events"))
    paneled = enrich(totals, dim, "product_code", ["review_panel"]).where("review_panel IS NOT NULL")
    order = [F.desc("events"), F.asc("product_code")]
    running = stored(running_by_range(paneled, "review_panel", order, "position", {"running_events": "events"}))
    panel = running.groupBy("review_panel").agg(F.max("running_events").alias("panel_events"))
    return running.join(panel, "review_panel").select(
        "review_panel", "product_code", "events", "position", "running_events",
        firm_share(F.col("running_events"), F.col("panel_events")).alias("cumulative_share"),
    )


def firm_concentration(firm_year: DataFrame, dim: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest firms of each panel, their share and the cumulative share.

    Spark keeps n firms per panel and task before the shuffle; the second window holds n rows per panel.
    """
    paneled = enrich(firm_year, dim, "product_code", ["review_panel"]).where("review_panel IS NOT NULL")
    firms = stored(paneled.groupBy("review_panel", "manufacturer").agg(F.sum("event_count_dedup").alias("events")))
    panels = firms.groupBy("review_panel").agg(F.sum("events").alias("panel_events"))
    order = Window.partitionBy("review_panel").orderBy(F.desc("events"), F.asc("manufacturer"))
    top = firms.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)
    running = F.sum("events").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return top.withColumn("running_events", running).join(panels, "review_panel").select(
        "review_panel", "manufacturer", "position", "events",
        firm_share(F.col("events"), F.col("panel_events")).alias("firm_share"),
        firm_share(F.col("running_events"), F.col("panel_events")).alias("cumulative_share"),
    )


def firm_profile(firm_year: DataFrame, manufacturer: str) -> DataFrame:
    """One firm by product and year."""
    one = firm_year.where(F.col("manufacturer") == manufacturer)
    measures = ["event_count_dedup", "recall_count", "severe_recall_count"]
    return one.groupBy("product_code", "year").agg(*[F.sum(c).alias(c) for c in measures])


def flag_partial_year(df: DataFrame, last_year: int) -> DataFrame:
    """Mark the last year of the window, which may be incomplete."""
    return df.withColumn("is_partial_year", F.col("year") == last_year)


def panel_spot_check(
    panel_year: DataFrame,
    panels: Sequence[str],
    columns: Sequence[str] = (
        "year", "event_count_dedup", "recall_count", "clearance_count", "events_per_100_clearances", "severe_recall_share",
    ),
) -> DataFrame:
    present = [c for c in columns if c in panel_year.columns]
    return panel_year.where(F.col("review_panel").isin(*panels)).select("review_panel", *present)
