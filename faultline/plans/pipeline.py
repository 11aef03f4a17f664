"""The stages end to end. Only here are paths known; stages meet in stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline.config import DEFAULTS, Settings
from faultline.plans import clean, exports, mapping, marts, quality_suites
from faultline.sources import records as R
from faultline.sources.tables import write_review, write_table
from faultline.streaming.landing import land_archives, read_bronze


def run_clean(spark: SparkSession, raw: str, out: str, settings: Settings = DEFAULTS) -> None:
    """Raw folders to clean tables. Archives are landed first, and only those that are new."""
    land_archives(spark, f"{raw}/adverse_events", f"{out}/bronze_events", f"{out}/bronze_events_checkpoint")
    lookup = clean.recall_code_lookup(R.scan_documents(spark, f"{raw}/recall_product_codes", "recall_product_codes_*.json"))
    tables = {
        "dim_product_code": clean.build_dim_product(
            R.scan_single_document(spark, f"{raw}/classification/classification_all.json")
        ),
        "clean_event_device_level": clean.clean_adverse_events(read_bronze(spark, f"{out}/bronze_events")),
        "clean_recall": clean.clean_recalls(R.scan_documents(spark, f"{raw}/recalls", "recalls_*.json"), lookup, settings),
        "clean_510k": clean.clean_clearances(R.scan_documents(spark, f"{raw}/clearances", "clearances_*.json"), settings),
    }
    for name, df in tables.items():
        write_table(df, f"{out}/{name}.parquet")


def run_mapping(spark: SparkSession, out: str, settings: Settings = DEFAULTS) -> None:
    """Company aliases and mapped recalls. The mapped recalls are a table of their own."""
    events = spark.read.parquet(f"{out}/clean_event_device_level.parquet")
    alias = mapping.manufacturer_alias(events, threshold=settings.alias_score, review_top_n=settings.review_top_n)
    write_table(alias, f"{out}/dim_manufacturer_alias.parquet")
    write_review(spark.read.parquet(f"{out}/dim_manufacturer_alias.parquet"), f"{out}/manufacturer_manual_review.csv")
    recalls = spark.read.parquet(f"{out}/clean_recall.parquet")
    dim = spark.read.parquet(f"{out}/dim_product_code.parquet")
    mapped = mapping.map_recalls(recalls, dim, high=settings.high_score, low=settings.low_score)
    write_table(mapped, f"{out}/recall_mapped.parquet")


def clean_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    files = {
        "events": "clean_event_device_level", "recalls": "recall_mapped", "clearances": "clean_510k", "dim": "dim_product_code",
    }
    return {name: spark.read.parquet(f"{out}/{file}.parquet") for name, file in files.items()}


def run_pipeline(spark: SparkSession, raw: str, out: str, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Clean, map, aggregate, export and check. Returns the app tables and the check results."""
    run_clean(spark, raw, f"{out}/clean", settings)
    run_mapping(spark, f"{out}/clean", settings)
    tables = clean_tables(spark, f"{out}/clean")
    built = marts.write_all_marts(
        spark, tables["events"], tables["recalls"], tables["clearances"], tables["dim"], f"{out}/mart", settings
    )
    apps = exports.export_all(built, tables, settings)
    exports.write_exports(apps, f"{out}/app")
    clean_layer = {**tables, "dim_product_code": tables["dim"]}
    summary = quality_suites.qa_summary(spark, clean_layer, built, apps, settings)
    write_table(summary, f"{out}/mart/qa_summary.parquet")
    return {**apps, "qa_summary": spark.read.parquet(f"{out}/mart/qa_summary.parquet")}
