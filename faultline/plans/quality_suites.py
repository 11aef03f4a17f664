"""Check suites of the layers, and the go/no-go decisions between stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.config import DEFAULTS, Settings
from faultline.fixed_values import LAYER_TABLES, STAGE_TABLES, TIER_EXACT, TIER_HIGH
from faultline.operators import quality as Q
from faultline.operators.joins import flag_members
from faultline.sources.tables import read_csv, read_if_present, write_table
from pyspark.sql.utils import AnalysisException

Tables = Mapping[str, DataFrame | None]

MART_KEYS = {name: key for layer, name, _, key, _, _ in LAYER_TABLES if layer == "mart"}


def qa_summary(spark: SparkSession, clean: Tables, marts: Tables, apps: Tables, settings: Settings = DEFAULTS) -> DataFrame:
    """All checks of all layers as one table, each table scanned once; one that is not there is a failed check, not an error."""
    layers = {"clean": clean, "mart": marts, "app": apps}

    def checked(layer: str, name: str, file: str, key: list[str], few_nulls: list[str], cap: str | None) -> DataFrame:
        df = layers[layer].get(name)
        if df is None:
            return Q.failed(spark, f"file_exists_{name}", f"{file} not found")
        return Q.table_checks(df, name, 1, few_nulls, key=key, max_rows=cap and getattr(settings, cap))

    return Q.run_checks([checked(*spec) for spec in LAYER_TABLES])


def build_qa_summary(
    spark: SparkSession, clean_dir: str, mart_dir: str, app_dir: str, output: str, settings: Settings = DEFAULTS
) -> DataFrame:
    """``qa_summary`` over the stored layers, written to ``output``."""

    def csv(path: str) -> DataFrame | None:
        try:
            return read_csv(spark, path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def parquet(path: str) -> DataFrame | None:
        return read_if_present(spark, path)

    readers = {"clean": (clean_dir, parquet), "mart": (mart_dir, parquet), "app": (app_dir, csv)}
    layers: dict[str, dict[str, DataFrame | None]] = {layer: {} for layer in readers}
    for layer, name, file, *_ in LAYER_TABLES:
        folder, read = readers[layer]
        layers[layer][name] = read(f"{folder}/{file}")
    summary = qa_summary(spark, *layers.values(), settings)
    write_table(summary, output)
    return spark.read.parquet(output)


def _stage_table(df: DataFrame, name: str, key: Sequence[str] = (), key_name: str | None = None) -> DataFrame:
    least, nulls = STAGE_TABLES[name]
    return Q.table_checks(df, name, least, nulls, key=key, key_name=key_name)


def event_stage_checks(events: DataFrame, dim: DataFrame, alias: DataFrame) -> DataFrame:
    """Checks after cleaning the events, on their latest versions."""
    latest = events.where("is_latest_version")
    return Q.run_checks(
        [
            _stage_table(dim, "dim_product_code", ["product_code"], "dim_product_code_pk"),
            _stage_table(latest, "clean_events_latest"),
            Q.check_uniqueness(events, ["event_record_id"], "event_record_id_pk"),
            Q.check_volume_shift(latest, "event_year"),
            _stage_table(alias, "manufacturer_alias"),
            Q.check_coverage(latest, "product_code", dim),
        ]
    )


def recall_stage_checks(recalls: DataFrame, clearances: DataFrame, dim: DataFrame) -> DataFrame:
    """Checks after mapping the recalls and cleaning the clearances."""
    return Q.run_checks(
        [
            _stage_table(recalls, "clean_recall", ["recall_number"], "recall_number_pk"),
            Q.check_volume_shift(recalls, "recall_year"),
            _stage_table(clearances, "clean_510k", ["k_number"], "k_number_pk"),
            Q.check_volume_shift(clearances, "decision_year"),
            Q.check_coverage(clearances, "product_code", dim),
        ]
    )


def _rate_gate(df: DataFrame, gate: str, hit, target: float) -> DataFrame:
    rate = F.coalesce(F.avg(hit.cast("double")), F.lit(0.0))
    return df.agg(rate.alias("rate")).select(
        F.lit(gate).alias("gate"), "rate", F.lit(target).alias("target"), (F.col("rate") >= target).alias("passed")
    )


def mapping_rates(recalls: DataFrame, clearances: DataFrame, dim: DataFrame) -> DataFrame:
    """Share of recalls in the two best tiers (60 % wanted) and of clearances with a known code (90 %)."""
    best = F.coalesce(F.col("mapping_quality").isin(TIER_EXACT, TIER_HIGH), F.lit(False))
    known = flag_members(clearances, "product_code", dim, "product_code", "_known")
    return _rate_gate(recalls, "recall_mapping", best, 0.60).unionByName(
        _rate_gate(known, "clearance_codes", F.col("_known"), 0.90)
    )


def stage_decision(rates: DataFrame, checks: DataFrame) -> DataFrame:
    """One row: go if both rates reach their target and no check failed."""
    votes = rates.select("passed").unionByName(checks.select((F.col("status") != "fail").alias("passed")))
    return votes.agg((F.count_if(~F.col("passed")) == 0).alias("go"), F.count_if(~F.col("passed")).alias("objections"))
