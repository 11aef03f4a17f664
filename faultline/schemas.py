"""Declared schemas of the layers, and the conform step that enforces them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


def _struct(columns: str) -> T.StructType:
    """A schema from "name type, ..."; unlike a DDL string it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# One raw record of a landed JSON or ZIP file; (file, member, pos) is its place in reading order.
RAW_RECORD = _struct("file string, member int, pos bigint, record string")

DIM_PRODUCT = _struct(
    "product_code string, device_name string, medical_specialty string, medical_specialty_description string, "
    "review_panel string, device_class string, implant_flag boolean, life_sustain_support_flag boolean, "
    "regulation_number string"
)
EVENT = _struct(
    "event_record_id string, mdr_report_key string, date_received date, event_year int, product_code string, "
    "brand_name string, generic_name string, manufacturer_d_name string, event_type string, "
    "adverse_event_flag boolean, product_problem_flag boolean, has_death boolean, has_serious_injury boolean, "
    "has_malfunction boolean, source_type string, remedial_action_flag boolean, followup_rank int, "
    "is_latest_version boolean"
)
RECALL = _struct(
    "recall_number string, recall_initiation_date date, recall_year int, recall_class string, product_code string, "
    "product_description string, recalling_firm string, reason_for_recall string, status string, "
    "voluntary_mandated string"
)
MAPPED_RECALL = T.StructType(
    RECALL.fields
    + _struct(
        "mapping_quality string, matched_product_code string, match_score double, include_in_core_dashboard boolean"
    ).fields
)
CLEARANCE = _struct(
    "k_number string, decision_date date, decision_year int, product_code string, applicant string, "
    "applicant_std string, advisory_committee string, clearance_type string, decision_code string"
)
ALIAS = _struct(
    "raw_name string, standardized_name string, normalization_rule string, confidence_level double, "
    "manual_review_flag boolean"
)
QA_RESULT = _struct("check_name string, status string, metric_value double, threshold double, details string")

PANEL_COUNTS = [
    "event_count_raw",
    "event_count_dedup",
    "death_related_reports",
    "serious_injury_reports",
    "malfunction_reports",
    "recall_count",
    "class_i_recall_count",
    "class_ii_recall_count",
    "class_iii_recall_count",
    "clearance_count",
]
PRODUCT_COUNTS = ["event_count_dedup", "recall_count", "class_i_recall_count", "clearance_count"]
FIRM_COUNTS = ["event_count_dedup", "recall_count", "severe_recall_count"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order; absent ones become typed nulls."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Zero rows with the full schema, so later operators work unchanged on missing input."""
    return spark.createDataFrame([], schema)
