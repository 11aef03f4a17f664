"""The scores and rates as functions of a session, for queries written in SQL.

Common subsequences are an Arrow UDF; all else are SQL functions, which Spark inlines into the query before it is optimised.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from faultline.config import DEFAULTS, Settings
from faultline.functions import similarity

_TEXTS = "a STRING, b STRING"


def _sql_functions(settings: Settings) -> list[tuple[str, str, str, str]]:
    """(name, parameters, type, body)."""

    def guarded(numerator: str, denominator: str, allowed: str) -> str:
        return f"CASE WHEN {allowed} THEN try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE)) END"

    clearances, recalls = f"least_clearances INT DEFAULT {settings.min_clearances}", f"least_recalls INT DEFAULT {settings.min_recalls}"
    split = r"filter(split(t, r'(?U)[\s\x1c-\x1f]+'), w -> length(w) > 0)"
    return [
        ("name_tokens", "t STRING", "ARRAY<STRING>", split),
        ("sorted_form", "t STRING", "STRING", "array_join(array_sort(name_tokens(t)), ' ')"),
        ("indel_ratio", _TEXTS, "DOUBLE", "CASE WHEN length(a) + length(b) = 0 THEN 100D ELSE (1D - (length(a) + length(b) - 2 * common_subsequence(a, b)) / (length(a) + length(b))) * 100D END"),
        ("token_sort_ratio", _TEXTS, "DOUBLE", "indel_ratio(sorted_form(a), sorted_form(b))"),
        ("token_rest", _TEXTS, "STRING", "array_join(array_sort(array_except(array_distinct(name_tokens(a)), array_distinct(name_tokens(b)))), ' ')"),
        ("shared_length", _TEXTS, "INT", "length(array_join(array_intersect(name_tokens(a), name_tokens(b)), ' '))"),
        (
            "set_score", "s INT, m INT, n INT, c BIGINT", "DOUBLE",
            "CASE WHEN s > 0 AND (m = 0 OR n = 0) THEN 100D "
            "WHEN s > 0 THEN greatest(100D - 100D * (m + n - 2 * c) / (2 * (s + 1) + m + n), 100D - 100D * (1 + m) / (2 * s + 1 + m), 100D - 100D * (1 + n) / (2 * s + 1 + n)) "
            "ELSE 100D - 100D * (m + n - 2 * c) / greatest(m + n, 1) END",
        ),
        (
            "token_set_ratio", _TEXTS, "DOUBLE",
            "CASE WHEN a IS NULL OR b IS NULL THEN NULL WHEN size(name_tokens(a)) = 0 OR size(name_tokens(b)) = 0 THEN 0D ELSE set_score(shared_length(a, b), "
            "length(token_rest(a, b)), length(token_rest(b, a)), common_subsequence(token_rest(a, b), token_rest(b, a))) END",
        ),
        ("events_per_100_clearances", f"events BIGINT, clearances BIGINT, {clearances}", "DOUBLE", guarded("events", "clearances", "clearances >= least_clearances") + " * 100"),
        ("recalls_per_100_clearances", f"recalls BIGINT, clearances BIGINT, {clearances}", "DOUBLE", guarded("recalls", "clearances", "clearances >= least_clearances") + " * 100"),
        ("recall_to_event_ratio", "recalls BIGINT, events BIGINT", "DOUBLE", guarded("recalls", "events", "events > 0")),
        ("severe_recall_share", f"class_i BIGINT, recalls BIGINT, {recalls}", "DOUBLE", guarded("class_i", "recalls", "recalls >= least_recalls")),
        ("firm_share", "firm BIGINT, total BIGINT", "DOUBLE", guarded("firm", "total", "total > 0")),
    ]


def register_functions(spark: SparkSession, settings: Settings = DEFAULTS) -> list[str]:
    """Make the scores and rates callable from SQL in this session; returns their names. Thresholds default to ``settings``."""
    spark.udf.register("common_subsequence", similarity._common)
    names = ["common_subsequence"]
    for name, parameters, kind, body in _sql_functions(settings):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
        names.append(name)
    return names
