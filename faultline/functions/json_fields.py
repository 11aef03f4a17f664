"""Fields of raw JSON records (variants). Absent keys and JSON nulls give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(record: Column, path: str) -> Column:
    return F.try_variant_get(record, path, "string")


def text_list(record: Column, path: str) -> Column:
    """A field that holds a list of strings or one string, as a list."""
    return F.coalesce(
        F.try_variant_get(record, path, "array<string>"),
        F.when(text(record, path).isNotNull(), F.array(text(record, path))),
    )


def is_filled(record: Column, path: str) -> Column:
    """Field has a value other than null, false, zero, and an empty list, object or string."""
    value = F.try_variant_get(record, path, "variant")
    return F.coalesce(
        F.size(F.try_variant_get(record, path, "array<variant>")) > 0,
        F.when(F.schema_of_variant(value) == "BOOLEAN", F.try_variant_get(record, path, "boolean")),
        F.when(F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(record, path, "double") != 0),
        F.when(F.schema_of_variant(value) == "OBJECT<>", F.lit(False)),
        F.length(text(record, path)) > 0,
        F.lit(False),
    )


def first_code(openfda: Column) -> Column:
    """First of ``product_code`` if the block is an object and the field a non-empty list."""
    return F.try_element_at(F.try_variant_get(openfda, "$.product_code", "array<string>"), F.lit(1))
