"""Layer tables: Parquet between the layers, CSV for the app."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from faultline.operators.counts import in_years


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def register_view(
    spark: SparkSession, name: str, path: str, year: str | None = None, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Temp view over a Parquet table, limited to a year window if both bounds are given."""
    df = read_table(spark, path)
    if year:
        df = in_years(df, year, first, last)
    df.createOrReplaceTempView(name)
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV. Without a schema the types are inferred, which reads the file twice."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, order: Sequence[Column] = (), *, capped: bool = False) -> None:
    """Ordered header CSV. Only a row-capped table may be written as a single file."""
    out = df.orderBy(*order) if order else df
    if capped:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_review(alias: DataFrame, path: str) -> None:
    """The alias rows flagged for manual review, as CSV."""
    write_csv(alias.filter(F.col("manual_review_flag")), path, [F.col("raw_name")])
