"""Version ranks and keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.operators.ordered import HOT_ROWS, date_descending, ordered_within


def rank_versions(
    df: DataFrame,
    key: str = "mdr_report_key",
    date: str = "date_received",
    tie_break: Sequence[str] = (),
    *,
    grain: str = "device",
    any_of: Sequence[str] = (),
    present: Column | None = None,
    hot_rows: int = HOT_ROWS,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add ``followup_rank`` (1 = newest) and ``is_latest_version``; all rows are kept.

    grain="device" numbers the rows of a report, so exactly one row per report is the latest one.
    grain="report" numbers its dates, so every device row of the newest date is.
    ``present`` marks rows that take a rank; the others sort last (they only feed ``any_of``).
    """
    if grain == "report":
        return _rank_dates(df, key, date, hot_rows)
    order: list[Column] = [F.col(date).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tie_break]]
    slots = date_descending(F.col(date))
    if tie_break:
        slots.append(F.struct(F.col(tie_break[0]).isNotNull(), F.coalesce(F.col(tie_break[0]), _least(df, tie_break[0]))))
    if present is not None:
        order.insert(0, (~present).asc())
        slots.insert(0, ~present)
    ranked = ordered_within(
        df, [key], order, slots, position="followup_rank", any_of=any_of, counted=present, hot_rows=hot_rows, keys=keys
    )
    return ranked.withColumn("is_latest_version", F.col("followup_rank") == 1)


def _least(df: DataFrame, column: str) -> Column:
    """A stand-in for null of the column's own type; the null flag before it decides the order."""
    kind = df.schema[column].dataType.simpleString()
    return F.lit("" if kind == "string" else 0).cast(kind)


def _rank_dates(df: DataFrame, key: str, date: str, hot_rows: int) -> DataFrame:
    # A key has at most as many dates as the calendar, whatever its row count.
    dates = df.select(key, date).distinct()
    ranked = ordered_within(
        dates, [key], [F.col(date).desc_nulls_last()], date_descending(F.col(date)),
        position="followup_rank", hot_rows=hot_rows,
    ).select(F.col(key).alias("_key"), F.col(date).alias("_date"), "followup_rank")
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(date).eqNullSafe(F.col("_date"))
    joined = df.join(ranked, same, "left").select(*df.columns, "followup_rank")
    return joined.withColumn("is_latest_version", F.col("followup_rank") == 1)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``. Null keys form one group.

    A minimum instead of a window: map tasks reduce every key to one row before the shuffle, so a key with
    many copies needs no task of its own. The kept row has no fixed width, so Spark sorts by key for this, with spill.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*key).agg(first).select(*[F.col(c) if c in key else F.col(f"_first.{c}") for c in df.columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def dedup_report(df: DataFrame) -> DataFrame:
    """Total rows, latest rows, superseded rows and their share."""
    latest = F.count_if("is_latest_version")
    total = F.count("*")
    return df.agg(
        total.alias("total_rows"),
        latest.alias("latest_rows"),
        (total - latest).alias("superseded_rows"),
        F.try_divide((total - latest).cast("double"), total.cast("double")).alias("superseded_share"),
    )
