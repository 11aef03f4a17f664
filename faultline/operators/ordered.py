"""Order-dependent numbers within a group (position, running total) for groups of any size.

A plain window puts a whole group into one task. When one key holds a large part of all rows, that task
never ends, and adaptive execution does not split windows. ``ordered_within`` therefore cuts the groups of
hot keys into slots along the leading part of their order, numbers each slot on its own and adds what the
earlier slots of the group hold. Groups of other keys stay whole, so the common case is one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.session import stored

# Keys are hashed into this many buckets to find the hot ones: a narrow scan and a shuffle of at most this
# many counters per map task.
_BUCKETS = 1 << 14
HOT_ROWS = 4_000_000


def hot_buckets(keys: DataFrame, key: Sequence[str], hot_rows: int) -> DataFrame:
    """Hash buckets that hold more than ``hot_rows`` rows and over four times the mean bucket.

    At most a quarter of the buckets can exceed four times the mean, so the result never has more than
    4,096 rows, whatever the data: that is the bound that allows broadcasting it. The counters are packed
    into one row, one entry per bucket, to compare each with the mean.
    """
    loads = keys.groupBy(F.pmod(F.xxhash64(*key), F.lit(_BUCKETS)).alias("_bucket")).agg(F.count("*").alias("_load"))
    packed = loads.agg(F.sum("_load").alias("_total"), F.collect_list(F.struct("_bucket", "_load")).alias("_loads"))
    hot = packed.select("_total", F.inline("_loads")).filter(
        (F.col("_load") > hot_rows) & (F.col("_load") * _BUCKETS > 4 * F.col("_total"))
    )
    return hot.select("_bucket", F.lit(True).alias("_hot"))


def ordered_within(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    slots: Sequence[Column],
    *,
    position: str | None = None,
    running: Mapping[str, str] | None = None,
    any_of: Sequence[str] = (),
    counted: Column | None = None,
    hot_rows: int = HOT_ROWS,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add order-dependent columns per group of ``key``.

    order     sort expressions of the group; they must begin with the columns ``slots`` is made of
    slots     null-free expressions whose ascending order is the leading part of ``order``
    position  name of the 1-based position column
    running   output name -> numeric column to add up from the start of the group, current row included
    any_of    boolean columns to replace by "true anywhere in the group"
    counted   only rows where this holds take a position; they must sort before the others
    keys      a cheaper source of the key columns, to find the hot keys in; any set of hot keys is right
    """
    running = dict(running or {})
    key = list(key)
    # Never null, and told so: else the join infers a filter that is pushed down to the records and parses them again.
    bucket = F.coalesce(F.pmod(F.xxhash64(*key), F.lit(_BUCKETS)), F.lit(0))
    # Size-bounded by construction, see hot_buckets.
    hot = F.broadcast(hot_buckets(df if keys is None else keys, key, hot_rows))
    marked = df.withColumn("_bucket", bucket).join(hot, "_bucket", "left")
    marked = marked.withColumn("_slot", F.when(F.col("_hot"), F.struct(*slots)))

    in_slot = Window.partitionBy(*key, "_slot")
    so_far = in_slot.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {name: F.sum(source).over(so_far) for name, source in running.items()}
    if position:
        added[position] = F.row_number().over(in_slot.orderBy(*order))
    added.update({name: F.bool_or(name).over(in_slot) for name in any_of})
    numbered = marked.withColumns(added)

    # What the earlier slots of a hot group hold: one row per hot group and slot.
    own = [F.count("*" if counted is None else F.when(counted, 1)).alias("_n")]
    own += [F.sum(source).alias(f"_sum_{name}") for name, source in running.items()]
    own += [F.bool_or(name).alias(f"_any_{name}") for name in any_of]
    per_slot = marked.filter("_hot").groupBy(*key, "_slot").agg(*own)
    group = Window.partitionBy(*key)
    earlier = group.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.sum("_n").over(earlier).alias("_n_before")]
    before += [F.sum(f"_sum_{name}").over(earlier).alias(f"_before_{name}") for name in running]
    before += [F.bool_or(f"_any_{name}").over(group).alias(f"_any_{name}") for name in any_of]
    offsets = per_slot.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col("_slot").alias("_at"), *before)

    # Rows of other keys have a null slot: they match nothing here and still spread out by key.
    same = F.col("_slot") == F.col("_at")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = numbered.join(offsets, same, "left")

    out = {name: F.col(name) + F.coalesce(F.col(f"_before_{name}"), F.lit(0)) for name in running}
    if position:
        out[position] = (F.col(position) + F.coalesce(F.col("_n_before"), F.lit(0))).cast("int")
    out.update({name: F.coalesce(F.col(f"_any_{name}"), F.col(name)) for name in any_of})
    return joined.withColumns(out).select(*df.columns, *[c for c in out if c not in df.columns])


def running_by_range(df: DataFrame, group: str, order: Sequence[Column], position: str, running: Mapping[str, str]) -> DataFrame:
    """Add the 1-based place and running totals (output name -> column) of every row in its group, for groups of any size.

    ``order`` has to be total within a group. One range partitioning by group and order cuts groups into runs that
    fit a task each; runs are numbered and summed by themselves, and what earlier runs of the group hold is added.
    """
    ranged = df.repartitionByRange(F.col(group), *order).withColumn("_range", F.spark_partition_id())
    # stored: the numbers of the ranges are used twice and must be the same both times
    ranged = stored(ranged)
    in_range = Window.partitionBy(group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = ranged.withColumn(position, F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order)))
    numbered = numbered.withColumns({name: F.sum(source).over(in_range) for name, source in running.items()})
    sums = [F.count("*").alias("_n"), *[F.sum(source).alias(f"_sum_{name}") for name, source in running.items()]]
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.sum("_n").over(earlier).alias("_n_before"), *[F.sum(f"_sum_{name}").over(earlier).alias(f"_before_{name}") for name in running]]
    offsets = ranged.groupBy(group, "_range").agg(*sums).select(F.col(group).alias("_group"), F.col("_range").alias("_at"), *before)
    joined = numbered.join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_at")))
    out = {position: (F.col(position) + F.coalesce("_n_before", F.lit(0))).cast("int")}
    out |= {name: F.col(name) + F.coalesce(f"_before_{name}", F.lit(0)) for name in running}
    return joined.withColumns(out).select(*df.columns, *out)


def date_descending(day: Column) -> list[Column]:
    """Slot expressions for "latest first, nulls last"."""
    return [day.isNull(), F.coalesce(-F.unix_date(day.cast("date")), F.lit(0))]
