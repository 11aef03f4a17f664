"""What several operators share: word patterns, reliable intermediate tables, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.session import use_checkpoints

# Words are runs of anything but ASCII white space; bytes.split() cuts UTF-8 text in the same places.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_count(text: Column) -> Column:
    """Number of words as a long; null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there, with its lineage cut."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in (name + "_" * k for k in range(len(taken) + 1)) if n.lower() not in taken) for name in names]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id reachable from each node that has an edge.

    ``edges`` has two long columns ``a`` and ``b``. Large-star and small-star steps alternate until the edge set stays
    the same: each hangs neighbours on the smallest node near them, so a group ends as a star around its smallest id
    after few rounds, whatever its shape. A step is an aggregate with partial sums and a join whose large side may be
    split, so a node with very many neighbours needs no task of its own. Null ids and loops are ignored.
    """
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _digest(now)
    while True:
        now = saved(_small_star(_large_star(now)))
        after = _digest(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest of the node and its neighbours. ``a > b`` in the result."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    moved = both.where("b > a").join(least, F.col("a") == F.col("u"))
    return moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest of them. Expects ``a > b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    moved = edges.join(least, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def stage_folder(spark, name: str) -> str:
    """A new folder under the shared checkpoint folder for a stage's table."""
    use_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/stages/{uuid.uuid4().hex}-{name}"


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with longs ``group_no`` and ``position``: the place of its group among all groups, and its own in the group.

    Groups go by the value of the column ``group``, null first, rows by the columns ``order``, nulls first, then by their
    place in the table; both numbers have no gaps and start at 0. One range partitioning by all of these spreads a group
    of any size over several tasks. Each task numbers its own rows; what lies before them follows from one record per
    task, which is all that the driver sees.
    """
    keys = [group, *order, "_place"]
    dealt = rows.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = saved(dealt.drop("_place"))
    names = dealt.columns
    at = names.index(group)

    def starts_of(column: pa.Array) -> np.ndarray:
        codes = column.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        return np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        groups = count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(at)
            starts = starts_of(column)
            value, ending = column[0], column[batch.num_rows - 1]
            goes_on = last is not None and value.as_py() == last.as_py()
            groups += len(starts) - goes_on
            first, last = first if first is not None else value, ending
            tail = batch.num_rows - int(starts[-1])
            count = tail + count if goes_on and len(starts) == 1 else tail
        if first is not None:
            kind = first.type
            numbers = [pa.array([x], pa.int64()) for x in (TaskContext.get().partitionId(), groups, count)]
            ends = [pa.array([x.as_py()], kind) for x in (first, last)]
            yield pa.RecordBatch.from_arrays([*numbers, *ends], names=["task", "groups", "tail", "first", "last"])

    kind = dealt.schema[group].dataType.simpleString()
    records = sorted(dealt.mapInArrow(summary, f"task long, groups long, tail long, first {kind}, last {kind}").collect())
    before: dict[int, tuple[int, int]] = {}
    number, carried, last = -1, 0, None
    for k, r in enumerate(records):
        goes_on = k > 0 and r["first"] == last
        start = number if goes_on else number + 1
        before[r["task"]] = (start, carried if goes_on else 0)
        carried = r["tail"] + (carried if goes_on and r["groups"] == 1 else 0)
        number, last = start + r["groups"] - 1, r["last"]

    def count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous = None
        number = position = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = batch.column(at)
            starts = starts_of(column)
            if previous is None:
                number, position = before[TaskContext.get().partitionId()]
            elif column[0].as_py() != previous.as_py():
                number, position = number + 1, 0
            run = np.zeros(n, np.int64)
            run[starts[1:]] = 1
            run = np.cumsum(run)
            places = np.arange(n) - starts[run] + np.where(run == 0, position, 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number + run), pa.array(places)], names=[*names, "group_no", "position"])
            previous, number, position = column[n - 1], number + len(starts) - 1, int(places[-1]) + 1

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    return dealt.mapInArrow(count_up, f"{fields}, group_no long, position long")
