"""Best-fit packing into sequences of several permitted lengths."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import saved, table, word_count

CAPACITIES = (512, 1024, 2048, 4096)
# Remainders are packed in shards of about this many, whatever the size of the input.
SHARD_ROWS = 50_000


@dataclass(frozen=True)
class Cost:
    """What a sequence of ``length`` costs: a fixed part, its words, and attention that grows with the square."""

    fixed: float = 32.0
    attention: float = 16_384.0

    def of(self, length: int) -> float:
        return self.fixed + length + length * length / self.attention


def best_fit(sizes: list[int], capacities: tuple[int, ...], cost: Cost) -> tuple[list[tuple[int, int]], list[int]]:
    """Place pieces, in the given order, into bins of variable capacity: ((bin, offset) of each piece, capacity of each bin).

    A piece goes to the open bin it leaves the least room in. If none takes it, the bin opened is the one of least cost
    per word it can still be filled with. All pieces are placed once for every bound on the capacity opened for pieces
    that need no larger one; each bin then shrinks to the smallest permitted length that holds its contents, and the
    cheapest placement is the result.
    """
    best = None
    for bound in capacities:
        placed, used = _place(sizes, capacities, bound, cost)
        shrunk = [next(c for c in capacities if c >= u) for u in used]
        total = sum(map(cost.of, shrunk))
        if best is None or total < best[0]:
            best = total, placed, shrunk
    return (best[1], best[2]) if best else ([], [])


def _place(sizes: list[int], capacities: tuple[int, ...], bound: int, cost: Cost) -> tuple[list[tuple[int, int]], list[int]]:
    placed, used, left = [], [], sum(sizes)
    open_bins: list[list[tuple[int, int]]] = [[] for _ in range(capacities[-1] + 1)]  # (bin, capacity) by room
    rooms = 0  # bit r is set if a bin with room r is open
    for size in sizes:
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number, capacity = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            allowed = [c for c in capacities if c >= size and (c <= bound or c == next(x for x in capacities if x >= size))]
            room = capacity = min(allowed, key=lambda c: (cost.of(c) / min(c, left), c))
            number = len(used)
            used.append(0)
        placed.append((number, used[number]))
        used[number] += size
        left -= size
        room -= size
        if room:
            open_bins[room].append((number, capacity))
            rooms |= 1 << room
    return placed, used


def pack(sized: DataFrame, capacities: tuple[int, ...] = CAPACITIES, cost: Cost | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Rows (doc_id, size) to pieces: doc_id, piece, piece_start, n_words, bin_id, bin_offset, bin_capacity.

    A document longer than the largest capacity is cut; its full pieces fill bins of their own. Remainders are dealt to
    shards of bounded size by a hash of their place in the table, so a repeated id needs no shard of its own, and each
    shard is packed by itself, large pieces first. Documents without words give one piece of no words in no bin. Each
    row is packed, repeated ones too; an empty table gives an empty result.
    """
    largest, cost = capacities[-1], cost or Cost()
    rows = saved(sized.select(F.col("doc_id").cast("long"), F.coalesce(F.col("size").cast("long"), F.lit(0)).alias("size")))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    shards = max(1, -(-rows.count() // shard_rows))
    full = rows.where(F.col("size") >= largest).select(
        "doc_id", "row", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"size div {largest} - 1"))).alias("piece")
    )
    full = full.select(
        "doc_id", F.col("piece").cast("int"), (F.col("piece") * largest).alias("piece_start"), F.lit(largest).cast("long").alias("n_words"),
        F.concat_ws("-", F.lit("full"), "row", "piece").alias("bin_id"), F.lit(0).cast("long").alias("bin_offset"), F.lit(largest).alias("bin_capacity"),
    )
    empty = rows.where("size = 0").selectExpr(
        "doc_id", "0 AS piece", "0L AS piece_start", "0L AS n_words", "CAST(NULL AS STRING) AS bin_id", "CAST(NULL AS LONG) AS bin_offset", "CAST(NULL AS INT) AS bin_capacity"
    )
    # pandas would turn ids beside a null into floats, so nulls travel as a flag
    rest = rows.where(F.col("size") % largest > 0).select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "row", "size", F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard")
    )

    def work(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.assign(n_words=pieces["size"] % largest).sort_values(["n_words", "doc_id", "row"], ascending=[False, True, True])
        placed, lengths = best_fit(pieces["n_words"].tolist(), capacities, cost)
        number = [p[0] for p in placed]
        return pd.DataFrame(
            {
                "doc_id": pieces["doc_id"].astype("Int64").mask(pieces["no_id"]),
                "piece": pieces["size"] // largest,
                "piece_start": pieces["size"] // largest * largest,
                "n_words": pieces["n_words"],
                "bin_id": [f"shard-{key[0]}-{n}" for n in number],
                "bin_offset": [p[1] for p in placed],
                "bin_capacity": [lengths[n] for n in number],
            }
        )

    schema = "doc_id long, piece int, piece_start long, n_words long, bin_id string, bin_offset long, bin_capacity int"
    return rest.groupBy("shard").applyInPandas(work, schema).unionByName(full).unionByName(empty)


def pack_documents(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, cost: Cost | None = None) -> DataFrame:
    """Pieces of all documents, in words of their whole texts. Other columns are ignored."""
    return pack(docs.select("doc_id", word_count(F.col("text")).alias("size")), capacities, cost)


def op10_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
