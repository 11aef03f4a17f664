"""Sharding: balanced label propagation keeps linked documents in one shard and all shards equally large."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import numbered, saved, table

SHARDS = 40
ROUNDS = 10
# While labels spread, a shard may exceed its quota by this share, or by what random labels vary by if that is more.
SLACK = 0.05
# Movers between two shards are admitted in this many classes, drawn by hash.
CLASSES = 16


def quotas(rows: int, shards: int) -> list[int]:
    """Rows of each shard: equal, or at most one apart."""
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def seeded(large: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int]]:
    """(group, shard, rows) of groups (group, rows) too large for propagation; ``room`` is used up.

    The largest come first. A group fills the emptiest shards whole, and what is left of it the fullest one that has room.
    """
    dealt = []
    for group, left in sorted(large, key=lambda g: (-g[1], g[0])):
        while left:
            fitting = [k for k in range(len(room)) if room[k] >= left]
            shard = min(fitting, key=lambda k: (room[k], k)) if fitting else max(range(len(room)), key=lambda k: (room[k], -k))
            taken = min(left, room[shard])
            dealt.append((group, shard, taken))
            room[shard] -= taken
            left -= taken
    return dealt


def admitted(demand: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How much of the flows ``demand[i, j]`` from shard i to j may move at once, so that no shard gains more than its ``room``.

    Flows into a shard that would be overfull shrink in proportion, which takes outflow from others, until all fit.
    """
    flow = demand.astype(float)
    for _ in range(200):
        into, out = flow.sum(axis=0), flow.sum(axis=1)
        most = np.maximum(room + out, 0.0)
        if (into <= most + 1e-9).all():
            break
        flow *= np.where(into > most, most / np.maximum(into, 1e-12), 1.0)
    else:
        into = flow.sum(axis=0)
        flow *= np.minimum(1.0, np.maximum(room, 0.0) / np.maximum(into, 1e-12))
    return np.floor(flow + 1e-6)


def _pick(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]).cast("array<long>"), (at + 1).cast("int"))


def _slot_of(limits: list[int], value: Column) -> Column:
    """How many of the rising ``limits`` are not above ``value``."""
    return F.size(F.filter(F.array(*[F.lit(int(v)) for v in limits]).cast("array<long>"), lambda u: u <= value))


def _loads(cells: DataFrame, shards: int) -> np.ndarray:
    found = cells.select(F.inline("cells")).groupBy("shard").agg(F.sum("n").alias("n")).collect()
    load = np.zeros(shards, np.int64)
    for r in found:
        load[r.shard] = r.n
    return load


def propagate(cells: DataFrame, room: list[int], rounds: int = ROUNDS) -> list[DataFrame]:
    """Tables (g, n, cells) after label propagation from the given labels; ``cells`` is an array of (shard, n), at most one a shard.

    Documents of a group are each other's neighbours and alike, so a group's labels are kept as counts. In a round every
    document takes the label most frequent among its neighbours, if that shard can still hold the whole group, else a shard that can. The
    flows this asks for, one number per pair of shards, are cut down to what all quotas admit, and movers are admitted by
    classes; of the class at the limit each cell moves its share. Rounds end when each group has one label, nothing moves
    or ``rounds`` are over. The driver sees flows and loads only: at most shards * shards * ``CLASSES`` numbers.
    """
    shards = len(room)
    settled = [saved(cells.where("size(cells) = 1"))]
    state = saved(cells.where("size(cells) > 1"))
    load = _loads(settled[0], shards)
    for turn in range(rounds):
        free = np.array(room) - load - _loads(state, shards)
        rest = [int(x) for x in free]
        ranked = F.transform(
            "cells",
            lambda c: F.struct(
                (_pick(rest, c["shard"]) >= F.col("n") - c["n"]).alias("fits"), c["n"].alias("n"), F.xxhash64("g", c["shard"]).alias("tie"), c["shard"].alias("shard")
            ),
        )
        top = F.array_max(ranked)
        open_ones = F.filter(F.array(*[F.struct(F.lit(k).alias("shard"), F.lit(x).cast("long").alias("free")) for k, x in enumerate(rest)]), lambda s: s["free"] >= F.col("n"))
        drawn = F.element_at(open_ones, F.pmod(F.xxhash64("g", F.lit(turn)), F.greatest(F.size(open_ones), F.lit(1))).cast("int") + 1)["shard"]
        target = F.when(top["fits"] | (F.size(open_ones) == 0), top["shard"]).otherwise(drawn)
        asked = state.select("g", "n", F.col("cells"), target.alias("target"), F.pmod(F.xxhash64("g", F.lit(-turn - 1)), F.lit(CLASSES)).cast("int").alias("class"))
        asked = asked.select("g", F.inline("cells").alias("shard", "m"), "target", "class")
        demand = asked.where("shard <> target").groupBy("shard", "target", "class").agg(F.sum("m").alias("m")).collect()
        flow = np.zeros((shards, shards))
        for r in demand:
            flow[r["shard"], r["target"]] += r["m"]
        allowed, shares = admitted(flow, free), []
        for r in sorted(demand):
            left = allowed[r["shard"], r["target"]]
            share = min(1.0, left / r["m"])
            allowed[r["shard"], r["target"]] = left - min(left, r["m"])
            if share > 0:
                shares.append((r["shard"], r["target"], r["class"], float(share)))
        if not shares:
            break
        share = F.broadcast(cells.sparkSession.createDataFrame(shares, "_shard int, _target int, _class int, share double"))
        met = asked.join(share, (F.col("shard") == F.col("_shard")) & (F.col("target") == F.col("_target")) & (F.col("class") == F.col("_class")), "left")
        gone = F.floor(F.col("m") * F.coalesce("share", F.lit(0.0)) + 1e-9)
        both = F.array(F.struct("shard", (F.col("m") - gone).alias("m")), F.struct(F.col("target").alias("shard"), gone.alias("m")))
        moved = met.select("g", F.inline(both)).where("m > 0").groupBy("g", "shard").agg(F.sum("m").alias("m"))
        now = saved(_as_cells(moved.withColumnRenamed("m", "n")))
        settled.append(now.where("size(cells) = 1"))
        load = load + _loads(settled[-1], shards)
        state = now.where("size(cells) > 1")
        if state.isEmpty():
            break
    return [*settled, state]


def _as_cells(counts: DataFrame) -> DataFrame:
    return counts.groupBy("g").agg(F.sum("n").alias("n"), F.collect_list(F.struct(F.col("shard").cast("int").alias("shard"), "n")).alias("cells"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, group_size.

    The law is ``rows``: shards hold equally many rows, or one more. Documents are linked if their texts are equal, and
    linked ones are kept together: groups above half a shard are spread over as few shards as they need, all others start with
    labels drawn by document and settle by ``propagate``. Documents without a link fill the shards up at the end, after
    what a shard holds beyond its quota; both is taken in order of groups, so this cuts at most two groups a shard.
    ``slot`` numbers the rows of a shard from 0 without gaps.

    Null text is empty: size 16, checksum 0, and linked with other empty texts. Rows that repeat an id are placed one by
    one, null ids too. An empty table gives an empty result; other columns are ignored. Runs over the same table in the same
    partitions agree.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("h"),
    )
    rows = saved(numbered(rows, "h", ["doc_id"]).select("doc_id", "size", "text_crc32", F.col("group_no").alias("g"), F.col("position").alias("r")))
    total = rows.count()
    quota = quotas(total, shards)
    sizes = saved(rows.groupBy("g").agg(F.count("*").alias("group_size")))
    # at most two groups a shard can be this large
    large = [(r.g, r.group_size) for r in sizes.where(F.col("group_size") > F.lit(max(1, quota[0] // 2))).collect()]
    room = list(quota)
    hot = seeded(large, room)
    limits = [int(x) for x in np.cumsum(room)]
    start = F.least(_slot_of(limits, F.pmod(F.xxhash64("g", "r"), F.lit(max(1, limits[-1])))), F.lit(shards - 1))
    others = rows.where(~F.col("g").isin([g for g, _ in large])) if large else rows
    cells = _as_cells(others.groupBy("g", start.alias("shard")).agg(F.count("*").alias("n"))).where("n > 1")
    spark = docs.sparkSession
    hot_cells = _as_cells(spark.createDataFrame(hot, "g long, shard int, n long"))
    slack = int(max(quota[0] * SLACK, 2 * quota[0] ** 0.5))
    for part in propagate(cells, [r + slack * (r > 0) for r in room], rounds):
        hot_cells = hot_cells.unionByName(part)
    cells = F.array_sort("cells")
    upto = F.transform(
        F.sequence(F.lit(1), F.size("cells")),
        lambda k: F.struct(F.aggregate(F.slice(cells, 1, k), F.lit(0).cast("long"), lambda s, c: s + c["n"]).alias("upto"), F.element_at(cells, k)["shard"].alias("shard")),
    )
    labels = saved(hot_cells.select(F.col("g").alias("_g"), F.col("n").alias("group_size"), upto.alias("cells")))
    mine = F.filter("cells", lambda c: c["upto"] > F.col("r"))[0]["shard"]
    labelled = rows.join(labels, F.col("g") == F.col("_g"), "left")
    # documents without a link have no label and come last
    labelled = labelled.select("doc_id", "size", "text_crc32", "g", "r", F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.coalesce(mine, F.lit(shards)).alias("label"))
    placed = saved(numbered(labelled, "label", ["g", "r"]))
    load = {r.label: r.n for r in placed.groupBy("label").agg(F.count("*").alias("n")).collect()}
    kept = [min(load.get(k, 0), quota[k]) for k in range(shards)] + [0]
    spilled = np.cumsum([0] + [load.get(k, 0) - kept[k] for k in range(shards)])
    missing = np.cumsum([0] + [quota[k] - kept[k] for k in range(shards)])
    stays = F.col("position") < _pick(kept, F.col("label"))
    pooled = F.col("position") - _pick(kept, F.col("label")) + _pick(list(spilled), F.col("label"))
    filled = _slot_of(list(missing[1:]), pooled)
    slot = F.when(stays, F.col("position")).otherwise(pooled - _pick(list(missing), filled) + _pick(kept, filled))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.when(stays, F.col("label")).otherwise(filled).cast("int").alias("shard"),
        slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "group_size",
    )


def op12_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
