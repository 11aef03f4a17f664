"""Greedy leader clustering of names by similarity, distributed and exact.

Names are visited in rank order; a name not yet taken leads, and takes every free name that is similar enough. The
leaders are thus the rank-ordered independent set of the graph of similar names. All similar pairs are found once, by an
equality join on string pieces, or in blocks where pieces are so common that the join would meet more pairs than there
are to compare, and stored. Leaders are then elected by joins alone: a name whose better-ranked
neighbours are all taken leads, its neighbours are taken and leave the graph with their pairs, and so on. A round
elects all such names at once, wherever they are, so the number of rounds is the longest chain of decisions that depend on
each other and not the number of leaders.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from faultline.functions.similarity import lcs_table, ratio, score_of
from faultline.session import stored

# Texts of a side that one group compares, and how many times the work a joined pair makes than a pair compared in a block.
BLOCK, DENSE = 2048, 10


def _distance_limit(total_length: Column, threshold: float) -> Column:
    """Most insertions and deletions two texts of that summed length may differ by."""
    return F.floor(total_length * (100 - threshold) / 100 + 1e-9).cast("int")


def _start(n: Column, i: Column, pieces: Column) -> Column:
    return F.floor(n * i / pieces).cast("int")


def _pieces(nodes: DataFrame, threshold: float) -> DataFrame:
    """Cut every text, as the longer one of a pair, into one piece more than edits are allowed."""
    cut = nodes.select(F.col("id").alias("long_id"), "form", F.length("form").alias("n"))
    cut = cut.withColumn("pieces", _distance_limit(2 * F.col("n"), threshold) + 1)
    cut = cut.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    first, after = _start(F.col("n"), F.col("i"), F.col("pieces")), _start(F.col("n"), F.col("i") + 1, F.col("pieces"))
    return cut.select("long_id", "n", "i", F.substring("form", first + 1, after - first).alias("piece"))


def _probes(nodes: DataFrame, lengths: DataFrame, threshold: float) -> DataFrame:
    """Where a piece of a longer text can lie in this text, as the shorter one of the pair; ``lengths`` (n, m) are those to be compared.

    Let e(j) be the edits in piece j. If all of them are at most d < pieces, the first i with
    e(0)+...+e(i) <= i has e(i) = 0 and exactly i edits before it: piece i is intact and shifted by one of
    -i, -i+2, ..., i. The shift is also limited by how many characters either side can lack.
    """
    out = nodes.select(F.col("id").alias("short_id"), "form", F.length("form").alias("m"))
    out = out.join(F.broadcast(lengths.select("n", "m")), "m")
    out = out.withColumn("d", _distance_limit(F.col("m") + F.col("n"), threshold))
    out = out.withColumn("pieces", _distance_limit(2 * F.col("n"), threshold) + 1)
    out = out.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("d"))))
    out = out.withColumn("shift", F.explode(F.sequence(-F.col("i"), F.col("i"), F.lit(2))))
    lacking_long = F.floor((F.col("d") + F.col("n") - F.col("m")) / 2)
    lacking_short = F.floor((F.col("d") - F.col("n") + F.col("m")) / 2)
    out = out.filter(F.col("shift").between(-lacking_long, lacking_short))
    first, after = _start(F.col("n"), F.col("i"), F.col("pieces")), _start(F.col("n"), F.col("i") + 1, F.col("pieces"))
    at, size = first + F.col("shift"), after - first
    out = out.filter((at >= 0) & (at + size <= F.col("m")))
    return out.select("short_id", "n", "m", "i", F.substring("form", at + 1, size).alias("piece"))


_PIECE = ["n", "i", "piece"]


def _lengths(longer: DataFrame, shorter: DataFrame, threshold: float) -> DataFrame:
    """(n, m, longs, shorts): lengths whose texts can reach the threshold, and how many texts have them; n >= m."""
    longs = longer.groupBy(F.length("form").alias("n")).agg(F.count("*").alias("longs"))
    shorts = shorter.groupBy(F.length("form").alias("m")).agg(F.count("*").alias("shorts"))
    longest = F.floor(F.col("m") * (200 - threshold) / threshold + 1e-9).cast("int")
    near = shorts.withColumn("n", F.explode(F.sequence(F.col("m"), longest))).join(longs, "n")
    return near.where(F.col("n") - F.col("m") <= _distance_limit(F.col("n") + F.col("m"), threshold))


def _met(longer: DataFrame, shorter: DataFrame, lengths: DataFrame, threshold: float) -> DataFrame:
    """(long_id, short_id) of names that share a piece where it may lie; of a pair of equal length either may be the longer."""
    return _pieces(longer, threshold).join(_probes(shorter, lengths, threshold), _PIECE).select("long_id", "short_id")


def candidate_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Pairs (form, other) that may reach the threshold: all that do, and few that do not."""
    left, right = (side.select("form", F.col("form").alias("id")) for side in (left, right))
    pairs = _met(left, right, _lengths(left, right, threshold), threshold).toDF("form", "other")
    pairs = pairs.unionByName(_met(right, left, _lengths(right, left, threshold), threshold).toDF("other", "form"))
    return pairs.where("form <> other").distinct()


def _planned(longer: DataFrame, shorter: DataFrame, threshold: float, least: int) -> DataFrame:
    """``_lengths`` with a flag: would the pairs that share pieces be so many that comparing all texts is less work?"""
    lengths = _lengths(longer, shorter, threshold).where(F.col("n") - F.col("m") >= least)
    have = _pieces(longer, threshold).groupBy(*_PIECE).agg(F.count("*").alias("a"))
    asked = _probes(shorter, lengths, threshold).groupBy("m", *_PIECE).agg(F.count("*").alias("b"))
    met = have.join(asked, _PIECE).groupBy("n", "m").agg(F.sum(F.col("a").cast("double") * F.col("b")).alias("met"))
    dense = F.coalesce(F.col("met") * DENSE > F.col("longs").cast("double") * F.col("shorts"), F.lit(False))
    return lengths.join(met, ["n", "m"], "left").select("n", "m", "longs", "shorts", dense.alias("dense"))


def _compared(longer: DataFrame, shorter: DataFrame, lengths: DataFrame, threshold: float, once: bool) -> DataFrame:
    """(long_id, short_id, score): texts of the given lengths that reach the threshold, all compared, in blocks of bounded size."""

    def blocks(size: Column) -> Column:
        return F.ceil(size / BLOCK).cast("int")

    # one row per two lengths
    met = F.broadcast(lengths.select("n", "m", blocks(F.col("longs")).alias("nb"), blocks(F.col("shorts")).alias("mb")))
    parts = 4 * longer.sparkSession.sparkContext.defaultParallelism
    key = ["n", "m", "_n", "_m"]

    def dealt(side: DataFrame, name: str, length: str, own: str, mine: str, other: str, theirs: str) -> GroupedData:
        rows = side.select("id", "form", F.length("form").alias(length)).join(met, length)
        rows = rows.withColumn(mine, F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
        rows = rows.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        if once:
            rows = rows.where("n > m OR _n <= _m")
        # by number: the few rows make much work, and must not be put together into a few tasks
        return rows.select(*key, "id", "form").toDF(*key, f"id_{name}", f"form_{name}").repartition(parts, *key).groupBy(*key)

    def compare(group: tuple, longs: pa.Table, shorts: pa.Table) -> pa.Table:
        n, m, own, other = (k.as_py() for k in group)
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float64)]
        if len(longs) and len(shorts):
            ids = longs.column("id_long").to_numpy(), shorts.column("id_short").to_numpy()
            common = lcs_table(longs.column("form_long").to_pylist(), shorts.column("form_short").to_pylist())
            worth = score_of(np.int64(n + m), np.arange(m + 1))
            wanted = worth[common] >= threshold
            if once and n == m and own == other:
                wanted &= ids[0][:, None] < ids[1]
            i, j = np.nonzero(wanted)
            found = [ids[0][i], ids[1][j], worth[common[i, j]]]
        return pa.table(dict(zip(("long_id", "short_id", "score"), found, strict=True)))

    left, right = dealt(longer, "long", "n", "nb", "_n", "mb", "_m"), dealt(shorter, "short", "m", "mb", "_m", "nb", "_n")
    return left.cogroup(right).applyInArrow(compare, "long_id long, short_id long, score double")


def _scored(longer: DataFrame, shorter: DataFrame, threshold: float, once: bool = False, least: int = 0) -> DataFrame:
    """(long_id, short_id, score) of the pairs (id, form) that reach the threshold, equal texts too; they differ in length by ``least`` or more.

    Two lengths whose texts share few pieces are joined on pieces, others compared in blocks. ``once``: both sides are the
    same, and of two texts of one length only one pair comes out, without those of a text with itself.
    """
    lengths = stored(_planned(longer, shorter, threshold, least))
    sparse = _met(longer, shorter, lengths.where("NOT dense"), threshold).distinct()
    sparse = sparse.join(longer.select(F.col("id").alias("long_id"), F.col("form").alias("a")), "long_id")
    sparse = sparse.join(shorter.select(F.col("id").alias("short_id"), F.col("form").alias("b")), "short_id")
    if once:
        sparse = sparse.where("length(a) > length(b) OR long_id < short_id")
    sparse = sparse.withColumn("score", ratio(F.col("a"), F.col("b"))).where(F.col("score") >= threshold)
    return sparse.select("long_id", "short_id", "score").unionByName(_compared(longer, shorter, lengths.where("dense"), threshold, once))


def scored_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(left_id, right_id, score): all pairs of texts (id, form) that reach the threshold, equal ones included."""
    pairs = _scored(left, right, threshold).toDF("left_id", "right_id", "score")
    # texts of one length have come out of the first
    return pairs.unionByName(_scored(right, left, threshold, least=1).toDF("right_id", "left_id", "score"))


def similar_pairs(nodes: DataFrame, threshold: float) -> DataFrame:
    """(first, second, first_rank): all pairs of ``nodes`` (form, rank) that reach the threshold, the better-ranked name first."""
    numbered = stored(nodes.select("form", "rank").withColumn("id", F.monotonically_increasing_id()))
    similar = _scored(numbered, numbered, threshold, once=True)
    ranked = similar.join(numbered.select(F.col("id").alias("long_id"), F.col("form").alias("a"), F.col("rank").alias("a_rank")), "long_id")
    ranked = ranked.join(numbered.select(F.col("id").alias("short_id"), F.col("form").alias("b"), F.col("rank").alias("b_rank")), "short_id")
    ahead = F.col("a_rank") < F.col("b_rank")
    return ranked.select(
        F.when(ahead, F.col("a")).otherwise(F.col("b")).alias("first"),
        F.when(ahead, F.col("b")).otherwise(F.col("a")).alias("second"),
        F.when(ahead, F.col("a_rank")).otherwise(F.col("b_rank")).alias("first_rank"),
    )


def elect(pairs: DataFrame) -> tuple[DataFrame, int]:
    """((first, second) with all pairs in which a leader takes a name, number of rounds), given pairs (first, second).

    In a round, names that stand second in no pair that is left lead: nobody who could take them is undecided. Whoever stands second
    to them is taken, and all pairs of taken names go. A name left without pairs leads as well.
    """
    taking = None
    left, rounds = stored(pairs.select("first", "second")), 0
    while not left.isEmpty():
        rounds += 1
        leaders = left.select("first").distinct().join(left.select(F.col("second").alias("first")).distinct(), "first", "left_anti")
        won = stored(left.join(leaders, "first", "left_semi"))
        taking = won if taking is None else taking.unionByName(won)
        taken = won.select("second").distinct()
        rest = left.join(taken, "second", "left_anti").join(taken.select(F.col("second").alias("first")), "first", "left_anti")
        left = stored(rest)
    return pairs.select("first", "second").limit(0) if taking is None else taking, rounds


def greedy_leaders(nodes: DataFrame, threshold: float) -> DataFrame:
    """Leader of every node: (form, leader).

    nodes      distinct (form, rank); ``rank`` is any orderable, unique column
    threshold  least similarity, 0-100, on which a leader takes a name

    The stored graph holds every similar pair once. Taken names get the best-ranked of the leaders they are similar to.
    """
    nodes = stored(nodes.select("form", "rank"))
    pairs = stored(similar_pairs(nodes, threshold))
    won, _ = elect(pairs)
    # a leader may have been elected after its neighbour was taken by another one that ranks lower
    takers = nodes.select("form").join(won.select(F.col("second").alias("form")).distinct(), "form", "left_anti")
    takers = stored(takers.withColumnRenamed("form", "first"))
    taken = pairs.join(takers, "first", "left_semi").groupBy(F.col("second").alias("form")).agg(F.min_by("first", "first_rank").alias("leader"))
    return takers.select(F.col("first").alias("form"), F.col("first").alias("leader")).unionByName(taken)
