"""Mixing sources to target weights: entropy balancing of document rates, rounded into copies."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import fresh, saved, table, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
NEWTON_STEPS = 60
TOLERANCE = 1e-9
# Documents of one source and size are chosen by hash inside this many slots, so copies of one text share the work.
SLOTS = 256


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(k, source, source_size, target) for rows (source, size): ``share`` of all sizes, dealt by weight.

    Sources are ordered by code point, null last; ``k`` numbers them. A target stops at ``most`` times its source's size;
    what is left over is dealt again by weight until no target is above. That ends at one level of words per weight:
    with sources in order of cap per weight it is the largest of (budget - caps before) / (weights from here on).
    The window runs over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("int")
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("k", number).withColumn("w", F.element_at(wheel, ((F.col("k") - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * float(most))
    rising = Window.orderBy(F.col("cap") / F.col("w"), "k")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(rising.rowsBetween(0, Window.unboundedFollowing))
    level = F.greatest((F.sum("source_size").over(everything) * share - before) / rest, F.lit(0.0))
    per = per.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return per.select("k", "source", "source_size", F.least("cap", F.col("w") * F.col("level")).alias("target"))


def balanced_rates(hist: DataFrame, targets: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """``hist`` (k, size, n) with a double ``rate`` in 0..most: the entropy balancing solution of every source.

    Of all rates r whose words, the sum of n * size * r, meet the target, the solution stays closest to 1 in relative
    entropy: r = min(most, exp(a * size / mean)), with one multiplier a per source, the point where the dual is flat. The
    dual is convex; all sources take their Newton steps together, each step one aggregate over the histogram of sizes.
    A step that leaves the bracket known so far is replaced by its middle. Targets at the bound take every document
    ``most`` times.
    """
    mean = hist.groupBy("k").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    state = targets.where("target > 0").join(mean, "k").select("k", "target", "mean", (F.col("target") >= F.col("source_size") * most * (1 - 1e-12)).alias("full"))
    state = state.withColumns({"a": F.lit(0.0), "low": F.lit(-1e4), "high": F.lit(1e7), "off": F.lit(1e300)})
    state = saved(state)
    tilt = F.exp(F.least(F.col("a") * F.col("size") / F.col("mean"), F.lit(50.0)))
    words = F.col("n") * F.col("size")
    for _ in range(NEWTON_STEPS):
        sums = (
            hist.join(state.where("NOT full").select("k", "a", "mean"), "k")
            .groupBy("k")
            .agg(
                F.sum(words * F.least(tilt, F.lit(float(most)))).alias("f"),
                F.sum(F.when(tilt < most, words * tilt * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"),
            )
        )
        low = F.when(F.col("f") < F.col("target"), F.col("a")).otherwise(F.col("low"))
        high = F.when(F.col("f") > F.col("target"), F.col("a")).otherwise(F.col("high"))
        next_a = F.col("a") - F.when(F.col("slope") > 0, (F.col("f") - F.col("target")) / F.col("slope"))
        stepped = state.join(sums, "k", "left").withColumns({"low": low, "high": high, "next": next_a})
        inside = F.col("next").isNotNull() & (F.col("next") > F.col("low")) & (F.col("next") < F.col("high"))
        # far from the root the bracket spans powers of ten: its middle is taken on a logarithmic scale
        middle = F.when((F.col("low") >= 0.1) & (F.col("high") > 10 * F.col("low")), F.sqrt(F.col("low") * F.col("high"))).otherwise(
            F.when((F.col("low") < 0.1) & (F.col("high") > 10), F.lit(1.0)).otherwise((F.col("low") + F.col("high")) / 2)
        )
        off = F.coalesce(F.abs(F.col("f") / F.col("target") - 1), F.lit(0.0))
        done = off <= TOLERANCE
        state = saved(
            stepped.select(
                "k", "target", "mean", "full", F.when(done, F.col("a")).when(inside, F.col("next")).otherwise(middle).alias("a"), "low", "high", off.alias("off")
            )
        )
        if (state.agg(F.max("off")).first()[0] or 0.0) <= TOLERANCE:
            break
    rate = F.when(F.col("full"), F.lit(float(most))).otherwise(F.least(tilt, F.lit(float(most))))
    return hist.join(state.select("k", "a", "mean", "full"), "k").select("k", "size", "n", rate.alias("rate"))


def _round_source(sizes: pd.DataFrame) -> pd.DataFrame:
    """Copies of each size of a source, larger sizes first; what rounding leaves is passed on to the next size."""
    sizes = sizes.sort_values("size", ascending=False)
    copies, owed = [], 0.0
    for size, n, rate in zip(sizes["size"], sizes["n"], sizes["rate"], strict=True):
        owed += size * n * rate
        taken = min(max(round(owed / size), 0), MOST_COPIES * n)
        owed -= taken * size
        copies.append(int(taken))
    return pd.DataFrame({"k": sizes["k"], "size": sizes["size"], "n": sizes["n"], "copies": copies})


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies (0 to 2).

    Sizes are words of the whole text (null: none). Rates are solved on a histogram of sizes per source, which is
    bounded by the longest document, and rounded there with the remainder passed from size to size, so that a source
    misses its target by about one short document. Documents of one source and size are then equal to the mix; those
    that get the odd copy are the first by hash of the id within slots, and each row counts for itself: of rows with one
    id, or none, as many get it as the target asks for, chosen by place in the table. Documents without words are taken
    no times. An empty table gives an empty result; other columns are ignored.
    """
    sized = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    sized = saved(sized.withColumn("row", F.monotonically_increasing_id()))
    targets = saved(source_targets(sized, weights, share))
    named = targets.select("k", F.col("source").alias("_source"), "source_size", "target")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "row", "source", "size", "k", "source_size", "target")
    slot = F.pmod(F.xxhash64(F.when(F.col("doc_id").isNull(), F.col("row")), "doc_id"), F.lit(SLOTS)).cast("int")
    rows = rows.withColumn("slot", slot)
    cells = saved(rows.where("size > 0").groupBy("k", "size", "slot").agg(F.count("*").alias("m")))
    hist = saved(cells.groupBy("k", "size").agg(F.sum("m").alias("n")))
    rates = balanced_rates(hist, targets)
    copies = rates.groupBy("k").applyInPandas(_round_source, "k int, size long, n long, copies long")
    # odd copies of a size, dealt to its slots in proportion to their documents
    odd, over = F.col("copies") % F.col("n"), Window.partitionBy("k", "size").orderBy("slot")
    upto = F.sum("m").over(over)
    dealt = (
        cells.join(copies, ["k", "size"])
        .withColumns({"upto": upto, "odd": odd})
        .selectExpr("k AS _k", "size AS _size", "slot AS _slot", "int(copies div n) AS base", "odd * upto div n - odd * (upto - m) div n AS odd")
    )
    place = F.row_number().over(Window.partitionBy("k", "size", "slot").orderBy(F.xxhash64(F.lit("mix"), F.col("doc_id")), "doc_id", "row"))
    ranked = rows.withColumn("place", place)
    met = ranked.join(dealt, (F.col("k") == F.col("_k")) & (F.col("size") == F.col("_size")) & (F.col("slot") == F.col("_slot")), "left")
    number = F.coalesce(F.col("base") + (F.col("place") <= F.col("odd")).cast("int"), F.lit(0))
    return met.select("doc_id", "source", "size", "source_size", "target", number.alias("copies"))


def apply_mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Rows of ``docs``, all columns, each as often as the mix takes it.

    Rows meet the mix by id, source and size; where several rows agree in these, null ids included, each takes one of the
    numbers of copies that the mix has for them. An empty table stays empty; columns of any name are carried along.
    """
    keys = ["_id", "_none", "_source", "_plain", "_size"]

    def keyed(frame: DataFrame, size: Column, names: list[str]) -> DataFrame:
        values = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull()]
        values += [F.coalesce(F.col("source").cast("string"), F.lit("")), F.col("source").isNull(), size]
        return frame.withColumns(dict(zip(names, values, strict=True)))

    mixed = keyed(mix(docs, weights, share), F.col("size"), keys)
    taken = mixed.groupBy(*keys).agg(F.sort_array(F.collect_list("copies"), asc=False).alias("_copies")).where(F.col("_copies")[0] > 0)
    own, number, copies = fresh(docs, *["_own" + k for k in keys]), *fresh(docs, "_number", "_copies")
    taken = taken.toDF(*fresh(docs, *keys), copies)
    # the same keys for the numbers and the join, so that texts are exchanged once
    placed = keyed(docs, word_count(F.col("text")), own).withColumn(number, F.row_number().over(Window.partitionBy(*own).orderBy(F.xxhash64("text"))))
    same = [F.col(a) == F.col(b) for a, b in zip(own, fresh(docs, *keys), strict=True)]
    met = placed.join(taken, same).withColumn(copies, F.element_at(copies, F.col(number))).where(F.col(copies) > 0)
    each = F.explode(F.sequence(F.lit(1), F.col(copies)))
    return met.withColumn(number, each).select(*docs.columns)


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
