"""Entity resolution: company aliases, and recalls to products."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.config import DEFAULTS
from faultline.fixed_values import TIER_EXACT, TIER_HIGH, TIER_LOW, TIER_NONE
from faultline.functions.similarity import best_choice, sorted_form, token_sort_ratio
from faultline.functions.text import company_key, denoise_description
from faultline.operators.best_match import best_match
from faultline.operators.joins import flag_members
from faultline.operators.leaders import greedy_leaders, scored_pairs
from faultline.session import stored


def all_above(queries: DataFrame, choices: DataFrame, key: str, text: str, cutoff: float) -> DataFrame:
    """All choices that score at least ``cutoff`` for each query, by token-sort ratio: (query_key, choice_key, score).

    Both sides have columns ``key`` and ``text``. Every choice is considered: distinct token-sorted forms are compared by
    ``scored_pairs``, and their numbers joined to the keys.
    """
    q = queries.select(F.col(key).alias("query_key"), sorted_form(F.col(text)).alias("form"))
    c = choices.select(F.col(key).alias("choice_key"), sorted_form(F.col(text)).alias("form"))
    left, right = (stored(side.select("form").where("form IS NOT NULL").distinct().withColumn("id", F.monotonically_increasing_id())) for side in (q, c))
    scored = scored_pairs(left, right, cutoff)
    asked = q.join(left, "form").select("query_key", F.col("id").alias("left_id"))
    known = c.join(right, "form").select("choice_key", F.col("id").alias("right_id"))
    return asked.join(scored, "left_id").join(known, "right_id").select("query_key", "choice_key", "score")


def best_others(names: DataFrame, key: str, text: str, cutoff: float, step: float = 5.0, digits: int = 6) -> DataFrame:
    """For each name the best of all names under other keys, if it scores ``cutoff`` or more: (query_key, choice_key, score).

    Scores are rounded to ``digits``; of equal ones the lowest key wins. Cutoffs go down from 100 by steps, and a name
    whose best is above the cutoff is not asked again: the many pairs far below the best are never put out.
    """
    asked = stored(names.select(key, sorted_form(F.col(text)).alias(text)).where(F.col(key).isNotNull()))
    # of the keys under one form only the two lowest can be the best other key of any name
    place = F.row_number().over(Window.partitionBy(text).orderBy(key))
    names = stored(asked.where(F.col(text).isNotNull()).distinct().withColumn("_place", place).where("_place <= 2").select(key, text))
    found, level = None, 100.0
    while found is None or (level > cutoff and not asked.isEmpty()):
        level = max(cutoff, level - step)
        others = all_above(asked, names, key, text, level).where("query_key <> choice_key").withColumn("score", F.round("score", digits))
        best = best_choice(others, "query_key", "choice_key", "score", "choice_key", level)
        if level > cutoff:
            # what rounds to the cutoff may tie with a score just below it
            best = stored(best.where(F.col("score") > level + 10.0**-digits))
            asked = stored(asked.join(best.select(F.col("query_key").alias(key)), key, "left_anti"))
        found = best if found is None else found.unionByName(best)
    return found


def flag_top_with_ties(df: DataFrame, among, measure: str, n: int, flag: str) -> DataFrame:
    """Flag rows of ``among`` whose measure reaches the n-th largest one there; ties are all in."""
    top = df.where(among).select(measure).orderBy(F.desc(measure)).limit(n)
    least = top.agg(F.min(measure)).scalar()
    return df.withColumn(flag, among & F.coalesce(F.col(measure) >= least, F.lit(False)))


def label_aliases(pairs: DataFrame, review_top_n: int = DEFAULTS.review_top_n, order_by: str = "confidence_level") -> DataFrame:
    """Rule and confidence of (raw_name, standardized_name) pairs, and the flag for manual review.

    exact: the name itself, 100. suffix_removal: same name apart from legal form and punctuation, 95.
    fuzzy_match: anything else, with its token-sort score. Only fuzzy matches can be flagged.
    """
    raw, standard = company_key(F.col("raw_name")), company_key(F.col("standardized_name"))
    same = F.col("raw_name") == F.col("standardized_name")
    rule = F.when(same, "exact").when(raw == standard, "suffix_removal").otherwise("fuzzy_match")
    labelled = pairs.withColumn("normalization_rule", rule).withColumn("_score", token_sort_ratio(raw, standard))
    labelled = labelled.withColumn(
        "confidence_level",
        F.when(F.col("normalization_rule") == "exact", 100.0)
        .when(F.col("normalization_rule") == "suffix_removal", 95.0)
        .otherwise(F.col("_score")),
    )
    fuzzy = F.col("normalization_rule") == "fuzzy_match"
    flagged = flag_top_with_ties(labelled, fuzzy, order_by, review_top_n, "manual_review_flag")
    return flagged.select("raw_name", "standardized_name", "normalization_rule", "confidence_level", "manual_review_flag")


def manufacturer_alias(
    events: DataFrame, column: str = "manufacturer_d_name", threshold: float = DEFAULTS.alias_score,
    review_top_n: int = DEFAULTS.review_top_n,
) -> DataFrame:
    """One row per distinct company name with the name it is filed under.

    Names rank by frequency, then alphabetically. The score depends only on the token-sorted normal form, so
    clustering runs on distinct forms; a form ranks as its best raw name, which also labels the cluster.
    """
    names = (
        events.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("raw_name"))
        .agg(F.count("*").alias("n"))
        .select(
            "raw_name",
            sorted_form(company_key(F.col("raw_name"))).alias("form"),
            F.struct((-F.col("n")).alias("minus_n"), "raw_name").alias("rank"),
        )
    )
    # Stored: counting the names reads all events, and the names are used again for every label.
    names = stored(names)
    nodes = names.groupBy("form").agg(F.min("rank").alias("rank"))
    clusters = greedy_leaders(nodes, threshold)
    labels = nodes.select(F.col("form").alias("leader"), F.col("rank.raw_name").alias("standardized_name"))
    pairs = names.select("raw_name", "form").join(clusters, "form").join(labels, "leader")
    return label_aliases(pairs.select("raw_name", "standardized_name"), review_top_n)


def match_names(dim: DataFrame, order: str = "product_code") -> DataFrame:
    """Distinct device names in dimension order, each with the code of its last row.

    Rows without a code or a name are left out as rows, so code and name always belong together.
    """
    usable = dim.where("product_code IS NOT NULL AND device_name IS NOT NULL")
    return usable.groupBy("device_name").agg(
        F.min(order).alias("first_place"), F.max_by("product_code", order).alias("code")
    )


def map_recalls(
    recalls: DataFrame, dim: DataFrame, *, high: float = DEFAULTS.high_score, low: float = DEFAULTS.low_score,
    order: str = "product_code",
) -> DataFrame:
    """Recalls with mapping tier, matched code, score and the flag for the core dashboard.

    A known product code is an exact match. Otherwise the cleaned description is matched against the device
    names. Cleaning comes before deduplication: descriptions that differ only in lot or part numbers are
    matched once. ``order`` gives the order of the dimension, which decides between equal scores.
    """
    flagged = flag_members(recalls, "product_code", dim, "product_code", "_exact")
    cleaned = flagged.withColumn("_text", F.when(~F.col("_exact"), denoise_description(F.col("product_description"))))
    # Stored: cleaning is the costly part, and its result is used twice.
    cleaned = stored(cleaned)
    texts = cleaned.select("_text").where("_text <> ''").distinct()
    matches = best_match(
        texts, "_text", match_names(dim, order), name="device_name", code="code", place="first_place",
        cutoff=low,
    ).where("match_score IS NOT NULL")

    # Rows that need no text match get a key that matches nothing and spreads evenly.
    key = F.coalesce(F.nullif("_text", F.lit("")), F.concat(F.lit("\0"), F.xxhash64(*recalls.columns).cast("string")))
    joined = cleaned.withColumn("_key", key).join(matches.withColumnRenamed("_text", "_key"), "_key", "left")
    exact, score = F.col("_exact"), F.col("match_score")
    tier = (
        F.when(exact, TIER_EXACT).when(score >= high, TIER_HIGH).when(score.isNotNull(), TIER_LOW).otherwise(TIER_NONE)
    )
    return joined.select(
        *recalls.columns,
        tier.alias("mapping_quality"),
        F.when(exact, F.col("product_code")).otherwise(F.col("match_code")).alias("matched_product_code"),
        F.when(exact, 100.0).otherwise(score).alias("match_score"),
        (exact | F.coalesce(score >= high, F.lit(False))).alias("include_in_core_dashboard"),
    )
