import random

from pyspark.sql import functions as F

from faultline.operators import dedup, joins
from faultline.operators.ordered import ordered_within


def skewed(spark):
    """One key holds half of the rows; dates repeat and some are missing."""
    rng = random.Random(3)
    data = [
        (("hot" if rng.random() < 0.5 else f"k{rng.randrange(300)}") if i % 50 else None,
         f"2020-01-{rng.randrange(1, 9):02d}" if rng.random() < 0.9 else None, f"f{rng.randrange(5)}", i, rng.randrange(100), rng.random() < 0.01)
        for i in range(4000)
    ]
    df = spark.createDataFrame(data, "key string, day string, file string, pos int, v int, flag boolean")
    return df.withColumn("day", F.to_date("day"))


def test_split_groups_number_like_whole_ones(spark):
    df = skewed(spark)
    options = dict(key="key", date="day", tie_break=["file", "pos"], any_of=["flag"])
    whole = dedup.rank_versions(df, **options).collect()
    split = dedup.rank_versions(df, **options, hot_rows=50)
    # The split really happens: a hot bucket is found.
    from faultline.operators.ordered import hot_buckets

    assert hot_buckets(df, ["key"], 50).count() >= 1
    assert sorted(whole, key=repr) == sorted(split.collect(), key=repr)

    groups = {}
    for r in whole:
        groups.setdefault(r["key"], []).append(r)
    for group in groups.values():
        group.sort(key=lambda r: r["followup_rank"])
        assert [r["followup_rank"] for r in group] == list(range(1, len(group) + 1))
        days = [r["day"] for r in group]
        known = [d for d in days if d]
        assert known == sorted(known, reverse=True) and days[: len(known)] == known
        assert [r["is_latest_version"] for r in group] == [True] + [False] * (len(group) - 1)
        assert len({r["flag"] for r in group}) == 1


def test_running_total_over_split_groups(spark):
    df = skewed(spark).where("key IS NOT NULL")
    order = [F.desc("v"), F.asc("pos")]
    options = dict(position="n", running={"total": "v"})
    whole = ordered_within(df, ["key"], order, [-F.col("v")], **options).collect()
    split = ordered_within(df, ["key"], order, [-F.col("v")], **options, hot_rows=50).collect()
    assert sorted(whole, key=repr) == sorted(split, key=repr)
    hot = sorted((r for r in split if r["key"] == "hot"), key=lambda r: r["n"])
    total = 0
    for r in hot:
        total += r["v"]
        assert r["total"] == total


def test_absent_rows_take_no_position(spark):
    df = spark.createDataFrame([("a", "2020-01-02", 1, False), ("a", "2020-01-03", None, True), ("a", "2020-01-01", 2, False)], "key string, day string, d int, flag boolean")
    ranked = dedup.rank_versions(df, "key", "day", ["d"], any_of=["flag"], present=F.col("d").isNotNull(), hot_rows=0)
    found = {r["d"]: (r["followup_rank"], r["flag"]) for r in ranked.where("d IS NOT NULL").collect()}
    assert found == {1: (1, True), 2: (2, True)}


def test_report_grain_marks_every_row_of_the_newest_date(spark):
    df = spark.createDataFrame([("a", "2020-01-02", 1), ("a", "2020-01-02", 2), ("a", "2020-01-01", 3), ("b", None, 4)], "key string, day string, x int")
    ranked = dedup.rank_versions(df.withColumn("day", F.to_date("day")), "key", "day", grain="report")
    assert {r["x"]: (r["followup_rank"], r["is_latest_version"]) for r in ranked.collect()} == {
        1: (1, True), 2: (1, True), 3: (2, False), 4: (1, True),
    }


def test_keep_first_and_null_keys(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 5, "z"), (None, 4, "w")], "k string, pos int, v string")
    assert rows(dedup.keep_first(df, ["k"], ["pos"])) == sorted([("a", 1, "y"), (None, 4, "w")], key=repr)


def test_null_rules_of_joins(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2), ("x", 3)], "code string, n int")
    dim = spark.createDataFrame([("a", "A"), (None, "N")], "code string, label string")
    assert rows(joins.enrich(df, dim, "code", ["label"])) == sorted([("a", 1, "A"), (None, 2, "N"), ("x", 3, None)], key=repr)
    assert rows(joins.flag_members(df, "code", dim, "code", "known"), "n", "known") == [(1, True), (2, False), (3, False)]
    lookup = spark.createDataFrame([(1, "zz"), (2, "filled")], "id int, value string")
    filled = joins.fill_from_lookup(df, lookup, "code", "n", "id", "value")
    assert rows(filled, "n", "code") == [(1, "a"), (2, "filled"), (3, "x")]
    assert joins.fill_from_lookup(df, None, "code", "n", "id", "value") is df
    flags = spark.createDataFrame([(1, True)], "n int, f boolean")
    assert rows(joins.fill_flags(df, flags, "n", ["f"]), "n", "f") == [(1, True), (2, False), (3, False)]


def test_merge_counts_matches_null_with_null(spark, rows):
    a = spark.createDataFrame([(None, 2020, 2), ("p", 2020, 1)], "code string, year int, x bigint")
    b = spark.createDataFrame([(None, 2020, 5), ("q", 2021, 7)], "code string, year int, y bigint")
    merged = joins.merge_counts([a, b], ["code", "year"], ["x", "y"])
    assert rows(merged) == sorted([(None, 2020, 2, 5), ("p", 2020, 1, 0), ("q", 2021, 0, 7)], key=repr)
