from datetime import date

import pytest
from pyspark.sql import functions as F

from faultline.config import Settings
from faultline.operators import quality as Q
from faultline.operators.dedup import rank_versions
from faultline.operators.ordered import running_by_range
from faultline.plans import dashboard, exports, marts, quality_suites, refresh

SETTINGS = Settings(year_min=2019, year_max=2025)


@pytest.fixture(scope="module")
def layer(spark):
    dim = spark.createDataFrame(
        [("ABC", "Clamp One", "AN", "2", "Anesthesiology"), ("DEF", "Clamp Two", "CV", "3", "Cardiovascular"), ("GHI", "Clamp Three", "AN", "1", "Anesthesiology"), ("NOP", "None", None, "1", "x")],
        "product_code string, device_name string, review_panel string, device_class string, medical_specialty_description string",
    )
    codes = ["ABC"] * 3 + ["DEF"] * 2 + ["ABC"] * 2 + ["DEF"] * 2 + ["GHI"]
    firms = ["Cedar"] * 3 + ["Dogwood"] * 2 + ["Cedar"] * 2 + ["Elm"] * 2 + ["Cedar"]
    events = [
        (f"E{i}", date(2022 + i // 5, 1, 1), 2022 + i // 5, codes[i], firms[i], i >= 7, 4 <= i < 7, i < 4, i != 8) for i in range(10)
    ]
    # Outside the window, without a year, without a code, without a firm, and a superseded row of a firm of its own.
    events += [
        ("F1", None, None, "ABC", "Cedar", False, False, False, True), ("F2", date(2010, 1, 1), 2010, "ABC", "Cedar", False, False, False, True),
        ("F3", date(2022, 1, 1), 2022, None, "Alder", True, False, False, True), ("F4", date(2022, 1, 1), 2022, "NOP", None, False, False, False, True),
        ("F5", date(2023, 1, 1), 2023, "QQQ", "Birch", False, False, False, False),
    ]
    events = spark.createDataFrame(
        events,
        "event_record_id string, date_received date, event_year int, product_code string, manufacturer_d_name string, has_death boolean, has_serious_injury boolean, has_malfunction boolean, is_latest_version boolean",
    )
    recalls = spark.createDataFrame(
        [("R1", 2022, "I", "ABC", None, "Cedar", True), ("R2", 2022, "II", "zzz", "DEF", "Dogwood", True), ("R3", 2023, "III", "ABC", "ABC", "Cedar", True),
         ("R4", 2023, "I", "ABC", None, "Cedar", False), ("R5", 2022, "I", None, None, "Alder", True)],
        "recall_number string, recall_year int, recall_class string, product_code string, matched_product_code string, recalling_firm string, include_in_core_dashboard boolean",
    ).withColumn("mapping_quality", F.when(F.col("matched_product_code").isNotNull(), "exact_product_code_match").otherwise("unmapped"))
    recalls = recalls.withColumn("recall_initiation_date", F.lit(None).cast("date"))
    clearances = spark.createDataFrame([(f"K{i}", date(2022, 5, 1), 2022, "ABC" if i < 12 else "DEF") for i in range(15)], "k_number string, decision_date date, decision_year int, product_code string")
    return {"events": events, "recalls": recalls, "clearances": clearances, "dim": dim}


def built(layer):
    return marts.build_all_marts(layer["events"], layer["recalls"], layer["clearances"], layer["dim"], SETTINGS)


def test_panel_mart(layer):
    direct = marts.mart_panel_year(layer["events"], layer["recalls"], layer["clearances"], layer["dim"], SETTINGS).collect()
    assert direct == built(layer)["mart_panel_year"].collect()
    found = {(r["review_panel"], r["year"]): r for r in direct}
    assert list(found) == [("AN", 2022), ("AN", 2023), ("CV", 2022), ("CV", 2023)]
    an, cv = found["AN", 2022], found["CV", 2023]
    assert (an["event_count_raw"], an["event_count_dedup"], an["recall_count"], an["class_i_recall_count"], an["clearance_count"]) == (3, 3, 1, 1, 12)
    assert an["events_per_100_clearances"] == 25.0 and an["severe_recall_share"] is None
    assert (cv["event_count_raw"], cv["event_count_dedup"], cv["clearance_count"], cv["events_per_100_clearances"]) == (2, 1, 0, None)
    assert sum(r["event_count_raw"] for r in direct) == 10 and sum(r["event_count_dedup"] for r in direct) == 9 and sum(r["recall_count"] for r in direct) == 3
    assert dict(marts.mart_panel_year(layer["events"], layer["recalls"], layer["clearances"], layer["dim"], SETTINGS).dtypes)["recall_count"] == "bigint"


def test_product_mart(layer):
    found = {(r["product_code"], r["year"]): r for r in built(layer)["mart_product_code_year"].collect()}
    assert list(found)[-1] == (None, 2022)
    # Null codes of events and of recalls meet in one row; a group without latest rows still appears.
    assert (found[None, 2022]["event_count_dedup"], found[None, 2022]["recall_count"]) == (1, 1)
    assert found["QQQ", 2023]["event_count_dedup"] == 0 and found["QQQ", 2023]["recall_to_event_ratio"] is None
    assert found["ABC", 2022]["recall_to_event_ratio"] == pytest.approx(1 / 3)


def test_panel_and_product_marts_read_stored_counts(layer):
    """The facts are united and rolled up once, not by every reader of the two marts."""
    for name in ("mart_panel_year", "mart_product_code_year"):
        assert "Union" not in built(layer)[name]._jdf.queryExecution().optimizedPlan().toString(), name


def test_firm_mart(layer):
    found = {(r["manufacturer"], r["product_code"], r["year"]): r for r in built(layer)["mart_firm_product_year"].collect()}
    assert ("Alder", None, 2022) in found and found["Alder", None, 2022]["firm_share_within_product"] is None
    assert found["Birch", "QQQ", 2023]["firm_share_within_product"] is None and found["Birch", "QQQ", 2023]["firm_share_within_panel"] is None
    assert found["Cedar", "ABC", 2022]["firm_share_within_product"] == 1.0
    assert found["Cedar", "ABC", 2023]["firm_share_within_panel"] == pytest.approx(2 / 3)
    assert not any(k[0] is None for k in found)
    totals = {}
    for (_, code, year), r in found.items():
        if r["firm_share_within_product"] is not None:
            totals[code, year] = totals.get((code, year), 0) + r["firm_share_within_product"]
    assert all(t == pytest.approx(1) for t in totals.values())


def test_alias_merges_firms(layer, spark):
    alias = spark.createDataFrame([("Dogwood", "Cedar"), ("Elm", "Cedar")], "raw_name string, standardized_name string")
    mart = marts.mart_firm_product_year(layer["events"], layer["recalls"], layer["dim"], SETTINGS, alias)
    assert {r["manufacturer"] for r in mart.collect()} == {"Cedar", "Alder", "Birch"}


def test_marts_of_nothing(layer):
    empty = {k: v.limit(0) for k, v in layer.items()}
    assert all(df.count() == 0 for df in built(empty).values())


def test_exports(layer, spark, tmp_path):
    m = built(layer)
    blank = m["mart_panel_year"].limit(1).withColumn("review_panel", F.lit("  "))
    overview = exports.app_overview(m["mart_panel_year"].unionByName(blank))
    assert {r["review_panel"] for r in overview.collect()} == {"AN", "CV", "Unknown"}
    junk = m["mart_product_code_year"].limit(1).withColumn("product_code", F.lit("---"))
    product = m["mart_product_code_year"].unionByName(junk)
    category = exports.app_category_product(product, layer["dim"], SETTINGS)
    codes = [r["product_code"] for r in category.collect()]
    assert "---" not in codes and None in codes and "device_name" in category.columns
    capped = exports.app_category_product(product, layer["dim"], Settings(category_rows=2))
    assert [(r["product_code"], r["year"]) for r in capped.collect()] == [("ABC", 2022), ("ABC", 2023)]
    maker = exports.app_manufacturer(m["mart_firm_product_year"].withColumn("manufacturer", F.when(F.col("manufacturer") != "Birch", F.col("manufacturer"))), layer["dim"], SETTINGS)
    assert "Unknown" in {r["manufacturer"] for r in maker.collect()}
    apps = exports.export_all(m, layer, SETTINGS)
    assert list(apps) == ["app_overview", "app_category_product", "app_manufacturer", "app_methodology"]
    exports.write_exports(apps, str(tmp_path))
    assert spark.read.option("header", True).csv(str(tmp_path / "app_category_product.csv")).count() == len(codes)


def test_methodology(layer):
    found = {(r["source"], r["metric"]): r["value"] for r in exports.app_methodology(layer["events"], layer["recalls"], layer["clearances"], layer["dim"], SETTINGS).collect()}
    assert found["adverse_events", "row_count"] == "15" and found["adverse_events", "date_min"] == "2010-01-01"
    assert ("recalls", "date_min") not in found
    assert found["adverse_events", "duplicate_rate_pct"] == str(round((1 - 13 / 15) * 100, 1))
    assert found["mapping_coverage", "event_product_code_coverage_pct"] == "80.0"
    assert found["recalls", "core_dashboard_coverage_pct"] == "80.0" and found["recalls", "mapping_quality_exact"] == "2"
    assert found["analysis_window", "year_max"] == "2025" and all(v is not None for v in found.values())
    nothing = {(r["source"], r["metric"]): r["value"] for r in exports.app_methodology(*(layer[k].limit(0) for k in ("events", "recalls", "clearances", "dim")), SETTINGS).collect()}
    assert nothing["adverse_events", "duplicate_rate_pct"] == "0.0" and ("mapping_coverage", "event_product_code_coverage_pct") not in nothing


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0]


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 3)] + [("b", i) for i in range(6)], "k string, v int")
    assert one(Q.check_row_count(df, "t", 5))[1:3] == ("pass", 10.0)
    assert one(Q.check_row_count(df, "t", 5000)).details == "t: 10 rows (min 5,000)"
    assert [one(Q.check_null_rate(df, "k", r)).status for r in (0.2, 0.1, 0.05)] == ["pass", "warn", "fail"]
    assert one(Q.check_null_rate(df, "k", 0.2)).details == "k: 20.0% null (max 20.0%)"
    assert one(Q.check_null_rate(df, "no"))[1:3] == ("fail", None)
    assert one(Q.check_null_rate(df.limit(0), "k")).metric_value == 0.0
    assert one(Q.check_uniqueness(df, ["k", "v"], "t"))[1:3] == ("fail", 1.0)
    assert one(Q.check_uniqueness(df, ["k", "v"], "t")).details == "t: 1 duplicates on ['k', 'v']"
    assert one(Q.check_uniqueness(df.limit(0), ["k"], "t"))[1:] == ("pass", 0.0, 0.0, "t: empty DataFrame")
    counts = spark.createDataFrame([(100, 45, 0)], "raw int, kept int, zero int")
    assert [one(Q.check_dedup_ratio(counts, "raw", "kept", "t", m)).status for m in (0.55, 0.5, 0.4)] == ["pass", "warn", "fail"]
    assert one(Q.check_dedup_ratio(counts, "zero", "zero", "t")).details == "t: no raw rows"
    assert one(Q.check_coverage(df, "k")).details == "k: 80.0% non-null (8/10)"
    reference = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    assert one(Q.check_coverage(df, "k", reference))[1:3] == ("warn", 0.6667)
    assert one(Q.check_coverage(df, "k", reference)).details == "k: 2/3 ref values (66.7%), row coverage 80.0%"
    assert one(Q.check_row_limit(df, "t", 9)).status == "fail"


def test_volume_shift(spark):
    df = spark.createDataFrame([(2019,)] * 10 + [(2020,)] * 15 + [(2023,)] * 10 + [(None,)], "y int")
    result = one(Q.check_volume_shift(df, "y"))
    assert (result.status, result.metric_value, result.details) == ("pass", 0.5, "Max YoY change: 50.0% (2019->2020)")
    assert [one(Q.check_volume_shift(df, "y", max_change=m)).status for m in (0.4, 0.1)] == ["warn", "fail"]
    assert one(Q.check_volume_shift(df.where("y = 2019"), "y")).details == "Not enough years to compare"
    sums = spark.createDataFrame([(2019, 0), (2020, 5), (2021, 5)], "y int, n int")
    assert one(Q.check_volume_shift(sums, "y", "n")).details == "Max YoY change: 0.0% ()"
    assert one(Q.check_volume_shift(df, "no")).status == "fail"
    shrinking = spark.createDataFrame([(2019, -4), (2020, -8)], "y int, n int")
    assert one(Q.check_volume_shift(shrinking, "y", "n")).metric_value == 0.0


def test_gate_grain_and_invariant(spark, layer):
    passing = Q.check_row_count(layer["dim"], "dim")
    failing = Q.failed(spark, "file_exists_x", "x not found")
    assert Q.evaluate_quality_gate(passing) and not Q.evaluate_quality_gate(Q.run_checks([passing, failing]))
    assert Q.evaluate_quality_gate(passing.limit(0))
    assert Q.assert_grain(layer["dim"], ["product_code"], "dim") is layer["dim"]
    with pytest.raises(ValueError, match="duplicate keys"):
        Q.assert_grain(layer["dim"], ["review_panel"], "dim")
    rules = [("events_per_100_clearances", "clearance_count", 10)]
    assert one(Q.kpi_null_invariant(built(layer)["mart_panel_year"], rules)).holds


def test_suites_and_decisions(spark, layer, tmp_path):
    m = built(layer)
    clean_layer = {"events": layer["events"], "recalls": layer["recalls"], "clearances": layer["clearances"]}
    summary = quality_suites.qa_summary(spark, clean_layer, m, {}, SETTINGS).collect()
    names = [r["check_name"] for r in summary]
    assert "file_exists_dim_product_code" in names and names.count("file_exists_app_overview") == 1 and "uniqueness_mart_panel_year" in names
    stored = quality_suites.build_qa_summary(spark, str(tmp_path / "c"), str(tmp_path / "m"), str(tmp_path / "a"), str(tmp_path / "qa"))
    assert stored.where("status = 'fail'").count() == 10
    rates = {r["gate"]: r["passed"] for r in quality_suites.mapping_rates(layer["recalls"], layer["clearances"], layer["dim"]).collect()}
    assert rates == {"recall_mapping": False, "clearance_codes": True}
    alias = spark.createDataFrame([("x",)], "raw_name string")
    assert quality_suites.event_stage_checks(layer["events"], layer["dim"], alias).count() == 12
    assert quality_suites.recall_stage_checks(layer["recalls"], layer["clearances"], layer["dim"]).count() == 12
    decision = one(quality_suites.stage_decision(quality_suites.mapping_rates(layer["recalls"], layer["clearances"], layer["dim"]), Q.check_row_count(layer["dim"], "dim")))
    assert (decision.go, decision.objections) == (False, 1)


def test_dashboard(layer):
    m = built(layer)
    cards = one(dashboard.kpi_cards(m["mart_panel_year"]))
    assert (cards.event_count_dedup, cards.recall_count, cards.class_i_recall_count) == (9, 3, 1)
    assert one(dashboard.kpi_cards(m["mart_panel_year"].limit(0))).recall_count == 0
    assert [r["year"] for r in dashboard.yearly_trend(m["mart_panel_year"]).collect()] == [2022, 2023]
    ranking = dashboard.panel_ranking(m["mart_panel_year"]).collect()
    assert [(r["review_panel"], r["year"], r["rank"]) for r in ranking] == [("AN", 2022, 1)]
    assert {r["year"] for r in dashboard.product_scatter(m["mart_product_code_year"]).collect()} == {2023}
    pareto = dashboard.pareto_products(m["mart_product_code_year"], layer["dim"]).where("review_panel = 'AN'")
    assert [(r["product_code"], r["running_events"], r["position"]) for r in pareto.orderBy("position").collect()] == [("ABC", 5, 1), ("GHI", 6, 2)]
    top = dashboard.firm_concentration(m["mart_firm_product_year"], layer["dim"], 1).collect()
    assert {(r["review_panel"], r["manufacturer"]) for r in top} == {("AN", "Cedar"), ("CV", "Dogwood")}
    assert dashboard.firm_profile(m["mart_firm_product_year"], "Cedar").count() == 3
    assert {r["year"]: r["is_partial_year"] for r in dashboard.flag_partial_year(m["mart_panel_year"], 2023).collect()} == {2022: False, 2023: True}
    assert dashboard.panel_spot_check(m["mart_panel_year"], ["CV", "??"]).count() == 2


def test_checks_of_a_table_scan_it_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", None), (1, "a", 2.0), (2, None, float("nan"))], "k int, s string, x double").write.parquet(path)
    checks = Q.table_checks(spark.read.parquet(path), "t", 2, {"s": 0.4, "x": 0.1, "y": 0.2}, key=["k", "s"], key_name="t_pk", max_rows=2)
    assert checks._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    found = {r.check_name: (r.status, r.metric_value, r.threshold) for r in checks.collect()}
    assert found == {
        "row_count_t": ("pass", 3.0, 2.0), "row_limit_t": ("fail", 3.0, 2.0), "null_rate_s": ("pass", 0.3333, 0.4), "null_rate_x": ("fail", 0.6667, 0.1),
        "null_rate_y": ("fail", None, 0.2), "uniqueness_t_pk": ("fail", 1.0, 0.0),
    }
    empty = {r.check_name: (r.status, r.details) for r in Q.table_checks(spark.read.parquet(path).limit(0), "t", key=["k"], null_columns=["k"]).collect()}
    assert empty["uniqueness_t"] == ("pass", "t: empty DataFrame") and empty["null_rate_k"][0] == "pass" and empty["row_count_t"][0] == "fail"


def test_marts_of_two_batches_equal_those_of_one_go(spark, layer, tmp_path):
    """Also where a report of the first batch gets a newer version in the second, and where a batch is repeated."""
    ties = ["event_record_id"]
    events = layer["events"].drop("is_latest_version").withColumn("mdr_report_key", F.substring("event_record_id", 1, 2))
    more = events.withColumns({"event_record_id": F.concat("event_record_id", F.lit("x")), "date_received": F.date_add("date_received", 40)}).where("event_record_id < 'E6'")
    whole = rank_versions(events.unionByName(more), tie_break=ties)
    expected = marts.build_all_marts(whole, layer["recalls"], layer["clearances"], layer["dim"], SETTINGS)
    folder = str(tmp_path / "marts")
    before = rank_versions(events, tie_break=ties)
    late = layer["recalls"].where("recall_number < 'R3'"), layer["recalls"].where("recall_number >= 'R3'")
    refresh.write_batch("1", folder, {"events": before, "recalls": late[0], "clearances": layer["clearances"]}, settings=SETTINGS)
    added, withdrawn = refresh.reranked(before, more, ties)
    assert 0 < withdrawn.count() < before.count()
    for _ in range(2):
        refresh.write_batch("2", folder, {"events": added, "recalls": late[1]}, {"events": withdrawn}, SETTINGS)
    found = refresh.marts_from_state(spark, folder, layer["dim"], SETTINGS)
    for name, mart in expected.items():
        assert [tuple(r) for r in found[name].collect()] == [tuple(r) for r in mart.collect()], name


def test_running_totals_of_one_large_group_are_spread(spark):
    """All products on one count and one prefix: no run of the group holds more than a share of it."""
    rows = spark.range(4000).selectExpr("'p' AS g", "concat('AA', lpad(CAST(id AS STRING), 5, '0')) AS code", "7 AS n").unionByName(
        spark.createDataFrame([(None, "x", 1), (None, "y", 2)], "g string, code string, n int")
    )
    found = running_by_range(rows, "g", [F.desc("n"), F.asc("code")], "place", {"total": "n"})
    got = found.collect()
    assert sorted((r.place, r.code, r.total) for r in got if r.g) == [(k + 1, f"AA{k:05}", 7 * (k + 1)) for k in range(4000)]
    assert sorted((r.place, r.code, r.total) for r in got if not r.g) == [(1, "y", 2), (2, "x", 3)]
    ranges = rows.repartitionByRange(8, F.col("g"), F.desc("n"), F.asc("code")).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ranges) < 2000
