import json
from datetime import date

import pytest

from faultline import schemas
from faultline.config import Settings
from faultline.plans import clean


def raw(spark, *items, file="/in/a"):
    data = [(file, 0, i, json.dumps(x)) for i, x in enumerate(items)]
    return spark.createDataFrame(data, schemas.RAW_RECORD)


def report(key="1", day="20230115", devices=1, **fields):
    record = {"mdr_report_key": key, "date_received": day, "event_type": "Malfunction", "adverse_event_flag": "Y", "product_problem_flag": "N",
              "source_type": "Manufacturer report", **fields}
    if devices:
        record["device"] = [{"device_report_product_code": f"P{i}", "brand_name": "B", "generic_name": "G", "manufacturer_d_name": "M"} for i in range(devices)]
    return {k: v for k, v in record.items() if v is not ...}


def test_flatten(spark):
    records = raw(
        spark, report("1", devices=2), report("2", devices=0), report("", devices=1), report(None, devices=1),
        report("3", source_type=["Company", "User"], event_type=..., remedial_action=["Recall"]),
        report("4", source_type=[], event_type=None, remedial_action=[]), report("5", source_type=..., device=[], devices=0), report("6", source_type=None, remedial_action="Fix"),
    )
    flat = clean.flatten_devices(records)
    found = {r["event_record_id"]: r for r in flat.where("device_index IS NOT NULL").collect()}
    assert sorted(found) == ["1_0", "1_1", "3_0", "4_0", "6_0"]
    assert found["1_1"]["product_code"] == "P1" and found["1_0"]["has_malfunction"]
    assert (found["3_0"]["source_type"], found["3_0"]["event_type"], found["3_0"]["remedial_action_flag"]) == ("Company", "", True)
    assert (found["4_0"]["source_type"], found["4_0"]["event_type"], found["4_0"]["remedial_action_flag"], found["4_0"]["has_malfunction"]) == ("", None, False, False)
    assert (found["6_0"]["source_type"], found["6_0"]["remedial_action_flag"]) == (None, True)
    assert sorted(r["mdr_report_key"] for r in flat.where("device_index IS NULL").collect()) == ["2", "5"]


@pytest.fixture(scope="module")
def outcome_cases():
    return [
        ([["D"]], True, False), ([["L"]], False, True), (None, False, False), ([["H"], ["D"]], True, True), (["D"], True, False), ([["Death"]], True, False),
        ([[" D"]], True, False), ([["Hospitalization", "Life Threatening"]], False, True), ([[" H"]], False, True), ([["Death"], [" L", "Other"]], True, True),
        ([["Disability"]], False, True), ([["Congenital Anomaly"]], False, True), ([["Required Intervention"]], False, False), ([[""]], False, False),
        ([[None, "d"]], True, False), ([None], False, False), ([[]], False, False),
    ]


def test_outcomes(spark, outcome_cases):
    items = []
    for i, (patients, _, _) in enumerate(outcome_cases):
        items.append(report(str(i), patient=... if patients is None else [{"sequence_number_outcome": p} for p in patients]))
    found = {r["mdr_report_key"]: (r["has_death"], r["has_serious_injury"]) for r in clean.flatten_devices(raw(spark, *items)).collect()}
    assert found == {str(i): case[1:] for i, case in enumerate(outcome_cases)}


@pytest.mark.parametrize("hot_rows", [0, 10**6])
def test_clean_adverse_events(spark, hot_rows):
    records = raw(
        spark, report("1", "20230101", 2), report("1", "20230301", 2, patient=[{"sequence_number_outcome": ["H"]}]),
        report("1", "20230401", 0, patient=[{"sequence_number_outcome": "D"}]), report("2", "BADDATE", 1, adverse_event_flag="x"), report("2", "20220301", 1),
    )
    events = clean.clean_adverse_events(records, hot_rows=hot_rows)
    assert [(f.name, f.dataType) for f in events.schema] == [(f.name, f.dataType) for f in schemas.EVENT]
    found = sorted(((r["mdr_report_key"], r["followup_rank"], r["event_record_id"], r["date_received"], r["is_latest_version"]) for r in events.collect()), key=repr)
    assert found == [
        ("1", 1, "1_0", date(2023, 3, 1), True), ("1", 2, "1_1", date(2023, 3, 1), False), ("1", 3, "1_0", date(2023, 1, 1), False),
        ("1", 4, "1_1", date(2023, 1, 1), False), ("2", 1, "2_0", date(2022, 3, 1), True), ("2", 2, "2_0", None, False),
    ]
    # Outcomes count for every version, also those of a version without devices.
    assert {(r["mdr_report_key"], r["has_death"], r["has_serious_injury"]) for r in events.collect()} == {("1", True, True), ("2", False, False)}
    assert {r["adverse_event_flag"] for r in events.where("date_received IS NULL").collect()} == {None}
    latest = clean.clean_adverse_events(records, grain="report", hot_rows=hot_rows).where("is_latest_version")
    assert sorted(r["event_record_id"] for r in latest.collect()) == ["1_0", "1_1", "2_0"]


def test_empty_inputs_keep_the_schema(spark):
    nothing = spark.createDataFrame([], schemas.RAW_RECORD)
    for build, schema in ((clean.clean_adverse_events, schemas.EVENT), (clean.clean_recalls, schemas.RECALL),
                          (clean.clean_clearances, schemas.CLEARANCE), (clean.build_dim_product, schemas.DIM_PRODUCT)):
        df = build(nothing)
        assert df.columns == schema.names and df.count() == 0


def recall(number="Z-1", day="20230115", codes=("ABC",), **fields):
    return {"recall_number": number, "recall_initiation_date": day, "classification": "Class II", "recalling_firm": "F", **fields,
            **({} if codes is None else {"openfda": {"product_code": list(codes)}})}


def test_clean_recalls(spark):
    records = raw(
        spark, recall("A"), recall("A", codes=("XYZ",)), recall("B", "2023-01-15", None), recall("C", "20150101"), recall("D", "BADDATE"),
        recall("E", codes=()), recall("F", codes=None, openfda={}), recall("G", classification="none"), recall("H", codes=None, openfda="text"),
    )
    lookup = clean.recall_code_lookup(
        raw(spark, {"product_res_number": "B", "product_code": "OLD"}, {"product_res_number": "B", "product_code": "NEW--"}, {"product_res_number": "A", "product_code": "NO"},
            {"product_res_number": "E", "product_code": "---"}, {"product_res_number": "F", "product_code": ""}, {"product_code": "Q"})
    )
    found = {r["recall_number"]: r for r in clean.clean_recalls(records, lookup).collect()}
    assert sorted(found) == ["A", "B", "E", "F", "G", "H"]
    assert {k: v["product_code"] for k, v in found.items()} == {"A": "ABC", "B": "NEW", "E": "", "F": None, "G": "ABC", "H": None}
    assert found["B"]["recall_initiation_date"] == date(2023, 1, 15) and found["B"]["recall_year"] == 2023
    assert (found["A"]["recall_class"], found["G"]["recall_class"]) == ("II", None)
    without = {r["recall_number"]: r["product_code"] for r in clean.clean_recalls(records).collect()}
    assert without["B"] is None


def test_clean_clearances(spark):
    def item(number, **fields):
        return {"k_number": number, "decision_date": "2021-05-01", "applicant": "Acme, Inc.", **fields}

    records = raw(
        spark, item("K1", product_code="ABC", openfda={"product_code": ["N"]}), item("K1", product_code="LATER"), item("K2", product_code="", openfda={"product_code": ["N"]}),
        item("K3", applicant=None), item("K4", decision_date="2031-01-01"), item("K5", applicant=""),
    )
    found = {r["k_number"]: r for r in clean.clean_clearances(records, Settings(window_first_year=2020, window_last_year=2022)).collect()}
    assert sorted(found) == ["K1", "K2", "K3", "K5"]
    assert [found[k]["product_code"] for k in ("K1", "K2", "K3")] == ["ABC", "N", None]
    assert [found[k]["applicant_std"] for k in ("K1", "K3", "K5")] == ["ACME", None, None]


def test_build_dim_product(spark):
    records = raw(spark, {"product_code": "A", "device_name": "first", "implant_flag": "Y", "extra": 1}, {"product_code": "A", "device_name": "second"},
                  {"product_code": "B", "implant_flag": "?", "life_sustain_support_flag": "N"})
    found = {r["product_code"]: r for r in clean.build_dim_product(records).collect()}
    assert found["A"]["device_name"] == "first" and found["A"]["implant_flag"] is True
    assert found["B"]["implant_flag"] is None and found["B"]["life_sustain_support_flag"] is False and found["B"]["device_name"] is None


def test_no_python_in_the_clean_layer(spark):
    plan = clean.clean_adverse_events(raw(spark, report()))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan


def test_date_readability(spark):
    days = ["20220401", "2022-04-02", "BADDATE", "", None, "2001-01-01", "1/2/2023"]
    rows = [("f.json", 0, k, json.dumps({"d": d} if d is not None else {})) for k, d in enumerate(days)]
    found = clean.date_readability(spark.createDataFrame(rows, schemas.RAW_RECORD), "d")
    assert tuple(found.first()) == (7, 2, 1, 1, 3)


def test_records_are_spread_once(spark):
    """The key scan, the hot branch and the rows read one shuffle of the records."""
    records = raw(spark, report()).repartition("file")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = clean.clean_adverse_events(records)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    by_file = [line for line in plan.splitlines() if "hashpartitioning(file" in line]
    assert len([line for line in by_file if "ReusedExchange" not in line]) == 1 and len(by_file) > 1, plan
