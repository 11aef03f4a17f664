import json
import zipfile

from faultline.config import Settings
from faultline.plans import quality_suites
from faultline.plans.pipeline import run_pipeline


def put(root, path, content):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps(content))


def test_raw_folders_to_app_tables(spark, tmp_path):
    raw = tmp_path / "raw"
    reports = [
        {"mdr_report_key": str(i // 2), "date_received": f"2022030{1 + i % 2}", "event_type": "Injury", "source_type": ["Company"],
         "device": [{"device_report_product_code": "ABC" if i % 3 else "DEF", "manufacturer_d_name": "Lindmoor Inc" if i % 2 else "LINDMOOR LLC"}],
         "patient": [{"sequence_number_outcome": ["Death" if i == 0 else "O"]}]}
        for i in range(12)
    ]
    (raw / "adverse_events").mkdir(parents=True)
    with zipfile.ZipFile(raw / "adverse_events" / "q1.zip", "w") as archive:
        archive.writestr("data.json", json.dumps({"meta": {}, "results": reports}))
    put(raw, "classification/classification_all.json", {"results": [
        {"product_code": "ABC", "device_name": "Tidal Hinge Rack", "review_panel": "AN", "device_class": "2"},
        {"product_code": "DEF", "device_name": "Quarry Lamp", "review_panel": "CV", "device_class": "3"}]})
    put(raw, "recalls/2022/recalls_2022.json", {"results": [
        {"recall_number": "R1", "recall_initiation_date": "20220401", "classification": "Class I", "product_description": "Tidal Hinge Rack Lot No. 5", "recalling_firm": "Lindmoor Inc"},
        {"recall_number": "R2", "recall_initiation_date": "2022-04-02", "classification": "Class II", "product_description": "??", "recalling_firm": "Lindmoor Inc"}]})
    put(raw, "recall_product_codes/recall_product_codes_2022.json", [{"product_res_number": "R2", "product_code": "DEF-"}])
    put(raw, "clearances/2022/clearances_2022.json", {"results": [
        {"k_number": f"K{i}", "decision_date": "2022-02-01", "product_code": "ABC", "applicant": "Lindmoor"} for i in range(11)]})

    out = run_pipeline(spark, str(raw), str(tmp_path / "out"), Settings())
    panels = {r["review_panel"]: r for r in out["app_overview"].collect()}
    assert panels["AN"]["recall_count"] == 1 and panels["CV"]["recall_count"] == 1
    assert panels["AN"]["event_count_raw"] + panels["CV"]["event_count_raw"] == 12
    assert panels["AN"]["event_count_dedup"] + panels["CV"]["event_count_dedup"] == 6
    assert panels["AN"]["death_related_reports"] + panels["CV"]["death_related_reports"] == 2
    assert panels["AN"]["events_per_100_clearances"] is not None and panels["CV"]["events_per_100_clearances"] is None

    alias = spark.read.parquet(str(tmp_path / "out/clean/dim_manufacturer_alias.parquet")).collect()
    assert {r["standardized_name"] for r in alias} == {"LINDMOOR LLC"}
    mapped = {r["recall_number"]: r for r in spark.read.parquet(str(tmp_path / "out/clean/recall_mapped.parquet")).collect()}
    assert mapped["R1"]["mapping_quality"] == "high_confidence_text_match" and mapped["R1"]["matched_product_code"] == "ABC"
    assert mapped["R2"]["mapping_quality"] == "exact_product_code_match" and mapped["R2"]["product_code"] == "DEF"

    assert out["qa_summary"].where("check_name LIKE 'file_exists%'").count() == 0
    stored = quality_suites.build_qa_summary(
        spark, str(tmp_path / "out/clean"), str(tmp_path / "out/mart"), str(tmp_path / "out/app"), str(tmp_path / "out/qa")
    )
    assert stored.where("check_name LIKE 'file_exists%'").count() == 0

    # A second run lands nothing twice.
    again = run_pipeline(spark, str(raw), str(tmp_path / "out"), Settings())
    assert {r["review_panel"]: r["event_count_raw"] for r in again["app_overview"].collect()} == {k: v["event_count_raw"] for k, v in panels.items()}
