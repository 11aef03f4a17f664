"""Clean layer: raw records to typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline import schemas
from faultline.config import DEFAULTS, Settings
from faultline.fixed_values import DEATH_CODES, SERIOUS_CODES
from faultline.functions import json_fields as J
from faultline.functions.dates import compact_date, mixed_date
from faultline.functions.text import applicant_key, outcome_code, recall_class, without_trailing_dashes, yes_no
from faultline.operators.counts import in_years
from faultline.operators.dedup import keep_first, rank_versions
from faultline.operators.joins import fill_from_lookup
from faultline.operators.ordered import HOT_ROWS
from faultline.sources.records import file_order, parsed

_PLACE = ["_file", "pos"]


# The fields of a report. A variant holds what may be a string, a list or missing.
_REPORT = (
    "mdr_report_key string, date_received string, event_type variant, adverse_event_flag string, "
    "product_problem_flag string, source_type variant, remedial_action variant, "
    "device array<struct<device_report_product_code string, brand_name string, generic_name string, "
    "manufacturer_d_name string>>, patient array<struct<sequence_number_outcome variant>>"
)


def outcome_codes(patients: Column) -> Column:
    """All outcome codes of a report's patients, as a flat list; nulls drop out."""
    per_patient = F.transform(
        F.coalesce(patients, F.array()),
        lambda p: F.transform(
            F.coalesce(J.text_list(p["sequence_number_outcome"], "$"), F.array().cast("array<string>")), outcome_code
        ),
    )
    return F.array_compact(F.flatten(per_patient))


def _any_of(codes: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(codes, F.array(*[F.lit(c) for c in wanted]))


def flatten_devices(records: DataFrame) -> DataFrame:
    """One row per device of a report, with the report's outcome flags.

    Reports without devices stay as one row with a null ``device_index``: they add no device row but their
    outcomes still count for other versions of the report. Every record is parsed once: what depends on the
    key is decided inside the generator, as a filter would be pushed down and parse again.
    """
    r = F.col("r")
    read = records.select(file_order(F.col("file")).alias("_file"), "pos", F.from_json("record", _REPORT).alias("r"))
    source = F.coalesce(
        F.try_variant_get(r["source_type"], "$", "array<string>"),
        F.array(F.when(r["source_type"].isNull(), F.lit("")).otherwise(J.text(r["source_type"], "$"))),
    )
    reports = read.select(
        "_file",
        "pos",
        r["mdr_report_key"].alias("mdr_report_key"),
        r["date_received"].alias("date_received"),
        F.when(r["event_type"].isNull(), F.lit("")).otherwise(J.text(r["event_type"], "$")).alias("event_type"),
        r["adverse_event_flag"].alias("adverse_event_flag"),
        r["product_problem_flag"].alias("product_problem_flag"),
        F.when(F.size(source) > 0, F.element_at(source, 1)).otherwise(F.lit("")).alias("source_type"),
        J.is_filled(r["remedial_action"], "$").alias("remedial_action_flag"),
        outcome_codes(r["patient"]).alias("_outcomes"),
        r["device"].alias("_devices"),
    )
    devices = F.when(F.size("_devices") > 0, F.col("_devices")).otherwise(F.array(F.lit(None)))
    rows = reports.select(
        *[c for c in reports.columns if c != "_devices"],
        F.posexplode(F.when(F.col("mdr_report_key") != "", devices)).alias("_index", "d"),
    )
    d = F.col("d")
    index = F.when(d.isNotNull(), F.col("_index"))
    return rows.select(
        *[c for c in rows.columns if c not in ("_outcomes", "_index", "d")],
        index.alias("device_index"),
        F.concat_ws("_", "mdr_report_key", index.cast("string")).alias("event_record_id"),
        d["device_report_product_code"].alias("product_code"),
        d["brand_name"].alias("brand_name"),
        d["generic_name"].alias("generic_name"),
        d["manufacturer_d_name"].alias("manufacturer_d_name"),
        F.coalesce(F.col("event_type") == "Malfunction", F.lit(False)).alias("has_malfunction"),
        _any_of(F.col("_outcomes"), DEATH_CODES).alias("has_death"),
        _any_of(F.col("_outcomes"), SERIOUS_CODES).alias("has_serious_injury"),
    )


def clean_adverse_events(records: DataFrame, *, grain: str = "device", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Raw report records to one row per report version and device.

    One shuffle on the report key serves both the outcome flags (true if true in any version) and the
    version rank.
    """
    # Out of a generator, whose columns are not pruned: all uses read the same columns, so a shuffle that spread the records
    # is made once and read by each of them.
    records = records.select(F.inline(F.array(F.struct("file", "pos", "record"))))
    typed = flatten_devices(records).withColumns(
        {
            "date_received": compact_date(F.col("date_received")),
            "adverse_event_flag": yes_no(F.col("adverse_event_flag")),
            "product_problem_flag": yes_no(F.col("product_problem_flag")),
        }
    )
    flags = ["has_death", "has_serious_injury"]
    # Hot reports are looked for in the records: only the key is read, nothing else is parsed.
    keys = records.select(F.get_json_object("record", "$.mdr_report_key").alias("mdr_report_key"))
    ranked = rank_versions(
        typed, tie_break=["_file", "pos", "device_index"], any_of=flags,
        present=F.col("device_index").isNotNull(), hot_rows=hot_rows, keys=keys,
    ).where("device_index IS NOT NULL")
    if grain == "report":
        ranked = rank_versions(ranked.drop("followup_rank", "is_latest_version"), grain="report", hot_rows=hot_rows)
    dated = ranked.withColumn("event_year", F.year("date_received"))
    return schemas.conform(dated, schemas.EVENT)


def recall_code_lookup(records: DataFrame) -> DataFrame:
    """(product_res_number, product_code): the last record wins, trailing dashes go."""
    pairs = parsed(records, "product_res_number string, product_code string")
    usable = pairs.where("product_res_number <> '' AND product_code <> ''")
    last = F.max_by(without_trailing_dashes(F.col("product_code")), F.struct(*_PLACE))
    return usable.groupBy("product_res_number").agg(last.alias("product_code"))


def dated(rows: DataFrame, date: str, year: str) -> DataFrame:
    """``rows`` with ``date`` read from its text, and its ``year``.

    The row goes through a generator as a whole. A filter on the year would otherwise be pushed down to the scan with the
    parsing of the record, and of its date, copied into every branch.
    """
    once = rows.select(F.explode(F.array(F.struct(*rows.columns, mixed_date(F.col(date)).alias("_day")))).alias("_row"))
    fields = [F.col("_row._day" if c == date else f"_row.{c}").alias(c) for c in rows.columns]
    return once.select(*fields, F.year("_row._day").alias(year))


def date_readability(records: DataFrame, field: str, settings: Settings = DEFAULTS) -> DataFrame:
    """One row on what the year window does to raw records: how many there are, lack the date, have one that cannot be read,
    lie outside the window, and are left. Cleaning drops all but the last silently."""
    rows = dated(parsed(records, f"{field} string").withColumn("_text", F.col(field)), field, "_year")
    filled, read = F.coalesce(F.length("_text") > 0, F.lit(False)), F.col("_year").isNotNull()
    inside = F.coalesce(F.col("_year").between(settings.window_first_year, settings.window_last_year), F.lit(False))
    return rows.agg(
        F.count("*").alias("records"), F.count_if(~filled).alias("missing"), F.count_if(filled & ~read).alias("unreadable"),
        F.count_if(read & ~inside).alias("outside"), F.count_if(inside).alias("kept"),
    )


_RECALL = (
    "recall_number string, recall_initiation_date string, classification string, openfda variant, "
    "product_description string, recalling_firm string, reason_for_recall string, status string, "
    "voluntary_mandated string"
)


def clean_recalls(records: DataFrame, lookup: DataFrame | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Raw recall records to one row per recall number. ``lookup`` fills missing product codes."""
    rows = dated(parsed(records, _RECALL), "recall_initiation_date", "recall_year")
    # Window and keep-first come before the lookup join: fewer rows meet it, and filling changes neither.
    kept = keep_first(
        in_years(rows, "recall_year", settings.window_first_year, settings.window_last_year), ["recall_number"], _PLACE
    ).withColumns({"recall_class": recall_class(F.col("classification")), "product_code": J.first_code(F.col("openfda"))})
    filled = fill_from_lookup(kept, lookup, "product_code", "recall_number", "product_res_number", "product_code")
    return schemas.conform(filled, schemas.RECALL)


_CLEARANCE = (
    "k_number string, decision_date string, product_code string, openfda variant, applicant string, "
    "advisory_committee string, clearance_type string, decision_code string"
)


def clean_clearances(records: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Raw clearance records to one row per clearance number.

    The top-level product code counts unless it is missing or empty, else the nested one.
    """
    rows = dated(parsed(records, _CLEARANCE), "decision_date", "decision_year")
    kept = keep_first(
        in_years(rows, "decision_year", settings.window_first_year, settings.window_last_year), ["k_number"], _PLACE
    )
    code = F.coalesce(F.nullif("product_code", F.lit("")), J.first_code(F.col("openfda")))
    named = kept.withColumns({"product_code": code, "applicant_std": applicant_key(F.col("applicant"))})
    return schemas.conform(named, schemas.CLEARANCE)


_CLASSIFICATION = ", ".join(f"{name} string" for name in schemas.DIM_PRODUCT.names)


def build_dim_product(records: DataFrame) -> DataFrame:
    """Raw classification records to one row per product code."""
    first = keep_first(parsed(records, _CLASSIFICATION), ["product_code"], _PLACE)
    flags = {c: yes_no(F.col(c)) for c in ("implant_flag", "life_sustain_support_flag")}
    return schemas.conform(first.withColumns(flags), schemas.DIM_PRODUCT)
