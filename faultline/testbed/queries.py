"""Every operator as a query over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.functions import dates, kpis, text
from faultline.functions import json_fields as J
from faultline.functions.registry import register_functions
from faultline.functions.similarity import (
    choices_above,
    ratio,
    sorted_form,
    token_set_ratio,
    token_sort_ratio,
)
from faultline.operators import counts as C
from faultline.operators import dedup, joins, quality
from faultline.operators.best_match import best_match
from faultline.plans import clean, dashboard, exports, mapping, marts, quality_suites
from faultline.sources import partition_index, records
from faultline.testbed.adapters import SETTINGS, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SMALL_CAPS = replace(SETTINGS, category_rows=500, manufacturer_rows=300, overview_rows=5_000)


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


# Marts


@query
def mart_panel_year(t: Tables) -> DataFrame:
    return marts.mart_panel_year(t.events(), t.recalls(), t.clearances(), t.dim(), SETTINGS)


@query
def mart_panel_year_guarded(t: Tables) -> DataFrame:
    """With minimums in the middle of the data, so that both branches of the guards occur."""
    guarded = replace(SETTINGS, min_clearances=60, min_recalls=12)
    return marts.mart_panel_year(t.events(), t.recalls(), t.clearances(), t.dim(), guarded)


@query
def mart_product_year(t: Tables) -> DataFrame:
    return marts.mart_product_year(t.events(), t.recalls(), t.clearances(), replace(SETTINGS, min_clearances=1, min_recalls=1))


@query
def mart_firm_product_year(t: Tables) -> DataFrame:
    return marts.mart_firm_product_year(t.events(), t.recalls(), t.dim(), SETTINGS)


@query
def all_marts(t: Tables) -> DataFrame:
    """All rows of the three marts, built from one set of firm counts."""
    built = marts.build_all_marts(t.events(), t.recalls(), t.clearances(), t.dim(), SETTINGS)
    tagged = [df.withColumn("mart", F.lit(name)) for name, df in built.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


@query
def mart_firm_product_year_aliased(t: Tables) -> DataFrame:
    """Manufacturer names replaced through an alias table that merges every ten suppliers."""
    alias = t.read("supplier").selectExpr(
        "s_name AS raw_name", "concat('Group ', CAST(s_suppkey DIV 10 AS STRING)) AS standardized_name"
    )
    return marts.mart_firm_product_year(t.events(), t.recalls(), t.dim(), SETTINGS, alias=alias)


# Aggregations


@query
def events_by_panel_year(t: Tables) -> DataFrame:
    return C.to_panels(C.event_counts(t.events(), ["product_code"]), t.dim())


@query
def recalls_by_panel_year(t: Tables) -> DataFrame:
    return C.to_panels(C.recall_counts(t.recalls(), [C.recall_code().alias("product_code")]), t.dim())


@query
def clearances_by_panel_year(t: Tables) -> DataFrame:
    return C.to_panels(C.clearance_counts(t.clearances(), ["product_code"]), t.dim())


@query
def events_by_product_year(t: Tables) -> DataFrame:
    return C.event_counts(t.events(), ["product_code"]).select("product_code", "year", "event_count_dedup")


@query
def recalls_by_product_year(t: Tables) -> DataFrame:
    counts = C.recall_counts(t.recalls(), [C.recall_code().alias("product_code")])
    return counts.select("product_code", "year", "recall_count", "class_i_recall_count")


@query
def clearances_by_product_year(t: Tables) -> DataFrame:
    return C.clearance_counts(t.clearances(), ["product_code"])


@query
def events_by_firm_product_year(t: Tables) -> DataFrame:
    return marts.firm_counts(t.events(), t.recalls(), SETTINGS)[0].select("manufacturer", "product_code", "year", "event_count_dedup")


@query
def recalls_by_firm_product_year(t: Tables) -> DataFrame:
    counts = marts.firm_counts(t.events(), t.recalls(), SETTINGS)[1]
    return counts.select("manufacturer", "product_code", "year", "recall_count", "class_i_recall_count")


@query
def year_window(t: Tables) -> DataFrame:
    return C.in_years(t.recalls(), "recall_year", 1997, 1998).select("recall_number", "recall_year", "recall_class")


@query
def kpi_guards(t: Tables) -> DataFrame:
    """All five KPIs on counts per supplier and year, with thresholds that cut through the data."""
    lines = t.read("lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year"))
    base = lines.agg(
        F.count("*").alias("events"),
        F.count_if(F.col("l_linenumber") == 7).alias("recalls"),
        F.count_if(F.col("l_returnflag") == "R").alias("clearances"),
        F.count_if((F.col("l_linenumber") == 7) & (F.col("l_tax") == 0)).alias("class_i"),
    )
    return base.select(
        "l_suppkey",
        "year",
        kpis.events_per_100_clearances(F.col("events"), F.col("clearances"), 25).alias("events_per_100_clearances"),
        kpis.recalls_per_100_clearances(F.col("recalls"), F.col("clearances"), 25).alias("recalls_per_100_clearances"),
        kpis.recall_to_event_ratio(F.col("events"), F.col("recalls")).alias("recall_to_event_ratio"),
        kpis.severe_recall_share(F.col("class_i"), F.col("recalls")).alias("severe_recall_share"),
        kpis.firm_share(F.col("recalls"), F.col("class_i")).alias("firm_share"),
    )


@query
def firm_share_product(t: Tables) -> DataFrame:
    mart = marts.mart_firm_product_year(t.events(), t.recalls(), t.dim(), SETTINGS)
    return mart.select("manufacturer", "product_code", "year", "firm_share_within_product")


@query
def firm_share_panel(t: Tables) -> DataFrame:
    mart = marts.mart_firm_product_year(t.events(), t.recalls(), t.dim(), SETTINGS)
    return mart.select("manufacturer", "product_code", "year", "firm_share_within_panel")


@query
def facet_counts(t: Tables) -> DataFrame:
    return C.facet_counts(t.recalls(), "product_code", F.col("recall_year") >= 1997, limit=1000)


@query
def filtered_count(t: Tables) -> DataFrame:
    return C.filtered_count(t.recalls(), F.col("recall_class") == "II")


@query
def value_distribution(t: Tables) -> DataFrame:
    return C.value_distribution(t.recalls(), "mapping_quality")


@query
def name_frequency(t: Tables) -> DataFrame:
    return C.name_frequency(t.unranked_events(), "manufacturer_d_name")


@query
def panel_totals_top15(t: Tables) -> DataFrame:
    mart = marts.mart_panel_year(t.events(), t.recalls(), t.clearances(), t.dim(), SETTINGS)
    return C.top_totals(mart, "review_panel", "event_count_dedup", 15)


@query
def distinct_counts(t: Tables) -> DataFrame:
    return C.distinct_counts(t.recalls(), ["recall_number", "product_code", "recalling_firm"])


@query
def seriousness(t: Tables) -> DataFrame:
    return C.seriousness(t.events())


@query
def rows_per_year(t: Tables) -> DataFrame:
    return C.rows_per_year(t.events().where("is_latest_version"), "event_year")


@query
def code_set_overlap(t: Tables) -> DataFrame:
    return C.overlap(t.events(), "product_code", t.dim(), "product_code")


@query
def distinct_values(t: Tables) -> DataFrame:
    return dedup.distinct_values(t.recalls(), "product_code")


# Clean layer


@query
def version_rank(t: Tables) -> DataFrame:
    return t.events().select(
        "mdr_report_key", "date_received", "l_linenumber", "l_partkey", "l_suppkey", "followup_rank", "is_latest_version"
    )


@query
def version_rank_split(t: Tables) -> DataFrame:
    """The same ranks with every key treated as hot if its bucket is; here the limit is a handful of rows."""
    return t.events(hot_rows=1).select(
        "mdr_report_key", "date_received", "l_linenumber", "l_partkey", "l_suppkey", "followup_rank", "is_latest_version"
    )


@query
def version_rank_report_grain(t: Tables) -> DataFrame:
    ranked = dedup.rank_versions(t.unranked_events(), grain="report")
    return ranked.select("mdr_report_key", "date_received", "l_linenumber", "l_partkey", "followup_rank", "is_latest_version")


@query
def dedup_report(t: Tables) -> DataFrame:
    return dedup.dedup_report(t.events())


@query
def keep_first_dedup(t: Tables) -> DataFrame:
    lines = t.read("lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_returnflag")
    keyed = lines.withColumn("code", F.when(F.col("l_partkey") % 5 != 0, F.col("l_partkey")))
    return dedup.keep_first(keyed.drop("l_partkey"), ["code"], ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"])


@query
def lookup_fill(t: Tables) -> DataFrame:
    lookup = clean.recall_code_lookup(t.lookup_records())
    recalls = t.recalls().select("recall_number", "recall_year", "product_code", "recalling_firm")
    return joins.fill_from_lookup(recalls, lookup, "product_code", "recall_number", "product_res_number", "product_code")


@query
def recall_code_lookup(t: Tables) -> DataFrame:
    return clean.recall_code_lookup(t.lookup_records())


@query
def membership_flag(t: Tables) -> DataFrame:
    flagged = joins.flag_members(t.clearances(), "product_code", t.dim(), "product_code", "known_code")
    return flagged.select("k_number", "product_code", "known_code")


@query
def fill_flags(t: Tables) -> DataFrame:
    """Report-level flags joined back to the clearances; reports without flags count as false."""
    flags = t.unranked_events().where("has_death OR has_serious_injury").groupBy(F.col("mdr_report_key").alias("k_number")).agg(
        F.bool_or("has_death").alias("has_death"), F.bool_or("has_serious_injury").alias("has_serious_injury")
    )
    clearances = t.clearances().select("k_number", "product_code", "decision_year")
    return joins.fill_flags(clearances, flags, "k_number", ["has_death", "has_serious_injury"])


@query
def dimension_enrichment(t: Tables) -> DataFrame:
    codes = t.clearances().select("k_number", F.when(F.col("product_code") != "7", F.col("product_code")).alias("product_code"))
    return joins.enrich(codes, t.dim(), "product_code", ["device_name", "review_panel"])


@query
def normalize_company_name(t: Tables) -> DataFrame:
    return t.companies().select("s_suppkey", text.company_key(F.col("company")).alias("company_key"))


@query
def standardize_applicant(t: Tables) -> DataFrame:
    named = t.companies().withColumn("company", F.expr("CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE company END"))
    return named.select("s_suppkey", text.applicant_key(F.col("company")).alias("applicant_std"))


@query
def denoise_description(t: Tables) -> DataFrame:
    noisy = t.described_recalls().select(
        "recall_number",
        F.concat(
            "product_description",
            F.expr(
                "CASE CAST(substring_index(recall_number, '-', 1) AS BIGINT) % 6 WHEN 0 THEN ' UDI: (01)10840619083929(17)220729' "
                "WHEN 1 THEN ', REF (RPN): HNB5.0-38 kit' WHEN 2 THEN ' 2.5-3.9x124mm, 16mm stop' WHEN 3 THEN ' BG7045 tip Version 1.13' "
                "WHEN 4 THEN ' Part Number: 45-A p/n X1 end' ELSE '' END"
            ),
        ).alias("d"),
    )
    return noisy.select("recall_number", text.denoise_description(F.col("d")).alias("cleaned"))


@query
def recall_class_extract(t: Tables) -> DataFrame:
    lines = t.read("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey",
        "CASE l_linenumber WHEN 1 THEN 'Class I' WHEN 2 THEN 'Class  II' WHEN 3 THEN 'is Class III.' WHEN 4 THEN 'Class IV' "
        "WHEN 5 THEN 'class II' WHEN 6 THEN '' END AS classification",
    )
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", text.recall_class(F.col("classification")).alias("recall_class"))


def _raw_dates(t: Tables) -> DataFrame:
    return t.read("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey",
        "CASE WHEN l_linenumber = 7 THEN 'BADDATE' WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_shipdate AS DATE) AS STRING) "
        "ELSE replace(CAST(CAST(l_shipdate AS DATE) AS STRING), '-', '') END AS raw_date",
    )


@query
def mixed_dates(t: Tables) -> DataFrame:
    """The day of every line item in one of twelve spellings, chosen by part; every seventh line has none."""
    layouts = [
        "yyyyMMdd", "yyyy-MM-dd", "M/d/yyyy", "MM-dd-yyyy", "yyyy.MM.dd", "yyyyMMdd'T'HHmmss", "d MMMM yyyy", "MMMM d yyyy", "MM/dd/yy",
        "yyyy/MM/dd", "MMM d, yyyy", "d MMM yyyy",
    ]
    spelled = F.when(F.col("l_linenumber") == 7, "BADDATE")
    for k, layout in enumerate(layouts):
        spelled = spelled.when(F.col("l_partkey") % len(layouts) == k, F.date_format("l_shipdate", layout))
    day = dates.mixed_date(F.col("raw_date"))
    return t.read("lineitem").withColumn("raw_date", spelled).select("l_orderkey", "l_linenumber", "l_partkey", day.alias("day"), F.year(day).alias("year"))


@query
def strict_dates(t: Tables) -> DataFrame:
    day = dates.compact_date(F.col("raw_date"))
    return _raw_dates(t).select("l_orderkey", "l_linenumber", "l_partkey", day.alias("day"), F.year(day).alias("year"))


@query
def yn_flags(t: Tables) -> DataFrame:
    lines = t.read("lineitem").withColumn("f", F.expr("CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' ELSE 'n' END"))
    return lines.groupBy("l_orderkey", text.yes_no(F.col("f")).alias("flag")).agg(F.count("*").alias("n"))


@query
def outcome_codes(t: Tables) -> DataFrame:
    raw = F.expr(
        "CASE l_linenumber WHEN 1 THEN ' d' WHEN 2 THEN 'Life Threatening' WHEN 3 THEN ' DEATH ' WHEN 4 THEN 'unheard of ' "
        "WHEN 5 THEN '' WHEN 6 THEN 'Congenital Anomaly' END"
    )
    return t.read("lineitem").groupBy("l_linenumber", text.outcome_code(raw).alias("code")).agg(F.count("*").alias("n"))


@query
def outcome_flags(t: Tables) -> DataFrame:
    """Outcome flags per report, any version counting."""
    flat = clean.flatten_devices(t.event_records())
    return flat.groupBy("mdr_report_key").agg(F.bool_or("has_death").alias("has_death"), F.bool_or("has_serious_injury").alias("has_serious_injury"))


@query
def flatten_devices(t: Tables) -> DataFrame:
    flat = clean.flatten_devices(t.event_records()).where("device_index IS NOT NULL")
    return flat.select(
        "event_record_id", "mdr_report_key", "date_received", "product_code", "brand_name", "generic_name", "manufacturer_d_name",
        "event_type", "has_malfunction", "source_type", "remedial_action_flag",
    )


@query
def clean_adverse_events(t: Tables) -> DataFrame:
    return clean.clean_adverse_events(t.event_records())


@query
def clean_recalls(t: Tables) -> DataFrame:
    lookup = clean.recall_code_lookup(t.lookup_records())
    return clean.clean_recalls(t.recall_records(), lookup, SETTINGS)


@query
def clean_clearances(t: Tables) -> DataFrame:
    return clean.clean_clearances(t.clearance_records(), SETTINGS)


@query
def build_dim_product(t: Tables) -> DataFrame:
    return clean.build_dim_product(t.classification_records())


@query
def json_field_extract(t: Tables) -> DataFrame:
    v = F.try_parse_json("props")
    return t.read("events").select("event_id", J.text(v, "$.k").cast("bigint").alias("k"), J.text(v, "$.missing").alias("missing"))


@query
def field_presence(t: Tables) -> DataFrame:
    fields = ["mdr_report_key", "date_received", "event_type", "source_type", "patient", "device", "remedial_action", "product_code"]
    return C.field_presence(t.event_records(), "record", fields)


@query
def junk_code_filter(t: Tables) -> DataFrame:
    codes = t.read("part").selectExpr(
        "p_partkey", "CASE p_size % 5 WHEN 0 THEN '---' WHEN 1 THEN '-' WHEN 2 THEN NULL ELSE concat('-', p_brand) END AS product_code"
    )
    return codes.filter(~text.is_junk_code(F.col("product_code")))


@query
def blank_labels(t: Tables) -> DataFrame:
    labels = t.read("part").selectExpr(
        "p_partkey", "CASE p_size % 4 WHEN 0 THEN '  ' WHEN 1 THEN NULL WHEN 2 THEN concat(' ', p_brand, ' ') ELSE '' END AS label"
    )
    return labels.select("p_partkey", text.label_or_unknown(F.col("label")).alias("label"))


# Raw files


@query
def document_scan(t: Tables) -> DataFrame:
    return records.read_records(t.order_files(), zipped=False)


@query
def zip_scan(t: Tables) -> DataFrame:
    return records.read_records(t.order_files(zipped=True), zipped=True)


@query
def date_readability(t: Tables) -> DataFrame:
    return clean.date_readability(t.recall_records(), "recall_initiation_date", SETTINGS)


@query
def single_document_scan(t: Tables) -> DataFrame:
    """Documents that may be an object of columns instead of a list of records; the records' values are read."""
    found = records.read_records(t.supplier_files(), zipped=False, bare_object=True)
    fields = F.from_json("record", "k bigint, name string, region struct<nation: bigint>")
    return found.select("file", "member", "pos", fields.alias("r")).selectExpr("file", "member", "pos", "r.k", "r.name", "r.region.nation")


@query
def lookup_scan(t: Tables) -> DataFrame:
    """The recall-code lookup out of its documents' bytes."""
    return clean.recall_code_lookup(records.read_records(t.lookup_files(), zipped=False))


@query
def mart_order(t: Tables) -> DataFrame:
    """Rows of the panel and product marts by their place: keys ascend, nulls last."""
    panel = marts.mart_panel_year(t.events(), t.recalls(), t.clearances(), t.dim(), SETTINGS).select("review_panel", "year")
    product = marts.mart_product_year(t.events(), t.recalls(), t.clearances(), SETTINGS).select("product_code", "year")

    def placed(mart: DataFrame, name: str) -> DataFrame:
        # ids ascend in the order the sorted mart is read; the window holds one row per key of a mart
        read = mart.withColumn("_at", F.monotonically_increasing_id())
        place = F.row_number().over(Window.orderBy("_at"))
        return read.select(F.lit(name).alias("mart"), F.col(mart.columns[0]).alias("first_key"), "year", place.alias("place"))

    return placed(panel, "mart_panel_year").unionByName(placed(product, "mart_product_code_year"))


# Exports and profile


@query
def export_all(t: Tables) -> DataFrame:
    """The four app tables of one export run, columns that a table does not have as null."""
    facts = t.events(), t.recalls(), t.clearances()
    built = marts.build_all_marts(*facts, t.dim(), SETTINGS)
    apps = exports.export_all(built, dict(zip(("events", "recalls", "clearances", "dim"), (*facts, t.dim()), strict=True)), SMALL_CAPS)
    named = [df.withColumn("app", F.lit(name)) for name, df in apps.items()]
    out = named[0]
    for df in named[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


@query
def export_overview(t: Tables) -> DataFrame:
    return exports.app_overview(marts.mart_panel_year(t.events(), t.recalls(), t.clearances(), t.dim(), SETTINGS))


@query
def export_category_topn(t: Tables) -> DataFrame:
    mart = marts.mart_product_year(t.events(), t.recalls(), t.clearances(), SETTINGS)
    return exports.app_category_product(mart, t.dim(), SMALL_CAPS)


@query
def export_manufacturer_topn(t: Tables) -> DataFrame:
    mart = marts.mart_firm_product_year(t.events(), t.recalls(), t.dim(), SETTINGS)
    return exports.app_manufacturer(mart, t.dim(), SMALL_CAPS)


@query
def export_manufacturer_top_per_product(t: Tables) -> DataFrame:
    mart = marts.mart_firm_product_year(t.events(), t.recalls(), t.dim(), SETTINGS)
    top = exports.app_manufacturer(mart, t.dim(), replace(SETTINGS, manufacturer_rows=3), partition_by="product_code")
    return top.select("manufacturer", "product_code", "year", "event_count_dedup")


@query
def methodology_metrics(t: Tables) -> DataFrame:
    return exports.app_methodology(t.events(), t.recalls(), t.clearances(), t.dim(), SETTINGS)


@query
def source_profile(t: Tables) -> DataFrame:
    return exports.source_profile(t.clearances(), "clearances", "decision_date")


@query
def code_coverage(t: Tables) -> DataFrame:
    return exports.code_coverage(t.events(), t.dim())


# Quality


@query
def qa_row_count(t: Tables) -> DataFrame:
    return quality.run_checks([quality.check_row_count(t.dim(), "dim", 100), quality.check_row_count(t.dim(), "dim_large", 10**9)])


@query
def qa_null_rate(t: Tables) -> DataFrame:
    events = t.unranked_events()
    checks = [quality.check_null_rate(events, "product_code", limit) for limit in (0.05, 0.015, 0.001)]
    return quality.run_checks([*checks, quality.check_null_rate(events, "absent", 0.05)])


@query
def qa_uniqueness(t: Tables) -> DataFrame:
    return quality.run_checks(
        [
            quality.check_uniqueness(t.recalls(), ["recall_number"], "recall_number"),
            quality.check_uniqueness(t.dim(), ["product_code"], "dim"),
            quality.check_uniqueness(t.events(), ["product_code", "event_year"], "code_year"),
            quality.check_uniqueness(t.dim().where("product_code = 'none'"), ["product_code"], "nothing"),
        ]
    )


@query
def qa_dedup_ratio(t: Tables) -> DataFrame:
    sizes = t.events().agg(F.count("*").alias("raw"), F.count_if("is_latest_version").alias("kept"))
    return quality.run_checks([quality.check_dedup_ratio(sizes, "raw", "kept", "events", limit) for limit in (0.5, 0.7, 0.8)])


@query
def qa_coverage(t: Tables) -> DataFrame:
    return quality.run_checks(
        [
            quality.check_coverage(t.recalls(), "product_code"),
            quality.check_coverage(t.recalls(), "matched_product_code"),
            quality.check_coverage(t.recalls(), "product_code", t.dim()),
            quality.check_coverage(t.clearances(), "absent"),
        ]
    )


@query
def qa_volume_shift(t: Tables) -> DataFrame:
    return quality.run_checks(
        [
            quality.check_volume_shift(t.unranked_events(), "event_year"),
            quality.check_volume_shift(t.clearances(), "decision_year", max_change=0.25),
            quality.check_volume_shift(t.clearances().where("decision_year = 1997"), "decision_year"),
            quality.check_volume_shift(t.unranked_events(), "event_year", "l_quantity"),
        ]
    )


@query
def year_changes(t: Tables) -> DataFrame:
    return quality.year_changes(t.clearances(), "decision_year")


def _summary(t: Tables) -> DataFrame:
    events, recalls, clearances, dim = t.events(), t.recalls(), t.clearances(), t.dim()
    built = marts.build_all_marts(events, recalls, clearances, dim, SETTINGS)
    apps = {
        "app_overview": exports.app_overview(built["mart_panel_year"]),
        "app_category_product": exports.app_category_product(built["mart_product_code_year"], dim, SMALL_CAPS),
    }
    layer = {"events": events, "recalls": recalls, "clearances": clearances, "dim_product_code": dim}
    return quality_suites.qa_summary(t.spark, layer, built, apps, SMALL_CAPS)


@query
def qa_summary(t: Tables) -> DataFrame:
    return _summary(t)


@query
def quality_gate(t: Tables) -> DataFrame:
    return quality.quality_gate(_summary(t))


@query
def qa_grain(t: Tables) -> DataFrame:
    """The grain assertion as data: duplicate keys per mart."""
    built = marts.build_all_marts(t.events(), t.recalls(), t.clearances(), t.dim(), SETTINGS)
    return quality.run_checks([quality.check_uniqueness(df, quality_suites.MART_KEYS[name], name) for name, df in built.items()])


@query
def event_stage_checks(t: Tables) -> DataFrame:
    """The checks after the event stage, with their literals; every supplier stands for an alias."""
    alias = t.read("supplier").selectExpr("s_name AS raw_name", "s_name AS standardized_name")
    return quality_suites.event_stage_checks(t.events(), t.dim(), alias)


@query
def recall_stage_checks(t: Tables) -> DataFrame:
    return quality_suites.recall_stage_checks(t.recalls(), t.clearances(), t.dim())


@query
def kpi_null_invariant(t: Tables) -> DataFrame:
    guarded = replace(SETTINGS, min_clearances=60, min_recalls=12)
    mart = marts.mart_panel_year(t.events(), t.recalls(), t.clearances(), t.dim(), guarded)
    return quality.kpi_null_invariant(
        mart, [("events_per_100_clearances", "clearance_count", 60), ("severe_recall_share", "recall_count", 12)]
    )


@query
def mapping_rates(t: Tables) -> DataFrame:
    return quality_suites.mapping_rates(t.recalls(), t.clearances(), t.dim())


@query
def stage_decision(t: Tables) -> DataFrame:
    rates = quality_suites.mapping_rates(t.recalls(), t.clearances(), t.dim())
    checks = quality.run_checks(
        [quality.check_uniqueness(t.dim(), ["product_code"], "dim"), quality.check_null_rate(t.recalls(), "recall_class")]
    )
    return quality_suites.stage_decision(rates, checks)


# Dashboard


def _panel_mart(t: Tables) -> DataFrame:
    return marts.mart_panel_year(t.events(), t.recalls(), t.clearances(), t.dim(), SETTINGS)


@query
def kpi_cards(t: Tables) -> DataFrame:
    return dashboard.kpi_cards(_panel_mart(t))


@query
def yearly_trend(t: Tables) -> DataFrame:
    return dashboard.yearly_trend(_panel_mart(t))


@query
def panel_ranking(t: Tables) -> DataFrame:
    guarded = replace(SETTINGS, min_clearances=60)
    return dashboard.panel_ranking(marts.mart_panel_year(t.events(), t.recalls(), t.clearances(), t.dim(), guarded))


@query
def scatter_latest_year(t: Tables) -> DataFrame:
    return dashboard.product_scatter(marts.mart_product_year(t.events(), t.recalls(), t.clearances(), SETTINGS))


@query
def pareto_products(t: Tables) -> DataFrame:
    mart = marts.mart_product_year(t.events(), t.recalls(), t.clearances(), SETTINGS)
    return dashboard.pareto_products(mart, t.dim())


@query
def firm_concentration(t: Tables) -> DataFrame:
    mart = marts.mart_firm_product_year(t.events(), t.recalls(), t.dim(), SETTINGS)
    return dashboard.firm_concentration(mart, t.dim(), 5)


@query
def firm_profile(t: Tables) -> DataFrame:
    mart = marts.mart_firm_product_year(t.events(), t.recalls(), t.dim(), SETTINGS)
    return dashboard.firm_profile(mart, "Supplier#000000007")


@query
def partial_year_flag(t: Tables) -> DataFrame:
    flagged = dashboard.flag_partial_year(_panel_mart(t), SETTINGS.year_max)
    return flagged.select("review_panel", "year", "event_count_dedup", "is_partial_year")


@query
def panel_spot_check(t: Tables) -> DataFrame:
    return dashboard.panel_spot_check(_panel_mart(t), ["Brand#3", "Brand#7", "Brand#11"])


# Landing index


@query
def partition_pruning(t: Tables) -> DataFrame:
    return partition_index.prune_partitions(t.partition_index(), 2019, 2025).select("file", "display_name", "year")


@query
def landed_volume(t: Tables) -> DataFrame:
    return partition_index.landed_volume(partition_index.prune_partitions(t.partition_index(), 2019, 2025))


@query
def landing_names(t: Tables) -> DataFrame:
    return t.partition_index().select("file", partition_index.landing_name(F.col("file")).alias("landed_name"))


# Fuzzy matching


def _name_pairs(t: Tables) -> DataFrame:
    """Every supplier's company name against the names of the suppliers around it."""
    names = t.companies()
    left = names.select(F.col("s_suppkey").alias("a_key"), F.col("company").alias("a"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("step"))
    left = left.withColumn("b_key", F.col("a_key") + F.col("step") * F.col("step"))
    return left.join(names.select(F.col("s_suppkey").alias("b_key"), F.col("company").alias("b")), "b_key")


@query
def indel_ratio(t: Tables) -> DataFrame:
    return _name_pairs(t).select("a_key", "b_key", F.round(ratio(F.col("a"), F.col("b")), 6).alias("score"))


@query
def token_sort(t: Tables) -> DataFrame:
    return _name_pairs(t).select("a_key", "b_key", F.round(token_sort_ratio(F.col("a"), F.col("b")), 6).alias("score"))


@query
def token_set(t: Tables) -> DataFrame:
    return _name_pairs(t).select("a_key", "b_key", F.round(token_set_ratio(F.col("a"), F.col("b")), 6).alias("score"))


_SIMILARITY_IN_SQL = """
    SELECT a_key, b_key, round(indel_ratio(a, b), 6) AS plain, round(token_sort_ratio(a, b), 6) AS sorted, round(token_set_ratio(a, b), 6) AS sets
    FROM {pairs}
"""


@query
def similarity_in_sql(t: Tables) -> DataFrame:
    """All three scores of every pair, by a query written in SQL with the registered functions."""
    register_functions(t.spark)
    return t.spark.sql(_SIMILARITY_IN_SQL, pairs=_name_pairs(t))


_KPIS_IN_SQL = """
    WITH counts AS (
        SELECT l_suppkey, year(l_shipdate) AS year, count(*) AS events, count_if(l_linenumber = 7) AS recalls,
               count_if(l_returnflag = 'R') AS clearances, count_if(l_linenumber = 7 AND l_tax = 0) AS class_i
        FROM {lines} GROUP BY ALL
    )
    SELECT l_suppkey, year, events_per_100_clearances(events, clearances, 25) AS events_per_100_clearances,
           recalls_per_100_clearances(recalls, clearances, 25) AS recalls_per_100_clearances,
           recall_to_event_ratio(events, recalls) AS recall_to_event_ratio, severe_recall_share(class_i, recalls) AS severe_recall_share,
           firm_share(recalls, class_i) AS firm_share
    FROM counts
"""


@query
def kpis_in_sql(t: Tables) -> DataFrame:
    """The five KPIs by a query written in SQL with the registered functions."""
    register_functions(t.spark)
    return t.spark.sql(_KPIS_IN_SQL, lines=t.read("lineitem"))


def _similar_names(t: Tables, cutoff: float) -> DataFrame:
    found = mapping.all_above(t.companies(), t.companies(), "s_suppkey", "company", cutoff).where("query_key <> choice_key")
    return found.select(F.col("query_key").alias("a_key"), F.col("choice_key").alias("b_key"), F.round("score", 6).alias("score"))


@query
def extract_one(t: Tables) -> DataFrame:
    """For every company name the best of all other names, if it scores 80 or more."""
    return mapping.best_others(t.companies(), "s_suppkey", "company", 80.0).toDF("a_key", "b_key", "score")


@query
def extract_above(t: Tables) -> DataFrame:
    """For every company name all other names that score 90 or more."""
    return choices_above(_similar_names(t, 90.0), "score", 90.0).select("a_key", "b_key", "score")


@query
def sorted_tokens(t: Tables) -> DataFrame:
    return t.companies().select("s_suppkey", sorted_form(F.col("company")).alias("form"))


def _firm_mentions(t: Tables) -> DataFrame:
    """Names as reports spell them: legal forms, swapped words, typing errors."""
    return t.shipped().selectExpr(
        "CASE l_linenumber WHEN 1 THEN s_name WHEN 2 THEN concat(s_name, ', Inc.') WHEN 3 THEN concat('Region ', CAST(s_nationkey AS STRING), "
        "' Instruments') WHEN 4 THEN concat('instruments region ', CAST(s_nationkey AS STRING), ' LLC') WHEN 5 THEN concat('Regon ', "
        "CAST(s_nationkey AS STRING), ' Instruments') WHEN 6 THEN concat(split_part('Arbor Basalt Cobalt Dynamo Ember Fathom Garnet Harbor', "
        "' ', CAST(s_suppkey % 8 + 1 AS INT)), ' Medical GmbH') END AS manufacturer_d_name"
    )


@query
def manufacturer_alias(t: Tables) -> DataFrame:
    alias = mapping.manufacturer_alias(_firm_mentions(t), review_top_n=20)
    return alias.withColumn("confidence_level", F.round("confidence_level", 6))


@query
def alias_reduction(t: Tables) -> DataFrame:
    return C.alias_reduction(mapping.manufacturer_alias(_firm_mentions(t)))


@query
def alias_rules(t: Tables) -> DataFrame:
    """Rule and confidence of given pairs, and the review flag for the best-scored ones, ties included."""
    pairs = _name_pairs(t).select(F.col("a").alias("raw_name"), F.expr("CASE WHEN step % 3 = 0 THEN a ELSE b END").alias("standardized_name"))
    pairs = pairs.unionByName(
        t.companies().join(t.read("supplier").select("s_suppkey", "s_name"), "s_suppkey").selectExpr("company AS raw_name", "s_name AS standardized_name")
    )
    labelled = mapping.label_aliases(pairs, 50)
    return labelled.withColumn("confidence_level", F.round("confidence_level", 6))


@query
def fuzzy_recall_mapping(t: Tables) -> DataFrame:
    mapped = mapping.map_recalls(t.described_recalls(), t.dim())
    return mapped.withColumn("match_score", F.round("match_score", 6))


@query
def best_text_match(t: Tables) -> DataFrame:
    texts = t.described_recalls().select(text.denoise_description(F.col("product_description")).alias("cleaned")).distinct()
    names = mapping.match_names(t.dim())
    found = best_match(texts, "cleaned", names, name="device_name", code="code", place="first_place", cutoff=60)
    return found.withColumn("match_score", F.round("match_score", 6))
