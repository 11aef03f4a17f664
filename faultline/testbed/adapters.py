"""The benchmark tables in the schemas of the library: clean tables, and raw JSON records.

Every adapter reads whole tables; nothing is cached or collected.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.config import Settings
from faultline.operators.dedup import rank_versions

# The tables cover 1995-2001; the first and last year are cut off by the window.
SETTINGS = Settings(window_first_year=1996, window_last_year=2000, year_min=1996, year_max=2000)


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Clean tables

    def dim(self) -> DataFrame:
        """Products, some under a code that no fact uses, so that some facts have none; and null and blank panels."""
        return self.read("part").selectExpr(
            "CASE WHEN p_partkey % 10 = 0 THEN concat('X', CAST(p_partkey AS STRING)) ELSE CAST(p_partkey AS STRING) END AS product_code",
            "p_name AS device_name",
            "CASE WHEN p_size = 50 THEN NULL WHEN p_size = 49 THEN '' ELSE p_brand END AS review_panel",
            "CAST(p_size % 3 + 1 AS STRING) AS device_class",
            "p_type AS medical_specialty_description",
        )

    def shipped(self) -> DataFrame:
        return self.read("lineitem").join(self.read("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))

    def unranked_events(self) -> DataFrame:
        return self.shipped().selectExpr(
            "concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS event_record_id",
            "CAST(l_orderkey AS STRING) AS mdr_report_key",
            "CAST(l_shipdate AS DATE) AS date_received",
            "year(l_shipdate) AS event_year",
            "CASE WHEN l_quantity = 1 THEN NULL ELSE CAST(l_partkey AS STRING) END AS product_code",
            "s_name AS manufacturer_d_name",
            "l_returnflag = 'R' AS has_death",
            "l_returnflag = 'A' AS has_serious_injury",
            "l_linestatus = 'F' AS has_malfunction",
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        )

    def events(self, **options) -> DataFrame:
        ties = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
        keys = self.read("lineitem").select(F.col("l_orderkey").cast("string").alias("mdr_report_key"))
        return rank_versions(self.unranked_events(), tie_break=ties, keys=keys, **options)

    def recalls(self) -> DataFrame:
        """Mapped recalls, one per line item; the recall number repeats now and then."""
        return self.shipped().selectExpr(
            "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS recall_number",
            "CAST(l_shipdate AS DATE) AS recall_initiation_date",
            "year(l_shipdate) AS recall_year",
            "CASE l_linenumber % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'II' ELSE 'III' END AS recall_class",
            "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST(l_partkey AS STRING) END AS product_code",
            "CASE WHEN l_partkey % 4 = 0 THEN CAST(l_partkey AS STRING) END AS matched_product_code",
            "s_name AS recalling_firm",
            "l_returnflag = 'R' AND l_discount >= 0.05 AND l_tax <= 0.06 AS include_in_core_dashboard",
            "CASE l_partkey % 5 WHEN 0 THEN 'exact_product_code_match' WHEN 1 THEN 'high_confidence_text_match' "
            "WHEN 2 THEN 'low_confidence_text_match' ELSE 'unmapped' END AS mapping_quality",
        )

    def clearances(self) -> DataFrame:
        """One clearance per order, for the least product of its lines."""
        products = self.read("lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("l_partkey"))
        return products.join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
            "CAST(o_orderkey AS STRING) AS k_number",
            "CAST(o_orderdate AS DATE) AS decision_date",
            "year(o_orderdate) AS decision_year",
            "CAST(l_partkey AS STRING) AS product_code",
            "o_orderpriority AS decision_code",
        )

    def companies(self) -> DataFrame:
        """Company names with punctuation, legal forms and double spaces."""
        return self.read("supplier").selectExpr(
            "s_suppkey",
            "concat(s_name, CASE CAST(s_suppkey % 5 AS INT) WHEN 0 THEN ', Inc.' WHEN 1 THEN ' LLC' "
            "WHEN 2 THEN ' Holdings  Group Ltd' WHEN 3 THEN ' GmbH & Co' ELSE '' END) AS company",
        )

    def described_recalls(self) -> DataFrame:
        """Recalls to be mapped: some codes unknown, descriptions with noise, reordered and misspelt names; spread as a scan of files is."""
        lines = self.read("lineitem")
        return lines.join(self.read("part"), F.col("l_partkey") == F.col("p_partkey")).selectExpr(
            "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS recall_number",
            "CASE WHEN l_partkey % 3 = 0 THEN CAST(l_partkey AS STRING) WHEN l_partkey % 3 = 1 THEN 'none' END AS product_code",
            _DESCRIPTION + " AS product_description",
        ).repartition("recall_number")

    # Raw records

    def event_records(self) -> DataFrame:
        """One report version per line item, with zero to two devices; spread by file, as a scan of files is."""
        return self.shipped().select(
            F.concat(F.lit("/in/"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0"), F.lit(".zip")).alias("file"),
            F.lit(0).alias("member"),
            (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("pos"),
            _json_object(
                '"mdr_report_key":"', "CAST(l_orderkey AS STRING)", '"',
                ',"date_received":"', "CASE WHEN l_linenumber = 7 THEN 'BADDATE' ELSE date_format(l_shipdate, 'yyyyMMdd') END", '"',
                "", "CASE WHEN l_discount = 0 THEN '' WHEN l_linestatus = 'F' THEN ',\"event_type\":\"Malfunction\"' "
                    "ELSE ',\"event_type\":\"Injury\"' END", "",
                "", "CASE WHEN l_suppkey % 7 = 0 THEN '' WHEN l_suppkey % 11 = 0 THEN ',\"source_type\":[]' "
                    "WHEN l_suppkey % 2 = 0 THEN ',\"source_type\":[\"Company\",\"Other\"]' "
                    "ELSE ',\"source_type\":\"User\"' END", "",
                "", "CASE WHEN l_tax = 0 THEN ',\"remedial_action\":[]' WHEN l_tax > 0.04 THEN "
                    "',\"remedial_action\":[\"Recall\"]' ELSE '' END", "",
                ',"adverse_event_flag":"', "CASE l_linenumber % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE '' END", '"',
                "", "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN ',\"patient\":[{\"sequence_number_outcome\":\"Death\"}]' "
                    "WHEN l_returnflag = 'R' THEN ',\"patient\":[{},{\"sequence_number_outcome\":[\" d\",\"Other\"]}]' "
                    "WHEN l_returnflag = 'A' THEN ',\"patient\":[{\"sequence_number_outcome\":[\"x\",\" Hospitalization\"]}]' "
                    "WHEN l_linestatus = 'F' THEN ',\"patient\":[{\"sequence_number_outcome\":[\"\",\"Required Intervention\"]}]' "
                    "ELSE '' END", "",
                "", "CASE l_linenumber % 3 WHEN 0 THEN '' ELSE concat(',\"device\":[{\"brand_name\":\"', l_returnflag, "
                    "'\",\"manufacturer_d_name\":\"', s_name, '\"', CASE WHEN l_quantity = 1 THEN '' ELSE "
                    "concat(',\"device_report_product_code\":\"', CAST(l_partkey AS STRING), '\"') END, '}', "
                    "CASE l_linenumber % 3 WHEN 2 THEN ',{\"generic_name\":\"second\"}' ELSE '' END, ']') END", "",
            ).alias("record"),
        ).repartition("file")

    def recall_records(self) -> DataFrame:
        return self.shipped().select(
            *_document("recalls", F.col("l_partkey") * 100000000 + F.round(F.col("l_extendedprice") * 100).cast("bigint")),
            _json_object(
                '"recall_number":"', "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))", '"',
                ',"recall_initiation_date":"', "CASE WHEN l_linenumber = 7 THEN 'BADDATE' WHEN l_linenumber % 2 = 0 THEN "
                    "date_format(l_shipdate, 'yyyy-MM-dd') ELSE date_format(l_shipdate, 'yyyyMMdd') END", '"',
                ',"classification":"', "CASE l_linenumber % 4 WHEN 0 THEN 'Class I' WHEN 1 THEN 'Class  II' WHEN 2 THEN 'Class III' "
                    "ELSE 'unclassified' END", '"',
                ',"product_description":"', "l_linestatus", '"',
                ',"recalling_firm":"', "s_name", '"',
                "", "CASE WHEN l_partkey % 3 = 0 THEN concat(',\"openfda\":{\"product_code\":[\"', CAST(l_partkey AS STRING), "
                    "'\",\"zz\"]}') WHEN l_partkey % 3 = 1 THEN ',\"openfda\":{\"product_code\":[]}' ELSE '' END", "",
            ).alias("record"),
        ).repartition("file")

    def lookup_records(self) -> DataFrame:
        """Product codes by recall number, with trailing dashes, several per number."""
        return self.shipped().select(
            *_document("recall_product_codes", F.col("l_partkey") * 100000000 + F.round(F.col("l_extendedprice") * 100).cast("bigint")),
            _json_object(
                '"product_res_number":"', "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))", '"',
                ',"product_code":"', "CASE WHEN l_partkey % 5 = 0 THEN '' ELSE concat('P', CAST(l_partkey AS STRING), "
                    "CASE WHEN l_partkey % 2 = 0 THEN '--' ELSE '' END) END", '"',
            ).alias("record"),
        ).repartition("file")

    def clearance_records(self) -> DataFrame:
        """One record per line item, so that an order has several and the first has to win."""
        joined = self.read("lineitem").join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        joined = joined.join(self.companies(), F.col("l_suppkey") == F.col("s_suppkey"))
        return joined.select(
            *_document("clearances", F.col("l_partkey") * 100000000 + F.round(F.col("l_extendedprice") * 100).cast("bigint")),
            _json_object(
                '"k_number":"K', "CAST(o_orderkey AS STRING)", '"',
                ',"decision_date":"', "date_format(o_orderdate, 'yyyy-MM-dd')", '"',
                ',"decision_code":"', "o_orderpriority", '"',
                "", "CASE WHEN l_suppkey % 9 = 0 THEN '' ELSE concat(',\"applicant\":\"', company, '\"') END", "",
                "", "CASE l_partkey % 3 WHEN 0 THEN concat(',\"product_code\":\"', CAST(l_partkey AS STRING), '\"') "
                    "WHEN 1 THEN concat(',\"product_code\":\"\",\"openfda\":{\"product_code\":[\"N', CAST(l_partkey AS STRING), '\"]}') "
                    "ELSE '' END", "",
            ).alias("record"),
        ).repartition("file")

    def classification_records(self) -> DataFrame:
        """Each product code twice, so that the first record has to win."""
        return self.read("part").select(
            *_document("classification", F.col("p_partkey")),
            _json_object(
                '"product_code":"', "CAST(p_partkey DIV 2 AS STRING)", '"',
                ',"device_name":"', "p_name", '"',
                ',"review_panel":"', "p_brand", '"',
                ',"implant_flag":"', "CASE p_size % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'U' END", '"',
            ).alias("record"),
        )

    def order_files(self, zipped: bool = False) -> DataFrame:
        """(path, content): one JSON document per customer with its orders, as an object or a bare list; or in an archive."""
        record = F.expr("concat('{\"k\": ', CAST(o_orderkey AS STRING), ', \"s\": \"', o_orderpriority, '\", \"n\": [1, {\"results\": null}]}')")
        orders = self.read("orders").select("o_custkey", F.struct("o_orderkey", record.alias("record")).alias("o"))
        files = orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o")).alias("orders"))
        body = F.array_join("orders.record", ", ")
        wrapped = F.concat(F.lit('{"meta": {"results": [{}]}, "results": ['), body, F.lit("]}"))
        text = F.when(F.col("o_custkey") % 2 == 0, wrapped).otherwise(F.concat(F.lit("["), body, F.lit("]")))
        path = F.concat(F.lit("/in/"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lit(".zip" if zipped else ".json"))
        files = files.select(path.alias("path"), F.encode(text, "UTF-8").alias("content"))
        return files.mapInPandas(_archives, files.schema) if zipped else files

    def supplier_files(self) -> DataFrame:
        """(path, content): one JSON document per supplier, a list that holds its record or an object of columns."""
        record = F.expr("concat('{\"k\": ', CAST(s_suppkey AS STRING), ', \"name\": \"', s_name, '\", \"region\": {\"nation\": ', CAST(s_nationkey AS STRING), '}}')")
        columns = F.expr("concat('{\"k\": [', CAST(s_suppkey AS STRING), '], \"name\": [\"', s_name, '\"], \"region\": [{\"nation\": ', CAST(s_nationkey AS STRING), '}]}')")
        text = F.when(F.col("s_suppkey") % 2 == 0, columns).otherwise(F.concat(F.lit("[ "), record, F.lit(" ]")))
        path = F.concat(F.lit("/in/"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0"), F.lit(".json"))
        return self.read("supplier").select(path.alias("path"), F.encode(text, "UTF-8").alias("content"))

    def lookup_files(self) -> DataFrame:
        """(path, content): the records of ``lookup_records`` as one document per file."""
        files = self.lookup_records().groupBy(F.col("file").alias("path")).agg(F.array_sort(F.collect_list(F.struct("pos", "record"))).alias("rows"))
        text = F.concat(F.lit('{"results": ['), F.array_join("rows.record", ", "), F.lit("]}"))
        return files.select("path", F.encode(text, "UTF-8").alias("content"))

    def partition_index(self) -> DataFrame:
        """One download partition per order: year in the name, in the path, out of range or nowhere."""
        return self.read("orders").selectExpr(
            "concat('/bulk/', CASE WHEN o_orderkey % 4 = 1 THEN concat('(', CAST(2000 + o_orderkey % 31 AS STRING), ')') "
            "ELSE 'all' END, '/device-event-', CAST(o_orderkey AS STRING), '.json.zip') AS file",
            "CASE o_orderkey % 4 WHEN 0 THEN concat(CAST(2000 + o_orderkey % 29 AS STRING), ' Q', CAST(o_orderkey % 4 + 1 AS STRING), "
            "' (part ', CAST(o_orderkey AS STRING), ')') WHEN 2 THEN 'All other data 1999' ELSE 'part of it' END AS display_name",
            "CASE WHEN o_orderkey % 10 = 3 THEN NULL WHEN o_orderkey % 10 = 4 THEN 'n/a' ELSE CAST(o_orderkey % 100 AS STRING) END AS size_mb",
        )


def _archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each document as the member of an archive that also has a note, which is no JSON."""
    for batch in batches:
        packed = []
        for content in batch["content"]:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("note.txt", "nothing")
                archive.writestr("data.json", content)
            packed.append(buffer.getvalue())
        yield batch.assign(content=packed)


_DESCRIPTION = (
    "concat(CASE l_linenumber % 4 WHEN 0 THEN p_name WHEN 1 THEN concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1)) "
    "WHEN 2 THEN concat(split_part(p_name, ' ', 2), 's for clinical use') ELSE replace(p_name, 'i', 'yy') END, "
    "' Model XR-', CAST(l_partkey AS STRING), ' Lot Number: ', CAST(l_orderkey AS STRING))"
)


def _document(name: str, pos: Column) -> list[Column]:
    """Place of a record: its file and the position in it."""
    key = "p_partkey" if name == "classification" else "l_suppkey"
    folder = F.lpad(F.col(key).cast("string"), 8, "0") if name != "classification" else F.lit("all")
    return [F.concat(F.lit("/raw/"), folder, F.lit(f"/{name}.json")).alias("file"), F.lit(0).alias("member"), pos.alias("pos")]


def _json_object(*parts: str) -> Column:
    """JSON text from triples of literal, SQL expression, literal."""
    pieces = [F.lit("{")]
    for i in range(0, len(parts), 3):
        pieces += [F.lit(parts[i]), F.expr(parts[i + 1]), F.lit(parts[i + 2])]
    return F.concat(*pieces, F.lit("}"))
