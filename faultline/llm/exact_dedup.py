"""Exact dedup: group by a 128-bit content hash, keep one row by its stable id, compare bytes inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import table


def text_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def exact_classes(docs: DataFrame, content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by (hash, text): the 128-bit hash deals them out, and the aggregate compares whole keys, so texts of
    equal hash stay apart. Copies shrink to one row per map task before the shuffle, which carries each text once. Rows
    then meet their class by hash and digest, without texts; a row's side of that join may be split where it is hot.

    Null text counts as empty. The largest id of a class stays; rows that repeat id and text of the keeper are the same
    row and are all marked kept. A null id loses to any other. An empty table gives an empty result; other columns are
    ignored.
    """
    text = text_of(docs)
    rows = docs.select("doc_id", text.alias("text")).withColumns({"h": content_hash(F.col("text")), "text_sha256": F.sha2("text", 256)})
    classes = rows.groupBy("h", "text_sha256", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    classes = classes.select(F.col("h").alias("_h"), F.col("text_sha256").alias("_s"), "keep_id", "group_size")
    met = rows.select("doc_id", "h", "text_sha256").join(classes, (F.col("h") == F.col("_h")) & (F.col("text_sha256") == F.col("_s")))
    return met.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """The row of largest id of every class of equal texts, with all columns of ``docs``; null and empty texts are equal.

    Of rows that repeat the keeper's id, one stays. One shuffle: the keeper's other columns ride along as a struct.
    """
    names = docs.columns
    rest = [F.when(docs[c].isNull(), None).otherwise(F.lit(True)).alias(c) if c == "text" else docs[c].alias(c) for c in names]
    packed = docs.select(text_of(docs).alias("_text"), docs["doc_id"].alias("_id"), F.struct(*rest).alias("_row"))
    packed = packed.withColumn("_h", content_hash(F.col("_text")))
    # max_by skips null orders; a class that has only null ids falls back on any of its rows
    kept = packed.groupBy("_h", "_text").agg(F.coalesce(F.max_by("_row", "_id"), F.first("_row")).alias("_row"))
    return kept.select(*[F.when(F.col("_row.text"), F.col("_text")).alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in names])


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_classes(table(spark, sf_dir, "documents"))


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
